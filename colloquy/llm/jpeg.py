"""Progressive JPEG: a decoder in numpy, and an encoder that holds bytes as coefficients.

The decoder accumulates the scans of a progressive file in coefficient arrays:
spectral selection sends bands of coefficients, successive approximation first
their high bits and then one bit more in each refinement. An inverse transform
in numpy and chroma upsampling give full-resolution RGB.

The encoder writes 4:2:0 YCbCr whose quantized coefficients are payload bytes:
the first of each block as DC, the others as the signed number of eight bits
whose bits are the byte, so that all have one size and no run. It uses 10 scans:
DC, two bands of luma and one of each chroma component, then one refinement of
each of these. The first scan of a band takes a byte for a coefficient: one bit
of Huffman code and seven of value.
"""

from __future__ import annotations

import math
import struct
from functools import lru_cache

import numpy as np

#: Zigzag order (fixed by the format): natural place of the k-th coefficient.
ZIGZAG = np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, (p // 8 if (p // 8 + p % 8) % 2 else p % 8))), np.int64)
_k = np.arange(8)
_DCT = np.sqrt(np.where(_k == 0, 1, 2) / 8)[:, None] * np.cos((2 * _k[None, :] + 1) * _k[:, None] * np.pi / 16)
#: Natural-order coefficients times this matrix are the block's samples times SCALE. Its entries are whole numbers, and
#: with coefficients up to LARGEST no sum reaches 2 ** 53: products are exact, in whatever order a machine adds them.
SCALE, LARGEST = 1 << 22, 1 << 20
INVERSE = np.rint(np.kron(_DCT, _DCT) * SCALE)
#: Red by Cr, green by Cb and Cr, and blue by Cb, in 65536ths.
CHROMA = (91881, 22553, 46802, 116130)
_ONES = (1 << np.arange(15, -1, -1)).astype(np.int64)
#: Bands of each component that encode() sends in scans of their own.
BANDS = (((1, 5), (6, 63)), ((1, 63),), ((1, 63),))


class Jpeg:
    """What a file holds: size, sampling and coefficient arrays (blocks down, across, 64 in zigzag order)."""

    def __init__(self):
        self.width = self.height = 0
        self.ids: list[int] = []
        self.sampling: list[tuple[int, int]] = []
        self.tables: list[int] = []
        self.quant: dict[int, np.ndarray] = {}
        self.coefficients: list[np.ndarray] = []


@lru_cache(64)
def _huffman(counts: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    table, code, k = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            table[length, code] = symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return table


class _Bits:
    """A scan's entropy-coded bits, as an array and, where single codes are read, as digits."""

    def __init__(self, data: bytes):
        self.bytes = np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8)
        self.at = 0
        self._bits: np.ndarray | None = None
        self._digits = ""

    @property
    def bits(self) -> np.ndarray:
        if self._bits is None:
            self._bits = np.unpackbits(self.bytes)
        return self._bits

    def digits(self, n: int) -> str:
        if not self._digits:
            self._digits = (self.bits + 48).tobytes().decode("ascii")
        return self._digits[self.at : self.at + n]

    def symbol(self, table: dict) -> int:
        ahead, code = self.digits(16), 0
        for length, digit in enumerate(ahead, 1):
            code = code << 1 | (digit == "1")
            if (length, code) in table:
                self.at += length
                return table[length, code]
        raise ValueError("no such Huffman code")

    def number(self, n: int) -> int:
        value = int(self.digits(n), 2) if n else 0
        self.at += n
        return value

    def signed(self, size: int) -> int:
        value = self.number(size)
        return value if not size or value >> (size - 1) else value - (1 << size) + 1

    def take(self, n: int) -> np.ndarray:
        self.at += n
        return self.bits[self.at - n : self.at]


def _dc_first(bits: _Bits, order: np.ndarray, flat: list[np.ndarray], which: np.ndarray, tables: list[dict], al: int) -> None:
    last = [0] * len(flat)
    values = np.zeros(len(order), np.int64)
    for i, c in enumerate(which.tolist()):
        last[c] += bits.signed(bits.symbol(tables[c]))
        values[i] = last[c]
    for c, f in enumerate(flat):
        f[order[which == c], 0] = values[which == c] << al


def _ac_first(bits: _Bits, f: np.ndarray, table: dict, ss: int, se: int, al: int) -> None:
    n, band = len(f), se - ss + 1
    if len(table) == 1:
        ((length, _), symbol), = table.items()
        size = symbol & 15
        if symbol >> 4 == 0 and size:
            # One symbol without a run: all coefficients take the same number of bits, eight where they are bytes.
            if length + size == 8:
                values = (bits.bytes[: n * band] & ((1 << size) - 1)).astype(np.int16)
            else:
                rows = bits.take(n * band * (length + size)).reshape(n * band, length + size)[:, length:]
                values = np.packbits(rows[:, :8], axis=1)[:, 0].astype(np.int16) >> max(0, 8 - size)
                for k in range(8, size):
                    values = values << 1 | rows[:, k]
            values -= np.where(values >> (size - 1), 0, (1 << size) - 1).astype(np.int16)
            f[:, ss : se + 1] = (values << al).reshape(n, band)
            return
    run = 0
    for b in range(n):
        if run:
            run -= 1
            continue
        k = ss
        while k <= se:
            symbol = bits.symbol(table)
            r, size = symbol >> 4, symbol & 15
            if size:
                k += r
                f[b, k] = bits.signed(size) << al
                k += 1
            elif r == 15:
                k += 16
            else:
                run = (1 << r) + bits.number(r) - 1
                break


def _correct(bits: _Bits, part: np.ndarray, al: int) -> None:
    """One more bit for each nonzero coefficient of part, in order."""
    if part.all():
        more = bits.take(part.size).reshape(part.shape).astype(part.dtype) << al
        part += np.where(part < 0, -more, more)
        return
    nonzero = part != 0
    values = part[nonzero]
    more = bits.take(len(values)).astype(part.dtype) << al
    part[nonzero] = values + np.where(values < 0, -more, more)


def _ac_refine(bits: _Bits, f: np.ndarray, table: dict, ss: int, se: int, al: int) -> None:
    n, b = len(f), 0
    while b < n:
        k, run = ss, 0
        while k <= se:
            symbol = bits.symbol(table)
            r, size = symbol >> 4, symbol & 15
            if not size and r < 15:
                run = (1 << r) + bits.number(r)
                break
            new = (1 if bits.number(1) else -1) << al if size else 0
            # Skip r zeros; correct the nonzero coefficients on the way.
            while k <= se:
                if f[b, k]:
                    if bits.number(1):
                        f[b, k] += (1 << al) if f[b, k] > 0 else -(1 << al)
                elif r == 0:
                    break
                else:
                    r -= 1
                k += 1
            if new and k <= se:
                f[b, k] = new
            k += 1
        if run:
            _correct(bits, f[b, k : se + 1], al)
            _correct(bits, f[b + 1 : b + run, ss : se + 1], al)
            b += run
        else:
            b += 1


def _interleaved(jpeg: Jpeg, parts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Order of blocks in an interleaved scan: block numbers, and which of the parts each belongs to."""
    hmax, vmax = max(h for h, _ in jpeg.sampling), max(v for _, v in jpeg.sampling)
    across, down = -(-jpeg.width // (8 * hmax)), -(-jpeg.height // (8 * vmax))
    return _mcu_order(across, down, tuple(jpeg.sampling[c] for c in parts))


@lru_cache(64)
def _mcu_order(across: int, down: int, sampling: tuple) -> tuple[np.ndarray, np.ndarray]:
    y, x = np.divmod(np.arange(across * down), across)
    columns, owners = [], []
    for i, (h, v) in enumerate(sampling):
        for dy in range(v):
            for dx in range(h):
                columns.append((y * v + dy) * (across * h) + x * h + dx)
                owners.append(i)
    return np.stack(columns, 1).reshape(-1), np.tile(np.array(owners), across * down)


def _scan(jpeg: Jpeg, header: bytes, data: bytes, huffman: dict) -> None:
    n = header[0]
    parts = [jpeg.ids.index(header[1 + 2 * i]) for i in range(n)]
    selectors = [header[2 + 2 * i] for i in range(n)]
    ss, se, approx = header[1 + 2 * n : 4 + 2 * n]
    ah, al = approx >> 4, approx & 15
    bits = _Bits(data)
    flat = [jpeg.coefficients[c].reshape(-1, 64) for c in parts]
    if n > 1:
        order, which = _interleaved(jpeg, parts)
    else:
        h, v = jpeg.sampling[parts[0]]
        hmax, vmax = max(a for a, _ in jpeg.sampling), max(b for _, b in jpeg.sampling)
        across, down = -(-jpeg.width * h // (8 * hmax)), -(-jpeg.height * v // (8 * vmax))
        grid = jpeg.coefficients[parts[0]].shape
        order = (np.arange(down)[:, None] * grid[1] + np.arange(across)).reshape(-1)
        which = np.zeros(len(order), np.int64)
    if ss == 0:
        if ah == 0:
            _dc_first(bits, order, flat, which, [huffman[0, s >> 4] for s in selectors], al)
        else:
            more = bits.take(len(order)).astype(np.int64) << al
            for i, f in enumerate(flat):
                f[order[which == i], 0] |= more[which == i]
        return
    f = flat[0][order]
    (_ac_refine if ah else _ac_first)(bits, f, huffman[1, selectors[0] & 15], ss, se, al)
    flat[0][order] = f


def decode(data: bytes) -> Jpeg:
    """Read a progressive file (8 bits, no restart intervals) into coefficient arrays."""
    jpeg, huffman, at = Jpeg(), {}, 2
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    while True:
        marker, = struct.unpack_from(">H", data, at)
        if marker == 0xFFD9:
            return jpeg
        length, = struct.unpack_from(">H", data, at + 2)
        body = data[at + 4 : at + 2 + length]
        at += 2 + length
        if marker == 0xFFDB:
            while body:
                wide = body[0] >> 4
                jpeg.quant[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[65 + 64 * wide :]
        elif marker == 0xFFC2:
            _, jpeg.height, jpeg.width, n = struct.unpack_from(">BHHB", body)
            for i in range(n):
                c, hv, t = body[6 + 3 * i : 9 + 3 * i]
                jpeg.ids.append(c)
                jpeg.sampling.append((hv >> 4, hv & 15))
                jpeg.tables.append(t)
            hmax, vmax = max(h for h, _ in jpeg.sampling), max(v for _, v in jpeg.sampling)
            across, down = -(-jpeg.width // (8 * hmax)), -(-jpeg.height // (8 * vmax))
            jpeg.coefficients = [np.zeros((down * v, across * h, 64), np.int16) for h, v in jpeg.sampling]
        elif marker == 0xFFC4:
            while body:
                n = sum(body[1:17])
                huffman[body[0] >> 4, body[0] & 15] = _huffman(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xFFDD and body != b"\0\0":
            raise ValueError("restart intervals are not supported")
        elif marker in (0xFFC0, 0xFFC1, 0xFFC3):
            raise ValueError("not a progressive file")
        elif marker == 0xFFDA:
            end = at
            while True:
                end = data.index(b"\xff", end)
                if data[end + 1]:
                    break
                end += 2
            _scan(jpeg, body, data[at:end], huffman)
            at = end


def rgb(jpeg: Jpeg) -> np.ndarray:
    """Full-resolution RGB, (height, width, 3) uint8."""
    return np.concatenate(list(strips(jpeg)))


#: Pixels of a strip at most, if one row of MCUs is not more.
STRIP = 1 << 18


def strips(jpeg: Jpeg):
    """RGB, a few rows of MCUs at a time, so that the memory of a large image's planes is bounded."""
    hmax, vmax = max(h for h, _ in jpeg.sampling), max(v for _, v in jpeg.sampling)
    down, step = -(-jpeg.height // (8 * vmax)), max(1, STRIP // (8 * vmax * jpeg.width))
    for top in range(0, down, step):
        yield _strip(jpeg, top, min(step, down - top), hmax, vmax)


def _samples(coefficients: np.ndarray, quant: np.ndarray) -> np.ndarray:
    """Samples (blocks, 64) of blocks of coefficients in zigzag order, as whole numbers from 0 to 255."""
    if quant.max() < 256:
        x = coefficients.astype(np.float64) @ (INVERSE[ZIGZAG] * quant[:, None])
    else:
        x = np.clip(coefficients * quant.astype(np.int64), -LARGEST, LARGEST).astype(np.float64) @ INVERSE[ZIGZAG]
    x += SCALE // 2 + 128 * SCALE
    x *= 1 / SCALE
    np.floor(x, out=x)
    np.clip(x, 0, 255, out=x)
    return x.astype(np.uint8)


def _strip(jpeg: Jpeg, top: int, rows: int, hmax: int, vmax: int) -> np.ndarray:
    planes, height = [], min(jpeg.height - 8 * vmax * top, 8 * vmax * rows)
    for whole, (h, v), t in zip(jpeg.coefficients, jpeg.sampling, jpeg.tables):
        c = whole[top * v : (top + rows) * v]
        down, across = c.shape[:2]
        planes.append(_samples(c.reshape(-1, 64), jpeg.quant[t]).reshape(down, across, 8, 8).swapaxes(1, 2).reshape(down * 8, across * 8))
    full = lambda p, k: p.repeat(vmax // jpeg.sampling[k][1], 0).repeat(hmax // jpeg.sampling[k][0], 1)[:height, : jpeg.width]
    if len(planes) == 1:
        return np.stack([full(planes[0], 0)] * 3, -1)
    y = (full(planes[0], 0).astype(np.int32) << 16) + (1 << 15)
    cb, cr = planes[1].astype(np.int32) - 128, planes[2].astype(np.int32) - 128
    # Factors are taken before chroma is upsampled, where both components have one size.
    if jpeg.sampling[1] != jpeg.sampling[2]:
        cb, cr = (c.repeat(vmax // jpeg.sampling[k][1], 0).repeat(hmax // jpeg.sampling[k][0], 1) for k, c in ((1, cb), (2, cr)))
        full = lambda p, k: p[:height, : jpeg.width]
    out = np.empty(y.shape + (3,), np.uint8)
    for k, more in enumerate((CHROMA[0] * cr, -CHROMA[1] * cb - CHROMA[2] * cr, CHROMA[3] * cb)):
        sums = full(more, 1) + y
        sums >>= 16
        np.clip(sums, 0, 255, out=sums)
        out[..., k] = sums
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">HH", marker, len(body) + 2) + body


def _scan_head(parts, ss, se, ah, al) -> bytes:
    return _segment(0xFFDA, bytes([len(parts)]) + b"".join(bytes([c, 0]) for c in parts) + bytes([ss, se, ah << 4 | al]))


def _scan_bytes(parts, ss, se, ah, al, bits: np.ndarray) -> bytes:
    packed = np.packbits(bits)
    packed[-1] |= (1 << -len(bits) % 8) - 1
    return _scan_head(parts, ss, se, ah, al) + packed.tobytes().replace(b"\xff", b"\xff\x00")


@lru_cache(8)
def _table(kind: int, length: int, symbols: tuple[int, ...]) -> bytes:
    """A Huffman table that gives all symbols codes of one length."""
    counts = bytearray(16)
    counts[length - 1] = len(symbols)
    return _segment(0xFFC4, bytes([kind << 4]) + bytes(counts) + bytes(symbols))


def _variable(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bits of values, each with its own length below 17, one after another."""
    bits = (values[:, None] & _ONES) != 0
    return bits[np.arange(16) >= 16 - lengths[:, None]].astype(np.uint8)


def grid(n_blocks: int) -> tuple[int, int]:
    """MCUs across and down for so many blocks, six in each MCU."""
    mcus = -(-n_blocks // 6)
    across = min(4095, math.isqrt(mcus - 1) + 1)
    return across, -(-mcus // across)


def encode(payload: bytes) -> bytes:
    """Hold a payload, a positive multiple of 64 bytes, as the coefficients of a progressive file."""
    blocks = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    across, down = grid(len(blocks))
    if down > 4095:
        raise ValueError("a JPEG file holds no more than 4095 x 4095 MCUs")
    mcus = across * down
    whole = np.zeros((6 * mcus, 64), np.uint8)
    whole[: len(blocks)] = blocks
    planes = (whole[: 4 * mcus], whole[4 * mcus : 5 * mcus], whole[5 * mcus :])
    jpeg = Jpeg()
    jpeg.width, jpeg.height, jpeg.sampling = across * 16, down * 16, [(2, 2), (1, 1), (1, 1)]
    out = [b"\xff\xd8", _segment(0xFFDB, b"\0" + b"\1" * 64)]
    frame = struct.pack(">BHHB", 8, jpeg.height, jpeg.width, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    out.append(_segment(0xFFC2, frame))

    order, which = _interleaved(jpeg, [0, 1, 2])
    dc = np.zeros(len(order), np.int64)
    for c, p in enumerate(planes):
        dc[which == c] = p[order[which == c], 0]
    diff = np.zeros(len(dc), np.int64)
    for c in range(3):
        own = which == c
        diff[own] = np.diff(dc[own] >> 1, prepend=0)
    size = np.frexp(np.abs(diff).astype(np.float64))[1].astype(np.int64)
    extra = np.where(diff < 0, diff + (1 << size) - 1, diff)
    out.append(_table(0, 4, tuple(range(9))))
    out.append(_scan_bytes([1, 2, 3], 0, 0, 0, 1, _variable(size << size | extra, 4 + size)))
    out.append(_table(1, 1, (7,)))
    for c, p in enumerate(planes, 1):
        for ss, se in BANDS[c - 1]:
            part = p[:, ss : se + 1].reshape(-1)
            # A zero for the code and the seven high bits, which are those of half the coefficient.
            out.append(_scan_head([c], ss, se, 0, 1) + (part >> 1).tobytes())
    out.append(_scan_bytes([1, 2, 3], 0, 0, 1, 0, (dc & 1).astype(np.uint8)))
    out.append(_table(1, 4, tuple(r << 4 for r in range(15))))
    for c, p in enumerate(planes, 1):
        for ss, se in BANDS[c - 1]:
            bits = []
            for lo in range(0, len(p), 32767):
                part = p[lo : lo + 32767, ss : se + 1]
                r = len(part).bit_length() - 1
                bits.append(_variable(np.array([r, len(part) - (1 << r)]), np.array([4, r])))
                # The low bit of the magnitude: negative ones count down to the byte.
                bits.append(((part & 1) ^ (part < 128)).reshape(-1))
            out.append(_scan_bytes([c], ss, se, 1, 0, np.concatenate(bits)))
    out.append(b"\xff\xd9")
    return b"".join(out)


def payload_of(jpeg: Jpeg, n_bytes: int) -> bytes:
    """The payload, padding included, of a file that encode() made for a text of n_bytes."""
    blocks = max(1, -(-n_bytes // 64))
    flat = np.concatenate([c.reshape(-1, 64) for c in jpeg.coefficients])[:blocks]
    return (flat + np.where(flat < 0, 255, 0).astype(np.int16)).astype(np.uint8).tobytes()
