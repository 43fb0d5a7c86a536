import hashlib
import zlib

import numpy as np
import pytest
from colloquy.llm import jpeg, media
from hypothesis import given, settings
from hypothesis import strategies as st

SCHEMA = "doc_id long, text string, media string, n_bytes string"


@given(st.text(max_size=900))
@settings(max_examples=40, deadline=None)
def test_round_trip(text):
    data, n = media.payload(text)
    assert len(data) % 64 == 0 and len(data) >= 64 and not any(data[n:]) and len(data) - n < 64 + (n == 0)
    assert jpeg.payload_of(jpeg.decode(jpeg.encode(data)), n) == data


def test_long_text():
    data, n = media.payload("ü" * 70_001 + "\xff\0")
    assert jpeg.payload_of(jpeg.decode(jpeg.encode(data)), n) == data


def test_strips_give_the_whole(monkeypatch):
    rng = np.random.default_rng(2)
    file = jpeg.decode(jpeg.encode(rng.integers(0, 256, 64 * 3000, np.uint8).tobytes()))
    whole, said = jpeg.rgb(file), media.features(file)
    monkeypatch.setattr(jpeg, "STRIP", 3 * 16 * file.width)
    assert len(list(jpeg.strips(file))) > 3 and np.array_equal(jpeg.rgb(file), whole) and media.features(file) == said
    flat = whole.reshape(-1, 3).astype(float)
    assert said.split(" mean ")[1] == " ".join(f"{x:.2f}" for x in flat.mean(0)) + " std " + " ".join(f"{x:.2f}" for x in flat.std(0))


def bits_of(value, n):
    return [value >> i & 1 for i in reversed(range(n))]


def scan(parts, ss, se, ah, al, bits):
    return jpeg._scan_bytes(parts, ss, se, ah, al, np.array(bits, np.uint8))


def plain_encode(coefficients, bands):
    """A gray progressive file of any coefficients, in the plain way of the format: runs, end-of-block runs and late bits."""
    n = len(coefficients)
    symbols = tuple(r << 4 | s for r in range(16) for s in range(11))
    table = lambda kind, some: jpeg._table(kind, 8, some)
    code = {s: i for i, s in enumerate(symbols)}
    frame = jpeg.struct.pack(">BHHB", 8, 8, 8 * n, 1) + bytes([1, 0x11, 0])
    out = [b"\xff\xd8", jpeg._segment(0xFFDB, b"\0" + b"\1" * 64), jpeg._segment(0xFFC2, frame), table(0, tuple(range(12))), table(1, symbols)]

    def signed(v):
        size = abs(v).bit_length()
        return size, bits_of(v if v > 0 else v + (1 << size) - 1, size)

    bits, last = [], 0
    for c in coefficients:
        size, extra = signed((int(c[0]) >> 1) - last)
        last = int(c[0]) >> 1
        bits += bits_of(size, 8) + extra
    out.append(scan([1], 0, 0, 0, 1, bits))
    out.append(scan([1], 0, 0, 1, 0, [int(c[0]) & 1 for c in coefficients]))
    half = lambda v: int(v) >> 1 if v >= 0 else -(int(-v) >> 1)
    for ss, se in bands:
        bits, ended = [], 0

        def flush(ended):
            if not ended:
                return []
            r = ended.bit_length() - 1
            return bits_of(code[r << 4], 8) + bits_of(ended - (1 << r), r)

        for c in coefficients:
            v = [half(x) for x in c[ss : se + 1]]
            if not any(v):
                ended += 1
                continue
            bits += flush(ended)
            ended, run = 0, 0
            end = max(i for i, x in enumerate(v) if x)
            for x in v[: end + 1]:
                if not x:
                    run += 1
                    continue
                while run > 15:
                    bits += bits_of(code[0xF0], 8)
                    run -= 16
                size, extra = signed(x)
                bits += bits_of(code[run << 4 | size], 8) + extra
                run = 0
            if end < se - ss:
                ended = 1
        out.append(scan([1], ss, se, 0, 1, bits + flush(ended)))
        bits = []
        for c in coefficients:
            v = [int(x) for x in c[ss : se + 1]]
            new = [i for i, x in enumerate(v) if abs(x) == 1]
            at = 0
            for i in new:
                late, run = [], 0
                for x in v[at:i]:
                    if abs(x) > 1:
                        late.append(abs(x) & 1)
                    else:
                        run += 1
                        if run == 16:
                            bits += bits_of(code[0xF0], 8) + late
                            late, run = [], 0
                bits += bits_of(code[run << 4 | 1], 8) + [int(v[i] > 0)] + late
                at = i + 1
            if at < len(v):
                bits += bits_of(code[0], 8) + [abs(x) & 1 for x in v[at:] if abs(x) > 1]
        out.append(scan([1], ss, se, 1, 0, bits))
    return b"".join(out) + b"\xff\xd9"


@pytest.mark.parametrize("density", [0.02, 0.3, 0.9])
def test_decoder_on_general_scans(density):
    rng = np.random.default_rng(3)
    c = rng.integers(-90, 90, (23, 64)) * (rng.random((23, 64)) < density)
    c[::5, 1:] = 0
    c[1, 1:] = np.where(rng.random(63) < 0.5, rng.integers(-1, 2, 63), 0)
    got = jpeg.decode(plain_encode(c, ((1, 5), (6, 63))))
    assert np.array_equal(got.coefficients[0].reshape(-1, 64), c)


def test_inverse_and_chroma():
    rng = np.random.default_rng(1)
    f = jpeg.Jpeg()
    f.width, f.height, f.sampling, f.tables, f.quant = 20, 10, [(2, 2), (1, 1), (1, 1)], [0, 0, 0], {0: np.full(64, 2)}
    f.coefficients = [rng.integers(-40, 40, shape + (64,)) for shape in ((2, 4), (1, 2), (1, 2))]

    def plane(c):
        out = np.zeros((c.shape[0] * 8, c.shape[1] * 8))
        scale = lambda k: np.sqrt(0.5) if k == 0 else 1
        for by in range(c.shape[0]):
            for bx in range(c.shape[1]):
                for y in range(8):
                    for x in range(8):
                        s = 0.0
                        for k in range(64):
                            v, u = divmod(int(jpeg.ZIGZAG[k]), 8)
                            s += c[by, bx, k] * 2 * scale(u) * scale(v) * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16) / 4
                        out[by * 8 + y, bx * 8 + x] = s
        return np.clip(np.rint(out) + 128, 0, 255)

    y, cb, cr = (plane(c) for c in f.coefficients)
    cb, cr = (np.kron(p, np.ones((2, 2)))[:10, :20] - 128 for p in (cb, cr))
    want = np.stack([y[:10, :20] + 1.402 * cr, y[:10, :20] - 0.344136 * cb - 0.714136 * cr, y[:10, :20] + 1.772 * cb], -1)
    assert np.abs(jpeg.rgb(f).astype(int) - np.clip(np.rint(want), 0, 255)).max() <= 1


def plain_feature(data):
    """Size, means and deviations of the image that holds a payload, block by block in whole numbers."""
    blocks = np.frombuffer(data, np.uint8).reshape(-1, 64).astype(np.int64)
    across, down = jpeg.grid(len(blocks))
    mcus = across * down
    held = np.zeros((6 * mcus, 64), np.int64)
    held[: len(blocks)] = blocks
    held[:, 1:] -= np.where(held[:, 1:] < 128, 255, 0)
    at = np.arange(8)
    wave = np.cos((2 * at[None, :] + 1) * at[:, None] * np.pi / 16) * np.where(at == 0, np.sqrt(1 / 8), 0.5)[:, None]
    basis = np.rint(np.einsum("vy,ux->vuyx", wave, wave) * 2**22).astype(np.int64)
    natural = np.zeros((6 * mcus, 8, 8), np.int64)
    for k in range(64):
        natural[:, jpeg.ZIGZAG[k] // 8, jpeg.ZIGZAG[k] % 8] = held[:, k]
    samples = np.zeros((6 * mcus, 8, 8), np.int64)
    for v in range(8):
        for u in range(8):
            samples += natural[:, v, u, None, None] * basis[v, u]
    samples = np.clip((samples + 2**21 >> 22) + 128, 0, 255)
    lay = lambda p, h, w: p.reshape(h, w, 8, 8).transpose(0, 2, 1, 3).reshape(8 * h, 8 * w)
    y = lay(samples[: 4 * mcus], 2 * down, 2 * across)
    cb, cr = (np.kron(lay(p, down, across), np.ones((2, 2), np.int64)) - 128 for p in (samples[4 * mcus : 5 * mcus], samples[5 * mcus :]))
    red, green, blue = (np.clip((y * 65536 + 32768 + more) // 65536, 0, 255) for more in (91881 * cr, -22553 * cb - 46802 * cr, 116130 * cb))
    flat = np.stack([red, green, blue], -1).reshape(-1, 3).astype(float)
    mean, mean_of_squares = flat.sum(0) / len(flat), (flat * flat).sum(0) / len(flat)
    std = np.sqrt(np.maximum(mean_of_squares - mean * mean, 0))
    return f"{16 * down}x{16 * across} mean " + " ".join(f"{x:.2f}" for x in mean) + " std " + " ".join(f"{x:.2f}" for x in std)


def test_whole_table(spark, sf):
    """All columns of the query, files and features, against texts and a decoder that adds whole numbers."""
    from colloquy.llm import queries

    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = sorted(queries.op4_media(spark, sf).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [i for i, _ in texts]
    for r, (_, text) in zip(got, texts):
        data, n = media.payload(text)
        held = jpeg.encode(data)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(held), hashlib.sha256(held).hexdigest())
        assert r.feature == plain_feature(data)


def test_sums_do_not_depend_on_their_order():
    rng = np.random.default_rng(7)
    c = rng.integers(-jpeg.LARGEST, jpeg.LARGEST, (50, 64)).astype(np.float64)
    whole = c @ jpeg.INVERSE
    by = rng.permutation(64)
    assert np.array_equal(c[:, by] @ jpeg.INVERSE[by], whole) and np.array_equal(whole, (c.astype(np.int64) @ jpeg.INVERSE.astype(np.int64)).astype(float))


def test_query_and_edges(spark):
    rows = [(1, None, "x", "y"), (2, "", "x", "y"), (3, "a" * 64, "x", "y"), (3, "a" * 64, "x", "y"), (None, "é" * 4000, None, "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = media.digests(media.store_media(df)).collect()
    by = {}
    for (i, t, _, _), r in zip(rows, got):
        data, n = media.payload(t)
        assert (r.doc_id, r.n_bytes, r.payload_bytes) == (i, n, len(data))
        assert r.payload_sha256 == hashlib.sha256(data).hexdigest() and r.tail_crc32 == zlib.crc32(data[-64:])
        held = jpeg.encode(data)
        assert (r.media_bytes, r.media_sha256) == (len(held), hashlib.sha256(held).hexdigest())
        assert by.setdefault(data, r.feature) == r.feature
    tensors = media.read_media(media.store_media(df)).collect()
    assert [len(t.rgb) for t in tensors] == [3 * t.height * t.width for t in tensors]
    assert bytes(tensors[4].payload) == media.payload("é" * 4000)[0]
    assert media.digests(media.store_media(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_reads_the_files_back_from_a_table(spark, sf):
    from colloquy.llm import queries

    files = queries.op4_media(spark, sf).inputFiles()
    assert files and all("/media-" in f for f in files)
