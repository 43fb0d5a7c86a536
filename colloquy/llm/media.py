"""Media columns: texts held as progressive JPEG files, read back into payloads and RGB tensors.

Edge cases: a null text is empty and has a payload of 64 zero bytes; equal
texts give equal files; repeated rows stay rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from . import jpeg
from .columns import map_batches


def payload(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes of a text, with zeros up to a positive multiple of 64, and how many they were without."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + bytes(-len(data) % 64 if data else 64), len(data)


def store_media(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_bytes, media): each text as a file."""

    def run(batches):
        for batch in batches:
            rows = [payload(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": [n for _, n in rows], "media": [jpeg.encode(p) for p, _ in rows]})

    schema = docs.select("doc_id").schema.add("n_bytes", "long").add("media", "binary")
    return map_batches(docs.select("doc_id", "text"), run, schema)


def read_media(media: DataFrame) -> DataFrame:
    """Rows (doc_id, height, width, rgb, payload): tensors as row-major bytes, 3 per pixel."""

    def run(batches):
        for batch in batches:
            for doc_id, n, data in zip(batch["doc_id"], batch["n_bytes"], batch["media"]):
                file = jpeg.decode(data)
                tensor = jpeg.rgb(file)
                yield pd.DataFrame({"doc_id": pd.Series([doc_id], dtype=batch["doc_id"].dtype), "height": [tensor.shape[0]], "width": [tensor.shape[1]], "rgb": [tensor.tobytes()], "payload": [jpeg.payload_of(file, n)]})

    schema = media.select("doc_id").schema.add("height", "integer").add("width", "integer").add("rgb", "binary").add("payload", "binary")
    return map_batches(media.select("doc_id", "n_bytes", "media"), run, schema)


def features(file: jpeg.Jpeg) -> str:
    """Size, and mean and deviation of each channel, from strips of the RGB tensor; sums are of whole numbers."""
    total, squares = np.zeros(3, np.int64), np.zeros(3, np.int64)
    for strip in jpeg.strips(file):
        flat = strip.reshape(-1, 3)
        total += flat.sum(0, dtype=np.int64)
        squares += np.array([np.dot(x, x) for x in flat.T.astype(np.float64)]).astype(np.int64)
    n = file.height * file.width
    mean = total / n
    std = np.sqrt(np.maximum(squares / n - mean * mean, 0))
    return f"{file.height}x{file.width} mean " + " ".join(f"{x:.2f}" for x in mean) + " std " + " ".join(f"{x:.2f}" for x in std)


def digests(media: DataFrame) -> DataFrame:
    """What the files hold, read back, as one row of digests each; tensors don't leave the worker."""

    def run(batches):
        for batch in batches:
            rows = []
            for n, data in zip(batch["n_bytes"], batch["media"]):
                file = jpeg.decode(data)
                held = jpeg.payload_of(file, n)
                rows.append((len(held), hashlib.sha256(held).hexdigest(), zlib.crc32(held[-64:]), len(data), hashlib.sha256(data).hexdigest(), features(file)))
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "n_bytes", batch["n_bytes"].to_numpy())
            out.insert(0, "doc_id", batch["doc_id"])
            yield out

    schema = media.select("doc_id", "n_bytes").schema
    for name, kind in (("payload_bytes", "long"), ("payload_sha256", "string"), ("tail_crc32", "long"), ("media_bytes", "long"), ("media_sha256", "string"), ("feature", "string")):
        schema = schema.add(name, kind)
    return map_batches(media.select("doc_id", "n_bytes", "media"), run, schema)
