"""An inverted file of vectors: rows by the nearest of some coarse centroids, so that a query reads a few cells.

Centroids are trained by k-means in DataFrame jobs on a bounded sample; every
row is then dealt to its nearest one and stored by it. The manifest keeps, for
each cell, its size and the cosine of its member that is farthest from the
centroid. With the angle between query and centroid that bounds the best cosine
a cell can hold, so a search can also go on until its results are exact, and
still skip the cells that can't matter.

Centroids lie on the driver and in task closures: cells * dimensions doubles,
at most MOST_BYTES, else an error.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import scratch
from ..sources.versions import Manifest, VersionedTable
from .search import retrieve

MOST_BYTES = 64 << 20
#: Rows of a sample for each cell, rounds of k-means, and rows of a cell that one task compares with queries.
SAMPLE, ROUNDS, PART = 256, 5, 4096
#: Cells that hold vectors without a direction.
NOWHERE = -1


def _matrix(vectors, width: int | None = None) -> np.ndarray:
    """Rows of length one; null, empty and zero vectors, and those with odd components, are zero rows."""
    rows = [np.asarray(v, np.float64) if v is not None else np.zeros(0) for v in vectors]
    width = max((len(r) for r in rows), default=0) if width is None else width
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : min(width, len(r))] = r[:width]
    out[~np.isfinite(out).all(axis=1)] = 0
    norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)


def _nearest(m: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, cosine to its centroid) of rows; zero rows have none."""
    cell, close = np.zeros(len(m), np.int64), np.zeros(len(m))
    for lo in range(0, len(m), 8192):
        sims = m[lo : lo + 8192] @ centroids.T
        cell[lo : lo + 8192] = sims.argmax(axis=1)
        close[lo : lo + 8192] = sims.max(axis=1)
    none = ~m.any(axis=1)
    cell[none], close[none] = NOWHERE, 1.0
    return cell, np.clip(close, -1, 1)


def train(rows: DataFrame, cells: int, sample: int = SAMPLE, rounds: int = ROUNDS, key: str = "id", vector: str = "embedding") -> np.ndarray:
    """Centroids of length one, by k-means with cosines on at most sample * cells rows, chosen by the hash of their key."""
    spark = rows.sparkSession
    at = scratch.folder(spark, "centroids")
    some = rows.select(F.xxhash64(key).alias("h"), F.col(vector).cast("array<double>").alias("v")).filter("size(v) > 0")
    some.orderBy("h", F.xxhash64("v")).limit(sample * cells).write.parquet(at)
    some = spark.read.parquet(at)
    start = some.orderBy("h", F.xxhash64("v")).limit(cells).collect()
    if not start:
        return np.zeros((0, 0))
    width = max(len(r.v) for r in start)
    if cells * width * 8 > MOST_BYTES:
        raise ValueError(f"{cells} centroids of {width} dimensions take more than {MOST_BYTES} bytes")
    centroids = np.unique(_matrix([r.v for r in start], width), axis=0)
    centroids = centroids[centroids.any(axis=1)]
    for _ in range(rounds if len(centroids) else 0):
        centre = spark.sparkContext.broadcast(centroids)

        def add(batches):
            sums, sizes = np.zeros_like(centre.value), np.zeros(len(centre.value), np.int64)
            for batch in batches:
                m = _matrix(batch["v"], centre.value.shape[1])
                cell, _ = _nearest(m, centre.value)
                m, cell = m[cell >= 0], cell[cell >= 0]
                np.add.at(sums, cell, m)
                sizes += np.bincount(cell, minlength=len(sizes))
            held = np.flatnonzero(sizes)
            # A task without rows gives none: a column of no arrays would have a type of its own.
            if len(held):
                yield pd.DataFrame({"cell": held, "sums": list(sums[held])})

        # One row for each cell and task.
        parts = some.mapInPandas(add, "cell long, sums array<double>")

        def whole(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            # In one order, so that sums don't depend on which task was first.
            return pd.DataFrame({"cell": [key[0]], "sums": [np.sum(sorted(p.tolist() for p in parts["sums"]), axis=0)]})

        moved = centroids.copy()
        for r in parts.groupBy("cell").applyInPandas(whole, "cell long, sums array<double>").collect():
            moved[r.cell] = r.sums
        moved = _matrix(moved, width)
        centre.destroy()
        if np.allclose(moved, centroids, atol=1e-9):
            break
        centroids = moved
    return centroids


def assign(rows: DataFrame, centroids: np.ndarray, vector: str = "embedding") -> DataFrame:
    """rows with cell and closeness, the cosine to the cell's centroid."""
    centre = rows.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        for batch in batches:
            cell, close = _nearest(_matrix(batch["_v"], centre.value.shape[1] if len(centre.value) else 0), centre.value) if len(centre.value) else (np.full(len(batch), NOWHERE), np.ones(len(batch)))
            yield pd.DataFrame({"_row": batch["_row"], "cell": cell, "closeness": close})

    # Only the vector is read in Python; rows travel as they are.
    names = [F.col(f"`{c}`") for c in rows.columns]
    schema = rows.select(F.struct(*names).alias("_row")).schema.add("cell", "long").add("closeness", "double")
    return rows.select(F.struct(*names).alias("_row"), F.col(vector).cast("array<double>").alias("_v")).mapInPandas(run, schema).select("_row.*", "cell", "closeness")


class InvertedFile:
    """Rows (id, embedding, ...) stored by cell under a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = VersionedTable(spark, path, "cell", {"least": F.min("closeness")})

    def build(self, rows: DataFrame, cells: int | None = None, **training) -> Manifest:
        """Train on rows and store them in place of what is there; by default the square root of their number of cells."""
        if cells is None:
            cells = max(1, min(65_536, math.isqrt(rows.count())))
        centroids = train(rows, cells, **training)
        base = self.table.manifest()
        dealt = assign(rows, centroids)
        held = f"centroids/{uuid.uuid4().hex}"
        self.spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "cell long, vector array<double>").write.parquet(f"{self.table.path}/{held}")
        return self.table.replace(dealt, list(base.buckets), base, notes={"centroids": held})

    def centroids(self, now: Manifest) -> np.ndarray:
        held = self.spark.read.schema("cell long, vector array<double>").parquet(f"{self.table.path}/{now.notes['centroids']}")
        rows = sorted(held.collect())
        return np.array([r.vector for r in rows], np.float64) if rows else np.zeros((0, 0))

    def add(self, rows: DataFrame, gone: DataFrame | None = None, key: str = "id") -> Manifest:
        """Put rows in by key under the centroids that are there; rows of their keys in other cells go, and those listed in gone (key)."""
        now = self.table.manifest()
        at = scratch.folder(self.spark, "added")
        assign(rows, self.centroids(now)).write.parquet(at)
        fresh = self.spark.read.parquet(at)
        leaving = fresh.select(key)
        if gone is not None:
            leaving = leaving.unionByName(gone.select(F.col("key").alias(key)))
        # Only keys and cells are read of cells that aren't touched.
        held = self.table._read(now, now.buckets).select(key, "cell").join(leaving, key, "left_semi")
        touched = {r[0] for r in held.select("cell").unionByName(fresh.select("cell")).distinct().collect()}
        kept = self.table._read(now, touched).join(leaving, key, "left_anti")
        return self.table.replace(kept.unionByName(fresh), sorted(touched), now)

    def probes(self, vector, now: Manifest) -> list[tuple[int, float, float]]:
        """(cell, cosine to its centroid, best cosine that it can hold), nearest first."""
        centroids = self.centroids(now)
        q = _matrix([vector], centroids.shape[1])[0]
        out = []
        for cell, entry in now.buckets.items():
            if cell == NOWHERE or not q.any():
                out.append((cell, 0.0, 0.0))
                continue
            near = float(np.clip(centroids[cell] @ q, -1, 1))
            apart = math.acos(near) - math.acos(max(-1.0, min(1.0, entry["least"])))
            out.append((cell, near, math.cos(max(0.0, apart))))
        return sorted(out, key=lambda p: (-p[1], p[0]))

    def search(self, vector: list[float], n: int, nprobe: int | None = 8, category: str | None = None, exact: bool = False) -> DataFrame:
        """The n rows nearest to a vector among the nprobe nearest cells (None: all), as retrieve() gives them.

        exact goes on to every further cell whose bound reaches the last
        similarity found, which takes one job before the plan is returned.
        """
        now = self.table.manifest()
        ranked = self.probes(vector, now)
        first = [c for c, _, _ in ranked[:nprobe]]
        rows = self.table._read(now, first).drop("cell", "closeness")
        found = retrieve(rows, vector, n, category)
        if not exact or len(first) == len(ranked):
            return found
        last = found.agg(F.count(F.lit(1)), F.min("similarity")).first()
        floor = last[1] - 1e-9 if last[0] == n else -2.0
        more = [c for c, _, bound in ranked[nprobe:] if bound >= floor]
        return retrieve(self.table._read(now, first + more).drop("cell", "closeness"), vector, n, category)

    def search_many(self, queries: DataFrame, n: int, nprobe: int | None = 8) -> DataFrame:
        """(query_id, id, similarity): the n nearest rows of each query (query_id, vector), from its nprobe nearest cells.

        Queries travel to the parts of their cells, PART rows or so each; a part
        returns its n best for each query, so no pair of query and row is
        shuffled but these.
        """
        now = self.table.manifest()
        centroids, known = self.centroids(now), sorted(now.buckets)
        real = np.array([c for c in known if c != NOWHERE], np.int64)
        sizes = {c: max(1, -(-now.buckets[c]["rows"] // PART)) for c in known}
        take = len(real) if nprobe is None else min(nprobe, len(real))

        def deal(batches):
            for batch in batches:
                m = _matrix(batch["vector"], centroids.shape[1])
                near = np.argsort(-(m @ centroids[real].T), axis=1, kind="stable")[:, :take]
                own, cell, part = [], [], []
                for i, cells in enumerate(real[near].tolist()):
                    for c in [*cells, *([NOWHERE] if nprobe is None and NOWHERE in sizes else [])]:
                        for p in range(sizes[c]):
                            own.append(i)
                            cell.append(c)
                            part.append(p)
                out = batch.iloc[own].reset_index(drop=True)
                out["cell"], out["part"] = cell, part
                yield out

        asked = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"))
        sent = asked.mapInPandas(deal, asked.select("*").schema.add("cell", "long").add("part", "long"))
        # One row for each cell.
        parts = self.spark.createDataFrame(sorted(sizes.items()), "cell long, parts long")
        rows = self.table._read(now, known).select("id", F.col("embedding").cast("array<double>").alias("embedding"), "cell").join(F.broadcast(parts), "cell")
        rows = rows.select("id", "embedding", "cell", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))

        def compare(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(asked) or not len(rows):
                return pd.DataFrame({"query_id": asked["query_id"].iloc[:0], "id": rows["id"].iloc[:0], "similarity": np.zeros(0)})
            q, m = _matrix(asked["vector"], centroids.shape[1]), _matrix(rows["embedding"], centroids.shape[1])
            ids = rows["id"].to_numpy()
            by = np.argsort(ids, kind="stable")
            m, ids, found = m[by], ids[by], []
            for lo in range(0, len(q), 256):
                # Beyond 12 decimals a product depends on the order of its sums.
                sims = np.round(q[lo : lo + 256] @ m.T, 12)
                best = np.argsort(-sims, axis=1, kind="stable")[:, :n]
                i = np.repeat(np.arange(len(sims)), best.shape[1])
                found.append(pd.DataFrame({"query_id": asked["query_id"].to_numpy()[lo + i], "id": ids[best.ravel()], "similarity": sims[i, best.ravel()]}))
            return pd.concat(found)

        schema = queries.select("query_id").schema.add("id", rows.schema["id"].dataType).add("similarity", "double")
        pairs = sent.groupBy("cell", "part").cogroup(rows.groupBy("cell", "part")).applyInPandas(compare, schema)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
        return pairs.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def recall(found: DataFrame, true: DataFrame) -> float:
    """Share of true (query_id, id) that found holds."""
    held = true.join(found.select("query_id", "id").distinct().withColumn("_held", F.lit(1)), ["query_id", "id"], "left")
    return held.agg(F.coalesce(F.avg(F.coalesce("_held", F.lit(0))), F.lit(1.0))).first()[0]

