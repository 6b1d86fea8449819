"""Centroid clustering of whole-number vectors by scalar lookup tables.

Vectors become whole numbers (floor of ``scale`` times a component).  Per
round a batch of vectors finds the integer values that occur in it, tabulates
the squared difference of every (dimension, value, centroid), and gathers and
sums its distances from that table, so no distance is multiplied out.  A task
passes on one row of counts and sums for each centroid; sums and means are
exact whole numbers, so results do not depend on partitions or retries.  Only
the centroids reach the driver and go back to the tasks.

Every round scans the input again and no group of vectors is moved: give a
written table, not a costly query.

Defined cases: a vector of another length, or with a null, NaN or infinite
component, is left out; repeated rows are separate vectors; a null id is
clustered and comes last in the order of the start; fewer vectors than
centroids start fewer clusters; an empty table gives an empty result; other
columns are not read.  Values beyond 2^27 are handled with Python's whole
numbers, up to 2^62 (larger ones count as that), and a distance or sum that
does not fit a long counts as the largest long.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors handled at once; a batch's table has at most so many values a dimension.
BATCH = 4096
#: Components up to this keep 64-dimensional squared distances within a long.
SMALL, LARGEST = 1 << 27, 1 << 62
LONG = (1 << 63) - 1


def whole(column, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the vectors that count, their whole numbers) of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    right = (lengths == size) & column.is_valid().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(right)
    first = column.offsets.to_numpy()[:-1][at]
    values = column.values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    x = values[first[:, None] + np.arange(size)] if len(at) else np.zeros((0, size))
    good = np.isfinite(x).all(axis=1)
    with np.errstate(over="ignore"):
        return at[good], np.floor(np.clip(scale * x[good], -float(LARGEST), float(LARGEST)))


def integers(x: np.ndarray, *others: int) -> np.ndarray:
    """As 64-bit integers where squared distances fit, else Python's."""
    largest = max([int(abs(x).max()) if x.size else 0, *others])
    if x.shape[-1] * (largest * 2) ** 2 <= LONG:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (vectors x centroids): table gathers and sums."""
    total = np.zeros((len(x), len(centroids)), dtype=x.dtype)
    for d in range(x.shape[1]):
        values, place = np.unique(x[:, d], return_inverse=True)
        table = (values[:, None] - centroids[None, :, d]) ** 2
        total += table[place]
    return total


def nearest(column, centroids: list[list[int]], size: int, scale: int):
    """(places, whole numbers, cluster, squared distance); ties: smaller number."""
    at, x = whole(column, size, scale)
    x = integers(x, *(abs(v) for c in centroids for v in c))
    far = distances(x, np.array(centroids, dtype=x.dtype).reshape(-1, size))
    best = far.argmin(axis=1) if len(x) else np.zeros(0, np.int64)
    return at, x, best.astype(np.int64), far[np.arange(len(x)), best]


def start(vectors: DataFrame, key: str, column: str, k: int, size: int, scale: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash of ``1:<key>``."""
    chosen = vectors.select(F.col(key).alias("id"), F.col(column).cast("array<double>").alias("v"))
    fits = (F.size("v") == size) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    said = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")).cast("binary"), 256)
    first = chosen.where(fits).orderBy(said.asc_nulls_last(), "v").limit(k)  # k rows of each task at most
    rows = pa.array([r["v"] for r in first.collect()], pa.list_(pa.float64()))
    return [[int(v) for v in row] for row in whole(rows, size, scale)[1]]


def moved(vectors: DataFrame, column: str, centroids: list[list[int]], size: int, scale: int) -> list[list[int]]:
    """Each centroid's vectors' exact mean, rounded down; empty ones stay."""

    def run(batches):
        count, sums = np.zeros(len(centroids), np.int64), [[0] * size for _ in centroids]
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                _, x, own, _ = nearest(batch.column(0).slice(i, BATCH), centroids, size, scale)
                count += np.bincount(own, minlength=len(centroids))
                for c in np.unique(own).tolist():
                    sums[c] = [a + int(b) for a, b in zip(sums[c], x[own == c].sum(axis=0).tolist(), strict=True)]
        got = [c for c in range(len(centroids)) if count[c]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(got, pa.int32()), pa.array([int(count[c]) for c in got], pa.int64()), pa.array([[Decimal(v) for v in sums[c]] for c in got], pa.list_(pa.decimal128(38, 0)))],
            ["c", "n", "sums"],
        )

    parts = vectors.select(column).mapInArrow(run, "c int, n long, sums array<decimal(38,0)>")
    totals = parts.select("c", "n", F.posexplode("sums").alias("d", "s")).groupBy("c", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out = [list(c) for c in centroids]
    for r in totals.collect():  # one row for each centroid and dimension
        out[r["c"]][r["d"]] = int(r["s"]) // r["n"]
    return out


def assigned(vectors: DataFrame, key: str, column: str, centroids: list[list[int]], size: int, scale: int) -> DataFrame:
    """``key``, ``cluster`` and ``distance`` of every vector that counts."""
    chosen = vectors.select(F.col(key).alias("key"), F.col(column).alias("v"))
    schema = chosen.select("key", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).schema

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                at, _, own, far = nearest(part.column(1), centroids, size, scale)
                far = far if far.dtype == np.int64 else [min(int(v), LONG) for v in far]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), pa.array(own.astype(np.int32)), pa.array(far, pa.int64())], ["key", "cluster", "distance"])

    return chosen.mapInArrow(run, schema).withColumnRenamed("key", key)


def cluster(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64) -> tuple[DataFrame, list[list[int]]]:
    """(``key``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``) of
    every vector that counts, and the final centroids."""
    centroids = start(vectors, key, column, k, size, scale)
    for _ in range(rounds):
        centroids = moved(vectors, column, centroids, size, scale) if centroids else centroids
    found = assigned(vectors, key, column, centroids or [[0] * size], size, scale)
    exact = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    by = {r["cluster"]: int(r["s"]) for r in exact.collect()}  # one row for each centroid
    fit = lambda v: F.lit(min(v, LONG)).cast("long")
    own = F.element_at(F.array(*[fit(by.get(c, 0)) for c in range(max(1, len(centroids)))]), F.col("cluster") + 1)
    return found.withColumns({"cluster_inertia": own, "inertia": fit(sum(by.values()))}), centroids
