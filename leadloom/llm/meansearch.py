"""Centroid clustering with exact nearest centroids found by component mean and deviation.

Vectors are whole numbers. Centroids are sorted by the sum of their components; a vector starts where its own sum
would stand and looks outward, always at the side whose mean is nearer. With S the sum of the w components and R the
length of what is left after the mean is taken off, the squared distance of x and c is at least
(S_x - S_c)^2 / w + (R_x - R_c)^2. The first part grows outward, so a vector is done once it passes the best distance
found; the whole sum rejects single centroids. What is left is compared exactly in whole numbers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import ship_package
from leadloom.session import cut_lineage

#: Components beyond this (in size) would let a squared distance of 64 of them pass a long.
LARGEST = 1 << 27
#: Bounds are doubles; they reject only beyond this relative slack, so rounding never rejects a nearest centroid.
SLACK = 1e-9


class MeanSearch:
    """Nearest of a few centroids (rows of whole numbers), the smaller number among equals."""

    def __init__(self, centroids: np.ndarray):
        self.number = np.lexsort((np.arange(len(centroids)), centroids.sum(axis=1)))
        self.rows = centroids[self.number]
        self.sums, self.rest = self._shape(self.rows)
        #: Exact distances taken so far.
        self.compared = 0

    @staticmethod
    def _shape(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = x.sum(axis=1).astype(np.float64)
        centred = x - (sums / x.shape[1])[:, None]
        return sums, np.sqrt((centred * centred).sum(axis=1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and its squared distance, for each row of ``x``."""
        sums, rest = self._shape(x)
        up = np.searchsorted(self.sums, sums)
        down = up - 1
        best = np.full(len(x), np.iinfo(np.int64).max)
        number = np.full(len(x), len(self.rows))
        open_rows = np.arange(len(x))
        last = len(self.rows) - 1
        while len(open_rows):
            u, d, s = up[open_rows], down[open_rows], sums[open_rows]
            gap_up = np.where(u <= last, np.abs(s - self.sums[np.minimum(u, last)]), np.inf)
            gap_down = np.where(d >= 0, np.abs(s - self.sums[np.maximum(d, 0)]), np.inf)
            rising = gap_up <= gap_down
            gap = np.where(rising, gap_up, gap_down)
            by_mean = gap * gap / x.shape[1] * (1 - SLACK)
            going = by_mean <= best[open_rows]
            going &= np.isfinite(gap)
            open_rows, rising, by_mean = open_rows[going], rising[going], by_mean[going]
            at = np.where(rising, up[open_rows], down[open_rows])
            up[open_rows] += rising
            down[open_rows] -= ~rising
            apart = np.abs(rest[open_rows] - self.rest[at]) - SLACK * (rest[open_rows] + self.rest[at])
            maybe = by_mean + np.square(np.maximum(apart, 0)) * (1 - SLACK) <= best[open_rows]
            rows, at = open_rows[maybe], at[maybe]
            self.compared += len(rows)
            apart = x[rows] - self.rows[at]
            distance = (apart * apart).sum(axis=1)
            found = self.number[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (found < number[rows]))
            best[rows[better]], number[rows[better]] = distance[better], found[better]
        return number, best


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"a scaled component is beyond {LARGEST}: squared distances would not fit a long")
    return x


def start(kept: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors (or all) with the smallest SHA-256 of ``salt``, a colon and the id, in that order."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = kept.select(F.sha2(name.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in first], dtype=np.int64)


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor of the exact mean of their vectors; those without vectors stay."""
    width = centroids.shape[1]

    def sums(batches):
        search = MeanSearch(centroids)
        count, total = np.zeros(len(centroids), dtype=np.int64), np.zeros(centroids.shape, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            own, _ = search.nearest(x)
            count += np.bincount(own, minlength=len(centroids))
            np.add.at(total, own, x)
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, type=pa.int32()), pa.array(count[used]), pa.array(total[used].tolist(), type=pa.list_(pa.int64()))],
                names=["cluster", "n", "total"])

    parts = kept.select("v").mapInArrow(sums, "cluster int, n long, total array<long>")
    exact = [F.sum(F.col("total")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
    after = centroids.copy()
    # As many rows as centroids reach the driver.
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect():
        after[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return after


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, width: int = 64, scale: float = 64.0, salt: str = "1",
    id_col: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """One row per kept vector: id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Kept are vectors of exactly ``width`` components, none null or not finite; a component x becomes floor(scale * x). Null
    vectors and those of other widths have no row. Repeated rows and ids each have their own row and vote; a row without an
    id counts as the empty id where starts are drawn, starts with equal ids come in the order of their components. With
    fewer than ``k`` kept vectors all of them are centroids; an empty table gives no rows. Other columns are not read.
    Scaled components beyond 2^27 raise an error, because distances could not be told exactly in a long.

    The vectors are scaled and written once. Each round sends one row of sums per task and centroid; the centroids
    (k x width numbers) are all that reaches the driver or is sent to tasks.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.col(f"`{vector}`").cast("array<double>")
    sound = (F.size(v) == width) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = cut_lineage(vectors.filter(F.coalesce(sound, F.lit(False))).select(
        F.col(f"`{id_col}`").alias("id"), F.transform(v, lambda x: F.floor(x * scale)).alias("v")))
    kind = kept.schema["id"].dataType.simpleString()
    centroids = start(kept, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(kept, centroids)

    def assign(batches):
        search = MeanSearch(centroids)
        for batch in batches:
            own, distance = search.nearest(_matrix(batch.column("v"), width))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(own, type=pa.int32()), pa.array(distance)],
                                             names=["id", "cluster", "distance"])

    rows = cut_lineage(kept.mapInArrow(assign, f"id {kind}, cluster int, distance long"))
    # One row per centroid.
    found = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in found}
    names = [(c, s, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, s in inertia.items()]
    table = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
