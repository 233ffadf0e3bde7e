"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by sign flips and Hadamard transforms, three times over; its hash is the axis it is nearest to. Some hashes
together name a bucket of a table. A vector also enters the buckets that it just missed (one hash replaced by the
second nearest axis). Vectors that share a bucket are compared in double precision. A bucket is dealt into blocks, and a task compares
two blocks at a time: it gives back counts and one root per vector, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import components, ship_package
from leadloom.llm.shingles import mix
from leadloom.session import cut_lineage

#: Vectors of a block; pairs at the threshold that may be missed by all tables, as estimated when the tables are laid out.
BLOCK, MISSED = 1024, 1e-5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / math.sqrt(width)


class Tables:
    """Rotations for vectors of one width, ``depth`` hashes a table; the number of tables follows from ``MISSED``."""

    def __init__(self, width: int, depth: int, cosine: float):
        self.width, self.depth = width, depth
        self.padded = max(2, 1 << (width - 1).bit_length())
        self.tables = 64
        draw = np.random.default_rng(11)
        self.signs = draw.choice([-1.0, 1.0], (self.tables * depth, 3, self.padded))
        x = draw.standard_normal((2000, width))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y = draw.standard_normal((2000, width))
        y -= (x * y).sum(axis=1, keepdims=True) * x
        y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
        y = cosine * x + math.sqrt(1 - cosine * cosine) * y
        a, b = (self.buckets(v, 8).reshape(len(v), 8, -1) for v in (x, y))
        met = (a[:, :, :, None] == b[:, :, None, :]).any(axis=(2, 3)).mean()
        self.tables = min(64, max(2, math.ceil(math.log(MISSED) / math.log(1 - min(max(met, 0.05), 1 - 1e-9)))))

    def buckets(self, x: np.ndarray, tables: int | None = None) -> np.ndarray:
        """Bucket numbers of every row: for each table its own and the near misses."""
        tables = tables or self.tables
        x = np.pad(x, ((0, 0), (0, self.padded - x.shape[1])))
        first, second = [], []
        for h in range(tables * self.depth):
            z = x
            for signs in self.signs[h]:
                z = hadamard(z * signs)
            size = np.abs(z)
            top = size.argmax(axis=1)
            rows = np.arange(len(z))
            one = 2 * top + (z[rows, top] < 0)
            size[rows, top] = -1
            top = size.argmax(axis=1)
            first.append(one.astype(np.uint64))
            second.append((2 * top + (z[rows, top] < 0)).astype(np.uint64))
        out = []
        for t in range(tables):
            own = list(range(t * self.depth, (t + 1) * self.depth))
            for swap in [None, *own]:
                key = np.full(len(x), t * 1_000_003 + self.width, dtype=np.uint64)
                for h in own:
                    key = mix(key * np.uint64(3) + (second[h] if h == swap else first[h]))
                out.append(key)
        return np.stack(out, axis=1).view(np.int64)


def _compare(cid, mult, unit, buckets, bucket, side, cosine):
    """Links counted in this group, and a root in it, for every member; ``side`` None: all pairs, else only across."""
    like = unit @ unit.T >= cosine
    np.fill_diagonal(like, False)
    if side is not None:
        like &= side[:, None] != side[None, :]
    a, b = np.nonzero(np.triu(like))
    links = np.zeros(len(cid), dtype=np.int64)
    for at in range(0, len(a), 20_000):
        i, j = a[at:at + 20_000], b[at:at + 20_000]
        # A pair that shares several buckets is counted in the one with the least number.
        same = (buckets[i][:, :, None] == buckets[j][:, None, :]).any(axis=2)
        low = np.where(same, buckets[i], np.iinfo(np.int64).max).min(axis=1)
        here = low == bucket
        np.add.at(links, i[here], mult[j[here]])
        np.add.at(links, j[here], mult[i[here]])
    root = cid.copy()
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == root).all():
            break
        root = new
    return links, root


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", group: str = "label", cosine: float = 0.98,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` and ``kept``.

    Vectors of the same ``group`` and width whose cosine is at least ``cosine`` are linked. Null, empty and zero vectors, those with a
    null or non-finite component and those without a group have no links. Equal vectors are one class and are counted, not
    compared. Rows that share an id are one vector for the components; a row without an id takes part, and its component is null only
    if no linked vector has an id. Other columns are not read. An empty table gives no rows.
    """
    ship_package(vectors.sparkSession)
    v = F.col(vector).cast("array<double>")
    sound = F.col(group).isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    mark = [F.xxhash64(F.lit(i), F.col(group).cast("string"), v).alias(f"m{i}") for i in range(2)]
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.coalesce(sound, F.lit(False)).alias("sound"),
                          F.col(group).cast("string").alias("group"), v.alias("v"), *mark)
    rows = cut_lineage(base.withColumn("rid", F.coalesce("id", F.xxhash64("m0", "m1"))).select(
        "id", "rid", "sound", "group", "m0", "m1", F.size("v").alias("width")))
    sizes = rows.filter("sound").groupBy("width").agg(F.count("*").alias("n"))
    # One row per width of vectors; tables are laid out for each.
    plans = {}
    for width, n in sizes.collect():
        padded = max(2, 1 << (width - 1).bit_length())
        plans[width] = Tables(width, max(1, round(math.log(max(n, 2)) / math.log(2 * padded))), cosine)
    classes = cut_lineage(rows.filter("sound").groupBy("m0", "m1").agg(
        F.min("id").alias("least"), F.count("*").alias("mult"), F.coalesce(F.min("id"), F.min("rid")).alias("cid")))
    heads = (base.filter("sound").withColumn("rid", F.coalesce("id", F.xxhash64("m0", "m1"))).select("m0", "m1", "rid", "group", "v")
             .join(classes.withColumnRenamed("cid", "rid"), ["m0", "m1", "rid"]).dropDuplicates(["m0", "m1", "rid"]))

    def hashed(batches):
        for batch in batches:
            table = batch.to_pydict()
            by_width: dict[int, list[int]] = {}
            for i, x in enumerate(table["v"]):
                by_width.setdefault(len(x), []).append(i)
            for width, own in by_width.items():
                x = np.array([table["v"][i] for i in own], dtype=np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                keys = plans[width].buckets(x)
                groups = np.array([hash_text(table["group"][i]) for i in own], dtype=np.uint64)
                keys = mix(keys.view(np.uint64) + groups[:, None]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([table["rid"][i] for i in own], type=pa.int64()),
                     pa.array([table["mult"][i] for i in own], type=pa.int64()), pa.array(x.tolist()), pa.array(keys.tolist())],
                    names=["cid", "mult", "unit", "buckets"])

    placed = cut_lineage(heads.select("rid", "mult", "group", "v").mapInArrow(
        hashed, "cid long, mult long, unit array<double>, buckets array<long>"))
    entries = placed.select("cid", F.explode(F.array_distinct("buckets")).alias("bucket"))
    shared = cut_lineage(entries.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"))
    members = entries.join(shared, "bucket").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    members = members.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    members = members.select("cid", "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    members = members.select("cid", "bucket", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    dealt = members.join(placed, "cid").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def compared(batches):
        def close(parts):
            cid, mult, own = (np.concatenate([p[k] for p in parts]) for k in ("cid", "mult", "own"))
            unit, buckets = (np.concatenate([p[k] for p in parts]) for k in ("unit", "buckets"))
            bucket, i, j = parts[0]["key"]
            found = []
            width = np.array([len(u) for u in unit])
            for w in set(width):
                pick = np.flatnonzero(width == w)
                if len(pick) > 1:
                    links, root = _compare(cid[pick], mult[pick], np.stack(list(unit[pick])), np.stack(list(buckets[pick])), bucket,
                                           None if i == j else own[pick], cosine)
                    hit = root != cid[pick]
                    hit |= links > 0
                    found.append((cid[pick][hit], links[hit], root[hit]))
            return found

        def objects(column):
            flat, at = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            out = np.empty(len(column), dtype=object)
            for n in range(len(column)):
                out[n] = flat[at[n]:at[n + 1]]
            return out

        open_parts, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "i", "j")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            columns = {c: batch.column(c).to_numpy() for c in ("cid", "mult", "own")}
            columns |= {c: objects(batch.column(c)) for c in ("unit", "buckets")}
            found = []
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)]):
                now = tuple(keys[lo])
                if key is not None and now != key:
                    found += close(open_parts)
                    open_parts = []
                key = now
                open_parts.append({c: x[lo:hi] for c, x in columns.items()} | {"key": now})
            yield from _links(found)
        if open_parts:
            yield from _links(close(open_parts))

    found = cut_lineage(dealt.mapInArrow(compared, "cid long, links long, root long"))
    roots = components(found.filter("cid <> root"), "cid", "root").toDF("cid", "root")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = classes.join(links, "cid", "left").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = cut_lineage(joined.join(named, "root").select(
        "m0", "m1", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component_id"))
    whole = rows.filter("sound").join(labels, ["m0", "m1"]).select("id", "n_links", "component_id")
    alone = rows.filter("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return whole.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _links(found):
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in range(3)],
                                         names=["cid", "links", "root"])


def hash_text(text: str) -> int:
    """A 64-bit number for a group's name, the same in every process."""
    value = np.uint64(1469598103934665603)
    with np.errstate(over="ignore"):
        for byte in text.encode("utf-8", "surrogatepass"):
            value = (value ^ np.uint64(byte)) * np.uint64(1099511628211)
    return int(value)
