"""Near-duplicate documents by min-max hashing of word shingles.

Every hash function gives two values of a set, its minimum and its maximum. Both agree between two sets with the
probability of their Jaccard similarity, so half as many hash functions are evaluated for as many values. Values are
joined into bands; documents that share a band are candidates; a link counts only when the full shingle sets confirm it.

A bucket of a band is never expanded into pairs. Its members are compared with one member, the hub, which is a linear
number of pairs; then with other hubs, but only where a member is not yet in the hub's component. Pairs across components that are
left in a bucket after these rounds are all compared, so nothing is lost by it. A sketch of one bit per value
and the sizes of the sets turn away hopeless pairs before any set is read. In the last round so does a parity sketch: every
element flips one bit of a bitmap, so two bitmaps never differ in more bits than the sets in elements, and no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.bytebpe import _slices
from leadloom.llm.common import WORD, bitmap, components, has_bit, held, ship_package
from leadloom.llm.shingles import mix, shingle_sets
from leadloom.session import cut_lineage

#: 40 bands of 6 values from 120 hash functions: a pair of similarity 0.8 shares no band with probability 5e-6.
BANDS, ROWS = 40, 6
#: Bits of 240 that may differ: at similarity 0.8 the mean is 24 and the standard deviation 4.6.
MAX_BITS = 52
#: Bits of a parity sketch.
PARITY = 4096
#: Rounds with hubs before the remaining pairs of a bucket are compared.
HUB_ROUNDS = 3

_RANDOM = np.random.default_rng(7)
_MULTIPLY = _RANDOM.integers(0, 2**31, BANDS * ROWS // 2, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RANDOM.integers(0, 2**32, BANDS * ROWS // 2, dtype=np.uint32)
_BAND_SEED = _RANDOM.integers(0, 2**64, BANDS, dtype=np.uint64)


def signatures(items: np.ndarray, bounds: np.ndarray, block: int = 512) -> np.ndarray:
    """A row per set with minimum and maximum of every hash function over its items, side by side.

    ``items`` are the mixed items of all sets, none of them empty, and ``bounds`` where each begins, with the end. The
    functions work on 32 bits of the items, which only proposes a few more pairs; a block stays in the cache.
    """
    items = items.astype(np.uint32)[:, None]
    out = np.empty((len(bounds) - 1, len(_MULTIPLY), 2), dtype=np.uint64)
    room = np.empty((block, len(_MULTIPLY)), dtype=np.uint32)
    for i, (begin, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        low = high = None
        for at in range(begin, end, block):
            part = items[at:min(at + block, end)]
            values = np.multiply(part, _MULTIPLY, out=room[:len(part)])
            values += _ADD
            lo, hi = values.min(axis=0), values.max(axis=0)
            low, high = (lo, hi) if low is None else (np.minimum(low, lo), np.maximum(high, hi))
        out[i, :, 0], out[i, :, 1] = low, high
    return out.reshape(len(out), 2 * len(_MULTIPLY))


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key per band of every signature."""
    grid = values.reshape(len(values), BANDS, ROWS)
    keys = np.broadcast_to(_BAND_SEED, grid.shape[:2])
    for j in range(ROWS):
        keys = mix(keys * np.uint64(3) + grid[:, :, j])
    return keys.view(np.int64)


def sketches(values: np.ndarray) -> np.ndarray:
    """One bit of every value, packed into four numbers per signature."""
    bits = np.zeros((len(values), 256), dtype=bool)
    bits[:, :values.shape[1]] = mix(values) & np.uint64(1)
    return np.packbits(bits, axis=1).view(np.int64)


def parity(items: np.ndarray) -> np.ndarray:
    """Bitmap in which every element has flipped one bit."""
    places = (mix(items ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(PARITY)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=PARITY).astype(np.uint8) & 1).view(np.int64)


def _rows(batch: pa.RecordBatch, k: int, full: bool) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), k)
    ids = batch.column("rid")
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    items = np.concatenate(sets)
    if full:
        offsets = np.concatenate([[0], np.cumsum(sizes * 8)]).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(sets), [None, pa.py_buffer(offsets), pa.py_buffer(items)])
        return pa.RecordBatch.from_arrays([ids, packed], names=["rid", "items"])
    filled = sizes > 0
    bounds = np.concatenate([[0], np.cumsum(sizes[filled])])
    marks = np.zeros((len(sets), 2), dtype=np.uint64)
    if len(items):
        spread = mix(items)
        marks[filled, 0] = np.add.reduceat(spread, bounds[:-1])
        marks[filled, 1] = np.add.reduceat(spread * spread, bounds[:-1])
    else:
        spread = items
    values = signatures(spread, bounds)

    def lists(flat, width):
        offsets = np.concatenate([[0], np.cumsum(filled * width)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))

    columns = [ids, batch.column("doc_id"), pa.array(sizes), pa.array(marks[:, 0].view(np.int64)),
               pa.array(marks[:, 1].view(np.int64)), lists(band_keys(values), BANDS), lists(sketches(values), 4)]
    return pa.RecordBatch.from_arrays(columns, names=["rid", "doc_id", "n", "m0", "m1", "bands", "sketch"])


def _parities(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The parity sketch of every set of a batch (cid, items)."""
    flips = [parity(np.frombuffer(v.as_buffer(), dtype=np.uint64)) for v in batch.column("items")]
    offsets = np.arange(len(batch) + 1, dtype=np.int32) * (PARITY // 64)
    flat = np.concatenate(flips) if flips else np.empty(0, dtype=np.int64)
    return pa.RecordBatch.from_arrays([batch.column("cid"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                                      names=["cid", "parity"])


def _met(batch: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    """A row per band key that has its bit set, with the other columns of its row."""
    bands = batch.column("bands")
    keys = bands.flatten().to_numpy()
    keep = has_bit(bits, keys)
    owner = np.repeat(np.arange(len(batch)), pc.list_value_length(bands).to_numpy(zero_copy_only=False))[keep]
    own = batch.drop_columns(["bands"]).take(pa.array(owner))
    return pa.RecordBatch.from_arrays([*own.columns, pa.array(keys[keep])], names=[*own.schema.names, "key"])


def _overlaps(batch: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    """The pairs of a batch that 100 * intersection >= ``percent`` * union of their full sets confirms."""
    keep = np.empty(len(batch), dtype=bool)
    for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
        one, two = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
        # Items of a set are distinct, so one that comes twice is in both.
        both = np.sort(np.concatenate([one, two]))
        common = int(np.count_nonzero(both[1:] == both[:-1]))
        keep[i] = 100 * common >= percent * (len(one) + len(two) - common)
    return batch.select(["a", "b"]).filter(pa.array(keep))


def _similar(low: int, a: str, b: str) -> Column:
    """What two sizes and two sketches say: False only for pairs that cannot, or all but surely do not, reach ``low`` %."""
    sizes = (100 * F.least(f"{a}.n", f"{b}.n") >= low * F.greatest(f"{a}.n", f"{b}.n"))
    bits = sum(F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(4))
    return sizes & (bits <= MAX_BITS)


def _near(low: int, a: str, b: str) -> Column:
    """False only if the parity sketches differ in more bits than two linked sets of these sizes can in elements."""
    bits = F.aggregate(F.zip_with(f"{a}.parity", f"{b}.parity", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0),
                       lambda s, x: s + x)
    return bits * (100 + low) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - low)


def _row_id(id_col: str, text: str) -> Column:
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.xxhash64(F.lit("no id"), F.col(f"`{text}`")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that of the smallest id; all columns stay.

    Of rows that share an id, or have no id and one text, one stays. Texts without a word are linked with nothing, so all of their rows stay.
    """
    near = grouped(docs, id_col, text, k, percent)
    winners = cut_lineage(near.filter("n > 0 and rid = winner").groupBy("rid").agg(F.count("*").alias("__n"))
                          .withColumnRenamed("rid", "__rid"))
    rows = docs.withColumn("__rid", _row_id(id_col, text))
    worded = F.coalesce(F.col(f"`{text}`").rlike(WORD), F.lit(False))
    one = rows.filter(worded).join(winners.filter("__n = 1").select("__rid").hint("merge"), "__rid", "left_semi")
    more = rows.filter(worded).join(winners.filter("__n > 1").select("__rid"), "__rid", "left_semi").dropDuplicates(["__rid"])
    return one.unionByName(more).unionByName(rows.filter(~worded)).drop("__rid")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 2, percent: int = 80) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` and ``kept``.

    Documents with 100 * intersection >= ``percent`` * union of their sets of ``k``-word shingles are linked (band and
    sketch settings are made for 80 or more); components follow the links; the smallest id stays. Null and empty texts and texts
    without a word have an empty set and no links. Rows with equal sets are one class. Rows that share an id are one
    document; rows whose id is null are told apart by their text, and have a null component only if no linked document
    has an id. Other columns are not read. An empty table gives no rows. Sets are compared as 64-bit hashes.
    """
    rows = grouped(docs, id_col, text, k, percent)
    return rows.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                       F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def grouped(docs: DataFrame, id_col: str, text: str, k: int, percent: int) -> DataFrame:
    """What ``near_duplicates`` tells, as (rid, doc_id, n, component_id, winner): rid and winner also name rows without an id."""
    ship_package(docs.sparkSession)
    source = docs.select(_row_id(id_col, text).alias("rid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.col(f"`{text}`").alias("text"))

    def signed(batches):
        held("minmax")
        for whole in batches:
            for batch in _slices(whole, 2_000_000, "text"):
                yield _rows(batch, k, False)

    def full(batches):
        held("minmax")
        for whole in batches:
            for batch in _slices(whole, 2_000_000, "text"):
                yield _rows(batch, k, True)

    def overlapping(batches):
        held("minmax")
        for batch in batches:
            yield _overlaps(batch, percent)

    def flipped(batches):
        held("minmax")
        for batch in batches:
            yield _parities(batch)

    rows = cut_lineage(source.mapInArrow(
        signed, "rid long, doc_id long, n long, m0 long, m1 long, bands array<long>, sketch array<long>"))
    mark = ["n", "m0", "m1"]
    classes = cut_lineage(rows.filter("n > 0").groupBy(*mark).agg(
        F.min("doc_id").alias("least"), F.coalesce(F.min("doc_id"), F.min("rid")).alias("cid")))
    # The row that stands for a class has its number, so bands are only taken from those rows.
    heads = rows.filter("n > 0").join(classes.select(*mark, F.col("cid").alias("rid")), [*mark, "rid"], "left_semi")
    bands = heads.select(F.col("rid").alias("cid"), F.explode("bands").alias("key"))
    shared = cut_lineage(bands.groupBy("key").agg(F.min("cid").alias("hub"), F.max("cid").alias("most"))
                         .filter("hub <> most").select("key"))
    met = docs.sparkSession.sparkContext.broadcast(bitmap(shared, "key"))  # SLOTS bits

    def meeting(batches):
        held("minmax")
        for batch in batches:
            yield _met(batch, met.value)

    bits = [F.get("sketch", F.lit(i)).alias(f"s{i}") for i in range(4)]
    bands = heads.select(F.col("rid").alias("cid"), "n", *bits, "bands").mapInArrow(
        meeting, "cid long, n long, s0 long, s1 long, s2 long, s3 long, key long")
    members = cut_lineage(bands.join(shared, "key", "left_semi").dropDuplicates(["key", "cid"]))
    wanted = members.select(F.col("cid").alias("rid")).distinct()
    sets = cut_lineage(source.select("rid", "text").join(wanted.hint("merge"), "rid", "left_semi").dropDuplicates(["rid"])
                       .mapInArrow(full, "rid long, items binary").withColumnRenamed("rid", "cid"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        joined = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("items").alias("x")), "a")
                  .join(sets.select(F.col("cid").alias("b"), F.col("items").alias("y")), "b"))
        return joined.select("a", "b", "x", "y").mapInArrow(overlapping, "a long, b long")

    open_rows = members.withColumn("root", F.col("cid"))
    links = None
    for turn in range(HUB_ROUNDS + 1):
        if open_rows.isEmpty():
            break
        if turn == HUB_ROUNDS:
            marks = sets.join(open_rows.select("cid").distinct(), "cid", "left_semi").mapInArrow(flipped, "cid long, parity array<long>")
            open_rows = cut_lineage(open_rows.join(marks, "cid"))
        m, h = open_rows.alias("m"), open_rows.alias("h")
        if turn < HUB_ROUNDS:
            order = F.xxhash64("key", "cid", F.lit(turn)) if turn else F.col("cid")
            hubs = cut_lineage(open_rows.groupBy("key").agg(F.min_by("cid", order).alias("hub")))
            h = (open_rows.join(hubs.withColumnRenamed("hub", "cid"), ["key", "cid"], "left_semi"))
            h = cut_lineage(h).alias("h")
            apart = F.col("m.root") != F.col("h.root")
        else:
            apart = (F.col("m.root") != F.col("h.root")) & (F.col("m.cid") < F.col("h.cid"))
        alike = _similar(percent, "m", "h")
        if turn == HUB_ROUNDS:
            alike = alike & _near(percent, "m", "h")
        pairs = m.join(h, (F.col("m.key") == F.col("h.key")) & apart & alike).select(
            F.least("m.cid", "h.cid").alias("a"), F.greatest("m.cid", "h.cid").alias("b")).distinct()
        found = cut_lineage(confirmed(pairs))
        links = found if links is None else cut_lineage(links.unionByName(found))
        if turn == HUB_ROUNDS:
            break
        roots = components(links).toDF("cid", "new_root")
        open_rows = cut_lineage(open_rows.drop("root").join(roots, "cid", "left")
                                .withColumn("root", F.coalesce("new_root", "cid")).drop("new_root"))
        mixed = open_rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
        open_rows = cut_lineage(open_rows.join(cut_lineage(mixed.select("key")), "key", "left_semi"))
        if turn == 0:
            # Few rows stay open as a rule, so later rounds need not read all sets.
            sets = cut_lineage(sets.join(open_rows.select("cid").distinct(), "cid", "left_semi"))
    if links is None:
        joined = classes.withColumn("root", F.col("cid"))
    else:
        roots = components(links).toDF("cid", "root")
        joined = classes.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    # A null stands for a component only when none of its documents has an id.
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    winner = F.coalesce("component_id", "root")
    labels = cut_lineage(joined.select(*mark, "root").join(named, "root").select(*mark, "component_id", winner.alias("winner")))
    out = rows.select("rid", "doc_id", *mark)
    linked = out.filter("n > 0").join(labels, mark).select("rid", "doc_id", "n", "component_id", "winner")
    return linked.unionByName(out.filter("n = 0").select(
        "rid", "doc_id", "n", F.col("doc_id").alias("component_id"), F.col("rid").alias("winner")))
