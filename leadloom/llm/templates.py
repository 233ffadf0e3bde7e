"""Line dedup with a tree of templates.

Lines are parsed into a tree of fixed depth: the number of tokens, then the leading tokens, where tokens with digits
are variable fields; case of A-Z and the kind of space between tokens do not matter. The lines of a leaf are generalised: a token stays where it stands in a fifth of the leaf's lines at that place,
anything else is a variable field. A template is a line as it is, or a generalised one that keeps most of its tokens.
Templates that recur across documents are dropped from all of them.

Copies of a document repeat each other's lines, which is no reason to drop them: texts that are near copies by their
shingles of five words, as the near-duplicate stage links them, have one vote together. Short lines recur by chance, so a
template of ``n`` tokens needs ``need / n`` votes, and two at least.

A passage may be wrapped over several lines. Neighbouring recurring lines are therefore also judged together: of every line, the
shortest run that begins with it and the shortest that ends with it and has ``need / 2`` tokens is a key that needs two
votes. Whatever longer run texts share is covered by such runs, and their number grows with the lines only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm import minmax
from leadloom.llm.bytebpe import _slices
from leadloom.llm.common import bitmap, has_bit, held, ship_package
from leadloom.llm.shingles import _POWERS, mix, word_edges, word_spans
from leadloom.session import cut_lineage

#: Leading tokens in the tree; the share of a leaf's lines that makes a token constant; the share of constant tokens in a
#: template; tokens times votes for a template; words of a shingle and percent of likeness that make two texts copies.
DEPTH, CONSTANT, KEPT, NEED, SHINGLE, COPY = 3, 0.2, 0.6, 100, 5, 80
#: Tokens of a run of lines that two votes drop.
PASSAGE = NEED // 2
#: Not used here any more: the share above which a text once lost its vote, which the plain rule of the tests still reads.
RECURRING = 0.5
#: Tokens of a leaf up to which one task generalises its lines; the lines of larger leaves are summed place by place.
LEAF = 1 << 20


def _tokens(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token between the places, each part with the space that ends it, and whether it has a digit."""
    if not len(low):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=bool)
    edges = np.stack([low, high], axis=1).ravel()
    own = data[:high[-1]][np.repeat(np.tile([False, True], len(low)), np.diff(edges, prepend=0))]
    starts, ends, words = word_spans(own.tobytes())
    digits = np.concatenate([[0], np.cumsum((own >= 48) & (own <= 57))])
    return words, digits[ends] > digits[starts]


def _lines(batch: pa.RecordBatch, wanted: np.ndarray | None) -> pa.RecordBatch:
    """A row per line that has a token, by its leading tokens alone; with ``wanted``, whole lines, if their leaf has its bit set."""
    parts = batch.column("text").cast(pa.binary()).to_pylist()
    data = np.frombuffer(b"\n".join([*parts, b""]), dtype=np.uint8)
    begins = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
    starts, ends = word_edges(data)
    breaks = np.flatnonzero(data == 10)
    bounds = np.concatenate([[0], np.searchsorted(starts, breaks), [len(starts)]])
    line = np.flatnonzero(bounds[1:] > bounds[:-1])
    heads, sizes = bounds[line], (bounds[1:] - bounds[:-1])[line]
    lead = np.minimum(sizes, DEPTH)
    words, fields = _tokens(data, starts[heads], ends[heads + lead - 1] + 1)
    masked = np.where(fields, np.uint64(0), words | np.uint64(1))
    at = np.cumsum(lead) - lead
    leaf = mix(sizes.astype(np.uint64))
    for j in range(DEPTH):
        own = masked[np.minimum(at + j, max(len(masked) - 1, 0))]
        leaf = mix(leaf * np.uint64(3) + np.where(sizes > j, own, np.uint64(7)))
    leaf = leaf.view(np.int64)
    first = np.searchsorted(breaks, begins)
    owner = np.searchsorted(first, line, side="right") - 1
    tids = batch.column("tid").to_numpy()[owner]
    if wanted is None:
        return pa.RecordBatch.from_arrays([pa.array(tids), pa.array(sizes.astype(np.int32)), pa.array(leaf)], names=["tid", "n", "leaf"])
    keep = has_bit(wanted, leaf)
    pos, order = line - first[owner], np.arange(len(line)) - np.searchsorted(owner, owner)
    tids, pos, order, heads, sizes, leaf = (c[keep] for c in (tids, pos, order, heads, sizes, leaf))
    words, fields = _tokens(data, starts[heads], ends[heads + sizes - 1] + 1)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    place = (np.arange(len(words)) - np.repeat(offsets[:-1], sizes)).astype(np.uint64)
    keys = np.add.reduceat(mix(words ^ mix(place + np.uint64(1))), offsets[:-1]) if len(heads) else np.empty(0, dtype=np.uint64)
    flat = np.where(fields, np.int64(0), ((words >> np.uint64(33)) | np.uint64(1)).astype(np.int64)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(tids), pa.array(pos.astype(np.int32)), pa.array(order.astype(np.int32)), pa.array(mix(keys).view(np.int64)),
         pa.array(sizes.astype(np.int32)), pa.array(leaf), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
        names=["tid", "pos", "ord", "lh", "n", "leaf", "toks"])


def _parsed(docs: DataFrame, text: str, wanted=None) -> DataFrame:
    """Rows (tid, n, leaf), one per line that has a token; tid stands for the text.

    ``wanted`` is a broadcast bitmap of leaves; then only their lines come, as (tid, pos, ord, lh, n, leaf, toks): lh stands for
    the line, pos counts all lines of the text, ord those with a token, and toks has a number per token, 0 for a field. Only
    those lines are hashed as a whole.
    """
    rows = docs.select(F.xxhash64(f"`{text}`").alias("tid"), F.col(f"`{text}`").alias("text")).filter("text is not null")

    def run(batches):
        held("templates")
        for whole in batches:
            for batch in _slices(whole, 1_000_000, "text"):
                yield _lines(batch, None if wanted is None else wanted.value)

    whole = "tid long, pos int, ord int, lh long, n int, leaf long, toks array<int>"
    return rows.mapInArrow(run, "tid long, n int, leaf long" if wanted is None else whole)


def _runs(tids: np.ndarray, order: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """The runs of whole texts, whose lines come in order; a line that is missing ends a run."""
    at = np.arange(len(tids))
    new = np.concatenate([[True], (tids[1:] != tids[:-1]) | (order[1:] != order[:-1] + 1)])[:len(at)]
    begins = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    low, high = begins[run], np.append(begins[1:], len(at))[run]
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    ends = np.searchsorted(total, total[:-1] + PASSAGE)
    starts = np.searchsorted(total, total[1:] - PASSAGE, side="right") - 1
    ahead, back = ends <= high, starts >= low
    first = np.concatenate([at[ahead], starts[back]])
    end = np.concatenate([ends[ahead], at[back] + 1])
    up, down = _POWERS.get(len(at) + 1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(keys.view(np.uint64)) * up[:len(at)])])
    marks = mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64)).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(tids[first]), pa.array(marks), pa.array(order[first]), pa.array(order[end - 1])],
        names=["tid", "key", "first", "last"])


def passages(lines: DataFrame) -> DataFrame:
    """Rows (tid, key, first, last), one per run of neighbouring ``lines`` (tid, ord, n, key) with just enough tokens."""
    def run(batches):
        names = ["tid", "ord", "n", "key"]
        rest = [np.empty(0, dtype=t) for t in (np.int64, np.int32, np.int32, np.int64)]
        for batch in batches:
            rest = [np.concatenate([r, batch.column(c).to_numpy()]) for r, c in zip(rest, names)]
            # The last text of a batch may go on in the next one.
            whole = np.searchsorted(rest[0], rest[0][-1]) if len(rest[0]) else 0
            if whole:
                yield _runs(*[r[:whole] for r in rest])
                rest = [r[whole:] for r in rest]
        if len(rest[0]):
            yield _runs(*rest)

    rows = lines.select("tid", "ord", "n", "key").repartition("tid").sortWithinPartitions("tid", "ord")
    return rows.mapInArrow(run, "tid long, key long, first int, last int").distinct()


def _general(leaf: np.ndarray, sizes: np.ndarray, toks: np.ndarray) -> pa.Array:
    """The template of every line of whole leaves, or null; lines come in the order of ``leaf``, ``toks`` line by line."""
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    place = np.arange(len(toks)) - np.repeat(heads, sizes)
    first = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
    number = np.searchsorted(first, np.arange(len(leaf)), side="right") - 1
    lines = np.diff(np.append(first, len(leaf)))
    slots = np.concatenate([[0], np.cumsum(np.maximum.reduceat(sizes, first))[:-1]])
    keys = ((np.repeat(slots[number], sizes) + place) << 32) | toks
    _, at, seen = np.unique(keys, return_inverse=True, return_counts=True)
    constant = (seen[at] >= CONSTANT * np.repeat(lines[number], sizes)) & (toks != 0)
    marks = mix(np.where(constant, toks, 0).astype(np.uint64) ^ mix(place.astype(np.uint64) + np.uint64(1)))
    marks = mix(np.add.reduceat(marks, heads) ^ mix(leaf.view(np.uint64))).view(np.int64)
    return pa.array(marks, mask=np.add.reduceat(constant.astype(np.int64), heads) < KEPT * sizes)


def _small_leaves(met: DataFrame) -> DataFrame:
    """Rows (tid, pos, ord, lh, n, template) of the lines of leaves of up to ``LEAF`` tokens."""
    names = ["tid", "pos", "ord", "lh", "n", "leaf", "toks"]

    def rows(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks().to_batches()[0]
        # Lines of rows with equal texts follow each other.
        tid, pos = part.column("tid").to_numpy(), part.column("pos").to_numpy()
        part = part.filter(pa.array(np.concatenate([[True], (tid[1:] != tid[:-1]) | (pos[1:] != pos[:-1])])))
        sizes = part.column("n").to_numpy().astype(np.int64)
        toks = part.column("toks").flatten().to_numpy().astype(np.int64)
        template = _general(part.column("leaf").to_numpy(), sizes, toks)
        return pa.RecordBatch.from_arrays([*[part.column(c) for c in names[:5]], template], names=[*names[:5], "template"])

    def run(batches):
        held("templates")
        rest = None
        for batch in batches:
            rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if not len(rest):
                continue
            leaf, sizes = rest.column("leaf").to_numpy(), rest.column("n").to_numpy()
            # Whole leaves, about LEAF tokens at a time; the last leaf of a batch may go on in the next one.
            begins = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
            portion = (np.cumsum(sizes, dtype=np.int64) // LEAF)[begins]
            cuts = np.unique(np.append(begins[np.concatenate([[True], portion[1:] != portion[:-1]])], begins[-1]))
            for low, high in zip(cuts[:-1], cuts[1:]):
                yield rows(rest.slice(low, high - low))
            rest = rest.slice(cuts[-1])
        if rest is not None and len(rest):
            yield rows(rest)

    return (met.select(*names).repartition("leaf").sortWithinPartitions("leaf", "tid", "pos")
            .mapInArrow(run, "tid long, pos int, ord int, lh long, n int, template long"))


def _large_leaves(met: DataFrame) -> DataFrame:
    """The same rows for leaves of any size: tokens are counted by place, and each line meets what stays of its leaf."""
    places = met.select("leaf", F.posexplode("toks").alias("p", "tok")).groupBy("leaf", "p", "tok").agg(F.count("*").alias("c"))
    sizes = met.groupBy("leaf").agg(F.count("*").alias("lines"))
    kept = F.collect_list(F.when((F.col("c") >= CONSTANT * F.col("lines")) & (F.col("tok") != 0), F.col("tok")))
    profile = (places.join(sizes, "leaf").groupBy("leaf", "p").agg(kept.alias("own"))
               .groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("p", "own")))["own"].alias("profile")))
    profile = cut_lineage(profile)
    general = F.transform("toks", lambda t, i: F.when(F.array_contains(F.get("profile", i), t), t).otherwise(F.lit(0)))
    found = met.join(profile, "leaf").withColumn("general", general)
    constant = F.size(F.filter("general", lambda t: t != 0))
    template = F.when(constant >= KEPT * F.col("n"), F.xxhash64("leaf", "general"))
    return found.select("tid", "pos", "ord", "lh", "n", template.alias("template"))


def copy_groups(docs: DataFrame, tids: DataFrame, text: str) -> DataFrame:
    """Rows (tid, voter) for the texts in ``tids``: near copies among them have the same voter."""
    rows = docs.select(F.xxhash64(f"`{text}`").alias("tid"), F.col(f"`{text}`").alias("text")).filter("text is not null")
    rows = cut_lineage(rows.join(cut_lineage(tids).hint("merge"), "tid", "left_semi").dropDuplicates(["tid"]))
    return minmax.grouped(rows, "tid", "text", SHINGLE, COPY).select(F.col("rid").alias("tid"), F.col("winner").alias("voter"))


def recurring_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (tid, pos): the lines to drop, by the hash of the text and the number of the line; a line may come more than once."""
    ship_package(docs.sparkSession)
    lines = _parsed(docs, text)
    # A leaf matters if two different texts reach it; least and greatest tell that without a list.
    leaves = cut_lineage(lines.groupBy("leaf").agg(F.min("tid").alias("a"), F.max("tid").alias("b"), F.sum("n").alias("tokens"))
                         .filter((F.col("a") != F.col("b")) | (F.col("tokens") > LEAF)))
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(leaves.filter("a <> b"), "leaf"))  # SLOTS bits
    # The map also lets lines of a few other leaves through; with one text each, they share no key.
    met, large = _parsed(docs, text, wanted), leaves.filter(F.col("tokens") > LEAF).select("leaf")
    if large.isEmpty():
        found = cut_lineage(_small_leaves(met))
    else:
        met = cut_lineage(met)
        found = _small_leaves(met.join(large, "leaf", "left_anti"))
        more = cut_lineage(met.join(large, "leaf", "left_semi").dropDuplicates(["tid", "pos"]))
        found = cut_lineage(found.unionByName(_large_leaves(more)))

    keys = found.select("tid", "pos", "n", F.explode(F.array_compact(F.array("lh", "template"))).alias("key"))
    shared = keys.groupBy("key").agg(F.min("tid").alias("a"), F.max("tid").alias("b")).filter("a <> b").select("key")
    shared = cut_lineage(shared)
    keys = cut_lineage(keys.join(shared, "key", "left_semi"))
    # Equal lines have equal templates, so runs of templates hold the runs of equal lines.
    like = found.select("tid", "pos", "ord", "n", F.coalesce("template", "lh").alias("key"))
    runs = cut_lineage(passages(like.join(shared, "key", "left_semi")))
    again = runs.groupBy("key").agg(F.min("tid").alias("a"), F.max("tid").alias("b")).filter("a <> b").select("key")
    runs = cut_lineage(runs.join(cut_lineage(again), "key", "left_semi"))
    votes = keys.select("key", "tid", "n").distinct()
    # Groups are never more than texts, so only keys that enough texts hold can have the votes.
    needed = F.greatest(F.lit(2), F.ceil(NEED / F.min("n")))
    texts = votes.groupBy("key").agg(F.count("*").alias("docs"), needed.alias("need")).filter("docs >= need")
    votes = votes.select("key", "tid").join(cut_lineage(texts.select("key", "need")), "key")
    votes = cut_lineage(votes.unionByName(runs.select("key", "tid", F.lit(2).cast("long").alias("need")).distinct()))
    voters = copy_groups(docs, votes.select("tid").distinct(), text)
    dropped = (votes.join(voters, "tid").select("key", "need", "voter").distinct()
               .groupBy("key", "need").agg(F.count("*").alias("c")).filter("c >= need").select("key"))
    dropped = cut_lineage(dropped)
    inside = runs.join(dropped, "key", "left_semi").select("tid", F.explode(F.sequence("first", "last")).alias("ord"))
    lines = keys.join(dropped, "key", "left_semi").select("tid", "pos")
    return lines.unionByName(like.join(inside, ["tid", "ord"], "left_semi").select("tid", "pos"))


def drop_recurring(docs: DataFrame, text: str = "text", dropped: str | None = None) -> DataFrame:
    """``docs`` without the lines whose templates recur; ``dropped``, if named, is a new column with the number of lost lines.

    Every row stays, in all its columns (one called like ``dropped`` is replaced), also if no line is left: its text is
    then empty. Null texts stay null, empty lines stay, and a table without rows gives none. Equal texts lose equal
    lines; a text counts once however many rows have it. Whole texts are parsed, also very long ones.
    """
    lost = recurring_lines(docs, text).groupBy("tid").agg(F.array_sort(F.collect_set("pos")).alias("lost"))
    lost = cut_lineage(lost)
    # The caller's columns go by number, so that no name clashes with a working column.
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    own = F.col(names[docs.columns.index(text)])
    rows = rows.withColumn("tid", F.xxhash64(own)).join(lost.hint("merge"), "tid", "left")
    rows = rows.withColumn("lines", F.when(F.col("lost").isNotNull(), F.split(own, "\n")))
    # The lines between one lost line and the next are taken as a whole.
    between = F.transform(F.concat(F.array(F.lit(-1)), "lost"), lambda p, i: F.slice(
        "lines", p + 2, F.coalesce(F.get("lost", i), F.size("lines")) - p - 1))
    kept = F.when(F.col("lost").isNull(), own).otherwise(F.array_join(F.flatten(between), "\n"))
    out = [(kept if c == text else F.col(n)).alias(c) for n, c in zip(names, docs.columns)
           if not dropped or c.lower() != dropped.lower()]
    if dropped:
        out.append(F.greatest(F.size("lost"), F.lit(0)).cast("long").alias(dropped))
    return rows.select(*out)
