"""Audit of how far sources differ in their terms, from exact counts by minimal perfect hashes.

The first pass over the texts counts documents per (language, term) and keeps the terms of enough documents. These are
dealt to shards of about ``SHARD`` terms, and each shard gets a minimal perfect hash with its keys stored. The second pass
looks every term up and adds its count to the dense slots of its group (language, source). Tables of hashes are
broadcast in rounds of bounded size: with more than one round, the second pass writes its counts per term once, dealt
to the rounds, and each round reads its own part.

Counts of a shard meet in one task as a matrix of sources x slots, where every pair of sources and every term is
rated. All numbers are whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadloom.llm.common import ship_package
from leadloom.llm.perfecthash import Shards, build, shard_hash
from leadloom.session import cut_lineage, fresh_path

#: Bytes of a text to themselves in lower case if they belong to a term (letters, all beyond ASCII), else to a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Terms in a shard, on average.
SHARD = 2048
#: Bytes of stored keys and hashes sent to tasks in a round.
BROADCAST = 48 << 20
#: Entries of a task's counters before they are handed on, and bytes of its dense slots.
ENTRIES, DENSE = 400_000, 96 << 20
#: Sources of a language that one task rates against all sources.
TILE = 512
SCALE = 1_000_000_000


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of ASCII letters, in lower case, and of characters beyond ASCII."""
    return text.translate(FOLD).split()


def _ratio(a: np.ndarray, d: np.ndarray) -> np.ndarray:
    """floor(10^9 * a / d) for 0 <= a <= d, by long division in three steps, so that nothing passes 64 bits."""
    out = np.zeros(np.broadcast(a, d).shape, dtype=np.int64)
    rest = np.broadcast_to(a, out.shape)
    for _ in range(3):
        part = rest * 1000
        out = out * 1000 + part // d
        rest = part % d
    return out


def shares(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """p = 1 + floor(10^9 * (count + 1) / (total + kept))."""
    below = np.asarray(total, dtype=np.int64) + kept
    if below.size and below.max() > 9 * 10 ** 15:
        raise ValueError("more than 9 * 10^15 terms in a group")
    return 1 + _ratio(counts + 1, below)


# First pass


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """Rows (lang, term): the terms in at least ``least`` documents of the language."""
    def frequencies(batches):
        seen: dict[str, Counter] = {}

        def rows():
            for lang, counter in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter), type=pa.string()), pa.array(list(counter), type=pa.binary()),
                     pa.array(list(counter.values()), type=pa.int64())], names=["lang", "term", "n"])
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                seen.setdefault(lang, Counter()).update(set(terms(text.as_py())))
                if sum(map(len, seen.values())) > ENTRIES:
                    yield from rows()
        yield from rows()

    counts = docs.select("lang", "text").mapInArrow(frequencies, "lang string, term binary, n long")
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("lang", "term")


# Perfect hashes


def hashed_shards(vocabulary: DataFrame, langs: DataFrame, rounds: int) -> DataFrame:
    """One row per shard: lang, number of shards of the language in a round, round, shard, levels and keys in slot order."""
    h = F.xxhash64("term")
    placed = vocabulary.join(langs.select("lang", "shards"), "lang").select(
        "lang", "shards", "term", F.pmod(F.shiftrightunsigned(h, 32), F.lit(rounds)).cast("int").alias("round"),
        F.pmod(h.bitwiseAND(F.lit(0xFFFFFFFF)), F.col("shards")).cast("int").alias("shard"))
    order = ["lang", "round", "shard"]
    placed = placed.repartition(*order).sortWithinPartitions(*order, "term")

    def hashes(batches):
        def close(key, keys):
            levels, slots = build(keys)
            stored = [keys[i] for i in np.argsort(slots).tolist()]
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in key[:1]] + [pa.array([x], type=pa.int32()) for x in key[1:]]
                + [pa.array([levels], type=pa.list_(pa.binary())), pa.array([stored], type=pa.list_(pa.binary()))],
                names=["lang", "shards", "round", "shard", "levels", "keys"])

        now, keys = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("lang", "shards", "round", "shard", "term")]
            for *key, term in zip(*columns):
                if key != now:
                    if keys:
                        yield close(now, keys)
                    now, keys = key, []
                keys.append(term)
        if keys:
            yield close(now, keys)

    return placed.mapInArrow(hashes, "lang string, shards int, round int, shard int, levels array<binary>, keys array<binary>")


class Tables:
    """The shards of a round, as a task looks terms up in them."""

    def __init__(self, sent: bytes):
        table = pa.ipc.open_stream(sent).read_all().combine_chunks().sort_by([("lang", "ascending"), ("shard", "ascending")])
        self.shard = table.column("shard").to_numpy()
        langs, shards = table.column("lang").to_pylist(), table.column("shards").to_pylist()
        keys = table.column("keys").combine_chunks() if table.num_rows else pa.array([], type=pa.list_(pa.binary()))
        keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
        self.sizes = keys.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.shards = Shards.load(table.column("levels").to_pylist(), keys.flatten(), self.sizes)
        #: Per language: the number of its shards, the row of each of them (-1: without keys), first slot, slots.
        self.langs: dict[str, tuple[int, np.ndarray, int, int]] = {}
        for lang in dict.fromkeys(langs):
            rows = np.array([i for i, x in enumerate(langs) if x == lang])
            row_of = np.full(shards[rows[0]], -1, dtype=np.int64)
            row_of[self.shard[rows]] = rows
            self.langs[lang] = (shards[rows[0]], row_of, int(self.shards.first[rows[0]]), int(self.sizes[rows].sum()))

    def find(self, lang: str, keys: list[bytes]) -> np.ndarray:
        """Slot among those of the language, -1 for terms not kept."""
        found = np.full(len(keys), -1, dtype=np.int64)
        if lang in self.langs and keys:
            count, row_of, first, _ = self.langs[lang]
            row = row_of[((shard_hash(keys) & np.uint64(0xFFFFFFFF)) % np.uint64(count)).astype(np.int64)]
            there = np.flatnonzero(row >= 0)
            slot = self.shards.find([keys[i] for i in there.tolist()] if len(there) < len(keys) else keys, row[there])
            found[there] = np.where(slot >= 0, slot - first, -1)
        return found


_LOADED: dict[str, Tables] = {}


def _tables(name: str, sent: bytes) -> Tables:
    """The tables of one round at a time; a worker runs many tasks of it."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Tables(sent)
    return _LOADED[name]


# Second pass


Tally = tuple[str, str, list[bytes], np.ndarray]


def tallies(batches) -> Iterator[Tally]:
    """Counts per term of each group, from (lang, source, text); a group comes again once counters are full."""
    held: dict[tuple[str, str], Counter] = {}

    def rows():
        for (lang, source), counter in held.items():
            yield lang, source, list(counter), np.fromiter(counter.values(), dtype=np.int64, count=len(counter))
        held.clear()

    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
            held.setdefault((lang, source), Counter()).update(terms(text.as_py()))
            if sum(map(len, held.values())) > ENTRIES:
                yield from rows()
    yield from rows()


def _stored(batches) -> Iterator[Tally]:
    for batch in batches:
        for lang, source, own, counts in zip(*(batch.column(c) for c in ("lang", "source", "terms", "counts"))):
            yield lang.as_py(), source.as_py(), own.as_py(), counts.values.to_numpy()


COUNTED = "lang string, source string, round int, shard int, slots array<int>, counts array<long>, total long"


def _recount(groups: Iterator[Tally], tables: Tables, number: int) -> Iterator[pa.RecordBatch]:
    """Add counts to the dense slots of their groups; give slots that are not 0, by group and shard."""
    dense: dict[tuple[str, str], np.ndarray] = {}

    def rows():
        out = []
        for (lang, source), slots in dense.items():
            _, row_of, first, _ = tables.langs[lang]
            for row in row_of[row_of >= 0].tolist():
                start = int(tables.shards.first[row]) - first
                own = slots[start:start + int(tables.sizes[row])]
                used = np.flatnonzero(own)
                if len(used):
                    out.append((lang, source, number, int(tables.shard[row]), used.astype(np.int32), own[used], int(own.sum())))
        dense.clear()
        for at in range(0, len(out), 500):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*out[at:at + 500]), (
                    pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64()))],
                names=["lang", "source", "round", "shard", "slots", "counts", "total"])

    for lang, source, own, counts in groups:
        slot = tables.find(lang, own)
        kept = slot >= 0
        if kept.any():
            if (lang, source) not in dense:
                if sum(x.nbytes for x in dense.values()) > DENSE:
                    yield from rows()
                dense[lang, source] = np.zeros(tables.langs[lang][3], dtype=np.int64)
            # A term is once in a tally, so no slot comes twice.
            dense[lang, source][slot[kept]] += counts[kept]
    yield from rows()


def recounted(docs: DataFrame, shards: DataFrame, rounds: int) -> DataFrame:
    """Counts per (lang, source, shard) as slots and counts, from one pass over the texts and one broadcast per round.

    A row comes from one task, so a group and shard have several.
    """
    spark = docs.sparkSession
    texts = docs.select("lang", "source", "text")
    if rounds > 1:
        def dealt(batches):
            for lang, source, own, counts in tallies(batches):
                number = ((shard_hash(own) >> np.uint64(32)) % np.uint64(rounds)).astype(np.int64)
                for r in np.unique(number).tolist():
                    at = np.flatnonzero(number == r)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r], type=pa.int32()), pa.array([lang]), pa.array([source]),
                         pa.array([[own[i] for i in at.tolist()]], type=pa.list_(pa.binary())),
                         pa.array([counts[at]], type=pa.list_(pa.int64()))],
                        names=["round", "lang", "source", "terms", "counts"])

        stored = fresh_path(spark, "tallies")
        kind = "round int, lang string, source string, terms array<binary>, counts array<long>"
        texts.mapInArrow(dealt, kind).write.partitionBy("round").parquet(stored)
        texts = spark.read.schema(kind).parquet(stored)
    target = fresh_path(spark, "counts")
    for r in range(rounds):
        own = shards.filter(F.col("round") == r).select("lang", "shards", "shard", "levels", "keys").toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, own.schema) as writer:
            writer.write_table(own)
        sent = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())  # at most about BROADCAST bytes
        name = f"{target}/{r}"

        def run(batches, r=r, sent=sent, name=name):
            groups = _stored(batches) if rounds > 1 else tallies(batches)
            yield from _recount(groups, _tables(name, sent.value), r)

        rows = texts.filter(F.col("round") == r) if rounds > 1 else texts
        rows.mapInArrow(run, COUNTED).write.mode("append").parquet(target)
        sent.unpersist()
    return spark.read.schema(COUNTED).parquet(target)


# Rating


class Rating:
    """Sums per pair of sources and the best terms per source, for some sources of one language against all of them."""

    def __init__(self, top: int):
        self.top = top
        self.sources: list[str] = []
        self.totals = self.pairs = np.empty(0, dtype=np.int64)
        self.mine: list[int] = []
        self.kept = 0
        self.best: dict[int, list[tuple[int, bytes]]] = {}

    def add(self, counts: np.ndarray, keys: list[bytes]) -> None:
        """Rate the slots of a shard; ``counts`` has a row per source."""
        if not keys:
            return
        own = shares(counts, self.totals[:, None], self.kept)
        lang = shares(counts.sum(axis=0), self.totals.sum(), self.kept)
        order = None
        for i, g in enumerate(self.mine):
            for at in range(0, len(own), 256):
                apart = own[g] - own[at:at + 256]
                self.pairs[i, at:at + 256] += (apart * apart // own[at:at + 256]).sum(axis=1)
            better = np.flatnonzero((counts[g] > 0) & (own[g] > lang))
            if not len(better):
                continue
            value = np.square(own[g][better] - lang[better]) // lang[better]
            if len(better) > self.top:
                least = np.partition(value, -self.top)[-self.top]
                better, value = better[value >= least], value[value >= least]
            if order is None:
                order = np.empty(len(keys), dtype=np.int64)
                order[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys))
            first = np.lexsort((order[better], -value))[:self.top].tolist()
            found = self.best.get(g, []) + [(-int(value[j]), keys[better[j]]) for j in first]
            self.best[g] = sorted(found)[:self.top]

    def rows(self) -> Iterator[tuple[str, str, str, int]]:
        for i, g in enumerate(self.mine):
            for h, other in enumerate(self.sources):
                if h != g:
                    yield self.sources[g], "pair", other, int(self.pairs[i, h])
            for less, term in self.best.get(g, []):
                yield self.sources[g], "term", term.decode("utf-8", "replace"), -less


def _rate(batches, top: int) -> Iterator[pa.RecordBatch]:
    """Rows of a task, sorted by (lang, tile, shard, kind): heads of all sources, then the keys, then counts of the shard."""
    rating, place, shard = Rating(top), None, None
    heads: list[tuple[str, int, bool]] = []
    counts, keys = None, []
    index: dict[str, int] = {}

    def open_shard():
        nonlocal counts, index
        if not rating.sources:
            rating.sources, rating.totals = [h[0] for h in heads], np.array([h[1] for h in heads], dtype=np.int64)
            rating.mine = [i for i, h in enumerate(heads) if h[2]]
            rating.pairs = np.zeros((len(rating.mine), len(heads)), dtype=np.int64)
        index = {s: i for i, s in enumerate(rating.sources)}
        counts = np.zeros((len(heads), len(keys)), dtype=np.int64)

    def close_shard():
        if shard is not None:
            if counts is None:
                open_shard()
            rating.add(counts, keys)

    def done():
        if place is not None:
            own = list(rating.rows())
            for at in range(0, len(own), 10_000):
                part = list(zip(*own[at:at + 10_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([place[0]] * len(part[0])), *[pa.array(c) for c in part[:3]], pa.array(part[3], type=pa.int64())],
                    names=["lang", "source", "part", "item", "value"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lang", "tile", "round", "shard", "kind", "source", "total", "mine")]
        for n, (lang, tile, number, part, kind, source, total, mine) in enumerate(zip(*columns)):
            if (lang, tile) != place or (number, part) != shard:
                close_shard()
                shard, counts, heads, keys = (number, part), None, [], []
                if (lang, tile) != place:
                    yield from done()
                    rating, place = Rating(top), (lang, tile)
            if kind == 0:
                heads.append((source, total, mine))
            elif kind == 1:
                rating.kept, keys = total, batch.column("keys")[n].as_py() or []
            else:
                if counts is None:
                    open_shard()
                slots, own = batch.column("slots")[n].values.to_numpy(), batch.column("counts")[n].values.to_numpy()
                counts[index[source], slots] += own  # slots of a row are distinct
    close_shard()
    yield from done()


def audit(
    docs: DataFrame, least: int = 3, top: int = 200, text: str = "text", lang: str = "lang", source: str = "source",
    shard: int = SHARD, broadcast: int = BROADCAST, tile: int = TILE,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how each source differs from the others of its language, and by which terms.

    Null text, language and source are empty strings. A language keeps the terms in at least ``least`` of its documents;
    repeated rows are documents of their own. Part ``pair`` has a row for each other source of the language, also of sources
    without terms and languages without kept terms (value 0); part ``term`` the ``top`` best terms of the source. Ranks
    are by value, the largest first, then by the UTF-8 bytes of the item. A very long text is split in its own row. An
    empty table gives no rows; other columns are not read.

    A shard's counts of all sources of a language meet in one task; shards are equal by hash, so a hot source or
    language has no larger tasks, only more of them. ``tile`` sources at a time are rated against all of them.
    """
    spark = docs.sparkSession
    ship_package(spark)
    empty = F.lit("")
    docs = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), empty).alias("lang"),
                       F.coalesce(F.col(f"`{source}`").cast("string"), empty).alias("source"),
                       F.coalesce(F.col(f"`{text}`"), empty).cast("binary").alias("text"))
    vocabulary = cut_lineage(kept_terms(docs, least))
    groups = cut_lineage(docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")))
    weight = vocabulary.agg(F.coalesce(F.sum(F.octet_length("term") + 8), F.lit(0)).alias("b")).first()["b"]
    rounds = max(1, -(-weight // broadcast))
    kept = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    langs = cut_lineage(
        groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(kept, "lang", "left")
        .withColumn("kept", F.coalesce("kept", F.lit(0)))
        .withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("kept") / (shard * rounds))).cast("int"))
        .withColumn("tiles", F.ceil(F.col("sources") / tile).cast("int")))
    shards = cut_lineage(hashed_shards(vocabulary, langs, rounds))
    counted = recounted(docs, shards, rounds)

    totals = counted.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    place = [F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round")]
    every = langs.select("lang", "kept", "shards", "tiles", *place).select(
        "lang", "kept", "tiles", "round", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")).select(
        "lang", "kept", "tiles", "round", "shard", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    none = {"source": F.lit(None).cast("string"), "total": F.lit(None).cast("long"), "mine": F.lit(None).cast("boolean"),
            "keys": F.lit(None).cast("array<binary>"), "slots": F.lit(None).cast("array<int>"),
            "counts": F.lit(None).cast("array<long>")}

    def kind(rows: DataFrame, number: int, **given) -> DataFrame:
        columns = none | given
        return rows.select("lang", "tile", "round", "shard", F.lit(number).alias("kind"), *[c.alias(k) for k, c in columns.items()])

    members = groups.select("lang", "source").join(totals, ["lang", "source"], "left").withColumn(
        "total", F.coalesce("total", F.lit(0)))
    heads = kind(every.join(members, "lang"), 0, source=F.col("source"), total=F.col("total"),
                 mine=F.pmod(F.xxhash64("source"), F.col("tiles")) == F.col("tile"))
    stored = kind(every.join(shards.select("lang", "round", "shard", "keys"), ["lang", "round", "shard"], "left"), 1,
                  total=F.col("kept"), keys=F.col("keys"))
    spread = counted.join(langs.select("lang", "tiles"), "lang").withColumn(
        "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    filled = kind(spread, 2, source=F.col("source"), slots=F.col("slots"), counts=F.col("counts"))
    order = ["lang", "tile", "round", "shard"]
    dealt = heads.unionByName(stored).unionByName(filled).repartition(*order).sortWithinPartitions(*order, "kind", "source")
    rated = cut_lineage(dealt.mapInArrow(
        lambda batches: _rate(batches, top), "lang string, source string, part string, item string, value long"))

    ordered = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = rated.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = rated.filter("part = 'term'").withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(ordered)).unionByName(best).select(
        "lang", "source", "part", "item", "value", "rank")
