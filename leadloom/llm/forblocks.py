"""Token ids in binary files: patched frame-of-reference blocks with an index.

A file is a run of segments, each followed by ``END``. A segment holds whole documents of one writing partition:

- head: magic, CRC-32 of what follows it, partition, number of the segment in it, documents, blocks, ids, ids before
  this segment in its partition, bytes of the blocks;
- per document its id, whether the id is null, and its number of ids;
- per block its start (bytes from the first block): the index, through which single blocks are read;
- the blocks, each for 256 ids: least id, width, number of exceptions; the ids less the least one, packed at ``width``
  bits (first the lowest bit of all of them, then the next); for ids that need more bits, their places and what is left above ``width``.

The width of a block is the one among a few percentiles of the needed bits that makes the block smallest.
All numbers are little-endian. Segments sort by (partition, number), partitions hold ascending ranges of document ids.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from leadloom.llm.common import ship_package

MAGIC, END = b"PFR1", "\nPFR/\n"
HEAD = struct.Struct("<4sIIIIIQQQ")
BLOCK = 256
#: Parts of a block's ids that the packed width may be made to fit; the rest are exceptions.
PERCENTILES = (0.5, 0.75, 0.9, 0.97, 1.0)
#: Ids after which a segment is closed, and segments in a file. A segment holds whole documents.
SEGMENT, SEGMENTS_PER_FILE = 1 << 20, 16
#: Bytes of text that are encoded at a time.
SLICE = 4_000_000


# Blocks


def _needed(x: np.ndarray) -> np.ndarray:
    """Bits that whole numbers need: the exponent of a double."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


_BITS = _needed(np.arange(1 << 16))


def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Starts and bytes of the blocks that hold ``ids`` (unsigned 32-bit numbers)."""
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.empty(0, dtype="<u8"), b""
    full = np.full(blocks * BLOCK, ids[-1], dtype=np.uint32)
    full[:len(ids)] = ids
    full = full.reshape(blocks, BLOCK)
    least = full.min(axis=1)
    delta = full - least[:, None]
    bits = _BITS[delta] if delta.max() < len(_BITS) else _needed(delta)
    # Per block and width, how many ids need more bits.
    beyond = np.stack([np.count_nonzero(bits > w, axis=1) for w in range(int(bits.max()) + 1)], axis=1)
    width, size = np.zeros(blocks, dtype=np.int64), np.full(blocks, np.iinfo(np.int64).max)
    for part in PERCENTILES:
        w = (beyond > BLOCK - np.ceil(part * BLOCK)).sum(axis=1)
        needed = w * BLOCK // 8 + 5 * beyond[np.arange(blocks), w]
        width, size = np.where(needed < size, w, width), np.minimum(needed, size)
    over = bits > width[:, None]
    count = beyond[np.arange(blocks), width]
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            low = delta[own]
            planes = np.empty((len(own), w, BLOCK // 8), dtype=np.uint8)
            for bit in range(w):
                planes[:, bit] = np.packbits((low >> np.uint32(bit)).astype(np.uint8) & 1, axis=1, bitorder="little")
            for i, row in zip(own.tolist(), planes):
                packed[i] = row.tobytes()
    places = np.nonzero(over)[1].astype(np.uint8)
    high = (delta[over] >> np.repeat(width, count).astype(np.uint32)).astype("<u4")
    ends = np.cumsum(count)
    out = []
    for i, (m, w, n, end) in enumerate(zip(least.tolist(), width.tolist(), count.tolist(), ends.tolist())):
        out.append(struct.pack("<IBH", m, w, n) + packed[i] + places[end - n:end].tobytes() + high[end - n:end].tobytes())
    starts = np.zeros(blocks, dtype="<u8")
    np.cumsum([len(b) for b in out[:-1]], out=starts[1:])
    return starts, b"".join(out)


def unpack(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All ids of the blocks at ``starts`` in ``data`` (bytes), 256 for each."""
    if not len(starts):
        return np.empty(0, dtype=np.uint32)
    starts = starts.astype(np.int64)
    heads = data[starts[:, None] + np.arange(7)]
    least = np.ascontiguousarray(heads[:, :4]).view("<u4")[:, 0]
    width, count = heads[:, 4].astype(np.int64), np.ascontiguousarray(heads[:, 5:7]).view("<u2")[:, 0].astype(np.int64)
    delta = np.zeros((len(starts), BLOCK), dtype=np.uint32)
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        for own in np.array_split(own, -(-len(own) // 1024)) if w else []:
            planes = data[starts[own][:, None] + 7 + np.arange(w * BLOCK // 8)].reshape(len(own), w, BLOCK // 8)
            low = np.zeros((len(own), BLOCK), dtype=np.uint32)
            for bit in range(w):
                low |= np.unpackbits(planes[:, bit], axis=1, bitorder="little").astype(np.uint32) << np.uint32(bit)
            delta[own] = low
    if count.any():
        block = np.repeat(np.arange(len(starts)), count)
        nth = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
        first = starts + 7 + width * BLOCK // 8
        places = data[first[block] + nth]
        high = np.ascontiguousarray(data[(first + count)[block][:, None] + 4 * nth[:, None] + np.arange(4)]).view("<u4")[:, 0]
        delta[block, places] |= high << width[block].astype(np.uint32)
    return (delta + least[:, None]).reshape(-1)


@dataclass
class Segment:
    """One segment read from a file."""

    partition: int
    number: int
    before: int
    doc_ids: list[int | None]
    sizes: np.ndarray
    starts: np.ndarray
    data: np.ndarray

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids ``first`` up to ``last`` of the segment; only the blocks that hold them are unpacked."""
        last = int(self.sizes.sum()) if last is None else last
        if first >= last:
            return np.empty(0, dtype=np.uint32)
        block = first // BLOCK
        got = unpack(self.data, self.starts[block:-(-last // BLOCK)])
        return got[first - block * BLOCK:last - block * BLOCK]


def segment_bytes(partition: int, number: int, before: int, doc_ids: list[int | None], parts: list[bytes]) -> bytes:
    """A segment from the ids of its documents, each given as little-endian unsigned 32-bit numbers."""
    ids = np.frombuffer(b"".join(parts), dtype="<u4")
    starts, data = pack(ids)
    body = b"".join([
        np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(),
        np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
        np.array([len(p) // 4 for p in parts], dtype="<u8").tobytes(), starts.tobytes(), data])
    return HEAD.pack(MAGIC, zlib.crc32(body), partition, number, len(parts), len(starts), len(ids), before, len(data)) + body


def segments(content: bytes, heads_only: bool = False) -> Iterator[Segment | tuple]:
    """The segments of a file, or (partition, number, ids, before) of each. A file that is cut or changed raises an error."""
    at, end = 0, END.encode()
    while at < len(content):
        if len(content) - at < HEAD.size:
            raise ValueError("a file of ids ends within a head")
        magic, crc, partition, number, docs, blocks, n_ids, before, size = HEAD.unpack_from(content, at)
        stop = at + HEAD.size + docs * 17 + blocks * 8 + size
        if magic != MAGIC or content[stop:stop + len(end)] != end:
            raise ValueError("not a segment of ids")
        if heads_only:
            yield partition, number, n_ids, before
        else:
            body = memoryview(content)[at + HEAD.size:stop]
            if zlib.crc32(body) != crc:
                raise ValueError(f"segment {number} of partition {partition} is damaged")
            ids, null = np.frombuffer(body, "<i8", docs), np.frombuffer(body, np.uint8, docs, docs * 8)
            yield Segment(partition, number, before, [None if n else i for i, n in zip(ids.tolist(), null.tolist())],
                          np.frombuffer(body, "<u8", docs, docs * 9), np.frombuffer(body, "<u8", blocks, docs * 17),
                          np.frombuffer(body, np.uint8, size, docs * 17 + blocks * 8))
        at = stop + len(end)


# Encoding


class Encoder:
    """Ids of whole texts by the tokenizers library, with memos of the parts between ASCII white space.

    Where white space is normalised to a space and dropped, no token spans it, so parts encode on their own. This is
    checked from the definition (``_SHAPE``); with any other definition whole texts go to the library. Latin words leave
    their part's outer punctuation, which makes pieces of its own beside a letter or digit, and are encoded many at a
    time by the library without its normaliser: below U+0250 composition changes nothing, and lower case goes letter by
    letter. Other parts, and those with special tokens, go through the library as they are. The memos only save time: two
    generations of ``entries`` parts and twice as many words; long ones stay outside.
    """

    def __init__(self, definition: str, entries: int = 200_000, longest: int = 48):
        self.library = Tokenizer.from_str(definition)
        self.entries, self.longest = entries, longest
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {"": b""}
        read = json.loads(definition)
        mark = self.library.encode(MARK, add_special_tokens=False).ids
        self.by_part = _shape(read) == _SHAPE and len(mark) == 1 and all(t["content"].startswith("<|") for t in read["added_tokens"])
        if self.by_part:
            self.mark = mark[0]
            self.special = [t["content"].lower() for t in read["added_tokens"]]
            self.tokenize = self.library.model.tokenize
            byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.letters = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(LATIN) if chr(c).isalpha()}
            self.bare = Tokenizer.from_str(json.dumps(read | {"normalizer": None, "added_tokens": []}))

    def _spell(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case Latin words.

        Letters alone are one piece, which the library's model takes. Of the others, runs with a mark behind each are
        encoded, and cut at its id.
        """
        flat, ends = [], []
        rest = []
        for word in words:
            if word.isalpha():
                flat += [t.id for t in self.tokenize(word if word.isascii() else word.translate(self.letters))]
            else:
                rest.append(word)
            ends.append(len(flat))
        data, at, out = np.array(flat, dtype="<u4").tobytes(), 0, []
        for end in ends:
            out.append(data[4 * at:4 * end])
            at = end
        found = []
        for run in self.bare.encode_batch_fast([f" {MARK} ".join([*own, ""]) for own in batched(rest, 50)], add_special_tokens=False):
            ids = np.array(run.ids, dtype="<u4")
            data, at = ids.tobytes(), 0
            for cut in np.flatnonzero(ids == self.mark).tolist():
                found.append(data[4 * at:4 * cut])
                at = cut + 1
        more = iter(found)
        return [ids if word.isalpha() else next(more) for word, ids in zip(words, out)]

    def _latin(self, text: str) -> bool:
        return text.isprintable() and (text.isascii() or ord(max(text)) < LATIN) and not any(t in text for t in self.special)

    def _learn(self, parts: list[bytes]) -> None:
        """Put the ids of new parts into the memo."""
        texts = [str(p, "utf-8", "replace") for p in parts]
        low = "\t".join(texts).lower().split("\t")  # parts hold no white space
        if not self._latin("".join(low)):
            latin = list(map(self._latin, low))
            whole = [i for i, own in enumerate(latin) if not own]
            for i, ids in zip(whole, self.library.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)):
                self.memo[parts[i]] = np.array(ids.ids, dtype="<u4").tobytes()
            parts, low = list(compress(parts, latin)), list(compress(low, latin))
        cores = [t.strip(OUTER) for t in low]
        words, outer = self.words, []
        for i, (text, core) in enumerate(zip(low, cores)):
            if core != text:
                if core and core[0].isalnum() and core[-1].isalnum():
                    at = text.index(core)
                    outer.append((i, text[:at], text[at + len(core):]))
                else:
                    cores[i] = text
        new = list({w for w in cores if w not in words}.union(w for _, *both in outer for w in both if w not in words))
        words.update(zip(new, self._spell(new)))
        self.memo.update(zip(parts, map(words.__getitem__, cores)))
        for i, before, behind in outer:
            self.memo[parts[i]] = words[before] + self.memo[parts[i]] + words[behind]
        for word in new:
            if len(word) > self.longest:
                del words[word]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """For each text (UTF-8) its ids as little-endian unsigned 32-bit numbers."""
        if not self.by_part:
            found = self.library.encode_batch([str(t, "utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.array(e.ids, dtype="<u4").tobytes() for e in found]
        if len(self.memo) > self.entries:
            self.memo, self.older = {}, self.memo
        if len(self.words) > 2 * self.entries:
            self.words = {"": b""}
        # Lower case first makes for fewer parts; only where no letter composes with a mark and no special token is near.
        split = [(t if BEYOND.search(t) else t.lower()).split() for t in texts]
        memo, older = self.memo, self.older
        new = set().union(*split).difference(memo)
        memo.update((p, older[p]) for p in new if p in older)
        new = [p for p in new if p not in memo]
        self._learn(new)
        out = [b"".join(map(memo.__getitem__, parts)) for parts in split]
        for part in new:
            if len(part) > self.longest:
                del memo[part]
        return out


#: Stands between words that are encoded together; it is no Latin character.
MARK = "\u2665"
#: Bytes of characters from U+0240 on, and what special tokens begin with.
BEYOND = re.compile(rb"[\xc9-\xff]|<\|")
#: ASCII punctuation without the apostrophe, which begins pieces such as 's.
OUTER = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters below this have no composed or decomposed twin among themselves.
LATIN = 0x250
#: What a definition must hold for parts to encode on their own.
_SHAPE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "truncation": None, "padding": None}


def _shape(read: dict) -> dict:
    return {k: read.get(k) for k in _SHAPE}


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str, definition: str) -> Encoder:
    """One encoder per worker and definition; workers are used for many tasks."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(definition)
    return _ENCODERS[name]


# Tables


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, id_col: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append ``end_id`` to it and write the ids of all documents in ascending order of their id.

    Ids of documents are whole numbers; null ids come first, rows of one id follow by the hash of their text, equal rows
    in any order (they are the same). A null text is empty and holds the end id alone. Other columns are not read. An empty table
    makes a folder without segments. Rows go to ranges of (id, hash, seeded number), so that many rows of one id are
    split too. ``tokenizer`` is a definition file that the driver reads; its size is that of a vocabulary.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    shared, name = spark.sparkContext.broadcast(definition), hashlib.sha256(definition.encode()).hexdigest()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(f"`{text}`", F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("salt", F.rand(12))
    rows = rows.repartitionByRange("id", "h", "salt").sortWithinPartitions(F.col("id").asc_nulls_first(), "h")
    last = struct.pack("<I", end_id)

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        encoder = _encoder(name, shared.value)
        partition = TaskContext.get().partitionId()
        number, before, held, doc_ids, parts = 0, 0, 0, [], []
        for whole in batches:
            for batch in _slices(whole):
                own = encoder.encode(batch.column("text").to_pylist())
                for doc_id, ids in zip(batch.column("id").to_pylist(), own):
                    doc_ids.append(doc_id)
                    parts.append(ids + last)
                    held += len(ids) // 4 + 1
                    if held >= SEGMENT:
                        yield _one(segment_bytes(partition, number, before, doc_ids, parts))
                        number, before, held, doc_ids, parts = number + 1, before + held, 0, [], []
        if parts:
            yield _one(segment_bytes(partition, number, before, doc_ids, parts))

    written = rows.select("id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "segment binary")
    # The text writer puts the bytes of a string as they are, and the separator behind each row.
    written.select(F.col("segment").cast("string").alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", SEGMENTS_PER_FILE).text(path)


def _one(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data], type=pa.binary())], names=["segment"])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``SLICE`` bytes of text, one row at least."""
    start, held = 0, 0
    for i, size in enumerate(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)):
        if i > start and held + size > SLICE:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def index(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment: partition, number, ids, and ids before it in its partition; from the heads alone."""
    ship_package(spark)

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = list(segments(content.as_py(), heads_only=True))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*rows)],
                                                     names=["partition", "number", "n_ids", "before"])

    return _files(spark, path).mapInArrow(run, "partition long, number long, n_ids long, before long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``.

    ``ids`` is binary: little-endian unsigned 32-bit numbers. The ids before a partition come from one sum per partition;
    there are no more of them than the write had partitions, which bounds the table that is broadcast.
    """
    ship_package(spark)

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                for segment in segments(content.as_py()):
                    ids = segment.ids()
                    ends = np.cumsum(segment.sizes.astype(np.int64))
                    starts = ends - segment.sizes.astype(np.int64)
                    for at in range(0, len(ends), 2_000):
                        own = slice(at, min(at + 2_000, len(ends)))
                        first, last = int(starts[own][0]), int(ends[own][-1])
                        offsets = 4 * (np.append(starts[own], last) - first).astype(np.int32)
                        data = pa.Array.from_buffers(pa.binary(), len(ends[own]), [
                            None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids[first:last].astype("<u4").tobytes())])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(ends[own]), segment.partition, dtype=np.int64)),
                             pa.array(segment.doc_ids[own], type=pa.int64()), pa.array(starts[own] + segment.before),
                             pa.array(segment.sizes[own].astype(np.int64)), data],
                            names=["partition", "doc_id", "start", "n_tokens", "ids"])

    totals = index(spark, path).groupBy("partition").agg(F.sum("n_ids").alias("n"))
    earlier = W.orderBy("partition").rowsBetween(W.unboundedPreceding, -1)  # one row per partition of the write
    base = totals.select("partition", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rows = _files(spark, path).mapInArrow(run, "partition long, doc_id long, start long, n_tokens long, ids binary")
    return rows.join(F.broadcast(base), "partition").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")
