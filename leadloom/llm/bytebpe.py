"""Byte-level BPE: encoding and decoding with a file of ranks.

A text is cut by a pattern and every piece is encoded on its own. The bytes of a piece are read as Latin-1 characters,
and an Aho-Corasick automaton over all tokens lists the tokens that end at each byte, longest first. Of these, the last
token of the encoded prefix is the first one that may follow the last token before it. Whether two tokens may stand
side by side (merging their joint bytes gives back just these two) is looked up in a memo. Walking back from the end of the piece gives the
tokens. The work grows with the length of the piece, and the result is that of the merges.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import batched, chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.common import held, ship_package

#: Entries a memo may hold before it starts anew; they only save time.
PIECES, PAIRS = 300_000, 300_000
#: Characters of a text beyond which its pieces are taken in blocks.
LONG = 1_000_000


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def merge(data: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[bytes]:
    """The merges themselves, by definition: join the neighbours of least rank, the first ones first.

    They end when ``stop`` parts are left or nothing can be joined.
    """
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > stop:
        best = min(((ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks),
                   default=None)
        if best is None:
            break
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


class _Memo(dict):
    """Results of a function; emptied when it holds ``most`` of them."""

    def __init__(self, find, most: int):
        super().__init__()
        self.find, self.most = find, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = value = self.find(key)
        return value


class Codec:
    """Encoder and decoder for one vocabulary and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pairs = _Memo(self._compatible, PAIRS)
        self.pieces = _Memo(self._encode_piece, PIECES)
        # The last two parts of a token; a token that merges don't build only ever stands for a whole piece.
        self.halves = {token: tuple(parts) for token in ranks
                       if len(token) > 1 and len(parts := merge(token, ranks, 2)) == 2}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) == 1 or token in self.halves:
                self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.edges = _Memo(self._edge, PAIRS)

    def _edge(self, key: tuple[int, int]) -> list[tuple[bytes, float]]:
        """What stands at one edge (0 left, 1 right) of a token while it is merged, and the rank that ends it."""
        part, side = self.bytes_of[key[0]], key[1]
        found = [(part, float("inf"))]
        while part in self.halves:
            rank, part = self.ranks[part], self.halves[part][side]
            found.append((part, rank))
        return found[::-1]

    def _compatible(self, pair: int) -> bool:
        """Whether no merge ever crosses the border of two tokens; of equal ranks the merge further left comes first."""
        left, right = self.edges[pair >> 32, 1], self.edges[pair & 0xFFFFFFFF, 0]
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            across = self.ranks.get(x + y)
            if across is not None and across < x_ends and across <= y_ends:
                return False
            if i == len(left) - 1 and j == len(right) - 1:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def _encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        # last[e]: the last token of the encoding of the first e bytes, and where that token starts.
        last, start, pairs = [-1] * (len(data) + 1), [0] * (len(data) + 1), self.pairs
        for end, (rank, size) in self.automaton.iter(data.decode("latin-1")):
            end += 1
            if last[end] < 0:
                begin = end - size
                if begin == 0 or (last[begin] >= 0 and pairs[last[begin] << 32 | rank]):
                    last[end], start[end] = rank, begin
        at, ids = len(data), []
        while at > 0:
            if last[at] < 0:
                raise ValueError(f"the vocabulary does not cover the bytes of {piece!r}")
            ids.append(last[at])
            at = start[at]
        return tuple(reversed(ids))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; none for null and for the empty text."""
        if not text:
            return np.empty(0, dtype=np.int32)
        pieces = self.pieces
        if len(text) <= LONG:
            return np.fromiter(chain.from_iterable(map(pieces.__getitem__, self.pattern.findall(text))), dtype=np.int32)
        return np.concatenate([
            np.fromiter(chain.from_iterable(pieces[m.group()] for m in block), dtype=np.int32)
            for block in batched(self.pattern.finditer(text), 100_000)])

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Decoder:
    """The decoding half alone."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bytes_of = {rank: token for token, rank in ranks.items()}

    decode = Codec.decode


def _codec(kind: type, data: bytes, digest: str, pattern: str) -> Codec | Decoder:
    """One codec per worker and vocabulary; workers are used for many tasks."""
    kept, key = held("bytebpe"), (kind, digest, pattern)
    if key not in kept:
        kept.clear()
        kept[key] = kind(load_ranks(data), pattern)
    return kept[key]


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The file of ranks, whose size is that of a vocabulary (under 10 MB), read once by the driver."""
    with open(path, "rb") as file:
        return file.read()


def _list(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))


def _slices(batch: pa.RecordBatch, chars: int, text: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``chars`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > chars:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def _added(df: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    """``df`` without a column of that name, and its schema with the new one at the end."""
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()])
    return df, T.StructType([*df.schema.fields, T.StructField(name, kind)])


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``, the array of token ids of every whole text.

    Null and empty texts have an empty array. A column already called ``out`` is replaced; all others stay, with as
    many rows as came in (equal rows have equal ids). Special tokens are plain text. Long texts are cut into pieces block by block.
    """
    ship_package(df.sparkSession)
    data = read_ranks(df.sparkSession, path)
    shared = df.sparkSession.sparkContext.broadcast(data)  # size of a vocabulary file
    digest = hashlib.sha256(data).hexdigest()
    df, schema = _added(df, out, T.ArrayType(T.IntegerType()))

    def run(batches):
        codec = _codec(Codec, shared.value, digest, pattern)
        for whole in batches:
            for batch in _slices(whole, 2_000_000, text):
                ids = _list([codec.encode(t) for t in batch.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the bytes that an array of token ids stands for; none for a null or empty array."""
    ship_package(df.sparkSession)
    data = read_ranks(df.sparkSession, path)
    shared = df.sparkSession.sparkContext.broadcast(data)  # size of a vocabulary file
    digest = hashlib.sha256(data).hexdigest()
    df, schema = _added(df, out, T.BinaryType())

    def run(batches):
        codec = _codec(Decoder, shared.value, digest, "")
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                parts = [codec.decode(row.values.to_numpy().tolist()) if row.is_valid else b"" for row in batch.column(ids)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, type=pa.binary())],
                                                 names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)
