"""Near duplicates against all pairs, and the odd cases."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from leadloom.llm import minmax, shingles as words_of
from leadloom.llm.common import SLOTS, has_bit
from leadloom.llm.minmax import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n long, component_id string"


def shingles(text, k=2):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def made(seed, n):
    draw = random.Random(seed)
    words = ["w%d" % i for i in range(300)] + ["É", "Zwölf", " x"]
    base = [" ".join(draw.choices(words, k=draw.randint(1, 120))) for _ in range(n // 6)]
    rows = []
    for i in range(n):
        text = draw.choice(base).split(" ")
        for _ in range(draw.choice([0, 0, 1, 2, 4, 8])):
            text[draw.randrange(len(text))] = draw.choice(words)
        sep = draw.choice([" ", "\n", "\t ", "\x0b"])
        text = sep.join(text)
        rows.append((i * 3 + 1, text.upper() if draw.random() < 0.1 else text))
    return rows


def result(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", __import__("pyspark").sql.functions.lit(1))
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()}


def test_equals_all_pairs(spark):
    rows = made(1, 400) + [(5000, ""), (5002, None), (5003, " \t\n"), (5004, "one"), (5005, "ONE"), (5006, "one two")]
    # A large group of near copies whose members are often not alike themselves.
    draw = random.Random(3)
    base = ["b%d" % i for i in range(60)]
    for i in range(150):
        text = list(base)
        for j in draw.sample(range(60), 3):
            text[j] = "x%d" % draw.randrange(1000)
        rows.append((7000 + i, " ".join(text)))
    assert result(spark, rows) == brute(rows)


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(None, "a b c d"), (None, "a b c d"), (None, "q r s"), (4, "a b c d"), (4, "a b c d"), (None, None), (None, "")],
        "doc_id long, text string")
    rows = sorted(map(tuple, near_duplicates(df).collect()), key=repr)
    assert rows == sorted([(4, 3, 4, True)] * 2 + [(None, 3, 4, False)] * 2 + [(None, 2, None, True)]
                          + [(None, 0, None, True)] * 2, key=repr)
    assert near_duplicates(df.limit(0)).count() == 0


def test_one_very_long_text(spark):
    text = " ".join(str(i % 50_000) for i in range(400_000))
    rows = [(1, text), (2, text + " end"), (3, "x" * 3_000_000), (4, "x" * 3_000_000 + " y")]
    got = result(spark, rows)
    assert got[1][1:] == (1, True) and got[2][1:] == (1, False)
    assert got[3] == (1, 3, True) and got[4] == (1, 4, True)


def test_links_are_confirmed_on_packed_sets():
    one, two, far = " ".join("abcdefghi"), " ".join("abcdefgh"), " ".join("abcxefghi")
    ids = pa.array(range(4), pa.int64())
    batch = pa.RecordBatch.from_pydict({"rid": ids, "doc_id": ids, "text": [one, two, far, None]})
    sets = minmax._rows(batch, 1, True)
    assert sets.column("items").type == pa.binary() and len(sets.column("items")[3].as_py()) == 0
    items = sets.column("items").to_pylist()
    pairs = pa.RecordBatch.from_pydict({"a": [0, 0, 1, 0], "b": [1, 2, 2, 0], "x": [items[i] for i in (0, 0, 1, 0)],
                                        "y": [items[i] for i in (1, 2, 2, 0)]})
    # 8 of 9, 8 of 10 and 7 of 10 items are common.
    assert minmax._overlaps(pairs, 80).to_pydict() == {"a": [0, 0, 0], "b": [1, 2, 0]}
    assert minmax._overlaps(pairs, 81).to_pydict() == {"a": [0, 0], "b": [1, 0]}


def test_rows_of_a_batch_are_those_of_its_texts():
    draw = random.Random(5)
    texts = [" ".join(str(draw.randrange(2000)) for _ in range(n)) for n in (0, 1, 3, 700, 0, 1500, 40)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_pydict({"rid": ids, "doc_id": ids, "text": texts})
    whole = minmax._rows(batch, 2, False).to_pylist()
    assert whole == [minmax._rows(batch.slice(i, 1), 2, False).to_pylist()[0] for i in range(len(texts))]
    assert [len(r["bands"]) for r in whole] == [minmax.BANDS * bool(t) for t in texts]


def test_words_do_not_depend_on_blocks(monkeypatch):
    draw = random.Random(6)
    blob = " ".join("w" * draw.choice([1, 3, 5, 300, 900]) + draw.choice(["", "\t ", "\n\n"]) for _ in range(300)).encode()
    whole = words_of.word_spans(blob)
    assert whole[0].tolist() == [m.start() for m in re.finditer(rb"w+", blob)]
    for block in (1, 7, 256, 1000):
        monkeypatch.setattr(words_of, "BLOCK", block)
        assert all((a == b).all() for a, b in zip(words_of.word_spans(blob), whole))
    for part, items in zip(blob.split(b"\n"), words_of.shingle_sets(blob.split(b"\n"), 2)):
        assert items.tolist() == np.unique(items).tolist() == words_of.shingle_sets([part.decode()], 2)[0].tolist()


def test_only_keys_with_a_bit_are_met():
    keys = np.array([5, -7, 5 + SLOTS, 9, -7], dtype=np.int64)
    bits = np.zeros(SLOTS // 8, dtype=np.uint8)
    for key in (5, -7):
        bits[(key & (SLOTS - 1)) >> 3] |= 1 << (key & 7)
    assert has_bit(bits, keys).tolist() == [True, True, True, False, True]
    lists = pa.ListArray.from_arrays(pa.array([0, 2, 2, 5], pa.int32()), pa.array(keys))
    batch = pa.RecordBatch.from_arrays([pa.array([10, 11, 12]), lists], names=["cid", "bands"])
    for part, cids in ((batch, [10, 10, 12, 12]), (batch.slice(1), [12, 12])):
        met = minmax._met(part, bits).to_pydict()
        assert met["cid"] == cids and met["key"] == [5, -7, 5 + SLOTS, -7][-len(cids):]
