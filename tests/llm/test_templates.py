"""Who votes for a template."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from leadloom.llm import templates
from leadloom.llm.common import SLOTS
from leadloom.llm.templates import drop_recurring


def words(draw, n):
    return " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n))


def left(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in drop_recurring(df).orderBy("doc_id").collect()]


def test_a_passage_that_makes_up_most_of_its_texts_is_dropped(spark):
    draw = random.Random(1)
    passage = words(draw, 60)
    own = [(words(draw, 20), words(draw, 20)) for _ in range(4)]
    assert left(spark, [f"{a}\n{passage}\n{b}" for a, b in own]) == [f"{a}\n{b}" for a, b in own]


def test_texts_of_template_lines_only_are_emptied(spark):
    draw = random.Random(2)
    kinds = [words(draw, 7).split(" ") for _ in range(3)]
    texts = ["\n".join(" ".join([*k[:4], str(draw.randrange(10**6)), *k[4:], str(draw.randrange(10**6))]) for k in kinds)
             for _ in range(30)]
    assert left(spark, texts) == [""] * 30


def test_twins_with_a_small_edit_have_one_vote_together(spark):
    draw = random.Random(3)
    passage = words(draw, 60)
    pages = ["\n".join(words(draw, 60) for _ in range(3)) for _ in range(3)]
    twins = [p for page in pages for p in (page, page + " edited")]
    assert left(spark, [f"{t}\n{passage}" for t in twins]) == twins


def test_passages_wrapped_over_lines_need_two_votes(spark):
    draw = random.Random(4)
    thin, wide, short = ([words(draw, n) for _ in range(k)] for n, k in ((10, 6), (25, 3), (10, 4)))
    texts, rest = [], []
    for own, lines in ((0, thin), (1, thin), (2, wide), (3, wide), (4, short), (5, short)):
        before, after = words(draw, 90), words(draw, 90)
        middle = "\n\n".join(lines) if own == 1 else "\n".join(lines)
        texts.append(f"{before}\n{middle}\n{after}")
        rest.append(texts[-1] if lines is short else f"{before}\n" + "\n" * (own == 1) * (len(lines) - 1) + after)
    assert left(spark, texts) == rest


def test_lines_of_a_passage_in_another_order_are_no_passage(spark):
    draw = random.Random(5)
    lines = [words(draw, 10) for _ in range(6)]
    texts = [f"{words(draw, 90)}\n" + "\n".join(order) for order in (lines, lines[::-1])]
    assert left(spark, texts) == texts


def test_large_leaves_give_what_small_ones_give(spark, monkeypatch):
    draw = random.Random(6)
    kinds = [words(draw, 9).split(" ") for _ in range(4)]
    texts = ["\n".join(" ".join([*k[:4], draw.choice("abc"), *k[4:], str(draw.randrange(99))]) for k in draw.sample(kinds, 3))
             + "\n" + words(draw, 30) for _ in range(40)]
    small = left(spark, texts)
    assert small != texts and all(small)
    monkeypatch.setattr(templates, "LEAF", 0)
    assert left(spark, texts) == small


def test_columns_named_like_working_ones_and_long_texts_stay(spark):
    draw = random.Random(7)
    line = words(draw, 50)
    own = [words(draw, 30) for _ in range(3)]
    long = "\n".join([line, *own] * 3000)
    rows = [(1, long, "x", [1], 7), (2, f"{line}\n{words(draw, 90)}", "y", None, 8), (3, None, "z", [], 9)]
    df = spark.createDataFrame(rows, "doc_id long, `a.text` string, tid string, lost array<int>, `__lost` int")
    got = drop_recurring(df, "a.text", dropped="gone").orderBy("doc_id").collect()
    assert got[0].asDict() == {"doc_id": 1, "a.text": "\n".join(own * 3000), "tid": "x", "lost": [1], "__lost": 7, "gone": 3000}
    assert [(r["tid"], r["lost"], r["__lost"], r["gone"]) for r in got[1:]] == [("y", None, 8, 1), ("z", [], 9, 0)]


def test_only_leading_tokens_and_wanted_lines_are_hashed(monkeypatch):
    draw = random.Random(8)
    lines = ["", "one 2", *(words(draw, 40) for _ in range(50)), "  \t", f"{words(draw, 9)}\r"]
    texts = ["\n".join(lines), "", "\n".join(lines[::-1]), "ein wort"]
    batch = pa.RecordBatch.from_pydict({"tid": pa.array(range(4), pa.int64()), "text": texts})
    hashed, spans = [], templates.word_spans
    monkeypatch.setattr(templates, "word_spans", lambda blob: hashed.append(len(blob)) or spans(blob))
    first = templates._lines(batch, None).to_pydict()
    assert sum(hashed) < len("".join(texts)) / 8
    assert list(zip(first["tid"], first["n"])) == [(t, len(x.split())) for t, text in enumerate(texts)
                                                  for x in text.split("\n") if x.split()]
    hashed.clear()
    wanted = np.zeros(SLOTS // 8, dtype=np.uint8)
    slot = first["leaf"][7] & (SLOTS - 1)
    wanted[slot >> 3] |= 1 << (slot & 7)
    some = templates._lines(batch, wanted).to_pydict()
    assert sum(hashed) < len("".join(texts)) / 6
    at = len(texts[0].split("\n")) - 1 - 8
    assert (some["tid"], some["pos"], some["ord"]) == ([0, 2], [8, at], [7, at - 1])
    assert some["lh"][0] == some["lh"][1] and some["toks"][0] == some["toks"][1] and len(some["toks"][0]) == 40
    every = templates._lines(batch, ~np.zeros_like(wanted)).to_pydict()
    assert [every[c] for c in ("tid", "n", "leaf")] == [first[c] for c in ("tid", "n", "leaf")]
    assert every["lh"][7] == some["lh"][0] and every["toks"][0][1] == 0 and every["toks"][0][0] != 0
