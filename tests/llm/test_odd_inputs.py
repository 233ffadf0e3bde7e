"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator on texts."""

from __future__ import annotations

import collections

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from leadloom.llm import bytebpe, langmix, merkle, mixing, punlearn, rollups, templates
from leadloom.session import cut_lineage, fresh_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def documents(spark, extra=()):
    rows = [(1, "The quick brown fox jumps over the lazy dog.\nIt was the best of times.", "en", "a"),
            (2, "Der schnelle braune Fuchs springt. Über den faulen Hund und die Straße.", "de", "b"),
            (3, None, "en", "a"), (4, "", None, None), (None, "no id here at all", None, "c"), (None, None, None, None),
            (5, " \t\n ", "de", "b"), (5, " \t\n ", "de", "b"), (6, "12 34 ... !!!", "en", "a"),
            (7, "x" * 200_000 + " " + "lang " * 50_000, "en", "a"), (8, "漢字🙂 \x0b é", "fr", None)]
    rows += list(extra)
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], SCHEMA)


def clashing(df, *names):
    for name in names:
        df = df.withColumn(name, F.lit("clash"))
    return df


def encoding():
    ranks = bytebpe.load_ranks(open(PATH, "rb").read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_codec_equals_the_library(spark):
    df = clashing(documents(spark), "IDS", "decoded", "size")
    rows = bytebpe.decode(bytebpe.encode(df, PATH, public_tokenizers.PATTERN), PATH)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "ids", "decoded"]
    own = encoding()
    got = rows.collect()
    assert len(got) == 11
    for row in got:
        assert row["ids"] == own.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]).decode() == (row["text"] or "")
    assert bytebpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_codec_on_drawn_pieces():
    import random
    draw, own = random.Random(3), encoding()
    codec = bytebpe.Codec(bytebpe.load_ranks(open(PATH, "rb").read()), public_tokenizers.PATTERN)
    letters = "abcdehinorstuàéßñ漢字🙂 '\n\t0159!?-_"
    for _ in range(3000):
        text = "".join(draw.choices(letters, k=draw.randint(0, 60)))
        assert list(codec.encode(text)) == own.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()
    before, bytebpe.LONG = bytebpe.LONG, 10
    try:
        assert list(codec.encode("the quick brown fox " * 9)) == own.encode_ordinary("the quick brown fox " * 9)
    finally:
        bytebpe.LONG = before


def test_language_of_odd_texts(spark):
    df = clashing(documents(spark), "SCORE", "lang_pred")
    got = langmix.predict(df, langmix.fit(df)).collect()
    assert len(got) == 11
    for row in got:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not letters) and 0 <= row["score"] <= 1
    found = {row["doc_id"]: row["lang_pred"] for row in got}
    assert found[1] == "en" and found[2] == "de"
    assert {r["lang_pred"] for r in langmix.predict(df, langmix.fit(df.limit(0))).collect()} == {"und"}
    assert langmix.predict(df.limit(0), langmix.fit(df)).count() == 0


def test_mixed_text_has_both_languages():
    counts = collections.Counter()
    english, german = "the cat and the dog went to the house ", "der hund und die katze gehen in das haus "
    slots = {name: langmix.grams([text * 50])[0] for name, text in (("de", german), ("en", english))}
    import numpy as np
    table = np.stack([np.bincount(slots[n], minlength=langmix.SLOTS) for n in ("de", "en")], axis=1) + 0.5
    model = {"langs": ["de", "en"], "likelihood": (table / table.sum(axis=0)).astype("float32"), "prior": np.array([0.5, 0.5])}
    pred, score = langmix.infer([english * 6 + german * 2, german * 6, english + "123"], model)
    assert pred == ["en", "de", "en"] and 0.6 < score[0] < 0.9 and score[1] > 0.99
    counts.update(pred)


def test_mix_meets_targets_to_the_word(spark):
    extra = [(100 + i, "w " * (i % 17), "en", "abcdefg"[i % 7] if i % 3 else "a") for i in range(400)]
    df = clashing(documents(spark, extra).filter("doc_id is null or doc_id <> 7"), "size", "bucket", "key", "h")
    rows = mixing.plan(df, [5.0, 2.0, 1.0], rows_per_bucket=20, keep=["source"]).collect()
    assert len(rows) == df.count()
    taken, sizes = collections.Counter(), collections.Counter()
    for r in rows:
        key = (r["source"], r["source_size"], r["target"])
        taken[key] += r["taken"]
        sizes[key] += r["size"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == sum(p["words"] for p in r["pieces"])
        assert all(0 <= p["position"] <= 1 for p in r["pieces"])
    for (_, size, target), words in taken.items():
        assert abs(words - target) <= 1 and target <= 3 * size + 1e-9
    assert sum(t for _, _, t in taken) == pytest.approx(sum(sizes.values()), abs=1e-6)
    again = mixing.plan(df.repartition(5), [5.0, 2.0, 1.0], rows_per_bucket=20, keep=["source"]).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert mixing.plan(df.limit(0), [1.0]).count() == 0


def test_mix_gives_copies_in_order(spark):
    df = clashing(documents(spark), "mix_copy").unionByName(clashing(documents(spark), "mix_copy"))
    out = mixing.mix(df, [5.0, 2.0, 1.0], tilt=0.5)
    assert out.columns == [*df.drop("mix_copy").columns, "mix_copy", "mix_position", "mix_words"]
    rows = out.collect()
    assert [r["mix_position"] for r in rows] == sorted(r["mix_position"] for r in rows)
    planned = mixing.plan(df, [5.0, 2.0, 1.0], tilt=0.5).collect()
    assert len(rows) == sum(len(r["pieces"]) for r in planned)
    assert sum(r["mix_words"] for r in rows) == sum(r["taken"] for r in planned)


def test_a_tilt_moves_a_source_to_the_start(spark):
    df = spark.createDataFrame([(i, "a b c d", "en", "ab"[i % 2], 7) for i in range(400)], SCHEMA)
    rows = mixing.mix(df, [1.0], tilt=0.9).collect()
    early = collections.Counter(r["source"] for r in rows if r["mix_position"] < 0.3)
    late = collections.Counter(r["source"] for r in rows if r["mix_position"] > 0.7)
    assert early["a"] > 1.5 * early["b"] and late["b"] > 1.5 * late["a"]


def test_merkle_of_odd_texts(spark):
    df = clashing(documents(spark), "text2", "bucket", "h")
    rows = merkle.fingerprints(df).collect()
    assert len(rows) == 11
    for r in rows:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    one = merkle.fingerprints(df.filter("doc_id = 1")).first()
    assert one["near_next"] == 1.0
    assert merkle.fingerprints(df.limit(0)).count() == 0


def test_merkle_branches_locate_an_edit(spark):
    lines = [f"line {i} holds some words, and then a few more." for i in range(40)]
    changed = list(lines)
    changed[17] = "something else stands here now."
    df = spark.createDataFrame([("\n".join(lines), "\n".join(changed))], "a string, b string")
    marks = [merkle.fingerprint(merkle.tree(F.col(c))) for c in ("a", "b")]
    row = df.select(merkle.edited_paragraphs(*marks).alias("at"), merkle.edited_paragraphs(marks[0], marks[0]).alias("none"),
                    merkle.likeness(*marks).alias("near")).first()
    assert row["at"] == [17] and row["none"] == [] and 0.9 < row["near"] < 1


def plain_templates(texts):
    """The rule of the template tree in plain Python."""
    import re
    word = re.compile(r"[^\x20\x09-\x0D]+")
    lines, sizes = [], {}
    for tid, text in enumerate(sorted({t for t in texts if t is not None})):
        sizes[tid] = len(word.findall(text))
        for pos, line in enumerate(text.split("\n")):
            toks = ["*" if re.search("[0-9]", w) else w for w in word.findall(line)]
            if toks:
                lines.append((tid, pos, line, toks, (len(toks), *toks[:templates.DEPTH])))
    reached = collections.defaultdict(set)
    for tid, _, _, _, leaf in lines:
        reached[leaf].add(tid)
    lines = [x for x in lines if len(reached[x[4]]) > 1]
    total, seen = collections.Counter(), collections.Counter()
    for _, _, _, toks, leaf in lines:
        total[leaf] += 1
        seen.update((leaf, i, t) for i, t in enumerate(toks))
    keyed = []
    for tid, pos, line, toks, leaf in lines:
        general = tuple(t if t != "*" and seen[leaf, i, t] >= templates.CONSTANT * total[leaf] else "*" for i, t in enumerate(toks))
        keys = [("line", line)]
        if sum(t != "*" for t in general) >= templates.KEPT * len(toks):
            keys.append(("template", leaf, general))
        keyed.append((tid, pos, len(toks), keys))
    owners = collections.defaultdict(set)
    for tid, _, _, keys in keyed:
        for key in keys:
            owners[key].add(tid)
    again = collections.Counter()
    for tid, _, n, keys in keyed:
        if any(len(owners[k]) > 1 for k in keys):
            again[tid] += n
    support, length = collections.defaultdict(set), {}
    for tid, _, n, keys in keyed:
        for key in keys:
            if len(owners[key]) > 1 and again[tid] <= templates.RECURRING * sizes[tid]:
                support[key].add(tid)
                length[key] = n
    drop = {k for k, t in support.items() if len(t) >= max(2, -(-templates.NEED // length[k]))}
    names = dict(enumerate(sorted({t for t in texts if t is not None})))
    return {(names[tid], pos) for tid, pos, _, keys in keyed if any(k in drop for k in keys)}


def test_templates_equal_the_plain_rule(spark):
    import random
    draw = random.Random(9)
    words = ["w%s" % c for c in "abcdefghijklmnopqrstuvwxyz"]
    passage = " ".join(draw.choices(words, k=60))
    texts = []
    for i in range(120):
        lines = [" ".join(draw.choices(words, k=draw.randint(1, 25))) for _ in range(12 if i % 40 == 1 else draw.randint(1, 8))]
        if i % 3 == 0:
            lines.insert(draw.randint(0, len(lines)), f"page {draw.randint(1, 99)} of the annual report of {draw.choice(words)} and its many friends")
        if i % 40 == 1:
            lines.append(passage)
        texts.append("\n".join(lines))
    texts += [texts[5]] * 30 + [texts[7].replace("wa", "zz", 1) for _ in range(5)] + [None, "", "\n\n", "one"]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    lost = plain_templates(texts)
    assert len(lost) > 30 and any(passage == t.split("\n")[p] for t, p in lost)
    got = templates.drop_recurring(clashing(df, "N_dropped", "pos", "tid", "line"), dropped="n_dropped").collect()
    assert len(got) == len(texts)
    for row in got:
        text = texts[row["doc_id"]]
        if text is None:
            assert row["text"] is None and row["n_dropped"] == 0
            continue
        lines = text.split("\n")
        assert row["text"] == "\n".join(x for p, x in enumerate(lines) if (text, p) not in lost)
        assert row["n_dropped"] == sum((text, p) in lost for p in range(len(lines)))
    assert templates.drop_recurring(df.limit(0)).count() == 0


def test_quality_of_odd_texts(spark):
    good = [(100 + i, f"plain words of text number {i}, written with care. And more of it.", "en", "a") for i in range(60)]
    bad = [(200 + i, "&&& ### | | | !!! %%% " * (3 + i % 5), "en", "a") for i in range(20)]
    df = clashing(documents(spark, [*good, *bad]), "features", "score", "mark")
    labels = spark.createDataFrame([(100 + i, 1) for i in range(0, 60, 2)] + [(200 + i, 0) for i in range(8)] + [(None, 1), (100, None), (102, 0), (102, 1)],
                                   "doc_id long, quality int")
    rows = punlearn.quality(df, labels, lambda i: F.coalesce(i % 5 != 1, F.lit(True))).collect()
    assert len(rows) == df.count() and all(0 <= r["score"] <= 1 for r in rows)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert min(score[100 + i] for i in range(60)) > max(score[200 + i] for i in range(20))
    none = punlearn.quality(df, labels.limit(0), lambda i: F.lit(True)).collect()
    assert {round(r["score"], 6) for r in none} == {0.5}
    assert punlearn.quality(df.limit(0), labels, lambda i: F.lit(True)).count() == 0


def test_rollup_adds_takes_back_and_ignores_a_batch_sent_again(spark):
    kind = "struct<source:string,lang:string,tokenizer:string,tokens:bigint>"
    schema = f"op string, old {kind}, new {kind}"
    roll = rollups.Rollup(spark, fresh_path(spark, "rollup-test"))
    assert roll.version() == 0 and roll.batches() == [] and roll.totals().count() == 0
    first = spark.createDataFrame([("insert", None, ("a", "en", "t", 10)), ("insert", None, ("a", "en", "t", 5)),
                                   ("insert", None, (None, None, "t", None))], schema)
    second = spark.createDataFrame([("revise", ("a", "en", "t", 5), ("b", "en", "t", 7)), ("delete", (None, None, "t", None), None)], schema)
    assert roll.commit("one", first) and roll.commit("two", second)
    assert not roll.commit("two", second) and not roll.commit("one", first)
    assert {tuple(r) for r in roll.totals().collect()} == {("a", "en", "t", 1, 10), ("b", "en", "t", 1, 7)}
    assert roll.batches() == ["one", "two"] and roll.commit("three", first.limit(0)) and roll.version() == 3
    assert rollups.Rollup(spark, roll.path).batches() == ["one", "two", "three"]
    with pytest.raises(Exception, match="unknown change"):
        roll.commit("four", spark.createDataFrame([("move", None, None)], schema))


def test_stages_on_odd_rows(spark):
    extra = [(300 + i, f"The cat number {i} went to the house and sat there for a very long time, looking at birds.", "en", "a") for i in range(5)]
    df = clashing(documents(spark, extra), "ids", "__note", "n")
    docs = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, ""))
        assert docs.columns == df.columns
        kept = [r["text"] for r in docs.collect()]
        if name == "language ID":
            assert None not in kept and "" not in kept and len([t for t in kept if t.startswith("The cat")]) == 5
        if name == "near dedup":
            assert len(kept) == len(set(kept))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert last and all(r["exact"] and r["n_tokens"] == len(r["ids"]) for r in last)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.limit(0), "").count() == 0
