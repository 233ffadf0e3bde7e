"""Perfect hashes and the audit of sources against a plain version."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from leadloom.llm import divergence, perfecthash

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=3, top=200):
    """``rows``: (text, lang, source)."""
    docs = [("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""), g or "", s or "") for t, g, s in rows]
    found = [(TERM.findall(t), g, s) for t, g, s in docs]
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for words, g, s in found:
        seen[g].update(set(words))
        counts[g, s].update(words)
    out = []
    for g in seen.keys() | {g for _, g, _ in docs}:
        kept = [w for w, n in seen[g].items() if n >= least]
        sources = sorted({s for _, x, s in docs if x == g}, key=str.encode)

        def p(own):
            total = sum(own[w] for w in kept)
            return {w: 1 + 10 ** 9 * (own[w] + 1) // (total + len(kept)) for w in kept}

        own = {s: p(counts[g, s]) for s in sources}
        q = p(sum((counts[g, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((own[s][w] - own[o][w]) ** 2 // own[o][w] for w in kept)) for o in sources if o != s]
            best = [(w, (own[s][w] - q[w]) ** 2 // q[w]) for w in kept if counts[g, s][w] > 0 and own[s][w] > q[w]]
            for part, items, limit in (("pair", pairs, None), ("term", best, top)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(g, s, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def ours(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], "text string, lang string, source string, value string").repartition(3)
    return sorted(map(tuple, divergence.audit(df, **more).collect()))


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Größe", "日本", "ÄB", "don't"]
    out = []
    for i in range(n):
        size = int(rng.integers(0, 40))
        own = rng.zipf(1.4, size=size) % len(words)
        out.append((" ".join(words[j] for j in own), ["en", "de", None][i % 3], f"s{rng.integers(0, 5)}"))
    return out


@pytest.mark.parametrize("more", [{}, {"shard": 7, "tile": 2}, {"shard": 5, "broadcast": 300}, {"top": 3}])
def test_equals_plain_version(spark, more):
    rows = texts(200)
    assert ours(spark, rows, **more) == plain(rows, top=more.get("top", 200))


def test_odd_rows(spark):
    rows = [(None, None, None), ("", "en", "a"), ("x y z", "en", None), ("x X x", "en", "b"), ("x", "en", "b"), ("x y", "en", "c"),
            ("123 !?", "fr", "a"), ("once only", "fr", "b"), ("solo", "it", "a"), ("solo", "it", "a"), ("solo", "it", "a"),
            ("long " * 50_000 + "y", "en", "a"), ("x y", "en", "c"), ("\u0080ÿ \x7f\x00a", "en", "c")]
    assert ours(spark, rows) == plain(rows)
    assert ours(spark, []) == []


def test_counters_and_slots_that_fill_up(spark, monkeypatch):
    rows = texts(150, seed=4)
    batches = [pa.RecordBatch.from_pydict({"lang": [r[1] or "" for r in rows], "source": [r[2] for r in rows],
                                           "text": [r[0].encode() for r in rows]})]
    whole = Counter()
    for g, s, own, n in divergence.tallies(batches):
        whole.update({(g, s, w): int(k) for w, k in zip(own, n)})
    monkeypatch.setattr(divergence, "ENTRIES", 20)
    parts, number = Counter(), 0
    for g, s, own, n in divergence.tallies(batches):
        number += 1
        parts.update({(g, s, w): int(k) for w, k in zip(own, n)})
    assert parts == whole and number > 15


def test_shares_are_exact():
    for count, total, kept in ((0, 0, 1), (5, 17, 3), (10 ** 13, 3 * 10 ** 13, 10 ** 8), (7, 9 * 10 ** 15 - 1, 1)):
        got = divergence.shares(np.array([count]), np.array([total]), kept)
        assert got.tolist() == [1 + 10 ** 9 * (count + 1) // (total + kept)]


@pytest.mark.parametrize("n", [0, 1, 2, 9, 2000])
def test_perfect_hash_is_minimal_and_verified(n):
    keys = [f"key-{i}".encode() * (1 + i % 3) for i in range(n)]
    levels, slots = perfecthash.build(keys)
    assert sorted(slots.tolist()) == list(range(n))
    stored = [keys[i] for i in np.argsort(slots)]
    table = perfecthash.Shards.load([levels, levels], pa.array(stored * 2, type=pa.binary()), np.array([n, n]))
    for shard in (0, 1):
        assert table.find(keys, np.full(n, shard)).tolist() == (slots + shard * n).tolist()
    other = [b"other-%d" % i for i in range(500)] + [b""]
    assert (table.find(other, np.zeros(len(other), dtype=np.int64)) == -1).all()


def test_equal_keys_are_refused():
    with pytest.raises(ValueError):
        perfecthash.build([b"a", b"a"])


def test_shard_hash_equals_spark(spark):
    from pyspark.sql import functions as F
    words = ["", "a", "word", "Größe", "日本" * 20, "x" * 100]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64(F.col("w").cast("binary")).alias("h")).collect()
    assert [r["h"] for r in rows] == perfecthash.shard_hash([w.encode() for w in words]).view(np.int64).tolist()
