"""Quality scores from trusted positives and unlabelled text.

A text is described by how its characters are made up: shares of character kinds and of pairs of kinds, repeated words and
lines. A logistic model is fitted by the non-negative risk of positive-unlabelled learning: with prior p, positives P
and unlabelled text U, it is ``p * E_P[loss(+)] + max(0, E_U[loss(-)] - p * E_P[loss(-)])``. Where the second part falls below
zero, the step goes against it. Every step is one pass over the stored features of all rows, summed inside the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.bytebpe import _slices
from leadloom.llm.common import ship_package
from leadloom.llm.shingles import word_hashes
from leadloom.session import cut_lineage

#: Kinds of bytes: each ASCII mark alone, then line feed, space, digit, upper, lower, other control, and above ASCII.
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_FINE = np.full(256, len(_MARKS) + 5, dtype=np.int64)
_COARSE = np.full(256, 1, dtype=np.int64)
for _i, _b in enumerate(_MARKS):
    _FINE[_b] = _i
    _COARSE[_b] = 2 if _b in b".,;:'\"" else 3 if _b in b"!?" else 4 if _b in b"-_/@" else 5
for _place, (_bytes, _kind) in enumerate(((b"\n", 0), (b" ", 6), (b"0123456789", 7),
                                          (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 8), (b"abcdefghijklmnopqrstuvwxyz", 9))):
    _FINE[list(_bytes)], _COARSE[list(_bytes)] = len(_MARKS) + _place, _kind
_FINE[128:], _COARSE[128:] = len(_MARKS) + 6, 9
N_FINE, N_COARSE, N_MORE = len(_MARKS) + 7, 10, 7
N_FEATURES = N_FINE + N_COARSE * N_COARSE + N_MORE
#: Standardised features are cut to this range, so that a rare mark cannot outweigh everything else.
CLIP = 3


def features(texts: list[str | None]) -> np.ndarray:
    """One row of ``N_FEATURES`` numbers per text, all between 0 and a few; null is the empty text, which gives zeros."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    blob = b"\n".join(parts) + b"\n"
    data = np.frombuffer(blob, dtype=np.uint8)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    owner = np.repeat(np.arange(len(parts)), sizes + 1)
    inside = np.ones(len(data), dtype=bool)
    inside[starts[1:] - 1] = False
    n = np.maximum(sizes, 1)[:, None]
    fine = np.bincount((owner * N_FINE + _FINE[data])[inside], minlength=len(parts) * N_FINE).reshape(-1, N_FINE) / n
    coarse = _COARSE[data]
    pair = inside[1:] & inside[:-1]
    codes = owner[1:] * N_COARSE**2 + coarse[:-1] * N_COARSE + coarse[1:]
    pairs = np.bincount(codes[pair], minlength=len(parts) * N_COARSE**2).reshape(-1, N_COARSE**2) / n
    at, words = word_hashes(blob)
    bounds = np.searchsorted(at, starts)
    line = np.cumsum(data == 10)[at] if len(at) else np.empty(0, dtype=np.int64)
    more = np.zeros((len(parts), N_MORE))
    for i in range(len(parts)):
        own = words[bounds[i]:bounds[i + 1]]
        if not len(own):
            continue
        again = own[1:] == own[:-1]
        lines, heads = np.unique(line[bounds[i]:bounds[i + 1]], return_index=True)
        sums = np.add.reduceat(own, heads)
        more[i] = (again.mean() if len(again) else 0.0, len(np.unique(own)) / len(own), again.any(),
                   1 - len(np.unique(sums)) / len(sums), np.log1p(len(own)) / 10, len(own) / max(sizes[i], 1),
                   len(lines) / len(own))
    return np.concatenate([np.sqrt(fine), np.sqrt(pairs), more], axis=1).astype(np.float32)


def _sums(table: DataFrame, work, width: int) -> np.ndarray:
    """Sum over all rows what ``work(values, positive)`` gives for a block; blocks are summed in their task first."""
    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            values = batch.column("features").flatten().to_numpy().reshape(-1, N_FEATURES).astype(np.float64)
            total += work(values, batch.column("positive").to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], names=["i", "v"])

    got = table.select("features", "positive").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v")).collect()
    out = np.zeros(width)
    for i, v in got:
        out[i] = v
    return out


def describe(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, features), written once; every whole text is read."""
    ship_package(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        for whole in batches:
            for batch in _slices(whole, 1_000_000, "text"):
                flat = features(batch.column("text").to_pylist())
                offsets = np.arange(len(flat) + 1, dtype=np.int32) * N_FEATURES
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "features"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return cut_lineage(rows.mapInArrow(run, f"id {kind}, features array<float>"))


def fit(table: DataFrame, prior: float, steps: int = 40, rate: float = 0.1, ridge: float = 3e-3) -> dict:
    """Weights for standardised features, from rows (features, positive): all rows are unlabelled text, some are positives.

    Full passes with Adam steps. Without positives or without rows every score is the prior.
    """
    def moments(x, p):
        return np.concatenate([[len(x), p.sum()], x.sum(axis=0), (x * x).sum(axis=0)])

    got = _sums(table, moments, 2 + 2 * N_FEATURES)
    n, n_pos = got[:2]
    flat = float(np.log(prior / (1 - prior)))
    if not n or not n_pos:
        return {"mean": np.zeros(N_FEATURES), "scale": np.zeros(N_FEATURES), "weights": np.zeros(N_FEATURES), "bias": flat}
    mean = got[2:2 + N_FEATURES] / n
    spread = np.sqrt(np.maximum(got[2 + N_FEATURES:2 + 2 * N_FEATURES] / n - mean**2, 0))
    scale = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0.0)

    def cut(x):
        return np.clip((x - mean) * scale, -CLIP, CLIP)

    mean_pos = np.append(_sums(table, lambda x, p: cut(x[p]).sum(axis=0), N_FEATURES) / n_pos, 1.0)
    w, m, v = np.append(np.zeros(N_FEATURES), flat), np.zeros(N_FEATURES + 1), np.zeros(N_FEATURES + 1)
    for step in range(1, steps + 1):
        def slopes(x, p, w=w):
            z = cut(x)
            f = z @ w[:-1] + w[-1]
            s, loss = 1 / (1 + np.exp(-f)), np.logaddexp(0, f)
            return np.concatenate([[loss.sum(), loss[p].sum()], s @ z, [s.sum()], s[p] @ z[p], [s[p].sum()]])

        got = _sums(table, slopes, 4 + 2 * N_FEATURES)
        all_neg, pos_neg = got[0] / n, got[1] / n_pos
        grad_all, grad_pos = got[2:3 + N_FEATURES] / n, got[3 + N_FEATURES:] / n_pos
        negative = all_neg - prior * pos_neg
        grad = prior * (grad_pos - mean_pos) + grad_all - prior * grad_pos if negative >= 0 else prior * grad_pos - grad_all
        grad = grad + ridge * np.append(w[:-1], 0.0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {"mean": mean, "scale": scale, "weights": w[:-1], "bias": float(w[-1])}


def score(table: DataFrame, model: dict, out: str = "score") -> DataFrame:
    """``table`` with ``features`` replaced by the score; the model is a few thousand numbers."""
    columns = [c for c in table.columns if c not in ("features", out)]
    kept = table.select(*columns, "features")
    schema = kept.drop("features").schema.add(out, "double")

    def run(batches):
        for batch in batches:
            x = batch.column("features").flatten().to_numpy().reshape(-1, N_FEATURES).astype(np.float64)
            f = np.clip((x - model["mean"]) * model["scale"], -CLIP, CLIP) @ model["weights"] + model["bias"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(1 / (1 + np.exp(-np.clip(f, -500, 500))))], names=[*columns, out])

    return kept.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text: str = "text", label: str = "quality",
            prior: float | None = None, threshold: float = 0.7) -> DataFrame:
    """One row per document: id, ``learned``, ``score`` and ``predicted``.

    ``learn`` is a condition on the id; only rows that meet it are learned from, with or without a label. Positives are documents whose
    labels are all 1 (several labels of an id: the lowest counts; null labels count as none). The prior, unless given, is the share
    of positives among the labelled rows, kept between 0.02 and 0.98; without labels it is one half. Null and empty texts have zero features and a score. Other
    columns are not read; equal texts have equal scores; an empty table gives no rows.
    """
    rows = describe(docs, id_col, text)
    marks = labels.filter(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label).alias("mark"))
    rows = rows.join(marks, "id", "left").withColumn("learned", F.coalesce(learn(F.col("id")), F.lit(False)))
    rows = cut_lineage(rows.select("id", "learned", "features", F.when(F.col("learned"), F.col("mark")).alias("mark")))
    if prior is None:
        seen, good = rows.select(F.count("mark"), F.sum((F.col("mark") == 1).cast("long"))).first()
        prior = min(max((good or 0) / seen, 0.02), 0.98) if seen else 0.5
    train = rows.filter("learned").select("features", F.coalesce(F.col("mark") == 1, F.lit(False)).alias("positive"))
    model = fit(train, prior)
    scored = score(rows.select("id", "learned", "features"), model)
    return scored.select(F.col("id").alias(id_col), "learned", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
