"""Language identification of texts that may hold several languages.

Byte 4-grams of letters are counted per language over all labelled texts. A text is a mixture: every n-gram was drawn from one of its
languages. Expectation-maximisation finds the proportions; the set of languages starts with all and loses its smallest
member for as long as the penalised likelihood rises. The prediction is the language with the largest proportion.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.bytebpe import _slices
from leadloom.llm.common import held, ship_package

#: Hash values an n-gram can have; a model is a table of that many rows and a column per language.
SLOTS = 1 << 16
#: What a further language must add to the log-likelihood per text, times the log of the number of n-grams.
PENALTY = 3.0
#: Neighbouring n-grams overlap; their joint likelihood counts as one part in so many.
OVERLAP = 4.0
ROUNDS, SMOOTH = 8, 0.5
#: Share under which languages leave the full set together.
TRACE = 0.02
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Slot of every n-gram that ends in a letter, and for each text where its own begin (one bound more than texts)."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _FOLD[np.frombuffer(b"   " + b"   ".join(parts) + b"   ", dtype=np.uint8)].astype(np.uint32)
    ends = data[3:] != 0x20
    ends &= ~((data[3:] >= 0xC0))  # a lead byte alone is half a letter
    code = data[3:] | data[2:-1] << 8 | data[1:-2] << 16 | data[:-3] << 24
    at = np.flatnonzero(ends)
    slots = ((code[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
    starts = np.cumsum([0] + [len(p) + 3 for p in parts])
    return slots, np.searchsorted(at, starts)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", tempered: float = SMOOTH) -> dict:
    """Count n-grams per language over all rows whose text and language are not null.

    Each task sums its rows before they are shuffled. The driver gets one table of ``SLOTS`` counts per language and the
    number of texts of each; both sizes depend on the number of languages only. Without labelled rows there are no languages.
    """
    ship_package(docs.sparkSession)
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))

    def count(batches):
        held("langmix")
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for whole in batches:
            for batch in _slices(whole, 2_000_000, "text"):
                slots, bounds = grams(batch.column("text").to_pylist())
                langs = np.array(batch.column("lang").to_pylist(), dtype=object)
                owner = np.repeat(langs, np.diff(bounds))
                for name in set(langs):
                    if name not in sums:
                        sums[name] = np.zeros(SLOTS, dtype=np.int64)
                        seen[name] = 0
                    sums[name] += np.bincount(slots[owner == name], minlength=SLOTS)
                    seen[name] += int((langs == name).sum())
        for name, table in sums.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(used) + 1)), pa.array(np.append(used, -1)), pa.array(np.append(table[used], seen[name]))],
                names=["lang", "slot", "n"])

    counts = (rows.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
              .toArrow())
    langs = sorted(set(counts.column("lang").to_pylist()))
    table, texts = np.zeros((SLOTS, len(langs))), np.zeros(len(langs))
    place = {name: i for i, name in enumerate(langs)}
    column = np.array([place[x] for x in counts.column("lang").to_pylist()], dtype=np.int64)
    slot, n = counts.column("slot").to_numpy(), counts.column("n").to_numpy()
    table[slot[slot >= 0], column[slot >= 0]] = n[slot >= 0]
    texts[column[slot < 0]] = n[slot < 0]
    # An n-gram that was never seen is as likely in a language with little text as in one with much.
    totals = np.maximum(table.sum(axis=0), 1.0)
    smooth = table + tempered * totals / totals.max(initial=1.0)
    return {"langs": langs, "likelihood": (smooth / smooth.sum(axis=0)).astype(np.float32) if langs else table.astype(np.float32),
            "prior": texts / max(texts.sum(), 1)}


def _mixture(counts, rows, starts, sizes, chances, allowed):
    """Proportions and log-likelihood of each text, over its allowed languages. ``rows`` names the text of an entry."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for turn in range(ROUNDS + 1):
        part = chances * share[rows]
        total = part.sum(axis=1)
        if turn == ROUNDS:
            return share, np.add.reduceat(counts * np.log(total), starts)
        part *= (counts / total)[:, None]
        share = np.add.reduceat(part, starts, axis=0) / sizes[:, None]


def infer(texts: list[str | None], model: dict) -> tuple[list[str], np.ndarray]:
    """Prediction and score of each text of a batch."""
    langs, prior = model["langs"], model["prior"]
    pred, score = ["und"] * len(texts), np.zeros(len(texts))
    lettered = np.array([bool(t and _LETTER.search(t)) for t in texts], dtype=bool)
    if not langs or not lettered.any():
        return pred, score
    slots, bounds = grams(texts)
    counts, codes, owners = [], [], []
    for i in np.flatnonzero(lettered):
        code, count = np.unique(slots[bounds[i]:bounds[i + 1]], return_counts=True)
        counts.append(count)
        codes.append(code)
        owners.append(i)
    best = int(np.argmax(prior))
    for i in owners:
        pred[i], score[i] = langs[best], prior[best]
    filled = [j for j, c in enumerate(codes) if len(c)]
    if not filled:
        return pred, score
    owners = np.array([owners[j] for j in filled])
    lengths = np.array([len(codes[j]) for j in filled])
    counts = np.concatenate([counts[j] for j in filled]).astype(np.float32)
    chances = model["likelihood"][np.concatenate([codes[j] for j in filled])]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    rows = np.repeat(np.arange(len(filled)), lengths)
    sizes = np.add.reduceat(counts, starts)
    log_prior = np.log(prior + 1e-9)
    # Likelihood of each language alone.
    lone = np.add.reduceat(counts[:, None] * np.log(chances), starts, axis=0)
    alone = lone / OVERLAP + log_prior
    allowed = np.ones((len(filled), len(langs)), dtype=np.float32)
    share, likely = _mixture(counts, rows, starts, sizes, chances, allowed)
    cost = PENALTY * np.log1p(sizes)
    value = likely / OVERLAP - cost * len(langs)
    live = np.arange(len(filled)) if len(langs) > 1 else np.arange(0)
    first = True
    while len(live):
        # First all that hardly take part leave, then the smallest member of the set, one at a time. A text whose value falls
        # keeps its set and is done.
        rest = np.where(allowed[live] > 0, share[live], np.inf)
        small = rest < TRACE if first else np.zeros(rest.shape, dtype=bool)
        first = False
        small[np.arange(len(live)), share[live].argmax(axis=1)] = False
        stuck = ~small.any(axis=1)
        small[stuck, rest.argmin(axis=1)[stuck]] = True
        fewer = np.where(small, 0, allowed[live]).astype(np.float32)
        new_share, new_likely = fewer.copy(), np.empty(len(live))
        # A set of one needs no search: its likelihood is that of the language alone.
        one = fewer.sum(axis=1) == 1
        new_likely[one] = lone[live[one], fewer[one].argmax(axis=1)]
        more = live[~one]
        if len(more):
            picked = np.isin(rows, more)
            place = np.searchsorted(more, rows[picked])
            heads = np.concatenate([[0], np.cumsum(lengths[more])[:-1]])
            new_share[~one], new_likely[~one] = _mixture(
                counts[picked], place, heads, sizes[more], chances[picked], fewer[~one])
        new_value = new_likely / OVERLAP - cost[live] * fewer.sum(axis=1)
        better = new_value >= value[live]
        won = live[better]
        allowed[won], share[won], value[won] = fewer[better], new_share[better], new_value[better]
        live = won[allowed[won].sum(axis=1) > 1]
    # A set of one is the best language alone; ties go to the first language.
    single = allowed.sum(axis=1) <= 1
    top = np.where(single, alone.argmax(axis=1), share.argmax(axis=1))
    odds = np.exp(alone - alone.max(axis=1, keepdims=True))
    sure = odds[np.arange(len(top)), top] / odds.sum(axis=1)
    value = np.where(single, sure, share[np.arange(len(top)), top])
    for j, i in enumerate(owners):
        pred[i], score[i] = langs[top[j]], float(min(max(value[j], 0.0), 1.0))
    return pred, score


def predict(docs: DataFrame, model: dict, text: str = "text", out: str = "lang_pred", out_score: str = "score") -> DataFrame:
    """Add the predicted language and its score (0 to 1) to every row; only the text is read for it.

    Null texts and texts without a letter are ``und`` with score 0, as is everything when nothing was learned. Letters
    of which no n-gram is known give the most frequent language with its share. The score is the proportion of the language in a mixed
    text, else its probability among all. Equal texts get equal results; other columns stay, but for columns that bear
    the names of the new ones, which are replaced.
    """
    ship_package(docs.sparkSession)
    added = {out.lower(), out_score.lower()}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType()), T.StructField(out_score, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS rows, a column per language

    def run(batches):
        held("langmix")
        for whole in batches:
            for batch in _slices(whole, 1_000_000, text):
                pred, score = infer(batch.column(text).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, type=pa.string()), pa.array(score)],
                                                 names=[*batch.schema.names, out, out_score])

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of an id's text leaves ``part`` when divided by ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part
