"""Quality classifier: generalised additive model with pairwise interactions.

Features of a whole text (lengths, letter cases, symbols, repetition) go into
quantile bins.  Fitting boosts one feature after the other, round after round,
with shallow trees (three splits) on the logistic loss; a tree over bins only
adds to that feature's lookup table.  The strongest pairs by remaining
gradient are boosted the same way into small two-way tables.  A score is the
sigmoid of a sum of table entries, for a batch by numpy indexing.

The model is fitted on the driver from at most about ``MAX_FIT_ROWS`` labelled
rows' features (the documented bound of the sample, chosen by a hash of the
id), never on texts; its tables have a fixed size and are broadcast.

Edge cases: null and empty texts have zero features and are scored like any
text; labels that are null or neither 0 nor 1 are ignored, repeated labels of
a document count once (the lowest); with one class only, or none, the score is
that class's share (0.5 for none); further columns are carried untouched.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, prepare
from .langid import sample_below

MAX_FIT_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAF_ROWS, SHRINK = 150, 60, 0.15, 20, 1.0
FEATURES = ("log_words", "word_length", "upper", "digits", "symbols", "exclaims", "stops", "spaces", "lines",
            "line_words", "distinct", "repeats", "top_word", "non_ascii", "bars", "line_copies")
_SYMBOLS = np.array([c in b"#$%&*+/<=>@[\\]^_`{|}~" for c in range(256)])


def features(text: str | None) -> list[float]:
    text = text or ""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    size, words, lines = max(1, int(raw.sum())), text.split(), text.split("\n")
    n, counts = max(1, len(words)), Counter(words)
    upper, lower = int(raw[65:91].sum()), int(raw[97:123].sum())
    again = sum(map(str.__eq__, words, words[1:]))
    return [float(np.log1p(len(words))), len(text) / n, upper / max(1, upper + lower), raw[48:58].sum() / size,
            raw[_SYMBOLS].sum() / size, raw[33] / n, (raw[46] + raw[44]) / n, (raw[32] + raw[10]) / size, len(lines) / n,
            float(np.log1p(n / len(lines))), len(counts) / n, again / n, max(counts.values(), default=0) / n,
            raw[128:].sum() / size, raw[124] / n, 1 - len(set(lines)) / len(lines)]


def _split(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[float, int]:
    """Best cut of a run of bins: (gain, bins on the left)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl, cl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(c)[:-1]
    gr, hr, cr = g.sum() - gl, h.sum() - hl, c.sum() - cl
    gain = gl ** 2 / (hl + SHRINK) + gr ** 2 / (hr + SHRINK) - g.sum() ** 2 / (h.sum() + SHRINK)
    gain[(cl < LEAF_ROWS) | (cr < LEAF_ROWS)] = 0
    best = int(np.argmax(gain))
    return float(gain[best]), best + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, c: np.ndarray, splits: int = 3) -> np.ndarray:
    """Step per bin of a tree with at most ``splits`` cuts, best cut first."""
    runs = [(0, len(g))]
    for _ in range(splits):
        found = [(*_split(g[a:b], h[a:b], c[a:b]), a, b) for a, b in runs]
        gain, left, a, b = max(found)
        if gain <= 1e-9:
            break
        runs.remove((a, b))
        runs += [(a, a + left), (a + left, b)]
    out = np.zeros(len(g))
    for a, b in runs:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + SHRINK)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """Tree of depth two over a two-way table: one cut along the first axis,
    one along the second in each half; (step per cell, gain)."""
    best = (np.zeros(g.shape), 0.0)
    for cut in range(1, g.shape[0]):
        out, total = np.zeros(g.shape), 0.0
        for part in (slice(0, cut), slice(cut, None)):
            gs, hs, cs = g[part].sum(0), h[part].sum(0), c[part].sum(0)
            gain, left = _split(gs, hs, cs)
            for side in ((slice(0, left), slice(left, None)) if gain > 0 else (slice(None),)):
                if cs[side].sum() >= LEAF_ROWS:
                    out[part, side] = gs[side].sum() / (hs[side].sum() + SHRINK)
                    total += gs[side].sum() ** 2 / (hs[side].sum() + SHRINK)
        if total > best[1]:
            best = (out, total)
    return best


class Gam:
    def __init__(self, cuts, pair_cuts, base, tables, pairs):
        self.cuts, self.pair_cuts, self.base, self.tables, self.pairs = cuts, pair_cuts, base, tables, pairs

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row: bin look-ups and additions."""
        z = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            z += table[np.searchsorted(self.cuts[j], x[:, j], side="right")]
        for (i, j), table in self.pairs:
            z += table[np.searchsorted(self.pair_cuts[i], x[:, i], side="right"),
                       np.searchsorted(self.pair_cuts[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _cuts(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1])) if len(v) else np.empty(0)


def fit_tables(x: np.ndarray, y: np.ndarray) -> Gam:
    k = x.shape[1]
    cuts, pair_cuts = [_cuts(x[:, j], BINS) for j in range(k)], [_cuts(x[:, j], PAIR_BINS) for j in range(k)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    share = float(y.mean()) if len(y) else 0.5
    if not 0 < share < 1:
        return Gam(cuts, pair_cuts, 40.0 if share == 1 else -40.0 if share == 0 and len(y) else 0.0, tables, [])
    base = float(np.log(share / (1 - share)))
    bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    small = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(pair_cuts)]
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables, strict=True)]
    z = np.full(len(y), base)
    for _ in range(ROUNDS):
        for j in range(k):
            p = 1 / (1 + np.exp(-z))
            step = RATE * shallow_tree(np.bincount(bins[j], y - p, len(tables[j])), np.bincount(bins[j], p * (1 - p), len(tables[j])), sizes[j])
            tables[j] += step
            z += step[bins[j]]

    def grid(i: int, j: int):
        shape = len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1
        cell, p = small[i] * shape[1] + small[j], 1 / (1 + np.exp(-z))
        return [np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (y - p, p * (1 - p), None)], cell

    ranked = sorted(((pair_tree(*grid(i, j)[0])[1], i, j) for i in range(k) for j in range(i)), reverse=True)[:PAIRS]
    pairs = [((i, j), np.zeros((len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1))) for _, i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in pairs:
            sums, cell = grid(i, j)
            step = RATE * pair_tree(*sums)[0]
            table += step
            z += step.reshape(-1)[cell]
    return Gam(cuts, pair_cuts, base, tables, pairs)


def _featured(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    import pyarrow as pa

    def run(batches):
        for b in batches:
            f = [features(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(f, pa.list_(pa.float64()))],
                                             names=[*keep, "f"])

    from pyspark.sql.types import ArrayType, DoubleType, StructType
    part = df.select(*keep, text)
    return part.mapInArrow(run, StructType(part.schema.fields[:-1]).add("f", ArrayType(DoubleType())))


def fit(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality") -> Gam:
    """Fit on labelled rows for which ``train`` (over column ``doc_id``)
    holds.  The sampled label rows, bounded by ``MAX_FIT_ROWS``, are
    broadcast to the texts, which are not shuffled."""
    prepare(docs.sparkSession)
    picked = (labels.select(col(doc_id).alias("doc_id"), col(label).alias("y")).where("y in (0, 1) and doc_id is not null")
              .where(train).groupBy("doc_id").agg(F.min("y").alias("y")))
    picked = sample_below(picked, F.col("doc_id"), MAX_FIT_ROWS)
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("t")).join(F.broadcast(picked), "doc_id")
    got = _featured(rows, ["doc_id", "y"], "t").select("y", "f").toArrow()
    y = got.column("y").to_numpy().astype(float)
    x = np.array(got.column("f").to_pylist(), float).reshape(len(y), len(FEATURES))
    order = np.lexsort([*x.T, y])  # sums do not depend on the order rows arrive in
    return fit_tables(x[order], y[order])


def scorer(spark, model: Gam):
    """Column function text -> score."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
        return pd.Series(shared.value.score(x))

    return score
