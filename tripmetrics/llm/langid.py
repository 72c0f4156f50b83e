"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fit: about ``MAX_FIT_ROWS`` labelled rows (chosen by a hash of the id, the
documented bound of the sample) are counted in their tasks, summed by Spark
and turned into a languages x ``BUCKETS`` matrix of log probabilities, whose
size is fixed and which is broadcast.  Predict: a batch's texts become sparse
bucket counts in numpy, multiplied with the matrix rows of those buckets.

Edge cases: a null text or one without letters is ``und`` with score 0; rows
without a language, or with a null id, are never learned from; without any
labelled row every text is ``und``; ties go to the first language by name;
very long texts are counted whole; further columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, fresh, prepare

BUCKETS = 1 << 14
GRAMS = (1, 2, 3)
MAX_FIT_ROWS = 20_000
MAX_LANGUAGES = 500
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    """Whether a character is a letter; digits of any kind, superscripts and fractions are none."""
    return any(map(str.isalpha, text))


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the lower-cased text's character n-grams; every
    run of other characters than letters counts as one space."""
    points = np.frombuffer((" " + _NOT_LETTERS.sub(" ", text.lower()) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    total = np.zeros(BUCKETS, np.int64)
    for n in GRAMS:
        if len(points) < n:
            break
        h = np.full(len(points) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h ^= points[k:len(points) - n + 1 + k]
            h *= np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        total += np.bincount(h & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at]


def sample_below(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if fewer), chosen by a hash of
    ``key``: the same rows on every run and any partitioning."""
    n = df.count()
    return df if n <= rows else df.where(F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 40)) < int(rows / n * (1 << 40)))


class Model:
    def __init__(self, languages: list[str], logp: np.ndarray, prior: np.ndarray):
        self.languages, self.logp, self.prior = languages, logp, prior

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        at, n = grams(text)
        s = self.prior + n @ self.logp[at]
        best = int(np.argmax(s))
        return self.languages[best], float(1 / np.exp(s - s[best]).sum())


def fit(rows: DataFrame, text: str, lang: str, key: str) -> Model:
    """Learn from all ``rows`` given, or a sample of ``MAX_FIT_ROWS`` of them."""
    import pyarrow as pa
    prepare(rows.sparkSession)
    rows = rows.select(col(text).alias("t"), col(lang).alias("l"), col(key).alias("k")).where("t is not null and l is not null")
    rows = sample_below(rows, F.col("k"), MAX_FIT_ROWS).select("t", "l")

    def count(batches):
        sums, docs = {}, {}
        for b in batches:
            for t, lang_ in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if has_letter(t):
                    at, n = grams(t)
                    sums.setdefault(lang_, np.zeros(BUCKETS, np.int64))[at] += n
                    docs[lang_] = docs.get(lang_, 0) + 1
        for lang_, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang_] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int32()),
                                              pa.array(np.append(total[at], docs[lang_]), pa.int64())], names=["l", "b", "n"])

    got = rows.mapInArrow(count, "l string, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).toArrow()
    lang_, bucket, n = (got.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    languages = sorted(set(lang_.tolist()))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; at most {MAX_LANGUAGES} are supported")
    row = {x: i for i, x in enumerate(languages)}
    table, docs = np.ones((BUCKETS, len(languages))), np.zeros(len(languages))
    for i, b, c in zip((row[x] for x in lang_.tolist()), bucket.tolist(), n.tolist(), strict=True):
        if b < 0:
            docs[i] = c
        else:
            table[b, i] += c
    return Model(languages, np.log(table / table.sum(axis=0)) if languages else table,
                 np.log(docs / docs.sum()) if languages else docs)


def predict(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
            out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns (all but the text by default) with the predicted
    language and its posterior probability; no shuffle."""
    import pyarrow as pa
    from pyspark.sql.types import DoubleType, StringType, StructType
    prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c != text] if keep is None else keep
    out = (fresh(keep, out[0]), fresh([*keep, out[0]], out[1]))
    src = fresh([*keep, *out], "text_in")
    part = df.select(*[col(c) for c in keep], col(text).alias(src))

    def run(batches):
        m = shared.value
        for b in batches:
            got = [m.predict(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())], names=[*keep, *out])

    schema = StructType([f for f in part.schema.fields if f.name != src]).add(out[0], StringType()).add(out[1], DoubleType())
    return part.mapInArrow(run, schema)
