"""URL filter: rules first, then words of the host judged by naive Bayes.

Host names are cut into words by a unigram Viterbi segmentation; words of
host and path are scored by a multinomial naive Bayes model.  Unigram counts
come from all words of the visible text of all pages, plus the seed words; a
host name is cut with the counts of its own substrings, of up to
``MAX_WORD_CHARS`` letters (the length of a DNS label), and its tokens have
their weights from the counts of all tokens.  Counts and weights are tables
that meet distinct host runs and urls in joins.  There are no
labelled urls, so the classes are seeded: an url whose host holds a seed word
(a short list of spam words, a parameter) is an example to block, every other
one an example to allow; what else occurs in blocked hosts is learned.

Edge cases: a null url, or one without ``://``, has an empty host and path,
matches no rule and is judged by the method like any other (an url without
words gets the prior, so ``allow``); repeated urls get the same verdict; very
long hosts are cut whole; an empty table gives an empty one; of equally long
rules the one given first wins; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, materialize, prepare

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Words that mark an example host as one to block.
SEEDS = ("adult", "ads", "bets", "casino", "loans", "pills", "poker", "porn", "spam", "viagra")
MAX_WORD_CHARS, SEED_COUNT, SMOOTHING, BLOCK_AT = 63, 1000, 0.5, 0.5
RUNS = "[a-z]+|[0-9]+"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host lower-cased in A-Z only."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(u, instr(u, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule (struct of rule and verdict), else null."""
    tests = []
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        tests.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*tests, F.lit(None).cast("struct<rule:string,verdict:string>"))


class Segmenter:
    def __init__(self, counts: dict[str, int], total: int | None = None):
        self.total = total or sum(counts.values()) or 1
        self.unknown = [math.log(10 / self.total) - k * math.log(10) for k in range(MAX_WORD_CHARS + 1)]
        self.logp = self.logs(counts)

    def logs(self, counts: dict[str, int]) -> dict[str, float]:
        return {w: math.log(n / self.total) for w, n in counts.items()}

    def words(self, run: str) -> list[str]:
        """The most probable cut of a run of letters into words; a word that
        the dictionary lacks costs ten times more with every letter."""
        best, back = [0.0] + [-math.inf] * len(run), [0] * (len(run) + 1)
        for end in range(1, len(run) + 1):
            for start in range(max(0, end - MAX_WORD_CHARS), end):
                p = best[start] + self.logp.get(run[start:end], self.unknown[end - start])
                if p > best[end]:
                    best[end], back[end] = p, start
        out, end = [], len(run)
        while end:
            out.append(run[back[end]:end])
            end = back[end]
        out.reverse()
        return out


def unigrams(pages: DataFrame, html: str, seeds=SEEDS) -> DataFrame:
    """(w, n): counts of all words of all pages' visible text, and the seeds."""
    words = F.regexp_extract_all(F.lower(F.regexp_replace(F.col("t"), r"<(script|style)[^>]*>[^<]*</|<[^>]*>", " ")), F.lit("[a-z]+"), 0)
    found = pages.select(col(html).alias("t")).select(F.explode_outer(words).alias("w")).where("w is not null").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    if seeds:
        more = pages.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in seeds])).alias("w"), F.lit(0).cast("long").alias("n"))
        found = found.unionByName(more).groupBy("w").agg(F.sum("n").alias("n"))
    return found.withColumn("n", F.when(F.col("w").isin(*seeds), F.greatest("n", F.lit(SEED_COUNT))).otherwise(F.col("n")))


def segmented(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(run, words) of distinct runs of letters: a run meets the counts of its
    own substrings alone, whatever the size of the dictionary."""
    import pyarrow as pa
    total = counts.agg(F.sum("n")).first()[0] or 1
    cuts = (f"array_distinct(flatten(transform(sequence(1, length(run)), i -> transform(sequence(1, least({MAX_WORD_CHARS}, length(run) - i + 1)), "
            "k -> substring(run, i, k)))))")
    known = runs.select("run", F.explode_outer(F.expr(cuts)).alias("w")).join(counts, "w")
    known = known.groupBy("run").agg(F.collect_list("w").alias("w"), F.collect_list("n").alias("n"))  # as many as a run has substrings at most

    def cut(batches):
        s = Segmenter({}, total)
        for b in batches:
            out = []
            for run, w, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                s.logp = s.logs(dict(zip(w or (), n or (), strict=True)))
                out.append(s.words(run))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))], names=["run", "words"])

    return runs.join(known, "run", "left").mapInArrow(cut, "run string, words array<string>")


def tokenized(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds tokens to distinct (host, path): ``h:`` words of the host
    (segmented), ``p:`` words of the path; numbers are one token."""
    hosts = urls.select("host").distinct().select("host", F.posexplode_outer(F.regexp_extract_all("host", F.lit(RUNS), F.lit(0))).alias("pos", "run"))
    hosts = materialize(hosts.where("run is not null"), "url-hosts")
    parts = segmented(hosts.where("run >= 'a'").select("run").distinct(), counts)
    parts = hosts.join(parts, "run", "left").select("host", F.struct("pos", F.coalesce("words", F.array(F.lit("#"))).alias("words")).alias("part"))
    parts = parts.groupBy("host").agg(F.expr("flatten(transform(array_sort(collect_list(part)), x -> transform(x.words, w -> 'h:' || w)))").alias("h"))
    path = F.transform(F.regexp_extract_all(F.lower("path"), F.lit(RUNS), F.lit(0)), lambda x: F.concat(F.lit("p:"), F.when(x >= "a", x).otherwise("#")))
    none = F.expr("cast(array() as array<string>)")
    return urls.join(parts, "host", "left").select(*urls.columns, F.concat(F.coalesce("h", none), path).alias("tokens"))


def weights(urls: DataFrame, seeds=SEEDS) -> tuple[DataFrame | None, float]:
    """(w, llr): log-likelihood ratio (block against allow) of every token, and
    the prior's; ``urls`` has tokens and the number n of rows."""
    rows = urls.select(F.arrays_overlap("tokens", F.array(*[F.lit("h:" + s) for s in seeds])).alias("bad"), "tokens", "n")
    docs = {r.bad: r.n for r in rows.groupBy("bad").agg(F.sum("n").alias("n")).collect()}
    if not docs.get(True):
        return None, -math.inf
    got = (rows.select("bad", "n", F.explode("tokens").alias("w")).groupBy("w")
           .agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("b"), F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("a")))
    got = materialize(got, "url-weights")
    a, b, v = got.agg(F.sum("a"), F.sum("b"), F.count(F.lit(1))).first()
    llr = F.log((F.col("b") + SMOOTHING) / (b + SMOOTHING * v)) - F.log((F.col("a") + SMOOTHING) / (a + SMOOTHING * v))
    return got.select("w", llr.alias("llr")), math.log((docs[True] + 1) / (docs.get(False, 0) + 1))


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", rules=RULES, seeds=SEEDS) -> DataFrame:
    """page_id, host, path, rule, verdict, score (probability to block) and
    tokens of every row."""
    prepare(pages.sparkSession)
    rows = pages.select(col(page_id).cast("long").alias("page_id"), col(url).alias("u"))
    host, path = url_parts(F.col("u"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.select("page_id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("r"))
    rows = materialize(rows, "url-rows")
    urls = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    urls = materialize(tokenized(urls, materialize(unigrams(pages, html, seeds), "url-words")), "url-tokens")
    llr, prior = weights(urls, seeds)
    if llr is None:
        scored = urls.withColumn("score", F.lit(prior))
    else:  # decimal sums do not depend on the order
        scored = urls.select("host", "path", F.explode("tokens").alias("w")).join(llr, "w")
        scored = scored.groupBy("host", "path").agg(F.sum(F.col("llr").cast("decimal(28,18)")).cast("double").alias("sum"))
        scored = urls.join(scored, ["host", "path"], "left").withColumn("score", F.lit(prior) + F.coalesce("sum", F.lit(0.0)))
    scored = scored.select("host", "path", "tokens", (1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), "score"))))).alias("score"))
    out = rows.join(scored, ["host", "path"])
    own = F.when(F.col("score") >= BLOCK_AT, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", own).alias("verdict"), "score", "tokens")
