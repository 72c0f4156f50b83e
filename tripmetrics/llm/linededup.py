"""Line deduplication by content-defined chunks of lines; DataFrame functions only.

A text is cut into lines: at line breaks, after the punctuation that ends a
clause and after every word of ``LONG_WORD`` characters or more, each with the
separators after it, so the lines together are the text and text without
punctuation has lines too.  The rolling hash at a line covers the hashes of
that line and the one before it; a chunk ends where the rolling hash is
smaller than its left neighbour and not larger than its right one.  That
depends on four lines only, so inserted or removed lines move the chunks next
to them alone, and no inner chunk has fewer than two lines.

Seeds are chunks of at least two lines and ``SEED_CHARS`` characters that
occur again anywhere.  Their hashes are counted in a sorted run of thin rows, and
the occurrences of repeated ones are grouped by their bytes; a hash that
different bytes share removes nothing.  All occurrences but the first by
(doc_id, place) are removed, and with them the neighbouring words, up to
``REACH`` bytes away, that equal those beside an earlier occurrence byte for
byte.  A seed stays if it has fewer than ``LEAST_CHARS`` bytes together with
those words and the seeds beside it.

Neighbours are carried only where a run of seeds ends, up to the next run, and the earliest
occurrence that ends a run there is the one compared with.  What is removed
always equals an earlier place that bears it, so no passage is lost whole.

Texts are cut into lines once; from then on chunks are byte offsets.

Edge cases: null and empty texts and rows with a null doc_id come back as
they are and lend no occurrence; rows that repeat a doc_id and text are
cleaned alike (their chunks count once); other rows with the same doc_id are
told apart by their text; a very long text has more chunks and nothing else;
an empty table gives an empty one; further columns are carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, fresh

LEAST_CHARS = 50
SEED_CHARS = 36
REACH = 400
LONG_WORD = 7
RUN = 16
#: Characters of two neighbours that are compared before all of them.
GLANCES = (16, 64)
#: A line: words shorter than that, then what ends the line.  What follows a run of characters
#: may always be empty, so no run is ever given back.
LINE = r"(?:[^ .,;:!?\n]{0,%d}+ +)++[^ .,;:!?\n]*[.,;:!?\n]* *|[^ .,;:!?\n]+[.,;:!?\n]* *|[.,;:!?\n]+ *" % (LONG_WORD - 1)


def offsets(strings: str) -> str:
    """SQL of the byte offset of each string of an array (and maybe one more).
    An array only grows by being copied, so runs of ``RUN`` are summed first
    and each run's offsets then begin from the run's own."""
    return (f"transform(array(transform({strings}, x -> octet_length(x))), s -> transform(array(aggregate(sequence(0, (size(s) - 1) div {RUN}), array(0), "
            f"(o, q) -> array_append(o, element_at(o, -1) + aggregate(slice(s, int(q) * {RUN} + 1, {RUN}), 0, (n, x) -> n + x)))), g -> flatten("
            f"transform(g, (at, q) -> aggregate(slice(s, q * {RUN} + 1, {RUN - 1}), array(at), (o, x) -> array_append(o, element_at(o, -1) + x)))))[0])[0]")


def chunks_of(text: str) -> str:
    """SQL of the array of (h, start, size, lines) of the chunks of SQL ``text``:
    hash, byte offset, bytes, lines.  Each step is bound once, as the variable
    of a lambda over an array of one."""
    line = LINE.replace("\\", "\\\\")
    return (f"transform(array(regexp_extract_all({text}, '{line}', 0)), a -> "
            "transform(array(transform(a, x -> xxhash64(x))), h -> "
            "transform(array(transform(h, (x, i) -> xxhash64(if(i = 0, 0L, h[i - 1]), x))), r -> "
            "transform(array(concat(array(0), filter(sequence(1, greatest(size(a), 1)), i -> i = size(a) or "
            "(i > 1 and r[i - 1] < r[i - 2] and r[i - 1] <= r[i])))), b -> "
            "transform(array(transform(slice(b, 2, size(b)), (e, i) -> array_join(slice(a, b[i] + 1, e - b[i]), ''))), c -> "
            f"transform(array({offsets('c')}), o -> "
            "transform(c, (x, i) -> struct(xxhash64(x) as h, o[i] as start, octet_length(x) as size, b[i + 1] - b[i] as lines, length(x) as chars))"
            ")[0])[0])[0])[0])[0])[0]")


def bound(df: DataFrame, expr: str, out: str) -> DataFrame:
    """``df`` with ``out``, the value of ``expr``: a generated column, which the
    optimiser neither copies nor computes a second time for a filter."""
    return df.select("*", F.explode_outer(F.array(F.expr(expr))).alias(out))


def agreeing(a: str, b: str, last: bool) -> str:
    """SQL: how many bytes of the text ``a`` are whole words that it shares
    with ``b`` from the start on (from the end back if ``last``); 0 if either is null.
    Words are cut only as far as the first of ``GLANCES`` that shows a
    difference: the word it falls in differs, those before it are whole."""
    word, turn, side = (r"\\S+\\s*", "reverse", "right") if last else (r"\\s*\\S+", "", "left")
    other = "other"
    far = (f"case when {side}({a}, 1) <> {side}({other}, 1) then 0 " + "".join(f"when {side}({a}, {n}) <> {side}({other}, {n}) then {n} " for n in GLANCES)
           + f"else greatest(length({a}), length({other})) end")
    words = [f"{turn}(regexp_extract_all({side}({t}, far), '{word}', 0))" for t in (a, other)]
    return (f"transform(array({b}), {other} -> if({a} is null or {other} is null, 0, transform(array({far}), far -> transform(array({words[0]}), w -> "
            f"aggregate(slice(w, 1, coalesce(nullif(array_position(zip_with(w, {words[1]}, (p, q) -> coalesce(p = q, false)), false), 0) - 1, size(w))), "
            "0, (n, x) -> n + octet_length(x)))[0])[0]))[0]")


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", counts: tuple[str, str] | None = ("n_removed", "chars_removed"),
          least_chars: int = LEAST_CHARS) -> DataFrame:
    """``df`` with repeated passages cut from the text; ``counts`` names two more
    columns, the removed seeds and characters.

    Only hashes and offsets of all chunks are shuffled, once, and counted where
    equal hashes lie side by side.  Texts are shuffled once, by document, to meet
    the offsets of chunks with repeated hashes; the bytes of those chunks alone, and of what stands beside their
    runs, are then grouped.
    """
    names = list(df.columns)
    taken = [*names, *(counts or ())]
    i, k, maybe, gone, raw, kept, t = (fresh(taken, x) for x in ("id_", "tkey_", "maybe_", "gone_", "raw_", "kept_", "text_"))
    whole = col(doc_id).isNotNull() & col(text).isNotNull() & (col(text) != "")
    # one and the same projection for both joins with texts, so that where no
    # other columns are carried Spark reuses one shuffle of the texts
    rest = [c for c in names if c not in (doc_id, text)]
    rows = df.where(whole).select(col(doc_id).alias(i), F.xxhash64(col(doc_id), col(text)).alias(k), col(text).alias(t), *[col(c) for c in rest])
    found = rows.select(k, F.explode_outer(F.expr(f"filter({chunks_of(t)}, c -> c.lines >= 2 and c.chars >= {SEED_CHARS})")).alias("c"))
    found = found.where("c is not null").select(k, F.expr("shiftleft(cast(c.start as long), 32) + c.size").alias("at"), "c.h")   # thin rows
    again = F.count(F.lit(1)).over(Window.partitionBy("h"))
    places = found.withColumn("n", again).where("n > 1").select(k, F.expr("int(shiftright(at, 32)) as start"), F.expr("int(at & 4294967295) as size"), "h").groupBy(k).agg(F.sort_array(F.collect_set(F.struct("start", "size", "h"))).alias(maybe))
    met = bound(rows.select(i, k, t).join(places, k), f"cast({t} as binary)", raw)
    # beside a seed: the seed there, or what lies before the next seed, up to REACH bytes without a word cut through
    ahead = f"coalesce(get({maybe}, j + 1).start, octet_length({raw})) - m.start - m.size"
    behind = f"m.start - coalesce(get({maybe}, j - 1).start + get({maybe}, j - 1).size, 0)"
    after, before = f"cast(substr({raw}, m.start + m.size + 1, least({REACH}, {ahead})) as string)", f"cast(substr({raw}, m.start - least({REACH}, {behind}) + 1, least({REACH}, {behind})) as string)"
    after = f"if({ahead} > {REACH}, regexp_replace({after}, '(?<!\\\\S)\\\\S++$', ''), {after})"
    before = f"if({behind} > {REACH}, regexp_replace({before}, '^\\\\S+', ''), {before})"
    nexts, prior = f"coalesce(get({maybe}, j + 1).start = m.start + m.size, false)", f"coalesce(get({maybe}, j - 1).start + get({maybe}, j - 1).size = m.start, false)"
    met = met.select(i, k, F.explode(F.expr(
        f"transform({maybe}, (m, j) -> struct(m.h as h, m.start as start, m.size as size, substr({raw}, m.start + 1, m.size) as chunk, "
        f"if({nexts}, null, {after}) as after, if({prior}, null, {before}) as before, "
        f"if({nexts}, get({maybe}, j + 1).size, 0) + if({prior}, get({maybe}, j - 1).size, 0) as seeds))")).alias("c"))
    met = met.select(i, k, "c.*")
    one = F.struct(i, k, "start")
    ends = [F.min(F.when(F.col(c).isNotNull(), F.struct(one.alias("one"), F.col(c).alias("t")))).alias(f"first_{c}") for c in ("after", "before")]
    # one shuffle, by the hash: its occurrences bear the same bytes if the smallest and the largest do
    first = met.groupBy("h").agg(F.min(one).alias("first"), *ends, F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    cut = met.drop("chunk").join(first.where("low = high").drop("low", "high"), "h").where(one != F.col("first"))
    shared = ", ".join(agreeing(c, f"if(first_{c}.one < struct(`{i}`, `{k}`, start), first_{c}.t, null)", c == "before") + f" as {c}" for c in ("after", "before"))
    cut = bound(cut, f"struct({shared})", "n")      # once, not again for the filter
    drop = (cut.where(f"size + seeds + n.after + n.before >= {least_chars}")
            .groupBy(k).agg(F.sort_array(F.collect_set(F.struct(i, F.expr("start - n.before as a"), F.expr("start + size + n.after as b")))).alias(gone)))
    own = F.expr(f"filter(`{gone}`, g -> g.`{i}` = `{i}`)").alias(gone)
    out = rows.join(drop, k, "left").select(*[col({doc_id: i, text: t}.get(c, c)).alias(c) for c in names], own)
    out = out.unionByName(df.where(~F.coalesce(whole, F.lit(False))).withColumn(gone, F.lit(None).cast(drop.schema[gone].dataType)))
    quoted = "`" + text.replace("`", "``") + "`"
    # the stretches between what is cut: from the end of the cuts so far to the next cut
    between = (f"aggregate(array_append(transform(`{gone}`, g -> struct(g.a as a, g.b as b)), struct(octet_length({quoted}) as a, 0 as b)), struct(0 as done, cast(array() as array<struct<a:int,b:int>>) as s), "
               "(o, g) -> struct(greatest(o.done, g.b) as done, if(g.a > o.done, array_append(o.s, struct(o.done as a, g.a as b)), o.s) as s), o -> o.s)")
    left = (f"transform(array(cast({quoted} as binary)), r -> array_join(transform({between}, "
            "s -> cast(substr(r, s.a + 1, s.b - s.a) as string)), ''))[0]")
    out = bound(out, f"if(`{gone}` is null, {quoted}, {left})", kept)
    cols = [(F.col(kept) if c == text else col(c)).alias(c) for c in names]
    if counts:
        cols += [F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias(counts[0]),
                 F.coalesce(F.length(col(text)) - F.length(F.col(kept)), F.lit(0)).alias(counts[1])]
    return out.select(*cols)
