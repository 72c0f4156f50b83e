"""Benchmark decontamination by template canonicalisation; DataFrame functions only.

Tokens are runs of letters, numbers with their separators (commas between
thousands are left out) and currency signs; numbers, units after
a number and names (capitalised words within a sentence) become typed
placeholders, every other word its lower-case form.  Windows of ``WINDOW``
template tokens of all documents meet the benchmark's in a hash join, in three
forms: with all placeholders, with names as plain words (whether a word looks
like a name depends on case and on what stands before it), and plain.  A form
with more placeholders than plain words is left out, so that lists of
names do not meet by their template but arithmetic does verbatim.  Items
shorter than a window use one window of their own length.

Slot consistency: the matched windows of a document and an item are taken by
their alignment (document place minus item place).  The values behind the
placeholders must be consistent: the same value of the item always maps to
the same one in the document (two may map to one).  A match with another
value somewhere is a re-parameterised copy.

An item is found in a document if some consistent alignment matches
``LEAST_WINDOWS`` of its windows, or, of a shorter item, all but one; of the
windows that can meet with other values, as many or all but one are enough.

Benchmark windows are broadcast only if their checked number is at most
``BROADCAST_WINDOWS``.  Of more, the distinct keys are, ``BROADCAST_KEYS`` at a
time, and the documents' windows that have one of them are shuffled to the
benchmark's by key; no other window leaves the task that made it.  A text is
cut into runs of ``RUN`` windows first: the rows of a run's windows carry its
tokens, not those of the whole text.

Edge cases: null and empty texts and rows with null ids match nothing;
repeated rows of a document or an item count once; ties between alignments go
to the smallest; very long texts are windowed whole; an empty benchmark gives
no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, materialize

WINDOW = 8
LEAST_WINDOWS = 4
BROADCAST_WINDOWS = 200_000
BROADCAST_KEYS = 1_000_000
RUN = 512
#: Stands before a kind (n, d, u) and the value it replaces; never in a token else.
MARK = "\x01"
#: Stands for a point or comma within a number.
POINT = "\x02"
#: A capitalised word that neither starts the text nor follows the end of a sentence.
NAME = r"\p{Lu}(?<=[^.!?\s]\s{1,3}\p{Lu})\p{Ll}+(?!\p{L})"
NUMBER = f"[0-9]+(?:{POINT}[0-9]+)*"
THOUSANDS = r",(?<=[0-9],)(?=[0-9]{3}(?![0-9]))"
WITHIN = r"[.,](?<=[0-9][.,])(?=[0-9])"
UNITS = ("mm", "cm", "m", "km", "in", "ft", "mi", "mg", "g", "kg", "lb", "oz", "ml", "l", "s", "sec", "min", "h", "hr", "hrs",
         "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
         "meter", "meters", "metre", "metres", "kilometer", "kilometers", "mile", "miles", "inch", "inches", "foot", "feet",
         "gram", "grams", "kilogram", "kilograms", "pound", "pounds", "liter", "liters", "litre", "litres", "percent",
         "dollar", "dollars", "euro", "euros", "cent", "cents", "degree", "degrees", "mph", "kmh", "hz", "w", "kw", "v")
UNIT = f"({MARK}d[0-9{POINT}]+) *(%|(?:" + "|".join(UNITS) + r")(?![\p{L}]))"
SPLIT = f"[^\\p{{L}}\\p{{M}}{MARK}{POINT}0-9%$€£¥]+"


#: Of a marked token: its template form, and the value behind a placeholder.
TYPE = f"if(startswith(t, '{MARK}'), left(t, 2), t)"
VALUE = f"if(startswith(t, '{MARK}'), substr(t, 3), '')"
#: The token without marks.
PLAIN = f"if(startswith(t, '{MARK}'), substr(t, 3), t)"
#: Forms of a token that a window's keys are made of, and which tokens are placeholders in them.
FORMS = ((TYPE, f"startswith(t, '{MARK}')"),
         (f"if(startswith(t, '{MARK}n'), substr(t, 3), {TYPE})", f"startswith(t, '{MARK}') and not startswith(t, '{MARK}n')"), (PLAIN, "false"))


def template(df: DataFrame, text: str) -> DataFrame:
    """Replaces ``text`` by ``tok``, plain words and values with the mark of
    their kind, and by whether any are names (``_names``) or others (``_values``).  Marks are set in the whole text, so a token costs no
    expression of its own."""
    names = [c for c in df.columns if c != text]
    df = df.withColumn("_m", F.when((F.instr(col(text), MARK) > 0) | (F.instr(col(text), POINT) > 0), F.translate(col(text), MARK + POINT, "  ")).otherwise(col(text)))
    df = df.withColumn("_m", F.regexp_replace(F.regexp_replace("_m", THOUSANDS, ""), WITHIN, POINT))
    df = df.withColumn("_m", F.regexp_replace("_m", NAME, MARK + "n$0"))
    df = df.withColumn("_m", F.regexp_replace("_m", NUMBER, f" {MARK}d$0 "))
    df = df.withColumn("_m", F.regexp_replace(F.lower("_m"), UNIT, f"$1 {MARK}u$2 "))
    df = df.withColumn("_tok", F.split("_m", SPLIT))
    return df.select(*names, F.expr("if(_tok[0] = '' or _tok[size(_tok) - 1] = '', array_remove(_tok, ''), _tok)").alias("tok"),
                     (F.instr("_m", MARK + "n") > 0).alias("_names"), (F.instr("_m", MARK + "d") > 0).alias("_values"))


def light(tok: str, n: str, form: int = 0) -> str:
    """Whether ``n`` tokens hold as many plain words as placeholders at least."""
    return f"2 * size(filter({tok}, t -> {FORMS[form][1]})) <= {n}"


def windows(df: DataFrame, n: int) -> DataFrame:
    """Adds (pos, key, form, i) of every window of ``n`` tokens to ``df`` (with
    tok): a key of each form that the marks tell from the ones before it.  The
    tokens are those of the window's run, where it starts at ``i``."""
    runs = f"if(size(tok) <= {RUN}, array(tok), transform(sequence(0, size(tok) - 1, {RUN}), s -> slice(tok, s + 1, {RUN + n - 1})))"
    df = df.select(*[c for c in df.columns if c != "tok"], F.posexplode_outer(F.expr(runs)).alias("_run", "tok"))
    names, forms = [c for c in df.columns if c not in ("_names", "_values", "_run")], []
    for f, (form, _) in enumerate(FORMS):
        whole = "transform(tok, t -> xxhash64(t))"
        h = (f"if(_names or _values, transform(tok, t -> xxhash64({form})), {whole})" if f == 0 else
             f"if({('_names', '_values')[f - 1]}, transform(tok, t -> xxhash64({form})), cast(array() as array<bigint>))")
        df, last, width = df.withColumn(f"_h1_{f}", F.expr(h)), f"_h1_{f}", 1
        while width < n:  # by doubling: a window's key is the hash of its two halves' keys
            by = min(width, n - width)
            df = df.withColumn(f"_h{width + by}_{f}", F.expr(f"transform({last}, (x, i) -> xxhash64(x, get({last}, i + {by})))"))
            last, width = f"_h{width + by}_{f}", width + by
        forms.append(last)
    # the outer form: from the inner one Spark infers a filter on the array's
    # size and computes the array a second time for it
    df = df.select(*names, "_names", "_run", F.size("tok").alias("n"), F.posexplode_outer(F.concat(*forms)).alias("at", "key"))
    df = df.where(f"at % n <= n - {n}")
    return df.select(*names, F.expr(f"at % n + _run * {RUN}").alias("pos"), "key", F.expr("int(at / n) + if(at >= n and not _names, 1, 0)").alias("form"),
                     F.expr("at % n").alias("i"))


def known(every: DataFrame, keys: DataFrame) -> DataFrame:
    """The windows that have one of the distinct ``keys``, which are broadcast in parts."""
    parts, out = max(1, -(-keys.count() // BROADCAST_KEYS)), None
    for part in range(parts):
        mine = f"pmod(key, {parts}) = {part}"
        hit = every.join(F.broadcast(keys.where(mine) if parts > 1 else keys), "key", "left_semi")
        out = hit if out is None else out.unionByName(hit)
    return out


def matches(docs: DataFrame, bench: DataFrame, doc_id: str, doc_text: str, item_id: str, item_text: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, pos, place, light, slots, item_slots) of every matched window."""
    items = bench.select(col(item_id).alias("item_id"), col(item_text).alias("t")).where("item_id is not null and t is not null").distinct()
    items = template(items, "t").where("size(tok) > 0")
    lengths = [r[0] for r in items.select(F.least(F.size("tok"), F.lit(window)).alias("n")).distinct().orderBy("n").collect()]
    docs = docs.select(col(doc_id).alias("doc_id"), col(doc_text).alias("t")).where("doc_id is not null and t is not null")
    docs, out = template(docs, "t"), None
    for n in lengths:
        own = windows(items.where(f"size(tok) >= {window}" if n == window else f"size(tok) = {n}"), n)
        own = own.withColumn("tok", F.expr(f"slice(tok, i + 1, {n})")).withColumn("light", F.expr(light("tok", n)))
        own = own.where(" or ".join(f"(form = {f} and {light('tok', n, f)})" for f in range(len(FORMS))))
        own = own.select("item_id", F.col("pos").alias("place"), "key", "light", F.expr(f"transform(tok, t -> {VALUE})").alias("item_slots"))
        own = materialize(own.distinct(), "decontam-items")
        every = windows(docs, n)
        slots = F.expr(f"transform(slice(tok, i + 1, {n}), t -> {PLAIN})").alias("slots")
        if own.count() <= BROADCAST_WINDOWS:
            found = every.join(F.broadcast(own), "key").select("*", slots)
        else:
            found = known(every, own.select("key").distinct()).select("doc_id", "pos", "key", slots).join(own.hint("merge"), "key")
        found = found.select("doc_id", "item_id", "pos", "place", "light", "slots", "item_slots")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, pos int, place int, light boolean, slots array<string>, item_slots array<string>")
    return out


def contaminated(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, least: int = LEAST_WINDOWS) -> DataFrame:
    """A row per document and item with a match, by the best alignment:
    doc_id, item_id, pos (first matched token), n_windows, item_windows,
    n_slots, consistent, changed (a slot differs) and contaminated."""
    found = materialize(matches(docs, bench, doc_id, doc_text, item_id, item_text, window).distinct(), "decontam-matches")
    key = ["doc_id", "item_id", "shift"]
    found = found.withColumn("shift", F.col("pos") - F.col("place"))
    base = found.groupBy(*key).agg(F.count_distinct("place").alias("n_windows"), F.count_distinct(F.when(F.col("light"), F.col("place"))).alias("n_light"),
                                   F.min("pos").alias("pos"))
    slot = (found.where("array_join(item_slots, '') <> ''").select(*key, F.explode(F.arrays_zip("item_slots", "slots")).alias("s"))
            .select(*key, F.col("s.item_slots").alias("i"), F.col("s.slots").alias("d")).where("i <> ''").distinct())
    slots = slot.groupBy(*key).agg(F.count(F.lit(1)).alias("n_slots"), F.count_distinct("i").alias("ni"),
                                   F.max(F.col("i") != F.col("d")).alias("changed"))
    size = template(bench.select(col(item_id).alias("item_id"), col(item_text).alias("t")).where("item_id is not null and t is not null"), "t")
    size = size.where("size(tok) > 0").withColumn("_n", F.greatest(F.lit(1), F.size("tok") - (window - 1)))
    some = light(f"slice(tok, p, {window})", f"least({window}, size(tok))")
    size = size.groupBy("item_id").agg(F.max("_n").alias("item_windows"), F.max(F.expr(f"size(filter(sequence(1, _n), p -> {some}))")).alias("item_light"))
    out = base.join(slots, key, "left").join(size, "item_id")
    out = out.select("doc_id", "item_id", "shift", "pos", "n_windows", "item_windows", "n_light", "item_light", F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
                     F.coalesce(F.col("n_slots") == F.col("ni"), F.lit(True)).alias("consistent"),
                     F.coalesce("changed", F.lit(False)).alias("changed"))
    enough = [F.col(n) >= F.least(F.lit(least), F.greatest(F.lit(1), F.col(of) - 1)) for n, of in (("n_windows", "item_windows"), ("n_light", "item_light"))]
    out = out.withColumn("contaminated", F.col("consistent") & (enough[0] | enough[1]))
    best = F.struct(F.col("contaminated"), F.col("n_windows"), -F.col("shift"), "pos", "item_windows", "n_slots", "consistent", "changed")
    out = out.groupBy("doc_id", "item_id").agg(F.max(best).alias("b"))
    return out.select("doc_id", "item_id", "b.pos", "b.n_windows", "b.item_windows", "b.n_slots", "b.consistent", "b.changed", "b.contaminated")
