"""Language, quality, line dedup, Jaccard join, decontamination: brute force and odd rows."""
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tripmetrics.llm import decontam, gam, jaccard, langid, linededup
from tripmetrics.llm.queries import QUERIES, fold

from .conftest import SF


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_links(rows):
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    links = defaultdict(int)
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, s), (b, u) in itertools.combinations(sets, 2):
        if s and u and min(len(s), len(u)) >= 0.8 * max(len(s), len(u)) and len(s & u) >= 0.8 * len(s | u) - 1e-12:
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (find(d), links[d]) for d, _ in sets}


def test_language_of_marks_alone():
    m = langid.Model(["a", "b"], np.zeros((langid.BUCKETS, 2)), np.zeros(2))
    assert [m.predict(t)[0] for t in ("² ½ ¼", "١٢ ⅷ _", "12 !", "½ x", "漢")] == ["und"] * 3 + ["a"] * 2


def test_jaccard_equals_brute_force(spark, docs):
    got = {r.doc_id: (r.class_id, r.n_links) for r in QUERIES["op4_jaccard_join"](spark, SF).collect()}
    want = brute_links([(r.doc_id, r.text) for r in docs.collect()])
    assert got == want
    assert any(n for _, n in want.values())


def test_jaccard_near_copies_in_blocks(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        w = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 4)):
            w[k] = f"x{rng.integers(0, 5)}"
        rows.append((i, " ".join(w)))
    import tripmetrics.llm.blocks as blocks
    old, blocks.BLOCK = blocks.shared_buckets.__defaults__, 32
    blocks.shared_buckets.__defaults__ = (32,)
    try:
        got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        blocks.shared_buckets.__defaults__, blocks.BLOCK = old, old[0]
    assert got == brute_links(rows)


def test_bayesian_bound():
    for n in (32, 96, 160):
        m = jaccard.least_matches(n)
        p = np.linspace(0, 1, 20_001)
        post = lambda k: (p ** k * (1 - p) ** (n - k))[p >= 0.8].sum() / (p ** k * (1 - p) ** (n - k)).sum()  # noqa: B023, E731
        assert post(m) >= jaccard.TOLERANCE * 0.9 and post(m - 1) < jaccard.TOLERANCE * 1.1


def test_jaccard_odd_rows(odd):
    got = sorted((tuple(r) for r in jaccard.join(odd).collect()), key=str)
    by = defaultdict(list)
    for d, c, n, k in got:
        by[d].append((c, n, k))
    assert len(got) == odd.count()
    assert by[None] == [(None, 0, True)] and by[1] == [(1, 0, True)] and by[2] == [(2, 0, True)] and by[3] == [(3, 0, True)]
    assert by[5] == [(5, 2, True)] * 2 and by[6] == [(5, 2, False)]
    assert jaccard.join(odd.limit(0)).count() == 0


def line_chunks(text):
    lines = re.findall(linededup.LINE, text)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
    def pair(a, b):
        first = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)
        return signed(xxhash.xxh64_intdigest(b.to_bytes(8, "little"), first))
    r = [pair(h[i - 1] if i else 0, h[i]) for i in range(len(h))]
    cuts = [0] + [i for i in range(1, len(lines) + 1) if i == len(lines) or (i > 1 and r[i - 1] < r[i - 2] and r[i - 1] <= r[i])]
    return [(lines[a:b]) for a, b in itertools.pairwise(cuts)]


def shared_words(a, b, last):
    x, y = (re.findall(r"\S+\s*" if last else r"\s*\S+", t) for t in (a, b))
    if last:
        x, y = x[::-1], y[::-1]
    return sum(len(p.encode()) for p, _ in itertools.takewhile(lambda z: z[0] == z[1], zip(x, y)))


def brute_dedup(rows):
    """What is left of each (doc_id, text), in the rows' order of occurrences."""
    reach, raw, seeds = linededup.REACH, [t.encode() for _, t in rows], defaultdict(list)
    for n, (_, t) in enumerate(rows):
        start = 0
        for lines in line_chunks(t):
            c = "".join(lines)
            if len(lines) >= 2 and len(c) >= linededup.SEED_CHARS:
                seeds[c.encode()].append((n, start))
            start += len(c.encode())
    seeds = {c: at for c, at in seeds.items() if len(at) > 1}
    starts, ends = ({(n, p + (len(c) if end else 0)): len(c) for c, at in seeds.items() for n, p in at} for end in (False, True))

    def after(n, end):
        size = min([p for m, p in starts if m == n and p >= end], default=len(raw[n])) - end
        text = raw[n][end:end + min(size, reach)].decode(errors="replace")
        return re.sub(r"\S+$", "", text) if size > reach else text

    def before(n, start):
        size = start - max([p for m, p in ends if m == n and p <= start], default=0)
        text = raw[n][start - min(size, reach):start].decode(errors="replace")
        return re.sub(r"^\S+", "", text) if size > reach else text

    gone = [bytearray(len(r)) for r in raw]
    for c, at in seeds.items():
        size = len(c)
        for n, p in at[1:]:
            grown, total = [0, 0], size
            for side, (text, place, others) in enumerate(((after, size, starts), (before, 0, ends))):
                if (n, p + place) in others:  # another seed stands there
                    total += others[n, p + place]
                    continue
                other = next(x for x in at if (x[0], x[1] + place) not in others)
                if other < (n, p):
                    grown[side] = shared_words(text(n, p + place), text(other[0], other[1] + place), side == 1)
            if total + sum(grown) >= linededup.LEAST_CHARS:
                a, b = p - grown[1], p + size + grown[0]
                gone[n][a:b] = b"\1" * (b - a)
    return {d: bytes(x for x, g in zip(raw[n], gone[n]) if not g).decode() for n, (d, _) in enumerate(rows)}


def test_line_dedup_equals_brute_force(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = brute_dedup(rows)
    got = {r.doc_id: r for r in QUERIES["op6_line_chunks"](spark, SF).collect()}
    assert {d: r.text for d, r in got.items()} == want
    assert any(want[d] != t for d, t in rows) and all(got[d].chars_removed == len(t) - len(want[d]) for d, t in rows)


def test_line_dedup_removes_passages(spark, docs):
    """Passages of 52 to 100 words, with and without punctuation, go from the second document."""
    rng = random.Random(5)
    vocabulary = sorted({w for r in docs.collect() for w in r.text.split() if len(w) < 20})
    rows, planted = [], []
    for n in range(120):
        passage = " ".join(rng.sample(vocabulary, (52, 60, 100)[n % 3]))
        if n % 2:
            passage = re.sub("[.,;:!?]", "", passage)
        for d in (2 * n, 2 * n + 1):  # words of their own around it
            w = [f"{x}{d}" for x in rng.sample(vocabulary, 150)]
            k = rng.randrange(len(w))
            rows.append((d, " ".join([*w[:k], passage, *w[k:]])))
        planted.append(passage)
    got = {r.doc_id: r.text for r in linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    assert all(got[2 * n] == text[2 * n] for n in range(120))
    whole = [got[2 * n + 1].split() == text[2 * n + 1].replace(p, "").split() for n, p in enumerate(planted)]
    assert sum(whole) >= 0.9 * len(whole)


def test_line_dedup_binds_arrays_once(spark, docs):
    """A filter on the cleaned text copies no regular expression."""
    out = linededup.dedup(docs.select("doc_id", "text"))
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count(linededup.LINE[:20])
    assert count(out.where("length(text) < 50")) <= count(out) <= 2


def test_line_dedup_long_lines(spark):
    """No deep recursion, no lost character: words without an end, texts without words of any length."""
    rows = [(1, "a" * 300_000), (2, "ab " * 200_000), (3, "." * 100_000), (4, " " * 100_000), (5, "x" * 50_000 + "!" + "y" * 50_000)]
    got = linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == dict(rows)


def test_line_chunks_resist_shifts(spark):
    lines = [f"Sentence number {i} has some words in it." for i in range(40)]
    a, b = "\n".join(lines), "An extra start.\n" + "\n".join(lines[:20]) + "\nSomething new here.\n" + "\n".join(lines[20:])
    got = {r.doc_id: r for r in linededup.dedup(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()}
    assert got[1].text == a and len(got[2].text) < 0.45 * len(b)


def test_line_dedup_odd_rows(odd):
    out = linededup.dedup(odd, counts=None)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert {(r.doc_id, r.text) for r in out.collect()} == {(r.doc_id, r.text) for r in odd.collect()}
    assert linededup.dedup(odd.limit(0)).count() == 0


ITEMS = [(1, "A train travels from Paris to Lyon in 3 hours at 120 km per hour and then it rests for 3 hours in town"),
         (2, "What is two plus two"), (3, None), (4, ""), (5, "Completely different words that nobody else would ever write in a text like this one")]


def test_decontam_finds_reparameterised_copies(spark):
    body = "Some words before this. {} And some words after that, which do not matter at all."
    texts = [ITEMS[0][1], ITEMS[0][1].replace("Paris", "Rome").replace("Lyon", "Milan").replace("3", "5").replace("120", "90"),
             ITEMS[0][1].replace("3 hours at", "4 hours at").replace("for 3", "for 5"), "what is two plus two", "nothing to see here",
             ITEMS[4][1].upper()]
    docs = spark.createDataFrame([(i, body.format(t)) for i, t in enumerate(texts)] + [(90, None), (91, "")], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, bench).collect()}
    assert got[0, 1].contaminated and not got[0, 1].changed
    assert got[1, 1].contaminated and got[1, 1].changed and got[1, 1].n_slots >= 5
    assert not got[2, 1].consistent and not got[2, 1].contaminated  # one value became two
    assert got[3, 2].contaminated and got[5, 5].contaminated
    assert not any(d == 4 for d, _ in got)
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), bench).count() == 0
    import tripmetrics.llm.decontam as d
    old, d.BROADCAST_WINDOWS = d.BROADCAST_WINDOWS, 0
    try:
        assert {tuple(r) for r in decontam.contaminated(docs, bench).collect()} == {tuple(r) for r in got.values()}
    finally:
        d.BROADCAST_WINDOWS = old


def test_decontam_windows_carry_a_run_alone(spark):
    """A window's row holds the tokens of its run, not of a long text, and every window is there once, where it is in the text."""
    text = " ".join(f"word{i} and {i}" for i in range(500)).replace("word", "w")
    rows = decontam.template(spark.createDataFrame([(1, text), (2, "one two three")], "doc_id long, t string"), "t")
    n, got = rows.selectExpr("max(size(tok))").first()[0], decontam.windows(rows, 8).collect()
    assert n > 3 * decontam.RUN and max(len(r.tok) for r in got) <= decontam.RUN + 7 and {r.doc_id for r in got} == {1}
    assert sorted(r.pos for r in got if r.form == 0) == list(range(n - 7))
    tok = rows.where("doc_id = 1").first().tok
    assert all(r.tok[r.i:r.i + 8] == tok[r.pos:r.pos + 8] for r in got)


def test_decontam_large_benchmark_moves_known_windows_alone(spark, monkeypatch):
    """Over the broadcast bound only windows with a key of the benchmark are shuffled, and the rows are the same, in one part or several."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    items = [(i, " ".join(word() for _ in range(14))) for i in range(30)] + [(30, ITEMS[0][1])]
    noise = lambda k: " ".join(word() for _ in range(k))
    docs = [(i, f"{noise(1200)} {items[i % 31][1]} {noise(40)}") for i in range(20)] + [(20, noise(700) + " " + ITEMS[0][1].replace("3", "5")), (21, noise(2000))]
    docs, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, decontam.contaminated(docs, bench).collect()))
    assert {(r[0], r[1]) for r in want if r[-1]} == {(i, i) for i in range(20)} | {(20, 30)}
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    for keys in (10**6, 50):
        monkeypatch.setattr(decontam, "BROADCAST_KEYS", keys)
        plan = decontam.matches(docs, bench, "doc_id", "text", "item_id", "text")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [key" in plan and "LeftSemi" in plan
        assert sorted(map(tuple, decontam.contaminated(docs, bench).collect())) == want


def test_decontam_finds_verbatim_items(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    flat = lambda t: " ".join(t.lower().split())
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items if flat(t) in flat(r.text)}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_template_decontam"](spark, SF).where("contaminated").collect()}
    assert want and want <= got


def found_items(spark, pairs):
    """(item, text around a copy) pairs: the rows by number of the pair."""
    body = "Some words before this. {} And some words after that, which do not matter at all."
    docs = spark.createDataFrame([(i, body.format(t)) for i, (_, t) in enumerate(pairs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(pairs)], "item_id long, text string")
    return {r.doc_id: r for r in decontam.contaminated(docs, bench).collect() if r.doc_id == r.item_id}


def test_decontam_finds_items_dense_in_values(spark):
    dense = ["Evaluate 12 * 7 + 9 - 4 * 3 + 8", "What is 12 + 34 + 56 + 78?", "List 12, 15, 18, 21, 24 and find the mean of them",
             "They met Anna, Berta, Clara, Doris, Emma, Frida, Gerda, Hanna, Irene"]
    pairs = [(t, t) for t in dense] + [(dense[2], "List 11, 14, 19, 25, 29 and find the mean of them"), (dense[1], "What is 13 + 35 + 57 + 79?"),
                                       (dense[3], "They met Udo, Vera, Wim, Xenia, Yan, Zeno, Tom, Sven, Rolf")]
    got = found_items(spark, pairs)
    assert all(got[i].contaminated and not got[i].changed for i in range(4))
    assert got[4].contaminated and got[4].changed
    assert not any(i in got and got[i].contaminated for i in (5, 6))  # nothing but values: only verbatim


def test_decontam_lets_two_values_become_one(spark):
    item = "A shop sells pens for 3 dollars each and books for 5 dollars each, so how much does one of each cost in all"
    got = found_items(spark, [(item, item.replace("3", "4").replace("5", "4")), (item.replace("5", "3"), item)])
    assert got[0].contaminated and got[0].changed
    assert not got[1].contaminated  # one value became two


def test_decontam_finds_names_in_any_case(spark):
    item = "Then Natalia sold clips to 48 of her friends in April, and then Natalia sold half as many clips in May"
    short, price = "What is the capital of France?", "The new car costs about 1,200 euros more than the old one did last year"
    got = found_items(spark, [(item, item.lower()), (item, item.upper()), (item, item.lower().replace("48", "52")), (short, f"Question: {short}"),
                              (short, f"Quiz night\n{short}"), (price, price.replace("1,200", "900")), (price, price.replace("1,200", "1200")),
                              (price, price.replace("1,200", "2.5"))])
    assert all(got[i].contaminated for i in range(8))
    assert [got[i].changed for i in range(8)] == [False, False, True, False, False, True, False, True]


def test_decontam_odd_rows(odd, spark):
    assert decontam.contaminated(odd, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_language_held_out(spark, docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = QUERIES["op5_language_bayes"](spark, SF).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(odd, docs):
    model = langid.fit(docs, "text", "lang", "doc_id")
    got = {r.doc_id: r for r in langid.predict(odd, model, keep=["doc_id"]).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and got[1].score == 0 and got[8].lang_pred != "und"
    assert langid.predict(odd, model).columns[-2:] == ["lang_pred", "_score"] and langid.predict(odd, model).count() == odd.count()
    none = langid.fit(odd.where("lang is null"), "text", "lang", "doc_id")
    assert {r.lang_pred for r in langid.predict(odd, none).collect()} == {"und"}
    assert langid.predict(odd.limit(0), model).count() == 0


def test_quality_held_out(spark):
    y = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = [r for r in QUERIES["op8_quality_gam"](spark, SF).collect() if r.held_out and r.doc_id in y]
    assert sum(r.predicted == y[r.doc_id] for r in got) >= 0.9 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((6000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = gam.fit_tables(x[:4000], y[:4000])
    assert ((m.score(x[4000:]) >= 0.5) == y[4000:]).mean() > 0.9
    assert gam.fit_tables(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    assert gam.fit_tables(x[:9], np.ones(9)).score(x[:1])[0] > 0.99


def test_quality_odd_rows(odd, spark):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, None), (7, 1), (None, 1), (8, 3)], "doc_id long, quality int")
    model = gam.fit(odd, labels, fold("doc_id", 4) >= 0)
    got = odd.withColumn("s", gam.scorer(spark, model)("text")).collect()
    assert all(0 <= r.s <= 1 for r in got)
    assert gam.fit(odd, labels.limit(0), F.lit(True)).score(np.zeros((1, len(gam.FEATURES)))).tolist() == [0.5]


def test_line_hashes_are_shuffled_once(spark):
    """Chunks are cut once and their hashes dealt once, with place and size in one number; nothing is written before the texts meet them."""
    rnd = random.Random(5)
    text = "".join(f"w{rnd.randrange(900)} x{rnd.randrange(900)} y{rnd.randrange(900)}, " for _ in range(40))
    df = spark.createDataFrame([(n, f"start {n}. {text} end {n}.") for n in range(6)], "doc_id long, text string")
    out = linededup.dedup(df)
    got = {r.doc_id: r for r in out.collect()}
    assert got[0].n_removed == 0 and all(got[n].n_removed > 0 and len(got[n].text) < len(got[0].text) for n in range(1, 6))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "line-chunks" not in plan and "Window [count(1)" in plan and "shiftleft" in plan


def test_line_dedup_offsets(spark):
    """Byte offsets by runs are the running sums, whatever the number of strings."""
    rows = [(["é" * (n % 3) + "x" * (j % 5) for j in range(n)],) for n in (0, 1, 2, 15, 16, 17, 32, 33, 100)]
    for r in spark.createDataFrame(rows, "c array<string>").selectExpr("c", f"{linededup.offsets('c')} as o").collect():
        assert r.o[:len(r.c)] == [sum(len(x.encode()) for x in r.c[:j]) for j in range(len(r.c))]


def test_line_dedup_agreeing_words(spark):
    """Words shared from one end, wherever the first difference is, are counted whole."""
    def shared(a, b, last):
        w, v = (re.findall(r"\S+\s*" if last else r"\s*\S+", t) for t in (a, b))
        w, v = (w[::-1], v[::-1]) if last else (w, v)
        n = next((j for j, x in enumerate(w) if j >= len(v) or v[j] != x), len(w))
        return sum(len(x.encode()) for x in w[:n])

    rnd, rows = random.Random(3), [("", ""), ("a", ""), ("  ", "  "), (" x", "x"), ("x ", "x"), ("same words", "same words")]
    for _ in range(300):
        words = [rnd.choice(("a", "né", "longer", "東京", "x\n", " ")) for _ in range(rnd.randrange(1, 60))]
        a, at = " ".join(words), rnd.randrange(len(words))
        rows += [(a, " ".join([*words[:at], "other", *words[at + 1:]])), (a, " ".join(words[at:])), (a, " ".join(words[:at])), (a, a)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.selectExpr("a", "b", f"{linededup.agreeing('a', 'b', False)} as f", f"{linededup.agreeing('a', 'b', True)} as l").collect()
    assert all((r.f, r.l) == (shared(r.a, r.b, False), shared(r.a, r.b, True)) for r in got)


def test_line_dedup_compares_neighbours_once(spark, docs):
    """The words beside a chunk are compared in one place of the plan, and first occurrences dealt by their hash alone."""
    plan = linededup.dedup(docs.select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert sum("zip_with(" in line for line in plan.split("\n")) == 1
    assert not re.search(r"Aggregate \[h#\d+L?, chunk#", plan)
