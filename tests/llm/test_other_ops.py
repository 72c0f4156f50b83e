"""WARC, url filter, embeddings, token files, BPE: brute force, round trips, odd rows."""
import base64
import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

import tripmetrics.llm.bpe as bpe
from tripmetrics.llm import itq, tokenfile, urlfilter, warc
from tripmetrics.llm.queries import QUERIES, bpe_digests

from .conftest import SF


def expected_records(rows):
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    out = []
    for p, _, h in rows:
        raw = (h or "").encode()
        again = p is not None and len(raw) >= 100 and first[h or ""] != p
        out.append((p, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out, key=str)


def records(spark, pages):
    a, i = warc.folders(spark)
    level = warc.write_index(warc.write_archives(pages, a), i)
    found = warc.lookup(pages.select("url", "page_id"), level, i)
    return warc.read_records(found, a)


def test_warc_round_trip(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    got = QUERIES["op1_warc_index"](spark, SF).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_records(rows)


def test_warc_odd_rows(spark):
    big = "x" * 150
    rows = [(1, "http://A.b.com/q", big), (2, "http://a.b.com/q", big), (2, "http://a.b.com/q", big), (3, None, None), (4, "odd", ""), (None, "http://n.com", big),
            (5, "http://a.b.com/q", "short"), (6, "http://a.b.com/q", "short"), (7, "http://é.com/\n", "é" * 300_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")
    got = records(spark, pages).collect()
    shape = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(set(shape), key=str) == sorted(set(expected_records(rows)), key=str)
    assert {r.page_id: r.url for r in got} == {r[0]: r[1] for r in rows}
    assert records(spark, pages.limit(0)).count() == 0


def test_one_page_id_with_several_urls(spark):
    """Urls that differ in scheme or host case alone give a row each, not a row per pair."""
    big = "y" * 200
    rows = [(1, "http://a.com/x", big), (1, "https://a.com/x", big), (1, "http://A.com/x", "other"), (2, "https://a.com/x", big)]
    got = records(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.url) for r in got) == sorted(r[:2] for r in rows)
    assert [r.record_type for r in got if r.page_id == 2] == ["revisit"]


def test_index_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_ROWS", 3)
    fs, path = warc.open_fs(warc.folders(spark)[1])
    caps = spark.createDataFrame([(warc.url_key(f"http://h{i % 7}.com/"), i, "f", i, 1) for i in range(100)], "key string, page_id long, file string, at long, size long")
    want = spark.createDataFrame([(f"http://h{i % 7}.com/", i) for i in range(100)] + [("http://none.com/", 3)], "url string, page_id long")
    folder = warc.folders(spark)[1]
    got = warc.lookup(want, warc.write_index(caps, folder), folder).collect()
    assert sorted(r["at"] for r in got) == list(range(100))


def test_url_rules(spark):
    urls = ["http://example.com/en/1", "https://WWW.example.com/en/1", "http://a.example.com/en/2", "http://x.com", "http://x.com/", "http://a.net/es/1",
            "http://net/fr/", "http://notnet/fr/", None, "no scheme", "http://casino-win.example.org/en/1?a#b", "http://a.org/de/1", "://?x"]
    pages = spark.createDataFrame([(i, u, "<p>casino words here</p>" * 3) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r for r in urlfilter.judge(pages).collect()}
    assert [got[i].rule for i in range(13)] == ["example.com/en/", "www.example.com/en/", "example.com/en/", None, "com/", "net/es/", "net/fr/", None, None, None, None, None, None]
    assert [got[i].verdict for i in (0, 1, 2, 4, 5, 6)] == ["block", "allow", "block", "allow", "block", "block"]
    assert (got[8].host, got[8].path, got[9].host) == ("", "", "") and (got[10].host, got[10].path) == ("casino-win.example.org", "/en/1")
    assert got[1].host == "www.example.com" and got[3].path == "" and all(r.verdict in ("allow", "block") for r in got.values())
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_url_words_and_weights_of_all_tokens(spark):
    words = "qu" + "abcdefghij" * 3
    pages = [(0, "http://zorpblim.org/casino", "zorp blim"), (1, f"http://{words}zorp.org/", words), (2, "http://casino.org/rareone", ""),
             (3, "http://other.org/rareone", ""), (4, "http://other.org/", "")]
    pages += [(10 + i, f"http://site{'abcdefghij'[i % 10]}.org/page", "zorpb lim and") for i in range(40)]
    got = {r.page_id: r for r in urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(got) == len(pages) and got[0].tokens == ["h:zorpb", "h:lim", "h:org", "p:casino"]
    assert got[1].tokens[:2] == ["h:" + words, "h:zorp"]  # words seen once, and of over 24 letters
    assert got[3].score > got[4].score  # "rareone" occurs with a blocked host


def test_url_segmentation_and_verdicts(spark):
    s = urlfilter.Segmenter({"cheap": 50, "pills": 50, "now": 30, "che": 1, "a": 5})
    assert s.words("cheappillsnow") == ["cheap", "pills", "now"] and "".join(s.words("zzqcheap" * 50)) == "zzqcheap" * 50
    got = QUERIES["op2_url_words"](spark, "/root/testdata/sf0.01").where("rule is null").collect()
    bad = [r for r in got if any(w in r.host for w in ("casino", "pills", "bets", "spam", "adult", "ads-"))]
    assert all((r.verdict == "block") == (r in bad) for r in got)


def test_embeddings_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows], float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    ids, linked = [r.vec_id for r in rows], u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    got = {r.vec_id: r for r in QUERIES["op7_itq_near_dup"](spark, sf).collect()}
    n = sum(got[i].n_links for i in ids)
    assert all(got[i].n_links <= linked[k].sum() for k, i in enumerate(ids)) and n >= 0.97 * linked.sum()


def test_embeddings_recall_at_the_threshold(spark):
    rng = np.random.default_rng(5)
    a = rng.standard_normal((1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((1500, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.952 * a + np.sqrt(1 - 0.952 ** 2) * b
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, near]))]
    got = {r.vec_id: r for r in itq.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    hits = sum(got[i].n_links >= 1 and got[i + 1500].component_id == i for i in range(1500))
    assert hits >= 0.95 * 1500


def test_embeddings_scaled_copies_and_a_second_dimension(spark):
    rng, rows, pairs = np.random.default_rng(6), [], []
    for dim, n, mean in ((64, 1000, 1.0), (32, 600, 0.0)):
        a = rng.standard_normal((n, dim)) + mean
        near = a + 0.1 * rng.standard_normal((n, dim)) * np.linalg.norm(a, axis=1, keepdims=True) / dim ** 0.5
        near *= rng.uniform(0.3, 3, (n, 1))
        at = len(rows)
        rows += [(at + i, v.tolist()) for i, v in enumerate(np.concatenate([a, near]))]
        pairs.append([(at + i, at + n + i) for i in range(n)])
    got = {r.vec_id: r for r in itq.link(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    for p in pairs:
        assert sum(got[i].n_links >= 1 and got[i].component_id == got[j].component_id for i, j in p) >= 0.98 * len(p)


def test_embeddings_plan_keeps_its_miss_bound():
    for rows in (10**4, 10**6, 10**8, 10**9):
        for bits in (32, 64):
            width, rotations = itq.plan(rows, bits)
            assert (1 - (1 - np.arccos(0.95) / np.pi) ** width) ** (rotations * (bits // width)) <= 0.01


def test_embeddings_odd_rows(spark):
    v = [1.0] + [0.0] * 7
    rows = [(1, v), (2, v), (2, v), (3, None), (4, [0.0] * 8), (5, [None] + v[1:]), (6, [float("nan")] + v[1:]), (None, v), (7, [1.0, 2.0]), (8, []),
            (9, [-x for x in v]), (10, [2.0] + v[1:])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, key int")
    got = itq.link(df).collect()
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert len(got) == len(rows) and by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[10] == (3, 1, False) and by[9] == (0, 9, True)
    assert all(by[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8)) and by[None] == (0, None, True)
    assert itq.link(df.limit(0)).count() == 0 and itq.link(df.where("vec_id in (3, 4)")).count() == 2


@pytest.fixture(scope="module")
def vocabulary():
    import tiktoken
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    assert ranks == {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return ranks, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("leaf", [1, 3, 4096])
def test_tree_bpe_equals_the_library(vocabulary, monkeypatch, leaf):
    ranks, library = vocabulary
    monkeypatch.setattr(bpe, "LEAF_CHARS", leaf)
    codec, rng = bpe.Codec(ranks, P.PATTERN), random.Random(leaf)
    parts = ["a", "b", " ", "  ", "\n", "'", "s", "re", "'ll", "é", "1", "!", "...", "　", "日本", "😀", "the", "\x1c", "\x85", "\t", " ", "ǆ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["a" * 3000, " " * 999 + "x", "é=" * 700]
    for t in texts:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t) and codec.decode(ids) == t.encode()


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_joined_halves_equal_merges(vocabulary, monkeypatch, leaf):
    monkeypatch.setattr(bpe, "LEAF_BYTES", leaf)
    tree, rng = bpe.TreeBpe(vocabulary[0]), random.Random(leaf)
    for _ in range(500):
        data = "".join(rng.choice("abcdestn aéß=") for _ in range(rng.randint(1, 90))).encode()
        assert tree.tree(data) == tree.merge(data)


def test_bpe_query_and_odd_rows(spark, odd, docs, vocabulary):
    _, library = vocabulary
    for source in (docs.limit(40), odd):
        rows = source.select("doc_id", "text").collect()
        want = []
        for d, t in rows:
            ids = np.array(library.encode_ordinary(t or ""), "<u4")
            want.append((d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        got = [tuple(r) for r in bpe_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe_digests(odd.limit(0)).count() == 0
    kept = bpe.encode_decode(odd.withColumnRenamed("score", "token_ids"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert kept.columns[-2:] == ["_token_ids", "decoded"] and kept.count() == odd.count()


@pytest.mark.parametrize("n", [1, 63, 64, 129, 5000, 70_000])
def test_range_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), np.zeros(n, int), np.full(n, 50256), rng.integers(0, 3, n), rng.pareto(0.3, n).astype(int) % 50257):
        data = tokenfile.encode_block(ids, 50257)
        assert np.array_equal(tokenfile.decode_block(data, n, tokenfile._shape(n)[0], 50257), ids)
    assert len(tokenfile.encode_block(np.tile(np.arange(500), 200), 50257)) < 150_000


def expected_files(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    out, start = {}, 0
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out[d] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_token_files(spark, docs):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op9_token_files"](spark, SF).collect()}
    assert got == expected_files([(r.doc_id, r.text) for r in docs.collect()])


def test_token_files_odd_rows_and_small_blocks(spark, odd, monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_IDS", 1000)
    rows = odd.dropDuplicates(["doc_id"]).select("doc_id", "text").collect() + [(20, "<|endoftext|> x")]
    folder = tokenfile.token_folder(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = tokenfile.write_ids(df, folder, P.path("byte_bpe_50k.json"), P.PATTERN)
    got = {r.doc_id: (r.start, r.n_tokens, zlib.crc32(r.token_ids)) for r in tokenfile.read_ids(manifest, folder).collect()}
    assert got == expected_files([tuple(r) for r in rows])
    empty = tokenfile.token_folder(spark)
    assert tokenfile.read_ids(tokenfile.write_ids(df.limit(0), empty, P.path("byte_bpe_50k.json"), P.PATTERN), empty).count() == 0


def test_broken_token_file_is_found():
    import io
    out = io.BytesIO()
    w = tokenfile.FileWriter(out, 50257, 2)
    w.add(1, np.arange(3000))
    w.close()
    data = bytearray(out.getvalue())
    assert [(d, s, len(i)) for d, s, i in tokenfile.read_file(io.BytesIO(data), len(data), 50257)] == [(1, 0, 3001)]
    data[500] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        list(tokenfile.read_file(io.BytesIO(data), len(data), 50257))


def test_unseen_matches_take_rows_in_order():
    """A match takes the next row where it is looked up first; the library runs no threads beside Spark's tasks."""
    memo = tokenfile.Memo()
    assert [memo[w] for w in ("a", "b", "a", "c")] == [0, 1, 0, 2] and memo.since(1) == ["b", "c"] and memo.since(3) == []
    tok = tokenfile.Tokenizer(P.path("byte_bpe_50k.json"), P.PATTERN)
    list(tok(["some words, and more words", None, ""]))
    seen = len(tok.memo)
    assert [x.tolist() for x in tok(["more words"])] == [tok.library.encode("more words", add_special_tokens=False).ids] and len(tok.memo) >= seen
    assert "TOKENIZERS_PARALLELISM" in os.environ


def test_leaf_memo_is_bounded_alone(monkeypatch):
    """A worker remembers few leaves, whatever the number of matches it remembers; the ids do not change."""
    monkeypatch.setattr(bpe, "MAX_LEAVES", 10)
    codec = bpe.Codec(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    texts = [f"zq{n}xv kwpt{n} blorf{n}gnu" for n in range(100)]
    got = [codec.encode(t) for t in texts]
    assert len(codec.bpe._leaf) <= 10 and len(codec.words) > 10 and [codec.decode(e).decode() for e in got] == texts
    monkeypatch.undo()
    plain = bpe.Codec(codec.bpe.ranks, P.PATTERN)
    assert got == [plain.encode(t) for t in texts]


def test_match_memo_keeps_what_is_met_again(monkeypatch):
    """The memo of matches stays within its bound, and a match met all along is encoded once."""
    monkeypatch.setattr(bpe, "MAX_WORDS", 20)
    codec = bpe.Codec(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    met, match = [], codec.bpe.match
    monkeypatch.setattr(codec.bpe, "match", lambda data: met.append(data) or match(data))
    for n in range(100):
        assert codec.decode(codec.encode(f" qzoften qz{n}")).decode() == f" qzoften qz{n}"
        assert len(codec.words) + len(codec.words.old) <= 20
    assert met.count(b" qzoften") == 1
