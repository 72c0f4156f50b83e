"""Packing, whitening, prefix trie: brute force, library results, odd rows."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from tripmetrics.llm import packing, trie, whitening
from tripmetrics.llm.queries import QUERIES, op11_vector_packing, op12_whitening, op13_zfast_trie

from .conftest import SF

WORDS = P.path("word_bpe_49k.json")


# -- packing -------------------------------------------------------------------

def library_ids(texts):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(WORDS)
    lib.encode_special_tokens = True
    return [e.ids + [1] for e in lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_pieces(rows, docs, limits):
    """Every id in exactly one piece, sequences gapless and within the limits."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(docs)
    for d, pieces in by_doc.items():
        ids, at = docs[d], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert np.frombuffer(r.token_ids, "<u4").tolist() == ids[at:at + r.length]
            at += r.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(r.loss_tokens for r in pieces) <= limits.loss
    return by_seq


def test_packing_whole_table(spark, docs):
    rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    want = dict(zip(rows, library_ids(list(rows.values())), strict=True))
    pieces = packing.pack_documents(docs, WORDS)
    seqs = check_pieces(pieces.collect(), want, packing.Limits())
    assert packing.padding(pieces, 2048).first().padding == 0
    used = sorted(sum(r.length for r in s) for s in seqs.values())
    assert sum(u == 2048 for u in used) > 0.5 * len(used)
    got = op11_vector_packing(spark, SF).collect()
    assert {r.doc_id for r in got} == set(want)
    assert all(r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()) for r in got)


def test_packing_odd_rows(spark, odd, monkeypatch):
    monkeypatch.setattr(packing, "CELL_EXAMPLES", 4)
    x = odd.where("doc_id is not null and doc_id <> 5").coalesce(1)
    rows = {r.doc_id: r.text for r in x.collect()}
    check_pieces(packing.pack_documents(x, WORDS).collect(), dict(zip(rows, library_ids(list(rows.values())), strict=True)), packing.Limits())
    whole = packing.pack_documents(odd, WORDS).collect()
    assert sum(r.length for r in whole if r.doc_id == 5) == 2 * [r.doc_tokens for r in whole if r.doc_id == 5][0]
    assert any(r.doc_id is None for r in whole) and packing.pack_documents(odd.limit(0), WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(odd, WORDS, packing.Limits(0, 1, 1))


def test_words_as_the_library():
    texts = ["don't stop", "İstanbul ΣΑΣ Σ", "a\x1cb\x85c\xa0d e", "क़लम é ́x", "<|startoftext|> <|endoftext|>x", "x" * 5000 + " 漢字 😀", "  \n\n ", "\t\r\n a", "१२ ½ a1b2", "end. a, b; c: d! e? f... .g ,\nİ. x.. e\u0301. q\u0338, 's. a's, ½. 漢. ﬁ."]
    rng = random.Random(3)
    texts += ["".join(rng.choice("ab'sT İé́\n\t 漢1!क़") for _ in range(200)) for _ in range(50)]
    assert [[*x.tolist(), 1] for x in packing.WordTokenizer(WORDS)(pa.array([*texts[:3], None, *texts[3:]]))] == library_ids([*texts[:3], None, *texts[3:]])


@pytest.mark.parametrize("cut", [True, False])
def test_vector_limits_bind(spark, cut):
    """Instruction data: prompts without loss, answers with; each limit binds somewhere."""
    rng = random.Random(5)
    rows = [(i, list(range(n)), rng.randint(0, n)) for i, n in enumerate(rng.choice([1, 2, 3, 40, 100, 180]) for _ in range(400))]
    rows += [(400, list(range(1000)), 900), (401, [], 0), (402, None, None), (403, [7, None, 8], 5)]
    limits = packing.Limits(256, 6, 100)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, ids array<int>, loss long, length string").coalesce(1)
    got = packing.pack_examples(df, limits, cut).collect()
    seqs = check_pieces(got, {i: [x for x in ids or [] if x is not None] for i, ids, _ in rows if ids}, limits)
    loss = {}
    for r in got:
        loss[r.doc_id] = loss.get(r.doc_id, 0) + r.loss_tokens
    assert all(loss[i] == min(b, r) for i, ids, b in rows if ids for r in [len([x for x in ids if x is not None])])
    used = [(sum(r.length for r in s), len(s), sum(r.loss_tokens for r in s)) for s in seqs.values()]
    assert any(u == 256 for u, _, _ in used) and any(m == 6 for _, m, _ in used) and any(b == 100 for _, _, b in used)
    if cut:
        assert all(u & (u - 1) == 0 for u, _, _ in used)
    else:
        assert all(r.length == r.doc_tokens for r in got if r.doc_id not in (400,) and loss[r.doc_id] <= 100)


# -- whitening -----------------------------------------------------------------

def expected_whitening(vectors, count=8):
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors], np.int64)
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return dev, values[::-1][:count], axes[:, ::-1][:, :count], y, values.sum()


def test_whitening_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    dev, values, axes, y, trace = expected_whitening([v for _, v in rows])
    got = {}
    for r in op12_whitening(spark, SF).collect():
        got[r.vec_id, r.component] = r
    assert len(got) == 8 * len(rows)
    z = np.array([[got[i, c].whitened for c in range(1, 9)] for i, _ in rows])
    want = y @ axes / np.sqrt(values)
    assert np.abs(np.abs(z) - np.abs(want)).max() < 1e-6
    assert [got[i, 1].deviation for i, _ in rows] == dev and all(r.n == len(rows) and r.identity_error <= 1e-8 for r in got.values())
    assert all(abs(got[rows[0][0], c].explained / (values[c - 1] / trace) - 1) < 1e-9 for c in range(1, 9))


def test_eigenvectors():
    rng = np.random.default_rng(2)
    for v in (np.diag([5.0, 5, 5, 2, 2, 0]), np.zeros((4, 4)), np.array([[3.0]]), np.ones((7, 7)), np.eye(9) * 4, *[(lambda a: a @ a.T)(rng.standard_normal((k, k + 2))) for k in (2, 3, 12, 60)]):
        values, axes = whitening.components(v, 8)
        k, size = min(8, len(v)), max(1.0, np.abs(v).max())
        assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:k], atol=1e-12 * size * len(v))
        assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-12 and np.abs(v @ axes - axes * values).max() < 1e-11 * size * len(v)


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(40)]
    flat = [(100 + i, [0.5, float(i % 2)]) for i in range(10)]
    rows = good + flat + [(1, good[0][1]), (None, [0.1, 0.2, 0.3]), (200, None), (201, []), (202, [1.0, None, 2.0]), (203, [float("nan")] * 3), (204, [float("inf")] * 2),
                          (300, [1e300] * 4), (301, [-1e300] * 4)]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, component string, whitened double")
    got = whitening.whiten(df).collect()
    three = [v for i, v in rows if v and len(v) == 3 and None not in v and np.isfinite(v).all()]
    assert len(three) == 42 and sum(r.n == 42 for r in got) == 42 * 3
    assert [r.component for r in got if r.n == 10] == [1] * 10 and all(abs(abs(r.whitened) - 1) < 1e-12 for r in got if r.n == 10)
    assert sum(r.vec_id is None for r in got) == 3 and not {200, 201, 202, 203, 204} & {r.vec_id for r in got}
    assert all(r.deviation is None for r in got if r.n == 2) and sum(r.n == 2 for r in got) == 2
    assert whitening.whiten(df.limit(0)).count() == 0


# -- prefix trie -----------------------------------------------------------------

def expected_trie(seqs):
    """Nodes of {conv: [(role, text)]}, by brute force."""
    members = {}
    for c, turns in seqs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, out = {}, {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    done = {}
    for node in sorted(members, key=len, reverse=True):
        below = [done[k] for k in kids.get(node, [])]
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        done[node] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
        ends = ",".join(map(str, sorted(c for c in members[node] if len(seqs[c]) == len(node))))
        out[min(members[node]), len(node)] = (min(members[node[:-1]]) if node else None, len(members[node]), len(kids.get(node, [])), *done[node],
                                              hashlib.sha256(ends.encode()).hexdigest())
    return out


def rebuilt(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            key = (t is not None, t or 0, hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).digest())
            own.setdefault(c, []).append((key, (r, x)))
    own = {c: [y for _, y in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + v[h:]
    return out


def node_rows(df):
    got = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(out) == len(got)
    return out


def test_trie_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert node_rows(op13_zfast_trie(spark, SF)) == expected_trie(rebuilt(rows))


@pytest.mark.parametrize("held", [1 << 20, 7])
def test_trie_of_many_shapes(spark, monkeypatch, held):
    """Hot prefixes, chains inside chains, copies, long chains, tries that are cut off early."""
    monkeypatch.setattr(trie, "HELD_TURNS", held)
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    rng = random.Random(held)
    seqs = {c: [("u", rng.choice("ab")) for _ in range(rng.choice([0, 1, 2, 3, 4, 7, 9, 16, 17]))] for c in range(250)}
    seqs |= {1000 + c: [("u", "hot")] * rng.randint(0, 40) + [("a", str(c % 7))] for c in range(100)} | {2000 + c: [("u", "same"), ("a", "turns")] for c in range(50)}
    lists = [(c, [(i, hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest(), len(x)) for i, (r, x) in enumerate(v)]) for c, v in seqs.items()]
    df = spark.createDataFrame(lists, "conv_id long, turns array<struct<turn: long, digest: binary, chars: long>>").repartition(5)
    assert node_rows(trie.prefix_trie(df)) == expected_trie(seqs)


def test_trie_odd_rows(spark):
    long = "é" * 200_000
    rows = [(0, 0, "user", "hi"), (0, 1, None, None), (0, 2, "user", long), (7, None, "user", "hi"), (7, 3, "user", "x"), (7, 3, "user", "x"), (7, 3, "bot", "😀"), (None, 1, "user", "no id"),
            (205, 0, "u", "only"), (-3, 1, "user", "below"), (100, 0, "", ""), (101, 5, "user", "end"), (504, 0, "user", "no head, all cut")] + [(c, t, "user", "q") for c in range(8, 30) for t in range(c % 4)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    want = rebuilt(rows)
    assert any(not v for v in want.values())
    assert node_rows(trie.prefix_trie(trie.rebuild(df))) == expected_trie(want)
    assert trie.prefix_trie(trie.rebuild(df.limit(0))).count() == 0


def test_fat_binary_search():
    """Located nodes are the deepest whose chain is a prefix, in few look-ups."""
    assert [trie.two_fattest(a, b) for a, b in ((0, 7), (0, 8), (4, 7), (6, 7), (8, 13), (3, 5))] == [4, 8, 6, 7, 12, 4]
    rng, z, kept = random.Random(1), trie.ZFastTrie(), []
    for _ in range(300):
        turns = [rng.choice("ab") for _ in range(rng.randint(1, 60))] if rng.random() < 0.5 or not kept else kept[-1][:rng.randint(1, 60)] + ["c"]
        h, chain = trie.ROOT, b""
        for t in turns:
            h = hashlib.md5(h + t.encode()).digest()
            chain += h
        at = z.locate(chain)
        ends = [k for k in range(len(z.top)) if not z.depth[k] or chain[:16 * z.depth[k]] == z.chain[k][:16 * z.depth[k]]]
        assert z.depth[at] == max(z.depth[k] for k in ends)
        z.insert([chain], [None])
        kept.append(turns)


def test_new_queries_registered():
    assert {"op11_vector_packing", "op12_whitening", "op13_zfast_trie"} <= set(QUERIES)
