"""Packing, SimHash, fingerprints, repeats, subwords against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from starweave.llm import bwt_merge, packing, prefix_hash, simhash, subwords, suffix_dedup
from starweave.llm.common import workers_import
from starweave.llm.components import components

from .fixtures import DOCS, docs, rows


@pytest.fixture(autouse=True)
def _workers(spark):
    workers_import(spark)


def test_packing_matches_tokenizer_and_best_fit(spark):
    cap = 64
    got = packing.pack(spark, packing.token_pieces(docs(spark), capacity=cap), cap).toPandas()
    tk = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, text, *_ in rows():
        ids = np.array(tk.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        for k, (s, n) in enumerate(packing.piece_bounds(len(ids), cap)):
            want.append((i, k, s, n, zlib.crc32(ids[s:s + n].tobytes())))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(want) == Counter(got[names].itertuples(index=False, name=None))
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= cap
    lengths = sorted((w[3] for w in want), reverse=True)
    bins = []
    for n in lengths:      # one piece at a time
        fit = min((b for b in range(len(bins)) if bins[b] >= n), key=lambda b: bins[b], default=None)
        if fit is None:
            bins.append(cap)
            fit = len(bins) - 1
        bins[fit] -= n
    assert got.sequence_id.nunique() == len(bins)


def test_chunked_encoder_equals_whole_texts(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 500)      # cleared many times
    enc, r = packing.TextEncoder(packing.default_vocabulary()), random.Random(3)
    texts = ["  a\n\n b \t c ", "a \x1c b \x85c  \n", "x\0y z", "<|endoftext|> <|endoftext|>", "é" * 300 + " é"]
    texts += ["".join(r.choice(" \n\ta1é'. \x1c\x85\0<|>\U0001f642s") for _ in range(r.randint(1, 60))) for _ in range(1500)]
    for text in texts:
        want = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert enc.encode(text) == np.array(want, "<u4").tobytes(), repr(text)


def test_packing_pieces_and_empty(spark):
    assert packing.piece_bounds(5, 4) == [(0, 1), (1, 4)] and packing.piece_bounds(8, 4) == [(0, 4), (4, 4)]
    assert packing.pack(spark, packing.token_pieces(docs(spark, []))).count() == 0


def test_capacity_tree():
    t = packing.CapacityTree(10)
    for c in (3, 7, 10):
        t.add(c, 1)
    assert [t.tightest(n) for n in (1, 3, 4, 8, 10)] == [3, 3, 7, 10, 10]
    t.add(10, -1)
    assert t.tightest(8) is None


def _components(ids, fps, bits):
    fp = np.array(fps, np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= bits
    label = np.array(ids)
    while True:
        new = np.array([label[near[i]].min() for i in range(len(ids))])
        if (new == label).all():
            return label.tolist()
        label = new


@pytest.mark.parametrize("limit", [20_000, 1])
def test_simhash_links_all_pairs(spark, limit):
    r = np.random.default_rng(2)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = []
    for b in base.tolist():
        for _ in range(4):
            fps.append(b)
            for bit in r.integers(0, 64, 3):
                b ^= 1 << int(bit)
    fps = sorted(set(fps))
    classes = spark.createDataFrame([(f - (1 << 64) if f >= 1 << 63 else f, i) for i, f in enumerate(fps)], "fp long, node long")
    e = simhash.links(spark, classes, 4, group_limit=limit)
    got = {x["node"]: x["root"] for x in components(spark, e).collect()}
    assert [got.get(i, i) for i in range(len(fps))] == _components(range(len(fps)), fps, 4)


def test_simhash_documents(spark):
    got = simhash.near_duplicates(spark, docs(spark)).toPandas()
    assert len(got) == len(rows())
    for d in got.itertuples():
        text = next(t for i, t, *_ in rows() if i == d.doc_id)
        assert d.fp % (1 << 64) == simhash.fingerprint(text)
    want = _components(got.doc_id.tolist(), [f % (1 << 64) for f in got.fp.tolist()], 4)
    assert got.component_id.tolist() == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.near_duplicates(spark, docs(spark, [])).count() == 0


def test_threshold_allocation():
    cost, ts = simhash.allocate([[0, 5, 9], [0, 1, 2], [0, 4, 30]], 0)
    assert sum(ts) == 0 and cost == min(a + b + c for i, a in enumerate((0, 5, 9), -1) for j, b in enumerate((0, 1, 2), -1)
                                        for k, c in enumerate((0, 4, 30), -1) if i + j + k == 0)


def test_prefix_hash_fingerprints(spark):
    got = prefix_hash.fingerprint_documents(spark, docs(spark)).toPandas()
    data = sorted(((i, t or "") for i, t, *_ in rows()), key=lambda x: (-x[0], x[1]))
    want = []
    for k, (i, t) in enumerate(data):
        n = len(t)
        e = t[:n - n // 3] + data[(k + 1) % len(data)][1][:n // 3]
        same = next((p for p, (x, y) in enumerate(zip(t, e)) if x != y), min(n, len(e)))
        want.append((i, n, hashlib.sha256(e.encode()).hexdigest(), prefix_hash.Document(t).print,
                     prefix_hash.Document(e).print, same))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "common_prefix"]
    assert Counter(want) == Counter(got[names].itertuples(index=False, name=None))
    assert got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    assert prefix_hash.fingerprint_documents(spark, docs(spark, [])).count() == 0
    one = prefix_hash.fingerprint_documents(spark, docs(spark, [rows()[0]])).first()
    assert one["near_next"] == 1.0


def test_common_extension():
    a, b = prefix_hash.PrefixHash("xxhello world"), prefix_hash.PrefixHash("hello wolf")
    assert a.common_extension(2, b, 0) == 8 and a.equal(2, b, 0, 5) and not a.equal(0, b, 0, 2)


def test_merged_transforms():
    import random

    r = random.Random(5)
    for _ in range(20):
        s = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 25))) for _ in range(r.randint(1, 10))]
        own, depth = np.array([r.randint(0, 4) for _ in s]), r.randint(1, 6)
        least = {}
        for x, o in zip(s, own):
            for i in range(len(x) - depth + 1):
                least[x[i:i + depth]] = min(least.get(x[i:i + depth], 99), o)
        for x, g in zip(s, bwt_merge.least_owner(s, own, depth, symbols=r.randint(4, 50))):
            assert g.tolist() == [least[x[i:i + depth]] for i in range(len(x) - depth + 1)]


@pytest.mark.parametrize("hot", [5000, 2])
def test_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_DOCS", hot)
    data = [(i, t, "kept?", i) for i, t, *_ in rows()] + [(None, rows()[4][1], "x", 1), (6, "other " + rows()[0][1], "y", 2)]
    df = spark.createDataFrame(data, "doc_id long, text string, note string, extra long")
    got = suffix_dedup.remove_repeats(spark, df).toPandas()
    least = {}
    for i, t, *_ in data:
        raw = (t or "").encode()
        for k in range(len(raw) - 49 if i is not None else 0):
            least[raw[k:k + 50]] = min(least.get(raw[k:k + 50], 1 << 60), i)
    want = Counter()
    for i, t, *_ in data:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - 49 if i is not None else 0):
            if least[raw[k:k + 50]] < i:
                gone[k:k + 50] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        want[(i, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    out = Counter((None if x != x else int(x), *rest) for x, *rest in got[names].itertuples(index=False, name=None))
    assert out == want and sum(n for (_, _, r, *_), n in want.items() if r) > 5
    assert suffix_dedup.remove_repeats(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("lattice", [False, True])
def test_subwords_equal_the_library(spark, lattice):
    data = rows()[:6] + rows()[40:] if lattice else rows()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = subwords.encode_documents(spark, docs(spark, data), with_ids=True, lattice=lattice)
    out = {(r["doc_id"], r["ids_crc32"]): r for r in got.collect()}
    assert got.count() == len(data)
    for i, t, *_ in data:
        ids = sp.encode(t or "")
        r = out[i, zlib.crc32(np.array(ids, "<u4").tobytes())]
        assert r["ids"] == ids and r["n_pieces"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    texts = {r["doc_id"]: r["text"] for r in subwords.decode_documents(got).collect()}
    assert all(texts[i] == (t or "").replace("▁", " ") for i, t, *_ in data)


def test_the_query_runs_the_lattice(spark, monkeypatch, tmp_path):
    data = rows()[:30] + [(900, "x" * 3000 + " \u6f22\U0001f600\x01", "en", "s", 1)]
    docs(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    joined = []
    plain = subwords.word_edges
    monkeypatch.setattr(subwords, "word_edges", lambda *a, **b: joined.append(1) or plain(*a, **b))
    out = {(r["doc_id"], r["decoded_sha256"]): r for r in subwords.op10_sentencepiece(spark, str(tmp_path)).collect()}
    vocab = subwords.Vocabulary(subwords.default_model())
    score, ids = {p: s for p, _, s in vocab.pieces}, {p: i for p, i, _ in vocab.pieces}
    assert joined
    for i, t, *_ in data:
        pieces = [p for w in subwords.words_of(t or "") for p in subwords.best_path(w, score)]
        want = [x for p in pieces for x in ([ids[p]] if p in ids else [vocab.first_byte + c for c in p.encode()])]
        r = out[i, hashlib.sha256((t or "").replace("\u2581", " ").encode()).hexdigest()]
        assert (r["n_pieces"], r["ids_crc32"]) == (len(want), zlib.crc32(np.array(want, "<u4").tobytes()))


def test_viterbi_fold(spark):
    score = {"a": -1.0, "b": -1.5, "ab": -1.2, "ba": -0.4, "aba": -3.0, "c": -2.0}
    rnd = random.Random(3)
    # segments of 64 symbols: words around and over their borders, unbroken runs, symbols outside the vocabulary
    words = ["abab", "abac", "bbaab", "a", "zab", "a" * 63, "ab" * 32, "ba" * 64 + "a", "ab" * 5000]
    words += sorted({"".join(rnd.choice("abcz\u6f22\U0001f600") for _ in range(rnd.randint(1, 200))) for _ in range(40)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    pieces = spark.createDataFrame([(p, i, s) for i, (p, s) in enumerate(score.items())], "piece string, id int, score double")
    found = subwords.word_edges(df, pieces, 3, 4).select(
        F.expr("concat_ws('', transform(segs, g -> g.own))").alias("word"),
        subwords.spelled(subwords.viterbi_fold(F.col("segs"), 3), 100).alias("ids"))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {r["word"]: r["ids"] for r in found.collect()}
    ids = {p: i for i, p in enumerate(score)}
    assert got == {w: [x for p in subwords.best_path(w, score) for x in ([ids[p]] if p in ids else [100 + c for c in p.encode()])]
                   for w in words}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert subwords.encode_documents(spark, empty).count() == 0


def test_route_chunks_hold_whole_routes():
    rnd = random.Random(5)
    rows_ = sorted((rnd.randint(0, 40) if rnd.random() < 0.7 else 7, rnd.randbytes(rnd.randint(50, 300))) for _ in range(900))
    for step in (1, 13, 200, 900):
        batches = [pa.RecordBatch.from_arrays([pa.array([r for r, _ in part], pa.int32()), pa.array([c for _, c in part], pa.binary())],
                                              names=["route", "content"])
                   for part in (rows_[i:i + step] for i in range(0, 900, step))]
        chunks = [t.to_pylist() for t in suffix_dedup.route_chunks(iter(batches), size=4000)]
        assert [(r["route"], r["content"]) for c in chunks for r in c] == rows_
        routes = [{r["route"] for r in c} for c in chunks]
        assert len(chunks) > 10 and sum(map(len, routes)) == len(set().union(*routes))
        # a chunk is full only with its last route
        assert all(sum(len(r["content"]) for r in c if r["route"] != c[-1]["route"]) < 4000 for c in chunks)
