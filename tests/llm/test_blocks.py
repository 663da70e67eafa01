"""Rows that tasks send in blocks: as many as parts, whatever the documents."""

import random

import numpy as np
import pyarrow as pa
import pytest

from starweave.llm import packing, toxicity
from starweave.llm import suffix_dedup as sd


def passages(n, seed=4):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 8)))
    common = [" ".join(word() for _ in range(14)) for _ in range(12)]
    return [" ".join(x for c in r.sample(common, 6) for x in (word(), c, word())).encode() for _ in range(n)]


class Hot:
    value = np.zeros(0, np.int32)


def merged_blocks(texts, parts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "text"])
    row, _, _, key = sd.segments(texts)
    keys = [sd.short_key(np.unique(key[row == i]).view(np.int64)) for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int32()))], names=["doc_id", "text", "keys"])
    half = batch.num_rows // 2
    sent = [b for x in (batch.slice(0, half), batch.slice(half)) for b in sd._segment_blocks(Hot, 50, 24, False, parts)(iter([x]))]
    of = lambda bs, p: (b.filter(pa.array(b.column("part").to_numpy() == p)) for b in bs)
    spans = [list(sd._merge_buckets(50, parts)(of(sent, p))) for p in range(parts)]
    docs = [r for p in range(parts) for b in sd._doc_spans(of([b for s in spans for b in s], p)) for r in b.to_pylist()]
    return spans, docs


@pytest.mark.parametrize("n", [40, 200])
def test_span_rows_grow_with_parts_not_with_documents(n):
    texts, parts = passages(n), 4
    spans, docs = merged_blocks(texts, parts)
    assert all(sum(b.num_rows for b in s) <= parts for s in spans)
    seen, want = set(), {}
    for i, t in enumerate(texts):
        own = {t[k:k + 50] for k in range(len(t) - 49)}
        got = [(k, k + 50) for k in range(len(t) - 49) if t[k:k + 50] in seen]
        seen |= own
        if got:
            want[i] = sd.merge_spans(got)
    assert {r["doc_id"]: (r["spans"][0]["starts"], r["spans"][0]["ends"]) for r in docs} == want
    assert len(docs) == len(want) > n // 2


def test_unions_equal_merged_spans():
    r = random.Random(2)
    rows = [(r.randint(-3, 3), r.randint(0, 1), a, a + r.randint(1, 9)) for a in (r.randint(0, 60) for _ in range(300))]
    got = list(zip(*(x.tolist() for x in sd.union_spans(*(np.array(c) for c in zip(*rows))))))
    want = []
    for d, t in sorted({x[:2] for x in rows}):
        want += [(d, t, a, z) for a, z in zip(*sd.merge_spans([x[2:] for x in rows if x[:2] == (d, t)]))]
    assert got == want


def test_strings_set_aside_share_no_window():
    r = random.Random(3)
    for _ in range(50):
        s = ["".join(r.choice("ab") for _ in range(r.randint(6, 14))).encode() for _ in range(r.randint(1, 6))]
        got = sd.may_share(pa.array(s, pa.binary()), 6)
        grams = [{x[i:i + 6] for i in range(len(x) - 5)} for x in s]
        assert got.tolist() == [any(g & h for j, h in enumerate(grams) if j != i) for i, g in enumerate(grams)]


class Start:
    model = toxicity.Model(7)
    value = (model.params, np.full_like(model.params, 1e-6))


def test_a_task_sends_the_sum_of_its_shards():
    r = random.Random(8)
    rows = [(k, " ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(r.randint(0, 30))), r.randint(0, 1), r.random() < 0.25)
            for k in range(5) for _ in range(70)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.int32(), pa.bool_()))],
                                       names=["shard", "text", "toxic", "held"])
    packed = list(toxicity._blocked(iter([batch])))
    assert [b.column("shard")[0].as_py() for b in packed] == list(range(5))
    assert sum(b.column(f"n{int(h)}{y}")[0].as_py() for b in packed for h in (0, 1) for y in (0, 1)) == len(rows)
    for held in (False, True, None):
        want = [(t, y) for k, t, y, h in rows if held in (None, h)]
        got = [x for _, own in toxicity._shards(iter(packed)) for s in toxicity._slices(own, held) for x in zip(*s)]
        assert got == want
    run = toxicity._shard(Start, (1.0, 1.0), 0, 3, 7, False)
    together = pa.Table.from_batches(list(run(iter(packed)))).to_pandas()
    apart = pa.Table.from_batches([x for b in packed for x in run(iter([b]))]).to_pandas()
    assert len(together) < len(apart) and together["row"].is_unique and together["n"].max() == 5
    assert together.set_index("row").equals(apart.groupby("row").sum())


def test_texts_encoded_together(monkeypatch):
    enc, r = packing.TextEncoder(packing.default_vocabulary()), random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "\n\n", "\t", "\0", "é", "漢", "'s", "1", "\xa0", ".", " the", "\r\n", "x" * 70]
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 80)
    calls, frequent = [], [" kept", " words"]
    encode = enc.encode_chunks
    monkeypatch.setattr(enc, "encode_chunks", lambda chunks, odd: calls.append(chunks) or encode(chunks, odd))
    for _ in range(200):
        texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) + "".join(frequent) for _ in range(5)]
        want = [np.array(enc.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert enc.encode_all(texts) == want, texts
    assert len(enc.cache) <= 80 and sum(frequent[1] in c for c in calls) == 1 and len(calls) <= 200


def test_changes_of_parameters_travel_in_small_blocks():
    rng = np.random.default_rng(3)
    rows = np.sort(rng.choice(toxicity.ROWS_TOGETHER, 700, replace=False)).astype(np.int64) + toxicity.ROWS_TOGETHER
    n, values = rng.integers(1, 4, 700), rng.normal(0, 1 << 28, (700, len(toxicity.VALUES))).astype(np.int64)
    values[0, :4] = (2**63 - 1, -2**63, 0, -1)
    blob = toxicity._packed(rows, n, values)
    assert np.array_equal(toxicity._unpacked(blob), np.concatenate((rows[:, None], n[:, None], values), axis=1))
    assert len(blob) < 0.6 * 8 * (2 + len(toxicity.VALUES)) * 700
    some = toxicity._packed(rows[:300], n[:300], values[:300])
    got = toxicity._summed(pa.table({"block": pa.array([1, 1], pa.int32()), "blob": pa.array([blob, some], pa.binary())}))
    assert got["row"].to_pylist() == rows.tolist()
    assert got["n"].to_pylist() == np.concatenate((2 * n[:300], n[300:])).tolist()
    with np.errstate(over="ignore"):
        assert np.array_equal(got["p5"].to_numpy(), np.concatenate((2 * values[:300, 5], values[300:, 5])))


def test_blocks_of_changes_hold_what_a_task_sends():
    rows = [0, 5, 1023, 1024, 5000]
    sent = pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([1, 2, 1, 3, 1]),
                                       *[pa.array([i - 2, i, -i, 0, i << 40]) for i in range(len(toxicity.VALUES))]],
                                      names=["row", "n", *toxicity.VALUES])
    blocks = list(toxicity._together(iter)([sent]))
    assert [b.column("block")[0].as_py() for b in blocks] == [0, 1, 4]
    back = pa.concat_tables([toxicity._summed(pa.Table.from_batches([b])) for b in blocks])
    assert back.to_pydict() == sent.to_pydict()
