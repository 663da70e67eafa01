"""WARC, URL lists, neighbours, toxicity, personal data and the pipeline."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starweave.llm import learned_ann, personal_data, toxicity, url_lists, warc
from starweave.llm.common import workers_import

from .fixtures import DOCS, docs, rows

PAGES = "page_id long, url string, html string, extra int"


@pytest.fixture(autouse=True)
def _workers(spark):
    workers_import(spark)


def test_warc_round_trip(spark):
    data = [(5, "http://a/x\r\ny", "<p>é</p>", 1), (2, None, "<p>é</p>", 1), (9, "http://b", None, 1), (7, "http://b", "", 1),
            (2, None, "<p>é</p>", 1), (None, "http://c", "only", 1), (11, "http://d", "x" * 200_000, 1), (12, "http://d", "x\r\n\r\ny", 1)]
    got = warc.read_archives(spark, warc.write_archives(spark, spark.createDataFrame(data, PAGES), archive_bytes=300)).collect()
    want = []
    for i, _, html, _ in data:
        raw = (html or "").encode()
        first = min((j for j, _, h, _ in data if (h or "") == (html or "") and j is not None), default=None)
        again = i is not None and first < i
        want.append((i, len(raw), warc.base32_sha1(raw), "revisit" if again else "response", first if again else None))
    assert Counter(want) == Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got)
    assert {r["payload"].decode() for r in got if r["payload"] is not None} == {(h or "") for _, _, h, _ in data}
    empty = warc.write_archives(spark, spark.createDataFrame([], PAGES))
    assert warc.read_archives(spark, empty).count() == 0


def test_warc_damage_is_found():
    good = warc.record_bytes(1, "u", b"abc", warc.base32_sha1(b"abc"))
    assert warc.parse_record(good)["payload"] == b"abc"
    with pytest.raises(warc.WarcError):
        warc.parse_record(good.replace(b"abc", b"abd"))
    with pytest.raises(warc.WarcError):
        warc.parse_record(good[:-5])
    import io

    stream = warc.gzip_member(good) + warc.gzip_member(good)
    assert list(warc.members(io.BytesIO(stream), block=7)) == [good, good]
    with pytest.raises(warc.WarcError):
        list(warc.members(io.BytesIO(stream[:-3])))


def test_url_lists_as_of(spark):
    e = [("b", "block", "domain", "x.org", 10, "add"), ("b", "block", "domain", "x.org", 20, "remove"),
         ("a", "allow", "prefix", "w.x.org/ok", 12, "add"), ("b", "block", "domain", None, 1, "add"),
         ("b", "block", "domain", "x.org", 30, "add"), ("b", "block", "domain", "x.org", 30, "add")]
    entries = spark.createDataFrame(e, "list string, verdict string, kind string, pattern string, t long, action string")
    entries = entries.withColumn("ts", F.timestamp_seconds("t"))
    c = [(1, "http://W.x.org/ok/1", 15), (2, "http://w.x.org/okay", 15), (3, "http://w.x.org/ok", 11), (4, "http://x.org", 20),
         (5, "http://x.org", 30), (6, "http://notx.org", 15), (7, None, 15), (8, "http://x.org/a", None), (2, "http://w.x.org/okay", 15)]
    caps = spark.createDataFrame(c, "page_id long, url string, t long").withColumn("fetch_ts", F.timestamp_seconds("t"))
    got = sorted((r["page_id"], r["blocked"], r["n_active"]) for r in url_lists.evaluate(caps, url_lists.intervals(entries)).collect())
    assert got == [(1, False, 2), (2, True, 1), (2, True, 1), (3, True, 1), (4, False, 0), (5, True, 1), (6, False, 0),
                   (7, False, 0), (8, False, 0)]
    assert url_lists.evaluate(caps, url_lists.intervals(entries.limit(0))).where("blocked").count() == 0


def test_nearest_is_exact_on_one_part(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(120, 8)).round(2)
    data = [(i, [float(v) for v in x[i]], 0) for i in range(120)]
    data += [(200 + i, data[3][1], 1) for i in range(30)] + [(300, None, 0), (301, [0.0] * 8, 0), (302, [float("nan")] * 8, 0),
             (303, [1.0], 0), (None, data[0][1], 0), (304, [None] * 8, 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = learned_ann.nearest(spark, df, 5, F.col("vec_id") % 20 == 0).toPandas()
    ok = {i: np.array(v) for i, v, _ in data if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    for q in (i for i in ok if i % 20 == 0):
        s = sorted(((-float((ok[q] * v).sum()), i) for i, v in ok.items() if i != q))[:5]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine.vec_id.tolist() == [i for _, i in s]
    assert learned_ann.nearest(spark, df.limit(0), 5).count() == 0


def test_learned_parts_reach_recall(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(20, 16))
    x = (centres[r.integers(0, 20, 4096)] + 0.3 * r.normal(size=(4096, 16)))
    router, probes = learned_ann.learn(x, 16_000)
    part = router.logits(x).argmax(1)
    assert len(router.b2) == 8 and probes < 8 and np.bincount(part, minlength=8).min() > 0


def test_small_tables_are_routed():
    x = np.random.default_rng(2).normal(size=(500, 16))
    router, probes = learned_ann.learn(x, 500)
    assert len(router.b2) == 4 and 1 <= probes <= 4 and np.bincount(router.logits(x).argmax(1), minlength=4).min() > 0


def test_balanced_parts():
    r = np.random.default_rng(1)
    x = r.normal(size=(256, 8))
    parts = learned_ann.balanced_parts(learned_ann.neighbour_graph(x, 8), 4)
    assert np.bincount(parts).tolist() == [64] * 4


def _toxic_data(n=240):
    r = random.Random(4)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(150)]
    out, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        t = [r.choice(words) for _ in range(30)] + (["zorgle" + r.choice("abc"), "zorgle" + r.choice("def")] if bad else [])
        r.shuffle(t)
        out.append((i, " ".join(t), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    return out, labels


def test_toxicity_learns_and_ignores_held_out(spark):
    data, labels = _toxic_data()
    data += [(1000, None, "en", "s", 0), (1001, "", "en", "s", 0), (None, "zorglea", "en", "s", 0)]
    lab = spark.createDataFrame(labels + [(5, 1, 0), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train_on(spark, docs(spark, data), lab)
    got = toxicity.score(spark, docs(spark, data), model).toPandas()
    truth = {i: t for i, _, t in labels}
    hits = [((s >= toxicity.DECISION) == bool(truth[i])) for i, s in zip(got.doc_id, got.score) if i in truth]
    assert np.mean(hits) > 0.95 and got.score.between(0, 1).all() and len(got) == len(data)
    none = toxicity.train_on(spark, docs(spark, data), lab.limit(0))
    assert none is None and toxicity.score(spark, docs(spark, data), none).where("score <> 0").count() == 0
    flipped = lab.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.score(spark, docs(spark, data), toxicity.train_on(spark, docs(spark, data), flipped)).toPandas()
    assert np.allclose(again.score, got.score)


def test_toxicity_trains_on_every_labelled_row(spark):
    """Also on texts of more than 100,000 characters, and over several shards."""
    data, _ = _toxic_data(60)
    long_ones = [(i, "zorgle " * 14_300 + "zorgle", "en", "s", 1) for i in range(100, 106)]
    data = [row for row in data if "zorgle" not in row[1]] + long_ones
    lab = spark.createDataFrame([(i, 1, int(i >= 100)) for i, *_ in data], "doc_id long, quality int, toxic int")
    model = toxicity.train_on(spark, docs(spark, data), lab)
    got = toxicity.score(spark, docs(spark, data), model).toPandas().set_index("doc_id").score
    assert (got[got.index >= 100] >= toxicity.DECISION).all() and (got[got.index < 100] < toxicity.DECISION).all()


def test_toxicity_of_several_shards(spark):
    data, labels = _toxic_data(600)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    models = [toxicity.train_on(spark, docs(spark, data).repartition(n), lab, shard_rows=100) for n in (1, 5)]
    assert np.array_equal(models[0].params, models[1].params) and models[0].thresholds == models[1].thresholds
    got = toxicity.score(spark, docs(spark, data), models[0]).toPandas()
    truth = {i: t for i, _, t in labels}
    assert np.mean([(s >= toxicity.DECISION) == bool(truth[i]) for i, s in zip(got.doc_id, got.score)]) > 0.9


KIND_RE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _base(text):
    out = []
    for k, kind in enumerate(KIND_RE):
        for m in re.finditer(KIND_RE[kind], text):
            d = re.sub(r"\D", "", m.group())
            luhn = sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(d[::-1])) % 10 == 0
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == "card" and 12 <= len(d) <= 19 and luhn or kind == "phone" and 9 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return ",".join(f"{personal_data.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_personal_data_base_and_terms(spark):
    r = random.Random(3)
    filler = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    data = [(i, " ".join(r.sample(filler, 30)), "en", "s", 1) for i in range(60)]
    for i in range(6):   # one person, named in different texts
        data.append((100 + i, " ".join(r.sample(filler, 12)) + " Quastor ann@x.example.org " + " ".join(r.sample(filler, 12)), "en", "s", 1))
    data += [(200, "1.2.3.4.5.6.7.8 é+1 (988) 555-2485, 4111 1111 1111 1111 4111-1111-1111-1112 300.1.1.1 a@b a@b.c%d@e.f",
              "en", "s", 1), (201, None, "en", "s", 1), (202, "", "en", "s", 1), (203, "1" * 5000 + " +" + "2" * 10, "en", "s", 1),
             (None, "x@y.z", "en", "s", 1), (200, "dup 8.8.8.8", "en", "s", 1)]
    found = personal_data.find_personal_data(spark, docs(spark, data)).select(
        "doc_id", "text", personal_data.label("base").alias("base"), personal_data.label("spans").alias("spans")).collect()
    assert len(found) == len(data) and all(x["base"] == _base(x["text"]) for x in found)
    for x in found:
        terms = [t for t in x["spans"].split(",") if t.startswith("term")]
        named = "Quastor" in x["text"]
        assert len(terms) == named
        if named:
            _, s, e = terms[0].split(":")
            assert x["text"][int(s):int(e)] == "Quastor"
    clean = {x["doc_id"]: x["text"] for x in personal_data.sanitise(
        personal_data.find_personal_data(spark, docs(spark, data))).select("doc_id", "text").collect()}
    assert "[TERM] [EMAIL]" in clean[100] and clean[202] == "" and clean[0] == data[0][1]
    assert personal_data.find_personal_data(spark, docs(spark, [])).count() == 0



def _terms(spark, data):
    """Lower-case words that are term spans, of every document."""
    got = personal_data.find_personal_data(spark, docs(spark, data)).select("text", personal_data.label("spans").alias("spans")).collect()
    spans = [(x["text"], t.split(":")) for x in got for t in x["spans"].split(",") if t.startswith("term")]
    return Counter(text[int(s):int(e)].lower() for text, (_, s, e) in spans)


def _far_texts(n, address):
    """Texts with an address, and far from it a name, a short name and a customer number."""
    r = random.Random(5)
    filler = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    data = [(i, " ".join(r.choices(filler, k=40)), "en", "s", 1) for i in range(300)]
    return data + [(1000 + i, f"Dear Quastor Li 77812 {' '.join(r.choices(filler, k=40))} {address(i)}", "en", "s", 1) for i in range(n)]


def test_terms_of_whole_texts(spark):
    data = _far_texts(8, lambda i: "ann@x.example.org")
    data += data[-1:] * 20      # copies count once
    assert _terms(spark, data) == {w: 28 for w in ("dear", "quastor", "li", "77812")}


def test_terms_of_pooled_values(spark):
    """Every address occurs in one text only; the domain and the kind tell."""
    data = _far_texts(12, lambda i: f"p{i}.q{i}@x.example.org seen{i}")
    assert _terms(spark, data) == {w: 12 for w in ("dear", "quastor", "li", "77812")}
    assert not _terms(spark, data[:301])    # one text shows nothing


def test_pipeline_stages_one_by_one(spark, tmp_path):
    import corpus_pipeline as P
    from starweave.llm import simhash

    data, labels = _toxic_data(120)
    extra = [(500 + i, t or "", "en", "s", n) for i, (_, t, _, _, n) in enumerate(rows(12))]
    data = data + extra + [(900, "mail ann@x.example.org now please", "en", "s", 1), (None, "no id here", "en", "s", 1), data[1]]
    spark.createDataFrame(data, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d = str(tmp_path)
    start = spark.read.parquet(f"{d}/documents.parquet").withColumn("kept", F.lit(1)).withColumn("score", F.lit("clash"))
    kept = P.toxic(spark, start, d)
    assert kept.columns == start.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert sum(i in ids for i, _, t in labels if t) < 5 and sum(i in ids for i, _, t in labels if not t) > 80
    near = P.near_duplicate(spark, start, d)
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(spark, start).collect()}
    left = Counter(r["doc_id"] for r in near.select("doc_id").collect())
    assert near.columns == start.columns and left == Counter({**{c: 1 for c in groups.values() if c is not None}, None: 1})
    cut = P.repeats(spark, start, d)
    assert cut.columns == start.columns and cut.where("n_chars <> length(text)").count() == 0
    safe = P.private(spark, start, d)
    assert safe.where("doc_id = 900").first()["text"] == "mail [EMAIL] now please"
    assert P.packed(spark, start, d).count() >= len(data)
    out = P.run(spark, d)
    assert out.columns[:3] == ["doc_id", "piece", "start"] and out.count() > 50
    nothing = start.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, nothing, d).count() == 0


def test_rows_of_one_doc_id_are_told_apart(spark):
    """A clashing id: only the row of the other group's text goes."""
    import corpus_pipeline as P

    r = random.Random(9)
    a, b, c = (" ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(60)) for _ in range(3))
    data = [(1, a, "en", "s", 1), (7, a, "en", "s", 1), (7, b, "en", "s", 1), (7, c, "en", "s", 1), (7, c, "en", "s", 1),
            (9, b, "en", "s", 1), (None, a, "en", "s", 1)]
    left = [(x["doc_id"], x["text"]) for x in P.near_duplicate(spark, docs(spark, data), "").collect()]
    assert Counter(left) == Counter([(1, a), (7, b), (7, c), (None, a)])


def test_registered_names():
    import __spark_entry__ as E

    names = list(E.queries())
    assert "pipeline" in names and sum(bool(re.match(r"op\d+_", n)) for n in names) == 13
    assert hashlib.sha256(b"").hexdigest()[:4] == "e3b0"
