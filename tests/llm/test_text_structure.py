"""Main text of pages, fill-in-middle and source divergence against brute force."""

import hashlib
import html as H
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starweave.llm import fill_middle, host_consensus, source_divergence
from starweave.llm.common import workers_import

from .fixtures import DOCS, docs, rows

PAGES = "page_id long, url string, html string, host string, paths string, salt int"


@pytest.fixture(autouse=True)
def _workers(spark):
    workers_import(spark)


# ------------------------------------------------------------------ main text
SHELL = """<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style><script>var a="</article><p>no</p>";</script></head>
<body class="with-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href="/">menu</a></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice"><p>we use cookies, a lot of them, on every page of this site and on all others</p></div>{}
<div id="comments"><p>a reader comment that is much, much longer than the text of the page itself, as they are</p></div>
<form><p>subscribe</p><input value=">"></form><footer>foot</footer></body></html>"""


def page(body):
    return SHELL.format(body)


def test_main_text_of_one_page():
    get = lambda body: host_consensus.extract(page(body), [])
    assert get("<article><h1>T &amp; t</h1><p>a<b>b</b>c <br>d<p>second<ul><li>x<li>y</ul></article>") == "T & t abc d second x y"
    assert get('<div class="post-17" title="a>b"><p>Text &lt;P&gt; &#233; &nbsp;\t end</p><aside>no</aside>tail</div>') == "Text <P> é end tail"
    assert get("<article><header><h1>Head</h1></header><p>p</p><button>no<div>no</button></article>") == "Head p"
    assert get("<article></article>") == ""
    assert host_consensus.extract(None, []) == host_consensus.extract("", []) == ""
    assert host_consensus.extract("just text & more <", []) == "just text & more <"      # the root is a container
    assert host_consensus.extract("<nav>menu</nav><p>cut <b>off</b> <a href='x", []) == "cut off"
    assert host_consensus.extract("<div><p>cut <b>off</b> <a href='x", []) == "cut off"


def test_very_long_pages_are_linear():
    n = 100_000
    for s in ("<div>" * n, "<p>" * n, "</div>" * n, '<a "' * n, "<button>" * n + "</div>" * n, '<div class="ad">' * n + "<h1>x"):
        host_consensus.extract(s, [])
    long = " ".join(["word"] * 300_000)
    assert host_consensus.extract(f"<article><p>{long}</p></article>", []) == long


def consensus_pages():
    """Two page plans on one host; some pages would choose another container by themselves."""
    out, want = [], {}
    for i in range(60):
        text = f"short {i}" if i % 7 == 0 else f"the text of page {i} " + "with several words " * 5
        other = "an unrelated block that is longer than a short page " * 2
        body = f'<div class="story s{i}"><p>{text}</p></div><div class="teaser"><p>{other if i % 7 == 0 else "x"}</p></div>'
        out.append((i, f"HTTP://u@A.example:80/{i}", page(body), "h", "p", 1))
        want[i] = " ".join(text.split())
    return out, want


def test_host_vote_decides(spark):
    data, want = consensus_pages()
    alone = {i: host_consensus.extract(h, []) for i, _, h, *_ in data}
    assert alone[7] != want[7]
    data += [(100, "http://b.example/", page("<article><p>one</p></article>"), None, None, None), (101, None, None, None, None, None),
             (102, None, page("<article><p>no host</p></article>"), None, None, None), (None, "http://b.example/", "", "x", "y", 2),
             (100, "http://b.example/", page("<article><p>one</p></article>"), None, None, None)]
    want |= {100: "one", 101: "", 102: "no host", None: ""}
    df = spark.createDataFrame(data, PAGES).repartition(5)
    for limit in (host_consensus.HOSTS_BROADCAST, 0):        # broadcast, and the salted join
        got = host_consensus.extract_main_text(spark, df, broadcast_rows=limit).collect()
        assert Counter((r["page_id"], r["text"], r["n_chars"]) for r in got) == Counter((i, want[i], len(want[i])) for i, *_ in data)
    paths = {r["host"]: r["labels"] for r in host_consensus.host_paths(spark, df).collect()}
    assert paths["a.example"][0] == "html>body.with-sidebar>div.s#.story" and set(paths) == {"a.example", "b.example"}
    assert host_consensus.extract_main_text(spark, df.limit(0)).count() == 0


def test_pages_of_the_tables(spark):
    """Every article of the given pages, by an independent cut with patterns."""
    found = {r["page_id"]: r["text"] for r in host_consensus.op11_host_consensus(spark, "/root/testdata/sf0.01").collect()}
    given = duckdb.execute("SELECT page_id, html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for i, h in given:
        inner = h[h.index("<article>") + 9:].split("</article>")[0]
        parts = [H.unescape(re.sub("<[^>]*>", " ", x)) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert found.pop(i) == " ".join(" ".join(parts).split())
    assert not found


# ------------------------------------------------------------------ fill in the middle
def cut_by_hand(i, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(b"1:" + (b"" if i is None else str(i).encode())).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (i, len(units), "plain", None, None, text, text)
    if h[3] % 100 < 20:
        return (i, len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}", text)
    return (i, len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}", text)


def awkward(n, seed):
    r = random.Random(seed)
    texts = ["".join(r.choice("ab<PSM>é漢😀 \n1") for _ in range(r.choice([0, 1, 2, 5, 30, 400]))) for _ in range(n)]
    return [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(None, "abc def", None, None, None), (-5, "x<", "en", "s", 1),
                                                                  (9, None, "en", "s", 1), (9, "a" * 70_000 + "é" * 500, "en", "s", 1)] * 2


def test_fill_in_middle_equals_slicing(spark):
    data = awkward(400, 3) + rows()
    made = fill_middle.restore(fill_middle.fill_in_middle(docs(spark, data).withColumn("output", F.lit(1)).withColumn("n", F.lit(2))))
    got = Counter(tuple(r) for r in made.collect())
    assert got == Counter(cut_by_hand(d[0], d[1]) for d in data)
    assert {"plain", "psm", "spm"} == {k[2] for k in got}
    assert fill_middle.fill_in_middle(docs(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("window,limit", [(5, 40), (64, 1000)])
def test_windows_and_chunks_do_not_show(monkeypatch, window, limit):
    monkeypatch.setattr(fill_middle, "WINDOW", window)
    whole = fill_middle.chunks
    monkeypatch.setattr(fill_middle, "chunks", lambda column: whole(column, limit))
    data = [d for d in awkward(300, 8) if len(d[1] or "") < 1000]
    batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in data], pa.int64()), pa.array([d[1] for d in data], pa.string())],
                                       names=["doc_id", "text"])
    got = [tuple(r.values()) for b in fill_middle._restore(fill_middle._transform([batch.slice(2)])) for r in b.to_pylist()]
    assert got == [cut_by_hand(d[0], d[1]) for d in data[2:]]


def test_restore_needs_its_markers():
    broken = pa.RecordBatch.from_arrays([pa.array(["psm"]), pa.array(["<P>abc<S>d"])], names=["form", "output"])
    with pytest.raises(ValueError):
        list(fill_middle._restore([broken]))


# ------------------------------------------------------------------ divergence of sources
def divergence_by_hand(data, min_docs, top):
    words = lambda t: re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    groups, n_docs = {}, {}
    for _, text, lang, source, _ in data:
        w = words(text)
        groups.setdefault((lang or "", source or ""), Counter()).update(w)
        n_docs.setdefault(lang or "", Counter()).update(set(w))
    out = set()
    for lang, seen in n_docs.items():
        kept = [t for t, k in seen.items() if k >= min_docs]
        of = {s: c for (x, s), c in groups.items() if x == lang}
        all_of = sum(of.values(), Counter())

        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        share, q = {s: p(c) for s, c in of.items()}, p(all_of)
        f = lambda x, y: (x - y) * (x - y) // y
        for s in of:
            parts = {"pair": [(o, sum(f(share[s][t], share[o][t]) for t in kept)) for o in of if o != s],
                     "term": [(t, f(share[s][t], q[t])) for t in kept if of[s][t] and share[s][t] > q[t]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, v, k) for k, (item, v) in enumerate(items[:top] if part == "term" else items, 1)}
    return out


def grouped(n, seed):
    r = random.Random(seed)
    vocab = ["".join(r.choice("aBcdéÉ漢") for _ in range(r.randint(1, 4))) for _ in range(120)]
    out = [(i % 90, " ".join(r.choice(vocab[:20 + 10 * (i % 10)]) for _ in range(r.randint(0, 60))), r.choice(["en", "de", None]),
            f"s{min(int(r.expovariate(.4)), 9)}", 1) for i in range(n)]
    return out + [(1, None, "en", None, 1), (2, "", "xx", "only", 1), (3, "unique words", "yy", "a", 1), (3, "other", "yy", "b", 1),
                  (4, "a1b_C-d[e]f`g{h}i\x7fj", "en", "s0", 1), (5, "long " * 60_000 + "Éé", "en", "s1", 1)] + out[:5]


@pytest.mark.parametrize("shard,block", [(8192, 64), (7, 3)])
def test_divergence_equals_brute_force(spark, shard, block):
    data = grouped(250, 4)
    df = docs(spark, data).withColumn("term", F.lit("x")).withColumn("blk", F.lit(1))
    got = source_divergence.divergence(spark, df, top=15, shard_terms=shard, block_sources=block).collect()
    assert {tuple(r) for r in got} == divergence_by_hand(data, 3, 15) and len(got) == len(set(got))
    assert source_divergence.divergence(spark, df.limit(0)).count() == 0


def test_trees_share_equal_parts():
    r = np.random.default_rng(2)
    counts = (r.zipf(1.6, (6, 500)) - 1).clip(0, 50)
    counts[3], counts[4] = counts[1], 0
    values, levels, roots = source_divergence.hash_cons(counts)
    assert roots[3] == roots[1]                                     # equal groups are one tree
    assert sum(len(x) for x, _ in levels) < 6 * 511                 # and equal parts are one node
    a, b = np.triu_indices(6, 1)
    pair, x, y, times = source_divergence.leaf_pairs(levels, roots, a, b)
    assert len(set(zip(pair, x, y))) == len(pair)                   # each pair of leaves once
    for k in range(len(a)):
        want = Counter(zip(counts[a[k]].tolist(), counts[b[k]].tolist()))
        here = {(int(values[i]), int(values[j])): int(t) for p, i, j, t in zip(pair, x, y, times) if p == k}
        here.pop((-1, -1), None)
        assert here == want


def test_counts_beyond_64_bits_are_exact():
    values = np.array([-1, 0, 1, 10 ** 13], np.int64)
    p = source_divergence.shares(values, np.array([10 ** 13 + 1]), np.array([2]))
    assert p.tolist() == [[1] + [1 + 10 ** 9 * (v + 1) // (10 ** 13 + 3) for v in (0, 1, 10 ** 13)]]
