"""Unbroken runs in the base patterns, and probes that do not depend on the size."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from starweave.llm import personal_data, simhash
from starweave.llm.common import workers_import

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
         "card": r"[0-9](?:[ -]?[0-9])+", "phone": r"\+[0-9][ ().0-9-]+[0-9]"}


@pytest.fixture(autouse=True)
def _workers(spark):
    workers_import(spark)


def test_patterns_find_what_the_plain_ones_find(spark):
    r = random.Random(6)
    texts = ["".join(r.choice(al) for _ in range(r.randint(0, 60))) for al in ("a.@_-é ", "12.3 ", "1.1.@a_", "+1( )-.2 ") for _ in range(400)]
    texts += ["a@b.c_d@e.f", "a@b.c@d.e", "x_a@b.c-@d.e", "1.2.3.4.5.6.7.8", "11.2.3.4", "a@b", "@a.b", "%@-.-"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for kind, plain in PLAIN.items():
        got = [x.f for x in df.select(F.regexp_extract_all("text", F.lit(personal_data.PATTERNS[kind]), F.lit(0)).alias("f")).collect()]
        assert got == [re.findall(plain, t) for t in texts], kind


def test_runs_of_a_megabyte(spark):
    n = 1 << 20
    texts = [(1, "a" * n + " x@y.z"), (2, "1" * n + " 1.2.3.4"), (3, "a" * n + "@b.c"), (4, "+1" + "(" * n)]
    start = time.time()
    out = {r.doc_id: r for r in personal_data.base_spans(spark.createDataFrame(texts, "doc_id long, text string"))
           .select("doc_id", *[F.size(f"sp_{k}").alias(k) for k in personal_data.KINDS]).collect()}
    assert time.time() - start < 120
    assert [out[i].email for i in (1, 2, 3)] == [1, 0, 1] and out[2].ip == 1


def test_probes_do_not_depend_on_the_size(spark):
    r = random.Random(5)
    made = []
    for n in (50, 5000):
        fps = spark.createDataFrame([(r.getrandbits(64) - (1 << 63),) for _ in range(n)], "fp long")
        plan = simhash.choose_plan(spark, fps, 4)
        assert sum(t + 1 for _, t in plan) == 4 + 1 and sorted(b for g, _ in plan for b in g) == list(range(64))
        made.append(sum(len(simhash.flips(len(g), t)) for g, t in plan))
    assert made[0] == made[1]
