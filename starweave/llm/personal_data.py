"""Personal data: base patterns and information-theoretic sanitisation.

Base spans are e-mail addresses, IP addresses, card and phone numbers.  A span
value is a protected entity, and so are the groups it belongs to (its kind, mail
domain, network or number prefix): values of one text only still show what is
written beside values of their group.  For the words of the texts that hold it the corpus
tells how much they give away: with N distinct texts, of which n_e hold the entity,
n_t the word (outside base spans) and n_te both, anywhere in the text, the disclosure of the entity by the word is
PMI / IC = log(N n_te / (n_t n_e)) / log(N / n_e), 1 when the word never occurs
without the entity.  Every co-occurrence is counted, once is enough; a pair
counts as more than chance when its log-likelihood ratio reaches log(T / ERROR),
T being the number of entities times that of words (a Bonferroni bound on all
pairs that could have met).  Words of such pairs whose disclosure reaches ``DISCLOSURE`` are spans as
well (kind term) wherever they occur.  ``sanitise`` generalises every span to its
kind.  All of it is DataFrame operations on the JVM.

Copies of a text count once, before any shuffle of words.  Counts are over all
documents.

Defined results: null text is empty and has no spans; repeated rows get equal
results; a null doc_id is kept; an empty table gives no rows.  Positions are
code points, the end is exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import persist, small_side, table

KINDS = ("email", "ip", "card", "phone")
# Possessive quantifiers where what follows cannot match inside, and no start
# inside a run whose head failed or was taken (after a match, \G, the rest of a
# run is a run of its own): the same matches as the plain patterns in time
# linear in the text, however long its runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MAY_HOLD = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
TERM_KIND = "term"
WORD = r"[\p{L}\p{N}]+"
MARKED = r"[\p{L}\p{N}\x01]+"   # a word, or what touches a span cut out
ERROR = 0.05                # chance of any pair by accident
DISCLOSURE = 0.9
TERMS_BROADCAST = 100_000
COPIES_BROADCAST = 1_000_000
NO_SPANS = "array<struct<s:int,k:int,e:int>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), worth) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(rf"^(?:{BYTE}\.){{3}}{BYTE}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _located(text: Column, pieces: Column, found: Column, kind: int, keep) -> Column:
    """Spans of the matches, from the lengths of what lies between them; only
    those for which ``keep`` holds are collected."""
    empty = F.array().cast(NO_SPANS)
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, i: Column) -> Column:
        value = F.element_at(found, i)
        s = acc["at"] + F.length(F.element_at(pieces, i))
        e = s + F.length(value)
        span = F.array(F.struct(s.alias("s"), F.lit(kind).alias("k"), e.alias("e")))
        return F.struct(e.alias("at"), F.when(keep(value), F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    got = F.aggregate(F.sequence(F.lit(1), F.size(found)), start, step, lambda acc: acc["out"])
    return F.when(F.size(found) > 0, got).otherwise(empty)


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (text not null) with sp_<kind> arrays of spans (s, k, e) and
    ``base``, all of them by start, then kind."""
    may = {k: F.col("text").rlike(MAY_HOLD[k]) for k in KINDS}
    none = F.array().cast("array<string>")
    out = docs.withColumns({f"f_{k}": F.when(may[k], F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))).otherwise(none)
                            for k in KINDS})
    out = out.withColumns({f"p_{k}": F.when(F.size(f"f_{k}") > 0, F.split("text", PATTERNS[k], -1)).otherwise(none)
                           for k in KINDS})
    out = out.withColumns({f"sp_{k}": _located(F.col("text"), F.col(f"p_{k}"), F.col(f"f_{k}"), i,
                                               lambda v, k=k: valid(k, v)) for i, k in enumerate(KINDS)})
    out = out.drop(*[f"{x}_{k}" for x in "fp" for k in KINDS])
    return out.withColumn("base", F.array_sort(F.concat(*[f"sp_{k}" for k in KINDS])))


def _outside(text: Column, base: Column) -> Column:
    """Distinct words (lower case) of a text that touch no span of ``base``."""
    plain = F.regexp_replace(text, "\u0001", " ")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        new = F.concat(acc["out"], F.substring(plain, acc["at"] + 1, x["s"] - acc["at"]), F.lit("\u0001"))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    cut = F.aggregate(base, start, step, lambda acc: F.concat(acc["out"], F.substring(plain, acc["at"] + 1, F.length(plain))))
    marked = F.array_distinct(F.regexp_extract_all(F.lower(cut), F.lit(MARKED), F.lit(0)))
    return (F.when(F.size(base) > 0, F.filter(marked, lambda w: ~F.contains(w, F.lit("\u0001"))))
            .otherwise(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))))


def _entities(text: Column, base: Column) -> Column:
    """The distinct protected entities of the spans of a text: values and their groups."""
    def of(x: Column) -> Column:
        value = F.lower(F.substring(text, x["s"] + 1, x["e"] - x["s"]))
        kind, digits = F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["k"] + 1), _digits(value)
        parts = {"email": [F.substring_index(value, "@", -1)],
                 "ip": [F.substring_index(value, ".", 2), F.substring_index(value, ".", 3)],
                 "card": [F.substring(digits, 1, 6)], "phone": [F.substring(digits, 1, 4), F.substring(digits, 1, 7)]}
        groups = F.array().cast("array<string>")
        for k, group in parts.items():
            groups = F.when(kind == k, F.array(*[F.concat_ws(" ", F.lit(f"{k}{i}"), g) for i, g in enumerate(group)])).otherwise(groups)
        return F.concat(F.array(value, F.concat(F.lit("kind "), kind)), groups)

    return F.array_distinct(F.flatten(F.transform(base, of)))


def _likelihood(n: float, n_te: Column, n_t: Column, n_e: Column) -> Column:
    """Log-likelihood ratio (nats) of dependence against independence."""
    def cell(o: Column, row: Column, col: Column) -> Column:
        return F.when(o > 0, o * F.log(o * F.lit(n) / (row.cast("double") * col))).otherwise(0.0)

    return (cell(n_te, n_t, n_e) + cell(n_t - n_te, n_t, n - n_e) + cell(n_e - n_te, n - n_t, n_e)
            + cell(n - n_t - n_e + n_te, n - n_t, n - n_e))


def disclosing_terms(spark: SparkSession, docs: DataFrame, disclosure: float = DISCLOSURE,
                     error: float = ERROR) -> tuple[DataFrame, DataFrame]:
    """(terms, where): every word that discloses an entity, with its
    disclosure; and the rows (doc_id, th, term) of the documents that hold it.
    ``docs`` is (doc_id, text, th), th the hash of the text."""
    # Of copies of a text the rows with the least doc_id stand for it; same is their number.
    texts = docs.groupBy("th", "doc_id").agg(F.count(F.lit(1)).alias("same"))
    texts = texts.groupBy("th").agg(F.min(F.struct("doc_id", "same")).alias("first"), F.sum("same").alias("copies"))
    texts = persist(spark, texts, "texts")
    n = float(texts.count())
    worded = base_spans(docs).withColumn("words", _outside(F.col("text"), F.col("base")))
    own = persist(spark, worded.where(F.size("base") > 0)
                  .select("th", _entities(F.col("text"), F.col("base")).alias("entities"), "words").dropDuplicates(["th"]), "entity-texts")
    copied = persist(spark, texts.where("copies > 1").select("th", F.col("first.doc_id").alias("stands"), "first.same"), "copied-texts")
    words = (worded.select("doc_id", "th", "words").join(small_side(copied, COPIES_BROADCAST), "th", "left")
             .where(F.col("same").isNull() | F.col("doc_id").eqNullSafe(F.col("stands")))
             .select(F.coalesce("same", F.lit(1)).alias("same"), F.explode("words").alias("term")))
    n_t = (words.groupBy("term", "same").agg(F.count(F.lit(1)).alias("n"))    # before the shuffle a row a word
           .groupBy("term").agg(F.sum(F.expr("n div same")).alias("n_t")))
    n_t = persist(spark, n_t, "words")
    n_e = own.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    n_e = persist(spark, n_e, "entity-counts")
    least = math.log(max(n_e.count() * n_t.count(), 1) / error)
    # Bounds, nothing is lost: no pair is likelier than n_te = n_t = n_e, nor, once n_te is known, than n_t = n_te.
    n_e = persist(spark, n_e.where(_likelihood(n, F.col("n_e"), F.col("n_e"), F.col("n_e")) >= least), "entities")
    held = own.select(F.explode("entities").alias("entity"), "words").join(small_side(n_e, TERMS_BROADCAST).select("entity"), "entity")
    joint = (held.select("entity", F.explode("words").alias("term")).groupBy("entity", "term")
             .agg(F.count(F.lit(1)).alias("n_te")).join(n_e, "entity")
             .where(_likelihood(n, F.col("n_te"), F.col("n_te"), F.col("n_e")) >= least))
    joint = persist(spark, joint, "entity-terms")
    ic = F.log(F.lit(n) / F.col("n_e"))
    ratio = F.log(F.lit(n) * F.col("n_te") / (F.col("n_t") * F.col("n_e"))) / ic
    terms = (joint.join(n_t, "term").where(_likelihood(n, F.col("n_te"), F.col("n_t"), F.col("n_e")) >= least)
             .withColumn("disclosure", F.when(ic > 0, ratio))
             .groupBy("term").agg(F.max("disclosure").alias("disclosure")).where(F.col("disclosure") >= disclosure))
    terms = persist(spark, terms, "disclosing-terms")
    every = docs.select("doc_id", "th", F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("term"))
    return terms, every.join(small_side(terms.select("term"), TERMS_BROADCAST), "term")


def find_personal_data(spark: SparkSession, docs: DataFrame, disclosure: float = DISCLOSURE,
                       error: float = ERROR) -> DataFrame:
    """``docs`` with text (null: empty), sp_<kind>, base and spans, the base
    spans and those of disclosing words; columns of ``docs`` with these names
    are replaced."""
    made = {"th", "base", "spans", "terms", *[f"{x}_{k}" for x in ("sp", "f", "p") for k in KINDS]}
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made and c != "text"],
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    _, where = disclosing_terms(spark, rows.select("doc_id", "text", "th"), disclosure, error)
    by_doc = persist(spark, where.groupBy(F.col("doc_id").alias("d_id"), F.col("th").alias("d_th"))
                     .agg(F.collect_set("term").alias("terms")), "document-terms")
    out = rows.join(small_side(by_doc, TERMS_BROADCAST),
                    F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("th") == F.col("d_th")), "left").drop("d_id", "d_th")
    none = F.array().cast("array<string>")
    out = base_spans(out)
    out = out.withColumn("f_w", F.when(F.col("terms").isNotNull(), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).otherwise(none))
    out = out.withColumn("p_w", F.when(F.size("f_w") > 0, F.split("text", WORD, -1)).otherwise(none))
    found = _located(F.col("text"), F.col("p_w"), F.col("f_w"), len(KINDS),
                     lambda v: F.array_contains("terms", F.lower(v)))
    out = out.withColumn("sp_term", found)
    free = F.filter("sp_term", lambda t: ~F.exists("base", lambda b: (t["s"] < b["e"]) & (b["s"] < t["e"])))
    return out.withColumn("spans", F.array_sort(F.concat("base", free))).drop("f_w", "p_w", "sp_term", "terms", "th")


def label(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM_KIND)])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def sanitise(found: DataFrame) -> DataFrame:
    """Replaces every span of the text by its kind, e.g. [EMAIL]; of
    overlapping spans the first names the replacement."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in (*KINDS, TERM_KIND)])
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        new = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.element_at(names, x["k"] + 1))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("spans", start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return found.withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(text))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = find_personal_data(spark, docs)
    return found.select("doc_id", *[F.size(f"sp_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(label("base"), 256).alias("base_sha256"), label("spans").alias("spans"))
