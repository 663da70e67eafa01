"""The corpus pipeline: five stages over ``documents``.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet and rereads as the next
stage's docs.  All but the last return the columns of documents.

A table without rows passes through every stage.  Null texts become empty;
further columns of docs are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starweave.llm import packing, personal_data, simhash, suffix_dedup, toxicity
from starweave.llm.common import persist, small_side, table, workers_import
from starweave.llm.components import components

ORACLE_SQL = None   # a classifier and fingerprints are not SQL: tested against brute force


DUPLICATES_BROADCAST = 500_000


def slim(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _row): the other columns travel in a struct, so their
    names never meet those an operator makes."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.struct(F.lit(True).alias("-"), *rest).alias("_row"))


def widen(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again; n_chars follows the text."""
    def column(c: str):
        if c == "n_chars":
            return F.length("text").cast(docs.schema[c].dataType).alias(c)
        return F.col(c) if c in ("doc_id", "text") else F.col("_row").getField(c).alias(c)

    return rows.select(*[column(c) for c in docs.columns])


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = toxicity.train_on(spark, docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(spark, slim(docs), model, "toxicity")
    return widen(scored.where(F.col("toxicity") < toxicity.DECISION), docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: the one with the smallest doc_id; of
    rows with that doc_id, the one with the least text hash.  Groups are of
    fingerprints, so rows that only share a doc_id stay.  Rows without a
    doc_id stay."""
    workers_import(spark)
    rows = slim(docs).withColumn("th", F.xxhash64("text"))
    keyed = persist(spark, simhash.keyed_fingerprints(rows).where("doc_id is not null"), "fingerprints")
    firsts = keyed.groupBy("fp").agg(F.min(F.struct("doc_id", "th")).alias("first"))
    firsts = persist(spark, firsts.withColumn("node", F.col("fp")), "classes")
    roots = components(spark, simhash.links(spark, firsts.select("fp", "node"), simhash.MAX_BITS))
    kept = (firsts.join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("first").alias("first"))
            .select("first.doc_id", "first.th"))
    copies = persist(spark, keyed.select("doc_id", "th").distinct().join(kept, ["doc_id", "th"], "left_anti"), "copies")
    rows = rows.join(small_side(copies, DUPLICATES_BROADCAST), ["doc_id", "th"], "left_anti")
    repeated = persist(spark, keyed.groupBy("doc_id", "th").count().where("count > 1").select("doc_id", "th"), "repeated-rows")
    if not repeated.isEmpty():
        few = small_side(repeated, DUPLICATES_BROADCAST)
        first = Window.partitionBy("doc_id", "th").orderBy(F.xxhash64("text"))
        one = (rows.join(few, ["doc_id", "th"], "left_semi").withColumn("r", F.row_number().over(first)).where("r = 1").drop("r"))
        rows = rows.join(few, ["doc_id", "th"], "left_anti").unionByName(one)
    return widen(rows, docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat a document of a smaller id;
    documents of which nothing is left go."""
    workers_import(spark)
    cut = suffix_dedup.remove_repeats(spark, slim(docs), as_text=True)
    kept = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    return widen(kept.withColumnRenamed("kept", "text"), docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data generalised to its kind."""
    return widen(personal_data.sanitise(personal_data.find_personal_data(spark, slim(docs))), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 1024 tokens."""
    workers_import(spark)
    return packing.pack(spark, packing.token_pieces(docs))


STAGES = [("toxicity", toxic), ("simhash", near_duplicate), ("suffix_dedup", repeats),
          ("personal_data", private), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = persist(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
