"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and
returns the columns of ``documents``; the last returns packed sequences.  ``run``
writes every stage's result to the shared folder before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm import language, lines, mixing, packing, simhash
from rivulet.llm.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def small_batches(spark):
    """Whole texts go to Python ``BATCH_ROWS`` at a time, or fewer if the session
    says so: frames are run after their stage has returned, so this stays set."""
    now = int(spark.conf.get(BATCH))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))


def language_id(spark, docs, sf_dir):
    """Documents whose language is rejected go; ``lang`` becomes the predicted one.

    Null, empty and letterless texts are rejected; ties between languages have no
    margin and are rejected; repeated rows are treated alike; a null id teaches
    nothing; no rows give no rows.
    """
    small_batches(spark)
    learned = language.learn(docs.where(language.fold() != 0))
    found = language.identify(docs, learned).where("not rejected")
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def line_dedup(spark, docs, sf_dir):
    """Aligned blocks go from later documents; a document nothing is left of goes too.

    Documents without a removed line stay as they are, also null and empty texts
    and null ids.  Of equal texts the smallest id stays; repeated rows (one id,
    one text) are the same document and stay, for the next stage; documents of
    one id go by text hash.
    """
    small_batches(spark)
    found = lines.line_dedup(docs)
    left = F.col("removed").isNull() | F.col("text").rlike(r"\S")
    return found.where(left).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def simhash_dedup(spark, docs, sf_dir):
    """Of each group of near duplicates the smallest (id, text hash) stays.

    A null id is the largest.  Null and wordless texts are near no other; of rows
    of one id and one text, nulls too, one stays.
    """
    small_batches(spark)
    key = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.xxhash64("text").alias("h"))
    keyed = docs.withColumn("key", key)
    groups = simhash.near_duplicates(keyed, "key")
    gone = groups.where(F.col("key") != F.col("group")).select("key").distinct()
    # rows of one key are equal texts of one id: the first stays
    return keyed.dropDuplicates(["key"]).join(gone, "key", "left_anti").select(*COLUMNS)


def mix_sources(spark, docs, sf_dir):
    """Each document as often as the mix takes it.

    Null ids and sources are ids and sources; null and wordless texts have no
    words and are not taken.  Rows of one id, source and text are taken in all
    as often as the mix says, spread evenly over them.
    """
    same = ["doc_id", "source", "text_hash"]
    times = mixing.mix(docs).groupBy(*same).agg(F.sum(F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0)).cast("int").alias("times"), F.count("*").alias("copies")).where("times > 0")
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in same]
    held = docs.withColumn("text_hash", F.xxhash64("text")).alias("a").join(times.alias("b"), on).select("a.*", "b.times", "b.copies")
    # the n-th of several equal rows takes the n-th part; single rows need no rank
    rank = F.row_number().over(Window.partitionBy(*same).orderBy("lang", "n_chars"))
    many = held.where("copies > 1").withColumn("times", F.expr("div(times, copies)").cast("int") + (rank <= F.col("times") % F.col("copies")).cast("int")).where("times > 0")
    taken = held.where("copies = 1").unionByName(many)
    return taken.select(*COLUMNS, F.explode(F.sequence(F.lit(1), "times")).alias("time")).drop("time")


def pack_sequences(spark, docs, sf_dir):
    """Pieces of sequences of 2048 ids; null and empty texts are the end id
    alone, repeated rows are packed each, ties go to the oldest window."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup), ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]

ORACLE_SQL = None  # stages 1, 2, 3 and 5 have no SQL form


def run(spark, sf_dir):
    docs, scratch, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline"), []
    for name, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
        scratch.drop(*last)
        last = [docs]
    return docs
