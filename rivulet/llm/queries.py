"""The ten operators as queries over the tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, embeddings, language, lines, media, mixing, packing, quality, sharding, simhash

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = language.fold() == 0
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs.where(~held)))
    return found.select("doc_id", (language.fold() == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op2_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "votes", "posterior", "quality", (F.col("quality") >= 0.5).alias("accepted"))


def op4_sharding(spark, sf_dir):
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", sharding.shard_names())


def op5_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_media(spark, sf_dir):
    found = media.media_digests(table(spark, sf_dir, "documents"))
    feature = F.concat_ws(";", F.transform("clips", lambda c: F.concat_ws(",", c.first_frame, c.frames, F.format_number(c.peak, 6))))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


def op7_simhash(spark, sf_dir):
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op8_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(c).cast("long").alias("conv_id"), F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(x).alias("text")) for c, t, r, x in PLANTED])))
    done = chat.format_trees(chat.chains(rows.unionByName(extra)))
    turns = chat.parse(F.col("formatted"))
    said = done.select(F.col("tree").alias("conv_id"), turns.alias("turns"), chat.masked(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return said.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


OP8_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), shown AS (
  SELECT *, '### ' || url_encode(role) || ': ' || replace(replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#'), '##', '#\#') || '</turn>' || chr(10) AS shown FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(shown))::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""


def op9_embeddings(spark, sf_dir):
    return embeddings.embedding_components(table(spark, sf_dir, "embeddings"))


def op10_lines(spark, sf_dir):
    found = lines.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.coalesce(F.aggregate("removed", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1), F.lit(0))
    return found.select("doc_id", "removed", gone.alias("n_removed"), F.length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_language, op2_mixing, op3_quality, op4_sharding, op5_packing, op6_media, op7_simhash, op8_chat, op9_embeddings, op10_lines)}


def op4_sql() -> str:
    """The filled table as a literal; slots and the join are the SQL's own."""
    table = ",".join(map(str, sharding.fill(sharding.shard_names(), sharding.SLOTS)))
    return f"""
WITH filled AS (SELECT string_split('{table}', ',') AS shards), slots AS (
  SELECT doc_id, n_chars, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.SLOTS} AS slot FROM documents
), names AS (SELECT unnest(range({sharding.SLOTS})) AS slot, unnest(shards) AS shard FROM filled)
SELECT doc_id, n_chars, slot, 'shard-' || lpad(shard, 5, '0') AS shard FROM slots JOIN names USING (slot)
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_sharding": op4_sql(), "op8_chat": OP8_SQL}
