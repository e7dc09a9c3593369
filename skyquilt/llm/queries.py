"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fold, fresh_dir
from .exact_dedup import exact_dedup
from .langid import identify, learn
from .line_dedup import WHOLE, line_decisions
from .lm import score
from .minhash import near_duplicates
from .mixing import mix, realised
from .packing import pack
from .quality import judge
from .resharding import read_shards, rewrite_affected, solve
from .secrets import learn as learn_secrets
from .secrets import scan

OLD_SHARDS, SHARDS = 32, 40


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), k=3, percent=85)


def op2_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 32 shards by a hash of the id to 40 of near equal bytes: the affected shards are written, and read again for the result.

    All that the files say comes from them; old_shard is the hash of the id. Shards that no transfer touches are not written; their rows
    come from the placement.
    """
    docs, old = documents(spark, sf_dir), F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS)).cast("int")
    solved, root = solve(docs, old, OLD_SHARDS, SHARDS), fresh_dir(spark, "shards")
    done = rewrite_affected(docs, solved, root)
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", "old_shard"]
    text = F.coalesce(F.col("text"), F.lit(""))
    size, crc = (F.octet_length(text) + 16).cast("long"), F.crc32(text.cast("binary"))
    rows = read_shards(spark, root, docs.schema, F.col("doc_id"), size.alias("size"), crc.alias("text_crc32"), old.alias("old_shard")).select(*columns) if done else None
    if len(done) < SHARDS:
        kept = solved.rows(docs).where(~F.col("shard").isin(done)).select(*columns)
        rows = rows.union(kept) if done else kept
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior", "votes")


def op5_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_decisions(documents(spark, sf_dir), **WHOLE)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, f"{sf_dir}/documents.parquet")


def op7_crf_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scan(docs, learn_secrets(docs))


def op8_gru_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)
    found = identify(docs.select("doc_id", "held_out", "text"), learn(docs.where("not held_out")))
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_phrases").alias("phrases"))


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each time that a document is taken, with its place: by pass, turn, block, rank and key."""
    mixed = realised(mix(documents(spark, sf_dir)))
    return mixed.select("doc_id", "source", "mix_tokens", "mix_weight", "mix_budget", "mix_copies", "mix_pass", "mix_turn", "mix_block", "mix_rank", "mix_key")


QUERIES = {f.__name__: f for f in (op1_minhash_near_dedup, op2_reshard, op3_best_fit_packing, op4_quality_rules, op5_fuzzy_line_dedup, op6_exact_dedup, op7_crf_secrets, op8_gru_scoring, op9_language_id, op10_temperature_mixing)}

ORACLES = {
    "op6_exact_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id)""",
}
