"""Exact dedup by a stream with keyed state on disk."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, fresh_dir, sieve, text_or_empty, written

#: State on the executors' disks. Without fallocate a partition takes the disk it needs, not some MB for its logs at once.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normal(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", "")


def digest(norm: Column) -> Column:
    return F.sha2(norm, 256)


def absorb(spark: SparkSession, table: str, state: str, id_col: str = "doc_id", text_col: str = "text", of: Callable[[Column], Column] = digest, max_bytes: int = 256 << 30) -> DataFrame:
    """Feed the files of a Parquet table that the state has not seen yet to the keyed state, and return the state.

    table: path of a file or a folder of files. state: folder of the stream's checkpoint, in the shared folder; call again
    with the same one when files were added, and only those are read. The state lives in RocksDB on the executors'
    disks, is backed up in `state`, never expires, and holds for each digest the count, and the identifier and content
    locator (file, row) of the row that stays. Copies within a task are merged before the shuffle.
    max_bytes: most bytes of files in a micro-batch. Returns digest, group_size, code_points, keep_id, file, row.
    """
    schema = spark.read.parquet(table).schema
    head, _, last = table.rstrip("/").rpartition("/")
    # a pattern, so that a table of one file is accepted as well as a folder
    rows = spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes).parquet(f"{head}/{last[:-1]}[{last[-1]}]")
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = rows.select(of(normal(text)).alias("digest"), F.struct(F.char_length(text).alias("code_points"), (-F.col(id_col)).alias("minus_id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("best"))
    found = slim.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max("best").alias("best"))
    was = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        found.writeStream.outputMode("update").format("noop").option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        # the stored value is the aggregation buffer, (count, best); its field names are Spark's own, so they go by place
        stored = spark.read.format("statestore").load(state)
        count, best = (F.col(f"value.`{f.name}`") for f in stored.schema["value"].dataType.fields)
        return written(stored.select(F.col("key.digest").alias("digest"), count.alias("group_size"), best.alias("best")), "state").select("digest", "group_size", "best.code_points", (-F.col("best.minus_id")).alias("keep_id"), "best.file", "best.row")
    finally:
        for key, value in was.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def exact_dedup(spark: SparkSession, table: str, id_col: str = "doc_id", text_col: str = "text", of: Callable[[Column], Column] = digest, state: str | None = None) -> DataFrame:
    """One row per row of the table: its id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after deleting white space. Of equal texts the one with the most code points
    stays, then the smallest id. Null text counts as empty, so nulls and blank texts form one group; a null id is
    larger than any other and keeps only a group of its own; repeated rows count in group_size and are all marked kept when
    they carry keep_id; extra columns of any name are ignored; an empty table gives an empty result.

    Hits are checked on full bytes: the least and the greatest normalised text of each digest with more than one row must be
    equal. A digest with several texts gets a group for each of them.
    """
    seen = absorb(spark, table, state or fresh_dir(spark, "exact-state"), id_col, text_col, of)
    text = text_or_empty(text_col)
    rows = spark.read.parquet(table).select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("norm", normal(F.col("text"))).select("doc_id", F.char_length("text").alias("code_points"), "norm", of(F.col("norm")).alias("digest"))
    # texts of hits meet as their least and greatest, merged in each task first; what else the sieve lets through has one text
    ends = sieve(rows.select("digest", "norm"), "digest", seen.where("group_size > 1").select("digest")).groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    checked = written(ends.where("low <> high").select("digest"), "checked")
    false_hits = checked.select("digest")
    slim = rows.select("doc_id", "digest", F.sha2("norm", 256).alias("text_sha256"))
    plain = slim.join(seen, "digest").join(false_hits, "digest", "left_anti").select("doc_id", "keep_id", "group_size", "text_sha256")
    clash = rows.join(false_hits, "digest", "left_semi")
    own = clash.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("code_points", (-F.col("doc_id")).alias("minus_id"))).alias("best"))
    apart = clash.join(own, ["digest", "norm"]).select("doc_id", (-F.col("best.minus_id")).alias("keep_id"), "group_size", F.sha2("norm", 256).alias("text_sha256"))
    return plain.union(apart).select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("doc_id").isNull() & F.col("keep_id").isNull()).alias("kept"), "text_sha256")
