"""What the operators of this subpackage share: the shared folder, tables written there, hashes and components."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every operator here, as a Java or Python character class body: space and the controls 9 to 13.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary one in local mode (tests);
    on a cluster that is an error, as executors would write to folders of their own."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that driver and executors share")
        sc.setCheckpointDir(found := tempfile.mkdtemp(prefix="skyquilt-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new folder in the shared one; it goes when the application ends."""
    path = f"{shared_dir(spark)}/skyquilt/{tag}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def written(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """df as a table in the shared folder, read again: lineage ends here, so losing an executor costs no recomputation."""
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, tag)
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._skyquilt_path = path
    return out


def discard(spark: SparkSession, *tables: DataFrame | None) -> None:
    """Delete tables of written() that nothing reads any more, and let Spark drop the shuffle files of plans that are gone."""
    jvm = spark.sparkContext._jvm
    for t in tables:
        if t is not None:
            at = jvm.org.apache.hadoop.fs.Path(t._skyquilt_path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    gc.collect()
    # Spark's listeners hold the last event, and with it the plan of the last query, until another comes
    spark.sql("SELECT 1").collect()
    jvm.System.gc()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def n_words(name: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(name), F.lit(WORD)), F.lit(0)).cast("long")


def fold(of: Column, modulus: int) -> Column:
    """crc32 of a value's text, modulo: the split into training and held-out rows."""
    return F.pmod(F.crc32(F.coalesce(of.cast("string"), F.lit(""))), F.lit(modulus))


#: Bits of sieve(): 128 bitmaps of 4 KB, whatever the number of ids.
SIEVE_BITS = 22


def sieve(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of df whose key may be among ids (one column): all that are, and a share of the others that rises with the number
    of ids. It spares a join the shuffle of rows that cannot match; its broadcast has a fixed size."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << SIEVE_BITS))
    spot = place(F.col(ids.columns[0]))
    maps = ids.select(F.shiftright(spot, 15).alias("_bucket"), spot.bitwiseAND(F.lit(32767)).alias("_bit")).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    at = place(F.col(key))
    byte = F.conv(F.hex(F.substring("_map", (F.shiftright(at.bitwiseAND(F.lit(32767)), 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = at.bitwiseAND(F.lit(7)).cast("int")
    held = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), bit + 1)) != 0
    return df.join(F.broadcast(maps), F.shiftright(at, 15) == F.col("_bucket")).where(held).drop("_bucket", "_map")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node in edges (a, b long), written: component is the smallest node reachable.

    Large-star and small-star turns over written tables; each turn shuffles the edges twice, and the number of
    turns grows with the logarithm of the longest path. Nothing about the graph but two counts reaches the driver.
    Edges with a null end and loops are left out, repeated edges count once, and no edges give an empty result.
    """
    spark = edges.sparkSession
    now = written(edges.where("a is not null and b is not null and a <> b")
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        old, now = now, written(small, "edges")
        discard(spark, old)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if mark == before:
            break
        before = mark
    leaf = now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    out = written(leaf.union(leaf.select(F.col("component").alias("node"), "component").distinct()), "components")
    discard(spark, now)
    return out
