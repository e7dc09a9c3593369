"""Resharding ends in files, and leaves the files of untouched shards alone."""

from collections import Counter

from pyspark.sql import functions as F

from skyquilt.llm import queries, resharding


def test_the_result_is_that_of_the_files(spark, docs, rows, monkeypatch):
    roots = []
    rewrite = queries.rewrite_affected
    monkeypatch.setattr(queries, "rewrite_affected", lambda d, solved, root: roots.append(root) or rewrite(d, solved, root))
    got = queries.op2_reshard(spark, docs.path.rpartition("/")[0]).collect()
    files = resharding.read_shards(spark, roots[0], docs.schema).collect()
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in got) == Counter((r["doc_id"], r["shard"], r["slot"]) for r in files)
    assert Counter((r["doc_id"], r["text"]) for r in files) == Counter((r[0], r[1]) for r in rows)


def test_untouched_shards_keep_their_files(spark, docs, tmp_path):
    root, old = str(tmp_path / "live"), F.pmod(F.xxhash64("doc_id"), F.lit(4)).cast("int")
    placed, _ = resharding.reshard(docs, old, 4, 4)
    before = docs.withColumn("shard", old).withColumn("slot", F.lit(0).cast("long"))
    before.write.partitionBy("shard").parquet(root)
    sizes = [sum(r["size"] for r in placed.collect() if r["old_shard"] == i) for i in range(4)]
    solved = resharding.solve(docs, old, 4, [sizes[0] - 1000, sizes[1] + 1000, sizes[2], sizes[3]])
    kept = lambda: {f: f.read_bytes() for n in (2, 3) for f in (tmp_path / "live" / f"shard={n}").iterdir()}
    first = kept()
    assert resharding.rewrite_affected(docs, solved, root) == [0, 1]
    assert first and kept() == first and spark.read.parquet(root).count() == docs.count()
    # a shard that loses all it holds loses its files
    sizes = {r["shard"]: r["b"] for r in solved.placed(docs).groupBy("shard").agg(F.sum("_key.size").alias("b")).collect()}
    emptied = resharding.solve(docs, old, 4, [sum(sizes.values()) - sizes[2] - sizes[3], 0, sizes[2], sizes[3]])
    resharding.rewrite_affected(docs, emptied, root)
    assert kept() == first and not (tmp_path / "live" / "shard=1").exists() and spark.read.parquet(root).count() == docs.count()
