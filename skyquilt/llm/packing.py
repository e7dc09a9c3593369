"""Best-fit packing under conflicts: no bin holds two pieces of one source or of one cluster of copies."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, n_words, written

#: Pieces aimed at in a block; each block is packed alone, in one task, over slim rows.
BLOCK_ROWS = 4_096
SCHEMA = "doc_id long, piece int, start long, n_tokens long, bin_id string, offset long, cluster long"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def best_fit(items: Iterable[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each item (size, source bit, cluster bit), in the order given; a bit of 0 conflicts with nothing.

    Open bins stand in order of residual, each with the bitmaps of its sources and clusters. The search begins at the
    first residual that is large enough and goes on to the next larger one until a bin has none of the item's bits:
    that is the tightest compatible bin. If there is none, a bin is opened.
    """
    order: list[tuple[int, int]] = []  # (residual, bin)
    sources: list[int] = []
    clusters: list[int] = []
    out = []
    for size, source, cluster in items:
        k = bisect_left(order, (size, -1))
        while k < len(order) and (sources[order[k][1]] & source or clusters[order[k][1]] & cluster):
            k += 1
        if k < len(order):
            left, b = order.pop(k)
        else:
            left, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[b] |= source
        clusters[b] |= cluster
        out.append((b, capacity - left))
        if left > size:
            insort(order, (left - size, b))
    return out


def _pack_block(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["n_tokens", "doc_id", "piece", "again"], ascending=[False, True, True, True], na_position="first")
    bits: dict = {}
    repeated = set(pdf["cluster"][pdf["cluster"].duplicated()])
    own: dict = {}
    items = []
    for n, source, cluster in zip(pdf["n_tokens"], pdf["source"], pdf["cluster"], strict=True):
        items.append((int(n), 1 << bits.setdefault(None if source is None or source != source else source, len(bits)), 1 << own.setdefault(cluster, len(own)) if cluster in repeated else 0))
    placed = best_fit(items, capacity)
    block = pdf["block"].iloc[0]
    return pdf.assign(bin_id=[f"b{block}-{b}" for b, _ in placed], offset=[o for _, o in placed])[COLUMNS]


def pack(docs: DataFrame, capacity: int = 2_048, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 23) -> DataFrame:
    """Pieces of all documents in bins of `capacity` tokens (words): doc_id, piece, start, n_tokens, bin_id, offset, and cluster,
    a hash of the text.

    A text longer than a bin is cut into whole pieces of a bin each and a rest, so nothing is lost. Whole pieces fill a
    bin alone; other pieces are packed by best_fit, longest first, within blocks of rows dealt by hash, so that a bin
    holds no two pieces of one source and no two of equal texts. Null is a source of its own. A text without words
    gets one row with n_tokens 0 and no bin. Repeated rows are packed each. Extra columns are ignored; an empty table
    gives an empty result. Only ids, sizes and checksums reach Python, some thousand rows at a time.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text).alias("cluster"), n_words(text_col).alias("n"))
    slim = written(slim.withColumn("again", F.monotonically_increasing_id()), "pack")
    rows = slim.count()
    blocks = max(1, -(-rows // BLOCK_ROWS))
    cut = F.lit(capacity)
    whole = slim.where(F.col("n") >= cut).withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / cut).cast("int") - 1)))
    whole = whole.select("doc_id", "piece", (F.col("piece") * cut).cast("long").alias("start"), F.lit(capacity).cast("long").alias("n_tokens"), F.concat(F.lit("w"), "again", F.lit("-"), "piece").alias("bin_id"), F.lit(0).cast("long").alias("offset"), "cluster")
    rest = slim.where((F.col("n") % cut) > 0).select("doc_id", F.floor(F.col("n") / cut).cast("int").alias("piece"), (F.col("n") - F.col("n") % cut).alias("start"), (F.col("n") % cut).alias("n_tokens"), "source", "cluster", "again", F.pmod(F.xxhash64(F.lit(seed), "again"), F.lit(blocks)).alias("block"))
    packed = rest.groupBy("block").applyInPandas(lambda pdf: _pack_block(pdf, capacity), SCHEMA)
    none = slim.where("n = 0").select("doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n_tokens"), F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("long").alias("offset"), "cluster")
    return packed.unionByName(whole.select(*COLUMNS)).unionByName(none)


def with_texts(packed: DataFrame, docs: DataFrame, capacity: int = 2_048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """pack()'s pieces with piece_text: the text as it is where it is one piece, else the piece's words with a space between.

    docs and capacity are those of pack(). Rows of one id and text share one copy of it in the join, so texts are shuffled once;
    a text is cut once, whatever the number of its pieces. Null texts give an empty piece_text; rows of a null id have
    theirs; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    once = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.xxhash64(text).alias("_cluster"), text.alias("_text")).groupBy("_id", "_cluster").agg(F.first("_text").alias("_text"))
    cut = F.lit(capacity)
    last = F.floor((F.size("_words") - 1) / cut).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("_words", i * cut + 1, cut), " "))
    long = n_words("_text") > cut
    once = once.withColumn("_words", F.when(long, F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))).withColumn("_parts", F.when(F.col("_words").isNull(), F.array("_text")).otherwise(parts)).select("_id", "_cluster", "_parts")
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_cluster") == F.col("cluster"))
    return once.join(packed, same).select(*packed.columns, F.get("_parts", F.col("piece")).alias("piece_text"))
