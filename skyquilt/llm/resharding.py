"""Resharding by minimum-cost flow: move the fewest bytes from old shards to new capacities."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import discard, written

#: Rows aimed at in a block; windows run over blocks, so no task holds more than some of them.
BLOCK_ROWS = 50_000
#: Bytes of texts aimed at in a shard file.
FILE_BYTES = 128 << 20


def equal_capacities(total: int, n: int) -> list[int]:
    """n capacities that differ by one at most and sum to total."""
    return [total // n + (j < total % n) for j in range(n)]


def minimum_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost) -> dict[tuple[int, int], int]:
    """Units from each old shard i to each new shard j at the least sum of units * cost(i, j).

    Successive shortest paths with potentials on the graph source -> i -> j -> sink; its size depends on the numbers of
    shards alone. supply must sum to capacity.
    """
    if sum(supply) != sum(capacity):
        raise ValueError("old sizes and new capacities differ in sum")
    n, m = len(supply), len(capacity)
    sink = n + m + 1
    graph: list[list[list[int]]] = [[] for _ in range(sink + 1)]  # edges [to, room, cost, index of the reverse edge]

    def edge(a: int, b: int, room: int, price: int) -> None:
        graph[a].append([b, room, price, len(graph[b])])
        graph[b].append([a, 0, -price, len(graph[a]) - 1])

    for i, units in enumerate(supply):
        edge(0, 1 + i, units, 0)
    for i in range(n):
        for j in range(m):
            edge(1 + i, 1 + n + j, supply[i], cost(i, j))
    for j, units in enumerate(capacity):
        edge(1 + n + j, sink, units, 0)
    potential = [0] * (sink + 1)
    while True:
        far: list[float] = [float("inf")] * (sink + 1)
        far[0], came, heap = 0, {}, [(0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for k, (b, room, price, _) in enumerate(graph[a]):
                if room and (to := d + price + potential[a] - potential[b]) < far[b]:
                    far[b], came[b] = to, (a, k)
                    heapq.heappush(heap, (to, b))
        if far[sink] == float("inf"):
            break
        potential = [p + (f if f < float("inf") else 0) for p, f in zip(potential, far, strict=True)]
        path, at = [], sink
        while at:
            path.append(came[at])
            at = came[at][0]
        units = min(graph[a][k][1] for a, k in path)
        for a, k in path:
            graph[a][k][1] -= units
            graph[graph[a][k][0]][graph[a][k][3]][1] += units
    return {(i, b - n - 1): supply[i] - room for i in range(n) for b, room, _, _ in graph[1 + i] if b > n and supply[i] > room}


#: Size classes of the order within a shard: large rows first, so that cuts fall among small ones.
LARGE_FIRST = 40
#: Rows near a cut at which a segment may end instead.
AROUND = 16


def _keyed(docs: DataFrame, old_shard, id_col: str, text_col: str) -> DataFrame:
    """docs with _key, the place of a row in the order of its old shard: (size class, hash, id, checksum, size), and _old."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    size = (F.octet_length(text) + F.lit(16)).cast("long")
    crc, row = F.crc32(text.cast("binary")), F.col(f"`{id_col}`")
    place = (F.lit(LARGE_FIRST) - F.floor(F.log2(size))).cast("int")
    key = F.struct(place.alias("class"), F.xxhash64(row, crc).alias("h"), row.alias("id"), crc.alias("crc"), size.alias("size"))
    return docs.withColumn("_old", old_shard.cast("int")).withColumn("_key", key)


def _segments(base: DataFrame, plan: list[tuple[int, int, int]], blocks: int) -> DataFrame:
    """(_old, _cuts): per old shard, in order, the new shards and the keys at which their segments end, null for the last.

    plan: (old shard, new shard, byte at which its segment ends). Only blocks in which a cut falls are sorted: a block has a
    part of the rows of one size class of one shard, by a range of hashes. A segment ends before (past 0) or behind (1) one of the
    AROUND rows nearest to the cut, as balanced() chooses.
    """
    spark = base.sparkSession
    cuts = spark.createDataFrame(plan, "_old int, shard int, _to long")
    span = F.lit(2.0**64 / blocks)
    base = base.withColumn("_block", F.least(F.lit(blocks - 1), F.floor((F.col("_key.h").cast("double") + 2.0**63) / span)).cast("int"))
    sums = base.groupBy("_old", "_key.class", "_block").agg(F.sum("_key.size").alias("_b"))
    before = Window.partitionBy("_old").orderBy("class", "_block").rowsBetween(Window.unboundedPreceding, -1)
    begun = sums.withColumn("_begin", F.coalesce(F.sum("_b").over(before), F.lit(0)))  # a row per block
    where = begun.join(F.broadcast(cuts), "_old").where((F.col("_begin") <= F.col("_to")) & (F.col("_to") < F.col("_begin") + F.col("_b")))
    where = written(where.select("_old", "class", "_block", "_begin", "shard", "_to"), "cuts")  # a row per cut
    where = where.withColumnRenamed("class", "_class")
    one = F.broadcast(where.select("_old", "_class", "_block", "_begin").distinct())
    held = base.withColumn("_class", F.col("_key.class")).join(one, ["_old", "_class", "_block"])
    # rows that are equal in all of the key are one step: no key tells them apart
    steps = held.groupBy("_old", "_class", "_block", "_begin", "_key").agg(F.sum("_key.size").alias("_b"))
    upto = Window.partitionBy("_old", "_class", "_block").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("_at", F.col("_begin") + F.coalesce(F.sum("_b").over(upto), F.lit(0)))
    near = Window.partitionBy("_old", "shard").orderBy(F.abs(2 * (F.col("_to") - F.col("_at")) - F.col("_b")), "_key")
    at = steps.join(F.broadcast(where.select("_old", "_class", "_block", "shard", "_to")), ["_old", "_class", "_block"]).withColumn("no", F.row_number().over(near)).where(f"no <= {AROUND}")
    at = written(at.select("_old", "shard", "no", "_key", (F.col("_at") - F.col("_to")).alias("before"), (F.col("_at") + F.col("_b") - F.col("_to")).alias("behind")), "near")
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for r in at.select("_old", "shard", "no", "before", "behind").collect():  # AROUND rows per cut
        found.setdefault((r[0], r[1]), []).extend([(r["before"], r["no"], 0), (r["behind"], r["no"], 1)])
    chosen = spark.createDataFrame([(i, j, no, past) for (i, j), (_, no, past) in balanced(plan, found).items()], "_old int, shard int, no int, past int")
    ends = at.join(F.broadcast(chosen), ["_old", "shard", "no"]).select("_old", "shard", F.struct("_key", "past").alias("end"))
    full = cuts.join(ends, ["_old", "shard"], "left")
    return full.groupBy("_old").agg(F.transform(F.array_sort(F.collect_list(F.struct("_to", "shard", "end"))), lambda c: F.struct(c["shard"].alias("shard"), c["end"].alias("end"))).alias("_cuts"))  # a row per old shard


def balanced(plan: Sequence[tuple[int, int, int]], found: dict[tuple[int, int], list[tuple[int, int, int]]]) -> dict[tuple[int, int], tuple[int, int, int]]:
    """For each cut one of the ends found near it, (bytes beyond the cut, ...), so that new shards miss their capacities least.

    A cut gives what lies beyond it to one new shard and takes it from the next of the same old shard. Starting with the
    nearest ends, cuts move one at a time as long as the sum of squares of what shards miss falls.
    """
    follows = {(i, j): nxt[1] for (i, j, _), nxt in zip(plan, [*plan[1:], None], strict=False) if nxt and nxt[0] == i}
    chosen = {cut: min(ends, key=lambda e: (abs(e[0]), e)) for cut, ends in found.items() if cut in follows}
    off: dict[int, int] = {}
    for (i, j), end in chosen.items():
        off[j] = off.get(j, 0) + end[0]
        off[follows[i, j]] = off.get(follows[i, j], 0) - end[0]
    moved = True
    while moved:
        moved = False
        for (i, j), now in chosen.items():
            k = follows[i, j]
            cost = lambda e, j=j, k=k, now=now: ((off[j] + e[0] - now[0]) ** 2 + (off[k] - e[0] + now[0]) ** 2, abs(e[0]), e)
            best = min(found[i, j], key=cost)
            if cost(best)[0] < cost(now)[0]:
                off[j] += best[0] - now[0]
                off[k] -= best[0] - now[0]
                chosen[i, j], moved = best, True
    return chosen


def _numbered(df: DataFrame, blocks: int) -> DataFrame:
    """df with slot, the place of a row in its new shard. Windows run within blocks and over one row per block."""
    df = df.withColumn("_block", F.pmod(F.col("_key.h"), F.lit(blocks)))
    sums = df.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"))
    inner = Window.partitionBy("shard", "_block").orderBy("_key")
    return df.withColumn("_k", F.row_number().over(inner).cast("long")).join(sums, ["shard", "_block"]).withColumn("slot", F.col("_n") + F.col("_k") - 1)


class Transfer:
    """A solved resharding: the flow in bytes, and the segments of each old shard, a table of n_old rows."""

    def __init__(self, old_shard, flow: dict[tuple[int, int], int], segments: DataFrame | None, blocks: int, bytes_each: int, id_col: str, text_col: str) -> None:
        self.old_shard, self.flow, self.segments, self.blocks, self.bytes_each, self.id_col, self.text_col = old_shard, flow, segments, blocks, bytes_each, id_col, text_col

    @property
    def touched(self) -> list[int]:
        """Shards, old or new, that a transfer enters or leaves."""
        return sorted({s for (i, j) in self.flow if i != j for s in (i, j)})

    def placed(self, docs: DataFrame) -> DataFrame:
        """docs with _old, _key and shard; rows find their segment by their key alone, so nothing is shuffled."""
        df = _keyed(docs, self.old_shard, self.id_col, self.text_col)
        if self.segments is None:  # no row at all
            return df.withColumn("shard", F.col("_old"))
        inside = "filter(_cuts, c -> c.end is null or _key < c.end._key or (_key = c.end._key and c.end.past = 1))[0].shard"
        return df.join(F.broadcast(self.segments), "_old").withColumn("shard", F.expr(inside)).drop("_cuts")

    def rows(self, docs: DataFrame) -> DataFrame:
        """doc_id, size, text_crc32, old_shard, shard, slot of every row."""
        slim = self.placed(docs.select(F.col(f"`{self.id_col}`"), F.col(f"`{self.text_col}`"))).select("_old", "_key", "shard")
        out = _numbered(written(slim, "placed"), self.blocks)
        return out.select(F.col("_key.id").alias("doc_id"), F.col("_key.size").alias("size"), F.col("_key.crc").alias("text_crc32"), F.col("_old").alias("old_shard"), "shard", "slot")


def solve(docs: DataFrame, old_shard, n_old: int, capacities: int | Sequence[int], id_col: str = "doc_id", text_col: str = "text") -> Transfer:
    """The transfers of fewest bytes from old shards to new capacities.

    docs: any table with an id and a text. old_shard: column expression of the shard that holds a row now, 0 to
    n_old - 1. capacities: the number of new shards, which get equal bytes, or the new capacities in bytes, whose sum
    must be that of the sizes. Size is UTF-8 bytes plus 16 (null text: 16). Bytes that stay in a shard of the same
    number cost nothing, others one a byte. Within an old shard rows stand in one order, large ones first, and each transfer
    takes a contiguous block, which ends at a row near its cut; of the rows there those are chosen that fit the
    capacities best, so a shard misses its capacity by less than half a row of the smaller ones for each end of its blocks. Rows equal in id and text are one step of that order and stay
    together. Null ids are ids; extra columns are ignored; an empty table gives an empty result.
    """
    base = _keyed(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), old_shard, id_col, text_col).select("_old", "_key")
    base = written(base, "sizes")
    sizes = {r[0]: (r[1], r[2]) for r in base.groupBy("_old").agg(F.sum("_key.size"), F.count(F.lit(1))).collect()}  # n_old rows at most
    supply = [sizes.get(i, (0, 0))[0] for i in range(n_old)]
    rows = sum(n for _, n in sizes.values())
    if isinstance(capacities, int):
        capacities = equal_capacities(sum(supply), capacities)
    flow = minimum_cost_flow(supply, capacities, lambda i, j: int(i != j))
    # a shard first keeps what stays, then gives its transfers away by the number of the new shard
    plan = []
    for i in range(n_old):
        end = 0
        for j in sorted((j for a, j in flow if a == i), key=lambda j: (j != i, j)):
            end += flow[i, j]
            plan.append((i, j, end))
    blocks = max(1, -(-rows // BLOCK_ROWS))
    segments = written(_segments(base, plan, blocks), "segments") if plan else None
    discard(docs.sparkSession, base)
    return Transfer(old_shard, flow, segments, blocks, max(capacities, default=0), id_col, text_col)


def reshard(docs: DataFrame, old_shard, n_old: int, capacities: int | Sequence[int], id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """(rows, flow): rows has doc_id, size, text_crc32, old_shard, shard, slot; flow has the bytes of each block transfer.

    See solve() for the arguments and odd rows. slot counts from 0 without gaps within a shard; repeated rows each get one.
    """
    solved = solve(docs, old_shard, n_old, capacities, id_col, text_col)
    return solved.rows(docs), solved.flow


def rewrite_affected(docs: DataFrame, solved: Transfer, root: str) -> list[int]:
    """Write the files of the shards that a transfer touches, as root/shard=N/part-*.parquet; return their numbers.

    Only rows of touched shards are shuffled, once, to the tasks that write them; a shard of more than FILE_BYTES is dealt to
    several. Shards that no transfer enters or leaves keep their files: of a live root, only touched shards are
    overwritten, when all of the new files are there, and those that are left without rows lose their files. docs must not be read from
    root itself, which raises. docs keeps all its columns but one named shard. A row's slot is its place in the shard's
    files, in order of their names: read_shards() tells it. Repeated rows are written each; an empty table writes nothing.
    """
    spark = docs.sparkSession
    touched = solved.touched
    if not touched:
        return []
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    below = jvm.org.apache.hadoop.fs.Path(fs.makeQualified(at).toString()).toUri().getPath().rstrip("/") + "/"
    if any(jvm.org.apache.hadoop.fs.Path(f).toUri().getPath().startswith(below) for f in docs.inputFiles()):
        raise ValueError(f"documents are read from {root}, which is to be overwritten")
    files = max(1, -(-solved.bytes_each // FILE_BYTES))
    out = solved.placed(docs.drop("shard")).where(F.col("shard").isin(touched)).withColumn("_file", F.pmod(F.xxhash64("_key.h"), F.lit(files)))
    out = out.repartition("shard", "_file").drop("_old", "_key", "_file")
    out.write.partitionBy("shard").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)
    filled = {int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(at) if s.getPath().getName().startswith("shard=")}
    into = {j for (_, j), n in solved.flow.items() if n}
    for n in (set(touched) - into) & filled:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/shard={n}"), True)
    return touched


def read_shards(spark: SparkSession, root: str, schema: StructType, *columns: Column) -> DataFrame:
    """The rows that the shard files below root hold, with shard and slot; schema is that of the rows, without these two.

    slot: the rows in earlier files of the shard, by name, and the row's place in its own file. columns: expressions to return
    instead of the rows, computed before files are joined with their counts, so that texts they shorten are not shuffled.
    """
    held = StructType([*[f for f in schema if f.name not in ("shard", "slot")], StructField("shard", IntegerType())])
    rows = spark.read.schema(held).parquet(root)
    per_file = rows.select("shard", F.col("_metadata.file_path").alias("_file")).groupBy("shard", "_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    begun = per_file.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))  # a row per file
    placed = rows.select(*(columns or [F.col(f"`{c}`") for c in rows.columns if c != "shard"]), "shard", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return placed.join(begun, "_file").withColumn("slot", F.col("_begin") + F.col("_row")).drop("_file", "_begin", "_row")
