"""Near-duplicates by chosen paths: trees that branch documents by minwise tokens, with exhaustive comparison in small nodes."""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, discard, sieve, written
from .textnum import constants, shingle_sets, sketch

#: Trees are grown TREES at a time, of TREES * DEPTH minwise tokens, until a similar pair meets with probability RECALL.
TREES, DEPTH, RECALL = 8, 8, 0.99
#: A node is small, and compared exhaustively, up to so many documents and shingles. A node that is not small at full
#: depth is cut into parts of PART documents.
SMALL, PART, SMALL_SHINGLES = 128, 512, 4_000_000
HUBS = 16


def _signed(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    factor = constants(TREES * DEPTH, 101)
    for batch in batches:
        size, digest, token = [], [], []
        for values in shingle_sets(batch.column("text").to_pylist(), k):
            size.append(len(values))
            digest.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
            token.append(sketch(values, factor).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(token, pa.binary())], ["id", "n", "digest", "token"])


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, edges of their groups) from batches sorted by keys; a group that a batch cuts waits for its end."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        edges = _edges(held, keys)
        if len(edges) > 2:
            yield held.slice(0, edges[-2]), edges[:-1]
            held = held.slice(edges[-2])
    if held is not None and held.num_rows:
        yield held, _edges(held, keys)


def _edges(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.concatenate([[0], np.flatnonzero(new), [table.num_rows]]) if table.num_rows else np.zeros(1, int)


def _least(percent: int) -> int:
    """Of TREES * DEPTH tokens: five standard deviations below what a pair at the threshold shares on average."""
    t, m = percent / 100, TREES * DEPTH
    return max(1, math.floor(t * m - 5 * math.sqrt(m * t * (1 - t))))


def _screened(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Documents of small nodes that have a compatible partner there, in the groups that compatible pairs join.

    All nodes of a batch go together: rows are compared with the row d places on, for each d that a node has room for.
    """
    least = _least(percent)
    for table, edges in _whole_groups(batches, ["key"]):
        tokens = np.frombuffer(b"".join(table.column("token").to_pylist()), np.uint32).reshape(-1, TREES * DEPTH)
        size = table.column("n").to_numpy()
        ends = np.repeat(edges[1:], np.diff(edges))
        label = np.arange(len(size))
        pairs = []
        at = np.arange(len(size))
        for d in range(1, int(np.diff(edges).max(initial=1))):
            at = at[at + d < ends[at]]
            for i in range(0, len(at), 1 << 16):
                x, y = at[i : i + (1 << 16)], at[i : i + (1 << 16)] + d
                fits = 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
                x, y = x[fits], y[fits]
                good = (tokens[x] == tokens[y]).sum(axis=1) >= least
                pairs.append((x[good], y[good]))
        own = np.zeros(len(size), bool)
        if pairs:
            left, right = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
            own[left] = own[right] = True
            while True:  # each row takes the least label of its partners until none changes
                before = label.copy()
                low = np.minimum(label[left], label[right])
                np.minimum.at(label, left, low)
                np.minimum.at(label, right, low)
                if (label == before).all():
                    break
        kept = table.filter(pa.array(own))
        part = label[own] - np.repeat(edges[:-1], np.diff(edges))[own]
        for out in kept.select(["tree", "key", "id"]).append_column("part", pa.array(part.astype(np.int64))).combine_chunks().to_batches():
            yield out


def _linked(ids: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join the documents of a group as all its similar pairs do; pairs already joined are not compared."""
    factor = constants(TREES * DEPTH, 101)
    tokens = np.stack([sketch(s, factor) for s in sets])
    sizes = np.array([len(s) for s in sets])
    same = np.zeros((len(ids), len(ids)), np.uint8)
    for column in tokens.T:
        same += column[:, None] == column[None, :]
    fits = (same >= _least(percent)) & (100 * np.minimum.outer(sizes, sizes) >= percent * np.maximum.outer(sizes, sizes))
    left, right = np.nonzero(np.triu(fits, 1))
    order = np.argsort(-same[left, right].astype(np.int16), kind="stable")
    _, root = np.unique(comp, return_inverse=True)
    parent = {int(r): int(r) for r in root}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i, j in zip(left[order].tolist(), right[order].tolist(), strict=True):
        a, b = find(int(root[i])), find(int(root[j]))
        if a == b:
            continue
        shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
            parent[a] = b
            out.append((int(ids[i]), int(ids[j])))
    return out


def _links(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    for table, edges in _whole_groups(batches, ["key", "part"]):
        ids, comp = table.column("id").to_numpy(), table.column("comp").to_numpy()
        found: list[tuple[int, int]] = []
        a = 0
        while a < len(edges) - 1:  # some groups at a time, so that their sets fit in memory
            b = a + 1
            while b < len(edges) - 1 and edges[b + 1] - edges[a] <= PART:
                b += 1
            rows = slice(int(edges[a]), int(edges[b]))
            sets = list(shingle_sets(table.column("text").slice(rows.start, rows.stop - rows.start).to_pylist(), k))
            for g in range(a, b):
                lo, hi = int(edges[g]), int(edges[g + 1])
                one = np.unique(ids[lo:hi], return_index=True)[1] + lo  # repeated ids are one document
                if len(np.unique(comp[one])) > 1:
                    found += _linked(ids[one], comp[one], [sets[i - rows.start] for i in one], percent)
            a = b
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])


def _large() -> Column:
    return (F.col("size") > SMALL) | (F.col("total") > SMALL_SHINGLES)


def _part() -> Column:
    """The part of its large node that a document belongs to."""
    return F.pmod(F.xxhash64("key", "id"), F.greatest(F.ceil(F.col("size") / PART), F.ceil(F.col("total") / SMALL_SHINGLES)))


def _grown(reps: DataFrame, turn: int) -> tuple[list[DataFrame], DataFrame]:
    """TREES trees over reps: the tables of their levels (tree, id, n, path, key, size, total, level), and (id, tree, depth) of the
    documents that branched below depth 1. Each turn after the first chooses its paths anew from the same minwise tokens."""
    order = list(range(TREES * DEPTH))
    if turn:
        random.Random(turn).shuffle(order)
    token = F.col("token") if not turn else F.concat(*[F.substring("token", 4 * p + 1, 4) for p in order])
    alive = reps.select("id", "n", token.alias("token")).select("id", "n", "token", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("place"))
    alive = alive.select((F.col("place") + turn * TREES).alias("tree"), "id", "n", F.substring("token", F.col("place") * 4 * DEPTH + 1, F.lit(4 * DEPTH)).alias("path"))
    alive = alive.withColumn("key", F.xxhash64("tree", F.substring("path", 1, 4)))
    levels = []
    for level in range(DEPTH):
        count = alive.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total")).where("size > 1")
        sized = written(alive.join(count, "key").withColumn("level", F.lit(level)), "level")
        levels.append(sized)
        alive = sized.where(_large()).select("tree", "id", "n", "path", F.xxhash64("key", F.substring("path", F.lit(4 * level + 5), F.lit(4))).alias("key"))
        if level == DEPTH - 1 or alive.isEmpty():
            break
    went = levels[0]
    for more in levels[1:]:
        went = went.union(more)
    went = went.where(_large() & (F.col("level") < DEPTH - 1))
    return levels, went.groupBy("id", "tree").agg((F.max("level") + 2).alias("depth"))


def _nodes(reps: DataFrame, percent: int, recall: float) -> DataFrame:
    """(tree, key, id, size, total), written, of the nodes with two documents or more where branching ends.

    For each document the chance is estimated that a pair at the threshold is missed by all its trees; while it is more than
    1 - recall the document gets more trees. A pair for which one document has enough trees is found by those.

    Of a pair of similarity s that meets at depth d, d tokens are equal: s ** d where tokens are alike. Where a share q of a text
    is in passages that many others have, those tokens are equal for sure, and the last one, which is the pair's own, with
    (s - q) / (1 - q) only. The lesser counts; q is estimated by the document's first tokens that many documents have.
    """
    s = min(percent / 100, 0.9999)
    limit, shallow = math.log(max(1 - recall, 1e-12)), TREES * math.log1p(-s)
    spark, turn, tables, ended = reps.sparkSession, 0, [], None
    wanting = reps.select("id", "n", "token", F.lit(0.0).alias("missed"))
    while True:
        levels, deep = _grown(wanting, turn)
        tables += levels
        for sized in levels:
            leaf = sized.where(~_large() | (F.col("level") == DEPTH - 1)).select("tree", "key", "id", "size", "total")
            ended = leaf if ended is None else ended.union(leaf)
        per = deep.groupBy("id").agg(F.collect_list("depth").alias("depths"))  # TREES of them at most
        q = (F.size("depths") + 1) / F.lit(TREES + 1.0)
        own = F.when(q < s, F.greatest((s - q) / (1 - q), F.lit(s**DEPTH))).otherwise(F.lit(s**DEPTH))
        logs = F.aggregate("depths", F.lit(0.0), lambda sum_, d: sum_ + F.log1p(-F.least(F.pow(F.lit(s), d), F.col("own"))))
        per = per.withColumn("own", own).select("id", (logs + (TREES - F.size("depths")) * F.log1p(-F.col("own"))).alias("more"))
        if shallow <= limit:  # then only documents that branched further can want more trees
            per = written(per.where(F.col("more") > limit), "wanting")
            tables.append(per)
            rows = sieve(wanting, "id", per.select("id")).join(per, "id")
        else:
            rows = wanting.join(per, "id", "left").withColumn("more", F.coalesce("more", F.lit(shallow)))
        rows = rows.select("id", "n", "token", (F.col("missed") + F.col("more")).alias("missed")).where(F.col("missed") > limit)
        wanting = written(rows, "trees")
        tables.append(wanting)
        if wanting.isEmpty():
            break
        turn += 1
    out = written(ended, "nodes")
    discard(spark, *tables)
    return out


def _compare(groups: DataFrame, texts: DataFrame, comps: DataFrame | None, k: int, percent: int) -> DataFrame:
    rows = groups.select("key", "part", "id").join(texts, "id")
    rows = rows.withColumn("comp", F.col("id")) if comps is None else _named(rows, comps)
    rows = rows.select("key", "part", "id", "comp", "text").repartition("key", "part").sortWithinPartitions("key", "part")
    return written(rows.mapInArrow(lambda it: _links(it, k, percent), "a long, b long"), "links")


def _named(rows: DataFrame, comps: DataFrame) -> DataFrame:
    return rows.join(comps.select(F.col("node").alias("id"), F.col("component").alias("comp")), "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _parted(large: DataFrame) -> DataFrame:
    """Parts of large nodes, each with the same hubs."""
    cut = large.select("key", "id", _part().alias("part"))
    firsts = cut.groupBy("key", "part").agg(F.min("id").alias("id")).groupBy("key").agg(F.slice(F.sort_array(F.collect_set("id")), 1, HUBS).alias("hubs"), F.collect_set("part").alias("parts"))
    hubs = firsts.select("key", F.explode("hubs").alias("id"), "parts").select("key", "id", F.explode("parts").alias("part"))
    return cut.union(hubs).distinct()


def _across(large: DataFrame, comps: DataFrame) -> DataFrame:
    """Groups of every document outside its node's largest component with every part of the node."""
    cut = written(_named(large, comps).withColumn("part", _part()), "parts")
    main = cut.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"))
    rest = cut.join(main, "key").where("comp <> main").select("key", "id", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / PART)).alias("own"), "part")
    owns = rest.groupBy("key").agg(F.collect_set("own").alias("owns"))
    every = cut.groupBy("key").agg(F.collect_set("part").alias("parts"))
    there = cut.join(owns, "key").select("key", "id", F.explode("owns").alias("own"), "part")
    here = rest.join(every, "key").select("key", "id", "own", F.explode("parts").alias("part"))
    return there.union(here).select("key", F.xxhash64("own", "part").alias("part"), "id").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row: components of links of shingle-set similarity percent / 100 or more.

    Words are runs without white space, A-Z in lower case; a document's set is its distinct runs of k words, the whole
    sequence if it has fewer words, and empty without words or for null, which links with nothing. Links are confirmed
    on full sets of 64-bit shingle hashes. component_id is the smallest id reachable; kept means doc_id = component_id.

    Equal sets are merged first. Then independent trees branch the rest: a document goes to the child of its next
    minwise token until a node is small; there all pairs are screened by sketches, and those left compared on whole texts. A pair
    of similarity s meets in a tree of depth d with probability s^d. TREES trees are grown for all documents, and TREES more at a
    time for those whose nodes lie so deep that a pair at the threshold would be missed more often than in 1 - recall of
    cases; most nodes end at depth 1, where 8 trees miss 0.15^8 of pairs at 0.85. After the first tree, only groups that still
    hold several components are compared. Large nodes at full depth are first compared in parts with common hubs (in the first
    tree of all), and then, in every tree, what lies outside the
    node's largest component with all its parts, so no pair of a node is left out.

    Rows of one id are one document; rows with a null id link with nothing and are kept; ties go to the smallest id;
    extra columns are ignored; an empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = written(base.mapInArrow(lambda it: _signed(it, k), "id long, n long, digest binary, token binary"), "signed")
    full = signed.where("id is not null and n > 0")
    reps = written(full.groupBy("digest").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("token").alias("token")), "reps")
    copies = full.select("id", "digest").join(reps.select("digest", F.col("id").alias("rep")), "digest").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    nodes = _nodes(reps, percent, recall)
    held = nodes.where(~_large()).join(reps.select("id", "n", "token"), "id").select("tree", "key", "id", "n", "token").repartition("key").sortWithinPartitions("key")
    small = written(held.mapInArrow(lambda it: _screened(it, percent), "tree int, key long, id long, part long"), "screened")
    large = written(nodes.where(_large()), "large")
    crowded = not large.isEmpty()
    involved = small.select("id").union(large.select("id")).distinct()
    # the one shuffle of all texts, at any size: what is compared at all is a small part of them
    texts = written(base.join(involved.hint("merge"), "id", "left_semi"), "texts")

    groups = small.where("tree = 0").select("key", "part", "id")
    links = _compare(groups.union(_parted(large.where("tree = 0")).select("key", "part", "id")) if crowded else groups, texts, None, k, percent)
    comps = components(links)
    spread = _named(small.where("tree > 0"), comps)
    several = spread.groupBy("key", "part").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key", "part")
    groups = small.where("tree > 0").join(several, ["key", "part"], "left_semi").select("key", "part", "id")
    links = links.union(_compare(groups.union(_across(large, comps)) if crowded else groups, texts, comps, k, percent))
    last = components(links.union(copies))
    sizes = written(signed.select("id", "n"), "sizes")
    discard(docs.sparkSession, signed, reps, nodes, small, large, texts, comps)
    out = sizes.join(last, sizes["id"] == last["node"], "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
