"""Language-model scoring of whole documents: corpus counts, a recurrent model trained by averaged replicas, exact sums for rare words."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gru
from .common import discard, written
from .textnum import Words, chunks

#: Head words have outputs of their own in the model. Known words have their counts at hand in each task: at most KNOWN pairs of
#: a hash and a count, 4 MB. Words beyond them are joined with the table of counts.
HEAD, KNOWN = 4_095, 262_144
#: The recurrent weights are trained on all BUCKETS hash buckets of the training documents, one a round; a replica has about
#: REPLICA tokens, and replicas are averaged by their tokens after each round.
BUCKETS, REPLICA = 16, 750_000
#: Tokens that the model scores side by side; a longer document is scored by itself.
AT_ONCE = 8_000_000
#: Places of head words, HEAD + 1 at most, in the table of tokens.
HEADS = np.uint16
#: The end of a document, as a hash.
END = 0
SMOOTH = 0.1


def _held_out(ids: Sequence, modulus: int = 10) -> np.ndarray:
    return np.array([zlib.crc32(("" if i is None else str(i)).encode()) % modulus == 0 for i in ids], bool)


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(h, c): how often each word, known by a 64-bit hash, and the end occur in docs (column text). Counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            h, where = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            c = np.bincount(where, np.concatenate([x for _, x in held]), len(h)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

        held, size = [], 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(texts):
                h, c = np.unique(Words(texts[a:b]).hashes(), return_counts=True)
                held.append((np.append(h, np.uint64(END)), np.append(c, b - a)))
                size += len(h)
                if size > 1_000_000:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


class Known:
    """Counts of the most frequent words, which of them are head words, and the totals."""

    def __init__(self, h: np.ndarray, c: np.ndarray, total: int, distinct: int) -> None:
        order = np.lexsort((h, -c))
        self.h, self.c = h[order].view(np.uint64), c[order]
        self.total, self.distinct = total, distinct
        self.head = min(HEAD + 1, len(self.h))
        self.sort = np.argsort(self.h)
        self.sorted = self.h[self.sort]
        self.rest = total - int(self.c[: self.head].sum())
        self.all_log = np.log10(total + SMOOTH * (distinct + 1))
        self.rest_log = np.log10(self.rest + SMOOTH * (distinct - self.head + 1))

    def places(self, h: np.ndarray) -> np.ndarray:
        """Rank of each hash, or the number of known words where it is not one."""
        n = len(self.h)
        at = np.minimum(np.searchsorted(self.sorted, h), max(0, n - 1))
        return np.where(self.sorted[at] == h, self.sort[at], n) if n else np.zeros(len(h), np.int64)

    def tokens(self, texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(hashes, places) of the words of each text and its end."""
        words = Words(texts)
        h = words.hashes()
        distinct, where = np.unique(h, return_inverse=True)
        places, end = self.places(distinct)[where], self.places(np.array([END], np.uint64))
        for i in range(len(texts)):
            a, b = words.first[i], words.first[i + 1]
            yield np.append(h[a:b], np.uint64(END)), np.append(places[a:b], end)


@lru_cache(1)
def _loaded(h: bytes, c: bytes, total: int, distinct: int, weights: bytes) -> tuple[Known, gru.Model]:
    known = Known(np.frombuffer(h, np.int64), np.frombuffer(c, np.int64), total, distinct)
    model = gru.Model(known.c[: known.head], known.rest)
    return known, model.unpack(np.frombuffer(weights, np.float32)) if weights else model


def _train(heads: DataFrame, packed: tuple, tokens: int) -> bytes:
    """The average of replicas that each train on a part of heads; weights are added up in a tree on the executors, some at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, start = _loaded(*packed)
        model, seen = gru.Model(known.c[: known.head], known.rest).unpack(start.packed()), 0
        for batch in batches:
            seen += model.train([np.frombuffer(x, HEADS) for x in batch.column("heads").to_pylist()])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen / REPLICA], pa.float64()), pa.array([(model.packed() * np.float32(seen / REPLICA)).tobytes()], pa.binary())], ["n", "w"])

    replicas = max(1, round(tokens / REPLICA))
    parts = heads.select("heads").repartition(replicas).mapInArrow(run, "n double, w binary")

    def add(a: tuple, b: tuple) -> tuple:
        return (a[0] + b[0], b[1] if a[1] is None else a[1] if b[1] is None else a[1] + b[1])

    depth = max(2, math.ceil(math.log(replicas, 16)))
    n, total = parts.rdd.map(lambda r: (r["n"], np.frombuffer(r["w"], np.float32))).treeAggregate((0.0, None), add, add, depth)
    return (total / n).astype(np.float32).tobytes() if n else packed[-1]


def _tokenised(batches: Iterator[pa.RecordBatch], packed: tuple) -> Iterator[pa.RecordBatch]:
    """Each row with its counts, the sums of logs that need no model, the words of the head, and the unknown words and their numbers."""
    from pyspark import TaskContext

    known, _ = _loaded(*packed)
    row = TaskContext.get().partitionId() << 36
    log = np.log10(known.c + SMOOTH)
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        base, rest, known_n, n, far, far_n, heads = [], [], [], [], [], [], []
        for a, b in chunks(texts):
            for own, p in known.tokens(texts[a:b]):
                near = p < len(known.h)
                v = log[p[near]]
                base.append(v.sum() - len(p) * known.all_log)
                rest.append(v[p[near] >= known.head].sum() - (p >= known.head).sum() * known.rest_log)
                known_n.append(int(near.sum()))
                n.append(len(p))
                hs, cs = np.unique(own[~near], return_counts=True)
                far.append(hs.view(np.int64))
                far_n.append(cs)
                heads.append(np.minimum(p, known.head).astype(HEADS).tobytes())
        ends = np.concatenate([[0], np.cumsum([len(x) for x in far])]).astype(np.int32)
        far_all = np.concatenate(far) if far else np.zeros(0, np.int64)
        far_c = np.concatenate(far_n).astype(np.int64) if far else np.zeros(0, np.int64)
        struct = pa.StructArray.from_arrays([pa.array(far_all), pa.array(far_c)], ["h", "k"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(row, row + len(texts))), batch.column("doc_id"), pa.array(_held_out(ids)), pa.array(n, pa.int64()), pa.array(known_n, pa.int64()), pa.array(np.array(base, float)), pa.array(np.array(rest, float)), pa.array(heads, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), struct)],
            ["row", "doc_id", "held_out", "n_tokens", "near", "base", "rest", "heads", "far"],
        )
        row += len(texts)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Tokens are words (runs without white space, A-Z in lower case) and one end; null counts as an empty text, which has the
    end alone. Learned from rows whose crc32 of the id's text modulo 10 is not 0 (a null id counts as an empty text). base_score: sum of
    log10((c + 0.1) / (N + 0.1 (V + 1))). score: the same for the recurrent model, which gives words outside its head the
    probability of the last class times (c + 0.1) / (N' + 0.1 (V' + 1)), N' and V' over training words outside the head.
    Texts of any length are scored whole. Repeated rows are scored each; extra columns are ignored; without training rows
    every token has chance 1 in the base and a uniform last class in the model.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    learned = rows.where(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(10)) != 0)
    counts = written(corpus_counts(learned), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("c"), "h").limit(KNOWN).toArrow()  # KNOWN rows
    h, c = (np.ascontiguousarray(top.column(k).to_numpy()).astype(np.int64) for k in ("h", "c"))
    packed = (h.tobytes(), c.tobytes(), int(total), int(distinct), b"")
    kind = docs.schema[id_col].dataType.simpleString()
    tokens = written(rows.mapInArrow(lambda it: _tokenised(it, packed), f"row long, doc_id {kind}, held_out boolean, n_tokens long, near long, base double, rest double, heads binary, far array<struct<h:long,k:long>>"), "tokens")
    for turn in range(BUCKETS):
        own = tokens.where(~F.col("held_out") & (F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(BUCKETS)) == turn))
        packed = (*packed[:-1], _train(own, packed, total // BUCKETS))
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, model = _loaded(*shared.value)
        for batch in batches:
            heads = [np.frombuffer(x, HEADS) for x in batch.column("heads").to_pylist()]
            found, held, start = [], 0, 0
            for i, x in enumerate(heads):
                held += len(x)
                if held >= AT_ONCE or i == len(heads) - 1:
                    found.append(model.log10(heads[start : i + 1]))
                    held, start = 0, i + 1
            scores = np.concatenate(found) if found else np.zeros(0)
            keep = batch.drop_columns(["heads", "rest"])
            yield keep.append_column("model", pa.array(scores + batch.column("rest").to_numpy()))

    schema = tokens.drop("heads", "rest").withColumn("model", F.lit(0.0)).schema
    scored = written(tokens.mapInArrow(run, schema), "scored")
    discard(docs.sparkSession, tokens)
    tail = scored.select("row", F.explode("far").alias("f")).select("row", "f.h", "f.k").join(counts, "h", "left")
    each = F.col("k") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + F.lit(SMOOTH))
    sums = tail.groupBy("row").agg(F.sum(each).alias("s"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("m"))
    out = scored.drop("far").join(sums, "row", "left")
    more = F.coalesce(F.col("s"), F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("near") + F.coalesce(F.col("m"), F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"))
