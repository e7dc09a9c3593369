"""Language identification by cross-parsing: the language whose sample needs the fewest normalised phrases wins."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textnum import chunks

#: The sample that a language is learned from: so many documents, chosen by a hash of their id, a piece of so many characters of each.
SAMPLE_DOCS, PIECE = 64, 200
#: Symbols of a text that are parsed beside others; the parse runs on across the ends of such blocks, so the size changes no result.
BLOCK = 256
#: Turns in which all blocks whose entry was wrong are mended at once; afterwards only the first such block of each text is.
TURNS = 3
OTHER, GAP = 0, 1  # codes of letters outside the samples and of everything that is not a letter


@lru_cache(1)
def _lower() -> tuple[np.ndarray, np.ndarray]:
    """For each code point, its lower-case code point and whether it is a letter."""
    low = np.arange(0x110000, dtype=np.uint32)
    letter = np.zeros(0x110000, bool)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            if len(x := c.lower()) == 1:
                low[i] = ord(x)
    return low, letter


def suffix_automaton(pieces: Sequence[Sequence[int]]) -> list[dict[int, int]]:
    """Transitions of an automaton that accepts the substrings of all pieces."""
    to: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    for piece in pieces:
        last = 0
        for c in piece:
            if c in to[last] and length[to[last][c]] == length[last] + 1:
                last = to[last][c]
                continue
            at = len(to)
            to.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in to[p]:
                to[p][c] = at
                p = link[p]
            if p >= 0:
                q = to[p][c]
                if length[q] == length[p] + 1:
                    link[at] = q
                else:
                    copy = len(to)
                    to.append(dict(to[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and to[p].get(c) == q:
                        to[p][c] = copy
                        p = link[p]
                    link[q] = link[at] = copy
            last = at
    return to


class Model:
    """Automata of all languages as one table, and the coding of characters."""

    def __init__(self, samples: Mapping[str, Sequence[str]]) -> None:
        low, letter = _lower()
        self.languages = sorted(samples)
        raw = {k: [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in v] for k, v in samples.items()}
        seen = sorted({int(c) for v in raw.values() for t in v for c in np.unique(low[t[letter[t]]])})
        known = np.zeros(0x110000, np.uint16)
        known[seen] = np.arange(len(seen)) + 2
        self.code = np.where(letter, known[low], GAP).astype(np.uint16)
        self.width = len(seen) + 2
        tables, self.root, self.bits, base = [], [], [], 0
        for k in self.languages:
            pieces = [self.symbols(t).tolist() for t in raw[k]]
            to = suffix_automaton(pieces)
            table = np.zeros((len(to) + 1, self.width), np.int64)
            # a missing transition ends a phrase (bit 0) and goes where the symbol leads from the root; a symbol that
            # leads nowhere is a phrase of its own, in the last state, from which each symbol begins another
            start = np.full(self.width, base + len(to), np.int64)
            for c, q in to[0].items():
                start[c] = base + q
            table[:] = start * self.width * 2 + 1
            table[0] -= 1
            for s, out in enumerate(to):
                for c, q in out.items():
                    table[s, c] = (base + q) * self.width * 2
            tables.append(table)
            self.root.append(base * self.width)
            self.bits.append(math.log2(max(2, sum(map(len, pieces)))))
            base += len(to) + 1
        self.table = np.concatenate(tables).ravel().astype(np.int32 if base * self.width * 2 < 2**31 else np.int64) if tables else np.zeros(0, np.int32)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        code = self.code[points]
        gap = code == GAP
        return code[~(gap & np.concatenate([[False], gap[:-1]]))] if len(code) else code

    def phrases(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases by language and text, symbols by text); a text without a letter has no symbols.

        All blocks are parsed at once from the root first. Then each is parsed again from the state in which the block before it
        ended, beside the parse there was, until both are in one state: from there on they are the same.
        """
        coded = [self.symbols(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)) for t in texts]
        coded = [c if (c != GAP).any() else c[:0] for c in coded]
        size = np.array([len(c) for c in coded])
        flat = np.concatenate([*coded, np.zeros(0, np.uint16)])
        blocks = -(-size // BLOCK)
        text = np.repeat(np.arange(len(coded)), blocks)
        place = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = np.repeat(np.cumsum(size) - size, blocks) + place * BLOCK
        length = np.minimum(BLOCK, size[text] - place * BLOCK)
        width = len(text)
        root = np.repeat(np.array(self.root, self.table.dtype), width)  # state by language and block, flat
        ends, end = np.zeros(len(root), np.int32), root.copy()
        by = np.argsort(-length, kind="stable")
        state = root.reshape(-1, width)[:, by]
        count = np.zeros(state.shape, np.int32)
        for step in range(int(length.max(initial=0))):
            n = int(np.searchsorted(-length[by], -step, side="left"))
            went = self.table[state[:, :n] + flat[begin[by[:n]] + step]]
            count[:, :n] += went & 1
            state[:, :n] = went >> 1
        ends.reshape(-1, width)[:, by], end.reshape(-1, width)[:, by] = count, state
        entry = root
        stale = np.flatnonzero(np.tile(place > 0, len(self.languages)))
        turn = 0
        while len(stale):
            now = stale
            if turn >= TURNS:
                _, first = np.unique(stale // width * len(coded) + text[stale % width], return_index=True)
                now = stale[first]
            turn += 1
            differs = now[entry[now] != end[now - 1]]
            old, new, at = entry[differs], end[differs - 1], differs
            entry[differs] = new
            changed = []
            for step in range(BLOCK):
                if not len(at):
                    break
                symbol = flat[begin[at % width] + step]
                was, went = self.table[old + symbol], self.table[new + symbol]
                ends[at] += ((went & 1) - (was & 1)).astype(np.int32)
                old, new = was >> 1, went >> 1
                apart, over = old != new, length[at % width] == step + 1
                if (done := apart & over).any():
                    changed.append(at[done])
                    end[at[done]] = new[done]
                keep = apart & ~over
                old, new, at = old[keep], new[keep], at[keep]
            after = np.concatenate([*changed, np.zeros(0, np.int64)]) + 1
            after = after[after % width != 0]
            after = after[place[after % width] > 0]
            stale = np.union1d(np.setdiff1d(stale, now), after)
        out = np.zeros((len(self.languages), len(texts)), np.int64)
        np.add.at(out, (slice(None), text), ends.reshape(-1, width))
        return out + (size > 0), size

    def predict(self, texts: Sequence[str | None]) -> list[tuple[str, float, int | None]]:
        """(language or und, score, phrases) for each text."""
        out = []
        for a, b in chunks(texts):
            found, size = self.phrases([t or "" for t in texts[a:b]])
            cost = found * np.array(self.bits)[:, None]
            for i in range(b - a):
                if not size[i] or not self.languages:
                    out.append(("und", 0.0, None))
                    continue
                order = np.argsort(cost[:, i], kind="stable")
                first, second = cost[order[0], i], cost[order[min(1, len(order) - 1)], i]
                out.append((self.languages[order[0]], float(second / (first + second)) if len(order) > 1 else 1.0, int(found[order[0], i])))
        return out


@lru_cache(2)
def _model(samples: tuple[tuple[str, tuple[str, ...]], ...]) -> Model:
    return Model(dict(samples))


def learn(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[tuple[str, tuple[str, ...]], ...]:
    """Samples by language of labelled rows, at most SAMPLE_DOCS pieces of PIECE characters each; languages must fit the driver."""
    h = F.xxhash64(F.col(id_col), F.lit(3))
    own = rows.where(F.col(lang_col).isNotNull() & (F.char_length(text_col) > 0)).select(F.col(lang_col).cast("string").alias("lang"), h.alias("h"), F.substring(F.col(text_col), (F.pmod(h, F.greatest(F.lit(1), F.char_length(text_col) - PIECE)) + 1).cast("int"), F.lit(PIECE)).alias("piece"))
    picked = own.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "piece"))).where(f"k <= {SAMPLE_DOCS}")
    found: dict[str, list[str]] = {}
    for r in picked.orderBy("lang", "k").collect():  # SAMPLE_DOCS pieces a language
        found.setdefault(r["lang"], []).append(r["piece"])
    return tuple((k, tuple(v)) for k, v in found.items())


def identify(docs: DataFrame, samples, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, lang_score and lang_phrases (columns of these names are replaced).

    lang_pred is a language of the samples, or und with score 0 for null, texts without a letter, and when nothing was
    learned. lang_score is b / (a + b) of the normalised phrase counts a of the best and b of the second language, so 0.5 is a
    tie, which goes to the first language by name; 1 with one language only. Phrase counts are normalised by the log of the
    sample's length. A text of any length is parsed whole; all other columns pass through untouched.
    """
    docs = docs.drop("lang_pred", "lang_score", "lang_phrases")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(samples)
        for batch in batches:
            got = model.predict(batch.column(text_col).to_pylist())
            new = [pa.array([g[j] for g in got], t) for j, t in enumerate((pa.string(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "lang_pred", "lang_score", "lang_phrases"])

    return docs.mapInArrow(run, docs.withColumns({"lang_pred": F.lit("").cast("string"), "lang_score": F.lit(None).cast("double"), "lang_phrases": F.lit(None).cast("long")}).schema)
