"""Secret scans: fixed patterns, and a linear-chain conditional random field over words."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnum import Words, chunks

# The base patterns, and the least length of what they must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "crf")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Bounds of the training sample: documents with a keyword or access prefix, others, and pieces of PIECE words of them.
HINTED, OTHERS, PIECE, PIECES = 256, 256, 24, 8_000
#: Characters of a sampled text that pieces are cut from, beginning at a place by a hash of its id.
SAMPLE_CHARS = 20_000
#: Views of a secret without its keyword that the field learns from.
VARIANTS = 3
TURNS, RATE, DECAY = 150, 0.1, 1e-4
OUT, BEGIN, INSIDE = 0, 1, 2
_KEYWORD = re.compile(rb"(?i)" + b"|".join(KEYWORDS))
_LONG = re.compile(r"[0-9a-f]{32,}")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base patterns in code points: leftmost matches that do not overlap within a kind, short ones dropped."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


# a word's features, each a range of ids in one table: shape, keyword, words before, word after, the two
# neighbouring words by hash, and the file
_SIZES = (400, 4, 8, 4, 2048, 2048, 10)
_BASE = np.concatenate([[0], np.cumsum(_SIZES)])[:-1]
PAD = sum(_SIZES)
# a shape's weights are sums over what makes it up, so that shapes never seen are judged by their parts: steps of length, steps
# of changes of character class, and whether there are digits, capitals, small letters and marks
_STEPS = (8, 16, 24, 40), (2, 4, 8, 16)
_PARTS = np.array([[*(k // 80 > i for i in range(4)), *(k % 5 > i for i in range(4)), *(k // 5 % 16 >> i & 1 for i in range(4))] for k in range(_SIZES[0])], float)


class Features:
    """Of all words of some texts, as ids into the weight table."""

    def __init__(self, texts: Sequence[str | None]) -> None:
        self.words = w = Words(texts)
        n = len(w.starts)
        raw = np.frombuffer(w.raw, np.uint8)
        digit, upper, lower = (raw >= 48) & (raw <= 57), (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122)
        mark = np.isin(raw, np.frombuffer(b"=:_\"'-/+", np.uint8))

        def has(mask: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
            return total[w.ends] - total[w.starts]

        kinds = digit * 1 + upper * 2 + lower * 3
        turns = np.digitize(has(np.concatenate([[False], kinds[1:] != kinds[:-1]])), _STEPS[1])
        digits = has(digit) > 0
        length = w.ends - w.starts
        self.shape = (np.digitize(length, _STEPS[0]) * 16 + digits * 8 + (has(upper) > 0) * 4 + (has(lower) > 0) * 2 + (has(mark) > 0)) * 5 + turns
        self.keyed = np.zeros(n, bool)
        self.hinted = np.zeros(len(texts), bool)  # documents with a keyword
        self.longs = np.zeros(len(texts), bool)  # documents with a word of 32 bytes or more
        low = w.low.tobytes()
        for i in range(len(texts)):
            a, b = int(w.begin[i]), int(w.begin[i + 1])
            if any(low.find(k, a, b) >= 0 for k in KEYWORDS):
                self.hinted[i] = True
                for m in _KEYWORD.finditer(w.raw, a, b):
                    self.keyed[np.searchsorted(w.starts, m.start(), side="right") - 1] = True
        doc = np.repeat(np.arange(len(texts)), np.diff(w.first))
        self.longs[doc[length >= 32]] = True
        equal = has((raw == 58) | (raw == 61)) > 0
        key = self.keyed * 2 + equal

        def shifted(x: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros_like(x)
            if by > 0:
                out[by:] = np.where(doc[by:] == doc[:-by], x[:-by], 0)
            else:
                out[:by] = np.where(doc[:by] == doc[-by:], x[-by:], 0)
            return out

        small = (w.hashes() % np.uint64(2047)).astype(np.int64) + 1
        share = np.bincount(doc, digits, len(texts)) / np.maximum(1, np.diff(w.first))
        file = np.digitize(share, [1e-9, 0.002, 0.01, 0.05]) * 2 + self.hinted
        columns = (self.shape, key, shifted(key, 1) * 2 + shifted(self.keyed.astype(np.int64), 2), shifted(digits * 2 + (length >= 16), -1), shifted(small, 1), shifted(small, -1), file[doc])
        self.ids = np.stack([c.astype(np.int64) + b for c, b in zip(columns, _BASE, strict=True)], axis=1).astype(np.int32)
        self.digits = digits

    def bytes_at(self, i: int, text: str, point: int) -> int:
        return int(self.words.begin[i]) + len(text[:point].encode("utf-8", "surrogatepass"))

    def points(self, i: int, a: int, b: int) -> tuple[int, int]:
        """Code points of the bytes a to b of text i."""
        begin = int(self.words.begin[i])
        start = len(self.words.raw[begin:a].decode("utf-8", "surrogatepass"))
        return start, start + len(self.words.raw[a:b].decode("utf-8", "surrogatepass"))


class Field:
    """Weights of a chain of labels outside, begin and inside: emissions by feature and transitions."""

    def __init__(self, emit: np.ndarray, move: np.ndarray) -> None:
        self.emit, self.move = emit, move

    @classmethod
    def fit(cls, ids: np.ndarray, labels: np.ndarray) -> Field:
        """Maximum conditional likelihood by forward and backward sums; ids (pieces, words, features), labels (pieces, words)."""
        n, t, _ = ids.shape
        weights = [np.zeros((PAD + 1, 3)), np.zeros((3, 3)), np.zeros((_PARTS.shape[1], 3))]
        weights[0][:, OUT] = 0.5
        moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
        truth = np.eye(3)[labels]
        pairs = np.zeros((3, 3))
        np.add.at(pairs, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1)
        flat = ids.reshape(-1, ids.shape[2])
        for turn in range(1, TURNS + 1):
            weights[0][: _SIZES[0]] = _PARTS @ weights[2]
            emit = weights[0][ids].sum(axis=2)
            move = np.exp(weights[1])
            e = np.exp(emit - emit.max(axis=2, keepdims=True))
            ahead, back = np.empty((t, n, 3)), np.empty((t, n, 3))
            ahead[0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
            for k in range(1, t):
                a = (ahead[k - 1] @ move) * e[:, k]
                ahead[k] = a / a.sum(axis=1, keepdims=True)
            back[t - 1] = 1
            for k in range(t - 2, -1, -1):
                b = (back[k + 1] * e[:, k + 1]) @ move.T
                back[k] = b / b.sum(axis=1, keepdims=True)
            one = ahead * back
            one /= one.sum(axis=2, keepdims=True)
            two = np.zeros((3, 3))
            for k in range(t - 1):
                both = ahead[k][:, :, None] * move * (back[k + 1] * e[:, k + 1])[:, None, :]
                two += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            wrong = (one.transpose(1, 0, 2) - truth).reshape(-1, 3)
            slope = np.stack([sum(np.bincount(flat[:, f], wrong[:, y], PAD + 1) for f in range(flat.shape[1])) for y in range(3)], axis=1)
            parts = _PARTS.T @ slope[: _SIZES[0]]
            for w, g, m in zip(weights, (slope / n + DECAY * weights[0], (two - pairs) / n + DECAY * weights[1], parts / n + DECAY * weights[2]), moments, strict=True):
                m[0][:] = 0.9 * m[0] + 0.1 * g
                m[1][:] = 0.99 * m[1] + 0.01 * g * g
                w -= RATE * (m[0] / (1 - 0.9**turn)) / (np.sqrt(m[1] / (1 - 0.99**turn)) + 1e-8)
        weights[0][: _SIZES[0]] = _PARTS @ weights[2]
        return cls(*weights[:2])

    def viterbi(self, emit: np.ndarray, before: bool = False, after: bool = False) -> list[int]:
        """The best labels; before, after: a word labelled outside stands there."""
        best, came = emit[0] + (self.move[OUT] if before else 0), []
        for e in emit[1:]:
            through = best[:, None] + self.move
            came.append(through.argmax(axis=0))
            best = through.max(axis=0) + e
        at = int((best + (self.move[:, OUT] if after else 0)).argmax())
        path = [at]
        for c in reversed(came):
            path.append(at := int(c[at]))
        return path[::-1]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Labels of the best path of each text.

        A word whose outside emission leads by more than two transitions can change is outside on the best path; such
        words cut the chain, and Viterbi runs over what is between them.
        """
        emit = np.zeros((len(ids), 3))
        for f in range(ids.shape[1]):
            emit += self.emit[ids[:, f]]
        free = emit[:, OUT] - emit[:, 1:].max(axis=1, initial=-np.inf) <= 2 * (self.move.max() - self.move.min())
        labels = np.zeros(len(ids), np.int8)
        inner = np.zeros(len(ids) + 1, bool)
        inner[first] = True
        at = np.flatnonzero(free)
        if not len(at):
            return labels
        cut = np.flatnonzero((np.diff(at) > 1) | inner[at[1:]]) + 1
        for run in np.split(at, cut):
            a, b = int(run[0]), int(run[-1]) + 1
            labels[a:b] = self.viterbi(emit[a:b], not inner[a], b < len(ids) and not inner[b])
        return labels


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """A field fitted to base spans in a bounded sample: HINTED documents with a keyword or prefix and OTHERS, by a hash of the id,
    SAMPLE_CHARS characters of each. Null ids and texts teach nothing; without rows the field tags nothing."""
    text = F.col(text_col)
    low = F.lower(text)
    hint = text.contains("AKIA")
    for k in KEYWORDS:
        hint = hint | low.contains(k.decode())
    key = docs.where(text.isNotNull()).select(F.col(id_col).alias("i"), F.xxhash64(F.col(id_col), F.lit(5)).alias("h"), hint.alias("hint"), F.char_length(text).alias("c"))
    pick = key.where("hint").orderBy("h", "i").limit(HINTED).unionAll(key.where("not hint").orderBy("h", "i").limit(OTHERS))
    begin = (F.pmod(F.xxhash64("i", F.lit(9)), F.greatest(F.lit(1), F.char_length(text_col) - SAMPLE_CHARS + 1)) + 1).cast("int")
    texts = docs.join(F.broadcast(pick.select("i").distinct()), F.col(f"`{id_col}`") == F.col("i")).select(F.xxhash64("i").alias("h"), F.substring(F.col(text_col), begin, F.lit(SAMPLE_CHARS)).alias("t"))
    sample = [r["t"] for r in texts.orderBy("h", "t").limit(HINTED + OTHERS).collect()]
    return Field.fit(*_pieces(sample))


def _pieces(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pieces around secrets, around words with digits and from anywhere, in two views: as they are, and, for pieces with a secret,
    as if no keyword stood there, where only the secret's own word is tagged. So the field learns what secrets look like."""
    rng = np.random.default_rng(7)
    ids, labels = [], []

    def add(i: np.ndarray, y: np.ndarray) -> None:
        ids.append(np.concatenate([i, np.full((PIECE - len(i), i.shape[1]), PAD, np.int32)]))
        labels.append(np.concatenate([y, np.zeros(PIECE - len(y), np.int64)]))

    for text in texts:
        f = Features([text])
        n = len(f.ids)
        label, bare = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for a, b, _ in base_spans(text):
            a, b = f.bytes_at(0, text, a), f.bytes_at(0, text, b)
            inside = np.flatnonzero((f.words.starts < b) & (f.words.ends > a))
            label[inside] = INSIDE
            label[inside[:1]] = BEGIN
            bare[[k for k in inside if f.digits[k] and f.words.ends[k] - f.words.starts[k] >= LEAST["assign"] and not f.keyed[k]]] = BEGIN
        hidden = f.ids.copy()
        hidden[:, 1] = _BASE[1] + (f.ids[:, 1] - _BASE[1]) % 2
        hidden[:, 2] = _BASE[2]
        hidden[:, 6] = _BASE[6] + (f.ids[:, 6] - _BASE[6]) // 2 * 2
        plain = np.flatnonzero(f.digits & (label == OUT))
        middles = [*np.flatnonzero(label == BEGIN)[:4], *(rng.permutation(plain)[:6] if len(plain) else []), *rng.integers(0, max(1, n), 4)]
        for m in middles if n else []:
            a = max(0, int(m) - PIECE // 2)
            add(f.ids[a : a + PIECE], label[a : a + PIECE])
        for m in np.flatnonzero(bare)[:4]:
            a = max(0, int(m) - PIECE // 2)
            for _ in range(VARIANTS):
                # another secret of the kind: as long or a step or two shorter, with or without capitals and marks
                k = int(f.ids[m, 0])
                flags = (k // 5 % 16) ^ int(rng.choice([0, 1, 4, 5]))
                view = hidden[a : a + PIECE].copy()
                view[m - a, 0] = max(2, k // 80 - int(rng.integers(0, 3))) * 80 + flags * 5 + k % 5
                add(view, bare[a : a + PIECE])
    if not ids:
        ids, labels = [np.full((PIECE, len(_SIZES)), PAD, np.int32)], [np.zeros(PIECE, np.int64)]
    return np.stack(ids[:PIECES]), np.stack(labels[:PIECES])


def find(texts: Sequence[str | None], field: Field) -> Iterator[list[Span]]:
    """All spans of each text in order: base spans, and those of the field that overlap none of them."""
    for lo, hi in chunks(texts):
        part = [t or "" for t in texts[lo:hi]]
        f = Features(part)
        w = f.words
        labels = field.decode(f.ids, w.first)
        tagged = np.flatnonzero(labels)
        for i, text in enumerate(part):
            spans: list[Span] = []
            if f.hinted[i]:
                spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
            if "AKIA" in text:
                spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
            if f.longs[i]:
                spans += [(m.start(), m.end(), "hex") for m in _LONG.finditer(text)]
            own = tagged[np.searchsorted(tagged, w.first[i]) : np.searchsorted(tagged, w.first[i + 1])]
            found: list[list[int]] = []
            for k in own.tolist():
                if found and labels[k] == INSIDE and found[-1][1] == k - 1:
                    found[-1][1] = k
                else:
                    found.append([k, k])
            base = list(spans)
            for a, b in found:
                start, end = f.points(i, int(w.starts[a]), int(w.ends[b]))
                while start < end and text[start] in "\"'.,;:()[]{}":
                    start += 1
                while end > start and text[end - 1] in "\"'.,;:()[]{}":
                    end -= 1
                if start < end and not any(x < end and start < y for x, y, _ in base):
                    spans.append((start, end, "crf"))
            yield in_order(spans)


def scan(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf for every row.

    spans: kind:start:end in code points, end exclusive, by start and then kind, comma-joined; base_sha256 is of the base
    spans alone. Null text counts as empty and has none; texts of any length are read whole; repeated rows and null ids give rows
    of their own; extra columns are ignored.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_crf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for spans in find(batch.column("text").to_pylist(), field):
                base = [s for s in spans if s[2] != "crf"]
                count = [sum(s[2] == k for s in base) for k in ("assign", "access", "hex")]
                rows.append((*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans) - len(base)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds))], names)

    return slim.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_crf long")
