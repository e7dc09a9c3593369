"""A gated recurrent word model in numpy: class-factored output, truncated backpropagation, state carried across windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

HIDDEN, PER_CLASS, WINDOW, TRAIN_LANES, SCORE_LANES = 16, 64, 24, 256, 1024
RATE = 0.08
#: Sums of exponentials of numbers up to this in size are normal numbers of single precision.
SAFE = 60.0
#: Long documents are learned from in segments of so many tokens, side by side; scoring carries the state through all of a document.
SEGMENT = 1_024
_F = np.float32
LOG10 = np.log(10.0)


def _soft(x: np.ndarray, bound: float) -> np.ndarray:
    """The probabilities of rows of logits, none larger in size than bound; x is overwritten."""
    if bound >= SAFE:
        x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= (x @ np.ones(x.shape[1], _F))[:, None]
    return x


def _log_sum(x: np.ndarray, bound: float) -> np.ndarray:
    """Log of the sum of the exponentials of each row; x is overwritten. No number of x is larger in size than bound: where that is
    small, the exponentials need no shift by each row's greatest."""
    if bound < SAFE:
        np.exp(x, out=x)
        return np.log(x @ np.ones(x.shape[1], _F))
    top = x.max(axis=1, keepdims=True)
    x -= top
    np.exp(x, out=x)
    return np.log(x.sum(axis=1)) + top[:, 0]


def _bounds(w: dict[str, np.ndarray]) -> tuple[float, np.ndarray]:
    """What no logit of a class exceeds in size, and none of a word in each class, as states are between -1 and 1."""
    outer = (np.abs(w["class"]).sum(axis=0) + np.abs(w["class_bias"])).max(initial=0)
    return float(outer), (np.abs(w["word"]).sum(axis=2) + np.abs(w["word_bias"])).max(axis=1, initial=0)


def lanes(docs: Sequence[np.ndarray], width: int) -> tuple[list[list[int]], np.ndarray]:
    """Documents dealt to at most `width` lanes, longest first to the shortest lane; lanes by falling length, and the lengths."""
    import heapq

    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    heap = [(0, k) for k in range(min(width, max(1, len(docs))))]
    out: list[list[int]] = [[] for _ in heap]
    for i in order:
        n, k = heapq.heappop(heap)
        out[k].append(i)
        heapq.heappush(heap, (n + len(docs[i]), k))
    size = [sum(len(docs[i]) for i in lane) for lane in out]
    by = sorted(range(len(out)), key=lambda k: -size[k])
    return [out[k] for k in by], np.array([size[k] for k in by])


class Lanes:
    """Documents in lanes, one after the other: memory is that of the tokens, however long a document is."""

    def __init__(self, docs: Sequence[np.ndarray], width: int) -> None:
        dealt, self.size = lanes(docs, width)
        order = [i for lane in dealt for i in lane]
        self.begin = np.concatenate([[0], np.cumsum(self.size)])[:-1].astype(np.int64)
        length = np.array([len(docs[i]) for i in order], np.int64)
        self.token = np.concatenate([docs[i] for i in order]) if order else np.zeros(0, np.int32)
        self.doc = np.repeat(np.array(order, np.int32), length)
        self.first = np.zeros(len(self.token), bool)
        self.first[(np.cumsum(length) - length)[length > 0]] = True

    def windows(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(lanes with a token at the window's start, for each step the places of the tokens in the lanes that go on)."""
        for start in range(0, int(self.size[0]) if len(self.size) else 0, WINDOW):
            stop = min(start + WINDOW, int(self.size[0]))
            alive = np.searchsorted(-self.size, -np.arange(start, stop), side="left")
            yield int(alive[0]), [self.begin[:n] + t for t, n in zip(range(start, stop), alive.tolist(), strict=True)]


class Model:
    """Tokens 0 to n - 1 are head words, by falling count; token n is any other word, and a class of its own.

    A head word's probability is that of its class times that within the class. Other words share the last class's
    probability in proportion to their smoothed counts, which is left to the caller. Before training the model is the
    unigram model of the counts.
    """

    def __init__(self, counts: Sequence[int], rest: float, seed: int = 1) -> None:
        self.n = len(counts)
        self.past: dict[str, np.ndarray] | None = None  # sums of squared slopes
        self.classes = -(-self.n // PER_CLASS)
        rng = np.random.default_rng(seed)
        padded = np.zeros(self.classes * PER_CLASS)
        padded[: self.n] = counts
        inner = np.where(np.arange(len(padded)) < self.n, np.log(np.maximum(padded, 1e-3)), -30.0).reshape(self.classes, PER_CLASS)
        outer = np.log(np.maximum([*padded.reshape(self.classes, PER_CLASS).sum(axis=1), rest], 1e-3))
        h = HIDDEN
        self.weights = {
            "enter": rng.normal(0, 0.1, (self.n + 2, 3 * h)), "turn": rng.normal(0, h**-0.5, (h, 3 * h)), "bias": np.zeros(3 * h),
            "class": rng.normal(0, 0.02, (h, self.classes + 1)), "class_bias": outer - outer.max(),
            "word": rng.normal(0, 0.02, (self.classes, PER_CLASS, h)), "word_bias": inner - inner.max(axis=1, keepdims=True) if self.classes else inner,
        }
        self.weights = {k: np.ascontiguousarray(v, _F) for k, v in self.weights.items()}

    def packed(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.weights.values()])

    def unpack(self, flat: np.ndarray) -> Model:
        at = 0
        for k, v in self.weights.items():
            self.weights[k] = flat[at : at + v.size].reshape(v.shape).astype(_F)
            at += v.size
        return self

    def _step(self, token: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        w, h = self.weights, HIDDEN
        a = w["enter"][token]
        a += w["bias"]
        u = state @ w["turn"]
        gate = np.tanh((a[:, : 2 * h] + u[:, : 2 * h]) * _F(0.5)) * _F(0.5) + _F(0.5)
        keep, reset = gate[:, :h], gate[:, h:]
        new = np.tanh(a[:, 2 * h :] + reset * u[:, 2 * h :])
        return new + keep * (state - new), keep, reset, new, u[:, 2 * h :]

    def _groups(self, token: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        kind = self._kinds(token)
        order = np.argsort(kind, kind="stable")
        ends = np.searchsorted(kind[order], np.arange(self.classes + 1))
        for c in range(self.classes):
            if ends[c] < ends[c + 1]:
                yield c, order[ends[c] : ends[c + 1]]

    def _kinds(self, token: np.ndarray) -> np.ndarray:
        return np.where(token >= self.n, self.classes, token // PER_CLASS)

    def log10(self, docs: Sequence[np.ndarray]) -> np.ndarray:
        """Log10 probability of each document; for words outside the head, of the last class alone. No window bounds the state."""
        out = np.zeros(len(docs))
        dealt = Lanes(docs, SCORE_LANES)
        state, before = np.zeros((len(dealt.size), HIDDEN), _F), np.zeros(len(dealt.size), np.int32)
        outer, inners = _bounds(self.weights)
        for _, steps in dealt.windows():
            seen = []
            for at in steps:
                n = len(at)
                fresh = dealt.first[at]
                state[:n][fresh] = 0
                state[:n] = self._step(np.where(fresh, self.n + 1, before[:n]), state[:n])[0]
                seen.append(state[:n].copy())
                before[:n] = dealt.token[at]
            at, s = np.concatenate(steps), np.concatenate(seen)
            y = dealt.token[at]
            logits = s @ self.weights["class"]
            logits += self.weights["class_bias"]
            got = logits[np.arange(len(y)), self._kinds(y)] - _log_sum(logits, outer)
            for c, where in self._groups(y):
                inner = s[where] @ self.weights["word"][c].T
                inner += self.weights["word_bias"][c]
                got[where] += inner[np.arange(len(where)), y[where] % PER_CLASS] - _log_sum(inner, inners[c])
            out += np.bincount(dealt.doc[at], got, len(docs))
        return out / LOG10

    def train(self, docs: Sequence[np.ndarray]) -> int:
        """One pass of Adagrad over the documents in windows of WINDOW steps; returns the number of tokens."""
        docs = [d[a : a + SEGMENT] for d in docs for a in range(0, len(d), SEGMENT)]
        dealt = Lanes(docs, TRAIN_LANES)
        width, w, h = len(dealt.size), self.weights, HIDDEN
        if self.past is None:
            self.past = {k: np.full(v.shape, 1e-4, _F) for k, v in w.items()}
        state, before = np.zeros((width, h), _F), np.zeros(width, np.int32)
        for _, steps in dealt.windows():
            kept, seen = [], []
            for at in steps:
                n = len(at)
                fresh = dealt.first[at]
                old = state[:n]
                old[fresh] = 0
                into = np.where(fresh, self.n + 1, before[:n])
                new = self._step(into, old)
                kept.append((into, old.copy(), fresh, *new))
                seen.append(new[0])
                state[:n], before[:n] = new[0], dealt.token[at]
            at, s = np.concatenate(steps), np.concatenate(seen)
            y = dealt.token[at]
            p = s @ w["class"]
            p += w["class_bias"]
            most, mosts = _bounds(w)
            p = _soft(p, most)
            p[np.arange(len(y)), self._kinds(y)] -= 1
            grads = {"class": s.T @ p, "class_bias": p.sum(axis=0), "word": np.zeros_like(w["word"]), "word_bias": np.zeros_like(w["word_bias"]), "turn": np.zeros_like(w["turn"])}
            back = p @ w["class"].T
            for c, where in self._groups(y):
                own = s[where]
                q = own @ w["word"][c].T
                q += w["word_bias"][c]
                q = _soft(q, mosts[c])
                q[np.arange(len(where)), y[where] % PER_CLASS] -= 1
                grads["word"][c], grads["word_bias"][c] = q.T @ own, q.sum(axis=0)
                back[where] += q @ w["word"][c]
            carry = np.zeros((width, h), _F)
            slopes, end = [], len(y)
            for into, old, fresh, _, keep, reset, new, un in reversed(kept):
                n = len(into)
                g = back[end - n : end] + carry[:n]
                end -= n
                outer = np.empty((n, 3 * h), _F)
                d_new = g * (1 - keep) * (1 - new * new)
                outer[:, :h] = g * (old - new) * keep * (1 - keep)
                outer[:, h : 2 * h] = d_new * un * reset * (1 - reset)
                outer[:, 2 * h :] = d_new
                inner = outer.copy()
                inner[:, 2 * h :] *= reset
                grads["turn"] += old.T @ inner
                slopes.append((into, outer))
                carry[:n] = g * keep + inner @ w["turn"].T
                carry[:n][fresh] = 0
            into, outer = np.concatenate([x for x, _ in slopes]), np.concatenate([x for _, x in slopes])
            grads["bias"] = outer.sum(axis=0)
            order = np.argsort(into, kind="stable")
            rows, starts = np.unique(into[order], return_index=True)
            scale = _F(1 / max(1, width))
            self._move("enter", np.add.reduceat(outer[order], starts, axis=0) * scale, rows)
            for k, g in grads.items():
                self._move(k, g * scale)
        return len(dealt.token)

    def _move(self, name: str, g: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        """A step of Adagrad for the rows of a weight."""
        np.clip(g, -1, 1, out=g)
        past = self.past[name][rows] + g * g
        self.past[name][rows] = past
        g *= _F(RATE)
        g /= np.sqrt(past)
        self.weights[name][rows] -= g
