"""Each operator against a plain version on a small table with nulls, empties, ties, repeated rows and clashing columns."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquilt.llm import exact_dedup, gru, langid, line_dedup, lm, minhash, mixing, packing, quality, resharding, secrets
from skyquilt.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(0)
    links = [tuple(map(int, p)) for p in rng.integers(0, 200, (150, 2))] + [(i, i + 1) for i in range(300, 360)]
    want = roots(links, {x for p in links if p[0] != p[1] for x in p})
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1 ---------------------------------------------------------------------------------------------------------
def shingles(text, k):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize(("k", "percent", "small"), [(3, 85, None), (5, 80, None), (3, 60, (4, 6))])
def test_near_duplicates(docs, rows, monkeypatch, k, percent, small):
    if small:
        monkeypatch.setattr(minhash, "SMALL", small[0])
        monkeypatch.setattr(minhash, "PART", small[1])
        monkeypatch.setattr(minhash, "HUBS", 1)
    sets = {r[0]: shingles(r[1], k) for r in rows if r[0] is not None}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = roots(links, ids)
    got = minhash.near_duplicates(docs, k, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    assert len(set(want.values())) < len(ids) - 10


def test_near_duplicates_edges(empty, clashing, rows):
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.near_duplicates(clashing).count() == len(rows)


def test_a_crowd_of_near_copies_is_one_group(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 8)
    monkeypatch.setattr(minhash, "PART", 16)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(150):
        w = list(base)
        w[i * 2 % 300] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r["component_id"] for r in got} == {0}


# -- 2 ---------------------------------------------------------------------------------------------------------
def test_minimum_cost_flow_is_least():
    rng = np.random.default_rng(2)
    for _ in range(20):
        supply = rng.integers(0, 50, 5).tolist()
        capacity = resharding.equal_capacities(sum(supply), 7)
        flow = resharding.minimum_cost_flow(supply, capacity, lambda i, j: int(i != j))
        assert [sum(v for (i, _), v in flow.items() if i == k) for k in range(5)] == supply
        assert [sum(v for (_, j), v in flow.items() if j == k) for k in range(7)] == capacity
        assert sum(v for (i, j), v in flow.items() if i != j) == sum(supply) - sum(min(s, c) for s, c in zip(supply, capacity, strict=False))
    with pytest.raises(ValueError, match="differ"):
        resharding.minimum_cost_flow([1], [2], lambda i, j: 0)


def test_reshard(docs, rows, clashing, empty, tmp_path, spark, monkeypatch):
    monkeypatch.setattr(resharding, "BLOCK_ROWS", 20)
    old = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    placed, flow = resharding.reshard(docs, old, 4, 6)
    got = placed.collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    total = sum(r["size"] for r in got)
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    assert all(v for k, v in flow.items()) and sum(flow.values()) == total
    # without the one row that is larger than a shard, sizes are equal but for less than a row
    even, flow = resharding.reshard(docs.where("length(text) < 10000"), old, 4, 6)
    even = even.collect()
    by, moved = Counter(), Counter()
    for r in even:
        by[r["shard"]] += r["size"]
        moved[r["old_shard"], r["shard"]] += r["size"]
    median = sorted(r["size"] for r in even)[len(even) // 2]
    assert all(abs(by[s] - sum(by.values()) / 6) <= median for s in range(6))
    assert all(abs(moved[k] - flow.get(k, 0)) <= 2 * median for k in set(moved) | set(flow))
    assert resharding.reshard(clashing, old, 4, 6)[0].count() == len(rows)
    assert resharding.reshard(empty, old, 4, 6)[0].count() == 0
    root = str(tmp_path / "shards")
    done = resharding.rewrite_affected(docs, resharding.solve(docs, old, 4, 6), root)
    back = spark.read.parquet(root).collect()
    assert {r["shard"] for r in back} <= set(done)
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((r["doc_id"], t) for r in got if r["shard"] in done for t in [next(x[1] for x in rows if x[0] == r["doc_id"] and zlib.crc32((x[1] or "").encode()) == r["text_crc32"])])
    assert resharding.rewrite_affected(empty, resharding.solve(empty, old, 4, 6), root) == []
    with pytest.raises(ValueError, match="overwritten"):
        resharding.rewrite_affected(spark.read.parquet(root).drop("shard"), resharding.solve(docs, old, 4, 6), root)


def test_equal_rows_stay_together_and_large_ones_do_not_straddle(spark):
    rows = [(1, "same")] * 50 + [(i, "x" * (10 + i)) for i in range(2, 200)] + [(1000, "y" * 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = resharding.reshard(docs, F.lit(0), 1, 3)[0].collect()
    size = Counter()
    for r in got:
        size[r["shard"]] += r["size"]
    assert len(got) == len(rows) and max(size.values()) - min(size.values()) <= 50 * 20
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == 1


# -- 3 ---------------------------------------------------------------------------------------------------------
def slow_best_fit(items, capacity):
    bins, out = [], []
    for size, source, cluster in items:
        fit = [(left, b) for b, (left, s, c) in enumerate(bins) if left >= size and not s & source and not c & cluster]
        if fit:
            _, b = min(fit)
        else:
            b = len(bins)
            bins.append((capacity, 0, 0))
        left, s, c = bins[b]
        out.append((b, capacity - left))
        bins[b] = (left - size, s | source, c | cluster)
    return out


def test_best_fit_takes_the_tightest_compatible_bin():
    rng = np.random.default_rng(4)
    for _ in range(50):
        items = [(int(rng.integers(1, 40)), 1 << int(rng.integers(0, 4)), int(rng.choice([0, 1, 2, 4]))) for _ in range(60)]
        assert packing.best_fit(items, 64) == slow_best_fit(items, 64)


def test_pack(docs, rows, empty, clashing, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 50)
    got = packing.pack(docs, 64).collect()
    size = Counter()
    for r in got:
        size[r["doc_id"]] += r["n_tokens"]
    want = Counter()
    for r in rows:
        want[r[0]] += len(WORD.findall(r[1] or ""))
    assert size == want
    by = defaultdict(list)
    for r in got:
        if r["bin_id"] is None:
            assert r["n_tokens"] == 0
        else:
            by[r["bin_id"]].append(r)
    about = {r[0]: r for r in rows}
    for b in by.values():
        b.sort(key=lambda r: r["offset"])
        assert sum(r["n_tokens"] for r in b) <= 64 and [r["offset"] for r in b] == [sum(x["n_tokens"] for x in b[:i]) for i in range(len(b))]
        sources = [about[r["doc_id"]][3] for r in b]
        assert len(set(sources)) == len(sources)
    assert packing.pack(empty).count() == 0 and packing.pack(clashing).count() >= len(rows)


def test_pieces_have_their_texts(docs, rows, empty, clashing):
    capacity = 64
    got = packing.with_texts(packing.pack(docs, capacity), docs, capacity).collect()
    texts = defaultdict(Counter)
    for r in docs.collect():
        texts[r["doc_id"]][r["text"] or ""] += 1
    want = Counter()
    for i, own in texts.items():
        for t, times in own.items():
            words = WORD.findall(t)
            for k in range(max(1, -(-len(words) // capacity))):
                want[i, k, " ".join(words[k * capacity : (k + 1) * capacity]) if len(words) > capacity else t] += times
    assert Counter((r["doc_id"], r["piece"], r["piece_text"]) for r in got) == want
    assert all(len(WORD.findall(r["piece_text"])) == r["n_tokens"] for r in got)
    assert packing.with_texts(packing.pack(empty), empty).count() == 0
    assert packing.with_texts(packing.pack(clashing), clashing).count() >= len(rows)


# -- 4 ---------------------------------------------------------------------------------------------------------
def plain_features(text):
    text = text or ""
    w = WORD.findall(text)
    runs = Counter(zip(w, w[1:], w[2:]))
    cover = {p for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)


def test_quality_features_and_verdict(docs, rows, empty, clashing):
    got = quality.judge(docs).collect()
    want = Counter((r[0], *plain_features(r[1])) for r in rows)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)
    assert quality.judge(empty).count() == 0 and quality.judge(clashing).count() == len(rows)


def test_expectation_maximisation_finds_planted_accuracies():
    rng = np.random.default_rng(5)
    n, bad = 20_000, 0.1
    truth = rng.random(n) >= bad
    counts, right = Counter(), defaultdict(Counter)
    for good in truth:
        votes = "".join("-" if rng.random() < 0.1 else ("b" if rng.random() < 0.01 else "g") if good else ("b" if rng.random() < 0.7 else "g") for _ in range(5))
        counts[votes] += 1
        right[votes][bool(good)] += 1
    post, share, chance = quality.expectation_maximisation(counts)
    assert abs(share - 0.9) < 0.02
    hit = sum(c for v, each in right.items() for good, c in each.items() if (post[v] >= 0.5) == good)
    assert hit / n > 0.98
    assert all(abs(c[quality.BAD][quality.BAD] / (1 - c[quality.BAD][quality.NONE]) - 0.7) < 0.08 for c in chance)


# -- 5 ---------------------------------------------------------------------------------------------------------
def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(q[-1] + 1, p[j] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


@pytest.mark.parametrize(("crowd", "hot"), [(2048, 1_000), (2, 1_000), (2048, 1)])
def test_fuzzy_lines(spark, rows, monkeypatch, crowd, hot):
    """Against edit similarity of all pairs, whatever keys and signatures the operator finds them by."""
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    monkeypatch.setattr(line_dedup, "HOT", hot)
    if hot == 1:
        monkeypatch.setattr(line_dedup, "_hot", lambda keys: line_dedup.written(keys.select("key").distinct(), "hot"))
    few = [r for r in rows if r[0] is None or r[0] < 70 or r[0] > 119 and r[0] != 125]
    docs = spark.createDataFrame(few, "doc_id long, text string, lang string, source string, n_chars long")
    norm = lambda x: re.sub(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ", x.lower()).strip(" ")
    lines = [(r[0], i, norm(x)) for r in few if r[1] is not None for i, x in enumerate(r[1].split("\n")) if norm(x)]
    texts = sorted({x[2] for x in lines})
    links = []
    for i, a in enumerate(texts):
        for b in texts[:i]:
            longest, bags = max(len(a), len(b)), Counter(a) - Counter(b)
            if 100 * min(len(a), len(b)) >= 80 * longest and 100 * (longest - bags.total()) >= 80 * longest:
                x, y = (a.split(" "), b.split(" ")) if longest > line_dedup.LONG else (a, b)
                if 100 * (max(len(x), len(y)) - distance(x, y)) >= 80 * max(len(x), len(y)):
                    links.append((a, b))
    group = roots(links, texts)
    first = {}
    for d, i, x in sorted(lines, key=lambda y: (y[0] is not None, y[0] or 0, y[1])):
        first.setdefault(group[x], (d, i))
    gone = {(d, i) for d, i, x in lines if first[group[x]] != (d, i)}
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    decided = {(r["doc_id"], i) for r in line_dedup.line_decisions(docs).collect() for i in r["dropped"]}
    assert decided <= gone and len(decided) >= 0.97 * len(gone) > 0
    text = {r[0]: r[1] for r in few}
    for r in got.collect():
        t = text[r["doc_id"]]
        left = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (r["doc_id"], i) not in decided)
        assert r["text"] == left
        assert r["n_lines"] == (0 if t is None else len(t.split("\n")))


def test_fuzzy_lines_edges(empty, clashing, rows):
    assert line_dedup.dedup_lines(empty).count() == 0
    assert line_dedup.dedup_lines(clashing).count() == len(rows) == line_dedup.line_decisions(clashing).count()


# -- 6 ---------------------------------------------------------------------------------------------------------
def plain_exact(rows):
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    for r in rows:
        groups[norm(r[1])].append(r)
    out = Counter()
    for n, g in groups.items():
        keep = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        for r in g:
            out[(r[0], keep, len(g), r[0] == keep, hashlib.sha256(n.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, docs, rows, weak):
    """A weak digest makes false hits, which the check of full bytes takes apart."""
    of = (lambda c: F.substring(F.sha2(c, 256), 1, 1)) if weak else exact_dedup.digest
    got = exact_dedup.exact_dedup(spark, docs.path, of=of).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got) == plain_exact(rows)


def test_exact_dedup_goes_on_from_its_state(spark, docs, empty, tmp_path):
    table, state = str(tmp_path / "t.parquet"), str(tmp_path / "state")
    spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string").write.parquet(table)
    assert {r["keep_id"]: r["group_size"] for r in exact_dedup.absorb(spark, table, state).collect()} == {1: 1, 2: 1}
    spark.createDataFrame([(0, "ab"), (3, " c ")], "doc_id long, text string").write.mode("append").parquet(table)
    assert {r["keep_id"]: r["group_size"] for r in exact_dedup.absorb(spark, table, state).collect()} == {1: 2, 3: 2}
    assert exact_dedup.exact_dedup(spark, empty.path).count() == 0


def test_exact_dedup_of_a_single_file_with_clashing_columns(spark, clashing, rows, tmp_path):
    table = str(tmp_path / "one")
    clashing.coalesce(1).write.parquet(table)
    import glob
    import shutil

    shutil.copy(glob.glob(f"{table}/part-*.parquet")[0], tmp_path / "documents.parquet")
    assert exact_dedup.exact_dedup(spark, str(tmp_path / "documents.parquet")).count() == len(rows)


# -- 7 ---------------------------------------------------------------------------------------------------------
def test_secret_spans(docs, rows, empty, clashing):
    field = secrets.learn(docs)
    got = secrets.scan(docs, field).collect()
    text = {(r[0], None if r[1] is None else len(r[1])): r[1] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        options = [t for (i, _), t in text.items() if i == r["doc_id"]]
        base = [secrets.base_spans(t or "") for t in options]
        assert r["base_sha256"] in [hashlib.sha256(secrets.joined(b).encode()).hexdigest() for b in base]
        kinds = Counter(x.split(":")[0] for x in r["spans"].split(",") if x)
        assert (kinds["assign"], kinds["access"], kinds["hex"], kinds["crf"]) == (r["n_assign"], r["n_access"], r["n_hex"], r["n_crf"])
    found = {r["doc_id"]: r for r in got}
    assert found[3]["n_assign"] == 1 and found[3]["n_access"] == 1 and found[4]["n_hex"] == 1 and found[4]["n_assign"] == 1
    assert secrets.scan(clashing, field).count() == len(rows)
    assert secrets.scan(empty, secrets.learn(empty)).count() == 0


def test_base_patterns():
    t = 'é Passwd:"short" API-KEY=x secret = abcdefgh token=12345678 AKIAAAAAAAAAAAAA ' + "f" * 31 + " " + "0" * 32
    assert [(k, t[a:b]) for a, b, k in secrets.base_spans(t)] == [("assign", "secret = abcdefgh"), ("assign", "token=12345678"), ("access", "AKIAAAAAAAAAAAAA"), ("hex", "0" * 32)]


def test_field_learns_and_cutting_the_chain_changes_nothing(rows):
    rng = np.random.default_rng(8)
    texts = [r[1] for r in rows if r[1]]
    secret = [t + " the key is password = " + "".join(rng.choice(list("abcdef0123456789"), 24)) + " and more" for t in texts[:80]]
    field = secrets.Field.fit(*secrets._pieces(secret + texts[80:]))
    f = secrets.Features(secret[:40] + texts[:40])
    emit = sum(field.emit[f.ids[:, k]] for k in range(f.ids.shape[1]))
    whole = [y for a, b in zip(f.words.first[:-1], f.words.first[1:], strict=True) for y in (field.viterbi(emit[a:b]) if b > a else [])]
    assert field.decode(f.ids, f.words.first).tolist() == whole
    held = texts[90] + " password = " + "".join(rng.choice(list("abcdef0123456789"), 24))
    g = secrets.Features([held])
    assert field.decode(g.ids, g.words.first)[-3:].tolist() == [1, 2, 2]


# -- 8 ---------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("known", [None, 40])
def test_scores(docs, rows, monkeypatch, known):
    if known:
        monkeypatch.setattr(lm, "KNOWN", known)
        monkeypatch.setattr(lm, "HEAD", known // 2)
    got = lm.score(docs).collect()
    toks = [(r[0], [*WORD.findall((r[1] or "").translate(LOW)), None]) for r in rows]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter(t for i, w in toks if not out(i) for t in w)
    total, distinct = sum(c.values()), len(c)
    want = Counter()
    for i, w in toks:
        want[(i, out(i), len(w), sum(c[t] > 0 for t in w), total, round(sum(math.log10((c[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in w), 5))] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_scoring_edges(empty, clashing, rows):
    assert lm.score(empty).count() == 0
    assert lm.score(clashing).count() == len(rows)


def test_model_probabilities_sum_to_one_and_state_is_carried():
    rng = np.random.default_rng(9)
    m = gru.Model([50, 40, 30, 20, 10], 25.0)
    for k in m.weights:
        m.weights[k] = (m.weights[k] + rng.normal(0, 0.3, m.weights[k].shape)).astype(np.float32)
    m.weights["word_bias"][0, 5:] = -40
    m.weights["word"][0, 5:] = 0
    head = rng.integers(0, 6, 70).astype(np.int32)
    each = m.log10([np.append(head, y).astype(np.int32) for y in range(6)])
    assert (10 ** (each - m.log10([head]))).sum() == pytest.approx(1, abs=1e-4)
    long, short = rng.integers(0, 6, 3000).astype(np.int32), rng.integers(0, 6, 4).astype(np.int32)
    assert m.log10([long, short, short])[0] == pytest.approx(m.log10([long])[0], rel=1e-5)


def test_untrained_model_is_the_unigram_and_training_helps():
    counts = [60, 30, 10]
    m = gru.Model(counts, 1e-9)
    doc = np.array([0, 1, 2, 0], np.int32)
    m.weights["class"][:] = 0
    m.weights["word"][:] = 0
    assert m.log10([doc])[0] == pytest.approx(sum(math.log10(counts[t] / 100) for t in doc), abs=1e-3)
    m = gru.Model(counts, 1e-9)
    docs = [np.array([0, 1, 2] * 40, np.int32) for _ in range(60)]
    before = m.log10(docs).sum()
    for _ in range(20):
        m.train(docs)
    assert m.log10(docs).sum() > before / 2


def test_gradient():
    """One step of training lowers the loss along the numeric gradient of a few weights."""
    rng = np.random.default_rng(10)
    docs = [rng.integers(0, 70, 20).astype(np.int32) for _ in range(5)]
    counts = list(range(70, 0, -1))
    base = gru.Model(counts, 5.0)
    trained = gru.Model(counts, 5.0)
    trained.train(docs)
    for k in ("turn", "class", "word", "enter", "bias", "word_bias"):
        moved = trained.weights[k] - base.weights[k]
        at = np.unravel_index(np.argmax(np.abs(moved)), moved.shape)
        m = gru.Model(counts, 5.0)
        eps = 0.05
        m.weights[k][at] += eps
        up = m.log10(docs).sum()
        m.weights[k][at] -= 2 * eps
        down = m.log10(docs).sum()
        if abs(up - down) > 1e-4:
            assert (up > down) == (moved[at] > 0), k


# -- 9 ---------------------------------------------------------------------------------------------------------
def slow_phrases(text, pieces):
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and any(text[i:j] in p for p in pieces):
            j += 1
        i = max(i + 1, j - 1)
        n += 1
    return n


def test_phrases_are_greedy_longest_matches():
    pieces = {"a": ["the river and the stone", "under the table"], "b": ["der fluss und der stein", "unter dem tisch"]}
    m = langid.Model(pieces)
    texts = ["the stone under the river", "und tisch", "xyz zz", "stone der table", "ÜBER the"]
    found, size = m.phrases(texts)
    for k, language in enumerate(m.languages):
        for i, t in enumerate(texts):
            assert found[k, i] == slow_phrases(t.lower(), pieces[language])
    assert size.tolist() == [len(t) for t in texts]


@pytest.mark.parametrize("block", [1, 3, 7, 256])
def test_phrases_run_across_blocks(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    pieces = {"a": ["the river and the stone", "under the table", "ababababab"], "b": ["der fluss und der stein", "xyxyxyx unter dem tisch"], "c": ["q"]}
    m = langid.Model(pieces)
    rng = np.random.default_rng(9)
    parts = ["the river", " und der", "ab", "xy", "tisch ", "ö", "q", "under the stone ", "fluss"]
    texts = ["", "ab" * 90, "xy" * 40 + "x", "q", "... 12", *("".join(rng.choice(parts, rng.integers(1, 60))) for _ in range(40))]
    found, size = m.phrases(texts)
    for k, language in enumerate(m.languages):
        for i, t in enumerate(texts):
            assert found[k, i] == (slow_phrases(re.sub(r"[^a-zö]+", " ", t), pieces[language]) if size[i] else 0), (language, t)


def test_language_identification(docs, rows, empty, clashing):
    samples = langid.learn(docs.where("doc_id % 4 <> 0"))
    got = langid.identify(docs, samples).collect()
    assert got and len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for i in (120, 121, 122, 124):
        assert by[i]["lang_pred"] == "und" and by[i]["lang_score"] == 0
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 120 and r["doc_id"] % 4 == 0 and r["doc_id"] % 6 > 1]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.9
    assert all(0 <= r["lang_score"] <= 1 for r in got)
    assert langid.identify(clashing, samples).count() == len(rows)
    assert langid.identify(empty, langid.learn(empty)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, langid.learn(empty)).collect()} == {"und"}


# -- 10 --------------------------------------------------------------------------------------------------------
def test_exponent_meets_its_limits():
    tokens = {"a": 1000, "b": 100, "c": 10, "d": 0}
    a = mixing.solve_exponent(tokens, max_repeats=3.0)
    w = mixing.weights_at(tokens, a)
    assert mixing.repeats(tokens, w, mixing.keep_all_budget(tokens, w)) == pytest.approx(3.0, rel=1e-6) and w["d"] == 0
    a = mixing.solve_exponent(tokens, target_entropy=0.8)
    assert mixing.entropy(mixing.weights_at(tokens, a)) == pytest.approx(0.8, abs=1e-6)
    assert mixing.solve_exponent({}, max_repeats=2.0) == 0.0


@pytest.mark.parametrize(("budget", "block"), [(None, 16_384), (2_000, 16_384), (2_000, 8), (9_000, 8)])
def test_mix(docs, rows, monkeypatch, budget, block):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
    got = mixing.mix(docs, budget=budget, max_repeats=2.0 if budget is None else None).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        assert r["mix_tokens"] == len(WORD.findall(r["text"] or ""))
        by[r["source"]].append(r)
    for g in by.values():
        want, tokens = g[0]["mix_budget"], sum(r["mix_tokens"] for r in g)
        taken = sum(r["mix_tokens"] * r["mix_copies"] for r in g)
        if tokens:
            assert max(r["mix_copies"] for r in g) - min(r["mix_copies"] for r in g) <= 1
            assert want <= taken < want + max(r["mix_tokens"] for r in g) + 1
        if budget is None:
            assert all(1 <= r["mix_copies"] <= 3 for r in g)
    assert abs(sum({r["source"]: r["mix_weight"] for r in got}.values()) - 1) < 1e-9


@pytest.mark.parametrize("block", [8, 16_384])
def test_last_pass_is_the_first_part_of_its_permutation(docs, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
    m = mixing.mix(docs, budget=2_000, max_repeats=None)
    by = defaultdict(list)
    for r in m.collect():
        by[r["source"]].append(r)
    whole = {k: min(r["mix_copies"] for r in g) for k, g in by.items()}
    passes = docs.sparkSession.createDataFrame([(k, v) for k, v in whole.items()], "s string, p long")
    every = m.join(passes, m["source"].eqNullSafe(passes["s"])).where("mix_tokens > 0").withColumn("mix_copies", F.col("p") + 1)
    order = sorted((r for r in mixing.realised(every).collect() if r["mix_pass"] == r["p"]), key=lambda r: (r["mix_turn"], r["mix_block"], r["mix_rank"], r["mix_key"]))
    some = 0
    for k, g in by.items():
        more = {r["mix_key"] for r in g if r["mix_copies"] > whole[k] and r["mix_tokens"]}
        keys = list(dict.fromkeys(r["mix_key"] for r in order if r["source"] == k))
        assert set(keys[: len(more)]) == more
        some += 0 < len(more) < len(keys)
    assert some
    blocks = defaultdict(set)
    for r in mixing.realised(m).collect():
        blocks[r["source"], r["mix_pass"], r["mix_turn"]].add(r["mix_block"])
    assert all(len(b) == 1 for b in blocks.values())


def test_mix_edges(docs, empty, clashing, rows):
    assert mixing.mix(empty).count() == 0 and mixing.mix(clashing).count() == len(rows)
    m = mixing.mix(docs)
    assert mixing.realised(m).count() == m.agg(F.sum("mix_copies")).first()[0]


# -- shared ----------------------------------------------------------------------------------------------------
def test_sieve_keeps_every_match(spark):
    from skyquilt.llm.common import sieve

    ids = spark.range(0, 3000).select((F.col("id") * 7919 - 5_000_000).alias("i"))
    rows = spark.range(0, 100_000).select((F.col("id") * 7919 - 5_000_000).alias("k"), F.lit("x").alias("_text"))
    kept = {r["k"] for r in sieve(rows, "k", ids).collect()}
    assert {i * 7919 - 5_000_000 for i in range(3000)} <= kept and len(kept) < 3600


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace as Some

    from skyquilt.llm.common import shared_dir

    conf = Some(get=lambda key: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Some(sparkContext=Some(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)))
