import math
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from sessionrank.llm import lm

from .texts import awkward, documents

ORDER = 4


def counted(texts):
    """Counts of all runs of up to ORDER bytes, of contexts, and continuations of contexts."""
    grams = Counter()
    for t in texts:
        s = lm.sequence(lm.tokens_of((t or "").encode()), ORDER)
        for i in range(ORDER - 1, len(s)):
            for k in range(1, ORDER + 1):
                grams[s[i + 1 - k:i + 1]] += 1
    c, f = Counter(), Counter()
    for g, n in grams.items():
        c[g[:-1]] += n
        f[g[:-1]] += 1
    return grams, c, f


def brute(texts, limit):
    grams, c, f = counted(texts)

    def smooth(g):
        if len(g) == 1:
            return (grams[g] + 1) / (c[b""] + 256)
        return (grams[g] + f[g[:-1]] * smooth(g[1:])) / (c[g[:-1]] + f[g[:-1]])

    def kept(g):
        return len(g) == 1 or grams[g] >= limit

    def prob(h, w):
        if kept(h + w):
            return smooth(h + w)
        arcs = [g[-1:] for g in grams if len(g) == len(h) + 1 and g[:-1] == h and kept(g)]
        if not arcs:
            return prob(h[1:], w)
        left = 1 - sum(smooth(h + x) for x in arcs)
        rest = 1 - sum(smooth(h[1:] + x) for x in arcs)
        return left / rest * prob(h[1:], w)

    def score(t):
        s = lm.sequence(lm.tokens_of((t or "").encode()), ORDER)
        return sum(math.log10(prob(s[i - ORDER + 1:i], s[i:i + 1])) for i in range(ORDER - 1, len(s)))

    return score


def automaton(spark, docs, texts, order=ORDER):
    """The automaton of the runs of some texts."""
    arcs = lm.fit(docs, order=order)
    rows = documents(spark, texts).selectExpr("0L block", "cast(text as binary) body").fillna("")
    found = arcs.paths(lm._asked(rows, order)).toArrow()
    return lm.Automaton(order, arcs.low, *lm._columns(found))


@pytest.mark.parametrize("lane", [256, 3])
def test_scores_equal_the_plain_backoff(spark, monkeypatch, lane):
    monkeypatch.setattr(lm, "_LANE", lane)
    train = [t for t in awkward(3, 25)[:30]] + [None, ""]
    plain = brute(train, 1)
    tests = [b" ".join(lm.tokens_of(t.encode())) for t in ["ab Abc d", "unseen: \u00ff words", "", train[0] or "", "x9 " * 200]]
    model = automaton(spark, documents(spark, train), [t.decode() for t in tests])
    assert np.allclose(model.scores(tests), [plain(t.decode()) for t in tests], rtol=1e-9)
    assert model.failures > 0


def test_texts_read_in_training_follow_no_failure_arc(spark):
    train = ["ab abc d", "d ab"]
    model = automaton(spark, documents(spark, train), train)
    assert np.isfinite(model.scores([t.encode() for t in train])).all() and model.failures == 0


def test_an_automaton_is_small_beside_its_runs():
    """Free slots of its table take four bytes each, and building it takes little more than keeping it."""
    gram = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 200_000, dtype=np.uint64))
    n, ones = len(gram), np.ones(len(gram))
    tracemalloc.start()
    model = lm.Automaton(6, np.full(256, 1 / 256), gram, (6 * ones).astype(np.uint8), -ones, np.zeros(n, np.uint8), np.zeros(0))
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 90 * n and peak < 250 * n
    state = model.state(gram[:9] >> np.uint64(8), 5)
    assert model.step(state, (gram[:9] & np.uint64(255)).astype(np.int64))[1].tolist() == [-1.0] * 9 and model.failures == 0


def test_probabilities_sum_to_one(spark):
    """Of all bytes after contexts that occur whole, in part, or not at all."""
    docs = documents(spark, awkward(3, 40))
    arcs = lm.fit(docs, order=5)
    some = [r["gram"] >> 8 for r in arcs.counts.orderBy("gram").limit(5).collect()] + [0x01020304, 0x01026120]
    asked = [lm._grouped(i, np.array([h << 8 | b for b in range(256)], np.uint64)) for i, h in enumerate(some)]
    asked = spark.createDataFrame([row for rows in asked for row in zip(*rows)], "block bigint, near int, grams binary")
    for i in range(len(some)):
        grams, _, logp, size, weights = lm._columns(arcs.paths(asked).filter(f"block = {i}").toArrow())
        of = np.repeat(np.arange(256), size)
        assert len(grams) == 256 and abs((10 ** (logp + np.bincount(of, weights, 256))).sum() - 1) < 1e-9


@pytest.mark.parametrize("head_share", [1e-6, 0.05, 2.0])
def test_base_scores(spark, head_share):
    texts = awkward(5, 30)
    train = texts[::2]
    docs = documents(spark, texts)
    words = lm.word_counts(documents(spark, train))
    counts = Counter(w for t in train for w in [*lm.tokens_of((t or "").encode()), b""])
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in lm.score(docs, lm.fit(documents(spark, train), order=3), words, head_share=head_share).collect()}
    for i, t in enumerate(texts):
        tokens = [*lm.tokens_of((t or "").encode()), b""]
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert math.isclose(got[i]["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)
        assert got[i]["score"] < 0


def test_nothing_learned_and_nothing_to_score(spark):
    docs = documents(spark, ["a b", None])
    none = docs.limit(0)
    model, words = lm.fit(none), lm.word_counts(none)
    got = {r["doc_id"]: r for r in lm.score(docs, model, words).collect()}
    assert got[0]["n_known"] == 0 and math.isclose(got[0]["score"], 4 * math.log10(1 / 256)) and got[1]["n_tokens"] == 1
    assert lm.score(none, model, words).collect() == []


def test_rows_with_equal_ids_are_scored_one_by_one(spark):
    docs = documents(spark, ["ab d", "ab d", "d"], ids=[1, 1, 1])
    got = lm.score(docs, lm.fit(docs), lm.word_counts(docs), head_share=2.0).collect()
    assert sorted(r["n_tokens"] for r in got) == [2, 3, 3] and all(r["n_known"] == r["n_tokens"] for r in got)


@pytest.mark.parametrize("block_bytes, held", [(lm.BLOCK_BYTES, 500_000), (100, 500_000), (1, 40)])
def test_runs_seen_once_count_in_long_training_texts(spark, monkeypatch, block_bytes, held):
    """Whatever the blocks, and however little a task that smooths runs holds of them."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(lm, "_HELD_ENTRIES", held)
    train = ["ab " * 800_000, "qx Zy", *awkward(3, 20)[:20]]
    tests = ["qx zy", "unseen: \u00ff words", "", None, train[4], "x9 " * 200]
    docs = documents(spark, train)
    got = lm.score(documents(spark, tests), lm.fit(docs, order=ORDER), lm.word_counts(docs)).orderBy("doc_id").collect()
    plain = brute(train, 1)
    assert np.allclose([r["score"] for r in got], [plain(t) for t in tests], rtol=1e-9)


def test_blocks_are_read_as_a_stream(spark, monkeypatch):
    """The texts of a block and its paths are not gathered as tables, and rows of paths are short; scores are the same."""
    monkeypatch.setattr(lm, "_ROW_RUNS", 16)
    train = awkward(3, 25)[:30]
    docs, tests = documents(spark, train), [*train[:9], None, "", "x9 " * 200]
    plain, arcs = brute(train, 1), lm.fit(documents(spark, train), order=ORDER)
    scored = lm.score(documents(spark, tests), arcs, lm.word_counts(docs))
    assert "FlatMapCoGroups" not in scored._jdf.queryExecution().toString()
    assert np.allclose([r["score"] for r in scored.orderBy("doc_id").collect()], [plain(t) for t in tests], rtol=1e-9)
    rows = documents(spark, train).selectExpr("0L block", "cast(text as binary) body").fillna("")
    assert max(len(r["lengths"]) for r in arcs.paths(lm._asked(rows, ORDER)).collect()) == 16


def test_few_runs_are_smoothed_at_a_time(monkeypatch):
    """A batch of many runs is smoothed in parts, which give what one gives; counted runs are at hand for all of their group."""
    sizes, plain = [], lm._paths
    monkeypatch.setattr(lm, "_paths", lambda gram, n, asked, *more: sizes.append(len(asked)) or plain(gram, n, asked, *more))
    rng = np.random.default_rng(2)
    runs = np.unique(rng.integers(0, 1 << 32, 6000, dtype=np.uint64) >> np.uint64(13) << np.uint64(21) | rng.integers(0, 256, 6000, dtype=np.uint64))
    near = ((runs >> np.uint64(8)) & np.uint64(65535)).astype(int).tolist()
    rows = [(g, -1, int(r), 3, None) for g, r in zip(near[::2], runs[::2])] + [(n, b, 0, 0, g) for b, n, g in zip(*lm._grouped(5, runs))]
    columns = [*zip(*sorted(rows, key=lambda r: (r[0], r[1] >= 0)))]
    kinds = [lm.pa.int32(), lm.pa.int64(), lm.pa.int64(), lm.pa.int64(), lm.pa.binary()]
    batch = lm.pa.RecordBatch.from_arrays([lm.pa.array(c, k) for c, k in zip(columns, kinds)], names=["near", "block", "gram", "n", "grams"])
    found = []
    for held in (1 << 20, 2000):
        monkeypatch.setattr(lm, "_HELD_ENTRIES", held)
        sizes.clear()
        each, last = lm._smoothing(5, np.ones((256, 256)), np.full(256, 1 / 256))
        made = [r for r in (each(batch), last()) if r]
        unpacked = [[lm._unpack(x, np.uint64) for r in made for x in r[1]], [np.frombuffer(x, np.uint8) for r in made for x in r[2]],
                    [lm._unpack(x, np.float64) for r in made for x in r[3]]]
        found.append(sorted(zip(*map(np.concatenate, unpacked))))
    assert len(sizes) > 3 and max(sizes) < 1000 and len(found[0]) == len(runs) and found[0] == found[1]
