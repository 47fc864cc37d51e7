import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sessionrank.functions.numbering import ordered_prefix
from sessionrank.operators import boosting as B
from sessionrank.sources import trees

NAMES = ["a", "b b", "c", "one"]


def made(n=900, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(1)
    x[:, 2], x[:, 3] = rng.integers(0, 3, n), 7
    y = (rng.random(n) < 1 / (1 + np.exp(-(1.5 * x[:, 0] + x[:, 1] * x[:, 2])))).astype(int)
    return x, y


@pytest.fixture(scope="module")
def data(spark):
    x, y = made()
    df = spark.createDataFrame([(i, *map(float, r), int(k)) for i, (r, k) in enumerate(zip(x, y))], ["id", *NAMES, "label"])
    return x, y, df.repartition(3)


def by_hand(x, y, s):
    """[(feature, threshold, gain, rows), ...] of each round and the log odds at the end, from sums over plain arrays."""
    edges = [np.unique(c) for c in x.T]
    edges = [(v[:-1] + v[1:]) / 2 for v in edges]
    part = lambda g, h: max(abs(g) - s.l1, 0) ** 2 / (h + s.l2)

    def best(at, g, h):
        found = None
        for f, cuts in enumerate(edges):
            for e in cuts:
                left, right = at[x[at, f] <= e], at[x[at, f] > e]
                if min(len(left), len(right)) < s.min_rows or min(h[left].sum(), h[right].sum()) < s.min_hessian:
                    continue
                gain = part(g[left].sum(), h[left].sum()) + part(g[right].sum(), h[right].sum()) - part(g[at].sum(), h[at].sum())
                if gain > 1e-7 and (found is None or gain > found[0] + 1e-7):
                    found = gain, f, e, left, right
        return found

    odds, rounds = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), []
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-odds))
        g, h = p - y, p * (1 - p)
        leaves, splits = [(np.arange(len(y)), best(np.arange(len(y)), g, h))], []
        while len(leaves) < s.leaves and any(b for _, b in leaves):
            at, b = leaves.pop(max(range(len(leaves)), key=lambda i: leaves[i][1][0] if leaves[i][1] else -1))
            splits.append((b[1], b[2], b[0], len(at)))
            leaves += [(part, best(part, g, h)) for part in b[3:]]
        for at, _ in leaves:
            odds[at] -= np.sign(g[at].sum()) * max(abs(g[at].sum()) - s.l1, 0) / (h[at].sum() + s.l2) * s.rate
        rounds.append(splits)
    return rounds, odds


@pytest.mark.parametrize("leaves", [2, 7, 63])
def test_trees_equal_plain_sums(spark, data, leaves):
    x, y, df = data
    s = B.Settings(rounds=2, leaves=leaves, row_share=1.0, feature_share=1.0)
    model = B.fit(df, None, NAMES, ["id"], s)
    rounds, odds = by_hand(x, y, s)
    for tree, splits in zip(model.trees, rounds, strict=True):
        got = zip(tree.feature, tree.threshold, tree.gain, tree.rows, strict=True)
        assert [g for t in got for g in t] == pytest.approx([g for t in splits for g in t], rel=1e-6)
    scored = sorted(rows(model.score(df).select("id", "score")))
    assert np.allclose([r[1] for r in scored], 1 / (1 + np.exp(-odds)), atol=1e-7)
    again = B.fit(df.repartition(5, "c"), None, NAMES, ["id"], s)
    assert rows(again.nodes(spark)) == rows(model.nodes(spark))


def test_trees_of_small_nodes_take_few_passes(spark, data, monkeypatch):
    """Subtrees found in one task are those that passes find, and spare the passes."""
    df, passes, histograms = data[2], [], B.histograms
    monkeypatch.setattr(B, "histograms", lambda *args: passes.append(1) or histograms(*args))
    s = B.Settings(rounds=2, leaves=20)
    few = rows(B.fit(df, None, NAMES, ["id"], s).nodes(spark))
    assert len(passes) == 2  # the roots
    for limit in (0, 300):
        monkeypatch.setattr(B, "TASK_ROWS", limit)
        assert rows(B.fit(df, None, NAMES, ["id"], s).nodes(spark)) == few
    assert len(passes) > 12


def test_a_tree_of_a_small_table_is_one_pass(spark, data, monkeypatch):
    """Whatever the number of leaves, a tree collects once: its root is not looked at before."""
    df, looks, below = data[2], [], []
    best_splits, subtrees = B.best_splits, B.subtrees
    monkeypatch.setattr(B, "best_splits", lambda *args: looks.append(1) or best_splits(*args))
    monkeypatch.setattr(B, "subtrees", lambda *args: below.append(1) or subtrees(*args))
    s = B.Settings(rounds=3, leaves=20)
    model = B.fit(df, None, NAMES, ["id"], s)
    assert (len(looks), len(below)) == (0, 3)
    monkeypatch.setattr(B, "TASK_ROWS", 800)  # fewer than the table has, more than the sample
    again = B.fit(df, None, NAMES, ["id"], s)
    assert (len(looks), len(below)) == (3, 6) and rows(again.nodes(spark)) == rows(model.nodes(spark))


def test_rounds_judged_beside_the_next_sample(spark, data):
    """Patience ends the fit where judging each sample before the next one would; trees grown meanwhile leave no trace."""
    df = data[2]
    s = B.Settings(rounds=40, patience=3, leaves=6)
    model = B.fit(df.filter("id % 3 > 0"), df.filter("id % 3 = 0"), NAMES, ["id"], s)
    areas, best = [h[1] for h in model.history], 0
    for i, area in enumerate(areas):
        best = i if area > areas[best] else best
    assert len(areas) == best + 1 + s.patience < 40 and len(model.trees) == best + 1
    assert [h[0] for h in model.history] == list(range(1, len(areas) + 1)) and all(h[2] and h[3] for h in model.history)


def test_rows_of_the_last_round_are_not_written(spark, data, monkeypatch):
    """Their losses are those of a fit that goes on."""
    written, plain = [], B.materialize
    monkeypatch.setattr(B, "materialize", lambda df, name: written.append(name) or plain(df, name))
    longer = B.fit(data[2], None, NAMES, ["id"], B.Settings(rounds=7, leaves=4))
    assert written.count("binned") == 2
    written.clear()
    model = B.fit(data[2], None, NAMES, ["id"], B.Settings(rounds=5, leaves=4))
    assert written.count("binned") == 1 and np.allclose([h[3] for h in model.history], [h[3] for h in longer.history[:5]], rtol=1e-12)


def test_samples_of_rows_and_features(spark, data):
    x, y, df = data
    model = B.fit(df, None, NAMES, ["id"], B.Settings(rounds=7, leaves=4))
    roots = [t.rows[0] for t in model.trees]
    assert len(set(roots[:5])) == 1 and len(set(roots)) == 2  # one sample for five rounds
    assert all(0.7 * len(y) < r < 0.9 * len(y) for r in roots)
    assert all(len(set(t.feature)) <= 2 for t in model.trees)  # 0.8 of three features that vary, rounded


def test_tables_that_teach_nothing(spark, data):
    _, y, df = data
    s = B.Settings(rounds=2)
    for table, score in (
        (df.withColumn("label", F.lit(1)), 1.0), (df.limit(0), 0.5), (df.drop("a", "b b", "c"), y.mean()), (df.filter("id < 20"), None),
    ):
        model = B.fit(table, table, [n for n in NAMES if n in table.columns], ["id"], s)
        found = {r["score"] for r in model.score(df).select("score").collect()}
        assert len(found) == 1 and (score is None or found.pop() == pytest.approx(score, abs=1e-6))
        assert rows(trees.parse(trees.text_of(model)).nodes(spark)) == rows(model.nodes(spark))
        assert model.total_gain(spark).agg(F.coalesce(F.sum("importance"), F.lit(0.0))).first()[0] == 0
    assert B.fit(df.limit(0), None, [], ["id"]).score(df).first()["score"] == 0.5


def test_missing_values_count_as_zero(spark, data):
    _, _, df = data
    holes = df.withColumn("a", F.when(F.col("a") != 0, F.col("a")))
    nan = df.withColumn("a", F.when(F.col("a") != 0, F.col("a")).otherwise(float("nan")))
    s = B.Settings(rounds=2, leaves=5)
    whole, model = B.fit(df, None, NAMES, ["id"], s), B.fit(holes, None, NAMES, ["id"], s)
    assert rows(model.nodes(spark)) == rows(whole.nodes(spark)) == rows(B.fit(nan, None, NAMES, ["id"], s).nodes(spark))
    expected = sorted(rows(whole.score(df).select("id", "score")))
    assert sorted(rows(model.score(holes).select("id", "score"))) == expected == sorted(rows(model.score(nan).select("id", "score")))


def test_bins_of_equal_numbers_of_rows(spark):
    values = [i**2 / 7 for i in range(1000)] + [5.0] * 1000
    df = spark.createDataFrame([(v,) for v in values], "v double")
    edges = B.bin_edges(df, ["v"], 10)[0]
    sizes = np.bincount(np.searchsorted(edges, values, "left"))
    assert 5 <= len(sizes) <= 10 and sorted(sizes)[-2] <= 220 and sizes.sum() == 2000
    few = B.bin_edges(df.selectExpr("cast(v as int) % 3 as v"), ["v"], 10)[0]
    assert few.tolist() == [0.5, 1.5]


def test_area_under_curve(spark):
    rng = random.Random(2)
    data = [(rng.choice("xyz"), rng.choice((-0.5, 0.0, 0.25, 1e300, rng.random())), rng.randrange(2)) for _ in range(400)]
    data += [("one", 0.5, 1), ("one", 0.5, 1), ("none", None, 1), ("none", 1.0, None)]
    found = dict(rows(B.area_under_curve(spark.createDataFrame(data, "g string, score double, label int"), ["g"])))
    for g in "xyz":
        pos, neg = ([s for k, s, y in data if k == g and y == label] for label in (1, 0))
        assert found[g] == pytest.approx(np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg]))
    assert found["one"] is None and "none" not in found


def test_prefix_sums_in_any_order(spark):
    rng = random.Random(3)
    data = [(rng.choice((None, "a", "b", "ü")), rng.uniform(-5, 5), rng.randrange(9), None if i % 7 == 0 else i) for i in range(500)]
    got = ordered_prefix(spark.createDataFrame(data, "g string, v double, n bigint, m bigint").repartition(4), ["g", "v"], n0="n", m0="m")
    n = m = 0
    for g, v, k, i in sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        row = got.filter(F.col("g").eqNullSafe(g) & (F.col("v") == v)).first() if i and i % 50 == 1 else None
        assert row is None or (row["n0"], row["m0"]) == (n, m)
        n, m = n + k, m + (i or 0)
    assert got.count() == 500


TEXT = """tree
version=v4
num_class=1
num_tree_per_iteration=1
label_index=0
max_feature_idx=1
objective=binary sigmoid:1
feature_names=u v
feature_infos=none none

Tree=0
num_leaves=3
num_cat=0
split_feature=1 0
split_gain=3 1.5
threshold=0.5 2
decision_type={kinds}
left_child=-1 -2
right_child=1 -3
leaf_value=1 2 -4
shrinkage=1

end of trees
"""


def test_text_from_elsewhere(spark, tmp_path):
    data = [(0, 0.0, 0.0), (1, 2.0, 1.0), (2, 2.5, 1.0), (3, None, 1.0), (4, 0.0, float("nan")), (5, 0.0, 1.0)]
    df = spark.createDataFrame(data, "id int, u double, v double")
    for kinds, leaves in (
        ("2 2", [0, 1, 2, 1, 0, 1]),     # nothing is missing: NaN is 0
        ("2 8", [0, 1, 2, 2, 0, 1]),     # NaN goes right
        ("10 4", [0, 1, 2, 2, 0, 2]),    # NaN goes left in the first split; zeros and NaN go right in the second
    ):
        (tmp_path / "model").write_text(TEXT.format(kinds=kinds))
        model = trees.read_trees(spark, str(tmp_path / "model"))
        scores = [r["score"] for r in model.score(df).orderBy("id").collect()]
        assert scores == pytest.approx([1 / (1 + np.exp(-(1, 2, -4)[k])) for k in leaves]), kinds
    assert model.features == ["u", "v"]
    for broken in (TEXT.format(kinds="1 2"), TEXT.format(kinds="2"), TEXT.format(kinds="2 2").replace("binary", "regression"), "text"):
        with pytest.raises(ValueError):
            trees.parse(broken)


def test_text_keeps_the_model(spark, data, tmp_path):
    _, _, df = data
    model = B.fit(df, None, NAMES, ["id"], B.Settings(rounds=3, leaves=9))
    trees.write_trees(spark, model, str(tmp_path / "m"))
    again = trees.read_trees(spark, str(tmp_path / "m"))
    assert again.features == NAMES and trees.text_of(again) == trees.text_of(model)
    assert rows(again.score(df).select("id", "score")) == rows(model.score(df).select("id", "score"))
    text = trees.text_of(model)
    starts = [text.index(f"Tree={i}\n") for i in range(3)] + [text.index("end of trees")]
    assert f"tree_sizes={' '.join(str(b - a) for a, b in zip(starts, starts[1:]))}\n" in text


def bound(n=6000, seed=4):
    """Rows whose columns a, b and c follow from one number, and d and e from another, as those of the same item or user do."""
    rng = np.random.default_rng(seed)
    item, user = rng.integers(0, 40, n), rng.integers(0, 30, n)
    x = np.stack([item % 7, item / 3, item % 2, user % 5, np.sqrt(user), rng.normal(size=n).round(1)], 1)
    return x, (rng.random(n) < 1 / (1 + np.exp(2 - x[:, 0] / 3 - x[:, 3] * x[:, 5] / 4))).astype(int)


def test_bins_that_go_together_share_a_code(spark, monkeypatch):
    """Trees by codes are those of plain sums, whatever goes together, and no code stands for more combinations than allowed."""
    x, y = bound()
    names = list("abcdef")
    df = spark.createDataFrame([(i, *map(float, r), int(k)) for i, (r, k) in enumerate(zip(x, y))], ["id", *names, "label"]).repartition(3)
    s = B.Settings(rounds=2, leaves=9, row_share=1.0, feature_share=1.0)
    edges = B.bin_edges(df, names, s.bins)
    monkeypatch.setattr(B, "MOST_CODES", 100)
    coding = B.coding_of(df, df.withColumn("a", F.col("a") + 1), names, edges, list(range(6)), ["id"], len(x))
    assert sorted(sorted(g) for g, _ in coding.groups) == [[0, 1, 2], [3, 4], [5]] and max(coding.sizes) <= 100
    codes = coding.codes_of(x.T)
    for f in range(6):
        group, bins = coding.bins[f]
        assert (bins[codes[group]] == np.searchsorted(edges[f], x[:, f], "left")).all()
    whole = rows(B.fit(df, df, names, ["id"], s).nodes(spark))
    splits, _ = by_hand(x, y, s)
    assert [r[6] for r in sorted(whole) if r[1] >= 0] == pytest.approx([p[2] for r in splits for p in r], rel=1e-6)
    for codes_allowed, task_rows, block in ((1, 1 << 22, 1 << 16), (64, 0, 700), (20, 1500, 100)):
        for name, value in (("MOST_CODES", codes_allowed), ("TASK_ROWS", task_rows), ("BLOCK_ROWS", block)):
            monkeypatch.setattr(B, name, value)
        assert rows(B.fit(df, df, names, ["id"], s).nodes(spark)) == whole


def test_a_pass_reads_blocks_and_only_the_smaller_child_is_summed(spark, data, monkeypatch):
    """What a pass gets from the table are a few blocks of rows; of two children one is summed, the other is what it leaves."""
    wanted, kept, histograms = [], [], B.histograms

    def seen(sample, coding, used, growing, nodes, *more):
        kept.append(sample.table.count())
        wanted.append(len(nodes))
        return histograms(sample, coding, used, growing, nodes, *more)

    monkeypatch.setattr(B, "histograms", seen)
    monkeypatch.setattr(B, "TASK_ROWS", 0)
    assert len(B.fit(data[2], None, NAMES, ["id"], B.Settings(rounds=1, row_share=0.0)).trees[0].feature) == 0  # no row, no split
    kept.clear(), wanted.clear()
    tree = B.fit(data[2], None, NAMES, ["id"], B.Settings(rounds=1, leaves=12)).trees[0]
    assert max(kept) <= 3 and sum(wanted) < 2 * len(tree.rows)
