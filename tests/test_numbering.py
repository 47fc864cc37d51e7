import random

import numpy as np
import pytest
from conftest import rows

from sessionrank.functions import numbering as N
from sessionrank.functions.skew import hot_keys, salted_join


@pytest.mark.parametrize("spread", [10, 2**17, 2**35, 2**62])
def test_exclusive_prefix(table, spread):
    rng = random.Random(spread)
    values = {rng.randrange(spread): rng.randrange(5) for _ in range(60)}
    df = table(list(values.items()), "k bigint, v bigint")
    total, expected = 0, []
    for key in sorted(values):
        expected.append((key, total))
        total += values[key]
    got = rows(N.exclusive_prefix(df, "k", "v", min(values), max(values)))
    assert got == sorted(expected, key=str)


def test_dense_index(table):
    df = table([(9,), (4,), (9,), (70_000_000_000,)], "k bigint")
    assert sorted(rows(N.dense_index(df, "k", "i"))) == [(4, 0), (9, 1), (70_000_000_000, 2)]


@pytest.mark.parametrize("spread", [6, 10**9])
def test_quantiles_equal_numpy(table, spread):
    rng = random.Random(spread)
    values = [rng.randrange(spread) for _ in range(201)]
    df = table([(v,) for v in values], "x bigint")
    probabilities = [0.0, 0.25, 0.4, 0.5, 0.8, 1.0]
    expected = np.quantile(values, probabilities)
    got = [N.exact_quantiles(df, ["x"], probabilities), N.count_quantiles(df, "x", probabilities)]
    for quantiles in got:
        assert np.allclose(quantiles.first()["q"], expected)


def test_quantiles_of_several_columns_and_of_nothing(table):
    data = [(i, -i * i if i % 3 else None, None) for i in range(40)]
    df = table(data, "a bigint, b bigint, c bigint")
    got = {r["column_name"]: r["q"] for r in N.exact_quantiles(df, ["a", "b", "c"], [0.1, 0.5]).collect()}
    for k, name in enumerate("ab"):
        assert np.allclose(got[name], np.quantile([r[k] for r in data if r[k] is not None], [0.1, 0.5]))
    assert got["c"] is None


def test_count_ranks(table):
    df = table([(5,), (3,), (3,), (1,)], "n bigint")
    assert rows(N.count_ranks(df, "n", "r")) == [(1, 4), (3, 2), (5, 1)]


def test_salted_join_equals_join(table):
    rng = random.Random(4)
    left = table([(rng.choice([1, 1, 1, 2, 3, None]), i) for i in range(200)], "k bigint, x bigint")
    right = table([(1, "a"), (1, "b"), (2, "c"), (9, "d")], "k bigint, y string")
    hot = hot_keys(left, "k", 20)
    found = dict(map(tuple, hot.table.collect()))
    assert found[1] > 3 and 9 not in found
    assert hot_keys(left, "k", 20).table.inputFiles() == hot.table.inputFiles()
    for how in ("inner", "left"):
        assert rows(salted_join(left, right, ["k"], how, hot, "k", ["x"])) == rows(
            left.join(right, "k", how)
        )
    assert hot_keys(left, "k") is None
