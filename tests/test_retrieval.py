import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows

from sessionrank.operators import cooccurrence as C
from sessionrank.operators import factors as A
from sessionrank.operators import popularity as P

SESSIONS = "user_id bigint, session_id bigint, item_id bigint, timestamp bigint, position int"


def _sessions(table, lists):
    return table(
        [(1, s, item, p, p) for s, items in lists.items() for p, item in enumerate(items)], SESSIONS
    )


def _brute_edges(lists, window):
    counts = Counter()
    for items in lists.values():
        for i, a in enumerate(items):
            for j, b in enumerate(items):
                if abs(i - j) <= window and a != b:
                    counts[a, b] += 1
    return counts


def _brute_recs(edges, lists, top_k, window):
    near = defaultdict(dict)
    for (a, b), n in edges.items():
        near[a][b] = n
    out = []
    for s, items in lists.items():
        scores, last = Counter(), Counter()
        for a in items[-window:]:
            for b, n in near[a].items():
                if b not in items:
                    scores[b] += n
        ranked = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:top_k]
        out += [(s, b, n, r, float(near[items[-1]].get(b, 0)))
                for r, (b, n) in enumerate(ranked, 1)]
    return sorted(out, key=str)


def _random_lists(seed, n_sessions, n_items, longest):
    rng = random.Random(seed)
    # Squared draws make small item numbers much more frequent.
    return {
        s: [int(n_items * rng.random() ** 3) for _ in range(rng.randint(1, longest))]
        for s in range(n_sessions)
    }


def test_popularity(table):
    train = _sessions(table, {0: [1, 2, 3], 1: [1, 2], 2: [1, 5, 4]})
    counts = P.fit_popularity(train)
    assert rows(P.popular_items(counts, 3)) == [(1, 3, 1), (2, 2, 2), (3, 1, 3)]
    context = _sessions(table, {7: [1, 9], 8: [2]})
    got = rows(P.retrieve_popular(counts, context, 2))
    assert got == [(7, 1, 3, 1), (7, 2, 2, 2), (8, 1, 3, 1), (8, 2, 2, 2)]


@pytest.mark.parametrize("block", [5, 7, 4096])
@pytest.mark.parametrize("window", [1, 5])
def test_edges_equal_brute_force(table, block, window):
    lists = _random_lists(block, 20, 8, 30)
    got = C.fit_cooccurrence(_sessions(table, lists), window, block)
    assert {(a, b): n for a, b, n in rows(got)} == dict(_brute_edges(lists, window))


def test_summary(table):
    train = _sessions(table, {0: [1, 2], 1: [3]})
    assert rows(C.cooccurrence_summary(train, C.fit_cooccurrence(train))) == [(3, 2)]


def test_repeated_recent_items_count_twice(table):
    edges = table([(10, 30, 2), (20, 30, 1)], "item_a bigint, item_b bigint, cnt bigint")
    context = _sessions(table, {0: [10, 10, 20]})
    assert rows(C.cooccurrence_scores(edges, context)) == [(0, 30, 5)]


def test_old_context_items_are_excluded_but_do_not_score(table):
    edges = table([(1, 50, 9), (7, 1, 3), (7, 60, 1)], "item_a bigint, item_b bigint, cnt bigint")
    context = _sessions(table, {0: [1, 2, 3, 4, 5, 6, 7]})
    assert rows(C.retrieve_cooccurrence(edges, context, 5)) == [(0, 60, 1, 1, 1.0)]


def test_ties_at_the_cut_go_to_the_smaller_item(table):
    edges = table([(1, b, 1) for b in (9, 4, 7)], "item_a bigint, item_b bigint, cnt bigint")
    context = _sessions(table, {0: [1], 1: [99]})
    assert [r[:2] for r in rows(C.retrieve_cooccurrence(edges, context, 2))] == [(0, 4), (0, 7)]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("head", [1, 3, 10, None])
def test_recommendations_equal_brute_force(spark, table, seed, head):
    train = _random_lists(seed, 150, 60, 12)
    edges = C.fit_cooccurrence(_sessions(table, train))
    lists = _random_lists(100 + seed, 40, 70, 9)
    expected = _brute_recs(_brute_edges(train, 5), lists, 4, 5)
    got = C.retrieve_cooccurrence(edges, _sessions(table, lists), 4, head=head, hot_rows=30)
    assert rows(got) == expected


def test_first_blocks_settle_some_sessions_and_not_others(spark, table):
    # Item 1 has one neighbour far ahead; item 2 has many equal ones.
    pairs = [(1, 100, 50), (1, 101, 40)] + [(1, b, 1) for b in range(200, 210)]
    pairs += [(2, b, 3) for b in range(300, 320)]
    edges = table(pairs, "item_a bigint, item_b bigint, cnt bigint")
    context = _sessions(table, {0: [1], 1: [2], 2: [1, 2]})
    trace = []
    got = [r[:4] for r in rows(C.retrieve_cooccurrence(edges, context, 2, head=3, trace=trace))]
    assert got == [(0, 100, 50, 1), (0, 101, 40, 2), (1, 300, 3, 1), (1, 301, 3, 2),
                   (2, 100, 50, 1), (2, 101, 40, 2)]
    # Equal counts leave the session of item 2 open to the end of its list; the others need the first block only.
    assert trace == [(0, 3, 12), (1, 1, 3), (2, 1, 6), (3, 1, 8)]


@pytest.mark.parametrize("hot_rows", [10**6, 40, 7])
def test_blocks_double_in_length(table, hot_rows):
    rng = random.Random(4)
    pairs = {(a, b): rng.choice((1, 1, 1, 2, 3, rng.randrange(1, 90))) for a, n in ((1, 300), (2, 3), (3, 33), (4, 64)) for b in rng.sample(range(10, 500), n)}
    edges = table([(*k, n) for k, n in pairs.items()], "item_a bigint, item_b bigint, cnt bigint")
    got = rows(C.impact_blocks(edges, 4, hot_rows))
    assert {r[:2]: r[2] for r in got} == pairs
    for item in (1, 2, 3, 4):
        counts = sorted((n for (a, _), n in pairs.items() if a == item), reverse=True)
        start, size, block = 0, 4, 0
        while start < len(counts):
            mine = [r for r in got if r[0] == item and r[4] == block]
            assert sorted((r[2] for r in mine), reverse=True) == counts[start:start + size]
            start += size
            size = start
            block += 1
            assert [r[3] for r in mine if r[3] is not None] == counts[start:start + 1]
        assert not [r for r in got if r[0] == item and r[4] >= block]


def test_few_edges_are_read(table):
    """Sessions settle on the strong edges of skewed counts: less than half of all their items' edges are read."""
    train = _random_lists(11, 3000, 400, 12)
    edges = C.fit_cooccurrence(_sessions(table, train))
    lists = _random_lists(12, 100, 400, 9)
    trace = []
    got = C.retrieve_cooccurrence(edges, _sessions(table, lists), 5, head=8, trace=trace)
    near = Counter(a for a, _ in _brute_edges(train, 5))
    assert sum(t[2] for t in trace) < sum(near[a] for items in lists.values() for a in set(items[-5:])) / 2
    assert rows(got) == _brute_recs(_brute_edges(train, 5), lists, 5, 5)


@pytest.mark.parametrize("insertion", [False, True])
def test_short_blocks_are_not_followed_one_by_one(table, insertion):
    """With `least` the second step reads the first blocks together; the lists are the same."""
    train = _random_lists(11, 400, 90, 12)
    edges = C.fit_cooccurrence(_sessions(table, train), insertion=insertion)
    context = _sessions(table, _random_lists(12, 40, 90, 9))
    longest = max(Counter(a for a, _ in _brute_edges(train, 5)).values())
    found = {}
    for least in (0, 16, 40, 512):
        trace = []
        found[least] = rows(C.retrieve_cooccurrence(edges, context, 5, head=2, trace=trace, insertion=insertion, least=least))
        steps = [t[0] for t in trace]
        assert steps == {0: [*range(len(steps))], 16: [0, *range(3, 2 + len(steps))], 40: [0, *range(5, 4 + len(steps))], 512: [0, 8]}[least]
        assert 32 < longest <= 512 and (least or len(steps) > 2)
    assert found[0] == found[16] == found[40] == found[512]


def test_first_meetings_are_found_without_a_sort(table, capsys):
    """Neither the places of pairs in a scan nor those of candidates are sorted to find the smallest."""
    sessions = _sessions(table, _random_lists(21, 60, 25, 14))
    edges = C.fit_cooccurrence(sessions, 3, insertion=True)
    edges.explain()
    found = edges.selectExpr("1L session_id", "item_b", "1L uses", "0L slot", "cnt", "first")
    C._accumulated(found, None, sessions, 3).explain()
    assert "SortAggregate" not in capsys.readouterr().out


def test_places_too_large_for_a_number(table):
    lists = _random_lists(21, 60, 25, 14)
    far = {s * (1 << 56): items for s, items in lists.items()}
    context = _sessions(table, _random_lists(22, 20, 30, 9))
    got = [rows(C.retrieve_cooccurrence(C.fit_cooccurrence(_sessions(table, x), 3, insertion=True), context, 6, 3, insertion=True)) for x in (lists, far)]
    assert got[0] == got[1]


def test_wide_windows(table):
    train = _random_lists(8, 40, 30, 150)
    edges = C.fit_cooccurrence(_sessions(table, train), 5)
    lists = {0: [i % 29 for i in range(140)], 1: [3, 4], 2: list(range(29, 0, -1)) * 3}
    expected = _brute_recs(_brute_edges(train, 5), lists, 3, 130)
    got = C.retrieve_cooccurrence(edges, _sessions(table, lists), 3, window=130, head=2)
    assert rows(got) == expected


def _factors(table, n, rank=8, seed=0):
    rng = np.random.default_rng(seed)
    matrix = rng.integers(-3, 4, (n, rank)) / 4
    rows_ = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return matrix, table(rows_, "id bigint, features array<float>")


@pytest.mark.parametrize("block_numbers, first_band", [(None, 100), (40, 100), (None, 2), (40, 5)])
def test_factor_recs_equal_brute_force(table, block_numbers, first_band):
    matrix, factors = _factors(table, 30)
    lists = {s: items for s, items in _random_lists(3, 25, 40, 6).items()}
    expected = []
    for s, items in lists.items():
        known = [i for i in items if i < 30]
        if not known:
            continue
        scores = np.round(matrix @ matrix[known].mean(axis=0), 6)
        ranked = sorted((i for i in range(30) if i not in items), key=lambda i: (-scores[i], i))
        expected += [(s, i, float(scores[i]), r) for r, i in enumerate(ranked[:5], 1)]
    got = rows(A.retrieve_by_factors(factors, _sessions(table, lists), 5, hot_rows=20, block_numbers=block_numbers, first_band=first_band))
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in sorted(expected, key=str)]


def test_few_products_of_a_block_are_rounded_and_sorted(monkeypatch):
    """Only those that can be among the best, ties by rounding included; the lists are those of all products."""
    rng = np.random.default_rng(4)
    items, vectors = rng.normal(size=(3000, 4)), rng.normal(size=(30, 4))
    items[1000:2000] = items[:1000] + rng.choice((0, 2e-7), (1000, 1))  # equal once rounded, or nearly so
    ids, wanted = rng.permutation(3000), rng.integers(1, 30, 30)
    wanted[0], sizes, plain = 4000, [], np.round
    monkeypatch.setattr(A.np, "round", lambda x, digits: sizes.append(x.size) or plain(x, digits))
    lists = lambda m: pa.array(m.tolist(), pa.list_(pa.float64()))
    got = A._best_of_blocks(
        pa.table({"session_id": np.arange(30), "vector": lists(vectors), "wanted": wanted}), pa.table({"id": ids, "features": lists(items)})
    ).to_pydict()
    expected = []
    for i, (vector, k) in enumerate(zip(vectors, wanted)):
        scores = plain(items @ vector, 6) + 0.0
        expected += [(i, ids[j], scores[j]) for j in np.lexsort((ids, -scores))[:k]]
    assert list(zip(got["session_id"], got["item_id"])) == [r[:2] for r in expected]
    assert np.allclose(got["score"], [r[2] for r in expected], rtol=0, atol=1.1e-6)
    assert sum(sizes) < 3000 + 29 * 3000 / 10


def test_small_blocks_are_pieces_of_a_task(table, monkeypatch):
    """Blocks of few numbers repeat the rows of the other side twice at most."""
    _, factors = _factors(table, 60)
    context = _sessions(table, {s: [s % 60, (7 * s) % 60] for s in range(50)})
    times, dealt = [], A._dealt
    monkeypatch.setattr(A, "_dealt", lambda df, key, own, n_own, other, n_other: times.append(n_other) or dealt(df, key, own, n_own, other, n_other))
    cut = rows(A.retrieve_by_factors(factors, context, 4, block_numbers=16))
    assert times == [2, 2] and len(cut) == 200
    assert cut == rows(A.retrieve_by_factors(factors, context, 4))


def test_bands_of_falling_length_end_the_search(table):
    """Sessions near long vectors stop early; what they get is what all products give."""
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(300, 6)) * (1.0 / (1 + np.arange(300)))[:, None] ** 0.7
    factors = table([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], "id bigint, features array<double>")
    bands = [(r["band"], r["id"], r["norm"]) for r in A.norm_bands(factors, 8).collect()]
    assert Counter(b for b, _, _ in bands) == {0: 8, 1: 8, 2: 16, 3: 32, 4: 64, 5: 128, 6: 44}
    norms = [[n for b, _, n in bands if b == k] for k in range(7)]
    assert all(min(a) >= max(b) for a, b in zip(norms, norms[1:]))
    context = _sessions(table, {s: [s % 20, (7 * s) % 300] for s in range(40)} | {99: [5000]})
    trace = []
    got = rows(A.retrieve_by_factors(factors, context, 3, first_band=8, trace=trace))
    assert got == rows(A.retrieve_by_factors(factors, context, 3)) and len(got) == 120
    assert sum(n * m for _, n, m in trace) < 40 * 300 / 2


@pytest.mark.parametrize("item_numbers, together", [(1 << 23, 7), (6 * 40, 3), (1, 1)])
def test_bands_that_fit_a_block_are_one_step(table, monkeypatch, item_numbers, together):
    """The vectors of sessions are dealt out once for them, and lists and order of ties are those of all products."""
    monkeypatch.setattr(A, "_ITEM_NUMBERS", item_numbers)
    rng = np.random.default_rng(3)
    matrix = rng.integers(-2, 3, (300, 6)) * (1.0 / (1 + rng.permutation(300) // 30))[:, None]
    factors = table([(i, [float(x) for x in v]) for i, v in enumerate(matrix)], "id bigint, features array<double>")
    lists = {s: [s % 300, (7 * s) % 300] for s in range(0, 300, 5)}
    context = _sessions(table, lists | {999: [5000]})
    dealt, times, trace = A._dealt, [], []
    monkeypatch.setattr(A, "_dealt", lambda df, key, *more: times.append(key) or dealt(df, key, *more))
    got = rows(A.retrieve_by_factors(factors, context, 3, first_band=8, trace=trace))
    assert [t[0] for t in trace] == list(range(len(trace))) and trace[0][1] == 60
    assert times.count("session_id") == len(trace) + 1 - together and (together < 7 or len(trace) == 7)
    assert sum(n * m for _, n, m in trace) < 60 * 300
    expected = []
    for s, items in lists.items():
        scores = np.round(matrix @ matrix[items].mean(0), 6)
        expected += [(s, i, r) for r, i in enumerate(sorted((i for i in range(300) if i not in items), key=lambda i: (-scores[i], i))[:3], 1)]
    assert [(r[0], r[1], r[3]) for r in got] == sorted(expected, key=str)


def test_vectors_that_come_twice_fill_no_list(table, monkeypatch):
    """Rows of one id count once for the end of a session's search: its list is as long with one step as with many."""
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(60, 4)) * (1.0 / (1 + np.arange(60)))[:, None]
    factors = table([(i % 50, [float(x) for x in matrix[i % 50]]) for i in range(100)], "id bigint, features array<double>")
    context = _sessions(table, {s: [s % 7, (s + 1) % 7, (3 * s) % 50] for s in range(30)})
    got = rows(A.retrieve_by_factors(factors, context, 3, first_band=4))
    assert len(got) == 90
    monkeypatch.setattr(A, "_ITEM_NUMBERS", 1)
    assert got == rows(A.retrieve_by_factors(factors, context, 3, first_band=4))


def test_factorization_separates_two_groups(table):
    rng = random.Random(1)
    data = []
    for user in range(30):
        items = [(user % 2) * 10**12 + rng.randrange(6) for _ in range(8)]
        data += [(user + 2**40, user, item, p, p) for p, item in enumerate(items)]
    train = table(data, SESSIONS)
    factors = A.fit_factors(train, factors=4, iterations=5)
    assert factors.count() == 12
    context = _sessions(table, {0: [0, 1], 1: [10**12, 10**12 + 1], 2: [555]})
    got = rows(A.retrieve_by_factors(factors, context, 3))
    assert {r[0] for r in got} == {0, 1}
    assert all((r[1] >= 10**12) == (r[0] == 1) for r in got)
    assert not {(0, 0), (0, 1)} & {r[:2] for r in got}


def test_unfitted_factors_are_an_error(table):
    with pytest.raises(RuntimeError):
        A.retrieve_by_factors(None, _sessions(table, {0: [1]}), 3)


def _scan(lists, window):
    """Counts in the order in which a scan of the sessions, position by position, first meets each neighbour."""
    near = defaultdict(dict)
    for s in sorted(lists):
        items = lists[s]
        for i, a in enumerate(items):
            for b in items[max(0, i - window):i + window + 1]:
                if a != b:
                    near[a][b] = near[a].get(b, 0) + 1
    return near


@pytest.mark.parametrize("head, block", [(1, 5), (3, 4096), (None, 4096)])
def test_equal_scores_in_order_of_insertion(table, head, block):
    train = _random_lists(21, 60, 25, 14)
    near = _scan(train, 3)
    lists = _random_lists(22, 40, 30, 9)
    expected = []
    for s, items in lists.items():
        scores = {}
        for a in reversed(items[-3:]):
            for b, n in near[a].items():
                if b not in items:
                    scores[b] = scores.get(b, 0) + n
        ranked = sorted(scores, key=lambda b: -scores[b])[:6]  # a stable sort
        expected += [(s, b, scores[b], r) for r, b in enumerate(ranked, 1)]
    edges = C.fit_cooccurrence(_sessions(table, train), 3, block, insertion=True)
    got = C.retrieve_cooccurrence(edges, _sessions(table, lists), 6, 3, head=head, insertion=True)
    assert [r[:4] for r in rows(got)] == sorted(expected, key=str)


def test_pieces_sort_only_what_can_be_among_the_best(monkeypatch):
    """Lists of pieces are those of all products, whatever the pieces; later pieces bring few products to be sorted."""
    rng = np.random.default_rng(8)
    vectors, features = rng.normal(size=(60, 8)).round(1), rng.normal(size=(5000, 8)).round(1)
    ids, wanted = rng.permutation(5000), rng.integers(3, 9, 60)
    lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 8).cast(pa.list_(pa.float64()))
    sessions = pa.table({"session_id": np.arange(60) * 3, "vector": lists(vectors), "wanted": wanted})
    items, sorted_rows, merged = pa.table({"id": ids, "features": lists(features)}), [], A._merged
    monkeypatch.setattr(A, "_merged", lambda old, new, k: sorted_rows.append(len(new[0])) or merged(old, new, k))
    scores = np.round(vectors @ features.T, 6) + 0.0
    expected = {(s * 3, int(ids[i]), scores[s, i]) for s in range(60) for i in np.lexsort((ids, -scores[s]))[:wanted[s]]}
    for piece in (None, 800, 80):
        sorted_rows.clear()
        got = A._best_of_blocks(sessions, items, piece).to_pylist()
        assert {(r["session_id"], r["item_id"], r["score"]) for r in got} == expected and len(got) == len(expected)
        assert sum(sorted_rows) < 60 * 5000 / 8, piece
