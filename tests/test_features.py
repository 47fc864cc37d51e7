"""Features of a random log against plain Python."""

import random
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows

from sessionrank.functions.skew import hot_keys
from sessionrank.operators import features as X

SESSIONS = "user_id bigint, session_id bigint, item_id bigint, timestamp bigint, position int"
MOVIES = "item_id bigint, title string, genres string, genre_list array<string>"
CANDIDATES = "session_id bigint, item_id bigint, rank int"
KINDS = ["Noir", "Kids-TV", "Old West"]


@pytest.fixture(scope="module")
def log():
    """(user, session, item, time, position): 23 sessions of 9 users, low items most frequent."""
    rng = random.Random(11)
    return [
        (s % 9, s, int(14 * rng.random() ** 2), 100 * s + p, p) for s in range(23) for p in range(rng.randrange(1, 8))
    ]


@pytest.fixture(scope="module")
def kinds():
    rng = random.Random(12)
    return {i: sorted(rng.sample(KINDS, rng.randrange(1, 4))) for i in range(0, 14) if i != 3}


@pytest.fixture(scope="module")
def train(table, log):
    return table(log, SESSIONS)


@pytest.fixture(scope="module")
def movies(table, kinds):
    return table([(i, f"title {i}", "|".join(g), g) for i, g in kinds.items()], MOVIES)


@pytest.fixture(scope="module")
def context(train):
    return train.filter("session_id < 12").select("session_id", "item_id", "position")


@pytest.fixture(scope="module")
def targets(table):
    return table([(s, s % 9 if s != 5 else 400, (3 * s) % 14) for s in range(11)],
                 "session_id bigint, user_id bigint, target_item_id bigint")


def _item_facts(log):
    count, users, sessions = defaultdict(int), defaultdict(set), defaultdict(set)
    for u, s, i, _, _ in log:
        count[i] += 1
        users[i].add(u)
        sessions[i].add(s)
    limit = np.quantile(list(count.values()), 0.8)
    return {
        i: (n, len(users[i]), len(sessions[i]), 1 + sum(m > n for m in count.values()), int(n >= limit))
        for i, n in count.items()
    }


def _user_facts(log):
    lengths = defaultdict(lambda: defaultdict(int))
    for u, s, _, _, _ in log:
        lengths[u][s] += 1
    totals = {u: sum(n.values()) for u, n in lengths.items()}
    limit = np.quantile(list(totals.values()), 0.8)
    return {u: (totals[u], len(n), totals[u] / len(n), int(totals[u] >= limit)) for u, n in lengths.items()}


def test_item_features(log, kinds, train, movies):
    got = X.item_features(train, movies)
    assert got.columns == ["item_id", *X.ITEM_COLUMNS, "genre_kids_tv", "genre_noir", "genre_old_west"]
    facts = _item_facts(log)
    found = {r["item_id"]: r for r in got.collect()}
    assert set(found) == set(facts)
    for i, (n, users, sessions, rank, head) in facts.items():
        r = found[i]
        assert (r["item_global_count"], r["item_unique_users"], r["item_unique_sessions"],
                r["item_global_rank"], r["item_is_head"]) == (n, users, sessions, rank, head)
        flags = [r["genre_noir"], r["genre_kids_tv"], r["genre_old_west"]]
        assert flags == ([int(k in kinds[i]) for k in KINDS] if i in kinds else [None] * 3)


def test_genre_columns(table):
    odd = table([(8, "x", "", ["Rock'n'Roll", "Late Night-Show"]), (9, "y", "", ["(no genres listed)"])], MOVIES)
    got = X.item_genres(odd)
    assert got.columns == ["item_id", "genre_late_night_show", "genre_rock'n'roll"]
    assert rows(got) == [(8, 1, 1), (9, 0, 0)]
    assert X.item_genres(odd, ["Unheard"]).columns == ["item_id", "genre_unheard"]


def test_genres_that_cannot_be_columns_are_an_error(table):
    same = table([(8, "x", "", ["Late Night", "late-night"])], MOVIES)
    with pytest.raises(ValueError, match="genre_late_night"):
        X.item_genres(same)
    with pytest.raises(ValueError, match="more than 1 genres"):
        X.genre_vocabulary(same, limit=1)


def test_user_features(log, train):
    found = {r["user_id"]: tuple(r)[1:] for r in X.user_features(train).select("user_id", *X.USER_COLUMNS).collect()}
    assert found == _user_facts(log)


def _context_facts(log):
    items = defaultdict(list)
    for _, s, i, _, _ in log:
        if s < 12:
            items[s].append(i)
    return {s: (len(i), i[-1], i[-2] if len(i) > 1 else 0) for s, i in items.items()}


def test_session_context(log, context):
    assert {r[0]: tuple(r)[1:] for r in X.session_context(context).collect()} == _context_facts(log)


def _candidates():
    return [(s, i, r) for s in range(13) for r, i in enumerate([(5 * s + k) % 17 for k in range(6)], 1)]


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_matrix(table, log, kinds, train, movies, context, targets, hot_rows):
    cooc = {(a, b): a * 20 + b for a in range(14) for b in range(14) if (a + b) % 3 == 0}
    candidates = table(_candidates(), CANDIDATES)
    hot = hot_keys(candidates, "item_id", hot_rows)
    items = X.item_features(train, movies)
    texts = items.join(movies.select("item_id", "title", "genre_list"), "item_id", "left")
    matrix = X.ranking_features(
        candidates, context, targets, texts, X.user_features(train), hot_rows=hot_rows,
        cooc=table([(a, b, n) for (a, b), n in cooc.items()], "item_a bigint, item_b bigint, cnt bigint"),
        hot_items=hot and hot.named("candidate_item_id"),
    )
    assert "title" not in matrix.columns and "genre_list" not in matrix.columns
    by_item, by_user, by_session = _item_facts(log), _user_facts(log), _context_facts(log)
    wanted = {s: (s % 9 if s != 5 else 400, (3 * s) % 14) for s in range(11)}
    expected = []
    for s, i, _ in _candidates():
        length, last, second = by_session.get(s, (0, 0, 0))
        user, target = wanted.get(s, (0, None))
        n, users, sessions, rank, head = by_item.get(i, (0,) * 5)
        flags = [int(i in by_item and i in kinds and k in kinds[i]) for k in ("Kids-TV", "Noir", "Old West")]
        total, own, mean, dense = by_user.get(user, (0, 0, 0.0, 0)) if s in wanted else (0, 0, 0.0, 0)
        score = float(cooc.get((last, i), 0)) if s in by_session else 0.0
        expected.append((s, i, length, last, second, user, n, users, sessions, rank, head, *flags,
                         total, own, mean, dense, score, int(i == target)))
    assert rows(matrix) == sorted(expected, key=str)
    positive = sum(e[-1] for e in expected)
    assert rows(X.matrix_summary(matrix)) == [(len(expected), len(matrix.columns), positive, positive / len(expected))]


def test_matrix_without_scores_and_without_candidates(table, train, movies, context, targets):
    feats = X.item_features(train, movies, genres=[]), X.user_features(train)
    plain = X.ranking_features(table(_candidates(), CANDIDATES), context, targets, *feats)
    assert {r["cooc_score_last_item"] for r in plain.collect()} == {0.0}
    none = X.ranking_features(table([], CANDIDATES), context, targets, *feats)
    assert rows(none) == [] and none.columns == plain.columns
