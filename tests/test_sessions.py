import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sessionrank.operators import sessions as S
from sessionrank.sources import files

EVENTS = "user_id bigint, item_id bigint, timestamp bigint, tie bigint"


def _events(table, triples):
    return table([(u, i, t, n) for n, (u, i, t) in enumerate(triples)], EVENTS)


def _build(events, **options):
    return S.build_sessions(events, tie_cols=("tie",), **options)


def test_gaps_limits_and_lengths(table):
    rng = random.Random(31)
    times = [0]
    for _ in range(50):
        times.append(times[-1] + rng.choice([1, 899, 900, 901, 5000]))
    triples = [(4, rng.randrange(6), t) for t in times]
    for low in (1, 2, 4):
        built = _build(_events(table, triples), gap=900, min_length=low, max_length=None, keep_size=True)
        assert rows(built) == _brute(triples, 900, low, None)


def test_gap_is_strict(table):
    events = _events(table, [(1, 10, 0), (1, 11, 1800), (1, 12, 3601), (1, 13, 3601)])
    assert [r[1] for r in rows(_build(events))] == [0, 0, 1, 1]


def test_truncation_keeps_the_last_rows(table):
    """Two users, unequal gaps, a session shorter than the limit and one that ends before the user does."""
    times = {5: [0, 7, 400, 1800, 1801, 3000, 3004], 9: [50, 60, 90, 5000, 6200, 6201, 8000]}
    events = _events(table, [(u, 100 * u + k, t) for u, ts in times.items() for k, t in enumerate(ts)])
    built = rows(_build(events, gap=1500, max_length=3))
    assert [(r[0], r[1], r[2], r[4]) for r in built] == [
        (5, 0, 504, 0), (5, 0, 505, 1), (5, 0, 506, 2), (9, 1, 900, 0), (9, 1, 901, 1), (9, 1, 902, 2), (9, 2, 903, 0), (9, 2, 904, 1), (9, 2, 905, 2),
    ]


def test_sixty_rows_keep_fifty(table):
    events = _events(table, [(1, i, i) for i in range(60)])
    built = sorted(r[2] for r in rows(_build(events)))
    assert built == list(range(10, 60))


def test_ties_follow_the_tie_column_whatever_the_partitions(table):
    events = _events(table, [(1, 30 - i, 7) for i in range(20)])
    expected = [(30 - i, i) for i in range(20)]
    for parts in (1, 3, 7):
        built = _build(events.repartition(parts, F.rand(parts)))
        assert sorted(((r[2], r[4]) for r in rows(built)), key=lambda x: x[1]) == expected


def _brute(triples, gap, low, high):
    """Sessions by plain Python over (user, item, time) in input order."""
    out, sid = [], 0
    for user in sorted({t[0] for t in triples}):
        mine = sorted((t for t in triples if t[0] == user), key=lambda t: t[2])
        runs = []
        for event in mine:
            if not runs or event[2] - runs[-1][-1][2] > gap:
                runs.append([])
            runs[-1].append(event)
        for run in runs:
            if len(run) < low:
                continue
            kept = run if high is None else run[-high:]
            out += [(user, sid, e[1], e[2], p, len(kept)) for p, e in enumerate(kept)]
            sid += 1
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("high", [None, 4])
def test_slices_of_hot_users_change_nothing(table, seed, high):
    rng = random.Random(seed)
    triples = [(5, rng.randrange(9), rng.randrange(4000)) for _ in range(300)]
    triples += [(7, rng.randrange(9), 10 * i) for i in range(80)]  # one endless session
    triples += [(rng.randrange(4), rng.randrange(9), rng.randrange(4000)) for _ in range(60)]
    events = _events(table, triples)
    expected = _brute(triples, 30, 2, high)
    for hot_rows in (20, 100, 10**6):
        built = S.build_sessions(
            events, gap=30, max_length=high, tie_cols=("tie",), keep_size=True, hot_rows=hot_rows
        )
        assert rows(built) == expected


def test_steps_are_the_same_for_hot_users(table):
    rng = random.Random(9)
    triples = [(5, 1, rng.randrange(3000)) for _ in range(200)]
    triples += [(u, 1, rng.randrange(3000)) for u in range(4) for _ in range(20)]
    events = _events(table, triples)
    for step in (
        lambda hot: S.event_gaps(events, ("tie",), hot),
        lambda hot: S.local_sessions(events, 40, ("tie",), hot),
        lambda hot: S.sessions_of_min_length(events, 40, 3, ("tie",), hot),
    ):
        assert step(25).columns == step(10**6).columns
        assert rows(step(25)) == rows(step(10**6))


def test_one_moment_of_one_user_is_split(table, monkeypatch):
    # All events of the hot user have one timestamp: only the ties can split them.
    triples = [(6, i % 5, 100) for i in range(400)] + [(6, 1, 9000), (2, 1, 5), (2, 3, 6)]
    events = _events(table, triples)
    largest = []
    parts_of = S._parts

    def watched(*args):
        parts = parts_of(*args)
        largest.append(parts.slices.groupBy("user_id", "slice").count().agg(F.max("count")).first()[0])
        return parts

    monkeypatch.setattr(S, "_parts", watched)
    built = _build(events, gap=50, max_length=None, keep_size=True, hot_rows=40)
    assert rows(built) == _brute(triples, 50, 2, None) and max(largest) < 120


def test_small_slices_share_tasks(spark, table):
    events = _events(table, [(u, i % 7, 13 * i) for u in (4, 5, 6) for i in range(300)])
    parts = S._parts(events, ("tie",), 3)
    slices = parts.slices.groupBy("user_id", "slice").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("low"), F.max("timestamp").alias("high"))
    found = sorted(map(tuple, slices.collect()))
    assert len(parts.slices.inputFiles()) <= spark.sparkContext.defaultParallelism
    assert max(n for _, _, n, _, _ in found) <= 3 and len(found) <= parts.n_slices
    for (user, _, _, _, high), (following, _, _, low, _) in zip(found, found[1:]):
        assert user != following or high <= low


def test_the_log_is_evaluated_once(spark, table):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    triples = [(u, i % 3, 40 * i) for u in range(6) for i in range(30)] + [(9, 1, 7 * i) for i in range(200)]
    events = _events(table, triples).mapInArrow(counted, EVENTS)
    for hot_rows in (10**6, 50):
        read.value = 0
        built = S.build_sessions(events, gap=100, tie_cols=("tie",), hot_rows=hot_rows)
        assert built.count() and read.value == len(triples)


def test_ids_are_dense_for_far_apart_users(table):
    users = [3, 70_000, 5_000_000_000, 2**40 + 1]
    events = _events(table, [(u, i, t) for u in users for i, t in ((1, 0), (2, 5), (3, 9999), (4, 9999))])
    built = _build(events)
    got = sorted({(r[0], r[1]) for r in rows(built)})
    assert got == [(u, 2 * i + j) for i, u in enumerate(users) for j in (0, 1)]


def test_empty_log(table):
    assert rows(_build(table([], EVENTS))) == []


def test_summary(table):
    events = _events(table, [(u, i, 10 * i) for u in (1, 2) for i in range(3)])
    assert rows(S.session_summary(_build(events))) == [(2, 2)]


def test_split_is_by_user_and_has_the_sizes(table):
    events = _events(table, [(u, i, 60 * i) for u in range(100) for i in range(5)])
    split = S.split_sessions(_build(events), 0.2, 0.1, 0)
    per_user = split.groupBy("user_id").agg(F.countDistinct("split").alias("n"))
    assert per_user.filter("n <> 1").count() == 0
    assert rows(S.split_summary(split)) == [("test", 20, 20), ("train", 70, 70), ("val", 10, 10)]


def test_split_depends_on_the_seed(table):
    events = _events(table, [(u, i, 60 * i) for u in range(50) for i in range(2)])
    built = _build(events)
    tests = [
        {r["user_id"] for r in S.split_sessions(built, seed=s).filter("split = 'test'").collect()}
        for s in (1, 2)
    ]
    assert len(tests[0]) == len(tests[1]) == 10 and tests[0] != tests[1]


def test_all_test_split(table):
    events = _events(table, [(u, i, i) for u in range(4) for i in range(2)])
    split = S.split_sessions(_build(events), 1.0, 0.0)
    assert {r["split"] for r in split.collect()} == {"test"}


@pytest.mark.parametrize("keep_size", [True, False])
def test_target_is_the_last_item(table, keep_size):
    events = _events(table, [(1, 10, 0), (1, 11, 60), (1, 12, 120)])
    context, targets = S.extract_targets(_build(events, keep_size=keep_size))
    assert rows(targets) == [(0, 1, 12)]
    assert [r[2] for r in rows(context)] == [10, 11]
    assert context.columns == ["user_id", "session_id", "item_id", "timestamp", "position"]


def test_one_row_session_has_a_target_and_no_context(table):
    events = _events(table, [(1, 10, 0)])
    context, targets = S.extract_targets(_build(events, min_length=1))
    assert rows(targets) == [(0, 1, 10)] and rows(context) == []


def test_input_order_of_files_and_splits(spark, tmp_path):
    """Rows of several files, read in many splits, in the order in which DuckDB numbers them."""
    rng = random.Random(6)
    for name in ("b", "a", "c"):
        data = [(rng.randrange(3), rng.randrange(10**6), rng.randrange(3)) for _ in range(4000)]
        frame = pa.table(dict(zip(("user_id", "item_id", "timestamp"), map(list, zip(*data)))))
        pq.write_table(frame, tmp_path / f"{name}.parquet", row_group_size=500)
    expected = duckdb.sql(
        f"SELECT item_id FROM read_parquet('{tmp_path}/*.parquet', filename=true, file_row_number=true) ORDER BY filename, file_row_number"
    ).fetchall()
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        read = files.with_input_order(spark.read.parquet(str(tmp_path)))
        assert read.select("input_block").distinct().count() > 3
        assert [r["item_id"] for r in read.orderBy(*files.INPUT_ORDER).collect()] == [r[0] for r in expected]
        got = S.build_sessions(read, 10, max_length=None, tie_cols=files.INPUT_ORDER).orderBy("session_id", "position").collect()
    finally:
        spark.conf.set(name, before)
    users = duckdb.sql(
        f"SELECT user_id, item_id FROM read_parquet('{tmp_path}/*.parquet', filename=true, file_row_number=true) "
        "ORDER BY user_id, timestamp, filename, file_row_number"
    ).fetchall()
    assert [(r["user_id"], r["item_id"]) for r in got] == users


def test_the_log_is_never_broadcast(table, monkeypatch):
    """However few bytes its rows take: users are sent to them up to a number of users, and both sides are dealt out beyond."""
    events = _events(table, [(u, 1, t) for u in range(40) for t in range(5)])
    plan = lambda: S.build_sessions(events, tie_cols=("tie",))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan() and "BuildLeft" not in plan()
    expected = rows(_build(events))
    monkeypatch.setattr(S, "BROADCAST_ROWS", 39)
    assert "BroadcastHashJoin" not in plan() and "SortMergeJoin" in plan()
    assert rows(_build(events)) == expected
