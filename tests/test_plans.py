"""Shapes of the physical plans that matter at scale."""

import re

from sessionrank.operators import cooccurrence as C
from sessionrank.operators import metrics as M
from sessionrank.operators import sessions as S
from sessionrank.plans import registry, stages


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sessions(table):
    return table(
        [(1, s, i, i, i) for s in range(3) for i in range(4)],
        "user_id bigint, session_id bigint, item_id bigint, timestamp bigint, position int",
    )


def test_sessions_shuffle_the_rows_once_and_never_to_one_task(table):
    events = table([(1, 2, 3, 4)], "user_id bigint, item_id bigint, timestamp bigint, tie bigint")
    # The rows are numbered in one shuffle, written, and joined with the users' first ids.
    plan = _plan(S.local_sessions(events, 10, ("tie",)))
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan
    plan = _plan(S.build_sessions(events, tie_cols=("tie",)))
    assert "SinglePartition" not in plan and "Window" not in plan.split("Join")[0]


def test_pairs_are_counted_before_the_shuffle_without_a_self_join(table):
    plan = _plan(C.fit_cooccurrence(_sessions(table)))
    assert "Join" not in plan and "partial_count" in plan


def test_lists_are_cut_before_the_shuffle(table):
    edges = table([(1, 2, 3)], "item_a bigint, item_b bigint, cnt bigint")
    plan = _plan(C.retrieve_cooccurrence(edges, _sessions(table), 10))
    assert "row_number(), 10, Partial" in plan
    for step in ("CartesianProduct", "NestedLoop", "SinglePartition", "Python"):
        assert step not in plan


def test_metrics_have_no_python_and_no_cross_join(table):
    recs = table([(0, 1, 1)], "session_id bigint, item_id bigint, rank int")
    targets = table([(0, 1)], "session_id bigint, target_item_id bigint")
    plan = _plan(M.compare_systems({"a": recs, "b": recs}, targets))
    for step in ("CartesianProduct", "NestedLoop", "Python"):
        assert step not in plan


def test_splits_of_the_input_order_grow_with_the_log(spark, tmp_path, monkeypatch):
    events = spark.range(120_000).selectExpr(
        "id AS event_id", "timestamp_seconds(1700000000 + id * 20) AS ts", "id % 900 AS user_id", "concat('{\"k\": ', id % 100, '}') AS props"
    )
    events.selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts", "user_id", "props").write.parquet(str(tmp_path / "events.parquet"))
    reads, read_in_order = [], registry.files.with_input_order
    monkeypatch.setattr(registry.files, "with_input_order", lambda df: reads.append((df.rdd.getNumPartitions(), len(df.inputFiles()))) or read_in_order(df))
    query = registry.registered()["q_build_sessions_input_order"]
    whole = query(spark, str(tmp_path))
    monkeypatch.setattr(registry, "FILE_ROWS", 10_000)
    cut = query(spark, str(tmp_path))
    (splits, files), (_, more_files) = reads
    assert files == 3 and 3 * files < splits < 100 and more_files == 12
    assert whole.count() == cut.count() and whole.exceptAll(cut).isEmpty()


def test_candidates_travel_in_lists_and_are_cut_where_they_are_grouped(table):
    edges = table([(i, j, i + j) for i in range(4) for j in range(9) if i != j], "item_a bigint, item_b bigint, cnt bigint")
    found = C.retrieve_cooccurrence(edges, _sessions(table), 3)
    plan = _plan(found)
    # The lists of the items are dealt out by session and part, not the candidates one by one.
    assert not re.search(r"hashpartitioning\(session_id#\d+L, item_b", plan)
    assert len(re.findall(r"hashpartitioning\(session_id#\d+L, part#\d+, \d+\), REPARTITION_BY_NUM", plan)) == 1
    assert "row_number(), 3, Partial" in plan
    assert sorted((r["session_id"], r["item_id"], r["score"]) for r in found.collect()) == [(s, i, 6 + 4 * i) for s in range(3) for i in (6, 7, 8)]


def test_edges_alone_are_not_sorted_into_blocks(table, monkeypatch):
    whole = _sessions(table).selectExpr("*", "4L AS n_items", "'train' AS split")
    made, impact_blocks = [], stages.impact_blocks
    monkeypatch.setattr(stages, "impact_blocks", lambda *args, **options: made.append(1) or impact_blocks(*args, **options))
    data = stages.Prepared(whole)
    alone = sorted(map(tuple, data.edges.collect()))
    assert len(alone) == 12 and not made
    assert sorted(map(tuple, data.blocks().select("item_a", "item_b", "cnt").collect())) == alone and made == [1]
    assert sorted(map(tuple, data.edges.collect())) == alone
