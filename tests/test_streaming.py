"""Streams of files that land one after the other, against sessions and counts of the whole log."""

import random
from collections import Counter

import pytest
from conftest import rows

from sessionrank.streaming import sessions as S

SCHEMA = "user_id bigint, item_id bigint, timestamp bigint"


def by_hand(events, gap, least):
    found = []
    for user in {u for u, _, _ in events}:
        times = sorted(t for u, _, t in events if u == user)
        start = 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i] - times[i - 1] > gap:
                if i - start >= least:
                    found.append((user, times[start], times[i - 1], i - start))
                start = i
    return sorted(found, key=str)


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / name) for name in ("landing", "sink", "checkpoint")]


def land(spark, events, folder):
    spark.createDataFrame(events, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_sessions_over_several_runs(spark, folders):
    landing, sink, checkpoint = folders
    rng = random.Random(1)
    events = sorted(((rng.randrange(6), rng.randrange(9), rng.randrange(4000) * 10) for _ in range(300)), key=lambda e: e[2])
    # A gap of exactly 100 does not end a session, one of 101 does.
    events += [(70, 1, 50_000), (70, 1, 50_100), (71, 1, 50_000), (71, 1, 50_101), (72, 1, 50_000)]
    stream = lambda: S.stream_sessions(S.event_files(spark, landing, SCHEMA, 1), 100, 2, 50)
    for part in (events[:90], events[90:200], events[200:]):
        land(spark, part, landing)
        S.run_available(stream(), sink, checkpoint)
    land(spark, [(-1, -1, 10**9)], landing)
    S.run_available(stream(), sink, checkpoint)
    got = rows(spark.read.parquet(sink))
    assert got == by_hand(events, 100, 2) and (70, 50_000, 50_100, 2) in got and not [r for r in got if r[0] in (71, 72)]
    # Nothing new has landed: a further run writes nothing.
    S.run_available(stream(), sink, checkpoint)
    assert rows(spark.read.parquet(sink)) == got


def test_rows_behind_the_watermark_are_left_out(spark, folders):
    landing, sink, checkpoint = folders
    ms = 1000
    stream = lambda: S.stream_sessions(S.event_files(spark, landing, SCHEMA, 1), 10 * ms, 1, 100 * ms)
    for part in ([(1, 1, 1000), (1, 1, 1005)], [(2, 1, 2000)], [(2, 1, 1950), (3, 1, 1800)], [(-1, 1, 10**6)]):
        land(spark, [(u, i, t * ms) for u, i, t in part], landing)
        S.run_available(stream(), sink, checkpoint)
    # 1950 is within the delay of 100 before 2000, 1800 is not.
    got = [(u, a // ms, b // ms, n) for u, a, b, n in rows(spark.read.parquet(sink))]
    assert got == [(1, 1000, 1005, 2), (2, 1950, 1950, 1), (2, 2000, 2000, 1)]


def test_popularity_by_event_time(spark, folders):
    landing, sink, checkpoint = folders
    rng = random.Random(2)
    events = sorted(((1, rng.randrange(5), rng.randrange(10_000)) for _ in range(200)), key=lambda e: e[2])
    stream = lambda: S.stream_popularity(S.event_files(spark, landing, SCHEMA), 1000)
    for part in (events[:120], events[120:], [(-1, -1, 10**7)]):
        land(spark, part, landing)
        S.run_available(stream(), sink, checkpoint)
    counts = Counter((t // 1000 * 1000, item) for _, item, t in events)
    assert rows(spark.read.parquet(sink)) == sorted(((*k, n) for k, n in counts.items()), key=str)
