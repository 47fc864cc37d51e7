import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sessionrank import schemas
from sessionrank.operators import ranking as K
from sessionrank.operators import reports as R
from sessionrank.functions.skew import hot_keys, salted_join
from sessionrank.functions.staging import materialize, materialize_alone, stage_scope
from sessionrank.plans import stages
from sessionrank.plans.stages import run
from sessionrank.sources import files


@pytest.fixture(scope="module")
def matrix(table):
    rng = random.Random(0)
    data = []
    for s in range(60):
        for c in range(10):
            score = rng.random()
            data.append((s, c, 5, rng.randrange(100), score, int(score > 0.6), 1))
    return table(
        data, "session_id bigint, candidate_item_id bigint, session_length bigint, "
        "item_global_count bigint, cooc_score_last_item double, label int, `genre_children's` int"
    )


@pytest.fixture(scope="module")
def model(matrix):
    return K.fit_ranker(
        matrix.filter("session_id < 40"), matrix.filter("session_id >= 40"), rounds=5, leaves=4
    )


def test_feature_columns(matrix):
    assert K.feature_columns(matrix) == [
        "session_length", "item_global_count", "cooc_score_last_item", "genre_children's"
    ]


def test_ranker_separates(spark, matrix, model):
    scored = K.predict(model, matrix)
    means = dict(rows(scored.groupBy("label").agg(F.avg("score"))))
    assert means[1] > means[0] + 0.04  # the first round separates them, so no more are kept
    recs = K.rerank(scored, 3)
    assert recs.groupBy("session_id").count().filter("count <> 3").count() == 0
    importance = K.feature_importance(spark, model)
    assert importance.first()["feature"] == "cooc_score_last_item"
    gains = model.nodes(spark).agg(F.sum("gain")).first()[0]
    assert importance.count() == 4 and importance.agg(F.sum("importance")).first()[0] == pytest.approx(gains)
    assert R.top_features(importance, 2).count() == 2


def test_saved_ranker_scores_the_same(matrix, model, tmp_path):
    K.save_ranker(model, str(tmp_path / "ranker"))
    loaded = K.load_ranker(str(tmp_path / "ranker"))
    columns = ["session_id", "candidate_item_id", "score"]
    assert rows(K.predict(model, matrix).select(columns)) == rows(
        K.predict(loaded, matrix).select(columns)
    )


def test_unfitted_ranker_is_an_error(spark, matrix, tmp_path):
    for use in (lambda: K.predict(None, matrix), lambda: K.feature_importance(spark, None),
                lambda: K.save_ranker(None, str(tmp_path / "none"))):
        with pytest.raises(RuntimeError):
            use()


def test_rounds_are_chosen_on_held_out_rows(spark, matrix):
    train, val = matrix.filter("session_id < 30"), matrix.filter("session_id >= 30")
    # Labels of the held-out rows are turned around, so the first round is the best and patience ends the fit.
    turned = val.withColumn("label", 1 - F.col("label"))
    short = K.fit_ranker(train, turned, rounds=40, patience=3, leaves=4)
    history = rows(K.fit_history(spark, short))
    best = max(history, key=lambda h: (h[1], -h[0]))[0]
    assert len(short.trees) == best and len(history) == best + 3
    assert [h[4] for h in history] == [h[0] <= best for h in history]
    whole = K.fit_ranker(train, rounds=6, leaves=4)
    cut = K.fit_ranker(train, val, rounds=6, leaves=4)
    n = len(cut.trees)
    assert len(whole.trees) == 6 and rows(cut.nodes(spark)) == [r for r in rows(whole.nodes(spark)) if r[0] < n]
    losses = [h[3] for h in whole.history]
    assert losses == sorted(losses, reverse=True)


def test_rerank_breaks_ties_by_item(table):
    scored = table(
        [(0, 3, 1.0), (0, 1, 1.0), (0, 2, 5.0)],
        "session_id bigint, candidate_item_id bigint, score double",
    )
    assert rows(K.rerank(scored, 2)) == [(0, 1, 1.0, 2), (0, 2, 5.0, 1)]


def test_raw_files(spark, tmp_path):
    (tmp_path / "ratings.dat").write_text("1::10::5::978300760\n2::11::3.5::978300761\n")
    (tmp_path / "movies.dat").write_bytes(
        "1::Amélie (2001)::Comedy|Romance\n2::A \"B\" C::Sci-Fi\n".encode("latin-1")
    )
    (tmp_path / "users.dat").write_text("1::F::1::10::48067\n2::M::56::16::70072-1\n")
    folder = str(tmp_path)
    assert rows(files.read_ratings(spark, folder)) == [
        (1, 10, 5.0, 978300760), (2, 11, 3.5, 978300761)
    ]
    assert rows(files.read_movies(spark, folder)) == [
        (1, "Amélie (2001)", "Comedy|Romance", ["Comedy", "Romance"]),
        (2, 'A "B" C', "Sci-Fi", ["Sci-Fi"]),
    ]
    assert rows(files.read_users(spark, folder)) == [
        (1, "F", 1, 10, "48067"), (2, "M", 56, 16, "70072-1")
    ]


def test_results_round_trip(spark, table, tmp_path):
    results = table([("a+b", "mrr", 0.25), ("c", "mrr", 0.5)], schemas.EVALUATION)
    plain, split = str(tmp_path / "plain"), str(tmp_path / "split")
    files.write_results(results, plain)
    assert rows(files.read_results(spark, plain, schemas.EVALUATION)) == rows(results)
    files.write_results(results, split, by_system=True)
    assert sorted(p.name for p in (tmp_path / "split").iterdir() if p.is_dir()) == [
        "system=a_b", "system=c"
    ]
    assert files.read_results(spark, str(tmp_path / "none"), schemas.EVALUATION) is None


def test_stage_table_round_trip(spark, table, tmp_path):
    stage = table([(1, "train"), (2, "test")], "x bigint, split string")
    files.write_table(stage, str(tmp_path / "t"), ["split"])
    assert rows(files.read_table(spark, str(tmp_path / "t"))) == rows(stage)


def test_whole_run(spark, table, tmp_path):
    rng = random.Random(5)
    events = table(
        [(u, (u % 3) * 20 + rng.randrange(20), 600 * t + 10**6 * (t // 12), t)
         for u in range(60) for t in range(36)],
        "user_id bigint, item_id bigint, timestamp bigint, tie bigint",
    )
    genres = ["Action", "Drama"]
    movies = table(
        [(i, "t", genres[i % 2], [genres[i % 2]]) for i in range(60)],
        "item_id bigint, title string, genres string, genre_list array<string>",
    )
    out = str(tmp_path)
    results = run(events, movies, tie_cols=("tie",), out=out, rounds=3, leaves=6)
    values = {(r["system"], r["metric"]): r["value"] for r in results["final_eval"].collect()}
    assert len(values) == 39
    assert values["cooccurrence", "recall@10"] >= values["popularity", "recall@10"]
    for system in ("popularity", "cooccurrence", "cooc+ranker"):
        # One target per session and lists of ten.
        assert values[system, "map@10"] == values[system, "mrr"]
        assert values[system, "recall@5"] <= values[system, "recall@10"] == values[system, "recall@20"]
    read = files.read_results(spark, f"{out}/results/final_eval", schemas.EVALUATION)
    assert rows(read) == rows(results["final_eval"])
    assert K.load_ranker(f"{out}/results/models/ranker").features[-1] == "genre_drama"
    by_system = spark.read.csv(f"{out}/results/missed_targets_by_system", header=True)
    assert by_system.count() == results["missed_targets"].count()
    assert {r["system"] for r in by_system.select("system").distinct().collect()} <= {"popularity", "cooccurrence", "cooc_ranker"}
    # Another run evaluates what was kept.
    data = stages.load_prepared(spark, out)
    feats = stages.fit_features(data, movies)
    kept = K.load_ranker(f"{out}/results/models/ranker")
    again = stages.evaluate(data, stages.recommend(data, feats, kept))
    assert rows(again["final_eval"]) == rows(results["final_eval"])
    assert rows(stages.analyse_errors(data, stages.recommend(data, feats, kept, "val"), "val")["missed_rate"])


def test_stage_tables_are_deleted_after_use(spark, table):
    with stage_scope(spark):
        kept = materialize(table([(1,)], "x bigint"), "short-lived")
        path = kept.inputFiles()[0].removeprefix("file:")
        assert kept.count() == 1 and os.path.exists(path)
    assert not os.path.exists(path)


def test_hot_keys_are_forgotten_with_their_tables(spark, table):
    df = materialize(table([(1, i) for i in range(9)] + [(2, 0)], "k bigint, v int"), "kept")
    other = table([(1, "a"), (2, "b")], "k bigint, w string")
    joined = lambda: rows(salted_join(df, other, ["k"], "inner", hot_keys(df, "k", 4), "k", ["v"]))
    with stage_scope(spark):
        first = joined()
    assert joined() == first and len(first) == 10


def test_tables_made_on_the_way_are_deleted(spark, table):
    made = []

    def build():
        made.append(materialize(table([(1, 2)], "x bigint, `a b` int"), "on-the-way"))
        return made[0].withColumn("y", F.col("x") + 1)

    path = lambda df: df.inputFiles()[0].removeprefix("file:")
    whole = materialize_alone(spark, build, "result")
    assert rows(whole) == [(1, 2, 2)] and os.path.exists(path(whole))
    assert not os.path.exists(path(made[0]))
