"""The registered queries: every operator on the benchmark tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionrank import schemas
from sessionrank.functions.staging import materialize, stage_path
from sessionrank.operators import (
    boosting, cooccurrence, errors, factors, features, metrics, popularity, ranking, reports, sessions,
    slices,
)
from sessionrank.plans import stages
from sessionrank.sources import files, fixtures
from sessionrank.streaming import sessions as streams

_QUERIES = {}

# A limit of rows per task that the users of the small tables exceed, and weights of the linear score
# that stands in for the trees where a query is compared with SQL.
HOT_SLICE = 48
# Lines of a file of the log in input order, 20 bytes each or more.
FILE_ROWS = 1 << 20
LINEAR_WEIGHTS = {
    "cooc_score_last_item": 3.0, "item_global_count": 0.5, "item_global_rank": -0.25,
}


def _query(function):
    _QUERIES[f"q_{function.__name__}"] = function
    return function


def registered():
    """All queries by name."""
    return dict(_QUERIES)


def _prepared(spark, folder, log=fixtures.dense_log):
    events, gap, ties = log(spark, folder)
    return stages.prepare(events, gap, tie_cols=ties)


def _sessions(spark, folder, log=fixtures.dense_log, **options):
    events, gap, ties = log(spark, folder)
    return sessions.build_sessions(events, gap, tie_cols=ties, **options)


def _rounded(df, *names):
    return df.select(*(
        F.round(F.col(c), 6).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns
    ))


# --- sessions -------------------------------------------------------------------------


@_query
def event_gaps(spark, folder):
    events, _, ties = fixtures.dense_log(spark, folder)
    return sessions.event_gaps(events, ties)


@_query
def event_gaps_sliced(spark, folder):
    # Few rows to a task, so that users are numbered in slices and stitched.
    events, _, ties = fixtures.dense_log(spark, folder)
    return sessions.event_gaps(events, ties, hot_rows=HOT_SLICE)


@_query
def local_sessions(spark, folder):
    events, gap, ties = fixtures.dense_log(spark, folder)
    return sessions.local_sessions(events, gap, ties)


@_query
def sessions_min_len(spark, folder):
    events, gap, ties = fixtures.dense_log(spark, folder)
    return sessions.sessions_of_min_length(events, gap, 5, ties)


@_query
def sessions_truncated(spark, folder):
    return _sessions(spark, folder, fixtures.sparse_log, max_length=5)


@_query
def session_ids(spark, folder):
    return _sessions(spark, folder).groupBy("session_id", "user_id").agg(
        F.min("timestamp").alias("started"), F.count(F.lit(1)).alias("n_items")
    )


@_query
def build_sessions(spark, folder):
    return _sessions(spark, folder)


@_query
def build_sessions_sparse(spark, folder):
    return _sessions(spark, folder, fixtures.sparse_log)


@_query
def build_sessions_sliced(spark, folder):
    return _sessions(spark, folder, hot_rows=HOT_SLICE)


@_query
def build_sessions_sparse_sliced(spark, folder):
    return _sessions(spark, folder, fixtures.sparse_log, hot_rows=HOT_SLICE)


@_query
def build_sessions_input_order(spark, folder):
    """Sessions by day alone, events of a day in the order of their lines in several files, each read in several splits."""
    events = fixtures.dense_log(spark, folder).events
    raw, name = stage_path(spark, "raw"), "spark.sql.files.maxPartitionBytes"
    lines = events.select(
        "user_id", "item_id", F.lit(1.0).alias("rating"), F.floor(F.col("timestamp") / fixtures.DAY).alias("timestamp"),
        (F.col("event_id") % 3).alias("part"), F.md5(F.col("event_id").cast("string")).alias("place"),
    )
    n = events.count()
    for part in range(3):
        # Files by ranges of the place, named in their order; one alone up to so many rows.
        placed = lines.filter(F.col("part") == part).repartitionByRange(max(1, -(-n // (3 * FILE_ROWS))), "place")
        _write_lines(placed.sortWithinPartitions("place").drop("part", "place"), raw, f"ratings.dat/{part}")
    before = spark.conf.get(name)
    # Splits grow with the log up to a fifth of a full file, so that their number does not follow its bytes.
    spark.conf.set(name, str(min(max(1 << 14, n // 4), 4 * FILE_ROWS)))
    try:
        read = files.with_input_order(files.read_ratings(spark, raw, folders=True))
        return sessions.build_sessions(read, 1, tie_cols=files.INPUT_ORDER)
    finally:
        spark.conf.set(name, before)


def _landed(spark, folder, parts=4):
    """(path, schema): the dense log in files that landed one after the other, by time."""
    events = fixtures.dense_log(spark, folder).events.select("user_id", "item_id", "timestamp")
    path = stage_path(spark, "landing")
    low, high = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    part = F.least(F.floor((F.col("timestamp") - low) * parts / (high - low + 1)), F.lit(parts - 1))
    for k in range(parts):
        events.filter(part == k).coalesce(2).write.mode("append").parquet(path)
    return path, events.schema, high


def _streamed(spark, folder, make, name):
    """What a stream over the landed files writes in two runs, the second from the checkpoint of the first."""
    path, schema, high = _landed(spark, folder)
    sink, checkpoint = stage_path(spark, name), stage_path(spark, "checkpoint")
    stream = lambda: make(streams.event_files(spark, path, schema, 3))
    streams.run_available(stream(), sink, checkpoint)
    # An event far ahead closes what is open.
    far = spark.createDataFrame([(-1, -1, high + 1000 * fixtures.DAY)], schema)
    far.coalesce(1).write.mode("append").parquet(path)
    streams.run_available(stream(), sink, checkpoint)
    streams.run_available(stream(), sink, checkpoint)
    return spark.read.parquet(sink)


@_query
def stream_sessions(spark, folder):
    _, gap, _ = fixtures.dense_log(spark, folder)
    found = _streamed(spark, folder, lambda events: streams.stream_sessions(events, gap), "stream-sessions")
    return found.select("user_id", "started", "ended", "n_items")


@_query
def stream_popularity(spark, folder):
    return _streamed(spark, folder, lambda events: streams.stream_popularity(events, 7 * fixtures.DAY), "stream-popularity")


@_query
def session_summary(spark, folder):
    return sessions.session_summary(_sessions(spark, folder))


@_query
def split_users(spark, folder):
    return _prepared(spark, folder).table.select("user_id", "split").distinct()


@_query
def split_sessions(spark, folder):
    table = _prepared(spark, folder, fixtures.sparse_log).table
    return table.select(*schemas.SESSION_COLUMNS, "split")


@_query
def split_summary(spark, folder):
    return sessions.split_summary(_prepared(spark, folder, fixtures.sparse_log).table)


@_query
def targets(spark, folder):
    return sessions.targets_of(_sessions(spark, folder, keep_size=True))


@_query
def context(spark, folder):
    return sessions.context_of(_sessions(spark, folder, keep_size=True))


# --- features -------------------------------------------------------------------------


def _train(spark, folder, log=fixtures.dense_log):
    return _prepared(spark, folder, log).sessions("train")


@_query
def item_counts(spark, folder):
    return features.item_counts(_train(spark, folder, fixtures.sparse_log))


@_query
def item_rank(spark, folder):
    counts = features.item_counts(_train(spark, folder, fixtures.sparse_log))
    return features.item_ranks(counts).select("item_id", "item_global_count", "item_global_rank")


@_query
def item_head(spark, folder):
    counts = features.item_counts(_train(spark, folder, fixtures.sparse_log))
    return features.item_heads(counts).select("item_id", "item_global_count", "item_is_head")


@_query
def item_genres(spark, folder):
    return features.item_genres(fixtures.items(spark, folder))


@_query
def item_features(spark, folder):
    train = _train(spark, folder, fixtures.sparse_log)
    return features.item_features(train, fixtures.items(spark, folder))


@_query
def user_stats(spark, folder):
    train = _train(spark, folder, fixtures.sparse_log)
    return _rounded(features.user_stats(train), "user_mean_session_length")


@_query
def user_features(spark, folder):
    train = _train(spark, folder, fixtures.sparse_log)
    return _rounded(features.user_features(train), "user_mean_session_length")


@_query
def session_context(spark, folder):
    return features.session_context(_prepared(spark, folder).context("test"))


def _matrix(spark, folder, split="test"):
    data = _prepared(spark, folder)
    # Text columns of the items are no features.
    items = fixtures.items(spark, folder)
    feats = stages.fit_features(data, items)
    texts = feats.items.join(items.select("item_id", "title", "genre_list"), "item_id", "left")
    return data.matrix(split, texts, feats.users, data.candidates(split))


@_query
def cooc_feature(spark, folder):
    # Looked up in the edge table, not carried along from retrieval.
    data = _prepared(spark, folder)
    candidates = data.neighbours("test", schemas.RETRIEVAL_K).drop("cooc_score_last_item")
    matrix = features.ranking_features(
        candidates, data.context("test"), data.targets("test"),
        *stages.fit_features(data, fixtures.items(spark, folder), genres=[]), cooc=data.edges,
    )
    return matrix.select("session_id", "candidate_item_id", "cooc_score_last_item")


@_query
def labels(spark, folder):
    return _matrix(spark, folder).select("session_id", "candidate_item_id", "label")


@_query
def ranking_features(spark, folder):
    return _rounded(_matrix(spark, folder, "train"), "user_mean_session_length")


@_query
def ranking_features_test(spark, folder):
    return _matrix(spark, folder)


@_query
def matrix_summary(spark, folder):
    return _rounded(features.matrix_summary(_matrix(spark, folder, "train")), "positive_rate")


# --- retrieval ------------------------------------------------------------------------


@_query
def popular_items(spark, folder):
    train = _train(spark, folder, fixtures.sparse_log)
    return popularity.popular_items(popularity.fit_popularity(train), schemas.RETRIEVAL_K)


@_query
def popularity_recs(spark, folder):
    return _prepared(spark, folder).popular("test", schemas.RETRIEVAL_K)


@_query
def cooccurrence_edges(spark, folder):
    return cooccurrence.fit_cooccurrence(_train(spark, folder))


@_query
def cooccurrence_sparse(spark, folder):
    return cooccurrence.fit_cooccurrence(_train(spark, folder, fixtures.sparse_log))


@_query
def recent_items(spark, folder):
    return cooccurrence.recent_items(_prepared(spark, folder).context("test"))


@_query
def cooc_scores(spark, folder):
    data = _prepared(spark, folder)
    return cooccurrence.cooccurrence_scores(data.edges, data.context("test"))


def _neighbours(spark, folder, top_k, log=fixtures.dense_log):
    return _prepared(spark, folder, log).neighbours("test", top_k).drop("cooc_score_last_item")


@_query
def cooc_recs(spark, folder):
    return _neighbours(spark, folder, schemas.RETRIEVAL_K)


@_query
def cooc_recs_top10(spark, folder):
    return _neighbours(spark, folder, schemas.RANKING_K)


@_query
def cooc_recs_sparse(spark, folder):
    return _neighbours(spark, folder, schemas.RANKING_K, fixtures.sparse_log)


@_query
def cooc_recs_heads(spark, folder):
    # Few edges to a list, so that not all sessions are settled by the lists.
    recs = _prepared(spark, folder).neighbours("test", schemas.RETRIEVAL_K, head=8)
    return recs.drop("cooc_score_last_item")


@_query
def cooc_recs_sparse_heads(spark, folder):
    recs = _prepared(spark, folder, fixtures.sparse_log).neighbours("test", schemas.RANKING_K, head=2)
    return recs.drop("cooc_score_last_item")


@_query
def cooc_recs_insertion_ties(spark, folder):
    data = _prepared(spark, folder)
    edges = materialize(cooccurrence.fit_cooccurrence(data.sessions("train"), insertion=True), "edges")
    # Few edges to a block, so that ties are met in several.
    recs = cooccurrence.retrieve_cooccurrence(edges, data.context("test"), schemas.RANKING_K, head=16, insertion=True, least=cooccurrence.HEAD)
    return recs.drop("cooc_score_last_item")


@_query
def cooc_scores_salted(spark, folder):
    data = _prepared(spark, folder)
    return cooccurrence.cooccurrence_scores(data.edges, data.context("test"), hot_rows=HOT_SLICE)


@_query
def cooc_summary(spark, folder):
    data = _prepared(spark, folder, fixtures.sparse_log)
    return cooccurrence.cooccurrence_summary(data.sessions("train"), data.edges)


def _whole_context(spark, folder, shift=0):
    table = materialize(_sessions(spark, folder, keep_size=True), "sessions")
    return sessions.context_of(table).withColumn("item_id", F.col("item_id") + shift)


@_query
def session_vectors(spark, folder):
    vectors = factors.session_vectors(
        fixtures.item_vectors(spark, folder), _whole_context(spark, folder)
    )
    return _rounded(
        vectors.select("session_id", F.posexplode("vector").alias("dim", "value")), "value"
    )


@_query
def embedding_recs(spark, folder):
    return factors.retrieve_by_factors(
        fixtures.item_vectors(spark, folder), _whole_context(spark, folder), 20
    )


@_query
def embedding_recs_blocks(spark, folder):
    return factors.retrieve_by_factors(
        fixtures.item_vectors(spark, folder), _whole_context(spark, folder), 20, block_numbers=20_000
    )


@_query
def embedding_recs_unknown(spark, folder):
    # Item ids moved so that part of them has no vector.
    return factors.retrieve_by_factors(
        fixtures.item_vectors(spark, folder), _whole_context(spark, folder, 440), 20
    )


def _als_recs(spark, folder):
    data = _prepared(spark, folder)
    model = materialize(factors.fit_factors(data.sessions("train")), "factors")
    return data, factors.retrieve_by_factors(model, data.context("test"), schemas.RANKING_K)


@_query
def als_recs(spark, folder):
    return _als_recs(spark, folder)[1]


@_query
def embedding_work(spark, folder):
    """Lists over vectors of different lengths, and whether fewer products than all pairs gave them."""
    vectors, trace = fixtures.item_vectors(spark, folder), []
    scale = 1 / (1 + F.col("id") % 50)
    vectors = vectors.select("id", F.transform("features", lambda x: x.cast("double") * scale).alias("features"))
    recs = factors.retrieve_by_factors(vectors, _whole_context(spark, folder), 10, first_band=32, trace=trace)
    return recs.withColumn("fewer", F.lit(sum(n * m for _, n, m in trace) < trace[0][1] * vectors.count()))


@_query
def als_facts(spark, folder):
    # What must hold for the lists of any factorization.
    data, recs = _als_recs(spark, folder)
    seen = data.context("test").select("session_id", "item_id").distinct().withColumn("seen", F.lit(True))
    return recs.join(seen, ["session_id", "item_id"], "left").groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.countDistinct("item_id").alias("n_different"),
        F.max("rank").cast("bigint").alias("last_rank"), F.count("seen").alias("n_seen"),
    )


# --- ranking --------------------------------------------------------------------------


def _linear(matrix):
    return ranking.linear_score(matrix, LINEAR_WEIGHTS)


def _three_systems(spark, folder, log=fixtures.dense_log):
    # The linear score uses no genre, so none is collected.
    data = _prepared(spark, folder, log)
    feats = stages.fit_features(data, fixtures.items(spark, folder), genres=[])
    return data, stages.recommend(data, feats, _linear)


@_query
def rerank(spark, folder):
    return _three_systems(spark, folder)[1][stages.RANKER]


@_query
def two_stage(spark, folder):
    data, systems = _three_systems(spark, folder)
    return metrics.evaluate(systems[stages.RANKER], data.targets("test"))


# Rankers fitted in this session, by folder: the trees are some thousand numbers, the fit takes minutes.
_rankers = {}


def _fitted_ranker(spark, folder):
    data = _prepared(spark, folder)
    feats = stages.fit_features(data, fixtures.items(spark, folder))
    known = spark.sparkContext.applicationId, folder
    if known not in _rankers:
        _rankers[known] = stages.train(data, feats)
    return _rankers[known], data, data.matrix("test", *feats, data.candidates("test"))


@_query
def gbt_scores(spark, folder):
    model, _, matrix = _fitted_ranker(spark, folder)
    return ranking.predict(model, matrix).select("session_id", "candidate_item_id", "score")


@_query
def gbt_two_stage(spark, folder):
    model, data, matrix = _fitted_ranker(spark, folder)
    recs = ranking.rerank(ranking.predict(model, matrix), schemas.RANKING_K)
    return metrics.evaluate(recs, data.targets("test"))


@_query
def gbt_importance(spark, folder):
    model, _, _ = _fitted_ranker(spark, folder)
    return ranking.feature_importance(spark, model)


@_query
def top_features(spark, folder):
    model, _, _ = _fitted_ranker(spark, folder)
    return reports.top_features(ranking.feature_importance(spark, model), 15)


@_query
def ranker_facts(spark, folder):
    """What must hold for any fitted ranker: rows scored, scores in range and kept by saving, names, importances, rounds."""
    model, _, matrix = _fitted_ranker(spark, folder)
    path = stage_path(spark, "ranker")
    ranking.save_ranker(model, path)
    loaded = ranking.load_ranker(path)
    scored = materialize(ranking.predict(model, materialize(matrix, "tested")), "scored")
    again = ranking.predict(loaded, scored.withColumnRenamed("score", "first_score"))
    facts = again.agg(
        F.count(F.lit(1)).alias("scored rows"),
        F.count_if(F.col("score").between(0, 1)).alias("scores in range"),
        F.count_if(F.col("score") == F.col("first_score")).alias("scores kept"),
    ).unpivot([], ["scored rows", "scores in range", "scores kept"], "fact", "value")
    importance = ranking.feature_importance(spark, model)
    top = reports.top_features(importance, 15)
    gains = importance.agg(F.sum("importance")).scalar()
    kept = loaded.nodes(spark).agg(F.sum("gain").alias("kept")).select(F.round(1000 * F.col("kept") / gains).cast("bigint").alias("value"))
    return facts.unionByName(importance.select(
        F.concat(F.lit("feature "), "feature").alias("fact"), F.count_if(F.col("importance") >= 0).over(Window.partitionBy("feature")).alias("value")
    )).unionByName(kept.withColumn("fact", F.lit("importance, thousandths"))
    ).unionByName(top.agg(F.count(F.lit(1)).alias("value")).withColumn("fact", F.lit("top features")))


@_query
def leafwise_facts(spark, folder):
    """What must hold for trees grown best-first and rounds chosen by validation rows, whatever the data."""
    model, _, _ = _fitted_ranker(spark, folder)
    settings = boosting.Settings()
    nodes = materialize(model.nodes(spark), "nodes")
    history = materialize(ranking.fit_history(spark, model), "rounds")
    leaves = nodes.filter("node < 0").groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    inner = nodes.filter("node >= 0")
    sides = inner.select("tree", F.explode(F.array("left", "right")).alias("node"))
    falls = history.withColumn("before", F.lag("train_loss").over(Window.partitionBy(F.floor((F.col("round") - 1) / 5)).orderBy("round")))
    best = history.agg(F.max_by("round", F.struct("auc", -F.col("round")))).scalar()
    counts = {
        "trees with too many leaves": leaves.filter(F.col("n") > settings.leaves),
        "trees without a root": nodes.select("tree").distinct().join(inner.filter("node = 0").select("tree"), "tree", "left_anti"),
        "nodes that are not the child of one node": sides.groupBy("tree", "node").count().filter("count <> 1"),
        "children that are no nodes": sides.join(nodes.select("tree", "node"), ["tree", "node"], "left_anti"),
        "splits without gain": inner.filter("NOT gain > 0"),
        "leaves with too few rows": nodes.filter((F.col("node") < 0) & (F.col("rows") < settings.min_rows)),
        "splits whose children have other rows": inner.select("tree", F.col("rows").alias("whole"), F.explode(F.array("left", "right")).alias("node"), F.col("node").alias("parent")).join(
            nodes.select("tree", "node", "rows"), ["tree", "node"]).groupBy("tree", "parent", "whole").agg(F.sum("rows").alias("parts")).filter("whole <> parts"),
        "rounds of a sample that raised its loss": falls.filter("before IS NOT NULL AND train_loss > before"),
        "rounds beyond the best one and patience": history.filter(F.col("round") > best + settings.patience),
        "kept rounds after the best": history.filter((F.col("round") > best) & F.col("kept")),
        "rounds fitted short of patience": history.agg(F.max("round").alias("last")).filter(
            (F.col("last") < best + settings.patience) & (F.col("last") < settings.rounds)),
    }
    found = None
    for fact, rows in counts.items():
        row = rows.agg(F.count(F.lit(1)).alias("value")).select(F.lit(fact).alias("fact"), "value")
        found = row if found is None else found.unionByName(row)
    return found


# A tree small enough to be grown in SQL as well.
SMALL_TREE = {"rounds": 1, "leaves": 4, "row_share": 1.0, "feature_share": 1.0}


def _small_tree(spark, folder):
    return ranking.fit_ranker(materialize(_matrix(spark, folder, "train"), "train-matrix"), **SMALL_TREE)


@_query
def leafwise_tree(spark, folder):
    """The first splits, best first, of all training rows."""
    nodes = _small_tree(spark, folder).nodes(spark).filter("node >= 0")
    return _rounded(nodes.select(F.col("node").alias("place"), "feature", "threshold", "gain", "rows"), "threshold", "gain")


@_query
def leafwise_leaves(spark, folder):
    """Rows and scores of the leaves of that tree."""
    nodes = _small_tree(spark, folder).nodes(spark).filter("node < 0")
    return _rounded(nodes.select("rows", "value"), "value")


@_query
def total_gain(spark, folder):
    model = _small_tree(spark, folder)
    path = stage_path(spark, "ranker")
    ranking.save_ranker(model, path)
    return _rounded(ranking.feature_importance(spark, ranking.load_ranker(path)), "importance")


@_query
def auc(spark, folder):
    """Area under the curve of the linear score, over all candidates and by head and tail items."""
    scored = materialize(_linear(_matrix(spark, folder)), "scored")
    parts = boosting.area_under_curve(scored, ["item_is_head"])
    whole = boosting.area_under_curve(scored).withColumn("item_is_head", F.lit(None).cast("int"))
    return _rounded(parts.unionByName(whole), "auc")


# Two trees in the public text format, as another program would have written them.
SAVED_TREES = """tree
version=v4
num_class=1
num_tree_per_iteration=1
label_index=0
max_feature_idx=3
objective=binary sigmoid:1
feature_names=cooc_score_last_item item_global_rank session_length item_is_head
feature_infos=[0:100] [1:500] [1:50] [0:1]

Tree=0
num_leaves=4
num_cat=0
split_feature=0 1 2
split_gain=30.5 12.25 4
threshold=1.5 40.5 3.5
decision_type=2 2 10
left_child=1 -1 -2
right_child=2 -3 -4
leaf_value=-2.5 -1.25 -3 -0.5
is_linear=0
shrinkage=1

Tree=1
num_leaves=3
num_cat=0
split_feature=3 0
split_gain=7.5 2
threshold=0.5 0.5
decision_type=2 4
left_child=-1 -2
right_child=1 -3
leaf_value=-0.125 0.25 0.75
is_linear=0
shrinkage=0.05

end of trees
"""


@_query
def saved_tree_scores(spark, folder):
    path = stage_path(spark, "trees")
    spark.createDataFrame([(SAVED_TREES,)], "value string").coalesce(1).write.text(path)
    scored = ranking.predict(ranking.load_ranker(path), _matrix(spark, folder))
    return _rounded(scored.select("session_id", "candidate_item_id", "score"), "score")


@_query
def ranker_features(spark, folder):
    names = ranking.feature_columns(_matrix(spark, folder))
    return spark.createDataFrame(list(enumerate(names)), "place int, feature string")


# --- evaluation -----------------------------------------------------------------------


def _per_session(spark, folder, *families):
    data = _prepared(spark, folder)
    per_session = metrics.session_metrics(
        data.neighbours("test", schemas.RETRIEVAL_K), data.targets("test")
    )
    return _plain_columns(per_session, families)


def _plain_columns(per_session, families):
    names = [n for n in metrics.metric_names() if n.split("@")[0] in families]
    return per_session.select(
        "session_id", *(F.round(F.col(n), 6).alias(n.replace("@", "_")) for n in names)
    )


@_query
def recall(spark, folder):
    return _per_session(spark, folder, "recall")


@_query
def precision(spark, folder):
    return _per_session(spark, folder, "precision")


@_query
def average_precision(spark, folder):
    return _per_session(spark, folder, "map")


@_query
def ndcg(spark, folder):
    return _per_session(spark, folder, "ndcg")


@_query
def mrr(spark, folder):
    return _per_session(spark, folder, "mrr")


@_query
def multi_target_metrics(spark, folder):
    # Every item of a session counts as relevant.
    data = _prepared(spark, folder)
    every = data.sessions("test").select("session_id", F.col("item_id").alias("target_item_id"))
    per_session = metrics.session_metrics(data.popular_list(schemas.RETRIEVAL_K), every)
    return _plain_columns(per_session, ("recall", "precision", "map", "ndcg", "mrr"))


@_query
def relevant_sets(spark, folder):
    return metrics.relevant_sets(_prepared(spark, folder).targets("test"))


@_query
def evaluate(spark, folder):
    data = _prepared(spark, folder)
    return metrics.evaluate(data.neighbours("test", schemas.RANKING_K), data.targets("test"))


def _compared(spark, folder, log=fixtures.dense_log):
    data, systems = _three_systems(spark, folder, log=log)
    return metrics.compare_systems(systems, data.targets("test"))


@_query
def compare_systems(spark, folder):
    return _compared(spark, folder)


@_query
def stages_reloaded(spark, folder):
    # Prepared sessions are kept, read back by another run and evaluated there.
    path = stage_path(spark, "run")
    stages.save(_prepared(spark, folder), path)
    data = stages.load_prepared(spark, path)
    feats = stages.fit_features(data, fixtures.items(spark, folder), genres=[])
    return stages.evaluate(data, stages.recommend(data, feats, _linear))["final_eval"]


@_query
def compare_systems_sparse(spark, folder):
    return _compared(spark, folder, fixtures.sparse_log)


@_query
def evaluate_retrieval(spark, folder):
    return stages.evaluate(_prepared(spark, folder), {})["retrieval_eval"]


@_query
def metric_pivot(spark, folder):
    return metrics.pivot_metrics(_compared(spark, folder))


# --- slices ---------------------------------------------------------------------------


@_query
def slice_length(spark, folder):
    data = _prepared(spark, folder)
    return slices.slice_by_session_length(
        data.context("test"), data.targets("test"), data.neighbours("test", schemas.RANKING_K)
    )


@_query
def slice_popularity(spark, folder):
    data = _prepared(spark, folder, fixtures.sparse_log)
    return slices.slice_by_item_popularity(
        data.sessions("train"), data.targets("test"), data.neighbours("test", schemas.RANKING_K)
    )


@_query
def slice_density(spark, folder):
    # Users of the test split never occur in train, so the slice is taken on train targets.
    data = _prepared(spark, folder)
    return slices.slice_by_user_density(
        data.sessions("train"), data.targets("train"), data.neighbours("train", schemas.RANKING_K)
    )


@_query
def all_slices(spark, folder):
    data = _prepared(spark, folder)
    recs = {"": data.neighbours("test", schemas.RANKING_K)}
    return stages.slice_systems(data, recs)["slice_eval_combined"].drop("system")


def _sliced(spark, folder):
    data, systems = _three_systems(spark, folder)
    return stages.slice_systems(data, systems)["slice_eval_combined"], list(systems)


@_query
def slice_systems(spark, folder):
    return _sliced(spark, folder)[0]


@_query
def slice_summary(spark, folder):
    return slices.slice_summary(*_sliced(spark, folder))


@_query
def slice_pivot(spark, folder):
    results, systems = _sliced(spark, folder)
    return slices.slice_pivot(results, "session_length", "recall@10", systems)


# --- errors and reports ---------------------------------------------------------------


@_query
def target_rank(spark, folder):
    data = _prepared(spark, folder)
    return errors.target_ranks(
        data.neighbours("test", schemas.RETRIEVAL_K), data.targets("test")
    )


@_query
def missed(spark, folder):
    data = _prepared(spark, folder)
    return errors.missed_targets(
        data.neighbours("test", schemas.RETRIEVAL_K), data.targets("test"), schemas.RANKING_K
    )


@_query
def coverage(spark, folder):
    data = _prepared(spark, folder, fixtures.sparse_log)
    systems = {
        "popularity": data.popular("test", schemas.RETRIEVAL_K),
        "cooccurrence": data.neighbours("test", schemas.RETRIEVAL_K),
    }
    return errors.coverage(
        metrics.combine_systems(systems), data.sessions("train"), schemas.RANKING_K, list(systems)
    )


def _report(spark, folder):
    data = _prepared(spark, folder)
    return errors.error_report(
        data.neighbours("test", schemas.RETRIEVAL_K), data.targets("test"),
        data.sessions("train"), data.context("test"), schemas.RANKING_K, item_counts=data.item_counts,
    )


@_query
def error_report(spark, folder):
    return _report(spark, folder)


@_query
def missed_rate(spark, folder):
    data, systems = _three_systems(spark, folder)
    return stages.analyse_errors(data, systems)["missed_rate"]


@_query
def error_summary(spark, folder):
    report = materialize(_report(spark, folder), "report")
    return _rounded(errors.error_summary(report), "mean", "std")


@_query
def hit_kpis(spark, folder):
    report = materialize(_report(spark, folder), "report")
    return _rounded(reports.hit_kpis(report), "hit_rate", "not_retrieved_pct")


@_query
def rank_histogram(spark, folder):
    report = materialize(_report(spark, folder), "report")
    return _rounded(reports.rank_histogram(report, 20), "low", "high")


@_query
def hit_by_length(spark, folder):
    return _rounded(reports.hit_rate_by_length(_report(spark, folder)), "hit_rate")


@_query
def key_metrics(spark, folder):
    return reports.key_metrics(_compared(spark, folder))


@_query
def best_system(spark, folder):
    return reports.best_system(_compared(spark, folder))


# --- files ----------------------------------------------------------------------------


def _write_lines(rows, folder, name, encoding="UTF-8"):
    """Writes columns as `::` separated lines, the format of the raw files."""
    line = F.concat_ws("::", *rows.columns).alias("value")
    rows.select(line).write.option("encoding", encoding).csv(
        f"{folder}/{name}", sep="\x01", quote="", encoding=encoding
    )


@_query
def read_ratings(spark, folder):
    raw = stage_path(spark, "raw")
    events = fixtures.dense_log(spark, folder).events
    _write_lines(events.select(
        "user_id", "item_id", (F.col("event_id") % 5 + 1).cast("double").alias("rating"),
        F.floor(F.col("timestamp") / fixtures.MICROS_PER_SECOND).alias("timestamp"),
    ), raw, "ratings.dat")
    return files.read_ratings(spark, raw)


@_query
def read_movies(spark, folder):
    raw = stage_path(spark, "raw")
    items = fixtures.items(spark, folder)
    _write_lines(
        items.select("item_id", F.concat("title", F.lit(" é")).alias("title"), "genres"),
        raw, "movies.dat", "ISO-8859-1",
    )
    return files.read_movies(spark, raw).withColumn("genre_list", F.concat_ws("/", "genre_list"))


@_query
def read_users(spark, folder):
    raw = stage_path(spark, "raw")
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    _write_lines(customers.select(
        "c_custkey", "c_mktsegment", F.col("c_nationkey").alias("age"),
        F.col("c_nationkey").alias("occupation"), "c_name",
    ), raw, "users.dat")
    return files.read_users(spark, raw)


@_query
def read_results(spark, folder):
    path = stage_path(spark, "results")
    files.write_results(_sliced(spark, folder)[0], path)
    return files.read_results(spark, path, schemas.SLICES)


@_query
def stage_tables(spark, folder):
    path = stage_path(spark, "kept")
    table = _prepared(spark, folder, fixtures.sparse_log).table
    files.write_table(table, path, ["split"])
    return files.read_table(spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("session_id").alias("n_sessions"),
        F.sum("item_id").alias("items"),
    )
