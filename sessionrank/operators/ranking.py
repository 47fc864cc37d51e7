"""Ranking: boosted trees on the matrix, scores, reranking, importances."""

from functools import reduce

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionrank.operators import boosting
from sessionrank.sources import trees

# What identifies a row of the matrix.
KEYS = ("session_id", "candidate_item_id")
# What numbers in the matrix identify or label a row.
NO_FEATURES = {"session_id", "candidate_item_id", "user_id", "last_item_id", "second_last_item_id", "label"}

# The features of the ranker, in order; genre flags follow.
FEATURE_COLS = [
    "session_length",
    "item_global_count",
    "item_global_rank",
    "item_unique_users",
    "item_unique_sessions",
    "item_is_head",
    "user_total_interactions",
    "user_total_sessions",
    "user_mean_session_length",
    "user_is_dense",
    "cooc_score_last_item",
]


def feature_columns(matrix):
    """The ranker's features: every number of the matrix that is neither an id nor the label.

    The fixed ones come in their order, whatever their place in the matrix; others follow as they come.
    """
    order = {name: place for place, name in enumerate(FEATURE_COLS)}
    numbers = (f.name for f in matrix.schema if isinstance(f.dataType, T.NumericType))
    return sorted((n for n in numbers if n not in NO_FEATURES), key=lambda n: order.get(n, len(order)))


def fit_ranker(train, val=None, **settings):
    """A boosting.Booster on `label`: up to 500 rounds, ended and chosen by the area under the curve on `val`.

    `settings` override those of boosting.Settings. Without `val` all rounds are fitted and kept.
    """
    return boosting.fit(train, val, feature_columns(train), KEYS, boosting.Settings(**settings))


def predict(model, matrix):
    """Adds `score`, the probability of a positive label."""
    return _fitted(model).score(matrix)


def rerank(scored, top_k, score="score"):
    """Recommendations (session_id, item_id, score, rank) by any score column."""
    best = Window.partitionBy("session_id").orderBy(F.desc("score"), "item_id")
    return (
        scored.select(
            "session_id", F.col("candidate_item_id").alias("item_id"), F.col(score).alias("score")
        )
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top_k)
    )


def linear_score(matrix, weights):
    """Adds `score`, a weighted sum of matrix columns."""
    terms = [F.col(f"`{name}`") * F.lit(float(w)) for name, w in weights.items()]
    return matrix.withColumn("score", reduce(lambda a, b: a + b, terms))


def _fitted(model):
    if model is None:
        raise RuntimeError("the ranker has not been fitted")
    return model


def feature_importance(spark, model):
    """Rows (feature, importance), largest first: the total gain of the feature's splits."""
    return _fitted(model).total_gain(spark).orderBy(F.desc("importance"), "feature")


def fit_history(spark, model):
    """Rows (round, auc, loss, train_loss, kept) of all rounds fitted: on the validation rows, and the loss on the training rows."""
    kept = len(_fitted(model).trees)
    rows = [(*h, h[0] <= kept) for h in model.history]
    return spark.createDataFrame(rows, "round int, auc double, loss double, train_loss double, kept boolean")


def save_ranker(model, path):
    """Saves the trees as text, and the names of their features beside them."""
    trees.write_trees(SparkSession.active(), _fitted(model), path)


def load_ranker(path):
    """A ranker saved by `save_ranker`, or a text of trees of the same format from elsewhere."""
    return trees.read_trees(SparkSession.active(), path)
