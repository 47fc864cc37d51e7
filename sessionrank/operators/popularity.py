"""Popularity retrieval: the same most frequent items for every session."""

from pyspark.sql import functions as F


def fit_popularity(sessions):
    """Rows (item_id, n): how often each item occurs."""
    return sessions.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))


def _top(popularity, top_k):
    """One row: the k most frequent items as an array, equal counts by item_id."""
    best = popularity.orderBy(F.desc("n"), "item_id").limit(top_k)
    return best.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), "item_id"))).alias("top")
    )


def popular_items(popularity, top_k):
    """Rows (item_id, n, rank) of the k most frequent items."""
    return _top(popularity, top_k).select(F.posexplode("top").alias("pos", "item")).select(
        "item.item_id", (-F.col("item.order")).alias("n"), (F.col("pos") + 1).alias("rank")
    )


def retrieve_popular(popularity, context, top_k):
    """Recommendations (session_id, item_id, score, rank); context items are not excluded.

    That is k rows for each session. Evaluation needs only `popular_items`, the list that all sessions share.
    """
    return (
        context.select("session_id").distinct()
        .withColumn("top", _top(popularity, top_k).scalar())
        .select("session_id", F.posexplode("top").alias("pos", "item"))
        .select(
            "session_id", "item.item_id",
            (-F.col("item.order")).alias("score"), (F.col("pos") + 1).alias("rank"),
        )
    )
