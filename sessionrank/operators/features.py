"""Item, user and session features, and the (session, candidate) ranking matrix."""

from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionrank import schemas
from sessionrank.functions.numbering import count_quantiles, count_ranks
from sessionrank.functions.skew import HOT_ROWS, hot_keys, salted_join
from sessionrank.functions.staging import materialize
from sessionrank.operators.cooccurrence import recent_items

NO_GENRE = "(no genres listed)"
# Genres become columns of the matrix.
MAX_GENRES = 1000

ITEM_COLUMNS = [
    "item_global_count", "item_unique_users", "item_unique_sessions", "item_global_rank",
    "item_is_head",
]
USER_COLUMNS = [
    "user_total_interactions", "user_total_sessions", "user_mean_session_length",
    "user_is_dense",
]


def above_quantile(df, value, probability, out):
    """Adds the 0/1 column `out`: whether `value` reaches its own quantile."""
    threshold = count_quantiles(df, value, [probability]).select(F.col("q")[0]).scalar()
    return df.withColumn(out, (F.col(value) >= threshold).cast("int"))


# --- items ----------------------------------------------------------------------------


def item_counts(sessions):
    """Per item: rows, distinct users, distinct sessions."""
    # A session has one user, so both distinct counts fall out of nested groups; counting
    # them side by side would triple the rows.
    in_session = sessions.groupBy("item_id", "user_id", "session_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    by_user = in_session.groupBy("item_id", "user_id").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_sessions")
    )
    return by_user.groupBy("item_id").agg(
        F.sum("n").alias("item_global_count"),
        F.count(F.lit(1)).alias("item_unique_users"),
        F.sum("n_sessions").alias("item_unique_sessions"),
    )


def item_ranks(counts):
    """Adds `item_global_rank`: popularity rank from 1, ties share the smallest."""
    ranks = count_ranks(counts, "item_global_count", "item_global_rank")
    # One row per distinct count, at most sqrt(2 * events); Spark broadcasts it while it is small.
    return counts.join(ranks, "item_global_count").select(
        *counts.columns, "item_global_rank"
    )


def item_heads(counts, quantile=schemas.HEAD_QUANTILE):
    """Adds `item_is_head`: 1 if the count reaches the quantile of all counts."""
    return above_quantile(counts, "item_global_count", quantile, "item_is_head")


def genre_vocabulary(movies, limit=MAX_GENRES):
    """The genres in use, sorted; at most `limit` (an error otherwise), because each becomes a column."""
    rows = (
        movies.select(F.explode("genre_list").alias("genre")).distinct()
        .filter(F.col("genre") != NO_GENRE).limit(limit + 1).collect()
    )
    if len(rows) > limit:
        raise ValueError(f"more than {limit} genres: pass the ones that should become columns")
    return sorted(row["genre"] for row in rows)


def genre_column(genre):
    """Name of a genre's flag column."""
    return "genre_" + genre.lower().translate(str.maketrans("- ", "__"))


def item_genres(movies, genres=None):
    """One 0/1 column per genre. Genres whose column names coincide are an error."""
    genres = genre_vocabulary(movies) if genres is None else genres
    clashes = [c for c, n in Counter(map(genre_column, genres)).items() if n > 1]
    if clashes:
        raise ValueError(f"several genres share the columns {clashes}")
    flags = [
        F.array_contains("genre_list", genre).cast("int").alias(genre_column(genre))
        for genre in genres
    ]
    return movies.select("item_id", *flags)


def item_features(sessions, movies, genres=None):
    """Counts, rank, head flag and genre flags of every item in the sessions."""
    counts = item_heads(item_ranks(materialize(item_counts(sessions), "item-counts")))
    flags = item_genres(movies, genres)
    return counts.join(flags, "item_id", "left").select(
        "item_id", *ITEM_COLUMNS, *(c for c in flags.columns if c != "item_id")
    )


# --- users ----------------------------------------------------------------------------


def user_stats(sessions):
    """Per user: interactions, sessions, mean session length."""
    lengths = sessions.groupBy("user_id", "session_id").agg(F.count(F.lit(1)).alias("n"))
    return lengths.groupBy("user_id").agg(
        F.sum("n").alias("user_total_interactions"),
        F.count(F.lit(1)).alias("user_total_sessions"),
        F.avg("n").alias("user_mean_session_length"),
    )


def user_features(sessions, quantile=schemas.HEAD_QUANTILE):
    """User statistics with `user_is_dense`: 1 if the total reaches the quantile."""
    stats = materialize(user_stats(sessions), "user-stats")
    return above_quantile(
        stats, "user_total_interactions", quantile, "user_is_dense"
    )


# --- sessions -------------------------------------------------------------------------


def session_lengths(context):
    """Rows (session_id, session_length) of the context."""
    return context.groupBy("session_id").agg(F.count(F.lit(1)).alias("session_length"))


def session_context(context):
    """Per session: length, last item, second last item (0 if there is none)."""
    last = recent_items(context, 2).groupBy("session_id").agg(
        F.max(F.when(F.col("recency") == 1, F.col("item_id"))).alias("last_item_id"),
        F.coalesce(
            F.max(F.when(F.col("recency") == 2, F.col("item_id"))), F.lit(0)
        ).alias("second_last_item_id"),
    )
    return session_lengths(context).join(last, "session_id")


# --- ranking matrix -------------------------------------------------------------------


def ranking_features(
    candidates, context, targets, items, users, cooc=None, hot_items=None, hot_rows=HOT_ROWS
):
    """The ranking matrix: one row per (session, candidate), nulls as 0.

    candidates (session_id, item_id, ...); items and users are feature tables. The score of
    the candidate next to the session's last item comes from the edge table `cooc`, or from
    the candidates themselves if retrieval carried it along; without either it is 0.
    `hot_items` (from `hot_keys`) splits the rows of candidates that recur very often. Item columns
    that are not numbers (a title, a genre list) are no features and are left out.
    """
    numbers = (T.NumericType, T.BooleanType)
    items = items.select(*(
        F.col(f"`{f.name}`").cast("int").alias(f.name) if isinstance(f.dataType, T.BooleanType) else F.col(f"`{f.name}`")
        for f in items.schema if f.name == "item_id" or isinstance(f.dataType, numbers)
    ))
    carried = "cooc_score_last_item" in candidates.columns
    spine = candidates.select(
        "session_id", F.col("item_id").alias("candidate_item_id"),
        *(["cooc_score_last_item"] if carried else []),
    )
    people = salted_join(
        targets.select("session_id", "user_id", "target_item_id"), users, ["user_id"], "left",
        hot_keys(targets, "user_id", hot_rows), "user_id", ["session_id"],
    )
    matrix = spine.join(session_context(context), "session_id", "left").join(
        people, "session_id", "left"
    )
    matrix = salted_join(
        matrix, items.withColumnRenamed("item_id", "candidate_item_id"),
        ["candidate_item_id"], "left", hot_items, "candidate_item_id", ["session_id"],
    )
    if not carried and cooc is not None:
        edges = cooc.select(
            F.col("item_a").alias("last_item_id"),
            F.col("item_b").alias("candidate_item_id"),
            F.col("cnt").cast("double").alias("cooc_score_last_item"),
        )
        matrix = salted_join(
            matrix, edges, ["last_item_id", "candidate_item_id"], "left",
            hot_items, "candidate_item_id", ["session_id"],
        )
    elif not carried:
        matrix = matrix.withColumn("cooc_score_last_item", F.lit(0.0))
    is_target = F.col("candidate_item_id") == F.col("target_item_id")
    matrix = matrix.withColumn("label", F.coalesce(is_target, F.lit(False)).cast("int"))
    return matrix.select(
        "session_id", "candidate_item_id",
        "session_length", "last_item_id", "second_last_item_id", "user_id",
        *(F.col(f"`{c}`") for c in items.columns if c != "item_id"),
        *(c for c in users.columns if c != "user_id"),
        F.col("cooc_score_last_item").cast("double").alias("cooc_score_last_item"),
        "label",
    ).na.fill(0)


def matrix_summary(matrix):
    """One row: rows, columns, positive labels and their share."""
    return matrix.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(matrix.columns)).cast("bigint").alias("n_columns"),
        F.sum("label").alias("n_positive"),
        F.avg("label").alias("positive_rate"),
    )
