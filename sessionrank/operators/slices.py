"""Metrics by session length, target popularity and user density."""

from pyspark.sql import functions as F

from sessionrank import schemas
from sessionrank.functions.numbering import count_quantiles
from sessionrank.functions.skew import hot_keys, salted_join, HOT_ROWS
from sessionrank.operators.features import above_quantile, session_lengths
from sessionrank.operators.metrics import hit_metrics, metric_names, to_long
from sessionrank.operators.popularity import fit_popularity


def _pairs(targets):
    return targets.select("session_id", "user_id", "target_item_id")


def length_bucket(length):
    """short up to 3, medium up to 9, else long."""
    return F.when(length <= 3, "short").when(length <= 9, "medium").otherwise("long")


def tag_session_length(targets, context):
    """Adds the slice `session_length`; null for sessions without context."""
    lengths = session_lengths(context).select(
        "session_id", length_bucket(F.col("session_length")).alias("session_length")
    )
    return targets.join(lengths, "session_id", "left")


def tag_item_popularity(targets, train, hot_rows=HOT_ROWS, item_counts=None):
    """Adds the slice `item_popularity`: head or tail by count in train, unseen is tail.

    `item_counts` (item_id, n) spares counting the items of train.
    """
    counts = fit_popularity(train) if item_counts is None else item_counts
    heads = above_quantile(counts, "n", schemas.HEAD_QUANTILE, "is_head").filter(
        "is_head = 1"
    ).select(F.col("item_id").alias("target_item_id"), F.lit("head").alias("item_popularity"))
    hot = hot_keys(targets, "target_item_id", hot_rows)
    return salted_join(
        targets, heads, ["target_item_id"], "left", hot, "target_item_id", ["session_id"]
    ).na.fill("tail", ["item_popularity"])


def tag_user_density(targets, train, hot_rows=HOT_ROWS):
    """Adds the slice `user_density`: sparse, dense or null (between, or unseen in train)."""
    counts = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    limits = count_quantiles(counts, "n", [schemas.SPARSE_QUANTILE, schemas.DENSE_QUANTILE])
    density = counts.withColumn("q", limits.scalar()).select(
        "user_id",
        F.when(F.col("n") <= F.col("q")[0], "sparse")
        .when(F.col("n") >= F.col("q")[1], "dense").alias("user_density"),
    )
    hot = hot_keys(targets, "user_id", hot_rows)
    return salted_join(targets, density, ["user_id"], "left", hot, "user_id", ["session_id"])


def _sliced(tagged, slices, systems, targets, k_values):
    """Mean metrics per system and slice: sessions are counted once per slice, and only hits are summed."""
    names = metric_names(k_values)
    tags = F.array(*(
        F.struct(F.lit(s).alias("slice_type"), F.col(s).alias("slice_value")) for s in slices
    ))
    tagged = tagged.select("session_id", F.inline(tags)).filter(F.col("slice_value").isNotNull())
    every = tagged.groupBy("slice_type", "slice_value").agg(
        F.count(F.lit(1)).alias("n_sessions")
    ).withColumn("system", F.explode(F.array(*map(F.lit, systems))))
    sums = tagged.join(hit_metrics(systems, targets, k_values), "session_id").groupBy(
        "slice_type", "slice_value", "system"
    ).agg(*(F.sum(n).alias(n) for n in names))
    means = every.join(sums, ["slice_type", "slice_value", "system"], "left").select(
        "slice_type", "slice_value", "n_sessions", "system",
        *((F.coalesce(F.col(n), F.lit(0.0)) / F.col("n_sessions")).alias(n) for n in names),
    )
    keys = ["slice_type", "slice_value", "n_sessions", "system"]
    return to_long(means, keys, names).select(
        "slice_type", "slice_value", "n_sessions", "metric", "value", "system"
    )


def slice_by_session_length(context, targets, recs, k_values=schemas.K_VALUES):
    """Metrics of the short, medium and long sessions."""
    tagged = tag_session_length(_pairs(targets), context)
    return _sliced(tagged, ["session_length"], {"": recs}, targets, k_values).drop("system")


def slice_by_item_popularity(train, targets, recs, k_values=schemas.K_VALUES):
    """Metrics of the sessions with a head and with a tail target."""
    tagged = tag_item_popularity(_pairs(targets), train)
    return _sliced(tagged, ["item_popularity"], {"": recs}, targets, k_values).drop("system")


def slice_by_user_density(train, targets, recs, k_values=schemas.K_VALUES):
    """Metrics of the sessions of sparse and of dense users."""
    tagged = tag_user_density(_pairs(targets), train)
    return _sliced(tagged, ["user_density"], {"": recs}, targets, k_values).drop("system")


def compare_slices(context, targets, train, systems, k_values=schemas.K_VALUES, item_counts=None):
    """All slices of several systems: (slice_type, slice_value, n_sessions, metric, value, system)."""
    tagged = tag_session_length(_pairs(targets), context)
    tagged = tag_user_density(tag_item_popularity(tagged, train, item_counts=item_counts), train)
    slices = ["session_length", "item_popularity", "user_density"]
    return _sliced(tagged, slices, systems, targets, k_values)


def all_slices(context, targets, train, recs, k_values=schemas.K_VALUES):
    """All slices of one system."""
    return compare_slices(context, targets, train, {"": recs}, k_values).drop("system")


def slice_summary(results, systems, k_values=schemas.K_VALUES):
    """Per slice, one column per system and key metric (recall at the last k, ndcg@10, mrr)."""
    names = [f"recall@{list(k_values)[-1]}", "ndcg@10", "mrr"]
    cells = [f"{system}_{name}" for system in systems for name in names]
    return (
        results.filter(F.col("metric").isin(names))
        .withColumn("cell", F.concat_ws("_", "system", "metric"))
        .groupBy("slice_type", "slice_value", "n_sessions")
        .pivot("cell", cells)
        .agg(F.avg("value"))
    )


def slice_pivot(results, slice_type, metric, systems):
    """One metric of one slice type: a row per slice value, a column per system."""
    return (
        results.filter((F.col("slice_type") == slice_type) & (F.col("metric") == metric))
        .groupBy("slice_value").pivot("system", list(systems)).agg(F.first("value"))
    )
