"""Report queries over evaluation results and error reports."""

from pyspark.sql import functions as F

from sessionrank import schemas
from sessionrank.functions.numbering import count_quantiles
from sessionrank.operators.slices import length_bucket

# The headline metrics.
KEY_METRICS = ("recall@10", "ndcg@10", "mrr")


def hit_kpis(report):
    """One row: hit rate, percentage not retrieved, median rank of the retrieved."""
    found = report.filter(F.col("target_rank") > 0)
    # Ranks end at the length of the lists, so they take few distinct values.
    median = count_quantiles(found, "target_rank", [0.5]).select(F.col("q")[0]).scalar()
    return report.agg(
        F.avg(F.col("hit_at_k").cast("int")).alias("hit_rate"),
        (100 * F.avg((F.col("target_rank") == -1).cast("int"))).alias("not_retrieved_pct"),
    ).withColumn("median_rank", median)


def rank_histogram(report, bins):
    """Rows (bin, low, high, n): equal-width bins of the found ranks, the last one closed."""
    found = report.filter(F.col("target_rank") > 0)
    edges = found.agg(
        F.min("target_rank").cast("double").alias("lo"),
        F.max("target_rank").cast("double").alias("hi"),
    ).select(
        # A single value gets a range of width one around it.
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    number = F.least(
        F.width_bucket(F.col("target_rank").cast("double"), F.col("e.lo"), F.col("e.hi"), F.lit(bins)),
        F.lit(bins),
    )
    counts = (
        found.withColumn("e", edges.select(F.struct("lo", "hi").alias("e")).scalar())
        .groupBy(number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    empty = edges.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "lo", "width"
    )
    return empty.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("low"),
        (F.col("lo") + F.col("bin") * F.col("width")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def hit_rate_by_length(report, max_length=schemas.MAX_LENGTH):
    """Rows (length_bucket, n_sessions, hit_rate) of sessions with a context, up to `max_length` long (None: any).

    Sessions are cut at the same length by default, so none is left out for being long.
    """
    length = F.col("session_length")
    within = (length > 0) if max_length is None else length.between(1, max_length)
    return (
        report.filter(within)
        .groupBy(length_bucket(length).alias("length_bucket"))
        .agg(
            F.count(F.lit(1)).alias("n_sessions"),
            F.avg(F.col("hit_at_k").cast("int")).alias("hit_rate"),
        )
    )


def key_metrics(results):
    """The headline metrics only, by metric and ascending value."""
    return results.filter(F.col("metric").isin(*KEY_METRICS)).orderBy("metric", "value", "system")


def best_system(results):
    """Per metric, the best value and the system that has it (the first by name on a tie)."""
    return results.groupBy("metric").agg(
        F.min_by("system", F.struct((-F.col("value")).alias("v"), "system")).alias("system"),
        F.max("value").alias("value"),
    )


def top_features(importance, n):
    """The n most important features."""
    return importance.orderBy(F.desc("importance"), "feature").limit(n)
