"""Error analysis: target ranks, misses, coverage, error report.

Targets hold one row per session. Recommendation tables may hold several systems, told
apart by a `system` column; the results then do too.
"""

from pyspark.sql import functions as F

from sessionrank import schemas
from sessionrank.functions.numbering import exact_quantiles
from sessionrank.functions.skew import HOT_ROWS, hot_keys, salted_join
from sessionrank.operators.features import above_quantile, session_lengths
from sessionrank.operators.popularity import fit_popularity


def target_ranks(recs, targets, systems=()):
    """Rows (session_id, target_item_id, target_rank): first rank of the target, else -1.

    `systems` names the systems in `recs`, each of which gets a row per session.
    """
    wanted = targets.select("session_id", "target_item_id")
    keys = ["session_id", "target_item_id"]
    if systems:
        wanted = wanted.withColumn("system", F.explode(F.array(*map(F.lit, systems))))
        keys = ["system", *keys]
    found = recs.withColumnRenamed("item_id", "target_item_id").select(*keys, "rank")
    return wanted.join(found, keys, "left").groupBy(*keys).agg(
        F.coalesce(F.min("rank"), F.lit(-1)).alias("target_rank")
    )


def missed_targets(recs, targets, top_k, systems=()):
    """Targets not among the first k; `retrieved` tells whether they come later."""
    return target_ranks(recs, targets, systems).filter(
        (F.col("target_rank") == -1) | (F.col("target_rank") > top_k)
    ).withColumn("retrieved", F.col("target_rank") > 0)


def coverage(recs, items, top_k, systems=()):
    """Catalogue size, distinct items in the first k, and their ratio.

    `items` is the catalogue, a table with an item_id column.
    """
    spark = items.sparkSession
    size = items.agg(F.countDistinct("item_id")).scalar()
    by = ["system"] if systems else []
    counts = recs.filter(F.col("rank") <= top_k).groupBy(*by).agg(
        F.countDistinct("item_id").alias("items_recommended")
    )
    if systems:
        spine = spark.createDataFrame([(s,) for s in systems], "system string")
        counts = F.broadcast(spine).join(counts, "system", "left").na.fill(0)
    return counts.select(size.alias("catalog_size"), "items_recommended", *by).select(
        "catalog_size", "items_recommended",
        F.coalesce(
            F.round(F.try_divide(F.col("items_recommended"), F.col("catalog_size")), 5), F.lit(0.0)
        ).alias("coverage"),
        *by,
    )


def error_report(recs, targets, train, context, top_k, systems=(), hot_rows=HOT_ROWS, item_counts=None):
    """Target ranks with session length, the target's count in train, head flag and hit flag.

    `item_counts` (item_id, n) spares counting the items of train.
    """
    item_counts = fit_popularity(train) if item_counts is None else item_counts
    counts = above_quantile(
        item_counts.select("item_id", F.col("n").alias("item_train_count")),
        "item_train_count", schemas.HEAD_QUANTILE, "item_is_head",
    ).withColumnRenamed("item_id", "target_item_id")
    ranked = target_ranks(recs, targets, systems).join(
        session_lengths(context), "session_id", "left"
    )
    hot = hot_keys(targets, "target_item_id", hot_rows)
    report = salted_join(
        ranked, counts, ["target_item_id"], "left", hot, "target_item_id", ["session_id"]
    )
    rank = F.col("target_rank")
    return report.select(
        *(["system"] if systems else []),
        "session_id", "target_item_id", "target_rank", "session_length", "item_train_count",
        F.coalesce("item_is_head", F.lit(0)).alias("item_is_head"),
        ((rank > 0) & (rank <= top_k)).alias("hit_at_k"),
    )


def missed_rate(recs, targets, top_k, systems):
    """Per system: missed and total targets, and the percentage."""
    missed = (F.col("target_rank") == -1) | (F.col("target_rank") > top_k)
    return target_ranks(recs, targets, systems).groupBy("system").agg(
        F.sum(missed.cast("bigint")).alias("missed"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn(
        "missed_pct",
        F.round(100.0 * F.col("missed") / F.greatest("total", F.lit(1)), 6),
    )


SUMMARY_COLUMNS = (
    "session_id", "target_item_id", "target_rank", "session_length", "item_train_count",
    "item_is_head",
)


def error_summary(report, columns=SUMMARY_COLUMNS):
    """Rows (column_name, count, mean, std, min, q25, q50, q75, max) of the report's numbers.

    Quartiles are exact and interpolated. `report` is read twice: pass a stage table.
    """
    quartiles = exact_quantiles(report, columns, [0.25, 0.5, 0.75])
    moments = report.agg(*(
        F.struct(
            F.lit(name).alias("column_name"),
            F.count(name).alias("count"),
            F.avg(name).alias("mean"),
            F.stddev_samp(name).alias("std"),
            F.min(name).cast("double").alias("min"),
            F.max(name).cast("double").alias("max"),
        ).alias(name)
        for name in columns
    ))
    described = moments.select(F.inline(F.array(*columns)))
    return described.join(quartiles, "column_name").select(
        "column_name", "count", "mean", "std", "min",
        *(F.col("q")[i].alias(f"q{25 * (i + 1)}") for i in range(3)), "max",
    )
