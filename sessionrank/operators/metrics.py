"""Ranking metrics over recommendation and target tables.

Recommendations are (session_id, item_id, rank), ranks from 1, with a `system` column where
several systems are compared. Targets are (session_id, target_item_id), possibly several
per session. Sessions without recommendations count with 0, recommendations for sessions
without a target are ignored.
"""

from functools import reduce

from pyspark.sql import functions as F

from sessionrank import schemas

_FAMILIES = ("recall", "precision", "map", "ndcg")


def metric_names(k_values=schemas.K_VALUES):
    """recall@k, precision@k, map@k, ndcg@k for every k, then mrr."""
    return [f"{family}@{k}" for family in _FAMILIES for k in k_values] + ["mrr"]


def ordered_metrics(k_values=schemas.K_VALUES):
    """The metric names by family, then by k."""
    cells = [(family, k) for family in _FAMILIES for k in k_values] + [("mrr", 0)]
    return [f"{family}@{k}" if k else family for family, k in sorted(cells)]


def relevant_sets(targets):
    """Distinct (session_id, item_id) of the targets."""
    return targets.select("session_id", F.col("target_item_id").alias("item_id")).distinct()


def combine_systems(systems):
    """One recommendation table out of {system: table}."""
    tables = [
        recs.select(F.lit(name).alias("system"), "session_id", "item_id", "rank")
        for name, recs in systems.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), tables)


def _sum(values):
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _discount(place):
    return F.lit(1.0) / F.log2(place.cast("double") + 1)


def _metrics_at(k, hits, n_relevant):
    """Columns of the metrics at k from the sorted ranks of the hits."""
    top = F.filter(hits, lambda rank: rank <= k)
    n_hits = F.size(top)
    precisions = F.transform(top, lambda rank, i: (i + 1).cast("double") / rank)
    gained = _sum(F.transform(top, _discount))
    # The ideal list has the same hits, moved to the front.
    ideal = _sum(F.transform(top, lambda rank, i: _discount(i + 1)))
    return [
        (n_hits / n_relevant).alias(f"recall@{k}"),
        (n_hits / F.lit(k)).alias(f"precision@{k}"),
        (_sum(precisions) / F.least(n_relevant, F.lit(k))).alias(f"map@{k}"),
        F.when(n_hits > 0, gained / ideal).otherwise(F.lit(0.0)).alias(f"ndcg@{k}"),
    ]


def _hits(recs, relevant, by):
    """Rows (*by, session_id, rank) of recommended relevant items."""
    if "session_id" in recs.columns:
        return recs.join(relevant, ["session_id", "item_id"]).select(*by, "session_id", "rank")
    # One short list for all sessions: the targets look themselves up in it.
    return relevant.join(recs, "item_id").select(*by, "session_id", "rank")


def hit_metrics(recs, targets, k_values=schemas.K_VALUES):
    """Metrics of the sessions with at least one hit, one row per (system,) session.

    `recs` is a recommendation table or {system: table}; a table without session_id is a list that every session
    gets. All other sessions score 0 everywhere, so means need only these rows and the number of
    sessions.
    """
    relevant = relevant_sets(targets)
    if isinstance(recs, dict):
        by = ["system"]
        tables = [table.select(F.lit(name).alias("system"), *(c for c in ("session_id", "item_id", "rank") if c in table.columns))
                  for name, table in recs.items()]
        shared = [t for t in tables if "session_id" not in t.columns]
        own = [t for t in tables if "session_id" in t.columns]
        united = [reduce(lambda a, b: a.unionByName(b), own)] if own else []
        found = reduce(lambda a, b: a.unionByName(b), [_hits(t, relevant, by) for t in united + shared])
    else:
        by = ["system"] if "system" in recs.columns else []
        found = _hits(recs, relevant, by)
    sizes = relevant.groupBy("session_id").agg(F.count(F.lit(1)).cast("int").alias("n_relevant"))
    ranks = F.when(F.col("rank") <= max(k_values), F.col("rank"))
    hits = found.groupBy(*by, "session_id").agg(
        F.array_sort(F.collect_list(ranks)).alias("hits"), F.min("rank").alias("first")
    )
    columns = [
        column for k in k_values for column in _metrics_at(k, F.col("hits"), F.col("n_relevant"))
    ]
    return hits.join(sizes, "session_id").select(
        *by, "session_id", *columns, (F.lit(1.0) / F.col("first")).alias("mrr")
    ).select(*by, "session_id", *metric_names(k_values))


def session_metrics(recs, targets, k_values=schemas.K_VALUES):
    """Metrics of every target session (of one system), 0 where nothing was hit."""
    sessions = targets.select("session_id").distinct()
    return sessions.join(
        hit_metrics(recs, targets, k_values), "session_id", "left"
    ).na.fill(0.0)


def to_long(wide, keys, names):
    """One row (*keys, metric, value) per metric column, values rounded to 5 digits."""
    rounded = [F.round(F.col(n), 5).alias(n) for n in names]
    return wide.select(*keys, *rounded).unpivot(list(keys), names, "metric", "value")


def system_spine(spark, systems, column="system"):
    """A table of the systems' names, so that a system without any hit keeps its rows."""
    return spark.createDataFrame([(name,) for name in systems], f"{column} string")


def evaluate(recs, targets, k_values=schemas.K_VALUES):
    """Mean metrics of one system: (metric, value)."""
    return compare_systems({"": recs}, targets, k_values).drop("system")


def compare_systems(systems, targets, k_values=schemas.K_VALUES, column="system"):
    """Mean metrics of several systems: (system, metric, value), rounded to 5 digits.

    `systems` maps names to recommendation tables; one without session_id is a list for every session.
    """
    names = metric_names(k_values)
    n_sessions = targets.agg(F.countDistinct("session_id")).scalar()
    sums = hit_metrics(systems, targets, k_values).groupBy("system").agg(
        *(F.sum(n).alias(n) for n in names)
    )
    spine = system_spine(targets.sparkSession, systems)
    means = F.broadcast(spine).join(sums, "system", "left").na.fill(0.0, names).select(
        "system", n_sessions.alias("n"), *names
    ).select("system", *(F.try_divide(F.col(n), F.col("n")).alias(n) for n in names))
    return to_long(means, ["system"], names).withColumnRenamed("system", column)


def pivot_metrics(results, k_values=schemas.K_VALUES, column="system"):
    """One row per system, one column per metric, by family and k."""
    names = ordered_metrics(k_values)
    return results.groupBy(column).pivot("metric", names).agg(F.first("value"))
