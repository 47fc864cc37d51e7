"""Mixing sources to target weights by Pareto order sampling, in DataFrame expressions only."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionrank.llm.common import WORD, stage

WEIGHTS, LIMIT, SEED = (1, 2, 3), 3, "mix"
# The order of a source is looked at in so many bins; only the bin in which its sample ends is sorted.
BINS = 1 << 16
# What the sample leaves of a target, because its next document is too long, is filled this many times over by later ones.
FILLS = 2
# A table of sources of up to so many rows is broadcast.
BROADCAST_SOURCES = 100_000


def words(text):
    """The number of runs of other than ASCII white space in a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(id_col, text, seed=SEED):
    """A number between 0 and 1 (exclusive) for each id and text, the same in every run: 52 bits of an md5."""
    own = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), own).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def allot(sizes, weights=WEIGHTS, limit=LIMIT):
    """Rows (source, source_size, target): the total of all sizes shared out by weight.

    `sizes` has one row (source, source_size) for each source. Sources in code point order, null last, take the weights in
    turn. A target stops at `limit` times its source's size; the excess goes to the others by weight, until none is
    above: sources sorted by limit x size / weight stop from the front, as long as the share of the rest exceeds it.
    The windows run over one row for each source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.array(*map(F.lit, weights))[F.pmod(turn, F.lit(len(weights)))]
    weighed = sizes.withColumn("weight", weight.cast("bigint"))
    at = F.col("source_size") * F.lit(limit) / F.col("weight")
    by_stop = Window.orderBy("at", F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    every = by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stopped = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * limit
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rated = weighed.withColumn("at", at).select(
        "*", ((F.sum("source_size").over(every) - stopped) / rest).alias("share"), F.row_number().over(by_stop).alias("place")
    )
    fits = F.when(F.col("share") <= F.col("at"), F.struct("place", "share"))
    found = rated.withColumn("end", F.min(fits).over(every))
    return found.select("source", "source_size", F.when(
        F.col("end").isNull() | (F.col("place") < F.col("end.place")), (F.col("source_size") * limit).cast("double")
    ).otherwise(F.col("end.share") * F.col("weight")).alias("target"))


def _ranked(docs, propensity):
    """Sampling order: random odds over inclusion odds, as `rank` between 0 and 1 (v / (1 + v)), and its bin."""
    part = F.col("part") if propensity is None else F.least(F.lit(1.0), F.col("part") * F.col(propensity))
    odds = F.col("draw") / (1 - F.col("draw")) * (1 - part) / part
    rank = F.when(part >= 1, 0.0).when(part > 0, odds / (1 + odds)).otherwise(1.0)
    return docs.withColumn("rank", rank).withColumn("bin", F.floor(F.col("rank") * BINS).cast("int"))


def _taken():
    """Whether a ranked document with the `cuts` of its source is in the sample."""
    def within(cut):
        return (F.col("size") <= cut["limit"]) & (
            (F.col("bin") < cut["bin"]) | ((F.col("bin") == cut["bin"]) & (F.col("rank") <= cut["rank"]))
        )

    return F.exists("cuts", within)


def cuts(light, targets, propensity=None):
    """(Rows (source, source_size, target, whole, part, cuts), small): how often each document is taken.

    Every document is taken `whole` times for certain, and once more if one of the `cuts` (limit, bin, rank) holds it: its
    size is within the limit and its rank not behind the cut. The first cut is the sample: ranks in order as long as their
    words fit the target. FILLS further cuts do the same with what is left and the documents no longer than
    that; the last one may go beyond the target if that comes nearer. Equal ranks go together. Only the bin in
    which a cut lies is sorted. `light` has (source, size, draw); `small` tells that sources are few enough to broadcast.
    """
    small = targets.count() <= BROADCAST_SOURCES
    some = F.col("source_size") > 0
    whole = F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    plan = targets.withColumn("whole", whole)
    plan = plan.withColumn("part", F.when(some, F.col("target") / F.col("source_size") - F.col("whole")).otherwise(0.0))
    plan = plan.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = plan.withColumn("cuts", F.array().cast("array<struct<limit:bigint,bin:int,rank:double>>"))
    so_far = Window.partitionBy("source").rowsBetween(Window.unboundedPreceding, 0)
    for fill in range(FILLS + 1):
        limit = F.floor("left").cast("bigint") if fill else F.lit((1 << 63) - 1)
        free = _ranked(of_source(light, plan, small), propensity).filter(
            (F.col("part") > 0) & ~_taken() & (F.col("size") <= limit)
        )
        bins = free.groupBy("source", "left", "bin").agg(F.sum("size").alias("size"))
        bins = bins.withColumn("upto", F.sum("size").over(so_far.orderBy("bin")))
        ends = bins.filter(F.col("upto") > F.col("left")).groupBy("source").agg(
            F.min(F.struct("bin", (F.col("upto") - F.col("size")).alias("before"))).alias("end")
        )
        all_words = bins.groupBy("source").agg(F.max("upto").alias("all"))
        plan = of_source(of_source(plan, ends, small, "left"), all_words, small, "left")
        # Without a bin that goes beyond what is left, all free documents are taken.
        plan = stage(plan.select(
            *targets.columns, "whole", "part", "left", "cuts",
            F.when(F.col("part") > 0, F.coalesce("end.bin", F.lit(BINS + 1))).otherwise(-1).alias("end_bin"),
            F.coalesce("end.before", "all", F.lit(0)).alias("before"),
        ), "mix-ends")
        limit = F.floor("left").cast("bigint") if fill else F.lit((1 << 63) - 1)
        last = _ranked(of_source(light, plan, small), propensity).filter(
            (F.col("part") > 0) & ~_taken() & (F.col("size") <= limit) & (F.col("bin") == F.col("end_bin"))
        )
        steps = last.groupBy("source", "rank", "before", "left").agg(F.sum("size").alias("size")).withColumn(
            "upto", F.col("before") + F.sum("size").over(so_far.orderBy("rank"))
        )
        if fill < FILLS:
            steps = steps.filter(F.col("upto") <= F.col("left")).groupBy("source").agg(
                F.max(F.struct("rank", "upto")).alias("best")
            )
        else:
            off = lambda words: F.abs(F.col(words) - F.col("left"))
            steps = steps.filter(off("upto") < off("before")).withColumn("off", off("upto")).groupBy("source").agg(
                F.min_by(F.struct("rank", "upto"), F.struct("off", "rank")).alias("best")
            )
        plan = of_source(plan, steps, small, "left")
        plan = stage(plan.select(
            *targets.columns, "whole", "part",
            (F.col("left") - F.coalesce("best.upto", "before")).alias("left"),
            F.concat("cuts", F.array(F.struct(
                limit.alias("limit"), F.col("end_bin").alias("bin"), F.coalesce("best.rank", F.lit(-1.0)).alias("rank")
            ))).alias("cuts"),
        ), "mix-cuts")
    return plan.drop("left"), small


def of_source(rows, table, small, how="inner"):
    """`rows` with the columns of a table of one row for each source; `small` tables are broadcast, others joined by shuffles."""
    named = table.withColumnRenamed("source", "its source")
    named = F.broadcast(named) if small else named
    return rows.join(named, rows["source"].eqNullSafe(named["its source"]), how).drop("its source")


def rated(docs, id_col="doc_id", text="text", source="source", propensity=None, weights=WEIGHTS, limit=LIMIT, seed=SEED):
    """The document rows with size, source_size, target (of the source) and copies: how often the mix takes the document.

    Sizes are words; a null text has none. Input columns of these names are replaced. The draw depends on seed, id and text, so
    reruns agree; rows of one id (or without) are drawn apart unless their texts are alike too. `propensity` names a column of factors
    on the inclusion probability of a document within its source; without it all documents of a source are equally
    likely. Documents of a null source form a source. A source without words has target 0.
    """
    light = docs.select(
        F.col(source).alias("source"), words(F.col(text)).alias("size"), draw(id_col, text, seed).alias("draw"),
        *([F.col(propensity)] if propensity else []),
    )
    light = stage(light, "mix-light")
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan, small = cuts(light, stage(allot(sizes, weights, limit), "mix-targets"), propensity)

    names = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "copies")]
    inner = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], F.col(source).alias("source"), words(F.col(text)).alias("size"),
                        draw(id_col, text, seed).alias("draw"), *([F.col(propensity)] if propensity else []))
    ranked = _ranked(of_source(inner, plan, small), propensity)
    return ranked.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "size", "source_size", "target",
        (F.col("whole") + _taken().cast("int")).alias("copies"),
    )


def mix(docs, **options):
    """The document rows as often as the mix takes them, with their columns."""
    names = docs.columns
    found = rated(docs, **options).filter("copies > 0")
    copies = found.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return copies.select(*names)
