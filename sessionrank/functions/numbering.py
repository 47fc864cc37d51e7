"""Global numbering without a global sort.

A window without partitions runs in one task. The helpers here get the same numbers from
windows whose groups have a known size limit, whatever the distribution of the keys.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionrank.functions.staging import materialize

# Keys are split into digits of this many bits, so no window group exceeds 2**16 rows.
_DIGIT_BITS = 16


def exclusive_prefix(df, key, value, low, high):
    """Rows (key, prefix): sum of `value` over all rows with a smaller key.

    `key` is a unique integer column within [low, high]. Each key belongs to a parent, the
    key without its last 16 bits; sums run inside a parent, and the parents' own totals are
    numbered the same way, one level up, until a single parent is left.
    """
    digits = df.select((F.col(key) - F.lit(low)).alias("k"), F.col(value).alias("v"))
    levels = max(1, -(-int(high - low).bit_length() // _DIGIT_BITS))
    return _prefix(digits, levels).select(
        (F.col("k") + F.lit(low)).alias(key), F.col("prefix")
    )


def _prefix(digits, levels):
    if levels > 1:
        digits = materialize(digits, "prefix")
    nested = digits.withColumn("parent", F.shiftright("k", _DIGIT_BITS))
    before = Window.partitionBy("parent").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    inside = nested.select(
        "k", "parent", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("inside")
    )
    if levels == 1:
        return inside.select("k", F.col("inside").alias("prefix"))
    totals = nested.groupBy(F.col("parent").alias("k")).agg(F.sum("v").alias("v"))
    above = _prefix(totals, levels - 1).select(
        F.col("k").alias("parent"), F.col("prefix").alias("above")
    )
    return inside.join(above, "parent").select("k", (F.col("above") + F.col("inside")).alias("prefix"))


def dense_index(df, key, out):
    """Rows (key, out): 0-based index of each distinct key in ascending order."""
    keys = materialize(df.select(key).distinct(), "keys")
    low, high = keys.agg(F.min(key), F.max(key)).first()
    if low is None:
        return keys.withColumn(out, F.lit(0).cast("bigint"))
    ones = keys.withColumn("one", F.lit(1).cast("bigint"))
    return exclusive_prefix(ones, key, "one", low, high).withColumnRenamed("prefix", out)


def ordered_prefix(df, order, **values):
    """`df` with, for each `name=column`, the sum of the column over all rows before in the order of the columns `order`.

    The order must be total (no two rows alike in it); it may be of any types. Rows are dealt out by ranges of it, written with the number
    of their task, and summed within the task; the tasks' own totals, one row for each, are added up in the driver.
    """
    names = df.columns
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(dealt.withColumn("its task", F.spark_partition_id()), "ranges")
    totals = placed.groupBy("its task").agg(*[F.sum(c).alias(n) for n, c in values.items()]).collect()
    lead, leads = dict.fromkeys(values, 0), []
    for row in sorted(totals, key=lambda r: r["its task"]):
        leads.append((row["its task"], *lead.values()))
        lead = {n: lead[n] + (row[n] or 0) for n in values}
    schema = "`its task` int, " + ", ".join(f"`{n}` {placed.schema[c].dataType.simpleString()}" for n, c in values.items())
    leads = df.sparkSession.createDataFrame(leads, schema)
    before = Window.partitionBy("its task").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.select(*names, "its task", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{n} inside") for n, c in values.items()])
    return inside.join(F.broadcast(leads), "its task").select(
        *names, *[(F.col(n) + F.col(f"{n} inside")).alias(n) for n in values]
    )


def frequencies(df, value):
    """Rows (value, freq): how often each value occurs."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("freq"))


def count_quantiles(df, value, probabilities):
    """One row, column `q`: exact quantiles (linear interpolation) of a column of counts.

    Counts that add up to N rows take at most sqrt(2N) distinct values, so the aggregate
    that holds one entry per distinct value stays small when fed with frequencies.
    """
    return frequencies(df, value).agg(
        F.percentile(value, list(probabilities), F.col("freq")).alias("q")
    )


def count_ranks(df, value, out):
    """Rows (value, out): 1 + number of rows with a larger value, per distinct value."""
    freq = materialize(frequencies(df, value).dropna(), "frequencies")
    low, high = freq.agg(*(F.coalesce(f(value), F.lit(0)) for f in (F.min, F.max))).first()
    falling = freq.select((-F.col(value)).alias("falling"), "freq")
    above = exclusive_prefix(falling, "falling", "freq", -high, -low)
    return above.select((-F.col("falling")).alias(value), (F.lit(1) + F.col("prefix")).alias(out))


def exact_quantiles(df, columns, probabilities):
    """Rows (column_name, q): exact quantiles (linear interpolation) of integer columns, nulls left out.

    The columns are unpivoted, values are counted once, and one prefix sum over (column, value) gives each value's
    place in its sorted column; only the values that cover a wanted place are kept. Nothing is sorted in one task.
    The range of the values times the number of columns must fit a bigint.
    """
    long = df.select(F.inline(F.array(*(
        F.struct(F.lit(i).cast("bigint").alias("c"), F.col(c).cast("bigint").alias("v")) for i, c in enumerate(columns)
    )))).filter(F.col("v").isNotNull())
    freq = materialize(long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("freq")), "frequencies")
    low, high = freq.agg(*(F.coalesce(f("v"), F.lit(0)) for f in (F.min, F.max))).first()
    width = high - low + 1
    keyed = freq.withColumn("key", F.col("c") * F.lit(width) + F.col("v") - F.lit(low))
    prefix = exclusive_prefix(keyed, "key", "freq", 0, width * len(columns) - 1)
    placed = keyed.join(prefix, "key")
    sizes = freq.groupBy("c").agg(F.sum("freq").alias("n"))
    # Places count from the first value of the column: the prefix less that of the columns before.
    before = placed.groupBy("c").agg(F.min("prefix").alias("lead"))
    ranged = placed.join(before.join(sizes, "c"), "c")
    at = F.col("prefix") - F.col("lead")
    picks = []
    for p in probabilities:
        place = F.lit(p) * (F.col("n") - 1)
        floor = F.floor(place)
        lower, upper = (
            F.max(F.when((at <= pos) & (pos < at + F.col("freq")), F.col("v"))).cast("double")
            for pos in (floor, F.least(floor + 1, F.col("n") - 1))
        )
        picks.append(lower + (upper - lower) * F.max(place - floor))
    found = ranged.groupBy("c").agg(F.array(*picks).alias("q"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "c bigint, column_name string")
    return names.join(found, "c", "left").select("column_name", "q")
