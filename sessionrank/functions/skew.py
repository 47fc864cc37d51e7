"""Joins on keys of which a few may hold a large share of the rows."""

from pyspark.sql import functions as F

from sessionrank.functions.staging import materialize, on_deletion

# Rows of one key that a task may sort; a key with more is hot, whatever the size of the table.
HOT_ROWS = 1_000_000
# Tables of hot keys of up to so many rows (16 bytes each) are broadcast, larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000

_known = []
# What was found lies in stage tables, which the end of a scope deletes.
on_deletion.append(_known.clear)


class HotKeys:
    """The hot keys of a column: a stage table (key, parts), parts being the number of tasks to split a key's rows into."""

    def __init__(self, table, key, n):
        self.table, self.key, self.n = table, key, n

    def named(self, key):
        """The same for a column of another name."""
        return HotKeys(self.table.withColumnRenamed(self.key, key), key, self.n)

    def hinted(self):
        """The table, broadcast if it is small."""
        return F.broadcast(self.table) if self.n <= BROADCAST_ROWS else self.table


def hot_keys(df, key, hot_rows=HOT_ROWS):
    """The HotKeys of a column, None if no key has more than `hot_rows` rows.

    Keys are counted once per table and column: what was found is kept and found again for an equal plan, so
    operators that share a stage table share the count, until a scope of stage tables ends. (An outdated table costs time, never a row.)
    """
    column = df.select(F.col(key).alias("key"))
    for seen, limit, found in _known:
        if limit == hot_rows and seen.sparkSession is df.sparkSession and seen.sameSemantics(column):
            return found and found.named(key)
    counts = column.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > hot_rows) & F.col("key").isNotNull())
    parts = materialize(counts.select("key", F.ceil(F.col("n") / hot_rows).cast("int").alias("parts")), "hot-keys")
    n = parts.count()
    found = HotKeys(parts, "key", n) if n else None
    _known.append((column, hot_rows, found))
    del _known[:-64]
    return found and found.named(key)


def salted_join(left, right, keys, how, hot, hot_key, spread):
    """`left.join(right, keys, how)` with the left rows of hot keys split into parts.

    `hot` comes from `hot_keys` on column `hot_key`. The left rows of a hot key are dealt
    out by a hash of `spread`; the right rows of that key are repeated once per part.
    """
    keys = list(keys)
    if hot is None:
        return left.join(right, keys, how)
    parts = hot.named(hot_key).hinted()
    dealt = (
        left.join(parts, hot_key, "left")
        .withColumn("part", F.coalesce(
            F.pmod(F.xxhash64(*spread), F.col("parts")), F.lit(0)
        ).cast("int"))
        .drop("parts")
    )
    repeated = (
        right.join(parts, hot_key, "left")
        .withColumn("part", F.explode(
            F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
        ))
        .drop("parts")
    )
    joined = dealt.join(repeated, [*keys, "part"], how).drop("part")
    extra = [c for c in right.columns if c not in keys]
    return joined.select(*left.columns, *extra) if how in ("left", "inner") else joined
