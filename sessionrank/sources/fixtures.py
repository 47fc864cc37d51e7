"""The interaction logs, items and vectors contained in the benchmark tables."""

from collections import namedtuple

from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
DAY = 86_400 * MICROS_PER_SECOND

# events: (user_id, item_id, timestamp in microseconds, *ties)
Log = namedtuple("Log", "events gap ties")


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _micros(column):
    # The tables hold times without zone, taken as UTC whatever the session's time zone is.
    time = F.col(column)
    seconds = F.hour(time) * 3600 + F.minute(time) * 60
    rest = F.extract(F.lit("SECOND"), time) * MICROS_PER_SECOND
    return F.unix_date(time.cast("date")) * F.lit(DAY) + seconds.cast("bigint") * MICROS_PER_SECOND + rest.cast("bigint")


def dense_log(spark, folder):
    """Clicks on 100 items: `events`, item from the JSON properties; gap one day."""
    events = _table(spark, folder, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        _micros("ts").alias("timestamp"),
        "event_id",
    )
    return Log(events, DAY, ("event_id",))


def sparse_log(spark, folder):
    """Purchases of parts: `lineitem` with the order's customer and date; gap 180 days."""
    ties = (
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
    )
    orders = _table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("user_id"),
        _micros("o_orderdate").alias("timestamp"),
    )
    events = (
        _table(spark, folder, "lineitem").select(*ties)
        .join(orders, "l_orderkey")
        .withColumn("item_id", F.col("l_partkey"))
    )
    return Log(events, 180 * DAY, ties)


def items(spark, folder):
    """Item metadata from `part`: type and the words of the name serve as genres."""
    genres = F.concat_ws("|", F.lower("p_type"), F.replace("p_name", F.lit(" "), F.lit("|")))
    return (
        _table(spark, folder, "part")
        .select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("title"),
            genres.alias("genres"),
        )
        .withColumn("genre_list", F.split("genres", r"\|"))
    )


def item_vectors(spark, folder):
    """Item factors (id, features) from `embeddings`."""
    return _table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features")
    )
