"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionrank.llm.common import stage

SHARDS, SEED = 8, 42
# Rows are dealt to so many slots by a hash; neighbouring slots make up local partitions of about PART_ROWS rows.
SLOTS = 1 << 16
PART_ROWS = 2000
# So many copies of a row are listed at a time.
COPIES = 1 << 16


def hypergeometric(good, bad, drawn, random):
    """How many of `drawn` objects, taken without return from `good` and `bad` ones, are good. Exact for any size.

    Inverts the distribution on the values within 12 standard deviations of its mode (the rest has less weight than a
    double can tell).
    """
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    spread = (drawn * (good / total) * (bad / total) * ((total - drawn) / max(1, total - 1))) ** 0.5
    reach = int(12 * spread) + 12
    k = np.arange(max(low, mode - reach), min(high, mode + reach), dtype=np.float64)
    steps = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weight = np.cumsum(np.exp(logs - logs.max()))
    return int(k[0]) + int(np.searchsorted(weight, random.random() * weight[-1], "right"))


def matrix(parts, shards, seed=SEED):
    """The numbers of rows (part, shard) that a uniform shuffle of parts of the given sizes into `shards` moves.

    Shard sizes are as equal as can be, the first ones a row larger. Part by part, the rows still to be dealt are split
    among what the shards still lack.
    """
    random = np.random.default_rng(seed)
    total = int(sum(parts))
    lack = [total // shards + (s < total % shards) for s in range(shards)]
    out = []
    for n in parts:
        row, left, rest = [], int(n), sum(lack)
        for s in range(shards):
            rest -= lack[s]
            x = hypergeometric(lack[s], rest, left, random)
            row.append(x)
            left -= x
        lack = [a - x for a, x in zip(lack, row)]
        out.append(row)
    return out


def _copies(counted):
    """Rows (h1, h2, copy) with copies 1 to n of each row (h1, h2, n), in two steps so that no long list is built."""
    n, block = F.col("n"), F.col("block")
    blocks = counted.select("h1", "h2", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / COPIES))).alias("block"))
    return blocks.select("h1", "h2", F.explode(F.sequence(block * COPIES + 1, F.least(n, (block + 1) * COPIES))).alias("copy"))


def shuffle(docs, id_col="doc_id", text="text", shards=SHARDS, seed=SEED, part_rows=PART_ROWS):
    """The rows with columns shard (0 to shards - 1) and slot (0, 1, ... within the shard), dealt uniformly at random.

    Shard sizes differ by one row at most. Rows equal in all columns are counted and their copies numbered. Rows are dealt to
    local partitions by a hash of the row and its number; the matrix draws how many of each partition's rows go to each
    shard; a random order within the partition says which; and a second random order within the shard gives the slots;
    rows are then exchanged. All random orders are seeded hashes of row and number, so copies are dealt as
    independently as other rows, rows that share an id (or have none) are spread, a lost task gets the same rows again and
    reruns agree. Only 128-bit hashes of rows are ordered; texts move twice, to their equals and to their shard's cell.
    Input columns named shard or slot are replaced. The driver holds the sizes of at most 65,536 partitions.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    at = {c: f"c{i}" for i, c in enumerate(names)}
    flat = [x for c in (id_col, text, *(c for c in names if c not in (id_col, text))) for x in (F.isnull(f"`{c}`"), F.col(f"`{c}`"))]
    h1, h2 = (F.xxhash64(F.lit(what), *flat).alias(what) for what in ("h1", "h2"))
    key = lambda what: F.xxhash64(F.lit(f"{what} {seed}"), F.col("h1"), F.col("copy"))
    copy = ("h1", "h2", "copy")
    light = _copies(stage(docs.select(h1, h2).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")), "rows"))
    slot = F.pmod(key("part"), F.lit(SLOTS)).cast("int").alias("hash slot")
    counts = np.zeros(SLOTS, np.int64)
    for s, n in light.groupBy(slot).agg(F.count(F.lit(1))).collect():  # SLOTS rows at most
        counts[s] = n
    total = int(counts.sum())
    n_parts = max(1, min(SLOTS, total // part_rows))
    parts = np.bincount(np.arange(SLOTS) * n_parts // SLOTS, counts, n_parts).astype(np.int64)
    dealt = [(p, np.cumsum(row).tolist()) for p, row in enumerate(matrix(parts.tolist(), shards, seed))]
    table = F.broadcast(spark.createDataFrame(dealt, "part int, upto array<bigint>"))  # one row for each partition

    cells = max(1, min(SLOTS // shards, total // (shards * part_rows)))
    in_part = Window.partitionBy("part").orderBy(key("first"), *copy)
    part = F.floor(F.pmod(key("part"), F.lit(SLOTS)) * F.lit(n_parts) / SLOTS).cast("int")
    ranked = light.withColumn("part", part).withColumn("place", F.row_number().over(in_part)).join(table, "part")
    shard = F.size(F.filter("upto", lambda n: n < F.col("place")))
    labelled = stage(ranked.select(*copy, shard.alias("shard"), F.pmod(key("cell"), F.lit(cells)).cast("int").alias("cell")), "dealt")

    sizes = labelled.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n")).collect()  # shards x cells rows
    lead, found = {}, {(s, c): n for s, c, n in sizes}
    for s in range(shards):
        n = 0
        for c in range(cells):
            lead[s, c] = n
            n += found.get((s, c), 0)
    leads = F.broadcast(spark.createDataFrame([(s, c, n) for (s, c), n in lead.items()], "shard int, cell int, lead bigint"))

    in_cell = Window.partitionBy("shard", "cell").orderBy(key("second"), *copy)
    placed = labelled.withColumn("rank", F.row_number().over(in_cell)).join(leads, ["shard", "cell"])
    placed = placed.select("h1", "h2", "shard", "cell", (F.col("lead") + F.col("rank") - 1).alias("slot"))
    whole = docs.select(h1, h2, *[F.col(f"`{c}`").alias(at[c]) for c in names]).groupBy("h1", "h2").agg(
        *[F.first(at[c]).alias(at[c]) for c in names]  # equal rows are alike
    )
    out = whole.join(placed, ["h1", "h2"]).repartition("shard", "cell").sortWithinPartitions("shard", "slot")
    return out.select(*[F.col(at[c]).alias(c) for c in names], "shard", "slot")
