"""Merkle dataset manifest: a content-addressed DAG of digests, proofs by descent from the root.

Every row is a leaf. The leaves of a group (a source), in order, are hashed in runs of FAN until one node, the group's
subroot, is left; the subroots, in the order of their groups, likewise give the root. The manifest stores a record
(digest, children) for every inner node. A proof is found by descending from the root: the digits (base FAN) of a leaf's rank
choose a child at each record, the others are collected, and the collected segments are reversed.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionrank.functions.skew import hot_keys, salted_join
from sessionrank.llm.common import stage

FAN_BITS = 4
FAN = 1 << FAN_BITS
# Copies of a row are listed so many at a time, so that no task builds a long list.
COPIES = 1 << 16
# A digest that more than so many frontier rows share (runs of equal leaves) has its rows split among tasks.
HOT_DIGEST = 100_000


def digest_of(*columns):
    """Lowercase hex sha256 of the values in a row: `-` for null, else UTF-8 byte count, `:`, value; integers in decimal."""
    def part(column):
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)), 256)


def group_key(column):
    """A string that sorts as the group does: null first, then UTF-8 bytewise."""
    return F.coalesce(F.concat(F.lit("1"), column.cast("string")), F.lit("0"))


@dataclass
class Manifest:
    """leaves (g, rank, total, digest, ...), records (digest, children), subroots (g, top, height, digest), root (None without leaves)."""

    leaves: DataFrame
    records: DataFrame
    subroots: DataFrame
    heights: tuple
    root: str


# ---------------------------------------------------------------- ranks

def numbered(rows, order):
    """`rows` (with a string column g) with rank, the place in the group by the columns `order`, and total, the group's size.

    Equal rows are counted and their copies listed after sorting. Rows are dealt out by ranges of (g, order), so a
    group that holds most rows is spread over many tasks; each task numbers its rows as they come, and a small table with one row for
    each (task, group) says where its rows begin. Nothing is numbered in a single task.
    """
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    # blocks of copies are rows of their own, so that ranges split them too
    blocks = counted.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / COPIES))))
    blocks = stage(blocks, "merkle-rows")
    keys = ["g", *order, *(c for c in names if c != "g" and c not in order), "block"]
    sorted_rows = blocks.repartitionByRange(*keys).sortWithinPartitions(*keys)
    many = F.least(F.lit(COPIES), F.col("n") - F.col("block") * COPIES).cast("int")
    listed = sorted_rows.select(*names, F.explode(F.sequence(F.lit(1), many)).alias("copy"))
    placed = stage(listed.select(*names, F.monotonically_increasing_id().alias("place")), "merkle-order")
    placed = placed.withColumn("task", F.shiftright("place", 33))
    starts = placed.groupBy("task", "g").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    # one row for each task that holds rows of the group
    group = Window.partitionBy("g").orderBy("task")
    before = F.coalesce(F.sum("n").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    starts = stage(starts.select("task", "g", (before - F.col("first")).alias("shift"), total.alias("total")), "merkle-starts")
    return placed.join(starts, ["task", "g"]).select(*names, (F.col("place") + F.col("shift")).alias("rank"), "total")


# ---------------------------------------------------------------- build

def _levels(nodes):
    """(records, tops, height): the records above the nodes (g, rank, total, digest), the last node of each g, and the levels built."""
    largest = nodes.agg(F.max("total")).first()[0] or 0
    records, tops, height = [], [nodes.filter("total = 1").select("g", F.lit(0).alias("height"), "digest")], 0
    while largest > 1:
        height += 1
        children = F.transform(F.array_sort(F.collect_list(F.struct("rank", "digest"))), lambda x: x["digest"])
        runs = nodes.filter("total > 1").groupBy("g", F.shiftright("rank", FAN_BITS).alias("rank")).agg(
            F.max("total").alias("total"), children.alias("children")
        )
        built = stage(runs.select(
            "g", "rank", F.floor((F.col("total") + (FAN - 1)) / FAN).alias("total"), "children",
            F.sha2(F.array_join("children", ""), 256).alias("digest"),
        ), "merkle-level")
        records.append(built.select("digest", "children"))
        nodes = built.select("g", "rank", "total", "digest")
        tops.append(nodes.filter("total = 1").select("g", F.lit(height).alias("height"), "digest"))
        largest = -(-largest // FAN)
    return records, tops, height


def _all(tables):
    out = tables[0]
    for t in tables[1:]:
        out = out.unionAll(t)
    return out


def build(leaves, order):
    """The Manifest of leaves (g, digest, more columns), ordered within g by the columns `order`, ties by all others.

    The driver holds the root and the number of levels. Without leaves the root is None.
    """
    ranked = stage(numbered(leaves, order), "merkle-leaves")
    records, tops, height = _levels(ranked.select("g", "rank", "total", "digest"))
    groups = numbered(_all(tops).withColumn("name", F.col("g")).withColumn("g", F.lit("")), ["name"])
    subroots = stage(groups.select(F.col("name").alias("g"), F.col("rank").alias("top"), "total", "height", "digest"), "merkle-subroots")
    more, top, top_height = _levels(subroots.select(F.lit("").alias("g"), F.col("top").alias("rank"), "total", "digest"))
    found = _all(top).first()
    records += more
    if not records:
        records = [leaves.sparkSession.createDataFrame([], "digest string, children array<string>")]
    unique = stage(_all(records).groupBy("digest").agg(F.first("children").alias("children")), "merkle-records")
    return Manifest(ranked, unique, subroots.drop("total"), (height, top_height), found and found["digest"])


# ---------------------------------------------------------------- proofs

def _segment(children, at):
    """What stands left and right of child number `at` (from 0) in a run."""
    return F.struct(
        F.array_join(F.slice(children, F.lit(1), at), "").alias("left"),
        F.array_join(F.slice(children, at + 2, F.lit(FAN)), "").alias("right"),
    )


def _looked_up(frontier, records):
    """The frontier rows with the children of their digests."""
    hot = hot_keys(frontier, "digest", HOT_DIGEST) if frontier.count() > HOT_DIGEST else None
    return salted_join(frontier, records, ["digest"], "inner", hot, "digest", ["rank"])


def _descend(frontier, records, wanted):
    """One level down: each frontier row (rank, digest, path, ...) looks up its record and goes on to its children."""
    found = _looked_up(frontier, records)
    others = [c for c in frontier.columns if c not in ("rank", "digest", "path")]
    each = found.select(*others, "rank", "path", "children", F.posexplode("children").alias("at", "child"))
    down = each.select(
        *others, (F.col("rank") * FAN + F.col("at")).alias("rank"), F.col("child").alias("digest"),
        F.concat("path", F.array(_segment(F.col("children"), F.col("at")))).alias("path"),
    )
    return stage(down if wanted is None else down.join(wanted, [c for c in wanted.columns], "left_semi"), "merkle-frontier")


def prove(manifest, requests=None):
    """Rows of the requested leaves (by default all) with subroot and path: segments (left, right) from the leaf to the root.

    `requests` holds (g, rank) rows and more columns, such as the manifest's leaves or some of them. All requests descend together,
    those that share their first digits as one row, so a level's frontier has at most one row for each of its nodes.
    Requests of places that no leaf has get no row.
    """
    spark = manifest.records.sparkSession
    every = requests is None
    requests = manifest.leaves if every else requests
    height, top_height = manifest.heights

    def wanted(level):
        if every:
            return None
        return requests.select("g", F.shiftright("rank", FAN_BITS * level).alias("rank")).distinct()

    schema = "rank bigint, digest string, path array<struct<left:string,right:string>>"
    frontier = spark.createDataFrame([(0, manifest.root, [])] if manifest.root else [], schema)
    for level in reversed(range(top_height)):
        asked = None
        if not every:
            tops = manifest.subroots.join(requests.select("g").distinct(), "g", "left_semi")
            asked = tops.select(F.shiftright("top", FAN_BITS * level).alias("rank")).distinct()
        frontier = _descend(frontier, manifest.records, asked)
    subroots = frontier.select(F.col("rank").alias("top"), "path").join(manifest.subroots, "top")
    subroots = stage(subroots.select("g", "height", F.lit(0).cast("bigint").alias("rank"), "digest", F.col("digest").alias("subroot"), "path"), "merkle-tops")
    enter = lambda level: subroots.filter(F.col("height") == level).drop("height")
    frontier = enter(height)
    for level in reversed(range(1, height)):
        frontier = _descend(frontier, manifest.records, wanted(level)).unionByName(enter(level))

    # the last level of each leaf: its run of up to FAN leaves, or nothing if it is its own subroot
    at = F.col("rank").bitwiseAND(F.lit(FAN - 1)).cast("int")
    none = F.array().cast("array<struct<left:string,right:string>>")
    runs = enter(0).select("g", F.col("rank").alias("run"), "subroot", "path", F.lit(None).cast("array<string>").alias("children"))
    if height:
        below = _looked_up(frontier, manifest.records)
        runs = runs.unionAll(below.select("g", F.col("rank").alias("run"), "subroot", "path", "children"))
    own = F.when(F.col("children").isNull(), none).otherwise(F.array(_segment(F.col("children"), at)))
    rows = requests.withColumn("run", F.shiftright("rank", FAN_BITS)).join(runs, ["g", "run"])
    return rows.filter(at < F.coalesce(F.size("children"), F.lit(1))).select(
        *requests.columns, "subroot", F.concat(own, F.reverse("path")).alias("path")
    )


def siblings(path):
    """All siblings of a path's segments as one text, leaf to root, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf, path):
    """The root that a leaf's digest and a path lead to."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


# ---------------------------------------------------------------- documents

def audit(docs, tampered, where, fields=("doc_id", "source", "lang", "n_chars", "text"), id_col="doc_id", source="source"):
    """Rows (id, leaf, subroot, root, path, folded_root, verified), one for each document row: proofs checked after tampering.

    A leaf is the digest of `fields`; groups are sources (null is one, first in order), leaves ascend by id, null ids
    first, equal ids by leaf. Rows for which `where` holds are tampered with: `tampered` maps names of fields to the expressions that
    replace them. The folded root comes from the tampered row's leaf and the original siblings; verified tells whether it is the root. Repeated rows are leaves of their own, next to each other.
    Texts are read once and leave their task as digests. Other columns play no part. An empty table gives no rows.
    """
    changed = [tampered.get(f, F.col(f"`{f}`")) for f in fields]
    leaves = docs.select(
        group_key(F.col(f"`{source}`")).alias("g"), F.col(f"`{id_col}`").alias("id"),
        digest_of(*[F.col(f"`{f}`") for f in fields]).alias("digest"), F.when(where, digest_of(*changed)).alias("changed"),
    )
    manifest = build(leaves, ["id", "digest"])
    found = prove(manifest).withColumn("folded", fold(F.coalesce("changed", "digest"), F.col("path")))
    return found.select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", F.lit(manifest.root).alias("root"), "path",
        F.col("folded").alias("folded_root"), (F.col("folded") == F.lit(manifest.root)).alias("verified"),
    )
