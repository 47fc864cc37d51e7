"""Boosted trees grown leaf by leaf from histograms of first and second derivatives of the log loss.

Features are binned once, and bins that go together are kept as one code: features of the same item have few different combinations, so
that one histogram by code gives those of all of them. Rows are kept in blocks, each a row of the stage table. A pass over them adds up gradients
and hessians by (leaf, code) in its tasks, a shuffle by leaf brings the tasks' histograms together, and the best split of each feature is found
there; one row for each comes back.
Sums are of integers, so trees do not depend on the order of rows. Trees are best-first up to `leaves`
leaves: each pass looks at the children of all leaves that would be split by what is known, until nothing unknown can
change the choice, so a tree takes about as many passes as it is deep, not one for each split. Once the leaves to be split have no
more than TASK_ROWS rows each, one more pass brings the rows of each together in a task, which finds all splits below it. Where the whole
table has no more, a tree is one pass.
"""

import heapq
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionrank import schemas
from sessionrank.functions.numbering import ordered_prefix
from sessionrank.functions.staging import discard, materialize, stage_path

# Derivatives are summed as multiples of 1 / SCALE.
SCALE = 1 << 30
# Rows of a file of the binned table: the first number at least, the second at most where there is a task for every core.
FEW_ROWS, MANY_ROWS = 1 << 15, 1 << 20
# A node of so many sampled rows or fewer is split further in one task, which holds about 50 bytes of each.
TASK_ROWS = 1 << 22
# Rows of a block.
BLOCK_ROWS = 1 << 16
# Different combinations of bins that a code stands for, at most, and rows by which features are tried together.
MOST_CODES, TRIED_ROWS = 1 << 12, 1 << 15
# Different values of a feature that a task counts before it hands them on.
_VALUES = 1 << 20


@dataclass(frozen=True)
class Settings:
    """The published settings of the ranker."""

    rounds: int = 500
    patience: int = 30
    leaves: int = 63
    rate: float = 0.05
    l1: float = 0.05
    l2: float = 0.05
    min_rows: int = 20
    min_hessian: float = 1e-3
    feature_share: float = 0.8
    row_share: float = 0.8
    # One sample of rows serves so many rounds.
    bag_rounds: int = 5
    bins: int = 255
    seed: int = schemas.SEED


@dataclass
class Tree:
    """Inner nodes by number, children below 0 being leaves (-1 is leaf 0); all arrays are plain numpy arrays."""

    feature: np.ndarray
    threshold: np.ndarray
    cut: np.ndarray  # the last bin that goes left; of no use for trees read from files
    left: np.ndarray
    right: np.ndarray
    gain: np.ndarray
    rows: np.ndarray
    hessian: np.ndarray
    output: np.ndarray
    leaf_value: np.ndarray
    leaf_rows: np.ndarray
    leaf_hessian: np.ndarray
    # By inner node, of files alone: where missing values go, and what is missing (0 nothing: NaN counts as 0; 1 zeros, 2 NaN).
    default_left: np.ndarray = None
    missing: np.ndarray = None
    shrinkage: float = 1.0

    def leaves_of(self, goes_left, n):
        """The leaf of each of n rows; goes_left(rows, nodes) decides."""
        at = np.zeros(n, np.int64) if len(self.feature) else np.full(n, -1)
        todo = np.flatnonzero(at >= 0)
        while len(todo):
            node = at[todo]
            at[todo] = np.where(goes_left(todo, node), self.left[node], self.right[node])
            todo = todo[at[todo] >= 0]
        return -1 - at

    def of_values(self, x):
        """The values of rows of feature values."""
        def goes_left(rows, node):
            v, kind = x[rows, self.feature[node]], self.missing[node]
            blank = np.isnan(v)
            v = np.where(blank, 0.0, v)
            lost = np.where(kind == 2, blank, (kind == 1) & (np.abs(v) <= 1e-35))
            return np.where(lost, self.default_left[node], v <= self.threshold[node])

        return self.leaf_value[self.leaves_of(goes_left, len(x))]


@dataclass
class Booster:
    """Trees whose values add up to the log odds; `history` has (round, auc, loss, train_loss) of the rounds fitted."""

    features: list
    trees: list
    history: list = field(default_factory=list)

    def score(self, matrix):
        """Adds `score`, the probability of a positive label."""
        trees = self.trees
        if not self.features:
            return matrix.withColumn("score", F.lit(float(_sigmoid(sum(float(t.leaf_value[0]) for t in trees)))))

        @F.arrow_udf("double")
        def probability(x: pa.Array) -> pa.Array:
            rows = _matrix_of(x)
            return pa.array(_sigmoid(sum((t.of_values(rows) for t in trees), np.zeros(len(rows)))))

        return matrix.withColumn("score", probability(_values(self.features)))

    def nodes(self, spark):
        """Rows (tree, node, feature, threshold, left, right, gain, rows, value): inner nodes from 0 on, leaf k as node -1 - k."""
        rows = []
        for i, t in enumerate(self.trees):
            rows += [
                (i, k, self.features[t.feature[k]], float(t.threshold[k]), int(t.left[k]), int(t.right[k]), float(t.gain[k]), int(t.rows[k]), float(t.output[k]))
                for k in range(len(t.feature))
            ]
            rows += [(i, -1 - k, None, None, None, None, None, int(t.leaf_rows[k]), float(v)) for k, v in enumerate(t.leaf_value)]
        return spark.createDataFrame(rows, NODES)

    def total_gain(self, spark):
        """Rows (feature, importance): the gains of all splits of a feature added up, 0 for features without one."""
        used = self.nodes(spark).groupBy("feature").agg(F.sum("gain").alias("gain"))
        names = spark.createDataFrame([(n,) for n in self.features], "feature string")
        return names.join(used, "feature", "left").select("feature", F.coalesce("gain", F.lit(0.0)).alias("importance"))


NODES = "tree int, node int, feature string, threshold double, `left` int, `right` int, gain double, rows bigint, value double"


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def _values(features):
    """The features of a row as doubles; null as NaN."""
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in features])


def _matrix_of(lists):
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


# ---------------------------------------------------------------- bins

def bin_edges(matrix, features, bins):
    """{number of the feature: upper edges of its bins but the last}: what lies midway between the values of neighbouring bins.

    A feature with at most `bins` different values gets a bin for each; others get bins of about equal numbers of rows.
    A missing value counts as 0. The values are counted once and placed by prefix sums over (feature, value).
    """
    def run(batches):
        held = [(np.zeros(0), np.zeros(0, np.int64))] * len(features)
        for batch in filter(len, batches):
            for f, v in enumerate(_columns_of(batch.column(0))):
                held[f] = _counted(*held[f], *np.unique(v, return_counts=True))
                if len(held[f][0]) > _VALUES:
                    yield out(f, *held[f])
                    held[f] = np.zeros(0), np.zeros(0, np.int64)
        yield from (out(f, *counts) for f, counts in enumerate(held))

    def out(f, values, n):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), f, np.int32)), pa.array(values), pa.array(n)], names=["f", "v", "n"])

    parts = matrix.select(_values(features).alias("x")).mapInArrow(run, "f int, v double, n bigint")
    counts = parts.groupBy("f", "v").agg(F.sum("n").alias("n"))
    placed = materialize(ordered_prefix(counts.withColumn("one", F.lit(1).cast("bigint")), ["f", "v"], rows="n", different="one"), "values")
    sizes = placed.groupBy("f").agg(
        F.min("rows").alias("r0"), F.min("different").alias("d0"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds")
    )
    number = F.when(F.col("kinds") <= bins, F.col("different") - F.col("d0")).otherwise(
        F.floor((F.col("rows") - F.col("r0")) * F.lit(bins) / F.col("all"))
    )
    ranges = placed.join(F.broadcast(sizes), "f").groupBy("f", number.alias("bin")).agg(F.min("v").alias("low"), F.max("v").alias("high"))
    following = F.lead("low").over(Window.partitionBy("f").orderBy("bin"))
    middle = F.col("high") + (F.col("following") - F.col("high")) / 2
    edges = ranges.withColumn("following", following).filter("following IS NOT NULL").select(
        "f", F.when(middle < F.col("following"), middle).otherwise(F.col("high")).alias("edge")
    )
    found = {i: [] for i in range(len(features))}
    for f, edge in edges.collect():  # bins x features rows at most
        found[f].append(edge)
    return {f: np.sort(np.array(e, float)) for f, e in found.items()}


def _columns_of(lists):
    """The features of rows of `_values`, one array each; what is missing counts as 0."""
    x = np.array(_matrix_of(lists).T, order="C")
    x[np.isnan(x)] = 0.0
    return x


def _counted(values, n, more, n_more):
    """Two lists of different values in order and their counts as one."""
    if np.array_equal(values, more):
        return values, n + n_more
    every, at = np.unique(np.concatenate([values, more]), return_inverse=True)
    sums = np.zeros(len(every), np.int64)
    np.add.at(sums, at, np.concatenate([n, n_more]))
    return every, sums


# ---------------------------------------------------------------- codes

class Coding:
    """How rows of bins are kept: a code for each group of features, which stands for the bins of all of them.

    `groups` has (features, keys) of each group: the combinations of bins that occur, as numbers in order. A code is a place among them.
    """

    def __init__(self, edges, groups):
        self.edges, self.groups = edges, groups
        self.sizes = [len(keys) for _, keys in groups]
        self.bins = {}  # feature: (its group, the bin of each code)
        for i, (features, keys) in enumerate(groups):
            for f in reversed(features):
                keys, bins = np.divmod(keys, len(edges[f]) + 1)
                self.bins[f] = i, bins.astype(np.uint8)

    def keys_of(self, columns):
        """For each group its numbers of rows, given by their features' values."""
        return [_combined([np.searchsorted(self.edges[f], columns[f], "left") for f in features], [len(self.edges[f]) + 1 for f in features]) for features, _ in self.groups]

    def codes_of(self, columns):
        """A row of codes for each group."""
        return np.stack([np.searchsorted(keys, own).astype(np.uint16) for (_, keys), own in zip(self.groups, self.keys_of(columns))])

    def goes_left(self, feature, cut):
        """(group, for each code whether it is in the bins up to the cut)."""
        group, bins = self.bins[feature]
        return group, bins <= cut

    def groups_of(self, used):
        """The groups of some features, in order."""
        return sorted({self.bins[f][0] for f in used})

    def spread(self, used):
        """A function of sums by code (3, codes of the groups of the features `used`): the features' histograms (features, 3, 256)."""
        first, start = {}, 0
        for i in self.groups_of(used):
            first[i], start = start, start + self.sizes[i]
        at = []
        for f in used:
            group, bins = self.bins[f]
            order = np.argsort(bins, kind="stable")
            kinds, starts = np.unique(bins[order], return_index=True)
            at.append((first[group] + order, starts, kinds))

        def histograms_of(sums):
            out = np.zeros((len(used), 3, 256), np.int64)
            for own, (order, starts, kinds) in zip(out, at):
                own[:, kinds] = np.add.reduceat(sums[:, order], starts, axis=1)
            return out

        return histograms_of


def _combined(bins, kinds):
    """Bins of several features as one number."""
    key = np.zeros(len(bins[0]), np.int64)
    for b, n in zip(bins, kinds):
        key = key * n + b
    return key


def _together(columns, edges, useful):
    """Groups of features, by rows tried: a feature joins the group whose combinations it adds fewest to, where they stay below MOST_CODES
    and half the rows know nearly all of them."""
    groups = []  # [features, numbers of the rows, how many are different, how many there could be]
    for f in sorted(useful, key=lambda f: -len(edges[f])):
        bins, kinds, best = np.searchsorted(edges[f], columns[f], "left"), len(edges[f]) + 1, None
        for group in groups:
            if group[3] * kinds < 1 << 62:
                key = group[1] * kinds + bins
                n = len(np.unique(key))
                if n <= MOST_CODES and n <= 1.1 * len(np.unique(key[::2])) and (best is None or n * best[0][2] < best[2] * group[2]):
                    best = group, key, n
        if best:
            best[0][:] = [*best[0][0], f], best[1], best[2], best[0][3] * kinds
        else:
            groups.append([[f], bins, max(1, len(np.unique(bins))), kinds])
    return [g[0] for g in groups]


def coding_of(train, val, features, edges, useful, keys, n):
    """A Coding of the rows of both tables by the features `useful`.

    Which features go together is chosen by some rows; the combinations are those of all rows. Groups with too many are taken apart.
    """
    mine = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(max(1, n // TRIED_ROWS))) == 0
    tried = train.filter(mine).select(_values(features).alias("x")).limit(2 * TRIED_ROWS).toArrow().column("x").combine_chunks()
    single = lambda f: ([f], np.arange(len(edges[f]) + 1))
    groups = _together(_columns_of(tried), edges, useful) if len(tried) else [[f] for f in useful]
    shared = [g for g in groups if len(g) > 1]
    trial = Coding(edges, [(g, np.zeros(0, np.int64)) for g in shared])

    def run(batches):
        held = [np.zeros(0, np.int64)] * len(shared)
        for batch in filter(len, batches):
            for i, own in enumerate(trial.keys_of(_columns_of(batch.column(0)))):
                if len(held[i]) <= MOST_CODES:
                    held[i] = np.unique(np.concatenate([held[i], np.unique(own)]))
        for i, own in enumerate(held):
            own = own[:MOST_CODES + 1]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), i, np.int32)), pa.array(own)], names=["group", "key"])

    found = {}
    if shared:
        both = train.select(_values(features).alias("x"))
        both = both if val is None else both.unionByName(val.select(_values(features).alias("x")))
        # At most so many numbers of a group come from a task, and one more than allowed from all.
        lists = both.mapInArrow(run, "group int, key bigint").groupBy("group").agg(F.slice(F.sort_array(F.collect_set("key")), 1, MOST_CODES + 1).alias("keys"))
        found = {r["group"]: np.array(r["keys"], np.int64) for r in lists.collect()}
    whole = [(g, found[i]) for i, g in enumerate(shared) if len(found[i]) <= MOST_CODES]
    known = {f for g, _ in whole for f in g}
    return Coding(edges, whole + [single(f) for f in useful if f not in known])


def _binned(matrix, features, coding, start, keys, name):
    """Stage table of blocks of rows: a hash of each, its label, the log odds so far and its codes, one group's after another's."""
    cells = matrix.select(
        F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("key"), F.col("label").cast("int").alias("label"), _values(features).alias("x")
    )

    def run(batches):
        held, n = [], 0
        for batch in filter(len, batches):
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int32), coding.codes_of(_columns_of(batch.column(2)))))
            n += len(batch)
            if n >= BLOCK_ROWS:
                yield out(held, n)
                held, n = [], 0
        if n:
            yield out(held, n)

    def out(held, n):
        key, label, codes = zip(*held)
        return _block(TABLE, np.concatenate(key), np.concatenate(label), np.full(n, start), np.concatenate(codes, 1))

    return materialize(cells.mapInArrow(run, TABLE), name)


TABLE = "key binary, label binary, margin binary, codes binary"


def _block(schema, *columns):
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in columns], names=schema.replace(",", "").split()[::2])


def _read(batches):
    """Hashes, labels, log odds and codes of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            key, label, margin, codes = (np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(batch.columns, (np.int64, np.int32, np.float64, np.uint16)))
            yield key, label, margin, codes.reshape(-1, len(key))


def _drawn(key, salt, share):
    """Whether the rows of the keys are in the sample of a salt: a hash of both below the share."""
    with np.errstate(over="ignore"):
        z = key.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share


# ---------------------------------------------------------------- one tree

def _sides(goes_left, codes, at):
    """Rows on the left and on the right of a split (group, for each code whether it goes left)."""
    group, left = goes_left
    mine = left.take(codes[group].take(at))
    return np.compress(mine, at), np.compress(~mine, at)


def _valued(coding, trees):
    """A function of the codes of a block and some of its rows: the values of the trees, one array each."""
    splits = [[coding.goes_left(f, cut) for f, cut in zip(t.feature.tolist(), t.cut.tolist())] for t in trees]
    links = [(t.left.tolist(), t.right.tolist(), t.leaf_value.tolist()) for t in trees]

    def values(codes, at):
        out = np.empty(codes.shape[1])
        for own, (left, right, leaf_value) in zip(splits, links):
            todo = [(0 if own else -1, at)]
            while todo:
                node, rows = todo.pop()
                if node < 0:
                    out[rows] = leaf_value[-1 - node]
                elif len(rows):
                    todo += zip((left[node], right[node]), _sides(own[node], codes, rows))
            yield out.take(at)

    return values


class _Sample:
    """The sampled rows of a tree: a table, and `read`, which makes of its Arrow batches (codes, g, h) of blocks of them.

    The codes are those of the groups of the features `used`, the derivatives whole multiples of 1 / SCALE. `trees` are the trees whose values
    the margins of the binned table lack.
    """

    def __init__(self, table, coding, used, trees, bag, share):
        groups = coding.groups_of(used)

        def read(batches):
            values = _valued(coding, trees)
            for key, label, margin, codes in _read(batches):
                at = np.flatnonzero(_drawn(key, bag, share))
                m = margin.take(at)
                for v in values(codes, at):
                    m = m + v
                p = _sigmoid(m)
                yield codes[groups].take(at, axis=1), np.rint((p - label.take(at)) * SCALE), np.rint(p * (1 - p) * SCALE)

        self.table, self.read = table, read

    def kept(self):
        """The same rows from a stage table, and its path: whoever reads them again finds the derivatives there."""
        spark, read = self.table.sparkSession, self.read

        def run(batches):
            for codes, g, h in read(batches):  # derivatives are not above SCALE
                yield _block(DERIVATIVES, codes, g.astype(np.int32), h.astype(np.int32))

        def read_again(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    codes, g, h = (np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(batch.columns, (np.uint16, np.int32, np.int32)))
                    yield codes.reshape(-1, max(1, len(g)))[:, :len(g)], g, h

        path = stage_path(spark, "derivatives")
        self.table.mapInArrow(run, DERIVATIVES).write.parquet(path)
        self.table, self.read = spark.read.schema(DERIVATIVES).parquet(path), read_again
        return path


DERIVATIVES = "codes binary, g binary, h binary"


def _router(coding, used, growing, wanted):
    """A function of a block of a sample: (place in `wanted`, codes, g, h) of the rows in wanted nodes, those of a node next to each other;
    None where there is no such row."""
    place, groups = {node: i for i, node in enumerate(wanted)}, coding.groups_of(used)
    splits = {k: (coding.goes_left(f, cut), left, right) for k, (f, cut, left, right) in growing.items()}

    def routed(block):
        codes, g, h = block
        own, found, todo = dict(zip(groups, codes)), [], [(0, np.arange(len(g)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node in place:
                found.append((place[node], rows))
            elif node in splits:
                goes_left, *children = splits[node]
                todo += zip(children, _sides(goes_left, own, rows))
        if not found:
            return None
        if len(found) == 1 and len(found[0][1]) == len(g):
            return np.full(len(g), found[0][0]), codes, g, h
        at = np.concatenate([rows for _, rows in found])
        places = np.repeat([i for i, _ in found], [len(rows) for _, rows in found])
        return places, codes.take(at, axis=1), g.take(at), h.take(at)

    return routed


def _added(cell, g, h, cells):
    """Sums of g and h and counts of rows by cell; whole numbers below 2^53."""
    return np.stack([np.bincount(cell, g, cells), np.bincount(cell, h, cells), np.bincount(cell, minlength=cells)]).astype(np.int64)


class _Sums:
    """A task's histograms by (wanted node, code)."""

    def __init__(self, coding, used, n_wanted):
        self.sizes, self.n = [coding.sizes[i] for i in coding.groups_of(used)], n_wanted
        self.held = [np.zeros((3, n_wanted * size), np.int64) for size in self.sizes]

    def add(self, place, codes, g, h):
        for held, size, own in zip(self.held, self.sizes, codes):
            held += _added(place * size + own, g, h, len(held[0]))

    def packed(self):
        """(place, sums by code as bytes) of the nodes with rows."""
        nodes = np.concatenate([held.reshape(3, self.n, -1) for held in self.held], 2)
        return [(i, nodes[:, i].tobytes()) for i in range(self.n) if nodes[2, i].any()]


def histograms(sample, coding, used, growing, wanted, rows=False):
    """Rows (leaf, sums): sums of derivatives, in multiples of 1 / SCALE, and rows of the sample by code, one row from each task for each
    leaf, dealt out by leaf.

    `growing` are the splits {node: (feature, bin, left, right)} so far, `wanted` the nodes looked at. Each task adds up its rows' histograms
    before anything is shuffled. With `rows` the same pass brings the sampled rows as well: rows of `_sampled`, of which those with `sums`
    have a task's histograms.
    """
    if rows:
        return _sampled(sample, coding, used, growing, wanted, True)
    read = sample.read

    def run(batches):
        sums = _Sums(coding, used, len(wanted))
        for found in filter(None, map(_router(coding, used, growing, wanted), read(batches))):
            sums.add(*found)
        for i, packed in sums.packed():
            yield pa.RecordBatch.from_arrays([pa.array([wanted[i]], pa.int32()), pa.array([packed], pa.binary())], names=["leaf", "sums"])

    return sample.table.mapInArrow(run, "leaf int, sums binary").repartition("leaf")


def _sampled(sample, coding, used, growing, wanted, summed=False):
    """Rows (root, g, h, codes, sums): packed sampled rows of the `wanted` nodes; with `summed` also each task's histograms of a node."""
    fields, read = pa.schema([("root", pa.int32()), *((c, pa.binary()) for c in ("g", "h", "codes", "sums"))]), sample.read

    def out(i, *packed):
        return pa.RecordBatch.from_arrays([pa.array([wanted[i]], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], schema=fields)

    def run(batches):
        sums = _Sums(coding, used, len(wanted) if summed else 0)
        for place, codes, g, h in filter(None, map(_router(coding, used, growing, wanted), read(batches))):
            if summed:
                sums.add(place, codes, g, h)
            starts = np.flatnonzero(np.diff(place, prepend=-1))
            for first, end in zip(starts, [*starts[1:], len(place)]):
                mine = slice(first, end)
                yield out(place[first], *(v[mine].astype(np.int32).tobytes() for v in (g, h)), codes[:, mine].tobytes(), None)
        if summed:
            yield from (out(i, None, None, None, packed) for i, packed in sums.packed())

    return sample.table.mapInArrow(run, "root int, g binary, h binary, codes binary, sums binary")


def _penalised(g, h, settings):
    """What a leaf with these sums of derivatives gains over the value 0 (twice the fall of the loss's second-order form)."""
    over = np.maximum(np.abs(g) - settings.l1, 0.0)
    return over * over / (h + settings.l2)


def _best_bins(sums, settings):
    """(sums up to each bin, the best gain, its bin) of histograms (any, 3, 256) of integers; the gain is below 0 where nothing fits."""
    upto = np.cumsum(sums, 2)
    whole = upto[:, :, -1:]
    (gl, hl), (g, h) = (x[:, :2].transpose(1, 0, 2) / SCALE for x in (upto, whole))
    gain = _penalised(gl, hl, settings) + _penalised(g - gl, h - hl, settings) - _penalised(g, h, settings)
    nl, n = upto[:, 2], whole[:, 2]
    fits = (nl >= settings.min_rows) & (n - nl >= settings.min_rows) & (hl >= settings.min_hessian) & (h - hl >= settings.min_hessian)
    gain = np.where(fits & (gain > 0), gain, -1.0)
    best = gain.argmax(1)
    return upto, gain[np.arange(len(best)), best], best


def _best_split(hist, used, settings):
    """(feature, g, h, n, gain, bin, gl, hl, nl): the best split of a node by its histograms of the features `used`, which are in order: the
    first feature and the lowest bin win a tie. Without one, what tells the split is None."""
    upto, gain, bin_ = _best_bins(hist, settings)
    f = int(gain.argmax())
    b = int(bin_[f])
    return used[f], *upto[f, :, -1].tolist(), *((float(gain[f]), b, *upto[f, :, b].tolist()) if gain[f] > 0 else (None,) * 5)


def best_splits(hist, coding, used, settings):
    """Rows (leaf, feature, g, h, n, gain, bin, gl, hl, nl, sums): the best split of each leaf, and its sums by code; without one, gain is null.

    A split keeps `min_rows` rows and `min_hessian` on both sides and has a gain above 0. A task adds up the histograms of the leaves that
    it was dealt and spreads them to the features' 256 bins.
    """
    schema = f"{SPLITS}, sums binary"

    def run(batches):
        held, spread = {}, coding.spread(used)
        for batch in batches:
            for leaf, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(sums.as_buffer(), np.int64).reshape(3, -1)
                held[leaf] = held[leaf] + own if leaf in held else own
        for leaf, sums in held.items():
            found = leaf, *_best_split(spread(sums), used, settings), sums.tobytes()
            yield pa.RecordBatch.from_pylist([dict(zip(schema.replace(",", "").split()[::2], found))], schema=SPLIT)

    return hist.mapInArrow(run, schema)


SPLITS = "leaf int, feature int, g bigint, h bigint, n bigint, gain double, bin int, gl bigint, hl bigint, nl bigint"


def subtrees(sample, coding, used, growing, best, wanted, settings, sampled=None):
    """Rows (root, parent, node, feature, g, ...): what lies below the `wanted` nodes, as far as a tree could need it.

    The sampled rows of a node, TASK_ROWS at most, meet in one task, which splits it best-first until it has as many leaves as the whole
    tree may have. A row tells the best split of a node; nodes are numbered below their root (0), the children of one next to each other.
    Where `sampled` comes with the histograms of the wanted nodes, their own best splits are found as well: rows of node 0 and parent -1.
    """
    known = {node: (used.index(best[node]["feature"]), best[node]["bin"]) for node in wanted if sampled is None}
    if sampled is None:
        sampled = _sampled(sample, coding, used, growing, wanted)
    groups = coding.groups_of(used)

    def split(rows):
        root, spread = rows.column("root")[0].as_py(), coding.spread(used)
        parts = [[np.frombuffer(x.as_buffer(), kind) for x in rows.column(c) if x.is_valid] for c, kind in (("g", np.int32), ("h", np.int32), ("codes", np.uint16))]
        g, h = (np.concatenate(v).astype(float) for v in parts[:2])
        codes = dict(zip(groups, np.concatenate([v.reshape(len(groups), -1) for v in parts[2]], 1)))

        def histogram(at):
            mine = g.take(at), h.take(at)
            return np.concatenate([_added(own.take(at), *mine, coding.sizes[i]) for i, own in codes.items()], 1)

        held, queue, found = {}, [], []

        def put(parent, node, at, sums, splits=None):
            if splits is None:
                best = _best_split(spread(sums), used, settings)
                splits = (used.index(best[0]), best[5], -best[4]) if best[4] is not None else ()
                found.append((root, parent, node, *best))
            if splits:
                held[node] = at, sums, *splits[:2]
                heapq.heappush(queue, (splits[2], node))

        every, n_nodes = np.arange(len(g)), 1
        if known:
            put(-1, 0, every, histogram(every), (*known[root], -np.inf))
        else:
            sums = sum(np.frombuffer(v, np.int64) for v in rows.column("sums").drop_null().to_pylist())
            put(-1, 0, every, sums.reshape(3, -1))
        for _ in range(settings.leaves - 1):
            if not queue:
                break
            parent = heapq.heappop(queue)[1]
            at, whole, f, cut = held.pop(parent)
            sides = _sides(coding.goes_left(used[f], cut), codes, at)
            small = int(len(sides[1]) < len(sides[0]))
            part = histogram(sides[small])
            for side, sums in zip(sides, (whole - part, part) if small else (part, whole - part)):
                put(parent, n_nodes, side, sums)
                n_nodes += 1
        return pa.table(dict(zip(SUBTREES.replace(",", "").split()[::2], zip(*found))), SUBTREE)

    # Many more partitions than nodes, so that few meet in one.
    return sampled.repartition(16 * len(wanted), "root").groupBy("root").applyInArrow(split, SUBTREES)


SUBTREES = "root int, parent int, " + SPLITS.replace("leaf", "node")
SPLIT, SUBTREE = (pa.schema([
    (name, {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}[kind]) for name, kind in (c.split() for c in columns.split(", "))
]) for columns in (f"{SPLITS}, sums binary", SUBTREES))


def _chosen(best, children, leaves):
    """Best-first: (the nodes split, in order; those of them whose children are not known but could change the choice)."""
    queue, order, unknown = [], [], []

    def put(node):
        found = best[node]
        if found["gain"] is not None:
            heapq.heappush(queue, (-found["gain"], node))

    put(0)
    while queue and len(order) < leaves - 1:
        node = heapq.heappop(queue)[1]
        order.append(node)
        if node in children:
            for c in children[node]:
                put(c)
        elif len(order) < leaves - 1:
            unknown.append(node)
    return order, unknown


def grow(table, coding, used, trees, bag, settings, n_rows):
    """A Tree grown on the sampled rows of a table of `n_rows` by the features `used`, or None if the root has no split."""
    best, children, splits, sums, spread = {}, {}, {}, {}, coding.spread(used)
    sample = _Sample(table, coding, used, trees, bag, settings.row_share)

    def look(wanted):
        """The best splits of nodes; of two children the one with more rows has what the other one leaves of their parent's sums."""
        pairs = {}
        for parent, (left, right) in children.items():
            if left in wanted:
                few, many = (left, right) if 2 * best[parent]["nl"] <= best[parent]["n"] else (right, left)
                pairs[few] = parent, many
        hist = histograms(sample, coding, used, splits, list(pairs) or wanted)
        for r in best_splits(hist, coding, used, settings).collect():  # one row for each node
            best[r["leaf"]], sums[r["leaf"]] = r.asDict(), np.frombuffer(r["sums"], np.int64).reshape(3, -1)
        for few, (parent, many) in pairs.items():
            sums[many] = sums.pop(parent) - sums[few]
            best[many] = dict(zip(SPLIT.names, (many, *_best_split(spread(sums[many]), used, settings))))
        for node in set(wanted) & set(sums):
            if best[node]["n"] <= TASK_ROWS or best[node]["gain"] is None:
                sums.pop(node)

    def part(node):
        children[node] = (1 + 2 * len(children), 2 + 2 * len(children))
        splits[node] = (best[node]["feature"], best[node]["bin"], *children[node])
        return children[node]

    def below(wanted, sampled=None):
        rows = subtrees(sample, coding, used, splits, best, wanted, settings, sampled).collect()  # 2 rows for each leaf of a tree
        number = {(node, 0): node for node in wanted}
        rows = sorted(rows, key=lambda r: (r["root"], r["node"]))
        best.update((r["root"], r.asDict()) for r in rows if r["parent"] < 0)
        for left, right in zip(*[iter([r for r in rows if r["parent"] >= 0])] * 2):
            for r, node in zip((left, right), part(number[left["root"], left["parent"]])):
                number[r["root"], r["node"]], best[node] = node, r.asDict()

    def grown():
        if 0 not in best or best[0]["gain"] is None:
            return None
        while True:
            order, unknown = _chosen(best, children, settings.leaves)
            if not unknown:
                return _tree(order, best, children, coding.edges, settings)
            large = [node for node in unknown if best[node]["n"] > TASK_ROWS]
            if large:
                for node in large:
                    part(node)
                look([c for node in large for c in children[node]])
                continue
            below(unknown)

    if n_rows <= TASK_ROWS:
        below([0], histograms(sample, coding, used, splits, [0], True))
        return grown()
    path = sample.kept()
    try:
        look([0])
        return grown()
    finally:
        discard(table.sparkSession, path)


def _output(g, h, settings):
    """The value of a leaf: a damped Newton step."""
    over = max(abs(g) - settings.l1, 0.0)
    return -np.sign(g) * over / (h + settings.l2) * settings.rate


def _tree(order, best, children, edges, settings):
    place = {node: i for i, node in enumerate(order)}
    leaves, links = [], {"left": [], "right": []}
    for node in order:
        b = best[node]
        rest = {c: b[c] - b[f"{c}l"] for c in "ghn"}
        sides = {"left": {c: b[f"{c}l"] for c in "ghn"}, "right": rest}
        for i, (side, sums) in enumerate(sides.items()):
            child = children[node][i] if node in children else None
            if child in place:
                links[side].append(place[child])
            else:
                leaves.append(sums)
                links[side].append(-len(leaves))
    of = lambda rows, c, unit=1: np.array([r[c] for r in rows]) / unit
    nodes = [best[n] for n in order]
    feature, cut = of(nodes, "feature").astype(int), of(nodes, "bin").astype(int)
    return Tree(
        feature, np.array([edges[f][c] for f, c in zip(feature, cut)]), cut, np.array(links["left"]), np.array(links["right"]),
        of(nodes, "gain"), of(nodes, "n").astype(int), of(nodes, "h", SCALE),
        np.array([_output(r["g"] / SCALE, r["h"] / SCALE, settings) for r in nodes]),
        np.array([_output(r["g"] / SCALE, r["h"] / SCALE, settings) for r in leaves]), of(leaves, "n").astype(int), of(leaves, "h", SCALE),
        np.ones(len(nodes), bool), np.zeros(len(nodes), int), settings.rate,
    )


# ---------------------------------------------------------------- rounds

def area_under_curve(scored, by=(), score="score", label="label"):
    """Rows (by..., auc): the share of pairs of a positive and a negative row that the score puts in order, equal scores half.

    Scores are counted, and the negatives below each score are one prefix sum over all (by, score), so nothing is ranked in one task. Null
    where a group has rows of one label only; rows without a score or label do not count.
    """
    by = list(by)
    rows = scored.select(*by, F.col(score).cast("double").alias("score"), F.col(label).cast("bigint").alias("label")).dropna()
    return _areas(rows.select(*by, "score", F.col("label").alias("pos"), (1 - F.col("label")).alias("neg")), by)


def _areas(rows, by):
    """`area_under_curve` of rows (by..., score, pos, neg), each of so many rows of either label."""
    counts = rows.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    placed = ordered_prefix(counts, [*by, "score"], below="neg")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    won = F.sum(wide("pos") * (2 * wide("below") + wide("neg")))
    pos, neg = F.sum(wide("pos")), F.sum(wide("neg"))
    won = won - 2 * pos * F.min(wide("below"))  # the prefix sum counts the groups before as well
    return placed.groupBy(*by).agg(
        F.when((pos > 0) & (neg > 0), won.cast("double") / (2 * pos.cast("double") * neg.cast("double"))).alias("auc")
    )


def _margins(coding, trees):
    """A function of a block: the log odds after each of the trees, a row for each of them."""
    values = _valued(coding, trees)

    def margins(block):
        return block[2] + np.cumsum(np.stack(list(values(block[3], np.arange(len(block[0]))))), 0)

    return margins


def _advanced(table, coding, trees, name):
    """The binned table with the margins after the trees, as a stage table."""
    def run(batches):
        margins = _margins(coding, trees)
        for key, label, margin, codes in _read(batches):
            yield _block(TABLE, key, label, margins((key, label, margin, codes))[-1], codes)

    return materialize(table.mapInArrow(run, TABLE), name)


def _rated(table, coding, trees):
    """Rows (place, score, pos, neg): how many rows of either label have a score after each of the trees, counted by blocks."""
    def run(batches):
        margins = _margins(coding, trees)
        for block in _read(batches):
            for place, m in enumerate(margins(block)):
                scores, at = np.unique(m, return_inverse=True)
                pos = np.bincount(at, block[1], len(scores)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(scores), place, np.int32)), pa.array(scores), pa.array(pos), pa.array(np.bincount(at, minlength=len(scores)) - pos),
                ], names=["place", "score", "pos", "neg"])

    return table.mapInArrow(run, "place int, score double, pos bigint, neg bigint")


def _losses(table, coding, trees):
    """{place: mean log loss} after each of the trees."""
    def run(batches):
        margins, sums, n = _margins(coding, trees), np.zeros(len(trees)), 0
        for block in _read(batches):
            m = margins(block)
            sums += (np.maximum(m, 0.0) - m * block[1] + np.log1p(np.exp(-np.abs(m)))).sum(1)
            n += len(block[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(trees), dtype=np.int32)), pa.array(sums), pa.array(np.full(len(trees), n))], names=["place", "loss", "n"])

    parts = table.mapInArrow(run, "place int, loss double, n bigint")
    return dict(map(tuple, parts.groupBy("place").agg(F.sum("loss") / F.sum("n")).collect()))


def fit(train, val, features, keys, settings=Settings()):
    """A Booster of the rows of `train`, its rounds chosen on `val` (None: all rounds are kept).

    After each sample of rows (`bag_rounds` rounds) the area under the curve of `val` is measured for all its rounds at once; the fit ends
    when `patience` rounds in a row bring no new best, and the rounds up to the best are kept. A table without rows of both
    labels gives a constant. Features with one value are never used. `keys` identify a row for the samples.
    """
    positive, n = train.agg(F.coalesce(F.sum(F.col("label").cast("bigint")), F.lit(0)), F.count(F.lit(1))).first()
    share = min(max(positive / n, 1e-15), 1 - 1e-15) if n else 0.5
    start = float(np.log(share / (1 - share)))
    edges = bin_edges(train, features, settings.bins) if features and n else {}
    useful = [f for f in edges if len(edges[f])]
    if not useful or positive in (0, n):
        return Booster(features, [_constant(start)])
    has_val = val is not None and val.limit(1).count() > 0
    coding = coding_of(train, val if has_val else None, features, edges, useful, keys, n)
    files = max(1, -(-n // MANY_ROWS), min(train.sparkSession.sparkContext.defaultParallelism, n // FEW_ROWS))
    rows = _binned(train.coalesce(files), features, coding, start, keys, "binned")
    held_out = _binned(val, features, coding, start, keys, "binned") if has_val else None
    random = np.random.default_rng(settings.seed)
    trees, history, best, rounds, judged = [], [], (-1.0, 0), settings.rounds, None

    def judge(rows, held_out, more):
        """`held_out` with the margins after the trees, and their (train losses, losses, areas); `rows` without them."""
        train_losses = _losses(rows, coding, more)
        if held_out is None:
            return None, train_losses, {}, {}
        losses, areas = _losses(held_out, coding, more), dict(map(tuple, _areas(_rated(held_out, coding, more), ["place"]).collect()))
        return _advanced(held_out, coding, more, "binned"), train_losses, losses, areas

    # The trees of a sample are judged while those of the next one are grown, which are dropped if that ends the fit.
    with ThreadPoolExecutor(1) as beside:
        while True:
            bag, more = len(trees) + (len(judged[0]) if judged else 0), []
            while len(more) < min(settings.bag_rounds, rounds - bag):
                used = np.sort(random.permutation(useful)[:max(1, round(settings.feature_share * len(useful)))]).tolist()
                tree = grow(rows, coding, used, more, bag, settings, n)
                if tree is None:
                    rounds = bag + len(more)
                    break
                more.append(tree)
            if judged:
                held_out, train_losses, losses, areas = judged[1].result()
                for i, tree in enumerate(judged[0]):
                    trees.append(tree)
                    history.append((len(trees), areas.get(i), losses.get(i), train_losses[i]))
                    if areas.get(i) is not None and areas[i] > best[0]:
                        best = (areas[i], len(trees))
                    elif best[1] and len(trees) - best[1] >= settings.patience:
                        more = []
                        break
            if not more:
                break
            judged = more, beside.submit(judge, rows, held_out, more)
            # The rows are not written after the last round.
            rows = _advanced(rows, coding, more, "binned") if bag + len(more) < rounds else rows
    trees = trees[:best[1] or None]
    if not trees:
        return Booster(features, [_constant(start)], history)
    first = trees[0]
    trees[0] = replace(first, leaf_value=first.leaf_value + start, output=first.output + start, shrinkage=1.0)
    return Booster(features, trees, history)


def _constant(value):
    none, real = np.zeros(0, int), np.zeros(0)
    return Tree(none, real, none, none, none, real, none, real, real, np.array([value]), np.array([0]), np.array([0.0]), none, none)
