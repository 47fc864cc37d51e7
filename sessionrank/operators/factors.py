"""Embedding retrieval: implicit-feedback factorization and nearest items by dot product."""

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionrank import schemas
from sessionrank.functions.numbering import dense_index, ordered_prefix
from sessionrank.functions.skew import HOT_ROWS, hot_keys, salted_join
from sessionrank.functions.staging import materialize

# Blocks that one task scores against each other: numbers in the vectors of a block of sessions and of items. A block of
# sessions is sent once for every block of items of a band, so those are the larger ones.
_BLOCK_NUMBERS, _ITEM_NUMBERS = 1 << 20, 1 << 23
# Products of a run, at most, whose largest is looked at first.
_RUN = 64
# Items whose products are looked at together, at most, so that most of a large block's meet the best of those before.
_PIECE = 1 << 12
# Blocks of either side that smaller blocks, if asked for, are dealt out to at most; a task then cuts its blocks into pieces.
_FEW_BLOCKS = 2
# Items of the first band, those with the longest vectors; each further band is as long as all before it.
FIRST_BAND = 1 << 15
# Ratings for each of the blocks that the factorization deals users and items out to.
_RATINGS_PER_BLOCK = 5_000_000
_MOST_IDS = (1 << 31) - 1
_SCORE_DIGITS = 6


def fit_factors(
    sessions,
    factors=schemas.ALS_FACTORS,
    iterations=schemas.ALS_ITERATIONS,
    regularization=schemas.ALS_REGULARIZATION,
    seed=schemas.SEED,
    hot_rows=HOT_ROWS,
):
    """Item factors (id, features) of the user-item interaction counts."""
    counts = sessions.groupBy("user_id", "item_id").agg(
        F.count(F.lit(1)).cast("float").alias("n")
    )
    items = dense_index(sessions, "item_id", "item")
    users = dense_index(sessions, "user_id", "user")
    ratings = counts
    for key, index in (("item_id", items), ("user_id", users)):
        hot = hot_keys(sessions, key, hot_rows)
        ratings = salted_join(ratings, index, [key], "inner", hot, key, ["user_id", "item_id"])
    ratings = ratings.select("user", "item", "n")
    ratings = materialize(ratings, "ratings")
    n, most = ratings.agg(F.count(F.lit(1)), F.greatest(F.max("user"), F.max("item"))).first()
    if n and most > _MOST_IDS:
        raise ValueError("the factorization takes at most 2^31 users and items")
    n_blocks = max(10, -(-n // _RATINGS_PER_BLOCK))
    model = ALS(
        rank=factors, maxIter=iterations, regParam=regularization, implicitPrefs=True,
        userCol="user", itemCol="item", ratingCol="n", seed=seed,
        numUserBlocks=n_blocks, numItemBlocks=n_blocks,
    ).fit(ratings.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), "n"))
    return model.itemFactors.withColumnRenamed("id", "item").join(
        items.select("item_id", F.col("item").cast("int").alias("item")), "item"
    ).select(F.col("item_id").alias("id"), "features")


def _dimensions(factors):
    first = factors.select(F.size("features")).first()
    return first[0] if first else 0


def session_vectors(factors, context, hot_rows=HOT_ROWS, dimensions=None):
    """Rows (session_id, vector): mean factors of the known context items, with repeats.

    `dimensions` is the length of the vectors, looked up if not given.
    """
    if factors is None:
        raise RuntimeError("the factors have not been fitted")
    dimensions = _dimensions(factors) if dimensions is None else dimensions
    hot = hot_keys(context, "item_id", hot_rows)
    known = salted_join(
        context.select("session_id", "item_id"), factors.withColumnRenamed("id", "item_id"),
        ["item_id"], "inner", hot, "item_id", ["session_id"],
    )
    means = [F.avg(F.col("features")[i].cast("double")) for i in range(dimensions)]
    return known.groupBy("session_id").agg(F.array(*means).alias("vector"))


def _numbers(table, column):
    """The vectors of an Arrow column as a matrix."""
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _best_of_blocks(sessions, items, piece=None, bounds=()):
    """The best items of one block for each session of another: matrix products, a bounded number of scores at a time.

    With `piece` the blocks are cut into pieces of about so many numbers, and a session's best of the pieces so far are kept. Items may have
    a `band`, which are read in order: `bounds` has (band, longest vector of the next one), and a session whose last wanted score beats its
    product with the length of the session's vector reads no further. `band` of the result is the last one that the session read.
    """
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32))]
    if len(sessions) and len(items):
        items = items.sort_by("id")
        ids, matrix = items.column("id").to_numpy(), _numbers(items, "features")
        parts = [(0, ids, matrix, np.nan)]
        if "band" in items.column_names:
            of, bounds = items.column("band").to_numpy(), dict(bounds)
            parts = [(int(b), ids[of == b], matrix[of == b], bounds.get(int(b), np.nan)) for b in np.unique(of)]
        session, wanted = sessions.column("session_id").to_numpy(), sessions.column("wanted").to_numpy()
        length = sessions.column("length").to_numpy() if "length" in sessions.column_names else np.full(len(session), np.nan)
        vectors = _numbers(sessions, "vector")
        most = max(len(p[1]) for p in parts)
        # What is no number counts by pieces, so that such vectors are not cut where that is not asked for.
        finite = bool(np.isfinite(matrix).all() and np.isfinite(vectors).all())
        few = (min(most, _PIECE) if finite else most) if piece is None else max(1, piece // max(1, matrix.shape[1]))
        step = max(1, 4_000_000 // few) if piece is None else few
        for start in range(0, len(session), step):
            here = slice(start, start + step)
            n = len(session[here])
            best, last = (np.zeros(0, np.int64), ids[:0], np.zeros(0)), np.zeros(n, np.int32)
            left, floor = np.arange(n), np.full(n, -np.inf)
            for band, names, vectors_of, bound in parts:
                last[left] = band
                own, k, least = (np.zeros(0, np.int64), ids[:0], np.zeros(0)), wanted[here][left], floor[left]
                mine = vectors[here][left]
                for first in range(0, len(names), few):
                    products = mine @ vectors_of[first:first + few].T
                    row, place = _near(products, k, least)
                    new = row, names[first + place], np.round(products[row, place], _SCORE_DIGITS) + 0.0
                    # The lists that the piece adds to are sorted anew.
                    hit = np.zeros(len(left), bool)
                    hit[row] = True
                    hit = hit[own[0]]
                    merged = _merged([x[hit] for x in own], new, k)
                    own = [np.concatenate([x[~hit], y]) for x, y in zip(own, merged)]
                    if finite:
                        last_wanted = np.flatnonzero(_ranked(merged[0]) == k[merged[0]] - 1)
                        least[merged[0][last_wanted]] = merged[2][last_wanted]
                own = left[own[0]], *own[1:]
                if len(parts) == 1:
                    best = own
                    break
                best, kth = _joined(best, own, wanted[here])
                if finite:
                    floor = np.where(np.isnan(kth), -np.inf, kth)
                # Rounding can lift a score by half a unit of its last digit.
                left = left[~(kth[left] > length[here][left] * bound + 10.0 ** -_SCORE_DIGITS)]
                if not len(left):
                    break
            out.append((session[here][best[0]], best[1], best[2], last[best[0]]))
    return pa.table(dict(zip(("session_id", "item_id", "score", "band"), map(np.concatenate, zip(*out)))))


def _scorer(piece, bounds):
    return lambda sessions, items: _best_of_blocks(sessions, items, piece, bounds)


def _near(products, wanted, least):
    """(rows, places) of products that can be among the best `wanted` of their row once rounded, row by row; no others than numbers.

    `least` is the score of the last wanted one found before, or -inf; where there is none, runs of products are looked at by their
    largest: as many runs as wanted have one at least as large as the last of these.
    """
    n, width = products.shape
    slack = 10.0 ** -_SCORE_DIGITS  # rounding moves either of two products by half of it
    run = min(_RUN, max(1, width // (8 * int(np.median(wanted))))) if n else 1  # shorter where few runs would be left out
    cut, n_runs = least - slack, width // run
    open_ = np.flatnonzero((least == -np.inf) & (wanted < n_runs))
    if len(open_):
        # A run's products lie as far from each other as there are runs, which makes their largest a comparison of whole rows.
        largest = products[open_, :n_runs * run].reshape(len(open_), run, -1).max(1)
        for k in np.unique(wanted[open_]).tolist():
            mine = wanted[open_] == k
            cut[open_[mine]] = np.partition(largest[mine], n_runs - k, axis=1)[:, n_runs - k] - slack
    at = np.flatnonzero(~(products < cut[:, None]))  # NaN stays, as it counts as the largest
    rows, places = np.divmod(at, max(1, width))
    near = products[rows, places]
    blank = np.isnan(near)
    if blank.any():
        # They take the places of the best, and are no scores themselves.
        scores, keep = np.round(near, _SCORE_DIGITS), ~blank
        for row in np.unique(rows[blank]).tolist():
            at, k = np.flatnonzero(rows == row), wanted[row]
            if k < len(at):
                keep[at] &= scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]
        rows, places = rows[keep], places[keep]
    return rows, places


def _ranked(rows):
    """The place of each entry among those of its row; rows are in order."""
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    return np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))


def _merged(old, new, wanted):
    """The best `wanted` of each row of (rows, ids, scores) found before and of a piece with higher ids; equal scores in order of their ids."""
    rows, ids, scores = (np.concatenate(x) for x in zip(old, new))
    # A stable sort keeps the order of the ids among ties: what was found before comes first, best first, then by id.
    order = np.lexsort((-scores, rows))
    order = order[_ranked(rows[order]) < wanted[rows[order]]]
    return rows[order], ids[order], scores[order]


def _joined(old, new, wanted):
    """((rows, ids, scores), score of the k-th different id of each row) of two bands' lists, without what lies below it; an id may have several
    entries."""
    rows, ids, scores = (np.concatenate(x) for x in zip(old, new))
    order = np.lexsort((-scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    by_id = np.lexsort((ids, rows))
    again = np.zeros(len(rows), bool)
    again[by_id[1:]] = (np.diff(rows[by_id]) == 0) & (np.diff(ids[by_id]) == 0)
    firsts = np.flatnonzero(~again)
    last = firsts[_ranked(rows[firsts]) == wanted[rows[firsts]] - 1]
    kth = np.full(len(wanted), np.nan)
    kth[rows[last]] = scores[last]
    near = ~(scores < kth[rows])
    return (rows[near], ids[near], scores[near]), kth


def _dealt(table, key, own, n_own, other, n_other):
    """Rows in `n_own` blocks by a hash of their key, once for every block of the other side."""
    return table.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
    )


def norm_bands(factors, first_band=FIRST_BAND):
    """Stage table (id, features, norm, band): items in bands of falling length of their vectors.

    Band 0 has the `first_band` longest, each further one as many as all before it; equal lengths are ordered by id.
    """
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda sum, x: sum + x.cast("double") * x.cast("double")))
    items = factors.select("id", "features", norm.alias("norm"), (-norm).alias("fall"), F.lit(1).cast("bigint").alias("one"))
    placed = ordered_prefix(items, ["fall", "id"], place="one")
    turn = F.floor(F.col("place") / F.lit(first_band)).cast("bigint")
    band = F.when(turn == 0, 0).otherwise(F.length(F.bin(turn)))
    return materialize(placed.select("id", "features", "norm", band.alias("band")), "bands", ["band"])


def _trace_bands(trace, step, near, n_sessions):
    """Adds (band, sessions that read it, items) of a step to `trace`; `n_sessions` is the number of sessions, if it is known."""
    depth = near.groupBy("session_id").agg(F.max("band").alias("band")).groupBy("band").count().collect()  # a row for each band
    listed = sum(n for _, n in depth)
    for band, n_items, _ in step:
        # A session without a list has read all.
        read = sum(n for last, n in depth if last >= band) + (max(n_sessions, listed) - listed if n_sessions else 0)
        trace.append((band, read, n_items))


def retrieve_by_factors(
    factors, context, top_k, hot_rows=HOT_ROWS, block_numbers=None, dimensions=None, first_band=FIRST_BAND, trace=None
):
    """Recommendations (session_id, item_id, score, rank): nearest items not in the context.

    Items are read in bands of falling vector length. A score is at most the product of the lengths of both vectors, so a session is
    done when its k-th best item so far beats that bound for the next band; the others go on, until no band is left. The first bands,
    as many as fit a block of items, are one step: tasks read them one after another, and the vectors of the sessions are sent once. Each further band is a
    step of its own. Within a step, sessions and items are dealt out to blocks by hashes, every pair of blocks meets in one task, which multiplies
    them in pieces of about `block_numbers` numbers (fewer numbers do not repeat the rows in more blocks), and yields each session's best k plus as many as the session has
    distinct items, so that k remain once the context is taken out. Scores are rounded to
    6 digits; equal scores are ordered by item_id. `factors` is read more than once: pass a stage table. `trace`, a list, gets (band,
    sessions, items) of each step.
    """
    if factors is None:
        raise RuntimeError("the factors have not been fitted")
    limits = _BLOCK_NUMBERS, _ITEM_NUMBERS
    dimensions = _dimensions(factors) if dimensions is None else dimensions
    seen = context.select("session_id", "item_id").distinct()
    sizes = seen.groupBy("session_id").agg((F.count(F.lit(1)) + top_k).alias("wanted"))
    vectors = session_vectors(factors, context, hot_rows, dimensions).join(sizes, "session_id")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda sum, x: sum + x * x))
    active = vectors.withColumn("length", length)
    items = norm_bands(factors, first_band)
    bands = sorted(map(tuple, items.groupBy("band").agg(F.count(F.lit(1)), F.max("norm")).collect()))  # a row for each doubling
    bounds = [(band, np.nan if longest is None else longest) for (band, _, _), (_, _, longest) in zip(bands, bands[1:])]
    steps = []
    for band in bands:
        if steps and (sum(n for _, n, _ in steps[0]) + band[1]) * max(dimensions, 1) <= limits[1]:
            steps[0].append(band)
        else:
            steps.append([band])
    if len(steps) > 1:
        active = materialize(active, "session-vectors")
    best = Window.partitionBy("session_id").orderBy(F.desc("score"), "item_id")
    schema = "session_id bigint, item_id bigint, score double, band int"
    found, done = None, []
    for step, following in zip(steps, [*steps[1:], None]):
        # A single step deals the vectors out as they are made; sessions without a known item have none.
        n_sessions = active.count() if len(steps) > 1 else context.select("session_id").distinct().count()
        numbers = [n * max(dimensions, 1) for n in (n_sessions, sum(n for _, n, _ in step))]
        blocks = [max(1, -(-n // limit)) for n, limit in zip(numbers, limits)]
        if block_numbers:
            blocks = [max(b, min(_FEW_BLOCKS, -(-n // block_numbers))) for b, n in zip(blocks, numbers)]
        left = _dealt(active.select("session_id", "vector", "wanted", "length"), "session_id", "sessions", blocks[0], "items", blocks[1])
        mine = items.filter(F.col("band").between(step[0][0], step[-1][0])).select("id", F.col("features").cast("array<double>").alias("features"), "band")
        right = _dealt(mine, "id", "items", blocks[1], "sessions", blocks[0])
        inner = [(band, bound) for band, bound in bounds if band < step[-1][0]]
        near = left.groupBy("sessions", "items").cogroup(right.groupBy("sessions", "items")).applyInArrow(_scorer(block_numbers, inner), schema)
        near = near.join(seen, ["session_id", "item_id"], "left_anti")
        near = near if found is None else near.unionByName(found)
        near = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_k)
        if following or trace is not None:
            near = materialize(near, "nearest")
        if trace is not None:
            _trace_bands(trace, step, near, active.count() if len(steps) > 1 else None)
        if following is None:
            done.append(near.drop("band"))
            break
        kth = near.filter(F.col("rank") == top_k).select("session_id", F.col("score").alias("kth"))
        # Rounding can lift a score by half a unit of its last digit.
        beaten = F.col("kth") > F.col("length") * F.lit(following[0][2]) + 10.0 ** -_SCORE_DIGITS
        judged = materialize(active.join(kth, "session_id", "left").withColumn("done", F.coalesce(beaten, F.lit(False))).drop("kth"), "session-vectors")
        finished = judged.filter("done").select("session_id")
        done.append(near.drop("band").join(finished, "session_id", "left_semi"))
        active = judged.filter("NOT done").drop("done")
        if not active.limit(1).count():
            break
        found = near.join(finished, "session_id", "left_anti").drop("rank")
    if not done:
        return context.sparkSession.createDataFrame([], "session_id bigint, item_id bigint, score double, rank int")
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole
