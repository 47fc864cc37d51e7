"""Inactivity sessions, user-level split, leave-last-out targets.

Events are (user_id, item_id, timestamp, *tie columns). Timestamps are integers; gaps are
given in the same unit. Spark keeps no input order, so equal timestamps are ordered by the
tie columns, which should make the order of a user's events total.

The log is evaluated once, into a stage table; everything else reads that. All window work
happens per timeline: a user, or, for a user with more rows than a task should sort, one of
several slices of that user's events in order. Slices are numbered on their own and stitched
together through a small table of what crosses their borders.
"""

from collections import namedtuple

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionrank import schemas
from sessionrank.functions.numbering import exclusive_prefix
from sessionrank.functions.skew import BROADCAST_ROWS, HOT_ROWS, hot_keys
from sessionrank.functions.staging import materialize

# The parts of a log: `plain` users, and the events of hot users (None without any) in at most `n_slices` slices of their order.
_Parts = namedtuple("_Parts", "plain slices n_slices")
_SLICED = ("user_id", "slice")


# --- numbering inside a timeline ------------------------------------------------------


def _timeline(keys, tie_cols):
    return Window.partitionBy(*keys).orderBy("timestamp", *tie_cols)


def _gaps(events, tie_cols, keys):
    """Adds `delta`: time since the previous event of the timeline, null for the first."""
    previous = F.lag("timestamp").over(_timeline(keys, tie_cols))
    return events.withColumn("delta", F.col("timestamp") - previous)


def _number_sessions(events, gap, tie_cols, keys):
    """Adds `delta` and `local_session_id`, the 1-based session number in the timeline.

    A session starts at the first event and wherever the gap is exceeded (strictly).
    """
    starts = F.col("delta").isNull() | (F.col("delta") > gap)
    running = _timeline(keys, tie_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _gaps(events, tie_cols, keys).withColumn(
        "local_session_id", F.sum(starts.cast("bigint")).over(running)
    )


def _number_rows(local, tie_cols, keys):
    """Adds `row` (0-based index in the session) and `n_rows` (session size)."""
    session = Window.partitionBy(*keys, "local_session_id")
    return local.withColumn(
        "row", F.row_number().over(session.orderBy("timestamp", *tie_cols)).cast("bigint") - 1
    ).withColumn("n_rows", F.count(F.lit(1)).over(session))


# --- slices of hot users --------------------------------------------------------------


def _parts(events, tie_cols, hot_rows):
    """Writes the log once and splits it: users a task can sort, and slices of the others.

    Hot users' events are dealt out by ranges of (user, timestamp, *ties), so that equal timestamps
    are split too, and sorted; every `hot_rows` rows of a range are a slice. A task takes many small
    slices: there are as many ranges as the rows need or the session has cores, whatever `hot_rows` is.
    """
    log = materialize(events, "events")
    hot = hot_keys(log, "user_id", hot_rows)
    if hot is None:
        return _Parts(log, None, 0)
    n_slices = hot.table.agg(F.sum("parts")).first()[0]
    users = hot.hinted()
    order = ("user_id", "timestamp", *tie_cols)
    cores = log.sparkSession.sparkContext.defaultParallelism
    n_ranges = min(int(n_slices), max(cores, -(-int(n_slices) * hot_rows // HOT_ROWS)))
    # The ids count the rows of a range in their order, and those of different ranges lie 2^33 apart.
    sliced = (
        log.join(users.select("user_id"), "user_id", "left_semi")
        .repartitionByRange(n_ranges, *order).sortWithinPartitions(*order)
        .withColumn("slice", F.floor(F.monotonically_increasing_id() / F.lit(hot_rows)))
    )
    plain = log.join(users.select("user_id"), "user_id", "left_anti")
    # Where a user or a range begins, a slice may be cut in two.
    return _Parts(plain, materialize(sliced, "slices"), 2 * int(n_slices) + n_ranges)


def _small(table, n_slices):
    """A table of a few rows per slice, broadcast unless there are very many slices."""
    return _sent(table, 2 * n_slices)


def _sent(table, n_rows):
    """A table to be joined with the log's rows, broadcast up to BROADCAST_ROWS rows.

    Beyond, both sides are dealt out. Left to itself, Spark would go by the bytes of files, and a log of many rows that compress well
    would pass through the driver.
    """
    return F.broadcast(table) if n_rows <= BROADCAST_ROWS else table.hint("merge")


def _slice_borders(numbered, gap):
    """What crosses the borders of the slices.

    Returns two small tables. shifts (user_id, slice, shift, closed): what to add to a slice's
    session numbers to get the user's, and when the slice before ended. edges (user_id, slice, local_session_id, before, total): for
    the first and last session of a slice, its rows in earlier slices and in all slices.
    """
    keys = _SLICED
    pieces = numbered.groupBy(*keys, "local_session_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp").alias("opens"),
        F.max("timestamp").alias("closes"),
    )
    slices = materialize(
        pieces.groupBy(*keys).agg(
            F.max("local_session_id").alias("n_pieces"),
            F.min("opens").alias("opens"),
            F.max("closes").alias("closes"),
            F.min_by("n", "local_session_id").alias("first_n"),
            F.max_by("n", "local_session_id").alias("last_n"),
        ),
        "slices",
    )
    order = Window.partitionBy("user_id").orderBy("slice")
    continued = F.coalesce(F.col("opens") - F.col("closed") <= gap, F.lit(False))
    linked = slices.withColumn("closed", F.lag("closes").over(order)).withColumn(
        "continued", continued.cast("bigint")
    )
    earlier = F.coalesce(
        F.sum("n_pieces").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    merged = F.sum("continued").over(order.rowsBetween(Window.unboundedPreceding, 0))
    shifted = linked.withColumn("shift", earlier - merged)

    first = F.struct(F.lit(1).cast("bigint").alias("p"), F.col("first_n").alias("n"))
    last = F.struct(F.col("n_pieces").alias("p"), F.col("last_n").alias("n"))
    ends = shifted.select(
        *keys, "shift", F.explode(F.array_distinct(F.array(first, last))).alias("end")
    )
    session = Window.partitionBy("user_id", F.col("shift") + F.col("end.p"))
    edges = ends.select(
        *keys,
        F.col("end.p").alias("local_session_id"),
        F.coalesce(
            F.sum("end.n").over(session.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("before"),
        F.sum("end.n").over(session).alias("total"),
    )
    return shifted.select(*keys, "shift", "closed"), edges


def _numbered_slices(parts, gap, tie_cols, keep):
    """The hot users' rows with numbers within the user, and in `slice` where they were numbered.

    `keep` names further columns to keep. Slices are numbered once, written, and stitched.
    """
    local = _number_rows(_number_sessions(parts.slices, gap, tie_cols, _SLICED), tie_cols, _SLICED)
    rows = materialize(local.select(
        *_SLICED, "timestamp", *keep, "delta", "local_session_id", "row", "n_rows"
    ), "numbered-slices")
    shifts, edges = _slice_borders(rows, gap)
    stitched = {
        "delta": F.coalesce("delta", F.col("timestamp") - F.col("closed")),
        "row": F.col("row") + F.coalesce("before", F.lit(0)),
        "n_rows": F.coalesce("total", "n_rows"),
        "local_session_id": F.col("local_session_id") + F.coalesce("shift", F.lit(0)),
    }
    joined = rows.join(
        _small(edges, parts.n_slices), [*_SLICED, "local_session_id"], "left"
    ).join(_small(shifts, parts.n_slices), [*_SLICED], "left")
    return joined.select(*(
        stitched[c].alias(c) if c in stitched else F.col(c) for c in rows.columns
    ))


# --- steps on their own ---------------------------------------------------------------


def _numbered(events, gap, tie_cols, hot_rows):
    parts = _parts(events, tie_cols, hot_rows)
    keys = ("user_id",)
    rows = _number_rows(_number_sessions(parts.plain, gap, tie_cols, keys), tie_cols, keys)
    if parts.slices is None:
        return rows
    others = [c for c in events.columns if c not in ("user_id", "timestamp")]
    return rows.unionByName(_numbered_slices(parts, gap, tie_cols, others).drop("slice"))


def event_gaps(events, tie_cols=(), hot_rows=HOT_ROWS):
    """Adds `delta`: time since the user's previous event, null for the first."""
    return _numbered(events, 0, tie_cols, hot_rows).drop("local_session_id", "row", "n_rows")


def local_sessions(events, gap, tie_cols=(), hot_rows=HOT_ROWS):
    """Adds `local_session_id`: 1-based session number within the user."""
    return _numbered(events, gap, tie_cols, hot_rows).drop("delta", "row", "n_rows")


def sessions_of_min_length(events, gap, min_length, tie_cols=(), hot_rows=HOT_ROWS):
    """Events with their local session and its size `n_rows`, short sessions dropped."""
    rows = _numbered(events, gap, tie_cols, hot_rows).drop("delta", "row")
    return rows.filter(F.col("n_rows") >= min_length)


# --- sessions -------------------------------------------------------------------------


def _kept_rows(rows, keys, min_length, max_length, order):
    """Rows (*keys, item_id, timestamp, started, position, n_items) of the sessions that are kept.

    `started` counts the kept sessions that have begun in the timeline so far. Sorted as the
    rows already are, so the running count costs no further sort.
    """
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    kept = rows.filter(F.col("n_rows") >= min_length).withColumn(
        "started", F.sum((F.col("row") == 0).cast("bigint")).over(so_far)
    )
    size, position = F.col("n_rows"), F.col("row")
    if max_length is not None:
        kept = kept.filter(F.col("n_rows") - F.col("row") <= max_length)
        size = F.least("n_rows", F.lit(max_length).cast("bigint"))
        position = F.col("row") - (F.col("n_rows") - size)
    return kept.select(
        *keys, "item_id", "timestamp", "started", position.cast("int").alias("position"), size.alias("n_items")
    )


def build_sessions(
    events,
    gap=schemas.GAP_SECONDS,
    min_length=schemas.MIN_LENGTH,
    max_length=schemas.MAX_LENGTH,
    tie_cols=(),
    keep_size=False,
    hot_rows=HOT_ROWS,
):
    """Sessions: (user_id, session_id, item_id, timestamp, position).

    Sessions shorter than `min_length` are dropped, then the last `max_length` rows of each
    are kept (None keeps all). `session_id` counts from 0 in (user, time) order without
    holes. `keep_size` adds `n_items`, the rows of the session. `hot_rows` is the number of
    rows of one user that a task may sort.
    """
    sessions, _ = sessions_and_users(
        events, gap, min_length, max_length, tie_cols, keep_size, hot_rows
    )
    return sessions


def sessions_and_users(
    events,
    gap=schemas.GAP_SECONDS,
    min_length=schemas.MIN_LENGTH,
    max_length=schemas.MAX_LENGTH,
    tie_cols=(),
    keep_size=False,
    hot_rows=HOT_ROWS,
):
    """`build_sessions`, and the table of the users that have a session."""
    parts = _parts(events.select("user_id", "item_id", "timestamp", *tie_cols), tie_cols, hot_rows)
    keys = ("user_id",)
    local = _number_rows(_number_sessions(parts.plain, gap, tie_cols, keys), tie_cols, keys)
    order = ("local_session_id", "timestamp", *tie_cols)
    rows = materialize(_kept_rows(local, keys, min_length, max_length, order), "kept-rows")
    # The last row of a session is always kept, so a user's highest running count is the number of sessions.
    counts = rows.groupBy("user_id").agg(F.max("started").alias("n_sessions"))
    if parts.slices is not None:
        # Rows of a slice are ordered by what numbers them, as the ties are gone.
        whole = _numbered_slices(parts, gap, tie_cols, ["item_id"])
        sliced = materialize(
            _kept_rows(whole, _SLICED, min_length, max_length, ("local_session_id", "row")), "kept-slices"
        )
        begins = (F.col("row") == 0) & (F.col("n_rows") >= min_length)
        per_slice = materialize(
            whole.groupBy(*_SLICED).agg(F.sum(begins.cast("bigint")).alias("n_sessions")), "slice-counts"
        )
        counts = counts.unionByName(per_slice.groupBy("user_id").agg(F.sum("n_sessions").alias("n_sessions")))
    counts = materialize(counts.filter("n_sessions > 0"), "session-counts")
    low, high, n_users = counts.agg(*(F.coalesce(f("user_id"), F.lit(0)) for f in (F.min, F.max)), F.count(F.lit(1))).first()
    first = exclusive_prefix(counts, "user_id", "n_sessions", low, high).withColumnRenamed("prefix", "first_id")

    columns = [
        F.col("user_id"),
        (F.col("first_id") + F.col("started") - 1).alias("session_id"),
        F.col("item_id"),
        F.col("timestamp"),
        F.col("position"),
        *([F.col("n_items")] if keep_size else []),
    ]
    sessions = rows.join(_sent(first, n_users), "user_id").select(*columns)
    if parts.slices is not None:
        earlier = Window.partitionBy("user_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        starts = per_slice.withColumn(
            "inside", F.coalesce(F.sum("n_sessions").over(earlier), F.lit(0))
        ).join(_sent(first, n_users), "user_id").select(*_SLICED, (F.col("first_id") + F.col("inside")).alias("first_id"))
        sessions = sessions.unionByName(
            sliced.join(_small(starts, parts.n_slices), [*_SLICED]).select(*columns)
        )
    return sessions, counts.select("user_id")


def session_summary(sessions):
    """One row: number of sessions and of users."""
    # Each session has one row at its first position, so users are the groups of those rows.
    return _per_user(sessions).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_sessions"), F.count(F.lit(1)).alias("n_users")
    )


def _per_user(sessions, *by):
    """Rows (*by, user_id, n): sessions of each user."""
    return sessions.filter("position = 0").groupBy(*by, "user_id").agg(F.count(F.lit(1)).alias("n"))


# --- split ----------------------------------------------------------------------------


def _user_hash(seed):
    return F.md5(F.concat_ws(":", F.col("user_id").cast("string"), F.lit(str(seed))))


def split_expression(
    users,
    test_fraction=schemas.TEST_FRACTION,
    val_fraction=schemas.VAL_FRACTION,
    seed=schemas.SEED,
):
    """A column that tells the split of a row from its user_id alone.

    Users are ordered by a seeded hash; the first part is test, the next val, the rest
    train. The two users at the borders are found through the sizes of the 65,536 groups of
    equal leading hash digits, after which any row can be assigned without a join.
    """
    hashed = users.select(_user_hash(seed).alias("h")).withColumn("lead", F.substring("h", 1, 4))
    sizes = sorted(tuple(r) for r in hashed.groupBy("lead").count().collect())
    n_users = sum(size for _, size in sizes)
    n_test = int(n_users * test_fraction)
    n_val = int(n_users * val_fraction)

    # (group, place in the group) of the first user after test and of the first after val
    borders = [_locate(sizes, index) for index in (n_test, n_test + n_val)]
    place = F.row_number().over(Window.partitionBy("lead").orderBy("h"))
    wanted = [b for b in borders if b]
    found = (
        hashed.filter(F.col("lead").isin([lead for lead, _ in wanted]))
        .withColumn("place", place)
        .filter(F.struct("lead", "place").isin(
            [F.struct(F.lit(lead), F.lit(at)) for lead, at in wanted]
        ))
        .collect()
    ) if wanted else []
    hashes = {(r["lead"], r["place"]): r["h"] for r in found}
    # "g" sorts after every hexadecimal digit.
    first_val, first_train = (hashes.get(b, "g") for b in borders)
    own = _user_hash(seed)
    return F.when(own < first_val, "test").when(own < first_train, "val").otherwise("train")


def _locate(sizes, index):
    """(group, 1-based place) of a 0-based index into sorted groups, None past the end."""
    for lead, size in sizes:
        if index < size:
            return lead, index + 1
        index -= size
    return None


def split_sessions(sessions, *fractions_and_seed, users=None, **options):
    """Adds `split`; all sessions of a user fall into the same one."""
    if users is None:
        users = materialize(sessions.select("user_id").distinct(), "users")
    return sessions.withColumn("split", split_expression(users, *fractions_and_seed, **options))


def split_summary(split):
    """Rows (split, n_users, n_sessions)."""
    return _per_user(split, "split").groupBy("split").agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_sessions")
    )


# --- targets --------------------------------------------------------------------------


def _flag_last(sessions):
    """Adds `is_last`: whether the row is at the session's highest position."""
    if "n_items" in sessions.columns:
        return sessions.withColumn("is_last", F.col("position") == F.col("n_items") - 1)
    # An aggregate and a join on (session, position): no task ever holds a whole session.
    last = sessions.groupBy("session_id").agg(F.max("position").alias("position"))
    return sessions.join(
        last.withColumn("found", F.lit(True)), ["session_id", "position"], "left"
    ).select(*sessions.columns, F.coalesce("found", F.lit(False)).alias("is_last"))


def targets_of(sessions):
    """Targets (session_id, user_id, target_item_id): the last item of each session."""
    return _flag_last(sessions).filter("is_last").select(
        "session_id", "user_id", F.col("item_id").alias("target_item_id")
    )


def context_of(sessions):
    """Context: the sessions without their last item."""
    return _flag_last(sessions).filter(~F.col("is_last")).drop("is_last", "n_items")


def extract_targets(sessions):
    """(context, targets) of the sessions."""
    return context_of(sessions), targets_of(sessions)
