"""Co-occurrence retrieval: items seen near the session's recent items, by summed counts."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionrank import schemas
from sessionrank.functions.skew import BROADCAST_ROWS, HOT_ROWS, hot_keys, salted_join
from sessionrank.functions.staging import materialize

# Sessions are processed in blocks of this many positions, so that a session without
# length limit does not end up in one task.
_BLOCK = 4096
# Strongest edges of an item that retrieval reads first.
HEAD = 512
# Recent items of a session are marked by the bits of longs, this many in each.
_SLOTS = 62
# Lists of the first block that a task takes, and parts of a list by a hash of its items.
_LISTS_PER_TASK, _PARTS = 10_000, 2


def _scan_place(sessions, window):
    """A function of a session's two positions, its own and a partner's: their place in a scan of all sessions.

    A number if the sessions times the longest one fit a bigint, which the smallest of can be found by hashing; a struct otherwise.
    """
    low, high, longest = sessions.agg(F.min("session_id"), F.max("session_id"), F.max("position")).first()
    if low is not None and (high - low + 1) * (longest + 1) * (2 * window + 1) >= 1 << 63:
        return lambda own, other: F.struct("session_id", own.alias("i"), other.alias("j"))
    row = (F.col("session_id") - F.lit(low or 0)).cast("bigint") * F.lit((longest or 0) + 1).cast("bigint")
    return lambda own, other: (row + own) * (2 * window + 1) + (other - own + window)


def _pairs(sessions, window, block, place):
    """One row (lo, hi, lo_first, hi_first) per pair of different items at most `window` positions apart.

    With `place`, lo_first and hi_first tell where a scan in order of sessions and positions meets the pair from the one and from the other
    item: place(own position, partner's position). A row looks ahead only. Rows near the start of a block are repeated at the end of the
    block before, where they serve as partners but do not look ahead themselves.
    """
    number = F.floor(F.col("position") / block)
    blocks = F.array(number)
    if window > 0:
        blocks = F.when(
            (F.col("position") % block < window) & (number > 0), F.array(number, number - 1)
        ).otherwise(blocks)
    rows = sessions.select(
        "session_id", "item_id", "position", number.alias("own"), F.explode(blocks).alias("block")
    )
    ahead = Window.partitionBy("session_id", "block").orderBy("position")
    partners = [F.lead("item_id", step).over(ahead) for step in range(1, window + 1)]
    here, there = F.col("position"), F.col("position") + F.col("step") + 1
    lower = F.col("item_id") < F.col("other")
    forth, back = (place(here, there), place(there, here)) if place else (None, None)
    firsts = [F.when(lower, forth).otherwise(back).alias("lo_first"), F.when(lower, back).otherwise(forth).alias("hi_first")] if place else []
    return (
        rows.withColumn("partners", F.array(*partners))
        .filter(F.col("own") == F.col("block"))
        .select("session_id", "position", "item_id", F.posexplode("partners").alias("step", "other"))
        .filter(F.col("other") != F.col("item_id"))
        .select(
            F.least("item_id", "other").alias("lo"), F.greatest("item_id", "other").alias("hi"), *firsts,
        )
    )


def fit_cooccurrence(sessions, window=schemas.WINDOW, block=_BLOCK, insertion=False):
    """Edges (item_a, item_b, cnt), both directions.

    Counts, over all sessions, how often two different items stand at most `window`
    positions apart. Positions must be 0-based without holes. Each pair is shuffled once,
    the opposite direction is added after counting. With `insertion`, `first` tells when a scan of the sessions in order, position by
    position, first meets item_b near item_a: a number or struct in the order of (session_id, i, j), positions of the two.
    """
    first = [F.min(c).alias(c) for c in ("lo_first", "hi_first")] if insertion else []
    counts = _pairs(sessions, window, block, _scan_place(sessions, window) if insertion else None).groupBy("lo", "hi").agg(
        F.count(F.lit(1)).alias("cnt"), *first
    )
    extra = lambda side: [F.col(f"{side}_first").alias("first")] if insertion else []
    both = F.array(
        F.struct(F.col("lo").alias("item_a"), F.col("hi").alias("item_b"), *extra("lo")),
        F.struct(F.col("hi").alias("item_a"), F.col("lo").alias("item_b"), *extra("hi")),
    )
    return counts.select("cnt", F.inline(both)).select("item_a", "item_b", "cnt", *(["first"] if insertion else []))


def cooccurrence_summary(sessions, edges):
    """One row: items fitted and directed pairs counted."""
    return edges.agg(F.count(F.lit(1)).alias("n_pairs")).select(
        sessions.agg(F.countDistinct("item_id")).scalar().alias("n_items"), "n_pairs"
    )


def recent_items(context, window=schemas.WINDOW):
    """The last `window` rows of each session, with `recency` from 1 (the last)."""
    latest = Window.partitionBy("session_id").orderBy(F.desc("position"))
    return (
        context.select("session_id", "item_id", "position")
        .withColumn("recency", F.row_number().over(latest))
        .filter(F.col("recency") <= window)
        .select("session_id", "item_id", "recency")
    )


def _recent_weights(context, window):
    """Rows (session_id, item_a, uses, slot): recent items, repeats counted.

    `slot` numbers a session's items by their latest use, 0 for its last item.
    """
    return recent_items(context, window).groupBy(
        "session_id", F.col("item_id").alias("item_a")
    ).agg(
        F.count(F.lit(1)).alias("uses"),
        (F.min("recency") - 1).alias("slot"),
    )


def _score():
    return F.sum(F.col("uses") * F.col("cnt"))


def _last_count():
    return F.sum(F.when(F.col("slot") == 0, F.col("cnt")).otherwise(0))


def _reach(edges, recent, hot):
    """Recent items joined with their neighbours."""
    return salted_join(recent, edges, ["item_a"], "inner", hot, "item_a", ["session_id"])


def _unseen_scores(reached, context, **more):
    """Scores per (session, item_b) of the reached items, those in the context left out.

    The context takes part in the grouping as rows that mark an item as seen, which spares
    the scores a join of their own.
    """
    marks = context.select(
        "session_id", F.col("item_id").alias("item_b"), F.lit(True).alias("seen")
    )
    return (
        reached.unionByName(marks, allowMissingColumns=True)
        .groupBy("session_id", "item_b")
        .agg(
            F.max("seen").alias("seen"), _score().alias("score"),
            _last_count().alias("last_count"), *(e.alias(name) for name, e in more.items()),
        )
        .filter(F.col("seen").isNull())
        .drop("seen")
    )


def cooccurrence_scores(edges, context, window=schemas.WINDOW, hot_rows=HOT_ROWS):
    """Scores (session_id, item_id, score) of every candidate, context items excluded."""
    recent = materialize(_recent_weights(context, window), "recent")
    hot = hot_keys(recent, "item_a", hot_rows)
    return _unseen_scores(_reach(edges, recent, hot), context).select(
        "session_id", F.col("item_b").alias("item_id"), "score"
    )


def _marks(window):
    """Columns mark_0, mark_1, ...: the bit of the slot that a candidate was reached in."""
    slot = F.col("slot")
    return {
        f"mark_{n}": F.when(
            F.floor(slot / _SLOTS) == n, F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % _SLOTS).cast("int"))
        ).otherwise(F.lit(0).cast("bigint"))
        for n in range(-(-max(window, 1) // _SLOTS))
    }


def _reached_in(slot, window):
    """Whether a candidate's marks have the slot."""
    return F.coalesce(*(
        F.when(F.floor(slot / _SLOTS) == n, F.call_function("shiftright", F.col(name), (slot % _SLOTS).cast("int")).bitwiseAND(F.lit(1)) == 1)
        for n, name in enumerate(_marks(window))
    ), F.lit(False))


def impact_blocks(edges, head=HEAD, hot_rows=HOT_ROWS, n_items=None):
    """Rows (item_a, item_b, cnt, following, block): each item's edges, strongest first, in blocks of doubling length.

    Block 0 holds the `head` strongest edges of an item, block 1 the next `head`, then 2 x `head` and so on. The last
    edge of a block that is not the item's last has `following`, the count of the strongest edge beyond it. Items with more than
    `hot_rows` edges are cut into slices of falling counts, numbered apart; they are looked for unless there are fewer than that
    many items, `n_items`. In that case `edges` is read once.
    """
    strongest = Window.partitionBy("item_a", "slice").orderBy(F.desc("cnt"), "item_b")
    hot = None if n_items is not None and n_items <= hot_rows else hot_keys(edges, "item_a", hot_rows)
    sliced = edges.withColumn("slice", F.lit(0))
    if hot is not None:
        sliced = _strength_slices(edges, hot, hot_rows)
    extra = [c for c in ("first",) if c in edges.columns]
    placed = sliced.select(
        "item_a", "item_b", "cnt", *extra, "slice", F.row_number().over(strongest).alias("place"), F.lead("cnt").over(strongest).alias("next"),
        *([] if hot is None else ["before", "below"]),
    )
    if hot is not None:
        placed = placed.select(
            "item_a", "item_b", "cnt", *extra, (F.col("place") + F.col("before")).alias("place"), F.coalesce("next", "below").alias("next")
        )
    blocks = placed.withColumn("turn", F.floor((F.col("place") - 1) / F.lit(head)))
    whole = (F.col("place") % head == 0) & (F.col("turn").bitwiseAND(F.col("turn") + 1) == 0)
    return blocks.select(
        "item_a", "item_b", "cnt", *extra, F.when(whole, F.col("next")).alias("following"),
        F.when(F.col("turn") == 0, 0).otherwise(F.length(F.bin("turn"))).alias("block"),
    )


def _strength_slices(edges, hot, hot_rows):
    """Edges with a slice number, the edges of the item in slices before it, and the count of the first edge after it.

    The counts of a hot item are added up by (count, hash of the neighbour), so that many equal counts are split as well; a slice ends
    where the edges so far fill one. An item has at most as many slices as its edges fill, and few (count, part) groups to a slice.
    """
    parts = F.coalesce("parts", F.lit(1))
    table = edges.join(hot.named("item_a").hinted(), "item_a", "left")
    # neighbours in order of their ids, cut at the same ids for every count
    width = F.when(parts > 1, F.ceil((F.col("high") - F.col("low") + 1) / (parts * 4))).otherwise(F.lit(None))
    span = edges.join(hot.named("item_a").hinted(), "item_a", "left_semi").groupBy("item_a").agg(F.min("item_b").alias("low"), F.max("item_b").alias("high"))
    span = materialize(span, "spans")
    cut = table.join(F.broadcast(span) if hot.n <= BROADCAST_ROWS else span, "item_a", "left").withColumn(
        "range", F.coalesce(F.floor((F.col("item_b") - F.col("low")) / width), F.lit(0))
    )
    sizes = cut.filter(parts > 1).groupBy("item_a", "cnt", "range").agg(F.count(F.lit(1)).alias("n"))
    so_far = Window.partitionBy("item_a").orderBy(F.desc("cnt"), "range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("upto", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
    sizes = sizes.withColumn("slice", F.floor(F.col("upto") / hot_rows).cast("int"))
    ends = Window.partitionBy("item_a").orderBy("slice")
    slices = sizes.groupBy("item_a", "slice").agg(F.min("upto").alias("before"), F.max("cnt").alias("top"))
    slices = slices.withColumn("below", F.lead("top").over(ends)).drop("top")
    of_group = materialize(sizes.join(slices, ["item_a", "slice"]).select("item_a", "cnt", "range", "slice", "before", "below"), "slices")
    return cut.join(of_group, ["item_a", "cnt", "range"], "left").select(
        *edges.columns, F.coalesce("slice", F.lit(0)).alias("slice"), F.coalesce("before", F.lit(0)).alias("before"), "below"
    )


def _packed_reach(edges, recent, context, hot):
    """What `_reach` gives for the first edges of the items, and the context as marks, with a `part`: rows of a session and part are in one task.

    Lists go as arrays of up to `head` numbers, which a shuffle carries in far fewer bytes than a row for each candidate. The
    candidates of a part are grouped where they are, and cut to the best before the parts of a session meet.
    """
    part = lambda item: F.pmod(F.xxhash64(item), F.lit(_PARTS)).cast("int")
    names = [c for c in edges.columns if c != "item_a"]
    lists = edges.groupBy("item_a").agg(F.collect_list(F.struct(*names)).alias("list"))
    lists = lists.select("item_a", "list", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))).alias("part")).withColumn(
        "list", F.filter("list", lambda edge: part(edge["item_b"]) == F.col("part"))
    )
    lists = lists.select("item_a", "part", *[F.col(f"list.{c}").alias(c) for c in names])
    blank = lambda c: F.col("item_id") if c == "item_b" else F.lit(None).cast(edges.schema[c].dataType)
    marks = context.select(
        "session_id", part(F.col("item_id")).alias("part"), *[F.array(blank(c)).alias(c) for c in names], F.lit(True).alias("seen"),
    )
    tasks = max(int(recent.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-recent.count() // _LISTS_PER_TASK))
    dealt = _reach(lists, recent, hot).drop("item_a").unionByName(marks, allowMissingColumns=True).repartition(tasks, "session_id", "part")
    return dealt.select("session_id", "part", "uses", "slot", "seen", F.inline(F.arrays_zip(*names)))


def _missing(lists, window):
    """The open lists of a session in which a candidate was not reached yet."""
    return F.filter(lists, lambda entry: ~_reached_in(entry["slot"], window))


def retrieve_cooccurrence(
    edges, context, top_k, window=schemas.WINDOW, head=None, hot_rows=HOT_ROWS, blocks=None, trace=None, insertion=False, least=0
):
    """Recommendations (session_id, item_id, score, rank, cooc_score_last_item).

    Score: summed counts next to the last `window` items, repeats counted. Items anywhere
    in the context are left out; equal scores are ordered by item_id. Sessions without a
    candidate have no row. `edges` is read more than once: pass a stage table.

    Each item's edges are read strongest first, in the blocks of `impact_blocks` (`blocks`, a stage table made with the
    same `head`, can be kept in place of the edges). After a block, the strongest edge not read yet bounds what each list can still add. A
    session is settled when its k-th best score so far is above the sum of those bounds: no unreached candidate can make
    its list, and only the reached ones that can still make it have their missing counts looked up. The others read the next,
    twice as long block, until they are settled or their lists end; so the result does not depend on `head`. A candidate
    that cannot make the list is left out at once: its bound only falls, the k-th score only rises. A step costs a pass over all
    candidates so far, so lists whose blocks are short are not followed block by block: with `least`, the second step reads the first
    blocks up to that many edges of an item, once more from the front.
    `cooc_score_last_item` is the candidate's count next to the session's last item, which
    is at hand here and saves the ranking matrix a join. With `insertion` (and edges fitted with it) equal scores are in the order in which a
    loop over the recent items, the last one first, and over their neighbours, first met first, comes upon them. `trace`, a list, gets (block, sessions, edges read) of each step, at the price of counting.
    """
    if blocks is None:
        blocks = materialize(impact_blocks(edges, head or HEAD, hot_rows), "blocks", ["block"])
    recent = materialize(_recent_weights(context, window), "recent")
    hot = hot_keys(recent, "item_a", hot_rows)
    best = Window.partitionBy("session_id").orderBy(F.desc("score"), "first" if insertion else "item_b")
    kept = ["session_id", "item_b", "score", "last_count", *(["first"] if insertion else [])]
    edge = ["item_a", "item_b", "cnt", *(["first"] if insertion else [])]
    ends = blocks.filter("following IS NOT NULL").select("item_a", "block", "following")
    marks = list(_marks(window))
    carried, block, done = None, 0, []
    start = 0  # the blocks from this one to `block` are read in a step
    while True:
        ceilings = ends.filter(F.col("block") == block).select("item_a", F.col("following").alias("ceiling"))
        lists = salted_join(recent, ceilings, ["item_a"], "left", hot, "item_a", ["session_id"]).na.fill(0, ["ceiling"])
        some = blocks.filter(F.col("block").between(start, block)).select(edge)
        found = _reach(some, recent, hot) if start else _packed_reach(some, recent, context, hot)
        if trace is not None:
            trace.append((block, recent.select("session_id").distinct().count(), found.filter("cnt IS NOT NULL").count()))
        reached = _accumulated(found, carried, context, window)
        if not ceilings.limit(1).count():
            # Every list has been read to its end.
            done.append(reached.select(kept))
            break
        entry = F.when(F.col("ceiling") > 0, F.struct("item_a", "uses", "slot", "ceiling"))
        sessions = materialize(lists.groupBy("session_id").agg(
            F.sum(F.col("uses") * F.col("ceiling")).alias("bound"), F.collect_list(entry).alias("open"),  # at most `window` entries
        ), "open-lists")
        # The k-th score is known from the k-th row on, which is where it matters.
        so_far = best.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        kth = F.max(F.when(F.col("place") == top_k, F.col("score"))).over(so_far)
        rated = reached.join(sessions, "session_id").withColumn("place", F.row_number().over(best)).withColumn("kth", kth)
        missing = _missing("open", window)
        most = F.col("score") + F.aggregate(missing, F.lit(0).cast("bigint"), lambda sum, entry: sum + entry["uses"] * entry["ceiling"])
        judged = materialize(
            rated.withColumn("most", most).filter(F.col("kth").isNull() | (F.col("most") >= F.col("kth"))).select(
                *kept, *marks, "bound", "place", "kth", "most", missing.alias("missing"),
            ), "judged",
        )
        cuts = materialize(judged.filter(F.col("place") == top_k).select("session_id", F.col("score").alias("cut")), "cuts")
        settled = sessions.select("session_id", "bound").join(cuts, "session_id", "left").filter(
            (F.col("bound") == 0) | (F.col("cut") > F.col("bound"))
        )
        settled = materialize(settled.select("session_id", "cut"), "settled")
        mine = judged.join(settled, "session_id").filter(F.col("cut").isNull() | (F.col("most") >= F.col("cut")))
        whole = (F.col("bound") == 0) | (F.size("missing") == 0)
        done.append(mine.filter(whole).select(kept))
        done.append(_completed(mine.filter(~whole), blocks.select(edge), hot).select(kept))
        rest = materialize(sessions.select("session_id").join(settled, "session_id", "left_anti"), "unsettled")
        if not rest.limit(1).count():
            break
        recent = materialize(recent.join(rest, "session_id", "left_semi"), "recent")
        context = context.join(rest, "session_id", "left_semi")
        if not block and (head or HEAD) < least:
            block = (-(-least // (head or HEAD)) - 1).bit_length()  # block n ends with edge head << n of an item
            continue
        carried = judged.join(rest, "session_id", "left_semi").select(*kept, *marks)
        start = block = block + 1
    exact = done[0]
    for more in done[1:]:
        exact = exact.unionByName(more)
    return (
        exact.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top_k)
        .select(
            "session_id", F.col("item_b").alias("item_id"), "score", "rank",
            F.col("last_count").cast("double").alias("cooc_score_last_item"),
        )
    )


def _met_first(met):
    """(slot, met) of the lowest slot. A slot reaches a candidate once; a smallest struct would take an aggregation that sorts."""
    return F.struct(F.min("slot").alias("slot"), F.min_by(met, "slot").alias("met"))


def _accumulated(found, carried, context, window):
    """Scores per (session, item_b) of the edges found and of what was carried over, context items left out, with the slots reached."""
    marks = _marks(window)
    met = ["slot", "met"] if "first" in found.columns else []
    rows = found.select(
        "session_id", "item_b", (F.col("uses") * F.col("cnt")).alias("score"),
        F.when(F.col("slot") == 0, F.col("cnt")).otherwise(0).alias("last_count"), *[mark.alias(name) for name, mark in marks.items()],
        *(["slot", F.col("first").alias("met")] if met else []), *[c for c in found.columns if c in ("part", "seen")],
    )
    if carried is not None:
        rows = rows.unionByName(carried.select(*[c for c in carried.columns if c != "first"], *[f"first.{c}" for c in met]))
    if "seen" not in rows.columns:
        seen = context.select("session_id", F.col("item_id").alias("item_b"), F.lit(True).alias("seen"))
        rows = rows.unionByName(seen, allowMissingColumns=True)
    return (
        rows.groupBy("session_id", *[c for c in found.columns if c == "part"], "item_b")
        .agg(F.max("seen").alias("seen"), F.sum("score").alias("score"), F.sum("last_count").alias("last_count"),
             *[F.bit_or(name).alias(name) for name in marks], *([_met_first("met").alias("first")] if met else []))
        .filter(F.col("seen").isNull()).drop("seen", "part")
    )


def _completed(candidates, edges, hot):
    """Candidates with the counts looked up that their missing lists hold for them."""
    first = ["first"] if "first" in edges.columns else []
    asked = candidates.select("session_id", "item_b", F.inline("missing"))
    added = salted_join(asked, edges, ["item_a", "item_b"], "inner", hot, "item_a", ["session_id"]).groupBy(
        "session_id", "item_b"
    ).agg(
        _score().alias("more"), _last_count().alias("more_last"),
        *[_met_first(c).alias("more_first") for c in first],
    )
    return candidates.join(added, ["session_id", "item_b"], "left").select(
        "session_id", "item_b", (F.col("score") + F.coalesce("more", F.lit(0))).alias("score"),
        (F.col("last_count") + F.coalesce("more_last", F.lit(0))).alias("last_count"),
        *[F.array_min(F.array(c, "more_first")).alias(c) for c in first],
    )
