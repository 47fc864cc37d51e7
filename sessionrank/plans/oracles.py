"""DuckDB SQL for the registered queries, written apart from the Spark code.

Shared steps are common table expressions; a query names the ones it ends on and gets the
ones they build on as well.
"""

_DENSE = """
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         epoch_us(ts) AS "timestamp", event_id AS tie
  FROM events"""

_SPARSE = """
  SELECT o_custkey AS user_id, l_partkey AS item_id, epoch_us(o_orderdate) AS "timestamp",
         row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                            l_extendedprice, l_shipdate) AS tie
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

# Days as timestamps, and the events of a day in the order of their lines: in three files, by a hash in each.
_BY_DAY = """
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS "timestamp",
         row_number() OVER (ORDER BY event_id % 3, md5(CAST(event_id AS VARCHAR))) AS tie
  FROM events"""

# log: (events, gap in microseconds)
_LOGS = {"by_day": (_BY_DAY, 1), "dense": (_DENSE, 86400000000), "sparse": (_SPARSE, 180 * 86400000000)}

# name: (steps it builds on, SQL)
# The genres of the items.
_GENRES = [
    "anvil", "blue", "bolt", "cold", "economy", "gear", "gizmo", "hot", "large", "medium",
    "new", "old", "plate", "promo", "red", "ring", "rod", "small", "standard", "widget",
]
_FLAGS = ", ".join(
    f"CAST(list_contains(genre_list, '{g}') AS INTEGER) AS genre_{g}" for g in _GENRES
)
_FLAGS_OR_0 = ", ".join(
    f"CAST(coalesce(list_contains(genre_list, '{g}'), false) AS INTEGER) AS genre_{g}"
    for g in _GENRES
)

_STEPS = {
    "gaps": (["ev"], """
  SELECT *, "timestamp" - lag("timestamp") OVER
         (PARTITION BY user_id ORDER BY "timestamp", tie) AS delta FROM ev"""),
    "loc": (["gaps"], """
  SELECT *, CAST(sum(CASE WHEN delta IS NULL OR delta > {gap} THEN 1 ELSE 0 END) OVER
         (PARTITION BY user_id ORDER BY "timestamp", tie
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS lsid FROM gaps"""),
    "sized": (["loc"], """
  SELECT *, count(*) OVER (PARTITION BY user_id, lsid) AS n_rows,
         row_number() OVER (PARTITION BY user_id, lsid ORDER BY "timestamp" DESC, tie DESC) AS rev
  FROM loc"""),
    "sess": (["sized"], """
  SELECT user_id, dense_rank() OVER (ORDER BY user_id, lsid) - 1 AS session_id, item_id,
         "timestamp", CAST(row_number() OVER
           (PARTITION BY user_id, lsid ORDER BY "timestamp", tie) - 1 AS INTEGER) AS position
  FROM sized WHERE n_rows >= 2 AND rev <= {max_length}"""),
    "split": (["sess"], """
  SELECT user_id,
         CASE WHEN r <= floor(n * CAST(0.2 AS DOUBLE)) THEN 'test'
              WHEN r <= floor(n * CAST(0.2 AS DOUBLE)) + floor(n * CAST(0.1 AS DOUBLE)) THEN 'val'
              ELSE 'train' END AS split
  FROM (SELECT user_id, count(*) OVER () AS n,
               row_number() OVER (ORDER BY md5(concat(user_id, ':', 42))) AS r
        FROM (SELECT DISTINCT user_id FROM sess))"""),
    "spl": (["sess", "split"], "SELECT * FROM sess JOIN split USING (user_id)"),
    "lastpos": (["spl"], """
  SELECT *, max(position) OVER (PARTITION BY session_id) AS last_position FROM spl"""),
    "ctx_all": (["lastpos"], "SELECT * FROM lastpos WHERE position < last_position"),
    "tgt_all": (["lastpos"], """
  SELECT session_id, user_id, item_id AS target_item_id, split FROM lastpos
  WHERE position = last_position"""),
    "train": (["spl"], "SELECT * FROM spl WHERE split = 'train'"),
    "ctx": (["ctx_all"], "SELECT * FROM ctx_all WHERE split = '{split}'"),
    "tgt": (["tgt_all"], "SELECT * FROM tgt_all WHERE split = '{split}'"),
    # features
    "counts": (["train"], """
  SELECT item_id, count(*) AS item_global_count,
         count(DISTINCT user_id) AS item_unique_users,
         count(DISTINCT session_id) AS item_unique_sessions FROM train GROUP BY item_id"""),
    "item": (["counts"], """
  SELECT *, rank() OVER (ORDER BY item_global_count DESC) AS item_global_rank,
         CAST(item_global_count >= (SELECT quantile_cont(item_global_count, 0.8) FROM counts)
              AS INTEGER) AS item_is_head FROM counts"""),
    "meta": ([], """
  SELECT p_partkey AS item_id,
         string_split(lower(p_type) || '|' || replace(p_name, ' ', '|'), '|') AS genre_list FROM part"""),
    "ustats": (["train"], """
  SELECT user_id, CAST(sum(n) AS BIGINT) AS user_total_interactions,
         count(*) AS user_total_sessions, avg(n) AS user_mean_session_length
  FROM (SELECT user_id, session_id, count(*) AS n FROM train GROUP BY ALL) GROUP BY user_id"""),
    "users": (["ustats"], """
  SELECT *, CAST(user_total_interactions >=
         (SELECT quantile_cont(user_total_interactions, 0.8) FROM ustats) AS INTEGER)
         AS user_is_dense FROM ustats"""),
    "sctx": (["ctx"], """
  SELECT session_id, count(*) AS session_length, max_by(item_id, position) AS last_item_id,
         coalesce(max(CASE WHEN back = 2 THEN item_id END), 0) AS second_last_item_id
  FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY position DESC) AS back
        FROM ctx) GROUP BY session_id"""),
    # retrieval
    "cooc": (["train"], """
  SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS cnt
  FROM train a JOIN train b ON a.session_id = b.session_id
   AND abs(a.position - b.position) <= 5 AND a.item_id <> b.item_id
  GROUP BY a.item_id, b.item_id"""),
    "recent": (["ctx"], """
  SELECT * FROM (SELECT session_id, item_id, CAST(row_number() OVER
    (PARTITION BY session_id ORDER BY position DESC) AS INTEGER) AS recency FROM ctx)
  WHERE recency <= 5"""),
    "scores": (["recent", "cooc", "ctx"], """
  SELECT session_id, item_b AS item_id, CAST(sum(cnt) AS BIGINT) AS score
  FROM recent JOIN cooc ON recent.item_id = cooc.item_a
  WHERE NOT EXISTS (SELECT 1 FROM ctx WHERE ctx.session_id = recent.session_id
                    AND ctx.item_id = cooc.item_b)
  GROUP BY session_id, item_b"""),
    "cooc_recs": (["scores"], """
  SELECT * FROM (SELECT *, CAST(row_number() OVER
    (PARTITION BY session_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM scores)
  WHERE rank <= 100"""),
    "pop": (["train"], """
  SELECT item_id, n, CAST(rank AS INTEGER) AS rank FROM (
    SELECT item_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, item_id) AS rank
    FROM train GROUP BY item_id) WHERE rank <= 100"""),
    "pop_recs": (["pop", "ctx"], """
  SELECT session_id, item_id, n AS score, rank
  FROM (SELECT DISTINCT session_id FROM ctx) CROSS JOIN pop"""),
    # ranking
    "matrix": (["cooc_recs", "sctx", "tgt", "item", "meta", "users", "cooc"], """
  SELECT r.session_id, r.item_id AS candidate_item_id, s.session_length, s.last_item_id,
         s.second_last_item_id, t.user_id,
         coalesce(i.item_global_count, 0) AS item_global_count,
         coalesce(i.item_unique_users, 0) AS item_unique_users,
         coalesce(i.item_unique_sessions, 0) AS item_unique_sessions,
         coalesce(i.item_global_rank, 0) AS item_global_rank,
         coalesce(i.item_is_head, 0) AS item_is_head, {flags},
         coalesce(u.user_total_interactions, 0) AS user_total_interactions,
         coalesce(u.user_total_sessions, 0) AS user_total_sessions,
         coalesce(u.user_mean_session_length, 0) AS user_mean_session_length,
         coalesce(u.user_is_dense, 0) AS user_is_dense,
         CAST(coalesce(c.cnt, 0) AS DOUBLE) AS cooc_score_last_item,
         CAST(r.item_id = t.target_item_id AS INTEGER) AS label
  FROM cooc_recs r LEFT JOIN sctx s USING (session_id) LEFT JOIN tgt t USING (session_id)
  LEFT JOIN item i ON i.item_id = r.item_id LEFT JOIN meta ON meta.item_id = i.item_id
  LEFT JOIN users u ON u.user_id = t.user_id
  LEFT JOIN cooc c ON c.item_a = s.last_item_id AND c.item_b = r.item_id"""),
    "ranked": (["matrix"], """
  SELECT * FROM (
    SELECT session_id, item_id, score, CAST(row_number() OVER
           (PARTITION BY session_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
    FROM (SELECT session_id, candidate_item_id AS item_id,
                 CAST(3 * cooc_score_last_item + 0.5 * item_global_count
                      - 0.25 * item_global_rank AS DOUBLE) AS score FROM matrix))
  WHERE rank <= 10"""),
    # evaluation; `recs` is (system, session_id, item_id, rank), `rel` the relevant sets
    "three": (["pop_recs", "cooc_recs", "ranked"], """
  SELECT 'popularity' AS system, session_id, item_id, rank FROM pop_recs WHERE rank <= 10
  UNION ALL SELECT 'cooccurrence', session_id, item_id, rank FROM cooc_recs WHERE rank <= 10
  UNION ALL SELECT 'cooc+ranker', session_id, item_id, rank FROM ranked"""),
    "two": (["pop_recs", "cooc_recs"], """
  SELECT 'popularity' AS system, session_id, item_id, rank FROM pop_recs
  UNION ALL SELECT 'cooccurrence', session_id, item_id, rank FROM cooc_recs"""),
    "rel": (["tgt"], "SELECT session_id, target_item_id AS item_id FROM tgt"),
    "ks": ([], "SELECT unnest([5, 10, 20]) AS k"),
    "hitk": (["recs", "rel", "ks"], """
  SELECT system, session_id, k, rank, row_number() OVER
         (PARTITION BY system, session_id, k ORDER BY rank) AS i
  FROM recs JOIN rel USING (session_id, item_id) JOIN ks ON rank <= k"""),
    "aggk": (["hitk"], """
  SELECT system, session_id, k, count(*) AS hits, sum(i / rank) AS precisions,
         sum(1 / log2(rank + 1)) AS dcg, sum(1 / log2(i + 1)) AS ideal
  FROM hitk GROUP BY system, session_id, k"""),
    "persession": (["recs", "rel", "ks", "aggk"], """
  SELECT system, session_id, k, coalesce(hits, 0) / n_rel AS recall,
         coalesce(hits, 0) / k AS precision, coalesce(precisions, 0) / least(n_rel, k) AS map,
         coalesce(dcg / ideal, 0) AS ndcg
  FROM (SELECT session_id, count(*) AS n_rel FROM rel GROUP BY session_id)
  CROSS JOIN (SELECT DISTINCT system FROM recs) CROSS JOIN ks
  LEFT JOIN aggk USING (system, session_id, k)"""),
    "rr": (["recs", "rel"], """
  SELECT system, session_id, coalesce(max(1 / rank), 0) AS mrr
  FROM (SELECT DISTINCT session_id FROM rel) CROSS JOIN (SELECT DISTINCT system FROM recs)
  LEFT JOIN (SELECT system, session_id, rank FROM recs JOIN rel USING (session_id, item_id))
  USING (system, session_id) GROUP BY system, session_id"""),
    "long": (["persession", "rr"], """
  SELECT system, session_id, 'recall@' || k AS metric, recall AS value FROM persession
  UNION ALL SELECT system, session_id, 'precision@' || k, precision FROM persession
  UNION ALL SELECT system, session_id, 'map@' || k, map FROM persession
  UNION ALL SELECT system, session_id, 'ndcg@' || k, ndcg FROM persession
  UNION ALL SELECT system, session_id, 'mrr', mrr FROM rr"""),
    "means": (["long"], """
  SELECT system, metric, round(avg(value), 5) AS value FROM long GROUP BY system, metric"""),
    # slices
    "by_length": (["ctx", "tgt"], """
  SELECT session_id, 'session_length' AS slice_type,
         CASE WHEN n <= 3 THEN 'short' WHEN n <= 9 THEN 'medium' ELSE 'long' END AS slice_value
  FROM (SELECT session_id, count(*) AS n FROM ctx GROUP BY session_id)
  JOIN tgt USING (session_id)"""),
    "by_popularity": (["item", "tgt"], """
  SELECT session_id, 'item_popularity' AS slice_type,
         CASE WHEN item_is_head = 1 THEN 'head' ELSE 'tail' END AS slice_value
  FROM tgt LEFT JOIN item ON item_id = target_item_id"""),
    "by_density": (["train", "tgt"], """
  SELECT session_id, 'user_density' AS slice_type, bucket AS slice_value
  FROM tgt JOIN (
    SELECT user_id, CASE WHEN n <= lo THEN 'sparse' WHEN n >= hi THEN 'dense' END AS bucket
    FROM (SELECT user_id, count(*) AS n FROM train GROUP BY user_id),
         (SELECT quantile_cont(n, 0.4) AS lo, quantile_cont(n, 0.6) AS hi
          FROM (SELECT count(*) AS n FROM train GROUP BY user_id))) USING (user_id)
  WHERE bucket IS NOT NULL"""),
    "tags": (["by_length", "by_popularity", "by_density"], """
  SELECT * FROM by_length UNION ALL SELECT * FROM by_popularity
  UNION ALL SELECT * FROM by_density"""),
    "sliced": (["tags", "long"], """
  SELECT slice_type, slice_value, count(*) AS n_sessions, metric,
         round(avg(value), 5) AS value, system
  FROM tags JOIN long USING (session_id) GROUP BY ALL"""),
    # errors
    "ranks": (["recs", "tgt"], """
  SELECT s.system, t.session_id, t.target_item_id,
         CAST(coalesce(min(r.rank), -1) AS INTEGER) AS target_rank
  FROM tgt t CROSS JOIN (SELECT DISTINCT system FROM recs) s
  LEFT JOIN recs r ON r.system = s.system AND r.session_id = t.session_id
   AND r.item_id = t.target_item_id
  GROUP BY s.system, t.session_id, t.target_item_id"""),
    "report": (["ranks", "ctx", "item"], """
  SELECT system, session_id, target_item_id, target_rank, session_length,
         item_global_count AS item_train_count, coalesce(item_is_head, 0) AS item_is_head,
         target_rank BETWEEN 1 AND 10 AS hit_at_k
  FROM ranks LEFT JOIN (SELECT session_id, count(*) AS session_length FROM ctx GROUP BY 1)
  USING (session_id) LEFT JOIN item ON item_id = target_item_id"""),
    "report100": (["report"], "SELECT * FROM report WHERE system = 'cooccurrence'"),
}


def _sql(body, needs, log="dense", split="test", recs="three", max_length=50, rel=None):
    events, gap = _LOGS[log]
    steps = {
        **_STEPS,
        "ev": ([], events),
        "recs": ([recs], f"SELECT * FROM {recs}"),
    }
    if rel:
        steps["rel"] = (["ctx", "tgt"], rel)
    order = []

    def visit(name):
        if name not in order:
            for base in steps[name][0]:
                visit(base)
            order.append(name)

    for name in needs:
        visit(name)
    values = {"{gap}": gap, "{split}": split, "{max_length}": max_length,
              "{flags}": _FLAGS_OR_0}
    parts = []
    for name in order:
        text = steps[name][1]
        for mark, value in values.items():
            text = text.replace(mark, str(value))
        parts.append(f"{name} AS MATERIALIZED ({text})")
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body


def _metric_columns(*families):
    return ", ".join(
        f"round(max(CASE WHEN k = {k} THEN {f} END), 6) AS {f}_{k}"
        for f in families for k in (5, 10, 20)
    )


def _per_session(family):
    return _sql(
        f"SELECT session_id, {_metric_columns(family)} FROM persession "
        "WHERE system = 'cooccurrence' GROUP BY session_id",
        ["persession"], recs="two",
    )


def _pivot(names, key="metric"):
    return ", ".join(f"max(CASE WHEN {key} = '{n}' THEN value END) AS \"{n}\"" for n in names)


# Metric columns by family and k.
_ORDERED = [
    "map@5", "map@10", "map@20", "mrr", "ndcg@5", "ndcg@10", "ndcg@20", "precision@5",
    "precision@10", "precision@20", "recall@5", "recall@10", "recall@20",
]
_SYSTEMS = ["popularity", "cooccurrence", "cooc+ranker"]
# The ranker's features in order.
_FEATURES = [
    "session_length", "item_global_count", "item_global_rank", "item_unique_users", "item_unique_sessions",
    "item_is_head", "user_total_interactions", "user_total_sessions", "user_mean_session_length", "user_is_dense",
    "cooc_score_last_item", *(f"genre_{g}" for g in _GENRES),
]
# Facts that hold for no tree or round.
_LEAFWISE_FACTS = [
    "trees with too many leaves", "trees without a root", "nodes that are not the child of one node", "children that are no nodes",
    "splits without gain", "leaves with too few rows", "splits whose children have other rows", "rounds of a sample that raised its loss",
    "rounds beyond the best one and patience", "kept rounds after the best", "rounds fitted short of patience",
]
# Every item of a session, context or target, as relevant.
_WHOLE_SESSION = """
  SELECT session_id, item_id FROM ctx UNION SELECT session_id, target_item_id FROM tgt"""
_SESSION_COLUMNS = 'user_id, session_id, item_id, "timestamp", position'
_SUMMARY = ["session_id", "target_item_id", "target_rank", "session_length",
            "item_train_count", "item_is_head"]


_VECTORS = """
  SELECT c.session_id, c.item_id, v.embedding FROM ctx_all c
  JOIN (SELECT vec_id, embedding FROM embeddings) v ON v.vec_id = c.item_id + {shift}"""


# The vectors at lengths that differ.
_SCALED = "SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (1 / (1 + vec_id % 50))) AS embedding FROM embeddings"


def _embedding(shift, vectors="SELECT vec_id, embedding FROM embeddings", top_k=20):
    known = _VECTORS.replace("{shift}", str(shift)).replace("SELECT vec_id, embedding FROM embeddings", vectors)
    return f"""SELECT * FROM (
  SELECT session_id, item_id, score,
         CAST(row_number() OVER (PARTITION BY session_id ORDER BY score DESC, item_id) AS INTEGER)
         AS rank
  FROM (
    SELECT m.session_id, e.vec_id AS item_id,
           round(list_dot_product(m.vector, CAST(e.embedding AS DOUBLE[])), 6) AS score
    FROM (SELECT session_id, list(x ORDER BY dim) AS vector FROM (
            SELECT session_id, dim, avg(CAST(embedding[dim] AS DOUBLE)) AS x
            FROM ({known}), (SELECT unnest(range(1, 65)) AS dim)
            GROUP BY session_id, dim) GROUP BY session_id) m, ({vectors}) e
    WHERE NOT EXISTS (SELECT 1 FROM ctx_all c WHERE c.session_id = m.session_id
                      AND c.item_id + {shift} = e.vec_id)))
WHERE rank <= {top_k}"""


def _leafwise(splits):
    """Steps of the first splits of one tree on all rows of `matrix`: s1, s2, ... and the leaves after them.

    Derivatives are those of the log loss at the mean label, as multiples of 2^-30; at most 255 bins a feature.
    """
    long = " UNION ALL ".join(
        f"SELECT r, {i} AS f, CAST({name} AS DOUBLE) AS v FROM numbered" for i, name in enumerate(_FEATURES)
    )
    steps = [
        ("numbered", "SELECT *, row_number() OVER () AS r FROM matrix"),
        ("derivatives", "SELECT r, CAST(round((p - label) * 1073741824) AS BIGINT) AS g, CAST(round(p * (1 - p) * 1073741824) AS BIGINT) AS h "
                        "FROM numbered, (SELECT avg(label) AS p FROM numbered)"),
        ("cells", long),
        ("kinds", "SELECT *, count(*) OVER (PARTITION BY f) AS kinds, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS place, "
                  "sum(n) OVER (PARTITION BY f ORDER BY v) - n AS before, sum(n) OVER (PARTITION BY f) AS every "
                  "FROM (SELECT f, v, count(*) AS n FROM cells GROUP BY f, v)"),
        ("bins", "SELECT f, bin, min(v) AS low, max(v) AS high FROM (SELECT *, CASE WHEN kinds <= 255 THEN place "
                 "ELSE floor(CAST(before * 255 AS DOUBLE) / every) END AS bin FROM kinds) GROUP BY f, bin"),
        ("edges", "SELECT f, high + (following - high) / 2 AS edge FROM "
                  "(SELECT *, lead(low) OVER (PARTITION BY f ORDER BY bin) AS following FROM bins) WHERE following IS NOT NULL"),
        ("binned", "SELECT r, cells.f, edge FROM cells LEFT JOIN (SELECT DISTINCT kinds.f, v, min(edge) AS edge FROM kinds JOIN edges "
                   "ON kinds.f = edges.f AND v <= edge GROUP BY kinds.f, v) e ON cells.f = e.f AND cells.v = e.v"),
        ("leaf0", "SELECT r, 0 AS leaf FROM numbered"),
    ]
    score = lambda g, h: f"pow(greatest(abs({g} / 1073741824) - 0.05, 0), 2) / ({h} / 1073741824 + 0.05)"
    for i in range(1, splits + 1):
        steps += [
            (f"hist{i}", f"SELECT leaf, f, edge, sum(g) AS g, sum(h) AS h, count(*) AS n FROM binned JOIN leaf{i - 1} USING (r) "
                         "JOIN derivatives USING (r) GROUP BY leaf, f, edge"),
            (f"sums{i}", "SELECT leaf, f, edge, "
                         + ", ".join(f"sum({c}) OVER upto AS {c}l, sum({c}) OVER every AS {c}" for c in "ghn")
                         + f" FROM hist{i} WINDOW upto AS (PARTITION BY leaf, f ORDER BY edge NULLS LAST), every AS (PARTITION BY leaf, f)"),
            (f"s{i}", f"SELECT * FROM (SELECT *, {score('gl', 'hl')} + {score('(g - gl)', '(h - hl)')} - {score('g', 'h')} AS gain FROM sums{i} "
                      "WHERE edge IS NOT NULL AND nl >= 20 AND n - nl >= 20 AND hl >= 1073741.824 AND h - hl >= 1073741.824) "
                      "WHERE gain > 0 ORDER BY gain DESC, leaf, f, edge LIMIT 1"),
            (f"leaf{i}", f"SELECT l.r, CASE WHEN l.leaf <> s{i}.leaf THEN l.leaf WHEN v <= edge THEN {2 * i - 1} ELSE {2 * i} END AS leaf "
                         f"FROM leaf{i - 1} l, s{i} JOIN cells ON cells.f = s{i}.f WHERE cells.r = l.r"),
        ]
    return steps


def _tree_sql(body):
    base = _sql("", ["matrix"], split="train")
    return base.rstrip() + "".join(f", {name} AS MATERIALIZED ({text})" for name, text in _leafwise(3)) + "\n" + body


_SPLITS = " UNION ALL ".join(f"SELECT {i - 1} AS place, * FROM s{i}" for i in (1, 2, 3))
_NAMES = "(VALUES " + ", ".join(f"({i}, '{n}')" for i, n in enumerate(_FEATURES)) + ") names(f, feature)"

# The trees of the saved text: (tree, node, feature, threshold, left, right), children below 0 being leaves.
_SAVED_NODES = """(VALUES (0, 0, 'cooc_score_last_item', 1.5, 1, 2), (0, 1, 'item_global_rank', 40.5, -1, -3), (0, 2, 'session_length', 3.5, -2, -4),
  (1, 0, 'item_is_head', 0.5, -1, 1), (1, 1, 'cooc_score_last_item', 0.5, -2, -3)) nodes(tree, node, feature, threshold, l, r)"""
# Zeros count as missing in one split, and missing values go right there.
_SAVED_LEAVES = """(VALUES (0, -1, -2.5), (0, -2, -1.25), (0, -3, -3.0), (0, -4, -0.5), (1, -1, -0.125), (1, -2, 0.25), (1, -3, 0.75))
  leaves(tree, node, value)"""


def oracles():
    """SQL per query name."""
    three = {"recs": "three"}
    return {
        # sessions
        "q_event_gaps": _sql(
            'SELECT event_id, user_id, item_id, "timestamp", delta FROM '
            '(SELECT tie AS event_id, * FROM gaps)', ["gaps"]),
        "q_local_sessions": _sql(
            'SELECT tie AS event_id, user_id, item_id, "timestamp", lsid AS local_session_id '
            "FROM loc", ["loc"]),
        "q_sessions_min_len": _sql(
            'SELECT tie AS event_id, user_id, item_id, "timestamp", lsid AS local_session_id, '
            "n_rows FROM sized WHERE n_rows >= 5", ["sized"]),
        "q_sessions_truncated": _sql(
            f"SELECT {_SESSION_COLUMNS} FROM sess", ["sess"], "sparse", max_length=5),
        "q_session_ids": _sql(
            'SELECT session_id, user_id, min("timestamp") AS started, count(*) AS n_items '
            "FROM sess GROUP BY session_id, user_id", ["sess"]),
        "q_build_sessions": _sql(f"SELECT {_SESSION_COLUMNS} FROM sess", ["sess"]),
        "q_build_sessions_sparse": _sql(
            f"SELECT {_SESSION_COLUMNS} FROM sess", ["sess"], "sparse"),
        "q_event_gaps_sliced": _sql(
            'SELECT event_id, user_id, item_id, "timestamp", delta FROM '
            '(SELECT tie AS event_id, * FROM gaps)', ["gaps"]),
        "q_build_sessions_sliced": _sql(f"SELECT {_SESSION_COLUMNS} FROM sess", ["sess"]),
        "q_build_sessions_sparse_sliced": _sql(
            f"SELECT {_SESSION_COLUMNS} FROM sess", ["sess"], "sparse"),
        "q_build_sessions_input_order": _sql(
            f"SELECT {_SESSION_COLUMNS} FROM sess", ["sess"], "by_day"),
        "q_stream_sessions": _sql(
            'SELECT user_id, min("timestamp") AS started, max("timestamp") AS ended, count(*) AS n_items '
            "FROM loc GROUP BY user_id, lsid HAVING count(*) >= 2", ["loc"]),
        "q_stream_popularity": _sql(
            'SELECT CAST("timestamp" // 604800000000 * 604800000000 AS BIGINT) AS window_start, item_id, count(*) AS n '
            "FROM ev GROUP BY ALL", ["ev"]),
        "q_session_summary": _sql(
            "SELECT count(DISTINCT session_id) AS n_sessions, count(DISTINCT user_id) AS n_users "
            "FROM sess", ["sess"]),
        "q_split_users": _sql("SELECT user_id, split FROM split", ["split"]),
        "q_split_sessions": _sql(
            f"SELECT {_SESSION_COLUMNS}, split FROM spl", ["spl"], "sparse"),
        "q_split_summary": _sql(
            "SELECT split, count(DISTINCT user_id) AS n_users, "
            "count(DISTINCT session_id) AS n_sessions FROM spl GROUP BY split",
            ["spl"], "sparse"),
        "q_targets": _sql(
            "SELECT session_id, user_id, target_item_id FROM tgt_all", ["tgt_all"]),
        "q_context": _sql(f"SELECT {_SESSION_COLUMNS} FROM ctx_all", ["ctx_all"]),
        # features
        "q_item_counts": _sql("SELECT * FROM counts", ["counts"], "sparse"),
        "q_item_rank": _sql(
            "SELECT item_id, item_global_count, item_global_rank FROM item", ["item"], "sparse"),
        "q_item_head": _sql(
            "SELECT item_id, item_global_count, item_is_head FROM item", ["item"], "sparse"),
        "q_item_genres": _sql(
            f"SELECT item_id, {_FLAGS} FROM meta", ["meta"]),
        "q_item_features": _sql(
            "SELECT i.item_id, item_global_count, item_unique_users, item_unique_sessions, "
            "item_global_rank, item_is_head, "
            + _FLAGS + " FROM item i LEFT JOIN meta USING (item_id)", ["item", "meta"], "sparse"),
        "q_user_stats": _sql(
            "SELECT user_id, user_total_interactions, user_total_sessions, "
            "round(user_mean_session_length, 6) AS user_mean_session_length FROM ustats",
            ["ustats"], "sparse"),
        "q_user_features": _sql(
            "SELECT user_id, user_total_interactions, user_total_sessions, "
            "round(user_mean_session_length, 6) AS user_mean_session_length, user_is_dense "
            "FROM users", ["users"], "sparse"),
        "q_session_context": _sql("SELECT * FROM sctx", ["sctx"]),
        "q_cooc_feature": _sql(
            "SELECT session_id, candidate_item_id, cooc_score_last_item FROM matrix", ["matrix"]),
        "q_labels": _sql("SELECT session_id, candidate_item_id, label FROM matrix", ["matrix"]),
        "q_ranking_features": _sql(
            "SELECT * REPLACE (round(user_mean_session_length, 6) AS user_mean_session_length) "
            "FROM matrix", ["matrix"], split="train"),
        "q_ranking_features_test": _sql("SELECT * FROM matrix", ["matrix"]),
        "q_matrix_summary": _sql(
            "SELECT count(*) AS n_rows, CAST(37 AS BIGINT) AS n_columns, "
            "CAST(sum(label) AS BIGINT) AS n_positive, round(avg(label), 6) AS positive_rate "
            "FROM matrix", ["matrix"], split="train"),
        # retrieval
        "q_popular_items": _sql("SELECT * FROM pop", ["pop"], "sparse"),
        "q_popularity_recs": _sql("SELECT * FROM pop_recs", ["pop_recs"]),
        "q_cooccurrence_edges": _sql("SELECT * FROM cooc", ["cooc"]),
        "q_cooccurrence_sparse": _sql("SELECT * FROM cooc", ["cooc"], "sparse"),
        "q_recent_items": _sql("SELECT * FROM recent", ["recent"]),
        "q_cooc_scores": _sql("SELECT * FROM scores", ["scores"]),
        "q_cooc_recs": _sql("SELECT * FROM cooc_recs", ["cooc_recs"]),
        "q_cooc_recs_top10": _sql("SELECT * FROM cooc_recs WHERE rank <= 10", ["cooc_recs"]),
        "q_cooc_recs_sparse": _sql(
            "SELECT * FROM cooc_recs WHERE rank <= 10", ["cooc_recs"], "sparse"),
        "q_cooc_recs_heads": _sql("SELECT * FROM cooc_recs", ["cooc_recs"]),
        "q_cooc_recs_sparse_heads": _sql(
            "SELECT * FROM cooc_recs WHERE rank <= 10", ["cooc_recs"], "sparse"),
        "q_cooc_recs_insertion_ties": _sql("""
SELECT session_id, item_id, score, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY session_id ORDER BY score DESC, met) AS INTEGER) AS rank FROM (
    SELECT r.session_id, c.item_b AS item_id, CAST(sum(c.cnt) AS BIGINT) AS score, min({'r': recency, 'f': f}) AS met
    FROM recent r JOIN (
      SELECT item_a, item_b, count(*) AS cnt, min({'s': s, 'i': i, 'j': j}) AS f FROM (
        SELECT a.item_id AS item_a, b.item_id AS item_b, a.session_id AS s, a.position AS i, b.position AS j
        FROM train a JOIN train b ON a.session_id = b.session_id AND abs(a.position - b.position) <= 5 AND a.item_id <> b.item_id)
      GROUP BY item_a, item_b) c ON r.item_id = c.item_a
    WHERE NOT EXISTS (SELECT 1 FROM ctx WHERE ctx.session_id = r.session_id AND ctx.item_id = c.item_b)
    GROUP BY r.session_id, c.item_b)) WHERE rank <= 10""", ["train", "recent", "ctx"]),
        "q_cooc_scores_salted": _sql("SELECT * FROM scores", ["scores"]),
        "q_cooc_summary": _sql(
            "SELECT (SELECT count(DISTINCT item_id) FROM train) AS n_items, "
            "count(*) AS n_pairs FROM cooc", ["cooc", "train"], "sparse"),
        "q_session_vectors": _sql(
            "SELECT session_id, CAST(dim - 1 AS INTEGER) AS dim, "
            "round(avg(CAST(embedding[dim] AS DOUBLE)), 6) AS value "
            f"FROM ({_VECTORS.replace('{shift}', '0')}), (SELECT unnest(range(1, 65)) AS dim) "
            "GROUP BY session_id, dim", ["ctx_all"]),
        "q_embedding_recs": _sql(_embedding(0), ["ctx_all"]),
        "q_embedding_recs_unknown": _sql(_embedding(440), ["ctx_all"]),
        "q_embedding_recs_blocks": _sql(_embedding(0), ["ctx_all"]),
        "q_embedding_work": _sql("SELECT *, true AS fewer FROM (" + _embedding(0, _SCALED, 10) + ")", ["ctx_all"]),
        "q_als_facts": _sql("""
SELECT session_id, n AS n_items, n AS n_different, n AS last_rank, CAST(0 AS BIGINT) AS n_seen
FROM (SELECT c.session_id, least(10, max(k.n) - count(DISTINCT CASE WHEN known THEN c.item_id END)) AS n
      FROM (SELECT *, item_id IN (SELECT item_id FROM train) AS known FROM ctx) c,
           (SELECT count(DISTINCT item_id) AS n FROM train) k
      GROUP BY c.session_id HAVING bool_or(known)) WHERE n > 0""", ["ctx", "train"]),
        # ranking
        "q_rerank": _sql("SELECT * FROM ranked", ["ranked"]),
        "q_ranker_features": "SELECT CAST(place AS INTEGER) AS place, feature FROM (VALUES "
            + ", ".join(f"({i}, '{n}')" for i, n in enumerate(_FEATURES)) + ") t(place, feature)",
        "q_ranker_facts": _sql(
            "SELECT fact, n AS value FROM (SELECT count(*) AS n FROM cooc_recs), (SELECT unnest("
            "['scored rows', 'scores in range', 'scores kept']) AS fact) "
            "UNION ALL SELECT 'feature ' || f, 1 FROM (SELECT unnest(["
            + ", ".join(f"'{n}'" for n in _FEATURES) + "]) AS f) "
            "UNION ALL SELECT 'importance, thousandths', 1000 UNION ALL SELECT 'top features', 15", ["cooc_recs"]),
        "q_leafwise_facts": "SELECT unnest([" + ", ".join(f"'{f}'" for f in _LEAFWISE_FACTS) + "]) AS fact, CAST(0 AS BIGINT) AS value",
        "q_leafwise_tree": _tree_sql(
            "SELECT CAST(place AS INTEGER) AS place, feature, round(edge, 6) AS threshold, round(gain, 6) AS gain, CAST(n AS BIGINT) AS rows "
            f"FROM ({_SPLITS}) JOIN {_NAMES} USING (f)"),
        "q_leafwise_leaves": _tree_sql(
            "SELECT n AS rows, round(p - sign(g) * greatest(abs(g) - 0.05, 0) / (h + 0.05) * 0.05, 6) AS value "
            "FROM (SELECT leaf, count(*) AS n, sum(g) / 1073741824 AS g, sum(h) / 1073741824 AS h FROM leaf3 JOIN derivatives USING (r) GROUP BY leaf), "
            "(SELECT ln(avg(label) / (1 - avg(label))) AS p FROM matrix)"),
        "q_total_gain": _tree_sql(
            f"SELECT feature, round(coalesce(sum(gain), 0), 6) AS importance FROM {_NAMES} LEFT JOIN ({_SPLITS}) USING (f) GROUP BY feature"),
        "q_auc": _sql(
            "SELECT item_is_head, round((sum(CASE WHEN label = 1 THEN below + ties / 2 ELSE 0 END)) / (sum(label) * sum(1 - label)), 6) AS auc FROM ("
            "SELECT s.item_is_head, label, sum(1 - label) OVER (PARTITION BY s.part ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
            "- sum(1 - label) OVER (PARTITION BY s.part, score) AS below, sum(1 - label) OVER (PARTITION BY s.part, score) AS ties FROM ("
            "SELECT item_is_head AS part, item_is_head, label, 3 * cooc_score_last_item + 0.5 * item_global_count - 0.25 * item_global_rank AS score FROM matrix "
            "UNION ALL SELECT -1, NULL, label, 3 * cooc_score_last_item + 0.5 * item_global_count - 0.25 * item_global_rank FROM matrix) s) "
            "GROUP BY item_is_head HAVING sum(label) > 0", ["matrix"]),
        "q_saved_tree_scores": _sql("", ["matrix"]).replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""",
values_of AS MATERIALIZED (SELECT session_id, candidate_item_id, feature, CAST(value AS DOUBLE) AS value FROM (
  SELECT session_id, candidate_item_id, CAST(cooc_score_last_item AS DOUBLE) AS cooc_score_last_item,
         CAST(item_global_rank AS DOUBLE) AS item_global_rank, CAST(session_length AS DOUBLE) AS session_length,
         CAST(item_is_head AS DOUBLE) AS item_is_head FROM matrix)
  UNPIVOT (value FOR feature IN (cooc_score_last_item, item_global_rank, session_length, item_is_head))),
descent AS (
  SELECT session_id, candidate_item_id, tree, 0 AS node FROM matrix, (SELECT unnest([0, 1]) AS tree)
  UNION ALL
  SELECT session_id, candidate_item_id, descent.tree,
         CASE WHEN descent.tree = 1 AND descent.node = 1 AND value = 0 THEN r WHEN value <= threshold THEN l ELSE r END
  FROM descent JOIN {_SAVED_NODES} ON nodes.tree = descent.tree AND nodes.node = descent.node
  JOIN values_of USING (session_id, candidate_item_id, feature))
SELECT session_id, candidate_item_id, round(1 / (1 + exp(-sum(value))), 6) AS score
FROM descent JOIN {_SAVED_LEAVES} ON leaves.tree = descent.tree AND leaves.node = descent.node GROUP BY session_id, candidate_item_id""",
        "q_two_stage": _sql(
            "SELECT metric, value FROM means WHERE system = 'cooc+ranker'", ["means"], **three),
        # evaluation
        "q_recall": _per_session("recall"),
        "q_precision": _per_session("precision"),
        "q_average_precision": _per_session("map"),
        "q_ndcg": _per_session("ndcg"),
        "q_mrr": _sql(
            "SELECT session_id, round(mrr, 6) AS mrr FROM rr WHERE system = 'cooccurrence'",
            ["rr"], recs="two"),
        "q_multi_target_metrics": _sql(
            f"SELECT p.session_id, {_metric_columns('recall', 'precision', 'map', 'ndcg')}, "
            "round(max(mrr), 6) AS mrr FROM persession p JOIN rr USING (system, session_id) "
            "WHERE system = 'popularity' GROUP BY p.session_id",
            ["persession", "rr"], recs="two", rel=_WHOLE_SESSION),
        "q_relevant_sets": _sql("SELECT * FROM rel", ["rel"]),
        "q_evaluate": _sql(
            "SELECT metric, value FROM means WHERE system = 'cooccurrence'", ["means"], **three),
        "q_compare_systems": _sql("SELECT * FROM means", ["means"], **three),
        "q_stages_reloaded": _sql("SELECT * FROM means", ["means"], **three),
        "q_compare_systems_sparse": _sql("SELECT * FROM means", ["means"], "sparse", **three),
        "q_evaluate_retrieval": _sql(
            "SELECT system AS retriever, metric, value FROM means", ["means"], recs="two"),
        "q_metric_pivot": _sql(
            f"SELECT system, {_pivot(_ORDERED)} FROM means GROUP BY system", ["means"], **three),
        # slices
        "q_slice_length": _sql(
            "SELECT * EXCLUDE (system) FROM sliced WHERE system = 'cooccurrence' "
            "AND slice_type = 'session_length'", ["sliced"], **three),
        "q_slice_popularity": _sql(
            "SELECT * EXCLUDE (system) FROM sliced WHERE system = 'cooccurrence' "
            "AND slice_type = 'item_popularity'", ["sliced"], "sparse", **three),
        "q_slice_density": _sql(
            "SELECT * EXCLUDE (system) FROM sliced WHERE system = 'cooccurrence' "
            "AND slice_type = 'user_density'", ["sliced"], split="train", **three),
        "q_all_slices": _sql(
            "SELECT * EXCLUDE (system) FROM sliced WHERE system = 'cooccurrence'",
            ["sliced"], **three),
        "q_slice_systems": _sql("SELECT * FROM sliced", ["sliced"], **three),
        "q_slice_summary": _sql(
            "SELECT slice_type, slice_value, n_sessions, "
            + ", ".join(
                f"max(CASE WHEN system = '{s}' AND metric = '{m}' THEN value END) AS \"{s}_{m}\""
                for s in _SYSTEMS for m in ("recall@20", "ndcg@10", "mrr"))
            + " FROM sliced GROUP BY slice_type, slice_value, n_sessions", ["sliced"], **three),
        "q_slice_pivot": _sql(
            f"SELECT slice_value, {_pivot(_SYSTEMS, 'system')} FROM sliced "
            "WHERE slice_type = 'session_length' AND metric = 'recall@10' GROUP BY slice_value",
            ["sliced"], **three),
        # errors
        "q_target_rank": _sql(
            "SELECT * EXCLUDE (system) FROM ranks WHERE system = 'cooccurrence'",
            ["ranks"], recs="two"),
        "q_missed": _sql(
            "SELECT * EXCLUDE (system), target_rank > 0 AS retrieved FROM ranks "
            "WHERE system = 'cooccurrence' AND (target_rank = -1 OR target_rank > 10)",
            ["ranks"], recs="two"),
        "q_coverage": _sql(
            "SELECT (SELECT count(DISTINCT item_id) FROM train) AS catalog_size, "
            "count(DISTINCT item_id) AS items_recommended, "
            "round(count(DISTINCT item_id) / (SELECT count(DISTINCT item_id) FROM train), 5) "
            "AS coverage, system FROM recs WHERE rank <= 10 GROUP BY system",
            ["recs", "train"], "sparse", recs="two"),
        "q_error_report": _sql(
            "SELECT * EXCLUDE (system) FROM report WHERE system = 'cooccurrence'",
            ["report"], recs="two"),
        "q_missed_rate": _sql(
            "SELECT system, CAST(sum(CASE WHEN target_rank BETWEEN 1 AND 10 THEN 0 ELSE 1 END) "
            "AS BIGINT) AS missed, count(*) AS total, "
            "round(100.0 * sum(CASE WHEN target_rank BETWEEN 1 AND 10 THEN 0 ELSE 1 END) "
            "/ count(*), 6) AS missed_pct FROM ranks GROUP BY system", ["ranks"], **three),
        "q_error_summary": _sql(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, "
                f"round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, "
                f"CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS q25, "
                f"CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS q50, "
                f"CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS q75, "
                f"CAST(max({c}) AS DOUBLE) AS max FROM report100" for c in _SUMMARY),
            ["report100"], recs="two"),
        # reports
        "q_hit_kpis": _sql(
            "SELECT round(avg(CAST(hit_at_k AS INTEGER)), 6) AS hit_rate, "
            "round(100 * avg(CAST(target_rank = -1 AS INTEGER)), 6) AS not_retrieved_pct, "
            "CAST(median(CASE WHEN target_rank > 0 THEN target_rank END) AS DOUBLE) AS median_rank "
            "FROM report100", ["report100"], recs="two"),
        "q_rank_histogram": _sql(
            "SELECT CAST(b AS INTEGER) AS bin, round(lo + (b - 1) * (hi - lo) / 20, 6) AS low, "
            "round(lo + b * (hi - lo) / 20, 6) AS high, "
            "count(target_rank) FILTER (least(floor((target_rank - lo) * 20 / (hi - lo)) + 1, 20) = b) "
            "AS n FROM (SELECT unnest(range(1, 21)) AS b), "
            "(SELECT CAST(min(target_rank) AS DOUBLE) AS lo, CAST(max(target_rank) AS DOUBLE) AS hi "
            "FROM report100 WHERE target_rank > 0), "
            "(SELECT target_rank FROM report100 WHERE target_rank > 0) GROUP BY b, lo, hi",
            ["report100"], recs="two"),
        "q_hit_by_length": _sql(
            "SELECT CASE WHEN session_length <= 3 THEN 'short' WHEN session_length <= 9 "
            "THEN 'medium' ELSE 'long' END AS length_bucket, count(*) AS n_sessions, "
            "round(avg(CAST(hit_at_k AS INTEGER)), 6) AS hit_rate FROM report100 "
            "WHERE session_length BETWEEN 1 AND 50 GROUP BY 1", ["report100"], recs="two"),
        "q_key_metrics": _sql(
            "SELECT * FROM means WHERE metric IN ('recall@10', 'ndcg@10', 'mrr')",
            ["means"], **three),
        "q_best_system": _sql(
            "SELECT metric, system, value FROM (SELECT *, row_number() OVER "
            "(PARTITION BY metric ORDER BY value DESC, system) AS r FROM means) WHERE r = 1",
            ["means"], **three),
        # files
        "q_read_ratings": _sql(
            'SELECT user_id, item_id, CAST(tie % 5 + 1 AS DOUBLE) AS rating, '
            '"timestamp" // 1000000 AS "timestamp" FROM ev', ["ev"]),
        "q_read_movies": """SELECT p_partkey AS item_id, p_name || ' é' AS title,
  lower(p_type) || '|' || replace(p_name, ' ', '|') AS genres,
  array_to_string(string_split(lower(p_type) || '|' || replace(p_name, ' ', '|'), '|'), '/') AS genre_list
FROM part""",
        "q_read_users": """SELECT c_custkey AS user_id, c_mktsegment AS gender,
  CAST(c_nationkey AS INTEGER) AS age, CAST(c_nationkey AS INTEGER) AS occupation,
  c_name AS zip_code FROM customer""",
        "q_read_results": _sql("SELECT * FROM sliced", ["sliced"], **three),
        "q_stage_tables": _sql(
            "SELECT split, count(*) AS n_rows, count(DISTINCT session_id) AS n_sessions, "
            "CAST(sum(item_id) AS BIGINT) AS items FROM spl GROUP BY split", ["spl"], "sparse"),
    }
