"""The stages of the whole run, from the event log to reports.

Every stage table is written once to shared storage and read by all later stages. Stages also run on
their own: `load_prepared` and `ranking.load_ranker` pick up what `save` kept, for any split.
"""

from collections import namedtuple
from functools import cached_property

from pyspark.sql import functions as F

from sessionrank import schemas
from sessionrank.functions.skew import HOT_ROWS, hot_keys
from sessionrank.functions.staging import materialize
from sessionrank.operators import errors, features, metrics, ranking, sessions, slices
from sessionrank.operators.cooccurrence import HEAD, fit_cooccurrence, impact_blocks, retrieve_cooccurrence
from sessionrank.operators.popularity import fit_popularity, popular_items, retrieve_popular
from sessionrank.sources.files import read_table, write_results, write_table

POPULARITY, COOCCURRENCE, RANKER = "popularity", "cooccurrence", "cooc+ranker"


class Prepared:
    """Sessions of an event log, split by user, with their contexts and targets.

    `window` is the reach of co-occurrence, in fitting and in retrieval.
    """

    def __init__(self, table, window=schemas.WINDOW):
        self.table = table
        self.window = window
        self._blocks, self._candidates, self._edges = {}, {}, None

    def sessions(self, split):
        """Sessions of one split."""
        return self.table.filter(F.col("split") == split).select(*schemas.SESSION_COLUMNS)

    def _sized(self, split):
        return self.table.filter(F.col("split") == split).drop("split")

    def context(self, split):
        """Context rows of one split."""
        return sessions.context_of(self._sized(split))

    def targets(self, split):
        """Targets of one split."""
        return sessions.targets_of(self._sized(split))

    @property
    def edges(self):
        """The training co-occurrences, from a stage table of their own where they are not needed in blocks."""
        if self._blocks:
            return next(iter(self._blocks.values())).select("item_a", "item_b", "cnt")
        if self._edges is None:
            self._edges = materialize(fit_cooccurrence(self.sessions("train"), self.window), "edges")
        return self._edges

    def blocks(self, head=HEAD):
        """Stage table of the training co-occurrences, each item's strongest first, in blocks of doubling length from `head` on."""
        if head not in self._blocks:
            train = self.sessions("train")
            n_items = train.select("item_id").distinct().count()
            known = self._blocks or self._edges is not None
            edges = self.edges if known else fit_cooccurrence(train, self.window)
            edges = edges if known or n_items <= HOT_ROWS else materialize(edges, "edges")
            self._blocks[head] = materialize(impact_blocks(edges, head, n_items=n_items), "blocks", ["block"])
        return self._blocks[head]

    @cached_property
    def item_counts(self):
        """Stage table (item_id, n) of the training items."""
        return materialize(fit_popularity(self.sessions("train")), "item-counts")

    def popular_list(self, top_k):
        """The popularity list that every session gets: (item_id, n, rank)."""
        return popular_items(self.item_counts, top_k)

    def popular(self, split, top_k):
        """Popularity recommendations for one split, a row per session and item."""
        return retrieve_popular(self.item_counts, self.context(split), top_k)

    def neighbours(self, split, top_k, head=None):
        """Co-occurrence recommendations for one split."""
        return retrieve_cooccurrence(None, self.context(split), top_k, self.window, head, blocks=self.blocks(head or HEAD), least=HEAD)

    def candidates(self, split, top_k=schemas.RETRIEVAL_K):
        """Stage table of the co-occurrence recommendations.

        Ranks follow a total order, so a shorter list is the same table cut at its rank.
        """
        if (split, top_k) not in self._candidates:
            self._candidates[split, top_k] = materialize(self.neighbours(split, top_k), "candidates")
        return self._candidates[split, top_k]

    def matrix(self, split, items, users, candidates):
        """Ranking matrix of the candidates of one split."""
        hot = hot_keys(candidates, "item_id")
        return features.ranking_features(
            candidates, self.context(split), self.targets(split), items, users,
            hot_items=hot and hot.named("candidate_item_id"),
        )


def prepare(
    events,
    gap=schemas.GAP_SECONDS,
    min_length=schemas.MIN_LENGTH,
    max_length=schemas.MAX_LENGTH,
    tie_cols=(),
    test_fraction=schemas.TEST_FRACTION,
    val_fraction=schemas.VAL_FRACTION,
    seed=schemas.SEED,
    window=schemas.WINDOW,
):
    """Sessionizes, splits and writes the sessions, partitioned by split."""
    table, users = sessions.sessions_and_users(
        events, gap, min_length, max_length, tie_cols, keep_size=True
    )
    split = sessions.split_sessions(table, test_fraction, val_fraction, seed, users=users)
    return Prepared(materialize(split, "sessions", partition_by=["split"]), window)


def save(data, folder):
    """Keeps the prepared sessions, and contexts and targets of all splits, under a folder."""
    write_table(data.table, f"{folder}/processed/sessions", ["split"])
    for part in ("train", "val", "test"):
        write_table(data.context(part), f"{folder}/processed/{part}_context")
        write_table(data.targets(part), f"{folder}/processed/{part}_targets")


def load_prepared(spark, folder, window=schemas.WINDOW):
    """Sessions kept by `save`."""
    return Prepared(read_table(spark, f"{folder}/processed/sessions"), window)


Features = namedtuple("Features", "items users")


def fit_features(data, movies, genres=None):
    """Stage tables of the item and user features of the training sessions."""
    train = data.sessions("train")
    return Features(
        materialize(features.item_features(train, movies, genres), "items"),
        materialize(features.user_features(train), "users"),
    )


def train(data, feats, retrieval_k=schemas.RETRIEVAL_K, folder=None, **ranker_params):
    """A ranker fitted on train, its rounds chosen on val; with `folder`, matrices and model are kept there."""
    matrices = {
        part: materialize(data.matrix(part, *feats, data.candidates(part, retrieval_k)), f"{part}-matrix")
        for part in ("train", "val")
    }
    model = ranking.fit_ranker(matrices["train"], matrices["val"], **ranker_params)
    if folder:
        for part, matrix in matrices.items():
            write_table(matrix, f"{folder}/results/{part}_feature_matrix")
        ranking.save_ranker(model, f"{folder}/results/models/ranker")
    return model


def recommend(data, feats, score, split="test", retrieval_k=schemas.RETRIEVAL_K, ranking_k=schemas.RANKING_K):
    """{system: recommendations} of the three systems; the popularity list is shared by all sessions.

    `score` is a fitted ranker or a function that adds `score` to a matrix.
    """
    candidates = data.candidates(split, retrieval_k)
    matrix = data.matrix(split, *feats, candidates)
    scored = score(matrix) if callable(score) else ranking.predict(score, matrix)
    return {
        POPULARITY: data.popular_list(ranking_k),
        COOCCURRENCE: candidates.filter(F.col("rank") <= ranking_k),
        RANKER: materialize(ranking.rerank(scored, ranking_k), "reranked"),
    }


def evaluate(data, systems, split="test", retrieval_k=schemas.RETRIEVAL_K, k_values=schemas.K_VALUES):
    """Results final_eval (all systems) and retrieval_eval (the retrievers' long lists)."""
    targets = data.targets(split)
    retrievers = {POPULARITY: data.popular_list(retrieval_k), COOCCURRENCE: data.candidates(split, retrieval_k)}
    results = {"retrieval_eval": metrics.compare_systems(retrievers, targets, k_values, column="retriever")}
    if systems:
        results["final_eval"] = metrics.compare_systems(systems, targets, k_values)
    return results


def slice_systems(data, systems, split="test", k_values=schemas.K_VALUES):
    """Results slice_eval_combined: the systems' metrics by slice."""
    found = slices.compare_slices(
        data.context(split), data.targets(split), data.sessions("train"), systems, k_values, data.item_counts
    )
    return {"slice_eval_combined": found}


def analyse_errors(data, systems, split="test", ranking_k=schemas.RANKING_K):
    """Results coverage_stats, error_report, missed_targets and missed_rate."""
    names, targets, train = list(systems), data.targets(split), data.sessions("train")
    own = {
        name: recs if "session_id" in recs.columns else data.popular(split, ranking_k)
        for name, recs in systems.items()
    }
    recs = materialize(metrics.combine_systems(own), "recommendations", ["system"])
    report = errors.error_report(
        recs, targets, train, data.context(split), ranking_k, names, item_counts=data.item_counts
    )
    return {
        "coverage_stats": errors.coverage(recs, train, ranking_k, names),
        "error_report": materialize(report, "report"),
        "missed_targets": errors.missed_targets(recs, targets, ranking_k, names),
        "missed_rate": errors.missed_rate(recs, targets, ranking_k, names),
    }


def run(
    events,
    movies,
    gap=schemas.GAP_SECONDS,
    min_length=schemas.MIN_LENGTH,
    max_length=schemas.MAX_LENGTH,
    tie_cols=(),
    split="test",
    retrieval_k=schemas.RETRIEVAL_K,
    ranking_k=schemas.RANKING_K,
    k_values=schemas.K_VALUES,
    out=None,
    test_fraction=schemas.TEST_FRACTION,
    val_fraction=schemas.VAL_FRACTION,
    seed=schemas.SEED,
    window=schemas.WINDOW,
    genres=None,
    **ranker_params,
):
    """The whole run: prepare, train, evaluate, slice, analyse errors.

    Returns the result tables by name. With `out`, the stage tables, the model and the
    results are also kept under that folder. The tables read stage tables; wrap the call and the use of its
    results in `stage_scope` to have those deleted afterwards.
    """
    data = prepare(events, gap, min_length, max_length, tie_cols, test_fraction, val_fraction, seed, window)
    feats = fit_features(data, movies, genres)
    model = train(data, feats, retrieval_k, out, **ranker_params)
    systems = recommend(data, feats, model, split, retrieval_k, ranking_k)
    results = {
        "session_summary": sessions.session_summary(data.table),
        "split_summary": sessions.split_summary(data.table),
        "feature_importance": ranking.feature_importance(events.sparkSession, model),
        **evaluate(data, systems, split, retrieval_k, k_values),
        **slice_systems(data, systems, split, k_values),
        **analyse_errors(data, systems, split, ranking_k),
    }
    if out:
        save(data, out)
        write_table(movies, f"{out}/processed/movies")
        results |= {name: materialize(results[name], name) for name in ("slice_eval_combined", "missed_targets")}
        for name, table in results.items():
            write_results(table, f"{out}/results/{name}")
        for source, name in (("slice_eval_combined", "slice_eval"), ("error_report",) * 2, ("missed_targets",) * 2):
            write_results(results[source], f"{out}/results/{name}_by_system", by_system=True)
    return results
