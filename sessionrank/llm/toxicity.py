"""Toxicity: a linear-chain conditional random field tags toxic words; marginals give document scores and offsets.

The labels are of documents, so words are labelled first: a word of a toxic document that tells toxic from clean documents
(itself or by how it begins) is labelled toxic, all others are not. The field learns from stretches of such words. Forward and
backward passes give each word's probability; a logistic function of their sum, its share of the words and the
largest one scores the document.
"""

import re
import zlib
from collections import Counter
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sessionrank.llm.common import flat_map, map_texts, stage, texts_of

LETTERS = re.compile(r"[^\W\d_]+")
# The fit reads about so many documents of each label, chosen by hashes, and up to so many stretches of so many words of each.
SAMPLE_ROWS, STRETCHES, STRETCH = 3000, 4, 32
# A word or beginning is telling if it occurs in so many toxic documents, and its log odds of toxic against clean documents are
# above the first limit and so many standard errors above 0. So many of the most telling ones are used.
LEAST_DOCS, LEAST_ODDS, LEAST_ERRORS, TELLING = 3, 2.0, 3.0, 5000
BEGINNINGS = (3, 4, 5, 6, 7)
FEATURE_BITS, ROUNDS, RATE, RIDGE = 18, 80, 0.3, 0.02
# A word is part of an offending span from this probability on.
OFFENDING = 0.5

_MASK = (1 << FEATURE_BITS) - 1
_CHUNK = 64
_KNOWN_WORDS = 200_000
_HELD_ENTRIES = 500_000


def words_of(text):
    """The runs of letters of a text."""
    return LETTERS.findall(text)


def clues(word):
    """The word in lower case and its beginnings."""
    w = word.lower()
    return [w, *(f"{w[:k]}-" for k in BEGINNINGS if len(w) > k)]


def features(word):
    """The numbers of a word's features: CRC-32 of its beginnings, of all of it, and of its end, in lower case and UTF-8 bytes."""
    w = word.lower().encode("utf-8", "replace")
    h = zlib.crc32(w[:BEGINNINGS[0]])
    found = [h]
    for k in BEGINNINGS[1:]:
        if len(w) < k:
            break
        h = zlib.crc32(w[k - 1:k], h)
        found.append(h)
    return [x & _MASK for x in (*found, zlib.crc32(w, 1), zlib.crc32(w[-3:], 2))]


# ---------------------------------------------------------------- the field

def marginals(scores, lengths, change):
    """The probability that each word is toxic.

    `scores` holds the words of documents in a row (what speaks for toxic, in natural logs), `lengths` (all above 0)
    their numbers, `change` (2, 2) what speaks for each tag after each other one; a document begins after a clean word.
    Exact: words are cut into runs whose products of step matrices are taken side by side and joined along each document.
    """
    chunks = -(-lengths // _CHUNK)
    total = int(chunks.sum())
    lead = np.cumsum(chunks) - chunks
    doc = np.repeat(np.arange(len(lengths)), chunks)
    rank = np.arange(total) - lead[doc]
    word_doc = np.repeat(np.arange(len(lengths)), lengths)
    cell = lead[word_doc] * _CHUNK + np.arange(len(scores)) - (np.cumsum(lengths) - lengths)[word_doc]
    weight, real = np.ones(total * _CHUNK), np.zeros(total * _CHUNK, bool)
    weight[cell], real[cell] = np.exp(np.clip(scores, -30, 30)), True
    weight, real = weight.reshape(total, _CHUNK), real.reshape(total, _CHUNK)
    step = np.exp(change)

    def ahead(state, t):
        """A row of states (or of matrices) after the word at place t of each run; unchanged past its end."""
        after = state @ step
        after[..., 1] *= weight[:, t].reshape(-1, *[1] * (state.ndim - 2))
        after /= after.sum(tuple(range(1, after.ndim)), keepdims=True)
        return np.where(real[:, t].reshape(-1, *[1] * (state.ndim - 1)), after, state)

    through = np.broadcast_to(np.eye(2) / 2, (total, 2, 2))
    for t in range(_CHUNK):
        through = ahead(through, t)
    by_rank = np.argsort(rank, kind="stable")
    cuts = np.searchsorted(rank[by_rank], np.arange(int(chunks.max()) + 1))
    enter, leave = np.zeros((total, 2)), np.zeros((total, 2))
    now, later = np.tile([1.0, 0.0], (len(lengths), 1)), np.full((len(lengths), 2), 0.5)
    for a, b in zip(cuts, cuts[1:]):
        c = by_rank[a:b]
        enter[c] = now[doc[c]]
        after = np.einsum("ci,cij->cj", enter[c], through[c])
        now[doc[c]] = after / after.sum(1, keepdims=True)
    for a, b in zip(cuts[-2::-1], cuts[:0:-1]):
        c = by_rank[a:b]
        leave[c] = later[doc[c]]
        before = np.einsum("cij,cj->ci", through[c], leave[c])
        later[doc[c]] = before / before.sum(1, keepdims=True)

    forward, state = np.empty((total, _CHUNK, 2)), enter
    for t in range(_CHUNK):
        state = forward[:, t] = ahead(state, t)
    out, state = np.empty((total, _CHUNK)), leave
    for t in reversed(range(_CHUNK)):
        both = forward[:, t] * state
        out[:, t] = both[:, 1] / both.sum(1)
        back = (state * np.stack([np.ones(total), weight[:, t]], 1)) @ step.T
        back /= back.sum(1, keepdims=True)
        state = np.where(real[:, t, None], back, state)
    return out.reshape(-1)[cell]


def train(words, lengths, tags, rounds=ROUNDS, rate=RATE, ridge=RIDGE):
    """(weights of features, change): a field fitted to tagged stretches of words by gradient ascent on the conditional likelihood.

    The gradient is what the tags have of each feature and change, less what forward and backward passes expect of it.
    """
    distinct, of = np.unique(np.array(words, object).astype(str), return_inverse=True)
    parts = [features(w) for w in distinct]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    feature = np.concatenate([np.array(p, np.int64) for p in parts]) if parts else np.zeros(0, np.int64)
    n, width = len(lengths), int(max(lengths, default=1))
    place = np.arange(width) < np.array(lengths)[:, None]
    tag, cell = np.zeros((n, width), np.int64), np.flatnonzero(place.ravel())
    tag.ravel()[cell] = tags
    before = np.concatenate([np.zeros((n, 1), np.int64), tag[:, :-1]], 1)
    seen = np.zeros((2, 2))
    np.add.at(seen, (before[place], tag[place]), 1)
    theta, change = np.zeros(1 << FEATURE_BITS), np.zeros((2, 2))
    held = np.bincount(feature, np.bincount(of, tags, len(distinct))[owner], len(theta))
    speed, pace = np.zeros(len(theta) + 4), np.zeros(len(theta) + 4)
    for i in range(1, rounds + 1):
        word = np.bincount(owner, theta[feature], len(distinct))
        score = np.zeros((n, width))
        score.ravel()[cell] = word[of]
        grid = np.exp(np.clip(score, -30, 30))
        step = np.exp(change)
        alpha, state = np.zeros((n, width + 1, 2)), np.tile([1.0, 0.0], (n, 1))
        alpha[:, 0] = state
        for t in range(width):
            after = state @ step
            after[:, 1] *= grid[:, t]
            after /= after.sum(1, keepdims=True)
            state = alpha[:, t + 1] = np.where(place[:, t, None], after, state)
        toxic, moved, state = np.zeros((n, width)), np.zeros((2, 2)), np.full((n, 2), 0.5)
        for t in reversed(range(width)):
            ahead = state * np.stack([np.ones(n), grid[:, t]], 1)
            pair = alpha[:, t, :, None] * step * ahead[:, None, :]
            pair /= pair.sum((1, 2), keepdims=True)
            pair[~place[:, t]] = 0
            moved += pair.sum(0)
            toxic[:, t] = pair[:, :, 1].sum(1)
            back = ahead @ step.T
            state = np.where(place[:, t, None], back / back.sum(1, keepdims=True), state)
        expected = np.bincount(of, toxic.ravel()[cell], len(distinct))
        slope = np.concatenate([
            held - np.bincount(feature, expected[owner], len(theta)) - ridge * theta, (seen - moved - ridge * change).ravel(),
        ])
        speed = 0.9 * speed + 0.1 * slope
        pace = 0.99 * pace + 0.01 * slope**2
        move = rate * (1 - 0.9 * i / rounds) * (speed / (1 - 0.9**i)) / (np.sqrt(pace / (1 - 0.99**i)) + 1e-8)
        theta += move[:-4]
        change += move[-4:].reshape(2, 2)
    return theta.astype(np.float32), change


class _Numbers(dict):
    """Numbers keys in the order of their first lookup."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Tagger:
    """Scores of words by the weights of their features, remembered for a bounded number of words; probabilities of texts."""

    def __init__(self, theta, change):
        self.theta, self.change = theta, change
        self.known, self.scores = _Numbers(), np.zeros(0)

    def _scored(self, words):
        if len(self.known) > _KNOWN_WORDS:
            self.known, self.scores = _Numbers(), np.zeros(0)
        before = len(self.known)
        ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        parts = [features(w) for w in islice(self.known, before, None)]
        if parts:
            flat = np.fromiter(chain.from_iterable(parts), np.int64)
            first = np.cumsum([0, *map(len, parts[:-1])])
            self.scores = np.concatenate([self.scores, np.add.reduceat(self.theta[flat].astype(np.float64), first)])
        return self.scores[ids]

    def probabilities(self, texts):
        """For each text the probabilities of its words."""
        found = [words_of(t) for t in texts]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        some = lengths > 0
        if not some.any():
            return [np.zeros(0) for _ in texts]
        scores = self._scored(list(chain.from_iterable(found)))
        return np.split(marginals(scores, lengths[some], self.change), np.cumsum(lengths)[:-1])


def evidence(p):
    """What a document's score is made of: the expected number of toxic words, its share, the largest probability."""
    if not len(p):
        return [1.0, 0.0, 0.0, 0.0]
    total = float(p.sum())
    return [1.0, np.log1p(total), np.log1p(100 * total / len(p)), float(p.max())]


def logistic(rows, labels, ridge=0.1, steps=50):
    """Weights of a logistic regression by Newton steps, with a ridge on all but the first."""
    x, y = np.array(rows, float), np.array(labels, float)
    w, keep = np.zeros(x.shape[1]), np.diag([1e-3, *[ridge] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += move / max(1.0, float(np.abs(move).max()))
    return w


# ---------------------------------------------------------------- fit

def labelled_sample(docs, labels, id_col="doc_id", text="text", label="toxic", rows=SAMPLE_ROWS):
    """Rows (text, label): about `rows` different documents of each label, at most about twice as many, chosen by hashes.

    A document with several labels is toxic if one of them says so; null ids and labels teach nothing.
    """
    share = lambda n: rows / max(n, 1)
    draw = lambda what, *c: F.pmod(F.xxhash64(F.lit(what), *c), F.lit(1 << 30)) / float(1 << 30)
    marks = labels.select(F.col(id_col).alias("id"), F.col(label).alias("label")).dropna().groupBy("id").agg(
        (F.max("label") > 0).cast("int").alias("label")
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    marks = stage(marks.join(texts.select("id").distinct(), "id", "left_semi"), "toxic-marks")
    sizes = dict(map(tuple, marks.groupBy("label").agg(F.count(F.lit(1))).collect()))  # two rows
    chosen = marks.filter(draw("ids", "id") < F.when(F.col("label") == 1, share(sizes.get(1, 0))).otherwise(share(sizes.get(0, 0))))
    mine = texts.join(F.broadcast(chosen), "id")  # about 2 x rows ids
    sizes = dict(map(tuple, mine.groupBy("label").agg(F.count(F.lit(1))).collect()))
    limit = F.when(F.col("label") == 1, 2 * share(sizes.get(1, 0))).otherwise(2 * share(sizes.get(0, 0)))
    return stage(mine.filter(draw("rows", "id", "text") < limit).select("text", "label").distinct(), "toxic-sample")


def telling(sample, sizes, limit=TELLING):
    """The clues that tell toxic documents from clean ones, at most `limit`; `sizes` has the numbers of both in the sample."""
    def make():
        held = Counter()

        def out():
            rows = [[c for c, _ in held], [k for _, k in held], list(held.values())]
            held.clear()
            return rows

        def each(batch):
            for t, k in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                held.update((c, k) for c in {c for w in set(words_of(t.decode("utf-8", "replace"))) for c in clues(w)})
            return out() if len(held) > _HELD_ENTRIES else None

        return each, out

    counts = flat_map(sample.select("text", "label"), "clue string, label int, n bigint", make)
    toxic, clean = (F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(name) for k, name in ((1, "toxic"), (0, "clean")))
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    found = counts.groupBy("clue").agg(toxic, clean).filter(F.col("toxic") >= LEAST_DOCS).select("clue", odds.alias("odds"), (odds / error).alias("errors"))
    found = found.filter((F.col("odds") >= LEAST_ODDS) & (F.col("errors") >= LEAST_ERRORS))
    return {r["clue"] for r in found.orderBy(F.desc("errors"), "clue").limit(limit).collect()}


def stretches(sample, lexicon):
    """Rows (words, tags): stretches of the sampled documents, those with telling words first, tagged as their labels allow."""
    sent = sample.sparkSession.sparkContext.broadcast(lexicon)

    def make():
        lexicon = sent.value

        def each(batch):
            words, tags = [], []
            for t, k in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                mine = words_of(t.decode("utf-8", "replace"))
                telling = [int(any(c in lexicon for c in clues(w))) for w in mine]
                parts = [(mine[i:i + STRETCH], telling[i:i + STRETCH]) for i in range(0, len(mine), STRETCH)]
                parts.sort(key=lambda p: (-sum(p[1]), zlib.crc32(" ".join(p[0]).encode())))
                for w, hit in parts[:STRETCHES]:
                    if sum(hit) or not k:  # what a toxic document holds besides is not known to be clean
                        words.append(w)
                        tags.append([h * k for h in hit])
            return [words, tags]

        return each, lambda: None

    return flat_map(sample.select("text", "label"), "words array<string>, tags array<int>", make)


def fit(docs, labels, id_col="doc_id", text="text", label="toxic", sample_rows=SAMPLE_ROWS):
    """(weights, change, calibration) learned from the documents that `labels` (id_col, label 0 or 1) covers.

    The driver holds 2 x sample_rows x STRETCHES stretches (of twice as many documents at most) and the evidence of the sampled documents. Without labels of
    both kinds nothing is learned about words, and all texts get the smoothed share of toxic ones as their score.
    """
    sample = labelled_sample(docs, labels, id_col, text, label, sample_rows)
    sizes = {0: 0, 1: 0} | dict(map(tuple, sample.groupBy("label").agg(F.count(F.lit(1))).collect()))
    theta, change = np.zeros(1 << FEATURE_BITS, np.float32), np.zeros((2, 2))
    if not (sizes[0] and sizes[1]):
        odds = (sizes[1] + 0.5) / (sizes[0] + 0.5)
        return theta, change, np.array([np.log(odds), 0.0, 0.0, 0.0])
    found = stretches(sample, telling(sample, sizes)).toPandas()
    found = found[found["words"].map(len) > 0]
    found = found.assign(text=found["words"].map(" ".join)).sort_values("text")  # the same sums in every run
    if len(found):
        theta, change = train(
            [w for ws in found["words"] for w in ws], found["words"].map(len).tolist(), [t for ts in found["tags"] for t in ts]
        )
    rows = map_texts(sample, "text", ["label"], "x array<double>", _evidence(sample, theta, change)).toPandas().sort_values("label", kind="stable")
    x = sorted(zip(rows["label"], map(tuple, rows["x"])))
    return theta, change, logistic([v for _, v in x], [k for k, _ in x])


def _evidence(df, theta, change):
    sent = df.sparkSession.sparkContext.broadcast((theta, change))

    def make():
        tagger = Tagger(*sent.value)
        return lambda texts, _: [[evidence(p) for p in tagger.probabilities([t.decode("utf-8", "replace") for t in texts])]]

    return make


# ---------------------------------------------------------------- score

def tag(docs, model, keep=("doc_id",), text="text", offending=OFFENDING):
    """Rows (keep..., score, n_words, toxic_words, spans), one for each document row.

    score is between 0 and 1, toxic_words the expected number of toxic words, spans (start, end, p; code points, end exclusive) the
    runs of consecutive words of probability `offending` or more, with the largest of them. A null text, an empty one and one
    without a letter have no word and the score of a document without any sign. Repeated rows are scored one by one;
    nothing but the text counts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        theta, change, weights = sent.value
        tagger = Tagger(theta, change)

        def each(texts, _):
            texts = [t.decode("utf-8", "replace") for t in texts]
            found = tagger.probabilities(texts)
            x = np.array([evidence(p) for p in found]).reshape(len(texts), 4)
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))
            spans = [_spans(t, p, offending) if len(p) and p.max() >= offending else [] for t, p in zip(texts, found)]
            return [pa.array(score), [len(p) for p in found], [float(p.sum()) for p in found], spans]

        return each

    return map_texts(docs, text, keep, "score double, n_words bigint, toxic_words double, spans array<struct<start:bigint,end:bigint,p:double>>", make)


def _spans(text, p, offending):
    spans, last = [], -2
    for i, m in enumerate(LETTERS.finditer(text)):
        if p[i] >= offending:
            if last == i - 1:
                spans[-1]["end"], spans[-1]["p"] = m.end(), max(spans[-1]["p"], float(p[i]))
            else:
                spans.append({"start": m.start(), "end": m.end(), "p": float(p[i])})
            last = i
    return spans
