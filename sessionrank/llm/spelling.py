"""Spelling variants: words one edit apart by asymmetric q-chunks, and the frequent form that each rare one stands for.

A word contributes two disjoint chunks, the other one its positional grams: one edit leaves a chunk untouched, which
the other word holds in the same place or shifted by one. Pairs that share such a chunk are candidates and verified.
A chunk that too many words share is refined: what the edit must lie in is cut into two chunks again, one of which
the edit leaves untouched as well.
"""

import re
import zlib
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionrank.functions.skew import hot_keys, salted_join
from sessionrank.llm.common import LOWER, UPPER, flat_map, stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, MORE = 7, 2, 10
# A key with more candidate pairs than this is refined.
PAIRS_PER_KEY = 1024
# Words of a form whose rows are split among tasks when roots are looked up.
HOT_FORM = 100_000

_HELD_ENTRIES = 500_000
_LOWER = str.maketrans(UPPER, LOWER)


# ---------------------------------------------------------------- words

def noisy(doc_id, word, every=31):
    """The word, less one letter if `every` divides the CRC-32 of `<doc_id>:<word>`."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % every:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def plain(doc_id, word):
    """The word as it is."""
    return word


def word_counts(docs, change=plain, id_col="doc_id", text="text", least=LEAST_LENGTH):
    """Rows (word, n): how often each word of at least `least` code points occurs.

    Words are the letter runs of whole texts, A-Z in lower case, as `change(doc_id, word)` leaves them. A null text has none;
    a null id counts as empty text. Tasks add up what they can hold of a bounded number of words before the shuffle.
    """
    def make():
        held = Counter()

        def out():
            rows = [list(held), list(held.values())]
            held.clear()
            return rows

        def each(batch):
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t:
                    name = "" if i is None else i
                    for w, n in Counter(RUN.findall(t.translate(_LOWER))).items():
                        w = change(name, w)
                        if len(w) >= least:
                            held[w] += n
            return out() if len(held) > _HELD_ENTRIES else None

        return each, out

    rows = docs.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text}`"))
    return flat_map(rows, "word string, n bigint", make).groupBy("word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- pairs

def _regions(words):
    """The first rows of each word: side, gap, size, and the places [lo, hi] where its one edit may be.

    gap is the difference of the lengths of a pair, size the length of its shorter word. A word meets those as long as itself (side
    "both"), longer ones (side "chunks") and shorter ones (side "grams"). Places are those of a replaced letter (0 to
    size - 1) or of an insertion into the shorter word (0 to size).
    """
    size = F.length("word")
    kinds = F.array(*[
        F.struct(F.lit(side).alias("side"), F.lit(gap).alias("gap"), length.alias("size"), F.lit(0).alias("lo"), (length - 1 + gap).alias("hi"))
        for side, gap, length in (("both", 0, size), ("chunks", 1, size), ("grams", 1, size - 1))
    ])
    return words.select("word", F.inline(kinds))


def _halved(rows, first=False):
    """Each row twice: with the places of the left half, given the right half as a chunk, and the other way round.

    An edit leaves one of two chunks untouched, so a pair shares one of them. The first two chunks of a word are disjoint, and
    an insertion between them is a place of both; later ones belong to disjoint sets of places, so that these shrink to one.
    """
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    if first:
        middle = F.when(F.col("gap") == 1, F.floor(F.col("size") / 2)).otherwise(middle).cast("int")
    after = middle + (F.when(F.col("gap") == 1, 0).otherwise(1) if first else 1)
    halves = F.array(
        F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(after.cast("int").alias("lo"), F.col("hi").alias("hi"))
    )
    return rows.select("word", "side", "gap", "size", F.inline(halves))


def _keyed(rows):
    """The rows with a key: 64 bits of the lengths, the places, and the text before and after them.

    The text after them starts a letter later in the longer word of a pair: its gram is shifted by one.
    """
    past = F.col("hi") + 1 - F.when(F.col("side") == "chunks", 1).otherwise(0)
    before = F.substring("word", F.lit(1), F.col("lo"))
    after = F.substring("word", past + 1, F.length("word"))
    return rows.withColumn("key", F.xxhash64("gap", "size", "lo", "hi", before, after))


def near_pairs(words, pairs_per_key=PAIRS_PER_KEY):
    """Rows (a, b), each unordered pair of distinct words one inserted, deleted or replaced code point apart once.

    `words` has distinct words (word) of two or more code points. Keys with more than `pairs_per_key` candidate pairs are refined
    until they have fewer or only one place is left; then all their words but for that place are equal, so the number
    of their pairs is bounded by the alphabet. Nothing is dropped: every key is either joined or refined.
    """
    rows, found = _halved(_regions(words), first=True), []
    each = Window.partitionBy("key")
    chunks = F.sum((F.col("side") != "grams").cast("bigint")).over(each)
    grams = F.sum((F.col("side") != "chunks").cast("bigint")).over(each)
    while True:
        # a key without both sides, or with one word alone, has no pair
        counted = _keyed(rows).withColumn("pairs", chunks * grams).withColumn("rows", F.count(F.lit(1)).over(each))
        wide = (F.col("pairs") > pairs_per_key) & (F.col("lo") < F.col("hi"))
        alive = stage(counted.filter("pairs > 0 AND rows > 1").withColumn("wide", wide).drop("pairs", "rows"), "spelling-keys")
        narrow = alive.filter("NOT wide")
        left = narrow.filter("side <> 'grams'").select("key", "gap", F.col("word").alias("a"))
        right = narrow.filter("side <> 'chunks'").select("key", F.col("gap").alias("their_gap"), F.col("word").alias("b"))
        pairs = left.join(right, "key").filter(
            (F.col("gap") == F.col("their_gap")) & ((F.col("gap") == 1) | (F.col("a") < F.col("b")))
            & (F.levenshtein("a", "b", 1) == 1)
        )
        found.append(stage(pairs.select("a", "b"), "spelling-pairs"))
        if not alive.filter("wide").limit(1).count():
            break
        rows = _halved(alive.filter("wide"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionAll(more)
    return pairs.distinct()


# ---------------------------------------------------------------- forms

def variants(words, more=MORE, pairs_per_key=PAIRS_PER_KEY):
    """Rows (word, form, root, n, n_near, form_n), one for each of `words` (word, n).

    n_near counts the words one edit away. The form of a word is the one of them with the largest n (ties: the smallest in code
    point order), if that is at least `more` times its own, else null; root follows the forms to the last, a word
    without a form being its own. Forms have larger n than their words (`more` above 1), so chains end.
    """
    words = stage(words, "spelling-words")
    pairs = stage(near_pairs(words.select("word"), pairs_per_key), "spelling-near")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(words.withColumnRenamed("word", "b"), "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("fewer"), "b")).alias("best")
    )
    best_n = -F.col("best.fewer")
    known = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        *[F.when(best_n >= F.col("n") * F.lit(more), c).alias(name) for name, c in (("form", F.col("best.b")), ("form_n", best_n))],
    ), "spelling-forms")
    roots = known.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    return known.join(_last(stage(roots, "spelling-roots")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _last(roots):
    """Links (word, root) followed to their ends; each round doubles the steps taken."""
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = salted_join(roots, step, ["root"], "left", hot_keys(roots, "root", HOT_FORM), "root", ["word"])
        joined = stage(joined, "spelling-roots")
        if not joined.filter("next IS NOT NULL").limit(1).count():
            return roots
        roots = joined.select("word", F.coalesce("next", "root").alias("root"))


def group_variants(docs, change=plain, least_length=LEAST_LENGTH, least_count=LEAST_COUNT, more=MORE, **columns):
    """`variants` of the words of whole texts: those of `least_length` code points or more that occur `least_count` times or more."""
    counts = word_counts(docs, change, least=least_length, **columns)
    return variants(counts.filter(F.col("n") >= least_count), more)
