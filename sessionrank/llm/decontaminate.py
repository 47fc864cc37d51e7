"""Benchmark decontamination: which words of a text lie in passages of benchmark items (Wu-Manber search)."""

import numpy as np
from pyspark.sql import functions as F

from sessionrank.llm.common import LOWER, UPPER, lowered, map_texts, stage

# Fixed value: bytes other than these ASCII ranges belong to words.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = 13

# Windows searched for in one pass over the documents; more windows take more passes.
BLOCK_WINDOWS = 400_000

_WORD_BYTES = bytes.maketrans(
    UPPER.encode() + bytes(b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)),
    LOWER.encode() + b" " * (128 - 62),
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WuManber:
    """Search for many byte strings that begin and end with a space in text of single-spaced words.

    The last B bytes of each string's first m bytes (m: the shortest string) select its bucket;
    blocks of B bytes that occur earlier in a string tell how far a position may be moved on.
    """

    def __init__(self, strings):
        self.strings = strings
        self.m = m = min(map(len, strings))
        self.b = b = min(8, m)
        self.bits = max(12, min(22, (len(strings) * m).bit_length() + 1))
        heads = np.frombuffer(b"".join(s[:m] for s in strings), np.uint8).reshape(-1, m)
        self.shift = np.full(1 << self.bits, m - b + 1, np.int64)
        block = np.zeros(len(strings), np.uint64)
        for j in range(m):  # the block that ends at byte j, its last byte uppermost
            block = (block >> np.uint64(8)) | (heads[:, j].astype(np.uint64) << np.uint64(56))
            if j >= b - 1:
                key = self._key(block)
                np.minimum.at(self.shift, key, m - 1 - j)
        order = np.argsort(key, kind="stable")
        self.suffix, self.order = key[order], order

    def _key(self, block):
        cut = block >> np.uint64(64 - 8 * self.b)
        return ((cut * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, text, flat, lanes=4096):
        """Occurrences as (string numbers, first bytes); `text` is `flat` (uint8) as bytes."""
        size, m = len(flat), self.m
        if size < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        padded = np.concatenate([np.zeros(7, np.uint8), flat])
        blocks = np.ndarray((size,), "<u8", padded, strides=(1,))  # blocks[i] ends at byte i
        step = max(2 * m, -(-(size - m + 1) // lanes))
        at = np.arange(m - 1, size, step)
        stop = np.minimum(at + step, size)
        ends, keys = [], []
        while len(at):
            key = self._key(blocks[at])
            move = self.shift[key]
            hit = move == 0
            if hit.any():
                ends.append(at[hit])
                keys.append(key[hit])
            at = at + np.maximum(move, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends, keys = np.concatenate(ends), np.concatenate(keys)
        low = np.searchsorted(self.suffix, keys, "left")
        many = np.searchsorted(self.suffix, keys, "right") - low
        found = [], []
        for some in np.array_split(np.arange(len(ends)), max(1, int(many.sum()) >> 20)):
            n = many[some]
            row = np.repeat(some, n)
            rank = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            for which, start in zip(self.order[low[row] + rank].tolist(), (ends[row] - m + 1).tolist()):
                if text.startswith(self.strings[which], start):
                    found[0].append(which)
                    found[1].append(start)
        return np.array(found[0], np.int64), np.array(found[1], np.int64)


def searchers(strings):
    """Wu-Manber tables for strings of similar lengths, so that short ones don't shorten all steps."""
    groups = {}
    for k, s in enumerate(strings):
        groups.setdefault(min(5, len(s).bit_length()), []).append(k)
    return [(np.array(ks), WuManber([strings[k] for k in ks])) for ks in groups.values()]


def single_spaced(texts):
    """(bytes, uint8 array, spaces, words per text): all words of the texts, each between two single spaces."""
    raw = b" " + b" ".join(texts).translate(_WORD_BYTES) + b" "
    buf = np.frombuffer(raw, np.uint8)
    blank = buf == 32
    keep = np.concatenate([[True], ~(blank[1:] & blank[:-1])])
    flat = buf[keep]
    first = np.concatenate([[0], np.cumsum(blank[:-1] & ~blank[1:], dtype=np.int32)])  # words begun up to a byte
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    counts = np.diff(first[ends], prepend=0)
    return flat.tobytes(), flat, np.flatnonzero(flat == 32), counts


def windows(benchmark, item="item_id", text="text", words=WORDS):
    """Rows (window, item): distinct runs of `words` words of each item, or all words of a shorter one."""
    found = F.regexp_extract_all(lowered(F.col(text)), F.lit(ITEM_WORD), F.lit(0))
    last = F.greatest(F.size("w") - F.lit(words), F.lit(0))
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", F.slice("w", i + 1, words)))
    return (
        benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), found.alias("w"))
        .filter(F.size("w") > 0)
        .select(F.explode(runs).alias("window"), "item")
        .distinct()
    )


def find_items(docs, benchmark, keep=("doc_id",), text="text", item="item_id", words=WORDS, block_windows=BLOCK_WINDOWS):
    """Rows (keep..., n_words, hit array<struct<first, past>>, items array<string>), one for each document row.

    `hit` has the runs of hit words (word numbers from 0, end exclusive), `items` the items with
    windows in the text, sorted as strings. The windows are broadcast in blocks of `block_windows` at
    most; each further block is one more pass over the documents, which carry the results so far.

    Null and empty texts have no words. Items without words have no windows; an item whose id is null
    is listed as "null"; an id that comes with several texts counts once. Repeated document rows are
    treated one by one. Other columns of either table play no part.
    """
    spark = docs.sparkSession
    rows = windows(benchmark, item, text="text", words=words)
    blocks = max(1, -(-rows.count() // block_windows))
    if blocks > 1:
        rows = stage(rows, "windows")
    state = ("hit", "items")
    for b in range(blocks):
        mine = rows.filter(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == b) if blocks > 1 else rows
        held = {}
        for window, name in mine.collect():  # a block of bounded size
            held.setdefault(window.encode(), []).append(name)
        sent = spark.sparkContext.broadcast((list(held), list(held.values())))
        docs = _search(docs, text, [*keep, *([text] if b < blocks - 1 and text not in keep else [])], sent, b > 0)
        if b < blocks - 1:
            docs = stage(docs, "searched")
    return docs.select(*keep, "n_words", *state)


def _search(docs, text, keep, sent, again):
    if again:
        docs = docs.withColumnsRenamed({"hit": "hit before", "items": "items before"})
        keep = [*keep, "hit before", "items before"]
    at = len(keep)

    def make():
        found, items = sent.value
        lengths = np.array([s.count(b" ") + 1 for s in found], np.int64)
        tables = searchers([b" " + s + b" " for s in found]) if found else []

        def each(texts, batch):
            raw, flat, spaces, counts = single_spaced(texts)
            which, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for numbers, table in tables:
                k, s = table.find(raw, flat)
                which.append(numbers[k])
                starts.append(s)
            which = np.concatenate(which)
            first = np.searchsorted(spaces, np.concatenate(starts))
            past = first + lengths[which]
            lead = np.concatenate([[0], np.cumsum(counts)])
            doc = np.searchsorted(lead, first, "right") - 1
            inside = past <= lead[doc + 1]
            hits, names = {}, {}
            for d, k, a, e in zip(doc[inside].tolist(), which[inside].tolist(), first[inside].tolist(), past[inside].tolist()):
                hits.setdefault(d, []).append((a - lead[d], e - lead[d]))
                names.setdefault(d, set()).update(items[k])
            if again:
                before = zip(batch.column(at - 2).to_pylist(), batch.column(at - 1).to_pylist())
                for d, (h, n) in enumerate(before):
                    if h:
                        hits.setdefault(d, []).extend((x["first"], x["past"]) for x in h)
                        names.setdefault(d, set()).update(n)
            n = range(len(texts))
            return [counts.tolist(), [merged(hits.get(d, ())) for d in n], [sorted(names.get(d, ())) for d in n]]

        return each

    fields = "n_words bigint, hit array<struct<first:bigint,past:bigint>>, items array<string>"
    docs = map_texts(docs.drop("n_words"), text, keep, fields, make)
    return docs.drop("hit before", "items before")


def merged(spans):
    """Overlapping or touching (first, past) pairs united, in order."""
    out = []
    for a, e in sorted(spans):
        if out and a <= out[-1]["past"]:
            out[-1]["past"] = max(out[-1]["past"], int(e))
        else:
            out.append({"first": int(a), "past": int(e)})
    return out


def judged(found):
    """`find_items` rows with n_hit, n_items and contaminated: words hit, and at least one in twenty."""
    hit = F.aggregate("hit", F.lit(0).cast("bigint"), lambda n, s: n + s["past"] - s["first"])
    return found.withColumn("n_hit", hit).withColumns({
        "n_items": F.size("items").cast("bigint"),
        "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
    })


def clean(docs, benchmark, text="text"):
    """The document rows that are not contaminated, with their columns."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    marked = judged(find_items(inner, benchmark, keep=inner.columns, text=f"c{names.index(text)}"))
    return marked.filter(~F.col("contaminated")).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
