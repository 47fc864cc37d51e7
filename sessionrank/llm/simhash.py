"""Near-duplicates by SimHash: fingerprints of word shingles, linked at a small Hamming distance."""

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sessionrank.llm.common import LOWER_BYTES, map_texts, stage
from sessionrank.llm.components import components

SHINGLE, DISTANCE, SEED = 3, 2, 42

# Blocks of more distinct fingerprints than this are linked by shared neighbours instead of pairs.
BLOCK_ROWS = 64
_CHUNK = 1 << 14


def fingerprint(text, shingle=SHINGLE, seed=SEED):
    """64-bit SimHash of a text given as bytes: a bit is set if it is in over half of the shingles' hashes."""
    words = text.translate(LOWER_BYTES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    n = max(1, len(words) - shingle + 1)
    first, past = (ends - size)[:n], ends[min(shingle, len(words)) - 1:]
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, _CHUNK):
        spans = zip(first[i:i + _CHUNK].tolist(), past[i:i + _CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs, keep=("doc_id",), text="text", shingle=SHINGLE):
    """Rows (keep..., fp): the signed 64-bit fingerprint of each document row; of no words, zero."""
    def make():
        return lambda texts, _: [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64).tolist()]

    return map_texts(docs, text, keep, "fp bigint", make)


def _masks(distance, blocks):
    """Masks of all choices of blocks that two fingerprints within `distance` must share one of."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    block = [sum(1 << k for k in range(a, b)) for a, b in zip(edge, edge[1:])]
    return [_signed(sum(c)) for c in combinations(block, blocks - distance)]


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def links(distinct, distance=DISTANCE, blocks=None, block_rows=BLOCK_ROWS):
    """Links (a, b) whose components are those of all fingerprint pairs within `distance` bits.

    `distinct` has the distinct fingerprints (fp). They are cut into `blocks` blocks (distance + 3 if not
    given) of which a close pair shares all but `distance`; each choice of that many is a join key.
    Groups of up to `block_rows` rows are joined and every pair's distance is verified. Larger groups
    emit no pairs: each fingerprint is given all changes of up to half the distance in the
    bits outside its key, and those that meet in a value are linked to one of them; that finds
    exactly the close pairs again, in rows that grow with the group and not with its square.
    """
    blocks = distance + 3 if blocks is None else blocks
    masks = _masks(distance, blocks)
    keys = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)
    ])).alias("k")).select("fp", "k.c", "k.key")
    sizes = keys.groupBy("c", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stage(keys.join(sizes, ["c", "key"]), "blocks")
    few = shared.filter(F.col("n") <= block_rows)
    left = few.select("c", "key", F.col("fp").alias("a"))
    right = few.select("c", "key", F.col("fp").alias("b"))
    pairs = left.join(right, ["c", "key"]).filter(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    ).select("a", "b")
    return pairs.unionByName(_neighbour_links(shared.filter(F.col("n") > block_rows), masks, distance)).distinct()


def _neighbour_links(rows, masks, distance):
    """Pairs within `distance` have a value at most distance // 2 bits from one and the rest from the other."""
    near, far = distance // 2, distance - distance // 2
    flips = []
    for i, m in enumerate(masks):
        free = [_signed(1 << k) for k in range(64) if not (m >> k) & 1]
        changes = [(n, c) for n in range(far + 1) for c in combinations(free, n)]
        flips.append(F.when(F.col("c") == i, F.array(*[
            F.struct(F.lit(n).alias("n"), F.lit(_xor(c)).alias("x")) for n, c in changes
        ])))
    met = rows.select("c", "fp", F.explode(F.coalesce(*flips)).alias("f")).select(
        "c", (F.col("fp").bitwiseXOR(F.col("f.x"))).alias("mid"), "fp", F.col("f.n").alias("n")
    )
    hubs = met.filter(F.col("n") <= near).groupBy("c", "mid").agg(F.min("fp").alias("a"))
    return met.join(hubs, ["c", "mid"]).select("a", F.col("fp").alias("b")).filter("a <> b")


def _xor(values):
    out = 0
    for v in values:
        out ^= v
    return out


def groups(docs, keep=("doc_id",), text="text", id_col="doc_id", shingle=SHINGLE, distance=DISTANCE, **options):
    """Rows (keep..., fp, component_id): near-duplicate groups, named by their smallest id.

    Documents without words (null or empty text) have fingerprint zero and link like any other; of fewer
    words than a shingle, the whole sequence is one. Repeated rows share a fingerprint. Rows whose
    id is null belong to groups but don't name them: a group of only such rows has a null name.
    """
    keep = list(dict.fromkeys([id_col, *keep]))
    marked = stage(fingerprints(docs, keep, text, shingle), "fingerprints")
    distinct = stage(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    roots = components(links(distinct, distance, **options))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return marked.join(names, "fp").select(*keep, "fp", "component_id")


def dedupe(docs, text="text", id_col="doc_id", **options):
    """One document row of each group, with its columns: the smallest id, among its rows the smallest text hash.

    Rows equal in id and text are one document. Documents of a group without any id are represented by one row.
    """
    key = F.xxhash64(F.col(id_col).isNull(), F.col(text))
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at, words = f"c{names.index(id_col)}", f"c{names.index(text)}"
    key = F.xxhash64(F.col(at).isNull(), F.col(words))
    numbered = numbered.withColumn("row key", key).withColumn("row id", F.coalesce(F.col(at), F.lit(0)))
    found = groups(numbered.select(F.col(at).alias("id"), "row key", F.col(words).alias("text")),
                   ("id", "row key"), "text", "id", **options)
    one = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("unnamed")).agg(
        F.min(F.struct(F.col("id").isNull(), "id", "row key")).alias("m")
    ).select(F.coalesce("m.id", F.lit(0)).alias("row id"), F.col("m.row key").alias("row key"))
    kept = numbered.join(one.distinct(), ["row id", "row key"], "left_semi")
    kept = kept.dropDuplicates(["row id", "row key"])
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
