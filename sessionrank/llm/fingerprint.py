"""Document fingerprints by a homomorphic multiset hash, in DataFrame expressions only.

Each paragraph (line) is hashed to a vector, and the vectors are added, so that the order of paragraphs
does not matter and a paragraph can be added or taken away without reading the rest. A vector has
EXACT lanes of a hash of the paragraph, modulo 2^32, that tell equality; a count of its pieces (runs of
PIECE words) modulo 2^32; and SIGNS lanes in which each piece counts +1 or -1, modulo 2^16. The
cosine of the sign lanes estimates how many pieces two documents share.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sessionrank.llm.common import stage

EXACT, SIGNS, PIECE = 16, 64, 4
_PIECES = r"(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){1,%d}+" % PIECE
_MOD32, _MOD16 = (1 << 32) - 1, (1 << 16) - 1


def vectors(texts, keys, text):
    """Rows (keys..., vector array<bigint>): the sum of the vectors of a text's paragraphs; lanes as in the module's text.

    `keys` identify the rows of `texts`. The parts of a text are summed in the task that holds it; only one
    row for each text is shuffled. Null and empty texts have one empty paragraph without pieces.
    """
    lines = texts.select(*keys, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line"))
    hashed = lines.select(*keys, F.xxhash64("line").alias("line hash"), F.posexplode_outer(
        F.regexp_extract_all("line", F.lit(_PIECES), F.lit(0))
    ).alias("i", "piece")).select(
        *keys, F.when(F.coalesce("i", F.lit(0)) == 0, F.col("line hash")).alias("line hash"),
        F.when(F.col("piece").isNotNull(), F.xxhash64("piece")).alias("p"),
    )
    exact = [F.sum(F.when(F.col("line hash").isNotNull(), F.xxhash64("line hash", F.lit(j)).bitwiseAND(F.lit(_MOD32)))).alias(f"e{j}") for j in range(EXACT)]
    # two sign lanes to a sum: bit counts of bit j in the lower, of bit j + 32 in the upper half
    pairs = [F.sum(F.shiftrightunsigned("p", j).bitwiseAND(F.lit(0x0000000100000001))).alias(f"s{j}") for j in range(SIGNS // 2)]
    sums = hashed.groupBy(*keys).agg(F.count("p").alias("n"), *exact, *pairs)
    bits = [F.coalesce(F.shiftright(F.col(f"s{j % 32}"), 32 * (j // 32)).bitwiseAND(F.lit(_MOD32)), F.lit(0)) for j in range(SIGNS)]
    return sums.select(*keys, F.array(
        *[F.col(f"e{j}").bitwiseAND(F.lit(_MOD32)) for j in range(EXACT)],
        F.col("n").bitwiseAND(F.lit(_MOD32)),
        *[(F.col("n") - 2 * b).bitwiseAND(F.lit(_MOD16)) for b in bits],
    ).alias("vector"))


def _lanes(a, b, sign):
    return F.transform(F.zip_with(a, b, lambda x, y: x + sign * y), lambda v, i: F.when(
        i <= EXACT, v.bitwiseAND(F.lit(_MOD32))
    ).otherwise(v.bitwiseAND(F.lit(_MOD16))))


def plus(a, b):
    """The vector of the paragraphs of both."""
    return _lanes(a, b, 1)


def minus(a, b):
    """The vector without the paragraphs of the second."""
    return _lanes(a, b, -1)


def text_of(vector):
    """A vector as a hex string: eight digits to each exact lane and the count, four to a sign lane."""
    return F.concat_ws("", F.transform(vector, lambda v, i: F.lower(F.lpad(
        F.hex(v), F.when(i <= EXACT, 8).otherwise(4), F.lit("0")
    ))))


def likeness(a, b):
    """0 to 1: 1 for equal vectors, else the cosine of the sign lanes, negative ones as 0."""
    def signed(v):
        return F.transform(F.slice(v, EXACT + 2, SIGNS), lambda x: F.when(x > 32767, x - 65536).otherwise(x))

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: (p * q).cast("double")), F.lit(0.0), lambda s, v: s + v)

    size = dot(signed(a), signed(a)) * dot(signed(b), signed(b))
    cosine = F.when(size > 0, dot(signed(a), signed(b)) / F.sqrt(size)).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def followers(rows, order):
    """`rows` with next_* columns: the `order` columns of the following row in that order; of the first after the last.

    `rows` are distinct in `order`. They are dealt out by ranges; within a range a window looks one row ahead, and the
    last row of a range gets the first one of the next, from a table of one row for each range.
    """
    ranged = rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranged = stage(ranged, "ranges")
    mine = F.struct(*order)
    inside = Window.partitionBy("range").orderBy(*order)
    firsts = ranged.groupBy("range").agg(F.min(mine).alias("first"))
    by_range = Window.orderBy("range")  # one row for each range
    firsts = firsts.select("range", F.coalesce(
        F.lead("first").over(by_range), F.first("first").over(by_range.rowsBetween(Window.unboundedPreceding, 0))
    ).alias("after"))
    found = ranged.withColumn("ahead", F.lead(mine).over(inside)).join(firsts, "range")
    found = found.withColumn("ahead", F.coalesce("ahead", "after"))
    return found.select(*rows.columns, *[F.col(f"ahead.{c}").alias(f"next_{c}") for c in order])


def compare_edits(docs, id_col="doc_id", text="text", share=4):
    """Rows (id, n_chars, edited_sha256, vector, edited_vector, next_vector), one for each document row.

    The edited text is the text with its last n_chars // share code points replaced by the first as many (or all) of the
    next document's: the next one by id (null ids first, then by a hash of the text), after the last the first. Rows equal in id
    and text are one document in this order. A null text is empty. Other columns play no part. The vectors are sums as in
    `vectors`; texts are shuffled once, and the parts that move to the document before once more.
    """
    source = docs.select(
        F.coalesce(F.col(id_col), F.lit(0)).alias("k"), F.when(F.col(id_col).isNull(), 0).otherwise(1).alias("given"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("h", F.xxhash64("text")).select("given", "k", "h", "text")
    key = ["given", "k", "h"]
    size = source.select(*key, F.length("text").alias("n_chars")).distinct()
    order = followers(size, key)
    wanted = order.select(
        *[F.col(f"next_{c}").alias(c) for c in key], *[F.col(c).alias(f"prev_{c}") for c in key],
        F.floor(F.col("n_chars") / share).cast("int").alias("many"),
    )
    # one row of equal ones lends its text
    lent = source.join(wanted, key).select(*[F.col(f"prev_{c}").alias(c) for c in key], F.left("text", F.col("many")).alias("moved"))
    lent = lent.groupBy(*key).agg(F.first("moved").alias("moved"))
    whole = source.join(lent, key).withColumn("n_chars", F.length("text").cast("bigint"))
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / share)
    whole = whole.select(*key, F.monotonically_increasing_id().alias("row"), "n_chars", "text",
                         F.concat(F.left("text", kept.cast("int")), F.col("moved")).alias("edited"))
    both = whole.select(*key, "row", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("words")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("words"))
    )).alias("t")).select(*key, "row", "n_chars", "edited_sha256", "t.which", "t.words")
    hashed = stage(vectors(both, [*key, "row", "n_chars", "edited_sha256", "which"], "words"), "vectors")
    own = hashed.filter("which = 0").drop("which")
    edited = hashed.filter("which = 1").select("row", F.col("vector").alias("edited_vector"))
    following = own.select(*[F.col(c).alias(f"next_{c}") for c in key], F.col("vector").alias("next_vector"))
    following = following.dropDuplicates([f"next_{c}" for c in key])
    ahead = order.select(*key, *[f"next_{c}" for c in key]).join(following, [f"next_{c}" for c in key]).select(*key, "next_vector")
    return own.join(edited, "row").join(ahead, key).select(
        F.when(F.col("given") == 1, F.col("k")).alias(id_col), "n_chars", "edited_sha256", "vector", "edited_vector", "next_vector"
    )
