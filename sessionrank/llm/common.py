"""Text batches, stage tables and digests shared by the operators."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionrank.functions.staging import materialize

# ASCII letters, and ASCII white space as [\x20\x09-\x0D].
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())

# Python tasks work on so many bytes of text at a time.
PIECE_BYTES = 1 << 20


def read(spark, folder, name):
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df, name):
    """`df` written to the shared folder and read back, under the same column names."""
    return materialize(df, f"llm-{name}")


def without(df, *names):
    """`df` without the columns that bear one of the names (results replace them)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def lowered(text):
    """A-Z to a-z and nothing else; null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def joined_spans(spans):
    """`kind:start:end,...` of an array of structs (kind, start, end)."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )))


def texts_of(column):
    """The texts of an Arrow column as bytes; null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def pieces(batch, at):
    """Consecutive slices of a batch whose texts (column number `at`) come to PIECE_BYTES or a single row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def map_texts(df, text, keep, fields, make):
    """Rows (keep..., fields...): what Python tasks make of each text, in Arrow batches (Spark bounds their bytes).

    `make()` runs once in each task and returns a function from a list of texts (bytes, null as
    empty) and the record batch of the kept columns to a list of Arrow arrays or Python lists,
    one for each of `fields` ("name type, ..."). No rows are added or dropped.
    """
    extra = T.StructType.fromDDL(fields)
    n = len(keep)
    at = list(keep).index(text) if text in keep else n
    source = df.select(*[F.col(f"`{k}`") for k in keep], *([F.col(f"`{text}`")] if at == n else []))
    schema = T.StructType([*source.schema.fields[:n], *extra.fields])
    kinds = _arrow(extra)

    def run(batches):
        each = make()
        for batch in batches:
            for piece in pieces(batch, at):
                made = each(texts_of(piece.column(at)), piece)
                made = [x if isinstance(x, pa.Array) else pa.array(x, k.type) for x, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([*piece.columns[:n], *made], names=[f.name for f in schema.fields])

    return source.mapInArrow(run, schema)


def flat_map(df, schema, make):
    """Rows of `schema` that Python tasks make of a DataFrame's Arrow batches.

    `make()` runs once in each task and returns (each, last): each(batch) and last() give lists of columns or None.
    """
    fields = T.StructType.fromDDL(schema)
    kinds = _arrow(fields)

    def run(batches):
        each, last = make()
        for batch in batches:
            yield from _batch(each(batch), kinds)
        yield from _batch(last(), kinds)

    return df.mapInArrow(run, fields)


def _batch(columns, kinds):
    if columns is not None and len(columns[0]):
        yield pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, k.type) for c, k in zip(columns, kinds)], names=[k.name for k in kinds]
        )


def _arrow(struct):
    from pyspark.sql.pandas.types import to_arrow_schema

    return list(to_arrow_schema(struct))


def table_sizes(df, rows):
    """The rows of a small table as tuples; `rows` is its proven limit."""
    found = df.limit(rows + 1).collect()
    if len(found) > rows:
        raise ValueError(f"the table has more rows than its limit of {rows}")
    return [tuple(r) for r in found]
