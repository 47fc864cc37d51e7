"""Stage tables: intermediate results written once to shared storage and read back.

A written table cuts the lineage, survives the loss of executors, and unlike a cached
plan keeps column pruning and partition pruning for its readers.
"""

import tempfile
import uuid
from contextlib import contextmanager

_open_scopes = []
# Functions to call when stage tables are deleted: whoever remembers some must forget them.
on_deletion = []


def stage_root(spark):
    """Shared folder for stage tables: the one named by spark.checkpoint.dir or set on the context.

    Where neither is set, a run in a single process (as in tests) sets a folder of its own; any other run must name one.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root and (context.master == "local" or context.master.startswith("local[")):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sessionrank-"))
        root = context.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and every executor can reach")
    return root


def stage_path(spark, name):
    """A fresh path under the shared folder."""
    path = f"{stage_root(spark)}/stages/{name}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


def materialize(df, name, partition_by=()):
    """Write `df` as a stage table and return the table."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


def materialize_alone(spark, build, name):
    """`materialize(build(), name)`, the stage tables that building it makes being deleted afterwards."""
    path = stage_path(spark, name)
    with stage_scope(spark):
        df = build()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path).select(*[f"`{c}`" for c in schema.names])


def discard(spark, path):
    """Deletes what is under a path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def stage_scope(spark):
    """Deletes the stage tables made inside on leaving; results must be written or collected by then."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for forget in on_deletion:
            forget()
        for path in _open_scopes.pop():
            discard(spark, path)
