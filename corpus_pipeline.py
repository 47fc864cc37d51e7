"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return the columns
of documents; the last one adds shard and slot. Stages write their rows as Parquet; the next one reads them.
"""

from sessionrank.functions.staging import materialize_alone
from sessionrank.llm import decontaminate, langid, mix, shard, simhash
from sessionrank.llm.common import read


def language_id(spark, docs, sf_dir):
    """Drops documents without a letter and those without a main language. Learns from all labelled rows' languages."""
    return langid.accept(docs, langid.fit(docs))


def near_dedup(spark, docs, sf_dir):
    """Keeps the document with the smallest id of each group of near-duplicates (three-word shingles, two bits)."""
    return simhash.dedupe(docs)


def decontamination(spark, docs, sf_dir):
    """Drops documents of which at least one word in twenty lies in a passage of a benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark, docs, sf_dir):
    """Takes each document as often as its source's target asks for."""
    return mix.mix(docs)


def sharding(spark, docs, sf_dir):
    """Deals all rows out to shards of equal row counts, in uniformly random order."""
    return shard.shuffle(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Fingerprints (XXH64), the fitted model and the random draws have no SQL counterpart; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, from the documents table to sharded rows. Tables that a stage makes on the way are deleted once it is written."""
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = materialize_alone(spark, lambda apply=apply, docs=docs: apply(spark, docs, sf_dir), f"llm-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
