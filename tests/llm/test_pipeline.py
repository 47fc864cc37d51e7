import os

import corpus_pipeline
from sessionrank.functions.staging import stage_root
from sessionrank.llm import decontaminate, simhash
from sessionrank.llm.common import read

FOLDER = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_and_drop_what_their_operators_say(spark):
    docs = read(spark, FOLDER, "documents")
    columns = docs.columns
    (_, language), (_, dedup), (_, clean), (_, mixing), (_, sharding) = corpus_pipeline.STAGES

    spoken = language(spark, docs, FOLDER)
    assert spoken.columns == columns
    letters = [r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert len(ids(spoken)) >= 0.98 * len(letters) and set(ids(spoken)) <= set(letters)

    single = dedup(spark, spoken, FOLDER)
    assert single.columns == columns
    prints = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(spoken).collect()}
    seen = ids(single)
    for i, p in prints.items():
        if i not in seen:  # what goes has something close that is kept or went, with a smaller or linked id
            assert any(((p ^ q) % (1 << 64)).bit_count() <= 2 for j, q in prints.items() if j != i)
    assert all(((prints[i] ^ prints[j]) % (1 << 64)).bit_count() > 2 for i in seen for j in seen if i < j)

    cleaned = clean(spark, single, FOLDER)
    assert cleaned.columns == columns
    marked = decontaminate.judged(decontaminate.find_items(single, read(spark, FOLDER, "benchmark")))
    assert ids(cleaned) == ids(marked.filter("not contaminated"))

    mixed = mixing(spark, cleaned, FOLDER)
    assert mixed.columns == columns and set(ids(mixed)) <= set(ids(cleaned))
    sharded = sharding(spark, mixed, FOLDER)
    assert ids(sharded) == ids(mixed) and {"shard", "slot"} <= set(sharded.columns)


def test_run_and_empty_input(spark):
    folder = f"{stage_root(spark).removeprefix('file:')}/stages"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = corpus_pipeline.run(spark, FOLDER)
    left = [name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before]
    # What the first four stages made on the way is gone, their rows and the last one's tables are there.
    assert {f"llm-{name}" for name, _ in corpus_pipeline.STAGES[:-1]} <= set(left) and not [n for n in left if "mix-" in n or "star" in n]
    sizes = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    docs = read(spark, FOLDER, "documents").limit(0)
    for _, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, FOLDER)
        assert docs.collect() == []
