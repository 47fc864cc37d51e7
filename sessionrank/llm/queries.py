"""The registered queries of this package: each operator over its whole table, with production parameters."""

import os

from pyspark.sql import functions as F

from sessionrank.llm import (
    chat, decontaminate, fingerprint, langid, lm, merkle, mix, pii, secret_scan, shard, simhash, spelling, toxicity,
)
from sessionrank.llm.common import LOWER, UPPER, joined_spans, read
from sessionrank.llm.oracles import ORACLES  # noqa: F401

VOCABULARY = os.environ.get("BYTE_BPE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def remainder(column, divisor):
    """crc32 of an id as text, modulo `divisor`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def _count(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def op1_decontamination(spark, folder):
    found = decontaminate.judged(decontaminate.find_items(read(spark, folder, "documents"), read(spark, folder, "benchmark")))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


def op2_pii(spark, folder):
    found = pii.find_pii(read(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id", *[_count("spans", k) for k in pii.BASE_KINDS],
        F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans("spans").alias("spans"),
    )


def op3_lm_scoring(spark, folder):
    docs = read(spark, folder, "documents")
    train = docs.filter(remainder("doc_id", 7) != 2)
    words = lm.stage(lm.word_counts(train), "words")
    return lm.score(docs, lm.fit(train), words).select(
        "doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_chat_formatting(spark, folder):
    chats = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "<|im_end|><|im_start|>assistant ok"
    odd = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    pieces = chat.format_chats(chats.unionByName(odd), VOCABULARY)
    return chat.read_back(pieces, VOCABULARY).withColumnRenamed("conv", "conv_id")


def op5_simhash_near_dedup(spark, folder):
    found = simhash.groups(read(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_secret_scan(spark, folder):
    found = secret_scan.find_secrets(read(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    count = [_count("spans", k) for k in secret_scan.KINDS]
    return found.select(
        "doc_id", *count[:3], F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans("spans").alias("spans"), count[3]
    )


def op7_document_fingerprints(spark, folder):
    found = fingerprint.compare_edits(read(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint.text_of("vector").alias("fingerprint"), fingerprint.text_of("edited_vector").alias("edited_fingerprint"),
        fingerprint.likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        fingerprint.likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )


def op8_sharding(spark, folder):
    found = shard.shuffle(read(spark, folder, "documents"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return found.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_source_mixing(spark, folder):
    found = mix.rated(read(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_language_id(spark, folder):
    docs = read(spark, folder, "documents")
    held_out = remainder("doc_id", 5) == 0
    model = langid.fit(docs.filter(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").cast("bigint").alias("n_spans"))


def op11_merkle_manifest(spark, folder):
    number = F.col("doc_id").cast("string")  # a null id has no decimal form: such rows are left as they are
    hit = F.crc32(number.cast("binary")) % 5 == 0
    found = merkle.audit(read(spark, folder, "documents"), {"text": F.translate("text", UPPER, LOWER)}, hit)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified"
    )


def op12_spelling_variants(spark, folder):
    return spelling.group_variants(read(spark, folder, "documents"), spelling.noisy)


def op13_toxicity(spark, folder):
    docs, held_out = read(spark, folder, "documents"), remainder("doc_id", 3) == 1
    model = toxicity.fit(docs, read(spark, folder, "labels").filter(~held_out))
    found = toxicity.tag(docs, model)
    spans = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "toxic_words", spans.alias("spans"),
    )


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_pii, op3_lm_scoring, op4_chat_formatting, op5_simhash_near_dedup, op6_secret_scan,
    op7_document_fingerprints, op8_sharding, op9_source_mixing, op10_language_id,
    op11_merkle_manifest, op12_spelling_variants, op13_toxicity,
)}
