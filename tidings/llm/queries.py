"""The registered queries of this subpackage, thin over its operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.llm import (
    decontamination, jaccard, language, middle, pieces, pii, prefix_trie, quality_model, quality_rules, repeats, secrets, toxicity, warc,
)
from tidings.llm.common import table
from tidings.llm.oracles import ORACLES  # noqa: F401


def op1_decontamination(spark, sf_dir):
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op2_warc(spark, sf_dir):
    return warc.roundtrip(table(spark, sf_dir, "pages"))


def op3_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(documents).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op4_quality_rules(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.verdicts(documents, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_pieces(spark, sf_dir):
    return pieces.encode(table(spark, sf_dir, "documents"))


def op6_secrets(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] < secrets.KINDS.index("entropy"))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.told(base), 256).alias("base_sha256"), secrets.told(F.col("secrets")).alias("spans"),
    )


def op7_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_model.classify(documents, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op8_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(documents, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted", "spans")


def op9_jaccard(spark, sf_dir):
    return jaccard.link(table(spark, sf_dir, "documents"))


def op10_pii(spark, sf_dir):
    return pii.digest(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))


def op12_middle(spark, sf_dir):
    made = middle.restored_sha256(middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    return made.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_repeats(spark, sf_dir):
    found = repeats.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0))
    return found.select(
        "row.doc_id", n_bytes.cast("long").alias("n_bytes"), (n_bytes - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_warc, op3_language, op4_quality_rules, op5_pieces, op6_secrets, op7_quality, op8_toxicity, op9_jaccard, op10_pii,
    op11_prefix_trie, op12_middle, op13_repeats,
)}
