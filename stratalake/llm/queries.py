"""The queries of the training-data operators and the SQL that checks them, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, decontaminate, language, mixing, packing, quality, rules, secrets, simhash, token_output, toxicity, url_filter, whitening
from .common import fold, new_dir, table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), out="score")
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= quality.GOOD).cast("int").alias("predicted"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mixing.dealt(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", F.round("first_position", 9).alias("first_position"), "passes")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "bench.n_words", "bench.n_hit", F.size("bench.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("bench.items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secrets", lambda s: s["kind"].isin(*[r.kind for r in secrets.BASE]))
    return found.select("doc_id", *[count(r.kind) for r in secrets.BASE], F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "language.lang_pred", "language.score")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    score = F.col("toxicity.score")
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), score.alias("score"), (score >= toxicity.REJECT).cast("int").alias("predicted"), "toxicity.spans")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs, a stored table, written as token records and read back. The files stay under `path`; without one they lie in
    the shared folder until the driver ends."""
    import public_tokenizers

    path = path or new_dir(docs.sparkSession, "tokens")
    token_output.write_records(docs, path, public_tokenizers.path("word_bpe_49k.json"), split_on_space=True, part_equal=True)
    return token_output.read_records(docs.sparkSession, path)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.score(alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")))


def op12_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), split_on_space=True)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    entries = F.posexplode(F.arrays_zip("white.whitened", "white.explained")).alias("component", "entry")
    found = rows.select("vec_id", "white", entries)
    return found.select("vec_id", (F.col("component") + 1).alias("component"), "white.n", "white.deviation", "entry.whitened", "entry.explained", "white.identity_error")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_classifier, op2_quality_rules, op3_benchmark_decontamination, op4_source_mixing, op5_secret_scan, op6_language_id, op7_simhash_near_dedup, op8_toxicity, op9_token_output, op10_url_filter, op11_token_alignment, op12_sequence_packing, op13_embedding_whitening, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op3_benchmark_decontamination": decontaminate.DECONTAMINATION_SQL, "op4_source_mixing": mixing.MIX_SQL, "op10_url_filter": url_filter.verdict_sql()}
