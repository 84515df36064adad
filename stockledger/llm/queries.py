"""The operators bound to the tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, decontaminate, html, langid, mixing, ngram_join, packing, passages, prefix_trie, quality, rules, sharding, toxicity
from .common import Shared, fold, read

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    model, stored = toxicity.fit(docs, labels, "doc_id", "text", "toxic", fold("doc_id", 4) != 2, Shared(spark, "toxicity"))
    return toxicity.predict(stored, model, "doc_id").select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "neighbours", "cosines")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", Shared(spark, "ngram"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.deduplicate(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", Shared(spark, "passages"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"), "html")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    rows = Shared(spark, "quality").save(quality.with_features(docs, "doc_id", "text"), "features")
    model = quality.fit_labels(rows, labels, "doc_id", "quality", fold("doc_id", 5) != 0)
    scored = rows.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), quality.score(rows, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.CUT).cast("int"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs, "text", "lang", "doc_id", fold("doc_id", 4) != 2)
    found = langid.predict(docs, model, "doc_id", "text")
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def tokeniser() -> dict:
    """The public vocabulary's files on this machine; every executor has them at the same place."""
    import public_tokenizers

    return {"path": str(public_tokenizers.path("byte_bpe_50k.json")), "ranks": (str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)}


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.tokenise(docs, "doc_id", "text", **tokeniser()), "doc_id", Shared(spark, "packing"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark").select("item_id", "text")
    found, hits = decontaminate.find(docs, "doc_id", "text", items, "item_id", "text", Shared(spark, "decontaminate"))
    return decontaminate.report(found, "doc_id", hits).drop("doc")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id", "text", "source", Shared(spark, "rules"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), "conv_id", "turn", "role", "text", Shared(spark, "trie"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding", Shared(spark, "centroids"))
    return found.drop("n_compared")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id", "text", "source", Shared(spark, "mixing"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_ngram_join": op2_ngram_join,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_sharding": op4_sharding,
        "op5_html_text": op5_html_text,
        "op6_quality": op6_quality,
        "op7_language_id": op7_language_id,
        "op8_packing": op8_packing,
        "op9_decontamination": op9_decontamination,
        "op10_quality_rules": op10_quality_rules,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_centroids": op12_centroids,
        "op13_mixing": op13_mixing,
    }


def oracle_sql() -> dict[str, str]:
    table = ",".join(map(str, sharding.fill_table(SHARDS)))
    return {
        "op2_ngram_join": ngram_join.oracle(),
        "op9_decontamination": decontaminate.oracle(),
        "op10_quality_rules": rules.oracle(),
        "op11_prefix_trie": prefix_trie.oracle(),
        "op12_centroids": centroids.oracle(),
        "op13_mixing": mixing.oracle(),
        "op4_sharding": f"""
            WITH t AS (SELECT unnest(range({sharding.DEFAULT_TABLE_SIZE})) AS slot, unnest([{table}]) AS owner),
            d AS (SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) % {sharding.DEFAULT_TABLE_SIZE} AS slot FROM documents)
            SELECT doc_id, d.slot AS slot, 'shard-' || lpad(CAST(owner AS VARCHAR), 3, '0') AS shard FROM d JOIN t ON d.slot = t.slot
        """,
    }
