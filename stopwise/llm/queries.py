"""The numbered queries: thin digests of the operators over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cover_lloyd, curriculum, kd_shards, line_dedup, near_join, oracles, phrase_index, quality, secret_crf, token_links, token_trie, toxicity, warc, weak_rules
from .shared import crc_fold, documents, labels, ship_package, table_path

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"      # public vocabularies, read where they are
BYTE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
Builder = Callable[[SparkSession, str], DataFrame]


def op1_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = quality.featurize(documents(spark, sf_dir))
    model = quality.train(feats, labels(spark, sf_dir).where(crc_fold("doc_id", 5) != 0))
    return quality.score(feats, model).select(
        "doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = curriculum.document_sizes(documents(spark, sf_dir))
    return curriculum.taken(curriculum.placed(sizes, curriculum.source_weights(sizes)))


def op3_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_classes(documents(spark, sf_dir), 3, near_join.Threshold(90, 100)).drop("key", "component")


def op4_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_rules.judge(weak_rules.statistics(documents(spark, sf_dir)))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                         (~failed & F.col("verdict")).alias("kept"), "p_good")


def op5_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    path = warc.write_archives(warc.records(spark.read.parquet(table_path(sf_dir, "pages"))))
    return warc.resolved(warc.read_archives(spark, path)).drop("digest_ok")


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.fuzzy_lines(documents(spark, sf_dir))


def op7_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = toxicity.train(docs, labels(spark, sf_dir).where(crc_fold("doc_id", 3) != 1))
    return toxicity.score(docs, net).select(
        "doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_phrase_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = phrase_index.build_index(documents(spark, sf_dir))
    found = phrase_index.phrase_matches(index, spark.read.parquet(table_path(sf_dir, "benchmark")))
    return phrase_index.contamination(index, found).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op9_token_trie(spark: SparkSession, sf_dir: str, model_file: str = MODEL_FILE) -> DataFrame:
    return token_trie.token_counts(documents(spark, sf_dir), token_trie.Vocabulary.of(token_trie.read_pieces(model_file)))


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kd_shards.with_slots(kd_shards.assign(kd_shards.slim(documents(spark, sf_dir)), 16))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secret_crf.digest(secret_crf.find_secrets(docs, secret_crf.train(docs)))


def op12_token_links(spark: SparkSession, sf_dir: str, a_file: str = BYTE_FILE, b_file: str = MODEL_FILE) -> DataFrame:
    return token_links.link_statistics(token_links.align_documents(documents(spark, sf_dir), a_file, b_file), a_file, b_file)


def op13_cover_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = cover_lloyd.compress(spark.read.parquet(table_path(sf_dir, "embeddings")))
    return cover_lloyd.with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(cover_lloyd.codebook_digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Builder] = {f.__name__: f for f in (op1_quality_discriminant, op2_curriculum_mix, op3_near_join, op4_weak_rules, op5_warc_chain, op6_fuzzy_lines, op7_gru_toxicity,
                                                   op8_phrase_decontamination, op9_token_trie, op10_kd_shards, op11_secret_crf, op12_token_links,
                                                   op13_cover_lloyd)}
ORACLES: dict[str, str] = {
    "op2_curriculum_mix": oracles.CURRICULUM,
    "op5_warc_chain": oracles.WARC,
    "op8_phrase_decontamination": oracles.PHRASES,
    "op13_cover_lloyd": oracles.cover_lloyd(),
}
