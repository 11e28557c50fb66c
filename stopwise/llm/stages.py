"""Pipeline stages: each calls one operator and lets its decisions take effect.

All but the last return the rows they keep with the columns they were given. Decisions meet
their rows by a 64-bit key of id and text (``keyed``), so null and repeated ids are safe.
Empty tables stay empty; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import curriculum, kd_shards, linking, near_join, phrase_index, quality
from .shared import labels, release, stored, table_path

KEY, POSITION = "__stage_key", "__stage_position"
SHARDS = 16


def keyed(docs: DataFrame) -> DataFrame:
    """Add a 64-bit key of (doc_id, text): the same in every read, also for null ids and repeated ids with other texts."""
    return docs.withColumn(KEY, F.xxhash64("doc_id", "text"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the discriminant, fitted on all labelled rows of ``docs``, scores 0.3 or more.

    No document moves: the model travels to the tasks and filters rows where they are. A null or empty text is scored like
    any other (its statistics are zero)."""
    model = quality.train(quality.featurize(docs), labels(spark, sf_dir))
    return quality.keep(docs, model, 0.3)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the smallest doc_id, of each group of near copies (5-word shingles, 0.8).

    Texts without words are in no group. Rows equal in id and text count as copies."""
    docs = keyed(docs)
    near = stored(near_join.near_classes(docs, 5, near_join.Threshold(80, 100), key_col=KEY).where("n_shingles > 0"), "near")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    groups = near.groupBy("component").agg(first.alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    dropped = stored(near.join(groups, "component").where("key <> first.key")
                     .select(F.col("key").alias(KEY)).distinct(), "dropped")
    twice = stored(near.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("key").alias(KEY)), "repeated")
    release(near)
    kept = docs.join(linking.bounded(dropped), KEY, "left_anti")
    if not twice.isEmpty():
        twice = linking.bounded(twice)
        kept = kept.join(twice, KEY, "left_anti").unionByName(kept.join(twice, KEY, "left_semi").dropDuplicates([KEY]))
    return kept.drop(KEY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more of the words lies in 13-word passages of the benchmark. Null and empty
    texts have no words and stay."""
    docs = keyed(docs)
    index = phrase_index.build_index(docs, id_col=KEY)
    found = phrase_index.phrase_matches(index, spark.read.parquet(table_path(sf_dir, "benchmark")))
    bad = stored(phrase_index.contamination(index, found).where("contaminated").select(F.col("doc_id").alias(KEY)).distinct(), "contaminated")
    release(index)
    return docs.join(linking.bounded(bad), KEY, "left_anti").drop(KEY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: a row for every copy of a document that the curriculum takes, range-sorted by training position.

    Documents are whole here: the copy that a source's target cuts is taken if at least half
    of it is wanted. Rows equal in id and text share a place on the token line, so each of
    their copies is a row."""
    docs = keyed(docs)
    sizes = curriculum.document_sizes(docs, id_col=KEY)
    rows = curriculum.copies(curriculum.placed(sizes, curriculum.source_weights(sizes)))
    taken = stored(rows.where("2 * words >= size").select(F.col("doc_id").alias(KEY), F.col("position").alias(POSITION)), "mix")
    repeated = sizes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    if not repeated.isEmpty():
        docs = docs.dropDuplicates([KEY])
    small = taken.count() <= linking.BROADCAST_IDS
    return (docs.join(F.broadcast(taken) if small else taken, KEY).repartitionByRange(POSITION, KEY).sortWithinPartitions(POSITION, KEY)
            .drop(KEY, POSITION))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): sixteen shards of near-equal bytes; a null text has size 1."""
    rows = kd_shards.with_slots(kd_shards.assign(kd_shards.slim(docs), SHARDS))
    return rows.select("doc_id", "size", "text_crc32", "shard", "slot")
