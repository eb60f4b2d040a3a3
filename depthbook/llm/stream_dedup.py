"""Exact de-duplication by a stream with keyed state on disk.

Arrivals (id, digest, content locator) run through a streaming aggregation keyed by the SHA-256 of the text. Its state
lies in RocksDB on the executors' disks with a change log in the shared folder, and never expires: per digest the
number of rows, the largest id and where that row's content lies. Equal digests of one task meet before the shuffle,
so a text that a third of all rows repeat costs one row per task.

A digest seen more than once is a hit: all texts behind hits are compared byte for byte, as the smallest and largest
text of each digest. Should they differ, the digest's rows are grouped by digest and text instead.

Given `state_dir` the state is kept, and a later call with new rows continues from it; without it the call is complete
in itself. Texts are kept with the arrivals there, as files behind locators may change or go, so new rows are compared with
those of earlier calls too; a state whose arrivals have no texts raises an error at the first hit on them.

Cases: null texts count as empty texts; rows that repeat id and text are one group and are all marked kept where the id
is the group's largest; null ids lose against any other, a group of null ids alone has a null `keep_id` and is kept
whole, as nothing tells its rows apart; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.llm.common import shared_folder, stored, table, text_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Arrival files of a micro-batch; their rows are about 50 bytes each.
FILES_PER_BATCH = 1000


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _digest(column: str = "text"):
    return F.unhex(F.sha2(text_of(column), 256))


def stream_groups(arrivals_path: str, arrivals: DataFrame, state_dir: str) -> DataFrame:
    """Drain the arrivals through the state; the groups as the state has them, one row per digest."""
    spark = arrivals.sparkSession
    out = f"{state_dir}/groups"
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # Else every partition of the state sets aside 4 MB for its manifest.
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
        # One limit for all stores of an executor, which stay open for a while after the stream has ended.
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    }
    with _settings(spark, settings):
        groups = (
            spark.readStream.schema(arrivals.schema)
            .option("maxFilesPerTrigger", FILES_PER_BATCH)
            .parquet(arrivals_path)
            .groupBy("digest")
            .agg(
                F.count("*").alias("group_size"),
                F.max("doc_id").alias("keep_id"),
                F.max(F.struct("doc_id", "locator"))["locator"].alias("locator"),
            )
        )
        # A batch that is repeated after a failure writes the same folder again.
        query = (
            groups.writeStream.outputMode("update")
            .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}"))
            .option("checkpointLocation", f"{state_dir}/stream")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    schema = "digest binary, group_size long, keep_id long, locator string, batch long"
    updates = spark.read.schema(schema).option("basePath", out).parquet(out)
    # Sizes only grow, so the newest update of a digest is the one with the largest size.
    return updates.groupBy("digest").agg(
        F.max("group_size").alias("group_size"),
        F.max("keep_id").alias("keep_id"),
        F.max(F.struct("group_size", "locator"))["locator"].alias("locator"),
    )


def exact_duplicates(docs: DataFrame, state_dir: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest (binary), locator (file of the row that stays)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.input_file_name().alias("locator"))
    state = state_dir or shared_folder(spark, "dedup-state")
    path = shared_folder(spark, "arrivals")
    if state_dir:
        path = f"{state_dir}/arrivals"
    texts = docs.select(text_of("text").alias("text"), _digest().alias("digest"), "doc_id", "locator")
    arrivals = texts.select("doc_id", "digest", "locator")
    # One write, so that arrivals and their texts cannot part.
    (texts if state_dir else arrivals).write.mode("append").parquet(path)
    if state_dir:
        texts = spark.read.schema(texts.schema).parquet(path)
    arrivals = spark.read.schema(arrivals.schema).parquet(path)
    if arrivals.isEmpty():
        return _shaped(arrivals.withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(0).cast("long")}))
    groups = stored(stream_groups(path, arrivals, state), "groups")
    hits = groups.where("group_size > 1").select("digest")
    if state_dir and not texts.where("text is null").join(hits, "digest", "left_semi").isEmpty():
        raise ValueError(f"arrivals of earlier calls in {state_dir} were kept without their texts")
    unequal = (
        texts.join(hits, "digest", "left_semi")
        .groupBy("digest")
        .agg(F.min("text").alias("low"), F.max("text").alias("high"))
        .where("low <> high")
        .select("digest")
    )
    unequal = stored(unequal, "unequal")
    if unequal.isEmpty():
        return _shaped(arrivals.drop("locator").join(groups, "digest"))
    apart = texts.join(unequal, "digest", "left_semi")
    exact = apart.groupBy("digest", "text").agg(
        F.count("*").alias("group_size"),
        F.max("doc_id").alias("keep_id"),
        F.max(F.struct("doc_id", "locator"))["locator"].alias("locator"),
    )
    rest = arrivals.drop("locator").join(unequal, "digest", "left_anti").join(groups, "digest")
    return _shaped(rest.unionByName(apart.drop("locator").join(exact, ["digest", "text"]).drop("text")))


def _shaped(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest", "locator"
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents with one row of each group of equal texts; columns as they are."""
    kept = exact_duplicates(docs).where("kept").select("doc_id", "digest").distinct()
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__digest": _digest()})
    kept = kept.select(F.col("doc_id").alias("__kept"), F.col("digest").alias("__digest"))
    keyed = keyed.join(
        kept, (keyed["__digest"] == kept["__digest"]) & keyed["__id"].eqNullSafe(kept["__kept"]), "left_semi"
    )
    return keyed.dropDuplicates(["__id", "__digest"]).drop("__id", "__digest")


def op7_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE_OP7 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
