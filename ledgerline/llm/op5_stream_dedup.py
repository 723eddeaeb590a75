"""Exact duplicates by a stateful stream: state per digest on disk, without expiry, bytes checked on hits.

The table is read as a file stream. RocksDB state keeps, for each digest, the largest (stable identifier, content locator)
and the number of rows; it never expires, so the same folder takes up new files later. Rows whose digest has more than one
row are hits: they are grouped by digest and text, which compares whole bytes and leaves one text a task and group to move.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm._common import shared_dir, small_or_shuffled, stored

_ROCKS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # no space is set aside: with many partitions that is more than the state
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
_LOCATOR = "named_struct('doc_id', CAST(doc_id AS BIGINT), 'file', _metadata.file_path, 'row', _metadata.row_index)"


def digested(rows: DataFrame) -> DataFrame:
    """Each row's digest, identifier and locator (file and row in it), and its text."""
    return rows.selectExpr("sha2(coalesce(text, ''), 256) digest", f"{_LOCATOR} place", "coalesce(text, '') text")


def fed(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Run the stream over the files at path that folder has not seen; rows (digest, place, group_size), the last state of each digest."""
    path = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    before = {k: spark.conf.get(k, None) for k in _ROCKS}
    for k, v in _ROCKS.items():
        spark.conf.set(k, v)
    try:
        # as a pattern, the path may name one file as well as a folder
        rows = digested(spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]"))
        state = rows.groupBy("digest").agg(F.max("place").alias("place"), F.count("*").alias("group_size"))
        stream = state.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
        query = stream.foreachBatch(lambda changed, n: changed.write.mode("overwrite").parquet(f"{folder}/changes/batch={n}")).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    kind = "digest string, place struct<doc_id: bigint, file: string, row: bigint>, group_size bigint, batch int"
    changes = spark.read.schema(kind).option("basePath", f"{folder}/changes").parquet(f"{folder}/changes")
    return changes.groupBy("digest").agg(F.max_by("place", "batch").alias("place"), F.max("group_size").alias("group_size"))


def exact_duplicates(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """One row per row of the Parquet table at path (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    folder, in storage that all executors share, holds the state; with the folder of an earlier call only new files go
    through the stream. Without one, a new folder is taken.
    Texts are equal if their bytes are; null counts as empty. Of equal texts the row with the largest doc_id is kept.
    Defined results: of rows that repeat doc_id and text, the one with the greatest locator is kept; null doc_ids come
    before all others; an empty table gives an empty result; other columns are not read. Texts of one digest and other
    bytes form groups of their own by their bytes.
    """
    folder = folder or f"{shared_dir(spark)}/op5-{uuid.uuid4().hex}"
    table = spark.read.parquet(path)
    if not table.limit(1).count():
        return table.selectExpr("CAST(doc_id AS BIGINT) doc_id", "CAST(doc_id AS BIGINT) keep_id", "1L group_size", "true kept", "sha2('', 256) text_sha256")
    state = fed(spark, path, folder).withColumnRenamed("place", "keep")
    rows = digested(table)
    hits = rows.join(small_or_shuffled(state.where("group_size > 1").select("digest"), 100), "digest", "left_semi")
    # bytes against bytes: equal rows of a task become one before they move; a digest with several texts is odd
    odd = hits.groupBy("digest", "text").agg(F.count("*").alias("n")).groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    odd = stored(odd, "odd-digests")
    out = rows.select("digest", "place").join(state, "digest").select("digest", "place", "keep", "group_size")
    if odd.limit(1).count():
        strays = rows.join(odd, "digest")
        groups = strays.groupBy("digest", "text").agg(F.max("place").alias("keep"), F.count("*").alias("group_size"))
        strays = strays.join(groups, ["digest", "text"]).select("digest", "place", "keep", "group_size")
        out = out.join(odd, "digest", "left_anti").union(strays)
    return out.selectExpr("place.doc_id doc_id", "keep.doc_id keep_id", "group_size", "place = keep kept", "digest text_sha256")
