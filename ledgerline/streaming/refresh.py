"""Incremental refresh: slices that changed are converted and replaced, then the manifest says so; a rerun resumes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.casting import typed
from ledgerline.functions.fields import id_parts
from ledgerline.operators.manifest import changed, upserted
from ledgerline.sources import slices
from ledgerline.sources.archive import write_raw


def refreshed(rows: DataFrame, files: DataFrame, manifest: DataFrame, kind: str = "Full", landed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the changed slices, and the manifest afterwards. rows have logical_id; files are a parsed listing.

    Only slices whose file has landed get an entry, so that the others are taken up by the next call: those that rows has,
    or those of landed (logical_id), where a file without rows may be named too. Of datestamp, parquet_key and updated_at,
    an entry has those that the manifest has; other columns of a new entry are NULL.
    """
    todo = changed(files, manifest, kind).select("logical_id", "etag", "datestamp")
    new = rows.join(todo.select("logical_id"), "logical_id", "left_semi")
    counts = new.groupBy("logical_id").agg(F.count("*").alias("row_count"))
    if landed is not None:
        counts = landed.select("logical_id").distinct().join(counts, "logical_id", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    product, year, agency = id_parts(F.col("logical_id"))
    entries = todo.join(counts, "logical_id").withColumns({"parquet_key": F.concat(product, F.lit("/fiscal_year="), year, F.lit("/agency="), agency), "updated_at": F.current_timestamp()})
    own = [c for c in ("logical_id", "etag", "row_count", "datestamp", "parquet_key", "updated_at") if c in manifest.columns]
    return new, upserted(manifest, entries.select(*[F.col(c).cast(manifest.schema[c].dataType).alias(c) for c in own]))


def refresh(rows: DataFrame, files: DataFrame, manifest: DataFrame, root: str, save: Callable[[DataFrame], None]) -> None:
    """Replaces the changed slices under root, then saves the manifest: a crash in between repeats work and skips none."""
    new, after = refreshed(rows, files, manifest)
    write_raw(new, root)
    save(after)


def stream_refresh(spark: SparkSession, folder: str, schema: StructType | str, root: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = typed, listing: DataFrame | None = None) -> None:
    """Takes up all CSV files that are new in a folder since the last call, typed, as slices under root; see sources.slices.

    A file's slice and archive cycle are in its path, in the archive's form of names: files of one cycle add up, a newer
    cycle replaces the older, Deltas are no slices. Each batch is committed with its manifest entries, etags from listing.
    The checkpoint saves reading files again; without it they are read and change nothing. Files are immutable.
    """
    rows = spark.readStream.schema(schema).options(header=True, multiLine=True, escape='"', recursiveFileLookup=True).csv(folder)

    def publish(batch: DataFrame, _: int) -> None:
        rows = batch.withColumns(slices.slice_columns(F.col("_file"))).where("kind = 'Full'").drop("_file", "kind")
        slices.stage(transform(rows), root)
        slices.commit(batch.sparkSession, root, listing)

    query = rows.select("*", F.col("_metadata.file_path").alias("_file")).writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
