"""Slices that arrive in several files: rows staged by file, committed together, read as the union of a slice's live files.

    root/data/product=/fiscal_year=/agency=/cycle=/file=/   rows of one source file, invisible until its entry is there
    root/manifest/<id>/                                     entries of one commit, JSON: a row a file

A slice's live files are the committed ones of its newest archive cycle: files of one cycle add up in whatever order and in
however many batches they come, a newer cycle replaces the older. A file is staged and committed once, so a batch that is
replayed, also after its checkpoint is lost, changes nothing; one that failed before its commit is staged anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.fields import logical_id
from ledgerline.sources import files
from ledgerline.sources.archive import MANIFEST, partitioned_text, write_slices

# Fixed value: the form of the archive's names, as part of the path of what was landed from it.
_NAME = r"FY\(?(\d{4}|All)\)?_([^_/]+)_(Contracts|Assistance)_(Full|Delta)_(\d{8})"
KEYS = ["product", "fiscal_year", "agency", "cycle", "file"]
ENTRY = f"{MANIFEST}, cycle string, file string"


def slice_columns(path: Column) -> dict[str, Column]:
    """Columns KEYS and kind of rows read from a path; a path without the archive's form of names is an error."""
    part = [F.regexp_extract(path, _NAME, i) for i in range(1, 6)]
    year = F.when(path.rlike(_NAME), part[0]).otherwise(F.raise_error(F.concat(F.lit("no slice in the path "), path)).cast("string"))
    return {"product": F.lower(part[2]), "fiscal_year": year, "agency": part[1], "cycle": part[4], "file": F.md5(path), "kind": part[3]}


def entries(spark: SparkSession, root: str) -> DataFrame:
    """A row for every committed file (schema ENTRY)."""
    path = f"{root}/manifest"
    if not files.folders(spark, path):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).option("recursiveFileLookup", True).json(path)


def live(committed: DataFrame) -> DataFrame:
    """Of entries, those of each slice's newest cycle."""
    newest = F.max("cycle").over(Window.partitionBy("logical_id"))
    return committed.withColumn("_newest", newest).where("cycle = _newest").drop("_newest")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of the live slices: rows and bytes of all their files together."""
    last = F.max("updated_at").alias("updated_at")
    sums = live(entries(spark, root)).groupBy("logical_id", "cycle").agg(F.max("etag").alias("etag"), F.sum("row_count").alias("row_count"), F.sum("parquet_bytes").alias("parquet_bytes"), F.min("parquet_key").alias("parquet_key"), last)
    return sums.select("logical_id", "etag", F.col("cycle").alias("datestamp"), "row_count", "parquet_bytes", "parquet_key", "updated_at")


def stage(rows: DataFrame, root: str) -> None:
    """Write rows (with columns KEYS) of files that are not committed yet; what an earlier try left of them is replaced."""
    new = rows.join(entries(rows.sparkSession, root).select("file"), "file", "left_anti")
    write_slices(new, KEYS, f"{root}/data")


def commit(spark: SparkSession, root: str, listing: DataFrame | None = None) -> int:
    """Commit all staged files that have no entry yet, in one file of entries; how many there were.

    Rows are counted from what was written. listing (logical_id, datestamp, etag): etags of entries, else NULL.
    """
    if not files.folders(spark, f"{root}/data"):
        return 0
    data = partitioned_text(spark, f"{root}/data")
    new = data.join(entries(spark, root).select("file"), "file", "left_anti").groupBy(*KEYS).agg(F.count("*").alias("row_count"))
    new = new.withColumn("logical_id", logical_id(F.col("product"), F.col("fiscal_year"), F.col("agency"))).withColumn("datestamp", F.col("cycle"))
    new = new.join(listing.select("logical_id", "datestamp", "etag"), ["logical_id", "datestamp"], "left") if listing is not None else new.withColumn("etag", F.lit(None).cast("string"))
    size = F.sum("length").alias("parquet_bytes")
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root}/data").select(F.regexp_extract("path", "/file=([^/]+)/", 1).alias("file"), "length").groupBy("file").agg(size)
    key = F.concat("product", F.lit("/fiscal_year="), "fiscal_year", F.lit("/agency="), "agency")
    told = new.join(sizes, "file").select(*[c.cast(t).alias(n) for n, t, c in _entry_columns(key)]).persist()
    try:
        n = told.count()
        if n:
            told.coalesce(1).write.json(f"{root}/manifest/{uuid.uuid4().hex}")
        return n
    finally:
        told.unpersist()


def _entry_columns(key: Column) -> list[tuple[str, str, Column]]:
    own = {"parquet_key": key, "updated_at": F.current_timestamp()}
    return [(n, t, own.get(n, F.col(n))) for n, t in (x.split() for x in ENTRY.split(", "))]


def read_live(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the live slices, with product, fiscal_year, agency and cycle. The live files prune the scan's partitions."""
    data, own = partitioned_text(spark, f"{root}/data"), live(entries(spark, root)).select("file", "cycle")
    return data.join(own, ["file", "cycle"], "left_semi").drop("file")


def replaced(spark: SparkSession, root: str) -> int:
    """Remove folders of committed files that a newer cycle replaced; how many. For when no reader is at an older listing."""
    committed = entries(spark, root)
    gone = committed.join(live(committed).select("file"), "file", "left_anti").select("parquet_key", "cycle", "file").collect()  # a row a file
    for r in gone:
        product, rest = r.parquet_key.split("/", 1)
        files.removed(spark, f"{root}/data/product={product}/{rest}/cycle={r.cycle}/file={r.file}")
    return len(gone)
