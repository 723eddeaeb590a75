"""The dashboard cube of a product in one pass: all dimensions, over all agencies and for each of them, and its files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.casting import quoted
from ledgerline.functions.fields import DatasetSpec, obligation, slug
from ledgerline.operators.cubes import BY_AGENCY, TOP, TOP_BY_AGENCY, YEAR, agency_kpis, county_names, dimension, timeseries, trend
from ledgerline.sources.archive import write_cube

# Fixed value: dimensions that are kept whole and too long for the main file, each in a file of its own.
SIDE_FILES = ("county",)
#: Partitions, at least, of what is shuffled to be written; small ones are united by their sizes as they are read.
PARTITIONS = 512
#: What names of counties are made of.
COUNTY = ("prime_award_transaction_recipient_county_fips_code", "recipient_county_name", "recipient_state_code")


def cube_base(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Sums (o, n) by (dim, agency, fy, label) of all breakdown dimensions that df has, of one scan of its rows.

    A row is spread over the dimensions before anything is shuffled; what is shuffled are the sums of each task.
    """
    own = [F.struct(F.lit(k).alias("dim"), dimension(spec, k).cast("string").alias("label")) for k, (c, _) in spec.breakdowns.items() if c in df.columns]
    rows = df.select(F.col("awarding_agency_name").alias("agency"), quoted(YEAR).alias("fy"), obligation(df).alias("_obl"), F.explode(F.array(*own)).alias("x"))
    return rows.select("x.dim", "agency", "fy", "x.label", "_obl").where("label IS NOT NULL").groupBy("dim", "agency", "fy", "label").agg(F.sum("_obl").alias("o"), F.count("*").alias("n"))


def cube(base: DataFrame, spec: DatasetSpec, n: int = TOP, n_agency: int = TOP_BY_AGENCY) -> DataFrame:
    """Ranked labels of a cube_base: (dim, agency, period, label, obligations, transactions, rank).

    Without an agency: each year, and `all` over rows with a year; the n largest, or all labels of dimensions that are kept
    whole. With one, for dimensions of BY_AGENCY: each year and `all` over all its rows; the n_agency largest. Years,
    periods and agencies come from the same sums by grouping sets; the base is read, rows are not.
    """
    return ranked_cube(cube_sums(base), spec, n, n_agency)


def cube_sums(base: DataFrame) -> DataFrame:
    """Sums of a cube_base by its grouping sets: each label's of all agencies and of one, of all years and of one."""
    dated = F.col("_year").isNotNull()
    sets = base.withColumn("_year", F.col("fy")).groupingSets([["dim", "label", "fy"], ["dim", "label"], ["dim", "label", "agency", "fy"], ["dim", "label", "agency"]], "dim", "label", "agency", "fy")
    return sets.agg(
        F.grouping("agency").alias("_every"), F.grouping("fy").alias("_all"), F.sum("o").alias("o"), F.sum("n").alias("n"),
        F.sum(F.when(dated, F.col("o"))).alias("o_dated"), F.coalesce(F.sum(F.when(dated, F.col("n"))), F.lit(0)).alias("n_dated"),
    )


def ranked_cube(sums: DataFrame, spec: DatasetSpec, n: int = TOP, n_agency: int = TOP_BY_AGENCY) -> DataFrame:
    """The cube of its sums (see cube)."""
    whole = [k for k, (_, kept) in spec.breakdowns.items() if kept]
    every = sums.where("_every = 1 AND n_dated > 0 AND (_all = 1 OR fy IS NOT NULL)").withColumns({"o": F.col("o_dated"), "n": F.col("n_dated")})
    each = sums.where("_every = 0 AND agency IS NOT NULL AND (_all = 1 OR fy IS NOT NULL)").where(F.col("dim").isin(*BY_AGENCY))

    def ranked(rows: DataFrame, most: int | None) -> DataFrame:
        rows = rows.select("dim", "agency", F.when(F.col("_all") == 1, "all").otherwise(F.col("fy")).alias("period"), "label", F.round(F.coalesce("o", F.lit(0.0)), 2).alias("obligations"), F.col("n").alias("transactions"))
        order = Window.partitionBy("dim", "agency", "period").orderBy(F.desc_nulls_last("obligations"), F.asc_nulls_last("label"))
        out = rows.withColumn("rank", F.row_number().over(order))
        return out if most is None else out.where(F.col("rank") <= most)

    # top lists apart, as Spark cuts them before their shuffle only where the limit is one number
    return ranked(every.where(~F.col("dim").isin(*whole)), n).unionByName(ranked(every.where(F.col("dim").isin(*whole)), None)).unionByName(ranked(each, n_agency))


@contextmanager
def finely_dealt(spark: SparkSession) -> Iterator[None]:
    """Writes within deal their shuffles to PARTITIONS at least, so that no task sums the labels of a large part of all."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, max(PARTITIONS, int(before or spark.conf.get("spark.sql.shuffle.partitions"))))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored_cube(df: DataFrame, spec: DatasetSpec, folder: str) -> DataFrame:
    """The cube of df, whose base and sums are written to a folder first, by dimension: rows are scanned once whatever is read of it."""
    spark = df.sparkSession
    with finely_dealt(spark):
        cube_base(df, spec).write.mode("overwrite").partitionBy("dim").parquet(f"{folder}/base")
        sums = cube_sums(spark.read.schema("agency string, fy string, label string, o double, n bigint, dim string").parquet(f"{folder}/base"))
        sums.write.mode("overwrite").partitionBy("dim").parquet(f"{folder}/sums")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sums.schema if f.name != "dim")
    return ranked_cube(spark.read.schema(f"{kinds}, dim string").parquet(f"{folder}/sums"), spec)


def write_files(df: DataFrame, spec: DatasetSpec, target: str, scratch: str) -> None:
    """The files of a product's cube as JSON under target.

    dims/dim=: the main dimensions; side/dim=: those of SIDE_FILES, county labels with their names; agency/slug=: each
    agency's dimensions; trend, timeseries and agencies. Agencies are written together, none is a job of its own. The columns
    of df that any file needs are written to scratch first, so that df, which may be a join, is computed once.
    """
    needed = {*[c for c, _ in spec.breakdowns.values()], "awarding_agency_name", "awarding_sub_agency_name", YEAR, "federal_action_obligation", *COUNTY}
    own = df.select(*[quoted(c) for c in df.columns if c in needed])
    own.write.mode("overwrite").parquet(f"{scratch}/rows")
    df = df.sparkSession.read.schema(own.schema).parquet(f"{scratch}/rows")
    rows = stored_cube(df, spec, f"{scratch}/base")
    every, side = rows.where("agency IS NULL").drop("agency"), F.col("dim").isin(*SIDE_FILES)
    write_cube(every.where(~side), f"{target}/dims", ["dim"])
    names = county_names(df).select(F.col("fips").alias("label"), F.col("label").alias("name"))
    write_cube(every.where(side).join(names, "label", "left"), f"{target}/side", ["dim"])
    write_cube(rows.where("agency IS NOT NULL").withColumn("slug", slug(F.col("agency"))), f"{target}/agency", ["slug", "agency", "dim"])
    for name, one in (("trend", trend(df)), ("timeseries", timeseries(df)), ("agencies", agency_kpis(df))):
        one.write.mode("overwrite").json(f"{target}/{name}")
