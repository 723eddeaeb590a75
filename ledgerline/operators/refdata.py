"""Reference tables: the data dictionary, its codebook, agency names and disaster codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the form of a line that tells a code's label.
CODE_LINE = r"^\s*(\S{1,15})\s*=\s*(\S.*?)\s*\z"


def column_names(headers: DataFrame) -> DataFrame:
    """Names of columns from headers (pos, display): a repeated one gets its spreadsheet letter from the second on."""
    again = F.row_number().over(Window.partitionBy("display").orderBy("pos"))
    letter = F.concat(F.when(F.col("pos") >= 26, F.char(F.lit(64) + F.floor(F.col("pos") / 26).cast("int"))).otherwise(""), F.char(F.lit(65) + F.col("pos") % 26))
    return headers.select("pos", F.when(again == 1, F.col("display")).otherwise(F.concat("display", F.lit(" ("), letter, F.lit(")"))).alias("name"))


def named_rows(rows: DataFrame, names: list[str]) -> DataFrame:
    """Arrays (row) as columns of these names; what a row has beyond them is dropped."""
    return rows.select(*[F.get("row", i).alias(n) for i, n in enumerate(names)])


def applies_to(c: Column) -> Column:
    """Which product a dictionary entry is of: both, Contracts, Assistance or ''."""
    contracts, assistance = c.contains("Contracts"), c.contains("Assistance")
    return F.when(contracts & assistance, "both").when(contracts, "Contracts").when(assistance, "Assistance").otherwise("")


def codebook(dictionary: DataFrame) -> DataFrame:
    """Coded values (column, code, label, applies_to) from lines `code = label` of domain_values, with or without blanks; prose and codes without a label are skipped."""
    name = F.nullif("award_element", F.lit(""))
    if "element" in dictionary.columns:
        name = F.coalesce(name, F.col("element"))
    lines = dictionary.select(name.alias("column"), applies_to(F.coalesce("award_file", F.lit(""))).alias("applies_to"), F.explode(F.split("domain_values", r"\r?\n")).alias("line"))
    rows = lines.where(F.col("line").rlike(CODE_LINE) & ~F.regexp_extract("line", CODE_LINE, 1).contains("="))
    return rows.select("column", F.regexp_extract("line", CODE_LINE, 1).alias("code"), F.regexp_extract("line", CODE_LINE, 2).alias("label"), "applies_to")


def decoded(df: DataFrame, column: str, book: DataFrame, out: str) -> DataFrame:
    """df with the codebook's label of a column; one label a code, the smallest. The codes of one column are few."""
    labels = book.where(F.col("column") == column).groupBy(F.col("code").alias(column)).agg(F.min("label").alias(out))
    return df.join(F.broadcast(labels), column, "left")


def entry(dictionary: DataFrame, element: str) -> DataFrame:
    """The dictionary's entry of a column."""
    return dictionary.where(F.col("award_element") == element)


def first_names(codes: DataFrame) -> DataFrame:
    """One name per trimmed, non-empty agency code, the first in source order: codes (line, code, name)."""
    rows = codes.withColumn("code", F.trim("code")).withColumn("name", F.trim("name")).where("code <> '' AND name <> ''")
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("code").orderBy("line"))).where("_n = 1").select("code", "name")


def agency_names(codes: DataFrame, toptier: DataFrame) -> DataFrame:
    """(code, name): of agency_codes where it has the code, else of the toptier agencies."""
    both = codes.select("code", "name", F.lit(1).alias("_p")).unionByName(toptier.select("code", "name", F.lit(2).alias("_p")))
    best = F.row_number().over(Window.partitionBy("code").orderBy("_p", "name"))
    return both.withColumn("_n", best).where("_n = 1").select("code", "name")


def named(df: DataFrame, code: str, names: DataFrame, out: str) -> DataFrame:
    """df with the agency's name, or its code where it has none."""
    lookup = names.select(F.col("code").alias(code), F.col("name").alias("_name"))
    return df.join(F.broadcast(lookup), code, "left").withColumn(out, F.coalesce("_name", code)).drop("_name")


def disaster_codes(codes: DataFrame) -> DataFrame:
    """Codes of each disaster group, sorted and joined: codes (disaster, code)."""
    return codes.where("disaster IS NOT NULL").groupBy("disaster").agg(F.array_join(F.sort_array(F.collect_set("code")), ", ").alias("codes"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of several tables."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
        out = one if out is None else out.unionByName(one)
    return out
