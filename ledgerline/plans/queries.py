"""One query per operator over the given tables, with the SQL that gives the same rows. Names start with the operator's ID."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions import casting, fields
from ledgerline.functions.fields import ASSISTANCE, CONTRACTS
from ledgerline.operators import cubes, guards, manifest, refdata, summary, table, whole_cube
from ledgerline.operators.table import TableRequest, build_table
from ledgerline.plans.views import oracle, view
from ledgerline.sources import archive, compaction, files, slices
from ledgerline.sources.scratch import scratch
from ledgerline.streaming.refresh import refreshed, stream_refresh

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

OBL = "federal_action_obligation"
UEI = "nullif(trim(recipient_uei), '')"
FIPS = "CASE WHEN regexp_matches(prime_award_transaction_recipient_county_fips_code, '^[0-9]{5}$') AND substr(prime_award_transaction_recipient_county_fips_code, 3, 3) NOT IN ('000', '999') THEN prime_award_transaction_recipient_county_fips_code END"
A, B = ("1996-01-01", "1996-12-31"), ("1997-01-01", "1997-12-31")
IN_A, IN_B = (f"action_date BETWEEN DATE '{x[0]}' AND DATE '{x[1]}'" for x in (A, B))


def query(sql: str | None = None, *views: str):
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*[view(spark, sf_dir, v) for v in views], **({"spark": spark, "sf_dir": sf_dir} if "spark" in f.__code__.co_varnames[: f.__code__.co_argcount] else {}))
        if sql is not None:
            ORACLE_SQL[f.__name__] = oracle(sql, *views)
        return f

    return add


def _base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _written(df: DataFrame, spark: SparkSession) -> DataFrame:
    """df written to a scratch folder and read back: what several parts of a query read is computed once."""
    path = scratch(spark, "once")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- sources and sinks

_CSV_COLUMNS = ["contract_transaction_unique_key", "action_date", OBL, "recipient_name"]


def _written_csv(contracts: DataFrame, spark: SparkSession) -> list[str]:
    """Two sets of CSV files with different headers, quoted line breaks in one."""
    root = scratch(spark, "csv")
    first, second = contracts.where("modification_number <> 'P00002'"), contracts.where("modification_number = 'P00002'")
    archive.write_csv(first.select(*_CSV_COLUMNS), f"{root}/a")
    archive.write_csv(second.select("recipient_uei", *_CSV_COLUMNS[::-1]).withColumn("recipient_name", F.concat("recipient_name", F.lit('\n"x", '), "recipient_uei")), f"{root}/b")
    return [f"{root}/a", f"{root}/b"]


_CSV_SQL = f"""SELECT action_date_fiscal_year AS fy, count(*) AS n_rows, round(sum({OBL}), 2) AS obligations, count(DISTINCT name) AS names, count(uei) AS with_uei FROM (
SELECT *, CASE WHEN modification_number = 'P00002' THEN concat(recipient_name, chr(10), '"x", ', recipient_uei) ELSE recipient_name END AS name,
  CASE WHEN modification_number = 'P00002' THEN recipient_uei END AS uei FROM contracts) GROUP BY 1"""


def _csv_sums(df: DataFrame) -> DataFrame:
    return df.groupBy(fields.fiscal_year(F.col("action_date")).alias("fy")).agg(F.count("*").alias("n_rows"), F.round(F.sum(OBL), 2).alias("obligations"), F.count_distinct("recipient_name").alias("names"), F.count("recipient_uei").alias("with_uei"))


@query(_CSV_SQL, "contracts")
def a01_csv_union_by_name(contracts, spark, sf_dir):
    return _csv_sums(casting.typed(archive.award_csv(spark, _written_csv(contracts, spark))))


@query("""SELECT count(*) AS n_rows, count(d) AS dates, count(x) AS numbers, round(sum(x), 2) AS total, CAST(min(d) AS DATE) AS first, max(d) AS last FROM (
SELECT TRY_CAST(CASE WHEN k = 0 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) WHEN k = 2 THEN '2024-02-30' WHEN k = 3 THEN ' 2024-1-5 ' WHEN k = 4 THEN '' ELSE NULL END AS DATE) AS d,
  TRY_CAST(CASE WHEN k = 0 THEN CAST(l_quantity AS VARCHAR) WHEN k = 1 THEN '1,000' WHEN k = 2 THEN '$5' WHEN k = 3 THEN '1e2' WHEN k = 4 THEN ' .5 ' END AS DOUBLE) AS x
FROM (SELECT *, l_orderkey % 5 AS k FROM lineitem))""")
def a02_typed_projection(spark, sf_dir):
    rows = _base(spark, sf_dir, "lineitem").withColumn("k", F.expr("l_orderkey % 5"))
    raw = rows.select(
        F.expr("CASE WHEN k = 0 THEN CAST(CAST(l_shipdate AS DATE) AS STRING) WHEN k = 1 THEN '2024' WHEN k = 2 THEN '2024-02-30' WHEN k = 3 THEN ' 2024-1-5 ' WHEN k = 4 THEN '' END").alias("action_date"),
        F.expr("CASE WHEN k = 0 THEN CAST(l_quantity AS STRING) WHEN k = 1 THEN '1,000' WHEN k = 2 THEN '$5' WHEN k = 3 THEN '1e2' WHEN k = 4 THEN ' .5 ' END").alias("total_dollars_obligated"),
    )
    x = F.col("total_dollars_obligated")
    return casting.typed(raw).agg(F.count("*").alias("n_rows"), F.count("action_date").alias("dates"), F.count(x).alias("numbers"), F.round(F.sum(x), 2).alias("total"), F.min("action_date").alias("first"), F.max("action_date").alias("last"))


@query(_CSV_SQL, "contracts")
def a03_csv_to_parquet(contracts, spark, sf_dir):
    target = scratch(spark, "parquet")
    archive.csv_to_parquet(spark, _written_csv(contracts, spark), target)
    return _csv_sums(spark.read.parquet(target))


_RAW = "SELECT action_date_fiscal_year AS fiscal_year, lpad(CAST(length(awarding_agency_name) AS VARCHAR), 3, '0') AS agency, * FROM contracts"


def _also_all(rows: DataFrame, before: str) -> DataFrame:
    """rows, and those of years before one again as agency All, in one pass."""
    both = F.when(F.col("fiscal_year") < before, F.array("agency", F.lit("All"))).otherwise(F.array("agency"))
    return rows.select(*[c for c in rows.columns if c != "agency"], F.explode(both).alias("agency"))


def _raw_layer(contracts: DataFrame, spark: SparkSession, with_all: bool = False) -> str:
    """A raw layer with agency codes from the agency's name; with_all: a second copy as All of years before 1996."""
    root = scratch(spark, "raw")
    rows = contracts.withColumns({"fiscal_year": F.col("action_date_fiscal_year"), "agency": F.lpad(F.length("awarding_agency_name").cast("string"), 3, "0")})
    archive.write_raw(_also_all(rows, "1996") if with_all else rows, root)
    return root


@query(f"SELECT fiscal_year, agency, count(*) AS n_rows, round(sum({OBL}), 2) AS obligations FROM ({_RAW}) GROUP BY ALL", "contracts")
def a04_hive_raw_layer(contracts, spark, sf_dir):
    root = _raw_layer(contracts, spark)
    rows = archive.read_raw(spark, root)
    archive.write_raw(rows.where("fiscal_year = '1995'"), scratch(spark, "other"))
    return rows.groupBy("fiscal_year", "agency").agg(F.count("*").alias("n_rows"), F.round(F.sum(OBL), 2).alias("obligations"))


@query(f"SELECT agency, count(*) AS n_rows FROM ({_RAW}) WHERE fiscal_year = '1995' GROUP BY ALL", "contracts")
def a05_raw_scan_of_a_year(contracts, spark, sf_dir):
    return archive.read_raw(spark, _raw_layer(contracts, spark), fiscal_year="1995").groupBy("agency").agg(F.count("*").alias("n_rows"))


def _serve(contracts: DataFrame, spark: SparkSession, sort: str | None = None) -> DataFrame:
    root = scratch(spark, "serve")
    archive.write_serve(contracts.withColumn("fiscal_year", F.col("action_date_fiscal_year")), f"{root}/contracts", sort)
    return archive.read_serve(spark, root, "contracts")


_YEARS = f"SELECT action_date_fiscal_year AS fiscal_year, count(*) AS n_rows, round(sum({OBL}), 2) AS obligations FROM contracts GROUP BY 1"


def _years(df: DataFrame) -> DataFrame:
    return df.groupBy("fiscal_year").agg(F.count("*").alias("n_rows"), F.round(F.sum(OBL), 2).alias("obligations"))


@query(_YEARS, "contracts")
def a06_serve_scan(contracts, spark, sf_dir):
    return _years(_serve(contracts, spark))


@query("""SELECT logical_id, row_count FROM (SELECT *, max(CASE WHEN split_part(logical_id, '/', 3) = 'All' THEN 1 ELSE 0 END) OVER (PARTITION BY split_part(logical_id, '/', 1), split_part(logical_id, '/', 2)) AS a FROM manifest)
WHERE (split_part(logical_id, '/', 3) = 'All') = (a = 1)""", "manifest")
def a07_slice_choice(manifest_):
    return manifest.slices(manifest_).select("logical_id", "row_count")


@query(_YEARS, "contracts")
def a07b_prefer_all_reader(contracts, spark, sf_dir):
    return _years(archive.read_raw(spark, _raw_layer(contracts, spark, with_all=True), "prefer_all"))


@query(_YEARS, "contracts")
def a08_serve_write(contracts, spark, sf_dir):
    return _years(_serve(contracts, spark))


@query(_YEARS, "contracts")
def a09_sorted_compaction(contracts, spark, sf_dir):
    return _years(_serve(contracts, spark, "recipient_name"))


@query("SELECT action_date_fiscal_year AS fiscal_year, count(*) AS n_rows, true AS some_files, 0 AS out_of_order FROM contracts GROUP BY 1", "contracts")
def a09b_sorted_ranges(contracts, spark, sf_dir):
    """Files of a sorted year hold ranges of names that do not overlap but at their ends, so a scan for a name skips the others."""
    rows = _serve(contracts, spark, "recipient_name").select("fiscal_year", "recipient_name", F.col("_metadata.file_path").alias("file"))
    ranges = rows.groupBy("fiscal_year", "file").agg(F.count("*").alias("n"), F.min("recipient_name").alias("lo"), F.max("recipient_name").alias("hi"))
    before = F.lag("hi").over(Window.partitionBy("fiscal_year").orderBy("lo", "hi"))
    return ranges.withColumn("_before", before).groupBy("fiscal_year").agg(F.sum("n").alias("n_rows"), (F.count("*") > 0).alias("some_files"), F.count(F.when(F.col("_before") > F.col("lo"), 1)).cast("int").alias("out_of_order"))


@query("""SELECT o_orderpriority AS priority, count(*) AS n_rows, count(DISTINCT o_orderkey) AS orders, round(sum(o_totalprice), 2) AS total, count(DISTINCT length(o_comment)) AS lengths, count(CASE WHEN o_orderkey % 2 = 1 THEN 1 END) AS odd
FROM (SELECT *, concat('"', o_clerk, '",', chr(10), o_orderkey) AS o_comment FROM (SELECT *, o_orderpriority AS o_clerk FROM orders)) GROUP BY 1""")
def a10_zip_landing(spark, sf_dir):
    """ZIP archives of the orders, made in tasks, two members each with other headers and quoted line breaks: inflated in
    pieces by the tasks, landed as files and read by column names."""
    root = scratch(spark, "zips")

    def pack(batches):
        import csv
        import io
        import zipfile

        import pyarrow as pa

        for batch in batches:
            rows, data = batch.to_pylist(), io.BytesIO()
            with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
                for odd, names in ((0, ["key", "priority", "price", "comment"]), (1, ["odd", "comment", "price", "priority", "key"])):
                    out = io.StringIO()
                    writer = csv.DictWriter(out, names, extrasaction="ignore", lineterminator="\n")
                    writer.writeheader()
                    writer.writerows(r | {"odd": 1, "comment": f'"{r["priority"]}",\n{r["key"]}'} for r in rows if r["key"] % 2 == odd)
                    z.writestr(f"deep/part_{odd + 1}.CSV", out.getvalue())
                z.writestr("readme.txt", "none")
            yield pa.RecordBatch.from_pydict({"path": [f"in/FY2024_{rows[0]['key']}_Contracts_Full_20261006.zip"], "content": [data.getvalue()]})

    orders = _base(spark, sf_dir, "orders").selectExpr("o_orderkey key", "o_orderpriority priority", "o_totalprice price")
    orders.mapInArrow(pack, "path string, content binary").write.parquet(f"{root}/zips")
    folders = archive.landed(spark.read.parquet(f"{root}/zips"), f"{root}/csv", 10_000)
    rows = archive.award_csv(spark, folders)
    return rows.groupBy("priority").agg(F.count("*").alias("n_rows"), F.count_distinct("key").alias("orders"), F.round(F.sum(F.col("price").cast("double")), 2).alias("total"), F.count_distinct(F.length("comment")).alias("lengths"), F.count("odd").alias("odd"))


_PARSED = """SELECT key, size, etag, regexp_extract(key, '^FY(\\d{4}|All)_([^_]+)_(Contracts|Assistance)_(Full|Delta)_(\\d{8})', 1) AS fiscal_year,
  regexp_extract(key, '^FY(\\d{4}|All)_([^_]+)_(Contracts|Assistance)_(Full|Delta)_(\\d{8})', 2) AS agency_code,
  regexp_extract(key, '^FY(\\d{4}|All)_([^_]+)_(Contracts|Assistance)_(Full|Delta)_(\\d{8})', 3) AS award_type,
  regexp_extract(key, '^FY(\\d{4}|All)_([^_]+)_(Contracts|Assistance)_(Full|Delta)_(\\d{8})', 4) AS kind,
  regexp_extract(key, '^FY(\\d{4}|All)_([^_]+)_(Contracts|Assistance)_(Full|Delta)_(\\d{8})', 5) AS datestamp FROM listing"""
_FILES = f"SELECT *, lower(award_type) || '/' || fiscal_year || '/' || agency_code AS logical_id FROM ({_PARSED})"


@query(_FILES, "listing")
def a11_archive_listing(listing):
    quoted = listing.withColumn("etag", F.concat(F.lit('"'), "etag", F.lit('"')))
    other = quoted.limit(1).select(F.lit("readme.txt").alias("key"), "size", "etag")
    return manifest.parse_listing(quoted.unionByName(other))


@query("SELECT count(*) AS n_rows, min(action_date) AS min_date, max(action_date) AS max_date, 29 AS n_columns FROM contracts", "contracts")
def a12_file_summary(contracts, spark, sf_dir):
    target = scratch(spark, "summary")
    contracts.write.parquet(target)
    return archive.file_summary(spark, target)


@query("SELECT action_date_fiscal_year AS fiscal_year, count(*) AS n_rows, min(action_date) AS min_date, max(action_date) AS max_date, 2 AS n_columns FROM contracts GROUP BY 1", "contracts")
def a12b_summary_without_statistics(contracts, spark, sf_dir):
    """Files whose writer left no statistics: the date column is scanned."""
    target = scratch(spark, "summary")
    rows = contracts.select("action_date", F.col("action_date_fiscal_year").alias("fiscal_year"))
    rows.write.option("parquet.column.statistics.enabled", "false").partitionBy("fiscal_year").parquet(target)
    return archive.file_summary(spark, target, ["fiscal_year"])


@query("SELECT n_regionkey AS region, '[' || string_agg('\"' || n_name || '\"', ',' ORDER BY n_name) || ']' AS nations FROM nation GROUP BY 1")
def a13_flat_snapshot(spark, sf_dir):
    target = scratch(spark, "snapshot")
    archive.snapshot(_base(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(F.sort_array(F.collect_list("n_name")).alias("nations")), target)
    return spark.read.parquet(target)


@query(f"""SELECT slug, period, label, obligations FROM (SELECT *, row_number() OVER (PARTITION BY slug, period ORDER BY obligations DESC NULLS LAST, label) AS r FROM (
SELECT trim(regexp_replace(lower(awarding_agency_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, period, recipient_state_code AS label, round(coalesce(sum({OBL}), 0), 2) AS obligations
FROM (SELECT *, unnest([action_date_fiscal_year, 'all']) AS period FROM contracts) WHERE recipient_state_code IS NOT NULL GROUP BY ALL)) WHERE r <= 15""", "contracts")
def a14_cube_sink(contracts, spark, sf_dir):
    target = scratch(spark, "cube")
    rows = cubes.agency_breakdown(contracts, CONTRACTS, "state").withColumn("slug", fields.slug(F.col("agency"))).drop("agency")
    archive.write_cube(rows, target, "slug")
    schema = "period string, rows array<struct<rank: int, label: string, obligations: double, transactions: bigint>>, slug string"
    return spark.read.schema(schema).json(target).select("slug", "period", F.explode("rows").alias("x")).select("slug", "period", "x.label", "x.obligations")


@query("SELECT contract_transaction_unique_key AS key, recipient_name AS name, nullif(recipient_zip_4_code, '') AS zip FROM contracts", "contracts")
def a15_csv_export(contracts, spark, sf_dir):
    target = scratch(spark, "export")
    archive.write_csv(contracts.selectExpr("contract_transaction_unique_key key", """concat(recipient_name, ' "q", ', chr(10)) name""", "recipient_zip_4_code zip"), target)
    rows = spark.read.options(header=True, multiLine=True, escape='"').csv(target)
    return rows.select("key", F.substring_index("name", ' "q"', 1).alias("name"), "zip")


@query("SELECT logical_id, etag, row_count FROM manifest", "manifest")
def a16_manifest_io(manifest_, spark, sf_dir):
    path = scratch(spark, "manifest")
    archive.save_manifest(archive.load_manifest(spark, path).unionByName(manifest_, allowMissingColumns=True), path)
    return archive.latest_entries(archive.load_manifest(spark, path)).select("logical_id", "etag", "row_count")


@query("SELECT DISTINCT fiscal_year, agency FROM (SELECT action_date_fiscal_year AS fiscal_year, lpad(CAST(length(awarding_agency_name) AS VARCHAR), 3, '0') AS agency FROM contracts)", "contracts")
def a17_file_inventory(contracts, spark, sf_dir):
    files = archive.tree(spark, _raw_layer(contracts, spark)).where("path LIKE '%.parquet' AND bytes > 0")
    return files.select(F.regexp_extract("path", "^fiscal_year=([^/]+)/", 1).alias("fiscal_year"), F.regexp_extract("path", "agency=([^/]+)/", 1).alias("agency")).distinct()


# --- projections and filters


@query(f"SELECT product_or_service_code AS psc, recipient_parent_name AS parent, transaction_number AS raw, round(sum({OBL}), 2) AS obligations FROM contracts GROUP BY ALL", "contracts")
def b01_field_resolution(contracts):
    keys = {"psc": "psc_code", "parent": "recipient_parent", "raw": "transaction_number"}
    assert fields.resolve(contracts, 'x"; --') is None
    return contracts.groupBy(*[fields.resolve(contracts, f).alias(n) for n, f in keys.items()]).agg(F.round(F.sum(OBL), 2).alias("obligations"))


_DIM_COLUMNS = {k: c for k, c in fields.DIMENSIONS.items() if k != "month"}


@query("SELECT " + ", ".join(f"count(DISTINCT {c}) AS {k}" for k, c in _DIM_COLUMNS.items()) + ", count(DISTINCT strftime(action_date, '%Y-%m')) AS month FROM contracts", "contracts")
def b02_dimensions(contracts):
    each = [F.explode(F.array(*[F.struct(F.lit(k).alias("k"), fields.resolve(contracts, k).alias("v")) for k in fields.DIMENSIONS])).alias("x")]
    distinct = contracts.select(*each).select("x.*").distinct().groupBy().pivot("k", list(fields.DIMENSIONS)).agg(F.count("v"))
    return distinct


@query("SELECT product_or_service_code AS psc_code, naics_code, count(*) AS n FROM contracts GROUP BY ALL", "contracts")
def b03_aliases(contracts):
    return contracts.groupBy(*[fields.resolve(contracts, a).alias(a) for a in ("psc_code", "naics_code")]).agg(F.count("*").alias("n"))


def _filtered(contracts: DataFrame, **wanted: str) -> DataFrame:
    for c in fields.filters(contracts, wanted):
        contracts = contracts.where(c)
    return contracts.groupBy("recipient_state_code").agg(F.count("*").alias("n"), F.round(F.sum(OBL), 2).alias("obligations"))


_BY_STATE = f"SELECT recipient_state_code, count(*) AS n, round(sum({OBL}), 2) AS obligations FROM contracts"


@query(f"{_BY_STATE} WHERE recipient_state_code IN ('NATION_6', 'NATION_12') AND action_date_fiscal_year IN ('1995') GROUP BY 1", "contracts")
def b04_in_filter(contracts):
    return _filtered(contracts, state="NATION_6||NATION_12", fiscal_year="1995|", extent_competed="|")


@query(f"{_BY_STATE} WHERE {OBL} >= 1000 AND {OBL} <= 20000 AND TRY_CAST(naics_code AS DOUBLE) <= 20 GROUP BY 1", "contracts")
def b05_range_filter(contracts):
    return _filtered(contracts, federal_action_obligation_min="1000", federal_action_obligation_max="2e4", naics_max="20")


@query(f"{_BY_STATE} WHERE extent_competed IN ('A') GROUP BY 1", "contracts")
def b06_unsafe_filters_dropped(contracts):
    return _filtered(contracts, **{'x" OR 1=1 --': "1", "No Such": "2", "not_there": "3", "extent_competed": "A"})


@query(f"SELECT {IN_A} AS in_a, count(*) AS n FROM contracts GROUP BY 1", "contracts")
def b07_period_mask(contracts):
    return contracts.groupBy(fields.period_mask(contracts, A).alias("in_a")).agg(F.count("*").alias("n"))


@query(f"SELECT sum(CASE WHEN last_modified_date BETWEEN DATE '{A[0]}' AND DATE '{A[1]}' THEN 1 ELSE 0 END) AS modified, sum(CASE WHEN {IN_A} THEN 1 ELSE 0 END) AS unknown_field FROM contracts", "contracts")
def b08_date_field(contracts):
    return contracts.agg(*[F.sum(F.when(fields.period_mask(contracts, A, f), 1).otherwise(0)).alias(n) for n, f in (("modified", "last_modified_date"), ("unknown_field", "no_such_date"))])


@query(f"SELECT extent_competed AS g0, sum(CASE WHEN {IN_A} THEN 1 ELSE 0 END) AS transactions_a, sum(CASE WHEN {IN_B} THEN 1 ELSE 0 END) AS transactions_b FROM contracts WHERE {IN_A} OR {IN_B} GROUP BY 1", "contracts")
def b09_period_predicate(contracts):
    return build_table(contracts, TableRequest(rows=("extent_competed",), metrics=("transactions",), period_a=A, period_b=B)).select("g0", "transactions_a", "transactions_b")


@query(f"SELECT count({OBL}) AS amounts, round(sum({OBL}), 2) AS total FROM contracts", "contracts")
def b10_amount(contracts):
    text = contracts.select(F.col(OBL).cast("decimal(20, 2)").cast("string").alias(OBL))
    x = fields.obligation(text)
    return text.agg(F.count(x).alias("amounts"), F.round(F.sum(x), 2).alias("total"))


@query(f"SELECT {UEI} AS vendor, count(*) AS n FROM contracts GROUP BY 1", "contracts")
def b11_vendor_id(contracts):
    return contracts.groupBy(fields.vendor().alias("vendor")).agg(F.count("*").alias("n"))


@query("SELECT strftime(action_date, '%Y-%m') AS month, count(*) AS n FROM contracts GROUP BY 1", "contracts")
def b12_month(contracts):
    return contracts.groupBy(fields.month(contracts).alias("month")).agg(F.count("*").alias("n"))


@query("SELECT nullif(substr(recipient_zip_4_code, 1, 5), '') AS zip, count(*) AS n FROM contracts GROUP BY 1", "contracts")
def b13_zip5(contracts):
    return contracts.groupBy(fields.zip5(F.col("recipient_zip_4_code")).alias("zip")).agg(F.count("*").alias("n"))


@query(f"SELECT {FIPS} AS fips, count(*) AS n FROM contracts GROUP BY 1", "contracts")
def b14_county_fips(contracts):
    return contracts.groupBy(fields.county_fips(F.col("prime_award_transaction_recipient_county_fips_code")).alias("fips")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT product_or_service_code_description AS name, coalesce(nullif(trim(regexp_replace(lower(concat('--', product_or_service_code_description, ' & Co.')), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') AS slug FROM contracts", "contracts")
def b15_slug(contracts):
    name = F.col("product_or_service_code_description")
    return contracts.select(name.alias("name"), fields.slug(F.concat(F.lit("--"), name, F.lit(" & Co."))).alias("slug")).distinct()


@query("""SELECT county, state, list_aggregate(list_transform(regexp_extract_all(county, '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', '') || CASE WHEN state <> '' THEN ', ' || state ELSE '' END AS label
FROM (SELECT concat(upper(s_name), ' O''BRIEN-', s_nationkey) AS county, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'TX' END AS state FROM supplier)""")
def b16_county_labels(spark, sf_dir):
    rows = _base(spark, sf_dir, "supplier").selectExpr("concat(upper(s_name), \" O'BRIEN-\", s_nationkey) c", "if(s_suppkey % 3 = 0, '', 'TX') s")
    return rows.select(F.col("c").alias("county"), F.col("s").alias("state"), fields.county_label(F.col("c"), F.col("s")).alias("label"))


@query(f"SELECT coalesce(nullif(awarding_agency_name, ''), '(unknown)') AS agency, coalesce(nullif(CASE WHEN recipient_state_code = 'NATION_6' THEN '' ELSE recipient_state_code END, ''), '(unknown)') AS state, round(coalesce(sum({OBL}), 0), 2) AS obligations FROM contracts GROUP BY ALL", "contracts")
def b17_unknown_labels(contracts):
    state = F.when(F.col("recipient_state_code") == "NATION_6", "").otherwise(F.col("recipient_state_code"))
    return contracts.groupBy(fields.or_unknown(F.col("awarding_agency_name")).alias("agency"), fields.or_unknown(state).alias("state")).agg(F.round(F.coalesce(F.sum(OBL), F.lit(0.0)), 2).alias("obligations"))


@query("SELECT DISTINCT CASE WHEN naics_description IS NOT NULL AND naics_description <> '' AND naics_code <> '000007' THEN naics_description || ' (' || naics_code || ')' ELSE naics_code END AS label FROM contracts", "contracts")
def b18_option_label(contracts):
    label = F.when(F.col("naics_code") != "000007", F.col("naics_description"))
    return contracts.select(fields.option_label(F.col("naics_code"), label).alias("label")).distinct()


@query("SELECT logical_id, split_part(logical_id, '/', 1) AS product, split_part(logical_id, '/', 2) AS fiscal_year, split_part(logical_id, '/', 3) AS agency, logical_id AS again FROM manifest", "manifest")
def b19_logical_id(manifest_):
    parts = manifest_.select("logical_id", *fields.id_parts(F.col("logical_id")))
    return parts.withColumn("again", fields.logical_id(F.upper("product"), F.col("fiscal_year"), F.col("agency")))


@query("SELECT pos, CASE WHEN again = 1 THEN display ELSE display || ' (' || chr(65 + pos) || ')' END AS name FROM (SELECT CAST(n_nationkey AS INT) AS pos, concat('Region ', n_regionkey) AS display, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS again FROM nation)")
def b20_duplicate_headers(spark, sf_dir):
    headers = _base(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("pos"), F.concat(F.lit("Region "), "n_regionkey").alias("display"))
    return refdata.column_names(headers)


@query("SELECT n_name AS a, CAST(n_nationkey AS VARCHAR) AS b FROM nation")
def b21_arrays_to_columns(spark, sf_dir):
    rows = _base(spark, sf_dir, "nation").select(F.array("n_name", F.col("n_nationkey").cast("string"), F.lit(None)).alias("row"))
    return refdata.named_rows(rows, ["a", "b"])


_BOOK = """SELECT award_element AS "column", trim(regexp_extract(line, '^\\s*(\\S{1,15})\\s*=\\s*(\\S.*?)\\s*$', 1)) AS code, trim(regexp_extract(line, '^\\s*(\\S{1,15})\\s*=\\s*(\\S.*?)\\s*$', 2)) AS label,
  CASE WHEN award_file LIKE '%Contracts%' AND award_file LIKE '%Assistance%' THEN 'both' WHEN award_file LIKE '%Contracts%' THEN 'Contracts' WHEN award_file LIKE '%Assistance%' THEN 'Assistance' ELSE '' END AS applies_to
FROM (SELECT *, unnest(string_split(domain_values, chr(10))) AS line FROM dictionary) WHERE regexp_matches(line, '^\\s*(\\S{1,15})\\s*=\\s*(\\S.*?)\\s*$') AND NOT contains(regexp_extract(line, '^\\s*(\\S{1,15})\\s*=\\s*(\\S.*?)\\s*$', 1), '=')"""


@query(_BOOK, "dictionary")
def b22_codebook(dictionary):
    return refdata.codebook(dictionary)


@query("SELECT applies_to, count(*) AS n FROM (SELECT CASE WHEN award_file LIKE '%Contracts%' AND award_file LIKE '%Assistance%' THEN 'both' WHEN award_file LIKE '%Contracts%' THEN 'Contracts' WHEN award_file LIKE '%Assistance%' THEN 'Assistance' ELSE '' END AS applies_to FROM dictionary) GROUP BY 1", "dictionary")
def b23_applies_to(dictionary):
    return dictionary.groupBy(refdata.applies_to(F.col("award_file")).alias("applies_to")).agg(F.count("*").alias("n"))


_AB = f"SELECT recipient_state_code AS g, round(sum(CASE WHEN {IN_A} THEN {OBL} END), 2) AS a, round(sum(CASE WHEN {IN_B} THEN {OBL} END), 2) AS b FROM contracts GROUP BY 1"


@query(f"SELECT g, round(b - a, 2) AS delta, CASE WHEN a <> 0 THEN round((b - a) / a * 100, 1) + 0.0 END AS pct FROM ({_AB})", "contracts")
def b24_change(contracts):
    sums = [F.round(F.sum(F.when(fields.period_mask(contracts, p), F.col(OBL))), 2).alias(n) for p, n in ((A, "a"), (B, "b"))]
    delta, pct = fields.change(F.col("a"), F.col("b"))
    return contracts.groupBy(F.col("recipient_state_code").alias("g")).agg(*sums).select("g", F.round(delta, 2).alias("delta"), pct.alias("pct"))


@query("SELECT l_linenumber AS line, count(CASE WHEN l_orderkey % 3 <> 0 THEN 1 END) AS numbers, count(*) AS n FROM lineitem GROUP BY 1")
def b25_nan_to_null(spark, sf_dir):
    x = F.when(F.expr("l_orderkey % 3 = 0"), F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    return _base(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("line")).agg(F.count(fields.nan_to_null(x)).alias("numbers"), F.count("*").alias("n"))


@query(f"SELECT {', '.join(CONTRACTS.detail)} FROM contracts", "contracts")
def b26_detail_columns(contracts):
    return contracts.select(*CONTRACTS.detail)


@query("SELECT column_name AS field, replace(column_name, '_', ' ') AS label FROM (SELECT unnest(json_keys(to_json(c))) AS column_name FROM (SELECT contracts AS c FROM contracts LIMIT 1))", "contracts")
def b27_field_list(contracts):
    return table.fields(contracts.withColumns({"fiscal_year": F.lit("1"), "agency": F.lit("2")}))


@query("SELECT CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS VARCHAR) AS fy, count(*) AS n FROM orders GROUP BY 1")
def b28_fiscal_year(spark, sf_dir):
    return _base(spark, sf_dir, "orders").groupBy(fields.fiscal_year(F.col("o_orderdate")).alias("fy")).agg(F.count("*").alias("n"))


_STATES = ", ".join(f"('{c}', '{n}')" for c, n in fields.STATE_NAMES.items())


@query(f"SELECT code, coalesce(name, code) AS state, count(*) AS n FROM (SELECT substr(p_name, 1, 1) || substr(p_brand, length(p_brand), 1) AS x, CASE WHEN p_partkey % 2 = 0 THEN 'TX' WHEN p_partkey % 3 = 0 THEN 'VI' ELSE 'ZZ' END AS code FROM part) LEFT JOIN (VALUES {_STATES}) s(c, name) ON code = c GROUP BY ALL")
def b29_state_names(spark, sf_dir):
    parts = _base(spark, sf_dir, "part").select(F.expr("CASE WHEN p_partkey % 2 = 0 THEN 'TX' WHEN p_partkey % 3 = 0 THEN 'VI' ELSE 'ZZ' END code"))
    return fields.with_state_name(parts, "code", "state").groupBy("code", "state").agg(F.count("*").alias("n"))


@query("SELECT CAST(n_regionkey AS VARCHAR) AS disaster, string_agg(code, ', ' ORDER BY code) AS codes FROM (SELECT DISTINCT n_regionkey, substr(n_name, 1, 2) AS code FROM nation) GROUP BY 1")
def b30_disaster_codes(spark, sf_dir):
    return refdata.disaster_codes(_base(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("disaster"), F.substring("n_name", 1, 2).alias("code")))


@query("SELECT * EXCLUDE (recipient_zip_4_code, transaction_number) FROM contracts", "contracts")
def b31_drop_helpers(contracts):
    return contracts.drop("recipient_zip_4_code", "transaction_number")


@query("SELECT DISTINCT naics_description AS label FROM contracts WHERE contains(lower(naics_description), 'omo') ORDER BY 1 LIMIT 200", "contracts")
def b32_typeahead(contracts):
    return cubes.search(contracts.select(F.col("naics_description").alias("label")).distinct(), "label", "OMO")


@query("SELECT award_element, award_file, domain_values FROM dictionary WHERE award_element = 'column_7'", "dictionary")
def b33_dictionary_entry(dictionary):
    return refdata.entry(dictionary, "column_7")


# --- aggregations


@query(f"SELECT awarding_agency_name AS g0, round(sum({OBL}), 2) AS obligations_a FROM contracts GROUP BY 1", "contracts")
def c01_obligations(contracts):
    return build_table(contracts, TableRequest(rows=("awarding_agency",), round_to=2))


@query(f"SELECT recipient_state_code AS g0, sum(CASE WHEN {IN_A} THEN 1 ELSE 0 END) AS transactions_a FROM contracts WHERE {IN_A} GROUP BY 1", "contracts")
def c02_transactions(contracts):
    return build_table(contracts, TableRequest(rows=("state",), metrics=("transactions",), period_a=A))


@query(f"SELECT funding_sub_agency_name AS g0, count(DISTINCT {UEI}) AS vendors_a FROM contracts GROUP BY 1", "contracts")
def c03_vendors(contracts):
    return build_table(contracts, TableRequest(metrics=("vendors",)))


@query(f"SELECT g0, CAST(sum(CASE WHEN round(net, 2) <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS vendors_nonzero_net_a FROM (SELECT recipient_state_code AS g0, {UEI} AS u, sum(CASE WHEN {IN_A} THEN {OBL} END) AS net FROM contracts WHERE {IN_A} GROUP BY ALL) WHERE u IS NOT NULL GROUP BY 1", "contracts")
def c04_vendors_nonzero_net(contracts):
    return build_table(contracts, TableRequest(rows=("state",), metrics=("vendors_nonzero_net",), period_a=A))


@query(f"SELECT awarding_agency_name AS g0, recipient_state_code AS g1, round(sum({OBL}), 2) AS obligations_a FROM contracts WHERE extent_competed IN ('A', 'N') GROUP BY ALL ORDER BY 3 DESC NULLS LAST, 1 NULLS LAST, 2 NULLS LAST LIMIT 40", "contracts")
def c05_table_one_metric(contracts):
    return build_table(contracts, TableRequest(rows=("awarding_agency", "state"), filters={"extent_competed": "A|N"}, top=40, round_to=2))


_MULTI = f"""SELECT g0, g1, round(sum(obl), 2) AS obligations_a, CAST(sum(n) AS BIGINT) AS transactions_a, count(u) AS vendors_a, CASE WHEN count(u) > 0 THEN CAST(sum(CASE WHEN u IS NOT NULL AND round(obl, 2) <> 0 THEN 1 ELSE 0 END) AS BIGINT) END AS vendors_nonzero_net_a
FROM (SELECT awarding_sub_agency_name AS g0, recipient_state_code AS g1, {UEI} AS u, sum({OBL}) AS obl, count(*) AS n FROM contracts GROUP BY ALL) GROUP BY ALL"""


@query(f"{_MULTI} ORDER BY 3 DESC NULLS LAST, 1 NULLS LAST, 2 NULLS LAST LIMIT 500", "contracts")
def c06_table_many_metrics(contracts):
    return build_table(contracts, TableRequest(rows=("awarding_subagency", "state"), metrics=table.METRICS, top=500, round_to=2))


@query(f"""SELECT *, round(obligations_b - obligations_a, 2) AS obligations_delta, CASE WHEN obligations_a <> 0 THEN round((obligations_b - obligations_a) / obligations_a * 100, 1) + 0.0 END AS obligations_pct,
  transactions_b - transactions_a AS transactions_delta, CASE WHEN transactions_a <> 0 THEN round((transactions_b - transactions_a) / transactions_a * 100, 1) + 0.0 END AS transactions_pct,
  vendors_b - vendors_a AS vendors_delta, CASE WHEN vendors_a <> 0 THEN round((vendors_b - vendors_a) / vendors_a * 100, 1) + 0.0 END AS vendors_pct
FROM (SELECT recipient_state_code AS g0, round(sum(CASE WHEN {IN_A} THEN {OBL} END), 2) AS obligations_a, round(sum(CASE WHEN {IN_B} THEN {OBL} END), 2) AS obligations_b,
  CAST(sum(CASE WHEN {IN_A} THEN 1 ELSE 0 END) AS BIGINT) AS transactions_a, CAST(sum(CASE WHEN {IN_B} THEN 1 ELSE 0 END) AS BIGINT) AS transactions_b,
  count(DISTINCT CASE WHEN {IN_A} THEN {UEI} END) AS vendors_a, count(DISTINCT CASE WHEN {IN_B} THEN {UEI} END) AS vendors_b FROM contracts WHERE {IN_A} OR {IN_B} GROUP BY 1)""", "contracts")
def c07_two_periods(contracts):
    return build_table(contracts, TableRequest(rows=("state",), metrics=table.METRICS[:3], period_a=A, period_b=B, round_to=2))


_FY = "action_date_fiscal_year"


@query(f"SELECT coalesce(fy, 'all') AS period, obligations, transactions FROM (SELECT {_FY} AS fy, grouping({_FY}) AS g, round(coalesce(sum({OBL}), 0), 2) AS obligations, count(*) AS transactions FROM contracts GROUP BY ROLLUP ({_FY})) WHERE g = 1 OR fy IS NOT NULL", "contracts")
def c08_trend_and_kpis(contracts):
    return cubes.trend(contracts)


_CUBE = f"SELECT {_FY} AS fy, coalesce(nullif(awarding_agency_name, ''), '(unknown)') AS agency, coalesce(nullif(awarding_sub_agency_name, ''), '(unknown)') AS subagency, round(coalesce(sum({OBL}), 0), 2) AS obligations, count(*) AS transactions FROM contracts WHERE {_FY} IS NOT NULL GROUP BY ALL"


@query(_CUBE, "contracts")
def c09_timeseries_cube(contracts):
    return cubes.timeseries(contracts)


@query(_CUBE.replace("contracts", "assistance"), "assistance")
def c09b_timeseries_cube_assistance(assistance):
    return cubes.timeseries(assistance)


def _ranked_sql(label: str, n: int | None, agency: bool = False, source: str = "contracts") -> str:
    a = "awarding_agency_name AS agency, " if agency else ""
    k = "agency, " if agency else ""
    null = "WHERE agency IS NOT NULL" if agency else "WHERE fy IS NOT NULL"
    limit = f"WHERE rank <= {n}" if n else ""
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k}period ORDER BY obligations DESC NULLS LAST, label NULLS LAST) AS rank FROM (
SELECT {k}CASE WHEN g = 1 THEN 'all' ELSE fy END AS period, label, obligations, transactions FROM (SELECT {k}fy, label, grouping(fy) AS g, round(coalesce(sum(obl), 0), 2) AS obligations, count(*) AS transactions
FROM (SELECT * FROM (SELECT {a}{_FY} AS fy, {label} AS label, {OBL} AS obl FROM {source}) {null}) WHERE label IS NOT NULL GROUP BY GROUPING SETS (({k}fy, label), ({k}label))) WHERE g = 1 OR fy IS NOT NULL)) {limit}"""


@query(_ranked_sql("recipient_name", 25), "contracts")
def c10_breakdown_top(contracts):
    return cubes.breakdown(contracts, CONTRACTS, "recipient")


@query(_ranked_sql(FIPS, None), "contracts")
def c10b_breakdown_whole(contracts):
    return cubes.breakdown(contracts, CONTRACTS, "county")


@query(_ranked_sql("cfda_number", 25, source="assistance"), "assistance")
def c10c_breakdown_assistance(assistance):
    return cubes.breakdown(assistance, ASSISTANCE, "cfda")


@query(_ranked_sql("naics_description", 15, agency=True), "contracts")
def c11_agency_breakdown(contracts):
    return cubes.agency_breakdown(contracts, CONTRACTS, "naics")


_DIM_SQL = {"county": FIPS, "zip": "nullif(substr({zip}, 1, 5), '')"}


def _cube_sql(spec: fields.DatasetSpec) -> str:
    parts = []
    for k, (column, kept) in spec.breakdowns.items():
        label = _DIM_SQL.get(k, column).replace("{zip}", spec.zip_column)
        parts.append(f"SELECT '{k}' AS dim, CAST(NULL AS VARCHAR) AS agency, period, label, obligations, transactions, rank FROM ({_ranked_sql(label, None if kept else 25, source=spec.name)})")
        if k in cubes.BY_AGENCY:
            parts.append(f"SELECT '{k}', agency, period, label, obligations, transactions, rank FROM ({_ranked_sql(label, 15, agency=True, source=spec.name)})")
    return " UNION ALL ".join(parts)


@query(_cube_sql(CONTRACTS), "contracts")
def c10d_whole_cube(contracts, spark, sf_dir):
    return whole_cube.stored_cube(contracts, CONTRACTS, scratch(spark, "cube-base"))


@query(_cube_sql(ASSISTANCE), "assistance")
def c10e_whole_cube_assistance(assistance, spark, sf_dir):
    return whole_cube.stored_cube(assistance, ASSISTANCE, scratch(spark, "cube-base"))


@query(f"""SELECT * FROM (WITH c AS ({_cube_sql(CONTRACTS)})
SELECT CASE WHEN agency IS NOT NULL THEN 'agency' WHEN dim = 'county' THEN 'side' ELSE 'dims' END AS file, dim, coalesce(trim(regexp_replace(lower(agency), '[^a-z0-9]+', '-', 'g'), '-'), '') AS slug, period, count(*) AS labels,
round(sum(obligations), 2) AS obligations, CAST(sum(rank * transactions) AS BIGINT) AS ranked, count(CASE WHEN agency IS NULL AND dim = 'county' THEN 1 END) AS named FROM c GROUP BY ALL)""", "contracts")
def a14b_cube_files(contracts, spark, sf_dir):
    """Every file of the cube, read back: main dimensions, the county file with its names, one folder an agency."""
    target = scratch(spark, "cube-files")
    whole_cube.write_files(contracts, CONTRACTS, target, scratch(spark, "cube-base"))
    label = "rank int, label string, name string, obligations double, transactions bigint"
    schema, out = f"agency string, dim string, slug string, period string, rows array<struct<{', '.join(x.replace(' ', ': ', 1) for x in label.split(', '))}>>", None
    for name in ("dims", "side", "agency"):
        one = spark.read.schema(schema).json(f"{target}/{name}").select(F.lit(name).alias("file"), "dim", F.coalesce("slug", F.lit("")).alias("slug"), "period", F.explode("rows").alias("x"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("file", "dim", "slug", "period").agg(F.count("*").alias("labels"), F.round(F.sum("x.obligations"), 2).alias("obligations"), F.sum(F.col("x.rank") * F.col("x.transactions")).alias("ranked"), F.count("x.name").alias("named"))


_KPIS = f"""WITH c AS (SELECT agency, fy, sum(obligations) AS o, sum(transactions) AS n FROM ({_CUBE}) GROUP BY ALL),
g AS (SELECT * FROM (SELECT DISTINCT agency FROM c) CROSS JOIN (SELECT DISTINCT fy FROM c))
SELECT agency, coalesce(nullif(trim(regexp_replace(lower(agency), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') AS slug, period, round(o, 2) AS obligations, CAST(n AS BIGINT) AS transactions FROM (
SELECT g.agency, g.fy AS period, coalesce(o, 0) AS o, coalesce(n, 0) AS n FROM g LEFT JOIN c ON g.agency = c.agency AND g.fy = c.fy UNION ALL SELECT agency, 'all', sum(o), sum(n) FROM c GROUP BY 1)"""


@query(f"SELECT * FROM ({_KPIS})", "contracts")
def c12_agency_kpis(contracts):
    return cubes.agency_kpis(contracts)


@query(f"SELECT {FIPS} AS fips, min(recipient_county_name) AS county, min(recipient_state_code) AS state FROM contracts WHERE {FIPS} IS NOT NULL GROUP BY 1", "contracts")
def c13_county_names(contracts):
    return cubes.county_names(contracts).drop("label")


_OPTION_FIELDS = ["recipient_state_code", "naics_code", "extent_competed", "recipient_name", "contract_transaction_unique_key", "awarding_sub_agency_code"]
_NAMED = "CASE WHEN name <> '' THEN name || ' (' || value || ')' ELSE value END"


@query(f"SELECT field, value, {_NAMED} AS label, obligations, row_number() OVER (PARTITION BY field ORDER BY obligations DESC, value) AS rank FROM (SELECT *, count(*) OVER (PARTITION BY field) AS c FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS value, {'min(awarding_sub_agency_name)' if f == 'awarding_sub_agency_code' else 'NULL'} AS name, round(coalesce(sum({OBL}), 0), 2) AS obligations FROM (SELECT *, CAST(length(awarding_sub_agency_name) AS VARCHAR) AS awarding_sub_agency_code FROM contracts) WHERE {f} IS NOT NULL GROUP BY {f}" for f in _OPTION_FIELDS if f != "recipient_name") + ")) WHERE c <= 10000", "contracts")
def c14_filter_options(contracts):
    return cubes.filter_options(contracts.withColumn("awarding_sub_agency_code", F.length("awarding_sub_agency_name").cast("string")), _OPTION_FIELDS)


_CANDIDATES = {k: c for k, c in {**fields.DIMENSIONS, **fields.ALIASES}.items() if k not in ("month", "recipient", "recipient_parent") and not c.endswith("sub_agency_code")}


@query("SELECT field, value, value AS label, obligations, row_number() OVER (PARTITION BY field ORDER BY obligations DESC, value) AS rank FROM (SELECT *, count(*) OVER (PARTITION BY field) AS c FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS field, {c} AS value, round(coalesce(sum({OBL}), 0), 2) AS obligations FROM contracts WHERE {c} IS NOT NULL GROUP BY {c}" for k, c in _CANDIDATES.items()) + f" UNION ALL SELECT 'month', strftime(action_date, '%Y-%m'), round(coalesce(sum({OBL}), 0), 2) FROM contracts WHERE action_date IS NOT NULL GROUP BY 2)) WHERE c <= 1500", "contracts")
def c14b_filter_candidates(contracts):
    """All candidate fields at a smaller gate, which some of them pass and some do not."""
    return cubes.filter_options(contracts, most=1500)


@query(f"SELECT DISTINCT extent_competed AS value, CASE WHEN b.label IS NOT NULL AND b.label <> '' THEN b.label || ' (' || extent_competed || ')' ELSE extent_competed END AS label, false AS searchable FROM contracts LEFT JOIN (SELECT * FROM (VALUES ('A', 'FULL'), ('R', '')) v(code, label)) b ON extent_competed = code", "contracts")
def c15_live_options(contracts, spark, sf_dir):
    labels = _base(spark, sf_dir, "region").limit(1).select(F.explode(F.expr("array(named_struct('value', 'A', 'label', 'FULL'), named_struct('value', 'R', 'label', ''))")).alias("x")).select("x.*")
    return cubes.live_options(contracts, "extent_competed", labels)


@query("SELECT CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS label, count(DISTINCT contract_transaction_unique_key) > 400 AS searchable FROM contracts", "contracts")
def c15b_too_many_options(contracts):
    return cubes.live_options(contracts, "contract_transaction_unique_key")


_ZIP = " UNION ALL ".join(f"SELECT '{n}' AS product, {_FY} AS fiscal_year, awarding_agency_name AS agency, nullif(substr({z}, 1, 5), '') AS zip, min(recipient_state_code) AS state, round(sum({OBL}), 2) AS obligations, count(*) AS transactions FROM {n} GROUP BY ALL" for n, z in (("contracts", "recipient_zip_4_code"), ("assistance", "recipient_zip_code")))


def _zips(contracts: DataFrame, assistance: DataFrame) -> DataFrame:
    return cubes.zip_summary(contracts, CONTRACTS).unionByName(cubes.zip_summary(assistance, ASSISTANCE))


@query(_ZIP, "contracts", "assistance")
def c16_zip_summary(contracts, assistance):
    return _zips(contracts, assistance)


@query(f"SELECT count(*) AS n_rows, count(DISTINCT zip) AS zips, round(sum(obligations), 2) AS obligations FROM ({_ZIP})", "contracts", "assistance")
def c17_zip_stats(contracts, assistance):
    return cubes.zip_stats(_zips(contracts, assistance))


_AWARDS = f"""SELECT * EXCLUDE (r) FROM (SELECT *, round(sum({OBL}) OVER w, 2) AS award_obligated_total, count(*) OVER w AS award_transaction_count, min(action_date) OVER w AS award_first_action_date, max(action_date) OVER w AS award_latest_action_date,
row_number() OVER (PARTITION BY contract_award_unique_key ORDER BY action_date DESC NULLS LAST, last_modified_date DESC NULLS LAST, contract_transaction_unique_key DESC NULLS LAST) AS r
FROM contracts WHERE contract_award_unique_key IS NOT NULL WINDOW w AS (PARTITION BY contract_award_unique_key)) WHERE r = 1"""


@query(f"SELECT contract_award_unique_key, contract_transaction_unique_key, award_obligated_total, award_transaction_count FROM ({_AWARDS})", "contracts")
def c18_award_totals(contracts):
    return summary.award_summary(contracts, CONTRACTS).select("contract_award_unique_key", "contract_transaction_unique_key", "award_obligated_total", "award_transaction_count")


@query(f"SELECT {_FY} AS fiscal_year, count(*) AS transactions, round(sum({OBL}) / 1e9, 2) AS billions FROM contracts GROUP BY 1", "contracts")
def c19_coverage(contracts):
    return cubes.coverage(contracts)


@query(f"SELECT {_FY} AS fiscal_year, round(sum({OBL}) / 1e9, 6) AS billions FROM contracts WHERE {_FY} IS NOT NULL GROUP BY 1", "contracts")
def c20_spend_series(contracts):
    return cubes.spend_series(contracts)


@query(f"SELECT award_type, kind, CAST(grouping(award_type, kind) AS INT) AS level, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, string_agg(DISTINCT fiscal_year, ',' ORDER BY fiscal_year) AS fiscal_years FROM ({_FILES}) GROUP BY ROLLUP (award_type, kind)", "listing")
def c21_inventory(listing):
    return manifest.inventory(manifest.parse_listing(listing))


@query(f"SELECT max(datestamp) AS datestamp FROM ({_FILES}) WHERE kind = 'Full'", "listing")
def c22_latest_datestamp(listing):
    return manifest.latest_datestamp(manifest.parse_listing(listing), "Full")


@query("""SELECT product, fiscal_year, agency, coalesce(name, agency) AS name, row_count AS n_rows, year_rows, row_number() OVER (PARTITION BY product ORDER BY fiscal_year DESC, name IS NULL, coalesce(name, agency), agency) AS place FROM (
SELECT *, CAST(coalesce(max(CASE WHEN agency = 'All' THEN row_count END) OVER w, sum(CASE WHEN agency <> 'All' THEN row_count END) OVER w) AS BIGINT) AS year_rows FROM (
SELECT split_part(logical_id, '/', 1) AS product, split_part(logical_id, '/', 2) AS fiscal_year, split_part(logical_id, '/', 3) AS agency, row_count FROM manifest WHERE row_count > 0) WINDOW w AS (PARTITION BY product, fiscal_year))
LEFT JOIN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS a, n_name AS name FROM nation WHERE n_regionkey <> 2) ON a = agency""", "manifest")
def c23_download_index(manifest_, spark, sf_dir):
    names = _base(spark, sf_dir, "nation").where("n_regionkey <> 2").select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("agency"), F.col("n_name").alias("agency_name"))
    return manifest.download_index(manifest_, names)


@query(f"""SELECT r AS rows_in, k AS rows_out, r - k AS rows_dropped, round(o - ko, 2) AS obligations_dropped FROM (SELECT count(*) AS r, sum({OBL}) AS o, count(CASE WHEN contract_transaction_unique_key NOT LIKE '%_R' THEN 1 END) AS k, sum(CASE WHEN contract_transaction_unique_key NOT LIKE '%\\_R' ESCAPE '\\' THEN {OBL} END) AS ko FROM contracts_raw)""".replace("'%_R' THEN 1", "'%\\_R' ESCAPE '\\' THEN 1"), "contracts_raw")
def c24_reload_accounting(raw):
    return summary.reload_accounting(raw, summary.without_republished(raw))


_WIDE_YEARS = ["1994", "1995", "1996"]


def _wide(label: str, where: str = "true", metric: str = "obligations") -> str:
    years = ", ".join(f"round(coalesce(sum(CASE WHEN fy = '{y}' THEN {metric} END), 0), 2) AS fy{y}" for y in _WIDE_YEARS)
    return f"SELECT {label} AS label, {years}, round(sum({metric}), 2) AS total FROM ({_CUBE}) WHERE fy IN ('1994', '1995', '1996') AND {where} GROUP BY 1"


@query(_wide("subagency", "agency = 'BUILDING'"), "contracts")
def c25_over_time(contracts):
    return cubes.over_time(cubes.timeseries(contracts), "subagency", "obligations", _WIDE_YEARS, "BUILDING")


@query(_wide("'all'", metric="transactions"), "contracts")
def c25b_over_time_total(contracts):
    return cubes.over_time(cubes.timeseries(contracts), None, "transactions", _WIDE_YEARS)


@query(_wide("subagency") + " ORDER BY total DESC, label LIMIT 8", "contracts")
def c26_top_series(contracts):
    return cubes.top_series(cubes.timeseries(contracts), "subagency", "obligations", _WIDE_YEARS)


@query(f"SELECT recipient_state_code AS label, round(coalesce(sum({OBL}), 0), 2) AS obligations, count(*) AS transactions FROM contracts WHERE {_FY} BETWEEN '1994' AND '1996' AND recipient_state_code IS NOT NULL GROUP BY 1", "contracts")
def c27_range_sum(contracts):
    return cubes.range_sum(cubes.breakdown(contracts, CONTRACTS, "state"), "1994", "1996")


@query(f"SELECT '1995' AS period, round(greatest(0, least(1, 1 - sum(CASE WHEN recipient_state_code IS NOT NULL THEN {OBL} END) / sum({OBL}))), 6) AS missing FROM contracts WHERE {_FY} = '1995'", "contracts")
def c28_map_missing(contracts):
    return cubes.map_missing(cubes.breakdown(contracts, CONTRACTS, "state"), cubes.trend(contracts), "1995")


@query(f"SELECT obligations, transactions, CASE WHEN transactions > 0 THEN round(obligations / transactions, 4) END AS average FROM (SELECT round(sum({OBL}), 2) AS obligations, count(*) AS transactions FROM contracts)", "contracts")
def c29_headline(contracts):
    return cubes.headline(contracts)


@query("SELECT 'nation' AS table_name, count(*) AS n_rows FROM nation UNION ALL SELECT 'dictionary', count(*) FROM dictionary", "dictionary")
def c30_row_counts(dictionary, spark, sf_dir):
    return refdata.row_counts({"nation": _base(spark, sf_dir, "nation"), "dictionary": dictionary})


# --- joins


@query(f"SELECT recipient_state_code AS g, round(sum({OBL}), 2) AS obligations, count(CASE WHEN {IN_A} THEN 1 END) AS n FROM contracts GROUP BY 1", "contracts")
def d01_metric_join(contracts):
    rows = contracts.withColumnRenamed("recipient_state_code", "g")
    first = rows.groupBy("g").agg(F.round(F.sum(OBL), 2).alias("obligations"))
    second = rows.groupBy("g").agg(F.count(F.when(fields.period_mask(rows, A), 1)).alias("n"))
    return table.metric_join([first, second], ["g"])


@query("SELECT extent_competed, CASE extent_competed WHEN 'A' THEN 'FULL' WHEN 'N' THEN 'NONE' END AS label, count(*) AS n FROM contracts GROUP BY ALL", "contracts")
def d02_decode(contracts, spark, sf_dir):
    texts = _base(spark, sf_dir, "region").limit(1).select(F.lit("extent_competed").alias("award_element"), F.lit("Contracts").alias("award_file"), F.lit("A = FULL\nA = OPEN\nsee there\nN = NONE\nQ = OTHER").alias("domain_values"))
    return refdata.decoded(contracts.select("extent_competed"), "extent_competed", refdata.codebook(texts), "label").groupBy("extent_competed", "label").agg(F.count("*").alias("n"))


@query("""SELECT c_nationkey AS code, coalesce(CASE WHEN c_nationkey < 10 THEN n_name WHEN c_nationkey < 20 THEN 'TOP ' || n_name END, CAST(c_nationkey AS VARCHAR)) AS name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""".replace("c_nationkey AS code", "CAST(c_nationkey AS VARCHAR) AS code"))
def d03_agency_names(spark, sf_dir):
    nation = _base(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("k"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"))
    names = refdata.agency_names(nation.where("k < 10"), nation.where("k < 20").withColumn("name", F.concat(F.lit("TOP "), "name")))
    customers = _base(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("code"))
    return refdata.named(customers, "code", names, "name").groupBy("code", "name").agg(F.count("*").alias("n"))


_CHANGED = f"SELECT f.logical_id, f.etag, f.datestamp, f.award_type, f.fiscal_year, f.agency_code FROM ({_FILES}) f LEFT JOIN manifest m ON f.logical_id = m.logical_id WHERE kind = 'Full' AND datestamp = (SELECT max(datestamp) FROM ({_FILES}) WHERE kind = 'Full') AND f.etag IS DISTINCT FROM m.etag"


@query(f"SELECT logical_id, etag, datestamp FROM ({_CHANGED})", "listing", "manifest")
def d04_changed_files(listing, manifest_):
    return manifest.changed(manifest.parse_listing(listing), manifest_).select("logical_id", "etag", "datestamp")


@query(f"SELECT * FROM manifest WHERE logical_id NOT IN (SELECT logical_id FROM ({_CHANGED})) UNION ALL SELECT logical_id, etag, CAST(1 AS BIGINT) FROM ({_CHANGED})", "listing", "manifest")
def d05_manifest_upsert(listing, manifest_):
    new = manifest.changed(manifest.parse_listing(listing), manifest_).select("logical_id", "etag", F.lit(1).cast("long").alias("row_count"))
    return manifest.upserted(manifest_, new)


@query(f"SELECT logical_id, fiscal_year FROM ({_CHANGED}) WHERE award_type = 'Contracts' AND fiscal_year IN ('2023', '2024', '2021') ORDER BY fiscal_year DESC, award_type, agency_code LIMIT 12", "listing", "manifest")
def d06_refresh_selection(listing, manifest_):
    rows = manifest.changed(manifest.parse_listing(listing), manifest_)
    return manifest.to_refresh(rows, 12, products=["Contracts"], years=["2023", "2024", "2021"]).select("logical_id", "fiscal_year")


@query(f"SELECT agency, period, obligations FROM ({_KPIS}) WHERE period <> 'all'", "contracts")
def d07_zero_filled_grid(contracts):
    return cubes.agency_kpis(contracts).where("period <> 'all'").select("agency", "period", "obligations")


# --- windows


@query(_AWARDS, "contracts")
def e01_award_summary(contracts):
    return summary.award_summary(contracts, CONTRACTS)


@query("SELECT * FROM contracts_raw WHERE contract_transaction_unique_key NOT LIKE '%\\_R' ESCAPE '\\'", "contracts_raw")
def e02_without_republished(raw):
    return summary.without_republished(raw)


@query(_ranked_sql("recipient_parent_name", 15, agency=True), "contracts")
def e03_top_k_per_group(contracts):
    return cubes.agency_breakdown(contracts, CONTRACTS, "recipient_parent")


@query("SELECT product, fiscal_year FROM (SELECT *, dense_rank() OVER (PARTITION BY product ORDER BY fiscal_year DESC) AS r FROM (SELECT DISTINCT split_part(logical_id, '/', 1) AS product, split_part(logical_id, '/', 2) AS fiscal_year FROM manifest)) WHERE r <= 2", "manifest")
def e04_year_pick(manifest_):
    return manifest.years_to_compact(manifest_)


@query("SELECT code, name FROM (SELECT CAST(c_nationkey AS VARCHAR) AS code, c_name AS name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer WHERE c_nationkey <> 3) WHERE r = 1")
def e05_first_wins(spark, sf_dir):
    codes = _base(spark, sf_dir, "customer").selectExpr("c_custkey line", "if(c_nationkey = 3, ' ', concat(' ', c_nationkey)) code", "c_name name")
    return refdata.first_names(codes)


# --- sorts, limits


@query(f"SELECT recipient_name AS g0, round(sum({OBL}), 2) AS obligations_a, count(*) AS transactions_a FROM contracts GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10", "contracts")
def f01_order_and_limit(contracts):
    return build_table(contracts, TableRequest(rows=("recipient",), metrics=("obligations", "transactions"), top=10, round_to=2))


@query(f"SELECT {', '.join(CONTRACTS.detail)} FROM contracts WHERE {IN_A} OR {IN_B} ORDER BY {OBL} DESC NULLS LAST, contract_transaction_unique_key LIMIT 1000", "contracts")
def f02_detail_extract(contracts):
    return table.detail(contracts, TableRequest(period_a=A, period_b=B), 1000)[0]


@query(f"SELECT recipient_name, round(sum({OBL}), 2) AS obligations FROM contracts WHERE {_FY} = '1996' GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 15", "contracts")
def f03_top_recipients(contracts):
    return table.top(contracts, "recipient_name", 15, F.col(_FY) == "1996")


@query(f"SELECT awarding_sub_agency_name, round(sum({OBL}), 2) AS obligations FROM contracts WHERE {_FY} = '1996' GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 15", "contracts")
def f04_top_agencies(contracts):
    return table.top(contracts, "awarding_sub_agency_name", 15, F.col(_FY) == "1996")


@query(f"SELECT recipient_name, round(sum({OBL}), 2) AS obligations FROM contracts WHERE awarding_agency_name = 'MACHINERY' GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10", "contracts")
def f05_top_at_agency(contracts):
    return table.top(contracts, "recipient_name", 10, F.col("awarding_agency_name") == "MACHINERY")


@query(f"SELECT label, obligations, transactions FROM ({_ranked_sql('recipient_name', 25)}) WHERE period = '1995' ORDER BY transactions DESC, label LIMIT 15", "contracts")
def f06_shown_by_metric(contracts):
    return cubes.shown(cubes.breakdown(contracts, CONTRACTS, "recipient"), "1995", "transactions")


@query(f"SELECT contract_transaction_unique_key, {OBL} FROM contracts WHERE {OBL} > 90000 ORDER BY 2 DESC", "contracts")
def f07_large_transactions(contracts):
    return table.large(contracts, 90000, ["contract_transaction_unique_key", OBL])


# --- set operations

_BOTH = " UNION ALL ".join(f"SELECT '{n}' AS product, {_FY} AS fy, recipient_name, {OBL} FROM {n}" for n in ("contracts", "assistance"))


@query(f"SELECT product, fy, count(*) AS n, round(sum({OBL}), 2) AS obligations FROM ({_BOTH}) GROUP BY ALL", "contracts", "assistance")
def g01_union_of_products(contracts, assistance):
    rows = [df.select(F.lit(n).alias("product"), F.col(_FY).alias("fy"), "recipient_name", OBL) for n, df in (("contracts", contracts), ("assistance", assistance))]
    return rows[0].unionByName(rows[1]).groupBy("product", "fy").agg(F.count("*").alias("n"), F.round(F.sum(OBL), 2).alias("obligations"))


@query("SELECT count(*) AS n, count(cfda_number) AS cfda, count(naics_code) AS naics FROM (SELECT * FROM contracts UNION ALL BY NAME SELECT * FROM assistance)", "contracts", "assistance")
def g02_union_by_name(contracts, assistance):
    return contracts.unionByName(assistance, allowMissingColumns=True).agg(F.count("*").alias("n"), F.count("cfda_number").alias("cfda"), F.count("naics_code").alias("naics"))


_NAMES_OF = "SELECT unnest(json_keys(to_json(x))) AS column_name FROM (SELECT {0} AS x FROM {0} LIMIT 1)"


@query(" UNION ALL ".join(f"SELECT '{side}' AS side, column_name FROM ({_NAMES_OF.format(own)}) WHERE column_name NOT IN (SELECT column_name FROM ({_NAMES_OF.format(other)}))" for side, own, other in (("added", "assistance", "contracts"), ("gone", "contracts", "assistance"))), "contracts", "assistance")
def g03_column_difference(contracts, assistance):
    return guards.column_difference(contracts, assistance)


@query("SELECT DISTINCT naics_code AS value FROM contracts", "contracts")
def g04_distinct(contracts):
    return contracts.select(F.col("naics_code").alias("value")).distinct()


# --- refresh and guards

_ROWS = "SELECT 'contracts/' || CAST(2020 + l_linenumber % 5 AS VARCHAR) || '/' || lpad(CAST(l_suppkey % 25 AS VARCHAR), 3, '0') AS logical_id, count(*) AS n FROM lineitem GROUP BY 1"


@query(f"SELECT * FROM manifest WHERE logical_id NOT IN (SELECT c.logical_id FROM ({_CHANGED}) c JOIN ({_ROWS}) r ON c.logical_id = r.logical_id) UNION ALL SELECT c.logical_id, c.etag, n FROM ({_CHANGED}) c JOIN ({_ROWS}) r ON c.logical_id = r.logical_id", "listing", "manifest")
def h01_incremental_refresh(listing, manifest_, spark, sf_dir):
    lines = _base(spark, sf_dir, "lineitem").select(F.expr("concat('contracts/', 2020 + l_linenumber % 5, '/', lpad(CAST(l_suppkey % 25 AS STRING), 3, '0')) logical_id"))
    return refreshed(lines, manifest.parse_listing(listing), manifest_)[1]


_AGENCY = "lpad(CAST(length(awarding_agency_name) AS VARCHAR), 3, '0')"


@query(f"""SELECT fiscal_year, agency, cycle, count(*) AS n_rows, round(sum({OBL}), 2) AS obligations, count(*) AS manifest_rows, min(etag) AS etag FROM (
SELECT {_FY} AS fiscal_year, {_AGENCY} AS agency, {OBL}, CASE WHEN {_FY} = '1995' THEN '20261106' ELSE '20261006' END AS cycle, CASE WHEN {_FY} = '1995' THEN md5({_AGENCY}) END AS etag
FROM contracts WHERE NOT ({_FY} = '1995' AND transaction_number = '1')) GROUP BY ALL""", "contracts")
def h01b_stream_refresh(contracts, spark, sf_dir):
    """Slices whose files come in two calls keep both; a newer cycle replaces a year; a call that reads all files again,
    as its checkpoint is lost, changes nothing; the manifest says what is live."""
    root, folder = scratch(spark, "stream-slices"), scratch(spark, "stream-csv")
    columns = ["contract_transaction_unique_key", "action_date", OBL, "awarding_agency_name"]
    contracts = _written(contracts.select(*columns, "transaction_number", _FY), spark)
    agency = F.lpad(F.length("awarding_agency_name").cast("string"), 3, "0")
    listing = contracts.where(f"{_FY} = '1995'").select(agency.alias("a")).distinct().select(F.concat(F.lit("contracts/1995/"), "a").alias("logical_id"), F.lit("20261106").alias("datestamp"), F.md5("a").alias("etag"))
    listing = _written(listing, spark)

    def land(rows: DataFrame, cycle: str, checkpoint: str) -> None:
        key = F.concat(F.lit("FY"), _FY, F.lit("_"), agency, F.lit(f"_Contracts_Full_{cycle}"))
        rows.select(*columns, key.alias("key")).write.mode("append").partitionBy("key").options(header=True, escape='"').csv(folder)
        stream_refresh(spark, folder, ", ".join(f"{c} string" for c in columns), root, f"{root}-{checkpoint}", listing=listing)

    land(contracts.where("transaction_number IN ('1', '2')"), "20261006", "first")
    land(contracts.where("transaction_number NOT IN ('1', '2')"), "20261006", "first")
    land(contracts.where(f"{_FY} = '1995' AND transaction_number <> '1'"), "20261106", "first")
    stream_refresh(spark, folder, ", ".join(f"{c} string" for c in columns), root, f"{root}-second", listing=listing)
    rows = slices.read_live(spark, root).groupBy("fiscal_year", "agency", "cycle").agg(F.count("*").alias("n_rows"), F.round(F.sum(OBL), 2).alias("obligations"))
    told = slices.manifest(spark, root).select(F.split("logical_id", "/")[1].alias("fiscal_year"), F.split("logical_id", "/")[2].alias("agency"), F.col("row_count").alias("manifest_rows"), "etag")
    return rows.join(told, ["fiscal_year", "agency"], "left")


def _old_and_new(contracts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per year: 1993 loses a tenth of its rows, 1994 its last days, 1995 a few rows only."""
    x = F.xxhash64("contract_transaction_unique_key")
    new = contracts.where(~((F.col(_FY) == "1993") & F.col("transaction_number").isin("1", "2")) & ~((F.col(_FY) == "1994") & (F.col("action_date") > F.lit("1994-09-01").cast("date"))))
    return guards.summary(contracts, [_FY]), guards.summary(new.drop("naics_code").withColumn("added", x), [_FY])


_OLD_NEW = f"""WITH o AS (SELECT {_FY} AS fy, count(*) AS n, min(action_date) AS lo, max(action_date) AS hi FROM contracts GROUP BY 1),
n AS (SELECT {_FY} AS fy, count(*) AS n, min(action_date) AS lo, max(action_date) AS hi FROM contracts WHERE NOT ({_FY} = '1993' AND transaction_number IN ('1', '2')) AND NOT ({_FY} = '1994' AND action_date > DATE '1994-09-01') GROUP BY 1)"""


@query(f"""SELECT * FROM ({_OLD_NEW} SELECT o.fy AS action_date_fiscal_year, array_to_string(list_filter([CASE WHEN coalesce(n.n, 0) < o.n * 0.95 THEN 'rows fall from ' || o.n || ' to ' || coalesce(n.n, 0) END, 'columns gone: naics_code',
CASE WHEN n.hi < o.hi THEN 'last date moves back' END, CASE WHEN n.lo > o.lo THEN 'first date moves on' END, CASE WHEN o.hi IS NOT NULL AND n.hi IS NULL THEN 'range of dates is lost' END], lambda x: x IS NOT NULL), '; ') AS problems FROM o LEFT JOIN n ON o.fy = n.fy)""", "contracts")
def i01_replace_guard(contracts):
    return guards.compared(*_old_and_new(contracts), [_FY]).withColumn("problems", F.array_join("problems", "; "))


def _manifest_of(raw: DataFrame) -> DataFrame:
    return raw.groupBy(F.concat(F.lit("contracts/"), "fiscal_year", F.lit("/"), "agency").alias("logical_id")).agg(F.count("*").alias("row_count"))


@query(f"""SELECT {_FY} AS fiscal_year, CASE WHEN {_FY} = '1993' THEN 'rows fall from ' || count(*) || ' to ' || count(CASE WHEN transaction_number NOT IN ('1', '2') THEN 1 END) ELSE '' END AS problems, {_FY} <> '1993' AS replaced,
count(*) AS served_rows, round(sum(CASE WHEN {_FY} = '1995' THEN 2 * {OBL} ELSE {OBL} END), 2) AS obligations FROM contracts GROUP BY 1""", "contracts")
def i01b_guarded_compaction(contracts, spark, sf_dir):
    """Raw slices published twice. At first with re-published copies, which go, and All copies of some years; then 1995's
    amounts are doubled, which is accepted, and 1993 loses a third of its rows, which is refused and leaves it as it was."""
    raw, again, serve = scratch(spark, "raw"), scratch(spark, "raw"), scratch(spark, "serve")
    rows = contracts.withColumns({"fiscal_year": F.col(_FY), "agency": F.lpad(F.length("awarding_agency_name").cast("string"), 3, "0")})
    copy = F.explode(F.when(F.col("transaction_number") == "3", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))).alias("copy")
    again_at, again_key = F.lit("2026-11-03").cast("date"), F.concat("contract_transaction_unique_key", F.lit("_R"))
    both = rows.select("*", copy).withColumns({"last_modified_date": F.when(F.col("copy"), again_at).otherwise(F.col("last_modified_date")), "contract_transaction_unique_key": F.when(F.col("copy"), again_key).otherwise(F.col("contract_transaction_unique_key"))})
    archive.write_raw(_also_all(both.drop("copy"), "1994"), f"{raw}/contracts")
    first = compaction.compact(spark, _manifest_of(archive.read_raw(spark, f"{raw}/contracts", "every")), raw, serve, "contracts")
    assert first.where("NOT replaced").isEmpty()
    # the same rows of the first raw layer, which is not needed after that, so that they are joined once
    rows = archive.read_raw(spark, f"{raw}/contracts", "every").where("NOT (agency <=> 'All')").where(~F.col("contract_transaction_unique_key").endswith("_R"))
    twice = rows.withColumn(OBL, F.when(F.col("fiscal_year") == "1995", 2 * F.col(OBL)).otherwise(F.col(OBL)))
    archive.write_raw(twice.where("NOT (fiscal_year = '1993' AND transaction_number IN ('1', '2'))"), f"{again}/contracts")
    files.removed(spark, raw)
    second = compaction.compact(spark, _manifest_of(archive.read_raw(spark, f"{again}/contracts", "every")), again, serve, "contracts")
    served = archive.read_serve(spark, serve, "contracts").groupBy("fiscal_year").agg(F.count("*").alias("served_rows"), F.round(F.sum(OBL), 2).alias("obligations"))
    return served.join(second.select("fiscal_year", F.array_join("problems", "; ").alias("problems"), "replaced"), "fiscal_year", "left")


@query(f"""SELECT * FROM ({_OLD_NEW} SELECT o.fy AS action_date_fiscal_year, 'rows ' || o.n || ' -> ' || coalesce(CAST(n.n AS VARCHAR), '-') || ', new columns: added, dates ' || o.lo || '..' || o.hi || ' -> ' || n.lo || '..' || n.hi AS change FROM o JOIN n ON o.fy = n.fy)""", "contracts")
def i02_change_described(contracts):
    return guards.described(*_old_and_new(contracts), [_FY])


#: What the checked cubes are made of.
_CHECKED = ["awarding_agency_name", "awarding_sub_agency_name", _FY, OBL, "recipient_state_code"]


@query("SELECT name, CAST(0 AS BIGINT) AS violations FROM (VALUES ('kpi periods are years or all'), ('one kpi row a period'), ('kpis have an all row'), ('breakdown periods are those of kpis'), ('amounts are finite'), ('counts are not negative'), ('listed agencies have outputs'), ('outputs are of listed agencies')) v(name)")
def i03_cube_integrity(spark, sf_dir):
    contracts = _written(view(spark, sf_dir, "contracts").select(*_CHECKED, "product_or_service_code", "product_or_service_code_description"), spark)
    kpis = cubes.agency_kpis(contracts)
    outputs = cubes.agency_breakdown(contracts, CONTRACTS, "psc").select(fields.slug(F.col("agency")).alias("slug")).distinct()
    return guards.cube_checks(*[_written(x, spark) for x in (cubes.trend(contracts), cubes.breakdown(contracts, CONTRACTS, "state"), kpis.select("slug").distinct(), outputs)])


@query(f"""SELECT * FROM (WITH b AS (SELECT DISTINCT unnest([{_FY}, 'all']) AS period, recipient_state_code AS label FROM contracts WHERE {_FY} IS NOT NULL AND recipient_state_code IS NOT NULL),
f AS (SELECT DISTINCT {_FY} AS fy, awarding_agency_name AS agency FROM contracts)
SELECT 'kpi periods are years or all' AS name, count(DISTINCT fy) AS violations FROM f WHERE fy = '1996' UNION ALL SELECT 'one kpi row a period', count(DISTINCT fy) FROM f WHERE fy = '1995' UNION ALL
SELECT 'kpis have an all row', 1 UNION ALL SELECT 'breakdown periods are those of kpis', count(*) FROM b WHERE period IN ('1996', 'all') UNION ALL
SELECT 'amounts are finite', count(*) FROM b WHERE label IN ('NATION_6', 'NATION_7') UNION ALL SELECT 'counts are not negative', count(*) FROM b WHERE label = 'NATION_12' UNION ALL
SELECT 'listed agencies have outputs', count(DISTINCT agency) FROM f WHERE agency = 'MACHINERY' UNION ALL SELECT 'outputs are of listed agencies', count(DISTINCT agency) FROM f WHERE agency = 'BUILDING')""", "contracts")
def i03b_broken_cube(contracts, spark, sf_dir):
    """Every check finds what is broken: a renamed, a repeated and a missing period, amounts and counts out of range, agencies left out."""
    contracts = _written(contracts.select(*_CHECKED), spark)
    kpis = cubes.trend(contracts).where("period <> 'all'").withColumn("period", F.when(F.col("period") == "1996", "FY96").otherwise(F.col("period")))
    kpis, rows = _written(kpis, spark), cubes.breakdown(contracts, CONTRACTS, "state")
    amount = F.expr("CASE label WHEN 'NATION_6' THEN double('inf') WHEN 'NATION_7' THEN NULL ELSE obligations END")
    rows = rows.withColumns({"obligations": amount, "transactions": F.expr("if(label = 'NATION_12', -transactions, transactions)")})
    rows, slugs = _written(rows, spark), _written(cubes.agency_kpis(contracts).select("slug").distinct(), spark)
    return guards.cube_checks(kpis.unionByName(kpis.where("period = '1995'")), rows, slugs.where("slug <> 'building'"), slugs.where("slug <> 'machinery'"))


@query(f"SELECT {_FY} AS fiscal_year, count(*) AS all_rows, count(*) AS agency_rows, 2 * count(*) AS unfiltered_rows FROM contracts WHERE {_FY} < '1996' GROUP BY 1 UNION ALL SELECT {_FY}, 0, count(*), count(*) FROM contracts WHERE {_FY} >= '1996' GROUP BY 1", "contracts")
def i04_double_count(contracts, spark, sf_dir):
    rows = spark.read.option("mergeSchema", True).parquet(_raw_layer(contracts, spark, with_all=True))
    return guards.double_count(rows)
