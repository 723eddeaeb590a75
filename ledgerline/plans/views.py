"""Award views over the given base tables; each statement runs unchanged in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

CONTRACTS = """
SELECT
  concat('CONT_AWD_', CAST(o_orderkey AS VARCHAR(20))) AS contract_award_unique_key,
  concat_ws('_', CAST(l_orderkey AS VARCHAR(20)), CAST(l_linenumber AS VARCHAR(20)), CAST(l_partkey AS VARCHAR(20)),
            CAST(l_suppkey AS VARCHAR(20)), CAST(CAST(l_shipdate AS DATE) AS VARCHAR(20)),
            CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR(20))) AS contract_transaction_unique_key,
  concat('P', lpad(CAST(l_linenumber AS VARCHAR(20)), 5, '0')) AS modification_number,
  CAST(l_shipdate AS DATE) AS action_date,
  CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS last_modified_date,
  CAST(year(l_shipdate) + CASE WHEN month(l_shipdate) >= 10 THEN 1 ELSE 0 END AS VARCHAR(20)) AS action_date_fiscal_year,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN -l_extendedprice
       WHEN l_partkey % 41 = 0 THEN NULL ELSE l_extendedprice END AS federal_action_obligation,
  CASE WHEN l_suppkey % 17 = 0 THEN '  ' ELSE concat(' UEI', lpad(CAST(l_suppkey AS VARCHAR(20)), 6, '0')) END AS recipient_uei,
  s_name AS recipient_name,
  concat('PARENT ', sn.n_name) AS recipient_parent_name,
  CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE sn.n_name END AS recipient_state_code,
  concat('COUNTY ', CAST(l_partkey % 1001 AS VARCHAR(20))) AS recipient_county_name,
  CASE WHEN l_partkey % 53 = 0 THEN '423.0'
       ELSE lpad(CAST(s_nationkey * 1000 + l_partkey % 1001 AS VARCHAR(20)), 5, '0') END
       AS prime_award_transaction_recipient_county_fips_code,
  CASE WHEN l_partkey % 29 = 0 THEN '' ELSE concat(lpad(CAST((l_suppkey * 37) % 100000 AS VARCHAR(20)), 5, '0'), '1234') END
       AS recipient_zip_4_code,
  c_mktsegment AS awarding_agency_name,
  concat(c_mktsegment, ' / ', cn.n_name) AS awarding_sub_agency_name,
  concat('FUND ', o_orderpriority) AS funding_agency_name,
  concat('FUND ', o_orderpriority, ' / ', cn.n_name) AS funding_sub_agency_name,
  lpad(CAST(p_size AS VARCHAR(20)), 6, '0') AS naics_code, p_type AS naics_description,
  p_brand AS product_or_service_code, p_name AS product_or_service_code_description,
  l_returnflag AS extent_competed, l_linestatus AS type_of_set_aside, o_orderstatus AS type_of_contract_pricing,
  substr(o_orderpriority, 1, 1) AS award_type_code,
  CASE WHEN p_size > 25 THEN 'OTHER THAN SMALL' ELSE 'SMALL' END AS contracting_officers_determination_of_business_size,
  CAST(l_orderkey AS VARCHAR(20)) AS award_id_piid,
  CAST(l_linenumber AS VARCHAR(20)) AS transaction_number
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN part ON l_partkey = p_partkey
"""

CONTRACTS_RAW = """
SELECT contract_award_unique_key,
  CASE WHEN v.copy = 1 THEN concat(contract_transaction_unique_key, '_R') ELSE contract_transaction_unique_key END AS contract_transaction_unique_key,
  modification_number, action_date, federal_action_obligation, awarding_agency_name, action_date_fiscal_year,
  CASE WHEN v.copy = 1 THEN DATE '2026-11-03' ELSE last_modified_date END AS last_modified_date
FROM contracts CROSS JOIN (VALUES (0), (1)) v(copy)
WHERE v.copy = 0 OR modification_number = 'P00003'
"""

ASSISTANCE = """
SELECT
  concat('ASST_', CAST(o_custkey AS VARCHAR(20))) AS assistance_award_unique_key,
  concat('T', lpad(CAST(o_orderkey AS VARCHAR(20)), 9, '0')) AS assistance_transaction_unique_key,
  CAST(o_orderkey AS VARCHAR(20)) AS award_id_fain,
  CAST(o_orderdate AS DATE) AS action_date,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS last_modified_date,
  CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS VARCHAR(20)) AS action_date_fiscal_year,
  CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS federal_action_obligation,
  CASE WHEN o_custkey % 19 = 0 THEN NULL ELSE concat('AUEI', CAST(o_custkey AS VARCHAR(20))) END AS recipient_uei,
  c_name AS recipient_name, concat('PARENT ', r_name) AS recipient_parent_name,
  n_name AS recipient_state_code, concat('COUNTY ', CAST(o_custkey % 97 AS VARCHAR(20))) AS recipient_county_name,
  lpad(CAST(n_nationkey * 1000 + o_custkey % 1000 AS VARCHAR(20)), 5, '0') AS prime_award_transaction_recipient_county_fips_code,
  CASE WHEN o_custkey % 23 = 0 THEN NULL ELSE lpad(CAST(o_custkey AS VARCHAR(20)), 5, '0') END AS recipient_zip_code,
  c_mktsegment AS awarding_agency_name, concat(c_mktsegment, ' / ', n_name) AS awarding_sub_agency_name,
  concat('FUND ', r_name) AS funding_agency_name, concat('FUND ', n_name) AS funding_sub_agency_name,
  concat('84.', lpad(CAST(o_custkey % 40 AS VARCHAR(20)), 3, '0')) AS cfda_number,
  concat('0', substr(o_orderpriority, 1, 1)) AS assistance_type_code
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

LISTING = """
SELECT concat('FY', CAST(2020 + r_regionkey AS VARCHAR(20)), '_', CASE WHEN n_nationkey = 1 AND r_regionkey < 3 THEN 'All' ELSE lpad(CAST(n_nationkey AS VARCHAR(20)), 3, '0') END, '_',
         CASE WHEN p.k = 0 THEN 'Contracts' ELSE 'Assistance' END, '_', CASE WHEN n_nationkey % 4 = 3 THEN 'Delta' ELSE 'Full' END, '_',
         CASE WHEN n_nationkey % 4 = 3 THEN '20261015' WHEN n_nationkey % 7 = 6 THEN '20260906' ELSE '20261006' END, '.zip') AS key,
  CAST(1000 + 37 * n_nationkey + 11 * r_regionkey AS BIGINT) AS size,
  md5(concat(n_name, r_name, CAST(p.k AS VARCHAR(20)))) AS etag
FROM nation CROSS JOIN region CROSS JOIN (VALUES (0), (1)) p(k)
"""

MANIFEST = """
SELECT concat(CASE WHEN p.k = 0 THEN 'contracts' ELSE 'assistance' END, '/', CAST(2020 + r_regionkey AS VARCHAR(20)), '/',
         CASE WHEN n_nationkey = 1 AND r_regionkey < 3 THEN 'All' ELSE lpad(CAST(n_nationkey AS VARCHAR(20)), 3, '0') END) AS logical_id,
  CASE WHEN n_nationkey % 3 = 0 THEN 'old-etag' ELSE md5(concat(n_name, r_name, CAST(p.k AS VARCHAR(20)))) END AS etag,
  CAST(100 * n_nationkey AS BIGINT) AS row_count
FROM nation CROSS JOIN region CROSS JOIN (VALUES (0), (1)) p(k)
WHERE n_nationkey % 5 <> 0
"""

DICTIONARY = """
SELECT concat('column_', CAST(p_partkey AS VARCHAR(20))) AS award_element,
  CASE WHEN p_partkey % 3 = 0 THEN 'Contracts, Assistance' WHEN p_partkey % 3 = 1 THEN 'Contracts' ELSE 'Subawards' END AS award_file,
  concat(p_brand, ' = ', p_name, chr(10), 'See https://example.org/codes', chr(10), '  S', CAST(p_size AS VARCHAR(20)), ' = SIZE = ',
         p_type, '  ', chr(10), 'Note that a = b is prose', chr(10), 'F=', p_type, chr(10), 'C = ', chr(10), 'X=Y=Z') AS domain_values
FROM part
"""

SQL = {"contracts": CONTRACTS, "contracts_raw": CONTRACTS_RAW, "assistance": ASSISTANCE, "listing": LISTING, "manifest": MANIFEST, "dictionary": DICTIONARY}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views over the Parquet tables in sf_dir; only its plan is made here."""
    for t in BASE:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    if name == "contracts_raw":
        view(spark, sf_dir, "contracts").createOrReplaceTempView("contracts")
    return spark.sql(SQL[name])


def oracle(query: str, *names: str) -> str:
    """A query with the views it names in front, for DuckDB."""
    if "contracts_raw" in names and "contracts" not in names:
        names = ("contracts", *names)
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n" + query.strip() if names else query.strip()
