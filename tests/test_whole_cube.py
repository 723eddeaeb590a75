"""The cube in one pass: the same rows as a breakdown a dimension, odd rows, and the plans it is there for."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.fields import ASSISTANCE, CONTRACTS
from ledgerline.operators import cubes, whole_cube
from ledgerline.plans.views import view

COLUMNS = "action_date_fiscal_year string, awarding_agency_name string, awarding_sub_agency_name string, recipient_name string, recipient_state_code string, prime_award_transaction_recipient_county_fips_code string, recipient_county_name string, federal_action_obligation double"


@pytest.fixture
def odd(spark):
    rows = [("2024", "X", "s1", "a", "CA", "06001", "ALAMEDA", 5.0), ("2024", "X", "s1", "b", "CA", "06000", "NONE", None), (None, "X", "s1", "a", "NY", "36001", "ALBANY", 7.0), ("2025", "", None, None, None, None, None, 1.0), ("2025", None, None, "a", "CA", "06001", "Alameda", 2.0)]
    rows += [("2024", "Y", "s2", f"n{i:02}", "TX", None, None, 3.0) for i in range(40)]
    return spark.createDataFrame(rows, COLUMNS)


def plain(df, columns):
    return sorted((tuple(r) for r in df.select(columns).collect()), key=repr)


@pytest.mark.parametrize("spec", [CONTRACTS, ASSISTANCE])
def test_cube_is_all_breakdowns_together(spark, sf_dir, odd, tmp_path, spec):
    for n, df in enumerate((odd, view(spark, sf_dir, spec.name))):
        got = whole_cube.stored_cube(df, spec, str(tmp_path / f"base{n}")).persist()
        columns = ["period", "label", "obligations", "transactions", "rank"]
        for k in ("recipient", "state", "county"):
            assert plain(got.where(f"agency IS NULL AND dim = '{k}'"), columns) == plain(cubes.breakdown(df, spec, k), columns)
            assert plain(got.where(f"agency IS NOT NULL AND dim = '{k}'"), ["agency", *columns]) == plain(cubes.agency_breakdown(df, spec, k), ["agency", *columns])
        assert got.where("agency IS NOT NULL AND dim LIKE 'awarding%'").isEmpty()
        got.unpersist()


def test_rows_are_scanned_once(spark, sf_dir, capsys):
    contracts = view(spark, sf_dir, "contracts")
    whole_cube.cube_base(contracts, CONTRACTS).explain("formatted")
    plan = capsys.readouterr().out.split("\n(1)")[0]
    assert plan.count("lineitem.parquet") <= 1 and plan.count("Generate") == 1 and "SortAggregate" not in plan


def test_grouping_texts_is_by_hash(spark, sf_dir, capsys):
    contracts = view(spark, sf_dir, "contracts")
    cubes.filter_options(contracts, ["recipient_state_code", "naics_code", "contract_transaction_unique_key"], 1000).explain()
    cubes.zip_summary(contracts, CONTRACTS).explain()
    plan = capsys.readouterr().out
    assert "SortAggregate" not in plan and "contract_transaction_unique_key" not in plan.split("named_struct")[-1]


def test_files(spark, odd, tmp_path):
    whole_cube.write_files(odd, CONTRACTS, str(tmp_path / "out"), str(tmp_path / "base"))
    found = {str(p.relative_to(tmp_path / "out").parent) for p in (tmp_path / "out").rglob("*.json")}
    assert {"side/dim=county", "dims/dim=state", "dims/dim=recipient", "agency/slug=x", "agency/slug=y", "trend", "agencies", "timeseries"} <= found and "dims/dim=county" not in found
    side = [json.loads(line) for p in (tmp_path / "out/side/dim=county").glob("*.json") for line in Path(p).read_text().splitlines()]
    assert {x["label"]: x["name"] for r in side for x in r["rows"]} == {"06001": "Alameda, CA"}
    nothing = odd.where(F.lit(False))
    assert whole_cube.stored_cube(nothing, CONTRACTS, str(tmp_path / "none")).count() == 0


def test_candidates_are_columns_that_are_there(odd):
    assert cubes.filter_candidates(odd) == ["fiscal_year", "awarding_agency", "awarding_subagency", "state", "county"]
    assert {r.field for r in cubes.filter_options(odd, most=2).collect()} == {"awarding_subagency", "fiscal_year"}
    assert cubes.filter_options(odd, ["nothing"]).count() == 0 and cubes.filter_options(odd, ["recipient"]).count() == 0


def test_what_a_cube_is_of_is_computed_once(spark, sf_dir, odd, tmp_path):
    """KPIs read their rows once; the files of a cube compute each row once, however many of them there are."""
    odd.write.parquet(str(tmp_path / "odd"))
    kpis = cubes.agency_kpis(spark.read.parquet(str(tmp_path / "odd")))
    assert kpis._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    amount = F.udf(counted, "double").asNondeterministic()("federal_action_obligation")
    whole_cube.write_files(odd.withColumn("federal_action_obligation", amount), CONTRACTS, str(tmp_path / "files"), str(tmp_path / "scratch"))
    assert seen.value == odd.count()


def test_stored_cube_is_dealt_finely(spark, sf_dir, tmp_path, monkeypatch):
    """Base and sums are written from many shuffle partitions whatever the session's number, which stays; the cube is the same."""
    key, seen = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", []
    own = whole_cube.cube_base
    monkeypatch.setattr(whole_cube, "cube_base", lambda df, spec: seen.append(spark.conf.get(key, "4")) or own(df, spec))
    contracts = view(spark, sf_dir, "contracts")
    got = whole_cube.stored_cube(contracts, CONTRACTS, str(tmp_path / "cube"))
    assert int(seen[0]) >= 512 and spark.conf.get(key, None) is None
    want = whole_cube.cube(own(contracts, CONTRACTS), CONTRACTS)
    row = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(map(row, got.select(want.columns).collect())) == sorted(map(row, want.collect()))
