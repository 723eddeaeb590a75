"""Golden cases of the award operators on literal rows."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import casting, fields
from ledgerline.functions.fields import CONTRACTS
from ledgerline.operators import cubes, guards, manifest, refdata, summary, table
from ledgerline.operators.table import TableRequest, build_table
from ledgerline.sources import archive
from ledgerline.streaming.refresh import refreshed

A, B = ("2024-01-01", "2024-12-31"), ("2025-01-01", "2025-12-31")


@pytest.fixture(scope="module")
def contracts(spark):
    # Rows whose sums and changes (below) are known.
    rows = [
        ("C0001", "Acme Corp", "AAA", "CA", "2024-03-01", "100"),
        ("C0002", "Acme Corp", "AAA", "CA", "2024-06-01", "200"),
        ("C0003", "Globex", "BBB", "NY", "2024-04-01", "300"),
        ("C0004", "Acme Corp", "AAA", "CA", "2025-03-01", "50"),
        ("C0005", "Initech", "CCC", "NY", "2025-04-01", "70"),
        ("C0006", "Umbrella", "DDD", "TX", "2024-05-01", "0"),
    ]
    df = spark.createDataFrame(rows, "award_id_piid string, recipient_name string, recipient_uei string, recipient_state_code string, action_date string, federal_action_obligation string")
    return df.withColumns({"funding_sub_agency_name": F.lit("Navy"), "awarding_agency_name": F.lit("DoD"), "action_date_fiscal_year": F.substring("action_date", 1, 4)})


def request(**more):
    return TableRequest(**({"rows": ("state",), "metrics": ("obligations",), "period_a": A, "period_b": B} | more))


def test_two_periods(contracts):
    got = {r.g0: r for r in build_table(contracts, request(metrics=("obligations", "transactions"))).collect()}
    assert [got["CA"][f"obligations_{x}"] for x in ("a", "b", "delta", "pct")] == [300, 50, -250, -83.3]
    assert [got["NY"][f"obligations_{x}"] for x in ("a", "b", "delta", "pct")] == [300, 70, -230, -76.7]
    assert [got["TX"][f"obligations_{x}"] for x in ("a", "b", "delta", "pct")] == [0, None, None, None]
    assert got["CA"].transactions_a == 2 and got["TX"].transactions_b == 0


def test_table_defaults_and_errors(contracts):
    assert [r.g0 for r in build_table(contracts, TableRequest(rows=('bad"field',))).collect()] == ["Navy"]
    for bad in (TableRequest(dataset="grants"), TableRequest(metrics=("nope",)), TableRequest(period_a=("2024", "2025-01-01"))):
        with pytest.raises(ValueError):
            build_table(contracts, bad)
    only_b = build_table(contracts, request(period_a=None)).collect()
    assert sum(r.obligations_a for r in only_b) == 720  # B alone does not filter


def test_vendors_nonzero_net(spark):
    rows = [("x", "A", 5.0), ("x", "A", -5.0), ("x", "B", 1.0), ("y", " ", 3.0), ("z", "C", None)]
    df = spark.createDataFrame(rows, "funding_sub_agency_name string, recipient_uei string, federal_action_obligation double").withColumn("action_date", F.lit("2024-01-01"))
    alone = {r.g0: r[1] for r in build_table(df, TableRequest(metrics=("vendors_nonzero_net",))).collect()}
    assert alone == {"x": 1, "z": 0}
    many = {r.g0: (r.transactions_a, r.vendors_a, r.vendors_nonzero_net_a) for r in build_table(df, TableRequest(metrics=("transactions", "vendors", "vendors_nonzero_net"))).collect()}
    assert many == {"x": (3, 2, 1), "y": (1, 0, None), "z": (1, 1, 0)}


def test_detail(contracts):
    rows, cut = table.detail(contracts, request(), 100)
    assert rows.count() == 6 and not rows.agg(cut).first()[0]
    assert table.detail(contracts, request(period_b=None))[0].count() == 4
    two = table.detail(contracts, request(period_b=None), 2)[0]
    assert [r.award_id_piid for r in two.collect()] == ["C0003", "C0002"]
    assert two.agg(F.count("*") >= 2).first()[0]


def test_filters(contracts):
    def n(**wanted):
        df = contracts
        for c in fields.filters(df, wanted):
            df = df.where(c)
        return df.count()

    assert n(state="CA|NY|") == 5 and n(state="|") == 6 and n(state="") == 6
    assert n(federal_action_obligation_min="100", federal_action_obligation_max="200") == 2
    assert n(federal_action_obligation_min="x") == 0 and n(recipient_name_min="1") == 0
    assert n(**{"a; DROP": "1", "missing_column": "1"}) == 6
    assert fields.date_field("nope") == "action_date" and fields.date_field("last_modified_date") == "last_modified_date"


def test_type_rules(spark):
    kinds = {
        "string": ["award_amount_basis_code", "award_amount_basis_name", "action_date_fiscal_year", "something"],
        "double": ["federal_action_obligation", "total_dollars_obligated", "face_value_of_loan", "obligated_amount_from_COVID-19_supplementals_for_overall_award"],
        "date": ["action_date"],
    }
    names = [n for ns in kinds.values() for n in ns]
    df = casting.typed(spark.createDataFrame([("x",) * len(names)], ", ".join(f"`{n}` string" for n in names)))
    assert dict(df.dtypes) == {n: kind for kind, ns in kinds.items() for n in ns}


def test_casts(spark):
    dates = {"2024-01-05": dt.date(2024, 1, 5), "2024/1/5": dt.date(2024, 1, 5), " 2024-1-5 ": dt.date(2024, 1, 5), "2024": None, "2024-02-30": None, "2024-01-01 garbage": None, "": None, "2024-01-01 10:00:00": dt.date(2024, 1, 1)}
    df = spark.createDataFrame([(k,) for k in dates], "x string")
    assert {r.x: r.d for r in df.select("x", casting.try_date(F.col("x")).alias("d")).collect()} == dates
    numbers = {"1e5": 1e5, ".5": 0.5, "1_000": 1000.0, " 7 ": 7.0, "12d": None, "0x1p3": None, "1,000": None, "$5": None, "": None}
    df = spark.createDataFrame([(k,) for k in numbers], "x string")
    assert {r.x: r.d for r in df.select("x", casting.try_double(F.col("x")).alias("d")).collect()} == numbers


def test_text_helpers(spark):
    df = spark.createDataFrame([("O'BRIEN MIAMI-DADE", "FL", "U.S. Dept. of  X!"), (None, "TX", "--"), ("ST. LOUIS", None, "é")], "n string, s string, a string")
    got = df.select(fields.county_label(F.col("n"), F.col("s")), fields.slug(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [("O'Brien Miami-Dade, FL", "u-s-dept-of-x"), ("TX", "unknown"), ("St. Louis", "unknown")]
    codes = spark.createDataFrame([(c,) for c in ("01001", "01000", "01999", "1001", "01001\n", None)], "c string")
    assert [r[0] for r in codes.select(fields.county_fips(F.col("c"))).collect()] == ["01001", None, None, None, None, None]


def reload_rows(spark, rows):
    schema = "contract_award_unique_key string, modification_number string, action_date date, federal_action_obligation double, transaction_number string, last_modified_date date"
    return spark.createDataFrame([(k, m, dt.date.fromisoformat(d), o, t, lm and dt.date.fromisoformat(lm)) for k, m, d, o, t, lm in rows], schema)


def test_republished_copies(spark):
    rows = [
        ("K1", "P1", "2026-01-05", 10.0, "old", "2026-02-01"),
        ("K1", "P1", "2026-01-05", 10.001, "copy", "2026-11-03"),
        ("K2", "P1", "2026-01-05", 10.0, "edited alone", "2026-11-03"),
        ("K3", "P1", "2026-01-05", 10.0, "old", "2026-02-01"),
        ("K3", "P1", "2026-01-05", 11.0, "other amount", "2026-11-03"),
        ("K4", "P1", "2026-01-05", 10.0, "old", "2026-02-01"),
        ("K4", "P1", "2026-01-05", 10.0, "outside the window", "2026-11-05"),
        ("K5", None, "2026-01-05", None, "null keys old", "2026-02-01"),
        ("K5", None, "2026-01-05", None, "null keys copy", "2026-11-02"),
        ("K6", "P1", "2026-01-05", 1.0, "null date", None),
    ]
    df = reload_rows(spark, rows)
    out = summary.without_republished(df)
    assert {r.transaction_number for r in out.collect()} == {r[4] for r in rows} - {"copy", "null keys copy"}
    assert summary.without_republished(out).count() == out.count()
    assert summary.reload_accounting(df, out).first().rows_dropped == 2


@pytest.mark.parametrize(
    ("old", "new", "bad"),
    [
        ((1000, ["a", "b"], "2025-01-01", "2025-12-31"), (1000, ["a", "b", "c"], "2025-01-01", "2025-12-31"), 0),
        ((1000, ["a"], "2025-01-01", "2025-12-31"), (951, ["a"], "2025-01-01", "2025-12-31"), 0),
        ((1000, ["a"], "2025-01-01", "2025-12-31"), (949, ["a"], "2025-01-01", "2025-12-31"), 1),
        ((1000, ["a", "b"], "2025-01-01", "2025-12-31"), (1000, ["a"], "2025-01-01", "2025-12-31"), 1),
        ((1000, ["a"], "2025-01-01", "2025-12-31"), (1000, ["a"], "2025-01-01", "2025-12-30"), 1),
        ((1000, ["a"], "2025-01-01", "2025-12-31"), (1000, ["a"], "2025-01-02", "2025-12-31"), 1),
        ((1000, ["a", "action_date"], "2025-01-01", "2025-12-31"), (1000, ["a"], None, None), 2),
        ((1000, ["a"], None, None), (1000, ["a"], "2025-01-01", "2025-12-31"), 0),
    ],
)
def test_replace_guard(spark, old, new, bad):
    day = lambda x: x and dt.date.fromisoformat(x)
    frames = [spark.createDataFrame([("k", n, c, day(lo), day(hi))], "key string, n_rows long, columns array<string>, min_date date, max_date date") for n, c, lo, hi in (old, new)]
    assert len(guards.compared(*frames, ["key"]).first().problems) == bad
    if bad:
        with pytest.raises(ValueError):
            guards.check_before_replace(*frames, ["key"])
    guards.check_before_replace(*frames, ["key"], allow=True)


def test_first_publication_passes(spark):
    empty = spark.createDataFrame([], "key string, n_rows long, columns array<string>, min_date date, max_date date")
    new = spark.createDataFrame([("k", 5, ["a"], None, None)], empty.schema)
    guards.check_before_replace(empty, new, ["key"])
    with pytest.raises(ValueError):
        guards.check_before_replace(new, empty, ["key"])


def test_listing_and_changes(spark):
    files = [("FY2024_097_Contracts_Full_20261006.zip", 1, '"e1"'), ("FY(All)_All_Assistance_Delta_20261015.zip", 2, "e2"), ("x.zip", 3, "e3"), ("FY2024_012_Contracts_Full_20260906.zip", 4, "e4"), ("FY2023_097_Contracts_Full_20261006.zip", 5, "e5")]
    parsed = manifest.parse_listing(spark.createDataFrame(files, "key string, size long, etag string"))
    got = {r.logical_id: (r.etag, r.kind, r.datestamp) for r in parsed.collect()}
    assert got["contracts/2024/097"] == ("e1", "Full", "20261006") and got["assistance/All/All"] == ("e2", "Delta", "20261015") and len(got) == 4
    known = spark.createDataFrame([("contracts/2024/097", "e1", 5), ("contracts/2023/097", None, 5)], "logical_id string, etag string, row_count long")
    assert [r.logical_id for r in manifest.changed(parsed, known).collect()] == ["contracts/2023/097"]
    after = manifest.upserted(known, spark.createDataFrame([("contracts/2023/097", "e5", 9), ("new", "e", 1)], known.schema))
    assert {r.logical_id: r.etag for r in after.collect()} == {"contracts/2024/097": "e1", "contracts/2023/097": "e5", "new": "e"}


def test_dictionary(spark):
    headers = spark.createDataFrame([(0, "Element"), (1, "Award File"), (2, "Award Element"), (3, "Award File"), (27, "Element")], "pos int, display string")
    assert [r.name for r in refdata.column_names(headers).orderBy("pos").collect()] == ["Element", "Award File", "Award Element", "Award File (D)", "Element (AB)"]
    text = "A = ALPHA\r\n  B  =  BETA = 2 \nC=GAMMA\nD = \nE=F=G\nSee a longer = line of prose\nAVERYLONGCODE1234 = x\n= none"
    book = refdata.codebook(spark.createDataFrame([("", "col", "Contracts and Assistance", text)], "award_element string, element string, award_file string, domain_values string"))
    assert [(r["column"], r.code, r.label, r.applies_to) for r in book.collect()] == [("col", "A", "ALPHA", "both"), ("col", "B", "BETA = 2", "both"), ("col", "C", "GAMMA", "both")]


def test_csv_landing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,action_date,total_dollars_x\n"x ""q""\nline",2024-01-05,"1,0"\ny,,2.5\n')
    (tmp_path / "b.csv").write_text("total_dollars_x,extra,name\n3,e,z\n")
    stats = archive.csv_to_parquet(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], str(tmp_path / "out"))
    rows = {r.name: (r.action_date, r.total_dollars_x, r.extra) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows == {'x "q"\nline': (dt.date(2024, 1, 5), None, None), "y": (None, 2.5, None), "z": (None, 3.0, "e")}
    assert stats["rows"] == 3 and stats["cols"] == 4 and stats["bytes"] > 0


def test_zip_landing(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("one.CSV", "a,b\n1,\n")
        z.writestr("deep/two.csv", "a\nx\n")
        z.writestr("no.txt", "n")
    (tmp_path / "f.zip").write_bytes(data.getvalue())
    members = archive.unzipped(spark, str(tmp_path))
    assert sorted(r.member for r in members.collect()) == ["deep/two.csv", "one.CSV"]
    assert sorted((r.member, r.record["a"]) for r in archive.csv_rows(members).collect()) == [("deep/two.csv", "x"), ("one.CSV", "1")]


def test_raw_layer(spark, tmp_path):
    root = str(tmp_path / "raw")
    df = spark.createDataFrame([("2024", "097", 1), ("2024", "012", 2), ("2024", "All", 1), ("2024", "All", 2), ("2023", "097", 3)], "fiscal_year string, agency string, x int")
    archive.write_raw(df, root)
    archive.write_raw(spark.createDataFrame([("2024", "012", 7, "n")], "fiscal_year string, agency string, x int, y string"), root)
    assert sorted((r.fiscal_year, r.agency, r.x) for r in archive.read_raw(spark, root).collect()) == [("2023", "097", 3), ("2024", "012", 7), ("2024", "097", 1)]
    assert archive.read_raw(spark, root, "all").count() == 2 and archive.read_raw(spark, root, "prefer_all").count() == 3
    assert archive.read_raw(spark, root, fiscal_year="2023").count() == 1
    with pytest.raises(ValueError):
        archive.read_raw(spark, root, "both")
    with pytest.raises(ValueError):
        archive.read_serve(spark, root, "grants")


def test_snapshot_of_nothing_keeps_what_is_there(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([(1, ["a"])], "i int, l array<string>")
    archive.snapshot(df, target)
    with pytest.raises(ValueError):
        archive.snapshot(df.where("false"), target)
    assert spark.read.parquet(target).first().l == '["a"]'


def test_cube_rules(spark):
    rows = [("2024", "X", "s1", "CA", 5.0), ("2024", "X", "s1", "CA", None), (None, "X", "s1", "NY", 7.0), ("2025", "", None, None, 1.0)]
    df = spark.createDataFrame(rows, "action_date_fiscal_year string, awarding_agency_name string, awarding_sub_agency_name string, recipient_state_code string, federal_action_obligation double")
    assert {r.period: (r.obligations, r.transactions) for r in cubes.trend(df).collect()} == {"2024": (5.0, 2), "2025": (1.0, 1), "all": (13.0, 4)}
    assert {(r.period, r.label): r.obligations for r in cubes.breakdown(df, CONTRACTS, "state").collect()} == {("2024", "CA"): 5.0, ("all", "CA"): 5.0}
    by = {(r.agency, r.period, r.label): r.obligations for r in cubes.agency_breakdown(df, CONTRACTS, "state").collect()}
    assert by == {("X", "2024", "CA"): 5.0, ("X", "all", "CA"): 5.0, ("X", "all", "NY"): 7.0}
    nobody = df.withColumn("awarding_agency_name", F.lit(None).cast("string"))
    assert cubes.agency_breakdown(nobody, CONTRACTS, "state").count() == 0
    with pytest.raises(ValueError):
        cubes.agency_breakdown(df, CONTRACTS, "awarding_agency")
    kpis = {(r.slug, r.period): (r.obligations, r.transactions) for r in cubes.agency_kpis(df).collect()}
    assert kpis == {("x", "2024"): (5.0, 2), ("x", "2025"): (0.0, 0), ("x", "all"): (5.0, 2), ("unknown", "2024"): (0.0, 0), ("unknown", "2025"): (1.0, 1), ("unknown", "all"): (1.0, 1)}


def test_options_are_gated(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("a"), (F.col("id") % 3).cast("string").alias("b"), F.lit("r").alias("recipient_name"), F.lit(1.0).alias("federal_action_obligation"))
    assert {r.field for r in cubes.filter_options(df, ["a", "b", "recipient_name", "missing"], most=10).collect()} == {"b"}
    assert [tuple(r) for r in cubes.live_options(df, "nothing").collect()] == [(None, None, True)]
    coded = df.withColumn("awarding_sub_agency_code", F.col("b")).withColumn("awarding_sub_agency_name", F.when(F.col("b") != "1", F.concat(F.lit("Office "), "b")))
    labels = {r.value: r.label for r in cubes.filter_options(coded, ["awarding_sub_agency_code"]).collect()}
    assert labels == {"0": "Office 0 (0)", "1": "1", "2": "Office 2 (2)"}
    assert [tuple(r) for r in cubes.live_options(df, "a", most=10).collect()] == [(None, None, True)] and cubes.live_options(df, "b", most=10).count() == 3


def test_null_keys_join(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "g string, m int")
    b = spark.createDataFrame([(None, 5), ("y", 6)], "g string, n int")
    assert sorted(((r.g or "", r.m, r.n) for r in table.metric_join([a, b], ["g"]).collect())) == [("", 2, 5), ("x", 1, None), ("y", None, 6)]


def test_refresh_resumes(spark):
    files = spark.createDataFrame([("contracts/2024/001", "e1"), ("contracts/2024/002", "e2"), ("contracts/2024/003", "e3")], "logical_id string, etag string").withColumns({"kind": F.lit("Full"), "datestamp": F.lit("20261006")})
    known = spark.createDataFrame([("contracts/2024/003", "e3", "20260906", 7, 4)], "logical_id string, etag string, datestamp string, row_count long, parquet_bytes long")
    rows = spark.createDataFrame([("contracts/2024/001", 1), ("contracts/2024/001", 2), ("contracts/2024/003", 3)], "logical_id string, x int")
    new, after = refreshed(rows, files, known)
    assert sorted(r.x for r in new.collect()) == [1, 2]
    assert {(r.logical_id, r.etag, r.datestamp, r.row_count) for r in after.collect()} == {("contracts/2024/001", "e1", "20261006", 2), ("contracts/2024/003", "e3", "20260906", 7)}
    # what has not landed is taken up by the next call; a file without rows may be named
    _, again = refreshed(spark.createDataFrame([], rows.schema), files, after, landed=files.where("logical_id LIKE '%/002'"))
    assert {r.logical_id: r.row_count for r in again.collect()} == {"contracts/2024/001": 2, "contracts/2024/002": 0, "contracts/2024/003": 7}


def test_award_summary_sorts_once(spark, sf_dir):
    """Totals and the latest transaction share one exchange and one sort of the wide rows."""
    rows = [("A", "t1", None, "2026-01-01", 1.25), ("A", "t2", "2026-02-01", "2026-01-01", None), ("A", "t3", "2026-02-01", None, 2.0), ("B", "t4", None, None, -3.0), (None, "t5", "2026-01-01", None, 9.0)]
    df = spark.createDataFrame(rows, "contract_award_unique_key string, contract_transaction_unique_key string, action_date string, last_modified_date string, federal_action_obligation double")
    out = summary.award_summary(df, CONTRACTS)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
    got = sorted((r.contract_award_unique_key, r.contract_transaction_unique_key, r.award_obligated_total, r.award_transaction_count, r.award_first_action_date, r.award_latest_action_date) for r in out.collect())
    assert got == [("A", "t2", 3.25, 3, "2026-02-01", "2026-02-01"), ("B", "t4", -3.0, 1, None, None)]
