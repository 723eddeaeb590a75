"""Slices in several files: commits, replays, crashes between staging and commit, newer and older cycles."""

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import files, slices
from ledgerline.streaming.refresh import stream_refresh

SCHEMA = "action_date string, federal_action_obligation string, id string"


def land(folder, name, rows):
    (folder / name).parent.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("action_date,federal_action_obligation,id\n" + "".join(f"{d},{x},{i}\n" for d, x, i in rows))


def ids(spark, root):
    return sorted((r.fiscal_year, r.agency, r.id) for r in slices.read_live(spark, str(root)).collect())


def test_files_of_a_cycle_add_up_and_a_newer_cycle_replaces(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "raw")
    take = lambda point="a": stream_refresh(spark, str(folder), SCHEMA, root, str(tmp_path / point))
    land(folder, "FY2024_097_Contracts_Full_20261006/FY2024_097_Contracts_Full_20261006_1.csv", [("2024-01-02", 5, "k1")])
    take()
    land(folder, "FY2024_097_Contracts_Full_20261006/FY2024_097_Contracts_Full_20261006_2.csv", [("2024-01-03", 6, "k2")])
    land(folder, "FY(All)_012_Assistance_Full_20261006.csv", [("2020-01-03", 1, "k3")])
    land(folder, "FY2024_097_Contracts_Delta_20261106.csv", [("2024-01-03", 1, "delta")])
    take()
    assert ids(spark, root) == [("2024", "097", "k1"), ("2024", "097", "k2"), ("All", "012", "k3")]
    told = {r.logical_id: (r.row_count, r.datestamp) for r in slices.manifest(spark, root).collect()}
    assert told == {"contracts/2024/097": (2, "20261006"), "assistance/All/012": (1, "20261006")}
    before = sorted(str(p) for p in (tmp_path / "raw").rglob("*.parquet"))
    take("b")  # another checkpoint: every file is read again
    assert sorted(str(p) for p in (tmp_path / "raw").rglob("*.parquet")) == before
    land(folder, "FY2024_097_Contracts_Full_20261106_1.csv", [("2024-01-02", 7, "k4")])
    land(folder, "FY2024_097_Contracts_Full_20260906_1.csv", [("2024-01-02", 7, "older")])
    take()
    assert ids(spark, root) == [("2024", "097", "k4"), ("All", "012", "k3")]
    assert slices.replaced(spark, root) == 3
    assert ids(spark, root) == [("2024", "097", "k4"), ("All", "012", "k3")]
    row = slices.read_live(spark, root).where("id = 'k4'").first()
    assert row.federal_action_obligation == 7.0 and str(row.action_date) == "2024-01-02" and row.product == "contracts"


def staged(spark, name, values):
    rows = spark.createDataFrame([(v,) for v in values], "id string").withColumns(slices.slice_columns(F.lit(name)))
    return rows.drop("kind")


def test_a_crash_before_the_commit_shows_nothing_and_is_repaired(spark, tmp_path):
    root, name = str(tmp_path / "raw"), "x/FY2024_097_Contracts_Full_20261006_1.csv"
    slices.stage(staged(spark, name, ["half"]), root)
    assert ids(spark, root) == [] and slices.manifest(spark, root).count() == 0
    slices.stage(staged(spark, name, ["k1", "k2"]), root)
    listing = spark.createDataFrame([("contracts/2024/097", "20261006", "e1"), ("contracts/2024/097", "20261106", "e2")], "logical_id string, datestamp string, etag string")
    assert slices.commit(spark, root, listing) == 1 and slices.commit(spark, root, listing) == 0
    assert [r[2] for r in ids(spark, root)] == ["k1", "k2"]
    slices.stage(staged(spark, name, ["other"]), root)
    assert [r[2] for r in ids(spark, root)] == ["k1", "k2"]
    one = slices.manifest(spark, root).first()
    assert one.etag == "e1" and one.row_count == 2 and one.parquet_bytes > 0 and one.parquet_key == "contracts/fiscal_year=2024/agency=097"


def test_a_path_without_a_slice_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="no slice in the path"):
        staged(spark, "somewhere/part-0.csv", ["x"]).collect()
    assert slices.commit(spark, str(tmp_path / "none")) == 0 and slices.entries(spark, str(tmp_path / "none")).count() == 0


def test_folders(spark, tmp_path):
    a, b = str(tmp_path / "a/x"), str(tmp_path / "b/y")
    (tmp_path / "a/x/z").mkdir(parents=True)
    assert files.folders(spark, a) == ["z"] and files.folders(spark, b) == [] and not files.exists(spark, b)
    files.moved(spark, a, b)
    assert files.exists(spark, b) and not files.exists(spark, a)
    (tmp_path / "a/x").mkdir()
    with pytest.raises(OSError):
        files.moved(spark, a, b)
    files.removed(spark, b)
    files.removed(spark, b)
    assert not files.exists(spark, b)
