"""Publishing a day at once: staged tables, manifests, lineage of input files, and leases."""

import os
import time
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from test_golden_load import ACCT, DAY, PLACE, PLACEMENT, PLAIN, QUEUE, WORK, WORKFLOW, reasons, rows

from feedlake import daily_load
from feedlake.sinks import DayBusy, LeaseLost, Publication, UnknownLineage, publish, read_manifest
from feedlake.sinks.manifest import Lease

TABLES = [("ACT", ACCT), ("NOT", ACCT), (WORKFLOW, WORKFLOW), (PLACEMENT, PLACEMENT), (QUEUE, QUEUE)]


def accounts(landing, spark, recordtype, feed=None):
    folder = landing.root / "published" / recordtype / (feed or recordtype)
    if not list(folder.glob("snap_day=*")):
        return []
    return [r[0] for r in rows(landing.table(spark, recordtype, feed), "accountno")]


def everything(landing, spark):
    return {t: accounts(landing, spark, *t) for t in TABLES}


def away(landing, name):
    os.remove(landing.root / "first" / name)


def drop_day(landing, version):
    landing.markers(DAY)
    landing.drop(f"Act_{DAY}.pgp", PLAIN, f"ACT|a{version}||C", f"NOT|n{version}||hi")
    landing.drop(f"W_{DAY}.pgp", WORK, f"w{version}|20240110101500|S")
    landing.drop(f"P_{DAY}.pgp", PLACE, f"p{version}|20240110101500|1|2")
    landing.drop(f"{QUEUE}_{DAY}.pgp", f"{version}|q{version}|2024-01-10 00:00:00||ok")


def of_version(version):
    return dict(zip(TABLES, [[f"{c}{version}"] for c in "anwpq"], strict=True))


# --- all or nothing ------------------------------------------------------------------------


@pytest.mark.parametrize("broken", range(1, 6))
def test_a_run_that_fails_at_any_write_leaves_the_former_day(spark, landing, monkeypatch, broken):
    drop_day(landing, 1)
    daily_load(spark, landing.config())
    assert everything(landing, spark) == of_version(1)
    before = {p: p.stat().st_mtime_ns for p in (landing.root / "published").rglob("*.parquet")}
    drop_day(landing, 22)
    stage, count = Publication.stage, []

    def failing(self, df, *args, **named):
        count.append(1)
        if len(count) == broken:
            df = df.withColumn("snap_dt", F.raise_error(F.lit("disk is full")).cast("timestamp_ntz"))
        return stage(self, df, *args, **named)

    monkeypatch.setattr(Publication, "stage", failing)
    with pytest.raises(PySparkException, match="disk is full"):
        daily_load(spark, landing.config(parallel_tables=1))
    monkeypatch.undo()
    assert everything(landing, spark) == of_version(1)
    assert {p: p.stat().st_mtime_ns for p in (landing.root / "published").rglob("*.parquet")} == before
    assert not list((landing.root / "published.staged" / "2024-01-15").iterdir())
    daily_load(spark, landing.config())
    assert everything(landing, spark) == of_version(22)


def test_a_bad_amount_leaves_all_tables(spark, landing):
    drop_day(landing, 1)
    daily_load(spark, landing.config())
    drop_day(landing, 22)
    landing.drop(f"P_{DAY}.pgp", PLACE, "p22|20240110101500|1|abc")
    with pytest.raises(PySparkException, match="not a number: abc"):
        daily_load(spark, landing.config())
    assert everything(landing, spark) == of_version(1)


def test_a_bad_queue_date_leaves_all_tables(spark, landing):
    drop_day(landing, 1)
    daily_load(spark, landing.config())
    drop_day(landing, 22)
    landing.drop(f"{QUEUE}_{DAY}.pgp", "1|a|20240110||y", "2|a|2024-01-10 00:00:00||y")
    with pytest.raises(PySparkException, match="opendate: not a date"):
        daily_load(spark, landing.config())
    assert everything(landing, spark) == of_version(1)


@pytest.mark.parametrize("done", [0, 1, 3])
def test_a_run_that_dies_after_its_commit_is_finished_by_the_next(spark, landing, monkeypatch, done):
    """``done`` files were moved before it died."""
    drop_day(landing, 1)
    daily_load(spark, landing.config())
    drop_day(landing, 22)
    moved = []

    def dying(files, old, new):
        # notes of finished steps, which lie beside the ledger, are no published files
        if "/published/" in new and "manifest-" not in new:
            if len(moved) == done:
                raise KeyboardInterrupt
            moved.append(new)
        rename(files, old, new)

    from feedlake.sinks.files import Files

    rename = Files.rename
    monkeypatch.setattr(Files, "rename", dying)
    with pytest.raises(KeyboardInterrupt):
        daily_load(spark, landing.config())
    monkeypatch.undo()
    assert {(e.recordtype, e.feed): e.rows for e in read_manifest(spark, str(landing.root / "published"), DAY).entries} == dict.fromkeys(TABLES, 1)
    # the ledger knows nothing of it, so the files are loaded once more, on top of the finished version
    with Publication(spark, str(landing.root / "published"), DAY, "look"):
        assert everything(landing, spark) == of_version(22)
    daily_load(spark, landing.config())
    assert everything(landing, spark) == of_version(22)


def test_a_failed_version_of_a_published_table(spark, tmp_path):
    def version(value):
        return spark.range(3).select("id", value.alias("v"), F.lit("2024-01-15").cast("timestamp_ntz").alias("snap_dt"))

    target = str(tmp_path / "t")
    publish(version(F.lit(1)), target, DAY, "feed", "kind")
    with pytest.raises(PySparkException):
        publish(version(F.raise_error(F.lit("no")).cast("int")), target, DAY, "feed", "kind")
    assert rows(spark.read.parquet(f"{target}/kind/feed"), "id", "v") == [(0, 1), (1, 1), (2, 1)]
    assert publish(version(F.lit(2)), target, DAY, "feed", "kind") == {"published": 3, "held_back": 0}
    assert rows(spark.read.parquet(f"{target}/kind/feed"), "id", "v") == [(0, 2), (1, 2), (2, 2)]
    assert publish(version(F.lit(3)).limit(0), target, DAY, "feed", "kind") == {"published": 0, "held_back": 0}
    assert not list((tmp_path / "t" / "kind" / "feed").glob("snap_day=*"))


# --- lineage -------------------------------------------------------------------------------


def test_a_late_file_keeps_the_rows_of_files_that_have_left(spark, landing):
    landing.markers(DAY)
    landing.drop(f"A_{DAY}.pgp", PLAIN, "ACT|a1||C", "NOT|a1||hi")
    daily_load(spark, landing.config())
    away(landing, f"A_{DAY}.pgp")
    landing.drop(f"B_{DAY}.pgp", PLAIN, "ACT|b1||C")
    late = daily_load(spark, landing.config())
    assert (late.status, late.published, late.tables) == ("ok", 2, {f"ACT/{ACCT}": 2})
    assert accounts(landing, spark, "ACT", ACCT) == ["a1", "b1"] and accounts(landing, spark, "NOT", ACCT) == ["a1"]
    # a new version of the late file replaces its own rows only
    landing.drop(f"B_{DAY}.pgp", PLAIN, "ACT|b22||C", "NOT|b22||hi")
    daily_load(spark, landing.config())
    assert accounts(landing, spark, "ACT", ACCT) == ["a1", "b22"] and accounts(landing, spark, "NOT", ACCT) == ["a1", "b22"]
    sources = {(e.recordtype, os.path.basename(e.source)): e.rows for e in read_manifest(spark, str(landing.root / "published"), DAY).entries}
    assert sources == {(t, f"{f}_{DAY}.pgp"): 1 for t in ("ACT", "NOT") for f in "AB"}


def test_only_files_that_are_new_are_read(spark, landing):
    landing.markers(DAY)
    landing.drop(f"A_{DAY}.pgp", PLAIN, "ACT|a1||C")
    daily_load(spark, landing.config())
    part = next((landing.root / "published" / "ACT").rglob("*.parquet"))
    landing.drop(f"B_{DAY}.pgp", PLAIN, "ACT|b1||C")
    daily_load(spark, landing.config())
    assert part.exists() and accounts(landing, spark, "ACT", ACCT) == ["a1", "b1"]


@pytest.mark.parametrize("line", ["ZZZ|1", "|t|x"], ids=["unknown type", "no type"])
def test_a_corrected_file_loses_its_rows_whatever_else_is_unusable(spark, landing, line):
    landing.markers(DAY)
    landing.drop(f"A_{DAY}.pgp", PLAIN, "ACT|a1||C", "NOT|a1||hi")
    landing.drop(f"B_{DAY}.pgp", PLAIN, "NOT|b1||hi")
    daily_load(spark, landing.config())
    landing.drop(f"A_{DAY}.pgp", PLAIN, "ACT|a22||C", line)
    result = daily_load(spark, landing.config())
    assert result.rejected == 1 and accounts(landing, spark, "ACT", ACCT) == ["a22"]
    assert accounts(landing, spark, "NOT", ACCT) == ["b1"]


def test_a_rejected_group_does_not_keep_the_rows_of_the_former_version(spark, landing):
    landing.markers(DAY)
    landing.drop(f"A_{DAY}.pgp", PLAIN, "ACT|a1||C", "NOT|a1||hi")
    daily_load(spark, landing.config())
    landing.drop(f"A_{DAY}.pgp", PLAIN, "ACT|a22||C", "NOT|a22||hi|too|many")
    result = daily_load(spark, landing.config())
    assert reasons(result) == [("NOT", "NOT|a22||hi|too|many", "width")]
    assert accounts(landing, spark, "ACT", ACCT) == ["a22"] and accounts(landing, spark, "NOT", ACCT) == []


def test_a_file_that_changes_its_feed(spark, landing):
    landing.markers(DAY)
    landing.drop(f"A_{DAY}.pgp", PLAIN, "ACT|a1||C")
    daily_load(spark, landing.config())
    landing.drop(f"A_{DAY}.pgp", WORK, "w1|20240110101500|S")
    daily_load(spark, landing.config())
    assert accounts(landing, spark, "ACT", ACCT) == [] and accounts(landing, spark, WORKFLOW) == ["w1"]


def test_published_files_of_unknown_input_are_not_mixed_with(spark, landing):
    landing.markers(DAY)
    landing.drop(f"A_{DAY}.pgp", PLAIN, "ACT|a1||C")
    daily_load(spark, landing.config())
    control = landing.root / "published.manifest" / "2024-01-15"
    for path in control.iterdir():
        path.unlink()
    landing.drop(f"B_{DAY}.pgp", PLAIN, "ACT|b1||C")
    with pytest.raises(UnknownLineage, match="1 files"):
        daily_load(spark, landing.config())
    assert accounts(landing, spark, "ACT", ACCT) == ["a1"]
    daily_load(spark, landing.config(replace_unmanaged=True))
    assert accounts(landing, spark, "ACT", ACCT) == ["b1"]


# --- one writer ----------------------------------------------------------------------------


def test_of_two_loads_one_is_refused(spark, landing):
    drop_day(landing, 1)
    with Publication(spark, str(landing.root / "published"), DAY, "other"):
        with pytest.raises(DayBusy):
            daily_load(spark, landing.config())
        other_day = "20240116"
        landing.markers(other_day)
        landing.drop(f"Act_{other_day}.pgp", f"{ACCT}|x|{other_day}", "ACT|b1||C")
        assert daily_load(spark, landing.config(other_day)).published == 1  # another day is free
    assert daily_load(spark, landing.config()).published == 5


def test_a_stale_lease_can_be_taken_over(spark, landing):
    target = str(landing.root / "published")
    rows_of = spark.range(2).select("id", F.lit("2024-01-15").cast("timestamp_ntz").alias("snap_dt"))
    slow = Publication(spark, target, DAY, "slow")
    slow.__enter__()
    slow.stage(rows_of, "feed", "kind")
    time.sleep(0.05)
    with Publication(spark, target, DAY, "quick", stale_after=0.01) as quick:
        quick.stage(rows_of.where("id = 0"), "feed", "kind")
        quick.commit(tables=[("feed", "kind")])
        # the slow one wakes up while the other holds the day, and may not commit
        with pytest.raises(LeaseLost):
            slow.commit(tables=[("feed", "kind")])
        slow.__exit__(None, None, None)
        quick._lease.check()
    with pytest.raises(LeaseLost):
        slow._lease.check()
    assert rows(spark.read.parquet(f"{target}/kind/feed"), "id") == [(0,)]
    assert [p.name for p in Path(f"{target}.manifest/2024-01-15").glob("lease-*")] == []


def test_numbers_of_leases_grow(spark, tmp_path):
    from feedlake.sinks.files import Files

    target = str(tmp_path / "t")
    for number in (1, 2):
        with Publication(spark, target, DAY, f"r{number}") as publication:
            assert publication._lease.number == number
            publication.commit()
    files = Files(spark)
    lease = Lease(files, f"{target}.manifest/2024-01-15")
    files.create(f"{target}.manifest/2024-01-15/lease-00000009", "x")
    with pytest.raises(DayBusy):
        lease.take("mine")
    with pytest.raises(FileExistsError):
        files.create(f"{target}.manifest/2024-01-15/lease-00000009", "y")


# --- finished steps ------------------------------------------------------------------------


def test_a_failed_run_is_taken_up_after_its_bronze(spark, landing, monkeypatch):
    from feedlake.plans import ingest

    drop_day(landing, 1)
    landing.drop(f"P_{DAY}.pgp", PLACE, "p1|20240110101500|1|abc")
    with pytest.raises(PySparkException, match="not a number: abc"):
        daily_load(spark, landing.config())
    steps = landing.root / "ledger.steps" / DAY
    assert {p.name.split("-")[0] for p in steps.iterdir() if p.name[0] != "."} == {"bronze", "verdicts"}

    def scanned_again(*args, **named):
        raise AssertionError("the lines are read again")

    monkeypatch.setattr(ingest, "bronze_lines", scanned_again)
    monkeypatch.setattr(ingest, "judge_bronze", scanned_again)
    # how amounts are read does not matter to bronze
    result = daily_load(spark, landing.config(money_on_error="null"))
    assert (result.published, reasons(result)) == (5, [(PLACEMENT, "p1|20240110101500|1|abc", "amount")])
    assert everything(landing, spark) == of_version(1) and not steps.exists()


@pytest.mark.parametrize("change", ["file", "setting", "half a note"])
def test_other_inputs_do_not_take_up_a_step(spark, landing, change):
    landing.markers(DAY)
    landing.drop(f"AccountPlacementImportFile_{DAY}.pgp", PLACE, "p1|20240110101500|1|abc")
    with pytest.raises(PySparkException):
        daily_load(spark, landing.config())
    settings = {"money_on_error": "null"}
    if change == "file":
        landing.drop(f"AccountPlacementImportFile_{DAY}.pgp", PLACE, "p22|20240110101500|1|2")
    elif change == "setting":
        settings["repairs"] = [("p1", "p22")]
    else:
        for note in (landing.root / "ledger.steps" / DAY).glob("bronze*.json"):
            note.rename(f"{note}.new")
        landing.drop(f"AccountPlacementImportFile_{DAY}.pgp", PLACE, "p22|20240110101500|1|2")
    daily_load(spark, landing.config(**settings))
    assert accounts(landing, spark, PLACEMENT) == ["p22"]
