"""End-to-end loads of small hand-written feeds."""

import json
from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import Landing
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedlake import daily_load
from feedlake.operators import WidthError
from feedlake.plans.handoff import shared_folder
from feedlake.plans.ingest import IncompleteArrival, RejectedRows
from feedlake.sinks import Ledger

DAY = "20240115"
ACCT = "AcctActReturnFile"
AGENT = "AgentReturnFile"
WORKFLOW = "WorkflowReturnFile"
PLACEMENT = "AcctPlacementFile"
QUEUE = "QueueExport"

PLAIN = f"{ACCT}|x|{DAY}"
WORK = f"HDR|{WORKFLOW}|{DAY}093000"
PLACE = f"HDR|{PLACEMENT}|{DAY}093000"
SHORT, LONG = datetime(2024, 1, 10), datetime(2024, 1, 11, 10, 15)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def of(df, prefix, *cols):
    """Rows of one of the files; their account numbers start alike."""
    return rows(df.where(F.col("accountno").startswith(prefix)), "accountno", *cols)


def reasons(result):
    return rows(result.rejects, "recordtype", "line", "reason") if result.rejects else []


# --- one day with many files ---------------------------------------------------------------


@pytest.fixture(scope="module")
def day(spark, tmp_path_factory):
    """Landing folders and result of a day on which everything happens at once."""
    land = Landing(tmp_path_factory.mktemp("day"))
    land.markers(DAY)
    drop = land.drop
    act = (PLAIN, "ACT|a1|20240110101500|C1", "NOT|a1|20240111120000|hi", "ACT|a2||C2")
    drop("Act_20240115.pgp", *act)
    drop("Crlf_20240115.pgp", "", *(line.replace("|a", "|crlf") for line in act), "  ", end="\r\n")
    drop("Hdr_20240115_.pgp", f"HDR|{ACCT}|{DAY}093000", "ACT|h1|20240110101500|C1", source="second")
    drop("Types_20240115.pgp", PLAIN, "01|t1|x", "|t2|y", "ZZZ|1", "NOBODY", "act|t3||C9")
    drop("Header_20240115.pgp", f"{ACCT}|x|2024-01", "ACT|bad1||C1")
    drop("Unknown_20240115.pgp", f"Elsewhere|x|{DAY}", "ACT|bad2||C1")
    drop("Late_20240115.pgp", f"{ACCT}|x|20240114", "ACT|late1||C9")
    drop("Empty_20240115.pgp")

    drop("Named_20240115.pgp", WORK, "n1|20240110101500|S1", f"n2|20240110101500|{WORKFLOW}")
    drop("Padded_20240115.pgp", WORK, "p1|20240110101500|S1", "p2|20240110101500")
    drop("AllShort_20240115.pgp", WORK, "short1|20240110101500", "short2|20240110101500")
    drop("Wide_20240115.pgp", WORK, "wide1|20240110101500|S1|extra", "wide2|20240110101500|S2")
    drop(
        "AccountPlacementImportFile_20240115.pgp",
        WORK,
        '"u|@x.test"|20240110101500|S1',
        "u2|20240110101500|Shop | 店",
    )
    drop("Unrepaired_20240115.pgp", WORK, "v1|20240110101500|Shop , S1")

    drop("Extra_20240115.pgp", PLACE, "x1|20240110101500| 10.5 ||")
    drop("TwoExtra_20240115.pgp", PLACE, "xx1|20240110101500| 10.5 |||")
    drop("Dates1_20240115.pgp", PLACE, "d1|20240110|1|1", "d2|20240111101500|1|1")
    drop("Dates2_20240115.pgp", PLACE, "e1|20240111101500|1|1", "e2||1|1")

    drop(
        "QueueExport_20240115.pgp",
        "1|a1|2024-01-10 00:00:00|2024-01-12|ok",
        '2|"a|2"|2024-01-11 10:15:00||',
        "3|a3|2024-01-11 10:15:00|x|y|",
        "4|NaN||null",
    )
    drop("QueueExport_202401151.pgp", "5|NA|20240110|null|ok", "6|a6|NaN|x|N/A")
    config = land.config(repairs=[('"u|@x.test"', "u@x.test"), ("Shop | 店", "Shop , 店")])
    return land, daily_load(spark, config), config


ACT_COLS = ("actiondate", "actioncode", "snap_dt")
SNAP = datetime(2024, 1, 15)
ACT_1 = datetime(2024, 1, 10, 10, 15)


@pytest.mark.parametrize(("prefix"), ["a", "crlf"])
def test_plain_header(spark, day, prefix):
    table = day[0].table(spark, "ACT", ACCT)
    assert table.columns == ["recordtype", "accountno", *ACT_COLS, "snap_day"]
    assert of(table, prefix, *ACT_COLS) == [
        (f"{prefix}1", ACT_1, "C1", SNAP),
        (f"{prefix}2", None, "C2", SNAP),
    ]
    assert of(day[0].table(spark, "NOT", ACCT), prefix, "text") == [(f"{prefix}1", "hi")]


def test_hdr_header(spark, day):
    assert of(day[0].table(spark, "ACT", ACCT), "h", *ACT_COLS) == [("h1", ACT_1, "C1", SNAP)]


def test_record_type_text_is_kept(spark, day):
    assert rows(day[0].table(spark, "01", ACCT), "recordtype", "accountno", "code") == [
        ("01", "t1", "x")
    ]
    # the registry is looked up in lower case, the table is named as in the feed
    assert rows(day[0].table(spark, "act", ACCT), "recordtype", "accountno") == [("act", "t3")]


def test_rejects_say_why(day):
    assert reasons(day[1]) == sorted(
        [
            ("", "|t2|y", "no_schema"),
            ("ACT", "ACT|bad1||C1", "bad_header"),
            ("ACT", "ACT|bad2||C1", "no_schema"),
            ("HDR", f"HDR|{ACCT}|{DAY}093000", "no_schema"),
            ("NOBODY", "NOBODY", "no_schema"),
            ("ZZZ", "ZZZ|1", "no_schema"),
            (PLACEMENT, "xx1|20240110101500| 10.5 |||", "width"),
            (QUEUE, "3|a3|2024-01-11 10:15:00|x|y|", "width"),
            (WORKFLOW, "short1|20240110101500", "width"),
            (WORKFLOW, "short2|20240110101500", "width"),
            (WORKFLOW, "wide1|20240110101500|S1|extra", "width"),
            (WORKFLOW, "wide2|20240110101500|S2", "width"),
        ],
        key=str,
    )
    assert day[1].rejected == 12


def test_counts(spark, day):
    land, result, config = day
    assert result.status == "ok" and result.held_back == 1
    found = {
        f"{path.parent.name}/{path.name}": spark.read.parquet(str(path)).count()
        for path in Path(config.target).glob("*/*")
    }
    assert found == result.tables and sum(found.values()) == result.published
    ledger = Ledger(spark, config.ledger)
    assert rows(ledger.runs(), "status", "period", "record_count") == [
        ("ok", "2024-01-15", result.published)
    ]
    assert ledger.files().count() == 20


def test_body_naming_the_feed_is_dropped(spark, day):
    assert of(day[0].table(spark, WORKFLOW), "n", "step") == [("n1", "S1")]
    assert day[1].dropped == 1


def test_short_rows_are_padded_and_broken_groups_left_out(spark, day):
    table = day[0].table(spark, WORKFLOW)
    assert of(table, "p", "step") == [("p1", "S1"), ("p2", None)]
    assert of(table, "short") == of(table, "wide") == []


def test_literal_repair_before_splitting(spark, day):
    table = day[0].table(spark, WORKFLOW)
    assert of(table, "u", "step") == [("u2", "Shop , 店"), ("u@x.test", "S1")]
    assert of(table, "v", "step") == [("v1", "Shop , S1")]


def test_placement_takes_one_extra_field(spark, day):
    table = day[0].table(spark, PLACEMENT)
    assert of(table, "x", "creditline", "balance") == [("x1", 10.5, 0.0)]


def test_date_format_is_chosen_per_file(spark, day):
    table = day[0].table(spark, PLACEMENT)
    assert of(table, "d", "placementdate") == [("d1", SHORT), ("d2", None)]
    assert of(table, "e", "placementdate") == [("e1", LONG), ("e2", None)]


def test_queue(spark, day):
    table = day[0].table(spark, QUEUE)
    cols = ("recordtype", "queueid", "accountno", "opendate", "lastupdatedate", "note", "snap_dt")
    assert table.columns == [*cols, "snap_day"]
    assert rows(table, *cols) == [
        (QUEUE, 1, "a1", SHORT, "2024-01-12", "ok", SNAP),
        (QUEUE, 2, "a|2", LONG, None, None, SNAP),
        (QUEUE, 4, None, None, None, None, SNAP),
        (QUEUE, 5, None, SHORT, None, "ok", SNAP),
        (QUEUE, 6, "a6", None, "x", None, SNAP),
    ]


def test_timestamps_are_int96(day):
    (part, *_) = Path(day[2].target, "ACT", ACCT).rglob("*.parquet")
    schema = pq.ParquetFile(part).schema
    kinds = {schema.column(i).name: schema.column(i).physical_type for i in range(len(schema))}
    assert kinds["snap_dt"] == kinds["actiondate"] == "INT96"


# --- options -------------------------------------------------------------------------------


def test_lenient_options(spark, landing):
    landing.markers(DAY)
    landing.drop("Work_20240115.pgp", WORK, "n1|20240110101500|S1", f"n2|20240110101500|{WORKFLOW}")
    landing.drop("Trim_20240115.pgp", f"  {PLAIN} ", "  ACT|a1||C1  ")
    landing.drop("P_20240115.pgp", PLACE, "d1|20240110|1|abc", "d2|20240111101500|2|3")
    config = landing.config(
        anchored_headers=True, trim_lines=True, date_scope="row", money_on_error="null"
    )
    result = daily_load(spark, config)
    assert of(landing.table(spark, WORKFLOW), "n", "step") == [("n1", "S1"), ("n2", WORKFLOW)]
    assert of(landing.table(spark, "ACT", ACCT), "a", "actioncode") == [("a1", "C1")]
    assert of(landing.table(spark, PLACEMENT), "d", "placementdate", "balance") == [
        ("d1", SHORT, 0.0),
        ("d2", LONG, 3.0),
    ]
    assert reasons(result) == [(PLACEMENT, "d1|20240110|1|abc", "amount")]


def test_one_date_format_only(spark, landing):
    landing.markers(DAY)
    landing.drop("P_20240115.pgp", PLACE, "d1|20240110|1|1", "d2|20240111101500|2|3")
    daily_load(spark, landing.config(date_rule="coerce"))
    assert of(landing.table(spark, PLACEMENT), "d", "placementdate") == [("d1", None), ("d2", LONG)]


# --- failures ------------------------------------------------------------------------------


def failed_run(spark, config):
    (run,) = Ledger(spark, config.ledger).runs().collect()
    assert (run.status, run.period, run.record_count) == ("failed", "2024-01-15", None)
    assert Ledger(spark, config.ledger).files().isEmpty()
    return run.message


@pytest.mark.parametrize(
    ("name", "lines", "error", "message"),
    [
        ("Act_20240115.pgp", [PLAIN, "ZZZ|1"], RejectedRows, "1 lines"),
        ("W_20240115.pgp", [WORK, "a1|20240110101500|S1|extra"], WidthError, WORKFLOW),
        ("P_20240115.pgp", [PLACE, "a1||1|abc"], PySparkException, "not a number: abc"),
        (
            "QueueExport_20240115.pgp",
            ["1|a|20240110|x|y", "2|a|2024-01-10 00:00:00|x|y"],
            PySparkException,
            "opendate: not a date",
        ),
    ],
    ids=["unusable line", "width", "amount", "mixed queue dates"],
)
def test_nothing_is_tolerated(spark, landing, name, lines, error, message):
    landing.markers(DAY)
    landing.drop(name, *lines)
    config = landing.config(fail_fast=True)
    with pytest.raises(error, match=message):
        daily_load(spark, config)
    assert message in failed_run(spark, config)


def test_incomplete_day(spark, landing):
    landing.drop("Act_20240115.pgp", PLAIN, "ACT|a1||C1")
    landing.markers(DAY, 5)
    config = landing.config()
    with pytest.raises(IncompleteArrival):
        daily_load(spark, config)
    assert "5 markers and 1 of 6 payloads" in failed_run(spark, config)


# --- repeated runs -------------------------------------------------------------------------


def test_days_are_replaced_whole_and_one_by_one(spark, landing):
    def run(day, name, *body):
        landing.drop(f"{name}_{day}.pgp", f"{ACCT}|x|{day}", *body)
        landing.markers(day)
        return daily_load(spark, landing.config(day))

    def published():
        table = landing.table(spark, "ACT", ACCT)
        return rows(table, F.date_format("snap_dt", "yyyyMMdd"), "accountno")

    run("20240115", "Act", "ACT|a1||C1", "ACT|a2||C2")
    run("20240116", "Act", "ACT|b1||C1")
    # a changed file replaces its day, another day stays
    run("20240115", "Act", "ACT|a3||C3333")
    assert published() == [("20240115", "a3"), ("20240116", "b1")]
    # a late file brings in the other files of its day again
    run("20240115", "Late", "ACT|a4||C4")
    assert published() == [("20240115", "a3"), ("20240115", "a4"), ("20240116", "b1")]
    again = daily_load(spark, landing.config("20240115"))
    assert (again.status, again.published) == ("nothing_pending", 0)


def test_split_files_give_the_same_tables(spark, landing, tmp_path):
    body = [f"ACT|a{i}|202401{i % 28 + 1:02d}101500|C{i}" for i in range(20_000)]
    landing.drop("Act_20240115.pgp", PLAIN, *body)
    landing.markers(DAY)

    def table(label):
        config = landing.config(target=str(tmp_path / label), ledger=str(tmp_path / f"{label}-runs"))
        assert daily_load(spark, config).published == 20_000
        return spark.read.parquet(f"{config.target}/ACT/{ACCT}")

    whole = table("whole")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
    try:
        split = table("split")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert whole.exceptAll(split).isEmpty() and split.exceptAll(whole).isEmpty()


def test_lenient_load_of_clean_amounts_has_no_rejects(spark, landing):
    landing.markers(DAY)
    landing.drop("P_20240115.pgp", PLACE, "d1|20240110101500|1|", "d2|20240111101500|2|3")
    result = daily_load(spark, landing.config(money_on_error="null"))
    assert (result.published, result.rejected, result.rejects) == (2, 0, None)


ODD_NAMES = ["A 1", "A%20", "A[1]", "A{1}", "A*", "Añ+b", "A?"]


def test_file_names_of_any_characters(spark, landing):
    """On the first run, and for files that come late."""
    landing.markers(DAY)
    landing.drop(f"Act_{DAY}.pgp", PLAIN, "ACT|first||C")
    for k, name in enumerate(ODD_NAMES[:4]):
        landing.drop(f"{name}_{DAY}.pgp", PLAIN, f"ACT|a{k}||C")
    assert daily_load(spark, landing.config()).published == 5
    for k, name in enumerate(ODD_NAMES[4:]):
        landing.drop(f"{name}_{DAY}.pgp", PLAIN, f"ACT|b{k}||C")
    late = daily_load(spark, landing.config())
    assert (late.published, late.rejected) == (8, 0)
    assert landing.table(spark, "ACT", ACCT).count() == 8
    assert daily_load(spark, landing.config()).status == "nothing_pending"


def test_a_mended_registry_brings_rejected_lines_back(spark, landing):
    landing.markers(DAY)
    landing.drop(f"Act_{DAY}.pgp", PLAIN, "ACT|a1||C1", "NEW|n1|x")
    landing.drop(f"{QUEUE}_{DAY}.pgp", "1|a1|2024-01-10 00:00:00||ok")
    whole = json.loads((landing.root / "registry.json").read_text())
    lacking = {k: v for k, v in whole.items() if k != "queue_export"}
    (landing.root / "registry.json").write_text(json.dumps(lacking))
    first = daily_load(spark, landing.config())
    assert reasons(first) == [("NEW", "NEW|n1|x", "no_schema"), ("queue", "1|a1|2024-01-10 00:00:00||ok", "no_schema")] or first.rejected == 2
    (landing.root / "registry.json").write_text(json.dumps({**whole, "cmc_aar_new": ["accountno", "what"]}))
    second = daily_load(spark, landing.config())
    assert (second.status, second.rejected, second.published) == ("ok", 0, 3)
    assert landing.table(spark, "NEW", ACCT).count() == 1
    assert daily_load(spark, landing.config()).status == "nothing_pending"


def test_partial_files_can_be_accepted(spark, landing):
    landing.markers(DAY)
    landing.drop(f"Act_{DAY}.pgp", PLAIN, "ACT|a1||C1", "NEW|n1|x")
    config = landing.config(accept_partial=True)
    assert daily_load(spark, config).rejected == 1
    assert daily_load(spark, config).status == "nothing_pending"


def test_a_corrected_day_loses_what_it_no_longer_has(spark, landing):
    landing.markers(DAY)
    landing.drop(f"Act_{DAY}.pgp", PLAIN, "ACT|a1||C1", "NOT|a1||hi")
    daily_load(spark, landing.config())
    assert landing.table(spark, "NOT", ACCT).count() == 1
    landing.drop(f"Act_{DAY}.pgp", PLAIN, "ACT|a1||C1", "ACT|a2||C2")
    daily_load(spark, landing.config())
    assert landing.table(spark, "ACT", ACCT).count() == 2
    assert not list((landing.root / "published" / "NOT" / ACCT).glob("snap_day=*"))


def test_a_load_leaves_only_its_rejects(spark, landing, tmp_path):
    landing.markers(DAY)
    landing.drop(f"Act_{DAY}.pgp", PLAIN, "ACT|a1||C1", "NEW|n1|x")
    before = set(Path(shared_folder(spark)).iterdir())
    result = daily_load(spark, landing.config(work=str(tmp_path / "work")))
    assert reasons(result) == [("NEW", "NEW|n1|x", "no_schema")]
    assert [p.name for p in (tmp_path / "work").iterdir()] == ["rejects"]
    left = {p.name.split("-")[0] for p in set(Path(shared_folder(spark)).iterdir()) - before}
    assert "handoff" not in left
