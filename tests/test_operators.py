"""Operators on small frames, where the probes do not reach."""

import time

from datetime import datetime

import pytest
from conftest import GOLDEN_REGISTRY
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedlake.functions import is_number, name_date, repair_literals, width
from feedlake.functions.dates import parse_date, parses
from feedlake.operators import (
    WidthError,
    completeness,
    feed_details,
    feed_header,
    first_lines,
    parse_dates_column,
    parse_doubles,
    tag_lines,
    width_guard,
)
from feedlake.plans import handoff, ingest
from feedlake.plans.handoff import from_driver, shared_folder, written
from feedlake.sources import discover, scan, scan_lines, sniff_first_lines
from feedlake.sources.registry import registry_entries

PLAIN_HEADER = "AcctActReturnFile|x|20240115"


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def values(df, expression):
    return [row[0] for row in df.select(expression).collect()]


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("Q_20240115.pgp", datetime(2024, 1, 15)),
        ("Q_20240115_.pgp", datetime(2024, 1, 15)),
        ("Q_202401151.pgp", datetime(2024, 1, 15)),
        ("Q_20241315.pgp", None),
        ("Q_20240115.txt", None),
        ("Q.pgp", None),
    ],
)
def test_date_in_a_file_name(spark, name, expected):
    assert values(column(spark, [name]), name_date(F.col("v"))) == [expected]


def test_date_check_agrees_with_the_parser(spark):
    stamps = [
        f"{year}{rest}"
        for year in ("0000", "0999", "1999", "2024", "9999")
        for rest in (
            "0228235959", "0229000000", "0230000000", "0431000000", "0430000000", "1231235959",
            "1301000000", "0001000000", "0100000000", "0101240000", "0101006000", "0101000060",
            "010100000", "01010000000", "0101 00000", "",
        )
    ]
    longs = ["2024-02-29 10:15:00", "2023-02-29 10:15:00", "2024-2-9 10:15:00", "2024-01-01T00:00:00"]
    for pattern in ("yyyyMMddHHmmss", "yyyy-MM-dd HH:mm:ss", "yyyyMMdd"):
        df = column(spark, [*stamps, *longs, "20240229", "20230229", "abc", "20240101101500\n"])
        differing = df.where(
            parses(F.col("v"), pattern) != parse_date(F.col("v"), pattern).isNotNull()
        )
        assert differing.collect() == []
    assert values(column(spark, ["", None]), parses(F.col("v"), "yyyyMMdd")) == [True, True]


def test_numbers(spark):
    good = ["1", "-1.5", "+2e3", ".5", "inf", "-inf", "nan", " 7 ", "\t8", "", None]
    bad = ["10d", "1.5F", "0x1p3", "$1", "1,000", "abc", "1 2"]
    assert values(column(spark, good), is_number(F.col("v"))) == [True] * len(good)
    assert values(column(spark, bad), is_number(F.col("v"))) == [False] * len(bad)
    with pytest.raises(PySparkException, match="v: not a number: 10d"):
        parse_doubles(column(spark, ["10d"]), ["v"]).collect()


def test_widths(spark):
    df = column(spark, ["", "a", "a|", "|", "a|b|c", None])
    assert values(df, width(F.col("v"))) == [1, 1, 2, 2, 3, 1]


def test_repairs_keep_their_order(spark):
    pairs = [("a|b", "ab"), ("ab", "X"), (".", "dot")]
    assert values(column(spark, ["a|b.c"]), repair_literals(F.col("v"), pairs)) == ["Xdotc"]


@pytest.mark.parametrize(
    ("markers", "first", "second", "status", "strict"),
    [
        (6, 1, 0, "ok", "ok"),
        (5, 3, 3, "ok_without_markers", "incomplete"),
        (5, 2, 3, "incomplete", "incomplete"),
        (0, 2, 5, "ok_without_markers", "incomplete"),
        (0, 1, 5, "incomplete", "incomplete"),
        (0, 0, 0, "incomplete", "incomplete"),
    ],
)
def test_arrival_rule(spark, markers, first, second, status, strict):
    files = [("first", ".mrk")] * markers + [("first", ".pgp")] * first
    files = spark.createDataFrame(files + [("second", ".pgp")] * second, "source string, suffix string")
    assert completeness(files, "second").first().status == status
    assert completeness(files, "second", strict_markers=True).first().status == strict


def test_discovery_sees_empty_and_odd_files(spark, landing):
    landing.drop("A 1_20240115.pgp", "x")
    landing.drop("B_20240115_.pgp")
    landing.drop("B_20240115.mrk")
    landing.drop("C_20240116.pgp", "x")
    landing.drop("D_20240115.pgp", "x", source="second")
    found = discover(spark, landing.config().sources, "20240115", (".pgp", ".mrk"))
    got = {(r["source"], r["name"], r["suffix"], r["length"]) for r in found.collect()}
    assert got == {
        ("first", "A 1_20240115.pgp", ".pgp", 2),
        ("first", "B_20240115_.pgp", ".pgp", 0),
        ("first", "B_20240115.mrk", ".mrk", 0),
        ("second", "D_20240115.pgp", ".pgp", 2),
    }
    assert discover(spark, landing.config().sources, "20230101", ".pgp").count() == 0


@pytest.fixture
def many_lines(landing):
    """A file of many splits, one that starts with blank lines, and a blank one."""
    landing.drop("Long_20240115.pgp", "AcctActReturnFile|x|20240115", *(["ACT|a1||C1"] * 30_000))
    landing.drop("Gap_20240115.pgp", *([" "] * 300), "HDR|WorkflowReturnFile|20240115x", "a1||S1")
    landing.drop("Blank_20240115.pgp", "", " ")
    return landing


def test_both_ways_to_read_headers_agree(spark, many_lines):
    folder = str(many_lines.root / "first")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 << 10))
    try:
        scanned = first_lines(scan_lines(spark, folder)).collect()
        sniffed = sniff_first_lines(spark, folder).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(scanned) == sorted(sniffed)
    assert sorted(row.value for row in sniffed) == [
        "AcctActReturnFile|x|20240115",
        "HDR|WorkflowReturnFile|20240115x",
    ]


def test_header_read_does_not_grow_with_the_file(spark, landing):
    line = "ACT|a1||" + "C" * 90
    landing.drop("Small_20240115.pgp", PLAIN_HEADER, *([line] * 20_000))
    landing.drop("Large_20240115.pgp", PLAIN_HEADER, *([line] * 600_000))

    def seconds(name):
        start = time.perf_counter()
        assert sniff_first_lines(spark, [str(landing.root / "first" / name)]).first().value == PLAIN_HEADER
        return time.perf_counter() - start

    small = min(seconds("Small_20240115.pgp") for _ in range(4))
    large = min(seconds("Large_20240115.pgp") for _ in range(4))
    assert large < 3 * small + 0.2


def test_header_read_keeps_settings_made_at_run_time(spark):
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    try:
        session = scan._session_of_whole_files(spark)
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")
    assert session.conf.get("spark.sql.files.ignoreCorruptFiles") == "true"
    assert session.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_header_read_does_not_cut_files(spark, landing):
    landing.drop("Large_20240115.pgp", PLAIN_HEADER, *(["ACT|a1||" + "C" * 90] * 200_000))
    path = str(landing.root / "first" / "Large_20240115.pgp")
    assert scan_lines(spark, path).rdd.getNumPartitions() > 1
    assert scan_lines(scan._session_of_whole_files(spark), path).rdd.getNumPartitions() == 1


def test_header_read_takes_the_first_piece_of_a_cut_file(spark, many_lines, monkeypatch):
    many_lines.drop("Late_20240115.pgp", *([" "] * 3_000), "HDR|WorkflowReturnFile|20240115y", "a1||S1")
    folder = str(many_lines.root / "first")

    def last_pieces_first(session, paths, trim=False):
        lines = scan_lines(session, paths, trim)
        return lines.where("block_start > 0").unionByName(lines.where("block_start = 0"))

    monkeypatch.setattr(scan, "scan_lines", last_pieces_first)
    monkeypatch.setattr(scan, "_session_of_whole_files", lambda spark: spark)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        sniffed = sniff_first_lines(spark, folder).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # the first piece of the late one is blank
    assert sorted(row.value for row in sniffed) == [
        PLAIN_HEADER,
        "HDR|WorkflowReturnFile|20240115x",
        "HDR|WorkflowReturnFile|20240115y",
    ]


def test_registry_with_a_repeated_name_is_refused(spark):
    for names in (["a", "b", "a"], ["a", "A:bigint"]):
        registry = spark.createDataFrame([("k", names)], "key string, names array<string>")
        with pytest.raises(ValueError, match="more than once"):
            registry_entries(registry)


def test_line_pass_shuffles_nothing(spark, many_lines):
    config = many_lines.config()
    folder = str(many_lines.root / "first")
    headers = written(feed_details(feed_header(first_lines(scan_lines(spark, folder)))))
    schemas = {k: ingest.RecordSchema.of(k, v, ()) for k, v in GOLDEN_REGISTRY.items()}
    lines = ingest.bronze_lines(spark, [folder], headers, schemas, config)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_record_schemas_may_have_more_dates_than_a_word_has_bits(spark, landing):
    names = [f"date{n}" for n in range(70)]
    schemas = {"cmc_aar_many": ingest.RecordSchema.of("cmc_aar_many", names, ())}
    texts = ["20240111101500"] * 70
    texts[3] = texts[66] = "20240110"
    landing.drop("A_20240115.pgp", "AcctActReturnFile|x|20240115", "|".join(["MANY", *texts]))
    folder = str(landing.root / "first")
    headers = written(feed_details(feed_header(first_lines(scan_lines(spark, folder)))))
    lines = ingest.bronze_lines(spark, [folder], headers, schemas, landing.config())
    (row,) = lines.collect()
    assert (row.unfit_0, row.unfit_1) == (1 << 3, 1 << 66 - 63)
    root = landing.root / "work"
    bronze = ingest.write_bronze(lines, str(root / "bronze"))
    verdicts = ingest.judge_bronze(bronze, str(root / "verdicts"))
    (table,) = ingest.plan_day(verdicts, schemas, landing.config()).tables
    short = [name for name, fits in table.first_fits.items() if fits is False]
    assert short == ["date3", "date66"] and None not in table.first_fits.values()


def test_tagging_in_one_pass_keeps_the_line(spark):
    rows = [
        ("WorkflowReturnFile", 0, "a1|S1"),
        ("WorkflowReturnFile", 0, "HDR|WorkflowReturnFile|x"),
        ("AcctActReturnFile", 1, "ACT|a1"),
        ("AcctActReturnFile", 1, "AcctActReturnFile|x|y"),
        ("AcctActReturnFile", 1, "alone"),
    ]
    df = spark.createDataFrame(rows, "feed string, lead int, value string")
    got = {(r.recordtype, r.value) for r in tag_lines(df).collect()}
    assert got == {("WorkflowReturnFile", "a1|S1"), ("ACT", "ACT|a1"), ("alone", "alone")}


def test_groups_with_a_null_key_are_judged_too(spark):
    rows = [(None, "a|b|c"), (None, "a"), ("f", "a|b")]
    df = spark.createDataFrame(rows, "file string, custom string")
    accepted, rejected = width_guard(df, 2, by=["file"], mode="reject")
    assert [tuple(r) for r in accepted.collect()] == [("f", "a|b")]
    assert rejected.count() == 2
    with pytest.raises(WidthError, match="expected 2 fields"):
        width_guard(df, 2, by=["file"])
    dates = spark.createDataFrame([(None, "20240110"), ("f", "20240111101500")], "file string, date string")
    typed = parse_dates_column(dates, by=["file"])
    assert {r.date for r in typed.collect()} == {datetime(2024, 1, 10), datetime(2024, 1, 11, 10, 15)}


def test_large_lookup_tables_are_not_broadcast_blindly(spark):
    small = from_driver(spark, [("a",)], "key string")
    large = from_driver(spark, [("x" * 1_000,) for n in range(2_000)], "key string")
    hints = [df._jdf.queryExecution().logical().toString() for df in (small, large)]
    assert "Hint broadcast" in hints[0] and "Hint broadcast" not in hints[1]


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_cluster_takes_a_shared_folder_without_scheme(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert written(spark.range(3)).count() == 3


@pytest.mark.parametrize("master", ["spark://elsewhere:7077", "local-cluster[2,1,1024]"])
def test_cluster_without_checkpoint_folder_uses_the_warehouse(spark, monkeypatch, tmp_path, master):
    monkeypatch.setattr(spark.sparkContext, "master", master)
    monkeypatch.setattr(handoff, "_own_folders", {})
    kept = {name: spark.conf.get(name) for name in ("spark.checkpoint.dir", "spark.sql.warehouse.dir")}
    given = {"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": f"file:{tmp_path}/tables"}
    session = spark.newSession()
    monkeypatch.setattr(type(session.conf), "get", lambda conf, name, *default: given[name])
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    folder = shared_folder(session)
    assert folder.startswith(given["spark.sql.warehouse.dir"]) and shared_folder(session) == folder
    monkeypatch.setattr(handoff, "_own_folders", {})
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: kept["spark.checkpoint.dir"])
    assert shared_folder(session) == kept["spark.checkpoint.dir"]


def test_folder_that_loses_what_tasks_write_is_refused(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    monkeypatch.setattr(handoff, "_tried", set())
    read = type(spark.read)
    monkeypatch.setattr(read, "parquet", lambda reader, path: spark.createDataFrame([], "id long"))
    with pytest.raises(ValueError, match="not shared by all executors"):
        shared_folder(spark)


def test_later_passes_read_only_what_they_need(spark, landing):
    line = "ACT|a1|20240110101500|C1"
    landing.drop("A_20240115.pgp", "AcctActReturnFile|x|20240115", line, "NOT|a1|20240111120000|hi")
    landing.drop("B_20240115.pgp", "AcctActReturnFile|x|20240115", line)
    config = landing.config()
    folder = str(landing.root / "first")
    headers = written(feed_details(feed_header(first_lines(scan_lines(spark, folder)))))
    schemas = {
        k: ingest.RecordSchema.of(k, v, config.exclude_columns) for k, v in GOLDEN_REGISTRY.items()
    }
    work = landing.root / "work"
    lines = ingest.bronze_lines(spark, [folder], headers, schemas, config)
    bronze = ingest.write_bronze(lines, str(work / "bronze"))
    verdicts = ingest.judge_bronze(bronze, str(work / "verdicts"))
    tables = {t.recordtype: t for t in ingest.plan_day(verdicts, schemas, config).tables}
    assert tables["ACT"].first_fits == {"actiondate": True}

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    table = ingest.typed_table(bronze, verdicts, tables["ACT"], config)
    assert table.count() == 2
    text = plan(table)
    # one pruned folder, no join, no shuffle, and the fallback format is not even planned
    assert "part_type" in text.split("PartitionFilters:")[1].split("]")[0]
    assert "Join" not in text and "Exchange" not in text and "yyyyMMdd," not in text
    narrow = bronze.groupBy("file").agg(F.max("width"), F.bit_or("unfit_0"))
    assert "line:string" not in plan(narrow)
