"""How many files the bronze pass writes: by bytes of text, not by splits times record types."""

from test_golden_load import ACCT, DAY, PLAIN

from feedlake import daily_load
from feedlake.plans.ingest import split_bytes
from feedlake.plans.steps import Steps

MB = 1 << 20


def test_splits_grow_with_record_types_while_all_cores_have_work():
    assert split_bytes(10**14, 1, 128 * MB, 4000) == 128 * MB
    assert split_bytes(10**14, 10, 128 * MB, 4000) == 1280 * MB
    assert split_bytes(10**14, 50, 128 * MB, 4000) == 2048 * MB
    # little text, or many cores: splits stay as they are
    assert split_bytes(10**9, 10, 128 * MB, 4000) == 128 * MB
    assert split_bytes(0, 0, 128 * MB, 0) == 128 * MB
    assert split_bytes(300 * MB, 10, 16 * MB, 4) == 25 * MB
    # a session's own splits are never made smaller
    assert split_bytes(10**14, 10, 4096 * MB, 4) == 4096 * MB


def test_fewer_bronze_files_and_the_same_rows(spark, landing, monkeypatch):
    landing.markers(DAY)
    lines = [f"{('ACT', 'NOT', '01')[n % 3]}|{n}||{'x' * 100}" for n in range(60_000)]
    lines = [line.replace("||", "|") if line.startswith("01") else line for line in lines]
    landing.drop(f"Act_{DAY}.pgp", PLAIN, *lines)
    monkeypatch.setattr(Steps, "clear", lambda self: None)
    name, least = "spark.sql.files.maxPartitionBytes", 64 << 10
    before = spark.conf.get(name)
    spark.conf.set(name, str(least))
    try:
        result = daily_load(spark, landing.config())
        # the caller's session keeps its splits
        assert spark.conf.get(name) == str(least)
    finally:
        spark.conf.set(name, before)
    assert result.tables == {f"{kind}/{ACCT}": 20_000 for kind in ("ACT", "NOT", "01")}
    size = (landing.root / "first" / f"Act_{DAY}.pgp").stat().st_size
    files = list(landing.root.glob(f"ledger.steps/{DAY}/bronze-*/**/*.parquet"))
    # at the session's own splits there would be three files for each 64 KB
    assert 0 < len(files) <= size // least + 6
    got = sorted(int(r.accountno) for kind in ("ACT", "NOT", "01") for r in landing.table(spark, kind, ACCT).select("accountno").collect())
    assert got == list(range(60_000))
