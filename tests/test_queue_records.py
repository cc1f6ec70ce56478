"""Quoted records over lines and splits, and types inferred from texts."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from test_golden_load import DAY, QUEUE, rows

from feedlake import daily_load
from feedlake.sources import scan_delimited
from feedlake.sources.inference import least_type, state
from feedlake.sources.records import has_breaks, quoted_records
from feedlake.sources.scan import OVERFLOW

PIECES = ["a", "b c", "|", '"', '""', "\n", "\n\n", "é", "5\" pipe", "x" * 30, " "]


def split_at(spark, size):
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.set(f"spark.sql.files.{name}", str(size))


@pytest.fixture(params=[7, 40, 300, 1 << 20])
def splits(spark, request):
    split_at(spark, request.param)
    yield request.param
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


def test_records_at_any_split_size(spark, tmp_path, splits):
    rng = random.Random(4)
    want = []
    for n in range(3):
        table = [[f"{n}-{k}", *("".join(rng.choices(PIECES, k=rng.randint(0, 4))) for _ in range(3))] for k in range(40)]
        text = io.StringIO()
        writer = csv.writer(text, delimiter="|", lineterminator="\n")
        for k, row in enumerate(table):
            if k % 9 == 0:
                text.write(f'stray {n}|5" pipe|a "b" c|"q"\n\n')
                want.append((f"stray {n}", '5" pipe', 'a "b" c', "q"))
            writer.writerow(row)
            want.append(tuple(row))
        (tmp_path / f"f {n}.pgp").write_text(text.getvalue())
    assert has_breaks(spark, str(tmp_path))
    got = scan_delimited(spark, str(tmp_path), ["k", "x", "y", "z"])
    assert got.where(F.col(OVERFLOW).isNotNull()).isEmpty()
    # empty and missing fields are alike here, and the parser trims nothing
    assert sorted(tuple(v or "" for v in r) for r in got.select("k", "x", "y", "z").collect()) == sorted(want)
    assert {r.file_name for r in got.select("file_name").distinct().collect()} == {f"f {n}.pgp" for n in range(3)}


def test_one_record_over_many_splits(spark, tmp_path, splits):
    long = "\n".join(f"line {k} | of a note" for k in range(60))
    (tmp_path / "q.pgp").write_text(f'1|"{long}"|end\n2|short|end\n3|"{long}"\n4|x|"never closed\nat all\n')
    got = {r.value for r in quoted_records(spark, str(tmp_path)).select("value").collect()}
    assert got == {f'1|"{long}"|end', "2|short|end", f'3|"{long}"', '4|x|"never closed\nat all'}


def test_without_breaks_no_line_is_joined(spark, tmp_path):
    (tmp_path / "q.pgp").write_text('1|"a|b"|5" x\n\n2|"c ""d"""|""\n')
    assert not has_breaks(spark, str(tmp_path))
    got = scan_delimited(spark, str(tmp_path), ["k", "x", "y"])
    assert rows(got, "k", "x", "y") == [("1", "a|b", '5" x'), ("2", 'c "d"', None)]
    with pytest.raises(ValueError):
        has_breaks(spark, str(tmp_path), "||")


def test_long_lines_do_not_overflow(spark, tmp_path):
    line = "|".join(['"a ""b"" c"'] * 20_000)
    (tmp_path / "q.pgp").write_text(f'{line}|"open\nclosed"|{line}\n')
    (record,) = quoted_records(spark, str(tmp_path)).collect()
    assert record.value == f'{line}|"open\nclosed"|{line}'


def test_a_typed_queue_with_breaks_is_loaded(spark, landing):
    landing.markers(DAY)
    landing.drop(f"{QUEUE}_{DAY}.pgp", '1|a1|2024-01-10 00:00:00||"two', 'lines"', "2|a2|2024-01-10 00:00:00||one", '3|a3|2024-01-10 00:00:00||"x|', 'y"|extra')
    result = daily_load(spark, landing.config())
    assert (result.published, result.rejected) == (2, 1)
    assert rows(landing.table(spark, QUEUE), "queueid", "note") == [(1, "two\nlines"), (2, "one")]


INFERRED = [
    (["1", "2", None], "bigint"),
    (["1", "2.5"], "double"),
    (["-7", " 8 ", "+9"], "bigint"),
    ([".5", "1e3", "-inf"], "double"),
    ([None, None], "double"),
    (["1", "x"], "string"),
    (["99999999999999999999"], "string"),
    (["1d"], "string"),
    ([""], "string"),
    (["2024-01-10 00:00:00", None], "timestamp_ntz"),
    (["2024-01-10 00:00:00", "1"], "string"),
    (["2024-13-10 00:00:00"], "string"),
]


@pytest.mark.parametrize(("texts", "wanted"), INFERRED)
def test_least_types(spark, texts, wanted):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parts = [r.s for r in df.withColumn("n", F.monotonically_increasing_id()).groupBy("n").agg(state(F.col("t"), True).alias("s")).collect()]
    whole = df.agg(state(F.col("t"), True).alias("s")).first().s
    assert least_type(parts) == least_type([whole]) == wanted


def test_types_of_a_queue_are_inferred_on_request(spark, landing):
    landing.markers(DAY)
    landing.drop(f"{QUEUE}_{DAY}.pgp", "1|7|2024-01-10 00:00:00||1.5", "2|NaN|2024-01-10 00:00:00||2")
    daily_load(spark, landing.config(infer_queue_types=True))
    table = landing.table(spark, QUEUE)
    assert rows(table, "queueid", "accountno", "lastupdatedate", "note") == [(1, 7, None, 1.5), (2, None, None, 2.0)]
    assert dict(table.dtypes)["accountno"] == "bigint" and dict(table.dtypes)["note"] == "double"
