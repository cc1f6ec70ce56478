"""What a load could not read: lost dates and amounts by file and column, refused lines by reason."""

import pytest
from pyspark.errors import PySparkException
from test_golden_load import ACCT, DAY, PLACE, PLACEMENT, PLAIN

from feedlake import daily_load
from feedlake.operators import lost_amount, lost_lines, lost_values, summarise_losses

VALUES = "file string, recordtype string, column string, reason string, text string"


def found(losses):
    """Losses as ``{(file name, record type, column, reason): (lost, texts)}``."""
    rows = losses.collect()
    out = {(r.file.rsplit("/", 1)[-1], r.recordtype, r.column, r.reason): (r.lost, r.texts) for r in rows}
    assert len(out) == len(rows)
    return out


def summary(spark, rows, **named):
    made = summarise_losses(spark.createDataFrame([(*r[:1], "t", "c", "date", r[1]) for r in rows], VALUES), **named)
    return {r.file: (r.lost, r.texts) for r in made.collect()}


def test_summary_counts_all_and_shows_the_smallest_different_texts(spark):
    rows = [("a", str(n % 50)) for n in range(1000)] + [("b", "x"), ("b", "x"), ("b", "é")]
    assert summary(spark, rows) == {"a": (1000, ["0", "1", "10"]), "b": (3, ["x", "é"])}
    assert summary(spark, rows, shown=1) == {"a": (1000, ["0"]), "b": (3, ["x"])}


def test_summary_of_nulls_long_texts_and_nothing(spark):
    long = "9" * 100_000
    assert summary(spark, [(None, "q"), (None, None), ("n", None), ("l", long)]) == {
        None: (2, ["q"]),
        "n": (1, []),
        "l": (1, [long]),
    }
    assert summary(spark, []) == {}


def test_summary_is_the_same_however_rows_are_dealt(spark):
    rows = [("f", "t", "c", "date", str(n * 7919 % 1000)) for n in range(3000)]
    made = [summarise_losses(spark.createDataFrame(rows, VALUES).repartition(n)).collect() for n in (1, 13)]
    assert made[0] == made[1]


def test_values_of_a_row_are_told_apart_and_a_null_condition_is_none(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "1", "x"), (2, "y", None), (3, "z", "z"), (4, "  ", "4")], "id int, p string, q string")
    losses = [(c, "amount", lost_amount(F.col(c)), F.col(c)) for c in "pq"]
    losses.append(("p", "never", F.lit(None).cast("boolean"), F.col("p")))
    got = [tuple(r) for r in lost_values(rows, losses, ["id"]).orderBy("id", "column").collect()]
    assert got == [(1, "q", "amount", "x"), (2, "p", "amount", "y"), (3, "p", "amount", "z"), (3, "q", "amount", "z")]


def test_notes_on_loaded_lines_are_no_lost_lines(spark):
    rows = [("f", "t", "l1", "width"), ("f", "t", "l1", "width"), ("f", None, None, "bad_header"), ("f", "t", "l2", "amount")]
    got = found(lost_lines(spark.createDataFrame(rows, "file string, recordtype string, line string, reason string")))
    assert got == {("f", "t", None, "width"): (2, []), ("f", None, None, "bad_header"): (1, [])}


# --- loads ---------------------------------------------------------------------------------

STAMP = "20240110101500"


def drop_notes(landing):
    """One file whose dates are all long, one mixed, one all short."""
    landing.markers(DAY)
    landing.drop(f"Long_{DAY}.pgp", PLAIN, f"NOT|a1|{STAMP}|hi", "NOT|a2||hi")
    landing.drop(f"Mixed_{DAY}.pgp", PLAIN, f"NOT|b1|{STAMP}|hi", "NOT|b2|20240110|hi", "NOT|b3|soon|hi", "NOT|b4|soon|hi")
    landing.drop(f"Short_{DAY}.pgp", PLAIN, "NOT|c1|20240110|hi", "NOT|c2||hi")


@pytest.mark.parametrize(
    ("settings", "lost"),
    [
        ({}, {"Mixed": (3, [STAMP, "soon"])}),
        ({"date_scope": "row"}, {"Mixed": (2, ["soon"])}),
        ({"date_rule": "coerce"}, {"Mixed": (3, ["20240110", "soon"]), "Short": (1, ["20240110"])}),
    ],
)
def test_lost_dates_of_each_rule(spark, landing, settings, lost):
    drop_notes(landing)
    result = daily_load(spark, landing.config(**settings))
    assert found(result.losses) == {(f"{f}_{DAY}.pgp", "NOT", "notedate", "date"): v for f, v in lost.items()}
    nulls = landing.table(spark, "NOT", ACCT).where("notedate IS NULL").count()
    assert nulls == 2 + sum(count for count, _ in lost.values())


def test_a_clean_load_has_no_losses_and_needs_no_pass_for_them(spark, landing, monkeypatch):
    landing.markers(DAY)
    landing.drop(f"Long_{DAY}.pgp", PLAIN, f"NOT|a1|{STAMP}|hi")
    landing.drop(f"Short_{DAY}.pgp", PLAIN, "NOT|c1|20240110|hi")

    def no_pass(*_):
        raise AssertionError("nothing was lost")

    monkeypatch.setattr("feedlake.plans.ingest.table_losses", no_pass)
    assert daily_load(spark, landing.config()).losses is None


def test_lost_amounts_and_refused_lines(spark, landing):
    landing.markers(DAY)
    landing.drop(f"P_{DAY}.pgp", PLACE, "p1|20240101000000|ten|2", "p2|20240101000000| |$5", "p3|never|ten|1")
    landing.drop(f"A_{DAY}.pgp", PLAIN, f"NOT|a1|{STAMP}|hi|more|yet more", "XYZ|1", "XYZ|2")
    result = daily_load(spark, landing.config(money_on_error="null"))
    assert found(result.losses) == {
        (f"P_{DAY}.pgp", PLACEMENT, "creditline", "amount"): (2, ["ten"]),
        (f"P_{DAY}.pgp", PLACEMENT, "balance", "amount"): (1, ["$5"]),
        (f"P_{DAY}.pgp", PLACEMENT, "placementdate", "date"): (3, ["20240101000000", "never"]),
        (f"A_{DAY}.pgp", "NOT", None, "width"): (1, []),
        (f"A_{DAY}.pgp", "XYZ", None, "no_schema"): (2, []),
    }


def test_a_bad_amount_fails_before_anything_is_published(spark, landing):
    drop_notes(landing)
    daily_load(spark, landing.config())
    before = sorted(landing.table(spark, "NOT", ACCT).collect())
    landing.drop(f"Mixed_{DAY}.pgp", PLAIN, f"NOT|b9|{STAMP}|hi")
    landing.drop(f"P_{DAY}.pgp", PLACE, f"p1|{STAMP}|ten|2")
    with pytest.raises(PySparkException):
        daily_load(spark, landing.config())
    assert sorted(landing.table(spark, "NOT", ACCT).collect()) == before
