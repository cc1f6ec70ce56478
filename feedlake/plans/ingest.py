"""The daily load, end to end.

Text is read once. That pass repairs, tags and strips the lines and writes them
as bronze, partitioned by feed, record type and day, together with what the
later steps must know about each line: its width and which of its date columns
do not match the first format. Reading those narrow columns back gives one
verdict per file and record type; after that each record type is one pruned
read of bronze and one write. Nothing but the lines of a broken group or of a
mixed date column is ever joined, and no line is shuffled on the way.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake.constants import (
    ENVELOPE_COLUMNS,
    FEED_PREFIXES,
    MARKER_SUFFIX,
    PAYLOAD_SUFFIX,
    PLACEMENT_FEED,
    QUEUE_DATE_FORMATS,
    QUEUE_KEY,
    QUEUE_RECORDTYPE,
    RECORD_DATE_FORMATS,
    REPAIR_NAME_PART,
    SINGLE_TYPE_FEEDS,
)
from feedlake.functions.dates import date_columns, parses
from feedlake.functions.text import fields, repair_literals
from feedlake.operators.arrivals import completeness, mark_fresh
from feedlake.operators.envelope import (
    attach_header,
    feed_details,
    feed_header,
    first_lines,
    prepend_literal,
    snapshot_from_name,
    tag_lines,
)
from feedlake.operators.losses import LOSS_KEYS, lost_amount, lost_date, lost_lines, lost_values, summarise_losses
from feedlake.operators.typing_rules import (
    apply_formats,
    bad_amounts,
    coerce_dates,
    date_choice,
    money_columns,
    parse_dates_column,
    parse_doubles,
)
from feedlake.operators.unpack import WidthError, unpack, width_ok
from feedlake.plans.handoff import cleared_after, fresh_folder, from_driver, written
from feedlake.plans.steps import Steps, fingerprint
from feedlake.session import configure
from feedlake.sinks.ledger import Ledger
from feedlake.sinks.manifest import STALE_SECONDS, Publication
from feedlake.sources.discover import discover, route_kind, union_sources
from feedlake.sources.inference import least_type, state
from feedlake.sources.registry import (
    load_registry,
    prune_schema,
    registry_entries,
    split_types,
)
from feedlake.sources.scan import (
    OVERFLOW,
    null_tokens,
    scan_delimited,
    scan_lines,
    session_like,
    sniff_first_lines,
)

log = logging.getLogger(__name__)

OK = "ok"
NO_PARTITION = "_"
# Column with a row's input file, up to the writing.
SOURCE = "_source"


class IncompleteArrival(RuntimeError):
    """Too few of the day's files are there."""


class RejectedRows(ValueError):
    """Rows had to be rejected in a load that allows none."""


@dataclass(frozen=True)
class LoadConfig:
    """What a daily load reads, writes and tolerates.

    ``sources`` maps source names to landing folders, the second source being
    the one whose payloads decide how many are expected. ``target`` holds the
    published tables, ``work`` this load's intermediate tables and ``ledger``
    the run ledger. ``work`` defaults to a new folder under
    ``spark.checkpoint.dir``. Files with rejected or held-back lines stay
    pending, so a run after the registry is mended loads them again;
    ``accept_partial`` takes them for done.
    """

    sources: Mapping[str, str]
    registry: str
    target: str
    ledger: str
    syncday: str
    work: str | None = None
    task_name: str = "daily_load"
    job: str = "feedlake"
    strict_markers: bool = False
    exclude_columns: Sequence[str] = ENVELOPE_COLUMNS
    repairs: Sequence[tuple[str, str]] = ()
    prefixes: Mapping[str, str] = field(default_factory=lambda: dict(FEED_PREFIXES))
    fail_fast: bool = False
    anchored_headers: bool = False
    trim_lines: bool = False
    date_scope: str = "column"
    date_rule: str = "fallback"
    money_on_error: str = "fail"
    parallel_tables: int = 4
    accept_partial: bool = False
    # whether columns of the queue export that the registry gives no type get the least one that holds their texts
    infer_queue_types: bool = False
    # seconds after which another run's hold on the day counts as left behind
    stale_after: float = STALE_SECONDS
    # whether published files of unknown input may be replaced
    replace_unmanaged: bool = False

    def __post_init__(self):
        if not (len(self.syncday) == 8 and self.syncday.isdigit()):
            raise ValueError(f"syncday must be YYYYMMDD, not {self.syncday!r}")
        if self.date_scope not in ("column", "row") or self.date_rule not in ("fallback", "coerce"):
            raise ValueError("date_scope is 'column' or 'row', date_rule 'fallback' or 'coerce'")
        if not self.sources:
            raise ValueError("at least one source folder is needed")

    @property
    def second_source(self) -> str:
        return list(self.sources)[min(1, len(self.sources) - 1)]


@dataclass(frozen=True)
class LoadResult:
    """How a load ended.

    ``tables`` has the rows of the day in each table that the run wrote to, also
    those of files that were loaded before, and ``published`` is their sum.
    ``losses`` has what was not read, per file, record type, column and reason:
    how many (``lost``) and the smallest few of the texts. Without a column
    they are whole lines, which are in ``rejects``.
    """

    task_id: str
    status: str
    published: int
    held_back: int
    rejected: int
    tables: dict[str, int]
    rejects: DataFrame | None
    # lines of single-type feeds that went because they name the feed, though they are no headers
    dropped: int = 0
    losses: DataFrame | None = None


# --- arrival ---------------------------------------------------------------------------------


def check_arrival(spark: SparkSession, cfg: LoadConfig) -> tuple[DataFrame, str]:
    """The day's payloads and the verdict on their completeness; raises if incomplete."""
    files = discover(spark, cfg.sources, cfg.syncday, (PAYLOAD_SUFFIX, MARKER_SUFFIX))
    verdict = completeness(files, cfg.second_source, strict_markers=cfg.strict_markers).first()
    if verdict.status == "incomplete":
        raise IncompleteArrival(
            f"{verdict.markers} markers and {verdict.payloads} of {verdict.expected} payloads"
        )
    return files.where(F.col("suffix") == PAYLOAD_SUFFIX), verdict.status


def read_headers(spark: SparkSession, files: DataFrame, cfg: LoadConfig) -> DataFrame:
    """Header and feed details of every file of ``files`` with a non-blank line, as a written table."""
    firsts = sniff_first_lines(spark, _paths(files.where("length > 0")), cfg.trim_lines)
    return written(feed_details(feed_header(firsts), cfg.prefixes))


def _paths(files: DataFrame) -> list[str]:
    """Paths for a reader, which takes them as a list: one text per file."""
    return [row.path for row in files.select("path").toLocalIterator()]


# --- bronze ----------------------------------------------------------------------------------


# Date columns whose verdicts fit into one bigint of flags.
_FLAGS = 63


@dataclass(frozen=True)
class RecordSchema:
    """A registry entry as the load uses it; ``dates`` are positions in ``names``."""

    key: str
    names: list[str]
    dates: list[int]

    @classmethod
    def of(cls, key: str, names: Sequence[str], exclude: Sequence[str]) -> RecordSchema:
        kept = prune_schema(split_types(names), exclude)
        dated = set(date_columns(kept))
        return cls(key, kept, [i for i, n in enumerate(kept) if n in dated])


def _slots(schemas: Mapping[str, RecordSchema]) -> range:
    """Numbers of date columns, up to the record type with most of them."""
    return range(max((len(s.dates) for s in schemas.values()), default=0))


def bronze_lines(
    spark: SparkSession,
    paths: Sequence[str],
    headers: DataFrame,
    schemas: Mapping[str, RecordSchema],
    cfg: LoadConfig,
    dropped: Observation | None = None,
) -> DataFrame:
    """All body lines with their record type, width, unfit date columns and reject reason.

    ``reason`` is ``ok``, ``bad_header`` (no date in it) or ``no_schema``. The
    partition columns ``part_feed``, ``part_type`` and ``snap_day`` are only
    filled for good lines, so that rubbish makes no folders.
    """
    lines = scan_lines(spark, list(paths), trim=cfg.trim_lines)
    if cfg.repairs:
        repaired = repair_literals(F.col("value"), cfg.repairs)
        broken = F.col("file_name").contains(REPAIR_NAME_PART)
        lines = lines.withColumn("value", F.when(broken, repaired).otherwise(F.col("value")))
    lines = lines.select("file", "value")
    tagged = tag_lines(attach_header(lines, headers), cfg.anchored_headers, dropped)

    slots = _slots(schemas)
    table = from_driver(
        spark,
        [
            (s.key, len(s.names), *(s.dates[n] if n < len(s.dates) else None for n in slots))
            for s in schemas.values()
        ],
        "key string, expected int" + "".join(f", _date_{n} int" for n in slots),
    )
    keyed = tagged.withColumn("_key", F.concat("prefix", F.lower("recordtype")))
    known = keyed.join(table, keyed["_key"] == table["key"], "left")
    reason = (
        F.when(F.col("snap_dt").isNull(), "bad_header")
        .when(F.col("key").isNull(), "no_schema")
        .otherwise(OK)
    )
    judged = known.withColumns({"reason": reason, "_fields": fields(F.col("value"))})
    good = F.col("reason") == OK
    return judged.select(
        "file",
        "feed",
        "recordtype",
        F.col("value").alias("line"),
        "snap_dt",
        "expected",
        # a line without a body still has one, missing, field
        F.greatest(F.size("_fields") - F.col("lead"), F.lit(1)).alias("width"),
        *_unfit_dates(slots),
        "reason",
        F.when(good, F.col("feed")).otherwise(NO_PARTITION).alias("part_feed"),
        F.when(good, F.col("recordtype")).otherwise(NO_PARTITION).alias("part_type"),
        F.when(good, F.to_date("snap_dt")).alias("snap_day"),
    )


def _unfit_dates(slots: range) -> list[Column]:
    """Flag columns ``unfit_<n>``: one bit per date column whose text is not of the first format."""

    def flag(n: int) -> Column:
        text = F.get("_fields", F.col(f"_date_{n}") + F.col("lead"))
        unfit = ~parses(text, RECORD_DATE_FORMATS[0])
        return F.when(unfit, F.lit(1 << n % _FLAGS)).otherwise(0).cast("bigint")

    words = range(0, max(len(slots), 1), _FLAGS)
    none = F.lit(0).cast("bigint")
    return [
        reduce(Column.bitwiseOR, (flag(n) for n in slots[first : first + _FLAGS]), none).alias(
            f"unfit_{word}"
        )
        for word, first in enumerate(words)
    ]


# Splits of the bronze pass do not grow beyond this, and leave so many tasks for each core.
_LARGEST_SPLIT = 2 << 30
_TASKS_PER_CORE = 3


def split_bytes(total: int, kinds: int, least: int, cores: int) -> int:
    """Bytes of text that a task of the bronze pass is to read.

    A task writes one file per record type it meets, so its share grows with the
    ``kinds`` of them: files are then of ``least`` bytes of text on average,
    however many kinds there are. It does not grow where that would leave cores
    without work.
    """
    return max(least, min(least * max(kinds, 1), total // (_TASKS_PER_CORE * max(cores, 1)), _LARGEST_SPLIT))


def _bronze_session(
    spark: SparkSession, files: DataFrame, headers: DataFrame, entries: Mapping[str, Sequence[str]], cfg: LoadConfig
) -> SparkSession:
    """The session to read the day's lines in: with larger splits, if there is enough to read."""
    found = {row.feed for row in headers.select("feed").distinct().collect()}
    prefixes = [prefix for feed, prefix in cfg.prefixes.items() if feed in found]
    kinds = max((sum(key.startswith(prefix) for key in entries) for prefix in prefixes), default=1)
    name = "spark.sql.files.maxPartitionBytes"
    least = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    total = files.agg(F.sum("length")).first()[0] or 0
    split = split_bytes(total, kinds, least, spark.sparkContext.defaultParallelism)
    return spark if split == least else session_like(spark, {name: str(split)})


def write_bronze(lines: DataFrame, path: str) -> DataFrame:
    return written(lines, path, ("reason", "part_feed", "part_type", "snap_day"))


def _unfit_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("unfit_")]


def judge_bronze(bronze: DataFrame, path: str) -> DataFrame:
    """Rows, width and unfit date columns per file and record type, as a written table.

    One pass over narrow columns, combined before it shuffles.
    """
    extra = F.when(F.col("part_feed") == PLACEMENT_FEED, 1).otherwise(0)
    judged = bronze.groupBy("reason", "part_feed", "part_type", "snap_day", "file").agg(
        F.count("*").alias("rows"),
        width_ok(F.max("width"), F.max("expected"), extra).alias("fits"),
        *(F.bit_or(c).alias(c) for c in _unfit_columns(bronze)),
    )
    return written(judged, path, ("reason", "part_feed", "part_type"))


# --- one record type -------------------------------------------------------------------------


@dataclass(frozen=True)
class TablePlan:
    """What the verdicts say about one record type of one feed on the sync day.

    ``first_fits`` says of each date column whether the first format fits it in
    all files, in none, or (None) in some.
    """

    feed: str
    recordtype: str
    schema: RecordSchema
    good_rows: int
    bad_rows: int
    first_fits: dict[str, bool | None]

    @property
    def lead(self) -> int:
        return 0 if self.feed in SINGLE_TYPE_FEEDS else 1


@dataclass(frozen=True)
class DayPlan:
    tables: list[TablePlan]
    held_back: int
    unusable: int

    @property
    def bad_rows(self) -> int:
        return sum(table.bad_rows for table in self.tables)


def plan_day(
    verdicts: DataFrame, schemas: Mapping[str, RecordSchema], cfg: LoadConfig
) -> DayPlan:
    """What is to be done, from one row per record type and day."""
    fits, flags = F.col("fits"), _unfit_columns(verdicts)
    found = (
        verdicts.groupBy("reason", "part_feed", "part_type", _due(cfg).alias("due"))
        .agg(
            F.sum("rows").alias("rows"),
            F.sum(F.when(fits, F.col("rows"))).alias("good_rows"),
            *(F.bit_or(F.when(fits, F.col(c))).alias(f"some_{c}") for c in flags),
            *(F.bit_and(F.when(fits, F.col(c))).alias(f"all_{c}") for c in flags),
        )
        .collect()
    )
    tables = []
    for row in (row for row in found if row.due):
        schema = schemas[f"{cfg.prefixes[row.part_feed]}{row.part_type.lower()}"]
        first_fits = {}
        for nth, at in enumerate(schema.dates):
            word, bit = divmod(nth, _FLAGS)
            some = (row[f"some_unfit_{word}"] or 0) >> bit & 1
            every = (row[f"all_unfit_{word}"] or 0) >> bit & 1
            first_fits[schema.names[at]] = True if not some else (False if every else None)
        good = row.good_rows or 0
        tables.append(
            TablePlan(row.part_feed, row.part_type, schema, good, row.rows - good, first_fits)
        )
    return DayPlan(
        tables,
        held_back=sum(row.rows for row in found if row.reason == OK and not row.due),
        unusable=sum(row.rows for row in found if row.reason != OK),
    )


def _due(cfg: LoadConfig) -> Column:
    day = F.to_date(F.lit(cfg.syncday), "yyyyMMdd")
    return (F.col("reason") == OK) & F.col("snap_day").eqNullSafe(day)


def _of_table(plan: TablePlan, cfg: LoadConfig) -> Column:
    return (
        _due(cfg)
        & (F.col("part_feed") == plan.feed)
        & (F.col("part_type") == plan.recordtype)
    )


# In front of the columns with the texts that dates were read from.
_TEXT = "_text_"


def _open_dates(plan: TablePlan) -> list[str]:
    """Date columns with texts that are not of the first format; only those can lose values."""
    return [name for name, fits in plan.first_fits.items() if fits is not True]


def _dated_rows(
    bronze: DataFrame, verdicts: DataFrame, plan: TablePlan, cfg: LoadConfig, kept: Sequence[str | Column] = ()
) -> DataFrame:
    """Unpacked rows of one record type with typed dates; bronze is read in its folder only.

    The texts of dates that may be lost stay, as ``_text_<column>``.
    """
    rows = bronze.where(_of_table(plan, cfg))
    files = verdicts.where(_of_table(plan, cfg))
    if plan.bad_rows:
        rows = rows.join(files.where(~F.col("fits")).select("file"), "file", "left_anti")
    kept = ["recordtype", "line", "snap_dt", *kept]
    by_column = cfg.date_rule == "fallback" and cfg.date_scope == "column"
    if by_column and None in plan.first_fits.values():
        flags = {c: f"_{c}" for c in _unfit_columns(verdicts)}
        rows = rows.drop(*flags).join(
            files.select("file", *(F.col(c).alias(a) for c, a in flags.items())), "file"
        )
        kept += flags.values()
    names, dates = plan.schema.names, list(plan.first_fits)
    out = unpack(rows.select(*kept), names, text="line", lead=plan.lead)
    out = out.withColumns({_TEXT + c: F.col(c) for c in _open_dates(plan)})
    if cfg.date_rule == "coerce":
        return coerce_dates(out, dates)
    if cfg.date_scope == "row":
        return parse_dates_column(out, dates, scope="row")
    typed = {}
    for nth, name in enumerate(dates):
        fits = plan.first_fits[name]
        if fits is None:
            word, bit = divmod(nth, _FLAGS)
            fits = F.getbit(f"_unfit_{word}", F.lit(bit)) == 0
        typed[name] = date_choice(F.col(name), fits, RECORD_DATE_FORMATS, name, "coerce")
    return out.withColumns(typed)


def _losses(plan: TablePlan, cfg: LoadConfig) -> list[tuple[str, str, Column, Column]]:
    """What rows of ``_dated_rows`` can lose: column, reason, condition and text."""
    texts = {c: F.col(_TEXT + c) for c in _open_dates(plan)}
    dates = [(c, "date", lost_date(text, F.col(c)), text) for c, text in texts.items()]
    if plan.feed != PLACEMENT_FEED or cfg.money_on_error != "null":
        return dates
    return dates + [(c, "amount", lost_amount(F.col(c)), F.col(c)) for c in money_columns(plan.schema.names)]


def typed_table(
    bronze: DataFrame,
    verdicts: DataFrame,
    plan: TablePlan,
    cfg: LoadConfig,
    seen: Observation | None = None,
    source: str | None = None,
) -> DataFrame:
    """Typed rows of one record type; bronze is read in its folder only.

    ``seen`` counts, while the rows are written, those that lost a value, by
    reason (``date``, ``amount``). ``source`` adds a column with each row's
    input file.
    """
    out = _dated_rows(bronze, verdicts, plan, cfg, [F.col("file").alias(source)] if source else [])
    if seen is not None:
        found = {"date": F.lit(False), "amount": F.lit(False)}
        for _, reason, lost, _ in _losses(plan, cfg):
            found[reason] = found[reason] | lost
        out = out.observe(seen, *(F.count_if(any_lost).alias(reason) for reason, any_lost in found.items()))
    names = plan.schema.names
    if plan.feed == PLACEMENT_FEED:
        out = parse_doubles(out, money_columns(names), cfg.money_on_error)
    # snap_dt goes last, after the registered columns
    lead = [c for c in out.columns if c in ("recordtype", *names)]
    return out.select(*lead, "snap_dt", *([source] if source else []))


def table_losses(bronze: DataFrame, verdicts: DataFrame, plan: TablePlan, cfg: LoadConfig) -> DataFrame:
    """Each value that the rows of one record type lost; a pass of its own, for tables that lost any."""
    rows = _dated_rows(bronze, verdicts, plan, cfg, [F.col("file").alias(SOURCE)])
    kinds = F.lit(plan.recordtype).alias("_kind")
    values = lost_values(rows, _losses(plan, cfg), [SOURCE, kinds])
    return values.withColumnsRenamed({SOURCE: "file", "_kind": "recordtype"})


def rejected_lines(
    bronze: DataFrame,
    verdicts: DataFrame,
    plans: Sequence[TablePlan],
    cfg: LoadConfig,
    noted: Collection[TablePlan] = (),
) -> DataFrame:
    """Rejects as ``(file, recordtype, line, reason)``.

    Lines without a usable header or schema, lines of groups of a wrong width,
    and, as notes, the lines of ``noted`` with an amount that was read as 0.0.
    """

    def reject(rows: DataFrame, reason: Column) -> DataFrame:
        return rows.select("file", "recordtype", "line", reason.alias("reason"))

    out = reject(bronze.where(F.col("reason") != OK), F.col("reason"))
    for plan in plans:
        files = verdicts.where(_of_table(plan, cfg))
        rows = bronze.where(_of_table(plan, cfg))
        if plan.bad_rows:
            bad = files.where(~F.col("fits")).select("file")
            out = out.unionByName(reject(rows.join(bad, "file", "left_semi"), F.lit("width")))
        if plan in noted:
            if plan.bad_rows:
                rows = rows.join(files.where("fits").select("file"), "file", "left_semi")
            whole = rows.select("file", "recordtype", "line", F.col("line").alias("_text"))
            unpacked = unpack(whole, plan.schema.names, text="_text", lead=plan.lead)
            bad = bad_amounts(money_columns(plan.schema.names))
            notes = unpacked.where(F.size(bad) > 0)
            out = out.unionByName(reject(notes, F.lit("amount")))
    return out


# --- queue export ----------------------------------------------------------------------------


def queue_rows(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], infer: bool = False
) -> tuple[DataFrame, DataFrame, int]:
    """Typed rows of queue exports, the rejected (too long) rows and their number.

    A first pass gives one verdict per file: its long rows, for each date
    column, whether the first format fits, and with ``infer`` the kinds of texts
    in each column that the registry gives no type. The second pass types the
    rows.
    """
    types = split_types(names)
    dates = date_columns(types)
    scanned = scan_delimited(spark, paths, list(types))
    fits = F.col(OVERFLOW).isNull()
    short = null_tokens(scanned, types)
    open_types = [c for c, t in types.items() if infer and t == "string" and c not in dates]
    verdicts = written(
        short.groupBy("file").agg(
            F.count_if(~fits).alias("long_rows"),
            *(
                F.bool_and(~fits | parses(F.col(c), QUEUE_DATE_FORMATS[0])).alias(f"_ok_{c}")
                for c in dates
            ),
            *(state(F.when(fits, F.col(c))).alias(f"_kinds_{c}") for c in open_types),
        )
    )
    if open_types:
        found = verdicts.agg(*(F.bit_or(f"_kinds_{c}").alias(c) for c in open_types)).first()
        types |= {c: least_type([found[c] or 0]) for c in open_types}
    dated = apply_formats(
        short.where(fits), verdicts, dates, QUEUE_DATE_FORMATS, ["file"], last="fail"
    )
    cast = {
        name: F.col(name).cast(kind)
        for name, kind in types.items()
        if kind != "string" and name not in dates
    }
    typed = snapshot_from_name(dated.withColumns(cast).withColumn(SOURCE, F.col("file"))).select(*types, "snap_dt", SOURCE)
    rejects = scanned.where(~fits).select(
        "file",
        F.lit(QUEUE_RECORDTYPE).alias("recordtype"),
        F.col(OVERFLOW).alias("line"),
        F.lit("width").alias("reason"),
    )
    long_rows = verdicts.agg(F.sum("long_rows")).first()[0] or 0
    return prepend_literal(typed, "recordtype", QUEUE_RECORDTYPE), rejects, long_rows


# --- the load --------------------------------------------------------------------------------


@dataclass
class _Totals:
    held_back: int = 0
    rejected: int = 0
    dropped: int = 0
    rejects: list[DataFrame] = field(default_factory=list)
    # values that were read as null or 0.0
    losses: list[DataFrame] = field(default_factory=list)
    # files with rejected or held-back lines
    partial: list[DataFrame] = field(default_factory=list)


def _load_feeds(
    spark: SparkSession,
    files: DataFrame,
    entries: Mapping[str, Sequence[str]],
    cfg: LoadConfig,
    totals: _Totals,
    publication: Publication,
    steps: Steps,
) -> None:
    """Stage the tables of these files; those of other files stay as they are published.

    Bronze and verdicts of a failed run over the same files are taken up again.
    """
    headers = read_headers(spark, files, cfg)
    paths = _paths(headers.withColumnRenamed("file", "path"))
    versions = sorted((r.path, r.modificationTime, r.length) for r in files.select("path", "modificationTime", "length").toLocalIterator())
    if not paths:
        return

    schemas = {k: RecordSchema.of(k, v, cfg.exclude_columns) for k, v in entries.items()}

    def bronze_step(path: str) -> tuple[DataFrame, dict]:
        dropped = Observation()
        reading = _bronze_session(spark, files, headers, entries, cfg)
        made = write_bronze(bronze_lines(reading, paths, headers, schemas, cfg, dropped), path)
        return spark.read.schema(made.schema).parquet(path), {"dropped": dropped.get["named"]}

    key = fingerprint(versions, entries, cfg.exclude_columns, cfg.repairs, cfg.prefixes, cfg.anchored_headers, cfg.trim_lines)
    bronze, facts = steps.take("bronze", key, bronze_step)
    totals.dropped += facts["dropped"]
    verdicts, _ = steps.take("verdicts", key, lambda path: (judge_bronze(bronze, path), {}))
    day = plan_day(verdicts, schemas, cfg)
    totals.held_back += day.held_back
    totals.rejected += day.unusable + day.bad_rows
    if day.unusable or day.bad_rows or day.held_back:
        clean = F.col("fits") & _due(cfg)
        totals.partial.append(verdicts.where(~F.coalesce(clean, F.lit(False))).select("file").distinct())
    if cfg.fail_fast and day.bad_rows:
        bad = sorted(f"{t.feed}/{t.recordtype}" for t in day.tables if t.bad_rows)
        raise WidthError(f"{day.bad_rows} lines in groups of a wrong width: {', '.join(bad)}")
    if cfg.fail_fast and day.unusable:
        raise RejectedRows(f"{day.unusable} lines without a usable header or schema")

    noted, lossy = [], []

    def load_table(plan: TablePlan) -> None:
        seen = Observation() if _losses(plan, cfg) else None
        table = typed_table(bronze, verdicts, plan, cfg, seen, SOURCE)
        publication.stage(table, plan.feed, plan.recordtype, SOURCE, paths)
        if seen is None:
            return
        found = seen.get
        if found["amount"]:
            noted.append(plan)
        if found["amount"] or found["date"]:
            lossy.append(plan)

    # The tables are independent; a few at a time keep the executors busy
    # through the tail of each write.
    ready = [plan for plan in day.tables if plan.good_rows]
    with ThreadPoolExecutor(max_workers=max(1, cfg.parallel_tables)) as pool:
        list(pool.map(inheritable_thread_target(spark)(load_table), ready))
    if day.unusable or day.bad_rows or noted:
        totals.rejects.append(rejected_lines(bronze, verdicts, day.tables, cfg, noted))
    totals.losses += [table_losses(bronze, verdicts, plan, cfg) for plan in lossy]


def _load_queue(
    spark: SparkSession,
    paths: Sequence[str],
    entries: Mapping[str, Sequence[str]],
    cfg: LoadConfig,
    totals: _Totals,
    publication: Publication,
) -> None:
    if QUEUE_KEY not in entries:
        lines = scan_lines(spark, paths)
        missing = lines.select(
            "file",
            F.lit(QUEUE_RECORDTYPE).alias("recordtype"),
            F.col("value").alias("line"),
            F.lit("no_schema").alias("reason"),
        )
        count = missing.count()
        if count and cfg.fail_fast:
            raise RejectedRows(f"{count} queue rows without a schema")
        totals.rejected += count
        totals.rejects.append(missing)
        totals.partial.append(missing.select("file").distinct())
        return
    rows, rejects, too_long = queue_rows(spark, paths, entries[QUEUE_KEY], cfg.infer_queue_types)
    if too_long and cfg.fail_fast:
        raise WidthError(f"{too_long} queue rows with too many fields")
    done = publication.stage(rows, QUEUE_RECORDTYPE, QUEUE_RECORDTYPE, SOURCE, paths)
    totals.held_back += done["held_back"]
    totals.rejected += too_long
    if too_long:
        totals.rejects.append(rejects)
        totals.partial.append(rejects.select("file").distinct())


def _load(
    spark: SparkSession, cfg: LoadConfig, ledger: Ledger, task_id: str, publication: Publication
) -> LoadResult:
    payloads, status = check_arrival(spark, cfg)
    files = written(mark_fresh(route_kind(payloads), ledger.files())).where("fresh")
    kinds = {row.kind for row in files.select("kind").distinct().collect()}
    totals = _Totals()
    # whoever holds the day may use and clear them
    steps = Steps(spark, f"{cfg.ledger.rstrip('/')}.steps/{cfg.syncday}")
    if not kinds:
        return LoadResult(task_id, "nothing_pending", 0, 0, 0, {}, None)
    entries = registry_entries(load_registry(spark, cfg.registry))
    if "queue" in kinds:
        _load_queue(spark, _paths(files.where("kind = 'queue'")), entries, cfg, totals, publication)
    if "feed" in kinds:
        _load_feeds(spark, files.where("kind = 'feed'"), entries, cfg, totals, publication, steps)
    rejects = None
    if totals.rejects:
        rejects = written(union_sources(*totals.rejects), f"{cfg.work}/rejects")
    losses = []
    if totals.losses:
        values = summarise_losses(union_sources(*totals.losses))
        losses.append(written(values, f"{cfg.work}/losses"))
    if rejects is not None:
        losses.append(lost_lines(rejects))
    lost = union_sources(*losses).select(*LOSS_KEYS, "lost", "texts") if losses else None
    # all is written and judged; what these files had published before goes
    manifest = publication.commit(sources=_paths(files))
    fresh = files.withColumn("status", F.lit("ok"))
    if totals.partial and not cfg.accept_partial:
        partial = union_sources(*totals.partial).distinct()
        fresh = fresh.join(partial, fresh.path == partial.file, "left").withColumn(
            "status", F.when(F.col("file").isNull(), "ok").otherwise("partial")
        )
    ledger.append_files(fresh, task_id, cfg.syncday)
    steps.clear()
    touched = sorted({(e.recordtype, e.feed) for e in publication.staged})
    tables = {f"{recordtype}/{feed}": manifest.rows(feed, recordtype) for recordtype, feed in touched}
    return LoadResult(
        task_id,
        status,
        sum(tables.values()),
        totals.held_back,
        totals.rejected,
        tables,
        rejects,
        totals.dropped,
        lost,
    )


def daily_load(spark: SparkSession, cfg: LoadConfig) -> LoadResult:
    """Check, load and publish the sync day's files, and note the run in the ledger.

    A failed run is noted as such and its error is raised again; running the
    day once more redoes what was not finished. Its bronze and verdicts lie
    beside the ledger until a run of the day ends well. Of the intermediate tables of a
    run that ends well only the rejects and the lost values' summary stay.
    """
    configure(spark)
    cfg = replace(cfg, work=cfg.work or fresh_folder(spark, f"load-{cfg.syncday}"))
    ledger = Ledger(spark, cfg.ledger)
    task_id = uuid.uuid4().hex
    run = {
        "task_id": task_id,
        "task_name": cfg.task_name,
        "job": cfg.job,
        "syncday": cfg.syncday,
        "start": datetime.now(timezone.utc),
    }
    try:
        hold = Publication(spark, cfg.target, cfg.syncday, task_id, cfg.stale_after, cfg.replace_unmanaged)
        with cleared_after(spark), hold as publication:
            result = _load(spark, cfg, ledger, task_id, publication)
    except Exception as error:
        ledger.record(**run, end=datetime.now(timezone.utc), error=f"{type(error).__name__}: {error}")
        raise
    ledger.record(**run, end=datetime.now(timezone.utc), record_count=result.published)
    log.info("%s: %s rows published, %s", cfg.syncday, result.published, result.status)
    return result
