"""One query per operator over the given tables, and the SQL each must agree with.

The queries pack the tables into the shapes the operators expect (delimited
text, files, file listings, run rows) and always use all rows. Where files are
needed they are written to a new folder under the shared folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from contextlib import suppress
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake.constants import (
    MARKER_SUFFIX,
    NULL_TOKENS,
    PAYLOAD_SUFFIX,
    PLACEMENT_FEED,
    QUEUE_DATE_FORMATS,
    QUEUE_RECORDTYPE,
)
from feedlake.operators import (
    arrival_counts,
    attach_header,
    coerce_dates,
    completeness,
    demux,
    feed_header,
    first_lines,
    latest_status,
    ledger_rows,
    parse_dates_column,
    parse_doubles,
    pending,
    prepend_literal,
    record_types,
    snapshot_from_name,
    split_width,
    stamp_snapshot,
    strip_header_contains,
    strip_header_type,
    tag_multi,
    tag_single,
    unpack,
    width_guard,
    width_ok,
    with_elapsed,
)
from feedlake.plans.handoff import fresh_folder, written
from feedlake.plans.ingest import LoadConfig, daily_load, queue_rows
from feedlake.plans.packing import name_files, pack, write_lines
from feedlake.session import configure
from feedlake.sinks import Ledger, publish, write_snapshot
from feedlake.sinks.files import Files
from feedlake.sources import (
    discover,
    load_registry,
    null_tokens,
    route_kind,
    scan_delimited,
    scan_lines,
    schema_for,
    sniff_first_lines,
    union_sources,
)
from feedlake.functions import repair_literals

DAY = "20240115"

ORDERS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}
LINEITEM = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _retyped(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The columns of ``types``, those that are no dates cast from text."""
    return df.select(
        *(
            F.col(name) if kind == "timestamp_ntz" else F.col(name).cast(kind).alias(name)
            for name, kind in types.items()
        )
    )


def _stamp(text: Column | str) -> Column:
    return F.date_format(text, "yyyyMMddHHmmss")


# --- sources ---------------------------------------------------------------------------------


def delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    # names are quoted, with a separator, quotes and a line break in front
    name = F.concat(F.lit('"| ""\n'), "c_name", F.lit('"'))
    folder = fresh_folder(spark, "delimited")
    quoted = customer.withColumn("c_name", name)
    quoted.select(pack(quoted).alias("value")).write.text(folder)
    scanned = scan_delimited(spark, folder, customer.columns)
    scanned = scanned.withColumn("c_name", F.replace("c_name", F.lit('| "\n'), F.lit("")))
    types = dict(customer.dtypes)
    return prepend_literal(_retyped(scanned, types), "recordtype", QUEUE_RECORDTYPE)


def queue_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a queue export of a registry without types; the texts tell which columns hold numbers."""
    customer = _table(spark, sf_dir, "customer")
    root = fresh_folder(spark, "inferred")
    parts = write_lines(customer, pack(customer), f"{root}/parts")
    name_files(spark, parts, f"{root}/queue", "QueueExport", DAY, PAYLOAD_SUFFIX)
    rows, _, _ = queue_rows(spark, f"{root}/queue", customer.columns, infer=True)
    return rows.select("recordtype", *customer.columns)


def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    line = pack(events, ["event_type", "event_id", "ts", "user_id", "props"])
    folder = write_lines(events, line, fresh_folder(spark, "lines"))
    lines = scan_lines(spark, folder)
    return lines.groupBy(F.split_part("value", F.lit("|"), F.lit(1)).alias("event_type")).agg(
        F.count("*").alias("lines"), F.sum(F.length("value")).alias("characters")
    )


_REGION_DAYS = [f"2024010{n}" for n in range(1, 6)]


def file_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    customer = _table(spark, sf_dir, "customer")
    located = written(
        customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            "n_regionkey", "c_custkey", "c_name"
        )
    )
    root = fresh_folder(spark, "landing")
    dirs = {"first": f"{root}/first", "second": f"{root}/second"}
    for region, day in enumerate(_REGION_DAYS):
        rows = located.where(F.col("n_regionkey") == region)
        source = dirs["first" if region % 2 else "second"]
        write_lines(rows, pack(rows, ["c_custkey", "c_name"]), source, stem=f"Feed_{day}")
    days = []
    for day in _REGION_DAYS:
        files = discover(spark, dirs, day, PAYLOAD_SUFFIX)
        paths = [row.path for row in files.where("length > 0").select("path").collect()]
        lines = scan_lines(spark, paths)
        days.append(
            lines.groupBy(F.lit(day).alias("day")).agg(
                F.count("*").alias("lines"),
                F.sum(F.split_part("value", F.lit("|"), F.lit(1)).cast("bigint")).alias("keys"),
            )
        )
    return union_sources(*days)


def kind_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    stem = (
        F.when(priority == "1-URGENT", "QueueExport")
        .when(priority == "2-HIGH", "AccountPlacementImportFile")
        .when(priority == "3-MEDIUM", "AccountPlacementImportFile_QueueExport")
        .otherwise("AgentReturnFile")
    )
    day = F.date_format("o_orderdate", "yyyyMMdd")
    name = F.concat(stem, F.lit("_"), day, F.lit(PAYLOAD_SUFFIX)).alias("name")
    return route_kind(orders.select("o_orderkey", name))


_TYPE_REGISTRY = {
    "cmc_aar_economy": ["id", "recordtype", "accountno", "actiondate"],
    "cmc_aar_large": ["accountno", "directionind", "amount"],
    "cmc_aar_medium": ["location", "accountno"],
    "cmc_aar_promo": ["accountno", "code", "text", "filegenerationdate"],
    "cmc_aar_small": ["rbcsource"],
}


def registry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    path = fresh_folder(spark, "registry")
    text = spark.createDataFrame([(json.dumps(_TYPE_REGISTRY),)], "value string")
    text.coalesce(1).write.text(path)
    typed = part.select(
        "p_partkey", F.lit("AcctActReturnFile").alias("feed"), F.col("p_type").alias("recordtype")
    )
    found = schema_for(typed, load_registry(spark, path))
    return found.select(
        "p_partkey",
        "key",
        F.size("names").cast("bigint").alias("columns"),
        F.array_join("names", ",").alias("names"),
    )


def snapshot_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    odd = F.when(F.col("o_orderstatus") == "F", "_").when(F.col("o_orderstatus") == "P", "1")
    name = F.concat(F.lit("Queue_"), day, F.coalesce(odd, F.lit("")), F.lit(PAYLOAD_SUFFIX))
    named = orders.select("o_orderkey", name.alias("file_name"))
    return snapshot_from_name(named).select("o_orderkey", "snap_dt")


# --- envelope --------------------------------------------------------------------------------


def _event_feeds(spark: SparkSession, sf_dir: str) -> str:
    """Feed files per event type; the types take turns in the kind of header."""
    events = _table(spark, sf_dir, "events")
    folder = fresh_folder(spark, "feeds")
    types = sorted(row[0] for row in events.select("event_type").distinct().collect())
    for n, kind in enumerate(types, start=1):
        day = f"202401{n:02d}"
        header = f"HDR|{kind}|{day}093000" if n % 2 else f"{kind}|x|{day}"
        rows = events.where(F.col("event_type") == kind)
        line = F.concat(F.lit("EV|"), pack(rows, ["event_id", "user_id"]))
        write_lines(rows, line, folder, header)
    return folder


def _per_feed(lines: DataFrame, headers: DataFrame) -> DataFrame:
    body = strip_header_type(tag_multi(attach_header(lines, headers)))
    return (
        demux(body, "EV")
        .groupBy("feed", "snap_dt")
        .agg(
            F.count("*").alias("lines"),
            F.sum(F.split_part("custom", F.lit("|"), F.lit(1)).cast("bigint")).alias("ids"),
        )
    )


def feed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _event_feeds(spark, sf_dir)
    headers = written(feed_header(sniff_first_lines(spark, folder)))
    return _per_feed(scan_lines(spark, folder), headers)


def feed_headers_scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = scan_lines(spark, _event_feeds(spark, sf_dir))
    return _per_feed(lines, written(feed_header(first_lines(lines))))


def strip_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    lines = documents.select("doc_id", F.col("text").alias("value"), F.lit("and").alias("feed"))
    return strip_header_contains(tag_single(lines)).select("doc_id", "recordtype", "custom")


def strip_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    line = pack(events, ["event_type", "event_id", "user_id"])
    lines = events.select(line.alias("value"), F.lit("error").alias("feed"))
    return strip_header_type(tag_multi(lines)).select("recordtype", "custom")


def first_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    # one language has no second field at all
    line = F.when(F.col("lang") == "es", F.col("lang")).otherwise(F.concat_ws("|", "lang", "text"))
    return tag_multi(documents.select("doc_id", line.alias("value"))).select(
        "doc_id", "recordtype", "custom"
    )


def record_type_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    line = pack(lineitem, ["l_returnflag", "l_orderkey", "l_linenumber"])
    lines = lineitem.select(F.col("l_linestatus").alias("file"), line.alias("value"))
    return record_types(tag_multi(lines))


def demultiplex(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    lineitem = _table(spark, sf_dir, "lineitem")
    folder = fresh_folder(spark, "mixed")
    write_lines(orders, F.concat(F.lit("ORD|"), pack(orders)), folder)
    write_lines(lineitem, F.concat(F.lit("LIN|"), pack(lineitem)), folder)
    rows = demux(tag_multi(scan_lines(spark, folder)), "ORD")
    return _retyped(coerce_dates(unpack(rows, orders.columns)), ORDERS)


# --- unpacking -------------------------------------------------------------------------------


def unpack_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    packed = lineitem.select(pack(lineitem).alias("custom"))
    rows = coerce_dates(unpack(packed, lineitem.columns))
    return stamp_snapshot(_retyped(rows, LINEITEM), F.lit(DAY))


_FEW_ORDERS = ["o_orderkey", "o_custkey", "o_orderpriority"]


def _guarded_orders(spark: SparkSession, sf_dir: str, line: Column, extra: int) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    rows = orders.select(
        F.col("o_orderstatus").alias("file"), F.lit("ORD").alias("recordtype"), line.alias("custom")
    )
    accepted, _ = width_guard(rows, len(_FEW_ORDERS), allow_extra=extra)
    return _retyped(unpack(accepted, _FEW_ORDERS), {c: ORDERS[c] for c in _FEW_ORDERS})


def pad_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = F.col("o_orderkey") % 7 == 0
    short = F.concat_ws("|", "o_orderkey", "o_custkey")
    full = F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderpriority")
    return _guarded_orders(spark, sf_dir, F.when(cut, short).otherwise(full), extra=0)


def overflow_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderpriority", F.lit("tail"))
    return _guarded_orders(spark, sf_dir, line, extra=1)


def width_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    rows = documents.select("source", F.col("text").alias("custom"))
    widths = split_width(rows, by=["source"])
    return widths.select(
        "source",
        F.col("width").cast("bigint").alias("width"),
        width_ok(F.col("width"), 1, 100).alias("fits"),
    )


def width_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    rows = documents.select("doc_id", "source", F.col("text").alias("custom"))
    accepted, rejected = width_guard(rows, 1, allow_extra=100, by=["source"], mode="reject")
    return union_sources(
        accepted.select("doc_id", "source", F.lit(None).cast("string").alias("reason")),
        rejected.select("doc_id", "source", "reason"),
    )


# --- typing ----------------------------------------------------------------------------------


def _order_dates(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    """Orders with their date as text in ``opendate``, and an untouched ``updatedate``."""
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        text.alias("opendate"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("updatedate"),
    )


def coerced_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.concat(_stamp("o_orderdate"), F.lit("x")))
        .when((status == "P") & (F.col("o_orderkey") % 3 == 0), "")
        .when(status == "P", F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("32000000")))
        .otherwise(_stamp("o_orderdate"))
    )
    return coerce_dates(_order_dates(spark, sf_dir, text))


def queue_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderkey") % 5 == 0, "")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    rows = _order_dates(spark, sf_dir, text)
    return parse_dates_column(rows, formats=QUEUE_DATE_FORMATS, by=["o_orderstatus"], last="fail")


def _polluted_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long dates in all groups but two: one all short, one with some short."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    short = F.date_format("o_orderdate", "yyyyMMdd")
    text = (
        F.when(status == "F", short)
        .when((status == "P") & (key % 1000 == 7), short)
        .when(key % 11 == 0, "")
        .otherwise(_stamp("o_orderdate"))
    )
    return _order_dates(spark, sf_dir, text)


def fallback_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_dates_column(_polluted_dates(spark, sf_dir), by=["o_orderstatus"])


def fallback_dates_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_dates_column(_polluted_dates(spark, sf_dir), scope="row")


def money_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    def text(key: str, amount: str) -> Column:
        padded = F.concat(F.lit("  "), F.col(amount).cast("string"), F.lit(" "))
        return F.when(F.col(key) % 6 == 0, "   ").when(F.col(key) % 6 == 1, None).otherwise(padded)

    def amounts(table: str, letter: str) -> DataFrame:
        key, amount = f"{letter}key", f"{letter[0]}_acctbal"
        return _table(spark, sf_dir, table).select(
            F.lit(table).alias("owner"), F.col(key).alias("id"), text(key, amount).alias("balance")
        )

    rows = union_sources(amounts("supplier", "s_supp"), amounts("customer", "c_cust"))
    return parse_doubles(rows, ["balance"])


def money_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.concat(price, F.lit("d")))
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit("$"), price))
        .otherwise(price)
    )
    rows = orders.select("o_orderkey", text.alias("balance"))
    return parse_doubles(rows, ["balance"], on_error="null")


def missing_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    tokens = F.array(*(F.lit(t) for t in NULL_TOKENS))
    # a third of the names are replaced by one of the tokens each
    nth = (F.col("c_custkey") % (3 * len(NULL_TOKENS)) + 1).cast("int")
    name = F.coalesce(F.try_element_at(tokens, nth), F.col("c_name"))
    return null_tokens(customer.select("c_custkey", name.alias("c_name")), ["c_name"])


_REPAIRS = (("and ", "& "), ("& t", "|t"))


def literal_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return documents.select("doc_id", repair_literals(F.col("text"), _REPAIRS).alias("text"))


# --- arrivals --------------------------------------------------------------------------------


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    suffix = F.when(F.col("c_custkey") % 3 == 0, MARKER_SUFFIX).otherwise(PAYLOAD_SUFFIX)
    files = customer.select(F.col("c_mktsegment").alias("source"), suffix.alias("suffix"))
    return arrival_counts(files)


def _daily_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as files: their date is the day, two of the customers' residues are markers."""
    orders = _table(spark, sf_dir, "orders")
    suffix = F.when(F.col("o_custkey") % 2 == 0, MARKER_SUFFIX).otherwise(PAYLOAD_SUFFIX)
    source = F.when(F.col("o_orderstatus") == "F", "first").otherwise("second")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return orders.select(day.alias("day"), source.alias("source"), suffix.alias("suffix"))


def complete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completeness(_daily_files(spark, sf_dir), "second", by=["day"])


def complete_days_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = completeness(_daily_files(spark, sf_dir), "second", by=["day"], strict_markers=True)
    return verdicts.groupBy("status").agg(F.count("*").alias("days"))


def sources_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier")
    customer = _table(spark, sf_dir, "customer")
    return union_sources(
        supplier.select(
            F.lit("supplier").alias("source"),
            F.col("s_name").alias("name"),
            F.col("s_nationkey").alias("nation"),
        ),
        customer.select(
            F.col("c_nationkey").alias("nation"),
            F.lit("customer").alias("source"),
            F.col("c_name").alias("name"),
        ),
    )


# --- sinks -----------------------------------------------------------------------------------


def _naive(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    # the order's year is the snapshot
    rows = orders.withColumn("snap_dt", F.date_trunc("year", "o_orderdate").cast("timestamp_ntz"))
    path = write_snapshot(rows, fresh_folder(spark, "sink"), "AgentReturnFile", "ORD")
    back = _naive(spark.read.parquet(path), "o_orderdate", "snap_dt")
    return back.withColumn("snap_day", F.col("snap_day").cast("string"))


def publish_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    final = F.col("o_orderstatus") == "F"
    day = F.when(final, F.lit("20240115")).otherwise("20240116")
    rows = stamp_snapshot(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), day)
    base = fresh_folder(spark, "published")
    target = (base, "AgentReturnFile", "ORD")

    def run(df: DataFrame, syncday: str) -> int:
        return publish(df, base, syncday, *target[1:])["held_back"]

    run(rows, "20240115")
    run(rows, "20240116")
    held_back = run(rows.withColumn("o_totalprice", F.col("o_totalprice") * 2), "20240115")
    # a version that fails while it is written leaves the one before
    broken = F.when(F.col("o_totalprice") > 0, F.raise_error(F.lit("broken"))).otherwise(F.lit(0.0))
    with suppress(PySparkException):
        run(rows.withColumn("o_totalprice", broken.cast("double")), "20240115")
    back = _naive(spark.read.parquet(f"{base}/ORD/AgentReturnFile"), "snap_dt")
    return back.select(
        "o_orderkey", "o_totalprice", "snap_dt", F.lit(held_back).cast("bigint").alias("held_back")
    )


# --- runs ------------------------------------------------------------------------------------


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runs: they last as many seconds as their value, errors fail."""
    events = _table(spark, sf_dir, "events")
    start = F.col("ts").cast("timestamp")
    seconds = F.floor("value")
    return events.select(
        F.col("event_id").cast("string").alias("task_id"),
        F.col("user_id").cast("string").alias("task_name"),
        F.col("event_type").alias("job"),
        F.date_format("ts", "yyyyMMdd").alias("syncday"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
        start.alias("start_time"),
        (start + F.make_dt_interval(secs=seconds)).alias("end_time"),
        F.floor(F.col("value") * 10).alias("record_count"),
    )


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = Ledger(spark, fresh_folder(spark, "ledger"))
    counted = Observation()
    rows = ledger_rows(_runs(spark, sf_dir)).observe(counted, F.count(F.lit(1)).alias("rows"))
    ledger.append_runs(rows)
    return (
        with_elapsed(ledger.runs())
        .groupBy("period", "status")
        .agg(
            F.count("*").alias("runs"),
            F.count("message").alias("messages"),
            F.sum("record_count").alias("records"),
            F.sum("elapsed_seconds").alias("seconds"),
            F.max("elapsed_minutes").alias("longest_minutes"),
        )
        .withColumn("appended", F.lit(counted.get["rows"]).cast("bigint"))
    )


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    lineitem = _table(spark, sf_dir, "lineitem")

    def path(key: str) -> Column:
        return F.concat(F.lit("/in/"), F.col(key).cast("string"), F.lit(PAYLOAD_SUFFIX))

    files = orders.select(
        path("o_orderkey").alias("path"), F.col("o_orderdate").alias("modificationTime")
    )
    # A load of a file is done if it returned; of some files the ledger knows
    # another version only.
    version = F.when(F.col("l_linestatus") == "O", F.col("o_orderdate")).otherwise(
        F.col("l_shipdate")
    )
    ledger = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        path("l_orderkey").alias("path"),
        version.alias("modificationTime"),
        F.when(F.col("l_returnflag") == "R", "ok").otherwise("failed").alias("status"),
    )
    return pending(files, ledger)


def last_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    runs = events.select(
        F.col("user_id").alias("task_name"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("end_time"),
        "event_id",
    )
    return latest_status(runs, order=("end_time", "event_id"))


# --- the whole load --------------------------------------------------------------------------

REGISTRY = {
    "cmc_aar_ord": ["id", "recordtype", *ORDERS],
    "cmc_aar_lin": [*LINEITEM],
    "apf_acctplacementfile": ["accountno", "name", "nation", "balance"],
    "queue_export": ["c_custkey:bigint", "c_name", "c_nationkey:int", "c_acctbal:double", "c_mktsegment"],
}


def pack_feeds(spark: SparkSession, sf_dir: str, root: str) -> LoadConfig:
    """``orders``, ``lineitem``, ``supplier`` and ``customer`` as one day's payloads.

    Orders and line items share a multi-type feed, suppliers are placements and
    customers a queue export.
    """
    orders = _table(spark, sf_dir, "orders")
    lineitem = _table(spark, sf_dir, "lineitem")
    supplier = _table(spark, sf_dir, "supplier")
    customer = _table(spark, sf_dir, "customer")
    amount = F.concat(F.lit(" "), F.col("s_acctbal").cast("string"))
    placement = F.concat_ws("|", "s_suppkey", "s_name", "s_nationkey", amount, F.lit(""))
    packed = [
        (orders, F.concat(F.lit("ORD|"), pack(orders)), f"AcctActReturnFile|x|{DAY}", "Orders"),
        (lineitem, F.concat(F.lit("LIN|"), pack(lineitem)), f"AcctActReturnFile|x|{DAY}", "Lines"),
        (supplier, placement, f"HDR|{PLACEMENT_FEED}|{DAY}093000", "AccountPlacementImportFile"),
        (customer, pack(customer), None, "QueueExport"),
    ]
    for df, line, header, stem in packed:
        parts = write_lines(df, line, f"{root}/parts/{stem}", header)
        source = "first" if stem in ("Orders", "Lines") else "second"
        name_files(spark, parts, f"{root}/{source}", stem, DAY, PAYLOAD_SUFFIX)
    # markers only have to exist
    markers = write_lines(spark.range(0, 6, 1, 6), F.lit("x"), f"{root}/parts/markers")
    name_files(spark, markers, f"{root}/second", "Marker", DAY, MARKER_SUFFIX)
    registry = f"{root}/registry"
    text = spark.createDataFrame([(json.dumps(REGISTRY),)], "value string")
    text.coalesce(1).write.text(registry)
    return LoadConfig(
        sources={"first": f"{root}/first", "second": f"{root}/second"},
        registry=registry,
        target=f"{root}/published",
        ledger=f"{root}/ledger",
        work=f"{root}/work",
        syncday=DAY,
    )


def _ingested(spark: SparkSession, sf_dir: str) -> LoadConfig:
    cfg = pack_feeds(spark, sf_dir, fresh_folder(spark, "ingest"))
    daily_load(spark, cfg)
    return cfg


def ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders packed as a feed, loaded and published: the same orders again."""
    cfg = _ingested(spark, sf_dir)
    table = spark.read.parquet(f"{cfg.target}/ORD/AcctActReturnFile")
    return _retyped(_naive(table, "o_orderdate"), ORDERS)


def ingest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _ingested(spark, sf_dir)
    table = spark.read.parquet(f"{cfg.target}/LIN/AcctActReturnFile")
    return _retyped(_naive(table, "l_shipdate"), LINEITEM)


def _drop(spark: SparkSession, df: DataFrame, cfg: LoadConfig, stem: str) -> None:
    """``df`` as four files of orders in the first landing folder, in place of those of that name."""
    files = Files(spark)
    _withdraw(spark, cfg, stem)
    line = F.concat(F.lit("ORD|"), pack(df))
    parts = write_lines(df.repartition(4, "o_orderkey"), line, f"{cfg.work}-{stem}-parts", f"AcctActReturnFile|x|{DAY}")
    name_files(spark, parts, cfg.sources["first"], stem, DAY, PAYLOAD_SUFFIX)
    files.delete(parts)


def _withdraw(spark: SparkSession, cfg: LoadConfig, stem: str) -> None:
    files = Files(spark)
    for found in files.listing(cfg.sources["first"]):
        if found.name.startswith(f"{stem}_"):
            files.delete(f"{cfg.sources['first']}/{found.name}")


def late_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dealt over two sets of files: the first is loaded and leaves, the second comes late, wrong and then corrected."""
    orders = _table(spark, sf_dir, "orders")
    root = fresh_folder(spark, "late")
    registry = spark.createDataFrame([(json.dumps(REGISTRY),)], "value string")
    registry.coalesce(1).write.text(f"{root}/registry")
    cfg = LoadConfig(
        sources={"first": f"{root}/first"},
        registry=f"{root}/registry",
        target=f"{root}/published",
        ledger=f"{root}/ledger",
        work=f"{root}/work",
        syncday=DAY,
    )
    markers = write_lines(spark.range(0, 6, 1, 6), F.lit("x"), f"{root}/markers")
    name_files(spark, markers, f"{root}/first", "Marker", DAY, MARKER_SUFFIX)
    final = F.col("o_orderstatus") == "F"
    _drop(spark, orders.where(final), cfg, "Final")
    daily_load(spark, cfg)
    _withdraw(spark, cfg, "Final")
    late = orders.where(~final)
    _drop(spark, late.withColumn("o_totalprice", F.col("o_totalprice") * 2), cfg, "Late")
    daily_load(spark, cfg)
    _drop(spark, late, cfg, "Late")
    daily_load(spark, cfg)
    table = spark.read.parquet(f"{cfg.target}/ORD/AcctActReturnFile")
    return _retyped(_naive(table, "o_orderdate"), ORDERS)


def resume_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that fails on an amount after its lines are bronze, and a second one that takes these up."""
    root = fresh_folder(spark, "resume")
    cfg = pack_feeds(spark, sf_dir, root)
    bad = write_lines(spark.range(1), F.lit("0|x|0|none|"), f"{root}/parts/bad", f"HDR|{PLACEMENT_FEED}|{DAY}093000")
    name_files(spark, bad, cfg.sources["second"], "Bad", DAY, PAYLOAD_SUFFIX)
    with suppress(PySparkException):
        daily_load(spark, cfg)
    daily_load(spark, replace(cfg, money_on_error="null"))
    table = spark.read.parquet(f"{cfg.target}/ORD/AcctActReturnFile")
    return _retyped(_naive(table, "o_orderdate"), ORDERS)


def loss_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as twelve placement files, some with texts that are no dates or amounts, some too wide: what the load lost."""
    orders = _table(spark, sf_dir, "orders")
    root = fresh_folder(spark, "losses")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    opened = (
        F.when(status == "F", day)
        .when((status == "P") & (key % 50 == 7), day)
        .when((status == "O") & (key % 11 == 0), "")
        .when((status == "O") & (key % 26 == 5), "n/a")
        .otherwise(_stamp("o_orderdate"))
    )
    amount = (
        F.when((status == "F") & (key % 7 == 0), F.concat(key, F.lit("d")))
        .when((status == "P") & (key % 5 == 0), F.concat(F.lit("$"), key % 100))
        .when(key % 9 == 0, " ")
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    part = F.concat(status, key % 4)
    extra = F.when(part == "P3", "|x|y").otherwise("")
    line = F.concat(F.concat_ws("|", key, opened, amount, "o_orderpriority"), extra)
    dealt = orders.withColumn("part", part).repartition("part")
    parts = write_lines(dealt, line, f"{root}/parts", f"HDR|{PLACEMENT_FEED}|{DAY}093000", part="part")
    for name in (f"{s}{n}" for s in "FOP" for n in range(4)):
        if Files(spark).exists(f"{parts}/part={name}"):
            name_files(spark, f"{parts}/part={name}", f"{root}/first", name, DAY, PAYLOAD_SUFFIX)
    markers = write_lines(spark.range(0, 6, 1, 6), F.lit("x"), f"{root}/markers")
    name_files(spark, markers, f"{root}/first", "Marker", DAY, MARKER_SUFFIX)
    names = {"apf_acctplacementfile": ["accountno", "placementdate", "balance", "note"]}
    registry = spark.createDataFrame([(json.dumps(names),)], "value string")
    registry.coalesce(1).write.text(f"{root}/registry")
    cfg = LoadConfig(
        sources={"first": f"{root}/first"},
        registry=f"{root}/registry",
        target=f"{root}/published",
        ledger=f"{root}/ledger",
        work=f"{root}/work",
        syncday=DAY,
        money_on_error="null",
    )
    losses = daily_load(spark, cfg).losses
    stem = F.regexp_extract("file", r"([FOP][0-3])_0_[0-9]+[.][a-z]+$", 1)
    return losses.select(stem.alias("part"), "recordtype", "column", "reason", "lost", F.array_join("texts", " ").alias("texts"))


def full_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each published table holds after a whole load."""
    cfg = _ingested(spark, sf_dir)

    def summary(recordtype: str, feed: str, key: str, amount: str, day: str) -> DataFrame:
        cents = F.sum(F.col(amount).cast("decimal(18,2)"))
        return (
            spark.read.parquet(f"{cfg.target}/{recordtype}/{feed}")
            .groupBy("recordtype")
            .agg(
                F.count("*").alias("rows"),
                F.sum(F.col(key).cast("bigint")).alias("keys"),
                cents.cast("double").alias("amount"),
                F.min(day).cast("timestamp_ntz").alias("first_day"),
                F.max(day).cast("timestamp_ntz").alias("last_day"),
            )
        )

    return union_sources(
        summary("ORD", "AcctActReturnFile", "o_orderkey", "o_totalprice", "o_orderdate"),
        summary("LIN", "AcctActReturnFile", "l_orderkey", "l_extendedprice", "l_shipdate"),
        summary(PLACEMENT_FEED, PLACEMENT_FEED, "accountno", "balance", "snap_dt"),
        summary(QUEUE_RECORDTYPE, QUEUE_RECORDTYPE, "c_custkey", "c_acctbal", "snap_dt"),
    )


PROBES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "delimited_scan": delimited_scan,
    "queue_inferred": queue_inferred,
    "line_scan": line_scan,
    "file_select": file_select,
    "kind_route": kind_route,
    "registry_lookup": registry_lookup,
    "snapshot_from_name": snapshot_name,
    "feed_header": feed_headers,
    "feed_header_scan": feed_headers_scanned,
    "strip_contains": strip_contains,
    "strip_type": strip_type,
    "first_split": first_split,
    "record_types": record_type_list,
    "demux": demultiplex,
    "unpack": unpack_columns,
    "pad_short": pad_short,
    "overflow_one": overflow_one,
    "width_guard": width_verdicts,
    "width_rejects": width_rejects,
    "coerce_dates": coerced_dates,
    "queue_dates": queue_dates,
    "fallback_dates": fallback_dates,
    "fallback_dates_row": fallback_dates_by_row,
    "money_doubles": money_doubles,
    "money_lenient": money_lenient,
    "null_tokens": missing_tokens,
    "literal_repair": literal_repair,
    "arrival_counts": arrivals,
    "completeness": complete_days,
    "completeness_strict": complete_days_strict,
    "union_sources": sources_union,
    "parquet_sink": parquet_sink,
    "publish": publish_days,
    "run_ledger": run_ledger,
    "resume_pending": resume_pending,
    "latest_status": last_status,
    "ingest_orders": ingest_orders,
    "ingest_lineitem": ingest_lineitem,
    "full_ingest": full_ingest,
    "late_merge": late_merge,
    "resume_steps": resume_steps,
    "loss_summary": loss_summary,
}
