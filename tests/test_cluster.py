"""Queries that keep files in the shared folder, in a session whose master is a cluster."""

import duckdb
import pytest

from feedlake.plans.oracles import ORACLES
from feedlake.plans.probes import PROBES

# The shared folder of the tests' session has no scheme, as /tmp/checkpoints has none.
MASTER = "spark://elsewhere:7077"

ON_CLUSTER = [
    "demux",
    "fallback_dates",
    "feed_header",
    "feed_header_scan",
    "full_ingest",
    "file_select",
    "ingest_lineitem",
    "ingest_orders",
    "late_merge",
    "line_scan",
    "loss_summary",
    "pad_short",
    "overflow_one",
    "parquet_sink",
    "publish",
    "queue_dates",
    "queue_inferred",
    "registry_lookup",
    "run_ledger",
    "resume_steps",
]

TABLES = {
    "nation": "SELECT i::INT AS n_nationkey, 'NATION_' || i AS n_name, (i % 5)::INT AS n_regionkey FROM range(25) r(i)",
    "customer": """
        SELECT i AS c_custkey, 'Customer#' || i AS c_name, (i % 25)::INT AS c_nationkey,
               (i * 7 % 90 - 9) + 0.25 AS c_acctbal, ['FURNITURE', 'MACHINERY'][i % 2 + 1] AS c_mktsegment
        FROM range(60) r(i)""",
    "supplier": """
        SELECT i AS s_suppkey, 'Supplier#' || i AS s_name, (i % 25)::INT AS s_nationkey,
               i * 11 % 50 + 0.5 AS s_acctbal
        FROM range(20) r(i)""",
    "part": """
        SELECT i AS p_partkey, 'ring ' || i AS p_name, 'Brand#1' AS p_brand,
               ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'][i % 6 + 1] AS p_type,
               1 AS p_size, 900 + i + 0.5 AS p_retailprice
        FROM range(40) r(i)""",
    "orders": """
        SELECT i AS o_orderkey, i % 60 AS o_custkey, ['F', 'O', 'P'][i % 3 + 1] AS o_orderstatus,
               1000 + i + 0.75 AS o_totalprice, TIMESTAMP '1996-02-27' + to_days(i::INT) AS o_orderdate,
               ['1-URGENT', '2-HIGH', '5-LOW'][i % 3 + 1] AS o_orderpriority
        FROM range(240) r(i)""",
    "lineitem": """
        SELECT i // 2 AS l_orderkey, i % 40 AS l_partkey, i % 20 AS l_suppkey, (i % 2 + 1)::INT AS l_linenumber,
               i % 50 + 0.0 AS l_quantity, 500 + i + 0.25 AS l_extendedprice, 0.05 AS l_discount, 0.02 AS l_tax,
               ['A', 'N', 'R'][i % 3 + 1] AS l_returnflag, ['F', 'O'][i % 2 + 1] AS l_linestatus,
               TIMESTAMP '1996-03-01' + to_days(i::INT) AS l_shipdate
        FROM range(480) r(i)""",
    "events": """
        SELECT i AS event_id, TIMESTAMP '2024-01-01 00:00:11' + to_minutes(i * 97) AS ts, i % 30 AS user_id,
               ['click', 'error', 'view'][i % 3 + 1] AS event_type, i * 13 % 400 + 0.5 AS value,
               '{"k": ' || i || '}' AS props
        FROM range(300) r(i)""",
}


@pytest.fixture(scope="module")
def small(tmp_path_factory):
    """A folder with a few rows of each table, and a connection that sees them."""
    folder = tmp_path_factory.mktemp("tables")
    connection = duckdb.connect()
    for name, rows in TABLES.items():
        doubles = [c for c, kind, *_ in connection.execute(f"DESCRIBE {rows}").fetchall() if kind.startswith("DECIMAL")]
        typed = ", ".join(f"{c}::DOUBLE AS {c}" for c in doubles)
        chosen = f"* REPLACE ({typed})" if typed else "*"
        connection.execute(f"COPY (SELECT {chosen} FROM ({rows})) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    yield str(folder), connection
    connection.close()


@pytest.mark.parametrize("name", ON_CLUSTER)
def test_query_agrees_with_its_sql_on_a_cluster(spark, small, name, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", MASTER)
    folder, duck = small
    got = PROBES[name](spark, folder)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(columns)
    want = sorted(expected.fetchall(), key=repr)
    assert want
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == want
