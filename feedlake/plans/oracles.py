"""The SQL each probe must agree with; it reads the original tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "delimited_scan": "SELECT 'QueueExport' AS recordtype, * FROM customer",
    "queue_inferred": """
        SELECT 'QueueExport' AS recordtype, c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment
        FROM customer""",
    "line_scan": """
        SELECT event_type, count(*) AS lines,
               sum(length(concat_ws('|', event_type, event_id, strftime(ts, '%Y%m%d%H%M%S'),
                                    user_id, props)))::BIGINT AS characters
        FROM events GROUP BY event_type""",
    "file_select": """
        SELECT '2024010' || (n_regionkey + 1) AS day, count(*) AS lines,
               sum(c_custkey)::BIGINT AS keys
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_regionkey""",
    "kind_route": """
        WITH named AS (
            SELECT o_orderkey,
                   CASE o_orderpriority
                       WHEN '1-URGENT' THEN 'QueueExport'
                       WHEN '2-HIGH' THEN 'AccountPlacementImportFile'
                       WHEN '3-MEDIUM' THEN 'AccountPlacementImportFile_QueueExport'
                       ELSE 'AgentReturnFile'
                   END || '_' || strftime(o_orderdate, '%Y%m%d') || '.pgp' AS name
            FROM orders)
        SELECT o_orderkey, name,
               CASE WHEN name LIKE '%QueueExport%' THEN 'queue' ELSE 'feed' END AS kind,
               name NOT LIKE '%QueueExport%' AND name LIKE '%AccountPlacementImportFile%' AS repair
        FROM named""",
    "registry_lookup": """
        WITH registry(key, columns, names) AS (
            VALUES ('cmc_aar_economy', 2::BIGINT, 'accountno,actiondate'),
                   ('cmc_aar_large', 2, 'accountno,amount'),
                   ('cmc_aar_medium', 1, 'accountno'),
                   ('cmc_aar_promo', 3, 'accountno,code,text'),
                   ('cmc_aar_small', 0, ''))
        SELECT p_partkey, key, columns, names
        FROM part LEFT JOIN registry ON key = 'cmc_aar_' || lower(p_type)""",
    "snapshot_from_name": """
        SELECT o_orderkey, date_trunc('day', o_orderdate)::TIMESTAMP AS snap_dt FROM orders""",
    "feed_header": """
        WITH kinds AS (
            SELECT event_type, dense_rank() OVER (ORDER BY event_type) AS n, event_id FROM events)
        SELECT event_type AS feed, strptime('202401' || lpad(n::VARCHAR, 2, '0'), '%Y%m%d') AS snap_dt,
               count(*) AS lines, sum(event_id)::BIGINT AS ids
        FROM kinds GROUP BY event_type, n""",
    "strip_contains": """
        SELECT doc_id, 'and' AS recordtype, text AS custom
        FROM documents WHERE NOT contains(text, 'and')""",
    "strip_type": """
        SELECT event_type AS recordtype, event_id || '|' || user_id AS custom
        FROM events WHERE event_type <> 'error'""",
    "first_split": """
        SELECT doc_id, lang AS recordtype, CASE WHEN lang <> 'es' THEN text END AS custom
        FROM documents""",
    "record_types": """
        SELECT DISTINCT l_linestatus AS file, l_returnflag AS recordtype FROM lineitem""",
    "demux": "SELECT * FROM orders",
    "unpack": "SELECT *, TIMESTAMP '2024-01-15 00:00:00' AS snap_dt FROM lineitem",
    "pad_short": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority
        FROM orders""",
    "overflow_one": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "width_guard": """
        SELECT source, max(len(string_split(text, '|')))::BIGINT AS width,
               max(len(string_split(text, '|'))) BETWEEN 1 AND 101 AS fits
        FROM documents GROUP BY source""",
    "width_rejects": """
        SELECT doc_id, source,
               CASE WHEN max(len(string_split(text, '|'))) OVER (PARTITION BY source) > 101
                    THEN 'width' END AS reason
        FROM documents""",
    "coerce_dates": """
        WITH texts AS (
            SELECT o_orderkey, o_orderstatus,
                   CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d%H%M%S') || 'x'
                        WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN ''
                        WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y%m') || '32000000'
                        ELSE strftime(o_orderdate, '%Y%m%d%H%M%S') END AS opendate,
                   strftime(o_orderdate, '%Y%m%d') AS updatedate
            FROM orders)
        SELECT o_orderkey, o_orderstatus,
               try_strptime(opendate, '%Y%m%d%H%M%S') AS opendate, updatedate
        FROM texts""",
    "queue_dates": """
        WITH texts AS (
            SELECT o_orderkey, o_orderstatus,
                   CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                        WHEN o_orderkey % 5 = 0 THEN ''
                        ELSE strftime(o_orderdate, '%Y%m%d') END AS opendate,
                   strftime(o_orderdate, '%Y%m%d') AS updatedate
            FROM orders)
        SELECT o_orderkey, o_orderstatus,
               coalesce(try_strptime(opendate, '%Y-%m-%d %H:%M:%S'),
                        try_strptime(opendate, '%Y%m%d')) AS opendate, updatedate
        FROM texts""",
    "fallback_dates": """
        WITH texts AS (
            SELECT o_orderkey, o_orderstatus,
                   CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d')
                        WHEN o_orderstatus = 'P' AND o_orderkey % 1000 = 7
                            THEN strftime(o_orderdate, '%Y%m%d')
                        WHEN o_orderkey % 11 = 0 THEN ''
                        ELSE strftime(o_orderdate, '%Y%m%d%H%M%S') END AS opendate,
                   strftime(o_orderdate, '%Y%m%d') AS updatedate
            FROM orders),
        judged AS (
            SELECT *, bool_and(opendate = '' OR try_strptime(opendate, '%Y%m%d%H%M%S') IS NOT NULL)
                          OVER (PARTITION BY o_orderstatus) AS fits
            FROM texts)
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN fits THEN try_strptime(opendate, '%Y%m%d%H%M%S')
                    ELSE try_strptime(opendate, '%Y%m%d') END AS opendate, updatedate
        FROM judged""",
    "fallback_dates_row": """
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 1000 = 7)
                         OR o_orderkey % 11 <> 0
                    THEN o_orderdate END AS opendate,
               strftime(o_orderdate, '%Y%m%d') AS updatedate
        FROM orders""",
    "money_doubles": """
        WITH texts AS (
            SELECT 'supplier' AS owner, s_suppkey AS id, s_acctbal AS amount FROM supplier
            UNION ALL
            SELECT 'customer', c_custkey, c_acctbal FROM customer)
        SELECT owner, id,
               coalesce(try_cast(nullif(trim(CASE WHEN id % 6 = 0 THEN '   '
                                                  WHEN id % 6 <> 1 THEN '  ' || amount || ' '
                                             END), '') AS DOUBLE), 0.0) AS balance
        FROM texts""",
    "money_lenient": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END AS balance
        FROM orders""",
    "null_tokens": """
        SELECT c_custkey, CASE WHEN c_custkey % 57 >= 19 THEN c_name END AS c_name FROM customer""",
    "literal_repair": """
        SELECT doc_id, replace(replace(text, 'and ', '& '), '& t', '|t') AS text FROM documents""",
    "arrival_counts": """
        SELECT c_mktsegment AS source,
               count(*) FILTER (c_custkey % 3 = 0) AS markers,
               count(*) FILTER (c_custkey % 3 <> 0) AS payloads
        FROM customer GROUP BY ROLLUP (c_mktsegment)""",
    "completeness": """
        WITH counts AS (
            SELECT strftime(o_orderdate, '%Y%m%d') AS day,
                   count(*) FILTER (o_custkey % 2 = 0) AS markers,
                   count(*) FILTER (o_custkey % 2 <> 0) AS payloads,
                   count(*) FILTER (o_custkey % 2 <> 0 AND o_orderstatus <> 'F') AS second_payloads
            FROM orders GROUP BY 1)
        SELECT *, CASE WHEN second_payloads >= 5 THEN 7 ELSE 6 END::INTEGER AS expected,
               CASE WHEN markers >= 6 THEN 'ok'
                    WHEN payloads = CASE WHEN second_payloads >= 5 THEN 7 ELSE 6 END
                        THEN 'ok_without_markers'
                    ELSE 'incomplete' END AS status
        FROM counts""",
    "completeness_strict": """
        WITH counts AS (
            SELECT count(*) FILTER (o_custkey % 2 = 0) AS markers FROM orders
            GROUP BY date_trunc('day', o_orderdate))
        SELECT CASE WHEN markers >= 6 THEN 'ok' ELSE 'incomplete' END AS status, count(*) AS days
        FROM counts GROUP BY 1""",
    "union_sources": """
        SELECT 'supplier' AS source, s_name AS name, s_nationkey AS nation FROM supplier
        UNION ALL
        SELECT 'customer', c_name, c_nationkey FROM customer""",
    "parquet_sink": """
        SELECT *, date_trunc('year', o_orderdate)::TIMESTAMP AS snap_dt,
               strftime(o_orderdate, '%Y-01-01') AS snap_day
        FROM orders""",
    "publish": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
               CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '2024-01-15 00:00:00'
                    ELSE TIMESTAMP '2024-01-16 00:00:00' END AS snap_dt,
               count(*) FILTER (o_orderstatus <> 'F') OVER () AS held_back
        FROM orders""",
    "run_ledger": """
        SELECT strftime(ts, '%Y-%m-%d') AS period,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
               count(*) AS runs,
               count(CASE WHEN event_type = 'error' THEN props END) AS messages,
               sum(floor(value * 10)::BIGINT)::BIGINT AS records,
               sum(floor(value)::BIGINT)::BIGINT AS seconds,
               round(max(floor(value)) / 60, 2) AS longest_minutes,
               (SELECT count(*) FROM events) AS appended
        FROM events GROUP BY 1, 2""",
    "resume_pending": """
        SELECT '/in/' || o_orderkey || '.pgp' AS path, o_orderdate AS "modificationTime"
        FROM orders
        WHERE NOT EXISTS (
            SELECT 1 FROM lineitem
            WHERE l_orderkey = o_orderkey AND l_returnflag = 'R'
              AND (l_linestatus = 'O' OR l_shipdate = o_orderdate))""",
    "latest_status": """
        SELECT user_id AS task_name, arg_max(event_type, (ts, event_id)) AS status
        FROM events GROUP BY user_id""",
    "ingest_orders": "SELECT * FROM orders",
    "ingest_lineitem": "SELECT * FROM lineitem",
    "late_merge": "SELECT * FROM orders",
    "resume_steps": "SELECT * FROM orders",
    "loss_summary": """
        WITH rows AS (
            SELECT o_orderstatus || (o_orderkey % 4) AS part,
                   CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 50 = 7)
                            THEN strftime(o_orderdate, '%Y%m%d')
                        WHEN o_orderstatus = 'O' AND o_orderkey % 11 = 0 THEN ''
                        WHEN o_orderstatus = 'O' AND o_orderkey % 26 = 5 THEN 'n/a'
                        ELSE strftime(o_orderdate, '%Y%m%d%H%M%S') END AS opened,
                   CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 = 0 THEN o_orderkey || 'd'
                        WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN '$' || (o_orderkey % 100)
                   END AS amount
            FROM orders),
        judged AS (
            SELECT *, bool_and(opened = '' OR length(opened) = 14) OVER (PARTITION BY part) AS fits
            FROM rows),
        lost AS (
            SELECT part, 'placementdate' AS "column", 'date' AS reason, opened AS text FROM judged
            WHERE part <> 'P3' AND NOT fits AND opened <> '' AND length(opened) <> 8
            UNION ALL
            SELECT part, 'balance', 'amount', amount FROM judged WHERE part <> 'P3' AND amount IS NOT NULL
            UNION ALL
            SELECT part, NULL, 'width', NULL FROM judged WHERE part = 'P3')
        SELECT part, 'AcctPlacementFile' AS recordtype, "column", reason, count(*) AS lost,
               coalesce(array_to_string(
                   list_sort(list(DISTINCT text) FILTER (text IS NOT NULL))[1:3], ' '), '') AS texts
        FROM lost GROUP BY part, "column", reason""",
    "full_ingest": """
        SELECT 'ORD' AS recordtype, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys,
               sum(o_totalprice::DECIMAL(18, 2))::DOUBLE AS amount,
               min(o_orderdate) AS first_day, max(o_orderdate) AS last_day
        FROM orders
        UNION ALL
        SELECT 'LIN', count(*), sum(l_orderkey)::BIGINT,
               sum(l_extendedprice::DECIMAL(18, 2))::DOUBLE, min(l_shipdate), max(l_shipdate)
        FROM lineitem
        UNION ALL
        SELECT 'AcctPlacementFile', count(*), sum(s_suppkey)::BIGINT,
               sum(s_acctbal::DECIMAL(18, 2))::DOUBLE,
               TIMESTAMP '2024-01-15 00:00:00', TIMESTAMP '2024-01-15 00:00:00'
        FROM supplier
        UNION ALL
        SELECT 'QueueExport', count(*), sum(c_custkey)::BIGINT,
               sum(c_acctbal::DECIMAL(18, 2))::DOUBLE,
               TIMESTAMP '2024-01-15 00:00:00', TIMESTAMP '2024-01-15 00:00:00'
        FROM customer""",
}
ORACLES["feed_header_scan"] = ORACLES["feed_header"]
