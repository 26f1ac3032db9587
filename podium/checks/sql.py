"""The SQL each query must agree with, run by another engine on the same tables."""

from __future__ import annotations


def _rounded(value: str, scale: int) -> str:
    """`value` rounded half up in its shortest decimal form, which is how Spark rounds a double."""
    return (
        f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,17)), {scale}) AS DOUBLE)"
    )


def _cleaned(value: str) -> str:
    keep = r"""[^a-zA-Z0-9,.\\"'']"""
    return f"regexp_replace(coalesce({value}, 'None'), '{keep}', '', 'g')"


_EVENT_STATS = f"""
SELECT event_type, c_mktsegment,
       {_rounded("avg(value)", 3)} AS avg_value,
       {_rounded("avg(c_acctbal)", 3)} AS avg_acctbal
FROM events JOIN customer ON user_id = c_custkey
GROUP BY event_type, c_mktsegment
"""

def _gold(balance: str) -> str:
    return f"""
        SELECT {_cleaned("o_orderpriority")} AS o_orderpriority, {_cleaned("o_orderstatus")} AS o_orderstatus,
               {_cleaned("c_mktsegment")} AS c_mktsegment, c_nationkey,
               {_rounded(f"avg(CAST({balance} AS FLOAT))", 2)} AS avg_weight,
               {_rounded("avg(CAST(o_totalprice AS FLOAT))", 2)} AS avg_height
        FROM customer JOIN orders ON c_custkey = o_custkey
        GROUP BY ALL
    """


# Text loses its minus signs when it is cleaned, numbers do not.
_GOLD_OF_TEXT, _GOLD_OF_CLEANED = _gold("abs(c_acctbal)"), _gold("c_acctbal")

SQL: dict[str, str] = {
    "q_gold_avg_stats": f"""
        SELECT o_orderpriority, o_orderstatus, c_mktsegment, c_nationkey,
               {_rounded("avg(CAST(c_acctbal AS FLOAT))", 2)} AS avg_weight,
               {_rounded("avg(CAST(o_totalprice AS FLOAT))", 2)} AS avg_height
        FROM customer JOIN orders ON c_custkey = o_custkey
        GROUP BY ALL
    """,
    "q_stats_double_3dp": f"""
        SELECT o_orderpriority, o_orderstatus, c_mktsegment,
               {_rounded("avg(o_totalprice)", 3)} AS avg_height,
               {_rounded("avg(c_acctbal)", 3)} AS avg_weight
        FROM customer JOIN orders ON c_custkey = o_custkey
        GROUP BY ALL
    """,
    "q_stats_unrounded": f"""
        SELECT o_orderpriority, c_mktsegment,
               {_rounded("avg(o_totalprice)", 6)} AS avg_height,
               {_rounded("avg(c_acctbal)", 6)} AS avg_weight
        FROM customer JOIN orders ON c_custkey = o_custkey
        GROUP BY ALL
    """,
    "q_stats_stamped": f"""
        SELECT o_orderpriority, c_mktsegment, {_rounded("avg(o_totalprice)", 3)} AS avg_height,
               TRUE AS stamped
        FROM customer JOIN orders ON c_custkey = o_custkey
        GROUP BY o_orderpriority, c_mktsegment
    """,
    "q_stats_whole_keys": f"""
        SELECT o_orderpriority, c_mktsegment, {_rounded("avg(o_totalprice)", 3)} AS avg_height
        FROM customer JOIN orders ON c_custkey = o_custkey
        WHERE o_orderkey % 5 < 3
        GROUP BY o_orderpriority, c_mktsegment
    """,
    "q_clean_text": f"""
        SELECT p_partkey, {_cleaned("p_name")} AS p_name, {_cleaned("p_brand")} AS p_brand
        FROM part
    """,
    "q_clean_documents": f"SELECT doc_id, {_cleaned('text')} AS text FROM documents",
    "q_clean_all_strings": f"""
        SELECT c_custkey, {_cleaned("c_name")} AS c_name, c_nationkey, c_acctbal,
               {_cleaned("c_mktsegment")} AS c_mktsegment
        FROM customer
    """,
    "q_silver_dedup": f"""
        SELECT DISTINCT {_cleaned("o_orderpriority")} AS o_orderpriority,
               {_cleaned("o_orderstatus")} AS o_orderstatus, o_custkey
        FROM orders
    """,
    "q_silver_documents": f"""
        SELECT DISTINCT {_cleaned("text")} AS text, {_cleaned("lang")} AS lang,
               {_cleaned("source")} AS source, n_chars
        FROM documents
    """,
    "q_numeric_rows": """
        SELECT p_partkey, try_cast(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no,
               try_cast(p_name AS DOUBLE) AS name_no,
               try_cast(CASE WHEN p_size <= 25 THEN CAST(p_size AS VARCHAR) ELSE p_name END
                        AS DOUBLE) AS size_text
        FROM part
        WHERE try_cast(CASE WHEN p_size <= 25 THEN CAST(p_size AS VARCHAR) ELSE p_name END
                       AS DOUBLE) IS NOT NULL
    """,
    "q_parse_born": """
        SELECT o_orderkey,
               CAST(try_strptime(strftime(o_orderdate, '%-d%B%Y'), '%-d%B%Y') AS DATE) AS born
        FROM orders
    """,
    "q_join_using": """
        SELECT o_custkey AS custkey, o_orderkey, c_mktsegment, o_orderstatus
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "q_hot_key_join": """
        SELECT c_custkey AS user_id, event_id, event_type, c_mktsegment
        FROM events
        JOIN customer ON CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END = c_custkey
    """,
    "q_latest_per_key": """
        SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value
        FROM events GROUP BY user_id, event_type
    """,
    "q_distinct_sorted": """
        SELECT DISTINCT c_mktsegment, c_nationkey FROM customer ORDER BY c_nationkey, c_mktsegment
    """,
    "q_limit_rows": """
        SELECT least(5, count(*)) AS n, least(5, count(*)) AS n_different FROM customer
    """,
    "q_limit_zero_schema": "SELECT * FROM customer LIMIT 0",
    "q_count_rows": "SELECT count(*) AS n FROM orders",
    "q_to_json": "SELECT * FROM orders",
    "q_keyed_messages": "SELECT CAST(c_custkey AS VARCHAR) AS key, * FROM customer",
    # Messages carry times to the millisecond.
    "q_payload_key": """
        SELECT value AS key, * REPLACE (date_trunc('millisecond', ts) AS ts) FROM events
    """,
    "q_uuid_key": """
        SELECT count(*) AS n_keys, count(*) AS n_uuids, count(DISTINCT c_custkey) AS n_customers
        FROM customer
    """,
    "q_from_json": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
    """,
    "q_bad_messages": """
        SELECT event_id,
               CASE WHEN event_type IN ('error', 'purchase') THEN NULL
                    ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
               CASE event_type WHEN 'error' THEN event_type
                               WHEN 'purchase' THEN '{"k": "none"}' END AS bad_record
        FROM events
    """,
    "q_topic_batch": f"""
        SELECT event_type, c_mktsegment,
               {_rounded("avg(value)", 6)} AS avg_value,
               {_rounded("avg(c_acctbal)", 6)} AS avg_acctbal
        FROM events JOIN customer ON user_id = c_custkey
        GROUP BY event_type, c_mktsegment
    """,
    "q_csv_bronze": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders
    """,
    # The cleaner removes minus signs, hence abs.
    "q_lake_end_to_end": f"""
        WITH c AS (
            SELECT DISTINCT c_custkey, abs(c_acctbal) AS c_acctbal,
                   {_cleaned("c_mktsegment")} AS c_mktsegment
            FROM customer WHERE c_custkey % 50 <> 7
        ), o AS (
            SELECT DISTINCT o_orderkey, o_custkey, o_totalprice,
                   {_cleaned("o_orderpriority")} AS o_orderpriority
            FROM orders WHERE o_orderkey % 50 <> 7
        )
        SELECT o_orderpriority, c_mktsegment,
               {_rounded("avg(CAST(c_acctbal AS FLOAT))", 2)} AS avg_weight,
               {_rounded("avg(CAST(o_totalprice AS FLOAT))", 2)} AS avg_height
        FROM c JOIN o ON c_custkey = o_custkey
        GROUP BY o_orderpriority, c_mktsegment
    """,
    "q_jdbc_round_trip": "SELECT * FROM customer",
    "q_publish_table": """
        SELECT CAST(c_custkey AS VARCHAR) AS key, c_custkey AS custkey, c_name, c_nationkey,
               c_acctbal, c_mktsegment
        FROM customer
    """,
    "q_stream_medal_stats": _EVENT_STATS,
    "q_stream_to_database": _EVENT_STATS,
    "q_stream_trigger": _EVENT_STATS,
    "q_stream_fan_out": """
        SELECT sink, events.* REPLACE (date_trunc('millisecond', ts) AS ts), TRUE AS stamped
        FROM events CROSS JOIN (VALUES ('files'), ('topic')) AS sinks(sink)
    """,
    # Windows that are still open at the final watermark are not emitted.
    "q_stream_windowed": f"""
        WITH mark AS (SELECT max(ts) - INTERVAL 10 MINUTE AS wm FROM events)
        SELECT date_trunc('hour', ts) AS w_start, event_type, count(*) AS n,
               {_rounded("avg(value)", 3)} AS avg_value
        FROM events, mark
        GROUP BY date_trunc('hour', ts), event_type
        HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= max(wm)
    """,
    "q_versioned_layer": """
        SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 2 = 0
    """,
    "q_lake_in_versions": _GOLD_OF_TEXT,
    "q_incremental_silver": f"""
        SELECT DISTINCT {_cleaned("o_orderpriority")} AS o_orderpriority,
               {_cleaned("o_orderstatus")} AS o_orderstatus, o_custkey
        FROM orders
    """,
    "q_incremental_gold": _GOLD_OF_CLEANED,
    "q_gold_by_key": _GOLD_OF_CLEANED,
    "q_stream_once": """
        SELECT sink, events.* REPLACE (date_trunc('millisecond', ts) AS ts)
        FROM events CROSS JOIN (VALUES ('files'), ('table')) AS sinks(sink)
    """,
    "q_stream_merged": _EVENT_STATS,
    "q_folded_history": _EVENT_STATS,
    "q_along_curve": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        WHERE l_partkey <= (SELECT max(l_partkey) // 8 FROM lineitem)
          AND l_suppkey <= (SELECT max(l_suppkey) // 8 FROM lineitem)
    """,
    "q_even_ranges": """
        SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL
                              WHEN event_id % 10 > 0 THEN user_id % 100 ELSE user_id * 1000 END AS key
        FROM events
    """,
    "q_reference_by_version": """
        WITH middle AS (
            SELECT min(ts) + to_microseconds(datediff('microsecond', min(ts), max(ts)) // 2) AS changed FROM events
        )
        SELECT event_id, user_id,
               CASE WHEN user_id % 3 = 0 AND ts >= changed THEN 'NEW ' || c_mktsegment ELSE c_mktsegment END AS c_mktsegment
        FROM events JOIN customer ON user_id = c_custkey, middle
    """,
    "q_unknown_payload": """
        SELECT event_id,
               CASE WHEN event_type NOT IN ('error', 'purchase')
                    THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
               CASE event_type WHEN 'error' THEN NULL WHEN 'purchase' THEN 'none'
                    ELSE json_extract_string(props, '$.k') END AS k_text,
               CASE WHEN event_type = 'purchase' THEN 5 END AS n
        FROM events
    """,
    # Late rows are dropped; windows that are still open at the final watermark are not emitted.
    "q_stream_late_rows": f"""
        WITH ends AS (SELECT min(ts) AS first, max(ts) AS last FROM events),
        timed AS (
            SELECT *, datediff('microsecond', first, ts) * 4 // (datediff('microsecond', first, last) + 1) AS part
            FROM events, ends
        )
        SELECT date_trunc('hour', ts) AS w_start, event_type, count(*) AS n,
               {_rounded("avg(value)", 3)} AS avg_value
        FROM timed
        WHERE NOT (part = 0 AND event_id % 20 = 0)
        GROUP BY date_trunc('hour', ts), event_type
        HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= max(last) - INTERVAL 10 MINUTE
    """,
}
