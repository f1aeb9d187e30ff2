"""The answer to each query as DuckDB SQL over the given tables."""

from __future__ import annotations


def _shard(key: str, shards: int = 4) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR), 1, 8))::BIGINT % {shards})::INTEGER"


_RECORDS = f"""
    SELECT event_type AS stream, {_shard("user_id")} AS shard_id, event_id AS sequence_number,
           user_id::VARCHAR AS partition_key, ts AS arrival_ts, props AS value
    FROM events
"""

_WITH_RECORDS = f"WITH records AS ({_RECORDS})"

_NUMBERED = "row_number() OVER (PARTITION BY stream, shard_id ORDER BY sequence_number)"

_PAGED = f"{_WITH_RECORDS}, paged AS (SELECT *, {_NUMBERED} AS place FROM records)"

_TEXTS = "SELECT props AS value FROM events"

_PUT = f"""
    {_WITH_RECORDS}
    SELECT stream, shard_id, {_NUMBERED} - 1 AS sequence_number, partition_key, arrival_ts, value
    FROM records
"""

_IN_BATCHES = f"""
    {_WITH_RECORDS}, batched AS (
        SELECT *, least((day(arrival_ts) - 1) // 10, 2) AS batch_id FROM records
    ), landed AS (
        SELECT stream, shard_id, batch_id,
               batch_id * 4294967296
                   + row_number() OVER (
                       PARTITION BY stream, shard_id, batch_id ORDER BY sequence_number
                   ) - 1 AS sequence_number,
               partition_key, arrival_ts, value
        FROM batched
    )
"""

_ACROSS = f"""
    {_IN_BATCHES}, starts AS (
        SELECT stream, shard_id, greatest(max(sequence_number) + 1 - 5, 0) AS start
        FROM landed WHERE batch_id = 0 GROUP BY stream, shard_id
    ), paged AS (
        SELECT landed.*, {_NUMBERED} AS place
        FROM landed JOIN starts USING (stream, shard_id) WHERE sequence_number >= start
    )
"""

_BY_THE_DAY = f"""
    {_WITH_RECORDS}, days AS (
        SELECT *, date_diff('day', DATE '2024-01-01', arrival_ts::DATE) AS batch_id FROM records
    ), landed AS (
        SELECT stream, shard_id, batch_id,
               batch_id * 4294967296
                   + row_number() OVER (
                       PARTITION BY stream, shard_id, batch_id ORDER BY sequence_number
                   ) - 1 AS sequence_number,
               partition_key, arrival_ts, value
        FROM days
    )
"""

_PAGE = "stream, shard_id, sequence_number, partition_key, arrival_ts, value"

ORACLES: dict[str, str] = {
    "stream_consume": _TEXTS,
    "stream_spread": _TEXTS,
    "stream_handlers": """
        SELECT props AS value, sink FROM events, (VALUES ('text'), ('log')) AS sinks (sink)
    """,
    "stream_union": f"""
        {_TEXTS} UNION ALL
        SELECT concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS value
        FROM lineitem
    """,
    "stream_latest": f"""
        {_WITH_RECORDS}
        SELECT stream, shard_id, partition_key, arrival_ts, value FROM records
    """,
    "stream_put": f"""
        WITH records AS (
            SELECT event_type AS stream, {_shard("user_id", 8)} AS shard_id, ts AS arrival_ts,
                   user_id::VARCHAR AS partition_key, props AS value
            FROM events
        )
        SELECT stream, shard_id,
               row_number() OVER (PARTITION BY stream, shard_id ORDER BY arrival_ts) - 1
                   AS sequence_number,
               partition_key, arrival_ts, value
        FROM records
    """,
    "decode_records": "SELECT event_id AS sequence_number, props AS value FROM events",
    "decode_documents": "SELECT doc_id, text AS value FROM documents",
    "shard_union": f"""
        SELECT shard_id, sequence_number, value FROM ({_PUT})
    """,
    "repartition_records": "SELECT event_id AS sequence_number, props AS value FROM events",
    "batch_preview": """
        SELECT event_id AS sequence_number, props AS value FROM events ORDER BY event_id LIMIT 10
    """,
    "batch_count": "SELECT count(*) AS records FROM events",
    "batch_stats_spread": "SELECT count(*) AS records, 6 AS partitions FROM events",
    "microbatch_counts": """
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS batch_start, count(*) AS records
        FROM events GROUP BY 1
    """,
    "put_records": _PUT,
    "put_replay": _PUT,
    "put_conversations": f"""
        WITH records AS (
            SELECT role AS stream, {_shard("conv_id")} AS shard_id, conv_id, turn,
                   conv_id::VARCHAR AS partition_key, text AS value
            FROM conversations
        )
        SELECT stream, shard_id,
               3 * 4294967296
                   + row_number() OVER (PARTITION BY stream, shard_id ORDER BY conv_id, turn) - 1
                   AS sequence_number,
               partition_key, TIMESTAMP '2024-01-01' AS arrival_ts, value
        FROM records
    """,
    "number_hot_shards": f"""
        WITH records AS (
            SELECT *, l_returnflag AS stream, {_shard("l_linestatus")} AS shard_id FROM lineitem
        )
        SELECT stream, shard_id,
               row_number() OVER (
                   PARTITION BY stream, shard_id
                   ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
               ) - 1 AS sequence_number,
               concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS value
        FROM records
    """,
    "list_streams": "SELECT DISTINCT event_type AS stream FROM events ORDER BY 1",
    "shard_inventory": f"""
        {_WITH_RECORDS}
        SELECT stream, shard_id, count(*) AS records,
               min(sequence_number) AS first_sequence, max(sequence_number) AS last_sequence,
               min(arrival_ts) AS first_arrival, max(arrival_ts) AS last_arrival
        FROM records GROUP BY stream, shard_id
    """,
    "shard_positions_oldest": f"""
        {_WITH_RECORDS}
        SELECT stream, shard_id, min(sequence_number) AS next_sequence
        FROM records GROUP BY stream, shard_id
    """,
    "shard_position_one": f"""
        {_WITH_RECORDS}
        SELECT stream, shard_id, max(sequence_number) + 1 AS next_sequence
        FROM records WHERE stream = 'click' AND shard_id = 1 GROUP BY stream, shard_id
    """,
    "positions_with_new_shards": f"""
        {_WITH_RECORDS}
        SELECT stream, shard_id,
               if(stream = 'click', max(sequence_number) + 1, min(sequence_number)) AS next_sequence
        FROM records GROUP BY stream, shard_id
    """,
    "shard_positions_latest": f"""
        {_WITH_RECORDS}
        SELECT stream, shard_id, max(sequence_number) + 1 AS next_sequence
        FROM records GROUP BY stream, shard_id
    """,
    "read_records": f"""
        {_PAGED} SELECT {_PAGE} FROM paged WHERE place <= 10
    """,
    "next_positions": f"""
        {_PAGED}
        SELECT stream, shard_id, max(sequence_number) + 1 AS next_sequence
        FROM paged WHERE place <= 10 GROUP BY stream, shard_id
    """,
    "read_records_second_page": f"""
        {_PAGED}
        SELECT {_PAGE} FROM paged WHERE place BETWEEN 11 AND 20
    """,
    "read_log_first_page": f"""
        {_IN_BATCHES}, paged AS (SELECT *, {_NUMBERED} AS place FROM landed)
        SELECT {_PAGE} FROM paged WHERE place <= 10
    """,
    "read_log_page_across_batches": f"{_ACROSS} SELECT {_PAGE} FROM paged WHERE place <= 10",
    "read_log_next_positions": f"""
        {_ACROSS}
        SELECT stream, shard_id, max(sequence_number) + 1 AS next_sequence
        FROM paged WHERE place <= 10 GROUP BY stream, shard_id
    """,
    "log_page_by_index": f"""
        {_BY_THE_DAY}, starts AS (
            SELECT stream, shard_id, max(sequence_number) + 1 AS start
            FROM landed WHERE batch_id <= 15 GROUP BY stream, shard_id
        ), paged AS (
            SELECT landed.*, {_NUMBERED} AS place
            FROM landed JOIN starts USING (stream, shard_id) WHERE sequence_number >= start
        )
        SELECT {_PAGE} FROM paged WHERE place <= 10
    """,
    "log_positions_after_pages": f"""
        {_IN_BATCHES}, paged AS (SELECT *, {_NUMBERED} AS place FROM landed)
        SELECT stream, shard_id, max(sequence_number) + 1 AS next_sequence
        FROM paged WHERE place <= 1000 GROUP BY stream, shard_id
    """,
    "log_streams": "SELECT DISTINCT event_type AS stream FROM events ORDER BY 1",
    "log_inventory": f"""
        {_IN_BATCHES}
        SELECT stream, shard_id, count(*) AS records,
               min(sequence_number) AS first_sequence, max(sequence_number) AS last_sequence,
               min(arrival_ts) AS first_arrival, max(arrival_ts) AS last_arrival
        FROM landed GROUP BY stream, shard_id
    """,
    "log_positions_oldest": f"""
        {_IN_BATCHES}
        SELECT stream, shard_id, min(sequence_number) AS next_sequence
        FROM landed GROUP BY stream, shard_id
    """,
    "log_positions_latest": f"""
        {_IN_BATCHES}
        SELECT stream, shard_id, max(sequence_number) + 1 AS next_sequence
        FROM landed GROUP BY stream, shard_id
    """,
    "log_after_broken_move": f"""
        {_IN_BATCHES} SELECT {_PAGE}, batch_id < 2 AS seen FROM landed
    """,
    "log_page_after_expiry": f"""
        {_BY_THE_DAY}, paged AS (SELECT *, {_NUMBERED} AS place FROM landed WHERE batch_id >= 10)
        SELECT {_PAGE} FROM paged WHERE place <= 10
    """,
    "log_inventory_after_expiry": f"""
        {_BY_THE_DAY}
        SELECT stream, shard_id, count(*) AS records,
               min(sequence_number) AS first_sequence, max(sequence_number) AS last_sequence,
               min(arrival_ts) AS first_arrival, max(arrival_ts) AS last_arrival
        FROM landed WHERE batch_id >= 10 GROUP BY stream, shard_id
    """,
    "stream_after_expiry": f"""
        {_BY_THE_DAY} SELECT value FROM landed WHERE batch_id >= 10 UNION ALL SELECT value FROM records
    """,
    "csv_header_scan": """
        SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey,
               o_orderstatus, o_totalprice::VARCHAR AS o_totalprice,
               o_orderdate::VARCHAR AS o_orderdate, o_orderpriority
        FROM orders
    """,
}
