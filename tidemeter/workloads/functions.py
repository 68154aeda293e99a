"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemeter.functions import columns, payload
from tidemeter.functions import time as times
from tidemeter.operators import sessions
from tidemeter.schemas import WIDE_BIN_NS
from tidemeter.streaming.jobs import batch_name
from tidemeter.workloads.inputs import as_of, EV, events, table
from tidemeter.workloads.registry import query

PATTERN = "'%Y-%m-%d %H:%M:%S'"


@query(
    f"""WITH {EV}
    SELECT event_id, strftime(date_trunc('second', clock), {PATTERN}) AS whole_second,
           epoch_us(clock) AS micros FROM ev"""
)
def ns_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id",
        times.format_datetime(times.ns_to_timestamp("origin")).alias("whole_second"),
        F.unix_micros(times.ns_to_timestamp("origin", precise=True)).alias("micros"),
    )


@query(
    f"""SELECT event_id, strftime(time_bucket(INTERVAL 5 minute, ts), {PATTERN}) AS window_start
    FROM events"""
)
def five_min_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = times.five_min_window(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", times.format_datetime(start).alias("window_start")
    )


@query(
    f"""SELECT event_id, strftime(time_bucket(INTERVAL 30 minute, ts), {PATTERN}) AS window_start
    FROM events"""
)
def half_hour_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = times.half_hour_window(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", times.format_datetime(start).alias("window_start")
    )


@query(
    f"""WITH {EV}
    SELECT event_id, epoch_us(clock) * 1000 // {WIDE_BIN_NS} * {WIDE_BIN_NS} AS bin,
           -1 * CAST(ceil(epoch_us(clock) / {WIDE_BIN_NS // 1000}) AS BIGINT) * {WIDE_BIN_NS} AS mirrored
    FROM ev"""
)
def bin_ns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id",
        times.bin_ns("origin", WIDE_BIN_NS).alias("bin"),
        times.bin_ns(-F.col("origin"), WIDE_BIN_NS).alias("mirrored"),
    )


@query(f"SELECT o_orderkey, strftime(o_orderdate, {PATTERN}) AS text FROM orders")
def format_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", times.format_datetime(F.col("o_orderdate")).alias("text")
    )


@query(
    f"SELECT event_id, strftime(date_trunc('hour', ts), {PATTERN}) AS hour FROM events"
)
def hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = times.hour_bucket(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", times.format_datetime(hour).alias("hour")
    )


@query(
    f"""WITH {EV}, r AS (SELECT unnest([15, 30, 60, 120, 240]) AS minutes)
    SELECT minutes, count(*) AS recent FROM ev, r
    WHERE clock >= TIMESTAMP '2024-01-01 07:12:00' - minutes * INTERVAL 1 minute GROUP BY minutes"""
)
def relative_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows within each of the selectable time ranges, from one scan."""
    ranges = (15, 30, 60, 120, 240)
    counts = events(spark, sf_dir).agg(
        *[
            F.count_if(F.col("at") >= times.minutes_before(as_of(), m)).alias(str(m))
            for m in ranges
        ]
    )
    long = counts.unpivot([], [str(m) for m in ranges], "minutes", "recent")
    return long.withColumn("minutes", F.col("minutes").cast("int"))


@query(
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2) AS price,
       round(l_quantity / 8, 2) AS eighth FROM lineitem"""
)
def round_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        columns.round_half_up("l_extendedprice", 2).alias("price"),
        columns.round_half_up(F.col("l_quantity") / 8, 2).alias("eighth"),
    )


@query(
    """SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS value, o_totalprice AS number
    FROM orders"""
)
def to_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("value")
    )
    return orders.withColumn("number", columns.strict_number("value"))


@query(
    """SELECT p_partkey, len(string_split(p_type, ' ')) AS items,
       upper(string_split(p_type, ' ')[1]) AS first_item FROM part"""
)
def comma_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists with blanks and empty items made of the words of the part type."""
    text = F.concat(F.lit(" ,"), F.replace("p_type", F.lit(" "), F.lit(" , ,")), F.lit(","))
    items = columns.comma_list(text)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.size(items).cast("bigint").alias("items"),
        F.upper(F.get(items, F.lit(0))).alias("first_item"),
    )


@query(
    """SELECT epoch_id, printf('events_%012d', epoch_id) AS batch_id, count(*) AS records
    FROM (SELECT event_id // 4000 AS epoch_id FROM events) GROUP BY epoch_id"""
)
def batch_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = F.call_function("div", F.col("event_id"), F.lit(4000)).alias("epoch_id")
    counts = table(spark, sf_dir, "events").groupBy(epoch).agg(F.count(F.lit(1)).alias("records"))
    pattern = batch_name("events", 0).replace("0" * 12, "%012d")
    return counts.withColumn("batch_id", F.format_string(pattern, "epoch_id"))


@query(
    """SELECT event_id, 'k' AS key, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS value_num,
       'num' AS kind, NULL AS value_str FROM events
    UNION ALL SELECT event_id, 'type', NULL, 'str', event_type FROM events
    UNION ALL SELECT event_id, 'note', NULL, 'str', '5' FROM events
    UNION ALL SELECT event_id, 'none', NULL, 'none', NULL FROM events"""
)
def flatten_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payload with an encoded object, a digit text and a null member."""
    text = F.to_json(
        F.struct(
            F.to_json(
                F.struct(
                    F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("k"),
                    F.col("event_type").alias("type"),
                )
            ).alias("inner"),
            F.lit("5").alias("note"),
        )
    )
    with_null = F.concat(F.lit('{"none":null,'), F.right(text, F.length(text) - 1))
    members = F.explode(payload.flatten_members(with_null)).alias("m")
    value = F.col("m.value")
    return table(spark, sf_dir, "events").select("event_id", members).select(
        "event_id",
        "m.key",
        payload.variant_number(value).alias("value_num"),
        payload.member_kind(value).alias("kind"),
        payload.variant_text(value).alias("value_str"),
    )


@query(
    """SELECT event_id, 'value' AS field, value AS value_num, NULL AS value_str, NULL AS value_bool
      FROM events
    UNION ALL SELECT event_id, 'type_str', NULL, event_type, NULL FROM events
    UNION ALL SELECT event_id, 'big', NULL, NULL, value > 50 FROM events"""
)
def typed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys: the later value decides, also when it is of another kind or null."""
    first = F.to_json(
        F.struct(
            F.col("event_type").alias("value"),
            F.col("value").alias("type"),
            F.col("value").alias("gone"),
        )
    )
    second = F.to_json(
        F.struct(
            F.col("value"),
            F.col("event_type").alias("type"),
            (F.col("value") > 50).alias("big"),
        )
    )
    merged = F.concat(
        F.expr("substring(first, 1, length(first) - 1)"),
        F.lit(',"gone":null,"list":[1,2],"object":{"a":1},'),
        F.expr("substring(second, 2)"),
    )
    texts = table(spark, sf_dir, "events").select(
        "event_id", first.alias("first"), second.alias("second")
    )
    members = payload.settle(payload.flatten_members(merged)).alias("members")
    return payload.explode_fields(texts.select("event_id", members), "members")


@query(
    """SELECT c_custkey,
       CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE c_mktsegment END AS segment,
       concat_ws('-', CAST(c_nationkey AS VARCHAR),
                 CASE WHEN c_acctbal >= 0 THEN c_mktsegment END) AS joined,
       c_mktsegment IN ('BUILDING', 'MACHINERY') AS listed,
       CAST(c_acctbal AS VARCHAR) AS text,
       CASE WHEN c_acctbal >= 5000 THEN 'high' WHEN c_acctbal >= 0 THEN 'low' END AS level
    FROM customer"""
)
def null_and_naming_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal")
    segment = F.when(balance >= 0, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.coalesce(segment, F.lit("unknown")).alias("segment"),
        F.concat_ws("-", F.col("c_nationkey").cast("string"), segment).alias("joined"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("listed"),
        balance.cast("string").alias("text"),
        F.when(balance >= 5000, "high").when(balance >= 0, "low").alias("level"),
    )


@query(
    f"""SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
       CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS by_path, 1 AS entries,
       strftime(to_timestamp(epoch_us(ts) // 1000000) AT TIME ZONE 'UTC', {PATTERN}) AS text_time,
       CAST(floor(value) AS BIGINT) AS floor_value
    FROM events"""
)
def json_map_time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", payload.TEXT_MAP)
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.try_element_at(parsed, F.lit("k")).cast("bigint").alias("k"),
        F.get_json_object("props", "$.k").try_cast("double").alias("by_path"),
        F.size(F.map_entries(parsed)).alias("entries"),
        F.date_format(F.to_timestamp(F.from_unixtime(seconds)), "yyyy-MM-dd HH:mm:ss").alias(
            "text_time"
        ),
        F.floor("value").alias("floor_value"),
    )


@query(
    """SELECT l_orderkey, l_linenumber,
       CAST(round(CAST(l_partkey / 1000 AS DECIMAL(18, 3)), 2) AS DOUBLE) AS celsius,
       CAST(floor(l_extendedprice * 1000 / 1048576) AS BIGINT) AS megabytes,
       CAST(trunc(l_extendedprice / 1024) AS BIGINT) AS kilobytes
    FROM lineitem"""
)
def scale_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        columns.celsius("l_partkey").alias("celsius"),
        columns.whole_megabytes(price * 1000).alias("megabytes"),
        columns.whole_kilobytes(price).alias("kilobytes"),
    )


SESSIONS = """WITH s AS (
  SELECT l_suppkey AS pid, l_returnflag || ' ' || l_linestatus || ',x' AS comm,
         '10.0.0.' || l_linenumber AS laddr, 1024 + l_linenumber AS lport,
         '10.1.0.' || (l_partkey % 4) AS daddr, 80 + l_partkey % 4 AS dport,
         sum(CAST(l_extendedprice AS BIGINT)) AS send_bytes,
         sum(CAST(l_quantity AS BIGINT) * 1000) AS recv_bytes
  FROM (SELECT * REPLACE (floor(l_extendedprice) AS l_extendedprice) FROM lineitem)
  GROUP BY ALL)
"""


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as byte counters of one interval each."""
    last = F.col("l_partkey") % 4
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("pid"),
        F.concat("l_returnflag", F.lit(" "), "l_linestatus", F.lit(",x")).alias("comm"),
        F.concat(F.lit("10.0.0."), "l_linenumber").alias("laddr"),
        (F.col("l_linenumber") + 1024).alias("lport"),
        F.concat(F.lit("10.1.0."), last).alias("daddr"),
        (last + 80).alias("dport"),
        F.floor("l_extendedprice").alias("send_bytes"),
        (F.col("l_quantity").cast("bigint") * 1000).alias("recv_bytes"),
    )


@query(
    SESSIONS
    + """SELECT pid, comm, laddr, lport, daddr, dport, CAST(recv_bytes // 1024 AS BIGINT) AS rx_kb,
       CAST(send_bytes // 1024 AS BIGINT) AS tx_kb FROM s"""
)
def tcp_session_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.tcp_session_throughput(counters(spark, sf_dir))


@query(
    SESSIONS
    + r"""SELECT 'tcp_top pid="' || pid || '",comm="' ||
       replace(replace(comm, ' ', '_'), ',', '\,') || '",laddr="' || laddr || '",lport="' || lport ||
       '",raddr="' || daddr || '",dport="' || dport || '",rx_kb=' ||
       CAST(recv_bytes // 1024 AS BIGINT) || ',tx_kb=' || CAST(send_bytes // 1024 AS BIGINT) AS line
    FROM s"""
)
def points_to_line_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.sessions_to_lines(sessions.tcp_session_throughput(counters(spark, sf_dir)))
