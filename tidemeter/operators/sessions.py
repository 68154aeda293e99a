"""TCP sessions and benchmark results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemeter.functions.columns import line_protocol_name, whole_kilobytes

SESSION_KEY = ("pid", "comm", "laddr", "lport", "daddr", "dport")


def session_totals(counters: DataFrame) -> DataFrame:
    """Bytes sent and received per session over all intervals."""
    return counters.groupBy(*SESSION_KEY).agg(
        F.sum("send_bytes").alias("send_bytes"), F.sum("recv_bytes").alias("recv_bytes")
    )


def tcp_session_throughput(counters: DataFrame) -> DataFrame:
    """Whole KB received and sent per session, busiest session first."""
    totals = session_totals(counters)
    busiest = (F.col("send_bytes") + F.col("recv_bytes")).desc()
    return totals.orderBy(busiest, *SESSION_KEY).select(
        *SESSION_KEY,
        whole_kilobytes("recv_bytes").alias("rx_kb"),
        whole_kilobytes("send_bytes").alias("tx_kb"),
    )


def session_line() -> Column:
    """Line-protocol text of one session row."""
    return F.format_string(
        'tcp_top pid="%s",comm="%s",laddr="%s",lport="%s",raddr="%s",dport="%s",rx_kb=%d,tx_kb=%d',
        F.col("pid").cast("string"),
        line_protocol_name(F.col("comm")),
        "laddr",
        F.col("lport").cast("string"),
        "daddr",
        F.col("dport").cast("string"),
        "rx_kb",
        "tx_kb",
    )


def sessions_to_lines(sessions: DataFrame) -> DataFrame:
    return sessions.select(session_line().alias("line"))


def benchmark_stats(results: DataFrame, elapsed_seconds: Column, keys: list[str]) -> DataFrame:
    """Latency and throughput of test calls (latency_ms, ok); failed calls count in both."""
    return results.groupBy(*keys).agg(
        F.min("latency_ms").alias("min_ms"),
        F.avg("latency_ms").alias("mean_ms"),
        F.max("latency_ms").alias("max_ms"),
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
        (F.count(F.lit(1)) / elapsed_seconds).alias("per_second"),
    )
