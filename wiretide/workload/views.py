"""Packet, label and evaluation views over the ``events`` table, as SQL for both engines.

Time is compressed 1000 times so that a one-minute idle timeout finds gaps on
both of its sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EPOCH_US = 1704067200000000

# Microseconds since 1970 of a zone-less timestamp, whatever the session time zone is.
SPARK_MICROS = (
    "CAST(CAST(CAST(ts - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS INTERVAL SECOND) AS DECIMAL(18, 6)) * 1000000 AS BIGINT)"
)
SPARK_TS = f"{EPOCH_US} + ({SPARK_MICROS} - {EPOCH_US}) DIV 1000"
DUCKDB_TS = f"{EPOCH_US} + (epoch_us(ts) - {EPOCH_US}) // 1000"

_PACKETS = """
SELECT event_id AS packet_id,
  CASE WHEN event_id % 997 = 0 THEN NULL WHEN event_id % 499 = 0 THEN 'not_an_ip'
       WHEN event_id % 2 = 0 THEN a_ip ELSE b_ip END AS src_ip,
  CASE WHEN event_id % 2 = 0 THEN b_ip ELSE a_ip END AS dst_ip,
  CASE WHEN protocol = 'ICMP' THEN NULL WHEN event_id % 2 = 0 THEN a_port ELSE 443 END AS src_port,
  CASE WHEN protocol = 'ICMP' THEN NULL WHEN event_id % 2 = 0 THEN 443 ELSE a_port END AS dst_port,
  protocol,
  CAST(20 + FLOOR(value) AS BIGINT) AS length,
  ts_us,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(32 + user_id % 97 AS INT) END AS ttl,
  CASE WHEN protocol <> 'TCP' THEN NULL ELSE
    CASE event_id % 11 WHEN 0 THEN 'S' WHEN 1 THEN 'SA' WHEN 2 THEN 'PA' WHEN 3 THEN 'FA' WHEN 4 THEN 'R'
      WHEN 5 THEN 'SEC' WHEN 6 THEN '' WHEN 7 THEN NULL WHEN 8 THEN 'U' ELSE 'a' END END AS tcp_flags,
  CASE WHEN event_id % 13 = 0 THEN CAST(event_id % 100 AS INT) ELSE NULL END AS payload_size
FROM (SELECT *, {TS} AS ts_us,
    CASE event_type WHEN 'error' THEN 'ICMP' WHEN 'view' THEN 'UDP' WHEN 'signup' THEN 'OTHER' ELSE 'TCP' END AS protocol,
    CASE WHEN user_id % 10 = 8 THEN '203.0.113.' ELSE '192.168.1.' END || CAST(user_id % 40 AS {STR}) AS a_ip,
    CASE WHEN user_id % 10 = 9 THEN '10.0.0.' ELSE '93.184.216.' END || CAST(user_id % 7 AS {STR}) AS b_ip,
    40000 + user_id % 40 AS a_port FROM events) e
"""

# The same packets with a third of them in one flow and a fifth at one instant.
_PACKETS_HOT = f"""
SELECT packet_id,
  CASE WHEN packet_id % 3 = 0 THEN '192.168.1.7' ELSE src_ip END AS src_ip,
  CASE WHEN packet_id % 3 = 0 THEN '93.184.216.1' ELSE dst_ip END AS dst_ip,
  CASE WHEN packet_id % 3 = 0 THEN 40007 ELSE src_port END AS src_port,
  CASE WHEN packet_id % 3 = 0 THEN 443 ELSE dst_port END AS dst_port,
  CASE WHEN packet_id % 3 = 0 THEN 'TCP' ELSE protocol END AS protocol,
  length,
  CASE WHEN packet_id % 5 = 0 THEN {EPOCH_US + 600_000_000} ELSE ts_us END AS ts_us,
  ttl, tcp_flags, payload_size
FROM packets
"""

# The same conversations between IPv6 addresses in several spellings; 'fd' is home.
_PACKETS_V6 = """
SELECT packet_id,
  CASE packet_id % 8 WHEN 0 THEN 'fd00::' || CAST(packet_id % 90 + 10 AS {STR})
    WHEN 1 THEN 'FD00:0:0:0:0:0:0:' || CAST(packet_id % 90 + 10 AS {STR})
    WHEN 2 THEN '2001:db8::' || CAST(packet_id % 90 + 10 AS {STR})
    WHEN 3 THEN 'fd00::1.2.3.' || CAST(packet_id % 250 AS {STR})
    WHEN 4 THEN 'fd00:::1' WHEN 5 THEN '2001:db8::1%eth0' WHEN 6 THEN 'fd00::12345' ELSE '10.1.2.3' END AS src_ip,
  CASE packet_id % 3 WHEN 0 THEN 'fd12:3456::1' WHEN 1 THEN '2606:4700:4700::1111' ELSE '::' END AS dst_ip
FROM packets
"""

_SCORED = """
SELECT event_id AS id,
  CASE event_id % 10 WHEN 0 THEN 'ddos' WHEN 1 THEN 'Port-Scan' WHEN 2 THEN ' Brute Force ' WHEN 3 THEN 'MALWARE'
    WHEN 4 THEN 'phishing' WHEN 5 THEN 'Botnet' WHEN 6 THEN 'data exfiltration' WHEN 7 THEN 'benign'
    WHEN 8 THEN 'weird' ELSE NULL END AS raw_label,
  (event_id % 1051) / 1e1 AS confidence
FROM events
"""

_LABEL = """CASE event_type WHEN 'click' THEN 'BENIGN' WHEN 'error' THEN 'DDOS' WHEN 'purchase' THEN 'BOTNET'
    WHEN 'signup' THEN 'MALWARE' ELSE 'PORT_SCAN' END"""

_EVAL_PAIRS = f"""
SELECT event_id AS id, y_true,
  CASE WHEN event_id % 501 = 0 THEN 'PHISHING' WHEN event_id % 7 = 0 THEN 'BENIGN' ELSE y_true END AS y_pred
FROM (SELECT *, {_LABEL} AS y_true FROM events) e
"""

# Class probabilities that sum to 1, with ties for the first place.
_PROBABILITIES = """
SELECT event_id AS id, (event_id % 5) / 1e1 AS p_benign, (4 - event_id % 5) / 1e1 AS p_ddos,
  (event_id % 7) / 1e1 AS p_phishing, (6 - event_id % 7) / 1e1 AS p_scan
FROM events
"""


def _spark(text: str) -> str:
    return text.replace("{TS}", SPARK_TS).replace("{STR}", "STRING")


def _duckdb(text: str) -> str:
    return text.replace("{TS}", DUCKDB_TS).replace("{STR}", "VARCHAR").strip()


DUCKDB_VIEWS = {
    "packets": _duckdb(_PACKETS),
    "packets_hot": _duckdb(_PACKETS_HOT),
    "packets_v6": _duckdb(_PACKETS_V6),
    "scored": _duckdb(_SCORED),
    "eval_pairs": _duckdb(_EVAL_PAIRS),
    "probabilities": _duckdb(_PROBABILITIES),
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_spark(_PACKETS).replace("FROM events)", "FROM {events})"), events=events(spark, sf_dir))


def labelled_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets with a class that follows the event type, which the protocol tells in part."""
    text = _PACKETS.replace("AS payload_size\n", f"AS payload_size,\n  {_LABEL} AS label\n")
    return spark.sql(_spark(text).replace("FROM events)", "FROM {events})"), events=events(spark, sf_dir))


def packets_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _spark(_PACKETS_HOT).replace("FROM packets", "FROM {packets}")
    return spark.sql(text, packets=packets(spark, sf_dir))


def packets_v6(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _spark(_PACKETS_V6).replace("FROM packets", "FROM {packets}")
    return spark.sql(text, packets=packets(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_spark(_SCORED).replace("FROM events", "FROM {events}"), events=events(spark, sf_dir))


def eval_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_spark(_EVAL_PAIRS).replace("FROM events)", "FROM {events})"), events=events(spark, sf_dir))


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_spark(_PROBABILITIES).replace("FROM events", "FROM {events}"), events=events(spark, sf_dir))
