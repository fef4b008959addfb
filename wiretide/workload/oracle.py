"""The registered queries as plain SQL for DuckDB, written from the definitions and not from the Spark code."""

from __future__ import annotations

from wiretide.schemas import FEATURE_SCHEMA, PREDICTION_SCHEMA
from wiretide.workload.queries import AS_OF_US, CAPTURE_PACKETS, CAPTURE_SECONDS, FIXED_NOW, LARGE_CAPTURE, LATE_DELAY, LATE_EVERY, RECENT_FLOWS, SWEEP_SECONDS, TRACKED_FLOWS
from wiretide.workload.views import DUCKDB_VIEWS

_TIMEOUT = 60_000_000

_STATE = """CASE WHEN protocol IS DISTINCT FROM 'TCP' THEN 'STATELESS'
  WHEN coalesce(tcp_flags, '') = '' THEN 'UNKNOWN'
  WHEN upper(tcp_flags) LIKE '%R%' THEN 'CLOSED' WHEN upper(tcp_flags) LIKE '%F%' THEN 'CLOSING'
  WHEN upper(tcp_flags) = 'S' THEN 'NEW'
  WHEN upper(tcp_flags) LIKE '%A%' OR upper(tcp_flags) LIKE '%P%' THEN 'ESTABLISHED' ELSE 'UNKNOWN' END"""

_PAYLOAD = """CAST(coalesce(payload_size, greatest(length - 20 -
  CASE protocol WHEN 'TCP' THEN 20 WHEN 'UDP' THEN 8 WHEN 'ICMP' THEN 8 ELSE 0 END, 0)) AS BIGINT)"""


def _number(ip: str) -> str:
    octets = [f"CAST(split_part({ip}, '.', {i}) AS BIGINT)" for i in (1, 2, 3, 4)]
    value = f"{octets[0]} * 16777216 + {octets[1]} * 65536 + {octets[2]} * 256 + {octets[3]}"
    return f"CASE WHEN regexp_full_match({ip}, '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+') THEN {value} END"


def _home(number: str) -> str:
    ranges = [(167772160, 184549375), (2886729728, 2887778303), (3232235520, 3232301055), (2130706432, 2147483647)]
    return "(" + " OR ".join(f"{number} BETWEEN {low} AND {high}" for low, high in ranges) + ")"


_DIRECTION = f"""CASE WHEN src_n IS NULL OR dst_n IS NULL THEN 'UNKNOWN'
  WHEN {_home('src_n')} AND {_home('dst_n')} THEN 'INTERNAL'
  WHEN {_home('src_n')} THEN 'OUTBOUND' WHEN {_home('dst_n')} THEN 'INBOUND' ELSE 'UNKNOWN' END"""

_CTES = {
    **DUCKDB_VIEWS,
    "good": """SELECT * FROM packets
      WHERE src_ip IS NOT NULL AND dst_ip IS NOT NULL AND length IS NOT NULL AND ts_us IS NOT NULL""",
    "ends": """SELECT *,
        coalesce(src_port, 0) AS sp, coalesce(dst_port, 0) AS dp,
        (src_ip < dst_ip OR (src_ip = dst_ip AND coalesce(src_port, 0) <= coalesce(dst_port, 0))) AS src_first
      FROM good""",
    "keyed": """SELECT * EXCLUDE (sp, dp, src_first),
        CASE WHEN src_first THEN src_ip ELSE dst_ip END AS endpoint_1_ip,
        CASE WHEN src_first THEN sp ELSE dp END AS endpoint_1_port,
        CASE WHEN src_first THEN dst_ip ELSE src_ip END AS endpoint_2_ip,
        CASE WHEN src_first THEN dp ELSE sp END AS endpoint_2_port
      FROM ends""",
    "flowed": """SELECT *, substr(sha256(protocol || ':' || endpoint_1_ip || ':' || CAST(endpoint_1_port AS VARCHAR)
        || '<->' || endpoint_2_ip || ':' || CAST(endpoint_2_port AS VARCHAR)), 1, 16) AS flow_id FROM keyed""",
    "gaps": "SELECT *, lag(ts_us) OVER (PARTITION BY flow_id ORDER BY ts_us, packet_id) AS prev_us FROM flowed",
    "breaks": f"""SELECT *, CAST(CASE WHEN prev_us IS NULL OR ts_us - prev_us > {_TIMEOUT} THEN 1 ELSE 0 END AS BIGINT)
        AS is_new FROM gaps""",
    "numbered": """SELECT *, CAST(sum(is_new) OVER (PARTITION BY flow_id ORDER BY ts_us, packet_id
        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM breaks""",
    "scanned": """SELECT *, count(*) OVER w AS n, CAST(sum(length) OVER w AS BIGINT) AS bytes,
        first_value(ts_us) OVER w AS start_us, first_value(src_ip) OVER w AS initiator_ip
      FROM numbered WINDOW w AS (PARTITION BY flow_id, session ORDER BY ts_us, packet_id ROWS UNBOUNDED PRECEDING)""",
    "deltas": """SELECT *, CASE WHEN is_new = 1 THEN 0 ELSE ts_us - prev_us END AS delta FROM scanned""",
    "averaged": """SELECT *, CAST(sum(delta) OVER w AS DOUBLE) / 1e6 / CAST(sum(is_new) OVER w AS DOUBLE)
        AS avg_flow_time FROM deltas WINDOW w AS (ORDER BY ts_us, packet_id ROWS UNBOUNDED PRECEDING)""",
    "located": f"SELECT *, {_number('src_ip')} AS src_n, {_number('dst_ip')} AS dst_n FROM averaged",
    "features": f"""SELECT packet_id, src_ip, dst_ip, src_port, dst_port, protocol, length AS packet_length,
        ts_us / 1e6 AS timestamp, ttl, tcp_flags, {_DIRECTION} AS direction, flow_id,
        (ts_us - start_us) / 1e6 AS flow_duration, {_STATE} AS connection_state, n AS total_packets_in_flow,
        bytes AS total_bytes, CAST(bytes AS DOUBLE) / n AS avg_packet_size, {_PAYLOAD} AS payload_size,
        ts_us / 1e6 AS packet_arrival_time,
        CASE WHEN is_new = 0 THEN (ts_us - prev_us) / 1e6 END AS inter_arrival_time,
        CASE WHEN ts_us <= start_us THEN CAST(n AS DOUBLE) ELSE n / ((ts_us - start_us) / 1e6) END AS packet_rate,
        CASE WHEN ts_us <= start_us THEN CAST(bytes AS DOUBLE) ELSE bytes / ((ts_us - start_us) / 1e6) END AS byte_rate,
        avg_flow_time
      FROM located""",
    "flows": f"""SELECT flow_id, session, endpoint_1_ip, endpoint_1_port, endpoint_2_ip, endpoint_2_port, protocol,
        min(ts_us) AS start_us, max(ts_us) AS last_seen_us, count(*) AS total_packets,
        CAST(sum(length) AS BIGINT) AS total_bytes, arg_max({_STATE}, (ts_us, packet_id)) AS connection_state,
        arg_min(src_ip, (ts_us, packet_id)) AS initiator_ip
      FROM numbered GROUP BY ALL""",
    "summary": """SELECT *, last_seen_us - start_us AS duration_us, (last_seen_us - start_us) / 1e6 AS duration,
        CAST(total_bytes AS DOUBLE) / total_packets AS avg_packet_size,
        CASE WHEN last_seen_us = start_us THEN CAST(total_packets AS DOUBLE)
          ELSE total_packets / ((last_seen_us - start_us) / 1e6) END AS packet_rate,
        CASE WHEN last_seen_us = start_us THEN CAST(total_bytes AS DOUBLE)
          ELSE total_bytes / ((last_seen_us - start_us) / 1e6) END AS byte_rate
      FROM flows""",
    "categories": """SELECT *, CASE WHEN word IN ('BENIGN', 'PORT_SCAN', 'DDOS', 'BRUTE_FORCE', 'MALWARE', 'PHISHING',
        'BOTNET', 'DATA_EXFILTRATION') THEN word ELSE 'UNKNOWN' END AS category
      FROM (SELECT *, replace(replace(upper(trim(raw_label)), '-', '_'), ' ', '_') AS word FROM scored) s""",
    "counts": "SELECT y_true, y_pred, count(*) AS n FROM eval_pairs GROUP BY ALL",
    "parts": """SELECT y_true AS label, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS hits, n AS actual, 0 AS predicted FROM counts
      UNION ALL SELECT y_pred, 0, 0, n FROM counts""",
    "quality": """SELECT label, CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(actual) AS BIGINT) AS support,
        CASE WHEN sum(predicted) > 0 THEN CAST(sum(hits) AS DOUBLE) / CAST(sum(predicted) AS DOUBLE) ELSE 0.0 END AS precision,
        CASE WHEN sum(actual) > 0 THEN CAST(sum(hits) AS DOUBLE) / CAST(sum(actual) AS DOUBLE) ELSE 0.0 END AS recall,
        CASE WHEN sum(actual) + sum(predicted) > 0
          THEN CAST(2 * sum(hits) AS DOUBLE) / CAST(sum(actual) + sum(predicted) AS DOUBLE) ELSE 0.0 END AS f1
      FROM parts GROUP BY label""",
}
# What each step reads, so that a query carries only the steps it needs.
_ORDER = list(_CTES)


def _sql(body: str) -> str:
    """A query with the common table expressions it refers to, directly or not."""
    import re

    needed: set[str] = set()

    def need(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
            if name in _CTES and name not in needed:
                needed.add(name)
                need(_CTES[name])

    need(body)
    steps = ",\n".join(f"{name} AS ({_CTES[name]})" for name in _ORDER if name in needed)
    return f"WITH {steps}\n{body}" if steps else body


_FEATURE_NUMBERS = [
    "packet_length", "flow_duration", "packet_rate", "byte_rate", "payload_size", "avg_packet_size",
    "total_packets_in_flow", "total_bytes", "inter_arrival_time", "ttl",
]
_AS_NUMBERS = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _FEATURE_NUMBERS)
_AS_NUMBERS += ", CAST(0 AS DOUBLE) AS window_size, avg_flow_time"


# The words of the categorical inputs by their codes; the last stands for all others.
_WORDS = {
    "protocol": ["TCP", "UDP", "ICMP", "OTHER", "UNKNOWN"],
    "direction": ["INBOUND", "OUTBOUND", "INTERNAL", "UNKNOWN"],
    "connection_state": ["NEW", "ESTABLISHED", "CLOSING", "CLOSED", "STATELESS", "UNKNOWN"],
}


def _code(name: str) -> str:
    words = _WORDS[name]
    cases = " ".join(f"WHEN '{word}' THEN {number}" for number, word in enumerate(words))
    return f"CAST(CASE upper({name}) {cases} ELSE {len(words) - 1} END AS DOUBLE) AS {name}"


_CLAMPED = "greatest(least(confidence, 100.0), 0.0)"


def _severity(value: str) -> str:
    return f"CASE WHEN {value} <= 30 THEN 'LOW' WHEN {value} <= 70 THEN 'MEDIUM' WHEN {value} <= 90 THEN 'HIGH' ELSE 'CRITICAL' END"


def _weight(column: str) -> str:
    return f"""CAST(CASE {column} WHEN 'BENIGN' THEN 0.0 WHEN 'PORT_SCAN' THEN 0.55 WHEN 'BRUTE_FORCE' THEN 0.70
      WHEN 'PHISHING' THEN 0.75 WHEN 'BOTNET' THEN 0.85 WHEN 'MALWARE' THEN 0.90 WHEN 'DDOS' THEN 0.90
      WHEN 'DATA_EXFILTRATION' THEN 0.95 ELSE 0.50 END AS DOUBLE)"""


_LABEL_OF_ID = "SELECT id, y_true FROM eval_pairs"
_SECONDS = """CAST(ts_us // 1000000 AS VARCHAR) || '.' ||
  CASE WHEN ts_us % 1000000 = 0 THEN '0' ELSE rtrim(lpad(CAST(ts_us % 1000000 AS VARCHAR), 6, '0'), '0') END"""
_BEST = "greatest(p_benign, p_ddos, p_phishing, p_scan)"

def _fields(names) -> str:
    return "'" + ",".join(sorted(names)) + "'"


_FIELDS_OF_PACKET = _fields(
    "packet_id src_ip dst_ip src_port dst_port protocol length ts_us ttl tcp_flags payload_size".split()
)

def _sessions(ctes: str) -> str:
    """Sessions of flows that break where the last of the added tables, `broken`, says so."""
    body = f"""{ctes}
        SELECT packet_id, flow_id, CAST(session AS BIGINT) AS session, first_value(ts_us) OVER w AS session_start_us,
          first_value(src_ip) OVER w AS initiator_ip, CAST(breaks AS BIGINT) AS is_new, lead(packet_id) OVER w IS NULL AS is_last
        FROM (SELECT *, sum(CAST(breaks AS BIGINT)) OVER (PARTITION BY flow_id ORDER BY ts_us, packet_id ROWS UNBOUNDED PRECEDING) AS session
          FROM broken) b WINDOW w AS (PARTITION BY flow_id, session ORDER BY ts_us, packet_id)"""
    steps = _sql(body).removesuffix(body).rstrip()
    return f"{steps.replace('WITH', 'WITH RECURSIVE', 1)},\n{body}"


ORACLE_SQL = {
    "packet_filter": _sql(
        """SELECT packet_id, src_ip, dst_ip,
        CASE WHEN protocol IN ('TCP', 'UDP') THEN src_port END AS src_port,
        CASE WHEN protocol IN ('TCP', 'UDP') THEN dst_port END AS dst_port,
        protocol, length, ts_us, ttl, tcp_flags, payload_size FROM packets
        WHERE src_ip IS NOT NULL AND dst_ip IS NOT NULL AND length IS NOT NULL AND protocol IN ('TCP', 'UDP', 'ICMP')"""
    ),
    "packet_limit": _sql(
        f"""SELECT packet_id, ts_us FROM good WHERE protocol <> 'OTHER'
        AND ts_us < (SELECT min(ts_us) FROM good WHERE protocol <> 'OTHER') + {int(CAPTURE_SECONDS * 1e6)}
        ORDER BY ts_us, packet_id LIMIT {CAPTURE_PACKETS}"""
    ),
    "packet_time_limit": _sql(
        f"""SELECT packet_id, ts_us FROM good WHERE protocol <> 'OTHER'
        AND ts_us < (SELECT min(ts_us) FROM good WHERE protocol <> 'OTHER') + {int(CAPTURE_SECONDS * 1e6)}"""
    ),
    "dead_letter": _sql(
        """SELECT CASE WHEN src_ip IS NULL THEN 'src_ip is missing' WHEN dst_ip IS NULL THEN 'dst_ip is missing'
        WHEN length IS NULL THEN 'length is missing' ELSE 'ts_us is missing' END AS error, count(*) AS packets
        FROM packets WHERE src_ip IS NULL OR dst_ip IS NULL OR length IS NULL OR ts_us IS NULL GROUP BY ALL"""
    ),
    "protocol_detect": _sql(
        """SELECT packet_id, protocol AS by_number,
        CASE WHEN packet_id % 3 = 0 THEN 'UDP' ELSE protocol END AS by_layers,
        CASE WHEN protocol IN ('TCP', 'UDP') THEN dst_port END AS port FROM packets"""
    ),
    "flow_key_id": _sql(
        "SELECT packet_id, endpoint_1_ip, endpoint_1_port, endpoint_2_ip, endpoint_2_port, flow_id FROM flowed"
    ),
    "packet_direction": _sql("SELECT packet_id, src_ip, dst_ip, direction FROM features"),
    "packet_direction_v6": _sql(
        """SELECT packet_id, src_ip, dst_ip,
        CASE WHEN src = 'bad' THEN 'UNKNOWN' WHEN src = 'home' AND dst_ip LIKE 'fd%' THEN 'INTERNAL'
          WHEN src = 'home' THEN 'OUTBOUND' WHEN dst_ip LIKE 'fd%' THEN 'INBOUND' ELSE 'UNKNOWN' END AS direction
        FROM (SELECT *, CASE WHEN packet_id % 8 IN (4, 6) THEN 'bad' WHEN packet_id % 8 IN (0, 1, 3, 7) THEN 'home'
          ELSE 'away' END AS src FROM packets_v6) p"""
    ),
    "direction_by_table": _sql(
        """SELECT packet_id, CASE WHEN src_ip NOT LIKE '%.%' OR dst_ip NOT LIKE '%.%' THEN 'UNKNOWN'
          WHEN s AND d THEN 'INTERNAL' WHEN s THEN 'OUTBOUND' WHEN d THEN 'INBOUND' ELSE 'UNKNOWN' END AS direction
        FROM (SELECT *,
          src_ip IN (SELECT src_ip FROM good WHERE src_ip LIKE '192.168.1.%') AS s,
          dst_ip IN (SELECT src_ip FROM good WHERE src_ip LIKE '192.168.1.%') AS d FROM good) g"""
    ),
    "direction_by_table_join": _sql(
        """SELECT packet_id, CASE WHEN src_ip NOT LIKE '%.%' OR dst_ip NOT LIKE '%.%' THEN 'UNKNOWN'
          WHEN s AND d THEN 'INTERNAL' WHEN s THEN 'OUTBOUND' WHEN d THEN 'INBOUND' ELSE 'UNKNOWN' END AS direction
        FROM (SELECT *,
          regexp_full_match(src_ip, '10[.].*|192[.]168[.]1[.]([0-9]|1[0-5])|93[.]184[.]216[.][0-2]') AS s,
          regexp_full_match(dst_ip, '10[.].*|192[.]168[.]1[.]([0-9]|1[0-5])|93[.]184[.]216[.][0-2]') AS d FROM good) g"""
    ),
    "direction_by_table_unreadable": _sql("SELECT packet_id, 'UNKNOWN' AS direction FROM good"),
    "tcp_state": _sql(f"SELECT packet_id, tcp_flags, {_STATE} AS connection_state FROM packets"),
    "payload_size": _sql(f"SELECT packet_id, {_PAYLOAD} AS payload_size FROM good"),
    "extra_fields": _sql(
        f"""SELECT packet_id, CASE WHEN packet_id % 3 <> 0 THEN ttl END AS ttl, CAST(NULL AS VARCHAR) AS tcp_flags,
        CASE WHEN packet_id % 3 <> 0 THEN CAST(payload_size AS BIGINT)
          ELSE {_PAYLOAD.replace('payload_size', 'NULL')} END AS payload_size FROM good"""
    ),
    "flow_sessions": _sql(
        "SELECT packet_id, flow_id, session, start_us AS session_start_us, initiator_ip, is_new FROM scanned"
    ),
    "packet_features": _sql("SELECT * EXCLUDE (avg_flow_time) FROM features"),
    "full_features": _sql("SELECT * FROM features"),
    "features_stream": _sql("SELECT * FROM features"),
    "avg_flow_time": _sql("SELECT packet_id, avg_flow_time FROM averaged"),
    "active_flow_timeline": _sql(
        f"""SELECT packet_id, ts_us, CAST(started - (SELECT count(*) FROM summary s
            WHERE s.last_seen_us + {_TIMEOUT} < c.ts_us) AS BIGINT) AS active_flows
        FROM (SELECT packet_id, ts_us, sum(is_new) OVER (ORDER BY ts_us, packet_id ROWS UNBOUNDED PRECEDING) AS started
          FROM breaks) c"""
    ),
    "flow_summary": _sql("SELECT * FROM summary"),
    "active_flows_asof": _sql(
        f"""SELECT flow_id, min(ts_us) AS start_us, max(ts_us) AS last_seen_us, count(*) AS total_packets
        FROM numbered WHERE ts_us <= {AS_OF_US} GROUP BY flow_id, session HAVING {AS_OF_US} - max(ts_us) <= {_TIMEOUT}"""
    ),
    "active_flow_count": _sql(
        f"""SELECT count(*) AS active_flows FROM (SELECT flow_id FROM numbered WHERE ts_us <= {AS_OF_US}
        GROUP BY flow_id HAVING {AS_OF_US} - max(ts_us) <= {_TIMEOUT}) f"""
    ),
    "expired_flows_asof": _sql(
        f"""SELECT flow_id, session, max(ts_us) AS last_seen_us, max(ts_us) - min(ts_us) AS duration_us
        FROM numbered WHERE ts_us <= {AS_OF_US} GROUP BY flow_id, session HAVING {AS_OF_US} - max(ts_us) > {_TIMEOUT}"""
    ),
    "mean_flow_time": _sql(
        """SELECT count(*) AS flows, CASE WHEN count(*) > 0
        THEN CAST(sum(duration_us) AS DOUBLE) / 1e6 / count(*) ELSE 0.0 END AS avg_flow_time FROM summary"""
    ),
    "recent_flows_topk": _sql(
        f"""SELECT flow_id, session, last_seen_us, total_packets FROM summary
        ORDER BY last_seen_us DESC, flow_id, session LIMIT {RECENT_FLOWS}"""
    ),
    "normalize_label": _sql("SELECT id, category FROM categories"),
    "severity": _sql(f"SELECT id, {_severity(_CLAMPED)} AS severity FROM scored"),
    "threat_label": _sql(
        """SELECT id, CASE WHEN category IN ('BENIGN', 'UNKNOWN') THEN category WHEN confidence < 50 THEN 'SUSPICIOUS'
        ELSE 'MALICIOUS' END AS threat_label FROM categories"""
    ),
    "risk_score": _sql(f"SELECT id, {_CLAMPED} * {_weight('category')} AS risk_score FROM categories"),
    "feature_select": _sql(
        f"SELECT packet_id, {_AS_NUMBERS}, protocol, direction, connection_state FROM features"
    ),
    "feature_encode": _sql(
        f"""SELECT packet_id, {_AS_NUMBERS}, {_code('protocol')}, {_code('direction')}, {_code('connection_state')}
        FROM features"""
    ),
    "partial_dataset": _sql(
        f"""SELECT packet_id AS row_id, CASE WHEN packet_id % 4 = 0 THEN 0.0 ELSE CAST(length AS DOUBLE) END AS packet_length,
        coalesce(CAST(ttl AS DOUBLE), 0.0) AS ttl, CAST(0 AS DOUBLE) AS byte_rate, {_code('protocol')},
        CAST(3 AS DOUBLE) AS direction, y_true AS label FROM packets JOIN eval_pairs ON packet_id = id"""
    ),
    "scorable_split": _sql(
        """SELECT CASE WHEN packet_id % 101 = 0 OR packet_id % 103 = 0 THEN 'byte_rate is not finite' END AS error,
        count(*) AS rows FROM good GROUP BY ALL"""
    ),
    "class_weights": _sql(
        """SELECT y_true AS label, count(*) AS rows, CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight
        FROM eval_pairs GROUP BY y_true"""
    ),
    "label_classes": _sql(
        """SELECT y_true AS label, CAST(row_number() OVER (ORDER BY y_true) - 1 AS INT) AS class_index
        FROM (SELECT DISTINCT y_true FROM eval_pairs) c"""
    ),
    "dataset_profile": _sql("SELECT count(*) AS samples, CAST(15 AS INT) AS features FROM packets"),
    "stratified_split": _sql(
        """SELECT id, y_true, CASE WHEN place <= floor(total * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT id, y_true, row_number() OVER (PARTITION BY y_true ORDER BY md5('42:' || CAST(id AS VARCHAR))) AS place,
          count(*) OVER (PARTITION BY y_true) AS total FROM eval_pairs) r"""
    ),
    "confusion": _sql("SELECT y_true, y_pred, n AS rows FROM counts"),
    "eval_metrics": _sql(
        """SELECT CAST(sum(hits) AS DOUBLE) / CAST(sum(support) AS DOUBLE) AS accuracy,
        sum(precision ORDER BY label) / count(*) AS precision_macro, sum(recall ORDER BY label) / count(*) AS recall_macro,
        sum(f1 ORDER BY label) / count(*) AS f1_macro FROM quality"""
    ),
    "classification_report": _sql(
        """SELECT label, precision, recall, f1, support FROM quality
        UNION ALL SELECT 'accuracy', a, a, a, s FROM (SELECT CAST(sum(hits) AS DOUBLE) / CAST(sum(support) AS DOUBLE) AS a,
          CAST(sum(support) AS BIGINT) AS s FROM quality) t
        UNION ALL SELECT 'macro avg', sum(precision ORDER BY label) / count(*), sum(recall ORDER BY label) / count(*),
          sum(f1 ORDER BY label) / count(*), CAST(sum(support) AS BIGINT) FROM quality
        UNION ALL SELECT 'weighted avg', sum(precision * support ORDER BY label) / CAST(sum(support) AS DOUBLE),
          sum(recall * support ORDER BY label) / CAST(sum(support) AS DOUBLE),
          sum(f1 * support ORDER BY label) / CAST(sum(support) AS DOUBLE), CAST(sum(support) AS BIGINT) FROM quality"""
    ),
    "union_rows": _sql(
        """SELECT packet_id, tcp_flags, CAST(NULL AS VARCHAR) AS protocol, CAST(NULL AS BIGINT) AS length
        FROM packets WHERE protocol = 'TCP'
        UNION ALL SELECT packet_id, NULL, protocol, length FROM packets WHERE protocol <> 'TCP'"""
    ),
    "packet_text": _sql(
        f"""SELECT packet_id, '[' || protocol || '] ' || coalesce(src_ip, 'None') || ':' || coalesce(CAST(src_port AS VARCHAR), 'None')
        || ' -> ' || coalesce(dst_ip, 'None') || ':' || coalesce(CAST(dst_port AS VARCHAR), 'None')
        || ' len=' || CAST(length AS VARCHAR) || ' ts=' || {_SECONDS} AS summary FROM packets"""
    ),
    "feature_text": _sql(
        """SELECT packet_id, 'FeatureVector[flow=' || flow_id || ' ' || protocol || ' ' || src_ip || ':'
        || coalesce(CAST(src_port AS VARCHAR), 'None') || '->' || dst_ip || ':' || coalesce(CAST(dst_port AS VARCHAR), 'None')
        || ' dir=' || direction || ' state=' || connection_state || ' len=' || CAST(packet_length AS VARCHAR)
        || ' pkt#=' || CAST(total_packets_in_flow AS VARCHAR) || ']' AS summary FROM features"""
    ),
    "packet_json": _sql(
        """SELECT '{"packet_id":' || CAST(packet_id AS VARCHAR) || ',"src_ip":' || coalesce('"' || src_ip || '"', 'null')
        || ',"src_port":' || coalesce(CAST(src_port AS VARCHAR), 'null') || ',"protocol":"' || protocol
        || '","length":' || CAST(length AS VARCHAR) || '}' AS value FROM packets"""
    ),
    "predictions": _sql(
        f"""SELECT *, printf('ThreatPrediction[label=%s category=%s confidence=%.2f%% risk=%.2f severity=%s model=%s]',
          threat_label, attack_category, confidence_score, risk_score, severity, 'given') AS summary
        FROM (SELECT id, attack_category, confidence_score,
          CASE WHEN attack_category = 'BENIGN' THEN 'BENIGN' WHEN confidence_score < 50 THEN 'SUSPICIOUS' ELSE 'MALICIOUS' END
            AS threat_label,
          {_severity('confidence_score')} AS severity, confidence_score * {_weight('attack_category')} AS risk_score,
          CAST({FIXED_NOW} AS DOUBLE) AS prediction_timestamp, p_ddos AS ddos_probability
        FROM (SELECT *, {_BEST} * 100.0 AS confidence_score,
          CASE {_BEST} WHEN p_benign THEN 'BENIGN' WHEN p_ddos THEN 'DDOS' WHEN p_phishing THEN 'PHISHING'
            ELSE 'PORT_SCAN' END AS attack_category FROM probabilities) p) q"""
    ),
    "flow_sessions_swept": _sessions(
        f"""sweeps(s) AS (SELECT min(ts_us) FROM good UNION ALL
          SELECT (SELECT min(ts_us) FROM good WHERE ts_us >= s + {int(SWEEP_SECONDS * 1e6)}) FROM sweeps WHERE s IS NOT NULL),
        broken AS (SELECT gaps.*, prev_us IS NULL OR s - prev_us > {_TIMEOUT} AS breaks FROM gaps ASOF JOIN (SELECT s FROM sweeps WHERE s IS NOT NULL) w
          ON gaps.ts_us >= w.s)"""
    ),
    "flow_sessions_capped": _sessions(
        f"""placed AS (SELECT *, row_number() OVER (ORDER BY ts_us, packet_id) AS place FROM gaps),
        known AS (SELECT *, lag(place) OVER (PARTITION BY flow_id ORDER BY place) AS earlier FROM placed),
        others AS (SELECT b.packet_id, count(DISTINCT o.flow_id) AS others FROM known b JOIN placed o ON o.place > b.earlier AND o.place < b.place
          WHERE b.place - b.earlier > {TRACKED_FLOWS} AND b.ts_us - b.prev_us <= {_TIMEOUT} GROUP BY b.packet_id),
        broken AS (SELECT known.*, earlier IS NULL OR ts_us - prev_us > {_TIMEOUT} OR coalesce(others, 0) >= {TRACKED_FLOWS} AS breaks
          FROM known LEFT JOIN others USING (packet_id))"""
    ),
    "late_packets_stream": _sql(
        f"""SELECT packet_id, 'late' AS fate, CAST(1 AS BIGINT) AS packets FROM good WHERE packet_id % {LATE_EVERY} = 0 AND ts_us + {_TIMEOUT} <=
          (SELECT max(ts_us) FROM good WHERE packet_id % {LATE_EVERY} <> 0) - {int(LATE_DELAY * 1e6)}
        UNION ALL SELECT NULL, CASE WHEN is_late THEN 'late, counted' ELSE 'in flow sessions' END, count(*) FROM (
          SELECT packet_id % {LATE_EVERY} = 0 AND ts_us + {_TIMEOUT} <=
            (SELECT max(ts_us) FROM good WHERE packet_id % {LATE_EVERY} <> 0) - {int(LATE_DELAY * 1e6)} AS is_late FROM good) g GROUP BY is_late"""
    ),
    "packet_record_json": _sql(f"SELECT *, {_FIELDS_OF_PACKET} AS fields FROM packets"),
    "feature_json": _sql(f"SELECT *, {_fields(FEATURE_SCHEMA.fieldNames())} AS fields FROM features"),
    "prediction_json": _sql(
        f"""SELECT id, attack_category, confidence_score,
          CASE WHEN attack_category = 'BENIGN' THEN 'BENIGN' WHEN confidence_score < 50 THEN 'SUSPICIOUS' ELSE 'MALICIOUS' END AS threat_label,
          {_severity('confidence_score')} AS severity, confidence_score * {_weight('attack_category')} AS risk_score, 'given' AS model_name,
          CAST({FIXED_NOW} AS DOUBLE) AS prediction_timestamp, CAST(NULL AS VARCHAR) AS flow_id,
          p_benign, p_ddos, p_phishing, p_scan AS p_port_scan, {_fields(['id', *PREDICTION_SCHEMA.fieldNames()])} AS fields
        FROM (SELECT *, {_BEST} * 100.0 AS confidence_score,
          CASE {_BEST} WHEN p_benign THEN 'BENIGN' WHEN p_ddos THEN 'DDOS' WHEN p_phishing THEN 'PHISHING'
            ELSE 'PORT_SCAN' END AS attack_category FROM probabilities) p"""
    ),
    "recent_flows_half": _sql(
        """SELECT flow_id, session, last_seen_us, total_packets
        FROM (SELECT *, row_number() OVER (ORDER BY last_seen_us DESC, flow_id, session) AS place, count(*) OVER () AS total FROM summary) r
        WHERE place <= total // 2"""
    ),
    "severity_by_table": _sql(
        f"""SELECT id, CASE WHEN c IS NULL THEN NULL ELSE coalesce(
            (SELECT r_name FROM region WHERE r_regionkey * 20 + 19.5 >= c ORDER BY r_regionkey LIMIT 1),
            (SELECT r_name FROM region ORDER BY r_regionkey DESC LIMIT 1)) END AS severity
        FROM (SELECT id, {_CLAMPED} AS c FROM scored) s"""
    ),
    "risk_by_table": _sql(
        f"""SELECT id, category, greatest(least({_CLAMPED} * coalesce(weight, 0.5::DOUBLE), 100.0), 0.0) AS risk_score
        FROM categories LEFT JOIN (SELECT y_true, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM eval_pairs) AS weight
          FROM eval_pairs GROUP BY y_true) w ON y_true = category"""
    ),
    "feature_vector": _sql(
        f"""SELECT packet_id, {_AS_NUMBERS}, {_code('protocol')}, {_code('direction')}, {_code('connection_state')}, 15 AS places
        FROM features"""
    ),
    "packets_table": _sql(
        """SELECT * REPLACE (CAST(src_port AS INTEGER) AS src_port, CAST(dst_port AS INTEGER) AS dst_port) FROM packets"""
    ),
    "stratified_split_many": _sql(
        """SELECT id, class, CASE WHEN place <= floor(total * 0.3 + 0.5) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT id, 'c' || (id % 2003) AS class, row_number() OVER (PARTITION BY id % 2003 ORDER BY md5('42:' || CAST(id AS VARCHAR))) AS place,
          count(*) OVER (PARTITION BY id % 2003) AS total FROM eval_pairs) r"""
    ),
    "feature_csv": _sql("SELECT packet_id, flow_id, direction, total_bytes, byte_rate, '{}' AS extra FROM features"),
    "labelled_csv": _sql(
        f"""SELECT CAST(packet_id AS DOUBLE) AS flow_duration, CAST(length AS DOUBLE) AS packet_length, {_code('protocol')},
        CAST(0 AS DOUBLE) AS total_bytes, y_true AS label FROM packets JOIN eval_pairs ON packet_id = id"""
    ),
    "saved_model": _sql(
        """SELECT CAST(0 AS BIGINT) AS differences, CAST(sum(floor(n * 0.2 + 0.5)) AS BIGINT) AS rows
        FROM (SELECT count(*) AS n FROM good JOIN eval_pairs ON packet_id = id GROUP BY y_true) c"""
    ),
    "labelled_csv_split": _sql(
        """SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(floor(n * 0.2 + 0.5)) AS BIGINT) AS test_rows, CAST(0 AS BIGINT) AS differences
        FROM (SELECT count(*) AS n FROM packets JOIN eval_pairs ON packet_id = id GROUP BY y_true) c"""
    ),
    "labelled_csv_rejects": _sql(
        """SELECT CASE WHEN packet_id % 19 = 0 THEN cells || ',5' ELSE packet_id || ',' || length END AS record,
          CASE WHEN packet_id % 19 = 0 THEN '4' ELSE '2' END || ' cells in place of 3' AS error
        FROM (SELECT packet_id, length, packet_id || ',' || length || ',' || lower(y_true) AS cells FROM packets JOIN eval_pairs ON packet_id = id) l
        WHERE packet_id % 29 <> 0 AND (packet_id % 19 = 0 OR packet_id % 23 = 0)"""
    ),
    "delivery_stream": _sql(
        f"""SELECT packet_id, CAST({_number('src_ip')} AS BIGINT) AS source,
          CASE WHEN src_ip IS NULL OR src_ip = 'not_an_ip' THEN 'AddressValueError' END AS error FROM packets"""
    ),
    "evaluation_checks": _sql(
        """SELECT label, support, true AS in_bounds, true AS f1_follows FROM (
          SELECT y_true AS label, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS support FROM good JOIN eval_pairs ON packet_id = id GROUP BY y_true
          UNION ALL SELECT name, CAST(sum(n) AS BIGINT) FROM (
            SELECT floor(count(*) * 0.2 + 0.5) AS n FROM good JOIN eval_pairs ON packet_id = id GROUP BY y_true) c,
            (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) t(name) GROUP BY name) r"""
    ),
    "score_stream_checks": _sql("SELECT packet_id, flow_id, CAST(1 AS BIGINT) AS times, true AS as_in_batch FROM flowed"),
    "prediction_checks": _sql(
        """SELECT packet_id, flow_id, true AS sum_to_one, true AS likeliest, true AS confidence_follows,
        true AS severity_follows, true AS label_follows, true AS risk_in_bounds
        FROM (SELECT packet_id, flow_id, row_number() OVER (PARTITION BY y_true ORDER BY md5('42:' || CAST(id AS VARCHAR))) AS place,
          count(*) OVER (PARTITION BY y_true) AS total FROM flowed JOIN eval_pairs ON packet_id = id) r
        WHERE place <= floor(total * 0.2 + 0.5)"""
    ),
    "closed_flows_stream": _sql("SELECT * EXCLUDE (session) FROM summary"),
    "summary_stream": _sql(
        """SELECT flow_id, endpoint_1_ip, endpoint_1_port, endpoint_2_ip, endpoint_2_port, protocol, start_us, last_seen_us,
        total_packets, total_bytes, connection_state, initiator_ip, duration_us FROM summary"""
    ),
}


def _on_hot(sql: str) -> str:
    """The same asked of the packets with a hot flow and a crowded instant."""
    text = sql.replace("SELECT * FROM packets\n", "SELECT * FROM packets_hot\n")
    return text.replace("good AS (", f"packets_hot AS ({DUCKDB_VIEWS['packets_hot']}),\ngood AS (", 1)


for _name in ("full_features", "active_flow_timeline", "flow_summary"):
    ORACLE_SQL[f"{_name}_cut"] = _on_hot(ORACLE_SQL[_name])
for _name in ("full_features", "active_flow_timeline"):
    ORACLE_SQL[f"{_name}_nested"] = ORACLE_SQL[f"{_name}_cut"]
ORACLE_SQL["packet_limit_large"] = _on_hot(
    _sql(f"SELECT packet_id, ts_us FROM good WHERE protocol <> 'OTHER' ORDER BY ts_us, packet_id LIMIT {LARGE_CAPTURE}")
)
