"""A one-row-at-a-time model of flow tracking, to check the Spark operators against."""


def track(packets, timeout_us):
    """Flow state after each packet, taken in the given order; packets are dicts with a ``flow``."""
    live, durations, out = {}, {}, []
    sessions = {}
    for p in packets:
        ts = p["ts_us"]
        seen = live.get(p["flow"])
        if seen is None or ts - seen["last"] > timeout_us:
            sessions[p["flow"]] = sessions.get(p["flow"], 0) + 1
            seen = {"start": ts, "last": ts, "n": 0, "bytes": 0, "by": p["src_ip"], "gap": None}
            live[p["flow"]] = seen
        else:
            seen["gap"] = max(ts - seen["last"], 0) / 1e6
        seen["n"] += 1
        seen["bytes"] += p["length"]
        seen["last"] = ts
        number = sessions[p["flow"]]
        durations[p["flow"], number] = max(ts - seen["start"], 0)
        d = durations[p["flow"], number]
        out.append(
            {
                "packet_id": p["packet_id"],
                "session": number,
                "total_packets_in_flow": seen["n"],
                "total_bytes": seen["bytes"],
                "initiator_ip": seen["by"],
                "flow_duration": d / 1e6,
                "packet_rate": seen["n"] / (d / 1e6) if d > 0 else float(seen["n"]),
                "byte_rate": seen["bytes"] / (d / 1e6) if d > 0 else float(seen["bytes"]),
                "inter_arrival_time": seen["gap"],
                "avg_flow_time": sum(durations.values()) / 1e6 / len(durations),
                "active": sum(ts - f["last"] <= timeout_us for f in live.values()),
            }
        )
    return out
