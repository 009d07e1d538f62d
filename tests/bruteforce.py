"""Plain-Python brute force of the log-analysis semantics, for small fixtures only."""

from __future__ import annotations

import datetime as dt
import re

CHAIN = ["api-gateway", "auth-service", "order-service", "payment-service", "inventory-service"]
RFC = re.compile(r"^(\d{4})-(\d\d)-(\d\d)T(\d{1,2}):(\d\d):(\d\d)(?:\.(\d+))?Z$")


def parse(raw):
    parts = raw.split(" | ", 5)
    if len(parts) < 6:
        return None
    m = RFC.match(parts[0].strip())
    if not m:
        return None
    y, mo, d, h, mi, s, frac = m.groups()
    frac = (frac or "").ljust(6, "0")[:6]
    ts = dt.datetime(int(y), int(mo), int(d), int(h), int(mi), int(s), int(frac))
    service, level, rid, msg = (p.strip() for p in parts[1:5])
    if not service or level not in ("INFO", "WARN", "ERROR", "DEBUG") or not rid or not msg:
        return None
    lat = parts[5].strip()
    lat = lat[len("latency="):] if lat.startswith("latency=") else lat
    lat = lat[:-2] if lat.endswith("ms") else lat
    ms = int(lat) if re.fullmatch(r"[+-]?[0-9]+", lat) and -(2**63) <= int(lat) < 2**63 else 0
    return dict(ts=ts, service=service, level=level, rid=rid, msg=msg, ms=ms, raw=raw)


def dur(ms):
    if ms == 0:
        return "0s"
    sign, a = ("-", -ms) if ms < 0 else ("", ms)
    if a < 1000:
        return f"{sign}{a}ms"
    h, rem = divmod(a, 3_600_000)
    m, rem = divmod(rem, 60_000)
    s, f = divmod(rem, 1000)
    out = (f"{h}h" if h else "") + (f"{m}m" if a >= 60_000 else "") + str(s) + (("." + f"{f:03d}".rstrip("0")) if f else "") + "s"
    return sign + out


def analyze(lines, threshold_ms=500, spike_threshold=10, window_s=60):
    groups = {}
    for raw in lines:
        e = parse(raw)
        if e is None:
            continue
        g = groups.setdefault(e["rid"], [])
        if all(x["raw"] != raw for x in g):
            g.append(e)
    diags = []
    for rid, es in groups.items():
        es.sort(key=lambda x: (x["ts"], x["raw"]))
        rules = []
        if any(x["level"] == "ERROR" for x in es):
            rules.append("error_detected")
        slow = [x for x in es if x["ms"] > threshold_ms]
        if slow:
            rules.append(f"high_latency({dur(slow[0]['ms'])} in {slow[0]['service']})")
        seen = {x["service"] for x in es}
        rules += [f"missing_hop({s})" for s in CHAIN if s not in seen]
        if any("timeout" in x["msg"].lower() or "context deadline exceeded" in x["msg"].lower() for x in es):
            rules.append("timeout_pattern")
        if rules:
            sev = "critical" if any("error" in r or "timeout" in r for r in rules) else "warning"
            diags.append(((es[0]["ts"], rid), dict(request_id=rid, root_cause="Rule-based detection: " + ", ".join(rules), severity=sev)))
    diags.sort(key=lambda x: x[0])
    errors = sorted(x["ts"] for es in groups.values() for x in es if x["level"] == "ERROR")
    spike = None
    for i, t in enumerate(errors):
        n = sum(1 for u in errors[i:] if u < t + dt.timedelta(seconds=window_s))
        if n > spike_threshold:
            spike = t
            break
    out = []
    if spike is not None:
        out.append(dict(request_id="GLOBAL_SYSTEM_SPIKE", severity="critical", start=spike.strftime("%Y-%m-%dT%H:%M:%SZ")))
    out += [d for _, d in diags]
    return out
