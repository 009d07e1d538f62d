"""Run parameters. Thresholds that the original tool hard-codes are
arguments here, with the same defaults."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import timedelta

# Fixed values that results depend on (must stay as they are).
DEFAULT_SERVICE_CHAIN = (
    "api-gateway",
    "auth-service",
    "order-service",
    "payment-service",
    "inventory-service",
)
VALID_LEVELS = ("INFO", "WARN", "ERROR", "DEBUG")
SPIKE_REQUEST_ID = "GLOBAL_SYSTEM_SPIKE"
DEFAULT_MODEL = "meta/llama3-70b-instruct"


@dataclass(frozen=True)
class Params:
    latency_threshold: timedelta = timedelta(milliseconds=500)
    # Idle gap that closes a request session in the streaming correlator.
    correlation_window: timedelta = timedelta(seconds=10)
    service_chain: tuple[str, ...] = field(default=DEFAULT_SERVICE_CHAIN)
    spike_window: timedelta = timedelta(minutes=1)
    spike_threshold: int = 10
    prompt_max_entries: int = 50
    prompt_head: int = 20
    prompt_tail: int = 30
    # Reject longer lines; None (default) parses lines of any length.
    max_line_bytes: int | None = None
    model: str = DEFAULT_MODEL
    temperature: float = 0.1

    @property
    def latency_threshold_ms(self) -> int:
        return int(self.latency_threshold / timedelta(milliseconds=1))


# Duration unit suffixes and their length in nanoseconds.
_UNIT_NS = {"ns": 1, "us": 1_000, "\u00b5s": 1_000, "\u03bcs": 1_000, "ms": 1_000_000, "s": 1_000_000_000, "m": 60_000_000_000, "h": 3_600_000_000_000}
_DURATION_RE = re.compile(r"([0-9]*(?:\.[0-9]*)?)(ns|us|\u00b5s|\u03bcs|ms|s|m|h)")


def parse_duration(text: str) -> timedelta | None:
    """Duration text such as ``500ms``, ``10s``, ``1m30s``, ``-1.5h``; ``0`` alone is zero.

    Returns None when the text is not a duration. Sub-microsecond parts are
    truncated (``timedelta`` holds microseconds).
    """
    s = text.strip()
    sign = -1 if s.startswith("-") else 1
    s = s[1:] if s[:1] in "+-" else s
    if s == "0":
        return timedelta(0)
    if not s:
        return None
    total_ns, pos = 0, 0
    for m in _DURATION_RE.finditer(s):
        number, unit = m.groups()
        if m.start() != pos or number in ("", "."):
            return None
        whole, _, frac = number.partition(".")
        total_ns += int(whole or 0) * _UNIT_NS[unit]
        if frac:
            total_ns += int(frac) * _UNIT_NS[unit] // 10 ** len(frac)
        pos = m.end()
    if pos != len(s):
        return None
    return timedelta(microseconds=sign * total_ns // 1_000)


def setting_duration(value, default: timedelta) -> timedelta:
    """A configured duration; a zero or unparsable value falls back to the default."""
    d = value if isinstance(value, timedelta) else parse_duration(str(value)) if value is not None else None
    return default if not d else d


def params_from_settings(settings: dict) -> Params:
    """Build :class:`Params` from a settings mapping (already loaded by the caller).

    Recognized keys: ``latency_threshold``, ``correlation_window`` (duration text,
    zero or unparsable -> default), ``services`` (list; empty -> default chain),
    ``model`` (empty -> default).
    """
    base = Params()
    chain = tuple(settings.get("services") or ()) or base.service_chain
    return Params(
        latency_threshold=setting_duration(settings.get("latency_threshold"), base.latency_threshold),
        correlation_window=setting_duration(settings.get("correlation_window"), base.correlation_window),
        service_chain=chain,
        model=settings.get("model") or base.model,
    )
