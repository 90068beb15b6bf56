"""Scalar readings of option values and their printed forms, in Python and as columns."""

from __future__ import annotations

import re
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS_MS = {"ms": 1, "s": 1000, "m": 60_000}
UNITS_BYTES = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
LONG_MAX = 2**63 - 1


def parse_duration(text: str, option: str = "duration") -> int:
    """Milliseconds of "250ms", "30s", "5m" or plain seconds."""
    m = re.fullmatch(r"(-?\d+)\s*(ms|s|m)?", (text or "").strip().lower())
    if not m:
        raise ValueError(f"{option}: not a duration: {text!r}")
    return int(m[1]) * UNITS_MS[m[2] or "s"]


def parse_size(text: str | None, option: str = "size") -> int:
    """Bytes of "64m", "1g", "512k" or a plain number; blank is 0."""
    text = (text or "").strip().lower()
    if not text:
        return 0
    m = re.fullmatch(r"(-?\d+)\s*([kmg]?)b?", text)
    if not m:
        raise ValueError(f"{option}: not a size: {text!r}")
    size = int(m[1]) * UNITS_BYTES[m[2]]
    if abs(size) > LONG_MAX:
        raise ValueError(f"{option}: too large: {text!r}")
    return size


def parse_instant(text: str, option: str = "time") -> int:
    """Epoch milliseconds of digits (taken as such) or of an RFC 3339 time with an offset."""
    text = (text or "").strip()
    if re.fullmatch(r"\d+", text):
        return int(text)
    try:
        at = datetime.fromisoformat(text)
    except ValueError:
        raise ValueError(f"{option}: not an instant: {text!r}") from None
    if at.tzinfo is None:
        raise ValueError(f"{option}: an offset is missing: {text!r}")
    delta = at - datetime(1970, 1, 1, tzinfo=UTC)
    return (delta.days * 86_400 + delta.seconds) * 1000 + delta.microseconds // 1000


def time_iso(ms: int) -> str:
    return datetime.fromtimestamp(ms / 1000, UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")


def elapsed(ms: int) -> str:
    """"750ms", "2.5m" from 100 seconds on, "12:05" from 10 minutes on."""
    if ms > 600_000:
        return f"{ms // 60_000}:{ms // 1000 % 60:02d}"
    if ms > 99_999:
        return f"{ms // 60_000}.{ms % 60_000 // 6_000}m"
    return f"{ms}ms"


def short_bytes(n: int) -> str:
    for unit, size in (("T", 1 << 40), ("G", 1 << 30), ("M", 1 << 20), ("K", 1 << 10)):
        if n >= size:
            return f"{n / size:.1f}{unit}"
    return f"{n}B"


def short_count(n: int) -> str:
    for unit, size in (("G", 10**9), ("M", 10**6), ("k", 10**3)):
        if n >= size:
            return f"{n / size:.1f}{unit}"
    return str(n)


def resource(project: str, kind: str, name: str) -> str:
    """A full path as it is, a bare name below its project."""
    return name if name.startswith("projects/") else f"projects/{project}/{kind}/{name}"


def duration_ms(text: Column) -> Column:
    """parse_duration as a column; null where it would fail."""
    t = F.lower(F.trim(text))
    n = F.regexp_extract(t, r"^(-?\d+)\s*(ms|s|m)?$", 1)
    unit = F.regexp_extract(t, r"^(-?\d+)\s*(ms|s|m)?$", 2)
    factor = F.when(unit == "ms", 1).when(unit == "m", 60_000).otherwise(1000)
    return F.when(n != "", n.cast("bigint") * factor)


def size_bytes(text: Column) -> Column:
    """parse_size as a column; null where it would fail."""
    t = F.lower(F.trim(text))
    n = F.regexp_extract(t, r"^(-?\d+)\s*([kmg]?)b?$", 1)
    unit = F.regexp_extract(t, r"^(-?\d+)\s*([kmg]?)b?$", 2)
    factor = F.when(unit == "k", 1 << 10).when(unit == "m", 1 << 20).when(unit == "g", 1 << 30).otherwise(1)
    return F.when(t == "", F.lit(0).cast("bigint")).when(n != "", n.cast("bigint") * factor.cast("bigint"))


def instant_ms(text: Column) -> Column:
    """parse_instant as a column; null where it would fail."""
    t = F.trim(text)
    dated = t.rlike(r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$")
    return F.when(t.rlike(r"^\d+$"), F.expr("1L") * t.try_cast("bigint")).when(dated, F.unix_millis(t.try_cast("timestamp")))


def resource_path(project: Column, kind: str, name: Column) -> Column:
    return F.when(name.startswith("projects/"), name).otherwise(F.concat(F.lit("projects/"), project, F.lit(f"/{kind}/"), name))
