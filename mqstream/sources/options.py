"""Options of the message source: names, aliases, defaults and checks."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from ..functions.values import elapsed, parse_duration, parse_instant, parse_size, resource, short_bytes, time_iso

ACK_MODES = {"aftercommit": "afterCommit", "aftercheckpoint": "afterCheckpoint", "early": "early"}
GATHER_MODES = ("batch", "immediate")
SEEK_MODES = {"none": "none", "beginning": "beginning", "start": "beginning", "timestamp": "timestamp", "time": "timestamp", "snapshot": "snapshot"}
SCHEMA_MODES = ("raw", "basic", "slim", "dynamic", "mixed")
METADATA_MODES = ("none", "basic", "slim", "full")
BATCH_BYTES, ACK_SEED_MS, MIB = 512 << 20, 180_000, 1 << 20


def choice(option: str, text: str, known) -> str:  # noqa: ANN001
    key = text.strip().lower()
    if key not in known:
        raise ValueError(f"{option}: {text!r} is none of {', '.join(known)}")
    return known[key] if isinstance(known, dict) else key


@dataclass(frozen=True)
class Options:
    project: str
    subscription: str
    topic: str | None = None
    ack_mode: str = "afterCommit"
    max_retry_ms: int = 90_000
    ack_deadline_ms: int | None = None
    gather_mode: str = "batch"
    receive_ms: int | None = None
    processing_ms: int | None = None
    batch_size: int = BATCH_BYTES
    batch_count: int = 0
    num_writers: int = 1
    seek: str = "none"
    seek_ms: int | None = None
    seek_snapshot: str | None = None
    limit_ms: int | None = None
    credentials_file: str | None = None
    emulator_host: str | None = None
    schema_mode: str = "basic"
    metadata_mode: str = "none"
    min_rows: int = 0
    max_rows: int = 0
    max_bytes: int = 0
    # Extensions of the local queue: its file, and a folder of topic schemas.
    queue: str | None = None
    registry: str | None = None

    @staticmethod
    def of(options: Mapping[str, str]) -> Options:
        given = {k.lower(): v.strip() for k, v in options.items() if v is not None and v.strip()}

        def get(*names: str) -> str | None:
            return next((given[n.lower()] for n in names if n.lower() in given), None)

        def timed(name: str) -> int | None:
            text = get(name)
            return None if text is None or text.lower() == "auto" else parse_duration(text, name)

        def count(name: str) -> int:
            text = get(name) or "0"
            try:
                return int(text)
            except ValueError:
                raise ValueError(f"{name}: not a whole number: {text!r}") from None

        project, subscription = get("projectId", "project"), get("subscription", "subscriptionName")
        if not project:
            raise ValueError("projectId is required")
        if not subscription:
            raise ValueError("subscription is required")
        topic, deadline = get("topic", "topicName"), timed("ackDeadline")
        if deadline is not None and (deadline % 1000 or not 10_000 <= deadline <= 600_000):
            raise ValueError("ackDeadline: whole seconds from 10s to 600s")
        retry = timed("maxRetryTime")
        if retry is not None and not 0 <= retry <= 1_800_000:
            raise ValueError("maxRetryTime: from 0 to 30m")
        for name in ("receiveTime", "processingTime"):
            if (ms := timed(name)) is not None and ms <= 0:
                raise ValueError(f"{name}: must be above 0")
        size = parse_size(get("batchSize"), "batchSize") if get("batchSize") else BATCH_BYTES
        if size and size < MIB:
            raise ValueError("batchSize: 0 or at least 1m")
        if count("batchCount") < 0:
            raise ValueError("batchCount: must not be below 0")
        writers = get("numWriters") or "1"
        if writers.lower() == "auto":
            writers = str(os.cpu_count() or 1)
        if not writers.isdigit() or int(writers) < 1:
            raise ValueError("numWriters: auto or at least 1")
        seek = choice("seek", get("seek") or "none", SEEK_MODES)
        seek_time, snapshot, limit = get("seekTime"), get("seekSnapshot"), get("limitTime")
        if seek == "timestamp" and not seek_time:
            raise ValueError("seekTime is required for seek=timestamp")
        if seek == "snapshot" and not snapshot:
            raise ValueError("seekSnapshot is required for seek=snapshot")
        seek_ms = parse_instant(seek_time, "seekTime") if seek_time else None
        limit_ms = parse_instant(limit, "limitTime") if limit else None
        if limit_ms is not None and seek == "timestamp" and limit_ms <= seek_ms:
            raise ValueError("limitTime must be after seekTime")
        ack = (get("ackMode") or "afterCommit").replace("_", "").replace("-", "")
        return Options(
            project, resource(project, "subscriptions", subscription), resource(project, "topics", topic) if topic else None,
            choice("ackMode", ack, ACK_MODES), min(90_000, deadline or ACK_SEED_MS) if retry is None else retry, deadline,
            choice("gatherMode", get("gatherMode") or "batch", GATHER_MODES), timed("receiveTime"), timed("processingTime"), size, count("batchCount"), int(writers),
            seek, seek_ms, snapshot, limit_ms, get("credentialsFile", "credentials"), get("emulatorHost"),
            choice("schemaMode", get("schemaMode") or "basic", SCHEMA_MODES), choice("metadataMode", get("metadataMode") or "none", METADATA_MODES),
            count("minRows"), count("maxRowsPerTrigger"), parse_size(get("maxBytesPerTrigger"), "maxBytesPerTrigger"), get("queue"), get("registry"),
        )

    def lease_ms(self) -> int:
        """How long a lease lasts between extensions."""
        return max(60_000, self.ack_deadline_ms or ACK_SEED_MS)

    def summary(self) -> str:
        """The start-up line; credentials stay out of it."""
        auto = lambda ms: "auto" if ms is None else elapsed(ms)
        parts = {
            "subscription": self.subscription, "topic": self.topic or "-", "ackMode": self.ack_mode, "ackDeadline": auto(self.ack_deadline_ms), "maxRetryTime": elapsed(self.max_retry_ms),
            "gatherMode": self.gather_mode, "receiveTime": auto(self.receive_ms), "processingTime": auto(self.processing_ms), "batchSize": short_bytes(self.batch_size) if self.batch_size else "off",
            "batchCount": self.batch_count or "off", "numWriters": self.num_writers, "seek": self.seek, "limitTime": time_iso(self.limit_ms) if self.limit_ms is not None else "-",
            "schemaMode": self.schema_mode, "metadataMode": self.metadata_mode,
        }
        return " ".join(f"{k}={v}" for k, v in parts.items())
