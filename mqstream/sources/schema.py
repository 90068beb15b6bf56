"""Table and metadata schemas: the message envelope and what the modes make of it."""

from __future__ import annotations

import json
import os

from pyspark.sql import types as T

from .avro import struct_of

ENVELOPE = {
    "body": T.StructField("body", T.BinaryType(), False),
    "messageid": T.StructField("messageid", T.StringType(), False),
    "publishtime": T.StructField("publishtime", T.TimestampType(), False),
    "orderingkey": T.StructField("orderingkey", T.StringType(), False),
    "ackid": T.StructField("ackid", T.StringType(), True),
    "attributes": T.StructField("attributes", T.MapType(T.StringType(), T.StringType(), False), False),
}
ALIASES = {"data": "body"}
RAW = T.StructType(list(ENVELOPE.values()))
TABLE = {"raw": ["body"], "basic": ["body", "messageid", "publishtime"], "slim": ["body", "messageid", "publishtime", "orderingkey"]}
MIXED = ["messageid", "publishtime"]
METADATA = {
    "none": [], "basic": ["messageid", "publishtime"], "slim": ["messageid", "publishtime", "orderingkey", "ackid"],
    "full": ["messageid", "publishtime", "orderingkey", "ackid", "attributes"],
}


def envelope_name(name: str) -> str | None:
    """The envelope column a field name stands for, whatever its case."""
    low = ALIASES.get(name.lower(), name.lower())
    return low if low in ENVELOPE else None


def table_schema(mode: str, payload: T.StructType | None = None) -> T.StructType:
    if mode in TABLE:
        return T.StructType([ENVELOPE[n] for n in TABLE[mode]])
    if payload is None or not payload.fields:
        raise ValueError(f"schemaMode={mode}: no payload schema is known; name a topic and a registry, or give a schema")
    if mode == "dynamic":
        return payload
    if mode != "mixed":
        raise ValueError(f"schemaMode: {mode!r} is unknown")
    taken = {f.name.lower() for f in payload.fields}
    return T.StructType([*payload.fields, *(ENVELOPE[n] for n in MIXED if n not in taken)])


def metadata_schema(mode: str, table: T.StructType) -> T.StructType:
    """The metadata columns that the table does not have already."""
    if mode not in METADATA:
        raise ValueError(f"metadataMode: {mode!r} is unknown")
    taken = {f.name.lower() for f in table.fields}
    return T.StructType([ENVELOPE[n] for n in METADATA[mode] if n not in taken])


def registered_schema(topic: str, registry: str) -> T.StructType:
    """The payload schema of a topic from a registry folder: NAME.json holds encoding, type and definition, NAME.avsc the
    definition alone. Only JSON-encoded Avro is readable."""
    base = os.path.join(registry, topic.rsplit("/", 1)[-1])
    if os.path.exists(f"{base}.avsc"):
        with open(f"{base}.avsc", encoding="utf-8") as f:
            return struct_of(f.read())
    if not os.path.exists(f"{base}.json"):
        raise ValueError(f"topic {topic} has no schema")
    with open(f"{base}.json", encoding="utf-8") as f:
        settings = json.load(f)
    if settings.get("encoding", "").upper() != "JSON":
        raise ValueError(f"topic {topic}: encoding {settings.get('encoding')!r} is not supported, only JSON")
    if settings.get("type", "").upper() != "AVRO":
        raise ValueError(f"topic {topic}: schema type {settings.get('type')!r} is not supported, only AVRO")
    return struct_of(settings.get("definition", ""))
