"""Messages as DataFrames: the envelope, the views of the schema modes, and payload columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decode import payload_fields
from ..sources.schema import METADATA, envelope_name, metadata_schema, table_schema


def envelope(df: DataFrame, messageid, body, publishtime, orderingkey=None, attributes=None) -> DataFrame:  # noqa: ANN001
    """Any rows as messages: nulls become empty, times are cut to milliseconds, ackid is the message id."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    empty = F.lit("")
    key = text(orderingkey) if orderingkey is not None else empty
    marks = F.transform_values(attributes, lambda _, v: F.coalesce(v, empty)) if attributes is not None else F.create_map().cast("map<string,string>")
    return df.select(
        F.coalesce(body.cast("binary"), F.encode(empty, "UTF-8")).alias("body"), text(messageid).alias("messageid"),
        F.date_trunc("MILLISECOND", publishtime).cast("timestamp").alias("publishtime"), key.alias("orderingkey"),
        text(messageid).alias("ackid"), F.coalesce(marks, F.create_map().cast("map<string,string>")).alias("attributes"),
    )


def of_schema(messages: DataFrame, schema: T.StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """Messages as rows of a schema: envelope names come from the envelope, all others are decoded from the payload,
    which is parsed once and only if a payload field is asked for. ``extra`` keeps further envelope columns."""
    wanted = [(f.name, f.dataType, envelope_name(f.name)) for f in schema.fields]
    payload = [(name, kind) for name, kind, known in wanted if known is None]
    rows, found = payload_fields(messages, payload) if payload else (messages, [])
    values = iter(found)
    columns = [(F.col(known) if known else next(values)).alias(name) for name, _, known in wanted]
    return rows.select(*columns, *extra)


def table_view(messages: DataFrame, mode: str, payload: T.StructType | None = None) -> DataFrame:
    return of_schema(messages, table_schema(mode, payload))


def metadata_view(messages: DataFrame, mode: str, metadata: str, payload: T.StructType | None = None) -> DataFrame:
    """The table with its metadata columns, which a Python source cannot hide."""
    table = table_schema(mode, payload)
    return of_schema(messages, table, tuple(metadata_schema(metadata, table).names))


def without_metadata(view: DataFrame, table: T.StructType) -> DataFrame:
    """What SELECT * shows: a metadata view's table columns."""
    assert set(METADATA["full"]) >= {c for c in view.columns if c not in table.names}
    return view.select(table.names)
