"""JSON payloads to typed columns, as JVM-side expressions.

A payload field is looked up by its exact name and else by the first name that is equal in lower case, at
every level. A missing or JSON null field is NULL. A value that does not fit its type is coerced rather than
refused: 0, 0.0, false, an empty map, or a one-element array; only timestamps and malformed payloads fail.
Everything is built from variant and JSON functions, so unused fields cost nothing and no Python runs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers of at least this size are epoch milliseconds, smaller ones seconds.
MILLIS_FROM = 1_000_000_000_000
INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|z|[+-]\d{2}:\d{2})$"
#: Names that a path may hold as they are.
PLAIN_NAME = re.compile(r"[A-Za-z0-9_ .-]+$")
SUPPORTED = (T.StringType, T.BinaryType, T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.TimestampType, T.DecimalType, T.StructType, T.ArrayType, T.MapType)


def check(kind: T.DataType) -> None:
    """Refuse at plan time what payloads cannot hold."""
    if not isinstance(kind, SUPPORTED):
        raise ValueError(f"payload fields cannot be {kind.simpleString()}")
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            check(field.dataType)
    elif isinstance(kind, T.ArrayType):
        check(kind.elementType)
    elif isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError("map keys of a payload are strings")
        check(kind.valueType)


def payload_text(body: Column) -> Column:
    return F.decode(body, "UTF-8")


def payload_variant(text: Column) -> Column:
    """The parsed payload; null if there is none; malformed JSON fails the query."""
    return F.when(F.length(F.trim(text)) > 0, F.parse_json(text))


class Node:
    """A JSON value: the variant, its JSON text where that is at hand, and its kind."""

    def __init__(self, variant: Column, text: Column | None = None, kind: Column | None = None):
        self.variant, self.text = variant, text
        self.kind = F.schema_of_variant(variant) if kind is None else kind

    def field(self, name: str, text: bool = True) -> Node:
        """A field by its exact name, which one look into the variant finds; only where that is missing are the names searched
        for one that is equal in lower case. ``text`` says whether its text is wanted, which is parsed for once more."""
        entries = F.when(F.schema_of_variant(self.variant).startswith("OBJECT"), F.try_variant_get(self.variant, "$", "map<string,variant>"))
        keys = F.json_object_keys(self.text) if self.text is not None else F.map_keys(entries)
        alike = F.try_element_at(F.filter(keys, lambda k: F.lower(k) == name.lower()), F.lit(1))
        path = f"$['{name}']"
        exact = F.try_variant_get(self.variant, path, "variant") if PLAIN_NAME.match(name) else F.try_element_at(entries, F.lit(name))
        found = F.coalesce(exact, F.try_element_at(entries, alike))
        if self.text is None or not text:
            return Node(found)
        key = F.when(exact.isNotNull(), F.lit(name)).otherwise(alike)
        return Node(found, F.call_function("get_json_object", self.text, F.concat(F.lit("$['"), key, F.lit("']"))))

    def missing(self) -> Column:
        return self.kind.isNull() | (self.kind == "VOID")

    def as_text(self) -> Column:
        return self.text if self.text is not None else self.variant.cast("string")


def needs_text(kind: T.DataType) -> bool:
    """Whether a type shows how its value was written."""
    return isinstance(kind, (T.StringType, T.BinaryType, T.DecimalType, T.StructType))


def numeric(kind: Column) -> Column:
    return kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")


def narrowed(value: Column, bits: int) -> Column:
    """The low bits of a whole number as a signed one."""
    return value if bits == 64 else F.shiftright(F.shiftleft(value, 64 - bits), 64 - bits)


def whole(node: Node, bits: int) -> Column:
    """Integers: fractions are cut towards zero, whole numbers out of range wrap, fractions out of range stop at its ends."""
    low, high, name = -(1 << (bits - 1)), (1 << (bits - 1)) - 1, "int" if bits == 32 else "bigint"
    real = F.try_variant_get(node.variant, "$", "double")
    cut = F.when(F.isnan(real), 0).otherwise(F.when(real >= float(high), F.lit(high)).when(real <= float(low), F.lit(low)).otherwise(real.try_cast("bigint")))
    number = F.when(node.kind == "BIGINT", narrowed(F.try_variant_get(node.variant, "$", "bigint"), bits).cast(name)).otherwise(cut.cast("bigint").try_cast(name))
    text = F.trim(node.as_text())
    digits = text.rlike(r"^[+-]?\d+$")
    parsed = F.when(digits, text.try_cast(name)).otherwise(text.try_cast("double").try_cast("bigint").try_cast(name))
    flag = F.try_variant_get(node.variant, "$", "boolean").cast(name)
    return F.when(numeric(node.kind), number).when(node.kind == "STRING", F.coalesce(parsed, F.lit(0))).when(node.kind == "BOOLEAN", flag).otherwise(F.lit(0)).cast(name)


def real(node: Node, name: str) -> Column:
    parsed = F.trim(node.as_text()).try_cast("double")
    flag = F.try_variant_get(node.variant, "$", "boolean").cast("int").cast("double")
    value = F.when(numeric(node.kind), F.try_variant_get(node.variant, "$", "double")).when(node.kind == "STRING", F.coalesce(parsed, F.lit(0.0))).when(node.kind == "BOOLEAN", flag).otherwise(F.lit(0.0))
    return value.cast(name)


def instant(node: Node) -> Column:
    number = F.try_variant_get(node.variant, "$", "double").cast("bigint")
    at = F.when(number >= MILLIS_FROM, F.timestamp_millis(number)).otherwise(F.timestamp_seconds(number))
    text = node.as_text()
    dated = F.when(text.rlike(INSTANT), text.try_cast("timestamp"))
    refused = F.raise_error(F.concat(F.lit("not an instant: "), F.coalesce(text, F.lit("")))).cast("timestamp")
    return F.when(numeric(node.kind), at).when(dated.isNotNull(), dated).otherwise(refused)


def decoded(node: Node, kind: T.DataType) -> Column:
    """The value of a node as a column of this type."""
    check(kind)
    container = node.kind.startswith("OBJECT") | node.kind.startswith("ARRAY")
    if isinstance(kind, T.StringType):
        value = node.as_text()
    elif isinstance(kind, T.BinaryType):
        value = F.when(container, F.encode(F.lit(""), "UTF-8")).otherwise(F.encode(node.as_text(), "UTF-8"))
    elif isinstance(kind, T.BooleanType):
        number = F.try_variant_get(node.variant, "$", "double") != 0
        value = F.when(node.kind == "BOOLEAN", F.try_variant_get(node.variant, "$", "boolean")).when(numeric(node.kind), number)
        value = value.when(node.kind == "STRING", F.trim(node.as_text()) == "true").otherwise(F.lit(False))
    elif isinstance(kind, T.IntegerType):
        value = whole(node, 32)
    elif isinstance(kind, T.LongType):
        value = whole(node, 64)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value = real(node, kind.simpleString())
    elif isinstance(kind, T.TimestampType):
        value = instant(node)
    elif isinstance(kind, T.DecimalType):
        value = F.when(numeric(node.kind), node.as_text().try_cast(kind)).otherwise(F.lit(0).cast(kind))
    elif isinstance(kind, T.StructType):
        value = F.struct(*(decoded(node.field(f.name), f.dataType).alias(f.name) for f in kind.fields))
    elif isinstance(kind, T.ArrayType):
        many = F.transform(F.try_variant_get(node.variant, "$", "array<variant>"), lambda x: decoded(Node(x), kind.elementType))
        value = F.when(node.kind.startswith("ARRAY"), many).otherwise(F.array(decoded(node, kind.elementType)))
    else:
        entries = F.transform_values(F.try_variant_get(node.variant, "$", "map<string,variant>"), lambda _, x: decoded(Node(x), kind.valueType))
        empty = F.from_json(F.lit("{}"), kind)
        value = F.when(node.kind.startswith("OBJECT"), entries).otherwise(empty)
    return F.when(~node.missing(), value)


def payload_field(body: Column, name: str, kind: T.DataType) -> Column:
    """One top-level field of a payload."""
    text = payload_text(body)
    return decoded(Node(payload_variant(text), text).field(name, needs_text(kind)), kind)


def payload_fields(df: DataFrame, fields: list[tuple[str, T.DataType]], body: str = "body") -> tuple[DataFrame, list[Column]]:
    """df with helper columns, and on it one column for each field. The payload is parsed once a row, and each field's value
    and kind, and those of the fields of records in it, are columns of their own below those that use them, so they are
    found once however often they are used."""
    rows = df.withColumn("_text", payload_text(F.col(body))).withColumn("_payload", payload_variant(F.col("_text")))
    root = Node(F.col("_payload"), F.col("_text"))
    level = [((k,), root, name, kind) for k, (name, kind) in enumerate(fields)]
    nodes: dict[tuple[int, ...], Node] = {}
    while level:
        found = {"_".join(map(str, path)): of.field(name, needs_text(kind)) for path, of, name, kind in level}
        rows = rows.withColumns({f"_value{k}": n.variant for k, n in found.items()} | {f"_text{k}": n.text for k, n in found.items() if n.text is not None})
        rows = rows.withColumns({f"_kind{k}": F.schema_of_variant(f"_value{k}") for k in found})
        for (path, _, _, _), (k, n) in zip(level, found.items(), strict=True):
            nodes[path] = Node(F.col(f"_value{k}"), None if n.text is None else F.col(f"_text{k}"), F.col(f"_kind{k}"))
        level = [((*path, k), nodes[path], f.name, f.dataType) for path, _, _, kind in level if isinstance(kind, T.StructType) for k, f in enumerate(kind.fields)]

    def value(path: tuple[int, ...], kind: T.DataType) -> Column:
        if not isinstance(kind, T.StructType):
            return decoded(nodes[path], kind)
        check(kind)
        return F.when(~nodes[path].missing(), F.struct(*(value((*path, k), f.dataType).alias(f.name) for k, f in enumerate(kind.fields))))

    return rows, [value((k,), kind) for k, (_, kind) in enumerate(fields)]
