"""Avro record definitions to Spark schemas. Logical types are not interpreted."""

from __future__ import annotations

import json

from pyspark.sql import types as T

SCALARS = {
    "string": T.StringType(), "enum": T.StringType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(),
    "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(),
}


def read_type(node: object, path: str) -> tuple[T.DataType, bool]:
    """(type, nullable) of any definition."""
    if isinstance(node, list):
        rest = [n for n in node if n != "null"]
        if len(rest) != 1:
            raise ValueError(f"{path}: a union needs exactly one type beside null")
        return read_type(rest[0], path)[0], len(rest) < len(node)
    if isinstance(node, str):
        if node in SCALARS and node != "enum":
            return SCALARS[node], False
        raise ValueError(f"{path}: type {node!r} is not supported")
    if not isinstance(node, dict) or "type" not in node:
        raise ValueError(f"{path}: a type is missing")
    name = node["type"]
    if isinstance(name, (dict, list)):
        return read_type(name, path)
    if name == "record":
        return record(node, path), False
    if name == "array":
        return T.ArrayType(read_type(node.get("items"), f"{path}.items")[0], True), False
    if name == "map":
        return T.MapType(T.StringType(), read_type(node.get("values"), f"{path}.values")[0], True), False
    if name == "enum":
        return SCALARS["enum"], False
    return read_type(name, path)


def record(node: dict, path: str) -> T.StructType:
    fields = node.get("fields")
    if not isinstance(fields, list):
        raise ValueError(f"{path}: a record needs fields")
    out = []
    for f in fields:
        if not isinstance(f, dict) or not f.get("name"):
            raise ValueError(f"{path}: a field needs a name")
        kind, nullable = read_type(f.get("type"), f"{path}.{f['name']}")
        out.append(T.StructField(f["name"], kind, nullable))
    return T.StructType(out)


def struct_of(definition: str) -> T.StructType:
    """The schema of a definition whose root is a record."""
    if not (definition or "").strip():
        raise ValueError("the Avro definition is blank")
    try:
        node = json.loads(definition)
    except json.JSONDecodeError as e:
        raise ValueError(f"the Avro definition is not valid JSON: {e}") from None
    while isinstance(node, dict) and isinstance(node.get("type"), dict):
        node = node["type"]
    if not isinstance(node, dict) or node.get("type") != "record":
        raise ValueError("the root of an Avro definition must be a record")
    return record(node, node.get("name", "record"))
