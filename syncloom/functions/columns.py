"""Small Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Destination field types and the Spark types that hold them.
DESTINATION_TYPES = {"text": "string", "number": "double", "boolean": "boolean", "date": "date"}


def quoted(name: str, side: str | None = None) -> Column:
    """The column with exactly this name; dots in it are part of the name, not nesting."""
    name = "`" + name.replace("`", "``") + "`"
    return F.col(f"{side}.{name}" if side else name)


def spark_type(name: str) -> str:
    return DESTINATION_TYPES.get(name, name)


def hashed(column: Column) -> Column:
    """Lower-case hex SHA-256 of the value's text; null stays null."""
    return F.sha2(column.cast("string"), 256)


def fingerprint(fields: Sequence[T.StructField], side: str | None = None) -> Column:
    """128 bits that differ when any of the fields differs (null is distinct from every value), as two longs.

    Two hash chains with different starts; each field goes in with its null flag, because hashing skips nulls. Maps have
    no hash, so they go in as text.
    """
    values: list[Column] = []
    for f in fields:
        value = quoted(f.name, side)
        values += [F.to_json(value) if has_map(f.dataType) else value, value.isNull()]
    return F.struct(F.xxhash64(F.lit(1), *values).alias("a"), F.xxhash64(F.lit(2), *values).alias("b"))


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def changed(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True when any pair differs, comparing null-safely."""
    test = F.lit(False)
    for a, b in pairs:
        test = test | ~a.eqNullSafe(b)
    return test


def nest(df: DataFrame) -> DataFrame:
    """Turn flat columns named ``a.b`` into fields of a struct column ``a``, in order of first appearance."""
    tree: dict = {}
    for name in df.columns:
        node = tree
        *parents, leaf = name.split(".")
        for p in parents:
            node = node.setdefault(p, {})
            if not isinstance(node, dict):
                raise ValueError(f"{name} nests under a field that is a value itself")
        if leaf in node:
            raise ValueError(f"{name} is both a value and a parent")
        node[leaf] = name

    def build(node: dict) -> list[Column]:
        return [
            (F.struct(*build(sub)) if isinstance(sub, dict) else quoted(sub)).alias(name) for name, sub in node.items()
        ]

    return df.select(*build(tree))


def flatten(df: DataFrame) -> DataFrame:
    """The inverse of :func:`nest`: every struct field becomes a column named by its path."""

    def leaves(schema: T.StructType, column, path: str):
        for f in schema.fields:
            here = quoted(f.name) if column is None else column.getField(f.name)
            name = f"{path}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here, name + ".")
            else:
                yield here.alias(name)

    return df.select(*leaves(df.schema, None, ""))
