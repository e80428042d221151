"""Schemas that grow, at any depth: one type for two, and columns brought to it.

Structs are merged field by field, by name in any case of letters, arrays by their elements, maps by
their values; plain types give the wider one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = dict(zip([type(t) for t in _WHOLE], (3, 5, 10, 20), strict=True))


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The plain type that holds all values of both, if one of the usual widenings gives it."""
    if a == b:
        return a
    for one, other in ((a, b), (b, a)):
        if one in _WHOLE:
            if other in _WHOLE:
                return max(a, b, key=_WHOLE.index)
            if isinstance(other, T.DoubleType) and one != T.LongType():
                return other
            if isinstance(other, T.DecimalType) and other.precision - other.scale >= _DIGITS[type(one)]:
                return other
        if isinstance(one, T.FloatType) and isinstance(other, T.DoubleType):
            return other
        if isinstance(one, T.DateType) and isinstance(other, T.TimestampNTZType):
            return other
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else None
    return None


def merged_type(a: T.DataType, b: T.DataType, path: str = "") -> T.DataType:
    """One type for both; fields keep the order of ``a``, new ones of ``b`` follow, nullable."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        new = {f.name.lower(): f for f in b.fields}
        fields = []
        for f in a.fields:
            other = new.pop(f.name.lower(), None)
            kind = f.dataType if other is None else merged_type(f.dataType, other.dataType, f"{path}.{f.name}")
            fields.append(T.StructField(f.name, kind, True))
        return T.StructType([*fields, *[T.StructField(f.name, f.dataType, True) for f in new.values()]])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType, f"{path}.element"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        if a.keyType != b.keyType:
            raise ValueError(f"the keys of the map {path.strip('.')} differ")
        return T.MapType(a.keyType, merged_type(a.valueType, b.valueType, f"{path}.value"))
    found = wider(a, b)
    if found is None:
        raise ValueError(f"column {path.strip('.')} is {a.simpleString()} and {b.simpleString()}")
    return found


def conform(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` of type ``have`` as ``want``, a type merged from it; fields it lacks are null."""
    if have == want:
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        there = {f.name.lower(): f for f in have.fields}
        fields = []
        for f in want.fields:
            own = there.get(f.name.lower())
            if own is None:
                value = F.lit(None).cast(f.dataType)
            else:
                value = conform(column.getField(own.name), own.dataType, f.dataType)
            fields.append(value.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.transform_values(column, lambda _, v: conform(v, have.valueType, want.valueType))
    return column.cast(want)


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, a schema merged from that of ``df``, in its order."""
    there = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        own = there.get(f.name.lower())
        value = F.lit(None).cast(f.dataType) if own is None else conform(F.col(f"`{own.name}`"), own.dataType, f.dataType)
        columns.append(value.alias(f.name))
    return df.select(*columns)
