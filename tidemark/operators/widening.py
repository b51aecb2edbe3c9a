"""Appends of rows whose columns have grown: wider types, more columns, more fields in nested ones.

Types meet in the narrowest type that holds all values of both exactly. Whole numbers widen to longer
ones and to decimals, decimals to decimals with room for the digits of both, 32-bit fractions and whole
numbers up to 32 bits to 64-bit fractions, dates to zone-less timestamps. Structs merge field by
field, arrays and maps by their parts. Anything else that differs is a clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DIGITS = (3, 5, 10, 19)
MOST_DIGITS = 38


class TypeClash(ValueError):
    """No type holds the values of both columns exactly."""


def _as_decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(DIGITS[WHOLE.index(type(kind))], 0) if type(kind) in WHOLE else None


def merged_type(a: T.DataType, b: T.DataType, where: str = "column") -> T.DataType:
    """The narrowest type for values of both, ``where`` names the place in the error."""
    if a == b:
        return a
    for one, other in ((a, b), (b, a)):
        if isinstance(one, T.NullType):
            return other
        if isinstance(one, T.DateType) and isinstance(other, T.TimestampNTZType):
            return other
        if isinstance(other, T.DoubleType) and isinstance(one, (T.FloatType, *WHOLE[:3])):
            return other
        if isinstance(other, T.FloatType) and isinstance(one, WHOLE[:2]):
            return other
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schema(a, b, where)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType, f"{where}.element"), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key = merged_type(a.keyType, b.keyType, f"{where}.key")
        return T.MapType(key, merged_type(a.valueType, b.valueType, f"{where}.value"), True)
    if type(a) in WHOLE and type(b) in WHOLE:
        return max(a, b, key=lambda kind: WHOLE.index(type(kind)))
    one, other = _as_decimal(a), _as_decimal(b)
    if one and other:
        scale = max(one.scale, other.scale)
        digits = max(one.precision - one.scale, other.precision - other.scale) + scale
        if digits <= MOST_DIGITS:
            return T.DecimalType(digits, scale)
    raise TypeClash(f"{where}: {a.simpleString()} and {b.simpleString()}")


def merged_schema(old: T.StructType, new: T.StructType, where: str = "") -> T.StructType:
    """Fields of both by name in any letter case: those of ``old``, then those only ``new`` has. All may be NULL."""
    theirs = {field.name.lower(): field for field in new}
    fields = []
    for field in old:
        other = theirs.pop(field.name.lower(), None)
        place = f"{where}.{field.name}".lstrip(".")
        kind = merged_type(field.dataType, other.dataType, place) if other else field.dataType
        fields.append(T.StructField(field.name, kind, True))
    return T.StructType([*fields, *(T.StructField(field.name, field.dataType, True) for field in theirs.values())])


def widened(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of a type as one of a wider type; NULL parts stay NULL."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        there = {field.name.lower(): field for field in have}
        parts = []
        for field in want:
            own = there.get(field.name.lower())
            part = widened(value.getField(own.name), own.dataType, field.dataType) if own else F.lit(None).cast(field.dataType)
            parts.append(part.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda item: widened(item, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        keys = F.transform_keys(value, lambda k, _: widened(k, have.keyType, want.keyType))
        return F.transform_values(keys, lambda _, v: widened(v, have.valueType, want.valueType))
    return value.cast(want)


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``, which must be wide enough; missing columns are NULL."""
    there = {field.name.lower(): field for field in df.schema}
    columns = []
    for field in schema:
        own = there.get(field.name.lower())
        value = widened(F.col(f"`{own.name}`"), own.dataType, field.dataType) if own else F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def widening_append(old: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both under the merged schema. Raises ``TypeClash`` where two types have no common one."""
    schema = merged_schema(old.schema, new.schema)
    return fitted(old, schema).union(fitted(new, schema))
