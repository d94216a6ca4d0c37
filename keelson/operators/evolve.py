"""Schema evolution: columns come, and their types widen without loss.

Types form a lattice: whole numbers by size, then decimals that hold them; ``float`` below
``double``, which also holds whole numbers up to 32 bits; ``date`` below ``timestamp_ntz``;
decimals by the digits on both sides of the point; and ``string`` above everything, where no
narrower type holds both without loss. Structs widen field by field, arrays and maps inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole numbers from narrow to wide, with the digits of the decimal that takes each (parquet
#: keeps the first three as 32 bits, which its reader takes as ten digits or more).
_WHOLE = ((T.ByteType, 10), (T.ShortType, 10), (T.IntegerType, 10), (T.LongType, 20))
_DIGITS = dict(_WHOLE)
_SIZE = {kind: i for i, (kind, _) in enumerate(_WHOLE)}


def _decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    digits = _DIGITS.get(type(kind))
    return T.DecimalType(digits, 0) if digits else None


def widest(first: T.DataType, second: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both."""
    if first == second or isinstance(second, T.NullType):
        return first
    if isinstance(first, T.NullType):
        return second
    if isinstance(first, T.StructType) and isinstance(second, T.StructType):
        return merged_schema(first, second)
    if isinstance(first, T.ArrayType) and isinstance(second, T.ArrayType):
        return T.ArrayType(widest(first.elementType, second.elementType))
    if isinstance(first, T.MapType) and isinstance(second, T.MapType):
        return T.MapType(widest(first.keyType, second.keyType), widest(first.valueType, second.valueType))
    kinds = {type(first), type(second)}
    if kinds <= set(_SIZE):
        return max(first, second, key=lambda kind: _SIZE[type(kind)])
    if kinds <= {T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    a, b = _decimal(first), _decimal(second)
    if a and b:
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        if precision <= 38:
            return T.DecimalType(precision, scale)
    return T.StringType()


def merged_schema(first: T.StructType, second: T.StructType) -> T.StructType:
    """Columns of ``first``, then the columns only ``second`` has, each as wide as either needs."""
    other = {f.name: f for f in second.fields}
    fields = [
        f if f.name not in other else T.StructField(f.name, widest(f.dataType, other[f.name].dataType))
        for f in first.fields
    ]
    known = set(first.fieldNames())
    return T.StructType(fields + [f for f in second.fields if f.name not in known])


def plain(kind: T.DataType) -> T.DataType:
    """The type with everything nullable and without metadata, to compare types by."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(plain(kind.keyType), plain(kind.valueType))
    return kind


def _fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as the wider type; fields a struct lacks are NULL."""
    if plain(have) == plain(want):
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = {f.name: f.dataType for f in have.fields}
        whole = F.struct(
            *(
                (_fitted(value[f.name], fields[f.name], f.dataType) if f.name in fields else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in want.fields
            )
        )
        return F.when(value.isNotNull(), whole)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _fitted(x, have.elementType, want.elementType))
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)) and isinstance(want, T.StringType):
        return F.to_json(value)
    return value.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order; missing ones are typed NULLs."""
    present = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *(
            (_fitted(F.col(f"`{f.name}`"), present[f.name], f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        )
    )


def union_evolving(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union all by name; a column only one side has is NULL on the other, and one whose types
    differ takes the narrowest type that holds both."""
    schema = merged_schema(first.schema, second.schema)
    return conform(first, schema).unionByName(conform(second, schema))


#: Widenings Spark's parquet reader does itself while it reads files of the narrower type.
_READABLE = {
    T.LongType: (T.ByteType, T.ShortType, T.IntegerType),
    T.IntegerType: (T.ByteType, T.ShortType),
    T.ShortType: (T.ByteType,),
    T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType),
    T.TimestampNTZType: (T.DateType,),
}


def readable_as(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether files written with type ``stored`` can be read as ``wanted`` without rewriting."""
    if plain(stored) == plain(wanted):
        return True
    if isinstance(stored, T.StructType) and isinstance(wanted, T.StructType):
        to = {f.name: f.dataType for f in wanted.fields}
        return all(f.name in to and readable_as(f.dataType, to[f.name]) for f in stored.fields)
    if isinstance(wanted, T.DecimalType):
        held = _decimal(stored)
        return held is not None and held.scale <= wanted.scale and held.precision - held.scale <= wanted.precision - wanted.scale
    return isinstance(stored, _READABLE.get(type(wanted), ()))
