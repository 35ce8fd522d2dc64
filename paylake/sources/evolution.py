"""Which changes of a stored table's columns are safe: added columns that may be NULL, and wider types.

Files of the older kind are read under the newer schema: Parquet gives NULL for a column that a file does not have, and
widens numbers. Everything else is refused before anything is written.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: Number types, each holding all values of those before it.
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONS = (T.FloatType, T.DoubleType)


class SchemaChangeError(ValueError):
    """Rows whose columns do not fit the stored ones."""


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of the old type is one of the new type, and files of it can be read as such."""
    if type(old) is type(new):
        if isinstance(old, T.DecimalType):
            return new.scale == old.scale and new.precision >= old.precision
        if isinstance(old, T.StructType):
            return not problems(old, new)
        if isinstance(old, T.ArrayType):
            return widens(old.elementType, new.elementType)
        if isinstance(old, T.MapType):
            return old.keyType == new.keyType and widens(old.valueType, new.valueType)
        return old == new
    for kinds in (WHOLE, FRACTIONS):
        if isinstance(old, kinds) and isinstance(new, kinds):
            return kinds.index(type(old)) < kinds.index(type(new))
    return isinstance(old, WHOLE[:3]) and isinstance(new, T.DoubleType)


def problems(old: T.StructType, new: T.StructType) -> list[str]:
    """Why rows of the new schema cannot join a table of the old one; empty if they can."""
    found = []
    for field in old.fields:
        if field.name not in new.fieldNames():
            found.append(f"{field.name} is missing")
        elif not widens(field.dataType, new[field.name].dataType):
            found.append(f"{field.name} was {field.dataType.simpleString()} and is {new[field.name].dataType.simpleString()}")
    return found


def check(name: str, old: T.StructType, new: T.StructType) -> None:
    """Raise unless the change is safe."""
    if found := problems(old, new):
        raise SchemaChangeError(f"{name}: {'; '.join(found)}")
