"""Column expressions over the INFO column of a VCF line.

Each field is searched for in the text on its own. Fields that a query does not use cost
nothing, since Catalyst drops them. The first ``KEY=VALUE`` item of a repeated key counts,
an absent one is null; keys are matched in their exact case. A flag is set by the bare key,
with or without a value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# INFO header Type -> Spark type (VCF specification).
INFO_TYPES = {
    "Integer": T.LongType(),
    "Float": T.DoubleType(),
    "Flag": T.BooleanType(),
    "String": T.StringType(),
    "Character": T.StringType(),
}


def fenced(info: Column) -> Column:
    """INFO with a separator at both ends, so that every item looks like ``;item;``."""
    return F.concat(F.lit(";"), info, F.lit(";"))


def value_text(fenced_info: Column, key: str) -> Column:
    """Value of the first ``KEY=VALUE`` item."""
    opening = f";{key}="
    # Null where the key is absent, which makes the whole expression null.
    at = F.nullif(F.locate(opening, fenced_info), F.lit(0))
    rest = F.substring(fenced_info, at + F.lit(len(opening)), F.lit(2**31 - 1))
    return F.substring_index(rest, ";", 1)


def flag_set(fenced_info: Column, key: str) -> Column:
    """Whether the key occurs, bare or with a value."""
    bare, valued = F.lit(f";{key};"), F.lit(f";{key}=")
    return F.contains(fenced_info, bare) | F.contains(fenced_info, valued)


def stored_type(type_name: str, number: str) -> T.DataType:
    """Spark type that :func:`typed_value` gives a field."""
    target = INFO_TYPES.get(type_name, T.StringType())
    return target if number in ("0", "1") else T.ArrayType(target)


def typed_value(text: Column, type_name: str, number: str) -> Column:
    """Give a value its declared type; ``.`` and unreadable values become null."""
    target = INFO_TYPES.get(type_name, T.StringType())
    if number not in ("0", "1"):
        parts = F.split(F.nullif(text, F.lit(".")), ",")
        if isinstance(target, T.StringType):
            return F.transform(parts, lambda x: F.nullif(x, F.lit(".")))
        return parts.try_cast(T.ArrayType(target))
    value = F.nullif(text, F.lit("."))
    return value if isinstance(target, T.StringType) else value.try_cast(target)
