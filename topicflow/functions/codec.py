"""Payload codecs as column functions: a value or null, and an error code.

Null bytes decode to null, and null values encode to null, without an error; empty bytes are the empty
string, and no integer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Codec = Callable[[Column], Column]

KEY_DECODE, VALUE_DECODE = "KEY_DESERIALIZATION", "VALUE_DESERIALIZATION"
KEY_ENCODE, VALUE_ENCODE = "KEY_SERIALIZATION", "VALUE_SERIALIZATION"


def utf8(b: Column) -> Column:
    """Text; null where the bytes are not valid UTF-8."""
    return F.when(F.is_valid_utf8(b.cast("string")), b.cast("string"))


def int32(b: Column) -> Column:
    """Big-endian; null unless there are four bytes."""
    wide = F.conv(F.hex(b), 16, 10).cast("bigint")
    return F.when(F.octet_length(b) == 4, F.shiftright(F.shiftleft(wide, 32), 32).cast("int"))


def reversed4(b: Column) -> Column:
    """Four bytes the other way round."""
    return F.concat(*[F.substring(b, i, 1) for i in (4, 3, 2, 1)])


def int32_little(b: Column) -> Column:
    """Little-endian; null unless there are four bytes."""
    return F.when(F.octet_length(b) == 4, int32(reversed4(b)))


def nothing(b: Column) -> Column:
    """The absent key: always null, never an error where the bytes are null."""
    return F.lit(None).cast("string")


def encode_int32(n: Column) -> Column:
    """Big-endian bytes of an integer."""
    return F.unhex(F.lpad(F.right(F.hex(n.cast("bigint")), F.lit(8)), 8, "0"))


def encode_int32_little(n: Column) -> Column:
    return reversed4(encode_int32(n))


def decode(records: DataFrame, key: Codec | None = None, value: Codec | None = None) -> DataFrame:
    """Decodes key and value in place of their bytes; raw_key, raw_value and error_code are added.

    error_code is null where all went well; where both fail it is the key's. Null bytes decode to null without an error.
    Columns called raw_key, raw_value and error_code are replaced. Repeated rows are rows like others; an empty table gives none.
    """
    out = records.withColumns({"raw_key": F.col("key"), "raw_value": F.col("value")})
    error = F.lit(None).cast("string")
    for name, codec, code in (("value", value, VALUE_DECODE), ("key", key, KEY_DECODE)):
        if codec is not None:
            made = codec(F.col(f"raw_{name}"))
            out = out.withColumn(name, made)
            failed = F.col(name).isNull() & F.col(f"raw_{name}").isNotNull() & F.lit(codec is not nothing)
            error = F.when(failed, F.lit(code)).otherwise(error)
    return out.withColumn("error_code", error)
