"""Wire formats of change records: JSON values, change envelopes, decimals
as base64 of the unscaled two's-complement bytes, dates as epoch days.

All built-in expressions; no Python per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def encode_row(cols: list[str] | None = None) -> Column:
    """Row (or selected columns) as compact JSON text."""
    return F.to_json(F.struct(*(cols or ["*"])))


def parse_value(value_col, schema: T.StructType | str) -> Column:
    """Binary/string message value -> struct by a fixed schema; malformed
    JSON gives NULL fields rather than failing the job."""
    return F.from_json(_c(value_col).cast("string"), schema, {"mode": "PERMISSIVE"})


def envelope_value(columns: list[str], op: Column | str = "c", ts_col: str | None = None) -> Column:
    """The change envelope {before, after, op, ts_ms} of a row, as JSON text;
    op 'd' rows carry the row as ``before`` and a null ``after``."""
    op_c = F.lit(op) if isinstance(op, str) else op
    row = F.struct(*[F.col(c) for c in columns])
    return F.to_json(F.struct(
        F.when(op_c == "d", row).alias("before"),
        F.when(op_c != "d", row).alias("after"),
        op_c.alias("op"),
        (F.col(ts_col) if ts_col else F.lit(None).cast("bigint")).alias("ts_ms"),
    ))


def envelope(df: DataFrame, op: Column | str = "c", ts_col: str | None = None) -> DataFrame:
    """Wrap rows as change envelopes in ``value``."""
    return df.select(envelope_value(df.columns, op, ts_col).alias("value"))


def _envelope_schema(row_schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("before", row_schema), T.StructField("after", row_schema),
        T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])


def unwrap(df: DataFrame, value_col: str, row_schema: T.StructType) -> DataFrame:
    """After-images of change envelopes; for deletes ('d') the before-image
    marked with ``__deleted``=true (the tombstone).

    The JSON is parsed once, into a column produced by a generator (a
    one-element ``explode``).  As a plain projection, the parse would be
    inlined into every expression that uses it: into each CASE branch, and
    into any later filter on ``__deleted``, which the optimizer then pushes
    down to the scan (below a repartition), parsing every message twice."""
    env = F.from_json(F.col(value_col).cast("string"), _envelope_schema(row_schema))
    parsed = df.select(F.explode(F.array(env)).alias("_env"))
    deleted = F.col("_env.op") == "d"
    fields = [F.when(deleted, F.col(f"_env.before.{f.name}")).otherwise(F.col(f"_env.after.{f.name}")).alias(f.name)
              for f in row_schema.fields]
    return parsed.select(*fields, deleted.alias("__deleted"), F.col("_env.op").alias("__op"))


def decimal_to_wire(col, scale: int) -> Column:
    """DECIMAL -> base64 of the minimal big-endian two's-complement bytes of
    its unscaled value (the JSON converter's default decimal encoding).
    Unscaled values must fit in 64 bits (enough for DECIMAL(18, s))."""
    # a decimal literal of the scale's own precision keeps the product exact
    unscaled = (_c(col) * F.lit(Decimal(10) ** scale)).cast("decimal(38,0)").cast("bigint")
    h = F.hex(unscaled)
    h = F.when(F.length(h) % 2 == 1, F.concat(F.lit("0"), h)).otherwise(h)
    # positive: add a 00 byte when the top bit is set; negative: drop
    # redundant leading FF bytes (hex() of a negative long has 16 digits)
    pos = F.when(F.substring(h, 1, 1).isin(*"89ABCDEF"), F.concat(F.lit("00"), h)).otherwise(h)
    neg = F.regexp_replace(h, "^(FF)+(?=[89A-F])", "")
    return F.base64(F.unhex(F.when(unscaled >= 0, pos).otherwise(neg)))


def wire_to_decimal(col, precision: int, scale: int, max_bytes: int = 8) -> Column:
    """base64 unscaled two's-complement bytes -> DECIMAL(precision, scale).

    Exact integer arithmetic: a negative value is minus one minus the number
    that its inverted bytes spell.  A value of more than ``max_bytes`` (at
    most 16) or that DECIMAL(precision, scale) can't hold, or text that isn't
    base64, gives NULL; ``quality.validation.keep_lost`` keeps its text for
    quarantine."""
    h = F.hex(F.try_to_binary(_c(col), F.lit("base64")))
    negative = F.substring(h, 1, 1).isin(*"89ABCDEF")
    spelled = F.when(negative, F.translate(h, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(h)
    number = lambda digits: F.conv(digits, 16, 10).cast("decimal(20,0)")
    signed = F.when(negative, F.lit(-1) - number(spelled)).otherwise(number(spelled)).cast("decimal(19,0)")
    value = signed * F.lit(Decimal(1).scaleb(-scale)) if scale else signed
    short = F.when(h != "", value).try_cast(f"decimal({precision},{scale})")
    if max_bytes <= 8:
        return F.when(F.length(h) <= 2 * max_bytes, short)
    long = F.when(F.length(h) <= 2 * min(max_bytes, 16), _long_decimal(spelled, negative, precision, scale))
    return F.when(F.length(h) <= 16, short).otherwise(long)


def _long_decimal(spelled: Column, negative: Column, precision: int, scale: int) -> Column:
    """Hex digits of 9 to 16 bytes, in two halves.  The point is set in
    the number's text, since products of such decimals lose digits."""
    plain = F.regexp_replace(spelled, "^0+(?=.)", "")
    half = lambda digits: F.conv(digits, 16, 10).cast("decimal(20,0)")
    high = F.coalesce(half(F.left(plain, F.greatest(F.length(plain) - 16, F.lit(0)))), F.lit(0).cast("decimal(20,0)"))
    size = F.try_add(F.try_multiply(high, F.lit(Decimal(1 << 64))), half(F.right(plain, F.lit(16))))
    digits = F.try_add(size, F.when(negative, 1).otherwise(0).cast("decimal(1,0)")).cast("string")
    digits = F.when(F.length(digits) > scale, digits).otherwise(F.lpad(digits, scale + 1, "0"))
    text = F.concat(F.when(negative, "-").otherwise(""), F.left(digits, F.length(digits) - scale), F.lit("."), F.right(digits, F.lit(scale)))
    return text.try_cast(f"decimal({precision},{scale})")


def days_to_date(col) -> Column:
    """Days since 1970-01-01 -> DATE."""
    return F.date_from_unix_date(_c(col).cast("int"))


def date_to_days(col) -> Column:
    return F.unix_date(F.to_date(_c(col)))
