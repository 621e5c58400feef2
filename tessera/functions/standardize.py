"""Silver standardization scalars: trimming, code remaps, phone and
country-code normalization, tolerant casts, prefix stripping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Category code anomalies and their canonical codes.
CATEGORY_CODE_FIXES = {"GROCERY": "GRCY", "BOOKS": "BKS", "TOYS": "TOY"}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column."""
    return df.withColumns({f.name: F.trim(F.col(f.name)) for f in df.schema.fields
                           if isinstance(f.dataType, T.StringType)})


def remap(col, mapping: dict[str, str]) -> Column:
    """Replace values found in ``mapping``; others pass through.  The map is
    a literal inside the expression (no join)."""
    m = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])
    return F.coalesce(F.element_at(m, _c(col)), _c(col))


def remap_code_suffix(col, mapping: dict[str, str] = CATEGORY_CODE_FIXES) -> Column:
    """Remap the part after the last '-' of a code (e.g. CAT-GROCERY -> CAT-GRCY)."""
    c = _c(col)
    suffix = F.regexp_extract(c, "([^-]*)$", 1)
    prefix = F.regexp_extract(c, "^(.*-)?[^-]*$", 1)
    return F.when(c.isNull(), c).otherwise(F.concat(prefix, remap(suffix, mapping)))


def normalize_phone(col) -> Column:
    """Keep digits and '+' only; NULL when nothing is left."""
    cleaned = F.regexp_replace(_c(col), "[^0-9+]", "")
    return F.when(F.length(cleaned) > 0, cleaned)


def normalize_country_code(col) -> Column:
    return F.upper(F.trim(_c(col)))


def strip_prefix(col, prefix: str = "brz_") -> Column:
    return F.regexp_replace(_c(col), "^" + prefix, "")


def tolerant_cast(col, type_name: str) -> Column:
    """Cast that yields NULL instead of failing (failures go to quarantine)."""
    return F.expr(f"try_cast({col} AS {type_name})") if isinstance(col, str) else col.try_cast(type_name)


def decimal_comma(col, type_name: str = "decimal(12,2)") -> Column:
    """'1.234,56' style number text -> DECIMAL (thousands dots dropped)."""
    txt = F.regexp_replace(F.regexp_replace(_c(col), r"\.", ""), ",", ".")
    return txt.try_cast(type_name)


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null -> 0 per column, cast-aware: ``fillna`` on a string column would
    write the text '0'; here numeric columns get a numeric zero."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols})
