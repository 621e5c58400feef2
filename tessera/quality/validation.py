"""Contract validation: schema comparison, row rules, quarantine split.

Row rules produce ``_dq_failed_rules`` (sorted array of rule names):
``not_null:<col>``, ``cast:<col>``, ``duplicate_key``, ``fk:<col>`` and the
contract's domain rules.  ``quarantine_split`` routes rows with any failure to the
quarantine frame, so passed + quarantined = input, with nothing dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.quality.contracts import Contract
from tessera.session import broadcast_limit, estimated_size, guarded_broadcast, measured

FAILED = "_dq_failed_rules"
UNCASTABLE = "_dq_uncastable"

VIOLATION_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("violation", T.StringType()),
    T.StructField("expected_type", T.StringType()),
    T.StructField("actual_type", T.StringType()),
])


def schema_violations_list(contract: Contract, schema: T.StructType) -> list[tuple]:
    """Missing, extra and type-divergent columns of ``schema`` against the
    contract (plain metadata, compared on the driver)."""
    expected = {c.name: c.type for c in contract.columns}
    actual = {f.name: f.dataType.simpleString() for f in schema.fields if not f.name.startswith("_")}
    rows = []
    for name in sorted(expected.keys() | actual.keys()):
        e, a = expected.get(name), actual.get(name)
        if a is None:
            rows.append((contract.table, name, "missing", e, None))
        elif e is None:
            rows.append((contract.table, name, "extra", None, a))
        elif e != a:
            rows.append((contract.table, name, "type_mismatch", e, a))
    return rows


def schema_violations(spark: SparkSession, contract: Contract, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(schema_violations_list(contract, schema), VIOLATION_SCHEMA)


def landed_columns(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(column_name, found_type, rows) of the fields of landed JSON lines, one
    row per field, from the lines themselves: ``rows`` counts the lines that
    give it a value, ``found_type`` is the JSON type over all of them."""
    objects = lines.select(F.try_parse_json(value_col).alias("_v")).where("_v is not null")
    fields = objects.lateralJoin(lines.sparkSession.tvf.variant_explode(F.col("_v").outer())).select("key", "value")
    return (fields.where("key is not null").groupBy(F.col("key").alias("column_name"))
            .agg(F.lower(F.schema_of_variant_agg("value")).alias("found_type"),
                 F.count_if(~F.is_variant_null("value")).alias("rows")))


# Contract types by what JSON can say of them: a date or time lands as text.
_LANDS_AS = [("^(tinyint|smallint|int|bigint)$", "^(bigint|void)$"), ("^(decimal.*|double|float)$", "^(bigint|decimal.*|double|float|void)$"),
             ("^boolean$", "^(boolean|void)$"), ("^(string|date|timestamp.*)$", "^(string|void)$")]


def landed_violations(lines: DataFrame, contract: Contract, value_col: str = "value") -> DataFrame:
    """(table_name, column_name, violation, expected_type, found_type, rows)
    of landed lines against the contract: ``missing`` and ``extra`` columns,
    ``type_mismatch``, and ``incomplete`` (a required column that some lines
    don't give; ``rows`` counts those that do)."""
    spark = lines.sparkSession
    declared = spark.createDataFrame([(c.name, c.type, not c.nullable) for c in contract.columns],
                                     "column_name string, expected_type string, required boolean")
    total = lines.agg(F.count_if(F.try_parse_json(value_col).isNotNull()).alias("total")).scalar()
    fits = F.lit(False)
    for expected, found in _LANDS_AS:
        fits = fits | (F.col("expected_type").rlike(expected) & F.col("found_type").rlike(found))
    violation = (F.when(F.coalesce("rows", F.lit(0)) == 0, F.when(F.col("expected_type").isNotNull(), "missing"))
                 .when(F.col("expected_type").isNull(), "extra").when(~fits, "type_mismatch")
                 .when(F.col("required") & (F.col("rows") < total), "incomplete"))
    both = declared.join(landed_columns(lines, value_col), "column_name", "full_outer")
    return both.select(F.lit(contract.table).alias("table_name"), "column_name", violation.alias("violation"), "expected_type",
                       "found_type", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")).where("violation is not null")


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast every contract column with ``try_cast``; missing columns become
    typed NULLs, extra columns are kept.  Where a column needs a cast, values
    that fail it are kept as text in ``_dq_uncastable`` (column, raw), which
    ``flag_rules`` turns into ``cast:<col>`` failures: nothing becomes NULL
    unseen."""
    cols, failures = [], []
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for c in contract.columns:
        if c.name in present:
            cast = F.expr(f"try_cast(`{c.name}` AS {c.type})")
            cols.append(cast.alias(c.name))
            if present[c.name] != c.type:
                failures.append(F.when(F.col(c.name).isNotNull() & cast.isNull(), F.struct(
                    F.lit(c.name).alias("column"), F.col(c.name).cast("string").alias("raw"))))
        else:
            cols.append(F.lit(None).cast(c.type).alias(c.name))
    extra = [F.col(n) for n in df.columns if n not in {c.name for c in contract.columns}]
    if failures:
        extra.append(F.filter(F.array(*failures), lambda x: x.isNotNull()).alias(UNCASTABLE))
    return df.select(*cols, *extra)


def keep_lost(df: DataFrame, parsed: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add or replace columns (name -> (column of raw text, parsed value)),
    and keep the raw text of each value that parsing lost in
    ``_dq_uncastable``, as ``conform`` does: ``flag_rules`` makes it a
    ``cast:<col>`` failure, so the row goes to quarantine.  Blank text is no
    value."""
    lost = [F.when((F.trim(raw) != "") & value.isNull(), F.struct(F.lit(name).alias("column"), F.col(raw).cast("string").alias("raw")))
            for name, (raw, value) in parsed.items()]
    found = F.filter(F.array(*lost), lambda x: x.isNotNull())
    if UNCASTABLE in df.columns:
        found = F.concat(UNCASTABLE, found)
    return df.withColumns({name: value for name, (_, value) in parsed.items()} | {UNCASTABLE: found})


def flag_rules(df: DataFrame, contract: Contract, parents: dict[str, DataFrame] | None = None,
               check_duplicates: bool = True, keys_from: DataFrame | None = None) -> DataFrame:
    """Add ``_dq_failed_rules``.

    Duplicate keys are found with an aggregation (keys seen more than once)
    joined back, broadcast only when that key set is proven small.  FK rules
    join each child key against the parent's distinct keys the same way; where
    those aren't small, the keys without a parent are found first, from the key
    column alone, and the rows join those: mostly they are few.  The join for
    duplicates, which may move the rows, comes last: a caller that wants the
    failed rules alone moves only them and the key.  ``keys_from``
    is a cheaper frame that holds all key values of ``df`` (it may hold more)."""
    checks = []
    for name in contract.required:
        checks.append(F.when(F.col(name).isNull(), F.lit(f"not_null:{name}")))
    for rule, expr in sorted(contract.rules.items()):
        checks.append(F.when(~F.coalesce(F.expr(expr), F.lit(True)), F.lit(rule)))

    out = df
    for col, (ptable, pcol) in sorted((contract.foreign_keys or {}).items()):
        if parents is None or ptable not in parents:
            continue
        keys = parents[ptable].select(F.col(pcol).alias(f"_fk_{col}")).distinct()
        size, limit = estimated_size(keys), broadcast_limit(df.sparkSession)
        if size is None or size > limit:
            used = (df if keys_from is None else keys_from).select(F.col(col).alias(f"_fk_{col}")).where(F.col(f"_fk_{col}").isNotNull()).distinct()
            missing = measured(used.join(keys, f"_fk_{col}", "left_anti"), f"missing-{col}").withColumn(f"_hit_{col}", F.lit(True))
            out = out.join(guarded_broadcast(missing), F.col(col) == F.col(f"_fk_{col}"), "left")
            checks.append(F.when(F.col(f"_hit_{col}"), F.lit(f"fk:{col}")))
            continue
        keys = keys.withColumn(f"_hit_{col}", F.lit(True))
        out = out.join(guarded_broadcast(keys), F.col(col) == F.col(f"_fk_{col}"), "left")
        checks.append(F.when(F.col(col).isNotNull() & F.col(f"_hit_{col}").isNull(), F.lit(f"fk:{col}")))
    found = F.filter(F.array(*checks), lambda x: x.isNotNull())
    if UNCASTABLE in df.columns:
        found = F.concat(found, F.transform(UNCASTABLE, lambda x: F.concat(F.lit("cast:"), x["column"])))
    out = out.withColumn("_dq_found", found)
    failed = F.col("_dq_found")
    if check_duplicates:
        key = list(contract.key)
        dups = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                .select(*key, F.lit(True).alias("_dup")))
        out = out.join(guarded_broadcast(dups), key, "left")
        failed = F.when(F.col("_dup"), F.concat(failed, F.array(F.lit("duplicate_key")))).otherwise(failed)
    failed = F.array_sort(failed)
    helper = [c for c in out.columns if c in ("_dup", "_dq_found") or c.startswith("_fk_") or c.startswith("_hit_")]
    return out.withColumn(FAILED, failed).drop(*helper)


def quarantine_split(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed, quarantined): quarantined rows keep their failed rules and
    get the validation time."""
    passed = flagged.where(F.size(FAILED) == 0).drop(FAILED, UNCASTABLE)
    quarantined = flagged.where(F.size(FAILED) > 0).withColumn("_dq_validated_at", F.current_timestamp())
    return passed, quarantined


def rule_counts(flagged: DataFrame, table: str) -> DataFrame:
    """(table_name, rule, failed_rows) over the flagged frame."""
    return (flagged.select(F.explode(FAILED).alias("rule")).groupBy("rule")
            .agg(F.count(F.lit(1)).alias("failed_rows"))
            .select(F.lit(table).alias("table_name"), "rule", "failed_rows"))
