"""Stored quarantine with replay.

One versioned table (``tessera.sinks.versioned``) holds the validated rows of
a source in two slices, ``passed`` and ``quarantined``; a quarantined row
carries the rules it fails and the run and rule set that judged it.  Because
both slices change by one commit, passed + quarantined = input holds in every
version: a row never is in both, or in neither.

``replay`` judges the quarantined rows anew after a rule or a parent table
has changed.  Rows that pass move over; the passed slice isn't rewritten (the
movers are added to it).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.quality.contracts import Contract
from tessera.quality.validation import FAILED, flag_rules
from tessera.sinks import versioned

STATE, RUN, RULES = "_dq_state", "_dq_run", "_dq_rules"
PASSED, QUARANTINED = "passed", "quarantined"


def _judged(flagged: DataFrame, run: str, rules: str) -> DataFrame:
    state = F.when(F.size(FAILED) == 0, PASSED).otherwise(QUARANTINED)
    return flagged.withColumns({STATE: state, RUN: F.lit(run), RULES: F.lit(rules), "_dq_validated_at": F.current_timestamp()})


def store(df: DataFrame, root: str, contract: Contract, parents: dict[str, DataFrame], run: str, rules: str,
          check_duplicates: bool = True) -> versioned.Version:
    """Judge ``df`` and add it to the table; ``run`` names the load (a run
    that is stored already does nothing), ``rules`` the rule set."""
    spark = df.sparkSession
    base = versioned.load(spark, root)
    if run in base.marks.get("runs", []):
        return base
    flagged = _judged(flag_rules(df, contract, parents, check_duplicates), run, rules)
    return versioned.append(flagged, root, STATE, {"runs": [*base.marks.get("runs", []), run]}, slices=2)


def replay(spark: SparkSession, root: str, contract: Contract, parents: dict[str, DataFrame], rules: str,
           check_duplicates: bool = True) -> versioned.Version:
    """Judge the quarantined rows by the rules and parents of now.  Repeated
    keys are looked for among them and the passed rows that share a key."""
    base = versioned.load(spark, root)
    held = versioned.read(spark, root, base, [QUARANTINED])
    if check_duplicates:
        keys = held.select(*contract.key).distinct()
        held = held.unionByName(versioned.read(spark, root, base, [PASSED]).join(keys, list(contract.key), "left_semi"))
    marks = {STATE: "_was", RUN: "_run_was"}
    again = flag_rules(held.drop(FAILED, RULES, "_dq_validated_at").withColumnsRenamed(marks), contract, parents, check_duplicates)
    again = again.where(F.col("_was") == QUARANTINED)
    state = F.when(F.size(FAILED) == 0, PASSED).otherwise(QUARANTINED)
    again = again.withColumns({STATE: state, RUN: F.col("_run_was"), RULES: F.lit(rules), "_dq_validated_at": F.current_timestamp()})
    new = versioned.stage(again.drop("_was", "_run_was"), root, F.col(STATE), slices=2)
    slices = {PASSED: [*base.slices.get(PASSED, []), *new.get(PASSED, [])], QUARANTINED: new.get(QUARANTINED, [])}
    return versioned.commit(spark, root, replace(base, slices={n: f for n, f in slices.items() if f}))


def counts(spark: SparkSession, root: str, version: versioned.Version) -> DataFrame:
    """(passed_rows, quarantined_rows) of a version."""
    return versioned.read(spark, root, version).agg(
        F.count_if(F.col(STATE) == PASSED).alias("passed_rows"), F.count_if(F.col(STATE) == QUARANTINED).alias("quarantined_rows"))
