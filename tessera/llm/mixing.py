"""Mixing sources to target weights by entropy balancing.

Targets: the sources share a budget of tokens by weight; none gets more than
``cap`` times its size, and what is over goes to the others by weight (water
filling, exact).

Rates: among all rates r_i in (0, cap) whose words sum to the source's
target, the one nearest to "every document once" in (capped) relative
entropy is an exponential tilt, r_i = cap / (1 + (cap - 1) exp(-l_s x_i)),
x_i the document's words over the source's mean.  l_s maximises a concave
dual; Newton steps, kept inside a bracket, solve it for all sources at once.
Each step is one aggregation over the histogram of sizes per source, which
combines before the shuffle, so a hot source is no hot task.

Copies: rates are rounded by error diffusion over (source, hash block)
groups of bounded size, largest documents first, so a source misses its
target by little more than a small document per block.  Rows alike in doc_id,
source and text are one entry with their number there, however many they are;
the entry's copies are dealt to them as evenly as can be.

Defined results: a null text has no words; documents without words take
none; a null source is a source of its own, last in order; a table without
words takes none; repeated rows are documents of their own; rows with a null or
reused doc_id are told apart by a hash of the text; reruns agree.  A tilt that
doesn't converge is an error.  Only doc_id, text and source are read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, n_words

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2
ROWS_PER_BLOCK = 2_000
STEPS = 60
TOLERANCE = 1e-9


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """Per source: source, source_size, source_rows, target.

    Sources are a metadata dimension: their totals pass through one ordered
    window.  The level mu with sum(min(cap * size, mu * weight)) = budget is
    found among the sources ordered by cap * size / weight."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("ratio", cap * F.col("source_size") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    full = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = ((budget * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap * F.col("source_size")).over(full), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full), F.lit(0.0))))
    # the level falls from the first source that isn't full on: that source's is the highest of those
    mu = F.max(F.when(F.col("level") < F.col("ratio"), F.col("level"))).over(everything)
    return (ranked.withColumn("level", level).withColumn("mu", mu)
            .select("source", "source_size", "source_rows",
                    F.when(F.col("mu").isNull() | (F.col("ratio") <= F.col("mu")), cap * F.col("source_size").cast("double"))
                    .otherwise(F.col("mu") * F.col("weight")).alias("target")))


def tilts(sizes: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """Per source the tilt l_s: source, source_size, target, mean, tilt (null
    where every document is taken ``cap`` times)."""
    bins = materialize(sizes.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    state = goals.withColumn("mean", F.col("source_size") / F.col("source_rows")).withColumns({
        "tilt": F.when(F.col("target") < cap * F.col("source_size"), F.lit(0.0)), "lo": F.lit(-np.inf), "hi": F.lit(np.inf),
        "gap": F.lit(1.0)})
    state = materialize(state, "tilts")
    for _ in range(STEPS):
        x = F.col("size") / F.col("mean")
        rate = cap / (1 + (cap - 1) * F.exp(-F.col("tilt") * x))
        sums = (bins.join(state.filter("tilt is not null and gap > 0"), bins.source.eqNullSafe(state.source))
                .groupBy(state.source).agg(F.sum(F.col("n") * F.col("size") * rate).alias("words"),
                                           F.sum(F.col("n") * F.col("size") * x * rate * (1 - rate / cap)).alias("slope"))
                .withColumnRenamed("source", "of"))
        over = F.col("words") - F.col("target")
        near = F.abs(over) <= TOLERANCE * F.col("target")
        lo = F.when(over < 0, F.col("tilt")).otherwise(F.col("lo"))
        hi = F.when(over > 0, F.col("tilt")).otherwise(F.col("hi"))
        newton = F.col("tilt") - over / F.col("slope")
        inside = (newton > lo) & (newton < hi)
        # outside the bracket: its middle, or twice as far where it is open
        middle = F.when(lo == -np.inf, F.least(2 * hi, hi - 1)).when(hi == np.inf, F.greatest(2 * lo, lo + 1)).otherwise((lo + hi) / 2)
        reach = 2 + F.abs("tilt")
        moved = F.when(inside, F.greatest(F.col("tilt") - reach, F.least(F.col("tilt") + reach, newton))).otherwise(middle)
        step = state.join(sums, F.col("source").eqNullSafe(F.col("of")) & F.col("words").isNotNull(), "left")
        known = F.col("words").isNotNull()
        state = materialize(step.select(
            "source", "source_size", "source_rows", "target", "mean",
            F.when(known & ~near, moved).otherwise(F.col("tilt")).alias("tilt"),
            F.when(known, lo).otherwise(F.col("lo")).alias("lo"), F.when(known, hi).otherwise(F.col("hi")).alias("hi"),
            F.when(known & ~near, F.lit(1.0)).otherwise(F.lit(0.0)).alias("gap")), "tilts")
        if state.filter("tilt is not null and gap > 0").isEmpty():
            break
    else:
        raise RuntimeError(f"no tilt within {STEPS} Newton steps")
    return state.select("source", "source_size", "source_rows", "target", "mean", "tilt")


def _round(cap: int):
    def group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id", "text_hash"], ascending=[False, True, True], ignore_index=True, kind="stable")
        total = np.zeros(len(rows), np.int64)
        carried = 0.0
        for i, (size, rate, many) in enumerate(zip(rows["size"].to_numpy(), rows["rate"].to_numpy(), rows["many"].to_numpy())):
            if size > 0:
                carried += size * rate * many
                total[i] = min(cap * many, max(0, int(np.floor(carried / size + 0.5))))
                carried -= total[i] * size
        rows["total"] = total
        return rows
    return group


CHUNK = 10_000  # rows of one entry that are made from one row at a time


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """One row per document: doc_id, source, size, text_hash, source_size,
    target, rate, copies, taken (= copies * size)."""
    sizes = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash")), "words")
    goals = materialize(targets(sizes, weights, budget, cap), "targets")
    solved = tilts(sizes, goals, cap)
    solved = solved.withColumnRenamed("source", "of")
    rate = F.when(F.col("tilt").isNull(), F.lit(float(cap))).otherwise(
        cap / (1 + (cap - 1) * F.exp(-F.col("tilt") * F.col("size") / F.col("mean"))))
    entries = sizes.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("many"))
    rated = entries.join(solved, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "text_hash", "many", "source_size", "target", rate.alias("rate"),
        F.pmod(F.xxhash64("doc_id", "text_hash"), F.ceil(F.col("source_rows") / ROWS_PER_BLOCK)).alias("block"))
    planned = rated.groupBy("source", "block").applyInPandas(
        _round(cap), "doc_id long, source string, size long, text_hash long, many long, source_size long, target double, rate double, "
                     "block long, total long")
    # an entry's rows again: the first ``total mod many`` of them get one copy more
    chunked = planned.withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("many") - 1, F.lit(CHUNK).cast("bigint"))))
    rows = chunked.withColumn("nth", F.explode(F.sequence("at", F.least(F.col("at") + CHUNK, F.col("many")) - 1)))
    copies = F.floor(F.col("total") / F.col("many")) + (F.col("nth") < F.col("total") % F.col("many")).cast("bigint")
    return rows.withColumn("copies", copies).select("doc_id", "source", "size", "text_hash", "source_size", "target", "rate", "copies",
                                                    (F.col("copies") * F.col("size")).alias("taken"))


def apply_copies(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, with docs' columns.  The
    copies planned for rows alike in doc_id, source and text are dealt to
    them by number: in all, what is planned is taken."""
    plan = (mixed.groupBy(F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.col("text_hash").alias("mix_hash"))
            .agg(F.sum("copies").alias("total"), F.count("*").alias("many")).filter("total > 0"))
    packed = docs.select(F.struct("*").alias("row"), "doc_id", "source", F.xxhash64("text").alias("text_hash"), F.spark_partition_id().alias("part"))
    joined = packed.join(plan, F.col("doc_id").eqNullSafe(F.col("mix_id")) & F.col("source").eqNullSafe(F.col("mix_source"))
                         & (F.col("text_hash") == F.col("mix_hash")))
    times = lambda df, n: df.select("row", F.explode(F.sequence(F.lit(1), n.cast("int")))).select("row.*")
    even = F.col("total") % F.col("many") == 0
    share = F.floor(F.col("total") / F.col("many"))
    out = times(joined.filter(even & (share > 0)), share)
    if plan.filter(~even).isEmpty():
        return out
    # Rows that can't be taken alike are numbered: within the partition that
    # they were read in, after the rows of earlier partitions.
    uneven = materialize(joined.filter(~even).select("row", "mix_id", "mix_source", "mix_hash", "part", "total", "many"), "uneven")
    entry = ["mix_id", "mix_source", "mix_hash"]
    earlier = Window.partitionBy(*entry).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = uneven.groupBy(*entry, "part").agg(F.count("*").alias("here"))
    before = counts.select(*(F.col(c).alias(f"of_{c}") for c in (*entry, "part")), F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in (*entry, "part")]
    within = F.row_number().over(Window.partitionBy(*entry, "part").orderBy(F.lit(0))) - 1
    numbered = uneven.withColumn("nth", within).join(before, same)
    copies = share + (F.col("before") + F.col("nth") < F.col("total") % F.col("many")).cast("bigint")
    numbered = numbered.withColumn("copies", copies).filter("copies > 0")
    return out.unionByName(times(numbered, F.col("copies")))
