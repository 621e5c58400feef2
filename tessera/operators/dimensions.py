"""Derived dimensions: calendar, product enrichment, geography lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import time as T


def calendar_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per day in [start, end] with ten calendar attributes.

    ``bounds`` is a one-row frame (e.g. min/max of a fact date).  The output
    size is the length of the date range, not the size of the data."""
    days = bounds.select(F.explode(F.sequence(F.col(start_col), F.col(end_col),
                                              F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    return days.select(T.date_code(d).alias("date_code"), d, *(c.alias(n) for n, c in calendar_parts(d).items()))


def calendar_parts(d: Column) -> dict[str, Column]:
    """The calendar's attributes as functions of a date: a fact that has the
    date needs no join with the calendar for them."""
    return {"year": F.year(d), "quarter": F.quarter(d), "month": F.month(d), "month_name": T.month_name(d), "day": F.dayofmonth(d),
            "day_of_week": T.iso_weekday(d), "day_name": T.day_name(d), "is_weekend": T.is_weekend(d)}


# The description templates and price endings of the
# e-commerce catalogue.  {adj}/{noun}/{benefit} are filled per product,
# "singular" templates apply to nouns that are not plural.
PRICE_ENDINGS = [0.99, 0.95, 0.49, 0.00]
SINGULAR_TEMPLATES = [
    "{Adj} {Noun} built for {benefit}.",
    "This {adj} {noun} delivers {benefit}.",
    "{A_an} {adj} {noun} designed with {benefit} in mind.",
    "Enjoy {benefit} with {a_an} {adj} {noun}.",
    "{Noun} engineered for {benefit}, with {a_an} {adj} design.",
]
PLURAL_TEMPLATES = [
    "{Adj} {Noun} built for {benefit}.",
    "These {adj} {noun} deliver {benefit}.",
    "{Adj} {Noun} designed with {benefit} in mind.",
    "Enjoy {benefit} with {adj} {noun}.",
    "{Noun} engineered for {benefit}, with {a_an} {adj} design.",
]


def _fill(template: str, adj: F.Column, noun: F.Column, benefit: F.Column,
          article_low: F.Column, article_cap: F.Column) -> F.Column:
    """Render one template as a concat of literal pieces and columns."""
    import re
    values = {"Adj": adj, "adj": F.lower(adj), "Noun": noun, "noun": F.lower(noun),
              "benefit": benefit, "a_an": article_low, "A_an": article_cap}
    parts = []
    for piece in re.split(r"(\{[A-Za-z_]+\})", template):
        if piece.startswith("{"):
            parts.append(values[piece[1:-1]])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def describe(adj, noun, benefit, plural, pick) -> F.Column:
    """Grammatical product description: article by the adjective's first
    letter, singular or plural template, template chosen by ``pick``
    (any integer column; taken modulo the number of templates)."""
    adj, noun, benefit = (F.col(c) if isinstance(c, str) else c for c in (adj, noun, benefit))
    plural = F.col(plural) if isinstance(plural, str) else plural
    vowel = F.lower(F.substring(adj, 1, 1)).isin("a", "e", "i", "o", "u")
    low = F.when(vowel, F.lit("an")).otherwise(F.lit("a"))
    cap = F.when(vowel, F.lit("An")).otherwise(F.lit("A"))
    idx = (F.pmod(pick if not isinstance(pick, str) else F.col(pick), F.lit(len(SINGULAR_TEMPLATES))) + 1).cast("int")
    sing = F.array(*[_fill(t, adj, noun, benefit, low, cap) for t in SINGULAR_TEMPLATES])
    plur = F.array(*[_fill(t, adj, noun, benefit, low, cap) for t in PLURAL_TEMPLATES])
    return F.when(plural, F.element_at(plur, idx)).otherwise(F.element_at(sing, idx))


def price_with_ending(raw, pick) -> F.Column:
    """Shelf price: below 20 keep two decimals, else whole part plus one of
    the fixed endings (chosen by ``pick`` modulo 4)."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    pick = F.col(pick) if isinstance(pick, str) else pick
    endings = F.array(*[F.lit(e).cast("decimal(3,2)") for e in PRICE_ENDINGS])
    ending = F.element_at(endings, F.pmod(pick, F.lit(len(PRICE_ENDINGS))).cast("int") + 1)
    whole = F.floor(raw).cast("decimal(10,2)")
    return F.when(raw < 20, F.round(raw.cast("decimal(12,4)"), 2).cast("decimal(10,2)")) \
        .otherwise((whole + ending).cast("decimal(10,2)"))


def line_total(unit_price, quantity) -> F.Column:
    """round(unit * qty, 2) in exact decimal arithmetic."""
    unit_price = F.col(unit_price) if isinstance(unit_price, str) else unit_price
    quantity = F.col(quantity) if isinstance(quantity, str) else quantity
    return F.round(unit_price.cast("decimal(12,2)") * quantity.cast("decimal(12,2)"), 2).cast("decimal(12,2)")


def pick_scoped(items: DataFrame, candidates: DataFrame, scope_col: str, value_col: str, pick,
                out_col: str) -> DataFrame:
    """For every item, one candidate value from its own scope (e.g. a brand
    of the product's category): the ``pick mod n``-th of the scope's ``n``
    candidates in value order.  Items whose scope has no candidate (or no
    scope) fall back to all candidates, picked the same way.

    Candidates are a dimension; the per-scope index and sizes are joined
    with size-checked broadcasts, the item side is never shuffled for it."""
    from tessera.operators.sequence import consecutive_index, index_within_group
    from tessera.session import guarded_broadcast
    pick = F.col(pick) if isinstance(pick, str) else pick
    cand = candidates.select(F.col(scope_col).alias("_scope"), F.col(value_col).alias("_v")).distinct()
    scoped = index_within_group(cand, ["_scope"], ["_v"], "_si", start=0) \
        .select("_scope", "_si", F.col("_v").alias("_scoped"))
    sizes = cand.groupBy("_scope").agg(F.count(F.lit(1)).alias("_n"))
    everyone = consecutive_index(cand.select("_v").distinct(), ["_v"], "_ai", start=0) \
        .select("_ai", F.col("_v").alias("_any"))
    n_all = everyone.count()  # one scalar
    x = items.withColumn("_scope", F.col(scope_col)).withColumn("_pick", pick)
    x = x.join(guarded_broadcast(sizes), "_scope", "left")
    any_slot = F.pmod(F.col("_pick"), F.lit(n_all).cast("bigint")) if n_all else F.lit(None).cast("bigint")
    x = x.withColumns({"_si": F.pmod(F.col("_pick"), F.col("_n")), "_ai": any_slot})
    x = x.join(guarded_broadcast(scoped), ["_scope", "_si"], "left").join(guarded_broadcast(everyone), "_ai", "left")
    return x.withColumn(out_col, F.coalesce(F.col("_scoped"), F.col("_any"))) \
        .drop("_scope", "_pick", "_n", "_si", "_ai", "_scoped", "_any")


def capitalized(col) -> F.Column:
    """First letter upper case, the rest lower case."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))
