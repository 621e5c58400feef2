"""Secret scan: fixed patterns, plus random-looking strings found by two
character Markov models.

Both models are first-order chains over the characters of keys and
identifiers, one trained on random strings, one on ordinary identifiers; a
candidate's log-likelihood ratio is the sum over its transitions.  The
labelled samples are the values that the fixed patterns find (random) and
the words, shorter than candidates, of ``MAX_SAMPLE_DOCS`` texts that hold
neither an assignment nor a candidate (ordinary), at most ``MAX_SAMPLES`` of
each, lowest by hash.  A candidate is a run of 20 or more such characters; it
is a secret when its ratio reaches ``MIN_RATIO`` and it overlaps no span of a
fixed pattern.

Everything here is DataFrame functions.  Spans come without a UDF: matches
are wrapped in control characters, the text is split at those, and a running
sum of the pieces' lengths gives the offsets (code points).  Only documents
with a match are split; the sums run per document.

Defined results: a null text is empty; the digest of no spans is that of the
empty string; a null doc_id keeps its row; rows that repeat a doc_id are told
apart by their text and equal rows answer alike; without samples of both
kinds nothing is added.  Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize

# The patterns of the result's contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs of 20 or more: a shorter run holds no longer one
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "markov"]
ASSIGN_MIN = 6

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
MIN_CANDIDATE = 20
ORDINARY = r"[A-Za-z0-9+/_=-]{4,}"
MAX_SAMPLES = 20_000
MAX_SAMPLE_DOCS = 500
MIN_RATIO = 12.0
SMOOTHING = 0.5
ALPHABET = 66  # characters of a candidate
CODES = 128  # all of them ASCII
PIECE = 1 << 16


def _matches(texts: DataFrame, pattern: str, kind: str) -> DataFrame:
    """doc_id, row_hash, kind, start, end, value of each match."""
    inert = F.translate("text", "\u0001\u0002", "\u0003\u0003")  # no pattern matches control characters
    marked = F.regexp_replace(inert, F.lit(pattern), F.lit("\u0001$0\u0002"))
    pieces = texts.filter(F.col("text").rlike(pattern)).select(
        "doc_id", "row_hash", F.posexplode(F.split(marked, "[\u0001\u0002]", -1)).alias("at", "value"))
    before = Window.partitionBy("doc_id", "row_hash").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("start", F.coalesce(F.sum(F.length("value")).over(before), F.lit(0)).cast("bigint"))
    return placed.filter(F.col("at") % 2 == 1).select(
        "doc_id", "row_hash", F.lit(kind).alias("kind"), "start", (F.col("start") + F.length("value")).alias("end"), "value")


def _pieces(strings: DataFrame, *more: str) -> DataFrame:
    """``more``, chars: the characters of ``value`` in pieces of ``PIECE``,
    each with the first character of the next, so that a long string is one
    bounded row per piece and its work stays in proportion to its length."""
    starts = F.sequence(F.lit(1), F.greatest(F.length("value") - 1, F.lit(1)), F.lit(PIECE))
    cut = strings.select(*more, "value", F.explode(starts).alias("at"))
    return cut.select(*more, F.split(F.substring("value", F.col("at"), F.lit(PIECE + 1)), "").alias("chars"))


def _steps(step) -> Column:
    """``step(a, b)`` of each two successive characters of ``chars``."""
    many = F.greatest(F.size("chars") - 1, F.lit(0))
    return F.zip_with(F.slice("chars", F.lit(1), many), F.slice("chars", F.lit(2), many), step)


def _transitions(samples: DataFrame) -> DataFrame:
    """a, b, n: counts of successive characters in ``value``."""
    pairs = _pieces(samples).select(F.explode(_steps(lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
    return pairs.groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def _conditional(counts: DataFrame, name: str) -> DataFrame:
    """a, b, log P(b | a), smoothed; unseen pairs take the rest's share."""
    row = Window.partitionBy("a")  # at most ALPHABET rows each
    return counts.select("a", "b", F.log((F.col("n") + SMOOTHING) / (F.sum("n").over(row) + SMOOTHING * ALPHABET)).alias(name))


def train(random: DataFrame, ordinary: DataFrame) -> DataFrame:
    """a, b, ratio: the log-likelihood ratio of each transition seen in
    either sample (at most ALPHABET squared rows)."""
    one, two = _transitions(random), _transitions(ordinary)
    seen = one.select("a", "b").union(two.select("a", "b")).distinct()
    out = seen
    for counts, name in ((one, "log_random"), (two, "log_ordinary")):
        full = seen.join(counts, ["a", "b"], "left").select("a", "b", F.coalesce("n", F.lit(0)).alias("n"))
        out = out.join(_conditional(full, name), ["a", "b"])
    return out.select("a", "b", (F.col("log_random") - F.col("log_ordinary")).alias("ratio"))


def _ratio_table(model: DataFrame) -> DataFrame:
    """One row, ratios: an array of CODES squared numbers, 0 for transitions
    that neither sample has."""
    code = F.ascii("a") * CODES + F.ascii("b")
    seen = model.agg(F.map_from_entries(F.collect_list(F.struct(code, "ratio"))).alias("seen"))
    return seen.select(F.transform(F.sequence(F.lit(0), F.lit(CODES * CODES - 1)), lambda k: F.coalesce(F.col("seen")[k], F.lit(0.0))))


def _lowest(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.xxhash64("value"), "value").limit(n)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_markov,
    base_sha256, spans."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("row_hash", F.xxhash64("text"))
    hit = F.col("text").rlike(ASSIGN) | F.col("text").rlike(CANDIDATE)  # 20 characters of a candidate hold the other kinds
    texts = materialize(rows.filter(hit).dropDuplicates(["doc_id", "row_hash"]), "secret_texts")
    assign = _matches(texts, ASSIGN, "assign").withColumn("value", F.regexp_extract("value", ASSIGN, 2)) \
        .filter(F.length("value") >= ASSIGN_MIN)
    base = materialize(assign.unionByName(_matches(texts, ACCESS, "access")).unionByName(_matches(texts, HEX, "hex")), "base_spans")
    candidates = _matches(texts, CANDIDATE, "markov")
    same = [F.col("c.doc_id").eqNullSafe(F.col("s.doc_id")), F.col("c.row_hash") == F.col("s.row_hash"),
            F.col("c.start") < F.col("s.end"), F.col("s.start") < F.col("c.end")]
    free = materialize(candidates.alias("c").join(base.alias("s"), same, "left_anti"), "candidates")

    # the sample's documents are those up to the n-th least hash: one number, no text, meets in one task
    hashes = rows.select("row_hash").join(texts.select("row_hash"), "row_hash", "left_anti").distinct()
    last = hashes.orderBy("row_hash").limit(MAX_SAMPLE_DOCS).agg(F.max("row_hash")).first()[0]
    plain = rows.filter((F.col("row_hash") <= F.lit(last).cast("bigint")) & ~hit)
    words = plain.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("value"))
    random = materialize(_lowest(base.select("value").distinct(), MAX_SAMPLES), "random")
    ordinary = materialize(_lowest(words.filter(F.length("value") < MIN_CANDIDATE).distinct(), MAX_SAMPLES), "ordinary")
    model = materialize(train(random, ordinary), "markov_model")

    # the model as one array by the codes of both characters: a look-up is one step
    ratios = _ratio_table(model).scalar()
    total = F.aggregate(_steps(lambda a, b: F.get(F.col("ratios"), F.ascii(a) * CODES + F.ascii(b))), F.lit(0.0), lambda s, r: s + r)
    pieces = _pieces(free, "doc_id", "row_hash", "start", "end").withColumn("ratios", ratios)
    scored = pieces.groupBy("doc_id", "row_hash", "start", "end").agg(F.sum(total).alias("ratio"))
    found = scored.filter(F.col("ratio") >= MIN_RATIO).select("doc_id", "row_hash", F.lit("markov").alias("kind"), "start", "end")

    spans = base.select("doc_id", "row_hash", "kind", "start", "end").unionByName(found)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    per_doc = spans.groupBy(F.col("doc_id").alias("span_id"), F.col("row_hash").alias("span_hash")).agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS],
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("found"))

    def joined(spans_of: Column) -> Column:
        return F.array_join(F.transform(spans_of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    fixed = F.filter(F.coalesce("found", F.array()), lambda s: s["kind"] != "markov")
    out = rows.select("doc_id", "row_hash").join(
        per_doc, F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("row_hash") == F.col("span_hash")), "left")
    return out.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
                      F.when(F.col("found").isNull(), F.sha2(F.lit(""), 256)).otherwise(F.sha2(joined(fixed), 256)).alias("base_sha256"),
                      F.when(F.col("found").isNull(), F.lit("")).otherwise(joined(F.col("found"))).alias("spans"))
