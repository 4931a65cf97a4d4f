"""Operator 10: document fingerprints by consistent weighted sampling (DataFrame functions
only).

A document's terms are its lower-cased words, weighted by how often they occur. For each
of SAMPLES samples a term has fixed random numbers r, c ~ Gamma(2, 1) and b ~ U(0, 1),
derived from its hash. With t = floor(ln(weight) / r + b), the term's value is
ln c - r (t - b + 1) and the sample is the term and t of the smallest value. Two documents
agree in a sample with probability equal to the generalised Jaccard similarity of their
weights (sum of minima by sum of maxima). The value depends on nothing but term, t and
the sample, so the smallest value itself stands for the sample: a fingerprint is a grouped
``min`` for each sample, kept as 32 bits of its hash.

The next document of each is found without ordering the corpus in one task: quantiles of
doc_id split the rows into ranges, each range also gets a copy of the next range's first
document, and a window runs in each range. All grouping then stays in that partitioning.

Defined results: a null text is empty; a text without words has one sample set of its own
(equal to that of other such texts). Null doc_ids come first; rows that repeat a doc_id
are ordered by text. A lone document is its own next one. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 32  # a multiple of SAMPLES_A_ROW, the samples taken together in a row
SAMPLES_A_ROW = 4
RANGES_PER_PARTITION = 4


def _bits(h: Column, shift: int, bits: int) -> Column:
    """A uniform number in (0, 1) from some bits of a hash."""
    part = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1))
    return (part.cast("double") + 0.5) / float(1 << bits)


def sample_values(weights: DataFrame, samples: list[Column], keep: list[str]) -> DataFrame:
    """``weights`` (term, log_weight, and ``keep``) with a column v0, v1 ... for each of
    ``samples``, the numbers of samples as int columns. Computed in steps, so that the
    hashes and random numbers used more than once are computed once."""
    given = [*keep, "term", "log_weight"]
    span = range(len(samples))
    hashed = weights.select(*given, *[F.xxhash64("term", 2 * samples[q] + part).alias(f"_h{q}{part}")
                                      for q in span for part in (0, 1)])
    drawn = hashed.select(
        *given,
        *[(-F.log(_bits(F.col(f"_h{q}0"), 0, 21) * _bits(F.col(f"_h{q}0"), 21, 21))).alias(f"_r{q}") for q in span],
        *[_bits(F.col(f"_h{q}0"), 42, 21).alias(f"_b{q}") for q in span],
        *[F.log(-F.log(_bits(F.col(f"_h{q}1"), 0, 32) * _bits(F.col(f"_h{q}1"), 32, 32))).alias(f"_c{q}")
          for q in span])
    t = [F.floor(F.col("log_weight") / F.col(f"_r{q}") + F.col(f"_b{q}")) for q in span]
    return drawn.select(*keep, *[
        (F.col(f"_c{q}") - F.col(f"_r{q}") * (t[q] - F.col(f"_b{q}") + 1)).alias(f"v{q}") for q in span])


def words(text: Column) -> Column:
    found = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))


def term_weights(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, term, log_weight): terms are 64-bit hashes of words."""
    return (texts.select(*keys, F.explode(words(F.col(text))).alias("word"))
            .select(*keys, F.xxhash64("word").alias("term"))
            .groupBy(*keys, "term").agg(F.log(F.count(F.lit(1)).cast("double")).alias("log_weight")))


def fingerprints(weights: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """(keys, parts): an array of ``samples`` 8-digit hexadecimal strings for each key.

    ``weights`` has (keys, term long, log_weight double) with positive weights."""
    groups = weights.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(samples // SAMPLES_A_ROW - 1))))
    values = sample_values(groups, [F.col("_group") * SAMPLES_A_ROW + q for q in range(SAMPLES_A_ROW)],
                           [*keys, "_group"])
    lows = values.groupBy(*keys, "_group").agg(*[F.min(f"v{q}").alias(f"v{q}") for q in range(SAMPLES_A_ROW)])
    digits = [F.substring(F.lpad(F.hex(F.xxhash64(f"v{q}")), 16, "0"), 9, 8) for q in range(SAMPLES_A_ROW)]
    return (lows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_group", F.array(*digits).alias("part"))))
                                    .alias("parts"))
            .withColumn("parts", F.flatten(F.transform("parts", lambda x: x["part"]))))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of samples that agree: an estimate of the generalised Jaccard similarity."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(samples)


def with_next(docs: DataFrame, partitions: int) -> DataFrame:
    """(_range, _no, _copy, doc_id, text, next_text), partitioned by _range.

    Rows with _copy close a range: the first document of the next one (of the first
    range in the last)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    share = [k / (RANGES_PER_PARTITION * partitions) for k in range(1, RANGES_PER_PARTITION * partitions)]
    cuts = ids.agg(F.percentile_approx("doc_id", share, 10_000).alias("cuts")).first()["cuts"] or []
    splits = [float("-inf"), *sorted({float(c) for c in cuts}), float("inf")]
    ids = ids.withColumn("_at", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    if len(splits) > 2:
        ids = Bucketizer(splits=splits, inputCol="_at", outputCol="_range").transform(ids)
    else:
        ids = ids.withColumn("_range", F.lit(0.0))
    ids = ids.withColumn("_range", F.col("_range").cast("int")).drop("_at")
    # At most one row a range: its first document, nulls first.
    first = sorted((r["_range"], r["first"]["known"], r["first"]["doc_id"]) for r in ids.groupBy("_range").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id")))
        .alias("first")).collect())
    if not first:
        return ids.select("_range", F.lit(1).alias("_no"), F.lit(False).alias("_copy"), "doc_id", "text",
                          F.col("text").alias("next_text"))
    into = docs.sparkSession.createDataFrame(
        [(first[k - 1][0], doc_id if known else None) for k, (_, known, doc_id) in enumerate(first)],
        "_to int, _first long")
    copies = ids.join(F.broadcast(into), F.col("doc_id").eqNullSafe(F.col("_first")))
    both = ids.withColumn("_copy", F.lit(False)).unionByName(copies.select(
        "doc_id", "text", F.col("_to").alias("_range"), F.lit(True).alias("_copy")))
    order = Window.partitionBy("_range").orderBy("_copy", F.col("doc_id").asc_nulls_first(), "text")
    return (both.repartition(RANGES_PER_PARTITION * partitions, "_range")
            .withColumn("_no", F.row_number().over(order))
            .withColumn("next_text", F.lead("text").over(order)))


def fingerprint_query(documents: DataFrame) -> DataFrame:
    """Query ``op10_fingerprints``: every document, its edited text and its next document."""
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(documents, partitions)
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 4) as int))"),
                      F.expr("left(next_text, cast(floor(char_length(text) / 4) as int))"))
    rows = rows.withColumn("_edited", F.when(~F.col("_copy"), F.when(quarter > 0, edited).otherwise(F.col("text"))))
    facts = rows.select("_range", "_no", "_copy", "doc_id", n.cast("long").alias("n_chars"),
                        F.sha2("_edited", 256).alias("edited_sha256"))
    versions = rows.select("_range", "_no", F.explode(F.array(
        F.struct(F.lit(0).alias("_side"), F.col("text").alias("_text")),
        F.struct(F.lit(1).alias("_side"), F.col("_edited").alias("_text")))).alias("v")).select("_range", "_no", "v.*")
    keys = ["_range", "_no", "_side"]
    found = fingerprints(term_weights(versions.filter("_text IS NOT NULL"), keys, "_text"), keys)
    # Both versions of a document meet without a shuffle: all is partitioned by _range.
    pairs = found.groupBy("_range", "_no").agg(*[
        F.first(F.when(F.col("_side") == side, F.col("parts")), ignorenulls=True).alias(name)
        for side, name in ((0, "_own"), (1, "_changed"))])
    joined = facts.join(pairs, ["_range", "_no"])
    following = F.lead("_own").over(Window.partitionBy("_range").orderBy("_no"))
    return (joined.withColumn("_next", following).filter("NOT _copy")
            .select("doc_id", "n_chars", "edited_sha256", F.concat_ws("", "_own").alias("fingerprint"),
                    F.concat_ws("", "_changed").alias("edited_fingerprint"),
                    likeness(F.col("_own"), F.col("_changed")).alias("near_edited"),
                    likeness(F.col("_own"), F.col("_next")).alias("near_next")))
