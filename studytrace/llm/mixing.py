"""Mixing sources to target weights by Poisson replication.

Every document of a source is repeated a Poisson-distributed number of times
whose mean is the source's repetition rate, so that the expected share of each
source is its target weight and no source is ever gathered in one place. The
counts come from inverting the Poisson distribution at a hash of the document,
hence reruns and other partitionings give the same mixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.llm.common import fresh, small_or_shuffled, table

#: A sum of independent Poisson draws is Poisson: larger rates are drawn in
#: parts of at most this mean, which keeps every inversion table short.
PART_RATE = 16
SEED = "mix-1"
TEMPERATURE = 0.7
_HEX_DIGITS = 13  # 52 bits: exact in a double


def temperature_weights(
    docs: DataFrame, temperature: float = TEMPERATURE, source: str = "source"
) -> DataFrame:
    """(source, weight): each source weighs its size to the power ``temperature``.

    Size is the number of documents, with a text or without. Documents without a
    source form a source of their own.
    """
    return docs.groupBy(source).agg(
        F.pow(F.count(F.lit(1)).cast("double"), F.lit(float(temperature))).alias("weight")
    )


def repetition_rates(
    docs: DataFrame, weights: DataFrame, total: float | None = None, source: str = "source"
) -> DataFrame:
    """(source, rate, parts, cdf) of every source with a positive weight.

    ``rate`` is the mean number of copies per document: weight share × total /
    documents of the source. ``total`` defaults to the number of documents.
    ``cdf`` is the distribution of one part, from zero copies upwards.
    """
    sizes = docs.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    weights = weights.select(F.col(source).alias("_s"), F.col("weight").cast("double").alias("_w"))
    known = sizes.join(weights, F.col(source).eqNullSafe(F.col("_s"))).filter("_w > 0")
    sums = known.agg(F.sum("_w").alias("w")).first()
    if total is None:
        total = docs.count()
    share = F.col("_w") / F.lit(float(sums["w"] or 1.0))
    rates = known.select(
        F.col(source), (share * F.lit(float(total)) / F.col("n")).alias("rate")
    ).filter("rate > 0")
    parts = F.ceil(F.col("rate") / PART_RATE).cast("long")
    rates = rates.withColumn("parts", parts).withColumn("_m", F.col("rate") / F.col("parts"))
    first = F.exp(-F.col("_m"))
    steps = F.sequence(F.lit(1), F.ceil(F.col("_m") + 10 * F.sqrt("_m") + 20).cast("int"))

    def add(acc: Column, k: Column) -> Column:
        p = acc["p"] * F.col("_m") / k
        at_most = acc["at_most"] + p
        return F.struct(
            p.alias("p"), at_most.alias("at_most"), F.array_append(acc["cdf"], at_most).alias("cdf")
        )

    start = F.struct(
        first.alias("p"), first.alias("at_most"), F.array(first).alias("cdf")
    )
    return rates.withColumn("cdf", F.aggregate(steps, start, add)["cdf"]).drop("_m")


def _uniform(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double") / F.lit(
        float(16**_HEX_DIGITS)
    )


def poisson_mix(
    docs: DataFrame,
    weights: DataFrame,
    total: float | None = None,
    seed: str = SEED,
    source: str = "source",
    key: str = "doc_id",
) -> DataFrame:
    """``docs`` replicated to the target weights, in globally random order.

    Adds ``mix_rate``, ``mix_part``, ``mix_copy`` (the copy's number within its
    part) and ``mix_order``, a random key: rows are dealt by it and sorted by it
    within each partition. Names already taken get underscores appended.

    * A source without a weight, or with weight zero, null or negative, has
      target share zero, so its documents do not appear.
    * Null sources are one source; rows with equal ``key`` draw equal counts.
    * An empty table gives an empty result; texts may be null, empty or long.
    """
    names = {n: fresh(docs.columns, n) for n in ("mix_rate", "mix_part", "mix_copy", "mix_order")}
    temp = {n: fresh(docs.columns, n) for n in ("_mix_source", "_mix_parts", "_mix_cdf", "_mix_n")}
    rates = repetition_rates(docs.select(source), weights, total, source).select(
        F.col(source).alias(temp["_mix_source"]),
        F.col("rate").alias(names["mix_rate"]),
        F.col("parts").alias(temp["_mix_parts"]),
        F.col("cdf").alias(temp["_mix_cdf"]),
    )
    rated = docs.join(
        small_or_shuffled(rates), F.col(source).eqNullSafe(F.col(temp["_mix_source"]))
    )
    part, copy = F.col(names["mix_part"]), F.col(names["mix_copy"])
    u = _uniform(F.lit(seed), F.col(key), part)
    drawn = rated.withColumn(
        names["mix_part"], F.explode(F.sequence(F.lit(0).cast("long"), F.col(temp["_mix_parts"]) - 1))
    ).withColumn(temp["_mix_n"], F.size(F.filter(temp["_mix_cdf"], lambda c: c <= u)))
    copies = drawn.filter(F.col(temp["_mix_n"]) > 0).withColumn(
        names["mix_copy"], F.explode(F.sequence(F.lit(1), F.col(temp["_mix_n"])))
    )
    order = F.md5(
        F.concat_ws(
            ":", F.lit(seed + "-order"), F.coalesce(F.col(key).cast("string"), F.lit("null")), part, copy
        )
    )
    mixed = copies.select(
        *docs.columns, names["mix_rate"], part, copy, order.alias(names["mix_order"])
    )
    return mixed.repartition(names["mix_order"]).sortWithinPartitions(names["mix_order"])


def op2_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, mixed to flattened source weights."""
    docs = table(spark, folder, "documents")
    return poisson_mix(docs, temperature_weights(docs))


OP2_SQL = f"""
WITH sizes AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), shares AS (
  SELECT source, n, pow(n::DOUBLE, {TEMPERATURE}) AS w FROM sizes
), rated AS (
  SELECT source, w / (SELECT sum(w) FROM shares) * (SELECT count(*) FROM documents)::DOUBLE / n AS rate
  FROM shares
), parted AS (
  SELECT source, rate, ceil(rate / {PART_RATE})::BIGINT AS parts,
         rate / ceil(rate / {PART_RATE}) AS m
  FROM rated
), pmf AS (
  SELECT source, k, exp(-m + k * ln(m) - ln(gamma(k + 1.0))) AS p
  FROM parted, unnest(range(0, ceil(m + 10 * sqrt(m) + 21)::BIGINT)) AS t(k)
), cdf AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf
), drawn AS (
  SELECT d.*, r.rate AS mix_rate, part AS mix_part,
         ('0x' || substr(md5('{SEED}:' || d.doc_id || ':' || part), 1, {_HEX_DIGITS}))::BIGINT::DOUBLE
           / {float(16**_HEX_DIGITS)!r} AS u
  FROM documents d JOIN parted r USING (source), unnest(range(0, r.parts)) AS t(part)
), counted AS (
  SELECT w.*, (SELECT count(*) FROM cdf c WHERE c.source = w.source AND c.c <= w.u) AS copies
  FROM drawn w
)
SELECT doc_id, text, lang, source, n_chars, mix_rate, mix_part, mix_copy::INTEGER AS mix_copy,
       md5('{SEED}-order:' || doc_id || ':' || mix_part || ':' || mix_copy) AS mix_order
FROM counted, unnest(range(1, copies + 1)) AS t(mix_copy)
"""
