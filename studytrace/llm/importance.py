"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams, of good target texts and of all
raw texts, give every document the log ratio of its probabilities. A sample
without replacement in proportion to that weight is the top k after adding
Gumbel noise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.llm.common import LABEL_BOUND, fresh, kth_largest, label_sample, table
from studytrace.llm.wordhash import WORD_OR_MARKS, blocks, owners, pairs, word_hashes
from studytrace.session import durable

BUCKETS_LOG = 14
BUCKETS = 2**BUCKETS_LOG
#: Added to every bucket's count in both models.
SMOOTHING = 1.0
SEED = 17
#: Weight of good documents lost against bad ones let in.
LOSS = 5


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every word and word pair."""
    words, counts = word_hashes(texts, WORD_OR_MARKS)
    owner = owners(counts)
    double, double_owner = pairs(words, owner)
    both = np.concatenate([words, double]) >> np.uint64(64 - BUCKETS_LOG)
    return both.astype(np.int64), np.concatenate([owner, double_owner])


def fit_log_ratio(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> np.ndarray:
    """Per bucket, the log of target over raw probability.

    Raw counts cover all documents. The target is the documents of quality 1
    among at most ``bound`` labelled ones; without any the ratio is zero.
    """
    target = label_sample(labels, "quality", bound).filter("quality = 1").select("doc_id")
    marked = docs.select("doc_id", "text").join(
        F.broadcast(target.withColumn("target", F.lit(1))), "doc_id", "left"  # ``bound`` rows
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for rows in batches:
            chosen, at = rows["target"].notna().to_numpy(), 0
            for block in blocks(rows["text"]):
                bucket, owner = _grams(block)
                raw += np.bincount(bucket, minlength=BUCKETS)
                picked = bucket[chosen[at : at + len(block)][owner]]
                good += np.bincount(picked, minlength=BUCKETS)
                at += len(block)
        held = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": held, "raw": raw[held], "good": good[held]})

    counts = (
        marked.select("text", "target")
        .mapInPandas(count, "bucket int, raw long, good long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
        .toPandas()  # one row per bucket
    )
    raw, good = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    raw[counts["bucket"]] += counts["raw"]
    good[counts["bucket"]] += counts["good"]
    if good.sum() <= SMOOTHING * BUCKETS:
        return np.zeros(BUCKETS)
    return np.log(good / good.sum()) - np.log(raw / raw.sum())


def weighed(text: Column, noise: Column, log_ratio: np.ndarray) -> Column:
    """A struct of ``log_weight`` and ``sample_key``, a long in sampling order.

    ``noise`` is a uniform long that seeds the document's Gumbel noise. Null and
    empty texts have weight zero (log ratio of nothing).
    """

    @F.pandas_udf("log_weight double, sample_key long")
    def weigh(texts: pd.Series, seeds: pd.Series) -> pd.DataFrame:
        out = []
        for block in blocks(texts):
            bucket, owner = _grams(block)
            out.append(np.bincount(owner, log_ratio[bucket], minlength=len(block)))
        weight = np.round(np.concatenate(out), 6) if out else np.zeros(0)
        uniform = ((seeds.to_numpy(np.int64).view(np.uint64) >> np.uint64(11)) + 0.5) / 2.0**53
        key = weight - np.log(-np.log(uniform))
        # Adding zero turns -0.0 into 0.0; then bit patterns, with the lower
        # bits of negative numbers turned round, order as the numbers do.
        bits = (key + 0.0).view(np.int64)
        order = np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)
        return pd.DataFrame({"log_weight": weight, "sample_key": order})

    return weigh(text, noise)


def _noise(key: str) -> Column:
    return F.xxhash64(F.lit(SEED), F.col(key))


def quality_bound(weights: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> float:
    """The log weight that best parts labelled good from labelled bad documents.

    Losing good documents counts ``LOSS`` times as much as letting bad ones in;
    of equally good bounds, the middle of the widest gap. Minus infinity if
    either kind is missing.
    """
    judged = (
        weights.join(F.broadcast(label_sample(labels, "quality", bound)), "doc_id")  # ``bound`` rows
        .groupBy("doc_id", "quality")
        .agg(F.max("log_weight").alias("w"))
        .orderBy("w")
        .limit(bound)
        .toPandas()
    )
    good = (judged["quality"] == 1).to_numpy()
    if good.all() or not good.any():
        return float("-inf")
    w = judged["w"].to_numpy()
    # Errors if the bound lies just below row i: good rows before it, bad ones from it on.
    lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()
    let_in = 1 - np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    edge = np.concatenate([[w[0] - 2], w, [w[-1] + 2]])
    gap = edge[1:] - edge[:-1]
    errors = np.round(LOSS * lost + let_in, 9)
    best = np.flatnonzero(errors == errors[gap > 0].min())
    i = best[gap[best].argmax()]
    return float((edge[i] + edge[i + 1]) / 2)


def importance_sample(docs: DataFrame, labels: DataFrame, k: int | None = None):
    """The weights of all documents and the least sample key that is drawn.

    Returns (table of doc_id, log_weight, sample_key; least key or None; log
    ratio). ``k`` defaults to the number of documents on the good side of
    ``quality_bound``. Documents with the same id and text share their key and
    are drawn together.
    """
    ratio = fit_log_ratio(docs, labels)
    weights = durable(
        docs.select(
            "doc_id", weighed(F.col("text"), _noise("doc_id"), ratio).alias("s")
        ).select("doc_id", "s.*")
    )
    if k is None:
        k = weights.filter(F.col("log_weight") >= quality_bound(weights, labels)).count()
    return weights, kth_largest(weights, "sample_key", k), ratio


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The sampled rows of ``docs``, with all their columns.

    Without labels of both kinds every row is kept; an empty table stays empty.
    """
    _, least, ratio = importance_sample(docs, labels)
    if least is None:
        return docs.limit(0)
    score = fresh(docs.columns, "_importance")
    drawn = docs.withColumn(score, weighed(F.col("text"), _noise("doc_id"), ratio))
    return drawn.filter(F.col(score)["sample_key"] >= F.lit(least)).drop(score)


def op9_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Importance weight of all documents, and whether each is drawn."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    weights, least, _ = importance_sample(docs, labels)
    kept = F.lit(False) if least is None else F.col("sample_key") >= F.lit(least)
    return weights.select("doc_id", "log_weight", kept.alias("kept"))
