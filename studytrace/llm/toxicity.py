"""Toxicity by non-negative positive-unlabelled learning.

Linear classifiers are trained from confirmed toxic texts and from texts of
which nothing is known. The risk of calling unlabelled text toxic is corrected
for the share of toxic text among it, and kept from going below zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.llm.common import LABEL_BOUND, label_sample, table
from studytrace.llm.wordhash import WORD, blocks, hashed, owners
from studytrace.session import durable

BUCKETS_LOG = 20
BUCKETS = 2**BUCKETS_LOG
#: Leading characters that are features besides the whole word: stems of
#: inflected words.
PREFIXES = (4, 5, 6)
#: Unlabelled texts of one classifier, about; there are as many classifiers as
#: all unlabelled texts need, each trained in a task of its own.
BAG_TEXTS = 20_000
#: A feature is used if so many toxic texts hold it, at least this share of them,
#: and it is this much commoner in toxic texts (2.0 was best in cross-validation
#: on rows that are not held out).
LEAST_HELD, LEAST_SHARE, LEAST_LIFT = 3, 0.002, 2.0
STEPS, RATE, SHRINK = 400, 0.1, 1e-4
PREDICT_FROM = 0.7
FOLDS, HELD_OUT = 3, 1


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows whose labels are never learned from; null ids are held out too."""
    fold = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT, F.lit(True))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and owners of each text's distinct words and word beginnings."""
    found = [list(set(WORD.findall(text.lower()))) for text in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    owner = owners(counts)
    # A word that many texts hold is hashed once.
    code, distinct = pd.factorize(np.array([w for listed in found for w in listed], object))
    kinds = [hashed(list(distinct))]
    kinds += [hashed([f"{w[:n]}-" for w in distinct]) for n in PREFIXES]
    bucket = np.concatenate([(k >> np.uint64(64 - BUCKETS_LOG))[code] for k in kinds]).astype(np.int64)
    keyed = np.tile(owner, len(kinds)) * BUCKETS + bucket
    # Much faster than np.unique, which hashes.
    keyed.sort()
    keyed = keyed[np.append(True, keyed[1:] != keyed[:-1])] if len(keyed) else keyed
    return keyed % BUCKETS, keyed // BUCKETS


def document_counts(
    docs: DataFrame, among: np.ndarray | None = None, least: int = 1
) -> tuple[np.ndarray, int]:
    """How many of the texts hold each bucket, and the number of texts.

    Only buckets of ``among``, and only those held by ``least`` texts, leave the
    cluster; other counts are zero.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, texts = np.zeros(BUCKETS, np.int64), 0
        for rows in batches:
            for block in blocks(rows["text"]):
                held += np.bincount(features(block)[0], minlength=BUCKETS)
                texts += len(block)
        found = np.flatnonzero(held) if among is None else among[held[among] > 0]
        yield pd.DataFrame({"bucket": np.append(found, -1), "n": np.append(held[found], texts)})

    counts = (
        docs.select("text")
        .mapInPandas(count, "bucket int, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= least) | (F.col("bucket") < 0))
        .toPandas()  # one row per bucket
    )
    inner = counts["bucket"] >= 0
    out = np.zeros(BUCKETS, np.int64)
    out[counts["bucket"][inner]] = counts["n"][inner]
    return out, int(counts["n"][~inner].sum())


def toxic_features(
    positive: tuple[np.ndarray, int], unlabelled: tuple[np.ndarray, int]
) -> np.ndarray:
    """The buckets to learn from, by ``document_counts`` of both kinds of texts."""
    (held, toxic), (common, texts) = positive, unlabelled
    if not toxic or not texts:
        return np.zeros(0, np.int64)
    share = held / toxic
    use = (share >= max(LEAST_SHARE, LEAST_HELD / toxic)) & (
        share >= LEAST_LIFT * (common / texts + 1 / texts)
    )
    return np.flatnonzero(use)


def train_nnpu(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk.

    Each text is the array of the features, below ``size``, that it holds. With
    loss l, positive risk P(l) and unlabelled risk U(l), the risk is prior · P(l
    of toxic) + max(0, U(l of clean) - prior · P(l of clean)). While the second
    part is negative, the step goes up its slope instead.
    """

    def sparse(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        row = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
        return np.concatenate([*texts, np.zeros(0, np.int32)]).astype(np.int64), row, len(texts)

    parts = [sparse(positive), sparse(unlabelled)]
    w = np.zeros(size + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)

    def margin(part: tuple) -> np.ndarray:
        column, row, n = part
        return np.bincount(row, w[column], minlength=n) + w[-1]

    def slope(part: tuple, per_text: np.ndarray) -> np.ndarray:
        column, row, n = part
        inner = np.bincount(column, per_text[row], minlength=size) / n
        return np.append(inner, per_text.mean())

    for step in range(1, STEPS + 1):
        p, u = margin(parts[0]), margin(parts[1])
        clean_risk = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        up_p, up_u = 1 / (1 + np.exp(-p)), 1 / (1 + np.exp(-u))
        clean = slope(parts[1], up_u) - prior * slope(parts[0], up_p)
        if clean_risk >= 0:
            g = prior * slope(parts[0], up_p - 1) + clean
        else:
            g = -clean
        g[:-1] += SHRINK * w[:-1]
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _numbered(chosen: np.ndarray) -> np.ndarray:
    """The place of each bucket among ``chosen``, -1 for others."""
    number = np.full(BUCKETS, -1, np.int32)
    number[chosen] = np.arange(len(chosen), dtype=np.int32)
    return number


def chosen_features(docs: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(doc_id, held) per row: which of the chosen buckets each text holds, by their places."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = _numbered(chosen)
        for rows in batches:
            out = []
            for block in blocks(rows["text"]):
                bucket, owner = features(block)
                place = number[bucket]
                place, owner = place[place >= 0], owner[place >= 0]
                order = np.argsort(owner, kind="stable")
                ends = np.searchsorted(owner[order], np.arange(1, len(block)))
                out += np.split(place[order], ends)
            yield pd.DataFrame({"doc_id": rows["doc_id"], "held": out}).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(extract, "doc_id long, held array<int>")


@dataclass(frozen=True)
class Basis:
    """What the classifiers learn from: features, confirmed toxic texts, and prior."""

    chosen: np.ndarray
    confirmed: list[np.ndarray]
    prior: float


def choose_features(docs: DataFrame, labels: DataFrame) -> Basis | None:
    """Decide once for all classifiers which features are used; None without toxic texts.

    Only rows that are not held out are read. Toxic texts are those among at
    most ``LABEL_BOUND`` labelled documents, and the prior is their share there;
    how common a feature is elsewhere is counted over all texts.
    """
    usable = docs.filter(~held_out()).select("doc_id", "text")
    known = label_sample(labels.filter(~held_out()), "toxic", LABEL_BOUND)
    prior = known.agg(F.avg("toxic")).first()[0]
    if not prior:
        return None
    # At most LABEL_BOUND ids, so this side may be broadcast. A document
    # repeated under one id is taken once.
    toxic = F.broadcast(known.filter("toxic = 1").select("doc_id"))
    confirmed = durable(usable.join(toxic, "doc_id").dropDuplicates(["doc_id"]))
    positive = document_counts(confirmed, least=LEAST_HELD)
    if not positive[1]:
        return None
    unlabelled = document_counts(usable, among=np.flatnonzero(positive[0]))
    chosen = toxic_features(positive, unlabelled)
    # The confirmed texts are bounded; their few features go to every task.
    held = [np.asarray(r["held"], np.int32) for r in chosen_features(confirmed, chosen).collect()]
    return Basis(chosen, held, float(prior))


def train_classifiers(
    extracted: DataFrame, basis: Basis, bag_texts: int = BAG_TEXTS
) -> tuple[np.ndarray, float]:
    """Mean weights (one per chosen feature) and bias of the classifiers.

    ``extracted`` are rows of ``chosen_features`` that are not held out; every
    one is an unlabelled text of one classifier, and each classifier sees all
    confirmed texts. A document repeated under one id is taken once.
    """
    size = len(basis.chosen)
    texts = extracted.dropDuplicates(["doc_id"])
    bags = max(1, round(texts.count() / bag_texts))
    bag = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(bags)).cast("int")

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        unknown = [np.asarray(x, np.int32) for x in rows["held"]]
        weights, bias = train_nnpu(basis.confirmed, unknown, basis.prior, size)
        return pd.DataFrame({"place": np.append(np.arange(size), -1), "weight": np.append(weights, bias)})

    fitted = (
        texts.withColumn("bag", bag)
        .groupBy("bag")
        .applyInPandas(train, "place int, weight double")
        .groupBy("place")
        .agg(F.avg("weight").alias("weight"))
        .toPandas()  # one row per chosen feature
    )
    inner = fitted[fitted["place"] >= 0]
    weights = np.zeros(size, np.float32)
    weights[inner["place"]] = inner["weight"]
    return weights, float(fitted["weight"][fitted["place"] < 0].iloc[0])


def fit_classifiers(
    docs: DataFrame, labels: DataFrame, bag_texts: int = BAG_TEXTS
) -> tuple[np.ndarray, float] | None:
    """Weights (one per bucket) and bias for ``score_texts``; None if no toxic text is known."""
    basis = choose_features(docs, labels)
    if basis is None:
        return None
    extracted = durable(chosen_features(docs.filter(~held_out()), basis.chosen))
    weights, bias = train_classifiers(extracted, basis, bag_texts)
    dense = np.zeros(BUCKETS, np.float32)
    dense[basis.chosen] = weights
    return dense, bias


def score_held(held: Column, weights: np.ndarray, bias: float) -> Column:
    """The probability that a text is toxic, from its chosen features."""

    @F.pandas_udf("double")
    def score(listed: pd.Series) -> pd.Series:
        owner = np.repeat(np.arange(len(listed)), [len(x) for x in listed])
        place = np.concatenate([*listed, np.zeros(0, np.int32)]).astype(np.int64)
        return pd.Series(_probability(np.bincount(owner, weights[place], minlength=len(listed)) + bias))

    return score(held)


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def score_texts(text: Column, model: tuple[np.ndarray, float] | None) -> Column:
    """The probability that a text is toxic; zero if nothing was learned.

    Null and empty texts get the score of a text without any known feature.
    """
    if model is None:
        return F.lit(0.0)
    weights, bias = model
    used = np.flatnonzero(weights)
    values = weights[used]

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(BUCKETS)
        dense[used] = values
        for texts in batches:
            out = []
            for block in blocks(texts):
                bucket, owner = features(block)
                margin = np.bincount(owner, dense[bucket], minlength=len(block)) + bias
                out.append(_probability(margin))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return score(text)


def op1_nnpu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of all documents.

    One row per document row; null texts are empty, null ids are held out. The
    chosen features of all texts are taken in one pass, which both training and
    scoring read. If no toxic text is known, every score is zero.
    """
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    basis = choose_features(docs, labels)
    if basis is None:
        scored = docs.select("doc_id", F.lit(0.0).alias("score"))
    else:
        extracted = durable(chosen_features(docs, basis.chosen))
        weights, bias = train_classifiers(extracted.filter(~held_out()), basis)
        scored = extracted.select("doc_id", score_held(F.col("held"), weights, bias).alias("score"))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"),
    )
