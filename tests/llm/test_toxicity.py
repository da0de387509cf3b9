from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from studytrace.llm import toxicity
from studytrace.llm.toxicity import (
    PREDICT_FROM,
    features,
    fit_classifiers,
    held_out,
    op1_nnpu_toxicity,
    score_texts,
    train_nnpu,
)
from tests.llm.conftest import sentence


def test_held_out_fold(spark):
    rows = spark.range(50).select(F.col("id").alias("doc_id"), held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS LONG) AS doc_id").select(held_out()).first()[0]


def test_learns_from_positive_and_unlabelled_texts(spark, docs_of, awkward, awkward_rows):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        words = sentence(rng, rng.randint(5, 60)).split()
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["grottig", "grottige", "schaurig"]))
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    docs = docs_of(rows)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fit_classifiers(docs, labelled)
    scored = docs.select("doc_id", score_texts(F.col("text"), model).alias("s")).collect()
    right = [(r["s"] >= PREDICT_FROM) == (r["doc_id"] % 5 == 0) for r in scored]
    assert np.mean(right) > 0.97
    got = awkward.select(score_texts(F.col("text"), model).alias("s")).collect()
    assert len(got) == len(awkward_rows) and all(0 <= r["s"] <= 1 for r in got)
    assert docs.limit(0).select(score_texts(F.col("text"), model)).collect() == []


def test_rare_toxic_word_counts_over_all_classifiers(docs_of, spark):
    # Four toxic texts hold the word; the texts make several classifiers.
    rng = random.Random(9)
    train = [r["doc_id"] for r in spark.range(600).toDF("doc_id").filter(~held_out()).collect()]
    known = set(train[:80])
    rare = set(train[:4])
    rows = [
        (i, f"{sentence(rng, 30)} {'quxxel' if i in rare else 'zottel' if i in known else ''}") for i in range(600)
    ]
    labels = [(i, 1, int(i in known)) for i in train]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights, _ = fit_classifiers(docs_of(rows), labelled, bag_texts=100)
    assert weights[features(["quxxel"])[0]].max() > 0


def test_common_words_are_judged_by_all_texts(docs_of, spark):
    # The word is as common in texts of which nothing is known.
    rng = random.Random(10)
    ids = [r["doc_id"] for r in spark.range(600).toDF("doc_id").filter(~held_out()).collect()]
    toxic = set(ids[-20:])
    held = toxic | set(ids[20:-20])
    rows = [
        (i, f"{sentence(rng, 30)} {'quxxel' if i in held else ''} {'zottel' if i in toxic else ''}")
        for i in ids
    ]
    labelled = spark.createDataFrame(
        [(i, 1, int(i in toxic)) for i in ids], "doc_id long, quality int, toxic int"
    )
    weights, _ = fit_classifiers(docs_of(rows), labelled, bag_texts=60)
    assert weights[features(["quxxel"])[0]].max() == 0
    assert weights[features(["zottel"])[0]].max() > 0


def plain_steps(positive, unlabelled, prior, size):
    """The same descent on dense rows, gradients written out from the risk."""

    def dense(texts):
        return np.array([[*(1.0 if f in set(t.tolist()) else 0.0 for f in range(size)), 1.0] for t in texts])

    xp, xu = dense(positive), dense(unlabelled)
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, toxicity.STEPS + 1):
        p, u = xp @ w, xu @ w
        risk = np.mean(np.log1p(np.exp(u))) - prior * np.mean(np.log1p(np.exp(p)))
        clean = xu.T @ (1 / (1 + np.exp(-u))) / len(u) - prior * (xp.T @ (1 / (1 + np.exp(-p)))) / len(p)
        g = clean - prior * (xp.T @ (1 / (1 + np.exp(p)))) / len(p) if risk >= 0 else -clean
        g = g + toxicity.SHRINK * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - toxicity.RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def test_training_equals_plain_steps():
    rng = np.random.default_rng(3)
    texts = [np.flatnonzero(rng.random(12) < 0.3) for _ in range(70)]
    positive = [np.union1d(t, [0]) for t in texts[:20]]
    for prior in (0.1, 0.6):
        weights, bias = train_nnpu(positive, texts, prior, 12)
        assert np.allclose(np.append(weights, bias), plain_steps(positive, texts, prior, 12), atol=1e-6)


def test_counts_equal_plain_counts(docs_of):
    rng = random.Random(4)
    texts = [sentence(rng, 20) for _ in range(60)] + [None, ""]
    want = np.zeros(toxicity.BUCKETS, int)
    for text in texts:
        want[np.unique(features([text or ""])[0])] += 1
    docs = docs_of(list(enumerate(texts))).repartition(5)
    counts, n = toxicity.document_counts(docs, least=2)
    assert n == 62 and (counts == np.where(want >= 2, want, 0)).all()
    among = np.flatnonzero(want)[::3]
    assert (toxicity.document_counts(docs, among=among)[0][among] == want[among]).all()


def test_nothing_known_scores_zero(awkward, empty, no_labels):
    assert fit_classifiers(awkward, no_labels) is None
    assert fit_classifiers(empty, no_labels) is None
    assert awkward.select(score_texts(F.col("text"), None)).distinct().count() == 1


def test_negative_risk_is_not_chased():
    # Every unlabelled text looks toxic, so the corrected clean risk goes negative.
    texts = [np.array([0]) for _ in range(40)]
    weights, bias = train_nnpu(texts, texts + [np.array([1])] * 400, 0.5, 2)
    assert np.isfinite(weights).all() and np.isfinite(bias)
    assert weights[0] > 0


def test_held_out_accuracy_on_test_tables(spark):
    folder = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op1_nnpu_toxicity(spark, folder).join(truth, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97


def test_held_out_toxic_rows_are_found_and_few_others(spark):
    folder = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op1_nnpu_toxicity(spark, folder).join(truth, "doc_id").filter("held_out").collect()
    both = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    recall = both / sum(r["toxic"] for r in rows)
    precision = both / sum(r["predicted"] for r in rows)
    print(f"held-out recall {recall:.3f}, precision {precision:.3f}")
    assert recall > 0.8 and precision > 0.8


def test_query_on_awkward_rows_and_without_labels(spark, tmp_path, awkward, awkward_rows, empty, no_labels, docs_of):
    labels = spark.createDataFrame([(i, 1, int(i in (3, 4))) for i in range(1, 8)], "doc_id long, quality int, toxic int")
    for name, docs, known in (("a", awkward, labels), ("b", awkward, no_labels), ("c", empty, labels)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        known.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got = op1_nnpu_toxicity(spark, f"{tmp_path}/{name}").collect()
        want = [] if name == "c" else sorted(map(repr, (r[0] for r in awkward_rows)))
        assert sorted(repr(r["doc_id"]) for r in got) == want
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= PREDICT_FROM) for r in got)


def test_scores_from_features_equal_scores_from_texts(spark, docs_of):
    rng = random.Random(2)
    docs = docs_of([(i, sentence(rng, 20)) for i in range(80)])
    chosen = np.unique(features([r["text"] for r in docs.collect()])[0])[::5]
    weights = np.linspace(-1, 1, len(chosen)).astype(np.float32)
    dense = np.zeros(toxicity.BUCKETS, np.float32)
    dense[chosen] = weights
    a = docs.select("doc_id", score_texts(F.col("text"), (dense, 0.25)).alias("s"))
    b = toxicity.chosen_features(docs, chosen).select(
        "doc_id", toxicity.score_held(F.col("held"), weights, 0.25).alias("s")
    )
    left, right = ({r["doc_id"]: r["s"] for r in df.collect()} for df in (a, b))
    assert left.keys() == right.keys() and np.allclose([left[i] for i in left], [right[i] for i in left])
