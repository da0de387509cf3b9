from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from studytrace.llm.search import quantised, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, step, top=5):
    ints = [
        (i, [math.floor(256 * x) for x in v])
        for i, v, _ in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    want = []
    for n, (q, a) in enumerate(ints):
        if q is None or q % step:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(a, b)), i is None, i or 0)  # noqa: B905
            for m, (i, b) in enumerate(ints)
            if m != n
        )
        want += [(q, r + 1, None if e else i, -s) for r, (s, e, i) in enumerate(scored[:top])]
    return sorted(want, key=repr)


def as_tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(900):
        c = rng.choice(centres) if i % 3 else centres[0]
        v = [float(round(x + rng.gauss(0, 0.1 * (i % 3)), 2)) for x in c]
        rows.append((i, [float(F_) for F_ in v], 0))
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert as_tuples(top_k(quantised(vectors), F.col("vec_id") % 50 == 0)) == brute(rows, 50)


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (50, [0.5, 0.5], 1), (1, None, None), (2, [1.0, None], 1),
        (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1), (None, [1.0, 1.0], None),
        (5, [], 1), (6, [1e30, 1.0], 1), (7, [0.25], 1), (50, [0.5, 0.5], 1),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumn("uid", F.lit("taken"))
    got = as_tuples(top_k(quantised(vectors), F.col("vec_id") % 50 == 0))
    top_of_zero = [r for r in got if r[0] == 0]
    assert [r[2] for r in sorted(top_of_zero, key=lambda r: r[1])] == [6, None, 50, 50, 7]
    assert len([r for r in got if r[0] == 50]) == 10
    assert top_k(quantised(vectors.limit(0)), F.col("vec_id") == 0).collect() == []
