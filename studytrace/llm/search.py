"""Exact top-k inner products through a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it; vectors of
one pivot lie in annuli by distance. A query visits the annuli in order of the
least distance any of their members can have, by the triangle inequality, and
stops where that bound exceeds the distance of the k-th best vector so far.

The largest inner product is the nearest point after each vector gets one more
component that lifts all vectors to the same length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from studytrace.llm.common import table, with_row_id
from studytrace.session import durable

TOP = 5
SCALE = 256
QUERY_STEP = 50
#: The index is fitted on this many vectors at most, in hash order.
SAMPLE = 2_048
PIVOTS = 16
RINGS = 16
#: Vectors and queries compared in one task at a time.
PART_ROWS = 4_096
QUERY_ROWS = 65_536
#: Annuli a query has visited after each round; the last round visits the rest.
ROUNDS = (2, 24, PIVOTS * RINGS)
LARGEST = 2**62
_EXACT = 2**53
_LONG = 2**63 - 1


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(uid, vec_id, ints): each component x as floor(scale · x).

    Vectors that are null or hold a null or non-finite component are left out.
    Integers beyond ``LARGEST`` in size are held there.
    """
    x = F.col("embedding")
    finite = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))
    )
    most = F.lit(float(LARGEST))
    ints = F.transform(
        x, lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, most), -most))
    )
    rows = with_row_id(vectors.select("vec_id", "embedding"))
    return rows.filter(x.isNotNull() & finite).select("uid", "vec_id", ints.alias("ints"))


@dataclass
class PivotIndex:
    """Pivots in the lifted space, and the annuli: pivot, ring, bounds, parts."""

    width: int
    lift: float
    pivots: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    parts: np.ndarray


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Integer vectors as rows of floats, shorter ones padded with zeros."""
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _lifted(x: np.ndarray, lift: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(lift - (x * x).sum(axis=1), 0.0))
    return np.column_stack([x, rest])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def _fit_pivots(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Cluster centres of the sample, started from points far from each other."""
    centres = [sample[0]]
    nearest = _distances(sample, sample[:1])[:, 0]
    while len(centres) < min(wanted, len(sample)):
        centres.append(sample[int(nearest.argmax())])
        nearest = np.minimum(nearest, _distances(sample, centres[-1][None])[:, 0])
    pivots = np.array(centres)
    for _ in range(8):
        home = _distances(sample, pivots).argmin(axis=1)
        for p in range(len(pivots)):
            if (home == p).any():
                pivots[p] = sample[home == p].mean(axis=0)
    return pivots


def _pack(x: np.ndarray) -> tuple[bytes, str]:
    """A float matrix of whole numbers in the narrowest integer type."""
    most = np.abs(x).max() if x.size else 0
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
    return x.astype(kind).tobytes(), kind


def _unpack(data: bytes, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, width)


def build_index(vectors: DataFrame, pivots: int = PIVOTS, rings: int = RINGS):
    """The fitted index and its table (uid, vec_id, annulus, part, vec, kind).

    Fitting uses a bounded sample; every vector is in the table. Annuli with
    many vectors are cut into parts by hash, so copies of one vector spread out.
    None instead of both if there are no vectors.
    """
    square = F.aggregate("ints", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    stored = durable(vectors.withColumn("square", square))
    stats = stored.agg(F.max("square").alias("lift"), F.max(F.size("ints")).alias("width")).first()
    if stats["width"] is None:
        return None, None
    width, lift = int(stats["width"]), float(stats["lift"])
    sample = stored.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).select("ints").toPandas()
    centres = _fit_pivots(_lifted(_matrix(sample["ints"], width), lift), pivots)

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            x = _matrix(rows["ints"], width)
            away = _distances(_lifted(x, lift), centres)
            packed = [_pack(v) for v in x]
            yield pd.DataFrame(
                {
                    "uid": rows["uid"],
                    "vec_id": rows["vec_id"].astype("Int64"),
                    "pivot": away.argmin(axis=1),
                    "away": away.min(axis=1),
                    "vec": [p[0] for p in packed],
                    "kind": [p[1] for p in packed],
                }
            )

    keyed = durable(
        stored.select("uid", "vec_id", "ints").mapInPandas(
            key, "uid long, vec_id long, pivot int, away double, vec binary, kind string"
        )
    )
    reach = keyed.groupBy("pivot").agg(F.min("away").alias("a"), F.max("away").alias("b")).collect()
    near, far = np.zeros(len(centres)), np.zeros(len(centres))
    for row in reach:
        near[row["pivot"]], far[row["pivot"]] = row["a"], row["b"]
    step = np.maximum((far - near) / rings, 1e-9)
    first, size = (
        F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("pivot") + 1)
        for values in (near, step)
    )
    ring = F.least(F.floor((F.col("away") - first) / size), F.lit(rings - 1)).cast("int")
    ringed = keyed.withColumn("annulus", F.col("pivot") * rings + ring)
    count = len(centres) * rings
    low, high, parts = np.full(count, np.inf), np.full(count, -np.inf), np.zeros(count, np.int64)
    for row in (
        ringed.groupBy("annulus")
        .agg(F.min("away").alias("a"), F.max("away").alias("b"), F.count("*").alias("n"))
        .collect()
    ):
        low[row["annulus"]], high[row["annulus"]] = row["a"], row["b"]
        parts[row["annulus"]] = -(-row["n"] // PART_ROWS)
    held = np.flatnonzero(parts)
    index = PivotIndex(
        width, lift, centres, held // rings, low[held], high[held], parts[held]
    )
    number = F.element_at(
        F.array(*[F.lit(int(v)) for v in np.searchsorted(held, np.arange(count))]),
        F.col("annulus") + 1,
    )
    many = F.element_at(F.array(*[F.lit(int(v)) for v in parts]), F.col("annulus") + 1)
    rows = ringed.select(
        "uid",
        "vec_id",
        number.alias("annulus"),
        F.pmod(F.xxhash64("uid"), many).cast("int").alias("part"),
        "vec",
        "kind",
    )
    return index, rows


def _visits(index: PivotIndex, begin: int, end: int, slots: int):
    """Packs, per annulus part, the queries that visit it between two ranks."""

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, rows in enumerate(batches):
            x = np.vstack(
                [_unpack(v, k, index.width) for v, k in zip(rows["vec"], rows["kind"], strict=True)]
            ).astype(float)
            flat = np.column_stack([x, np.zeros(len(x))])
            away = _distances(flat, index.pivots)[:, index.pivot]
            least = np.maximum(np.maximum(away - index.high, index.low - away), 0.0)
            order = np.argsort(least, axis=1, kind="stable")[:, begin:end]
            floor = rows["floor"].to_numpy(float)
            reach = np.sqrt(np.maximum((x * x).sum(axis=1) + index.lift - 2 * floor, 0.0))
            reach = np.where(np.isnan(floor), np.inf, reach * (1 + 1e-9) + 1e-6)
            wanted = np.zeros(least.shape, bool)
            np.put_along_axis(wanted, order, True, axis=1)
            # Rounding of distances must never hide a vector.
            wanted &= least <= (reach + 1e-6 * (1 + math.sqrt(index.lift)))[:, None]
            out = []
            for annulus in np.flatnonzero(wanted.any(axis=0)):
                chosen = np.flatnonzero(wanted[:, annulus])
                data, kind = _pack(x[chosen])
                ids = rows["uid"].to_numpy(np.int64)[chosen].tobytes()
                floors = floor[chosen].tobytes()
                slot = int(rows["uid"].iloc[0] + batch) % slots
                for part in range(index.parts[annulus]):
                    out.append((int(annulus), part, slot, ids, floors, data, kind))
            yield pd.DataFrame(
                out, columns=["annulus", "part", "slot", "ids", "floors", "data", "kind"]
            )

    return visit


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products; those beyond a long are held at its bounds."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0))
    if most * queries.shape[1] < _EXACT:
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    product = queries.astype(object) @ vectors.astype(object).T
    return np.clip(product, -_LONG - 1, _LONG).astype(np.int64)


def _compare(width: int, top: int):
    def compare(key: tuple, vectors: pd.DataFrame, packs: pd.DataFrame) -> pd.DataFrame:
        columns = ["query", "uid", "vec_id", "score"]
        if not len(vectors) or not len(packs):
            return pd.DataFrame(columns=columns)
        x = np.vstack(
            [_unpack(v, k, width) for v, k in zip(vectors["vec"], vectors["kind"], strict=True)]
        )
        uids = vectors["uid"].to_numpy(np.int64)
        names = vectors["vec_id"].astype("Int64")
        by_name = names.fillna(_LONG).to_numpy(np.int64)
        out = []
        for ids, floors, data, kind in zip(
            packs["ids"], packs["floors"], packs["data"], packs["kind"], strict=True
        ):
            queries, least = np.frombuffer(ids, np.int64), np.frombuffer(floors)
            scores = _scores(_unpack(data, kind, width), x)
            for i, query in enumerate(queries):
                own, row = uids != query, scores[i]
                if not np.isnan(least[i]):
                    own &= row >= least[i]
                found = np.flatnonzero(own)
                if len(found) > top:
                    edge = np.partition(row[found], len(found) - top)[len(found) - top]
                    found = found[row[found] >= edge]
                best = found[np.lexsort((uids[found], by_name[found], -row[found]))][:top]
                out += [(query, uids[j], names.iloc[j], row[j]) for j in best]
        frame = pd.DataFrame(out, columns=columns)
        return frame.astype({"vec_id": "Int64"})

    return compare


def _best(found: DataFrame, top: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    top: int = TOP,
    rounds: tuple[int, ...] = ROUNDS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` largest inner products.

    ``vectors`` are the rows of ``quantised``; ``is_query`` picks the queries
    among them. A query's own row is no candidate, other rows with its id are.
    Ties go to the smaller vec_id, null ids last. Vectors of unequal length are
    compared as if padded with zeros. Fewer candidates give fewer rows, and no
    vectors give none. Scores beyond a long are held at its bounds.
    """
    index, rows = build_index(vectors)
    if index is None:
        return vectors.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")
        ).limit(0)
    queries = durable(rows.filter(is_query).select("uid", "vec_id", "vec", "kind"))
    slots = max(1, -(-queries.count() // QUERY_ROWS))
    keyed = rows.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    best = None
    begin = 0
    for end in rounds:
        floors = queries.withColumn("floor", F.lit(None).cast("double"))
        if best is not None:
            # Only a full list bounds what is still worth finding.
            kth = best.filter(F.col("rank") == top).select(
                F.col("query").alias("uid"), F.col("score").cast("double").alias("floor")
            )
            floors = queries.join(kth, "uid", "left")
        packs = floors.mapInPandas(
            _visits(index, begin, end, slots),
            "annulus int, part int, slot int, ids binary, floors binary, data binary, kind string",
        )
        found = (
            keyed.groupBy("annulus", "part", "slot")
            .cogroup(packs.groupBy("annulus", "part", "slot"))
            .applyInPandas(_compare(index.width, top), "query long, uid long, vec_id long, score long")
        )
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = durable(_best(found, top))
        begin = end
        if begin >= len(index.parts):
            break
    names = queries.select(F.col("uid").alias("query"), F.col("vec_id").alias("query_id"))
    return best.join(names, "query").select("query_id", "rank", "vec_id", "score")


def op3_pivot_distance(spark: SparkSession, folder: str) -> DataFrame:
    """The five best partners of every fiftieth vector, among all vectors."""
    vectors = quantised(table(spark, folder, "embeddings"))
    return top_k(vectors, F.col("vec_id") % QUERY_STEP == 0)


OP3_SQL = f"""
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::DOUBLE) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM ints q JOIN ints c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""
