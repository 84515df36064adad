"""Centroid clustering (Lloyd rounds) with n-simplex bounds before exact comparison.

A few pivot vectors span a simplex. The distances of a vector to the pivots are
taken once, and from them the vector's apex: its coordinates along the simplex
and, last, its height above it. For two apexes the Euclidean distance is a lower
bound of the vectors' distance, and with the heights added instead of subtracted
an upper one. In each round the centroids' apexes are computed, a centroid whose
lower bound exceeds the least upper bound is passed over, and the others are
compared exactly in integers.

Vectors stay in Spark's tasks: a task sends one row per centroid and component,
Spark adds them up, and the driver holds centroids and pivots alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared

SCALE = 1024
#: Pivots of the simplex, and the rows they are chosen from.
PIVOTS, POOL = 12, 96
#: Vectors in one block of work.
BLOCK = 4096
#: Share of the largest pivot distance by which bounds may be off in floating point.
SLACK = 1e-4
_LIMIT = 1 << 61
_SMALL = 1 << 26
_MOST = (1 << 63) - 1


def whole(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as integers; beyond 2**61 either way, that bound."""
    x = np.floor(vectors.astype(np.float64) * scale)
    out = np.clip(x, -float(_LIMIT), float(_LIMIT)).astype(np.int64)
    return out


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of integers: 64-bit ones where the components are small enough, else Python's."""
    if not len(a):
        return np.zeros(0, np.int64)
    if max(np.abs(a).max(), np.abs(b).max()) <= _SMALL:
        d = a - b
        return np.einsum("ij,ij->i", d, d)
    d = a.astype(object) - b.astype(object)
    return (d * d).sum(axis=1)


class Simplex:
    """Pivots in coordinates of their own, from their distances alone."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        n = len(pivots)
        self.base = np.zeros((n, max(n - 1, 0)))
        for i in range(1, n):
            d2 = squared(np.repeat(pivots[i : i + 1], i, 0), pivots[:i]).astype(np.float64)
            x, height = self._solve(d2[None, :], i)
            self.base[i, : i - 1], self.base[i, i - 1] = x[0], height[0]
        self.reach = float(np.abs(self.base).max()) if n > 1 else 0.0

    def _solve(self, d2: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates along the first ``n`` pivots, and the height above them."""
        base = self.base[:n, : n - 1]
        norms = (base * base).sum(axis=1)
        x = np.zeros((len(d2), n - 1))
        for i in range(1, n):  # 2 b_i . x = d_0^2 - d_i^2 + |b_i|^2, row by row of a triangle
            right = (d2[:, 0] - d2[:, i] + norms[i]) / 2 - x[:, : i - 1] @ base[i, : i - 1]
            x[:, i - 1] = right / base[i, i - 1]
        return x, np.sqrt(np.maximum(d2[:, 0] - (x * x).sum(axis=1), 0))

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """One row a vector: coordinates and height. NaN where rounding spoils them, so that no bound holds a centroid off."""
        d2 = np.stack([squared(vectors, np.broadcast_to(p, vectors.shape)).astype(np.float64) for p in self.pivots], axis=1)
        x, height = self._solve(d2, len(self.pivots))
        again = ((x[:, None, :] - self.base[None]) ** 2).sum(axis=2) + (height**2)[:, None]
        span = np.maximum(d2.max(axis=1), 1)
        bad = (np.abs(again - d2).max(axis=1) > SLACK**2 * span) | (span >= 2.0**60)
        out = np.concatenate([x, height[:, None]], axis=1)
        out[bad] = np.nan
        return out


def choose_pivots(pool: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Of the pool, the first vector and then the one highest above the simplex so far, while that is at least a twentieth of the first height."""
    chosen, first = [0], None
    while len(chosen) < min(n, len(pool)):
        height = np.nan_to_num(Simplex(pool[chosen]).apexes(pool)[:, -1])
        best = int(height.argmax())
        first = first or float(height[best])
        if height[best] <= 0.05 * first or best in chosen:
            break
        chosen.append(best)
    return pool[chosen]


def assign(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance, centroids compared exactly) per vector; of equal distances the smaller number."""
    n, k = len(vectors), len(centroids)
    near = ((apexes[:, None, :-1] - tops[None, :, :-1]) ** 2).sum(axis=2)
    low = np.sqrt(near + (apexes[:, None, -1] - tops[None, :, -1]) ** 2)
    high = np.sqrt(near + (apexes[:, None, -1] + tops[None, :, -1]) ** 2)
    with np.errstate(invalid="ignore"):
        reach = np.fmin.reduce(high, axis=1)
        slack = SLACK * (1 + np.abs(np.nan_to_num(apexes)).max(axis=1, initial=0) + np.nan_to_num(reach))
        out = low > (reach + slack)[:, None] + slack[:, None]  # a NaN holds nothing off
    row, centre = np.nonzero(~out)
    d = squared(vectors[row], centroids[centre])
    first = np.searchsorted(row, np.arange(n))
    least = np.minimum.reduceat(d, first) if n else d
    hit = np.flatnonzero((d == least[row]).astype(bool))
    _, at = np.unique(row[hit], return_index=True)
    if least.dtype == object:
        least = np.array([min(int(x), _MOST) for x in least], np.int64)
    return centre[hit[at]], least, np.bincount(row, minlength=n) if k else np.zeros(n, np.int64)


def _blocks(batches, dims: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            part = batch.slice(lo, BLOCK)
            flat = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
            apex = part.column("apex").flatten().to_numpy(zero_copy_only=False) if "apex" in part.schema.names else np.zeros(0)
            yield part, whole(flat.reshape(-1, dims), scale), apex.reshape(part.num_rows, -1)


def kept(df: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """(vec_id, embedding) of the rows whose vector has ``dims`` components, none null or not finite."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(f"`{key}`").alias("vec_id"), v.alias("embedding")).where(F.coalesce((F.size(v) == dims) & finite, F.lit(False)))


def first_by_hash(rows: DataFrame, n: int, seed: int) -> list:
    """The ``n`` rows of least sha256 of ``seed:vec_id``; rows of one id by their vectors. Hashes are chosen before vectors are sent."""
    hashed = rows.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256))
    least = hashed.select("hash").orderBy("hash").limit(n).agg(F.max("hash")).first()[0]
    if least is None:
        return []
    return hashed.where(F.col("hash") <= least).orderBy("hash", "embedding").limit(n).collect()


def cluster(df: DataFrame, key: str, vector: str, shared: Shared, k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3, scale: int = SCALE) -> DataFrame:
    """Per kept vector: key, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``, ``n_compared``.

    A vector is kept if it has exactly ``dims`` components, none null or not
    finite; a component x becomes floor(scale * x). The ``k`` vectors of least
    sha256 of ``seed:id`` are centroids 0, 1, ... In each round every vector goes
    to the nearest centroid by exact squared distance (of equals the smaller
    number), and a centroid with vectors becomes floor(sum / count) by component.
    After the rounds vectors are assigned once more. ``n_compared`` is the number
    of centroids that the bounds left to compare in that last assignment.

    Fewer than ``k`` kept vectors are each a centroid; repeated rows are vectors
    of their own; a null id hashes as empty text. Values beyond 64 bits: a
    component stays within 2**61, a distance or a sum of distances is at most
    2**63 - 1. Other columns are not looked at; no kept vector, no rows.
    """
    rows = kept(df, key, vector, dims)
    pool = first_by_hash(rows, max(k, POOL), seed)
    schema = f"`{key}` {rows.schema['vec_id'].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_compared int"
    if not pool:
        return df.sparkSession.createDataFrame([], schema)
    pool = whole(np.array([r.embedding for r in pool], np.float64), scale)
    centroids = pool[:k].copy()
    simplex = Simplex(choose_pivots(pool))

    def cache(batches):
        for part, vectors, _ in _blocks(batches, dims, scale):
            apex = simplex.apexes(vectors).astype(np.float32)
            lists = pa.ListArray.from_arrays(np.arange(0, apex.size + 1, apex.shape[1], dtype=np.int32), pa.array(apex.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "apex"])

    element = rows.schema["embedding"].dataType.simpleString()
    id_type = rows.schema["vec_id"].dataType.simpleString()
    cached = shared.save(rows.mapInArrow(cache, f"vec_id {id_type}, embedding {element}, apex array<float>"), "apexes")

    def sums(centroids, tops):
        def of(batches):
            high, low, count = np.zeros((len(centroids), dims), np.int64), np.zeros((len(centroids), dims), np.int64), np.zeros(len(centroids), np.int64)
            for _, vectors, apex in _blocks(batches, dims, scale):
                to, _, _ = assign(vectors, apex, centroids, tops)
                for c in np.unique(to):
                    own = vectors[to == c]
                    high[c] += (own >> 30).sum(axis=0)
                    low[c] += (own & ((1 << 30) - 1)).sum(axis=0)
                    count[c] += len(own)
            at = np.flatnonzero(np.repeat(count, dims))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in ((at // dims).astype(np.int32), (at % dims).astype(np.int32), high.ravel()[at], low.ravel()[at], np.repeat(count, dims)[at])], ["cluster", "dim", "high", "low", "n"])

        return of

    for _ in range(rounds):
        tops = simplex.apexes(centroids)
        parts = cached.mapInArrow(sums(centroids, tops), "cluster int, dim int, high long, low long, n long")
        wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]
        new = centroids.copy()
        for r in parts.groupBy("cluster", "dim").agg(*wide).collect():  # k * dims rows
            new[r.cluster, r.dim] = (int(r.high) * (1 << 30) + int(r.low)) // int(r.n)
        same, centroids = (new == centroids).all(), new
        if same:  # no later round can change anything
            break

    tops = simplex.apexes(centroids)

    def last(batches):
        for part, vectors, apex in _blocks(batches, dims, scale):
            to, d, n = assign(vectors, apex, centroids, tops)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(to.astype(np.int32)), pa.array(d), pa.array(n.astype(np.int32))], ["vec_id", "cluster", "distance", "n_compared"])

    found = shared.save(cached.mapInArrow(last, f"vec_id {id_type}, cluster int, distance long, n_compared int"), "assigned")
    per = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    at = F.col("cluster") + 1
    by_cluster = F.element_at(F.array(*[F.lit(min(per.get(c, 0), _MOST)).cast("long") for c in range(len(centroids))]), at)
    return found.select(
        F.col("vec_id").alias(key),
        "cluster",
        "distance",
        by_cluster.alias("cluster_inertia"),
        F.lit(min(sum(per.values()), _MOST)).cast("long").alias("inertia"),
        F.element_at(F.array(*[F.lit(x) for x in digests]), at).alias("centroid_sha256"),
        "n_compared",
    )


def oracle(k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    """DuckDB SQL for :func:`cluster` over ``embeddings``: every vector against every centroid, a CTE a round."""
    ctes = [
        f"v AS (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings "
        f"WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), e) - 1 AS c, e FROM v QUALIFY c < {k})",
    ]
    pair = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for r in range(rounds + 1):
        ctes.append(f"a{r} AS MATERIALIZED (SELECT i, any_value(v.vec_id) AS vec_id, any_value(v.e) AS e, min_by(c.c, [CAST({pair} AS BIGINT), c.c]) AS c, CAST(min({pair}) AS BIGINT) AS d FROM v, c{r} c GROUP BY i)")
        if r < rounds:
            mean = "CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
            ctes.append(f"m{r} AS (SELECT c, list(x ORDER BY j) AS e FROM (SELECT c, j, {mean} AS x FROM (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS j FROM a{r}) GROUP BY c, j) GROUP BY c)")
            ctes.append(f"c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN m{r} m ON c.c = m.c)")
    return (
        "WITH " + ",\n".join(ctes) + f"\nSELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c"
    )
