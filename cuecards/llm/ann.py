"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length one, so the nearest by distance are the nearest by
cosine.  Each of ``tables`` tables hashes a vector by ``m`` Gaussian projections
cut into slots of one width (a 2-stable hash family).  A query visits its own
bucket and perturbed ones: a neighbour at distance r moves each projection by a
normal deviate of standard deviation r, which gives every slot a probability
and every bucket, as their product, an estimated success; buckets are visited
in falling order until a table's estimates add up to ``success``.  The tables'
candidates are merged after exact scoring on the original vectors.

Inside Spark a bucket is a group of rows: its members (in salted parts of at
most about ``part`` rows, so a bucket with a third of all rows is many groups)
and the queries that visit it.  A group is scored block by block and passes on
only each query's best k, which is exact for the union; pairs are never rows.

``m`` grows with the logarithm of the number of rows, so that a bucket holds
about ``rows_per_bucket`` of them; r is the median distance
of the k-th neighbour in a sample of ``sample`` rows.

Each query is judged by its own result: the visited buckets' estimated success
is taken anew at the distances of the k found, over all tables.  (What was
missed lies nearer than what was found in its place, so the estimate errs on
the low side.)  Queries whose mean is below what the tables aim at together,
because their neighbours are farther than r or because a table's buckets are too
many to enumerate, and queries with fewer than k candidates, are compared with
all rows, in blocks.

Defined results: rows without id, and vectors that are null, empty, zero, or
hold null or non-finite components, take no part; vectors of another length than
the query's are not comparable and not returned; rows with the query's id are
the query itself; repeated ids are candidates once, at their best score; ties go
to the smaller id; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuecards.llm import textvec as tv
from cuecards.llm.common import stage

_FOUND = "query long, vec long, score double"


def usable(col: str) -> Column:
    """Whether a vector column can be compared."""
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(col, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> list[np.ndarray]:
    """The vectors of a list column; all of them one matrix if of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    sizes = np.diff(column.offsets.to_numpy() - column.offsets[0].as_py())
    if len(sizes) and (sizes == sizes[0]).all():
        return list(flat.reshape(len(sizes), sizes[0]))
    return np.split(flat, np.cumsum(sizes)[:-1])


class Family:
    """The hash functions for vectors of ``dim`` components."""

    def __init__(self, dim: int, tables: int, m: int, width: float, seed: int = 5):
        rng = np.random.default_rng([seed, dim, tables, m])
        self.a = rng.standard_normal((dim, tables * m)) / width
        self.b = rng.random(tables * m)
        self.mul = tv.constants(m, 31) | np.uint64(1)
        self.add = tv.constants(tables, 32) + np.uint64(dim)
        self.shape = (tables, m)

    def places(self, x: np.ndarray) -> np.ndarray:
        """Projections in slots, ``(rows, tables, m)``."""
        unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
        return (unit @ self.a + self.b).reshape(-1, *self.shape)

    def keys(self, codes: np.ndarray, table: int | None = None) -> np.ndarray:
        """Bucket keys of slot numbers (last axis: the m projections)."""
        add = self.add if table is None else self.add[table]
        return tv.mix((codes.astype(np.int64).view(np.uint64) * self.mul).sum(axis=-1, dtype=np.uint64) + add)


_STEP = np.arange(-8, 8.0005, 0.001)
_NORMAL = 0.5 * (1 + np.vectorize(math.erf)(_STEP / math.sqrt(2)))


def perturbations(place: np.ndarray, spread: float, success: float, most: int = 1 << 14) -> np.ndarray:
    """Slot numbers of the buckets to visit for one table, in falling order of
    estimated success, until it adds up to ``success``.  ``spread``: standard
    deviation of a neighbour's projection, in slots.  Combinations too unlikely
    to be reached among ``most`` are not built."""
    home = np.floor(place)
    reach = max(1, math.ceil(3 * spread))
    steps = np.arange(-reach, reach + 1)
    edge = (home + steps[0] - place)[:, None] + np.arange(len(steps) + 1)
    mass = np.diff(np.interp(edge / spread, _STEP, _NORMAL), axis=1)
    prob, combo = np.ones(1), np.zeros((1, 0), np.int64)
    for j in range(len(place)):
        p = (prob[:, None] * mass[j]).ravel()
        if len(p) > most:
            keep = np.argpartition(-p, most)[:most]
        else:
            keep = np.arange(len(p))
        keep = keep[p[keep] > 1e-9]
        combo = np.concatenate([combo[keep // len(steps)], steps[keep % len(steps)][:, None]], axis=1)
        prob = p[keep]
    order = np.argsort(-prob, kind="stable")
    upto = int(np.searchsorted(np.cumsum(prob[order]), success)) + 1
    return home.astype(np.int64) + combo[order[:upto]]


def covered(place: np.ndarray, codes: np.ndarray, spread: float) -> float:
    """Probability that a neighbour whose projections have this standard
    deviation, in slots, lies in one of the distinct buckets ``codes``."""
    steps = codes - np.floor(place).astype(np.int64)
    low = int(steps.min())
    edge = (np.floor(place) + low - place)[:, None] + np.arange(int(steps.max()) - low + 2)
    mass = np.diff(np.interp(edge / spread, _STEP, _NORMAL), axis=1)
    return float(mass[np.arange(len(place)), steps - low].prod(axis=1).sum())


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of all pairs; each pair's sum runs in the same order wherever it stands."""
    dots = np.einsum("ij,kj->ik", q, x)
    return dots / (np.sqrt(np.einsum("ij,ij->i", q, q))[:, None] * np.sqrt(np.einsum("ij,ij->i", x, x)))


def _best(q_ids, q, x_ids, x, k: int) -> Iterator[pa.RecordBatch]:
    """The k best of ``x`` for each query, ties to the smaller id."""
    order = np.argsort(x_ids, kind="stable")
    x_ids, x = x_ids[order], x[order]
    for i in range(0, len(q), 256):
        ids, score = q_ids[i: i + 256], cosines(q[i: i + 256], x)
        score[ids[:, None] == x_ids] = -np.inf
        rows, cols = [], []
        for r in range(len(ids)):
            s = score[r]
            pick = np.arange(len(s))
            if len(s) > k:
                least = np.partition(s, len(s) - k)[len(s) - k]
                pick = np.flatnonzero(s >= least)
            pick = pick[np.argsort(-s[pick], kind="stable")]  # ids already ascend
            # a repeated id takes one place
            _, first = np.unique(x_ids[pick], return_index=True)
            pick = pick[np.sort(first)][:k]
            pick = pick[s[pick] > -np.inf]
            rows.append(np.full(len(pick), r))
            cols.append(pick)
        rows, cols = np.concatenate(rows), np.concatenate(cols)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[rows]), pa.array(x_ids[cols]), pa.array(score[rows, cols])], ["query", "vec", "score"])


def _bucket_scorer(k: int):
    """``mapInArrow`` over rows sorted by (key, part, is_query): members of a
    part are held (bounded), queries stream past them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, rows = None, [], []
        for batch in batches:
            keys = list(zip(batch.column("key").to_pylist(), batch.column("part").to_pylist(),
                            batch.column("dim").to_pylist(), strict=True))
            vec, is_query = batch.column("vec").to_numpy(), batch.column("is_query").to_pylist()
            data = _matrix(batch.column("data"))
            i, n = 0, len(keys)
            while i < n:
                if keys[i] != group:
                    group, ids, rows = keys[i], [], []
                j = i
                while j < n and keys[j] == keys[i] and is_query[j] == is_query[i]:
                    j += 1
                if not is_query[i]:
                    ids.append(vec[i:j])
                    rows.append(np.array(data[i:j]))
                elif rows:
                    if len(rows) > 1:
                        ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                    yield from _best(vec[i:j], np.array(data[i:j]), ids[0], rows[0], k)
                i = j
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query", "vec").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
            tables: int = 4, success: float = 0.5, part: int = 4096, sample: int = 20_000,
            rows_per_bucket: int = 1024) -> DataFrame:
    """``query, rank, vec, score``: the ``k`` nearest found by cosine for each
    row that ``is_query`` selects, among all other rows."""
    spark = vectors.sparkSession
    rows = stage(vectors.where(is_query.isNotNull() & F.col(id_col).isNotNull() & usable(vector_col)).select(
        F.col(id_col).cast("long").alias("vec"), F.col(vector_col).alias("data"),
        F.size(vector_col).alias("dim"), is_query.alias("is_query")), "ann-rows")
    total = rows.count()
    none = spark.createDataFrame([], "query long, rank int, vec long, score double")
    if total < 2:
        return none
    radius = _neighbour_distance(rows, total, k, sample)
    width = 1.8 * radius
    # a projection of unit vectors has about the differential entropy of a normal, less the slot's bits
    bits = max(0.3, 0.5 * math.log2(2 * math.pi * math.e) - math.log2(width))
    m = max(1, round(math.log2(max(2, total / rows_per_bucket)) / bits))

    def families():
        made: dict[int, Family] = {}

        def get(dim: int) -> Family:
            if dim not in made:
                made[dim] = Family(dim, tables, m, width)
            return made[dim]
        return get

    def by_dim(batch):
        dims = batch.column("dim").to_numpy()
        data = _matrix(batch.column("data"))
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            yield int(dim), at, np.array([data[i] for i in at])

    def hash_rows(batches):
        get = families()
        for batch in batches:
            for dim, at, x in by_dim(batch):
                keys = get(dim).keys(np.floor(get(dim).places(x)))  # (rows, tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column("vec").to_numpy()[at], tables)),
                     pa.array(keys.reshape(-1).view(np.int64))], ["vec", "key"])

    def probe(batches):
        get = families()
        for batch in batches:
            for dim, at, x in by_dim(batch):
                ids, place = batch.column("vec").to_numpy()[at], get(dim).places(x)
                for i in range(len(at)):
                    keys = np.concatenate([get(dim).keys(perturbations(place[i, t], radius / width, success), t)
                                           for t in range(tables)])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), ids[i])),
                                                      pa.array(keys.view(np.int64))], ["vec", "key"])

    hashed = stage(rows.select("vec", "data", "dim").mapInArrow(hash_rows, "vec long, key long"), "ann-keys")
    buckets = stage(hashed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / part).alias("parts")), "ann-buckets")
    queries = rows.where("is_query").select("vec", "data", "dim")
    probes = stage(queries.mapInArrow(probe, "vec long, key long").join(buckets, "key"), "ann-probes")
    data = rows.select("vec", "data", "dim").dropDuplicates(["vec", "data"])
    members = (hashed.distinct().join(buckets, "key")
               .withColumn("part", F.pmod(F.xxhash64("vec"), F.col("parts"))).select("vec", "key", "part")
               .join(data, "vec").withColumn("is_query", F.lit(0)))
    visits = (probes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
              .select("vec", "key", "part").distinct()
              .join(queries.dropDuplicates(["vec"]), "vec").withColumn("is_query", F.lit(1)))
    groups = (members.unionByName(visits).repartition("key", "part")
              .sortWithinPartitions("key", "part", "dim", "is_query"))
    found = stage(_top(groups.mapInArrow(_bucket_scorer(k), _FOUND), k), "ann-found")

    def judge(batches):
        get = families()
        for batch in batches:
            far_of = batch.column("far").to_pylist()
            for dim, at, x in by_dim(batch):
                ids, place = batch.column("vec").to_numpy()[at], get(dim).places(x)
                held = np.zeros(len(at))
                for i in range(len(at)):
                    spreads = np.maximum(far_of[at[i]], 1e-3) / width
                    missed = np.ones(len(spreads))
                    for t in range(tables):
                        codes = perturbations(place[i, t], radius / width, success)
                        missed *= [1 - covered(place[i, t], codes, s) for s in spreads]
                    held[i] = 1 - missed.mean()
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(held)], ["vec", "held"])

    far = F.sqrt(F.greatest(2 - 2 * F.col("score"), F.lit(0.0)))
    full = (found.groupBy("query").agg(F.collect_list(far).alias("far"))  # at most k
            .where(F.size("far") >= min(k, total - 1)).withColumnRenamed("query", "vec"))
    judged = queries.dropDuplicates(["vec"]).join(full, "vec").mapInArrow(judge, "vec long, held double")
    enough = stage(judged, "ann-judged").where(F.col("held") >= 1 - (1 - success) ** tables).select("vec")
    short = queries.dropDuplicates(["vec"]).join(enough, "vec", "left_anti")
    found = found.unionByName(_top(_exhaustive(short, rows, k), k))
    return (_top(found.select("query", "vec", "score"), k)
            .select("query", "rank", "vec", "score"))


def _neighbour_distance(rows: DataFrame, total: int, k: int, sample: int) -> float:
    """Median distance of the k-th neighbour of 200 vectors in a bounded sample."""
    taken = rows.where(F.pmod(F.xxhash64("vec"), F.lit(max(1, -(-total // sample)))) == 0).limit(2 * sample)
    got = taken.select("data", "dim").toPandas()
    dim = int(got["dim"].mode()[0]) if len(got) else 0
    x = np.array([v for v, d in zip(got["data"], got["dim"], strict=True) if d == dim], np.float64)
    if len(x) <= k:
        return 1.0
    sims = np.sort(cosines(x[:200], x), axis=1)[:, -(k + 1)]
    return float(np.sqrt(np.maximum(2 - 2 * np.median(sims), 0.01)))


def _exhaustive(short: DataFrame, rows: DataFrame, k: int, block: int = 4096) -> DataFrame:
    """Exact search of ``short`` queries, a bounded block at a time, against all rows."""
    spark = rows.sparkSession
    short = stage(short, "ann-short")
    out = spark.createDataFrame([], _FOUND)
    blocks = -(-short.count() // block)
    for b in range(blocks):
        mine = short.where(F.pmod(F.xxhash64("vec"), F.lit(blocks)) == b).toPandas()
        held = spark.sparkContext.broadcast([(d, g["vec"].to_numpy(np.int64), np.array(g["data"].tolist(), np.float64))
                                             for d, g in mine.groupby("dim")])

        def scan(batches, held=held):
            for batch in batches:
                dims, vec, data = batch.column("dim").to_numpy(), batch.column("vec").to_numpy(), _matrix(batch.column("data"))
                for d, q_ids, q in held.value:
                    at = np.flatnonzero(dims == d)
                    if len(at):
                        yield from _best(q_ids, q, vec[at], np.array([data[i] for i in at]), k)

        out = out.unionByName(rows.select("vec", "data", "dim").mapInArrow(scan, _FOUND))
    return out
