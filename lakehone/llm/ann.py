"""Approximate nearest neighbours: inverted lists scanned in blocks of rotated dimensions, candidates abandoned early."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Lists at most, vectors that their centres are fitted on (EACH for a list) at most, those of them that bound a query's distances (of all vectors, SHARE) at most, and queries that the number of probed lists is measured on at most.
LISTS, FIT, EACH, BOUND, SHARE, MEASURED = 16_384, 65_536, 32, 16_384, 0.25, 64
#: Vectors of one part of a list, queries of one part of a list's queries, dimensions of one block.
CHUNK, QUERIES, DIMS = 8192, 4096, 16
#: Queries that a task looks at together.
TOGETHER = 64
#: Strength of the hypothesis test: candidates go if the distance so far, scaled up, is beyond the bound by this many deviations.
EPSILON = 2.1
#: Share of true neighbours that the measured queries must find.
RECALL = 0.97


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (array of float or double) of vectors without null or non-finite components that are not zero; of the commonest length only."""
    # Floats stay floats, half as wide to move; all sums are of doubles.
    single = df.schema[vec_col].dataType.simpleString() == "array<float>"
    vec = F.col(vec_col).cast("array<float>" if single else "array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where("id is not null and vec is not null and size(vec) > 0")
    rows = rows.where(~F.exists("vec", bad) & F.exists("vec", lambda x: x != 0))
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (common.d if common else 0))


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def centres(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """k-means over distinct vectors."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    c = x[rng.permutation(len(x))[: min(k, len(x))]]
    for _ in range(rounds):
        own = nearest(x, c)
        n = np.bincount(own, minlength=len(c))
        s = np.zeros_like(c)
        np.add.at(s, own, x)
        c = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = (c**2).sum(1) / 2
    step = max(1, (1 << 22) // max(1, len(c)))
    for at in range(0, len(x), step):
        out[at : at + step] = (half - x[at : at + step] @ c.T).argmin(1)
    return out


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal vectors get equal ones, wherever they stand."""
    return (np.ascontiguousarray(x) * q).sum(1)


def best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids, largest first."""
    if len(score) > 4 * k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        keep = np.flatnonzero(score >= cut)
        return keep[np.lexsort((ids[keep], -score[keep]))[:k]]
    return np.lexsort((ids, -score))[:k]


class Index:
    """Lists by centre over vectors that get one more dimension, so that the largest inner product is the least distance.

    x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give |q' - x'|^2 = |q|^2 + M^2 - 2 q.x; both are then rotated at random, so that
    each block of dimensions is a fair sample of the distance.
    """

    def __init__(self, rows: DataFrame, seed: int = 5):
        self.rows = rows
        norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
        got = rows.agg(F.count("*").alias("n"), F.max(norm).alias("m"), F.max(F.size("vec")).alias("d")).first()
        self.n, self.most, self.d = got.n, got.m or 0.0, got.d or 0
        rng = np.random.default_rng(seed)
        self.turn = np.linalg.qr(rng.normal(size=(self.d + 1, self.d + 1)))[0] if self.n else np.zeros((1, 1))
        self.lists = max(1, min(LISTS, round(math.sqrt(self.n))))
        # An id counts once, so that the k-th nearest of these is no nearer than the k-th nearest id.
        fit = rows.orderBy(F.xxhash64("id"), "id", "vec").limit(min(FIT, max(4096, EACH * self.lists))).toPandas().drop_duplicates("id")
        bound = min(BOUND, math.ceil(SHARE * self.n))
        self.fit_ids = fit.id.to_numpy(np.int64)[:bound]
        fit = np.stack(fit.vec.to_numpy()).astype(float) if len(fit) else np.zeros((0, self.d))
        self.fit = fit[:bound]
        self.centres = centres(self.lift(fit), self.lists) if len(fit) else np.zeros((1, self.d + 1))
        self.fit_lists = nearest(self.lift(self.fit), self.centres)

    def lift(self, x: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.most - (x**2).sum(1), 0))
        return np.concatenate([x, more[:, None]], 1) @ self.turn

    def lift_queries(self, q: np.ndarray) -> np.ndarray:
        return np.concatenate([q, np.zeros((len(q), 1))], 1) @ self.turn

    def assigned(self) -> DataFrame:
        """id, vec, list: every row in its list."""
        shared = self.rows.sparkSession.sparkContext.broadcast((self.turn, self.most, self.centres))

        def run(batches):
            turn, most, c = shared.value
            for batch in batches:
                x = matrix(batch.column(1))
                x = np.concatenate([x, np.sqrt(np.maximum(most - (x**2).sum(1), 0))[:, None]], 1) @ turn
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nearest(x, c).astype(np.int32))], ["id", "vec", "list"])

        rows = materialize(self.rows.mapInArrow(run, f"id long, vec {self.rows.schema['vec'].dataType.simpleString()}, list int"), "assigned")
        # One row for each list, LISTS at most.
        held = rows.groupBy("list").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids")).collect()
        self.sizes, self.ids = {r.list: r.n for r in held}, {r.list: r.ids for r in held}
        return rows

    def probes(self, assigned: DataFrame, queries: DataFrame, k: int) -> int:
        """The number of lists to probe: measured on at most MEASURED queries, whose neighbours are found among all rows."""
        some = queries.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(MEASURED).toPandas()
        if not len(some):
            return 1
        ids, q = some.id.to_numpy(np.int64), np.stack(some.vec.to_numpy()).astype(float)

        def run(batches):
            held = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32)) for _ in ids]
            for batch in batches:
                x, own, lists = matrix(batch.column(1)), batch.column(0).to_numpy(), batch.column(2).to_numpy()
                for i, row in enumerate((x @ q.T).T if len(x) else ()):
                    ok = own != ids[i]
                    a, b, c = (np.concatenate(z) for z in zip(held[i], (own[ok], row[ok], lists[ok])))
                    keep = best(a, b, k)
                    held[i] = a[keep], b[keep], c[keep]
            for i, (a, b, c) in enumerate(held):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), i)), pa.array(a), pa.array(b), pa.array(c)], ["i", "id", "score", "list"])

        found = assigned.select("id", "vec", "list").mapInArrow(run, "i long, id long, score double, list int")
        top = found.withColumn("r", F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k).select("i", "list").toPandas()
        order = np.argsort(self.far(q), 1)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None], 1)
        at = np.sort(rank[top.i.to_numpy(np.int64), top.list.to_numpy(np.int64)])
        return int(at[min(len(at) - 1, math.ceil(RECALL * len(at)))]) + 1 if len(at) else 1

    def far(self, q: np.ndarray) -> np.ndarray:
        return (self.centres**2).sum(1)[None] - 2 * self.lift_queries(q) @ self.centres.T


def scan(q: np.ndarray, limit: np.ndarray, own: np.ndarray, qv: np.ndarray, ids: np.ndarray, x: np.ndarray, xv: np.ndarray, k: int):
    """The k nearest ids of each query among x (rotated; xv: as they are), abandoning candidates block by block.

    After j of D dimensions a candidate stays if its partial distance is at most limit * j / D * (1 + EPSILON / sqrt(j))^2.
    The first block is one product of matrices for all queries, the others look at what is left of each.
    """
    d = x.shape[1]
    again = len(np.unique(ids)) < len(ids)
    out = []

    def allowed(end: int) -> float:
        return 1.0 if end == d else end / d * (1 + EPSILON / math.sqrt(end)) ** 2

    first = min(d, DIMS)
    norm = (x[:, :first] ** 2).sum(1)
    for low in range(0, len(q), TOGETHER):
        near = q[low : low + TOGETHER, :first]
        start = norm[None] + (near**2).sum(1)[:, None] - 2 * near @ x[:, :first].T
        stay = start <= (limit[low : low + TOGETHER] * allowed(first) * (1 + 1e-9) + 1e-9)[:, None]
        for i in range(low, min(low + TOGETHER, len(q))):
            alive = np.flatnonzero(stay[i - low])
            part, bound = start[i - low, alive], limit[i]
            for at in range(first, d, DIMS):
                if not len(alive):
                    break
                end = min(d, at + DIMS)
                part = part + ((x[alive, at:end] - q[i, at:end]) ** 2).sum(1)
                keep = part <= bound * allowed(end) * (1 + 1e-9) + 1e-9
                alive, part = alive[keep], part[keep]
            alive = alive[ids[alive] != own[i]]
            if len(alive):
                s = scores(xv[alive], qv[i])
                if again:
                    order = np.lexsort((ids[alive], -s))
                    alive, s = alive[order], s[order]
                    once = np.sort(np.unique(ids[alive], return_index=True)[1])
                    alive, s = alive[once], s[once]
                keep = best(ids[alive], s, k)
                out.append((np.full(len(keep), own[i]), ids[alive][keep], s[keep]))
    return out


def search(df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", probes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of df with the largest inner product for each query, its own row aside.

    Every row is in the list of its nearest centre.  A query looks at the lists nearest to it, as many as MEASURED queries need to find RECALL
    of their true neighbours; in a list, vectors are compared block by block of rotated dimensions and abandoned as soon as their partial
    distance says that they are not among the k nearest.  How near that is, is bounded by the k-th of a sample's vectors in the same lists.

    Ties go to the smaller id.  Null vectors, zero vectors, those with null or non-finite components, without id, or of another
    length than most take no part.  Of rows with the same id the smallest vector is the query, and a result names an id once.
    An empty table gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    rows = materialize(usable(df, id_col, vec_col), "vectors")
    asked = usable(queries, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec"))
    index = Index(rows)
    empty = "query_id long, rank int, vec_id long, score double"
    if not index.n:
        return spark.createDataFrame([], empty)
    asked = materialize(asked.where(F.size("vec") == index.d), "queries")
    assigned = index.assigned()
    probes = min(probes or index.probes(assigned, asked, k), len(index.centres))
    sizes = np.zeros(len(index.centres), np.int64)
    for l, n in index.ids.items():
        sizes[l] = n
    shared = spark.sparkContext.broadcast((index.turn, index.most, index.centres, index.fit, index.fit_ids, index.fit_lists, sizes))
    vec = asked.schema["vec"].dataType.simpleString()

    def routes(part: pa.RecordBatch):
        """Of some queries: vectors, ids, the lists that each looks at, and its products with the vectors of the sample that are in them."""
        turn, _, c, fit, fit_ids, fit_lists, sizes = shared.value
        q, own = matrix(part.column(1)), part.column(0).to_numpy()
        turned = np.concatenate([q, np.zeros((len(q), 1))], 1) @ turn
        order = np.argsort((c**2).sum(1)[None] - 2 * turned @ c.T, 1, kind="stable")
        # As many lists as were measured, and more while they hold too few ids.
        before = np.cumsum(sizes[order], 1) - sizes[order]
        taken = (np.arange(order.shape[1])[None] < probes) | (before <= 2 * k)
        looked = np.zeros(order.shape, bool)
        np.put_along_axis(looked, order, taken & (sizes[order] > 0), 1)
        s = q @ fit.T
        s[(own[:, None] == fit_ids[None]) | ~looked[:, fit_lists]] = -np.inf
        return q, own, looked, s

    def route(batches):
        """Each query with its lists, and a bound on its k-th distance in them."""
        most = shared.value[1]
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                q, _, looked, s = routes(part)
                kth = np.partition(s, s.shape[1] - k, 1)[:, s.shape[1] - k] if s.shape[1] > k else np.full(len(q), -np.inf)
                limit = (q**2).sum(1) + most - 2 * kth
                rows_, l = np.nonzero(looked)
                yield pa.RecordBatch.from_arrays([*(col.take(pa.array(rows_)) for col in part.columns), pa.array(limit[rows_]), pa.array(l.astype(np.int32))], ["id", "vec", "limit", "list"])

    def known(batches):
        """Those that bound a query's distances have their products already, so that k are found whatever is abandoned."""
        *_, fit, fit_ids, _, _ = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                q, own, _, s = routes(batch.slice(at, TOGETHER))
                out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
                for i in range(len(q)):
                    near = np.flatnonzero(s[i] > -np.inf)
                    near = near[np.argsort(-s[i, near], kind="stable")[:k]]
                    out.append((np.full(len(near), own[i]), fit_ids[near], scores(fit[near], q[i])))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "vec_id", "score"])

    routed = asked.select("id", "vec").mapInArrow(route, f"id long, vec {vec}, limit double, list int")
    # A list of any size meets queries of any number in parts: its vectors go out once for each part of its own queries, and the other way round.
    many = routed.groupBy("list").count().collect()
    parts = spark.createDataFrame([(r.list, -(-index.sizes[r.list] // CHUNK), -(-r["count"] // QUERIES)) for r in many], "list int, parts int, q_parts int")
    parts = F.broadcast(parts)
    dealt = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = routed.join(parts, "list").withColumn("q_part", dealt("q_parts", 1)).withColumn("part", copies("parts")).drop("parts", "q_parts")
    right = assigned.join(parts, "list").withColumn("part", dealt("parts", 2)).withColumn("q_part", copies("q_parts")).drop("parts", "q_parts")
    key = ["list", "part", "q_part"]

    def meet(q: pa.Table, x: pa.Table) -> pa.Table:
        turn, most, *_ = shared.value
        out = []
        if q.num_rows and x.num_rows:
            qv, xv = matrix(q["vec"]), matrix(x["vec"])
            turned = np.concatenate([qv, np.zeros((len(qv), 1))], 1) @ turn
            lifted = np.concatenate([xv, np.sqrt(np.maximum(most - (xv**2).sum(1), 0))[:, None]], 1) @ turn
            out = scan(turned, q["limit"].to_numpy(), q["id"].to_numpy(), qv, x["id"].to_numpy(), lifted, xv, k)
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, "query_id long, vec_id long, score double")
    found = found.union(asked.select("id", "vec").mapInArrow(known, "query_id long, vec_id long, score double"))
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
