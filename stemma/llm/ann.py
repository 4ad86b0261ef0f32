"""Approximate nearest neighbours by inner product: lists around k-means centres, and an adaptive dimension scan within
each probed list.

With M the largest length of a vector, x becomes (x, sqrt(M^2 - |x|^2)) and a query (q, 0): the nearest by distance are
then the largest by inner product. The longer vectors are rotated by a random orthogonal matrix and kept in column
blocks. A query scans a list block by block; after t of the D dimensions the distance so far, times D / t, estimates the
whole, and candidates for which the hypothesis "it's among the nearest k" is rejected (the estimate exceeds the present
k-th distance by a factor of 1 + EPSILON / sqrt(t)) are abandoned. What is left is scored exactly, in double precision,
on the original vectors; equal scores go to the smaller vec_id.

The centres are fitted on a bounded sample (SAMPLE vectors, by a hash of their id); every vector is indexed. Lists are
dealt over cells of bounded size, vectors as well as queries, so a list that holds a third of all vectors is many tasks.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without
vec_id, nor vectors of another length than most have (ties: the shorter); of repeated query ids one vector is searched
(the smallest in array order) and no row of that id is its candidate; repeated candidates count each; fewer candidates
than k: all are returned if all lists are probed, and small tables (under 1,000 vectors) have one list. Extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

K = 20
SAMPLE = 12_000
#: The most lists; up to there half the square root of the number of vectors.
MOST_LISTS = 4096
#: Lists are probed as far as this share of the neighbours within the sample lies (TRIALS sample queries, brute force).
#: Neighbours among all vectors are nearer than those within the sample, so the share found is rather higher.
REACH, TRIALS = 0.97, 256
BLOCK = 16
EPSILON = 2.1
VECTORS, QUERIES = 8192, 4096
#: Slack for rounding where squared distances are compared.
TINY = 1e-9
SEED = 5


def valid(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (array of doubles) of the rows that take part, all of one length."""
    e = embeddings.select(embeddings["vec_id"].cast("bigint").alias("vec_id"), embeddings["embedding"].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    e = e.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))
    sizes = e.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return e.where(F.size("v") == (sizes.n if sizes else 0))


def centres(sample: np.ndarray, n: int, rounds: int = 10) -> np.ndarray:
    """k-means by Lloyd's rounds; an empty centre keeps its place."""
    r = np.random.default_rng(SEED)
    distinct = np.unique(sample, axis=0)
    c = distinct[r.permutation(len(distinct))[:n]]
    for _ in range(rounds):
        near = ((c * c).sum(1) - 2 * sample @ c.T).argmin(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, sample)
        count = np.bincount(near, minlength=len(c))
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c)
    return c


def calibrated(sample: np.ndarray, most: float, turn: np.ndarray, mid: np.ndarray, k: int) -> int:
    """How many of the nearest lists hold REACH of the k nearest vectors, measured within the sample."""
    x = longer(sample, most, False) @ turn
    owner = ((mid * mid).sum(1) - 2 * x @ mid.T).argmin(1)
    ask = sample[:: max(1, len(sample) // TRIALS)][:TRIALS]
    at = np.arange(len(sample))[:: max(1, len(sample) // TRIALS)][:TRIALS]
    score = ask @ sample.T
    score[np.arange(len(ask)), at] = -np.inf
    top = np.argsort(-score, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    far = (mid * mid).sum(1) - 2 * (longer(ask, most, True) @ turn) @ mid.T
    place = np.argsort(np.argsort(far, axis=1, kind="stable"), axis=1, kind="stable")
    ranks = np.take_along_axis(place, owner[top], axis=1).ravel()
    return int(np.quantile(ranks, REACH, method="higher")) + 1 if len(ranks) else 1


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def longer(x: np.ndarray, most: float, query: bool) -> np.ndarray:
    rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, most - (x * x).sum(1)))
    return np.concatenate([x, rest[:, None]], 1)


def scan(queries: np.ndarray, bounds: np.ndarray, allowed, z: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each query (lengthened, rotated) the places of the vectors z that may be among its k nearest. bounds: squared
    distances beyond which nothing is wanted (inf: not known yet); allowed(i): mask of the vectors that query i probes."""
    d = z.shape[1]
    cuts = [slice(at, min(at + BLOCK, d)) for at in range(0, d, BLOCK)]
    blocks = [np.ascontiguousarray(z[:, c]) for c in cuts]
    norms = [(b * b).sum(1) for b in blocks]

    def part(n: int, at, q: np.ndarray) -> np.ndarray:
        b = blocks[n] if at is None else blocks[n][at]
        return (norms[n] if at is None else norms[n][at]) - 2 * b @ q[cuts[n]] + q[cuts[n]] @ q[cuts[n]]

    for lo in range(0, len(queries), 128):
        some = queries[lo : lo + 128]
        first = norms[0] - 2 * some[:, cuts[0]] @ blocks[0].T + (some[:, cuts[0]] ** 2).sum(1)[:, None]
        for i, q in enumerate(some):
            ok, bound = allowed(lo + i), bounds[lo + i]
            if not np.isfinite(bound):
                start = np.flatnonzero(ok)[: 4 * k]
                whole = ((z[start] - q) ** 2).sum(1)
                bound = np.partition(whole, k - 1)[k - 1] if len(whole) >= k else np.inf
            t = cuts[0].stop
            limit = lambda t, d=d, bound=bound: bound * (1 + (0 if t == d else EPSILON / np.sqrt(t))) ** 2 * t / d + TINY
            left = np.flatnonzero(ok & (first[i] <= limit(t)))
            sofar = first[i][left]
            for n in range(1, len(blocks)):
                sofar = sofar + part(n, left, q)
                t = cuts[n].stop
                keep = sofar <= limit(t)
                left, sofar = left[keep], sofar[keep]
            if len(left) > k:  # by the distances, which rounding may put apart from the scores: equal ones stay
                left = left[sofar <= np.partition(sofar, k - 1)[k - 1] + TINY]
            yield left


def search(embeddings: DataFrame, is_query=None, k: int = K, lists: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query."""
    spark = embeddings.sparkSession
    is_query = F.col("vec_id") % 20 == 0 if is_query is None else is_query
    e = valid(embeddings)
    whole = e.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("most"), F.max(F.size("v")).alias("d")).first()
    if not whole.n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    most, d = whole.most, whole.d
    sample = matrix(e.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).select("v").toArrow().column("v"))
    turn = rotation(d + 1)
    mid = centres(longer(sample, most, False) @ turn, lists or (1 if whole.n < 1000 else min(MOST_LISTS, round(whole.n**0.5 / 2))))
    probes = calibrated(sample, most, turn, mid, k)
    near_first = max(1, probes // 10)
    squares = (mid * mid).sum(1)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = longer(matrix(b.column("v")), most, False) @ turn
                yield pa.record_batch({"list": pa.array((squares - 2 * x @ mid.T).argmin(1).astype(np.int32)), "vec_id": b.column("vec_id"), "v": b.column("v")})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                x = longer(matrix(part.column("v")), most, True) @ turn
                lists = np.argsort(squares - 2 * x @ mid.T, axis=1, kind="stable")[:, :probes].astype(np.int32)
                yield pa.record_batch({"vec_id": part.column("vec_id"), "v": part.column("v"), "lists": pa.array(lists.tolist(), pa.list_(pa.int32()))})

    held = cut(e.mapInArrow(index, "list int, vec_id bigint, v array<double>"))
    asked = cut(e.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).mapInArrow(route, "vec_id bigint, v array<double>, lists array<int>"))
    # Short lists share a cell of about VECTORS vectors, long ones are dealt over several; the plan has a row for each list.
    plan, cell, room = [], -1, 0
    for name, size in sorted((r[0], r[1]) for r in held.groupBy("list").count().collect()):
        if size > VECTORS or size > room:
            cell, room = cell + 1, VECTORS
        plan.append((name, cell, max(1, -(-size // VECTORS))))
        room = 0 if size > VECTORS else room - size
    plan = F.broadcast(spark.createDataFrame(plan, "list int, cell int, chunks int"))
    held = held.join(plan, "list").withColumn("chunk", F.pmod(F.hash("vec_id", "v"), F.col("chunks")))

    def nearest(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found: tuple = ([], [], [])
        if vectors.num_rows and queries.num_rows:
            order = np.argsort(vectors.column("vec_id").to_numpy(), kind="stable")
            x, ids = matrix(vectors.column("v"))[order], vectors.column("vec_id").to_numpy()[order]
            owners, owner = np.unique(vectors.column("list").to_numpy()[order], return_inverse=True)
            wanted = [np.isin(owners, w) for w in queries.column("lists").to_pylist()]
            q, me, least = matrix(queries.column("v")), queries.column("vec_id").to_numpy(), queries.column("least").to_numpy()
            allowed = lambda i: wanted[i][owner] & (ids != me[i])
            bounds = np.where(np.isnan(least), np.inf, (q * q).sum(1) + most - 2 * least)
            for i, at in enumerate(scan(longer(q, most, True) @ turn, np.maximum(bounds, 0), allowed, longer(x, most, False) @ turn, k)):
                s = (x[at] * q[i]).sum(1)
                best = np.lexsort((ids[at], -s))[:k]
                best = best[~(s[best] < least[i])]
                found[0].append(np.full(len(best), me[i]))
                found[1].append(ids[at][best])
                found[2].append(s[best])
        one = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table({"query_id": one(found[0], pa.int64()), "vec_id": one(found[1], pa.int64()), "score": one(found[2], pa.float64())})

    def probed(queries: DataFrame) -> DataFrame:
        """Candidates of queries (vec_id, v, lists, least): each query goes once to each cell that holds a list of its."""
        q = queries.withColumn("list", F.explode("lists")).join(plan, "list").groupBy("vec_id", "cell").agg(F.min("v").alias("v"), F.min("least").alias("least"), F.collect_list("list").alias("lists"), F.max("chunks").alias("chunks"))
        parts = q.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("qs"))
        q = q.join(parts, "cell").withColumn("qc", F.pmod(F.hash("vec_id", F.lit(2)), F.col("qs"))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        x = held.join(parts, "cell").withColumn("qc", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)))
        by, other = ["cell", "chunk", "qc"], ["q_cell", "q_chunk", "q_qc"]
        x = x.select(*by, "list", "vec_id", "v")
        q = q.select(*[F.col(c).alias(n) for c, n in zip(by, other, strict=True)], "vec_id", "v", "lists", "least")
        return x.groupBy(by).cogroup(q.groupBy(other)).applyInArrow(nearest, "query_id bigint, vec_id bigint, score double")

    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    # The nearest lists first: their k-th score is the least that any other list has to offer.
    near = cut(ranked(probed(asked.withColumns({"lists": F.slice("lists", 1, near_first), "least": F.lit(float("nan"))}))))
    if probes > near_first:
        least = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
        far = asked.withColumn("lists", F.slice("lists", near_first + 1, probes)).join(least, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(float("nan"))))
        near = cut(ranked(near.select("query_id", "vec_id", "score").unionByName(probed(far))))
    if probes < len(mid) and whole.n > k:  # a query whose lists hold fewer than k vectors goes to all lists
        full = near.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"))
        short = cut(asked.join(full, "vec_id", "left_anti"))
        if not short.isEmpty():
            every = short.withColumns({"lists": F.sequence(F.lit(0), F.lit(len(mid) - 1)), "least": F.lit(float("nan"))})
            again = ranked(probed(every))
            near = near.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select("query_id", "rank", "vec_id", "score").unionByName(again.select("query_id", "rank", "vec_id", "score"))
    return near.select("query_id", "rank", "vec_id", "score")


def op9_ann(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
