"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are one point, so that copies cannot wall a graph in; a point keeps its k + 1
smallest ids, more cannot reach a result. Points are dealt to shards of about ``SHARD`` by a
hash. A shard's graph has levels; a point's highest level is drawn from a hash of its id. On
each level a point is linked to near points that are not nearer to one already linked, and
back. The links are flat arrays, one row of neighbour numbers per point and level, stored in a
table with the vectors. As a shard is small, the candidates of its links are found by distance
blocks instead of searches in the growing graph, so a graph does not depend on the order of
insertion. Queries go in bounded rounds to the stored graphs, which do not move: each shard is
searched from its top level down, a task merges the results of its shards, and those are merged.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows without an id; a repeated id counts once, with its smallest vector; only
vectors of the same length are compared; fewer candidates than k give fewer rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roostline.llm.common import bounded_batches, mixed, table, written
from roostline.session import remove_scratch, scratch_dir

K = 10
SHARD = 4096
LINKS = 16
CANDIDATES = 64
BREADTH = 96
UPPER_BREADTH = 8
# Queries of one round, and the most bytes of their vectors, which are sent to all tasks.
QUERIES_AT_ONCE = 4096
QUERY_BYTES = 32 << 20


def levels_of(ids: np.ndarray) -> np.ndarray:
    """The highest level of each point, geometric, from a hash of its id."""
    draw = (mixed(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(float)
    return np.minimum((-np.log((draw + 1) / 2.0**53) / math.log(LINKS)).astype(np.int64), 12)


def link_level(vectors: np.ndarray, width: int) -> np.ndarray:
    """Neighbour numbers of the points of one level, padded with -1."""
    n = len(vectors)
    squares = (vectors**2).sum(axis=1)
    take = min(CANDIDATES, n - 1)
    pairs = []
    for start in range(0, n if n > 1 else 0, 256):
        own = np.arange(start, min(n, start + 256))
        apart = squares[own, None] + squares[None, :] - 2 * vectors[own] @ vectors.T
        apart[np.arange(len(own)), own] = np.inf
        near = np.argpartition(apart, take - 1, axis=1)[:, :take]
        far = np.take_along_axis(apart, near, axis=1)
        order = np.argsort(far, axis=1, kind="stable")
        near, far = np.take_along_axis(near, order, axis=1), np.take_along_axis(far, order, axis=1)
        points = vectors[near]
        between = (
            squares[near][:, :, None]
            + squares[near][:, None, :]
            - 2 * np.matmul(points, points.transpose(0, 2, 1))
        )
        kept = np.zeros(near.shape, bool)
        for j in range(take):
            hidden = ((between[:, j, :j] < far[:, j, None]) & kept[:, :j]).any(axis=1)
            kept[:, j] = ~hidden & (kept[:, :j].sum(axis=1) < LINKS)
        rows, columns = np.nonzero(kept)
        pairs.append(np.stack([own[rows], near[rows, columns]]))
    links = np.full((n, width), -1, np.int32)
    if not pairs:
        return links
    a, b = np.concatenate(pairs, axis=1)
    both = np.unique(np.concatenate([a * n + b, b * n + a]))
    a, b = both // n, both % n
    order = np.lexsort((((vectors[a] - vectors[b]) ** 2).sum(axis=1), a))
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    fits = place < width
    links[a[fits], place[fits]] = b[fits]
    return links


class Graph:
    """``links[l]`` holds the neighbours of the points of level l and above; ``members[l]``
    the numbers of those points; rows of upper levels are found through ``rows[l]``."""

    def __init__(self, vectors: np.ndarray, members: list[np.ndarray], links: list[np.ndarray]):
        self.vectors, self.members, self.links = vectors, members, links
        self.squares = (vectors**2).sum(axis=1)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> Graph:
        top = levels_of(ids)
        members, links = [], []
        level = 0
        while True:
            here = np.flatnonzero(top >= level)
            if not len(here):
                break
            own = link_level(vectors[here], 2 * LINKS if level == 0 else LINKS)
            # Neighbour numbers count within the level; make them numbers of points.
            links.append(np.where(own >= 0, here[np.maximum(own, 0)], -1).astype(np.int32))
            members.append(here.astype(np.int32))
            level += 1
        return cls(vectors, members, links)

    def pack(self) -> dict[str, bytes]:
        return {
            "vectors": self.vectors.astype("<f8").tobytes(),
            "sizes": np.array([len(m) for m in self.members], "<i4").tobytes(),
            "members": np.concatenate(self.members).astype("<i4").tobytes(),
            "links": b"".join(x.astype("<i4").tobytes() for x in self.links),
        }

    @classmethod
    def unpack(cls, row, dim: int) -> Graph:
        vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, dim)
        flat_members = np.frombuffer(row["members"], "<i4")
        flat_links = np.frombuffer(row["links"], "<i4")
        members, links = [], []
        at = link_at = 0
        for level, size in enumerate(np.frombuffer(row["sizes"], "<i4").tolist()):
            width = 2 * LINKS if level == 0 else LINKS
            members.append(flat_members[at : at + size])
            links.append(flat_links[link_at : link_at + size * width].reshape(size, width))
            at += size
            link_at += size * width
        return cls(vectors, members, links)

    def _layer(self, query, entries: list[tuple[float, int]], breadth: int, level: int):
        links = self.links[level]
        rows = None
        if level:
            rows = np.full(len(self.vectors), -1, np.int32)
            rows[self.members[level]] = np.arange(len(self.members[level]), dtype=np.int32)
        seen = np.zeros(len(self.vectors), bool)
        seen[[p for _, p in entries]] = True
        waiting = list(entries)
        heapq.heapify(waiting)
        best = [(-d, p) for d, p in entries]
        heapq.heapify(best)
        while waiting:
            d, p = heapq.heappop(waiting)
            if len(best) >= breadth and d > -best[0][0]:
                break
            near = links[p if rows is None else rows[p]]
            near = near[near >= 0]
            near = near[~seen[near]]
            if not len(near):
                continue
            seen[near] = True
            apart = self.squares[near] - 2.0 * (self.vectors[near] @ query)
            if len(best) >= breadth:
                closer = apart < -best[0][0]
                near, apart = near[closer], apart[closer]
            for far, q in zip(apart.tolist(), near.tolist()):
                if len(best) < breadth:
                    heapq.heappush(best, (-far, q))
                elif far < -best[0][0]:
                    heapq.heapreplace(best, (-far, q))
                else:
                    continue
                heapq.heappush(waiting, (far, q))
        return sorted((-d, p) for d, p in best)

    def search(self, query: np.ndarray, k: int, breadth: int = BREADTH) -> np.ndarray:
        """Numbers of about the 2k nearest points. Distances here leave out the query's own
        square, which changes no order."""
        start = int(self.members[-1][0])
        found = [(float(self.squares[start] - 2.0 * (self.vectors[start] @ query)), start)]
        for level in range(len(self.members) - 1, 0, -1):
            found = self._layer(query, found[:UPPER_BREADTH], UPPER_BREADTH, level)
        found = self._layer(query, found, max(breadth, k), 0)
        return np.array([p for _, p in found[: 2 * k]], np.int64)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part, one per id."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector"))
        .filter(F.col("vec_id").isNotNull() & v.isNotNull())
        .filter(finite & F.exists(v, lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
    )


def build_index(points: DataFrame, shard_size: int) -> DataFrame:
    """One row per shard: its points and its graph as flat arrays, in a table."""
    count = points.count()
    shards = max(1, -(-count // shard_size))
    dealt = points.withColumn("dim", F.size("vector")).withColumn(
        "shard", F.pmod(F.xxhash64("point"), F.lit(shards)).cast("int")
    )

    def build(frame):
        import pandas as pd

        frame = frame.sort_values("point")
        ids = frame["point"].to_numpy(np.int64)
        vectors = np.array([np.asarray(v, float) for v in frame["vector"]])
        packed = Graph.build(ids, vectors).pack()
        return pd.DataFrame(
            [{"dim": frame["dim"].iloc[0], "shard": frame["shard"].iloc[0], "ids": ids.astype("<i8").tobytes(), **packed}]
        )

    schema = "dim int, shard int, ids binary, vectors binary, sizes binary, members binary, links binary"
    return written(dealt.groupBy("dim", "shard").applyInPandas(build, schema), "graphs")


class Nearest:
    """The k nearest points of each query of a round so far, ties to the smaller point."""

    def __init__(self, queries: int, k: int):
        self.scores = np.full((queries, k), np.inf)
        self.points = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, query: int, scores: np.ndarray, points: np.ndarray) -> None:
        scores = np.concatenate([self.scores[query], scores])
        points = np.concatenate([self.points[query], points])
        best = np.lexsort((points, scores))[: self.scores.shape[1]]
        self.scores[query], self.points[query] = scores[best], points[best]


def searched(sent, k: int, breadth: int):
    """Rows of graphs to (query_id, point, score) of the queries sent, merged per task."""

    def search(batches):
        import pyarrow as pa

        best: dict[int, Nearest] = {}
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                if dim not in sent.value:
                    continue
                names, vectors = sent.value[dim]
                own = best.setdefault(dim, Nearest(len(names), k))
                graph, ids = Graph.unpack(row, dim), np.frombuffer(row["ids"], "<i8")
                for number, query in enumerate(vectors):
                    near = graph.search(query, k, breadth)
                    own.add(number, np.sqrt(((graph.vectors[near] - query) ** 2).sum(axis=1)), ids[near])
        for dim, own in best.items():
            which, place = np.nonzero(np.isfinite(own.scores))
            columns = [sent.value[dim][0][which], own.points[which, place], own.scores[which, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "point", "score"])

    return search


def search_index(index: DataFrame, queries: DataFrame, k: int, breadth: int, at_once: int) -> DataFrame:
    """(query_id, point, score): for each query the nearest points of the shards of each task.
    A round's results are written, so a lost executor costs its tasks of one round at most."""
    spark = index.sparkSession
    count, parts = queries.agg(F.count("*"), F.coalesce(F.sum(F.size("vector")), F.lit(0))).first()
    rounds = max(1, -(-count // at_once), -(-parts * 8 // QUERY_BYTES))
    # A fixed hash deals the queries to rounds of about equal size.
    dealt = queries.withColumn("turn", F.pmod(F.xxhash64("query_id"), F.lit(rounds)).cast("int"))
    dealt_folder, found_folder = (scratch_dir(spark, f"neighbours-{n}") for n in ("queries", "found"))
    dealt.write.partitionBy("turn").parquet(dealt_folder)
    schema = "query_id bigint, point bigint, score double"
    for number in range(rounds if count else 0):
        part = spark.read.schema(dealt.schema).parquet(dealt_folder).filter(F.col("turn") == number).toArrow()
        sides: dict[int, tuple] = {}
        for name, vector in zip(part["query_id"].to_pylist(), part["vector"].to_pylist()):
            names, vectors = sides.setdefault(len(vector), ([], []))
            names.append(name)
            vectors.append(vector)
        sides = {dim: (np.array(n, np.int64), np.array(v, float)) for dim, (n, v) in sides.items()}
        if not sides:
            continue
        sent = spark.sparkContext.broadcast(sides)
        found = index.mapInArrow(searched(sent, k, breadth), schema)
        found.write.parquet(f"{found_folder}/round={number}")
        sent.destroy()
    remove_scratch(spark, dealt_folder)
    if not count:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(found_folder).drop("round")


def nearest(
    vectors: DataFrame,
    queries_where: str,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_size: int = SHARD,
    breadth: int = BREADTH,
    at_once: int = QUERIES_AT_ONCE,
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest other rows of every row that satisfies
    ``queries_where`` (over vec_id), ties to the smaller vec_id."""
    bounded_batches(vectors.sparkSession)
    rows = written(usable(vectors, id_column, vector_column), "vectors")
    # Of very many copies of one vector, tasks keep k + 1 before the shuffle.
    copies = Window.partitionBy("vector")
    members = written(
        rows.withColumn("nth", F.row_number().over(copies.orderBy("vec_id")))
        .filter(F.col("nth") <= k + 1)
        .withColumn("point", F.min("vec_id").over(copies)),
        "points",
    )
    points = members.filter("nth = 1").select("point", "vector")
    index = build_index(points, shard_size)
    queries = rows.filter(queries_where).select(F.col("vec_id").alias("query_id"), "vector")
    found = search_index(index, queries, k + 1, breadth, at_once)
    best = Window.partitionBy("query_id")
    merged = found.withColumn("nth", F.row_number().over(best.orderBy("score", "point"))).filter(
        F.col("nth") <= k + 1
    )
    return (
        merged.drop("nth")
        .join(members.select("point", "vec_id"), "point")
        .filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(best.orderBy("score", "vec_id")))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")
