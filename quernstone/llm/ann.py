"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees.

Trees are grown on a bounded sample (SAMPLE vectors, those first by a hash of their id); every vector is indexed. Inner product is turned into distance by one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm (0 for queries).
A query searches all trees through one priority queue: the root of each tree enters it, the node with the best bound leaves, and its two children enter with the lesser of that bound and the signed distance to the plane. It stops
after the number of leaves found to reach TARGET recall on the sample (measured there by brute force, on CALIBRATED queries).

Rows and queries meet in leaves as blocks of at most BLOCK rows and BLOCK queries; a row that several trees offer is scored in each, which costs less than carrying the set of leaves along, and counts once.
Candidates are scored exactly, in double precision on the original vectors (sums do not depend on the order of their terms, so equal vectors have equal scores wherever they are scored); those below the k + 1 best among BOUNDING of the sample's vectors in the same leaves (they are candidates too) cannot be among its answers and are not sent on.

Repeated ids: answers are distinct ids, each once with its best score over its rows, and an id is never its own answer. Rows with one id and vector are one from the start; ids, not rows, fill the places that are kept.
Equal vectors: a query's answers can only hold the k + 1 smallest ids of each distinct vector, so that many are indexed and the rest cannot change a result; queries with equal vectors are searched once.
Null, zero and non-finite vectors, null ids, and vectors of another length than most take no part. Ties go to the smaller vec_id. Fewer candidates than k are all returned. A vec_id with several vectors is asked with all of them. Columns besides vec_id and embedding are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize

TREES, SAMPLE, LEAF_ROWS, LEAF_SAMPLE = 6, 50_000, 512, 4
TARGET, CALIBRATED, BLOCK, BOUNDING = 0.96, 200, 4096, 16_384


class Tree:
    """Planes in arrays; a leaf's children are -1 - leaf."""

    def __init__(self, points: np.ndarray, leaf: int, random: np.random.Generator):
        self.normals, self.offsets, self.children, self.leaves = [], [], [], 0
        self.root = self.grow(points, leaf, random)
        self.normals, self.offsets = np.array(self.normals).reshape(-1, points.shape[1]), np.array(self.offsets)

    def grow(self, points, leaf, random) -> int:
        if len(points) > leaf:
            for _ in range(3):
                normal = random.standard_normal(points.shape[1])
                normal /= np.linalg.norm(normal)
                along = points @ normal
                offset = float(np.median(along))
                right = along > offset
                if 0 < right.sum() < len(points):
                    node = len(self.children)
                    self.normals.append(normal)
                    self.offsets.append(offset)
                    self.children.append(None)
                    self.children[node] = (self.grow(points[~right], leaf, random), self.grow(points[right], leaf, random))
                    return node
        self.leaves += 1
        return -self.leaves

    def place(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        out, todo = np.zeros(len(x), np.int64), [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
            elif len(rows):
                right = x[rows] @ self.normals[node] > self.offsets[node]
                todo += [(self.children[node][0], rows[~right]), (self.children[node][1], rows[right])]
        return out


class Forest:
    def __init__(self, points: np.ndarray, leaf: int, top: float, trees: int = TREES, seed: int = 0):
        self.top, self.points, self.placed = top, points, None
        random = np.random.default_rng(seed)
        lifted = self.lift(points)
        self.trees = [Tree(lifted, leaf, random) for _ in range(trees)]
        self.base = np.cumsum([0, *(t.leaves for t in self.trees)])
        self.visits = int(self.base[-1])

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.sqrt(np.maximum(0, self.top**2 - (x * x).sum(axis=1)))])

    def place(self, x: np.ndarray) -> np.ndarray:
        lifted = self.lift(x)
        return np.column_stack([t.place(lifted) + b for t, b in zip(self.trees, self.base, strict=False)])

    def bounds(self, qs: np.ndarray, visited: list[list[int]], k: int) -> list[float]:
        """For each query a score that the k best found reach: the k-th best of BOUNDING of the sample's vectors, of those in the leaves visited, less what rounding may take."""
        if self.placed is None:
            self.placed = self.place(self.points[:BOUNDING])
        out = []
        for scores, leaves in zip(qs @ self.points[:BOUNDING].T, visited, strict=True):
            mask = np.zeros(int(self.base[-1]), bool)
            mask[leaves] = True
            some = scores[mask[self.placed].any(axis=1)]
            best = np.partition(some, len(some) - k)[len(some) - k] if len(some) >= k else -np.inf
            out.append(float(best - 1e-9 * (1 + abs(best))))
        return out

    def visit(self, q: np.ndarray, visits: int) -> list[int]:
        """Leaves for one query, best first, through one queue for all trees."""
        q = np.r_[q / np.linalg.norm(q) * self.top, 0.0]
        margins = [(t.normals @ q - t.offsets).tolist() if len(t.offsets) else [] for t in self.trees]
        queue = [(-np.inf, k, t.root) for k, t in enumerate(self.trees)]
        out = []
        while queue and len(out) < visits:
            bound, k, node = heapq.heappop(queue)
            if node < 0:
                out.append(int(self.base[k]) - node - 1)
                continue
            m = margins[k][node]
            left, right = self.trees[k].children[node]
            heapq.heappush(queue, (max(bound, m), k, left))
            heapq.heappush(queue, (max(bound, -m), k, right))
        return out

    def calibrate(self, points: np.ndarray, k: int) -> None:
        """The number of leaves that reaches TARGET recall on the sample, a query itself not counted."""
        total = int(self.base[-1])
        leaves, need = self.place(points), []
        for i in range(0, len(points), max(1, len(points) // CALIBRATED)):
            scores = points @ points[i]
            scores[i] = -np.inf
            best = np.argsort(-scores, kind="stable")[: min(k, len(points) - 1)]
            position = np.empty(total, np.int64)
            position[self.visit(points[i], total)] = np.arange(total)
            need.append(np.sort(position[leaves[best]].min(axis=1)))
        low, high = 1, total
        while low < high:
            mid = (low + high) // 2
            recall = np.mean([(x < mid).mean() if len(x) else 1.0 for x in need])
            low, high = (low, mid) if recall >= TARGET else (mid + 1, high)
        self.visits = low


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, x (doubles) of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("long"), x.alias("x")).filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = rows.filter(~F.exists("x", bad) & F.exists("x", lambda v: v != 0))
    size = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("x") == (size.n if size else 0))


def search(rows: DataFrame, k: int = 20, every: int = 20, trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose vec_id is divisible by `every`."""
    spark = rows.sparkSession
    bounded_batches(spark)
    rows = usable(rows)
    same = [F.xxhash64("x").alias("c"), F.hash("x").alias("c2")]
    order = Window.partitionBy("c", "c2").orderBy("vec_id")
    index = materialize(rows.select("vec_id", "x", *same).dropDuplicates(["vec_id", "c", "c2"]).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    count, top = index.agg(F.count("*"), F.max(norm)).first()
    # one row an id, so that the k best of the sample are k ids
    chosen = index.select("x", "vec_id", "c", F.xxhash64("vec_id").alias("h")).orderBy("h", "vec_id", "c").limit(sample).select("vec_id", "x").toArrow()
    points = np.zeros((0, 1))
    if chosen.num_rows:
        last = chosen.num_rows - 1 - np.unique(chosen.column("vec_id").to_numpy()[::-1], return_index=True)[1]
        points = chosen.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(chosen.num_rows, -1)[np.sort(last)]
    leaf = max(LEAF_SAMPLE, int(len(points) * LEAF_ROWS / max(count, 1)))
    forest = Forest(points, leaf, top or 0.0, trees)
    if len(points):
        forest.calibrate(points, k)
    shared = spark.sparkContext.broadcast(forest)  # bounded by the sample

    def vectors(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def place(batches):
        for b in batches:
            x = vectors(b.column("x"))
            leaves = shared.value.place(x)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(list(leaves.astype(np.int32)), pa.list_(pa.int32()))], ["vec_id", "x", "leaves"])

    def visit(batches):
        f = shared.value
        for b in batches:
            qs = vectors(b.column("x"))
            visited = [f.visit(q, f.visits) for q in qs]
            yield pa.RecordBatch.from_arrays([b.column("qid"), pa.array([r.tobytes() for r in qs], pa.binary()), pa.array(visited, pa.list_(pa.int32())), pa.array(f.bounds(qs, visited, k + 1), pa.float64())], ["qid", "x", "leaves", "bound"])

    # one search for each distinct vector among the queries, under the least of their ids
    wanted = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "x", *same)
    searched = wanted.withColumn("n", F.row_number().over(order)).filter("n = 1").select(F.col("vec_id").alias("qid"), "x", "c", "c2")
    searched = materialize(searched)
    # tasks by the work there is: placing is quick, a visit is a walk through the forest
    placed = materialize(index.select("vec_id", "x").repartition(count // 2048 + 1).mapInArrow(place, "vec_id long, x binary, leaves array<int>"))
    asking = materialize(searched.select("qid", "x").repartition(count // (64 * every) + 1).mapInArrow(visit, "qid long, x binary, leaves array<int>, bound double"))
    # blocks of each leaf: a row a leaf, of which there are at most trees * sample / LEAF_SAMPLE
    def sizes(rows, name):
        return rows.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    blocks = F.broadcast(sizes(placed, "row_blocks").join(sizes(asking, "query_blocks"), "leaf"))
    left = placed.select("vec_id", "x", F.explode("leaves").alias("leaf")).join(blocks, "leaf")
    left = left.withColumn("rb", F.pmod(F.xxhash64("vec_id"), F.col("row_blocks")).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))).drop("row_blocks", "query_blocks")
    right = asking.select("qid", "x", "bound", F.explode("leaves").alias("leaf")).join(blocks, "leaf")
    right = right.withColumn("qb", F.pmod(F.xxhash64("qid"), F.col("query_blocks")).cast("int")).withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1))).drop("row_blocks", "query_blocks")

    def meet(key, rows_, queries):
        ids, scores, asked = [], [], []
        if rows_.num_rows and queries.num_rows:
            rows_, queries = rows_.combine_chunks(), queries.combine_chunks()
            x = np.frombuffer(b"".join(rows_.column("x").to_pylist())).reshape(rows_.num_rows, -1)
            vec = rows_.column("vec_id").to_numpy()
            repeated = len(np.unique(vec)) < len(vec)
            for s in range(0, queries.num_rows, 256):
                part = queries.slice(s, 256)
                q = np.frombuffer(b"".join(part.column("x").to_pylist())).reshape(part.num_rows, -1)
                dots, qids = q @ x.T, part.column("qid").to_numpy()
                of, mine = np.nonzero(dots >= part.column("bound").to_numpy()[:, None])
                some = dots[of, mine]
                if repeated:  # the best row of each id
                    order = np.lexsort((-some, vec[mine], of))
                    new = np.r_[True, (np.diff(of[order]) != 0) | (np.diff(vec[mine[order]]) != 0)][: len(order)]
                    of, mine, some = of[order][new], mine[order][new], some[order][new]
                many = np.flatnonzero(np.bincount(of, minlength=len(qids)) > k + 1)
                if len(many):  # those that cannot be among the k + 1 best of the block go
                    start = np.searchsorted(of, np.arange(len(qids) + 1))
                    stay = np.ones(len(of), bool)
                    for i in many.tolist():
                        d = some[start[i] : start[i + 1]]
                        cut = np.partition(d, len(d) - k - 1)[len(d) - k - 1]
                        stay[start[i] : start[i + 1]] = d >= cut - 1e-9 * (1 + abs(cut))
                    of, mine = of[stay], mine[stay]
                ids.append(vec[mine])
                asked.append(qids[of])
                # a matrix product rounds by the shape of the block: scores that count are summed again, whatever the order of the terms
                scores.append(np.array([math.fsum(terms) for k in range(0, len(of), 4096) for terms in (x[mine[k : k + 4096]] * q[of[k : k + 4096]]).tolist()], np.float64))
        join = lambda a, kind: np.concatenate(a) if a else np.zeros(0, kind)
        return pa.table({"qid": join(asked, np.int64), "vec_id": join(ids, np.int64), "score": join(scores, np.float64)})

    keys = ["leaf", "rb", "qb"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "qid long, vec_id long, score double")
    met = met.groupBy("qid", "vec_id").agg(F.max("score").alias("score"))  # an id may meet a query in several blocks
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    near = met.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).select("qid", "vec_id", "score")
    # to every query with that vector, without itself
    back = searched.select("qid", "c", "c2").join(near, "qid").select("c", "c2", "score", F.col("vec_id").alias("found"))
    each = wanted.select(F.col("vec_id").alias("query_id"), "c", "c2").distinct().join(back, ["c", "c2"]).filter("found <> query_id")
    each = each.groupBy("query_id", "found").agg(F.max("score").alias("score"))
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "found")
    return each.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("found").alias("vec_id"), "score")
