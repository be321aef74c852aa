"""Nearest neighbours by inner product over a hierarchical k-means tree.

The tree is fitted on a bounded sample and sent to the tasks; every vector falls down to one leaf. A
query walks the tree best bin first with a priority queue and visits a number of leaves that is widened
on calibration queries, whose true neighbours come from a scan of all rows, until their recall reaches
the target. Queries meet vectors in blocks of one leaf, so a large leaf is many blocks.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from specloom.llm.joins import broadcast_if_small
from specloom.session import stable

# The tree is fitted on at most so many rows and has at most so many leaves.
SAMPLE_ROWS = 20_000
MAX_LEAVES = 4096
LEAF_ROWS = 256
BRANCHES = 8
# Calibration: so many queries, and the mean recall that the number of leaves has to reach.
CALIBRATION_QUERIES = 200
TARGET_RECALL = 0.96
# A block joins at most about so many vectors with so many queries.
BLOCK_ROWS = 4096
BLOCK_QUERIES = 2_000
# A task walks the tree for about so many queries.
WALK_QUERIES = 250
# Scores are summed anew in a fixed order; what a matrix product may differ from that.
SLACK = 1e-9


@dataclass
class Tree:
    """Nodes in one array; `children` of a leaf is empty and `leaf` its number, else -1."""

    centers: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    leaves: int

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector: down to the nearest child at every level."""
        out = np.zeros(len(vectors), dtype=np.int32)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not rows.size:
                continue
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = _nearest(vectors[rows], self.centers[self.children[node]])
            todo += [(child, rows[near == i]) for i, child in enumerate(self.children[node])]
        return out

    def visit(self, query: np.ndarray):
        """Leaves, best bin first: the open node whose center has the largest inner product is next."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.children[node]:
                own = self.children[node]
                score = -(self.centers[own] @ query)
                for s, child in zip(score.tolist(), own, strict=True):
                    heapq.heappush(queue, (s, child))
                _, node = heapq.heappop(queue)
            yield self.leaf[node]


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers**2).sum(axis=1) - 2 * (x @ centers.T)).argmin(axis=1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centers = x[[int(rng.integers(len(x)))]]
    while len(centers) < k:
        far = ((x**2).sum(axis=1)[:, None] - 2 * x @ centers.T + (centers**2).sum(axis=1)).min(axis=1).clip(0)
        if far.sum() <= 1e-12:
            break
        centers = np.vstack([centers, x[rng.choice(len(x), p=far / far.sum())]])
    for _ in range(rounds):
        near = _nearest(x, centers)
        centers = np.array([x[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centers)])
    return centers


def fit(sample: np.ndarray, leaves: int, seed: int = 7) -> Tree:
    """Hierarchical k-means; nodes with the most rows are split first until there are enough leaves."""
    rng = np.random.default_rng(seed)
    tree = Tree(np.zeros((1, sample.shape[1])), [[]], [0], 1)
    centers = [sample.mean(axis=0)]
    open_ = [(-len(sample), 0, np.arange(len(sample)))]
    count = 1
    while open_ and count < leaves:
        _, node, rows = heapq.heappop(open_)
        k = min(BRANCHES, leaves - count + 1, len(rows))
        own = _kmeans(sample[rows], k, rng) if k > 1 else sample[rows][:1]
        near = _nearest(sample[rows], own)
        parts = [(own[i], rows[near == i]) for i in range(len(own)) if (near == i).any()]
        if len(parts) < 2:
            continue
        for center, part in parts:
            child = len(centers)
            centers.append(center)
            tree.children.append([])
            tree.children[node].append(child)
            heapq.heappush(open_, (-len(part), child, part))
        count += len(parts) - 1
    tree.centers = np.array(centers)
    numbers = iter(range(count))
    tree.leaf = [-1 if c else next(numbers) for c in tree.children]
    tree.leaves = count
    return tree


def well_formed(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part: id not null, embedding neither null nor zero nor
    with a null, infinite or NaN component."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0))


def dimensions(rows: DataFrame) -> list[int]:
    """Dimensions of well-formed vectors, the commonest first, then the smallest."""
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d")
    return [r.d for r in sizes.collect()]


def usable(vectors: DataFrame) -> DataFrame:
    """The well-formed vectors of the commonest dimension, the smallest of several."""
    rows = well_formed(vectors)
    return rows.where(F.size("embedding") == (dimensions(rows) or [0])[0])


def search_each(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """`Index.search` where vectors may differ in dimension: each dimension is an index of its own, and a
    query meets the vectors of its dimension. There are as many indexes as dimensions."""
    rows, asked = well_formed(vectors), well_formed(queries)
    of = lambda df, d: df.where(F.size("embedding") == d)
    parts = [Index(of(rows, d), k).search(of(asked, d)) for d in dimensions(rows)]
    return reduce(DataFrame.unionByName, parts) if parts else Index(rows, k).search(asked)


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(np.float64) if len(values) else np.zeros((0, 0))


def _best(ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of a block for one query; vectors come in order of id."""
    rough = np.where(ids == query_id, -np.inf, rough)
    n = min(k, len(ids))
    least = np.partition(rough, len(ids) - n)[len(ids) - n]
    rows = np.flatnonzero((rough >= least - SLACK) & (rough > -np.inf))
    exact = (vectors[rows] * query).sum(axis=1)
    order = np.lexsort((ids[rows], -exact))[:k]
    return ids[rows[order]], exact[order]


def _top(frame: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_neighbours(vectors: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """True neighbours (query_id, rank, vec_id, score and the columns beside) of a few queries over all rows."""
    query_ids, query_vectors = queries.vec_id.to_numpy(np.int64), _matrix(queries.embedding)
    fields = [f for f in vectors.schema.fields if f.name not in ("vec_id", "embedding")]
    schema = ", ".join(["query_id bigint, vec_id bigint, score double", *(f"{f.name} {f.dataType.simpleString()}" for f in fields)])

    def scan(frames):
        for frame in frames:
            frame = frame.sort_values("vec_id", kind="stable")
            ids, x = frame.vec_id.to_numpy(np.int64), _matrix(frame.embedding)
            if not len(ids):
                continue
            other = [frame[f.name].to_numpy() for f in fields]
            where = {v: i for i, v in reversed(list(enumerate(ids.tolist())))}
            rough = query_vectors @ x.T
            for i, q in enumerate(query_ids):
                found, score = _best(ids, x, q, query_vectors[i], rough[i], k)
                at = [where[v] for v in found.tolist()]
                yield pd.DataFrame({"query_id": q, "vec_id": found, "score": score, **{f.name: o[at] for f, o in zip(fields, other, strict=True)}})

    return _top(vectors.mapInPandas(scan, schema), k)


class Index:
    """All usable vectors by leaf, and the number of leaves a query visits.

    Rows that are no neighbours of themselves are those of another vec_id; a repeated row counts as
    often as it occurs. An empty table gives an empty index.
    """

    def __init__(self, vectors: DataFrame, k: int = 20, target: float = TARGET_RECALL):
        self.k, self.target = k, target
        rows = usable(vectors)
        n = rows.count()
        self.tree: Tree | None = None
        self.rows = rows.withColumn("leaf", F.lit(0))
        if not n:
            return
        share = min(1.0, 1.2 * SAMPLE_ROWS / n)
        drawn = rows.where((F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)) if share < 1 else rows
        sample = drawn.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toPandas()
        tree = fit(_matrix(sample.embedding), max(1, min(MAX_LEAVES, n // LEAF_ROWS, len(sample))))

        @F.pandas_udf("int")
        def leaf_of(x: pd.Series) -> pd.Series:
            return pd.Series(tree.assign(_matrix(x)) if len(x) else [], dtype="int32")

        self.tree = tree
        self.rows = stable(rows.select("vec_id", "embedding", leaf_of("embedding").alias("leaf")))
        counts = {r.leaf: r.n for r in self.rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most MAX_LEAVES
        self.counts = np.array([counts.get(i, 0) for i in range(tree.leaves)])
        self.visits, self.recall = self._calibrate(sample.head(CALIBRATION_QUERIES))

    def _calibrate(self, queries: pd.DataFrame) -> tuple[int, float]:
        """Fewest leaves that reach the target recall on the calibration queries, and that recall."""
        queries = queries.drop_duplicates("vec_id")
        true = exact_neighbours(self.rows, queries[["vec_id", "embedding"]], self.k).select("query_id", "leaf").toPandas()
        order = {q: {leaf: i for i, leaf in enumerate(self.tree.visit(x))} for q, x in zip(queries.vec_id, _matrix(queries.embedding), strict=True)}
        place = np.array([order[q][leaf] for q, leaf in zip(true.query_id, true.leaf, strict=True)])
        visits, recall = 1, 1.0
        while place.size and visits < self.tree.leaves and (recall := float((place < visits).mean())) < self.target:
            visits += 1
        return visits, recall

    def search(self, queries: DataFrame) -> DataFrame:
        """(query_id, rank, vec_id, score) of the k best found for each row (vec_id, embedding) of
        `queries`. A query visits more leaves than calibrated while they hold too few rows."""
        k, tree = self.k, self.tree
        empty = "query_id bigint, rank int, vec_id bigint, score double"
        if tree is None:
            return queries.sparkSession.createDataFrame([], empty)
        counts, visits = self.counts, self.visits
        # Neighbouring leaves share a block; a leaf that is larger than a block is cut into several.
        cut = np.maximum(1, -(-counts // BLOCK_ROWS))
        before = np.where(cut > 1, 0, counts).cumsum() // BLOCK_ROWS
        first = before + np.concatenate([[0], np.where(cut > 1, cut + 1, 0).cumsum()[:-1]])
        first = np.where(cut > 1, first + 1, first)

        def walk(frames):
            for frame in frames:
                for q, x in zip(frame.vec_id, _matrix(frame.embedding), strict=True):
                    seen: dict[int, list[int]] = {}
                    rows = 0
                    for i, leaf in enumerate(tree.visit(x)):
                        if i >= visits and rows > k:
                            break
                        rows += int(counts[leaf])
                        for block in range(int(first[leaf]), int(first[leaf] + cut[leaf])):
                            seen.setdefault(block, []).append(leaf)
                    yield pd.DataFrame({"block": list(seen), "vec_id": q, "embedding": [x] * len(seen), "leaves": list(seen.values())})

        asked = usable_like(queries, tree.centers.shape[1]).distinct()
        # The walk is far dearer than its rows are large, so partitions go by rows.
        asked = asked.repartition(max(1, asked.count() // WALK_QUERIES), "vec_id")
        plan = stable(asked.mapInPandas(walk, "block int, vec_id bigint, embedding array<double>, leaves array<int>"))
        # The queries of a block go to as many groups as their number needs, and only over those its vectors
        # are repeated; a block that no query visits goes nowhere.
        asks = stable(plan.groupBy("block").agg(F.expr(f"int((count(1) + {BLOCK_QUERIES - 1}) div {BLOCK_QUERIES})").alias("shares")))
        plan = plan.join(asks, "block").withColumn("share", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("shares")).cast("int")).drop("shares")
        places = list(zip(range(tree.leaves), first.tolist(), cut.tolist(), strict=True))
        sizes = self.rows.sparkSession.createDataFrame(places, "leaf int, first int, cut int")
        block = F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("cut")).cast("int")
        dealt = self.rows.join(F.broadcast(sizes), "leaf").select(block.alias("block"), "leaf", "vec_id", "embedding")
        dealt = dealt.join(broadcast_if_small(asks), "block").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")

        def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            right = right.sort_values("vec_id", kind="stable")
            ids, x, asked_x = right.vec_id.to_numpy(np.int64), _matrix(right.embedding), _matrix(left.embedding)
            rows_of = {leaf: np.flatnonzero(right.leaf == leaf) for leaf in right.leaf.unique()}
            for at in range(0, len(left) if len(right) else 0, 256):
                part = left.iloc[at : at + 256]
                rough = np.full((len(part), len(ids)), -np.inf)
                askers: dict[int, list[int]] = {}
                for i, leaves in enumerate(part.leaves):
                    for leaf in leaves:
                        askers.setdefault(leaf, []).append(i)
                for leaf, who in askers.items():
                    if leaf in rows_of:
                        rough[np.ix_(who, rows_of[leaf])] = asked_x[at : at + 256][who] @ x[rows_of[leaf]].T
                for i, q in enumerate(part.vec_id):
                    near, score = _best(ids, x, q, asked_x[at + i], rough[i], k)
                    found.append((np.full(len(near), q), near, score))
            columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
            return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

        keys = ["block", "share"]
        met = plan.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(meet, "query_id bigint, vec_id bigint, score double")
        return _top(met, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def usable_like(queries: DataFrame, dimension: int) -> DataFrame:
    return usable(queries).where(F.size("embedding") == dimension)
