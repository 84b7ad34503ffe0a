"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a hash sample of at most about ``SAMPLE`` vectors (``BRANCHES`` children per
node, ``LEAF_SAMPLE`` sample vectors per leaf), so it has a bounded size and is broadcast. Every
vector is indexed: it goes down to a leaf. A query visits leaves best bin first: a priority queue
holds the nodes met so far by the inner product with their centroids, and the best is opened next.

How many leaves are visited is calibrated: for up to about ``CALIBRATION`` of the queries the exact
nearest are found among all vectors, and the visits are widened, doubling, until the share of
these found reaches ``RECALL``; then the smallest sufficient number of leaves is taken. In the
worst case all leaves are visited, and the search is exact. A query whose visited leaves hold fewer
vectors than it asks for, besides those of its own id, opens further leaves until they do. Nothing
else is left out: what stands in the visited leaves is compared in full.

Leaves are gathered in groups, groups are split into blocks of at most about ``BLOCK`` vectors by a
hash of the id, queries likewise: a hot leaf becomes many blocks. A block returns the best
``neighbours`` of each query; scores are inner products in double precision of the original vectors.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
those whose length is not the most frequent one. Equal scores are ranked by the smaller id. Rows of
one id are candidates each, except for the query of that id; as queries they are one, with the
smallest of their vectors. A row without id takes no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from versus.llm.common import table
from versus.session import materialize

SAMPLE = 20_000
BRANCHES = 8
LEAF_SAMPLE = 40
CALIBRATION = 100
RECALL = 0.97
GROUPS = 16
BLOCK = 8_192


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) with v an array of doubles of the most frequent length."""
    v = F.col(vector_col).cast("array<double>")
    fine = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull()
        & (F.size("v") > 0)
        & F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
        & F.exists("v", lambda x: x != 0)
    )
    length = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fine.where(F.size("v") == (length["n"] if length else 0))


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The cluster of each row: Lloyd's iterations from a k-means++ start."""
    centres = x[rng.integers(len(x))][None]
    gap = ((x - centres[0]) ** 2).sum(1)
    while len(centres) < k and gap.sum() > 0:
        centres = np.vstack([centres, x[rng.choice(len(x), p=gap / gap.sum())]])
        gap = np.minimum(gap, ((x - centres[-1]) ** 2).sum(1))
    own = np.zeros(len(x), np.int64)
    for _ in range(8):
        new = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
        if (new == own).all() and _:
            break
        own = new
        for j in np.unique(own):
            centres[j] = x[own == j].mean(0)
    return own


class Tree:
    """Centroids of all nodes; the children of a node; leaves are numbered in depth-first order,
    so that the leaves of a subtree have neighbouring numbers."""

    def __init__(self, sample: np.ndarray):
        rng = np.random.default_rng(4)
        self.children: list[list[int]] = []
        self.leaf: list[int] = []
        centroids: list[np.ndarray] = []
        self.leaves = 0

        def grow(x: np.ndarray) -> int:
            node = len(centroids)
            centroids.append(x.mean(0))
            self.children.append([])
            self.leaf.append(-1)
            own = _kmeans(x, BRANCHES, rng) if len(x) > LEAF_SAMPLE else np.zeros(len(x), np.int64)
            parts = np.unique(own)
            if len(parts) < 2:
                self.leaf[node] = self.leaves
                self.leaves += 1
            else:
                self.children[node] = [grow(x[own == j]) for j in parts]
            return node

        grow(sample)
        self.centroids = np.array(centroids)
        self.norms = (self.centroids**2).sum(1)

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: down the tree to the nearest centroid."""
        out = np.empty(len(x), np.int64)

        def down(node: int, rows: np.ndarray) -> None:
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
                return
            near = (self.norms[kids] - 2 * x[rows] @ self.centroids[kids].T).argmin(1)
            for j in np.unique(near):
                down(kids[j], rows[near == j])

        down(0, np.arange(len(x)))
        return out

    def visit(self, q: np.ndarray, limit: int, held: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first ``limit`` leaves of a query, best bin first, and more until they have at
        least ``least`` of the vectors ``held`` by leaves."""
        value = self.centroids @ q
        queue, out, n = [(-value[0], 0)], [], 0
        while queue and (len(out) < limit or n < least):
            node = heapq.heappop(queue)[1]
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
                n += least if held is None else held[self.leaf[node]]
            for kid in self.children[node]:
                heapq.heappush(queue, (-value[kid], kid))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _best(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int,
          allowed: np.ndarray | None = None) -> pd.DataFrame:
    """The k best candidates of each query with exact scores; the query's own id is none."""
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(q), 256):
        rough = q[at : at + 256] @ x.T
        bar = np.isin(ids, q_ids[at : at + 256])
        if bar.any():
            rough[:, bar] = np.where(ids[bar] == q_ids[at : at + 256, None], -np.inf, rough[:, bar])
        if allowed is not None:
            rough[~allowed[at : at + 256]] = -np.inf
        kth = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(rough), -np.inf)
        # products in blocks round differently: all that may be among the best are taken again
        row, col = np.nonzero((rough >= (kth - 1e-9 * (1 + abs(kth)))[:, None]) & (rough > -np.inf))
        exact = (q[at + row] * x[col]).sum(1)
        order = np.lexsort((ids[col], -exact, row))
        row, col, exact = row[order], col[order], exact[order]
        first = np.searchsorted(row, np.arange(len(rough)))
        keep = np.arange(len(row)) - first[row] < k
        out.append((q_ids[at + row[keep]], ids[col[keep]], exact[keep]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
    return pd.DataFrame({"query_id": np.array(columns[0], np.int64), "vec_id": np.array(columns[1], np.int64),
                         "score": np.array(columns[2], np.float64)})


_PAIR = "query_id long, vec_id long, score double"


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _calibrate(queries: DataFrame, indexed: DataFrame, tree: Tree, k: int, recall: float) -> int:
    """The number of leaves to visit."""
    n = queries.count()
    chosen = queries.where(
        F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 20)) < (1 << 20) * min(1.0, CALIBRATION / max(n, 1))
    ).limit(2 * CALIBRATION).collect()
    if not chosen:
        return tree.leaves
    q, q_ids = np.array([r["v"] for r in chosen]), np.array([r["id"] for r in chosen])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            ids = batch.column("id").to_numpy()
            best = _best(q, q_ids, _matrix(batch.column("v")), ids, k)
            best["leaf"] = leaf[np.argsort(ids)[np.searchsorted(ids, best["vec_id"], sorter=np.argsort(ids))]]
            yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    pairs = indexed.select("id", "v", "leaf").mapInArrow(nearest, f"{_PAIR}, leaf long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = pairs.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).collect()
    if not true:
        return tree.leaves
    at = {q_id: {leaf: i for i, leaf in enumerate(tree.visit(v, tree.leaves))}
          for v, q_id in zip(q, q_ids, strict=True)}
    needed = np.sort([at[r["query_id"]][r["leaf"]] + 1 for r in true])
    leaves = 1
    while (needed <= leaves).mean() < recall:
        leaves *= 2
    return int(needed[int(np.ceil(recall * len(needed))) - 1])


def search(rows: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding",
           neighbours: int = 20, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is a condition on the column ``id``."""
    spark = rows.sparkSession
    good = usable(rows, id_col, vector_col)
    total = good.count()
    share = min(1.0, SAMPLE / max(total, 1))
    sample = good.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < (1 << 20) * share).limit(2 * SAMPLE)
    fitted = np.array([r["v"] for r in sample.select("v").collect()])  # bounded
    if not len(fitted):
        fitted = np.array([r["v"] for r in good.select("v").limit(1).collect()] or [[0.0]])
    tree = spark.sparkContext.broadcast(Tree(fitted))
    per_group = -(-tree.value.leaves // GROUPS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.value.place(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf), pa.array(leaf // per_group)],
                names=["id", "v", "leaf", "part"],
            )

    indexed = materialize(
        good.mapInArrow(place, "id long, v array<double>, leaf long, part long")
    )
    # rows of one id ask once, by the smallest of their vectors
    queries = materialize(indexed.where(is_query).groupBy("id").agg(F.min("v").alias("v")))
    leaves = _calibrate(queries, indexed, tree.value, neighbours, recall)
    held_by = np.zeros(tree.value.leaves, np.int64)
    for row in indexed.groupBy("leaf").count().collect():  # bounded, as the tree is
        held_by[row["leaf"]] = row["count"]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, parts, wanted = [], [], []
            copies = batch.column(2).to_pylist()
            for i, q in enumerate(_matrix(batch.column(1))):
                own: dict[int, list[int]] = {}
                for leaf in tree.value.visit(q, leaves, held_by, neighbours + copies[i]):
                    own.setdefault(leaf // per_group, []).append(leaf)
                source += [i] * len(own)
                parts += own
                wanted += own.values()
            take = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(parts, pa.int64()),
                 pa.array(wanted, pa.list_(pa.int64()))],
                names=["id", "v", "part", "leaves"],
            )

    copies = indexed.where(is_query).groupBy("id").agg(F.count("*").alias("copies"))
    dealt = queries.join(copies, "id").repartition(spark.sparkContext.defaultParallelism, "id")
    visits = dealt.select("id", "v", "copies").mapInArrow(visit, "id long, v array<double>, part long, leaves array<long>")
    sizes = indexed.groupBy("part").agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"))
    sizes = sizes.select(
        "part", F.ceil(F.col("n") / BLOCK).alias("blocks"),
        F.ceil(F.greatest(F.lit(1), F.lit(queries.count())) / BLOCK).alias("q_blocks"),
    )
    h = F.xxhash64("id")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    # at most GROUPS rows: a bounded broadcast
    asked = visits.join(F.broadcast(sizes), "part").select(
        "id", "v", "leaves", "part", F.pmod(h, "q_blocks").alias("a"), every("blocks").alias("b")
    )
    held = indexed.join(F.broadcast(sizes), "part").select(
        "id", "v", "leaf", "part", every("q_blocks").alias("a"), F.pmod(h, "blocks").alias("b")
    )

    def compare(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64"}
            )
        leaf = x["leaf"].to_numpy()
        known, own = np.unique(leaf, return_inverse=True)
        open_ = np.zeros((len(q), len(known)), bool)
        for i, wanted in enumerate(q["leaves"]):
            open_[i] = np.isin(known, wanted)
        return _best(np.stack(q["v"]), q["id"].to_numpy(), np.stack(x["v"]), x["id"].to_numpy(),
                     neighbours, open_[:, own])

    found = (
        asked.groupBy("part", "a", "b")
        .cogroup(held.groupBy("part", "a", "b"))
        .applyInPandas(compare, _PAIR)
    )
    return _ranked(found, neighbours)


def brute_force(rows: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding",
                neighbours: int = 20) -> list[tuple]:
    """The exact result on a small table, in one process; for measuring recall."""
    got = usable(rows, id_col, vector_col)
    q = got.where(is_query).toPandas()
    x = got.toPandas()
    best = _best(np.stack(q["v"]), q["id"].to_numpy(), np.stack(x["v"]), x["id"].to_numpy(), neighbours)
    best["rank"] = best.groupby("query_id").cumcount() + 1
    return [(int(r.query_id), int(r.rank_), int(r.vec_id), float(r.score))
            for r in best.rename(columns={"rank": "rank_"}).itertuples()]


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of each vector whose id is divisible by 20."""
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
