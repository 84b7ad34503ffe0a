"""Extremely randomised trees, grown level by level as joins and aggregates.

Every tree sees all training rows. A node draws a few dimensions and, for each, a threshold between
the least and the largest value its rows have there; the draw with the purest halves (Gini) splits
it. Draws come from a hash of forest, tree, node and place, so a forest is a function of its rows,
and any engine with the same hash grows the same trees.

Many forests grow at once (the settings and folds of a search). A level takes two aggregates of
partial sums: ranges of the drawn dimensions, then class counts at the thresholds.

While the forests have few nodes (see ``HELD_CELLS``, counted at every level), tasks hold the splits:
a row is led from the root to its node in numpy, and only partial sums, one row per task, node and
label, are shuffled. Beyond that a row of a working table is one row of the data in one tree, splits
are a table, and a join sends every row to its child; no task holds a tree then. Both ways grow the
same trees. Rows that are only to be judged are led along without being counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from versus.session import materialize

DIGITS = 9
DEEPEST = 60  # numbers of nodes are 64-bit: a node's children are 2n and 2n + 1
# Numbers a task may hold: open nodes x labels x draws while it counts, nodes x labels while it judges.
HELD_CELLS = 1 << 23

_KEY = ["forest", "tree", "node"]


def _share(digest: Column, start: int) -> Column:
    """Eight hex digits as a number in [0, 1)."""
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def _digest(node: Column, j: int) -> Column:
    return F.md5(F.concat_ws(":", "forest", F.col("tree"), node, F.lit(str(j))).cast("binary"))


def _drawn(node: Column, draws: int) -> Column:
    """The dimensions a node draws, by place; null beyond the forest's number of draws."""
    picked = []
    for j in range(draws):
        at = F.floor(_share(_digest(node, j), 1) * F.size("dims")).cast("int")
        picked.append(F.when(F.lit(j) < F.col("draws"), F.get("dims", at)))
    return F.array(*picked)


def _values(drawn: Column) -> Column:
    return F.transform(drawn, lambda d: F.get("features", d))


def whole(df: DataFrame, dim: int, forest: str = "") -> DataFrame:
    """(forest, dims): one forest over all dimensions."""
    return df.sparkSession.range(1).select(
        F.lit(forest).alias("forest"), F.array(*map(F.lit, range(dim))).alias("dims")
    )


def grow(
    cells: DataFrame, points: DataFrame, dims: DataFrame, trees: int = 50, max_depth: int = DEEPEST
) -> tuple[DataFrame, DataFrame]:
    """The nodes of all forests, and the judgements of the rows that are not for training.

    ``cells``: forest, id, label, train; ``points``: id, features; ``dims``: forest, dims. A node
    draws the root of its forest's number of dimensions. Nodes: forest, tree, node, dim, threshold
    (null for leaves) and counts (label, n). A node is a leaf if its rows have one label, if no
    drawn dimension tells them apart, or at ``max_depth``. Judgements: (forest, id, label, pred).
    """
    if max_depth > DEEPEST:
        raise ValueError(f"trees of more than {DEEPEST} levels cannot be numbered")
    cells, points = cells.select("forest", "id", "label", "train"), points.select("id", "features")
    copies = F.count(F.lit(1)).over(Window.partitionBy("id"))
    placed = points.where("id is not null").withColumn("copies", copies)
    numbers = materialize(dims.select("forest", "dims"))
    names = sorted(r["forest"] for r in numbers.select("forest").collect())  # settings x folds: bounded by the search
    number = F.create_map(*(x for i, f in enumerate(names) for x in (F.lit(f), F.lit(i)))) if names else F.lit(None)
    packed = cells.join(placed, "id").join(numbers.select("forest"), "forest", "left_semi").select(
        "id", "label", "features", F.array(number[F.col("forest")] if names else F.lit(0)).alias("forests"),
        F.array("train").alias("train"), "copies", F.lit(1).cast("long").alias("weight"),
    )
    return _grow(packed, points, numbers, names, trees, max_depth)


def _grow(
    packed: DataFrame, points: DataFrame, dims: DataFrame, names: list[str], trees: int, max_depth: int
) -> tuple[DataFrame, DataFrame]:
    """``packed``: id, label, features, the numbers of its forests and whether it trains each of them;
    ``copies``: rows of its id; ``weight``: for how many rows it stands at a root."""
    spark = packed.sparkSession
    dims = dims.select("forest", "dims").withColumn("draws", F.greatest(F.lit(1), F.floor(F.sqrt(F.size("dims"))).cast("int")))
    draws, width = dims.agg(F.max("draws"), F.max(F.array_max("dims"))).first()
    draws, width = draws or 1, (width or 0) + 1
    places = range(draws)
    cores = spark.sparkContext.defaultParallelism
    packed = materialize(packed.repartition(cores))
    # draws are worked out once for each node, not for each of its rows
    roots = dims.withColumn("tree", F.explode(F.array(*map(F.lit, range(trees))))).select(
        "forest", "tree", F.lit(1).cast("long").alias("node"), "dims", "draws"
    )
    roots = materialize(roots.withColumn("drawn", _drawn(F.col("node"), draws)).drop("dims", "draws"))
    most = HELD_CELLS // draws
    trained = packed.where(F.exists("train", lambda t: t))
    labels = [r["label"] for r in trained.select("label").distinct().limit(most + 1).collect()]
    held = _Held(names, trees, sorted(x for x in labels if x is not None) + [None] * (None in labels), width)
    few = len(names) * trees * len(labels) <= most
    if few:
        held.start(roots.toPandas())
    nodes, reached, depth = None, None, 0
    kind, tag = dict(packed.dtypes)["label"], dict(packed.dtypes)["id"]
    while few:
        keys = f"forest string, tree int, node long, label {kind}, n long, "
        ends = [f"{name}{j}" for j in places for name in ("low", "high")]
        partial = packed.mapInArrow(_ranges(held, draws), keys + ", ".join(f"{c} double" for c in ends))
        per_label = materialize(partial.groupBy(*_KEY, "label").agg(
            F.sum("n").alias("n"), *((F.min if c.startswith("low") else F.max)(c).alias(c) for c in ends)
        ))

        def halves(tried: DataFrame) -> DataFrame:
            tried = materialize(tried)
            counted = packed.mapInArrow(
                _lefts(held, draws, tried.toPandas()), keys + ", ".join(f"left{j} long" for j in places)
            ).groupBy(*_KEY, "label").agg(F.sum("n").alias("n"), *(F.sum(f"left{j}").alias(f"left{j}") for j in places))
            return counted.join(tried, _KEY)

        leaf = depth == max_depth
        splits = materialize(_splits(per_label, halves, dims, places, leaf))
        plain = splits.drop("drawn0", "drawn1")
        nodes = plain if nodes is None else nodes.unionByName(plain)
        held.judge(splits.select(*_KEY, F.inline("counts")).toPandas())
        inner = splits.where("threshold is not null")
        held.split(inner.select(*_KEY, "dim", "threshold", "drawn0", "drawn1").toPandas())
        if not held.n_open():
            held.last = depth
            break
        depth += 1
        few = held.n_open() * len(labels) <= most and held.size() * len(labels) <= HELD_CELLS
    judged = packed.where(F.exists("train", lambda t: ~t)).mapInArrow(
        _judges(held), f"forest string, id {tag}, label {kind}, class {kind}, share double"
    )
    if few:
        return nodes, _voted(judged)
    if depth:
        at = packed.mapInArrow(
            _opened(held), f"forest string, tree int, node long, id {tag}, label {kind}, train boolean, xs array<double>"
        )
    else:
        alone = packed.select("*", F.explode(F.arrays_zip("forests", "train")).alias("c")).select(
            F.get(F.array(*map(F.lit, names)), F.col("c.forests")).alias("forest"), "id", "label", "c.train", "features",
            F.explode(F.sequence(F.lit(1), "weight")),
        )
        at = alone.join(roots, "forest").select(*_KEY, "id", "label", "train", _values(F.col("drawn")).alias("xs"))
    nodes, reached = _grow_joined(materialize(at), points, dims, places, max_depth, depth, nodes)
    votes = _shares(reached)
    return nodes, _voted(votes.unionByName(judged) if depth else votes)


def _grow_joined(
    at: DataFrame, points: DataFrame, dims: DataFrame, places: range, max_depth: int, first: int, nodes: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """The levels from ``first`` on, where the working table ``at`` stands."""
    reached = None
    for depth in range(first, max_depth + 1):
        seen = at.where("train")
        ends = [(name, j) for j in places for name in ("low", "high")]
        per_label = seen.groupBy(*_KEY, "label").agg(
            F.count(F.lit(1)).alias("n"),
            *((F.min if name == "low" else F.max)(F.get("xs", F.lit(j))).alias(f"{name}{j}") for name, j in ends),
        )

        def halves(tried: DataFrame) -> DataFrame:
            return seen.join(tried, _KEY).groupBy(*_KEY, "label").agg(
                F.count(F.lit(1)).alias("n"),
                F.first("thresholds").alias("thresholds"),
                *(F.sum((F.get("xs", F.lit(j)) <= F.get("thresholds", F.lit(j))).cast("long")).alias(f"left{j}") for j in places),
            )

        splits = materialize(_splits(per_label, halves, dims, places, leaf=depth == max_depth))
        plain = splits.drop("drawn0", "drawn1")
        nodes = plain if nodes is None else nodes.unionByName(plain)
        if depth < max_depth and not splits.where("threshold is not null").isEmpty():
            side = (F.get("features", F.col("dim")) > F.col("threshold")).cast("long")
            sent = at.drop("xs").join(splits, _KEY).join(points, "id")
            child = F.when(F.col("threshold").isNotNull(), 2 * F.col("node") + side)
            # a row that has come to a leaf keeps the leaf's counts and goes no further
            drawn = F.when(side == 0, F.col("drawn0")).otherwise(F.col("drawn1"))
            sent = materialize(
                sent.withColumn("xs", _values(drawn))
                .withColumn("counts", F.when(child.isNull(), F.col("counts")))
                .withColumn("node", child)
                .where("node is not null or not train")
                .select(*_KEY, "id", "label", "train", "counts", "xs")
            )
            settled, at = sent.where("node is null"), sent.where("node is not null").drop("counts")
        else:
            settled, at = at.where("not train").join(splits, _KEY), None
        settled = settled.select("forest", "tree", "id", "label", "counts")
        reached = settled if reached is None else reached.unionByName(settled)
        if at is None:
            break
    return nodes, reached


@dataclass
class _Held:
    """The forests as tasks hold them: a node is a slot, trees begin at the first slots, and the
    slots from ``first`` on are open: their draws are known and their rows not yet counted."""

    names: list[str]
    trees: int
    labels: list
    width: int
    first: int = 0
    last: int = DEEPEST + 1  # the last level; a row of an id with copies counts once more above it
    node: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    tree: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    dim: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    children: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), np.int32))
    drawn: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int32))
    shares: np.ndarray | None = None

    def size(self) -> int:
        return len(self.node)

    def n_open(self) -> int:
        return len(self.node) - self.first

    def _add(self, tree: np.ndarray, node: np.ndarray, drawn: np.ndarray) -> None:
        n = len(node)
        self.first = len(self.node)
        self.tree = np.concatenate([self.tree, tree.astype(np.int32)])
        self.node = np.concatenate([self.node, node.astype(np.int64)])
        self.dim = np.concatenate([self.dim, np.full(n, -1, np.int32)])
        self.threshold = np.concatenate([self.threshold, np.zeros(n)])
        self.children = np.concatenate([self.children, np.full((n, 2), -1, np.int32)])
        none = np.zeros((n, len(self.labels)))
        self.shares = none if self.shares is None else np.concatenate([self.shares, none])
        self.drawn = drawn

    def start(self, roots: pd.DataFrame) -> None:
        at = self._tree(roots)
        order = np.argsort(at)
        self._add(at[order], np.ones(len(at), np.int64), _draw_matrix(roots["drawn"])[order])

    def _tree(self, rows: pd.DataFrame) -> np.ndarray:
        number = {f: i for i, f in enumerate(self.names)}
        return rows["forest"].map(number).to_numpy(np.int64) * self.trees + rows["tree"].to_numpy(np.int64)

    def open_slots(self, rows: pd.DataFrame) -> np.ndarray:
        """The slots of open nodes (forest, tree, node)."""
        own = pd.MultiIndex.from_arrays([self.tree[self.first :], self.node[self.first :]])
        asked = pd.MultiIndex.from_arrays([self._tree(rows).astype(np.int32), rows["node"].to_numpy(np.int64)])
        return self.first + own.get_indexer(asked)

    def label_codes(self, labels: pa.Array) -> np.ndarray:
        """Places among the labels trained on; -1 for others."""
        given = [x for x in self.labels if x is not None]
        codes = pc.fill_null(pc.index_in(labels, value_set=pa.array(given, labels.type)), -1).to_numpy().astype(np.int64)
        if None in self.labels:
            codes[labels.is_null().to_numpy(zero_copy_only=False)] = len(given)
        return codes

    def judge(self, counts: pd.DataFrame) -> None:
        if len(counts):
            slots = self.open_slots(counts)
            known = pa.array([None if pd.isna(x) else int(x) for x in counts["label"]], pa.int64())
            self.shares[slots, self.label_codes(known)] = counts["n"].to_numpy(float)
            total = self.shares[self.first :].sum(1, keepdims=True)
            self.shares[self.first :] /= np.where(total > 0, total, 1.0)

    def split(self, inner: pd.DataFrame) -> None:
        slots = self.open_slots(inner) if len(inner) else np.zeros(0, np.int64)
        new = len(self.node) + np.arange(2 * len(slots)).reshape(-1, 2)
        self.dim[slots], self.threshold[slots], self.children[slots] = inner["dim"], inner["threshold"], new
        drawn = [_draw_matrix(inner[c]) for c in ("drawn0", "drawn1")]
        children = (2 * self.node[slots])[:, None] + np.arange(2)
        self._add(np.repeat(self.tree[slots], 2), children.ravel(), np.stack(drawn, 1).reshape(2 * len(slots), -1) if len(slots) else self.drawn[:0])

    def walk(self, root: int, x: np.ndarray, valid: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots that rows come to, how many steps they took, and whether they lack a value there."""
        cur, steps, lacking = np.full(len(x), root, np.int64), np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        live = np.arange(len(x))
        while True:
            c = cur[live]
            d = self.dim[c]
            go = d >= 0
            if valid is not None:
                lost = go & ~valid[live, d]
                lacking[live[lost]] = True
                go &= ~lost
            live, c, d = live[go], c[go], d[go]
            if not len(live):
                return cur, steps, lacking
            # NaN is above every threshold
            cur[live] = self.children[c, np.where(x[live, d] <= self.threshold[c], 0, 1)]
            steps[live] += 1

    def seen(self, batch: pa.RecordBatch, train: bool) -> Iterator[tuple]:
        """By tree: root, rows of the batch, their slots, for how many rows each stands, whether a value
        is lacking; and the batch's values."""
        x, valid = _dense(batch.column("features"), self.width)
        forests, rows = batch.column("forests"), np.arange(batch.num_rows)
        rows = np.repeat(rows, forests.value_lengths().to_numpy(zero_copy_only=False))
        wanted = pc.fill_null(batch.column("train").flatten(), False).to_numpy(zero_copy_only=False) == train
        if not train:
            wanted &= batch.column("train").flatten().is_valid().to_numpy(zero_copy_only=False)
        numbers, rows = forests.flatten().to_numpy(zero_copy_only=False)[wanted], rows[wanted]
        copies, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("copies", "weight"))
        order = np.argsort(numbers, kind="stable")
        numbers, rows = numbers[order], rows[order]
        for f in np.unique(numbers):
            own = rows[np.searchsorted(numbers, f) : np.searchsorted(numbers, f, "right")]
            mine, ok = x[own], None if valid is None else valid[own]
            for root in range(f * self.trees, (f + 1) * self.trees):
                slots, steps, lacking = self.walk(root, mine, ok)
                more = steps if train else steps + ((steps < self.last) & (slots < self.first))
                yield root, own, slots, weight[own] * copies[own] ** more, lacking, mine, ok

    def named(self, slots: np.ndarray) -> list[pa.Array]:
        """Forest, tree and node as columns."""
        trees = self.tree[slots]
        forests = pa.array(self.names, "string").take(pa.array(trees // self.trees))
        return [forests, pa.array((trees % self.trees).astype(np.int32)), pa.array(self.node[slots])]

    def counted(self, total: np.ndarray, kind: pa.DataType) -> tuple[np.ndarray, list[pa.Array]]:
        """Cells (open node x label) with rows, and their key columns with the count."""
        at = np.flatnonzero(total)
        labels = pa.array(self.labels, kind).take(pa.array(at % len(self.labels)))
        return at, [*self.named(self.first + at // len(self.labels)), labels, pa.array(total[at])]


def _draw_matrix(drawn: pd.Series) -> np.ndarray:
    """Dimensions by place, -1 where none is drawn."""
    rows = [[-1 if v is None or v != v else int(v) for v in row] for row in drawn]
    return np.array(rows, np.int32).reshape(len(rows), -1) if rows else np.zeros((0, 0), np.int32)


def _dense(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Values as a matrix, and which of them are given; None if all are."""
    sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
    values = lists.flatten()
    rows = np.repeat(np.arange(len(lists)), sizes)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    given = values.is_valid().to_numpy(zero_copy_only=False) & (place < width)
    x = np.zeros((len(lists), width))
    x[rows[given], place[given]] = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)[given]
    if given.sum() == x.size:
        return x, None
    valid = np.zeros(x.shape, bool)
    valid[rows[given], place[given]] = True
    return x, valid


_Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _open_cells(held: _Held, batch: pa.RecordBatch) -> Iterator[tuple]:
    """Training rows at open nodes, by tree: (cells, weights, open nodes, values and which are given by place)."""
    codes = held.label_codes(batch.column("label"))
    for _, own, slots, weight, _, x, valid in held.seen(batch, True):
        at = np.flatnonzero(slots >= held.first)
        if not len(at):
            continue
        place = slots[at] - held.first
        drawn = held.drawn[place]

        def values(j: int) -> tuple[np.ndarray, np.ndarray]:
            d = drawn[:, j]
            return x[at, d], (d >= 0) if valid is None else (d >= 0) & valid[at, d]

        yield place * len(held.labels) + codes[own[at]], weight[at], place, values


def _ranges(held: _Held, draws: int) -> _Run:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = held.n_open() * len(held.labels)
        total, kind = np.zeros(cells, np.int64), None
        low, high = np.full((draws, cells), np.inf), np.full((draws, cells), -np.inf)
        for batch in batches:
            kind = batch.column("label").type
            for cell, weight, _, values in _open_cells(held, batch):
                np.add.at(total, cell, weight)
                for j in range(draws):
                    v, ok = values(j)
                    v, c = (v, cell) if ok.all() else (v[ok], cell[ok])
                    np.fmin.at(low[j], c, v)
                    np.maximum.at(high[j], c, v)
        if kind is None:
            return
        at, columns = held.counted(total, kind)
        names = ["forest", "tree", "node", "label", "n"]
        for j in range(draws):
            lows, highs = low[j, at], high[j, at]
            none = (lows == np.inf) & (highs == -np.inf)
            lows = np.where(np.isnan(highs) & (lows == np.inf), np.nan, lows)
            columns += [pa.array(lows, mask=none), pa.array(highs, mask=none)]
            names += [f"low{j}", f"high{j}"]
        yield from pa.Table.from_arrays(columns, names).to_batches(65_536)

    return run


def _lefts(held: _Held, draws: int, tried: pd.DataFrame) -> _Run:
    thresholds = np.full((draws, held.n_open()), np.nan)
    if len(tried):
        rows = np.array([[np.nan if v is None else v for v in row] for row in tried["thresholds"]], float)
        thresholds[:, held.open_slots(tried) - held.first] = rows.T
    given = np.zeros((draws, held.n_open()), bool)
    if len(tried):
        own = np.array([[v is not None and v == v for v in row] for row in tried["thresholds"]])
        given[:, held.open_slots(tried) - held.first] = own.T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = held.n_open() * len(held.labels)
        total, left, kind = np.zeros(cells, np.int64), np.zeros((draws, cells), np.int64), None
        known = np.zeros((draws, cells), bool)
        for batch in batches:
            kind = batch.column("label").type
            for cell, weight, place, values in _open_cells(held, batch):
                np.add.at(total, cell, weight)
                for j in range(draws):
                    v, ok = values(j)
                    ok = ok & given[j, place]
                    known[j, cell[ok]] = True
                    inside = ok & (v <= thresholds[j, place])
                    np.add.at(left[j], cell[inside], weight[inside])
        if kind is None:
            return
        at, columns = held.counted(total, kind)
        columns += [pa.array(left[j, at], mask=~known[j, at]) for j in range(draws)]
        names = ["forest", "tree", "node", "label", "n", *(f"left{j}" for j in range(draws))]
        yield from pa.Table.from_arrays(columns, names).to_batches(65_536)

    return run


def _judges(held: _Held, lacking_too: bool = True) -> _Run:
    """(forest, id, label, class, share): the sums over trees of the shares where rows have come to rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = None
            for root, own, slots, weight, lacking, _, _ in held.seen(batch, False):
                sums = np.zeros((len(own), len(held.labels))) if sums is None else sums
                rests = (slots < held.first) & (lacking_too | ~lacking)
                sums += held.shares[slots] * (weight * rests)[:, None]
                if (root + 1) % held.trees == 0:
                    yield from _vote_rows(held, batch, root // held.trees, own, sums)
                    sums = None

    return run


def _vote_rows(held: _Held, batch: pa.RecordBatch, forest: int, own: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    row, label = np.nonzero(sums)
    if len(row):
        of, kind = pa.array(own[row]), batch.column("label").type
        columns = [
            pa.array([held.names[forest]], "string").take(pa.array(np.zeros(len(row), np.int64))),
            batch.column("id").take(of), batch.column("label").take(of),
            pa.array(held.labels, kind).take(pa.array(label)), pa.array(sums[row, label]),
        ]
        yield pa.record_batch(columns, names=["forest", "id", "label", "class", "share"])


def _opened(held: _Held) -> _Run:
    """Rows at open nodes, one for each tree, as the joined way has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for train in (True, False):
                for _, own, slots, weight, _, x, valid in held.seen(batch, train):
                    at = np.flatnonzero(slots >= held.first)
                    at = np.repeat(at, weight[at])
                    if not len(at):
                        continue
                    drawn = held.drawn[slots[at] - held.first]
                    ok = drawn >= 0 if valid is None else (drawn >= 0) & valid[at[:, None], drawn]
                    flat = pa.array(x[at[:, None], drawn].ravel(), mask=~ok.ravel())
                    ends = np.arange(len(at) + 1, dtype=np.int32) * drawn.shape[1]
                    of = pa.array(own[at])
                    columns = [
                        *held.named(slots[at]), batch.column("id").take(of), batch.column("label").take(of),
                        pa.array(np.full(len(at), train)), pa.ListArray.from_arrays(pa.array(ends), flat),
                    ]
                    yield pa.record_batch(columns, names=["forest", "tree", "node", "id", "label", "train", "xs"])

    return run


def _splits(
    per_label: DataFrame, halves_of: Callable[[DataFrame], DataFrame], dims: DataFrame, places: range, leaf: bool
) -> DataFrame:
    """The nodes of a level from the counts and ranges of their labels; ``halves_of`` counts, by label,
    the rows on the left of thresholds."""
    ends = [(name, j) for j in places for name in ("low", "high")]
    if leaf:
        none = F.lit(None)
        return per_label.groupBy(*_KEY).agg(
            none.cast("int").alias("dim"), none.cast("double").alias("threshold"), _counts(),
            *(none.cast("array<int>").alias(c) for c in ("drawn0", "drawn1")),
        )
    ranges = per_label.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("labels"),
        *((F.min if name == "low" else F.max)(f"{name}{j}").alias(f"{name}{j}") for name, j in ends),
    )

    def threshold(j: int) -> Column:
        low, high = F.col(f"low{j}"), F.col(f"high{j}")
        drawn = low + _share(_digest(F.col("node"), j), 9) * (high - low)
        # rounding must not leave the right half empty
        return F.when((low < high) & (F.col("labels") > 1), F.when(drawn < high, drawn).otherwise(low))

    tried = ranges.select(*_KEY, F.array(*map(threshold, places)).alias("thresholds"))
    halves = halves_of(tried)

    def purity(j: int) -> Column:
        a = F.col(f"left{j}")
        b = F.col("n") - a
        return F.round(
            F.sum(a * a).cast("double") / F.sum(a) + F.sum(b * b).cast("double") / F.sum(b), DIGITS
        )

    tally = halves.groupBy(*_KEY).agg(
        _counts(), F.first("thresholds").alias("thresholds"), *(purity(j).alias(f"purity{j}") for j in places)
    )
    each = F.array(*(F.struct(F.col(f"purity{j}").alias("purity"), F.lit(-j).alias("j")) for j in places))
    best = -F.array_max(F.filter(each, lambda x: x["purity"].isNotNull()))["j"]
    drawn = _drawn(F.col("node"), len(places))
    inner = F.col("best").isNotNull()
    return tally.withColumn("best", best).join(dims, "forest").select(
        *_KEY, F.when(inner, F.get(drawn, F.col("best"))).alias("dim"),
        F.get("thresholds", F.col("best")).alias("threshold"), "counts",
        *(F.when(inner, _drawn(2 * F.col("node") + i, len(places))).alias(f"drawn{i}") for i in (0, 1)),
    )


def _counts() -> Column:
    return F.array_sort(F.collect_list(F.struct("label", "n"))).alias("counts")


def _shares(reached: DataFrame) -> DataFrame:
    """(forest, id, label, class, share) of the leaves that rows have come to."""
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda acc, c: acc + c["n"])
    return reached.withColumn("total", total).select(
        "forest", "id", "label", "total", F.explode("counts").alias("c")
    ).select("forest", "id", "label", F.col("c.label").alias("class"), (F.col("c.n") / F.col("total")).alias("share"))


def _voted(shares: DataFrame) -> DataFrame:
    """The mean over trees of the leaves' class shares; the largest wins, ties to the smaller label."""
    tally = shares.groupBy("forest", "id", "label", "class").agg(F.round(F.sum("share"), DIGITS).alias("share"))
    top = F.max_by("class", F.struct(F.col("share"), -F.col("class")))
    return tally.groupBy("forest", "id", "label").agg(top.alias("pred"))


def predict(nodes: DataFrame, rows: DataFrame, trees: int = 50) -> DataFrame:
    """(id, pred) of the rows (id, features) by the one forest in ``nodes``."""
    forest = nodes.drop("forest")
    labels = [r["label"] for r in forest.select(F.explode("counts.label").alias("label")).distinct().limit(HELD_CELLS + 1).collect()]
    if forest.count() * max(1, len(labels)) <= HELD_CELLS:
        return _predict_held(forest, rows, trees, labels)
    at = rows.select("id", F.explode(F.array(*map(F.lit, range(trees)))).alias("tree"), F.lit(1).cast("long").alias("node"))
    reached = None
    while True:
        met = materialize(at.join(forest, ["tree", "node"]))
        settled = met.where("threshold is null").select(
            F.lit("").alias("forest"), "id", F.lit(None).cast("int").alias("label"), "counts"
        )
        reached = settled if reached is None else reached.unionByName(settled)
        inner = met.where("threshold is not null").drop("counts")
        if inner.isEmpty():
            break
        side = (F.get("features", F.col("dim")) > F.col("threshold")).cast("long")
        at = inner.join(rows.select("id", "features"), "id").select("id", "tree", (2 * F.col("node") + side).alias("node"))
    return _voted(_shares(reached)).select("id", "pred")


def _predict_held(forest: DataFrame, rows: DataFrame, trees: int, labels: list) -> DataFrame:
    """The same with the forest's nodes in every task."""
    known = forest.select(F.lit("").alias("forest"), "tree", "node", "dim", "threshold").where(F.col("tree") < trees).toPandas()
    width = int(known["dim"].max()) + 1 if known["dim"].notna().any() else 1
    held = _Held([""], trees, sorted(x for x in labels if x is not None) + [None] * (None in labels), width)
    rank = known["node"].to_numpy(np.int64) != 1
    roots = known[~rank].set_index("tree").reindex(range(trees)).reset_index()
    # a slot for each tree's root, then the others
    tree = np.concatenate([np.arange(trees), known["tree"].to_numpy()[rank]])
    node = np.concatenate([np.ones(trees, np.int64), known["node"].to_numpy(np.int64)[rank]])
    every = pd.concat([roots, known[rank]])
    held._add(tree, node, np.zeros((0, 0), np.int32))
    held.judge(forest.where(F.col("tree") < trees).select(F.lit("").alias("forest"), "tree", "node", F.inline("counts")).toPandas())
    inner = every["threshold"].notna().to_numpy()
    held.dim[inner], held.threshold[inner] = every["dim"].to_numpy()[inner], every["threshold"].to_numpy()[inner]
    own = pd.MultiIndex.from_arrays([tree, node])
    for side in (0, 1):
        held.children[:, side] = own.get_indexer(pd.MultiIndex.from_arrays([tree, 2 * node + side]))
    held.first, held.last = held.size(), 0
    copies = F.count(F.lit(1)).over(Window.partitionBy("id"))
    kind = dict(forest.select(F.explode("counts.label").alias("label")).dtypes)["label"]
    packed = rows.select("id", F.when(F.col("id").isNotNull(), F.col("features")).alias("features")).select(
        "id", F.lit(None).cast(kind).alias("label"), "features", F.array(F.lit(0)).alias("forests"),
        F.array(F.lit(False)).alias("train"), copies.alias("copies"), F.lit(1).cast("long").alias("weight"),
    )
    tag = dict(rows.dtypes)["id"]
    # as where a join led on: a row that lacks a value has no judgement of that tree
    judged = packed.mapInArrow(_judges(held, False), f"forest string, id {tag}, label {kind}, class {kind}, share double")
    return _voted(judged).select("id", "pred")


def search(
    folded: DataFrame, selected: DataFrame, trees: int = 50, max_depth: int = DEEPEST
) -> DataFrame:
    """(percentile, mean, std): accuracy over folds of a forest per fold and share of dimensions.

    ``folded``: id, label, fold, features; ``selected``: fold, percentile, dims, fitted on the rows
    outside the fold. All forests grow at once.
    """
    dims = materialize(selected.withColumn("forest", F.concat_ws("-", "percentile", "fold")))
    # settings x folds names: bounded by the search
    settings = {r["forest"]: r["fold"] for r in dims.drop("dims").collect()}
    names = sorted(settings)
    copies = F.count(F.lit(1)).over(Window.partitionBy("id"))
    # a row is in all forests: it travels once
    packed = folded.where("id is not null").withColumn("copies", copies).select(
        "id", "label", "features", F.array(*map(F.lit, range(len(names)))).alias("forests"),
        F.transform(F.array(*(F.lit(settings[f]) for f in names)), lambda h: F.col("fold") != h).alias("train"),
        "copies", F.col("copies").alias("weight"),
    )
    _, judged = _grow(packed, folded.select("id", "features"), dims, names, trees, max_depth)
    hits = judged.join(dims.select("forest", "percentile", "fold"), "forest").groupBy("percentile", "fold").agg(
        F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy")
    )
    return hits.groupBy("percentile").agg(
        F.avg("accuracy").alias("mean"), F.stddev_pop("accuracy").alias("std")
    )


def best_percentile(scores: DataFrame) -> int:
    """The share with the best mean, ties to the smaller one."""
    return scores.orderBy(F.round("mean", DIGITS).desc(), "percentile").first()["percentile"]
