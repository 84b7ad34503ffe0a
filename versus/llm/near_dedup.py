"""Near-duplicate documents: MinHash with tensored banding, exact links, components.

A document's set holds its distinct word shingles. Two collections of ``WIDTH`` band hashes of
``ROWS`` minhashes each are computed per set; a table's key combines one hash of either
collection, so WIDTH x WIDTH tables of 2 x ROWS minhashes come from 2 x WIDTH x ROWS minhashes
instead of that product. At a similarity of 0.8 a pair of sets meets in some table with
probability (1 - (1 - 0.8^3)^12)^2, about 0.9996.

Nothing is dealt out by pairs. Equal sets are one class. In each table every member of a key is
tied to the smallest member (first within a task, then between tasks), and ties are verified on
full sets: first one tie of each class, then those between different components. Keys that still
hold several components are the exact rest: their classes are compared in blocks of bounded size,
each outside the largest component against all others, and only links leave a block. So no two
classes of different components that met in a table stay uncompared.

Documents with fewer words than a shingle form one shingle of all their words; those without
words have an empty set, are linked with nothing and kept. Null text counts as empty. A row
without id is linked with nothing and kept. Rows of one id are one document: if any of its texts
links, all do. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versus.llm import arrays
from versus.llm.common import buckets, ship, table
from versus.llm.components import connected
from versus.session import materialize

WIDTH = 12
ROWS = 3
BLOCK = 512  # classes compared at a time in the exact rest

_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 1 << 64, 2 * WIDTH * ROWS, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 64, 2 * WIDTH * ROWS, dtype=np.uint64) | np.uint64(1)


def band_hashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The 2 x WIDTH hashes of each set; sets must not be empty."""
    out = np.zeros((len(bounds) - 1, 2 * WIDTH), np.uint64)
    for band in range(2 * WIDTH):
        for i in range(band * ROWS, (band + 1) * ROWS):
            low = np.minimum.reduceat((values ^ _XOR[i]) * _ODD[i], bounds[:-1])
            out[:, band] = arrays.combine(out[:, band] + np.uint64(band), low)
    return out


def table_keys(bands: np.ndarray) -> np.ndarray:
    """The keys of all tables, one column per pair of band hashes."""
    left = np.repeat(bands[:, :WIDTH], WIDTH, axis=1)
    return arrays.combine(left, np.tile(bands[:, WIDTH:], (1, WIDTH)))


def sets(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n (size of the set), h1, h2 (its digest) and bands; digests of empty sets are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in arrays.slices(batch.column(1)):
                part = batch.slice(start, stop - start)
                values, bounds = arrays.shingles(*arrays.words(part.column(1)), size)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                bands: list = [None] * len(n)
                if len(full):
                    found = band_hashes(values, np.append(bounds[full], len(values)))
                    for i, row in zip(full, found, strict=True):
                        bands[i] = row.tobytes()
                digests = [
                    np.frombuffer(hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest(), "<i8")
                    if b > a else (None, None)
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n, pa.int64()),
                        *(pa.array([None if d[k] is None else int(d[k]) for d in digests], pa.int64())
                          for k in (0, 1)),
                        pa.array(bands, pa.binary()),
                    ],
                    names=["doc_id", "n", "h1", "h2", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, h1 long, h2 long, bands binary"
    )


def _runs(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by key and id: the keys, the ids, and for each the smallest id with its key."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return keys, ids, ids[first][np.cumsum(first) - 1]


def _ties(keys: np.ndarray, ids: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    """(x, y, keys): the pairs of a member and the smallest one, each once with all its keys."""
    own = ids != low
    order = np.lexsort((keys[own], ids[own], low[own]))
    keys, x, y = keys[own][order], ids[own][order], low[own][order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    first = np.flatnonzero(new)
    packed = [keys[a:b].tobytes() for a, b in zip(first, np.append(first, len(x))[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(x[first]), pa.array(y[first]), pa.array(packed, pa.binary())], names=["x", "y", "keys"]
    )


def ties(classes: DataFrame) -> DataFrame:
    """(x, y, keys): classes that meet under keys; every member but the smallest is an x. A pair is
    one row for each task that finds it, whatever the number of its keys."""
    shards = buckets(classes, least=128)
    shift = np.uint64(64 - (shards.bit_length() - 1))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5000):
                part = batch.slice(at, 5000)
                bands = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u8")
                keys = table_keys(bands.reshape(-1, 2 * WIDTH))
                ids = np.repeat(part.column(0).to_numpy(), keys.shape[1])
                keys, ids, low = _runs(keys.ravel(), ids)
                yield _ties(keys, ids, low)
                one = ids == low  # one entry per key leaves the task
                keys, ids = keys[one], ids[one]
                own, first = np.unique(keys >> shift, return_index=True)
                ends = [*first[1:], len(keys)]
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(own.astype(np.int64)),
                    "keys": pa.array([keys[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
                    "ids": pa.array([ids[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()),
                })

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ties of a task, and what goes to the shards of keys, in rows of one schema."""
        kinds = pa.schema([("bucket", pa.int64()), ("ids", pa.binary()), ("x", pa.int64()), ("y", pa.int64()),
                           ("keys", pa.binary())])
        for part in spread(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(f.name) if f.name in part.schema.names else pa.nulls(part.num_rows, f.type) for f in kinds],
                schema=kinds,
            )

    def meet(parts: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(parts["keys"]), "<u8")
        ids = np.frombuffer(b"".join(parts["ids"]), "<i8")
        return _ties(*_runs(keys, ids)).to_pandas()

    dealt = materialize(
        classes.select("rep", "bands").mapInArrow(both, "bucket long, ids binary, x long, y long, keys binary")
    )
    inner = dealt.where("bucket is null").select("x", "y", "keys")
    outer = dealt.where("bucket is not null").select("bucket", "keys", "ids").groupBy("bucket").applyInPandas(
        meet, "x long, y long, keys binary"
    )
    return materialize(inner.unionByName(outer))


def _unfolded(met: DataFrame) -> DataFrame:
    """(key, x, y, cx, cy) of ties (x, y, cx, cy, keys)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.frombuffer(k.as_buffer(), "<i8") for k in batch.column(4)]
            if keys:
                at = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), *(batch.column(i).take(at) for i in range(4))],
                    names=["key", "x", "y", "cx", "cy"],
                )

    return met.select("x", "y", "cx", "cy", "keys").mapInArrow(run, "key long, x long, y long, cx long, cy long")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = int((b[at] == a).sum())
    return 100 * same >= percent * (len(a) + len(b) - same)


def verify(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Those pairs (x, y) whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            good = [
                _similar(np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8"), percent)
                for a, b in zip(left, right, strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(full.select(F.col("id").alias("x"), F.col("values").alias("a")), "x").join(
        full.select(F.col("id").alias("y"), F.col("values").alias("b")), "y"
    )
    return materialize(joined.select("x", "y", "a", "b").mapInArrow(run, "x long, y long"))


def _labelled(pairs: DataFrame, component: DataFrame) -> DataFrame:
    for c in ("x", "y"):
        labels = component.select(F.col("id").alias(c), F.col("component").alias(f"c{c}"))
        pairs = pairs.join(labels, c, "left").withColumn(f"c{c}", F.coalesce(f"c{c}", c))
    return pairs


def _rest(met: DataFrame, component: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a key of three or more classes."""
    labelled = materialize(_labelled(met, component))
    across = labelled.where("cx <> cy")
    live = across.select("cx").unionByName(across.select(F.col("cy").alias("cx"))).distinct()
    # the keys of components that meet no other are never unfolded
    labelled = materialize(_unfolded(labelled.join(live, "cx", "left_semi")))
    mixed = (
        labelled.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.min(F.least("cx", "cy")).alias("low"),
            F.max(F.greatest("cx", "cy")).alias("high"),
        )
        .where("n >= 2 and low <> high")
        .select("key")
    )
    cluster = connected(labelled.join(mixed, "key", "left_semi").select("x", "y"))
    label = component.select("id", F.col("component").alias("own"))
    members = materialize(
        cluster.withColumnRenamed("component", "cluster")
        .join(label, "id", "left")
        .withColumn("own", F.coalesce("own", "id"))
    )
    main = (
        members.groupBy("cluster", "own")
        .count()
        .groupBy("cluster")
        .agg(F.max(F.struct("count", "own")).alias("top"), F.sum("count").alias("n"))
        .select("cluster", F.col("top.own").alias("main"),
                F.ceil(F.col("n") / BLOCK).alias("all_blocks"),
                F.ceil((F.col("n") - F.col("top.count")) / BLOCK).alias("other_blocks"))
        .where("other_blocks > 0")
    )
    placed = members.join(main, "cluster").join(full, "id")
    h = F.xxhash64("id")
    ones = placed.where("own <> main").select(
        "cluster", "id", "own", "values", F.lit(True).alias("one"),
        F.pmod(h, "other_blocks").alias("a"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_blocks") - 1)).alias("b"),
    )
    others = placed.select(
        "cluster", "id", "own", "values", F.lit(False).alias("one"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_blocks") - 1)).alias("a"),
        F.pmod(h, "all_blocks").alias("b"),
    )

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        one, other = block[block["one"]], block[~block["one"]]
        found = []
        if len(one) and len(other):
            size = np.array([len(v) // 8 for v in other["values"]])
            flat = np.frombuffer(b"".join(other["values"]), "<u8")
            first = np.cumsum(size) - size
            ids, owns = other["id"].to_numpy(), other["own"].to_numpy()
            for x, own, values in zip(one["id"], one["own"], one["values"], strict=True):
                mine = np.frombuffer(values, "<u8")
                at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
                same = np.add.reduceat((mine[at] == flat).astype(np.int64), first)
                near = 100 * same >= percent * (len(mine) + size - same)
                near &= owns != own
                _, pick = np.unique(owns[near], return_index=True)  # one link to a component
                found += [(x, y) for y in ids[near][pick]]
        return pd.DataFrame(found, columns=["x", "y"], dtype="int64")

    return materialize(
        ones.unionByName(others).groupBy("cluster", "a", "b").applyInPandas(compare, "x long, y long")
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept, per row of ``docs``."""
    found = materialize(sets(docs, size))
    usable = found.where("n > 0 and doc_id is not null")
    classes = materialize(
        usable.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    )
    met = ties(classes)
    involved = met.select(F.col("x").alias("id")).unionByName(
        met.select(F.col("y").alias("id"))
    ).distinct()

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in arrays.slices(batch.column(1)):
                part = batch.slice(start, stop - start)
                flat, bounds = arrays.shingles(*arrays.words(part.column(1)), size)
                own = [flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(own, pa.binary())], names=["id", "values"]
                ).filter(pa.array(np.diff(bounds) > 0))

    full = materialize(
        docs.select(F.col("doc_id").alias("id"), "text")
        .join(involved, "id", "left_semi")
        .mapInArrow(values, "id long, values binary")
    )
    one = met.groupBy("x").agg(F.min("y").alias("y"))
    links = verify(one, full, percent)
    component = connected(links)
    further = _labelled(met.select("x", "y").distinct(), component).where("cx <> cy")
    links = links.unionByName(verify(further.select("x", "y"), full, percent))
    component = connected(links)
    links = links.unionByName(_rest(met, component, full, percent))
    component = connected(links)

    of_class = classes.select("h1", "h2", "rep").join(
        component.withColumnRenamed("id", "rep"), "rep", "left"
    ).select("h1", "h2", F.coalesce("component", "rep").alias("component_id"))
    linked = usable.join(of_class, ["h1", "h2"]).select("doc_id", "n", "component_id")
    alone = found.where("n = 0 or doc_id is null").select(
        "doc_id", "n", F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a similarity of 0.8 or more of their two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles) stays, with its columns."""
    ship(spark)
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE = {
    "op10_near_dedup": rf"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
pieces AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM pieces GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM pieces a JOIN pieces b USING (g)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, ways.y FROM reach JOIN ways ON ways.x = reach.r),
found AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM found LEFT JOIN sizes USING (doc_id)""",
}
