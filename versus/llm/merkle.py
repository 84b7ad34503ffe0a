"""Merkle manifest of a dataset, from SHA-256 midstates.

Every document is a leaf, the hash of its columns. The leaves of a source, by id, are hashed
upwards in runs of ``FAN``; the sources' roots likewise, by source (null first, bytewise).

A digest in hex is one block of SHA-256, so the state before a child slot of a parent is eight
words. Parents keep a copy of that state for every slot. To fold a replaced leaf upwards, the state
that matches its slot is resumed with the replacement and the siblings to its right only; nothing to
its left is read again. The states are numbers, not library objects, so they are stored with the
tree and resumed by any task.

*At scale.* Leaves are range-partitioned by source and id, so a source may lie in many partitions;
their places follow from sums of counts. ``FAN ** depth`` neighbouring leaves are one row, which
holds their digests and their parents' digests and states; the heads of these rows are the leaves
of the next pass, until one is left for every source. Paths travel the other way, from a row's head
to its leaves. So no task holds more than ``FAN ** depth`` nodes, and texts are read once.

Null columns are hashed as ``-``. Rows without id come first in their source and are not tampered
with; equal ids are ordered by leaf, and repeated rows are leaves each. Empty and very long texts
are hashed like others. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from versus.llm.common import table
from versus.session import materialize

FAN = 3
DEPTH = 6

_U = np.uint32


def _cube_root(n: int) -> int:
    x = 1 << -(-n.bit_length() // 3)
    while (y := (2 * x + n // (x * x)) // 3) < x:
        x = y
    return x


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, isqrt(p) + 1))]
#: The constants of SHA-256: fractions of the square and cube roots of the first primes.
_START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _PRIMES[:8]], _U)
_ROUND = [_U(_cube_root(p << 96) & 0xFFFFFFFF) for p in _PRIMES]
_HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> _U(n)) | (x << _U(32 - n))


def compress(state: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The states (8, n) after one more block (16, n) each."""
    w = list(words)
    for i in range(16, 64):
        x, y = w[i - 15], w[i - 2]
        w.append(w[i - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> _U(3))) + w[i - 7]
                 + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> _U(10))))
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[i] + w[i]
        u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def _words(digests: np.ndarray) -> np.ndarray:
    """The hex text of digests (n, 32) as blocks (16, n)."""
    return np.ascontiguousarray(_HEX[digests].reshape(len(digests), 64).view(">u4").astype(_U).T)


def _ended(state: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The digests (n, 32) of messages of ``width`` blocks, from the states after them."""
    last = np.zeros((16, len(width)), _U)
    last[0] = 0x80000000
    last[15] = 512 * width
    return _bytes(compress(state, last).T)


def _bytes(state: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(state).astype(">u4").view(np.uint8).reshape(*state.shape[:-1], 32)


def _state(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw).view(">u4").astype(_U)


def parents(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of nodes (m, 32): the digests of their parents, and the states before each slot."""
    n = -(-len(nodes) // FAN)
    state = np.repeat(_START[:, None], n, axis=1)
    kept = np.empty((n, FAN, 32), np.uint8)
    for slot in range(FAN):
        kept[:, slot] = _bytes(state.T)
        own = nodes[slot::FAN]
        state[:, : len(own)] = compress(state[:, : len(own)], _words(own))
    width = np.minimum(FAN, len(nodes) - FAN * np.arange(n))
    return _ended(state, width), kept


def tree(leaves: np.ndarray, height: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The nodes of every level from the leaves up, and the states their parents keep."""
    levels, states = [leaves], []
    for _ in range(height):
        up, kept = parents(levels[-1])
        levels.append(up)
        states.append(kept)
    return levels, states


#: A step of a path: width of the run, own slot, state before the slot, the other siblings.
_STEP = 2 + 32 + 32 * (FAN - 1)


def steps(levels: list[np.ndarray], states: list[np.ndarray]) -> np.ndarray:
    """The way up of every leaf, (n, height, _STEP)."""
    n = len(levels[0])
    out = np.zeros((n, len(states), _STEP), np.uint8)
    at = np.arange(n)
    for i, kept in enumerate(states):
        up, slot, m = at // FAN, at % FAN, len(levels[i])
        out[:, i, 0] = np.minimum(FAN, m - FAN * up)
        out[:, i, 1] = slot
        out[:, i, 2:34] = kept[up, slot]
        for j in range(FAN - 1):
            other = FAN * up + j + (j >= slot)
            there = other < np.minimum(m, FAN * up + FAN)
            out[there, i, 34 + 32 * j : 66 + 32 * j] = levels[i][other[there]]
        at = up
    return out


def fold(leaves: np.ndarray, way: np.ndarray) -> np.ndarray:
    """The digests reached from ``leaves`` (n, 32) by their ways up: kept states are resumed with
    the node and the siblings to its right."""
    for i in range(way.shape[1]):
        width, slot = way[:, i, 0].astype(np.int64), way[:, i, 1].astype(np.int64)
        state = compress(_state(way[:, i, 2:34]).T, _words(leaves))
        for j in range(FAN - 1):
            right = np.flatnonzero((j >= slot) & (j < width - 1))
            if len(right):
                state[:, right] = compress(
                    np.ascontiguousarray(state[:, right]), _words(way[right, i, 34 + 32 * j : 66 + 32 * j])
                )
        leaves = _ended(state, width)
    return leaves


def proofs(way: np.ndarray) -> list[str]:
    """The digest of the siblings on each way up, left to right and upwards."""
    there = np.arange(FAN - 1) < way[:, :, :1].astype(np.int64) - 1
    text = _HEX[way[:, :, 34:].reshape(*way.shape[:2], FAN - 1, 32)[there]].tobytes()
    ends = 64 * np.cumsum(there.sum((1, 2)))
    return [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def height(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _raw(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(-1, 32)


_BLOCKS = ("g string, block long, total long, head binary, ids array<string>, leaves binary, "
           "others binary, upper binary, states binary")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted rows of one group as one row: the digests as one value."""
    number = 0
    for batch in batches:
        own = batch.column(1).to_pylist()
        edges = [0, *(i for i in range(1, len(own)) if own[i] != own[i - 1]), len(own)]
        rows = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            part = batch.slice(a, b - a)
            rows.append({
                "part": part.column(0)[0].as_py(), "no": number, "g": own[a], "n": b - a,
                "ids": part.column(2).to_pylist(),
                "leaves": b"".join(part.column(3).to_pylist()), "others": b"".join(part.column(4).to_pylist()),
            })
            number += 1
        if own:
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("part", pa.int64()), ("no", pa.int64()), ("g", pa.string()), ("n", pa.int64()),
                ("ids", pa.list_(pa.string())), ("leaves", pa.binary()), ("others", pa.binary()),
            ]))


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Runs of leaves as parts of blocks of ``size``."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            at = 0
            while at < r["n"]:
                place = r["start"] + at
                stop = min(r["n"], at + size - place % size)
                rows.append({
                    "g": r["g"], "block": place // size, "start": place, "total": r["total"],
                    "ids": r["ids"][at:stop], "leaves": r["leaves"][32 * at : 32 * stop],
                    "others": r["others"][32 * at : 32 * stop],
                })
                at = stop
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("g", pa.string()), ("block", pa.int64()), ("start", pa.int64()), ("total", pa.int64()),
                ("ids", pa.list_(pa.string())), ("leaves", pa.binary()), ("others", pa.binary()),
            ]))


def _build(parts: pd.DataFrame, depth: int) -> pd.DataFrame:
    """A block of leaves with their parents; as high as the group's tree goes, ``depth`` at most."""
    parts = parts.sort_values("start")
    leaves = _raw(b"".join(parts["leaves"]))
    total = int(parts["total"].iloc[0])
    levels, states = tree(leaves, min(depth, height(total)))
    return pd.DataFrame({
        "g": parts["g"].iloc[:1].to_list(), "block": parts["block"].iloc[:1].to_list(), "total": [total],
        "head": [levels[-1][0].tobytes()], "ids": [[i for x in parts["ids"] for i in x]],
        "leaves": [leaves.tobytes()], "others": [b"".join(parts["others"])],
        "upper": [b"".join(x.tobytes() for x in levels[1:])],
        "states": [b"".join(x.tobytes() for x in states)],
    })


def forest(rows: DataFrame, order: list[str], depth: int) -> list[DataFrame]:
    """Trees over the rows of each group ``g`` by ``order``: rows of ``_BLOCKS`` for every pass.

    ``rows`` have g, id (text), leaf and other (32 bytes each); null sorts first.
    """
    keys, size = ["g", *order], FAN**depth
    build = lambda parts: _build(parts, depth)
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    packed = materialize(
        ranged.select(F.spark_partition_id().cast("long").alias("part"), "g", "id", "leaf", "other").mapInArrow(
            _pack, "part long, no long, g string, n long, ids array<string>, leaves binary, others binary"
        )
    )
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("g", "part").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    # a group has at most one row for every partition here
    offsets = packed.groupBy("g", "part").agg(F.sum("n").alias("n")).select(
        "g", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy("g")).alias("total"),
    )
    places = packed.select("g", "part", "no", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("own")).join(
        offsets, ["g", "part"]
    ).select("part", "no", "total", (F.col("offset") + F.col("own")).alias("start"))
    parts = packed.join(places, ["part", "no"]).select(
        "g", "start", "total", "n", "ids", "leaves", "others"
    ).mapInArrow(lambda x: _cut(x, size), "g string, block long, start long, total long, ids array<string>, leaves binary, others binary")
    passes = [materialize(parts.groupBy("g", "block").applyInPandas(build, _BLOCKS))]
    while (passes[-1].agg(F.max("total")).first()[0] or 0) > size:
        heads = passes[-1].where(F.col("total") > size).select(
            "g", F.floor(F.col("block") / size).alias("block"), F.col("block").alias("start"),
            F.ceil(F.col("total") / size).alias("total"), F.array().cast("array<string>").alias("ids"),
            F.col("head").alias("leaves"), F.lit(b"").alias("others"),
        )
        passes.append(materialize(heads.groupBy("g", "block").applyInPandas(build, _BLOCKS)))
    return passes


def _ways(row: dict) -> np.ndarray:
    """The ways up of a block's leaves, first inside it, then from its head."""
    n = len(row["leaves"]) // 32
    levels, states, at, below = [_raw(row["leaves"])], [], 0, 0
    upper, kept = _raw(row["upper"]), np.frombuffer(row["states"], np.uint8).reshape(-1, FAN, 32)
    while at < len(upper):
        below = -(-len(levels[-1]) // FAN)
        levels.append(upper[at : at + below])
        states.append(kept[at : at + below])
        at += below
    own = steps(levels, states)
    above = np.frombuffer(b"".join(row[c] for c in ("path", "top") if row.get(c)), np.uint8).reshape(1, -1, _STEP)
    return np.concatenate([own, np.repeat(above, n, axis=0)], axis=1)


def _down(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The ways up of the leaves of blocks: g, place, id and path."""
    for batch in batches:
        for row in batch.to_pylist():
            ways = _ways(row)
            place = np.arange(len(ways)) + size * row["block"]
            yield pa.RecordBatch.from_pydict({
                "g": pa.array([row["g"]] * len(ways), pa.string()), "block": pa.array(place, pa.int64()),
                "id": pa.array(row["ids"] or [None] * len(ways), pa.string()),
                "path": pa.array([w.tobytes() for w in ways], pa.binary()),
            })


def _leaf_ways(blocks: DataFrame, depth: int) -> DataFrame:
    size = FAN**depth
    return blocks.mapInArrow(lambda x: _down(x, size), "g string, block long, id string, path binary")


def with_paths(passes: list[DataFrame], depth: int) -> DataFrame:
    """The blocks of the first pass with ``path``, the way from their heads up."""
    paths = None
    for blocks in reversed(passes):
        if paths is None:
            found = blocks.withColumn("path", F.lit(b""))
        else:
            found = blocks.join(paths, ["g", "block"], "left").withColumn("path", F.coalesce("path", F.lit(b"")))
        paths = _leaf_ways(found, depth).select("g", "block", "path")
    return found


def leaf(columns: list[Column]) -> Column:
    """The hash of columns: ``-`` for null, else length in bytes, colon, value."""
    items = []
    for c in columns:
        s = c.cast("string")
        items.append(F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*items), 256))


def manifest(docs: DataFrame, changed: Column, group: str = "source", id_col: str = "doc_id",
             depth: int = DEPTH) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``changed`` is the text a copy of the dataset holds; it is verified against the root.
    """
    columns = [F.col(c) for c in (id_col, group, "lang", "n_chars")]
    rows = materialize(docs.select(
        # null before all others
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"),
        F.col(id_col).alias("o"), F.col(id_col).cast("string").alias("id"),
        leaf([*columns, F.col("text")]).alias("leaf"), leaf([*columns, changed]).alias("other"),
    ))
    passes = forest(rows, ["o", "leaf"], depth)
    subroots = passes[0].where(F.col("total") <= FAN**depth).select("g", "head")
    for blocks in passes[1:]:
        subroots = subroots.unionByName(blocks.where(F.col("total") <= FAN**depth).select("g", "head"))
    subroots = materialize(subroots)
    above = forest(subroots.select(
        F.lit("").alias("g"), F.col("g").alias("id"), F.col("head").alias("leaf"), F.col("head").alias("other")
    ), ["id"], depth)
    top = above[-1].select("head").first()
    ways = _leaf_ways(with_paths(above, depth), depth)
    sources = ways.select(F.col("id").alias("g"), F.col("path").alias("top")).join(
        subroots.withColumnRenamed("head", "subroot"), "g"
    )
    root = bytes(top["head"]) if top else b""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ways, n = _ways(row), len(row["ids"])
                folded = [x.tobytes() for x in fold(_raw(row["others"]), ways)]
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(row["ids"], pa.string()),
                    "leaf": pa.array([x.tobytes().hex() for x in _raw(row["leaves"])], pa.string()),
                    "subroot": pa.array([row["subroot"].hex()] * n, pa.string()),
                    "root": pa.array([root.hex()] * n, pa.string()),
                    "proof_sha256": pa.array(proofs(ways), pa.string()),
                    "folded_root": pa.array([x.hex() for x in folded], pa.string()),
                    "verified": pa.array([x == root for x in folded], pa.bool_()),
                })

    return with_paths(passes, depth).join(sources, "g").mapInArrow(
        check, "id string, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean"
    ).select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "leaf", "subroot", "root",
             "proof_sha256", "folded_root", "verified")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, and its check where every other id lost its line ends."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(docs, F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
