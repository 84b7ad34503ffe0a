"""Hard negatives: rows of another label whose score lies in a window under a positive's score.

A row's components become whole numbers (``floor(256 x)``); its score with an anchor is the inner
product. An anchor's positives are its best rows of the same label; for each of them the best rows
of other labels with a score between two shares of the positive's are its negatives.

Both searches are threshold joins over an inverted index with L2 bounds. Dimensions are ordered by
their energy. Where the norms of an anchor's and a row's remaining dimensions cannot reach the
threshold on their own, these dimensions are left out of the row's postings. Scores are accumulated
over the postings, a group of dimensions at a time; after each, pairs whose partial score and
remaining norms stay under the threshold are pruned, and rows without a live pair are skipped.
What is left is scored exactly. Thresholds begin at the best score a few rows of the block show and
are lowered, for the anchors whose windows are not full yet, until they are, or the lowest score
that can count is reached.

*At scale.* Rows are dealt into blocks of about ``ROWS``, anchors of about ``ANCHORS``, by a hash;
every block of anchors (a stated share of the rows) meets every block of rows - in the first search
only those of its label - and keeps the best few of each window. No pair leaves a block but these.

Rows with a null id, label or vector, or with null or non-finite components, take no part. Equal
rows (id, label and numbers) are one row; rows of an id with different contents are rows each, but
never partners of one another. Shorter vectors count as ending in zeros; empty ones score 0. Scores
are exact as long as they fit 53 bits; beyond, they are added up as whole numbers of any size, and
one that does not fit 64 bits is an error. Ties go to the smaller id. Empty tables give empty
results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from versus.llm.common import table
from versus.session import materialize

ROWS = 16_384
ANCHORS = 4_096
BATCH = 128  # anchors at a time
SEED = 256  # rows that show where thresholds begin
GROUP = 8  # dimensions between two prunings
SCALE = 256


class Index:
    """Rows of a block (n, d), by dimension in the order of energy, with the norms of what remains."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.cuts = np.append(np.arange(0, rows.shape[1], GROUP), rows.shape[1])
        self.rest = remaining(rows, self.cuts)

    def postings(self, most: np.ndarray) -> list[np.ndarray]:
        """For each group of dimensions the rows that are listed there: those whose dimensions from
        the group on can reach the threshold; ``most`` is 1 / (the least norm that can)."""
        listed = self.rest * most[None, :] >= 1
        return [np.flatnonzero(listed[:, g]) for g in range(len(self.cuts) - 1)]


def remaining(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The norm of the dimensions from each cut on, a little rounded up."""
    square = np.cumsum((x.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    square = np.concatenate([square, np.zeros((len(x), 1))], axis=1)
    return np.sqrt(square[:, cuts]) * (1 + 1e-9)


def threshold_join(index: Index, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, row, score) of all pairs with a score of at least ``least`` of the anchor."""
    rest = remaining(anchors, index.cuts)
    bound = np.broadcast_to(least[:, None], rest.shape).astype(np.float64)
    # a threshold of 0 or less is reached by any norms
    most = np.where(bound > 0, rest / np.where(bound > 0, bound, 1), np.inf).max(axis=0, initial=0)
    most = np.where(np.isnan(most), np.inf, most)
    with np.errstate(invalid="ignore"):
        lists = index.postings(most)
    score = np.zeros((len(anchors), len(index.rows)))
    live = np.zeros(score.shape, bool)
    if lists:
        live[:, lists[0]] = True
    if not np.isfinite(most[0]):  # rows of norm 0 reach such a threshold too
        live[:] = True
    for g, listed in enumerate(lists):
        listed = listed[live[:, listed].any(axis=0)]
        a, b = index.cuts[g], index.cuts[g + 1]
        part = anchors[:, a:b].astype(np.float64) @ index.rows[listed, a:b].astype(np.float64).T
        score[:, listed] += part
        slack = 1e-9 * rest[:, :1] * index.rest[listed, 0]
        reach = score[:, listed] + rest[:, g + 1, None] * index.rest[listed, g + 1] + slack
        live[:, listed] &= reach >= least[:, None]
    at, row = np.nonzero(live)
    exact = np.empty(len(at), anchors.dtype)
    for i in range(0, len(at), 1 << 16):
        exact[i : i + (1 << 16)] = (anchors[at[i : i + (1 << 16)]] * index.rows[row[i : i + (1 << 16)]]).sum(axis=1)
    good = (exact >= least[at]).astype(bool)
    return at[good], row[good], exact[good]


def fill(index: Index, anchors: np.ndarray, allowed: Callable[[np.ndarray, np.ndarray], np.ndarray],
         full: Callable[..., np.ndarray], ladder: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, row, score) under thresholds that are lowered until windows are full.

    ``ladder`` (a, steps) has falling thresholds, ``floor`` the lowest of each anchor;
    ``allowed(anchor, row)`` says which pairs count, ``full(anchor, score, n)`` which of n windows
    hold enough.
    """
    open_ = np.arange(len(anchors))
    out: list[tuple[np.ndarray, ...]] = []
    for step in range(ladder.shape[1] + 1):
        if not len(open_):
            break
        least = floor[open_]
        if step < ladder.shape[1]:
            least = np.maximum(least, ladder[open_, step])
        at, row, score = threshold_join(index, anchors[open_], least)
        good = allowed(open_[at], row)
        at, row, score = open_[at[good]], row[good], score[good]
        done = (least <= floor[open_]) | full(at, score, len(anchors))[open_]
        keep = np.isin(at, open_[done])
        out.append((at[keep], row[keep], score[keep]))
        open_ = open_[~done]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (
        np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    )


def _ladder(seed: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Falling thresholds of each anchor: the seed's scores up to ``upper``, at doubling ranks."""
    seed = np.where(seed <= upper[:, None], seed, -np.inf)
    seed = -np.sort(-seed, axis=1)
    return seed[:, [r - 1 for r in (1, 2, 4, 8, 16, 32, 64, 128, 256) if r <= seed.shape[1]]]


def matrix(vectors: pd.Series, width: int, order: np.ndarray) -> np.ndarray:
    """Packed vectors as rows of doubles, or of whole numbers of any size where sums need them."""
    n = np.array([len(v) // 8 for v in vectors])
    out = np.zeros((len(n), width))
    flat = np.frombuffer(b"".join(vectors), "<f8")
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    out = out[:, order]
    if width * np.abs(out).max(initial=0) ** 2 < 2**52:
        return out
    return np.array([[int(x) for x in r] for r in out], object).reshape(out.shape)


def _top(groups: tuple[np.ndarray, ...], ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The places of the first k of each group, by falling score and rising id."""
    order = np.lexsort((ids, -score.astype(np.float64), *groups[::-1]))
    if score.dtype == object:
        order = np.array(sorted(range(len(ids)), key=lambda i: (*(g[i] for g in groups), -score[i], ids[i])), np.int64)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for g in groups:
        new[1:] |= g[order[1:]] != g[order[:-1]]
    at = np.arange(len(order))
    return order[at - np.maximum.accumulate(np.where(new, at, 0)) < k]


_BASE = "id long, label long, v binary"
_POSITIVE = "anchor_id long, a_label long, a_v binary, positive_id long, positive_score long"
_NEGATIVE = f"{_POSITIVE}, negative_id long, negative_score long"


def numbers(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(id, label, v): different rows with whole components, packed as doubles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch.column(2).value_lengths())
            flat = batch.column(2).flatten().to_numpy()
            whole = np.floor(SCALE * flat) + 0.0  # no negative zero
            ends = np.cumsum(size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([whole[a:b].tobytes() for a, b in zip(ends - size, ends, strict=True)], pa.binary())],
                names=["id", "label", "v"],
            )

    fine = rows.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    ).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    )
    return fine.mapInArrow(pack, _BASE).dropDuplicates(["id", "label", "v"])


def energy(base: DataFrame) -> np.ndarray:
    """The dimensions by falling sum of squares: one number for each dimension."""

    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0)
        for batch in batches:
            for v in batch.column(0).to_pylist():
                x = np.frombuffer(v, "<f8") ** 2
                if len(x) > len(total):
                    total = np.append(total, np.zeros(len(x) - len(total)))
                total[: len(x)] += x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total)], names=["d", "e"]
        )

    rows = base.select("v").mapInArrow(square, "d long, e double").groupBy("d").agg(F.sum("e").alias("e"))
    return np.array([r["d"] for r in rows.orderBy(F.desc("e"), "d").collect()], np.int64)


def mine(rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id",
         vector_col: str = "embedding", positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``is_anchor`` is a condition on the column ``id``; a negative's score lies between ``low`` and
    ``high`` hundredths of its positive's.
    """
    base = materialize(numbers(rows, id_col, vector_col, label))
    order = energy(base)
    width = len(order)
    anchors = base.where(is_anchor).select(*(F.col(c).alias(c) for c in base.columns))
    total, asked = base.count(), anchors.count()
    sizes = base.groupBy("label").agg(
        F.ceil(F.count("*") / ROWS).alias("blocks"), F.ceil(F.count_if(is_anchor) / ANCHORS).alias("a_blocks")
    ).where("a_blocks > 0")
    h = F.xxhash64("id", F.lit(13))

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    def own(table_: DataFrame) -> DataFrame:
        return table_.join(sizes, "label")

    def nearest(a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        """The best rows of the anchors' label."""
        out = []
        if len(a) and len(x):
            block, ids = matrix(x["v"], width, order), x["id"].to_numpy()
            index = Index(block)
            for at in range(0, len(a), BATCH):
                part = a.iloc[at : at + BATCH]
                q, q_ids = matrix(part["v"], width, order).astype(block.dtype), part["id"].to_numpy()
                seed = _ladder((q @ block[:SEED].T).astype(np.float64), np.full(len(q), np.inf))

                def full(who, score, n):
                    return np.bincount(who, minlength=n) >= positives

                who, row, score = fill(index, q, lambda i, r, i_=q_ids: i_[i] != ids[r], full, seed,
                                       np.full(len(q), -np.inf))
                best = _top((who,), ids[row], score, positives)
                who, row = who[best], row[best]
                out.append(pd.DataFrame({
                    "anchor_id": q_ids[who], "a_label": part["label"].to_numpy()[who],
                    "a_v": part["v"].to_numpy()[who], "positive_id": ids[row],
                    "positive_score": [int(s) for s in score[best]],
                }))
        return pd.concat(out) if out else pd.DataFrame(columns=_names(_POSITIVE))

    met = (
        own(anchors).select("id", "label", "v", F.pmod(h, "a_blocks").alias("a"), every(F.col("blocks")).alias("b"))
        .groupBy("label", "a", "b")
        .cogroup(own(base).select("id", "label", "v", every(F.col("a_blocks")).alias("a"),
                                  F.pmod(h, "blocks").alias("b")).groupBy("label", "a", "b"))
        .applyInPandas(nearest, _POSITIVE)
    )
    anchor = ["anchor_id", "a_label", "a_v"]
    place = Window.partitionBy(*anchor).orderBy(F.desc("positive_score"), "positive_id")
    pairs = materialize(
        met.withColumn("place", F.row_number().over(place)).where(F.col("place") <= positives).drop("place")
    )

    def hard(a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        """The best rows of other labels in the window of each positive."""
        out = []
        if len(a) and len(x):
            block, ids, labels = matrix(x["v"], width, order), x["id"].to_numpy(), x["label"].to_numpy()
            index = Index(block)
            a = a.reset_index(drop=True)
            for at in range(0, len(a), BATCH):
                part = a.iloc[at : at + BATCH]
                q, q_ids, q_labels = matrix(part["v"], width, order).astype(block.dtype), part["id"].to_numpy(), part["label"].to_numpy()
                # pairs of the batch: the anchor's place and its positives' scores
                n = np.array([len(s) for s in part["scores"]])
                who_of = np.repeat(np.arange(len(part)), n)
                scores = np.array([int(s) for row in part["scores"] for s in row], object)
                p_ids = np.concatenate([np.asarray(r, np.int64) for r in part["ids"]])
                lows = np.array([-(-low * s // 100) for s in scores], block.dtype)
                highs = np.array([high * s // 100 for s in scores], block.dtype)
                some = (lows <= highs).astype(bool)  # a window that holds a number
                who_of, scores, p_ids, lows, highs = (x[some] for x in (who_of, scores, p_ids, lows, highs))
                n = np.bincount(who_of, minlength=len(part))
                floor, upper = np.full(len(part), np.inf), np.full(len(part), np.inf)
                np.minimum.at(floor, who_of, lows.astype(np.float64) * (1 - 1e-12))
                np.minimum.at(upper, who_of, highs.astype(np.float64))
                seed = _ladder((q @ block[:SEED].T).astype(np.float64), upper)
                first = np.append(0, np.cumsum(n))

                def windows(who, score, who_of=who_of, first=first, lows=lows, highs=highs, n=n):
                    """Places in (who, score) and of pairs whose window holds the score."""
                    pair_at = np.repeat(np.arange(len(who)), n[who])
                    pair = np.repeat(first[who] - np.cumsum(n[who]) + n[who], n[who]) + np.arange(len(pair_at))
                    good = ((score[pair_at] >= lows[pair]) & (score[pair_at] <= highs[pair])).astype(bool)
                    return pair_at[good], pair[good]

                def full(who, score, m, who_of=who_of, windows=windows):
                    held = np.bincount(windows(who, score)[1], minlength=len(who_of)) >= negatives
                    done = np.ones(m, bool)
                    np.logical_and.at(done, who_of, held)
                    return done

                def allowed(i, r, q_ids=q_ids, q_labels=q_labels):
                    return (q_ids[i] != ids[r]) & (q_labels[i] != labels[r])

                who, row, score = fill(index, q, allowed, full, seed, floor)
                entry, pair = windows(who, score)
                best = _top((pair,), ids[row[entry]], score[entry], negatives)
                entry, pair = entry[best], pair[best]
                out.append(pd.DataFrame({
                    "anchor_id": q_ids[who[entry]], "a_label": q_labels[who[entry]],
                    "a_v": part["v"].to_numpy()[who[entry]], "positive_id": p_ids[pair],
                    "positive_score": [int(s) for s in scores[pair]], "negative_id": ids[row[entry]],
                    "negative_score": [int(s) for s in score[entry]],
                }))
        return pd.concat(out) if out else pd.DataFrame(columns=_names(_NEGATIVE))

    blocks, a_blocks = max(1, -(-total // ROWS)), max(1, -(-asked // ANCHORS))
    # an anchor has a fixed number of positives at most
    grouped = pairs.groupBy(
        F.col("anchor_id").alias("id"), F.col("a_label").alias("label"), F.col("a_v").alias("v")
    ).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("p")).select(
        "id", "label", "v", F.col("p.positive_id").alias("ids"), F.col("p.positive_score").alias("scores"),
        F.pmod(h, F.lit(a_blocks)).alias("a"), every(F.lit(blocks).cast("long")).alias("b"),
    )
    found = grouped.groupBy("a", "b").cogroup(
        base.select("id", "label", "v", every(F.lit(a_blocks).cast("long")).alias("a"),
                    F.pmod(h, F.lit(blocks)).alias("b")).groupBy("a", "b")
    ).applyInPandas(hard, _NEGATIVE)
    place = Window.partitionBy(*anchor, "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every fiftieth vector, with every seventh vector's label moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label)


ORACLE = {
    "op13_hard_negatives": """
WITH numbers AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM numbers a JOIN numbers b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS "rank",
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY "rank" <= 3""",
}
