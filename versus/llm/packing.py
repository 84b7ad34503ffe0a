"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' tokens. Windows are filled in rounds: in every round a
queue may send its share of the window by the target proportions; what is less than a token stays
as the queue's deficit and is carried into the next window, across partitions and files. When a
queue runs out, its share goes to the others by their targets; with the default targets (the
sources' own token counts) all end together. The credit that a queue has earned by the time the
stream holds t tokens is a piecewise linear function of t with a break where a queue runs out, so
any task can work out any window from the queues' totals alone: nothing runs one after another.

The stream is cut into sequences of ``length`` tokens; the rest is cut into powers of two. There
is no padding, and every id lies in exactly one piece.

Null text counts as empty: only the closing id. A null source is a queue of its own. The
``named_queues`` largest sources have their own queues, all others share ``OTHER_QUEUES`` by hash.
Repeated rows are packed each; an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from versus.llm import arrays
from versus.llm.bpe import PreTokenEncoder
from versus.llm.common import ship, table
from versus.session import materialize

OTHER_QUEUES = 16
_RUN = 20_000  # windows worked out at a time

_encoders: dict[tuple, _Encoder] = {}


def _encoder(path: str, pattern: str) -> PreTokenEncoder:
    if (path, pattern) not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        model = tokenizer.model
        added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized
               for t in tokenizer.get_added_tokens_decoder().values()):
            raise ValueError("added tokens must be plain text")

        def new(parts: list[str]) -> list[list[int]]:
            # a pre-token goes to the merges directly, its bytes written as the vocabulary has them
            written = (p.encode().decode("latin-1").translate(_WRITTEN) for p in parts)
            return [[t.id for t in model.tokenize(w)] for w in written]

        _encoders[path, pattern] = _Encoder(PreTokenEncoder(pattern, new), added)
    return _encoders[path, pattern]


def _written() -> dict[int, int]:
    """Bytes as characters: printable ones are themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 0x100 + i for i, b in enumerate(rest)}


_WRITTEN = _written()


class _Encoder:
    """Texts to ids: first the tokenizer's added tokens are found, then what is between them is
    encoded by pre-tokens."""

    def __init__(self, plain: PreTokenEncoder, added: dict[str, int]):
        self.plain, self.added = plain, added
        longest = sorted(added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest)) + ")").split if added else None

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.split or not any(a in t for t in texts for a in self.added):
            return self.plain.encode(texts)
        parts = [self.split(t) for t in texts]
        between = iter(self.plain.encode([x for p in parts for x in p[::2]]))
        out = []
        for p in parts:
            ids = [next(between) if i % 2 == 0 else np.array([self.added[x]], "<u4").tobytes() for i, x in enumerate(p)]
            out.append(b"".join(ids))
        return out


def tokenise(docs: DataFrame, tokenizer: str, pattern: str, end_id: int = 0) -> DataFrame:
    """doc_id, queue, chunk (the task), at (tokens of the queue before it in the chunk), n, ids."""
    docs.sparkSession.sparkContext.addFile(tokenizer)
    name = tokenizer.rsplit("/", 1)[-1]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(SparkFiles.get(name), pattern)
        chunk, so_far = TaskContext.get().partitionId(), {}
        for batch in batches:
            for start, stop in arrays.slices(batch.column(2), 2 << 20):
                part = batch.slice(start, stop - start)
                ids = [i + end for i in encoder.encode([t or "" for t in part.column(2).to_pylist()])]
                at, n = [], [len(i) // 4 for i in ids]
                for queue, k in zip(part.column(1).to_pylist(), n, strict=True):
                    at.append(so_far.get(queue, 0))
                    so_far[queue] = at[-1] + k
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([chunk] * len(n), pa.int64()),
                     pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "queue", "chunk", "at", "n", "ids"],
                )

    source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    return docs.select("doc_id", source.alias("queue"), "text").mapInArrow(
        run, "doc_id long, queue string, chunk long, at long, n long, ids binary"
    )


class Plan:
    """When each queue has sent how many tokens, and where sequences begin."""

    def __init__(self, totals: list[int], targets: list[float], window: int, length: int):
        self.totals = np.array(totals, np.float64)
        self.window, self.length, self.all = window, length, int(sum(totals))
        weights = np.where(self.totals > 0, np.maximum(targets, 1e-9), 0)
        times, sent = [0.0], [np.zeros(len(totals))]
        live = self.totals > 0
        while live.any():
            rate = np.where(live, weights, 0) / weights[live].sum()
            left = (self.totals - sent[-1])[live] / rate[live]
            step = left.min()
            now = sent[-1] + rate * step
            done = live.copy()
            done[live] = left <= step * (1 + 1e-12)
            now[done] = self.totals[done]
            times.append(times[-1] + step)
            sent.append(now)
            live &= ~done
        times[-1] = float(self.all)
        self.times, self.sent = np.array(times), np.array(sent)
        full = self.all // length
        rest, bounds = self.all - full * length, [full * length]
        while rest:
            bounds.append(bounds[-1] + (1 << (rest.bit_length() - 1)))
            rest -= bounds[-1] - bounds[-2]
        self.full, self.tail = full, np.array(bounds, np.int64)

    def credit(self, t: np.ndarray) -> np.ndarray:
        """Whole tokens that each queue has sent when the stream should hold ``t``."""
        if len(self.times) == 1:
            return np.zeros((len(t), len(self.totals)), np.int64)
        t = np.clip(t.astype(np.float64), 0, self.times[-1])
        k = np.clip(np.searchsorted(self.times, t, "right") - 1, 0, len(self.times) - 2)
        share = ((t - self.times[k]) / (self.times[k + 1] - self.times[k]))[:, None]
        low, high = self.sent[k], self.sent[k + 1]
        value = np.minimum(low + (high - low) * share, high)
        value[t >= self.times[-1]] = self.totals
        return np.floor(value).astype(np.int64)

    def rounds(self, queue: int, first: int, last: int) -> tuple[int, int]:
        """A range of rounds that surely holds the tokens ``first`` to ``last`` of a queue."""
        t = np.interp([first, last + 1], self.sent[:, queue], self.times)
        low = max(0, int(t[0] // self.window) - 2)
        return low, min(int(t[1] // self.window) + 3, -(-self.all // self.window))

    def cut(self, pos: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Stretches of the stream cut where sequences end: origin, shift in it, length,
        sequence and offset."""
        parts = (pos + n - 1) // self.length - pos // self.length + 1
        origin = np.repeat(np.arange(len(pos)), parts)
        nth = np.arange(len(origin)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.maximum(pos[origin], (pos[origin] // self.length + nth) * self.length)
        end = np.minimum((pos + n)[origin], (begin // self.length + 1) * self.length)
        late = end > self.tail[0]
        if late.any() and len(self.tail) > 1:
            extra = [
                (o, max(b, self.tail[j]), min(e, self.tail[j + 1]))
                for o, b, e in zip(origin[late], begin[late], end[late], strict=True)
                for j in range(len(self.tail) - 1)
                if max(b, self.tail[j]) < min(e, self.tail[j + 1])
            ]
            more = np.array(extra, np.int64).reshape(-1, 3)
            origin = np.concatenate([origin[~late], more[:, 0]])
            begin = np.concatenate([begin[~late], more[:, 1]])
            end = np.concatenate([end[~late], more[:, 2]])
        last = np.searchsorted(self.tail, begin, "right") - 1
        in_tail = begin >= self.tail[0]
        sequence = np.where(in_tail, self.full + last, begin // self.length)
        offset = begin - np.where(in_tail, self.tail[np.maximum(last, 0)], sequence * self.length)
        return origin, begin - pos[origin], end - begin, sequence, offset


def _pieces(plan: Plan, queue: int, begin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pieces of documents of one queue that lie at ``begin``, sorted: which document, start in
    it, length, sequence, offset."""
    low, high = plan.rounds(queue, int(begin[0]), int((begin + n)[-1]) - 1)
    sent = plan.credit(np.arange(low, high + 1, dtype=np.int64) * plan.window)
    mine, whole = sent[:, queue], sent.sum(1)
    before = np.cumsum(np.diff(sent, axis=0), 1)[:, queue] - np.diff(mine)
    cuts = np.unique(np.concatenate([mine, begin, begin + n]))
    doc = np.searchsorted(begin, cuts, "right") - 1
    ok = (doc >= 0) & (cuts < (begin + n)[doc])
    stop = np.append(cuts[1:], 0)[ok]
    cuts, doc = cuts[ok], doc[ok]
    w = np.searchsorted(mine, cuts, "right") - 1
    pos = whole[w] + before[w] + cuts - mine[w]
    origin, shift, length, sequence, offset = plan.cut(pos, stop - cuts)
    return doc[origin], (cuts - begin[doc])[origin] + shift, length, sequence, offset


_OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(
    docs: DataFrame,
    tokenizer: str,
    pattern: str,
    end_id: int = 0,
    length: int = 1024,
    window: int | None = None,
    targets: dict[str | None, float] | None = None,
    named_queues: int = 255,
) -> DataFrame:
    """One row per piece. ``window`` (default: a sequence) is the number of tokens in which the
    target proportions hold, within one token per queue; ``targets`` are weights by source."""
    window = window or length
    stored = materialize(tokenise(docs, tokenizer, pattern, end_id))
    sums = stored.groupBy("queue", "chunk").agg(F.sum("n").alias("total"))
    by_queue = sums.groupBy("queue").agg(F.sum("total").alias("total"))
    named = by_queue.orderBy(F.desc("total"), "queue").limit(named_queues).collect()  # bounded
    numbers = docs.sparkSession.createDataFrame(
        [(row["queue"], i) for i, row in enumerate(named)], "queue string, no int"
    )
    other = len(named) + F.pmod(F.xxhash64("queue"), F.lit(OTHER_QUEUES)).cast("int")
    numbered = sums.join(F.broadcast(numbers), "queue", "left").withColumn(
        "no", F.coalesce("no", other)
    )
    earlier = (
        Window.partitionBy("no")
        .orderBy("chunk", "queue")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    base = materialize(
        numbered.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    )
    totals = [0] * (len(named) + OTHER_QUEUES)
    for row in base.groupBy("no").agg(F.sum("total").alias("total")).collect():  # bounded
        totals[row["no"]] = row["total"]
    weights = [float(t) for t in totals]
    for i, row in enumerate(named):
        if targets is not None:
            weights[i] = targets.get(row["queue"][1:] if row["queue"] else None, 0.0)
    plan = Plan(totals, weights, window, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            no, n = (batch.column(c).to_numpy() for c in ("no", "n"))
            begin = batch.column("at").to_numpy() + batch.column("base").to_numpy()
            order = np.lexsort((begin, no))
            first = 0
            while first < len(order):
                queue, x0 = no[order[first]], begin[order[first]]
                span = _RUN * plan.totals[queue] * window / max(plan.all, 1)
                last = first + 1
                while last < len(order) and no[order[last]] == queue and begin[order[last]] - x0 < span:
                    last += 1
                rows = order[first:last]
                first = last
                doc, start, size, sequence, offset = _pieces(plan, queue, begin[rows], n[rows])
                row = rows[doc]
                raw = [ids[i].as_buffer() for i in rows]
                views = [memoryview(b) for b in raw]
                crc = [
                    zlib.crc32(views[d][4 * s : 4 * e])
                    for d, s, e in zip(doc.tolist(), start.tolist(), (start + size).tolist(), strict=True)
                ]
                columns = [batch.column("doc_id").take(pa.array(row)), start, size, crc, n[row],
                           sequence, offset]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns],
                    names=_OUT,
                )

    return (
        stored.join(base.select("queue", "chunk", "no", "base"), ["queue", "chunk"])
        .select("doc_id", "no", "base", "at", "n", "ids")
        .mapInArrow(run, ", ".join(f"{c} long" for c in _OUT))
    )


def _packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(docs, path, public_tokenizers.PATTERN)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(table(spark, sf_dir, "documents"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return _packed(docs)
