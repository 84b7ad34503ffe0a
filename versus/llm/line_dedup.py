"""Line deduplication: winnowed line hashes, joined positions, repeated runs removed.

Lines without a word are passed over; every other line has the hash of its stripped text. A run of
neighbouring lines counts if it has ``MIN_LINES`` lines or ``MIN_WORDS`` words. Every line begins
a shortest run that counts and ends one: these are the windows. The smallest line hash in a window
is its fingerprint (winnowing), so equal windows have equal fingerprints wherever they stand.

Only fingerprints and their places are joined; those that occur at one place only are dropped. From
each of the other places a match is extended both ways, line by line, as far as windows reach that
have this fingerprint; these windows, and no others, are compared, by 128-bit hashes, with their
first place (by id, then line). The union of the windows of a document that stand at an earlier place
is all its lines that lie in a run that counts and was seen before; these lines are deleted, the
first occurrence stays. Places are joined with the first one only, never with one another.

Null text counts as empty and stays null. Rows without id are passed through and seen by nobody.
Repeated rows (same id and text) are one place: each gets the same result. Long texts are one row;
an empty table gives an empty result; all columns are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versus.llm.common import set_apart, ship, table
from versus.session import materialize

MIN_LINES = 3
MIN_WORDS = 50
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANK = " \t\n\x0b\f\r"


class Lines:
    """The lines of a text that hold a word: their numbers, 16-byte hashes and running word counts."""

    def __init__(self, places: np.ndarray, hashes: bytes, totals: np.ndarray):
        self.places, self.hashes, self.totals = places, hashes, totals

    @classmethod
    def of(cls, text: str) -> Lines:
        places, hashes, totals = [], [], [0]
        for i, line in enumerate(text.split("\n")):
            if line := line.strip(_BLANK):
                places.append(i)
                hashes.append(hashlib.blake2b(line.encode(), digest_size=16).digest())
                totals.append(totals[-1] + len(_WORD.findall(line)))
        return cls(np.array(places, "<i8"), b"".join(hashes), np.array(totals, "<i8"))

    def hash(self, i: int) -> bytes:
        return self.hashes[16 * i : 16 * i + 16]

    def windows(self, min_lines: int, min_words: int) -> list[tuple[int, int]]:
        """The shortest runs that count, as ranges of lines, in order of their starts."""
        n, totals = len(self.places), self.totals.tolist()

        def counts(a: int, b: int) -> bool:
            return b - a >= min_lines or totals[b] - totals[a] >= min_words

        spans, end, start = set(), 0, 0
        for a in range(n):
            end = max(end, a + 1)
            while end < n and not counts(a, end):
                end += 1
            if counts(a, end):
                spans.add((a, end))
        for b in range(1, n + 1):
            while start + 1 < b and counts(start + 1, b):
                start += 1
            if counts(start, b):
                spans.add((start, b))
        return sorted(spans)

    def minimum(self, a: int, b: int) -> int:
        """The line with the smallest hash; of equal ones the first."""
        return min(range(a, b), key=self.hash)

    def fingerprints(self, min_lines: int, min_words: int) -> list[tuple[int, int]]:
        """(fingerprint, line) of all windows, each once."""
        chosen = {self.minimum(a, b) for a, b in self.windows(min_lines, min_words)}
        return [(int(np.frombuffer(self.hash(i)[:8], "<i8")[0]), i) for i in sorted(chosen)]

    def around(self, chosen: set[int], min_lines: int, min_words: int) -> list[tuple[int, ...]]:
        """The windows that have one of the chosen lines as their fingerprint: first and last line
        as numbers in the text, and the two halves of the window's hash."""
        out = []
        for a, b in self.windows(min_lines, min_words):
            if self.minimum(a, b) in chosen:
                whole = hashlib.blake2b(self.hashes[16 * a : 16 * b], digest_size=16).digest()
                w1, w2 = (int(x) for x in np.frombuffer(whole, "<i8"))
                out.append((int(self.places[a]), int(self.places[b - 1]), w1, w2))
        return out


_LINES = "doc_id long, digest long, places binary, hashes binary, totals binary, prints array<long>, at array<long>"


def repeated(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, digest of the text, runs): for texts with repeated windows, their line ranges."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, columns = [], [[] for _ in range(5)]
            for row, text in enumerate(batch.column(2)):
                lines = Lines.of(text.as_py())
                prints = lines.fingerprints(min_lines, min_words)
                if prints:
                    kept.append(row)
                    values = (lines.places.tobytes(), lines.hashes, lines.totals.tobytes(),
                              [f for f, _ in prints], [i for _, i in prints])
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
            kinds = [*[pa.binary()] * 3, *[pa.list_(pa.int64())] * 2]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(pa.array(kept, pa.int64())) for i in (0, 1)),
                 *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "digest", "places", "hashes", "totals", "prints", "at"],
            )

    lines = materialize(
        docs.where("doc_id is not null and text is not null")
        .select("doc_id", F.xxhash64("text").alias("digest"), "text")
        .mapInArrow(select, _LINES)
    )
    placed = lines.select("doc_id", "digest", F.inline(F.arrays_zip(F.col("prints").alias("fingerprint"), "at")))
    spot = F.struct("doc_id", "digest", "at")
    shared = (
        placed.groupBy("fingerprint")
        .agg(F.min(spot).alias("low"), F.max(spot).alias("high"))
        .where("low < high")
        .select("fingerprint")
    )
    chosen = placed.join(shared, "fingerprint").groupBy("doc_id", "digest").agg(
        F.collect_set("at").alias("chosen")
    )

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for row, values in enumerate(batch.select([2, 3, 4, 5]).to_pylist()):
                own = Lines(np.frombuffer(values["places"], "<i8"), values["hashes"], np.frombuffer(values["totals"], "<i8"))
                found += [(row, *w) for w in own.around(set(values["chosen"]), min_lines, min_words)]
                if len(found) > 50_000 or row + 1 == batch.num_rows:
                    columns = list(zip(*found, strict=True)) or [()] * 5
                    rows = pa.array(columns[0], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(rows), batch.column(1).take(rows),
                         *(pa.array(c, pa.int64()) for c in columns[1:])],
                        names=["doc_id", "digest", "start", "end", "w1", "w2"],
                    )
                    found = []

    extended = materialize(
        # rows of one id and text are one place, so their windows are equal to each other
        lines.join(chosen, ["doc_id", "digest"])
        .select("doc_id", "digest", "places", "hashes", "totals", "chosen")
        .mapInArrow(extend, "doc_id long, digest long, start long, end long, w1 long, w2 long")
        .select("w1", "w2", F.struct("doc_id", "digest", "start").alias("here"), "end")
    )
    first = (
        extended.groupBy("w1", "w2")
        .agg(F.min("here").alias("first"), F.max("here").alias("last"))
        .where("first < last")
        .select("w1", "w2", "first")
    )
    return (
        extended.join(first, ["w1", "w2"])
        .where("here > first")
        .groupBy("here.doc_id", "here.digest")
        .agg(F.array_sort(F.collect_set(F.struct("here.start", "end"))).alias("runs"))
    )


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with the text left, and n_lines, n_removed, removed (ranges of line
    numbers) and emptied (all words are gone)."""
    extra = ["n_lines", "n_removed", "removed", "emptied"]
    names = [c for c in docs.columns if c not in extra]
    runs = repeated(docs, min_lines, min_words).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("runs").alias("__runs")
    )
    joined = docs.select(*names, F.xxhash64("text").alias("__own")).join(
        runs, (F.col("doc_id") == F.col("__id")) & (F.col("__own") == F.col("__digest")), "left"
    ).drop("__own", "__id", "__digest")
    where = joined.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, removed, ranges, emptied = [], [], [], [], []
            rows = zip(batch.column(where), batch.column(batch.num_columns - 1), strict=True)
            for text, runs in rows:
                text, gone = text.as_py(), set()
                for r in runs.as_py() or ():
                    gone.update(range(r["start"], r["end"] + 1))
                all_lines = text.split("\n") if text else []
                # blank lines inside a run go with it
                rest = [x for i, x in enumerate(all_lines) if i not in gone]
                texts.append("\n".join(rest) if gone else text)
                lines.append(len(all_lines))
                removed.append(len(gone))
                starts = [i for i in sorted(gone) if i - 1 not in gone]
                ends = [i for i in sorted(gone) if i + 1 not in gone]
                ranges.append(",".join(f"{a}-{b}" for a, b in zip(starts, ends, strict=True)))
                emptied.append(bool(gone) and not any(x.strip(_BLANK) for x in rest))
            columns = list(batch.columns[:-1])
            columns[where] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lines, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(ranges, pa.string()), pa.array(emptied, pa.bool_())],
                names=[*names, *extra],
            )

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return joined.mapInArrow(
        run, f"{schema}, n_lines long, n_removed long, removed string, emptied boolean"
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, removed lines, their ranges, and the digest of the text left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed", "removed", "emptied",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeats; a document of which no word is left goes."""
    ship(spark)
    apart, restore = set_apart(docs, ("doc_id", "text", "n_chars"))
    left = dedup_lines(apart).where("not emptied")
    return left.withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*restore)
