"""Corpus n-gram frequencies, frequency quartiles, and a sentence's share of them."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from versus.functions.expr import let
from versus.functions.ngrams import with_ngram_columns
from versus.operators.lookup import lookup
from versus.operators.packed import by_part, pack, rows_of, string_bytes, strings, take_bytes, unpack
from versus.session import materialize

ORDERS = (1, 2, 3, 4)
QUARTILES = (1, 2, 3, 4)
# Leading hex digits of a gram's hash used to narrow down a quartile boundary.
BUCKET_DIGITS = 4
# Tokens that a task gathers before it sums equal windows of them (or one row): this bounds its memory.
# Equal windows are mostly those of one row or one document, so more tokens save little.
CHUNK_TOKENS = 400_000
# Rows of a batch that a task hands on at a time.
BATCH_ROWS = 50_000
# Parts into which the windows of one input split are dealt.
PARTS_PER_SPLIT = 16
# Windows whose grams are counted together, and that are unfolded at a time: this bounds a part's memory.
PART_WINDOWS = 800_000
PIECE_WINDOWS = 100_000
# Tokens of a block of sentences, whose distinct grams are looked up together: this bounds its memory.
BLOCK_TOKENS = 500_000
# Bytes of a row group of stored parts, which one task reads at a time.
PART_BYTES = 16 << 20
# Numbers from which a row's block is taken, whatever the number of blocks.
SLOTS = 1 << 20


def explode_grams(
    df: DataFrame, sides: list[str], max_n: int, keys: tuple[str, ...] = ("id",)
) -> DataFrame:
    """(keys, side, n, gram), one row per occurrence."""
    return _gram_arrays(df, sides, max_n, keys).select(
        *keys, "side", "n", F.explode("g").alias("gram")
    )


def _gram_arrays(df: DataFrame, sides: list[str], max_n: int, keys: tuple[str, ...]) -> DataFrame:
    """(keys, side, n, g): all grams of one order of a sentence."""
    per_side = df.select(
        *keys,
        F.inline(
            F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("tokens")) for s in sides])
        ),
    )
    arrays = with_ngram_columns(per_side, "tokens", max_n)
    columns = ["tokens", *[f"tokens_{n}" for n in range(2, max_n + 1)]]
    by_order = F.array(
        *[F.struct(F.lit(n).alias("n"), F.col(c).alias("g")) for n, c in enumerate(columns, 1)]
    )
    return arrays.select(*keys, "side", F.inline(by_order))


def _runs(items: Column) -> Column:
    """(gram, cnt) of each distinct item of an array that is not empty."""

    def counted(s: Column) -> Column:
        first = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | ~F.get(s, i).eqNullSafe(F.get(s, i - 1)),
        )
        return let(
            first,
            lambda f: F.transform(
                f,
                lambda i, k: F.struct(
                    F.get(s, i).alias("gram"),
                    (F.coalesce(F.get(f, k + 1), F.size(s)) - i).cast("bigint").alias("cnt"),
                ),
            ),
        )

    return let(F.sort_array(items), counted)


def sentence_gram_counts(df: DataFrame, sides: list[str], max_n: int) -> DataFrame:
    """(id, side, n, gram, cnt) for each sentence.

    A sentence is counted inside its row. Only rows that share an id with others are shuffled.
    """
    shared = materialize(
        df.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("id")
    )
    if shared.isEmpty():
        return _row_gram_counts(df, sides, max_n)
    same = df["id"].eqNullSafe(shared["id"])
    grams = explode_grams(df.join(shared, same, "left_semi"), sides, max_n)
    merged = grams.groupBy("id", "side", "n", "gram").agg(F.count(F.lit(1)).alias("cnt"))
    return _row_gram_counts(df.join(shared, same, "left_anti"), sides, max_n).unionByName(merged)


def _row_gram_counts(df: DataFrame, sides: list[str], max_n: int) -> DataFrame:
    return _gram_arrays(df, sides, max_n, ("id",)).where(F.size("g") > 0).select(
        "id",
        "side",
        "n",
        F.inline(
            F.when(
                F.size(F.array_distinct("g")) == F.size("g"),
                F.transform("g", lambda x: F.struct(x.alias("gram"), F.lit(1).cast("bigint").alias("cnt"))),
            ).otherwise(_runs(F.col("g")))
        ),
    )


def _joined(tokens: pa.Array, codes: np.ndarray, rest: np.ndarray, at: np.ndarray, n: int) -> pa.Array:
    """The up to ``n`` tokens from each place in ``at`` on, joined by blanks; null with a null token."""
    grams, blank = tokens.take(pa.array(codes[at])), pa.scalar(" ", pa.large_string())
    for j in range(1, n):
        inside = rest[at] > j
        more = tokens.take(pa.array(codes[np.where(inside, at + j, at)]))
        grams = pc.if_else(pa.array(inside), pc.binary_join_element_wise(grams, more, blank), grams)
    return grams


def _token_hashes(tokens: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(t.encode()) if t is not None else 0 for t in tokens.to_pylist()], np.uint64)


def _pair_hashes(grams: pa.Array) -> np.ndarray:
    """Of the first two pieces between blanks; grams with strange tokens may equal other tokens' grams."""
    pairs = [g.split(" ", 2)[:2] if g is not None else ("", "") for g in grams.to_pylist()]
    return np.array([zlib.crc32(a.encode()) << 32 | zlib.crc32(b.encode()) for a, b in pairs], np.uint64)


def _spread(hashes: np.ndarray) -> np.ndarray:
    hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C55)
    return hashes ^ (hashes >> np.uint64(29))


def _keyed_windows(batches: list[pa.RecordBatch], max_n: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """(n, gram, cnt, n_flagged) of some token arrays: words (n = 1), and windows of k = 2 to
    ``max_n`` tokens (n = -k), one from each place on, which stand for all of their beginnings.
    Windows with a null token or a token with a blank are given by their beginnings instead (n = k).

    Also a hash, which is equal for the same first two pieces between blanks (n other than 1)."""
    lists, flags = [x.column(0) for x in batches], np.concatenate([x.column(1).to_numpy(zero_copy_only=False) for x in batches])
    values = pa.concat_arrays([x.flatten() for x in lists]).cast("large_string")
    sizes = np.concatenate([pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in lists])
    coded = values.dictionary_encode(null_encoding="encode")
    codes, tokens = coded.indices.to_numpy(), coded.dictionary
    del values, coded, lists
    rest, flags = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes)), np.repeat(flags, sizes)
    rest = np.minimum(rest, max_n).astype(np.int8)
    hashes = _token_hashes(tokens)

    def counted(numbers: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
        return [np.bincount(numbers, minlength=size), np.bincount(numbers[flags[at]], minlength=size)]

    everywhere = np.arange(len(codes), dtype=np.int32)
    out = [(np.ones(len(tokens)), tokens, *counted(codes, everywhere, len(tokens)))]
    keys = [_spread(hashes)]
    strange = pc.fill_null(pc.match_substring(tokens, " "), True).to_numpy(zero_copy_only=False)
    at = everywhere[rest > 1]
    odd, key = strange[codes[at]], codes[at].astype(np.int64)
    for j in range(1, max_n):
        inside = rest[at] > j
        code = codes[np.where(inside, at + j, at)]
        odd |= inside & strange[code]
        # numbers of distinct windows so far: no more than the tokens, so that products do not overflow
        key = np.unique(key * (len(tokens) + 1) + np.where(inside, code + 1, 0), return_inverse=True)[1]
    plain = at[~odd]
    _, first, numbers = np.unique(key[~odd], return_index=True, return_inverse=True)
    del key
    first = plain[first]
    out.append((-rest[first], _joined(tokens, codes, rest, first, max_n), *counted(numbers, plain, len(first))))
    two = hashes[codes[first]] << np.uint64(32) | hashes[codes[np.minimum(first + 1, len(codes) - 1)]]
    keys.append(_spread(two))
    for n in range(2, max_n + 1):
        whole = at[odd & (rest[at] >= n)]
        ones = np.ones(len(whole), np.int64)
        out.append((n * ones, grams := _joined(tokens, codes, rest, whole, n), ones, flags[whole]))
        keys.append(_spread(_pair_hashes(grams)))
    n, grams, cnt, flagged = zip(*out)
    rows = pa.record_batch(
        [
            pa.array(np.concatenate(n).astype(np.int32)),
            pa.concat_arrays([g.cast("string") for g in grams]),
            pa.array(np.concatenate(cnt).astype(np.int64)),
            pa.array(np.concatenate(flagged).astype(np.int64)),
        ],
        names=["n", "gram", "cnt", "n_flagged"],
    )
    return rows, np.concatenate(keys)


def _sum_windows(batches: list[pa.RecordBatch], max_n: int) -> pa.RecordBatch:
    return _keyed_windows(batches, max_n)[0]


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[list[pa.RecordBatch]]:
    """Rows with up to ``chunk`` tokens in their first column, or one row."""
    held, size = [], 0
    for batch in batches:
        ends, start = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)), 0
        while start < batch.num_rows:
            done = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, done + chunk - size, "right"))
            if stop <= start and held:
                yield held
                held, size = [], 0
                continue
            stop = max(start + 1, stop)
            held.append(batch.slice(start, stop - start))
            size, start = size + int(ends[stop - 1]) - done, stop
    if held:
        yield held


def _window_packer(max_n: int, chunk: int, parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(part, blob): the windows of a chunk of tokens that belong to a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _chunks(batches, chunk):
            rows, keys = _keyed_windows(held, max_n)
            numbers = [rows["n"].to_numpy() + max_n, rows["cnt"].to_numpy(), rows["n_flagged"].to_numpy()]
            found = list(by_part((keys % np.uint64(parts)).astype(np.int64), numbers, rows["gram"]))
            if found:
                part, blobs = zip(*found)
                yield pa.record_batch([pa.array(part, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

    return run


def _beginnings(blobs: list[bytes], max_n: int) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """(n, grams, counts, flagged counts) per order of packed windows, each as often as a window begins with it."""
    opened = [unpack(b) for b in blobs]
    sizes, n, cnt, flagged = (np.concatenate([x[0][i] for x in opened]).astype(np.int64) for i in range(4))
    data = np.concatenate([x[1] for x in opened])
    n -= max_n
    valid, lengths = sizes > 0, np.maximum(sizes - 1, 0)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    blanks = np.flatnonzero(data == 32)
    first = np.searchsorted(blanks, starts)
    for order in range(1, max_n + 1):
        rows = np.flatnonzero(n == 1 if order == 1 else (n == order) | (n <= -order))
        if not len(rows):
            continue
        cut = n[rows] < -order
        size = lengths[rows]
        size[cut] = blanks[first[rows[cut]] + order - 1] - starts[rows[cut]]
        grams = strings(take_bytes(data, starts[rows], size), size, valid[rows])
        yield order, grams, cnt[rows], flagged[rows]


def _summed(blobs: list[bytes], max_n: int, flagged: bool) -> Iterator[pa.RecordBatch]:
    """(n, gram, cnt, n_flagged) of a part's windows. A part of many windows is gone through several
    times, for some of its grams each time, so that memory stays bounded."""
    n_rows = sum(rows_of(b) for b in blobs)
    turns = -(-n_rows // PART_WINDOWS)
    for turn in range(turns):
        held: dict[int, list[pa.Table]] = {}
        start = 0
        while start < len(blobs):
            stop, size = start, 0
            while stop < len(blobs) and (stop == start or size < PIECE_WINDOWS):
                size += rows_of(blobs[stop])
                stop += 1
            for order, grams, cnt, flags in _beginnings(blobs[start:stop], max_n):
                rows = pa.table([grams, pa.array(cnt), pa.array(flags)], names=["gram", "cnt", "n_flagged"])
                if turns > 1:
                    rows = rows.filter(pa.array(_spread(_token_hashes(grams)) % np.uint64(turns) == turn))
                held.setdefault(order, []).append(rows)
            start = stop
        for order in sorted(held):
            rows = pa.concat_tables(held.pop(order))
            sums = [("cnt", "sum")] + [("n_flagged", "sum")] * flagged
            counts = rows.group_by("gram", use_threads=False).aggregate(sums)
            del rows
            for low in range(0, len(counts), BATCH_ROWS):
                some = counts.slice(low, BATCH_ROWS).combine_chunks()
                columns = [pa.array(np.full(len(some), order, np.int32)), some["gram"].combine_chunks().cast("string")]
                columns += [some[f"{c}_sum"].combine_chunks() for c, _ in sums]
                yield pa.record_batch(columns, names=["n", "gram", *(c for c, _ in sums)])


def _window_counter(max_n: int, flagged: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of rows (part, blob) in the order of parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blobs = None, []
        for batch in batches:
            for number, blob in zip(batch["part"].to_pylist(), batch["blob"].to_pylist()):
                if number != part and blobs:
                    yield from _summed(blobs, max_n, flagged)
                    blobs = []
                part = number
                blobs.append(blob)
        if blobs:
            yield from _summed(blobs, max_n, flagged)

    return run


def corpus_gram_counts(
    df: DataFrame, sides: list[str] = ["h1", "h2"], max_n: int = 4, flag: Column | None = None
) -> DataFrame:
    """(n, gram, cnt) over both hypotheses; the reference is not counted. With ``flag``, a condition,
    also ``n_flagged``: the occurrences in rows that meet it.

    A gram is the beginning of a longer one, so only the longest window at each place travels, to
    the part of its first two tokens; there it is unfolded into its beginnings, which are counted.
    Equal windows are summed in the task first, a bounded number of tokens at a time, and those of
    one part travel as one compressed blob.
    """
    flagged, flag = flag is not None, F.lit(False) if flag is None else F.coalesce(flag, F.lit(False))
    arrays = df.select(F.explode(F.array(*sides)).alias("tokens"), flag.alias("flag")).where("size(tokens) > 0")
    parts = max(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        PARTS_PER_SPLIT * df.rdd.getNumPartitions(),
    )
    windows = arrays.mapInArrow(_window_packer(max_n, CHUNK_TOKENS, parts), "part int, blob binary")
    dealt = windows.repartition(parts, "part").sortWithinPartitions("part")
    sums = "cnt bigint, n_flagged bigint" if flagged else "cnt bigint"
    return dealt.mapInArrow(_window_counter(max_n, flagged), f"n int, gram string, {sums}")


def distinct_totals(freq: DataFrame) -> DataFrame:
    """(n, n_grams, n_occurrences)."""
    return freq.groupBy("n").agg(
        F.count(F.lit(1)).alias("n_grams"), F.sum("cnt").alias("n_occurrences")
    )


def _hash() -> Column:
    """Grams with equal counts are in the order of this hash, then of the gram."""
    return F.md5("gram")


def _bucket() -> Column:
    """The hash's leading digits, as a number."""
    return F.conv(F.substring(_hash(), 1, BUCKET_DIGITS), 16, 10).cast("int")


def _locate(hist: DataFrame, by: list[str], order: str, target: Column, size: str) -> DataFrame:
    """Rows of a histogram in which the 0-based rank ``target`` falls, with ``rest`` inside it."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size).over(before), F.lit(0))
    placed = hist.withColumn("__start", start).withColumn("__target", target)
    inside = (F.col("__target") >= F.col("__start")) & (
        F.col("__target") < F.col("__start") + F.col(size)
    )
    return placed.where(inside).withColumn("rest", F.col("__target") - F.col("__start")).drop(
        "__start", "__target", size
    )


def bucket_sizes(freq: DataFrame) -> DataFrame:
    """(n, cnt, bucket, size), stored: the number of grams by count and bucket of their hash."""
    return materialize(freq.groupBy("n", "cnt", "bucket").agg(F.count(F.lit(1)).alias("size")))


def quartile_cuts(freq: DataFrame, by_bucket: DataFrame) -> DataFrame:
    """One row per n: for each of the three inner boundaries the count, bucket and tie key at it.

    Grams of one n, in ascending (count, tie key) order, are cut at int(N * i / 4). The
    boundary rank is located in the histogram of counts, then in a histogram of hash buckets
    inside that one count, and only the one remaining bucket is ranked row by row. So no
    order of all grams is ever made, however many share a count.
    """
    hist = by_bucket.groupBy("n", "cnt").agg(F.sum("size").alias("size"))
    whole = Window.partitionBy("n")
    cuts = hist.withColumn("total", F.sum("size").over(whole)).withColumn(
        "i", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    )
    at_count = _locate(
        cuts, ["n", "i"], "cnt", F.floor(F.col("total") * F.col("i") / 4), "size"
    ).select("n", "i", "cnt", F.col("rest").alias("in_count"))
    buckets = by_bucket.join(F.broadcast(at_count), ["n", "cnt"])  # three rows per n
    at_bucket = materialize(
        _locate(buckets, ["n", "i"], "bucket", F.col("in_count"), "size").select(
            "n", "i", "cnt", "bucket", F.col("rest").alias("in_bucket")
        )
    )
    members = freq.join(F.broadcast(at_bucket.withColumnRenamed("bucket", "__bucket")), ["n", "cnt"]).where(
        F.col("bucket") == F.col("__bucket")
    )
    rank = F.row_number().over(Window.partitionBy("n", "i").orderBy("key")) - 1
    keys = (
        members.select("n", "i", "cnt", "bucket", "in_bucket", F.struct(_hash().alias("hash"), "gram").alias("key"))
        .withColumn("rank", rank)
        .where("rank = in_bucket")
    )
    return keys.groupBy("n").agg(
        *[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}_{i}") for c in ("cnt", "bucket", "key") for i in (1, 2, 3)]
    )


def with_quartiles(freq: DataFrame) -> DataFrame:
    """(n, gram, cnt, quartile). ``freq`` should be a stored table: it is read three times. The
    grams' hashes are worked out anew each time, unless it has their ``bucket``: they would
    take more room than the grams."""
    freq = freq if "bucket" in freq.columns else freq.withColumn("bucket", _bucket())
    cuts = quartile_cuts(freq, bucket_sizes(freq))
    return _placed(freq, cuts).select("n", "gram", "cnt", "quartile")


def _placed(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add ``quartile`` to rows with n, gram, cnt and bucket; hashes are worked out in the buckets
    of the boundaries only."""

    def reached(i: int) -> Column:
        later = F.when(
            F.col("bucket").eqNullSafe(F.col(f"bucket_{i}")),
            F.struct(_hash().alias("hash"), "gram") >= F.col(f"key_{i}"),
        ).otherwise(F.col("bucket") > F.col(f"bucket_{i}"))
        at = F.col("cnt") == F.col(f"cnt_{i}")
        return F.when(F.when(at, later).otherwise(F.col("cnt") > F.col(f"cnt_{i}")), 1).otherwise(0)

    quartile = F.lit(1) + reached(1) + reached(2) + reached(3)
    return rows.join(F.broadcast(cuts), "n").select(*rows.columns, quartile.alias("quartile"))  # one row per n


def quartile_mass(freq: DataFrame) -> DataFrame:
    """(n, quartile, mass)."""
    return freq.groupBy("n", "quartile").agg(F.sum("cnt").alias("mass"))


def build_frequencies(df: DataFrame, sides: list[str] = ["h1", "h2"], max_n: int = 4) -> DataFrame:
    """Stored (n, gram, cnt, quartile) table of a corpus of token arrays."""
    return materialize(gram_quartiles(df, sides, max_n))


def gram_quartiles(df: DataFrame, sides: list[str] = ["h1", "h2"], max_n: int = 4) -> DataFrame:
    """The same for one reader: only the counts are stored, quartiles are worked out in passing."""
    return with_quartiles(materialize(corpus_gram_counts(df, sides, max_n)))


def save_frequencies(freq: DataFrame, path: str) -> None:
    freq.write.partitionBy("n").parquet(path)


def load_frequencies(spark: SparkSession, path: str) -> DataFrame:
    schema = "gram string, cnt bigint, quartile int, n int"
    return spark.read.schema(schema).parquet(path).select("n", "gram", "cnt", "quartile")


class _BlockGrams:
    """The distinct grams of a block's sentences, numbered in an order that depends on nothing else.

    A gram is numbered from the number of its beginning and its last token. Grams with a null token
    have no number.
    """

    def __init__(self, sides: list[pa.Array], max_n: int):
        self.max_n = max_n
        values = pa.concat_arrays([s.flatten().cast("large_string") for s in sides])
        coded = values.dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        rank = np.empty(len(order) + 1, np.int64)
        rank[order.to_numpy()], rank[-1] = np.arange(len(order)), -1
        self.tokens = coded.dictionary.take(order)
        self.codes = rank[pc.fill_null(coded.indices, len(order)).to_numpy()]
        self.sizes = np.concatenate([pc.fill_null(pc.list_value_length(s), 0).to_numpy() for s in sides])
        #: of every place, the row of the sides stacked one on the other
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def orders(self) -> Iterator[tuple[int, *tuple[np.ndarray, ...]]]:
        """Per order: n, the places of grams, their numbers, each number's beginning and last token;
        the places of grams with a null token come last."""
        rest = np.repeat(np.cumsum(self.sizes), self.sizes) - np.arange(len(self.codes))
        span, at, numbers = len(self.tokens), np.arange(len(self.codes)), np.zeros(len(self.codes), np.int64)
        lost = at[:0]
        for n in range(1, self.max_n + 1):
            longer = rest[at] >= n
            at, numbers, lost = at[longer], numbers[longer], lost[rest[lost] >= n]
            code = self.codes[at + n - 1]
            known = code >= 0
            lost = np.concatenate([lost, at[~known]])
            distinct, inverse = np.unique(numbers[known] * span + code[known], return_inverse=True)
            at, numbers = at[known], inverse
            yield n, at, numbers, distinct // max(span, 1), distinct % max(span, 1), lost

    def requests(self, block: int, counted: np.ndarray, numbered: bool) -> Iterator[pa.RecordBatch]:
        """(block, at, n, gram, cnt): each distinct gram with its number and its occurrences in the
        rows ``counted``; without numbers where no answer is wanted."""
        start, grams, blank = 0, None, pa.scalar(" ", pa.large_string())
        for n, at, numbers, beginning, last, lost in self.orders():
            words = self.tokens.take(pa.array(last))
            if n > 1:
                words = pc.binary_join_element_wise(grams.take(pa.array(beginning)), words, blank)
            grams, size = words, len(words)
            cnt = np.bincount(numbers[counted[self.row[at]]], minlength=size)
            places = np.arange(start, start + size) if numbered else np.full(size, -1)
            start += size
            n_lost = int(counted[self.row[lost]].sum())
            extra = 1 if n_lost else 0
            yield pa.record_batch(
                [
                    pa.array(np.full(size + extra, block, np.int32)),
                    pa.array(np.append(places, [-1] * extra).astype(np.int32)),
                    pa.array(np.full(size + extra, n, np.int32)),
                    pa.concat_arrays([words.cast("string"), pa.nulls(extra, "string")]),
                    pa.array(np.append(cnt, [n_lost] * extra).astype(np.int64)),
                ],
                names=["block", "at", "n", "gram", "cnt"],
            )

    def sums(self, at: np.ndarray, cnt: np.ndarray, quartile: np.ndarray) -> list[np.ndarray]:
        """Per row of the stacked sides, the sums of its grams' counts by order, then by order and
        quartile; ``at`` are the numbers of the grams that were found."""
        whole, by_quartile, start = [], [], 0
        order = np.argsort(at, kind="stable")
        at, cnt, quartile = at[order], cnt[order], quartile[order]
        for _, places, numbers, beginning, _, _ in self.orders():
            low, high = np.searchsorted(at, [start, start + len(beginning)])
            mine, counts, q = at[low:high] - start, cnt[low:high], quartile[low:high]
            start += len(beginning)
            rows = self.row[places]
            for k in (None, *QUARTILES):
                used = slice(None) if k is None else q == k
                each, out = np.zeros(len(beginning), np.int64), np.zeros(len(self.sizes), np.int64)
                np.add.at(each, mine[used], counts[used])
                np.add.at(out, rows, each[numbers])
                (whole if k is None else by_quartile).append(out)
        return whole + by_quartile


_ALL = [f"all_{i}" for i in ORDERS]
_BY_QUARTILE = [f"q_{i}_{k}" for i in ORDERS for k in QUARTILES]


def _blocks(df: DataFrame, sides: list[str]) -> tuple[DataFrame, int]:
    """Rows in blocks of a bounded number of tokens, as a stored table, and the number of blocks.
    Rows of one id may lie in several blocks."""
    slot = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SLOTS)).cast("int")
    stored = materialize(df.withColumn("__slot", slot))
    tokens = sum((F.greatest(F.size(s), F.lit(0)).cast("bigint") for s in sides[1:]), F.greatest(F.size(sides[0]), F.lit(0)).cast("bigint"))
    n_tokens = stored.agg(F.sum(tokens)).first()[0] or 0
    n_blocks = max(df.sparkSession.sparkContext.defaultParallelism, -(-n_tokens // BLOCK_TOKENS))
    return stored.withColumn("block", F.col("__slot") % n_blocks).drop("__slot"), n_blocks


def _requests(blocks: DataFrame, sides: list[str]) -> DataFrame:
    """(block, at, n, gram, cnt): each distinct gram of a block's rows that are ``asked``, once, and
    of its other rows that are ``counted`` (with no number). ``cnt`` is of the rows counted."""
    max_n = max(ORDERS)

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        asked, counted = (table[c].combine_chunks() for c in ("asked", "counted"))
        out = []
        for numbered, mask in ((True, asked), (False, pc.and_(counted, pc.invert(asked)))):
            part = table.filter(mask)
            if part.num_rows:
                flags = np.tile(part["counted"].to_numpy(), len(sides))
                grams = _BlockGrams([part[s].combine_chunks() for s in sides], max_n)
                out += grams.requests(block, flags, numbered)
        return pa.Table.from_batches(out)

    rows = blocks.where("asked or counted").select("block", "asked", "counted", *sides)
    return rows.groupBy("block").applyInArrow(run, "block int, at int, n int, gram string, cnt bigint")


def _answered(blocks: DataFrame, found: DataFrame, sides: list[str]) -> DataFrame:
    """(id, side, all_n.., q_n_k..) of the blocks' asked rows, from (block, at, cnt, quartile) of
    the grams that were found."""
    asked = blocks.where("asked").select("block", "id", *sides)
    max_n = max(ORDERS)

    def run(rows: pa.Table, grams: pa.Table) -> pa.Table:
        ids = rows["id"].combine_chunks()
        columns = [grams[c].to_numpy() for c in ("at", "cnt")] + [pc.fill_null(grams["quartile"], 0).to_numpy()]
        sums = _BlockGrams([rows[s].combine_chunks() for s in sides], max_n).sums(*columns)
        names = np.repeat(np.arange(len(sides)), len(ids))
        side = pa.array(sides).take(pa.array(names))
        return pa.table(
            [pa.concat_arrays([ids] * len(sides)), side, *map(pa.array, sums)], names=["id", "side", *_ALL, *_BY_QUARTILE]
        )

    kind = dict(asked.dtypes)["id"]
    schema = f"id {kind}, side string, " + ", ".join(f"{c} bigint" for c in [*_ALL, *_BY_QUARTILE])
    answers = found.select("block", "at", "cnt", "quartile")
    met = asked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
    return met.groupBy("id", "side").agg(*[F.sum(c).alias(c) for c in [*_ALL, *_BY_QUARTILE]])


class _BlockWindows:
    """The distinct words and windows of a block's sentences, in an order that depends on nothing else.

    As in ``corpus_gram_counts`` the longest window at each place, of two to ``max_n`` tokens, stands for
    its beginnings. Windows end before a null token. ``part`` is the part of each word, then window.
    """

    def __init__(self, sides: list[pa.Array], max_n: int, parts: int):
        self.max_n = max_n
        values = pa.concat_arrays([s.flatten().cast("large_string") for s in sides])
        coded = values.dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        rank = np.empty(len(order) + 1, np.int64)
        rank[order.to_numpy()], rank[-1] = np.arange(len(order)), -1
        self.tokens = coded.dictionary.take(order)
        self.codes = codes = rank[pc.fill_null(coded.indices, len(order)).to_numpy()]
        self.sizes = np.concatenate([pc.fill_null(pc.list_value_length(s), 0).to_numpy() for s in sides])
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        del values, coded, order
        here = np.arange(len(codes))
        null = np.where(codes < 0, here, len(codes))
        null = np.minimum.accumulate(null[::-1])[::-1]
        self.whole = np.minimum(np.repeat(np.cumsum(self.sizes), self.sizes) - here, max_n)
        #: tokens of the window at each place
        self.rest = np.minimum(null - here, self.whole)
        self.at = np.flatnonzero(self.rest > 1)
        key, span = codes[self.at], len(self.tokens) + 1
        for j in range(1, max_n):
            inside = self.rest[self.at] > j
            code = codes[np.where(inside, self.at + j, self.at)]
            key = np.unique(key * span + np.where(inside, code + 1, 0), return_inverse=True)[1]
        #: of every place with a window, its number
        _, first, self.numbers = np.unique(key, return_index=True, return_inverse=True)
        self.first = self.at[first]
        two = codes[self.first] * span + codes[self.first + 1] if len(self.first) else codes[:0]
        pairs, inverse = np.unique(two, return_inverse=True)
        blank = pa.scalar(" ", pa.large_string())
        texts = pc.binary_join_element_wise(self.tokens.take(pa.array(pairs // span)), self.tokens.take(pa.array(pairs % span)), blank)
        keys = np.concatenate([_token_hashes(self.tokens), _token_hashes(texts)[inverse]])
        self.part = (_spread(keys) % np.uint64(parts)).astype(np.int64)
        #: tokens of each word, then window
        self.k = np.concatenate([np.ones(len(self.tokens), np.int64), self.rest[self.first]])

    def packed(self, parts: int, counted: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(part, blob): the words, windows and grams with a null token of a part, the bytes of their
        beginnings of two and three tokens, and their occurrences in the rows ``counted``."""
        known = np.flatnonzero(self.codes >= 0)
        used = counted[self.row]
        words = np.bincount(self.codes[known][used[known]], minlength=len(self.tokens))
        windows = np.bincount(self.numbers[used[self.at]], minlength=len(self.first))
        bytes_ = pc.binary_length(self.tokens).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, length = [], np.zeros(len(self.first), np.int64)
        for j in range(self.max_n - 1):
            inside = self.rest[self.first] > j
            length = length + np.where(inside, bytes_[self.codes[np.where(inside, self.first + j, self.first)]] + (j > 0), 0)
            if j:
                ends.append(np.where(self.rest[self.first] > j + 1, length, 0))
        lost = [int((used & (self.whole >= n) & (self.rest < n)).sum()) for n in range(1, self.max_n + 1)]
        orders = np.flatnonzero(lost)
        none, extra = np.zeros(len(self.tokens), np.int64), np.zeros(len(orders), np.int64)
        texts = [self.tokens, _joined(self.tokens, self.codes, self.rest, self.first, self.max_n), pa.nulls(len(orders), pa.large_string())]
        columns = [np.concatenate([self.k, orders + 1])]
        columns += [np.concatenate([none, e, extra]) for e in ends]
        columns.append(np.concatenate([words, windows, np.array(lost, np.int64)[orders]]))
        part = np.concatenate([self.part, orders % parts])
        yield from by_part(part, columns, pa.concat_arrays(texts))

    def sums(self, answers: dict[int, bytes]) -> list[np.ndarray]:
        """Per row of the stacked sides, the sums of its grams' counts by order, then by order and
        quartile, from the answers of the parts."""
        size = len(self.k)
        counts, quartiles = np.zeros((self.max_n, size), np.int64), np.zeros((self.max_n, size), np.int8)
        order = np.argsort(self.part, kind="stable")
        cuts = np.searchsorted(self.part[order], [[p, p + 1] for p in answers])
        for (low, high), blob in zip(cuts, answers.values()):
            columns, _ = unpack(blob)
            mine = order[low:high]
            for n in range(1, self.max_n + 1):
                asked = mine[_begins(self.k[mine], n)]
                # after them come grams with a null token, which nobody asks for
                counts[n - 1, asked] = columns[2 * n - 2][: len(asked)]
                quartiles[n - 1, asked] = columns[2 * n - 1][: len(asked)]
        whole, by_quartile = [], []
        ends = np.cumsum(self.sizes)
        for n in range(1, self.max_n + 1):
            at = np.flatnonzero(self.rest >= n)
            entry = self.codes[at] if n == 1 else len(self.tokens) + self.numbers[self.rest[self.at] >= n]
            cnt, quartile = counts[n - 1, entry], quartiles[n - 1, entry]
            for k in (None, *QUARTILES):
                each = np.zeros(len(self.codes) + 1, np.int64)
                each[at + 1] = cnt if k is None else np.where(quartile == k, cnt, 0)
                upto = np.cumsum(each)
                (whole if k is None else by_quartile).append(upto[ends] - upto[ends - self.sizes])
        return whole + by_quartile


def _begins(k: np.ndarray, n: int) -> np.ndarray:
    """Words (n = 1) or windows that have a beginning of ``n`` tokens."""
    return np.flatnonzero(k == 1 if n == 1 else k >= n)


def _packed_requests(blocks: DataFrame, sides: list[str], parts: int) -> DataFrame:
    """(part, block, asked, blob): the words and windows of a block's rows that are ``asked``, and
    of its other rows that are ``counted``."""
    max_n = max(ORDERS)

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        asked, counted = (table[c].combine_chunks() for c in ("asked", "counted"))
        out = []
        for wanted, mask in ((True, asked), (False, pc.and_(counted, pc.invert(asked)))):
            rows = table.filter(mask)
            if rows.num_rows:
                flags = np.tile(rows["counted"].to_numpy(), len(sides))
                windows = _BlockWindows([rows[s].combine_chunks() for s in sides], max_n, parts)
                found = list(windows.packed(parts, flags))
                if found:
                    part, blobs = zip(*found)
                    columns = [pa.array(part, pa.int32()), pa.array([block] * len(part), pa.int32()), pa.array([wanted] * len(part))]
                    out.append(pa.record_batch([*columns, pa.array(blobs, pa.binary())], names=["part", "block", "asked", "blob"]))
        return pa.Table.from_batches(out, _REQUEST)

    rows = blocks.where("asked or counted").select("block", "asked", "counted", *sides)
    return rows.groupBy("block").applyInArrow(run, "part int, block int, asked boolean, blob binary")


_REQUEST = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("asked", pa.bool_()), ("blob", pa.binary())])
_MET = "part int, grams binary, blocks array<int>, codes array<binary>"


def _met(blocks: list[int], asked: list[bool], blobs: list[bytes], max_n: int) -> tuple[bytes, list[int], list[bytes]]:
    """The distinct grams of a part with their counts as one blob; the blocks that ask, and for each the
    numbers of the grams it asks for, order by order.

    A part of many windows is gone through several times, for some of its grams each time."""
    sizes = [rows_of(b) for b in blobs]
    starts, total = np.cumsum([0, *sizes]), sum(sizes)
    turns = -(-total // PART_WINDOWS)
    numbers = np.full((max_n, total), -1, np.int32)
    texts, orders, counts, done = [], [], [], 0
    for turn in range(turns):
        held: dict[int, list] = {n: [] for n in range(1, max_n + 1)}
        for blob, start in zip(blobs, starts):
            (length, k, *ends, cnt), data = unpack(blob)
            valid, length = length > 0, np.maximum(length.astype(np.int64) - 1, 0)
            begin = np.cumsum(length) - length
            for n in range(1, max_n + 1):
                rows = np.flatnonzero(np.where(valid, (k == 1) if n == 1 else (k >= n), k == n))
                size = length[rows]
                if 1 < n < max_n:
                    cut = ends[n - 2][rows].astype(np.int64)
                    size = np.where(k[rows] > n, np.where(valid[rows], cut, 0), size)
                grams = strings(take_bytes(data, begin[rows], size), size, valid[rows])
                places, uses = start + rows, cnt[rows].astype(np.int64)
                if turns > 1:
                    mine = _spread(_token_hashes(grams)) % np.uint64(turns) == turn
                    grams, places, uses = grams.filter(pa.array(mine)), places[mine], uses[mine]
                held[n].append((grams, places, uses))
        for n in range(1, max_n + 1):
            grams, places, uses = zip(*held.pop(n))
            coded = pa.concat_arrays(grams).dictionary_encode(null_encoding="encode")
            codes, places = coded.indices.to_numpy(), np.concatenate(places)
            numbers[n - 1, places] = done + codes
            sums = np.bincount(codes, np.concatenate(uses), len(coded.dictionary)).astype(np.int64)
            texts.append(coded.dictionary)
            orders.append(np.full(len(sums), n))
            counts.append(sums)
            done += len(sums)
    length, data = string_bytes(pa.concat_arrays(texts) if texts else pa.array([], "large_string"))
    grams = pack([length, *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (orders, counts))], data.data)
    out = []
    for low, high, wanted in zip(starts, starts[1:], asked):
        if wanted:
            each = [x[x >= 0].astype(np.int64) for x in numbers[:, low:high]]
            # new grams are numbered one after the other, equal beginnings stand side by side
            steps = [np.diff(x, prepend=0) for x in each]
            out.append(pack([np.where(s < 0, -2 * s - 1, 2 * s) for s in steps]))
    return grams, [b for b, wanted in zip(blocks, asked) if wanted], out


def _meeting(max_n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def made(part: int, held: list[tuple]) -> pa.RecordBatch:
        grams, blocks, codes = _met(*map(list, zip(*held)), max_n)
        columns = [pa.array([part], pa.int32()), pa.array([grams], pa.binary())]
        columns += [pa.array([blocks], pa.list_(pa.int32())), pa.array([codes], pa.list_(pa.binary()))]
        return pa.record_batch(columns, names=["part", "grams", "blocks", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("part", "block", "asked", "blob"))):
                if row[0] != part and held:
                    yield made(part, held)
                    held = []
                part = row[0]
                held.append(row[1:])
        if held:
            yield made(part, held)

    return run


def _part_grams(blob: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """n, gram and count of a part's grams."""
    (length, n, cnt), data = unpack(blob)
    size = np.maximum(length.astype(np.int64) - 1, 0)
    return n.astype(np.int32), strings(data, size, length > 0), cnt.astype(np.int64)


def _in_batches(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, rows.num_rows, BATCH_ROWS):
        yield rows.slice(start, BATCH_ROWS)


def _counted_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(n, gram, cnt) of the grams of stored parts that are counted."""
    for batch in batches:
        for blob in batch["grams"].to_pylist():
            n, grams, cnt = _part_grams(blob)
            rows = pa.record_batch([pa.array(n), grams.cast("string"), pa.array(cnt)], names=["n", "gram", "cnt"])
            yield from _in_batches(rows.filter(pa.array(cnt > 0)))


def _bounds(cut: dict) -> dict:
    """A row of cuts, its keys as (hash, bytes of the gram)."""
    keys = {i: cut[f"key_{i}"] for i in (1, 2, 3)}
    plain = {i: None if k is None else (k["hash"], None if k["gram"] is None else k["gram"].encode()) for i, k in keys.items()}
    return {**cut, **{f"key_{i}": k for i, k in plain.items()}}


def _quartiles(n: np.ndarray, grams: pa.Array, cnt: np.ndarray, cuts: dict[int, dict]) -> np.ndarray:
    """The quartile of each gram that is counted, 0 of others, as ``_placed`` gives it."""
    out = np.zeros(len(n), np.int8)
    for order, cut in cuts.items():
        rows = np.flatnonzero((n == order) & (cnt > 0))
        quartile, tied = np.ones(len(rows), np.int8), np.zeros(len(rows), bool)
        for i in (1, 2, 3):
            if cut[f"cnt_{i}"] is not None:
                quartile += cnt[rows] > cut[f"cnt_{i}"]
                tied |= cnt[rows] == cut[f"cnt_{i}"]
        same = np.flatnonzero(tied)
        texts = [None if g is None else g.encode() for g in grams.take(pa.array(rows[same])).to_pylist()]
        digests = [_NO_DIGEST if g is None else hashlib.md5(g).digest() for g in texts]
        heads = np.frombuffer(b"".join(digests), ">u8")[::2]
        for i in (1, 2, 3):
            at = cnt[rows[same]] == cut[f"cnt_{i}"]
            if not at.any():
                continue
            digest, gram = cut[f"key_{i}"]
            if digest is None:  # without a hash it has no place among others
                later = np.array([g is None for g in texts])
            else:
                later = heads > int(digest[:16], 16)
                for j in np.flatnonzero(heads == int(digest[:16], 16)):
                    later[j] = texts[j] is not None and (digests[j].hex(), texts[j]) >= (digest, gram)
                later &= np.array([g is not None for g in texts])
            quartile[same] += at & later
        out[rows] = quartile
    return out


_NO_DIGEST = bytes(16)


def _answers(stored: DataFrame, cuts: dict[int, dict]) -> DataFrame:
    """(block, part, blob): counts and quartiles of the grams that a block asks for, order by order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob, blocks, codes in zip(*(batch[c].to_pylist() for c in ("part", "grams", "blocks", "codes"))):
                if not blocks:
                    continue
                n, grams, cnt = _part_grams(blob)
                cnt = np.where(np.isin(n, list(cuts)), cnt, 0)
                quartile = _quartiles(n, grams, cnt, cuts)
                out = []
                for steps in codes:
                    signed = [s.astype(np.int64) for s in unpack(steps)[0]]
                    each = [np.cumsum(np.where(s % 2, -(s + 1) // 2, s // 2)) for s in signed]
                    out.append(pack([x for e in each for x in (cnt[e], quartile[e])]))
                columns = [pa.array(blocks, pa.int32()), pa.array([part] * len(blocks), pa.int32()), pa.array(out, pa.binary())]
                yield pa.record_batch(columns, names=["block", "part", "blob"])

    return stored.mapInArrow(run, "block int, part int, blob binary")


def _summed_blocks(blocks: DataFrame, answers: DataFrame, sides: list[str], parts: int) -> DataFrame:
    """(id, side, all_n.., q_n_k..) of the blocks' asked rows."""
    asked = blocks.where("asked").select("block", "id", *sides)
    max_n = max(ORDERS)

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        ids = rows["id"].combine_chunks()
        windows = _BlockWindows([rows[s].combine_chunks() for s in sides], max_n, parts)
        sums = windows.sums(dict(zip(found["part"].to_pylist(), found["blob"].to_pylist())))
        side = pa.array(sides).take(pa.array(np.repeat(np.arange(len(sides)), len(ids))))
        return pa.table(
            [pa.concat_arrays([ids] * len(sides)), side, *map(pa.array, sums)], names=["id", "side", *_ALL, *_BY_QUARTILE]
        )

    kind = dict(asked.dtypes)["id"]
    schema = f"id {kind}, side string, " + ", ".join(f"{c} bigint" for c in [*_ALL, *_BY_QUARTILE])
    met = asked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
    return met.groupBy("id", "side").agg(*[F.sum(c).alias(c) for c in [*_ALL, *_BY_QUARTILE]])


def share_sums(
    df: DataFrame, freq: DataFrame, sides: list[str] = ["h1", "h2"], **options: int
) -> DataFrame:
    """Per sentence and side: sums of corpus counts, by n (``all_n``) and quartile (``q_n_k``).

    Sentences are dealt into blocks. A block asks for each of its distinct grams once, under a
    number, and the counts found go back to it under that number.
    """
    asked = df.select("id", *sides, F.lit(True).alias("asked"), F.lit(False).alias("counted"))
    blocks, _ = _blocks(asked, sides)
    requests = _requests(blocks, sides).where("at >= 0").drop("cnt")
    # a gram is asked for once by a block, so that no gram is hot
    nothing = freq.select("n", "gram").limit(0)
    return _answered(blocks, lookup(requests, freq, ["n", "gram"], hot=nothing, **options), sides)


def shares(
    df: DataFrame,
    freq: DataFrame,
    sides: list[str] = ["h1", "h2"],
    parity_denominator: bool = True,
    **options: int,
) -> DataFrame:
    """(id, side, share array[4], quartile_share array[16]).

    ``share``: counts of the sentence's n-grams over the number of distinct corpus n-grams.
    ``quartile_share``: counts by quartile over that quartile's mass; with
    ``parity_denominator`` the unigram mass divides for every n.
    """
    return _divided(share_sums(df, freq, sides, **options), _mass(freq), parity_denominator)


def corpus_shares(
    df: DataFrame,
    sides: list[str] = ["h1", "h2"],
    parity_denominator: bool = True,
    asked: Column | None = None,
    counted: Column | None = None,
) -> DataFrame:
    """``shares`` of the rows that are ``asked`` by the frequencies of the rows ``counted``, both
    conditions; all rows where they are missing.

    The request of a block is also its contribution to the counts. A block's distinct windows travel
    once, as one compressed blob for a part, which counts their beginnings; the counts and quartiles of
    a part's windows go back to the block in the same order. Stored are the distinct grams of each
    part, once, and their numbers for each block.
    """
    asked, counted = (F.lit(True) if c is None else F.coalesce(c, F.lit(False)) for c in (asked, counted))
    blocks, n_blocks = _blocks(df.select("id", *sides, asked.alias("asked"), counted.alias("counted")), sides)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_blocks // 2))
    requests = _packed_requests(blocks, sides, parts).repartition(parts, "part").sortWithinPartitions("part")
    stored = materialize(requests.mapInArrow(_meeting(max(ORDERS)), _MET), row_group=PART_BYTES)
    freq = stored.select("grams").mapInArrow(_counted_grams, "n int, gram string, cnt bigint").withColumn("bucket", _bucket())
    sizes = bucket_sizes(freq)
    cuts = materialize(quartile_cuts(freq, sizes))
    # grams with a null token have no hash, and so no place among equal counts
    mass = _mass_of_sizes(sizes) if sizes.where("bucket is null").isEmpty() else _mass(_placed(freq, cuts))
    at = {r["n"]: _bounds(r.asDict()) for r in cuts.collect()}  # a row per order
    return _divided(_summed_blocks(blocks, _answers(stored, at), sides, parts), mass, parity_denominator)


def _mass(freq: DataFrame) -> DataFrame:
    """(n, quartile, size, mass)."""
    return freq.groupBy("n", "quartile").agg(F.count(F.lit(1)).alias("size"), F.sum("cnt").alias("mass"))


def _mass_of_sizes(by_bucket: DataFrame) -> DataFrame:
    """The same from the number of grams by count: a boundary is a rank in the order of counts,
    whichever grams it falls between."""
    hist = by_bucket.groupBy("n", "cnt").agg(F.sum("size").alias("size"))
    upto = Window.partitionBy("n").orderBy("cnt").rowsBetween(Window.unboundedPreceding, 0)
    ranked = hist.withColumns({"end": F.sum("size").over(upto), "total": F.sum("size").over(Window.partitionBy("n"))})
    cut = [F.floor(F.col("total") * i / 4) for i in range(5)]
    inside = [
        F.greatest(F.least("end", high) - F.greatest(F.col("end") - F.col("size"), low), F.lit(0))
        for low, high in zip(cut, cut[1:])
    ]
    spread = F.inline(F.array(*[F.struct(F.lit(k).alias("quartile"), x.alias("size")) for k, x in zip(QUARTILES, inside)]))
    return ranked.select("n", "cnt", spread).groupBy("n", "quartile").agg(
        F.sum("size").alias("size"), F.sum(F.col("size") * F.col("cnt")).alias("mass")
    )


def _divided(sums: DataFrame, mass: DataFrame, parity_denominator: bool) -> DataFrame:
    """Shares from sums and (n, quartile, size, mass)."""
    n, q = F.col("n"), F.col("quartile")
    stats = mass.agg(
        F.struct(
            *[F.sum(F.when(n == i, F.col("size")).otherwise(0)).alias(f"d_{i}") for i in ORDERS],
            *[
                F.sum(F.when((n == i) & (q == k), F.col("mass")).otherwise(0)).alias(f"m_{i}_{k}")
                for i in ORDERS
                for k in QUARTILES
            ],
        ).alias("stats")
    ).scalar()
    sums = sums.withColumn("stats", stats)
    mass_of = (lambda i: 1) if parity_denominator else (lambda i: i)
    return sums.select(
        "id",
        "side",
        F.array(
            *[F.try_divide(F.col(f"all_{i}"), F.col("stats")[f"d_{i}"]) for i in ORDERS]
        ).alias("share"),
        F.array(
            *[
                F.try_divide(F.col(f"q_{i}_{k}"), F.col("stats")[f"m_{mass_of(i)}_{k}"])
                for i in ORDERS
                for k in QUARTILES
            ]
        ).alias("quartile_share"),
    )
