"""n-gram generation and multiset matching, row-local: no shuffle, memory bounded by one row.

A text pair is matched inside its row, on codes of its tokens, a batch of rows at a time: see
``matching``. The counts are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versus.functions.expr import let
from versus.functions.matching import matcher

# Longest side, in tokens, of rows in which a missing side leaves the matches undefined.
CODED_LIMIT = 192
# Largest product of sizes for which membership is tested pair by pair.
PAIRWISE_LIMIT = 40_000
# The same for characters: the code points below this one.
CHARACTER_BASE = 8_192


def ngram_strings(tokens: Column, n: int | Column, sep: str = " ") -> Column:
    """All windows of ``n`` tokens, joined by ``sep``; none when the input is shorter."""
    n = F.lit(n) if isinstance(n, int) else n
    windows = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - n + 1),
        lambda i: F.array_join(F.slice(tokens, i, n), sep),
    )
    return F.when(F.size(tokens) >= n, windows).otherwise(F.array().cast("array<string>"))


def with_ngram_columns(df: DataFrame, tokens: str, max_n: int, sep: str = " ") -> DataFrame:
    """Add ``<tokens>_<n>`` for n = 2..max_n, each built by extending the order below by one token."""
    size = F.size(tokens)
    lower = tokens
    for n in range(2, max_n + 1):
        extended = F.zip_with(
            F.slice(lower, F.lit(1), size - (n - 1)),
            F.slice(tokens, F.lit(n), size - (n - 1)),
            lambda g, t: F.concat(g, F.lit(sep), t),
        )
        df = df.withColumn(
            f"{tokens}_{n}",
            F.when(size >= n, extended).otherwise(F.array().cast("array<string>")),
        )
        lower = f"{tokens}_{n}"
    return df


def ngram_total(length: Column, n: int) -> Column:
    return F.greatest(length - (n - 1), F.lit(0))


def _merge(left: Column, right: Column) -> Column:
    """Walk both bags in sorted order; gives (clipped, hits) in O(L log L)."""
    tagged = F.sort_array(
        F.concat(
            F.transform(left, lambda g: F.struct(g.alias("g"), F.lit(0).alias("s"))),
            F.transform(right, lambda g: F.struct(g.alias("g"), F.lit(1).alias("s"))),
        )
    )

    def closed(z: Column) -> tuple[Column, Column]:
        return (
            z["clipped"] + F.least(z["l"], z["r"]),
            z["hits"] + F.when(z["r"] > 0, z["l"]).otherwise(0),
        )

    def state(g, left_n, right_n, clipped, hits):
        return F.struct(
            g.alias("g"),
            left_n.alias("l"),
            right_n.alias("r"),
            clipped.alias("clipped"),
            hits.alias("hits"),
        )

    def step(z: Column, e: Column) -> Column:
        is_left = F.when(e["s"] == 0, 1).otherwise(0)
        same = state(z["g"], z["l"] + is_left, z["r"] + 1 - is_left, z["clipped"], z["hits"])
        clipped, hits = closed(z)
        return F.when(e["g"] == z["g"], same).otherwise(
            state(e["g"], is_left, 1 - is_left, clipped, hits)
        )

    def finish(z: Column) -> Column:
        clipped, hits = closed(z)
        return F.struct(clipped.alias("clipped"), hits.alias("hits"))

    zero = F.lit(0)
    return let(
        tagged,
        lambda items: F.aggregate(
            items, state(F.get(items, F.lit(0))["g"], zero, zero, zero, zero), step, finish
        ),
    )


def bag_hits(hyp: Column, ref: Column) -> Column:
    """Tokens of ``hyp`` (repeats counted) that occur at all in ``ref``."""
    short = F.size(hyp).cast("long") * F.size(ref) <= PAIRWISE_LIMIT
    return F.when(
        short, F.size(F.filter(hyp, lambda t: F.array_contains(ref, t)))
    ).otherwise(_merge(hyp, ref)["hits"])


def match_counts(
    df: DataFrame,
    hyps: list[str],
    ref: str,
    max_n: int = 4,
    coded_limit: int = CODED_LIMIT,
    characters: bool = False,
) -> DataFrame:
    """Add ``<hyp>_match``: clipped n-gram matches against ``ref`` for n = 1..max_n, as an array.

    Also adds ``<hyp>_len`` and ``<ref>_len``; n-gram totals follow from the lengths. A missing side
    leaves the matches of single tokens undefined in rows of up to ``coded_limit`` tokens.
    With ``characters`` every token is one character; the columns may also hold whole texts.
    """
    sides = [*hyps, ref]
    whole = {name for name, kind in df.dtypes if kind == "string"}
    texts = [F.array_join(c, "") if characters and c not in whole else F.col(c) for c in sides]
    run = matcher(max_n, CHARACTER_BASE - 1 if characters else coded_limit, characters)
    kind = ",".join(f"m{i}:array<bigint>" for i in range(len(hyps)))
    matched = df.withColumn("__matches", F.arrow_udf(run, f"struct<{kind}>")(*texts))
    return matched.withColumns(
        {
            **{f"{c}_len": F.length(c) if c in whole else F.size(c) for c in sides},
            **{f"{h}_match": F.col("__matches")[f"m{i}"] for i, h in enumerate(hyps)},
        }
    ).drop("__matches")
