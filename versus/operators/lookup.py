"""Lookups of many rows in a keyed table, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versus.operators.bitmap import build_filter, may_hold

# A lookup table of at most this many rows and bytes is broadcast.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A hot key with more entries than this is not broadcast but joined like the others.
MAX_ENTRIES = 100
# Hot rows and rows without a key are spread over this many parts in the shuffled join.
SPREAD = 1_000
# Keys holding at least this share of all rows are treated apart; there can be at most
# 1 / HOT_SHARE of them, whatever the data.
HOT_SHARE = 1.0 / 2_000


def hot_keys(rows: DataFrame, on: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold at least ``share`` of the rows: no more than 1 / share keys."""
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("t")).scalar()
    return counts.where(F.col("__n") >= total * share).select(*on)


def table_size(table: DataFrame) -> tuple[int, int]:
    """Rows, and bytes as counted: the lengths of strings and arrays, 8 for other values."""
    parts = [F.lit(16)]
    for name, kind in table.dtypes:
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(name), F.lit(0)) + 16)
        elif kind.startswith("array"):
            parts.append(8 * F.greatest(F.size(name), F.lit(0)) + 16)
        else:
            parts.append(F.lit(8))
    row = parts[0]
    for part in parts[1:]:
        row = row + part
    found = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(row), F.lit(0))).first()
    return found[0], found[1]


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "inner",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` with a stored ``table`` (``how``: inner or left).

    A table of few rows and bytes, both counted, is broadcast. A larger one is shuffled with the
    rows, which pass once; in an inner join a bitmap of fixed size drops most rows without an entry
    before that: rows of hot keys get their entries from a broadcast (a bounded number of
    keys with a bounded number of entries each) and are spread in the shuffle, like rows without a
    key. ``hot`` gives the hot keys when the caller knows them already; its size must be bounded
    like that of ``hot_keys``.
    """
    n_rows, n_bytes = table_size(table)
    if n_rows <= max_broadcast_rows and n_bytes <= max_broadcast_bytes:
        return rows.join(F.broadcast(table), on, how)
    if how == "inner":
        rows = may_hold(rows, build_filter(table, on), on)
    hot = F.broadcast((hot_keys(rows, on) if hot is None else hot).distinct())
    values = [c for c in table.columns if c not in on]
    entries = (
        table.join(hot, on, "left_semi")
        .groupBy(*on)
        .agg(F.collect_list(F.struct(*values)).alias("__hot"))
        .where(F.size("__hot") <= MAX_ENTRIES)
    )
    tagged = rows.join(F.broadcast(entries), on, "left")
    absent = F.col(on[0]).isNull()
    for c in on[1:]:
        absent = absent | F.col(c).isNull()
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)) + 1
    spread = F.when(F.col("__hot").isNotNull() | absent, part).otherwise(0)
    cold = table.select(*on, F.struct(*values).alias("__cold"), F.lit(0).cast("long").alias("__part"))
    joined = tagged.withColumn("__part", spread).join(cold, [*on, "__part"], "left")
    found = F.coalesce("__hot", F.when(F.col("__cold").isNotNull(), F.array("__cold")))
    kept = joined if how == "left" else joined.where(found.isNotNull())
    return kept.select(*rows.columns, F.inline_outer(found))
