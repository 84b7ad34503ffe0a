"""Sentence-level BLEU: plain, weighted, and with the smoothing techniques 0 to 7.

Inputs are the arrays made by ``match_counts`` (clipped matches per order) and the lengths.
Scores that are undefined come back NULL and are counted apart from wrong answers.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add, mul

from pyspark.sql import Column
from pyspark.sql import functions as F

from versus.functions.expr import let
from versus.functions.ngrams import ngram_total

# Integers up to here are exact as doubles.
EXACT_DOUBLE = float(2**53)
# Euclid's algorithm on numbers below 10 ** 38 ends within this many steps.
MAX_GCD_STEPS = 185
DEFAULT_K = 5.0


def _euclid(a: Column, b: Column, steps: Column, kind: str) -> Column:
    start = F.struct(a.cast(kind).alias("a"), b.cast(kind).alias("b"))

    def step(z: Column, _i: Column) -> Column:
        nxt = F.struct(z["b"].alias("a"), (z["a"] % F.when(z["b"] != 0, z["b"])).cast(kind).alias("b"))
        return F.when(z["b"] == 0, z).otherwise(nxt)

    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda z: z["a"])


def gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor of a non-negative and a positive integer."""
    steps = (F.log(b.cast("double")) / math.log((1 + math.sqrt(5)) / 2)).cast("int") + 3
    return _euclid(a, b, steps, "bigint")


def _whole(a: Column, b: Column) -> Column:
    """Integer quotient of an exact division."""
    return F.call_function("div", a, b)


def _product(items: list[Column]) -> Column:
    return reduce(mul, items)


def ratio_of_products(nums: list[Column], dens: list[Column]) -> Column:
    """One double for the exact rational prod(nums) / prod(dens).

    Equal rationals give equal doubles: below 2 ** 53 by a single rounded division, beyond it
    after reducing the fraction in 38-digit decimals.
    """
    size = _product([d.cast("double") for d in dens])
    small = _product([n.cast("bigint") for n in nums]).cast("double") / _product(
        [d.cast("bigint") for d in dens]
    ).cast("double")
    wide = "decimal(38,0)"
    num = reduce(lambda x, y: (x * y).cast(wide), [n.cast(wide) for n in nums])
    den = reduce(lambda x, y: (x * y).cast(wide), [d.cast(wide) for d in dens])
    divisor = _euclid(num, den, F.lit(MAX_GCD_STEPS), wide)
    exact = let(
        divisor, lambda g: _whole(num, g).cast("double") / _whole(den, g).cast("double")
    )
    return F.when(size < EXACT_DOUBLE, small).otherwise(exact)


class Precisions:
    """Clipped precisions of one hypothesis, for orders 1..max_n, as columns."""

    def __init__(self, hyp: str, ref: str = "ref", max_n: int = 4):
        self.max_n = max_n
        self.hyp_len = F.col(f"{hyp}_len")
        self.ref_len = F.col(f"{ref}_len")
        self._match = F.col(f"{hyp}_match")

    def num(self, n: int) -> Column:
        return F.get(self._match, F.lit(n - 1))

    def total(self, n: int) -> Column:
        return ngram_total(self.hyp_len, n)

    def den(self, n: int) -> Column:
        """The denominator, 1 where there is no n-gram (the fraction is then 0/1)."""
        return F.greatest(self.total(n), F.lit(1))

    def value(self, n: int) -> Column:
        return self.num(n).cast("double") / self.den(n).cast("double")

    @property
    def orders(self) -> range:
        return range(1, self.max_n + 1)

    def brevity(self) -> Column:
        ratio = self.ref_len.cast("double") / F.nullif(self.hyp_len, F.lit(0)).cast("double")
        return F.when(self.hyp_len > self.ref_len, F.lit(1.0)).otherwise(F.exp(F.lit(1.0) - ratio))


def _score(p: Precisions, product: Column, empty: float | None) -> Column:
    root = F.pow(product, F.lit(1.0 / p.max_n))
    return F.when(p.hyp_len == 0, F.lit(empty).cast("double")).otherwise(root * p.brevity())


def bleu(p: Precisions) -> Column:
    """Unsmoothed; an empty hypothesis scores 0."""
    product = ratio_of_products([p.num(n) for n in p.orders], [p.den(n) for n in p.orders])
    return _score(p, product, 0.0)


def bleu_orders(hyp: str, start: int, end: int, ref: str = "ref") -> Column:
    """Unsmoothed over the orders ``start`` to ``end``."""
    p = Precisions(hyp, ref, end)
    orders = range(start, end + 1)
    product = ratio_of_products([p.num(n) for n in orders], [p.den(n) for n in orders])
    root = F.pow(product, F.lit(1.0 / len(orders)))
    return F.when(p.hyp_len == 0, F.lit(0.0)).otherwise(root * p.brevity())


def bleu_weighted(p: Precisions, weights: list[float | Column]) -> Column:
    """Each precision is multiplied by its weight; the shorter list decides the order count."""
    used = list(zip(p.orders, weights))
    terms = [p.value(n) * (F.lit(float(w)) if not isinstance(w, Column) else w) for n, w in used]
    root = F.pow(_product(terms), F.lit(1.0 / len(used)))
    return F.when(p.hyp_len == 0, F.lit(0.0)).otherwise(root * p.brevity())


def _zero_rank(p: Precisions, n: int) -> Column:
    """How many of the orders 1..n have precision zero."""
    return reduce(add, [F.when(p.num(i) == 0, 1).otherwise(0) for i in range(1, n + 1)])


def _by_length(p: Precisions, k: Column) -> list[Column]:
    """Technique 4: the j-th zero precision becomes j * k / ln(length)."""
    log_len = F.nullif(F.log(F.nullif(p.hyp_len, F.lit(0)).cast("double")), F.lit(0.0))
    return [
        F.when(p.num(n) == 0, _zero_rank(p, n) * k / log_len).otherwise(p.value(n))
        for n in p.orders
    ]


def _neighbours(p: Precisions, values: list[Column]) -> list[Column]:
    """Technique 5: running average with both neighbouring orders.

    The last order's upper neighbour is always the order-5 precision.
    """
    upper = [*values[1:], p.value(5)]
    before = values[0] + 1
    out = []
    for value, after in zip(values, upper):
        before = (before + value + after) / 3
        out.append(before)
    return out


def _interpolated(p: Precisions, alpha: Column) -> list[Column]:
    """Technique 6: prior from the two orders before; orders 2 and 3 stay as they are.

    The first order's "orders before" wrap round to the last two. A zero divisor, or a single
    order, leaves the score undefined.
    """
    values: list[Column] = [p.value(n) for n in p.orders]
    for i in range(len(values)):
        if i in (1, 2):
            continue
        if len(values) < 2:
            return [F.lit(None).cast("double")]
        prior = F.try_divide(values[i - 1] * values[i - 1], values[i - 2])
        values[i] = (values[i] + alpha * prior) / (p.total(i + 1) + alpha)
    return values


def smoothed_product(
    p: Precisions,
    technique: int,
    epsilon: Column | float = 0.1,
    alpha: Column | float = 5.0,
    k: Column | float = 5.0,
) -> Column:
    eps, alpha, k = (
        v if isinstance(v, Column) else F.lit(float(v)) for v in (epsilon, alpha, k)
    )
    nums = [p.num(n) for n in p.orders]
    dens = [p.den(n) for n in p.orders]
    if technique == 0:
        return ratio_of_products(nums, dens)
    if technique == 1:
        # A zero precision is 0/1 after reduction, so it becomes epsilon itself.
        zero = [n == 0 for n in nums]
        rest = ratio_of_products(
            [F.when(z, 1).otherwise(n) for z, n in zip(zero, nums)],
            [F.when(z, 1).otherwise(d) for z, d in zip(zero, dens)],
        )
        return rest * _product([F.when(z, eps).otherwise(F.lit(1.0)) for z in zero])
    if technique == 2:
        pairs = F.array(*[F.struct(*add_one(n, d)) for n, d in zip(nums, dens)])
        return let(
            pairs,
            lambda rows: ratio_of_products(
                [rows[i]["num"] for i in range(p.max_n)], [rows[i]["den"] for i in range(p.max_n)]
            ),
        )
    if technique == 3:
        return ratio_of_products(
            [F.when(n == 0, 1).otherwise(n) for n in nums],
            [
                F.when(n == 0, _halvings(p, i)).otherwise(d)
                for i, n, d in zip(p.orders, nums, dens)
            ],
        )
    if technique == 4:
        return _product(_by_length(p, k))
    if technique == 5:
        return _product(_neighbours(p, [p.value(n) for n in p.orders]))
    if technique == 6:
        return _product(_interpolated(p, alpha))
    if technique == 7:
        return _product(_neighbours(p, _by_length(p, F.lit(DEFAULT_K))))
    raise ValueError(f"smoothing technique must be 0 to 7, got {technique}")


def _halvings(p: Precisions, n: int) -> Column:
    """2 ** (rank + 1) for the rank of order ``n`` among the zero precisions."""
    return F.pow(F.lit(2.0), _zero_rank(p, n) + 1).cast("int")


def add_one(num: Column, den: Column, reduce_first: bool = True) -> tuple[Column, Column]:
    """Add one to both terms of the fraction, by default after reducing it."""
    if not reduce_first:
        return (num + 1).alias("num"), (den + 1).alias("den")
    divisor = (
        F.when(num == 0, den)
        .when(num == den, den)
        .when(num == 1, F.lit(1))
        .otherwise(gcd(num, den))
    ).cast("bigint")
    return (
        let(divisor, lambda g: _whole(num, g) + 1).alias("num"),
        let(divisor, lambda g: _whole(den, g) + 1).alias("den"),
    )


def bleu_smoothed(
    p: Precisions,
    technique: int,
    epsilon: Column | float = 0.1,
    alpha: Column | float = 5.0,
    k: Column | float = 5.0,
) -> Column:
    """Smoothed sentence BLEU. Needs orders up to 5 in ``<hyp>_match`` for techniques 5 and 7."""
    product = smoothed_product(p, technique, epsilon, alpha, k)
    return _score(p, product, 0.0 if technique == 0 else None)
