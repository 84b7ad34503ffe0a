"""Shared pieces of the oracle SQL (DuckDB dialect): the fixtures and n-gram counts."""

from __future__ import annotations

# Byte whitespace, spelled with chr() because SQL literals have no escapes.
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"

TRIPLES = rf"""
cut AS (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]*[.!?]+|[^.!?\n]+') AS a FROM documents),
parts AS (SELECT doc_id, unnest(a) AS s, unnest(range(len(a))) AS pos FROM cut),
sentences AS (
  SELECT doc_id * 1000000 + pos AS id, doc_id, trim(s, {WS}) AS text
  FROM parts WHERE trim(s, {WS}) <> ''),
tok AS (SELECT id, doc_id, regexp_split_to_array(text, '\s+') AS ref FROM sentences),
triples AS (
  SELECT id, doc_id,
    list_filter(ref, lambda x, i: (i - 1 + id) % 5 <> 0) AS h1,
    list_concat(
      list_transform(ref, lambda x, i: CASE WHEN (i - 1 + id) % (doc_id % 4 + 3) = 0
                                            THEN x || '~' ELSE x END),
      ref[1:doc_id % 3]) AS h2,
    ref
  FROM tok)"""

GOLD = "gold AS (SELECT doc_id, (quality - toxic)::INTEGER AS gold FROM labels)"

OVERLAP = """
overlap AS (
  SELECT id, doc_id,
    len(list_filter(h1, lambda x: list_contains(ref, x))) AS h1_hits,
    len(list_filter(h2, lambda x: list_contains(ref, x))) AS h2_hits,
    len(h1) AS h1_len, len(h2) AS h2_len, len(ref) AS ref_len
  FROM triples)"""


def pref(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {a} > {b} THEN 1 "
        f"WHEN {a} = {b} THEN 0 ELSE -1 END"
    )


def meteor_sql(hits: str, hyp: str, ref: str, alpha: str) -> str:
    p, r = f"({hits}::DOUBLE / {hyp}::DOUBLE)", f"({hits}::DOUBLE / {ref}::DOUBLE)"
    return (
        f"CASE WHEN {hits} = 0 THEN 0.0::DOUBLE ELSE ({p} * {r}) / "
        f"((1.0::DOUBLE - {alpha}) * {r} + {alpha} * {p}) END"
    )


def sides_of(source: str, cols: tuple[str, ...] = ("h1", "h2", "ref")) -> str:
    union = " UNION ALL ".join(f"SELECT id, '{c}' AS side, {c} AS t FROM {source}" for c in cols)
    return f"sides AS ({union})"


def grams_of(max_n: int, sep: str = " ") -> str:
    """(id, side, n, g, c) from sides(id, side, t)."""
    return f"""
positions AS (
  SELECT id, side, n, t, unnest(range(1, len(t) - n + 2)) AS i
  FROM sides, range(1, {max_n + 1}) AS orders(n)),
grams AS (SELECT id, side, n, array_to_string(t[i:i + n - 1], '{sep}') AS g FROM positions),
gram_counts AS (SELECT id, side, n, g, count(*) AS c FROM grams GROUP BY ALL)"""


MATCHES = """
matches AS (
  SELECT h.id, h.side, h.n, sum(least(h.c, coalesce(r.c, 0)))::BIGINT AS m
  FROM (SELECT * FROM gram_counts WHERE side <> 'ref') h
  LEFT JOIN (SELECT * FROM gram_counts WHERE side = 'ref') r
    ON r.id = h.id AND r.n = h.n AND r.g = h.g
  GROUP BY ALL)"""


def _per_side(max_n: int) -> str:
    ms = ", ".join(
        f"coalesce(max(m) FILTER (n = {n}), 0) AS m{n}" for n in range(1, max_n + 1)
    )
    return f"""
lengths AS (
  SELECT id, doc_id, 'h1' AS side, len(h1) AS c, len(ref) AS r FROM triples
  UNION ALL SELECT id, doc_id, 'h2', len(h2), len(ref) FROM triples),
per_side AS (
  SELECT l.id, l.doc_id, l.side, l.c, l.r, {ms}
  FROM lengths l LEFT JOIN matches x ON x.id = l.id AND x.side = l.side
  GROUP BY ALL)"""


BLEU_INPUT = ",".join([TRIPLES, sides_of("triples"), grams_of(5), MATCHES, _per_side(5)])


def _prod(items: list[str]) -> str:
    return " * ".join(items)


def bleu_product(technique: int | str, orders: range = range(1, 5), weights=None) -> str:
    """The product under the root, over columns m1.. c of per_side."""
    eps, alpha, k = "0.1::DOUBLE", "5.0::DOUBLE", "5.0::DOUBLE"
    ns = list(orders)
    den = {n: f"greatest(c - {n - 1}, 1)" for n in [*ns, 5]}
    val = {n: f"(m{n}::DOUBLE / {den[n]}::DOUBLE)" for n in [*ns, 5]}
    rank = {
        n: "(" + " + ".join(f"(m{i} = 0)::INTEGER" for i in ns if i <= n) + ")" for n in ns
    }

    def ratio(nums, dens):
        return f"(({_prod(nums)})::BIGINT::DOUBLE / ({_prod(dens)})::BIGINT::DOUBLE)"

    def by_length():
        return {
            n: f"(CASE WHEN m{n} = 0 THEN {rank[n]} * {k} / nullif(ln(nullif(c, 0)::DOUBLE), 0)"
            f" ELSE {val[n]} END)"
            for n in ns
        }

    def neighbours(v):
        out, before = [], f"({v[ns[0]]} + 1)"
        for i, n in enumerate(ns):
            after = v[ns[i + 1]] if i + 1 < len(ns) else val[5]
            before = f"(({before} + {v[n]} + {after}) / 3)"
            out.append(before)
        return _prod(out)

    if technique == "weights":
        return _prod([f"({val[n]} * {w}::DOUBLE)" for n, w in zip(ns, weights)])
    if technique == 0:
        return ratio([f"m{n}" for n in ns], [den[n] for n in ns])
    if technique == 1:
        rest = ratio(
            [f"(CASE WHEN m{n} = 0 THEN 1 ELSE m{n} END)" for n in ns],
            [f"(CASE WHEN m{n} = 0 THEN 1 ELSE {den[n]} END)" for n in ns],
        )
        zeros = _prod([f"(CASE WHEN m{n} = 0 THEN {eps} ELSE 1.0::DOUBLE END)" for n in ns])
        return f"{rest} * ({zeros})"
    if technique == 2:
        return ratio(
            [f"(m{n} // gcd(m{n}, {den[n]}) + 1)" for n in ns],
            [f"({den[n]} // gcd(m{n}, {den[n]}) + 1)" for n in ns],
        )
    if technique == 3:
        return ratio(
            [f"(CASE WHEN m{n} = 0 THEN 1 ELSE m{n} END)" for n in ns],
            [f"(CASE WHEN m{n} = 0 THEN (2 ** ({rank[n]} + 1))::BIGINT ELSE {den[n]} END)" for n in ns],
        )
    if technique == 4:
        return _prod(list(by_length().values()))
    if technique == 5:
        return neighbours(val)
    if technique == 7:
        return neighbours(by_length())
    if technique == 6:
        assert ns == [1, 2, 3, 4]

        def mixed(n, a, b):
            return (
                f"((m{n}::DOUBLE / {den[n]}::DOUBLE + {alpha} * ({val[a]} * {val[a]} / "
                f"nullif({val[b]}, 0))) / (greatest(c - {n - 1}, 0) + {alpha}))"
            )

        return _prod([mixed(1, 4, 3), val[2], val[3], mixed(4, 3, 2)])
    raise ValueError(technique)


def bleu_score(technique, orders: range = range(1, 5), weights=None) -> str:
    empty = "0.0" if technique in (0, "weights") else "NULL"
    return (
        f"CASE WHEN c = 0 THEN {empty}::DOUBLE ELSE "
        f"pow({bleu_product(technique, orders, weights)}, 1.0::DOUBLE / {len(orders)}) * "
        f"CASE WHEN c > r THEN 1.0::DOUBLE ELSE exp(1 - r::DOUBLE / c::DOUBLE) END END"
    )


def bleu_scored(h1: str, h2: str) -> str:
    """CTE bleu_scored(id, doc_id, h1_score, h2_score) from two score expressions."""
    return f"""
bleu_scored AS (
  SELECT id, doc_id, max(s) FILTER (side = 'h1') AS h1_score, max(s) FILTER (side = 'h2') AS h2_score
  FROM (SELECT id, doc_id, side, CASE WHEN side = 'h1' THEN {h1} ELSE {h2} END AS s FROM per_side)
  GROUP BY ALL)"""


def with_ctes(*parts: str) -> str:
    """WITH clause of all but the last part, followed by the last."""
    return "WITH " + ",".join(parts[:-1]) + "\n" + parts[-1]
