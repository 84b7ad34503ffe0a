"""Queries over metrics, judgements and sweeps, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versus.functions.expr import r6
from versus.functions.ngrams import ngram_total
from versus.operators import judge as J
from versus.plans import fixtures as X
from versus.plans import oracle_base as O
from versus.plans import sweeps as S
from versus.sources.logs import parse_sweep_log, render_sweep_log

ALPHAS = (1, 100, 1, 100)
FINE_ALPHAS = (800, 1000, 1, 1000)
WEIGHTS = [(0.25, 0.25, 0.25, 0.25), (1.0, 1.0, 1.0, 1.0), (0.4, 0.3, 0.2, 0.1)]
FIRST_ROWS = 100


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    return J.overlap_counts(X.triples(spark, d))


def _counts(spark: SparkSession, d: str, max_n: int = 5) -> DataFrame:
    return J.bleu_counts(X.triples(spark, d), max_n)


def _scores(df: DataFrame) -> DataFrame:
    return df.select(
        "id", r6(F.col("h1_score")).alias("h1_score"), r6(F.col("h2_score")).alias("h2_score"), "pred"
    )


def word_overlap_pref(spark, d):
    out = J.judge_overlap(X.triples(spark, d))
    return out.select("id", "h1_hits", "h2_hits", "pred")


def row_limit(spark, d):
    return J.judge_overlap(J.first_rows(X.triples(spark, d), FIRST_ROWS)).select("id", "pred")


def meteor_scores(spark, d):
    return _scores(J.judge_meteor(X.triples(spark, d)))


def _meteor_counts(spark, d):
    preds = J.judge_meteor(X.triples(spark, d)).select("doc_id", "pred")
    return J.gold_pred_counts(preds, X.judgements(spark, d), "doc_id")


def confusion_matrix(spark, d):
    return J.confusion(_meteor_counts(spark, d))


def accuracy(spark, d):
    out = J.accuracy(_meteor_counts(spark, d))
    return out.select("n_judged", "n_right", "n_undefined", r6(F.col("accuracy")).alias("accuracy"))


def classification_report(spark, d):
    out = J.classification_report(_meteor_counts(spark, d))
    return out.select(
        "label",
        *[r6(F.col(c)).alias(c) for c in ("precision", "recall", "f_score")],
        "support",
    )


def raw_predictions(spark, d) -> DataFrame:
    """Judgements as text, with malformed, out-of-range and left-out rows for validation."""
    judged = J.judge_overlap(X.triples(spark, d)).select("id", "pred")
    raw = (
        F.when(F.col("id") % 97 == 0, F.lit("2"))
        .when(F.col("id") % 101 == 0, F.lit("x"))
        .otherwise(F.col("pred").cast("string"))
    )
    return judged.where("id % 89 <> 0").select("id", raw.alias("raw"))


def invalid_judgements(spark, d):
    return J.validate(raw_predictions(spark, d))[1]


def length_mismatch(spark, d):
    ids = X.sentences_of(X.documents(spark, d)).select("id")
    return J.length_mismatch(ids, raw_predictions(spark, d).select("id"))


def meteor_alpha_sweep(spark, d):
    out = S.meteor_alpha_sweep(
        _overlaps(spark, d), X.judgements(spark, d), "doc_id", S.fractions(*ALPHAS)
    )
    return out.select("alpha", "n_judged", "n_right", r6(F.col("accuracy")).alias("accuracy"))


def meteor_alpha_fine(spark, d):
    """The same sweep from 0.800 to 0.999 in steps of 0.001."""
    out = S.meteor_alpha_sweep(
        _overlaps(spark, d), X.judgements(spark, d), "doc_id", S.fractions(*FINE_ALPHAS)
    )
    return out.select("alpha", "n_judged", "n_right", r6(F.col("accuracy")).alias("accuracy"))


def sweep_topk(spark, d):
    """Sweep, render as a text log, parse the log again, and rank it."""
    log = render_sweep_log(
        meteor_alpha_sweep(spark, d).withColumn("id", F.round(F.col("alpha") * 100).cast("long"))
    )
    parsed = parse_sweep_log(log)
    return S.best_settings(parsed, 10, "id").select("alpha", "accuracy")


def ngram_counts(spark, d):
    """How many (sentence, gram) pairs occur 1, 2, … times, per side and order."""
    from versus.operators.frequency import sentence_gram_counts

    counts = sentence_gram_counts(X.triples(spark, d), ["h1", "h2", "ref"], 4)
    return counts.groupBy("side", "n", "cnt").agg(F.count(F.lit(1)).alias("n_grams"))


def clipped_precision(spark, d):
    counts = _counts(spark, d, 4)
    rows = counts.select(
        "id",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("n"),
                        F.get("h1_match", F.lit(n - 1)).alias("h1_match"),
                        ngram_total(F.col("h1_len"), n).alias("h1_total"),
                        F.get("h2_match", F.lit(n - 1)).alias("h2_match"),
                        ngram_total(F.col("h2_len"), n).alias("h2_total"),
                    )
                    for n in range(1, 5)
                ]
            )
        ),
    )
    return rows


def bleu_simple(spark, d):
    return _scores(J.score_bleu(_counts(spark, d, 4)))


def bleu_bigram_up(spark, d):
    return _scores(J.score_bleu(_counts(spark, d, 4), 4, start=2))


def bleu_weighted(spark, d):
    return _scores(J.score_bleu_weighted(_counts(spark, d, 4), list(WEIGHTS[2])))


def bleu_default(spark, d):
    """The defaults: technique 4 for the first hypothesis, 1 for the second."""
    return _scores(J.score_bleu_smoothed(_counts(spark, d)))


def _bleu_smooth(technique: int):
    def query(spark, d):
        return _scores(J.score_bleu_smoothed(_counts(spark, d), technique, technique))

    return query


def _sweep(out: DataFrame, key: str) -> DataFrame:
    return out.select(
        key, "n_judged", "n_right", "n_undefined", r6(F.col("accuracy")).alias("accuracy")
    )


def bleu_ngram_sweep(spark, d):
    out = S.bleu_order_sweep(_counts(spark, d, 4), X.judgements(spark, d), "doc_id")
    return _sweep(out, "max_n")


def bleu_weight_sweep(spark, d):
    out = S.bleu_weight_sweep(_counts(spark, d, 4), X.judgements(spark, d), "doc_id", WEIGHTS)
    return _sweep(out, "setting")


def bleu_smoothing_sweep(spark, d):
    out = S.bleu_smoothing_sweep(_counts(spark, d), X.judgements(spark, d), "doc_id")
    return _sweep(out, "technique")


QUERIES = {
    "word_overlap_pref": word_overlap_pref,
    "row_limit": row_limit,
    "meteor_scores": meteor_scores,
    "confusion_matrix": confusion_matrix,
    "accuracy": accuracy,
    "classification_report": classification_report,
    "invalid_judgements": invalid_judgements,
    "length_mismatch": length_mismatch,
    "meteor_alpha_sweep": meteor_alpha_sweep,
    "meteor_alpha_fine": meteor_alpha_fine,
    "sweep_topk": sweep_topk,
    "ngram_counts": ngram_counts,
    "clipped_precision": clipped_precision,
    "bleu_simple": bleu_simple,
    "bleu_bigram_up": bleu_bigram_up,
    "bleu_weighted": bleu_weighted,
    "bleu_default": bleu_default,
    **{f"bleu_smooth_{t}": _bleu_smooth(t) for t in range(8)},
    "bleu_ngram_sweep": bleu_ngram_sweep,
    "bleu_weight_sweep": bleu_weight_sweep,
    "bleu_smoothing_sweep": bleu_smoothing_sweep,
}

# ---------------------------------------------------------------- oracle SQL

_M1 = O.meteor_sql("h1_hits", "h1_len", "ref_len", "0.1::DOUBLE")
_M2 = O.meteor_sql("h2_hits", "h2_len", "ref_len", "0.1::DOUBLE")
_METEOR_SCORED = f"scored AS (SELECT id, doc_id, {_M1} AS s1, {_M2} AS s2 FROM overlap)"
_METEOR_COUNTS = f"""counts AS (
  SELECT gold, {O.pref('s1', 's2')} AS pred, count(*) AS cnt
  FROM scored JOIN gold USING (doc_id) GROUP BY ALL)"""
_COUNT_CTES = (O.TRIPLES, O.OVERLAP, O.GOLD, _METEOR_SCORED, _METEOR_COUNTS)
_RAW = f"""raw AS (
  SELECT id, CASE WHEN id % 97 = 0 THEN '2' WHEN id % 101 = 0 THEN 'x'
    ELSE ({O.pref('h1_hits', 'h2_hits')})::VARCHAR END AS raw
  FROM overlap WHERE id % 89 <> 0)"""
_SCORES = f"""SELECT id, round(h1_score, 6) AS h1_score, round(h2_score, 6) AS h2_score,
  {O.pref('h1_score', 'h2_score')} AS pred FROM bleu_scored"""


def _alpha_ctes(start: int, stop: int, step: int, divisor: int) -> tuple[str, ...]:
    sweep = f"""alphas AS (SELECT i::DOUBLE / {divisor}.0::DOUBLE AS alpha FROM range({start}, {stop}, {step}) AS t(i)),
profiles AS (SELECT gold, h1_hits, h2_hits, h1_len, h2_len, ref_len, count(*) AS weight
  FROM overlap JOIN gold USING (doc_id) GROUP BY ALL),
sweep AS (
  SELECT alpha, sum(weight)::BIGINT AS n_judged, (sum(weight) FILTER (pred = gold))::BIGINT AS n_right
  FROM (SELECT alpha, gold, weight, {O.pref(O.meteor_sql('h1_hits', 'h1_len', 'ref_len', 'alpha'),
                                            O.meteor_sql('h2_hits', 'h2_len', 'ref_len', 'alpha'))} AS pred
        FROM profiles, alphas)
  GROUP BY alpha)"""
    return (O.TRIPLES, O.OVERLAP, O.GOLD, sweep)


FINE_ALPHA_CTES = _alpha_ctes(*FINE_ALPHAS)
_ALPHA_CTES = _alpha_ctes(*ALPHAS)


def _scored_sql(h1: str, h2: str) -> str:
    return O.with_ctes(O.BLEU_INPUT, O.bleu_scored(h1, h2), _SCORES)


def _sweep_sql(key: str, settings: dict[object, str]) -> str:
    union = " UNION ALL ".join(
        f"SELECT {k} AS {key}, id, doc_id, side, {score} AS s FROM per_side"
        for k, score in settings.items()
    )
    return O.with_ctes(
        O.BLEU_INPUT,
        O.GOLD,
        f"unfolded AS ({union})",
        f"""paired AS (
  SELECT {key}, id, doc_id, max(s) FILTER (side = 'h1') AS s1, max(s) FILTER (side = 'h2') AS s2
  FROM unfolded GROUP BY ALL)""",
        f"""SELECT {key}, count(pred) AS n_judged,
  (count(*) FILTER (pred = gold)) AS n_right, (count(*) FILTER (pred IS NULL)) AS n_undefined,
  round((count(*) FILTER (pred = gold))::DOUBLE / count(pred), 6) AS accuracy
FROM (SELECT {key}, gold, {O.pref('s1', 's2')} AS pred FROM paired JOIN gold USING (doc_id))
GROUP BY {key}""",
    )


ORACLE = {
    "word_overlap_pref": O.with_ctes(
        O.TRIPLES,
        O.OVERLAP,
        f"SELECT id, h1_hits, h2_hits, {O.pref('h1_hits', 'h2_hits')} AS pred FROM overlap",
    ),
    "row_limit": O.with_ctes(
        O.TRIPLES,
        O.OVERLAP,
        f"SELECT id, {O.pref('h1_hits', 'h2_hits')} AS pred FROM overlap "
        f"ORDER BY id LIMIT {FIRST_ROWS}",
    ),
    "meteor_scores": O.with_ctes(
        O.TRIPLES,
        O.OVERLAP,
        _METEOR_SCORED,
        f"""SELECT id, round(s1, 6) AS h1_score, round(s2, 6) AS h2_score,
  {O.pref('s1', 's2')} AS pred FROM scored""",
    ),
    "confusion_matrix": O.with_ctes(
        *_COUNT_CTES,
        """SELECT g AS gold,
  coalesce(sum(cnt) FILTER (pred = -1), 0)::BIGINT AS pred_neg,
  coalesce(sum(cnt) FILTER (pred = 0), 0)::BIGINT AS pred_zero,
  coalesce(sum(cnt) FILTER (pred = 1), 0)::BIGINT AS pred_pos
FROM (VALUES (-1), (0), (1)) AS l(g) LEFT JOIN counts ON gold = g GROUP BY g""",
    ),
    "accuracy": O.with_ctes(
        *_COUNT_CTES,
        """SELECT (sum(cnt) FILTER (pred IS NOT NULL))::BIGINT AS n_judged,
  coalesce(sum(cnt) FILTER (pred = gold), 0)::BIGINT AS n_right,
  coalesce(sum(cnt) FILTER (pred IS NULL), 0)::BIGINT AS n_undefined,
  round(coalesce(sum(cnt) FILTER (pred = gold), 0)::DOUBLE / (sum(cnt) FILTER (pred IS NOT NULL)), 6)
    AS accuracy
FROM counts""",
    ),
    "classification_report": O.with_ctes(
        *_COUNT_CTES,
        """seen AS (
  SELECT label, sum(CASE WHEN gold = label THEN cnt ELSE 0 END)::BIGINT AS support,
    sum(CASE WHEN pred = label THEN cnt ELSE 0 END)::BIGINT AS predicted,
    sum(CASE WHEN gold = label AND pred = label THEN cnt ELSE 0 END)::BIGINT AS hit
  FROM counts, (SELECT DISTINCT gold AS label FROM counts UNION SELECT DISTINCT pred FROM counts) l
  GROUP BY label),
rated AS (SELECT label, support, coalesce(hit::DOUBLE / nullif(predicted, 0), 0) AS p,
  coalesce(hit::DOUBLE / nullif(support, 0), 0) AS r FROM seen)""",
        """SELECT label, round(p, 6) AS precision, round(r, 6) AS recall,
  round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f_score, support FROM rated""",
    ),
    "invalid_judgements": O.with_ctes(
        O.TRIPLES,
        O.OVERLAP,
        _RAW,
        """SELECT id, raw, CASE WHEN try_cast(raw AS INTEGER) IS NULL THEN 'not an integer'
  ELSE 'out of range' END AS reason
FROM raw WHERE coalesce(try_cast(raw AS INTEGER) NOT BETWEEN -1 AND 1, true)""",
    ),
    "length_mismatch": O.with_ctes(
        O.TRIPLES,
        O.OVERLAP,
        _RAW,
        """SELECT count(i.id) AS n_inputs, count(p.id) AS n_predictions,
  (count(*) FILTER (p.id IS NULL)) AS n_missing, (count(*) FILTER (i.id IS NULL)) AS n_extra
FROM sentences i FULL JOIN raw p ON i.id = p.id""",
    ),
    "meteor_alpha_sweep": O.with_ctes(
        *_ALPHA_CTES,
        "SELECT alpha, n_judged, n_right, round(n_right::DOUBLE / n_judged, 6) AS accuracy FROM sweep",
    ),
    "meteor_alpha_fine": O.with_ctes(
        *FINE_ALPHA_CTES,
        "SELECT alpha, n_judged, n_right, round(n_right::DOUBLE / n_judged, 6) AS accuracy FROM sweep",
    ),
    "sweep_topk": O.with_ctes(
        *_ALPHA_CTES,
        """SELECT alpha, round(n_right::DOUBLE / n_judged, 6) AS accuracy FROM sweep
ORDER BY accuracy DESC, alpha LIMIT 10""",
    ),
    "ngram_counts": O.with_ctes(
        O.TRIPLES,
        O.sides_of("triples"),
        O.grams_of(4),
        """SELECT side, n, c AS cnt, count(*) AS n_grams FROM gram_counts
GROUP BY ALL""",
    ),
    "clipped_precision": O.with_ctes(
        O.TRIPLES,
        O.sides_of("triples"),
        O.grams_of(4),
        O.MATCHES,
        """by_id AS (SELECT id, n, max(m) FILTER (side = 'h1') AS a, max(m) FILTER (side = 'h2') AS b
  FROM matches GROUP BY ALL),
orders AS (SELECT id, len(h1) AS c1, len(h2) AS c2, unnest([1, 2, 3, 4]) AS n FROM triples)""",
        """SELECT id, n, coalesce(a, 0) AS h1_match, greatest(c1 - n + 1, 0) AS h1_total,
  coalesce(b, 0) AS h2_match, greatest(c2 - n + 1, 0) AS h2_total
FROM orders LEFT JOIN by_id USING (id, n)""",
    ),
    "bleu_simple": _scored_sql(O.bleu_score(0), O.bleu_score(0)),
    "bleu_bigram_up": _scored_sql(O.bleu_score(0, range(2, 5)), O.bleu_score(0, range(2, 5))),
    "bleu_weighted": _scored_sql(
        O.bleu_score("weights", weights=WEIGHTS[2]), O.bleu_score("weights", weights=WEIGHTS[2])
    ),
    "bleu_default": _scored_sql(O.bleu_score(4), O.bleu_score(1)),
    **{f"bleu_smooth_{t}": _scored_sql(O.bleu_score(t), O.bleu_score(t)) for t in range(8)},
    "bleu_ngram_sweep": _sweep_sql(
        "max_n", {n: O.bleu_score(0, range(1, n + 1)) for n in range(1, 5)}
    ),
    "bleu_weight_sweep": _sweep_sql(
        "setting", {i: O.bleu_score("weights", weights=w) for i, w in enumerate(WEIGHTS)}
    ),
    "bleu_smoothing_sweep": _sweep_sql("technique", {t: O.bleu_score(t) for t in S.TECHNIQUES}),
}
