"""Scoring of triples, validation of judgements, agreement with human labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from versus.functions.tokens import trim_ws

from versus.functions import bleu as B
from versus.functions.metrics import meteor, preference
from versus.functions.ngrams import bag_hits, match_counts

LABELS = (-1, 0, 1)


def first_rows(df: DataFrame, n: int | None, by: str = "id") -> DataFrame:
    """The first ``n`` rows by id; all of them when ``n`` is None."""
    return df if n is None else df.orderBy(by).limit(n)


def overlap_counts(triples: DataFrame) -> DataFrame:
    """Matched words and lengths of both hypotheses."""
    ref = F.col("ref")
    return triples.select(
        *[c for c in triples.columns if c not in ("h1", "h2", "ref")],
        *[bag_hits(F.col(h), ref).alias(f"{h}_hits") for h in ("h1", "h2")],
        *[F.size(c).alias(f"{c}_len") for c in ("h1", "h2", "ref")],
    )


def judge_overlap(triples: DataFrame) -> DataFrame:
    """The hypothesis with more words found in the reference wins."""
    return overlap_counts(triples).withColumn(
        "pred", preference(F.col("h1_hits"), F.col("h2_hits"))
    )


def score_meteor(counts: DataFrame, alpha: Column | float = 0.1) -> DataFrame:
    """Add METEOR scores and the preference to the output of ``overlap_counts``."""
    scored = counts.withColumns(
        {
            f"{h}_score": meteor(F.col(f"{h}_hits"), F.col(f"{h}_len"), F.col("ref_len"), alpha)
            for h in ("h1", "h2")
        }
    )
    return scored.withColumn("pred", preference(F.col("h1_score"), F.col("h2_score")))


def judge_meteor(triples: DataFrame, alpha: float = 0.1) -> DataFrame:
    return score_meteor(overlap_counts(triples), alpha)


def bleu_counts(triples: DataFrame, max_n: int = 5) -> DataFrame:
    """Clipped matches up to ``max_n`` for both hypotheses, and the lengths."""
    return match_counts(triples, ["h1", "h2"], "ref", max_n).drop("h1", "h2", "ref")


def with_preference(scored: DataFrame) -> DataFrame:
    return scored.withColumn("pred", preference(F.col("h1_score"), F.col("h2_score")))


def score_bleu(counts: DataFrame, max_n: int = 4, start: int = 1) -> DataFrame:
    """Unsmoothed BLEU of both hypotheses and the preference."""
    return with_preference(
        counts.withColumns({f"{h}_score": B.bleu_orders(h, start, max_n) for h in ("h1", "h2")})
    )


def score_bleu_weighted(counts: DataFrame, weights: list[float], max_n: int = 4) -> DataFrame:
    return with_preference(
        counts.withColumns(
            {
                f"{h}_score": B.bleu_weighted(B.Precisions(h, max_n=max_n), list(weights))
                for h in ("h1", "h2")
            }
        )
    )


def score_bleu_smoothed(
    counts: DataFrame,
    smooth_h1: int = 4,
    smooth_h2: int = 1,
    epsilon: float = 0.1,
    alpha: float = 5.0,
    k: float = 5.0,
    max_n: int = 4,
) -> DataFrame:
    """Smoothed BLEU. The defaults smooth the two hypotheses differently."""
    modes = {"h1": smooth_h1, "h2": smooth_h2}
    return with_preference(
        counts.withColumns(
            {
                f"{h}_score": B.bleu_smoothed(B.Precisions(h, max_n=max_n), m, epsilon, alpha, k)
                for h, m in modes.items()
            }
        )
    )


def validate(predictions: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Split raw judgements into (valid rows with ``pred``, error rows with ``reason``)."""
    # As a generated column: a plain one would be put into the filter and the reason, and the
    # judgement behind it worked out anew for each mention.
    kept = [c for c in predictions.columns if c != "pred"]
    parsed = predictions.select(*kept, F.explode(F.array(trim_ws(F.col(raw)).try_cast("int"))).alias("pred"))
    ok = F.coalesce(F.col("pred").between(-1, 1), F.lit(False))
    errors = parsed.where(~ok).withColumn(
        "reason", F.when(F.col("pred").isNull(), "not an integer").otherwise("out of range")
    )
    return parsed.where(ok), errors.drop("pred")


def length_mismatch(inputs: DataFrame, predictions: DataFrame, on: str = "id") -> DataFrame:
    """One row: how many inputs lack a prediction and how many predictions lack an input.

    Rows are counted, not ids: a second prediction for one input is one too many. Both sides are tagged and grouped once instead of outer-joined.
    """
    tagged = inputs.select(on, F.lit(1).alias("i"), F.lit(0).alias("p")).unionAll(
        predictions.select(on, F.lit(0).alias("i"), F.lit(1).alias("p"))
    )
    per_id = tagged.groupBy(on).agg(F.sum("i").alias("i"), F.sum("p").alias("p"))
    return per_id.agg(
        F.sum("i").alias("n_inputs"),
        F.sum("p").alias("n_predictions"),
        F.coalesce(F.sum(F.greatest(F.col("i") - F.col("p"), F.lit(0))), F.lit(0)).alias("n_missing"),
        F.coalesce(F.sum(F.greatest(F.col("p") - F.col("i"), F.lit(0))), F.lit(0)).alias("n_extra"),
    )


def align(predictions: DataFrame, gold: DataFrame, on: str = "id") -> DataFrame:
    """Keep what both sides have, by key."""
    return predictions.join(gold, on)


def gold_pred_counts(predictions: DataFrame, gold: DataFrame, on: str = "id") -> DataFrame:
    """(gold, pred, cnt) over the aligned rows.

    Predictions are counted per key before the join, so that a key with very many rows
    crosses the network as at most four of them.
    """
    per_key = predictions.groupBy(on, "pred").agg(F.count(F.lit(1)).alias("cnt"))
    return align(per_key, gold, on).groupBy("gold", "pred").agg(F.sum("cnt").alias("cnt"))


def confusion(counts: DataFrame) -> DataFrame:
    """3 x 3 matrix from (gold, pred, cnt): one row per gold label, also for absent labels."""
    spark = counts.sparkSession
    zeros = spark.range(-1, 2, 1, 1).select(
        F.col("id").cast("int").alias("gold"),
        F.lit(0).alias("pred"),
        F.lit(0).cast("bigint").alias("cnt"),
    )
    names = {-1: "pred_neg", 0: "pred_zero", 1: "pred_pos"}
    both = counts.select("gold", "pred", "cnt").unionByName(zeros)
    return both.groupBy("gold").agg(
        *[
            F.sum(F.when(F.col("pred") == p, F.col("cnt")).otherwise(0)).alias(names[p])
            for p in LABELS
        ]
    )


def accuracy(counts: DataFrame) -> DataFrame:
    """Accuracy from (gold, pred, cnt). Rows without a judgement are counted, not scored."""
    judged = F.when(F.col("pred").isNotNull(), F.col("cnt")).otherwise(0)
    right = F.when(F.col("pred") == F.col("gold"), F.col("cnt")).otherwise(0)
    return counts.agg(
        F.sum(judged).alias("n_judged"),
        F.sum(right).alias("n_right"),
        F.sum(F.when(F.col("pred").isNull(), F.col("cnt")).otherwise(0)).alias("n_undefined"),
    ).withColumn("accuracy", F.try_divide(F.col("n_right"), F.col("n_judged")))


def classification_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F and support of each label from (gold, pred, cnt)."""
    cnt = F.when(F.col("pred").isNotNull(), F.col("cnt")).otherwise(0)
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("gold").alias("label"),
                    cnt.alias("support"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("gold") == F.col("pred"), F.col("cnt")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("pred").alias("label"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("cnt").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hit"),
                ),
            )
        )
    )
    total = sides.where("label IS NOT NULL").groupBy("label").agg(
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("hit").alias("hit"),
    )
    zero = F.lit(0.0)
    p = F.coalesce(F.try_divide(F.col("hit"), F.col("predicted")), zero)
    r = F.coalesce(F.try_divide(F.col("hit"), F.col("support")), zero)
    scored = total.select("label", p.alias("precision"), r.alias("recall"), "support")
    f = F.try_divide(
        F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
    )
    return scored.withColumn("f_score", F.coalesce(f, zero))
