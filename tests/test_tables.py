import pytest
from pyspark.sql import functions as F

from versus.operators.embed import merge_vectors
from versus.sources.tables import VECTOR_SCHEMA, load_bucketed, save_bucketed


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_vectors_merge_without_a_shuffle(spark, tmp_path, shuffled_joins):
    first = spark.range(200).select("id", F.array(F.col("id") * 1.0, F.lit(0.5)).alias("features"))
    second = spark.range(50, 260).select("id", F.array(F.col("id") * 2.0).alias("features"))
    want = sorted(map(tuple, merge_vectors(first, second).collect()))
    assert "Exchange" in _plan(merge_vectors(first, second))
    a = save_bucketed(first, str(tmp_path / "a"), "merge_a", ["id"], 3)
    b = save_bucketed(second, str(tmp_path / "b"), "merge_b", ["id"], 3)
    merged = merge_vectors(a, b)
    assert "Exchange" not in _plan(merged)
    assert sorted(map(tuple, merged.collect())) == want
    # the name goes, the stored files stay and are named again
    spark.sql("DROP TABLE merge_a")
    again = load_bucketed(spark, str(tmp_path / "a"), "merge_again", VECTOR_SCHEMA, ["id"], 3)
    merged = merge_vectors(again, b)
    assert "Exchange" not in _plan(merged)
    assert sorted(map(tuple, merged.collect())) == want
    for name in ("merge_b", "merge_again"):
        spark.sql(f"DROP TABLE {name}")


def test_bucketed_frequencies_are_not_shuffled(spark, tmp_path, shuffled_joins):
    freq = spark.range(300).select(
        (F.col("id") % 4 + 1).cast("int").alias("n"), F.concat(F.lit("g"), "id").alias("gram"), F.col("id").alias("cnt")
    )
    stored = save_bucketed(freq, str(tmp_path / "f"), "freq_f", ["n", "gram"], 4)
    grams = freq.select("n", "gram").unionByName(freq.select("n", F.concat("gram", F.lit("x")).alias("gram")))
    found = grams.join(stored, ["n", "gram"])
    assert _plan(found).count("Exchange hashpartitioning") == 1  # the grams' side alone
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, freq.collect()))
    assert save_bucketed(freq.limit(0), str(tmp_path / "e"), "freq_e", ["n", "gram"], 4).collect() == []
    for name in ("freq_f", "freq_e"):
        spark.sql(f"DROP TABLE {name}")
