"""Sketch tests by rank error, never by exact value; bounds predicate."""

import pytest
from pyspark.sql import functions as F

from tripmart.operators import outliers


def _values(spark, values, metric="duration_seconds", month="2023-01"):
    return spark.createDataFrame([(month, float(v)) for v in values], f"source_month string, {metric} double")


def _quantile(sketch_df, metric, q):
    sk = F.col(f"{metric}_sketch")
    return sketch_df.select(F.call_function("kll_sketch_get_quantile_float", sk, F.lit(q))).first()[0]


def test_median_and_tails(spark):
    small = outliers.month_sketches(_values(spark, range(1, 100)).withColumn("distance_millimiles", F.lit(1.0)))
    assert 45 <= _quantile(small, "duration_seconds", 0.5) <= 55
    big = outliers.month_sketches(_values(spark, range(1, 1000)).withColumn("distance_millimiles", F.lit(1.0)))
    assert 0 <= _quantile(big, "duration_seconds", 0.001) <= 10
    assert 990 <= _quantile(big, "duration_seconds", 0.999) <= 1000


def test_merge_keeps_all_items(spark):
    a = _values(spark, [1, 2, 3], month="2023-01")
    b = _values(spark, [4, 5, 6], month="2023-02")
    sk = outliers.month_sketches(a.unionByName(b).withColumn("distance_millimiles", F.lit(1.0)))
    merged = outliers.merge_sketches(sk)
    b = outliers.sketch_bounds(merged).first()
    assert b.duration_seconds_n == 6
    assert 3 <= _quantile(merged, "duration_seconds", 0.5) <= 4


def test_sketch_round_trip_through_parquet(spark, tmp_path):
    sk = outliers.month_sketches(_values(spark, range(1, 501)).withColumn("distance_millimiles", F.lit(1.0)))
    sk.write.parquet(str(tmp_path / "sk"))
    back = spark.read.parquet(str(tmp_path / "sk"))
    assert back.select(F.call_function("kll_sketch_get_n_float", F.col("duration_seconds_sketch"))).first()[0] == 500


@pytest.mark.parametrize("value, outlier", [(5, True), (150, True), (10, False), (50, False), (100, False)])
def test_bounds_predicate_strict(spark, value, outlier):
    df = spark.createDataFrame([(value, 500, 10, 100, 1, 1000)],
                               "duration_seconds long, distance_millimiles long, duration_seconds_low long, "
                               "duration_seconds_high long, distance_millimiles_low long, distance_millimiles_high long")
    assert df.select(outliers.outlier_flag()).first()[0] is outlier


def test_null_bounds_mean_no_test(spark):
    df = spark.createDataFrame([(5, 5, None, None, None, None)],
                               "duration_seconds long, distance_millimiles long, duration_seconds_low long, "
                               "duration_seconds_high long, distance_millimiles_low long, distance_millimiles_high long")
    assert df.select(outliers.outlier_flag()).first()[0] is False


def test_exact_bounds_gate_and_values(spark):
    rows = [("2023-01", d, d * 10) for d in range(1, 1001)]
    df = spark.createDataFrame(rows, "source_month string, duration_seconds long, distance_millimiles long")
    b = outliers.exact_bounds(df).first()
    assert (b.duration_seconds_low, b.duration_seconds_high) == (1, 999)
    few = outliers.exact_bounds(df.limit(50)).first()
    assert (few.duration_seconds_low, few.duration_seconds_high) == (1, 50)  # a small month has bounds too


def test_kll_rank_error_against_exact(spark):
    """The sketch's quantile sits within its rank error of the exact one."""
    rows = [("2023-01", (i * 7919) % 5000 + 1, 1) for i in range(20000)]
    df = spark.createDataFrame(rows, "source_month string, duration_seconds long, distance_millimiles long")
    approx = outliers.kll_bounds(df).first().duration_seconds_high
    exact = outliers.exact_bounds(df).first().duration_seconds_high
    assert abs(approx - exact) <= 0.01 * 5000
