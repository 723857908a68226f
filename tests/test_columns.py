import duckdb
from pyspark.sql import functions as F

from tidemark.functions.columns import flag, is_bad_value, parse_value, status_label, surrogate_key


def test_parse_value_cases(spark):
    vals = [".", "3.7", "0", "-1.5", "42", "not_a_number", "1d", "1f", "1_000", " 2.5 ", "1e3", None]
    df = spark.createDataFrame([(v,) for v in vals], "raw string")
    rows = df.select("raw", parse_value("raw").alias("v"), is_bad_value("raw").alias("bad")).collect()
    got = {r.raw: (r.v, r.bad) for r in rows}
    assert got["."] == (None, False)
    assert got["3.7"] == (3.7, False)
    assert got["0"] == (0.0, False)
    assert got["-1.5"] == (-1.5, False)
    assert got["42"] == (42.0, False)
    assert got["1e3"] == (1000.0, False)
    assert got[" 2.5 "] == (2.5, False)
    # text a strict float parse rejects is bad, even where Spark's cast would accept it
    for bad in ("not_a_number", "1d", "1f", "1_000"):
        assert got[bad] == (None, True), bad
    assert got[None] == (None, True)   # an absent value is no missing marker: it fails its series


def test_surrogate_key_matches_duckdb_md5(spark):
    df = spark.createDataFrame([("UNRATE", "2024-01-01")], "s string, d string").select(
        "s", F.to_date("d").alias("d"))
    k = df.select(surrogate_key("s", "d").alias("k")).first().k
    ref = duckdb.sql("SELECT md5(concat_ws('-', 'UNRATE', CAST(DATE '2024-01-01' AS VARCHAR)))").fetchall()[0][0]
    assert k == ref


def test_flag_null_is_zero_and_status(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "x double")
    rows = df.select(flag(F.col("x") < 0).alias("f")).collect()
    assert [r.f for r in rows] == [0, 1, 0]
    s = spark.createDataFrame([(1,), (0,), (None,)], "f int").select(status_label("f").alias("s")).collect()
    assert [r.s for r in s] == ["Active", "Inactive", "No Data"]
