"""A contract reads its text once a row, however many of its rules look into it."""

from pyspark.sql import functions as F

from clipsieve.functions import text
from clipsieve.operators import annotation


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_contract_parses_once(spark):
    d = spark.range(3).withColumn("raw", F.concat(F.lit("{"), F.col("id").cast("string")))
    for made in (annotation.response_errors, annotation.first_violation):
        df = d.select(made(F.col("raw"), F.lit(10.0)).alias("e"))
        spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
        plan = _plan(df)
        spark.conf.unset("spark.sql.debug.maxToStringFields")
        assert plan.count("from_json(") + plan.count("jsontostructs(") <= 2 and plan.count("variantexpressionevalutils") + plan.count("parse_json(") <= 2, plan[:2000]
        assert [list(r.e) if isinstance(r.e, list) else r.e for r in df.collect()] == [["not_object"] if made is annotation.response_errors else "not_object"] * 3


def test_forbidden_wording_is_named_in_order(spark):
    rows = ["A red house.", "The Camera pans over people", "a pandemic", "", "gamers at a game", "man-made crowd"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(rows)] + [(9, None)], "i int, t string")
    got = {r.i: r.w for r in d.select("i", text.forbidden_wording(F.col("t")).alias("w")).collect()}
    assert {i: got[i] for i in range(6)} == {0: [], 1: ["person_people", "camera", "pan"], 2: [], 3: [], 4: ["game"], 5: ["person_people", "crowd"]} and got[9] == []
