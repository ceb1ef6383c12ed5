from sievework.plans import reports


def test_text_tables_are_bounded(spark):
    df = spark.range(30).selectExpr("id", "cast(id as double) / 2 as half").orderBy("id")
    text = reports.text_table(df, 3)
    assert text.split("\n") == ["id  half", "0   0", "1   0.5", "2   1", "…"]
    assert reports.report({"a": df.limit(1)}).startswith("a\nid  half")
