"""Table sources: paths and names, renamed close columns."""

import datetime as dt

from tickspark.sources.tables import read_daily_close, read_table


def test_read_table_by_path_and_name(spark, tmp_shared):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 2), 5.0)], "sym string, d date, px double")
    path = f"{tmp_shared}/closes"
    df.write.parquet(path)
    assert read_table(spark, path).count() == 1
    df.createOrReplaceTempView("closes_by_name")
    assert read_table(spark, "closes_by_name").count() == 1


def test_read_daily_close_maps_columns(spark, tmp_shared):
    df = spark.createDataFrame([("A", "2024-01-02", "5")], "sym string, d string, px string")
    path = f"{tmp_shared}/closes_text"
    df.write.parquet(path)
    out = read_daily_close(spark, path, ric="sym", date="d", price="px")
    assert out.columns == ["RIC", "Date", "Price"]
    assert out.collect()[0] == ("A", dt.date(2024, 1, 2), 5.0)
