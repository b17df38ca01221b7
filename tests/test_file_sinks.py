"""Results that file sinks take whole, under the caller's own settings."""

import pyarrow.dataset as ds
import pytest

from __spark_entry__ import queries


@pytest.mark.parametrize("kind", ["parquet", "orc", "json"])
def test_dates_as_landed_and_as_parsed_are_written(spark, sf_small, tmp_path, kind):
    was = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        df = queries()["parse_text_date"](spark, sf_small)
        assert df.sparkSession.conf.get("spark.sql.shuffle.partitions") == "5"   # the caller's settings hold
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    df.write.format(kind).save(f"{tmp_path}/out")
    assert spark.conf.get("spark.sql.caseSensitive") == was
    if kind == "parquet":
        got = ds.dataset(f"{tmp_path}/out").to_table()
        assert got.column_names == ["SALE_ID", "SALE_DATE", "sale_date", "date_key"]
        assert got.num_rows == df.count() > 0
