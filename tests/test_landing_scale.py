"""Landing at size: tables land at the same time."""

import threading
from pathlib import Path

import pytest

from confluo import registry
from confluo.sources.landing import EXPECTED_TYPES, read_csv, read_landed, write_csv


def test_tables_land_at_the_same_time(spark, sf_small, tmp_path, monkeypatch):
    both = threading.Barrier(2, timeout=30)

    def write(df, path):
        both.wait()   # one after the other would break it
        df.write.option("header", True).csv(path)
        return path

    monkeypatch.setattr(registry, "write_csv", write)
    landed = registry._landed(registry.Landed(spark, sf_small), str(tmp_path), ("locations", "rt_stores"))
    assert {n: df.count() for n, df in landed.items()} == {"locations": 15, "rt_stores": 10}


def _bytes(path) -> int:
    return sum(p.stat().st_size for p in Path(path).iterdir() if p.name.startswith("part-"))


@pytest.mark.parametrize("table", ["erp_inventory", "erp_sales_lines"])
def test_landed_text_takes_a_fraction_of_its_size(spark, sf_small, tmp_path, table):
    df = registry.Landed(spark, sf_small).table(table).cache()
    write_csv(df, f"{tmp_path}/landed")
    df.write.option("header", True).csv(f"{tmp_path}/plain")
    assert _bytes(f"{tmp_path}/landed") * 2 < _bytes(f"{tmp_path}/plain")
    assert read_landed(spark, f"{tmp_path}/landed").columns == df.columns
    assert read_csv(spark, f"{tmp_path}/landed", df.schema).exceptAll(df).count() == 0
    assert read_csv(spark, f"{tmp_path}/landed", df.schema).count() == df.count()
    assert set(EXPECTED_TYPES[table]) <= set(df.columns)


def test_odd_values_land_and_come_back(spark, tmp_path):
    rows = [("", None, "\\N"), ("a", "x,y", 'say "hi"'), (None, "", "\u00e9")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    write_csv(df, f"{tmp_path}/odd")
    back = {tuple(r) for r in read_landed(spark, f"{tmp_path}/odd").collect()}
    assert back == {("", None, None), ("a", "x,y", 'say "hi"'), (None, "", "\u00e9")}   # the null mark itself reads as null
