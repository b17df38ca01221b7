"""Incremental conformance: two landed batches stream into the same rows the
batch conformance produces."""

import uuid

from pyspark.sql import functions as F

from confluo.plans.star import Conformer
from confluo.session import ensure_checkpoint_dir
from confluo.sources.binding import Landed
from confluo.sources.landing import write_csv
from confluo.streaming import retailer_sales_stream, start_append
from tests.compare import _rows


def test_stream_matches_batch(spark, sf_small):
    c = Conformer(Landed(spark, sf_small))
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex[:8]}"
    sales = c.landed.rt_sales
    early = F.substring("SALE_DATE", 7, 4) < "1998"
    write_csv(sales.where(early), f"{base}/landing/part1")
    write_csv(sales.where(~early), f"{base}/landing/part2")
    q = start_append(retailer_sales_stream(c, f"{base}/landing/*"), f"{base}/out", f"{base}/ckpt")
    q.awaitTermination(300)
    got = spark.read.parquet(f"{base}/out").drop("month_key")
    want = c.fact_sales.where(F.col("source") == c.cfg.source_retailer)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == \
        _rows(want.columns, [tuple(r) for r in want.select(*got.columns).collect()])
