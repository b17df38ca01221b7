"""Benchmark: full star build, then the headline answers over the written star.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf": ...}.
``value`` is the sum of all timed steps (star build + every answer).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from confluo.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="confluo-bench",
                        extra={"spark.driver.memory": "16g"})

    from confluo.plans import answers as A
    from confluo.plans import legacy as raw
    from confluo.plans.governed import governed
    from confluo.plans.star import Conformer, read_star, write_star
    from confluo.sources.binding import Landed

    scratch = tempfile.mkdtemp(prefix="confluo-bench-", dir="/tmp")
    L = Landed(spark, sf_dir)
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    # 1. conform the landed systems and write the star (facts partitioned by month)
    built = Conformer(L).star()
    timed("star_build", lambda: write_star(built, f"{scratch}/star"))
    star = read_star(spark, f"{scratch}/star")
    R = governed()

    answers = {
        "revenue_by_channel": lambda: A.revenue_by_channel(star, R),
        "revenue_by_source": lambda: A.revenue_by_source(star, R),
        "company_sales_total": lambda: A.company_sales_total(star, R),
        "stockout_rate": lambda: A.stockout_rate(star, R),
        "tickets_per_1k": lambda: A.tickets_per_1k(star, R),
        "parts_attach": lambda: A.parts_attach(star, R),
        "a_class_at_risk": lambda: A.a_class_at_risk(star),
        "sell_through_by_network": lambda: A.sell_through_by_network(star, R),
        "sales_on_day": lambda: A.sales_on_day(star, R, L),
        "revenue_since_event": lambda: A.revenue_since_event(star, R),
        "attributable_share": lambda: A.attributable_share(star, R),
        "after_sale_rate": lambda: A.after_sale_rate(star, R),
        "overstocked_products": lambda: A.overstocked_products(star, R),
        "drill_across": lambda: A.drill_across(star, R),
        "top_products": lambda: raw.top_products(L, A.P.top_n),
        "net_by_month": lambda: raw.net_by_month(L),
        "unmapped_gross": lambda: raw.unmapped_gross(L),
    }
    for name, fn in answers.items():
        timed(name, lambda fn=fn: fn().collect())
    # resolution and join keys, whole results
    from confluo.registry import QUERIES
    for name in ("resolve_text", "resolve_listing", "resolve_description", "star_join", "raw_star_join"):
        timed(name, lambda name=name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "star_build_plus_answers_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
