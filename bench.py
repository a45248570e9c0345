"""Times the registered queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. All queries run once to warm
up and then ``BENCH_RUNS`` times; the best run of each counts. Results go to the ``noop`` sink, so all
rows and columns are produced and none is brought to the driver. ``--variants`` adds the forms
of the compact KPI query that were measured against the one in use.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

from pyspark.sql import functions as F

from tallyspan.operators import kpi
from tallyspan.operators.periods import resolve_anchor, rolling_periods
from tallyspan.plans.catalog import KPI_COLUMNS, QUERIES
from tallyspan.session import build_session
from tallyspan.sources.star import ads_from_lineitem

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))



def joined_bounds(spark, sf_dir):
    """Bounds joined in as a relation instead of literals; one scan for both windows."""
    ads_from_lineitem(spark, sf_dir, KPI_COLUMNS).createOrReplaceTempView("ads")
    return spark.sql(
        """
        SELECT sum(CASE WHEN date > date_sub(top, 30) THEN spend END) AS spend_now,
               sum(CASE WHEN date <= date_sub(top, 30) THEN spend END) AS spend_before,
               sum(CASE WHEN date > date_sub(top, 30) THEN conversions END) AS conversions_now,
               sum(CASE WHEN date <= date_sub(top, 30) THEN conversions END) AS conversions_before
        FROM ads CROSS JOIN (SELECT max(date) AS top FROM ads)
        WHERE date BETWEEN date_sub(top, 59) AND top
        """
    )


def two_scans(spark, sf_dir):
    """One literal-bounded scan per window."""
    ads = ads_from_lineitem(spark, sf_dir, KPI_COLUMNS)
    p = rolling_periods(resolve_anchor(ads))
    halves = [
        ads.filter(test).agg(
            F.sum("spend").alias(f"spend_{w}"), F.sum("conversions").alias(f"conversions_{w}")
        )
        for w, test in (("now", p.in_current()), ("before", p.in_prior()))
    ]
    return halves[0].crossJoin(halves[1])


def literal_bounds(spark, sf_dir):
    ads = ads_from_lineitem(spark, sf_dir, KPI_COLUMNS)
    return kpi.period_totals(ads, rolling_periods(resolve_anchor(ads)))


def known_anchor(spark, sf_dir):
    """The newest date is given, as it is for the stored table."""
    ads = ads_from_lineitem(spark, sf_dir, KPI_COLUMNS)
    return kpi.period_totals(ads, rolling_periods(dt.date(2001, 11, 4)))


VARIANTS = {f.__name__: f for f in (literal_bounds, known_anchor, joined_bounds, two_scans)}


def timed(spark, query) -> float:
    began = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = VARIANTS if "--variants" in sys.argv else QUERIES
    # Whole rounds, so that no query profits from running right after itself.
    rounds = [{name: timed(spark, q) for name, q in queries.items()} for _ in range(1 + RUNS)]
    seconds = {name: round(min(r[name] for r in rounds[1:]), 3) for name in queries}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
