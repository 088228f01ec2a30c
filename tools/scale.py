"""Throughput on replicated readings, even and skewed.

``python tools/scale.py COPIES`` repeats the derived readings under new meter ids COPIES times, and
a second time so that one meter holds a third of all rows. It times the reads plans on both; every meter
is cut into days, by one plan. Data goes to a new folder of the session's shared folder.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from meterlake import Params  # noqa: E402
from meterlake.checks.views import Views  # noqa: E402
from meterlake.plans import reads  # noqa: E402
from meterlake.session import scratch, session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def copies_of(readings: DataFrame, copies: int) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    rows = readings.withColumn("_copy", copy)
    return rows.withColumn("meter_id", F.concat("meter_id", F.lit("-"), "_copy")).drop("_copy")


def with_hot_meter(readings: DataFrame, copies: int) -> DataFrame:
    """Half as many rows again, all of one meter, spread over the month by the second copy number."""
    half = copies_of(readings, max(1, copies // 2))
    shift = F.expr("make_dt_interval(0, 0, 0, pmod(xxhash64(meter_id), 3600))")
    hot = half.withColumn("reading_datetime", F.col("reading_datetime") + shift)
    return copies_of(readings, copies).unionByName(hot.withColumn("meter_id", F.lit("hot")))


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 100
    spark = session(
        "scale", f"local[{CPUS}]", **{"spark.sql.shuffle.partitions": "64", "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    v = Views(spark, FOLDER)
    base = scratch(spark, "scale")
    copies_of(v.readings(), copies).write.parquet(f"{base}/even")
    with_hot_meter(v.readings(), copies).write.parquet(f"{base}/skewed")
    params = Params(as_of=dt.date(2024, 1, 20), slot_begin=dt.datetime(2024, 1, 1))
    master = (v.location(), v.device(), v.backfill_contract())
    for data in ("even", "skewed"):
        readings = spark.read.parquet(f"{base}/{data}")
        rows = readings.count()
        for plan in (reads.backfill_hourly, reads.backfill_daily):
            start = time.perf_counter()
            plan(readings, *master, params).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            print(
                json.dumps(
                    {
                        "data": data,
                        "rows": rows,
                        "plan": plan.__name__,
                        "seconds": round(took, 2),
                        "rows_per_second": int(rows / took),
                    }
                ),
                flush=True,
            )
    spark.stop()


if __name__ == "__main__":
    main()
