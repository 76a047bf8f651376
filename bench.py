"""Benchmark: the pipeline's flows and the analysis questions at one scale.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8).  Prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Flows (each timed once, each writes its table):
  land     monthly folders -> lake partitioned by period (observing the null profile)
  labels   label lines -> five lookups
  profile  drop decision from the observed profile + profiled write
  stage    profiled -> staging write (aggregate + five broadcast joins)
  star     staging -> fact + six dimensions
  quality  every declared check over staging and star
  run_all  the same and all reconciliation in one call, into another root
  increment  one new month loaded onto that history by the stream, star refreshed
Questions (median of 3 warm runs each) over the written star: q1..q6, q3_top_state.
``value`` is the sum of all but run_all, which repeats the flows.  The input
folders themselves (derived from the test tables) are prepared first and not timed.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from landfall.operators import quality  # noqa: E402
from landfall.operators.profile import profile_extract  # noqa: E402
from landfall.operators.staging import build_staging  # noqa: E402
from landfall.plans import analysis, catalog  # noqa: E402
from landfall.plans.catalog import Q4_EXCLUDE, YEAR  # noqa: E402
from landfall.plans.flows import clean_labels, rebuild_star, run_all  # noqa: E402
from landfall.schemas import PERIOD_COLUMN  # noqa: E402
from landfall.session import build_session, shared_dir  # noqa: E402
from landfall.sources import fixtures  # noqa: E402
from landfall.sources.landing import land_extracts  # noqa: E402
from landfall.sources.warehouse import YEAR_PARTITION, Warehouse  # noqa: E402
from landfall.streaming.incremental import IncrementalLoader  # noqa: E402


def timed(fn):
    t = time.perf_counter()
    out = fn()
    took = time.perf_counter() - t
    print(f"bench: step took {took:.2f} s", file=sys.stderr, flush=True)
    return out, took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    conf = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage and task times for later reading, in a folder the caller names
        conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(f"local[{cpus}]", app_name="landfall-bench", shuffle_partitions=cpus * 2, conf=conf)
    root = shared_dir(spark)
    wh = Warehouse(spark, os.path.join(root, "warehouse"))
    times: dict[str, float] = {}

    # untimed: the monthly input folders and the label lines, from the test tables
    inbox, labels = catalog.inbox(spark, sf_dir), catalog.label_files(spark, sf_dir)
    lines = fixtures.label_lines(spark, sf_dir)

    # the landing write also observes the null profile (no separate profile scan)
    (lake, counts), times["land"] = timed(lambda: land_extracts(spark, inbox, wh.path("lake_i94"),
                                                                with_profile=True))
    lookups, times["labels"] = timed(lambda: clean_labels(spark, lines, wh))

    def profile():
        prof = profile_extract(lake, counts=counts)
        prof.df.write.mode("overwrite").partitionBy(PERIOD_COLUMN).parquet(wh.path("profiled"))
        return spark.read.parquet(wh.path("profiled"))
    profiled, times["profile"] = timed(profile)

    staging, times["stage"] = timed(lambda: wh.write_staging(build_staging(profiled, lookups)))
    star_tables, times["star"] = timed(lambda: rebuild_star(wh))

    def checks():
        tables = {"immigration_stage": staging.drop(PERIOD_COLUMN, YEAR_PARTITION)}
        tables.update({n: (d.drop(YEAR_PARTITION) if n == "immigration" else d)
                       for n, d in star_tables.tables().items()})
        return quality.star_suite(tables).collect()
    _, times["quality"] = timed(checks)
    _, run_all_time = timed(lambda: run_all(spark, inbox, labels, os.path.join(root, "run")))

    # one new month onto the history that the stream has loaded before
    history, drop = Warehouse(spark, os.path.join(root, "history")), os.path.join(root, "stream-inbox")
    raw, new = spark.read.parquet(inbox), F.col(PERIOD_COLUMN) == "jun96"
    loader = IncrementalLoader(spark, drop, history, lookups.materialize(spark, history.path("lookups")), refresh_star=True)
    raw.where(~new).write.partitionBy(PERIOD_COLUMN).parquet(drop)
    loader.run()
    raw.where(new).write.mode("append").partitionBy(PERIOD_COLUMN).parquet(drop)
    _, times["increment"] = timed(loader.run)

    s = wh.read_star()
    questions = {
        "q1": lambda: analysis.top_visa_types(s, YEAR),
        "q2": lambda: analysis.top_visa_categories(s, YEAR, gender="F"),
        "q3": lambda: analysis.state_totals_by_visa(s, YEAR),
        "q3_top_state": lambda: analysis.top_state_per_visa(s, YEAR),
        "q4": lambda: analysis.top_countries(s, YEAR, gender="F", exclude=Q4_EXCLUDE),
        "q5": lambda: analysis.top_mode_except(s, YEAR, exclude="Air"),
        "q6": lambda: analysis.top_ports(s, YEAR),
    }
    for name, build in questions.items():
        runs = []
        for _ in range(3):
            _, t = timed(lambda: build().collect())
            runs.append(t)
        times[name] = statistics.median(runs)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "pipeline_and_questions_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in (times | {"run_all": run_all_time}).items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
