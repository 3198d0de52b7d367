"""Time the headline queries; prints one JSON line.

Each query is forced by a no-op write of its whole result. A short warm-up on another query
starts the JVM and the Python workers first, so the numbers are not dominated by start-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tapeline.catalog import queries  # noqa: E402
from tapeline.session import spark_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "actionable_list",
    "moving_averages",
    "smoothed_candles",
    "parabolic_sar",
    "ema_trend",
    "price_lookback",
    "priority_revenue",
    "latest_line_per_part",
    "rank_over_all_orders",
    "orphan_lines",
    "insert_if_absent",
    "load_quotes",
    "load_finance",
    "index_direction",
    "stability_ranking_on_candles",
    "intraday_bars",
    "features_of_price_slope",
    "features_of_range_position",
    "market_indicators",
    "decay_votes",
    "revenue_monthly",
    "stream_deduplicated_ticks",
]

#: Timed too, but not part of the total, so that it stays comparable from round to round.
MORE = ["training_set", "conversion_long_report", "parabolic_sar_two_settings", "bars_within_spans", "lag_by_any_offset", "stream_sar"]


def main() -> None:
    spark = spark_session(
        "tapeline-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names, more = sys.argv[1:] or HEADLINE, [] if sys.argv[1:] else MORE
    registered = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("smoothed_candles")
    times = {name: round(run(name), 3) for name in names}
    others = {name: round(run(name), 3) for name in more}
    total = {"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times}
    print(json.dumps(total | {"more": others, "sf": os.path.basename(SF_DIR.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
