"""Time the headline queries; prints one JSON line.

One warm-up, then the median of BENCH_RUNS runs (default 3) of a full evaluation that
writes nowhere. After a warm-up over 8 seconds there is one run only; the stream runs once. BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from eventloom.session import get_spark
from eventloom.plans.catalog import QUERIES

HEADLINE = [
    "envelope_ingest", "event_log_documents", "pattern_extraction", "message_record", "line_rfc5424",
    "line_juniper", "line_custom", "event_build", "rule_match", "rule_capture_parms", "node_lookup",
    "node_enrich", "hardware_lookup", "mask_match", "mask_match_literal", "definition_lookup",
    "template_expand", "event_expand", "event_rows", "prefix_routing", "subscription_state",
    "source_batches", "connection_cap", "receipts", "ingest_metrics", "document_redaction", "alarm_reduction",
]
STREAMS = ["stream_flow"]
SLOW = 8.0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE + STREAMS
    spark = get_spark("eventloom-bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        taken, left = [], 1 if name in STREAMS else runs + 1
        while left:
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            left -= 1
            if len(taken) == 1 and taken[0] > SLOW:
                left = min(left, 1)
        taken = taken[1:] or taken
        seconds[name] = round(statistics.median(taken), 3)
    events = spark.read.parquet(f"{sf}/events.parquet").count()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")), "cpus": int(cpus), "events": events,
        "events_per_sec": {n: round(events / s) for n, s in seconds.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
