"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quaver.plans import catalog  # noqa: E402
from quaver.plans.adapters import notes  # noqa: E402
from quaver.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "bar_polyphony bar_primitive_features canonical_bars live_bars eligible_windows rhythmic_density pitch_entropy theil_sen_trend articulation overlap_pairs "
    "characterization lifecycle_crosstab dedupe_first_owner provenance_edges receipt_reconcile family_components cap_profile snapshot_windows "
    "inventory_classes inventory_compare inventory_coverage chunk_plan run_verification source_classification pedal_flattening next_fit_packs"
).split()


def main() -> None:
    spark = local_session("bench", cpus=CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()

    def timed(name: str) -> float:
        began = time.perf_counter()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    timed("bar_polyphony")  # starts executors' code generation and file caches
    seconds = {name: round(timed(name), 3) for name in HEADLINE}
    streams = notes(spark, SF_DIR).select("stream_id").distinct().count()
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "feature_streams_per_second": round(streams / seconds["bar_primitive_features"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
