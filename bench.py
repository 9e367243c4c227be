"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the cores. Every query runs in full: all
rows and columns are produced and dropped by the noop sink.
"""

import json
import os
import time
from pathlib import Path

from noteloom.plans.queries import QUERIES
from noteloom.session import local_session

HEADLINE = (
    "cohort_latest_opd_notes",
    "cohort_day_slice",
    "cohort_rolling_window",
    "dedup_latest",
    "topn_latest",
    "note_batches",
    "batch_prompts",
    "batch_prompts_billing",
    "repair_records",
    "unwrap_records",
    "normalize_merge",
    "fix_count",
    "batch_report",
    "cue_fields",
    "opd_score",
    "validate_records",
    "field_summary",
    "icd10_agreement_counts",
    "clean_records",
    "merge_by_row",
    "quality_metrics",
    "end_to_end_results",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    run("opd_score")  # starts the JVM's and the workers' machinery
    run("validate_records")
    timings = {name: round(run(name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
