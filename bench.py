"""Times the headline queries; prints one JSON line. BENCH_SF_DIR and BENCH_CPUS say where and on how many cores."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
sys.path.insert(0, ROOT)

from astroloom.plans import catalogue  # noqa: E402
from astroloom.session import build_session  # noqa: E402

HEADLINE = ["object_tile_bands", "band_counts", "band_combinations", "xmatch_nearest", "label_attach", "label_refresh", "tile_files", "pixel_stats", "survey_mean_std", "cutout_fast", "band_stacks", "stretches"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cores=int(cpus), partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = catalogue.queries(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):  # the first one compiles
            t = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        times[name] = round(statistics.median(runs), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
