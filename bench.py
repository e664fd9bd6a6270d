"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads.  Every query first runs on the next
smaller tables, if they are there, which compiles its code and shows its growth; the time on the named
tables is what counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from geonet.queries import registry  # noqa: E402
from geonet.session import clear_scratch, local_session  # noqa: E402

HEADLINE = ["classify_coverage", "best_match", "spatial_grid_join", "nearest_on_each_line", "crossings", "coverage_cells",
            "cover_intersect", "road_outline", "union_area", "clip_lines", "network_distance", "connected_components", "color_edges",
            "merge_intervals", "tile_features", "merge_runs", "merge_lines", "simplify_lines", "dissolve_lines", "changed_file_sync",
            "oneway_status", "parking_coverage"]
#: Timed on the smaller tables only.
SMALL_ONLY = ["seating_distance"]
SMALLER = {"sf0.1": "sf0.01", "sf0.01": "sf0.001"}


def timed(spark, fn, sf_dir: str) -> float:
    start = time.time()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spent = round(time.time() - start, 3)
    clear_scratch(spark)
    return spent


def main() -> None:
    sf_dir = Path(os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, scratch=tempfile.mkdtemp(prefix="geonet-bench-"))
    found = registry()
    less = sf_dir.parent / SMALLER.get(sf_dir.name, "-")
    small, times = {}, {}
    for name in names + [n for n in SMALL_ONLY if not sys.argv[1:]]:
        if less.is_dir():
            small[name] = timed(spark, found[name][0], str(less))
        if name not in SMALL_ONLY:
            times[name] = timed(spark, found[name][0], str(sf_dir))
        print(name, small.get(name), times.get(name), file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": sf_dir.name.removeprefix("sf"), "small": {"sf": less.name.removeprefix("sf"), "queries": small}}))
    spark.stop()


if __name__ == "__main__":
    main()
