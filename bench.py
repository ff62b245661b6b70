"""Headline timings: near-dup removal (D3), scoring (M2+M9), ranking (T1),
report aggregates (A4/A5) and the relational load (S10/S11).

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
and prints one JSON line.  Each query's complete result, all columns, goes to Spark's
``noop`` sink, so no column is pruned away.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hirelens.plans import catalog as C  # noqa: E402
from hirelens.session import build_session, checkpoint_dir, ship_package  # noqa: E402

HEADLINE = {
    "d3_dedup_near": C.q_d3_dedup_near,
    "m2_text_cosine": C.q_m2_text_cosine,
    "m9_score_full": C.q_m9_score_full,
    "t1_rank": C.q_t1_rank,
    "a4_histogram": C.q_a4_histogram,
    "a5_skill_frequency": C.q_a5_skill_frequency,
    "s10_skills_dim": C.q_s10_skills_dim,
    "s11_job_skills": C.q_s11_job_skills,
    "flagship_doc_top20": C.q_flagship,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    checkpoint_dir(spark, tempfile.mkdtemp(prefix="hirelens-bench-"))
    ship_package(spark)
    times = {}
    for name, fn in HEADLINE.items():
        t0 = time.time()
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
