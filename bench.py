"""Wall time of the headline queries. Prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from siteledger.plans.registered import QUERIES
from siteledger.session import local_session

#: All queries of the library itself, the crawls last.
HEADLINE = sorted(QUERIES, key=lambda name: (name.startswith(("crawl", "site_map")), name))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(
        cores, "bench", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")}
    )
    QUERIES["site_links"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
