"""Single-node reference timing: the oracle SQL of every registered query run
by DuckDB (the reference's engine) on the same parquet tables. One warm-up,
median of N timed runs (results fully materialised). Prints one JSON line.

usage: python tools/duck_baseline.py [sf_dir] [threads] [repeats]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.check_oracle import TABLES  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    repeats = int(sys.argv[3]) if len(sys.argv) > 3 else 3
    from ampere.plans.catalog import ORACLE

    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")

    def run(sql: str) -> float:
        t0 = time.perf_counter()
        con.execute(sql).to_arrow_table()
        return time.perf_counter() - t0

    times = {}
    for name, sql in ORACLE.items():
        run(sql)
        times[name] = round(statistics.median(run(sql) for _ in range(repeats)), 4)
    print(json.dumps({"engine": "duckdb", "threads": threads, "sf_dir": sf, "value": round(sum(times.values()), 3), "queries": times}))


if __name__ == "__main__":
    main()
