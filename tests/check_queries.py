"""Compare all or some registered queries with their SQL: check_queries.py [sf] [name ...]."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import importlib  # noqa: E402

from pedalmill.session import build_session  # noqa: E402
from tests.oracle_compare import compare, connect  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    if wanted and wanted[0].startswith("@"):
        from pedalmill.catalog import registry
        for m in wanted[0][1:].split(","):
            importlib.import_module(f"pedalmill.catalog.{m}")
        queries, oracles, wanted = registry.QUERIES, registry.ORACLES, wanted[1:]
    else:
        from pedalmill.catalog import ORACLES as oracles, QUERIES as queries
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, fn in queries.items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, name, fn, oracles[name], sf_dir)
            else:
                n = len(fn(spark, sf_dir).collect())
                problems = [] if n else ["no rows"]
        except Exception as e:  # report and go on
            problems = [type(e).__name__ + ": " + str(e)[:600]]
            if wanted:
                traceback.print_exc()
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:32s} {time.time() - t:5.2f}s "
              f"{'' if name in oracles else '(no sql)'} {'; '.join(problems)[:1500]}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
