"""Compares registered queries with their oracles: ``python tests/run_oracle.py SF_DIR [name ...]``."""

import os
import sys
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


def main() -> int:
    import importlib

    from oracle import compare, connect
    from perigee.plans import MODULES, registry
    from perigee.session import get_session

    sf, names = sys.argv[1], sys.argv[2:]
    for m in MODULES:
        if (ROOT / "perigee" / "plans" / f"{m}.py").exists():
            importlib.import_module(f"perigee.plans.{m}")
    spark = get_session(
        "oracle", os.environ.get("ORACLE_MASTER", "local[8]"),
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name in names or registry.QUERIES:
        start = time.time()
        try:
            df = registry.QUERIES[name](spark, sf)
            if name in registry.ORACLES:
                problems = compare(df, con, registry.ORACLES[name])
                status = "ok" if not problems else "DIFF"
            else:
                problems, status = [], f"rows={len(df.collect())}"
        except Exception as exc:
            problems, status = [f"{type(exc).__name__}: {str(exc)[:1500]}"], "ERROR"
            if "-v" in sys.argv:
                traceback.print_exc()
        failed += bool(problems)
        print(f"{name:26s} {status:10s} {time.time() - start:6.2f}s", flush=True)
        for p in problems:
            print("   ", p[:1500], flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
