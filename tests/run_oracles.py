"""Run registered queries against their oracles: python tests/run_oracles.py [sf_dir] [name ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import compare, connect

from logloom.plans import registry
from logloom.session import local_session

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, run in registry.QUERIES.items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            if name in registry.ORACLES:
                result = compare(spark, con, run, registry.ORACLES[name], sf_dir)
            else:
                result = None if run(spark, sf_dir).count() else "no rows"
        except Exception as exc:  # keep going, report all
            result = "".join(traceback.format_exception_only(exc))[:900]
        bad += result is not None
        print(f"{'ok ' if result is None else 'BAD'} {name} {time.time() - start:.2f}s {result or ''}", flush=True)
    print("failures:", bad)
