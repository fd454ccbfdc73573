"""Run registered queries against their SQL oracle: python tests/run_oracle.py [sf_dir] [name ...]."""

from __future__ import annotations

import sys
import time
import traceback

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from harness import compare, duck  # noqa: E402

from riskflow.plans.catalog import load_all  # noqa: E402
from riskflow.session import local_session  # noqa: E402


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    reg = load_all()
    spark = local_session()
    con = duck(sf)
    bad = []
    for name, q in reg.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = q.fn(spark, sf)
            if q.sql is None:
                n = df.count()
                print(f"R  {name:28s} rows={n} {time.time() - t:.1f}s", flush=True)
                continue
            n = compare(df, q.sql, con)
            print(f"OK {name:28s} rows={n} {time.time() - t:.1f}s", flush=True)
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL {name}: {str(e)[:1500]}", flush=True)
            if "-v" in names:
                traceback.print_exc()
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
