"""Run queries against their SQL from the command line: check.py FOLDER [NAME ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fitloom.plans import ORACLES, QUERIES  # noqa: E402
from fitloom.session import local_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con = local_session("8"), connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                result = compare(df, con, ORACLES[name])
            else:
                rows = df.collect()
                result = "" if rows else "no rows"
                print("   ", name, len(rows), rows[:2])
        except Exception as e:  # keep going, report at the end
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(result)
        print(f"{'BAD' if result else 'ok '} {name} {time.time() - start:.2f}s {result[:900]}", flush=True)
    print(f"{len(names)} checked, {bad} bad, {sum(n in ORACLES for n in names)} with SQL")
