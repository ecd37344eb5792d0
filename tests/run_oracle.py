"""Check queries against their SQL twins: python tests/run_oracle.py [folder] [name prefix ...]."""

import sys
import time
import traceback

sys.path.insert(0, ".")

import millrace.plans  # noqa: E402,F401
from millrace.registry import QUERIES  # noqa: E402
from millrace.session import get_spark  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_spark("8")
    con = connect(folder)
    bad = 0
    for name, q in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if q.sql is None:
                rows = q(spark, folder).collect()
                note = f"rows only: {len(rows)}" + ("" if rows else " EMPTY")
                fail = not rows
            else:
                diff = compare(spark, con, name, folder)
                n = len(con.execute(q.sql).fetchall()) if diff is None else -1
                note, fail = (f"ok {n}" + (" EMPTY" if n == 0 else "") if diff is None else diff[:1500]), diff is not None or n == 0
        except Exception as e:  # noqa: BLE001
            note, fail = f"{type(e).__name__}: {str(e)[:1200]}", True
            if "-v" in wanted:
                traceback.print_exc()
        bad += fail
        took = time.time() - start
        if fail or took > 5 or len(wanted) > 0:
            print(f"{'FAIL' if fail else 'pass'} {name} {took:.2f}s {note}", flush=True)
    print(f"{len(QUERIES)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
