"""Run every registered query against DuckDB: python -m tests.check_queries [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback

from __spark_entry__ import oracle_sql, queries
from tests.oracle import compare, connect
from tests.session import local_session


def main(sf_dir: str, only: list[str]) -> int:
    spark, con = local_session(), connect(sf_dir)
    sql, bad = oracle_sql(), 0
    for name, run in queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            got = run(spark, sf_dir).toArrow()
            took = time.time() - began
            found = compare(got, con.execute(sql[name]).to_arrow_table()) if name in sql else []
        except Exception:
            took, found = time.time() - began, [traceback.format_exc()[-1500:]]
        bad += bool(found)  # without SQL only that it runs
        print(f"{'ok  ' if not found else 'FAIL'} {name:28s} {took:6.2f}s {got.num_rows if not found else ''} {found or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
