"""Command line: python tests/compare.py [folder] [query ...] -- compare and time the registered queries."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import harness  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tillmark.session import local_session  # noqa: E402


def main(folder: str, names: list[str]) -> None:
    spark = local_session()
    con = harness.connect(folder)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name not in sqls:
                verdict = f"no SQL, {query(spark, folder).count()} rows"
            else:
                verdict = harness.difference(query(spark, folder), con, sqls[name]) or "ok"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:32s} {time.time() - start:6.1f}s  {verdict}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001", sys.argv[2:])
