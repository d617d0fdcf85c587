"""Compare registered queries with their SQL on one folder of test tables."""

from __future__ import annotations

import math

import duckdb

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')")
    return con


def expected(con, sql: str):
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    return names, result.fetchall()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(value):
        if value is None:
            return "null"
        if isinstance(value, bool):
            return str(value)
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value)
        return str(value)

    return [names[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None where both sides agree, a short description of the first differences otherwise."""
    got_names, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want_names, want = canonical(*expected(con, sql))
    if got_names != want_names:
        return f"columns differ: {set(got_names) ^ set(want_names)}"
    if got == want:
        return None
    only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    lines = [f"{len(got)} rows against {len(want)}; {len(only_got)} / {len(only_want)} without a partner"]
    if only_got and only_want:
        first, second = only_got[0], only_want[0]
        lines += [f"{n}: {a} != {b}" for n, a, b in zip(got_names, first, second) if a != b]
    else:
        lines += [str(dict(zip(got_names, r))) for r in (only_got or only_want or got)[:2]]
    return "\n".join(lines)
