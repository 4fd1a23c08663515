"""Compare a Spark result with DuckDB's, row by row and type by type."""

from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(df, sql, con):
    got = df.toArrow()
    want = con.execute(sql).to_arrow_table()
    problems = []
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} vs {sorted(want.column_names)}"]
    names = sorted(got.column_names)
    for n in names:
        a, b = str(got.schema.field(n).type), str(want.schema.field(n).type)
        if a != b:
            problems.append(f"type of {n}: {a} vs {b}")
    rows_a = Counter(zip(*[got[n].to_pylist() for n in names]))
    rows_b = Counter(zip(*[want[n].to_pylist() for n in names]))
    if rows_a != rows_b:
        only_a, only_b = rows_a - rows_b, rows_b - rows_a
        problems.append(
            f"rows {sum(rows_a.values())} vs {sum(rows_b.values())}; "
            f"{sum(only_a.values())} only here e.g. {list(only_a)[:2]}; "
            f"{sum(only_b.values())} only there e.g. {list(only_b)[:2]}"
        )
    if not rows_a:
        problems.append("no rows")
    return problems
