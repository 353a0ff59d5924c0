"""Run registered jobs beside their oracle SQL: python tests/oracle_check.py SF [key ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rookery.views import BASE_TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return ("f", "nan")
        return ("f", f"{value:.9g}")
    return (type(value).__name__, str(value))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    got_cols, got = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    odd = [str(d[1]) for d in result.description if "HUGEINT" in str(d[1]).upper() or "DECIMAL" in str(d[1]).upper()]
    want_cols, want = table(columns, result.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} / {want_cols}"
    if odd:
        return False, f"oracle types {odd}"
    if got != want:
        only_got = list(set(got) - set(want))[:2]
        only_want = list(set(want) - set(got))[:2]
        return False, f"rows {len(got)} / {len(want)}; spark only {str(only_got)[:700]}; oracle only {str(only_want)[:700]}"
    return True, f"{len(got)} rows"


def main(argv: list[str]) -> int:
    from tests.conftest import build_session
    import __spark_entry__ as contract

    sf_dir = f"/root/testdata/sf{argv[0]}"
    wanted = argv[1:]
    spark = build_session()
    con = connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = 0
    for key, run in queries.items():
        if wanted and not any(key == w or (w.endswith("*") and key.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if key in oracles:
                ok, note = compare(df, con, oracles[key])
            else:
                ok, note = True, f"{len(df.collect())} rows, no oracle"
        except Exception as problem:  # noqa: BLE001
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:900]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {key} {time.time() - start:.1f}s {note}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
