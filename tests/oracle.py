"""Compare contract queries with their SQL: columns, types, and rows in any order."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Spark type → DuckDB types that hold the same values.
SAME = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "boolean": {"BOOLEAN"},
    "timestamp_ntz": {"TIMESTAMP"}, "date": {"DATE"},
}


def expected(sf_dir: str, sql: str) -> tuple[pd.DataFrame, dict[str, str]]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    rel = con.sql(sql)
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return rel.df(), types


def _shown(v) -> str:
    """A value as text; pandas turns whole numbers beside nulls into floats."""
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(float(v))
    return "" if v is None else str(v)


def _rows(df: pd.DataFrame) -> list[tuple]:
    out = df[sorted(df.columns)].astype(object)
    out = out.where(out.notna(), None)
    return sorted(tuple(map(_shown, r)) for r in out.itertuples(index=False, name=None))


def differences(spark, sf_dir: str, query, sql: str) -> list[str]:
    got = query(spark, sf_dir)
    want, want_types = expected(sf_dir, sql)
    problems = []
    got_types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    if set(got_types) != set(want_types):
        return [f"columns {sorted(got_types)} against {sorted(want_types)}"]
    for name, t in got_types.items():
        if want_types[name] not in SAME.get(t, {t.upper()}):
            problems.append(f"type of {name}: {t} against {want_types[name]}")
    have, need = _rows(got.toPandas()), _rows(want)
    if len(have) != len(need):
        problems.append(f"{len(have)} rows against {len(need)}")
    if have != need:
        odd = [(h, n) for h, n in zip(have, need) if h != n][:3]
        problems.append(f"rows differ, such as {odd}")
    return problems


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from contract import ORACLE, QUERIES
    from millrace.session import local_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    failed = 0
    for name in names:
        t0 = time.time()
        try:
            problems = differences(spark, sf_dir, QUERIES[name], ORACLE[name]) if name in ORACLE else (
                QUERIES[name](spark, sf_dir).count() and []
            )
        except Exception as err:
            problems = [f"{type(err).__name__}: {str(err)[:600]}"]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - t0:.1f}s", *problems, sep="\n     ", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
