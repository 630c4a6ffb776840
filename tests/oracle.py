"""Run queries next to their SQL in DuckDB and compare the rows.

    python tests/oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(r[i] for i in order) for r in result.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def compare(df, con, sql: str) -> str:
    """Empty if equal, else the first differences."""
    names, got = spark_rows(df)
    wanted_names, wanted = oracle_rows(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if got == wanted:
        return "" if got else "both are empty"
    more, less = got - wanted, wanted - got
    return (
        f"{sum(got.values())} rows, wanted {sum(wanted.values())}; {sum(more.values())} not wanted, "
        f"{sum(less.values())} missing\n  + {str(list(more)[:2])[:800]}\n  - {str(list(less)[:2])[:800]}"
    )


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e
    from conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), connect(sf_dir)
    oracles = e.oracle_sql()
    for key, query in e.queries().items():
        if sys.argv[2:] and key not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            wrong = compare(query(spark, sf_dir), con, oracles[key])
        except Exception as error:
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{key}: {'ok' if not wrong else 'WRONG ' + wrong} ({time.time() - began:.1f}s)", flush=True)


if __name__ == "__main__":
    main()
