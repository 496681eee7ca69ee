"""Compare registered queries with their SQL in DuckDB. Also a script: oracle.py SF_DIR [NAME...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _family(kind: pa.DataType) -> str:
    if pa.types.is_floating(kind):
        return "float"
    if pa.types.is_integer(kind):
        return "int"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    return "timestamp" if pa.types.is_timestamp(kind) else str(kind)


def _rows(table: pa.Table) -> list[tuple]:
    columns = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    return sorted(zip(*columns), key=lambda row: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row))


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else a description."""
    ours = entry.queries()[name](spark, sf_dir).toArrow()
    theirs = con.execute(entry.oracle_sql()[name]).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} / {sorted(theirs.column_names)}"
    for c in ours.column_names:
        a, b = ours.schema.field(c).type, theirs.schema.field(c).type
        if _family(a) != _family(b):
            return f"type of {c}: {a} / {b}"
    if ours.num_rows != theirs.num_rows:
        return f"rows {ours.num_rows} / {theirs.num_rows}"
    left, right = _rows(ours), _rows(theirs)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}"
    return None


def main() -> None:
    from tests.conftest import make_session

    sf_dir = sys.argv[1]
    spark = make_session()
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    names = [n for n in sys.argv[2:] if "=" not in n] or list(entry.queries())
    for pair in [n for n in sys.argv[2:] if "=" in n]:
        spark.conf.set(*pair.split("=", 1))
    bad = 0
    for name in names:
        began = time.time()
        try:
            if name in sql:
                found = difference(spark, con, sf_dir, name)
            else:
                rows = entry.queries()[name](spark, sf_dir).toArrow().num_rows
                found = None if rows else "no rows"
                name += f" (rows only: {rows})"
        except Exception as error:  # report and go on with the next query
            found = "".join(traceback.format_exception_only(error))[:1500]
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {time.time() - began:6.2f}s {name}", flush=True)
        if found:
            print("    ", found, flush=True)
    print(f"{bad} of {len(names)} failed")
    spark.stop()


if __name__ == "__main__":
    main()
