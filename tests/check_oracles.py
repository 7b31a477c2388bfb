"""Compare every registered query with its oracle.

    python tests/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def sorted_rows(columns, rows):
    """Rows with their columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    cells = [tuple(_cell(row[n]) for n in order) for row in rows]
    return [columns[n] for n in order], sorted(cells, key=repr)


def compare(spark, con, name: str, sf_dir: str) -> tuple[int, str | None]:
    """Number of rows, and what differs, if anything."""
    got_df = entry.queries()[name](spark, sf_dir)
    got_columns, got = sorted_rows(got_df.columns, [tuple(row) for row in got_df.collect()])
    cursor = con.execute(entry.oracle_sql()[name])
    columns, want = sorted_rows([c[0] for c in cursor.description], cursor.fetchall())
    if got_columns != columns:
        return len(got), f"columns {got_columns} != {columns}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows, expected {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs or [type(x) for x in mine] != [type(x) for x in theirs]:
            return len(got), f"\n   got  {mine}\n   want {theirs}"
    return len(got), None


def main() -> None:
    from gleanframe.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          **{"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            rows, problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on
            rows, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:32} {rows:>8} rows {time.time() - start:6.2f} s"
              + (f"  {problem}" if problem else ""), flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")


if __name__ == "__main__":
    main()
