"""Run queries beside their SQL twins: ``python -m tests.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "TINYINT": "tinyint", "SMALLINT": "smallint", "FLOAT": "float",
}


def sql_types(con, sql: str) -> dict[str, str]:
    result = con.execute(f"DESCRIBE {sql}")
    return {r[0]: KINDS.get(r[1], r[1]) for r in result.fetchall()}


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns, types and rows; else what differs."""
    have_cols, have = spark_rows(df)
    want_cols, want = sql_rows(con, sql)
    if have_cols != want_cols:
        return f"columns {have_cols} != {want_cols}"
    have_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want_types = sql_types(con, sql)
    if have_types != want_types:
        return f"types differ: { {c: (have_types[c], want_types[c]) for c in have_types if have_types[c] != want_types[c]} }"
    if len(have) != len(want):
        return f"{len(have)} rows != {len(want)}"
    wrong = [(h, w) for h, w in zip(have, want, strict=True) if h != w]
    if wrong:
        return f"{len(wrong)} of {len(have)} rows differ, first {wrong[0]}"
    return None


def main() -> None:
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = []
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sqls:
                problem = difference(df, con, sqls[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as e:  # report and go on to the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        seconds = time.time() - start
        print(f"{'ok ' if problem is None else 'BAD'} {name:30s} {seconds:6.2f}s "
              f"{'' if name in sqls else '(rows)'} {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} ok; bad: {bad}")


if __name__ == "__main__":
    main()
