"""Order-free comparison of a Spark result with DuckDB's answer over the same files."""

from __future__ import annotations

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    return round(value, 9) if isinstance(value, float) else value


def _ordered(rows) -> list[tuple]:
    return sorted((tuple(map(_plain, r)) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, _ordered(df.select(*columns).collect())


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], _ordered([tuple(r[i] for i in order) for r in cursor.fetchall()])
