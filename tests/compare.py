"""Compare a Spark result with the oracle's, whatever the row order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple], list[str]]:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    kinds = [str(column[1]) for column in result.description]
    return names, result.fetchall(), kinds


def _key(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, float):
        return (1, f"{value:.6f}" if value else "0.000000")
    return (1, str(value))


def canonical(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda at: names[at])
    keyed = sorted(tuple(_key(row[at]) for at in order) for row in rows)
    return [names[at] for at in order], keyed
