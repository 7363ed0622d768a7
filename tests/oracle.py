"""Compare a Spark result with DuckDB's for the SQL of the same name."""

from __future__ import annotations

from pathlib import Path

import duckdb


def run_sql(sql: str, sf_dir: str):
    """Column names, types and rows."""
    with duckdb.connect() as db:
        for file in sorted(Path(sf_dir).glob("*.parquet")):
            db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
        result = db.execute(sql)
        described = [(c[0], str(c[1]).lower()) for c in result.description]
        return described, result.fetchall()


def normal(names, rows):
    """Rows in a form that does not depend on the order of columns or rows."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    def cell(value):
        return repr(round(value, 9)) if isinstance(value, float) else str(value)
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def differences(df, sql: str, sf_dir: str) -> str:
    """Empty if the results are equal, else what differs."""
    described, expected = run_sql(sql, sf_dir)
    names = [name for name, _ in described]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for name, kind in described:
        ours = types[name]
        same = {"varchar": "string", "bigint": "bigint", "integer": "int", "double": "double",
                "timestamp": "timestamp_ntz", "date": "date", "boolean": "boolean"}
        if same.get(kind) not in (ours, None):
            return f"type of {name}: {ours} != {kind}"
    rows = df.collect()
    got = normal(df.columns, rows)
    want = normal(names, expected)
    if got == want:
        return ""
    missing, extra = sorted(set(want) - set(got))[:3], sorted(set(got) - set(want))[:3]
    return f"{len(got)} rows, expected {len(want)}; missing {missing}; extra {extra}"
