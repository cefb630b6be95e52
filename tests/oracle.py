"""Compare a Spark result with a DuckDB oracle: names, types, row count and an
order-insensitive hash of the values (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from dataclasses import dataclass

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark simpleString -> DuckDB type name
_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\0"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def _digest(rows, names, order):
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@dataclass
class Comparison:
    rows_spark: int
    rows_oracle: int
    names_equal: bool
    types_equal: bool
    hash_equal: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return self.rows_spark == self.rows_oracle and self.names_equal and self.types_equal and self.hash_equal


def arrow_equal(df, con, sql: str) -> bool:
    """Exact compare through Arrow: same column types, same multiset of rows."""
    t, o = df.toArrow(), con.sql(sql).to_arrow_table()
    if {f.name: f.type for f in t.schema} != {f.name: f.type for f in o.schema}:
        return False
    cols = sorted(t.column_names)
    order = [(c, "ascending") for c in cols]
    return t.select(cols).sort_by(order).cast(o.select(cols).schema).equals(o.select(cols).sort_by(order))


def compare(df, con, sql: str) -> Comparison:
    s_names = df.columns
    s_types = [_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    o_names = rel.columns
    o_types = [str(t) for t in rel.types]
    o_rows = rel.fetchall()
    names_equal = sorted(s_names) == sorted(o_names)
    s_order = sorted(range(len(s_names)), key=lambda i: s_names[i])
    o_order = sorted(range(len(o_names)), key=lambda i: o_names[i])
    types_equal = names_equal and [s_types[i] for i in s_order] == [o_types[i] for i in o_order]
    hash_equal = names_equal and _digest(s_rows, s_names, s_order) == _digest(o_rows, o_names, o_order)
    detail = f"spark={list(zip(s_names, s_types))} oracle={list(zip(o_names, o_types))}"
    return Comparison(len(s_rows), len(o_rows), names_equal, types_equal, hash_equal, detail)
