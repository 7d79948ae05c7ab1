"""Run registered queries next to their SQL twins: ``python -m modsieve.catalog.check DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Spark type name -> type names of the other engine that count as equal.
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "string": {"VARCHAR"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "timestamp": {"TIMESTAMP", "TIMESTAMP WITH TIME ZONE"},
    "timestamp_ntz": {"TIMESTAMP"},
    "date": {"DATE"},
}


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    flat = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(flat, key=repr)


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(df, con, sql: str) -> str:
    """Empty text when both give the same columns, types and rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but SQL has {sorted(names)}"
    wrong = [
        f"{c}: {t} but SQL has {types[c]}"
        for c, t in df.dtypes
        if t in SAME_TYPE and types[c] not in SAME_TYPE[t]
    ]
    if wrong:
        return "types " + "; ".join(wrong)
    actual = rows_of(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows but SQL has {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"got {str(got)[:600]}\n   want {str(want)[:600]}"
    return ""


def main(argv: list[str]) -> int:
    from modsieve.catalog import ORACLES, QUERIES
    from modsieve.session import local_session

    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = compare(df, con, ORACLES[name]) if name in ORACLES else ""
            note = "ok" if name in ORACLES else f"rows {df.count()}"
        except Exception as error:  # report and go on with the next query
            problem, note = f"{type(error).__name__}: {str(error)[:1500]}", ""
        failed += bool(problem)
        print(f"{time.time() - start:6.2f}s {name}: {problem or note}", flush=True)
    print(f"{failed} of {len(names)} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
