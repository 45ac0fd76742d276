"""Run the named queries in Spark and their statements in DuckDB and compare the rows exactly.

    python -m tests.oracle /root/testdata/sf0.01 [name …]
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str):
    db = duckdb.connect()
    db.sql("SET threads TO 8")
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, db, sql: str) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    names = sorted(df.columns)
    right = db.sql(sql)
    if names != sorted(right.columns):
        return f"columns {names} != {sorted(right.columns)}"
    kinds = {n: str(t) for n, t in zip(right.columns, right.types)}
    want = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
    odd = [(n, t, kinds[n]) for n, t in df.dtypes if want.get(t) != kinds[n]]
    if odd:
        return f"types {odd}"
    ours = _sorted([tuple(r) for r in df.select(*names).collect()])
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = _sorted(right.project(quoted).fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)} of {len(ours)} rows differ, e.g. {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    from haulage import catalogue, session

    sf_dir, wanted = argv[0], argv[1:]
    spark = session.build("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    db = database(sf_dir)
    texts = catalogue.oracle_sql()
    failed = 0
    for name, make in catalogue.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = make(spark, sf_dir)
            if name in texts:
                note = compare(df, db, texts[name])
            else:
                note = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            note = f"{type(error).__name__}: {str(error)[:600]}"
        failed += note is not None
        print(f"{'ok  ' if note is None else 'FAIL'} {name} {time.time() - start:.1f}s {note or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
