"""Run registered queries next to their SQL: python tests/check_oracles.py [sf_dir] [name ...]"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def comparable(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def difference(spark, con, name, sf_dir):
    """None when the query's rows equal its SQL's, else what differs."""
    found = entry.queries()[name](spark, sf_dir)
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    if sorted(found.columns) != sorted(names):
        return f"columns {sorted(found.columns)} / {sorted(names)}"
    want = comparable(result.fetchall(), names)
    have = comparable(found.collect(), found.columns)
    if have == want:
        return None
    extra, missing = set(have) - set(want), set(want) - set(have)
    return (
        f"{len(have)} rows / {len(want)}; only here {len(extra)} {list(extra)[:2]}; "
        f"only there {len(missing)} {list(missing)[:2]}"
    )


if __name__ == "__main__":
    from conftest import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or entry.queries():
        started = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - reported, and counted as a failure
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:32s} {time.time() - started:6.2f}s {problem or ''}", flush=True)
    sys.exit(bad)
