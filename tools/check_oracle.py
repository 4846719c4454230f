"""Run every query beside its SQL and compare the rows: ``python tools/check_oracle.py [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from webtext.plans.registry import QUERIES, SQL  # noqa: E402
from webtext.session import build_session  # noqa: E402


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([repr(row[i]) for i in order] for row in rows))


def main(folder, names):
    spark = build_session("check", **dict(item.split("=", 1) for item in os.environ.get("CHECK_CONF", "").split()))
    db = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    bad = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            ours = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
        except Exception as error:
            bad += 1
            print(f"FAIL {name}: {str(error)[:600]}")
            continue
        took = time.time() - started
        if name not in SQL:
            print(f"rows {name}: {len(ours)} rows, {took:.1f} s")
            continue
        try:
            result = db.sql(SQL[name])
            theirs = rows_of(result.columns, result.fetchall())
        except Exception as error:
            bad += 1
            print(f"FAIL {name} (SQL): {str(error)[:600]}")
            continue
        same = ours == theirs and sorted(frame.columns) == sorted(result.columns)
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name}: {len(ours)} / {len(theirs)} rows, {took:.1f} s")
        if not same:
            print("  ", sorted(frame.columns), sorted(result.columns))
            pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
            for a, b in pairs[:2]:
                print("   ours  ", str(a)[:300])
                print("   theirs", str(b)[:300])
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    sys.exit(main(arguments[0] if arguments else "/root/testdata/sf0.01", arguments[1:]) > 0)
