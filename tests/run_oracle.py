"""Run registered queries against DuckDB: python tests/run_oracle.py <sf dir> [name ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from compare import database, differences  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from telemill.session import local_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark, con, sql, failed = local_session(), database(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            found = differences(df, con, sql[name]) if name in sql else []
            note = "" if name in sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            found, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
            if names:
                traceback.print_exc()
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
        for line in found:
            print("     ", line, flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
