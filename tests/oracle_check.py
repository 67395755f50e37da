"""Run registered queries against their DuckDB oracle (like the driver does).

    python tests/oracle_check.py [sf_dir] [key ...]

Prints one line per key: rows, schema and value match.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def compare(spark, sf_dir: str, keys: list[str] | None = None) -> dict:
    """Row count, column names and an order-insensitive value comparison
    (``EXCEPT ALL`` both ways inside DuckDB, doubles rounded to 6 places)."""
    import __spark_entry__ as E

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')").fetchall()
    qs, sqls = E.queries(), E.oracle_sql()
    out = {}
    for key in keys or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[key](spark, sf_dir)
            spark_tbl = sdf.toArrow()
            t1 = time.time()
            if key not in sqls:
                out[key] = dict(rows=spark_tbl.num_rows, oracle=None, secs=round(t1 - t0, 1))
                print(key, out[key], flush=True)
                continue
            con.register("spark_result", spark_tbl)
            con.execute(f"CREATE OR REPLACE TEMP TABLE oracle_result AS {sqls[key]}").fetchall()
            ocols = [r[0] for r in con.execute("DESCRIBE oracle_result").fetchall()]
            scols = list(spark_tbl.column_names)
            n_o = con.execute("SELECT count(*) FROM oracle_result").fetchall()[0][0]
            res = dict(rows=(spark_tbl.num_rows, n_o), schema=sorted(scols) == sorted(ocols), secs=round(t1 - t0, 1))
            if res["schema"]:
                def norm(tbl):
                    types = dict((r[0], r[1]) for r in con.execute(f"DESCRIBE {tbl}").fetchall())
                    cols = sorted(scols)
                    return ", ".join(
                        f'round("{c}", 6) AS "{c}"' if types[c] in ("DOUBLE", "FLOAT") else f'"{c}"' for c in cols
                    )
                a = f"SELECT {norm('spark_result')} FROM spark_result"
                b = f"SELECT {norm('oracle_result')} FROM oracle_result"
                d1 = con.execute(f"SELECT count(*) FROM ({a} EXCEPT ALL {b})").fetchall()[0][0]
                d2 = con.execute(f"SELECT count(*) FROM ({b} EXCEPT ALL {a})").fetchall()[0][0]
                res["values"] = d1 == 0 and d2 == 0
                if not res["values"]:
                    res["spark_only"] = con.execute(f"{a} EXCEPT ALL {b} LIMIT 3").fetchall()
                    res["oracle_only"] = con.execute(f"{b} EXCEPT ALL {a} LIMIT 3").fetchall()
            else:
                res["cols"] = (sorted(scols), sorted(ocols))
            con.unregister("spark_result")
        except Exception as e:  # report and continue
            res = dict(error=repr(e)[:400])
        out[key] = res
        print(key, res, flush=True)
    return out


if __name__ == "__main__":
    from ratecraft.session import build_session, release_scratch

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    compare(spark, sf, sys.argv[2:] or None)
    release_scratch(spark)
