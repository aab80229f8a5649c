"""List columns whose Spark and DuckDB oracle types differ (sf0.001)."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from webledger.plans.registry import all_oracles, all_queries  # noqa: E402
from webledger.session import build_session  # noqa: E402
from webledger.sources.tables import TABLES  # noqa: E402

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
                 "smallint": "SMALLINT", "tinyint": "TINYINT"}

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = build_session()
con = duckdb.connect()
for t in TABLES:
    con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
q, o = all_queries(), all_oracles()
for name in sorted(o):
    s = dict(q[name](spark, sf).dtypes)
    d = {r[0]: r[1] for r in con.execute(f"describe {o[name]}").fetchall()}
    diff = {c: (s[c], d.get(c)) for c in s if SPARK_TO_DUCK.get(s[c], s[c]) != d.get(c)}
    if diff:
        print(name, diff)
spark.stop()
