"""Compare every registered query with its SQL: columns, types and rows.

    python tests/check_sql.py [folder] [query ...]
"""

from __future__ import annotations

import datetime
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

FAMILIES = {
    "tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "long", "hugeint": "huge",
    "varchar": "string", "string": "string", "double": "double", "date": "date", "boolean": "boolean",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp", "short": "int", "byte": "int", "long": "long",
}


def family(type_name: str) -> str:
    name = str(type_name).lower()
    return FAMILIES.get(name, name)


def plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize())
    if isinstance(value, float):
        return repr(round(value, 6))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def compare(df, con, sql: str) -> list[str]:
    found = [f"{f.name}:{family(f.dataType.simpleString())}" for f in df.schema.fields]
    relation = con.sql(sql)
    wanted = [f"{c}:{family(t)}" for c, t in zip(relation.columns, relation.types, strict=True)]
    problems = []
    if sorted(found) != sorted(wanted):
        problems.append(f"columns {sorted(set(found) ^ set(wanted))}")
        if sorted(df.columns) != sorted(relation.columns):
            return problems
    order = sorted(df.columns)
    ours = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    place = [relation.columns.index(c) for c in order]
    theirs = Counter(tuple(plain(r[i]) for i in place) for r in relation.fetchall())
    if ours != theirs:
        problems.append(f"rows {sum(ours.values())} vs {sum(theirs.values())}")
        problems += [f"  only ours   {x}" for x in list((ours - theirs).elements())[:2]]
        problems += [f"  only theirs {x}" for x in list((theirs - ours).elements())[:2]]
    return problems


def main() -> None:
    from shiftroll.plans import oracle, registry
    from shiftroll.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = local_session(**{"spark.ui.showConsoleProgress": "false"})
    con = connect(folder)
    statements = oracle.statements()
    bad = 0
    for name, build in registry.registered().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            problems = compare(build(spark, folder), con, statements[name])
        except Exception as error:  # report and go on
            problems = [str(error)[:700]]
        bad += bool(problems)
        print("ok  " if not problems else "BAD ", f"{name:34s} {time.time() - start:6.2f}s", *problems, sep="\n" if problems else " ")
    print("extra sql:", sorted(set(statements) - set(registry.registered())))
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
