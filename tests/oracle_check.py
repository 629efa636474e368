"""Compare registered queries with their SQL: python tests/oracle_check.py FOLDER [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _key(row):
    return tuple((value is None, str(value)) for value in row)


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


KINDS = {
    "boolean": "BOOLEAN",
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    """Messages on columns, types, row count and values; empty if all agree."""
    relation = con.sql(sql)
    ours, theirs = sorted(df.columns), sorted(relation.columns)
    if ours != theirs:
        return [f"columns differ: {sorted(set(ours) ^ set(theirs))}"]
    found = []
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if KINDS.get(kind, kind) != kinds[field.name]:
            found.append(f"type of {field.name}: {kind} and {kinds[field.name]}")
    quoted = ", ".join(f'"{name}"' for name in ours)
    want = sorted((tuple(map(_plain, r)) for r in con.sql(f"SELECT {quoted} FROM ({sql})").fetchall()), key=_key)
    got = sorted((tuple(map(_plain, r)) for r in df.select(*[f"`{c}`" for c in ours]).collect()), key=_key)
    if len(got) != len(want):
        found.append(f"{len(got)} rows and {len(want)} expected")
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        g, w = wrong[0]
        cells = [(c, a, b) for c, a, b in zip(ours, g, w) if a != b]
        found.append(f"{len(wrong)} rows differ, first: {cells[:4]}")
    return found


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as registered
    from orderloom.session import local_session

    spark = local_session()
    con = connect(folder)
    queries, oracles = registered.queries(), registered.oracle_sql()
    failures = 0
    for name in names or queries:
        began = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                found, kind = differences(df, con, oracles[name]), "sql"
            else:
                rows = df.collect()
                found, kind = [] if rows else ["no rows"], f"rows {len(rows)} {rows[:2]}"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found, kind = [f"{type(error).__name__}: {str(error)[:600]}"], "error"
        failures += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} ({kind}) {time.time() - began:.1f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{failures} failures; without SQL: {sorted(set(queries) - set(oracles))}; extra SQL: {sorted(set(oracles) - set(queries))}")
    return failures


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
