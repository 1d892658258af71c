"""Compare a query's rows with the result of its SQL."""

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, run, sql, sf_dir):
    got = run(spark, sf_dir)
    table = got.toArrow()
    want = con.sql(sql).to_arrow_table()
    if sorted(table.column_names) != sorted(want.column_names):
        return f"columns {sorted(table.column_names)} != {sorted(want.column_names)}"
    a = rows_of(table.column_names, list(zip(*[c.to_pylist() for c in table.columns])))
    b = rows_of(want.column_names, list(zip(*[c.to_pylist() for c in want.columns])))
    types = [f"{n}: {table.schema.field(n).type} vs {want.schema.field(n).type}"
             for n in table.column_names
             if str(table.schema.field(n).type) != str(want.schema.field(n).type)]
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        return (f"rows {len(a)} vs {len(b)}; columns {sorted(table.column_names)}\n"
                f"  only here {only_a}\n  only sql  {only_b}")
    return ("types: " + "; ".join(types)) if types else None


if __name__ == "__main__":
    import pathlib
    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
    from tidemark.plans.catalog import EXPECTED, QUERIES
    from tidemark.session import build_session
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    session = build_session("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name in names:
        begun = time.time()
        try:
            if name in EXPECTED:
                verdict = compare(session, connection, QUERIES[name], EXPECTED[name], sf_dir)
            else:
                out = QUERIES[name](session, sf_dir).toPandas()
                verdict = f"(no sql) {len(out)} rows\n{out.head(12).to_string()}"
        except Exception as error:  # show and go on with the next query
            verdict = f"ERROR {str(error)[:600]}"
        print(f"{name}: {verdict or 'ok'} [{time.time() - begun:.1f}s]", flush=True)
