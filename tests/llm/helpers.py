import datetime
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def oracle_rows(sql, sf="sf0.01"):
    """Rows of a query in DuckDB over the given tables, columns in order of their names."""
    connection = duckdb.connect()
    for path in (DATA / sf).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = connection.sql(sql)
    order = sorted(range(len(found.columns)), key=lambda k: found.columns[k])
    return [found.columns[k] for k in order], sorted((tuple(row[k] for k in order) for row in found.fetchall()), key=repr)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


def planted_documents():
    """Rows as they should not be: nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    line = "A line that stands in many documents."
    rows = [
        (1, f"{line}\nown words of one\n{line}", "s"),
        (2, f"  {line.upper()} \nown words of two", "s"),
        (3, f"{line}\t", None),
        (4, None, "t"),
        (5, "", "t"),
        (5, "", "t"),
        (None, f"{line}\nwithout a number", None),
        (7, "short\nshort\nshort", "u"),
        (8, ("word " * 60_000).strip() + "\n" + line, "s"),
        (3, f"{line}\t", None),
    ]
    return [(*row, 0, 0, "x", datetime.date(2024, 1, 1)) for row in rows]


SCHEMA = "doc_id long, text string, source string, n long, key int, digest string, copy date"
