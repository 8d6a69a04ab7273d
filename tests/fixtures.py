"""Small hand-written staging tables."""

from datetime import date, datetime

from billscope.sources.staging import SCHEMAS, Staging


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def table(spark, name: str, rows: list[dict]):
    """A staging table; columns a row leaves out are NULL."""
    schema = SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def staging(spark, **rows: list[dict]) -> Staging:
    return Staging(**{name: table(spark, name, rows.get(name, [])) for name in SCHEMAS})


def by_key(df, *keys: str) -> dict:
    """Collected rows as dicts, keyed by one column or a tuple of columns."""
    found = {}
    for row in df.collect():
        key = row[keys[0]] if len(keys) == 1 else tuple(row[k] for k in keys)
        assert key not in found, f"repeated key {key}"
        found[key] = row.asDict()
    return found
