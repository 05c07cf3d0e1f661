"""Order-insensitive comparison of query results."""

import datetime as dt
import math
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return dt.datetime(value.year, value.month, value.day)
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return as_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(relation):
    return as_rows([c[0] for c in relation.description], relation.fetchall())


def day(text):
    return dt.date.fromisoformat(text)


def moment(text):
    return dt.datetime.fromisoformat(text)


def by_key(df, *keys):
    """Rows as dicts, by the values of the key columns."""
    found = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        assert key not in found, f"{key} twice"
        found[key if len(keys) > 1 else key[0]] = row.asDict()
    return found
