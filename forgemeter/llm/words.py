"""Words, identities and column names shared by the corpus operators.

A word is a run of bytes other than space and 0x09-0x0D; ``bytes.split()`` cuts
at exactly those. Null texts count as empty.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the word pattern of the corpus contracts.
WORD = r"[^\x20\x09-\x0D]+"

NO_ID = -(2**63)


def text_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 of each text; nulls are empty."""
    return [value or b"" for value in texts.cast(pa.binary()).to_pylist()]


def id_key(column: str = "doc_id") -> Column:
    """A join key that is never null."""
    return F.coalesce(F.col(column).cast("bigint"), F.lit(NO_ID))


def text_key(column: str = "text") -> Column:
    """A join key for a text: rows equal in id and text are the same document."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called that."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
