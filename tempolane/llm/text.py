"""Small pieces shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word and separator classes of the contracts.
SEPARATORS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def free_name(columns, wanted: str) -> str:
    """A column name that no column has yet."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
