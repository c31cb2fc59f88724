"""Several short values of a row as one text, for rows that are shuffled.

In a shuffled row each text has its place and length beside it and is filled up
to eight bytes; one text of several values takes less and compresses better.
``unpacked`` gives back exactly what ``packed`` was given: NULL is nothing, any
other value stands behind "=", and "|" parts them (inside a value it is "~1",
and "~" is "~0"). Numbers go as their digits and are cast back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def packed(*values: Column | str) -> Column:
    def one(v) -> Column:
        text = (F.col(v) if isinstance(v, str) else v).cast("string")
        whole = F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("|"), F.lit("~1"))
        return F.coalesce(F.concat(F.lit("="), whole), F.lit(""))
    return F.concat_ws("|", *map(one, values))


def unpacked(text: str, **types) -> dict[str, Column]:
    """The values of ``packed`` by the names they are to have, each of its type."""
    parts = F.split(F.col(text), "\\|", -1)

    def one(i, kind) -> Column:
        part = parts[i]
        whole = F.replace(F.replace(F.substr(part, F.lit(2)), F.lit("~1"), F.lit("|")), F.lit("~0"), F.lit("~"))
        return F.when(part != "", whole).cast(kind)
    return {name: one(i, kind) for i, (name, kind) in enumerate(types.items())}
