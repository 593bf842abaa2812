"""Rows as JSON texts, for state that must hold rows of any schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def packed(cols: list[str]) -> Column:
    """The columns as one JSON text (nulls kept, times to the microsecond)."""
    return F.to_json(F.struct(*cols), _JSON)


def unpacked(col: str, fields: list) -> list[Column]:
    """The columns of a ``packed`` text; all null where the text is null."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    value = F.from_json(F.col(col), schema, _JSON)
    return [value[f.name].alias(f.name) for f in fields]
