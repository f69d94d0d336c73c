"""Which rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % F.lit(k)
