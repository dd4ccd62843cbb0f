"""Keep filters from repeating costly parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpack_once(frame: DataFrame, parsed: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fields of the struct ``parsed`` as columns, next to ``keep``.

    The optimizer moves a filter below the projection its columns come from, and then works
    the projection out again for each condition: a JSON message would be parsed some eight
    times. It does not move a filter below a generator, so ``inline`` parses once.
    """
    return frame.select(*keep, F.inline(F.array(parsed)))
