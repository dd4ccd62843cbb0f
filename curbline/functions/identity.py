"""Deterministic trip ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbline.schema import ID_HEX_DIGITS, ID_PREFIX


def trip_id(
    row_number: Column,
    date_text: Column,
    latitude_text: Column,
    longitude_text: Column,
    base: Column,
    prefix: str = ID_PREFIX,
) -> Column:
    """Hash of the row's position and fields; equal rows at other positions differ.

    Null fields are left out, so the hash is never null. The planner cannot tell; the
    fallback says so, and a null test on the id no longer hashes every row.
    """
    identity = F.concat_ws(
        "|", row_number.cast("string"), date_text, latitude_text, longitude_text, base
    )
    digest = F.coalesce(F.sha2(identity, 256), F.lit(""))
    return F.concat(F.lit(prefix), F.substring(digest, 1, ID_HEX_DIGITS))
