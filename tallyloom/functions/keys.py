"""Composite document keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator inside a key and the text a missing part is written as.
SEPARATOR = "#"
MISSING = "null"


def _part(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(MISSING))


def app_device_key(package: Column, device_id: Column) -> Column:
    """``package#device``."""
    return F.concat(_part(package), F.lit(SEPARATOR), _part(device_id))


def statistic_key(
    package: Column, channel: Column, country: Column, app_key: Column, delimiter: str = ""
) -> Column:
    """``package#channel#country`` with the app key appended.

    By default nothing stands between country and app key, as in stored ids; pass a delimiter for
    keys that cannot collide.
    """
    sep = F.lit(SEPARATOR)
    return F.concat(
        _part(package), sep, _part(channel), sep, _part(country), F.lit(delimiter), _part(app_key)
    )


def device_hash(imei: Column, mac: Column) -> Column:
    """Repeatable device id: a digest of the identifiers first seen together."""
    return F.sha2(F.concat(_part(imei), F.lit("|"), _part(mac)), 256)
