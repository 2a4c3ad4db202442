"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def operation_id(device: str = "DeviceId", ts: str = "LocalTimeSpan") -> Column:
    """Key of a device and hour in UUID form, from a hash: the same on every run (K-1)."""
    h = F.md5(F.concat_ws("|", F.col(device), F.date_format(F.col(ts), "yyyy-MM-dd HH:mm:ss")).cast("binary"))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
