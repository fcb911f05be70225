"""When two intervals meet, in the conventions that interval formats use."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F


class Overlap(Enum):
    HALF_OPEN = "half_open"  # BED: touching ends don't meet
    CLOSED = "closed"  # both ends belong to the interval


def overlaps(how: Overlap, s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    if how is Overlap.HALF_OPEN:
        return (s1 < e2) & (s2 < e1)
    return (s1 <= e2) & (s2 <= e1)


def outer_span(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Bases from the first to the last of both intervals."""
    return F.greatest(e1, e2) - F.least(s1, s2) + 1


def centre_span(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Distance of the integer centres, plus one."""
    return F.abs(F.floor((s1 + e1) / 2) - F.floor((s2 + e2) / 2)) + 1
