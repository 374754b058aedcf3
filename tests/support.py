"""Names shared by the tests of the core."""

from __future__ import annotations

SMALL = "/root/testdata/sf0.001"


def rows_of(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=repr)
