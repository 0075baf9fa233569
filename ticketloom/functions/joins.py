"""Joins of wide rows to narrow per-key results whose size is not known ahead."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.session import stage, stored_bytes

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "left",
    name: str = "lookup",
    fixed_width: bool = True,
    broadcast_rows: int | None = None,
    moved: list[str] | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which holds one row per key.

    Planning both sides at once would shuffle the wide rows before anyone
    knows how few keys matter. So the lookup is staged first. With
    ``fixed_width`` (ids, hashes and numbers) its counted rows and the bytes of
    its staged files decide on a broadcast; otherwise Catalyst decides by the
    size of the staged files.
    Beyond either limit it is a shuffle join, where AQE splits hot keys: the
    lookup's side of a split key is a single row, so splitting costs nothing.
    ``moved`` gets ``name`` unless the rows are sure to stay in their tasks.
    """
    staged = stage(lookup, name)
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    if fixed_width and staged.count() <= limit and stored_bytes(staged) <= BROADCAST_BYTES:
        staged = F.broadcast(staged)
    elif moved is not None:
        moved.append(name)
    return rows.join(staged, on, how)
