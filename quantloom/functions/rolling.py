"""Rolling row windows, as SQL text, with pandas' rule that a frame must be full."""

from __future__ import annotations


def full_frame(agg: str, col: str, over: str, rows: int) -> str:
    """``agg`` over the last ``rows`` rows; null until the frame has that many values."""
    frame = f"OVER ({over} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) {frame} = {rows} THEN {agg}({col}) {frame} END"


def lag(col: str, over: str, rows: int) -> str:
    return f"lag({col}, {rows}) OVER ({over})"


def change(now: str, then: str) -> str:
    """Relative change between two values."""
    return f"try_divide({now}, {then}) - 1"
