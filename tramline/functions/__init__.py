"""Column-expression helpers. All return native Catalyst expressions."""

from tramline.functions.exprs import (
    bands,
    calendar_parts,
    clip_upper,
    clock_text,
    entity_status,
    lookup,
    next_in_cycle,
    pair_key,
    safe_pct,
    stop_index,
    tick_calendar,
    truncate_to,
)

__all__ = [
    "bands",
    "calendar_parts",
    "clip_upper",
    "clock_text",
    "entity_status",
    "lookup",
    "next_in_cycle",
    "pair_key",
    "safe_pct",
    "stop_index",
    "tick_calendar",
    "truncate_to",
]
