"""Identity resolution over clickstream tables, as DataFrame operators."""

from uidloom.operators.match import match_rate, three_phase
from uidloom.operators.resolve import resolve, user_map, write_back
from uidloom.operators.valid_uuid import choices, choices_from, set_valid_uuid
from uidloom.plans.resolution import (
    discover,
    read_discovered,
    resolve_table,
    resolve_valid,
    resolved_table,
    run,
    run_tables,
    unresolved,
)

__all__ = [
    "choices",
    "choices_from",
    "discover",
    "match_rate",
    "read_discovered",
    "resolve",
    "resolve_table",
    "resolve_valid",
    "resolved_table",
    "run",
    "run_tables",
    "set_valid_uuid",
    "three_phase",
    "unresolved",
    "user_map",
    "write_back",
]
