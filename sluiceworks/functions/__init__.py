from sluiceworks.functions.envelope import decode_envelope, encode_envelope
from sluiceworks.functions.expressions import (
    day_of_week,
    digest_projection,
    equals_ignore_case,
    instants,
    matches_ignore_case,
    register_functions,
    wall_clocks,
)

__all__ = [
    "day_of_week",
    "decode_envelope",
    "digest_projection",
    "encode_envelope",
    "equals_ignore_case",
    "instants",
    "matches_ignore_case",
    "register_functions",
    "wall_clocks",
]
