from indicator_engine.functions.numbers import percentage, round_half_up
from indicator_engine.functions.text import decode, flag_from_text, pad_key, snake_columns
from indicator_engine.functions.typing import as_double, as_int, as_key, as_kind, as_timestamp, typed

__all__ = [
    "as_double",
    "as_int",
    "as_key",
    "as_kind",
    "as_timestamp",
    "decode",
    "flag_from_text",
    "pad_key",
    "percentage",
    "round_half_up",
    "snake_columns",
    "typed",
]
