"""Column expressions shared by batch and streaming operators."""

from rillwork.functions.times import day_of, millis_to_time, parse_date, parse_time, window_of
from rillwork.functions.values import copy_block, to_json_text

__all__ = ["copy_block", "day_of", "millis_to_time", "parse_date", "parse_time", "to_json_text",
           "window_of"]
