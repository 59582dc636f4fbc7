"""Column functions."""

from millrace.functions.cursors import cursor_token, decode_cursor, parse_cursor
from millrace.functions.jsonsafe import item_json, json_safe
from millrace.functions.rules import all_hold, failed_names, failures, holds
from millrace.functions.times import iso_text, parse_event_time, since

__all__ = [
    "all_hold",
    "cursor_token",
    "decode_cursor",
    "failed_names",
    "failures",
    "holds",
    "iso_text",
    "item_json",
    "json_safe",
    "parse_cursor",
    "parse_event_time",
    "since",
]
