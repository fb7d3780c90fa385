"""Column expressions: text cleansing, parsing, hashing, audit values."""

from vaultwright.functions.audit import load_date, record_source
from vaultwright.functions.hashing import hash_diff, hash_key, link_key
from vaultwright.functions.parse import parse_date, parse_datetime
from vaultwright.functions.text import blank_marker, clean_text

__all__ = [
    "blank_marker", "clean_text", "hash_diff", "hash_key", "link_key",
    "load_date", "parse_date", "parse_datetime", "record_source",
]
