"""Scalar Column functions with the reference's parsing/formatting semantics."""

from rivulet.functions.codec import (decode_utf8, encode_utf8, from_json_envelope,
                                     to_json_envelope)
from rivulet.functions.numbers import bytes_to_long, java_parse_int, long_to_bytes, py_int
from rivulet.functions.text import (NON_WORD, SPACE, TAB, WHITESPACE, explode_run_split,
                                    first_field, java_format, java_length, java_split)

__all__ = [
    "decode_utf8", "encode_utf8", "from_json_envelope", "to_json_envelope",
    "bytes_to_long", "java_parse_int", "long_to_bytes", "py_int",
    "NON_WORD", "SPACE", "TAB", "WHITESPACE", "explode_run_split", "first_field",
    "java_format", "java_length", "java_split",
]
