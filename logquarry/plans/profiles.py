"""The ways a log is turned into layers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from logquarry.functions.clean import strip_request_chars, strip_request_tokens
from logquarry.operators.cleaning import dash_to_null, empty_to_na


@dataclass(frozen=True)
class LogProfile:
    """Choices of one pipeline; the steps themselves are the same for all.

    ``kb_digits`` None keeps the size in bytes. ``blanks_null`` makes blanks NULL between
    the raw and the cleansed layer; ``fill`` turns NULL strings into ``NA`` there.
    """

    name: str
    family: str
    strip: Callable[[Column | str], Column] | None
    kb_digits: int | None
    mark_missing: Callable[[DataFrame], DataFrame] | None
    dedup: bool
    blanks_null: bool
    fill: bool


# One typed chain: nothing stripped, bytes kept, '' left as it is.
TYPED = LogProfile("typed", "strict", None, None, None, False, False, False)
# Layer by layer: tokens stripped, two decimals, '-' becomes NULL and stays so.
STRICT = LogProfile("strict", "strict", strip_request_tokens, 2, dash_to_null, False, True, False)
# Whole KB, '-' becomes NULL, NULL becomes NA.
LOOSE = LogProfile("loose", "loose", strip_request_chars, 0, dash_to_null, False, True, True)
# As loose, but duplicates removed first and '' becomes NA.
DISTINCT = LogProfile("distinct", "loose", strip_request_chars, 0, empty_to_na, True, True, True)

PROFILES = {p.name: p for p in (TYPED, STRICT, LOOSE, DISTINCT)}
