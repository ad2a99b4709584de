"""Which format a feed's dates are written in, told from a cell."""

from __future__ import annotations

import re

# ---------------------------------------------------------------------------
# Shapes of dates and of times of day. Where a cell fits two
# dates, the earlier in the list is taken: months come before days.
# ---------------------------------------------------------------------------
DATE_SHAPES = (
    "yyyy-M-d",
    "yyyy/M/d",
    "yyyy.M.d",
    "M/d/yyyy",
    "M-d-yyyy",
    "M.d.yyyy",
    "d/M/yyyy",
    "d-M-yyyy",
    "d.M.yyyy",
    "MMMM d, yyyy",
    "MMM d, yyyy",
    "MMMM d yyyy",
    "MMM d yyyy",
    "d MMMM yyyy",
    "d MMM yyyy",
    "d-MMMM-yyyy",
    "d-MMM-yyyy",
    "MMM-d-yyyy",
    "yyyy MMMM d",
    "yyyy MMM d",
)
TIME_SHAPES = (
    "",
    " H:m",
    " H:m:s",
    " H:m:s.SSSSSSSSS",
    "'T'H:m",
    "'T'H:m:s",
    "'T'H:m:s.SSSSSSSSS",
    " h:m a",
    " h:m:s a",
)
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)

_PARTS = {
    "yyyy": r"\d{4}",
    "MMMM": "(?:" + "|".join(MONTHS) + ")",
    "MMM": "(?:" + "|".join(name[:3] for name in MONTHS) + ")",
    "M": r"(?:0?[1-9]|1[0-2])",
    "d": r"(?:0?[1-9]|[12]\d|3[01])",
    "H": r"(?:[01]?\d|2[0-3])",
    "h": r"(?:0?[1-9]|1[0-2])",
    "m": r"[0-5]?\d",
    "s": r"[0-5]?\d",
    "SSSSSSSSS": r"\d{1,9}",
    "a": "[AP]M",
    "'T'": "T",
}


def _pattern_of(shape: str) -> re.Pattern:
    """A pattern for the cells of a shape, part by part."""
    parts = re.findall(r"'T'|([A-Za-z])(\1*)|(.)", shape)
    tokens = ["".join(part) or "'T'" for part in parts]
    return re.compile("".join(_PARTS.get(token, re.escape(token)) for token in tokens), re.ASCII | re.IGNORECASE)


_PATTERNS = {date + time: _pattern_of(date + time) for date in DATE_SHAPES for time in TIME_SHAPES}


def format_of(cell: str) -> str | None:
    """The format of a date cell, or None if it has no known shape."""
    return next((shape for shape, pattern in _PATTERNS.items() if pattern.fullmatch(cell)), None)

