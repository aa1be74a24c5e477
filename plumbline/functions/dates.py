"""Date format tokens."""

from __future__ import annotations

import re

# Warehouse date-format tokens and the Spark pattern letters for them.
FORMAT_TOKENS = {
    "YYYY": "yyyy",
    "YY": "yy",
    "MMMM": "MMMM",
    "MON": "MMM",
    "MM": "MM",
    "DD": "dd",
    "DY": "EEE",
    "HH24": "HH",
    "HH12": "hh",
    "AM": "a",
    "PM": "a",
    "MI": "mm",
    "SS": "ss",
}

_TOKEN = re.compile(
    "|".join(sorted(FORMAT_TOKENS, key=len, reverse=True))
    + r"|FF(?P<digits>\d)"
    + r'|"(?P<quoted>[^"]*)"'
    + r"|(?P<separator>T)(?=HH)",
    re.IGNORECASE,
)
# Upper-case years and days, hours of a kind, minutes and short months by name are no Spark
# letters, nor are mixed cases; nor is "mm" without any "M" a month in a Spark pattern.
_WAREHOUSE_ONLY = re.compile(
    r"YY|DD|Yy|yY|Dd|dD|Mm|mM|(?i:HH24|HH12|MI|MON)|^(?=.*mm)(?=.*[yd])(?!.*[ML])"
)


def spark_date_pattern(date_format: str) -> str:
    """``YYYY-MM-DD`` style formats, in any case, as Spark patterns; Spark patterns stay unchanged.

    A format is a Spark pattern if it can be one: ``yyyy-MM-dd`` is, ``yyyy-mm-dd`` would have
    minutes for months and is read as the other kind.
    """
    if not _WAREHOUSE_ONLY.search(date_format):
        return date_format
    return _TOKEN.sub(_spark_letters, date_format)


def _spark_letters(token: re.Match[str]) -> str:
    if token["digits"]:
        return "S" * int(token["digits"])
    literal = token["quoted"] or token["separator"]
    return f"'{literal}'" if literal else FORMAT_TOKENS[token[0].upper()]
