"""Text to typed values with defaults, and the rule each rejected value broke.

The functions take and give SQL text, to be used with `selectExpr` or `expr`; `text` is
an expression of type string. An absent or empty value is not a breach, it just takes
the default.
"""

from __future__ import annotations

from logsieve.schema import UINT_TYPES

WIDE = "DECIMAL(20,0)"
NO_ADDRESS = "0.0.0.0"

_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_LONG_INTEGER = r"^\s*[+-]?[0-9]{19,}\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"


def _matches(text: str, pattern: str) -> str:
    return f"{text} RLIKE r'{pattern}'"


def _unless_absent(text: str, fine: str, rule: str) -> str:
    return f"CASE WHEN {fine} OR {text} IS NULL OR {text} = '' THEN NULL ELSE {rule} END"


def whole(text: str, kind: str, wide: str = WIDE) -> str:
    """The whole number written in the text, else NULL. Padding and a sign are fine;
    fractions, exponents and hex are not whole numbers."""
    # try_cast already demands an optional sign and digits.
    small = f"try_cast({text} AS BIGINT)"
    if kind != "uint64" or wide.upper() == "BIGINT":
        return small
    # Only text too long for a bigint pays for the pattern and the decimal parse.
    return (
        f"coalesce(CAST({small} AS {WIDE}), "
        f"CASE WHEN {_matches(text, _LONG_INTEGER)} THEN try_cast(trim({text}) AS {WIDE}) END)"
    )


def _fits(number: str, kind: str, wide: str) -> str:
    limit = UINT_TYPES[kind][0]
    if kind == "uint64" and wide.upper() == "BIGINT":
        limit = 2**63 - 1
    return f"{number} BETWEEN 0 AND {limit}"


def stored_uint(number: str, kind: str, wide: str = WIDE) -> str:
    """A parsed number in the sink type of `kind`, 0 when it is NULL, negative or too
    large. `wide` is the type of 64-bit columns; with BIGINT the upper half of their
    range is too large."""
    sink = wide if kind == "uint64" else UINT_TYPES[kind][1]
    return f"CAST(CASE WHEN {_fits(number, kind, wide)} THEN {number} ELSE 0 END AS {sink})"


def uint_breach(text: str, number: str, kind: str, wide: str = WIDE) -> str:
    rule = f"CASE WHEN {_matches(text, _INTEGER)} THEN 'out_of_range' ELSE 'not_integer' END"
    return _unless_absent(text, f"coalesce({_fits(number, kind, wide)}, false)", rule)


def to_uint(text: str, kind: str, wide: str = WIDE) -> str:
    return stored_uint(whole(text, kind, wide), kind, wide)


def finite(text: str, sink: str = "FLOAT") -> str:
    """The number in decimal or exponent notation, else NULL; also NULL when it is
    beyond the sink type. Words such as ``nan`` and ``inf`` are not numbers."""
    number = f"try_cast({text} AS {sink})"
    return f"CASE WHEN {_matches(text, _NUMBER)} THEN {only_finite(number, sink)} END"


def only_finite(number: str, sink: str = "FLOAT") -> str:
    return f"CASE WHEN abs({number}) < CAST('infinity' AS {sink}) THEN {number} END"


def or_zero(number: str, sink: str = "FLOAT") -> str:
    return f"coalesce({number}, CAST(0 AS {sink}))"


def to_float(text: str, sink: str = "FLOAT") -> str:
    return or_zero(finite(text, sink), sink)


def float_breach(text: str, number: str) -> str:
    return _unless_absent(text, f"{number} IS NOT NULL", "'not_number'")


def to_ipv4(text: str) -> str:
    """Dotted quad, else the null address."""
    return f"CASE WHEN {_matches(text, _IPV4)} THEN {text} ELSE '{NO_ADDRESS}' END"


def ipv4_breach(text: str) -> str:
    return _unless_absent(text, f"coalesce({_matches(text, _IPV4)}, false)", "'not_ipv4'")
