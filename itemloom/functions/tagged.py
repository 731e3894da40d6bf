"""Attribute values written as one-key tags, ``{"S": "x"}``, for request parameters."""

from __future__ import annotations

import base64
from collections.abc import Mapping
from typing import Any

from ..errors import ValidationError

# The descriptors of attribute values.
DESCRIPTORS = ("S", "N", "BOOL", "B", "SS", "NS", "BS", "L", "M", "NULL")


def number(text: str) -> int | float:
    """Number of a tag: an integer when it fits 64 bits, else a double."""
    try:
        whole = int(text)
    except ValueError:
        value = float(text)
        if value != value or value in (float("inf"), float("-inf")):
            raise ValidationError(f"{text} is not a number that an item can hold") from None
        return value
    return whole if -(2**63) <= whole < 2**63 else float(whole)


def untag(value: Any) -> Any:
    """Native value of a tagged one; anything else is returned as it is."""
    if not (isinstance(value, Mapping) and len(value) == 1):
        return value
    tag, inner = next(iter(value.items()))
    if tag not in DESCRIPTORS:
        return value
    if tag == "N":
        return number(str(inner))
    if tag == "NULL":
        return None
    if tag == "B":
        return base64.b64decode(inner) if isinstance(inner, str) else inner
    if tag == "NS":
        return [number(str(v)) for v in dict.fromkeys(inner)]
    if tag == "SS":
        return list(dict.fromkeys(inner))
    if tag == "BS":
        return [base64.b64decode(v) if isinstance(v, str) else v for v in dict.fromkeys(inner)]
    if tag == "L":
        return [untag(v) for v in inner]
    if tag == "M":
        return {k: untag(v) for k, v in inner.items()}
    return inner
