"""Errors raised at plan-building time, and the codes that failure rows carry."""

from __future__ import annotations


class ItemTableError(ValueError):
    """A request that cannot be planned."""


class TableNotFound(ItemTableError):
    """No table is registered under the name."""


class ValidationError(ItemTableError):
    """The request does not fit the table (missing key, unbound name, bad type)."""


# Codes found in the `code` column of failure rows.
CONDITION_FAILED = "ConditionalCheckFailedException"
VALIDATION = "ValidationException"
