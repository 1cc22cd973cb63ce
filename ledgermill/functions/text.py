"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.functions.bands import as_column


def blank_to_null(text: Column | str) -> Column:
    text = as_column(text)
    return F.when(F.length(text) > 0, text)


def gender_letter(text: Column | str) -> Column:
    """First letter in upper case; empty is NULL."""
    return F.upper(F.substring(blank_to_null(text), 1, 1))


def city_name(text: Column | str) -> Column:
    """Title case word by word; empty is NULL."""
    return F.initcap(F.lower(blank_to_null(text)))


def code_label(code: Column | str) -> Column:
    """``HOME_LOAN`` to ``Home Loan``."""
    return F.initcap(F.lower(F.replace(as_column(code), F.lit("_"), F.lit(" "))))


def prefixed_id(source_id: Column | str, prefix: str, missing: str = "UNKNOWN") -> Column:
    return F.concat(F.lit(prefix), F.coalesce(as_column(source_id), F.lit(missing)))


def account_id(customer_id: Column | str) -> Column:
    """``ACC_`` and the second part of the customer id, or the whole id."""
    key = as_column(customer_id)
    return F.concat(F.lit("ACC_"), F.coalesce(F.get(F.split(key, "_"), F.lit(1)), key))


def mapped(
    key: Column | str, table: Mapping[str, str], fallback: Column | None = None
) -> Column:
    """Look a code up in a small fixed table inside the row; no join is needed."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    found = F.try_element_at(F.create_map(*pairs), as_column(key))
    return found if fallback is None else F.coalesce(found, fallback)
