"""ANSI-safe parsing of listing text: whatever cannot be read becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


FIRST_NUMBER = r"[0-9][0-9,]*(?:\.[0-9]+)?"


def clean_price(text: Column, mode: str = "decimal") -> Column:
    """``₹1,234`` → 1234 as BIGINT.

    ``decimal`` takes the first number, with its thousands commas and its fraction, and rounds half up to whole
    units, so ``Rs.1,200`` reads 1200; ``digits`` drops every non-digit including the point, so ``₹12.50`` reads
    1250. A number beyond BIGINT is NULL.
    """
    if mode == "digits":
        return F.regexp_replace(text, r"\D+", "").try_cast("bigint")
    if mode != "decimal":
        raise ValueError(f"unknown price mode {mode!r}")
    number = F.regexp_replace(F.regexp_extract(text, FIRST_NUMBER, 0), ",", "")
    return F.round(number.try_cast("decimal(38,10)"), 0).try_cast("bigint")


def clean_rating(text: Column) -> Column:
    return text.try_cast("double")


def clean_count(text: Column) -> Column:
    """``8,442`` → 8442."""
    return F.regexp_replace(text, ",", "").try_cast("bigint")


def first_word(text: Column) -> Column:
    return F.get(F.split(text, " "), 0)


def email_address(name: Column, number: Column, domain: Column) -> Column:
    """``first_123@domain``; NULL when any part is NULL."""
    return F.concat(first_word(name), F.lit("_"), number.cast("string"), F.lit("@"), domain)


PACK_SEPARATOR = " - "


def pack_fields(*fields: Column) -> Column:
    return F.concat_ws(PACK_SEPARATOR, *fields)


def unpack_field(packed: Column, position: int) -> Column:
    """Field ``position`` (from 0) of a packed text; NULL when there is none."""
    return F.get(F.split(packed, PACK_SEPARATOR), position)
