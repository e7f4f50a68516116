"""Text cleaning as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Unicode white space plus the four ASCII separators U+001C to U+001F.
SPACE_CLASS = r"[\s\x1c-\x1f]"
SPACES = rf"(?U){SPACE_CLASS}+"
LEADING_TOKEN = r"(?U)^([^\s\x1c-\x1f]+)"
OWNER_PUNCTUATION = r"""[.,'"]"""
SEPARATOR = " | "


def first_present(*values: Column) -> Column:
    """First value that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def normalize_spaces(value: Column) -> Column:
    """Collapse every run of white space to one blank and trim."""
    return F.trim(F.regexp_replace(value, SPACES, " "))


def join_owners(first: Column, second: Column) -> Column:
    """Both owner fields in source order, blanks skipped."""
    cleaned = [F.nullif(normalize_spaces(v), F.lit("")) for v in (first, second)]
    return F.concat_ws(SEPARATOR, *cleaned)


def normalize_owner(owner: Column) -> Column:
    """Upper-case owner key.

    Punctuation goes after the trim, so a blank it leaves behind stays: '. Smith' gives ' SMITH'.
    """
    bare = F.regexp_replace(normalize_spaces(F.upper(owner)), OWNER_PUNCTUATION, "")
    return F.regexp_replace(bare, SPACES, " ")


def address_number(address: Column) -> Column:
    """Leading token of an address."""
    return F.regexp_extract(address, LEADING_TOKEN, 1)


def residential_zoning(zoning: Column) -> Column:
    """True where the zoning code starts with R; only blanks are trimmed."""
    return F.upper(F.trim(zoning)).startswith("R")


def hashed_key(prefix: str, *ids: Column) -> Column:
    """Prefix plus the md5 of the ids joined by a colon."""
    return F.concat(F.lit(prefix), F.md5(F.concat_ws(":", *ids)))


def pair_label(left: Column, right: Column) -> Column:
    """Label of a pair that does not depend on the order of its members."""
    return F.concat_ws(SEPARATOR, F.least(left, right), F.greatest(left, right))
