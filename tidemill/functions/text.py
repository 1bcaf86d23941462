"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (plain ``trim`` knows blanks only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def digits_only(text: Column) -> Column:
    """Keep decimal digits of any script; null becomes the empty text."""
    return F.coalesce(F.regexp_replace(text, r"[^\p{Nd}]", ""), F.lit(""))


def ascii_digits_only(text: Column) -> Column:
    """Keep 0-9; null becomes the empty text."""
    return F.coalesce(F.regexp_replace(text, "[^0-9]", ""), F.lit(""))


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` starts words at blanks only, so texts with other separators are cut into runs first.
    """
    runs = F.regexp_extract_all(text, F.lit(f"([{CASED}]+|[^{CASED}]+)"), F.lit(1))
    return F.when(text.rlike(f"^[{CASED} ]*$"), F.initcap(text)).otherwise(
        F.array_join(F.transform(runs, F.initcap), "")
    )


def has_text(text: Column) -> Column:
    return F.length(text) > 0


def dotted_part(text: Column, from_end: int, more_than: int = 1) -> Column:
    """The n-th last part of a dotted name, null when there are not more than ``more_than`` parts."""
    parts = F.split(text, r"\.")
    return F.when(F.size(parts) > more_than, F.try_element_at(parts, F.lit(-from_end)))
