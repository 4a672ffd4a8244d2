"""Text cleaning as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space, plus the four ASCII separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the accepted address pattern, ASCII only.
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"


def strip(c: Column) -> Column:
    """Trim every kind of white space; the one-argument ``trim`` removes spaces only."""
    return F.btrim(c, F.lit(WHITESPACE))


def standardized(c: Column) -> Column:
    return F.lower(strip(c))


def title_case(c: Column) -> Column:
    """Capital after anything that is not a letter (``t-shirt`` -> ``T-Shirt``).

    ``initcap`` only looks at spaces, so it serves the common case of letters and spaces; the
    rest is split into runs of letters and of other characters.
    """
    lowered = standardized(c)
    runs = F.regexp_extract_all(lowered, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    capitalised = F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.substring(run, F.lit(2), F.length(run)))),
        "",
    )
    return F.when(lowered.rlike(r"^[\p{L} ]*$"), F.initcap(lowered)).otherwise(capitalised)


def valid_email(c: Column) -> Column:
    """Trimmed and lower-cased address, or NULL when it does not look like one."""
    cleaned = standardized(c)
    return F.when(cleaned.rlike(EMAIL_PATTERN), cleaned)


def masked_tax_id(c: Column) -> Column:
    """Eleven digits as ``999.999.999-99``; anything else keeps its bare digits."""
    digits = F.regexp_replace(c, r"[^0-9]", "")
    return F.regexp_replace(digits, r"^(\d{3})(\d{3})(\d{3})(\d{2})$", "$1.$2.$3-$4")
