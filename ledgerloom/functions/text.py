"""Text clean-up."""

import sys

from pyspark.sql import functions as F

from ..constants import NULL_TOKENS

# Every code point Python strips: Spark's own trim takes only the space.
WHITESPACE = "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())

# A run of cased letters, or a run of anything else.
CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
WORDS = rf"([{CASED}]+|[^{CASED}]+)"


def null_tokens(col, tokens=NULL_TOKENS):
    """Null where the whole text is one of ``tokens``; no trimming first."""
    return F.when(~col.isin(list(tokens)), col)


def strip(col):
    """Drop white space of any kind from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col):
    return F.nullif(col, F.lit(""))


def title_case(col):
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` alone starts words at spaces only; here ``t-light 85cm`` must
    become ``T-Light 85Cm``.
    """
    words = F.regexp_extract_all(col, F.lit(WORDS), F.lit(1))
    return F.array_join(F.transform(words, F.initcap), "")
