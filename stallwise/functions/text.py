"""Text expressions of the cleaning job.

All run inside generated code: lists are cleaned as text, with one pattern per
cell, instead of being split into arrays and put together again.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from stallwise import fixed_values as V

# The characters of V.BLANKS as ranges: those of plain ASCII text, and all.
_ASCII = r"\t-\r\x1c-\x20"
_ANY = _ASCII + r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# What a number looks like. A cast alone would also take 4.2f or 0x1p3.
_NUMBER = r"(?i)^[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?|inf(inity)?)$"


def strip(text: Column) -> Column:
    """Remove blanks of every kind from both ends."""
    return F.btrim(text, F.lit(V.BLANKS))


def missing_to_null(text: Column) -> Column:
    """Turn the texts that mean "missing" in a raw file into null."""
    return F.when(~text.isin(*V.MISSING_TOKENS), text)


def strip_or_null(text: Column) -> Column:
    """Strip; a cell that then reads "nan" is missing, a blank one is not."""
    return F.nullif(strip(text), F.lit(V.MISSING_AFTER_STRIP))


def _join_between(body: Column, pattern: str, glue: str) -> Column:
    """Put the glue wherever the pattern matches; %s in it stands for blanks.

    Plain ASCII text, known by its length in bytes, gets a pattern that tests
    far fewer characters.
    """
    plain = F.octet_length(body) == F.char_length(body)
    quick = F.regexp_replace(body, pattern.replace("%s", _ASCII), glue)
    return F.when(plain, quick).otherwise(F.regexp_replace(body, pattern.replace("%s", _ANY), glue))


def comma_list(text: Column) -> Column:
    """Stripped, non-empty items of a comma list joined by ", "; null when none is left."""
    body = F.btrim(text, F.lit(V.BLANKS + ","))
    joined = F.when(body.contains(","), _join_between(body, "[%s]*+,[%s,]*+", ", ")).otherwise(body)
    return F.nullif(joined, F.lit(""))


def first_item(joined: Column) -> Column:
    return F.substring_index(joined, ",", 1)


def item_count(joined: Column) -> Column:
    return F.length(joined) - F.length(F.replace(joined, F.lit(","), F.lit(""))) + 1


def lines_to_one(text: Column) -> Column:
    """Stripped, non-empty lines joined by " | "; null when nothing is left."""
    body = strip(text)
    broken = body.contains("\n") | body.contains("\r")
    # Blanks without line breaks, a line break, any blanks.
    joined = _join_between(body, "[%s&&[^\r\n]]*+[\r\n][%s]*+", " | ")
    return F.nullif(F.when(broken, joined).otherwise(body), F.lit(""))


def parse_number(stripped: Column) -> Column:
    """Stripped text to double; anything that is not a number becomes null."""
    return F.when(stripped.rlike(_NUMBER), stripped.try_cast("double"))


def count_body(text: Column) -> Column:
    """What is left of "100+ ratings" or "1.5K+ ratings" without its words: 100 or 1.5k."""
    body = F.lower(text)
    for word in ("ratings", "rating", "+"):
        body = F.replace(body, F.lit(word), F.lit(""))
    return F.when(text != V.TOO_FEW_RATINGS, body)


def count_digits(body: Column) -> Column:
    """The number of a count body as text; underscores may join two digits, as in 1_000."""
    digits = strip(F.replace(body, F.lit("k"), F.lit("")))
    joined = F.regexp_replace(digits, "(?<=[0-9])_(?=[0-9])", "")
    return F.when(digits.contains("_"), joined).otherwise(digits)


def first_digits(text: Column) -> Column:
    """First run of digits as a whole number; null when there is none."""
    return F.regexp_substr(text, F.lit("[0-9]+")).try_cast("long")
