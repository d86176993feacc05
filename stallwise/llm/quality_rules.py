"""Quality rules, native: a table of thresholds, compiled into Spark columns.

A rule bounds the ratio of two measures of a text, in thousandths. All measures
and verdicts are column expressions over the text alone, so judging is one
narrow pass without a shuffle, and a rule that is added to the table is one more
comparison of whole numbers.

The only measure that needs work is the number of words in windows that a text
repeats. Window hashes that are all different prove that there is none, which is
the usual case; otherwise windows are sorted with their places, hash first, and
neighbours are compared by their whole words, so hashes decide nothing.

Defined cases: a null text counts as empty; a text without words has every count
0 and fails the
least number of words; a ratio to nothing holds; every input row is judged on
its own, so rows that repeat an id or have none get a row each; an empty table
gives no rows; extra columns are ignored.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common

#: White space between words, as a set of characters and as a pattern.
BLANKS = " \t\n\x0b\f\r"
BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
#: Taken off words before they are compared with the stop words.
PUNCTUATION = ".,;:!?\"'()"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

#: Frequent function words, by language.
STOP_WORDS = {
    "de": "der die das und ist von mit zu den in ein eine nicht auf für des im sich auch",
    "en": "the of and to in is that was for it with as on be at by this are from",
    "es": "el la los las de que y en un una es por con para del se no su al",
    "fr": "le la les de des et est un une dans que qui pour en du pas sur au avec",
}


@dataclass(frozen=True)
class Rule:
    """least <= 1000 * count / of <= most; a missing bound is no bound. Holds if `of` is below `fewest`: few say little."""

    name: str
    count: str
    of: str
    least: int | None = None
    most: int | None = None
    fewest: int = 1


#: Thresholds as usual for web text, in thousandths.
RULES = (
    Rule("word_length", "word_chars", "n_words", least=2_500, most=12_000),
    Rule("symbols", "n_symbols", "n_words", most=100),
    Rule("words_with_letters", "n_letter_words", "n_words", least=700, fewest=20),
    Rule("stop_words", "n_stop_words", "n_words", least=20, fewest=50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=300, fewest=10),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=900, fewest=10),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=300, fewest=10),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OTHER_MEASURES = ("n_lines", "n_letter_words", "n_stop_words", "n_bullet_lines", "n_ellipsis_lines")


def holds(rule: Rule) -> Column:
    count, of = 1000 * F.col(rule.count), F.col(rule.of)
    ok = F.lit(True)
    if rule.least is not None:
        ok = ok & (count >= rule.least * of)
    if rule.most is not None:
        ok = ok & (count <= rule.most * of)
    return ok | (of < rule.fewest)


def _chars_without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, "")).cast("long")


def _repeated_words(rows: DataFrame) -> DataFrame:
    """n_repeat_words: how many words lie in a window of WINDOW words that occurs at least twice in the text.

    Every step is a column of its own, because a step that looks at its
    neighbours must not be computed again for each of them.
    """
    words = F.col("_words")

    def window(i: Column) -> list[Column]:
        return [F.get(words, i + k) for k in range(WINDOW)]

    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("_hashes", F.transform(starts, lambda i: F.xxhash64(*window(i))))
    placed = F.transform(
        F.col("_hashes"), lambda h, i: F.struct(h.alias("h"), F.concat_ws(" ", *window(i)).alias("window"), i.alias("i"))
    )
    none = F.array().cast("array<struct<h:bigint,window:string,i:int>>")
    different = F.size(F.array_distinct("_hashes")) == F.size("_hashes")
    rows = rows.withColumn("_sorted", F.when(different, none).otherwise(F.sort_array(placed)))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["h"] == y["h"]) & (x["window"] == y["window"]), F.lit(False))

    def repeated(x: Column, k: Column) -> Column:
        around = F.col("_sorted")
        return same(x, F.get(around, k - 1)) | same(x, F.get(around, k + 1))

    rows = rows.withColumn("_places", F.sort_array(F.transform(F.filter("_sorted", repeated), lambda x: x["i"])))
    own = F.transform(
        "_places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), k + 1) - p, F.lit(WINDOW))).cast("long")
    )
    total = F.aggregate(own, F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.withColumn("n_repeat_words", total).drop("_hashes", "_sorted", "_places")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stop_words: Sequence[str] | None = None) -> DataFrame:
    """doc_id, text and all measures of each row."""
    stops = stop_words if stop_words is not None else sorted({w for some in STOP_WORDS.values() for w in some.split()})
    text = F.col("text")
    rows = common.text_rows(docs, id_col, text_col)
    found = F.filter(F.split(text, BLANK + "+"), lambda w: w != "")
    plain = F.split(F.translate(common.lower_az(text), PUNCTUATION, ""), BLANK + "+")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns({"_words": found, "_lines": lines, "_plain": plain})

    def many(items: str, which) -> Column:
        return F.size(F.filter(F.col(items), which)).cast("long")

    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": _chars_without(text, BLANKS),
            "n_symbols": F.char_length(text).cast("long") - _chars_without(text, SYMBOLS),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_letter_words": many("_words", lambda w: w.rlike(r"[A-Za-z\x{80}-\x{10FFFF}]")),
            "n_stop_words": many("_plain", lambda w: w.isin(*stops)),
            "n_bullet_lines": many("_lines", lambda line: line.rlike(rf"^{BLANK}*[-*•]")),
            "n_ellipsis_lines": many("_lines", lambda line: line.rlike(rf"(\.\.\.|…){BLANK}*\z")),
        }
    )
    # As a generated row, measures are computed once: a filter on one is not rewritten into a filter on the text.
    measures = F.struct(*MEASURES, *OTHER_MEASURES)
    return _repeated_words(rows).select("doc_id", "text", F.inline(F.array(measures)))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per input row: doc_id, the measures, base_failed, kept, and the names of the rules that failed."""
    rows = measured(docs, id_col, text_col)
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    kept = ~base_failed
    for rule in rules:
        kept = kept & holds(rule)
    failed = F.concat_ws(",", *[F.when(~holds(rule), F.lit(rule.name)) for rule in rules])
    return rows.select(
        "doc_id", *MEASURES, base_failed.alias("base_failed"), kept.alias("kept"), *OTHER_MEASURES, failed.alias("failed_rules")
    )


def drop_failing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that pass; the columns stay as they are. An id stays if any of its rows does."""
    return common.drop_rows(docs, judged(docs, id_col, text_col, rules).select("doc_id", "kept"), id_col)
