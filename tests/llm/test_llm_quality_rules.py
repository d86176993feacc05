import random
import re
from collections import Counter

import pytest
from llm_cases import clashing, frame, odd_rows

from stallwise.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    plain = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(r"[.,;:!?\"'()]", "", text)))
    stops = {w for some in Q.STOP_WORDS.values() for w in some.split()}
    found = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in Q.SYMBOLS for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_letter_words": sum(bool(re.search("[A-Za-z\x80-\U0010ffff]", w)) for w in words), "n_stop_words": sum(w in stops for w in plain),
        "n_bullet_lines": sum(bool(re.match("[\x20\x09-\x0d]*[-*•]", line)) for line in lines),
        "n_ellipsis_lines": sum(bool(re.search("(\\.\\.\\.|…)[\x20\x09-\x0d]*\\Z", line)) for line in lines),
    }
    found["base_failed"] = found["n_words"] < 10 or 100 * found["n_repeat_words"] > 20 * found["n_words"]
    failed = []
    for rule in Q.RULES:
        count, of = found[rule.count], found[rule.of]
        least, most = rule.least if rule.least is not None else 0, rule.most if rule.most is not None else 10**9
        if of >= rule.fewest and not least * of <= 1000 * count <= most * of:
            failed.append(rule.name)
    return found | {"kept": not found["base_failed"] and not failed, "failed_rules": ",".join(failed)}


def check(spark, rows):
    got = sorted((tuple(sorted(r.asDict().items())) for r in Q.judged(clashing(frame(spark, rows))).collect()), key=repr)
    assert got == sorted((tuple(sorted((brute(text) | {"doc_id": i}).items())) for i, text in rows), key=repr)


def test_against_brute_force(spark):
    pick = random.Random(4)
    units = ["the", "Der", "une,", "word", "x1", "12", "#", "a$b", "été", "𝒜", "\x1c", "…", "•", "-", "and...", "(la)", "İ"]
    gaps = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", " \n- ", " ", " "]
    rows = []
    for i in range(250):
        words = [pick.choice(units[: pick.choice([3, 8, 17])]) for _ in range(pick.randrange(70))]
        text = "".join(w + (" " if pick.random() < 0.7 else pick.choice(gaps)) for w in words)
        rows.append((i, text * pick.choice([1, 1, 1, 2, 3])))
    check(spark, rows)


def test_defined_cases(spark):
    check(spark, odd_rows() + [(30, "the " * 20_000), (31, "a b c d e\n" * 3), (32, "...\n...\r\n… ")])
    assert Q.judged(frame(spark, [])).collect() == []


@pytest.mark.parametrize("count, of, holds", [(99, 1000, True), (100, 1000, True), (101, 1000, False), (5, 9, True), (1, 0, True)])
def test_bounds_are_inclusive_and_few_say_little(spark, count, of, holds):
    rule = Q.Rule("r", "a", "b", most=100, fewest=10)
    assert frame(spark, [(count, of)], "a long, b long").select(Q.holds(rule)).first()[0] is holds


def test_rules_are_an_argument_and_rows_stay_whole(spark):
    rows = clashing(frame(spark, [(1, "one two three four five six seven eight nine ten"), (2, "short"), (2, "ten " + "other " * 9), (None, None)]))
    kept = Q.drop_failing(rows, rules=[Q.Rule("stop", "n_stop_words", "n_words", least=1)])
    assert kept.columns == rows.columns and kept.count() == 0
    assert [r["doc_id"] for r in Q.drop_failing(rows, rules=[]).collect()] == [1]


def test_no_python_and_no_shuffle(spark):
    plan = Q.judged(frame(spark, odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    # A filter on a measure is not turned into a filter on the text, which would work the measure out twice.
    filtered = Q.judged(frame(spark, odd_rows())).filter("kept AND n_repeat_words = 0")._jdf.queryExecution().executedPlan().toString()
    assert filtered.count("array_distinct") == plan.count("array_distinct")
