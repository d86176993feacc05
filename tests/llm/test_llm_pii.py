import hashlib
import random
import re

import numpy as np
import pytest
from llm_cases import clashing, frame, odd_rows

from stallwise.llm import pii, pii_model

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TEXTS = [
    "write to jo.do@mail.example.com or call +1 (625) 555-7196, host 78.118.65.158",
    "card 4337166598464399 and 4337 1665 9846 4399, not 4337166598464398, not 300.1.1.1",
    "+1 (208) 555-1177 4284896609045836", "a@b", "a@b.c@d.e", "Ä ä@ö.de 1.2.3.4.5.6.7.8", "9" * 5000 + ".1.2.3",
]


def by_definition(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p) < 4000 and int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def test_patterns_by_definition():
    pick = random.Random(1)
    made = ["".join(pick.choice(c) for _ in range(50)) for c in ("ab.@-_ é1", "12.. -", "+1 ()5.-2") for _ in range(500)]
    for text in TEXTS + made:
        assert pii.base_spans(text) == by_definition(text), text


def test_luhn():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")


def test_gradients_by_differences():
    pick = np.random.default_rng(0)
    tagger = pii_model.Tagger.new(4)
    tagger.weights = {k: v.astype(np.float64) for k, v in tagger.weights.items()}
    ids, mask, tags = pick.integers(1, 50, (7, 3)), np.ones((7, 3)), pick.integers(0, 9, (7, 3))
    mask[5:, 1] = mask[3:, 2] = 0
    _, grads = tagger.gradients(ids, mask, tags)
    for name, weight in tagger.weights.items():
        at = tuple(pick.integers(0, n) for n in weight.shape)
        at = (int(ids[0, 0]), at[1]) if name[0] == "w" else at
        value, sides = weight[at], []
        for step in (1e-5, -1e-5):
            weight[at] = value + step
            sides.append(tagger.gradients(ids, mask, tags)[0])
        weight[at] = value
        assert abs((sides[0] - sides[1]) / 2e-5 - grads[name][at]) < 2e-4


@pytest.fixture(scope="module")
def tagger():
    return pii_model.train(pii.labelled_windows(TEXTS))


def test_held_out_spans_are_found_and_nothing_else(tagger):
    held = [w for w in pii.labelled_windows(TEXTS, n=600, seed=77) if len(w[1]) <= 1]
    base = [pii.base_spans(text) for text, _ in held]
    added = pii.added_spans(tagger, [text for text, _ in held], base)
    hit = total = wrong = 0
    for (_, spans), b, a in zip(held, base, added):
        total += len(spans)
        hit += sum(s in b or s in a for s in spans)
        wrong += sum(s not in spans for s in a)
    assert hit / total > 0.85 and wrong / total < 0.03


@pytest.mark.parametrize("at, dot", [*pii.EMAIL_FORMS, ("[at]", "."), (" @ ", " dot ")])
def test_respelled_emails_without_digits_are_all_found(tagger, at, dot):
    names = ["jane.doe@example.com", "jane@example.com", "jane@mail.example.org", "anna_berg@uni-town.net", "a.b-c+d@e.f.org", "q" * 90 + "@" + "w" * 90 + ".com"]
    for name, domain in (n.split("@") for n in names):
        value = name + at + domain.replace(".", dot)
        for before, after in (("", ""), ("We met. Write to ", " for more."), ("the contact is ", ", or call"), ("Ask:\n", ". Then wait."), ("x " * 500, " x" * 500)):
            text = before + value + after
            assert pii.added_spans(tagger, [text], [pii.base_spans(text)])[0] == [(0, len(before), len(before) + len(value))], text


def test_prose_with_at_is_no_email_and_long_runs_are_linear(tagger):
    for text in ("He looked at home. Then he left.", "We met at noon. It was late", "at last", "She stayed at 3.5 percent"):
        assert pii.added_spans(tagger, [text], [[]])[0] == [], text
    for unit in ("at-", " at a", ". a", "at ", "a . ", " at a. b", "(at", " "):
        text = "x at y." + unit * 20_000
        assert all(0 <= a < b <= len(text) for a, b in pii.stretches(text))
        list(pii.spelled_emails(text, 0, len(text)))


def test_windows_are_reconciled(tagger):
    """A stretch of numbers much longer than a window: spans are found wherever they lie, and only once."""
    one = "reach 625.555.7196 or "
    text = "".join(f"{one}{i} " for i in range(60))
    spans = pii.added_spans(tagger, [text], [pii.base_spans(text)])[0]
    assert len(spans) == len(set(spans)) and all(a[2] <= b[1] for a, b in zip(sorted(spans), sorted(spans)[1:]))
    assert pii.stretches(text) == [(0, len(text))] and len(text) > 3 * pii.WINDOW


def test_rows(spark):
    rows = odd_rows() + [(100 + i, text) for i, text in enumerate(TEXTS)]
    got = {(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]): r["spans"] for r in pii.digests(pii.found_spans(clashing(frame(spark, rows)))).collect()}
    for i, text in rows:
        base = by_definition(text or "")
        joined = ",".join(pii.named(s) for s in base)
        counts = [sum(s[0] == k for s in base) for k in range(4)]
        spans = got[(i, *counts, hashlib.sha256(joined.encode()).hexdigest())]
        assert set(filter(None, joined.split(","))) <= set(spans.split(","))
    assert pii.found_spans(frame(spark, [])).collect() == []
