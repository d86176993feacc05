"""Personal data: published patterns, and a tagger for what is written around them.

The base finds email addresses, IP addresses, card numbers and phone numbers by
fixed patterns with checks. The tagger (`pii_model`) adds spans in other
spellings: `name (at) mail dot example dot com`, `10[.]1[.]2[.]3`, cards with
dots, phones without a plus. It is trained on labelled spans: base spans of a
bounded sample of documents in their surroundings, the same spans respelled, and
surroundings with numbers that are nothing of the kind.

Every span that can pass the checks has a digit or an @ in it, or is a name, a
spelled-out at and a domain. The tagger reads these, whatever their length, and
the text within `CONTEXT` characters of them, wherever they are in the text.
Stretches longer than a window are read in overlapping windows; each character's
scores are the mean of its windows', weighted towards their middles, and one
CRF pass over the whole stretch decides, so no span is cut where windows meet.
Emails are judged whole: the scores of a name, an at and a domain as one span are
held against those of plain text; an at in brackets, or a domain without spaced
full stops that ends in one of `TOP`, is one without question.
An added span has to pass the checks of its kind in its plain spelling and may
not overlap a base span.

Defined cases: null and empty texts have no spans; positions are code points,
ends are exclusive; without any sample the tagger is trained on the templates
alone; every input row gives one, also those that repeat an id or have none; an
empty table gives no rows; extra columns are ignored.
"""

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common, pii_model
from stallwise.llm.pii_model import KINDS

#: Documents that the labelled windows are cut from, and how large they may be.
SAMPLE, MOST_BYTES = 1_200, 65_536
CONTEXT, WINDOW, STRIDE = 40, 192, 96

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_DOT = r"(?:\s*+[\[({<]\s*+(?:[dD][oO][tT]|\.)\s*+[\])}>]\s*+|\s++[dD][oO][tT]\s++|\s*+\.\s*+)"
#: An @ in any spelling that `plausible` takes with the domain behind it; a digit, a single @, a spelled-out dot.
_TRIGGERS = re.compile(
    r"(?P<at>@|(?<=[\s\[({<])[aA][tT](?=[\s\])}>]))\s*+(?:[\])}>]\s*+)?+[A-Za-z0-9-]++"
    rf"(?:{_DOT}[A-Za-z0-9-]++)++"
    r"|[0-9@]|(?<![A-Za-z0-9])[dD][oO][tT](?![A-Za-z0-9])"
)
#: The name before a spelled at, read backwards.
_NAME = re.compile(r"[\s\[({<]*+(?:[A-Za-z0-9_%+-]++|\s*+[\])}>]\s*+(?:[tT][oO][dD]|\.)\s*+[\[({<]\s*+|\s++[tT][oO][dD]\s++|\s*+\.\s*+)*+")
#: A full stop with a space may as well end a sentence.
_STOP = re.compile(r"(?:\s+\.\s*|\.\s+)(?=[A-Za-z0-9_%+-])")
_LABEL = re.compile(r"[A-Za-z0-9-]+\Z")
#: Ends of domains that make a spelled email of any name, at and domain.
TOP = frozenset("com org net edu gov mil int info biz io co eu de uk us fr es nl be ch se dk fi pl cz ru ua jp cn kr br mx au nz ca za ie pt gr hu ro tr il sg hk tw".split())
_CLOSED = re.compile(r"\s*[\])}>]")
_DOT_MARKS = " \t\n\r\f\v\xa0[](){}<>.dotDOT"
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def is_card(text: str) -> bool:
    digits = _NOT_DIGIT.sub("", text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= len(_NOT_DIGIT.sub("", text)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the published pattern, found from each @ outwards: long words without an @ cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start."""
    if not _ANY.search(text):
        return []
    out = [(0, *span) for span in emails(text)]
    for kind, pattern, fits in ((1, _IP, is_ip), (2, _CARD, is_card), (3, _PHONE, is_phone)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if fits(m[0])]
    return out


_SPELLED_AT = re.compile(r"\s*[\[({<]\s*at\s*[\])}>]\s*|\s+at\s+|\s*@\s*", re.I)
_SPELLED_DOT = re.compile(r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+|\s*\.\s*", re.I)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def plausible(kind: int, text: str) -> bool:
    """Whether a respelled span is one of its kind in the plain spelling."""
    if kind == 0:
        return bool(_EMAIL.fullmatch(_SPELLED_DOT.sub(".", _SPELLED_AT.sub("@", text, count=1))))
    if kind == 1:
        plain = _SPELLED_DOT.sub(".", text)
        return bool(re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", plain)) and is_ip(plain)
    if kind == 2:
        return bool(re.fullmatch(r"[0-9][0-9 .\-_/]+[0-9]", text)) and is_card(text)
    return bool(re.fullmatch(r"[+(]?[0-9][0-9 ().\-/]+[0-9]", text)) and is_phone(text)


# Labelled windows

EMAIL_FORMS = [(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" AT ", " DOT "), (" [at] ", "."), (" at ", "."), ("(at)", ".")]
BEFORE = ["", "of the and ", "write to ", "the address is ", "please ask ", "He said: ", "mail me:\n", "or reach ", "is from "]
AFTER = ["", " in that.", " for more.", ", or call", " is where he was", "\nthanks", " and the rest", ". It was then", ") with all"]


def respelled(kind: int, text: str, random: np.random.Generator) -> str:
    """The same value in another spelling."""
    if kind == 0:
        at, dot = EMAIL_FORMS[random.integers(len(EMAIL_FORMS))]
        name, domain = text.split("@", 1)
        return name + at + domain.replace(".", dot)
    if kind == 1:
        return text.replace(".", ["[.]", " . ", " dot ", "(.)", "[dot]"][random.integers(5)])
    digits = _NOT_DIGIT.sub("", text)
    if kind == 2:
        mark = [".", "_", "/", " - ", "  "][random.integers(5)]
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    number = digits[-10:]
    forms = [f"({number[:3]}) {number[3:6]}-{number[6:]}", f"{number[:3]}-{number[3:6]}-{number[6:]}", f"{number[:3]}.{number[3:6]}.{number[6:]}", f"001 {number[:3]} {number[3:6]} {number[6:]}", f"1-{number[:3]}-{number[3:6]}-{number[6:]}"]
    return forms[random.integers(5)]


def _invented(kind: int, random: np.random.Generator) -> str:
    """A value of a kind."""
    number = lambda n: "".join(map(str, random.integers(0, 10, n)))
    if kind == 0:
        word = lambda a, b: "".join(common.LOWER[i] for i in random.integers(0, 26, random.integers(a, b)))
        return f"{word(3, 9)}{['', '.', '_'][random.integers(3)]}{word(2, 6)}{number(random.integers(0, 3))}@{word(3, 8)}.{['com', 'org', 'net', 'example.com'][random.integers(4)]}"
    if kind == 1:
        return ".".join(str(x) for x in random.integers(1, 256, 4))
    if kind == 2:
        head = "4" + number(14)
        return next(head + str(d) for d in range(10) if luhn(head + str(d)))
    return f"+1 ({random.integers(200, 999)}) 555-{number(4)}"


def _number(random: np.random.Generator) -> str:
    """A number, or words around an at, that are no personal data."""
    if random.random() < 0.12:
        one, place, next_one = ("".join(common.LOWER[i] for i in random.integers(0, 26, random.integers(2, 9))) for _ in range(3))
        return f"{one} at {place}" + [". " + next_one.title(), ". " + next_one, " " + next_one, ", " + next_one][random.integers(4)]
    digits = "".join(map(str, random.integers(0, 10, 24)))
    forms = [digits[:4], digits[:2] + "." + digits[2:4], "19" + digits[:2], digits[:3] + "," + digits[3:6], digits[:7], "v" + digits[0] + "." + digits[1] + "." + digits[2], digits[:24], f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", f"{digits[:2]}:{digits[2:4]}", "#" + digits[:6], "$" + digits[:5] + ".00", digits[:2] + "%"]
    return forms[random.integers(len(forms))]


def labelled_windows(texts: Sequence[str], n: int = 2000, seed: int = 5) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Windows with labelled spans: base spans where they stand, respelled ones, and other numbers."""
    random = np.random.default_rng(seed)
    plain = [" ".join(t.split()) for t in texts] or ["the and of to in a is that it for was on as with by at from"]
    pick = lambda: plain[random.integers(len(plain))]
    out: list[tuple[str, list[tuple[int, int, int]]]] = []
    found = [(t, s) for t in texts for s in base_spans(t)]
    for text, span in [found[i] for i in random.permutation(len(found))[: n // 3]]:
        start, end = max(0, span[1] - int(random.integers(5, 60))), min(len(text), span[2] + int(random.integers(5, 60)))
        whole = [(k, a - start, b - start) for k, a, b in base_spans(text) if a >= start and b <= end]
        free = sorted(whole, key=lambda s: (s[1], -s[2]))
        kept = [s for i, s in enumerate(free) if all(s[1] >= o[2] for o in free[:i])]
        if not any(a < start < b or a < end < b for _, a, b in base_spans(text)):
            out.append((text[start:end], kept))
    while len(out) < n:
        source = pick()
        at = int(random.integers(0, max(1, len(source) - 120)))
        before, after = source[at : at + int(random.integers(0, 50))], source[at + 60 : at + 60 + int(random.integers(0, 50))]
        if random.random() < 0.3 or any(_ANY.search(x) for x in (before, after)):
            before, after = BEFORE[random.integers(len(BEFORE))], AFTER[random.integers(len(AFTER))]
        kind = int(random.integers(6))
        if kind > 3:
            value, spans = _number(random), []
        else:
            value = _invented(kind, random)
            value = respelled(kind, value, random) if random.random() < 0.8 else value
            spans = [(kind, 0, len(value))]
        lead = before + (" " if before and not before.endswith(" ") else "")
        out.append((lead + value + [" ", ". ", ", ", ""][random.integers(4) if not after else random.integers(3)] + after, [(k, a + len(lead), b + len(lead)) for k, a, b in spans]))
    return out


# Decoding


def name_start(text: str, at: int) -> int:
    """Where the name that stands before a spelled at begins."""
    reach = 64
    while True:
        low = max(0, at - reach)
        start = at - _NAME.match(text[low:at][::-1]).end()
        # What is left could be the end of a spelled-out dot that the cut at `low` hides.
        if not low or text[low:start].strip(_DOT_MARKS):
            return start
        reach *= 4


def stretches(text: str) -> list[tuple[int, int]]:
    """Where the tagger reads: spelled emails, digits, @ and spelled-out dots with their surroundings."""
    lowered = "" if _ANY.search(text) else text.lower()
    if lowered and "at" not in lowered and "dot" not in lowered:
        return []
    out: list[tuple[int, int]] = []
    for m in _TRIGGERS.finditer(text):
        start = name_start(text, m.start()) if m["at"] else m.start()
        start, end = max(0, start - CONTEXT), min(len(text), m.end() + CONTEXT)
        while out and start <= out[-1][1]:
            start = min(start, out.pop()[0])
        out.append((start, end))
    return out


def spelled_emails(text: str, start: int, end: int) -> Iterator[tuple[list[int], list[int], bool]]:
    """Where each name, at and domain between the two places may start and may end, and whether it can be nothing else."""
    for m in _TRIGGERS.finditer(text, start, end):
        if m["at"]:
            name = name_start(text, m.start())
            while text[name] not in _LOCAL and name < m.start():
                name += 1
            ends = [*(x.start() for x in _STOP.finditer(text, m.end("at"), m.end())), m.end()]
            if len(ends) > 1 and not re.search(_DOT, text[m.end("at") : ends[0]]):
                del ends[0]  # a domain has two parts
            sure = m["at"] != "@" and bool(_CLOSED.match(text, m.end("at")))
            if not _STOP.search(text, m.end("at"), ends[0]) and _LABEL.search(text, m.end("at"), ends[0])[0].lower() in TOP:
                ends, sure = ends[:1], True
            yield [name, *(x.end() for x in _STOP.finditer(text, name, m.start()))], ends, sure


def judged_emails(tagger: pii_model.Tagger, scores: np.ndarray, text: str, start: int) -> list[tuple[int, int, int]]:
    """The spelled emails of a stretch, each as a whole: the sure ones, and of the others what the tagger's scores take for one."""
    moves, first = tagger.weights["moves"], tagger.weights["first"]
    gain = np.concatenate([[0.0], np.cumsum(scores[:, 2] - scores[:, 0] + moves[2, 2] - moves[0, 0], dtype=np.float64)])
    out: list[tuple[int, int, int]] = []
    for starts, ends, sure in spelled_emails(text, start, start + len(scores)):
        def opening(a: int) -> float:
            entry = moves[0, 1] if a else first[1] - first[0] + moves[0, 0]
            return gain[a] + scores[a, 2] - scores[a, 1] - entry - moves[1, 2] + 2 * moves[2, 2]

        def closing(b: int) -> float:
            return gain[b] + (moves[2, 0] - moves[0, 0] if b < len(scores) else 0.0)

        a, b = min((x - start for x in starts), key=opening), max((x - start for x in ends), key=closing)
        if sure or closing(b) > opening(a):
            out.append((0, a + start, b + start))
    return out


def added_spans(tagger: pii_model.Tagger, texts: Sequence[str], base: Sequence[list[tuple[int, int, int]]], batch: int = 256) -> list[list[tuple[int, int, int]]]:
    """The spans that the tagger adds to each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    work: list[tuple[int, int, int, int]] = []  # text, stretch, window
    places: list[tuple[int, int, int]] = []
    for i, text in enumerate(texts):
        for start, end in stretches(text):
            places.append((i, start, end))
            last = max(start, end - WINDOW)
            begins = [*range(start, last, STRIDE), last]
            work += [(len(places) - 1, i, a, min(end, a + WINDOW)) for a in begins]
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    waiting: list[int] = []
    for at in range(0, len(work), batch):
        own = work[at : at + batch]
        scores = tagger.emissions(*pii_model.windows_of([pii_model.classes(texts[i][a:b]) for _, i, a, b in own]))[0]
        for k, (place, i, a, b) in enumerate(own):
            _, start, end = places[place]
            if place not in sums:
                sums[place] = np.zeros((end - start, pii_model.TAGS), np.float32), np.zeros((end - start, 1), np.float32)
                waiting.append(place)
            n = b - a
            weight = np.minimum(np.arange(1, n + 1), np.arange(n, 0, -1))[:, None].astype(np.float32)
            sums[place][0][a - start : b - start] += scores[:n, k] * weight
            sums[place][1][a - start : b - start] += weight
        # A stretch is decided as a whole once its last window has been read.
        finished = waiting if at + batch >= len(work) else [p for p in waiting if p < work[at + batch][0]]
        for place in finished:
            i, start, _ = places[place]
            total, weight = sums.pop(place)
            total /= weight
            spelled = judged_emails(tagger, total, texts[i], start)
            decoded = [(kind, a + start, b + start) for kind, a, b in pii_model.spans_of(tagger.decode(total))]
            for span in spelled + [s for s in decoded if all(s[2] <= x or y <= s[1] for _, x, y in spelled)]:
                kind = span[0]
                if plausible(kind, texts[i][span[1] : span[2]]) and all(span[2] <= x or y <= span[1] for _, x, y in base[i]):
                    out[i].append(span)
        waiting = [p for p in waiting if p in sums]
    return out


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Broadcast:
    """The tagger, sent to the executors (under 100 KB), from a bounded sample by the order of a hash."""
    rows = common.text_rows(docs, id_col, text_col).filter((F.octet_length("text") <= MOST_BYTES) & F.col("text").rlike("[0-9@]"))
    chosen = common.bounded_sample(rows, ["doc_id", "text"], sample).collect()
    tagger = pii_model.train(labelled_windows([r["text"] for r in chosen]))
    return docs.sparkSession.sparkContext.broadcast(tagger)


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per input row: doc_id, base (spans as kind:start:end, by kind and start), added (likewise)."""
    model = trained(docs, id_col, text_col, sample)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = batch.column("text").to_pylist()
                base = [base_spans(text) for text in texts]
                added = added_spans(model.value, texts, base)
                columns = [pa.array([[named(s) for s in sorted(own)] for own in side], pa.list_(pa.string())) for side in (base, added)]
                both = pa.array([[named(s) for s in sorted([*a, *b])] for a, b in zip(base, added)], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, both], names=["doc_id", "base", "added", "every"])

    kinds = "doc_id long, base array<string>, added array<string>, every array<string>"
    return common.text_rows(docs, id_col, text_col).mapInArrow(run, kinds)


def named(span: tuple[int, int, int]) -> str:
    return f"{KINDS[span[0]]}:{span[1]}:{span[2]}"


def digests(found: DataFrame) -> DataFrame:
    """The counts and digests of a `found_spans` result."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda span: span.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), F.array_join("every", ",").alias("spans"))
