import zlib

import numpy as np
import pyarrow.parquet as pq
from llm_cases import clashing, frame, odd_rows

from stallwise.llm import toxicity


def features(word):
    """Subsequences of three characters within the span, by definition."""
    codes = toxicity.codes([word])[0]
    out = {}
    for i in range(len(codes)):
        for j in range(i + 1, len(codes)):
            for k in range(j + 1, min(len(codes), i + toxicity.SPAN)):
                if codes[i] and codes[j] and codes[k]:
                    key = codes[i], codes[j], codes[k]
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
    return out


def test_kernel_by_definition():
    words = ["idiot", "id.iot", "aaaa", "x", "the", "wörter"]
    got = toxicity.kernel(words, words)
    for i, a in enumerate(map(features, words)):
        for j, b in enumerate(map(features, words)):
            norm = np.sqrt((sum(v * v for v in a.values()) + 1e-6) * (sum(v * v for v in b.values()) + 1e-6))
            assert abs(got[i, j] - sum(v * b.get(k, 0) for k, v in a.items()) / norm) < 1e-4


def test_folding_is_the_sum_over_landmarks():
    words, marks, beta = ["moron", "morning", "a"], ["moron", "clown", "more"], np.array([1.0, -0.5, 0.25])
    weights = np.zeros(toxicity._CODES**3, np.float32)
    for (numbers, values), b in zip(toxicity.feature_rows(marks), beta):
        np.add.at(weights, numbers, b * values)
    assert np.allclose(toxicity.folded_values(words, weights), toxicity.kernel(words, marks) @ beta, atol=1e-4)


def held_out_rows(folder):
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
    labels = pq.read_table(f"{folder}/labels.parquet").to_pylist()
    rows = [(r["doc_id"], docs[r["doc_id"]], r["toxic"]) for r in labels if r["toxic"] is not None]
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows]
    return [r[1:] for r, h in zip(rows, held) if not h], [r[1:] for r, h in zip(rows, held) if h]


def test_held_out_accuracy_and_inserted_characters():
    learned, held = held_out_rows("/root/testdata/sf0.1")
    model = toxicity.train(learned[:2500])
    scores = np.array(model.scores([t for t, _ in held], toxicity.Known()))
    truth = np.array([y for _, y in held])
    # Some of the labelled toxic rows of this small table hold no insult, so not all of them can be found.
    assert (scores[truth == 1] >= 0.5).mean() > 0.87 and (scores[truth == 0] < 0.5).mean() > 0.99
    clean, *bad = model.scores(["on the that of in", "on the idiot in", "on the id.iot in", "on i d i o t in", "on wor-thless in"], toxicity.Known())
    assert clean < 0.5 and all(s >= 0.5 for s in bad)
    split = ["on i  d \n i o\tt in", "on id iot in", "on the idi ot in", "the mo\nron was", "that stu pid was", "on wor thless in", "on id i ot in"]
    assert all(s >= 0.5 for s in model.scores(split, toxicity.Known()))


def test_defined_cases(spark):
    docs, labels = frame(spark, odd_rows()), frame(spark, [], "doc_id long, toxic int")
    rows = toxicity.scored(docs, labels).collect()
    assert len(rows) == len(odd_rows()) and all(r["predicted"] == 0 and 0 <= r["score"] <= 1 for r in rows)
    both = frame(spark, [(5, 0), (9, None), (11, 1), (4, 0), (7, 1)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(clashing(docs), both)
    assert kept.columns == clashing(docs).columns
    assert toxicity.scored(frame(spark, []), both).collect() == []


def test_white_space_of_any_length_is_skipped():
    assert "bad" in words("x so b  a \n\td\nok") and {"idiot", "badly"} <= toxicity.joined_of("id\n iot ba d ly".split())
    assert "badbehaviour" not in toxicity.joined_of(["bad", "behaviour"])


def words(text):
    return toxicity.words_of(text, text.split())


def test_bound_decides_like_the_values():
    rng = np.random.default_rng(0)
    weights = rng.normal(0.05, 0.2, toxicity._CODES**3).astype(np.float32)
    weights[0] = 0
    texts = ["".join(rng.choice(list("abcdefgh.-é9"), rng.integers(0, 20))) for _ in range(3000)]
    exact = toxicity.folded_values(texts, weights)
    for least in (0.0, 0.4, 1.5):
        assert np.allclose(toxicity.folded_values(texts, weights, least), np.where(exact >= least, exact, -np.inf))


def test_only_words_that_count_are_measured(monkeypatch):
    rng = np.random.default_rng(1)
    weights = rng.normal(0, 0.5, toxicity._CODES**3).astype(np.float32)
    weights[0] = 0
    model = toxicity.Model(weights, -2.6, rng.normal(0, 0.5, len(toxicity.LEVELS) + 6))
    some = ["".join(rng.choice(list("abcdefghi-."), rng.integers(1, 30))) for _ in range(4000)]
    texts = [" ".join(rng.choice(some, n)) for n in (400, 300, 250, 200, 12, 5, 4, 1, 0)] + ["a b c de fg", "a b c de fg " * 200, "--- ..."]
    wanted = []
    for split in map(str.split, texts):
        own = toxicity.words_of(" ".join(split), split)
        values = model.values(sorted(own)).tolist()
        wanted.append(toxicity.evidence([*values, *model.joined(sorted(toxicity.joined_of(split) - own)).values()], len(own)) @ model.document)
    measured, lengths = [], toxicity._lengths
    monkeypatch.setattr(toxicity, "_lengths", lambda shapes: measured.append(len(shapes[0][0])) or lengths(shapes))
    for known in (toxicity.Known(), toxicity.Known(most=3)):
        for _ in range(2):
            assert np.allclose(model.scores(texts, known), 1 / (1 + np.exp(-np.clip(wanted, -30, 30))), atol=1e-6)
    first = model.scores(texts[:1], toxicity.Known())
    measured.clear()
    assert model.scores(texts[:1], toxicity.Known()) == first and 0 < sum(measured) < len(set(texts[0].split())) / 2


def test_what_was_judged_is_bounded():
    model, known = toxicity.train([("you idiot one", 1), ("a fine day", 0)]), toxicity.Known(most=50)
    before = model.scores(["so you idiot", "fine"], toxicity.Known())
    for i in range(40):
        model.scores([f"w{i} x{i} y{i}"], known)
        assert len(known.words) <= 50 and len(known.judged) <= 50
    assert model.scores(["so you idiot", "fine"], known) == before


def test_words_are_cut_and_joined():
    assert "bad" in words("x so b a d\nok") and "bad" in words("b a d")
    assert all(len(p) <= toxicity.LONGEST for p in toxicity._parts("y" * 500)) and toxicity._parts("...") == [""]
