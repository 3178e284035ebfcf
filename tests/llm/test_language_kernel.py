"""The language classifier beside a brute-force version: presence of n-grams, kernel, Nyström features, ridge solution, predictions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.llm import language_id as lang

WORDS = {"en": "the of and ing tion was with", "de": "der und ein schön über nicht ung", "es": "el la que ción año los para"}


def texts(number, seed):
    rng = random.Random(seed)
    out = []
    for n in range(number):
        name = list(WORDS)[n % 3]
        out.append((name, " ".join(rng.choice(WORDS[name].split()) for _ in range(rng.randint(1, 40))).capitalize() + rng.choice(["", ".", " 12!"])))
    return out


def slots(text):
    """Slots of all byte n-grams of a text, one by one."""
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
    raw = bytes(c if c >= 0x80 or 97 <= c <= 122 else 0x20 for c in raw)
    found = set()
    for n in (2, 3, 4):
        for i in range(len(raw) - n + 1):
            code = sum(b << (8 * k) for k, b in enumerate(raw[i : i + n]))
            found.add((code * int(lang._FACTORS[n]) & 0xFFFFFFFF) >> (32 - lang.SLOT_BITS))
    return found


def bits(strings):
    raw = [s.encode() for s in strings]
    return lang.presence(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))


def test_presence():
    strings = [t for _, t in texts(30, 1)] + ["", "a", "ab", "É", "AB ab", "x" * 5000]
    for row, text in zip(bits(strings), strings, strict=True):
        assert set(np.flatnonzero(row).tolist()) == slots(text)


@pytest.fixture(scope="module")
def fitted():
    given = texts(90, 2)
    languages = sorted(WORDS)
    x, y = bits([t for _, t in given]), np.array([languages.index(n) for n, _ in given])
    return given, languages, x, y, lang.Classifier(languages, x, y, landmarks=24)


def brute_kernel(a, b):
    return len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1))


def test_kernel_and_features(fitted):
    given, languages, x, y, model = fitted
    marks = [t for n in languages for t in [t for name, t in given if name == n][:8]]
    own = [slots(t) for _, t in given]
    of_marks = [slots(t) for t in marks]
    want = np.array([[brute_kernel(a, b) for b in of_marks] for a in own])
    assert np.allclose(model.kernel(x), want, atol=1e-5)
    # features of Nyström: their products are the kernel seen through the landmarks
    k_mm = np.array([[brute_kernel(a, b) for b in of_marks] for a in of_marks])
    phi = want @ model.root
    assert np.allclose(phi @ phi.T, want @ np.linalg.pinv(k_mm, rcond=1e-6, hermitian=True) @ want.T, atol=1e-4)


def test_ridge_solution(fitted):
    given, languages, x, y, model = fitted
    phi = model.kernel(x).astype(np.float64) @ model.root
    weight = 1 / np.bincount(y)[y]
    targets = (y[:, None] == np.arange(len(languages))).astype(float)
    # least squares with the penalty as further rows
    penalty = np.sqrt(lang.RIDGE * len(languages) / len(x)) * np.eye(phi.shape[1])
    solved = np.linalg.lstsq(np.vstack([phi * np.sqrt(weight)[:, None], penalty]), np.vstack([targets * np.sqrt(weight)[:, None], np.zeros((phi.shape[1], 3))]), rcond=None)[0]
    assert np.allclose(model.scores(x), phi @ solved, atol=1e-3)


def test_predictions_by_brute_force(spark):
    given = [(n, t, name) for n, (name, t) in enumerate(texts(150, 3))] + [(900, None, "en"), (901, " 12 ", "de"), (902, "ohne label", None), (903, "", None)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string").repartition(3)
    learn = F.col("doc_id") % 4 != 2
    model = lang.fit(docs, learn)
    found = {r.row: (r.lang_pred, r.score) for r in lang.identified(docs, model).collect()}
    lettered = {d: t for d, t, _ in given if t and any(c.isalpha() for c in t)}
    assert {d for d, (name, _) in found.items() if name == "und"} == set(found) - set(lettered)
    marks = model.marks.T
    for doc_id, text in lettered.items():
        own = np.zeros(lang.SLOTS)
        own[list(slots(text))] = 1
        kernel = np.array([(own * m).sum() / np.sqrt(max(own.sum(), 1) * max(m.sum(), 1)) for m in marks])
        scores = kernel @ model.weights
        assert found[doc_id][1] == pytest.approx(min(max(scores.max(), 0), 1), abs=1e-4)
        best = sorted(scores)
        if best[-1] - best[-2] > 1e-3:
            assert found[doc_id][0] == model.languages[int(scores.argmax())]
