"""Language identification: the Viterbi pass against a plain one, held-out accuracy, mixed and odd texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language as L

SCHEMA = "doc_id long, text string, lang string, lang_pred int, source string"


def plain_path(scores, switch):
    total, back = scores[0].astype(float), []
    for row in scores[1:]:
        ways = total[:, None] - switch * (1 - np.eye(len(total)))
        back.append(ways.argmax(axis=0))
        total = ways.max(axis=0) + row
    value, path = total.max(), [int(total.argmax())]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return value, path[::-1]


@pytest.mark.parametrize("k", [1, 2, 5])
def test_best_path(k):
    rng = np.random.default_rng(k)
    sizes = [0, 1, 63, 64, 65, 200, 0, 129]
    first = np.cumsum([0, *sizes])
    scores = rng.normal(size=(first[-1], k)).astype(np.float32) * 3
    got = L.best_path(scores, first, 2.0)
    for a, b in zip(first, first[1:]):
        if b > a:
            value, path = plain_path(scores[a:b], 2.0)
            own = got[a:b]
            total = scores[np.arange(a, b), own].sum() - 2.0 * np.count_nonzero(own[1:] != own[:-1])
            assert total == pytest.approx(value, abs=1e-2)


def test_empty_path():
    assert len(L.best_path(np.zeros((0, 3), np.float32), np.zeros(3, np.int64), 1.0)) == 0


def sentences(rng, words, n):
    return [" ".join(rng.choices(words, k=rng.randint(5, 30))) for _ in range(n)]


def corpus():
    rng = random.Random(1)
    english = "the and of that with this have from they would there their what about which".split()
    german = "der die und nicht eine werden über schön größe sich auch nach wird bei einer".split()
    russian = "и не на что это быть весь они как мы который свой для говорить время".split()
    rows = []
    for lang, words in (("en", english), ("de", german), ("ru", russian)):
        rows += [(len(rows) + i, t, lang, i, "s") for i, t in enumerate(sentences(rng, words, 60))]
    return rows, english, german, russian


def test_languages(spark):
    rows, english, german, russian = corpus()
    rng = random.Random(2)
    mixed = " ".join(rng.choices(english, k=40)) + "\n" + " ".join(rng.choices(german, k=80))
    extra = [(9001, None, "en", 0, ""), (9002, "", None, 0, ""), (9003, "12 34 !!", "de", 0, ""), (9004, mixed, None, 0, "")]
    extra += [(9005, " ".join(rng.choices(russian, k=5)), None, None, None), (None, "the " * 30000, None, 1, ""), (9004, mixed, None, 0, "")]
    df = spark.createDataFrame(rows + extra, SCHEMA).repartition(4)
    got = L.identify(df, F.coalesce(F.col("doc_id") % 4 != 2, F.lit(True)))
    assert got.columns == ["doc_id", "text", "lang", "source", "lang_pred", "lang_score", "lang_spans"]
    out = got.collect()
    right = [r.lang_pred == r.lang for r in out if r.doc_id is not None and r.doc_id < 9000 and r.doc_id % 4 == 2]
    assert len(right) > 40 and sum(right) / len(right) > 0.98
    by = {r.doc_id: r for r in out if r.doc_id is None or r.doc_id > 9000}
    assert [by[i].lang_pred for i in (9001, 9002, 9003, 9005, None)] == ["und", "und", "und", "ru", "en"]
    assert [by[i].lang_score for i in (9001, 9003, 9005)] == [0, 0, 1]
    assert [s.lang for s in by[9004].lang_spans] == ["en", "de"] and abs(by[9004].lang_spans[0].stop - 40) <= 2
    assert 0.5 < by[9004].lang_score < 1 and len(out) == len(rows) + len(extra)


def test_without_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert L.identify(df, F.lit(True)).collect() == []
    df = spark.createDataFrame([(1, "some text", None, 0, "")], SCHEMA)
    assert [(r.lang_pred, r.lang_score) for r in L.identify(df, F.lit(True)).collect()] == [("und", 0)]


def test_path_of_many_languages():
    rng = np.random.default_rng(7)
    first = np.cumsum([0, 0, 1, 70, 64, 0, 33])
    scores = rng.normal(size=(first[-1], L.PAIRS + 6)).astype(np.float32) * 3
    got = L.best_path(scores, first, 2.0)
    for a, b in zip(first, first[1:]):
        if b > a:
            own = got[a:b]
            total = scores[np.arange(a, b), own].sum() - 2.0 * np.count_nonzero(own[1:] != own[:-1])
            assert total == pytest.approx(plain_path(scores[a:b], 2.0)[0], abs=1e-2)


def test_more_languages_than_64(spark):
    """The rarest of 70 languages are learnt too."""
    rng = random.Random(5)
    words = {f"l{i:02}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)] for i in range(70)}
    rows = [(i, t, lang, 0, "") for i, lang in enumerate(words) for t in sentences(rng, words[lang], 4 if lang < "l64" else 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = L.identify(df, F.lit(True)).collect()
    assert len(out) == len(rows) and all(r.lang_pred == r.lang for r in out)


def test_sample_of_different_texts(spark, monkeypatch):
    """Copies do not take the places of other texts."""
    monkeypatch.setattr(L, "SAMPLE_ROWS", 20)
    rng = random.Random(6)
    texts = sentences(rng, [chr(97 + i) * 3 for i in range(26)], 100)
    rows = [(0, t, "en", 0, "") for t in texts] + [(1, t, "en", 0, "") for t in texts[:30] for _ in range(100)] + [(2, "a b c", "few", 0, "")] * 5
    languages, sample = L.sampled(spark.createDataFrame(rows, SCHEMA).select("lang", "text").repartition(4))
    got = [tuple(r) for r in sample.collect()]
    assert languages == ["en", "few"] and len(set(got)) == len(got) == 21


def brute_predictions(rows):
    """Prediction and score of every row by plain counts: trained on the rows with a language whose flag is set."""
    import math
    import unicodedata
    from collections import Counter

    def read(text):
        """Words as bytes, with their number of letters and their script."""
        out = []
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for word in lower.encode().split():
            scripts = Counter()
            for c in word.decode():
                if unicodedata.category(c)[0] == "L":
                    scripts[[name for start, name in L.RANGES if start <= ord(c)][-1]] += 1
            script = max(L.SCRIPTS, key=lambda s: (scripts[s], -L.SCRIPTS.index(s)))
            padded = b" " + word + b" "
            bins = [int.from_bytes(padded[i : i + 3], "big") * 0x9E3779B1 % 2**32 >> (32 - L.BIN_BITS) for i in range(len(word))]
            out.append((sum(scripts.values()), script, bins, scripts))
        return out

    languages = sorted({lang for _, _, lang, trains in rows if trains and lang})
    logs, foreign = {}, {}
    for lang in languages:
        counts, scripts = Counter(), Counter()
        for text in {text for _, text, own, trains in rows if trains and own == lang and text is not None}:
            for letters, script, bins, _ in read(text):
                if letters:
                    counts.update(bins)
                    scripts[script] += letters
        total = sum(counts.values()) + 0.5 * 2**L.BIN_BITS
        logs[lang] = lambda b, counts=counts, total=total: math.log((counts[b] + 0.5) / total)
        foreign[lang] = {s for s in L.SCRIPTS if scripts[s] < L.RARE * max(sum(scripts.values()), 1)}
    out = {}
    for i, text, *_ in rows:
        words = read(text)
        if not any(letters for letters, *_ in words):
            out[i] = ("und", 0.0)
            continue
        scores = np.array(
            [
                [sum(map(logs[lang], bins)) - L.FOREIGN * (script in foreign[lang]) if letters else 0.0 for lang in languages]
                for letters, script, bins, _ in words
            ]
        )
        share = Counter()
        for (letters, *_), label in zip(words, plain_path(scores, L.SWITCH)[1]):
            share[label] += letters
        best = max(share, key=lambda label: (share[label], -label))
        out[i] = (languages[best], share[best] / sum(share.values()))
    return out


def test_predictions_against_plain_counts(spark):
    """The whole operator: scores, scripts, spans and the vote of the letters."""
    rng = random.Random(5)
    corpus_rows, *words = corpus()
    rows = [(i, text, lang, i % 4 != 2) for i, text, lang, *_ in corpus_rows]
    for i in range(40):
        mixed = [w for part in rng.sample(words, 2) for w in rng.choices(part, k=rng.randint(1, 25))]
        rows.append((1000 + i, " ".join([*mixed, "12", "—", rng.choice(["日本", "x", "Ωμ"])]), None, False))
    rows += [(2000, None, "en", True), (2001, "12 --", "de", True), (2002, "", None, False)]
    want = brute_predictions(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, trains boolean").repartition(3)
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in L.identify(df, F.col("trains")).collect()}
    assert {i: p for i, (p, _) in got.items()} == {i: p for i, (p, _) in want.items()}
    assert all(got[i][1] == pytest.approx(want[i][1], abs=1e-6) for i in want)
