"""Quality rules: base counts and distances against plain Python, junk against prose."""

import math
import random
import re

from millrace.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, chars int, words string"


def base(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(ws) - 4):
        seen.setdefault(tuple(ws[i : i + 5]), []).append(i)
    covered = {j for places in seen.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def histograms(text, lang):
    text = text or ""
    classes = ["[A-Z]", "[0-9]", "[.,;:!?'\"()\\\\-]", r"[#$%&*+/<=>@\[\\\]^_`{|}~]", "[\x80-\U0010ffff]", r"[\x20\x09-\x0D]"]
    chars = [len(re.findall(c, text)) / max(len(text), 1) for c in classes]
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    common = [ws.count(w) / max(len(ws), 1) for w in Q.COMMON[lang]]
    return chars + [1 - sum(chars)], common + [1 - sum(common)]


def far(p, q):
    terms = lambda a, b: a * math.log2(2 * a / (a + b)) if a > 0 else 0
    return math.sqrt(max(0, sum(terms(a, b) + terms(b, a) for a, b in zip(p, q)) / 2))


def prose(rng, lang, n):
    rare = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(3, 9))) for _ in range(200)]
    return " ".join(rng.choice(Q.COMMON[lang] if rng.random() < 0.4 else rare) for _ in range(n)).capitalize() + "."


def made():
    rng = random.Random(1)
    rows = []
    for i in range(120):
        lang = rng.choice(list(Q.COMMON))
        lines = [prose(rng, lang, rng.randint(1, 60)) for _ in range(rng.randint(1, 6))]
        rows.append((i, "\n".join(lines + lines[: rng.randint(0, 1)]), lang, 1, "w"))
    junk = [" ".join(w.upper() + "!!" for w in prose(rng, "en", 200).split()), " ".join(w + "***" for w in prose(rng, "en", 200).split())]
    rows += [(200 + i, t, "en", 0, "") for i, t in enumerate(junk)]
    rows += [(300, None, "en", 0, ""), (301, "", None, None, None), (302, "a b " * 30_000, "xx", 0, ""), (None, rows[5][1], "en", 0, ""), rows[6]]
    rows += [(303, "one two three four\x0bfive\tsix seven\r\neight nine ten   eleven" + " x y z v w" * 2, "en", 0, "")]
    return rows


def test_verdicts(spark):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Q.judged(df).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(((r[0], *base(r[1])) for r in rows), key=repr)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        n, repeated = r.n_words, r.n_repeat_words
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert not (r.kept and r.base_failed)
        if not r.base_failed:
            assert r.kept == (r.doc_id not in (200, 201))
    featured = Q.with_features(df).cache()
    known = Q.references(featured)
    assert set(known) == set(Q.COMMON)
    for r in got:
        text = texts[r.doc_id]
        if r.n_words >= Q.MIN_WORDS and len(text) >= Q.MIN_CHARS:
            chars, words = histograms(text, r.reference)
            assert abs(far(chars, known[r.reference][0]) - r.char_distance) < 1e-6
            assert abs(far(words, known[r.reference][1]) - r.word_distance) < 1e-6
    left = Q.kept(df)
    assert left.schema == df.schema
    assert sorted(r.doc_id or -1 for r in left.collect()) == sorted(r.doc_id or -1 for r in got if r.kept)
    featured.unpersist()


def test_empty_table_and_unknown_language(spark):
    assert Q.judged(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "ten words are enough here when no reference is known", "xx", 0, ""), (2, "too few", "xx", 0, "")]
    assert {r.doc_id: r.kept for r in Q.judged(spark.createDataFrame(rows, SCHEMA)).collect()} == {1: True, 2: False}


def test_languages_without_written_words(spark):
    """Prose of other scripts is judged by its own references, junk of such a language is rejected."""
    rng = random.Random(3)
    common = "и в не на что он как это по но из у".split()
    rare = ["".join(rng.choice("абвгдежзиклмнопрст") for _ in range(rng.randint(3, 9))) for _ in range(300)]
    russian = lambda n: " ".join(rng.choice(common if rng.random() < 0.4 else rare) for _ in range(n)).capitalize() + "."
    chinese = lambda n: " ".join("".join(chr(rng.randint(0x4E00, 0x4F00)) for _ in range(6)) for _ in range(n))
    rows = [(i, russian(rng.randint(100, 300)), "ru", 1, "") for i in range(30)] + [(100 + i, chinese(150), "z'h", 1, "") for i in range(10)]
    rows += [(200 + i, prose(rng, "en", 200), "en", 1, "") for i in range(20)]
    rows += [(300, " ".join(w.upper() + "***" for w in prose(rng, "en", 200).split()), "ru", 0, ""), (301, russian(200), None, 1, "")]
    rows += [(302, russian(200), "none", 1, "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    learnt = Q.learnt_words(df.where("doc_id < 300"))
    assert set(learnt) == {"ru", "z'h"} and set(learnt["ru"]) == set(common)
    got = {r.doc_id: r for r in Q.judged(df).collect()}
    assert sorted(i for i, r in got.items() if not r.kept) == [300]
    assert {r.reference for i, r in got.items() if i < 100} == {"ru"} and got[100].reference == "z'h"
    left = Q.kept(df.withColumnsRenamed({"lang": "l", "text": "t"}), "t", "l")
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, r in got.items() if r.kept)
    # A document whose language has no reference has the base rules only.
    featured = Q.with_features(df)
    known = {"en": Q.references(featured)["en"]}
    assert [r.kept for r in Q.verdict(featured, known).where("doc_id in (301, 302)").select("_quality_verdict.kept").collect()] == [True, True]


def test_junk_of_medium_length(spark):
    """Menus of 1,000 to 2,000 characters beside prose of every length: all of it is kept, and none of them."""
    rng = random.Random(4)
    rows = [(i, prose(rng, "en", rng.randint(50, 500)), "en", 1, "") for i in range(400)]
    rows += [(1000 + i, " | ".join(prose(rng, "en", 3).lower().strip(".") for _ in range(rng.randint(70, 100))), "en", 0, "") for i in range(4)]
    got = Q.judged(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    junk = [r for r in got if r.doc_id >= 1000]
    assert not any(r.base_failed for r in got) and sorted(r.doc_id for r in got if r.kept) == list(range(400))
    texts = {r[0]: r[1] for r in rows}
    fixed = [r.char_distance / (Q.CHAR_LIMIT + Q.CHAR_SLACK / math.sqrt(len(texts[r.doc_id]))) for r in junk]
    assert max(fixed) < 1  # the limit that does not know the spread keeps them


def test_kept_leaves_columns_of_any_name_alone(spark):
    """Columns named like those the rules work with come out as they went in."""
    text = " ".join(f"word{i}" for i in range(30))
    names = "_quality_text string, _quality_kept long, _quality_features string, doc string, lang string, text string, b long"
    rows = [("x", 7, "f", "d", "en", text, 1), ("y", 8, None, None, None, None, 2), ("z", 9, "f", "d", "en", "too short", 3)]
    df = spark.createDataFrame(rows, names)
    got = Q.kept(df)
    assert got.schema == df.schema and [tuple(r) for r in got.collect()] == rows[:1]
