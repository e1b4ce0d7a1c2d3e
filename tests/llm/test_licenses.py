"""License scans against a plain search of phrases and notices."""

import random
import re

from millrace.llm import licenses as L

SCHEMA = "doc_id long, text string, words string, key int, n_words string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text):
    ws = words(text)
    places, labels = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(ws)) if ws[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def made():
    rng = random.Random(1)
    parts = ["MIT License", "gnu general-public LICENSE", "Apache\nlicense.", "cc by", "CC-BY", "mit", "license", "gnu general", "the", "É", "x" * 30, "apache apache license", "Kelvin", "ΜIT license", "0", ";"]
    rows = [(i, " ".join(rng.choices(parts, k=rng.randint(0, 25))), "w", 1, "n") for i in range(60)]
    rows += [(100, None, "", 0, ""), (101, "", None, None, None), (None, "mit license", "", 0, ""), rows[3], (102, "cc by " * 30_000, "", 0, "")]
    return rows


def test_base(spark):
    rows = made()
    got = L.scanned(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert [t for _, t in got.dtypes] == ["bigint"] * 5 + ["string", "string", "double"]
    got = got.collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(((r[0], *base(r[1])) for r in rows), key=repr)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert all((r.score > 0) == bool(r.labels) for r in got)


def template_words():
    out = [(f"notice {label}", label, words(text)) for label, text in L.NOTICES.items()]
    return out + [(f"statement {label}", label, words(text)) for label, text in L.STATEMENTS.items()]


def plain_spans(text):
    """Verified spans (label, first, stop, share), by loops over all places of all templates."""
    ws, spans = words(text), []
    for name, label, ts in template_words():
        triples = {}
        for at in range(len(ts) - 2):
            triples.setdefault(tuple(ts[at : at + 3]), []).append(at)
        lines = {}
        for place in range(len(ws) - 2):
            for at in triples.get(tuple(ws[place : place + 3]), ()):
                lines.setdefault(place - at, []).append((place, at))
        best = {}
        for hits in lines.values():
            run = []
            for hit in [*hits, None]:
                if run and (hit is None or hit[0] - run[-1][0] > L.GAP):
                    for place, at in run:
                        best[place] = min(best.get(place, (0, 0)), (-len(run), at))
                    run = []
                if hit:
                    run.append(hit)
        chain = []
        for place in [*sorted(best), None]:
            at = best[place][1] if place is not None else None
            if chain and (
                place is None
                or place - chain[-1][0] > L.GAP
                or at <= chain[-1][1]
                or abs((place - at) - (chain[-1][0] - chain[-1][1])) > L.NEAR
            ):
                spans.append((name, label, len(ts) - 2, chain))
                chain = []
            if place is not None:
                chain.append((place, at))
    out = []
    for k, (name, label, size, chain) in enumerate(spans):
        left = 0
        for place, _ in chain:
            rivals = [(-len(c), -len(c) / n, t, j) for j, (t, _, n, c) in enumerate(spans) if any(q == place for q, _ in c)]
            left += min(rivals)[3] == k
        need = max(-(-size * 3 // 10), min(size, L.VOTES))
        if left >= need and 2 * len(chain) >= chain[-1][1] - chain[0][1] + 1:
            out.append((label, chain[0][0], chain[-1][0] + 3, left / size))
    return out


def noise(rng, ts):
    """A template's words with some left out, doubled, moved, cut or mixed with others."""
    out = []
    for w in ts[rng.randrange(len(ts)) // 2 : len(ts) - rng.randrange(len(ts)) // 3]:
        roll = rng.random()
        if roll > 0.06:
            out.append(w)
        if roll > 0.96:
            out.append(rng.choice([w, "the", "software"]))
    return out


def test_labels_and_scores_against_loops(spark):
    rng = random.Random(4)
    rows = []
    for i in range(80):
        parts = [noise(rng, rng.choice(template_words())[2]) for _ in range(rng.randint(0, 3))]
        parts += [["use", "in", "source", "and"] * rng.randint(0, 9), "the following conditions are met the mit license".split()]
        rng.shuffle(parts)
        rows.append((i, " ".join(w for p in parts for w in [*p, *["filler"] * rng.choice([0, 2, 40])])))
    rows += [(None, rows[3][1]), (3, rows[3][1]), (4, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.labels, r.score) for r in L.scanned(df).collect()), key=repr)
    want = []
    for i, text in rows:
        found = plain_spans(text)
        labels = {label for label, *_ in found} | {x for x in base(text)[4].split(",") if x}
        score = 1.0 if base(text)[1] else max((share for *_, share in found), default=0.0)
        want.append((i, ",".join(sorted(labels)), score))
    want = sorted(want, key=repr)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(a[2] - b[2]) < 1e-12 for a, b in zip(got, want))
    assert len({r[1] for r in got}) > 6


def test_repeats_and_rivals(spark):
    """Repeating a phrase is no notice, and a notice has not the label of one that shares its beginning."""
    rows = [
        (1, "use in source and " * 8),
        (2, L.NOTICES["cc-by-nc"]),
        (3, L.NOTICES["cc-by"]),
        (4, L.STATEMENTS["cc-by-nc"]),
        (5, "this work is licensed under the creative commons " * 20),
        (6, L.NOTICES["mit"] + " " + L.NOTICES["mit"] + " and " + L.NOTICES["bsd"]),
    ]
    got = {r.doc_id: (r.labels, r.score) for r in L.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ("", 0.0) and got[2] == ("cc-by-nc", 1.0) and got[3] == ("cc-by", 1.0)
    assert got[4] == ("cc-by,cc-by-nc", 1.0) and got[5][0] == "" and got[6] == ("bsd,mit", 1.0)


def test_long_text_takes_time_in_proportion(spark):
    import time

    took = []
    for n in (10_000, 60_000):
        text = ("lorem ipsum dolor " * n) + L.NOTICES["mit"]
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        assert L.scanned(df).first().labels == "mit"
        took.append(time.perf_counter() - start)
    assert took[1] < 20 and took[1] < 12 * took[0]


def test_notices(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for i, (label, text) in enumerate(L.NOTICES.items()):
        ws = text.split()
        for k, edit in enumerate((0, 0.03)):  # whole, and with words left out
            kept = [w for w in ws if rng.random() >= edit]
            rows.append((10 * i + k, "some words before " * 9 + " ".join(kept) + " and words after it" * 5))
            want[10 * i + k] = label
    rows.append((999, "permission is hereby granted to use the software and to view a copy of this license " * 3))
    got = {r.doc_id: r for r in L.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(label in got[i].labels.split(",") for i, label in want.items())
    assert all(got[10 * i].score == 1 for i in range(len(L.NOTICES)))
    found = L.spans(L.votes(spark.createDataFrame(rows[:1], "doc_id long, text string"), L.key_of("doc_id", "text"))).where("not base").collect()
    assert [(s.label, s.first, s.stop) for s in found] == [("mit", 27, 27 + len(words(L.NOTICES["mit"])))]
    assert got[999].labels == ""


def test_empty_table(spark):
    assert L.scanned(spark.createDataFrame([], SCHEMA)).collect() == []
