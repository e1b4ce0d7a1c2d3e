"""Quality rules: divergence of a document's histograms from language references, in DataFrame functions only.

Each document gets two histograms: its characters by class, and its words by the most common words of each language
(and all others). The references are the shares of the same bins over all documents of a language that do not fail
the base rules; they are a few numbers per language, taken from the whole corpus. Every value of the language column
has a reference: the common words of the languages of ``COMMON`` are written there, those of any other language are
the words that are in most of its documents. A document is kept if for its own language or one of ``COMMON`` the
Jensen-Shannon distances (square root of the divergence in bits, 0 to 1) of both histograms are within limits. The limit of the characters follows from the distances of all documents of a language by their length: its
median and what they deviate from that, times the square root of the length. Minimum lengths guard short texts, whose histograms say little: below ``MIN_CHARS`` characters or
``MIN_WORDS`` words the one or the other distance is not judged.

Everything is computed within the row; the only exchanges are the sum of the histograms by language and, for languages
that are not in ``COMMON``, the count of documents by language and word.

Defined results: null text is empty and fails the base rules, as does any text of fewer than 10 words; only the
base rules decide on a document without a language, or whose language has no document that passes them (the nearest
reference is still reported, if there is one); rows with equal or null ids are documents like any other;
columns of ``docs`` stay, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.chunks import stored

#: Limit of the characters' distance for long texts, and what a text of n characters has more, times sqrt(n), while the
#: references are learnt: shares of few characters are uneven by chance. After that it has so many times the root mean
#: square of what the language's texts have more than their median. Limit of the words' distance. Lengths from which
#: they are judged.
CHAR_LIMIT = 0.15
CHAR_SLACK = 2.1
DEVIATIONS = 5.5
WORD_LIMIT = 0.4
MIN_CHARS = 250
MIN_WORDS = 40

# Common words of some languages; those of all others are learnt.
COMMON = {
    "de": "der die und in den von zu das mit ist ein eine".split(),
    "en": "the of and to in a is that for it was with".split(),
    "es": "de la que el en y a los del se las por".split(),
    "fr": "de la le et les des en un une que est pour".split(),
}
#: Common words that are learnt of any other language, and characters that such a word may have.
LEARNT = 12
LONGEST = 40
# Character classes besides white space; what is in none of them is mostly a-z.
CLASSES = ["A-Z", "0-9", ".,;:!?'\"()\\-", r"#$%&*+/<=>@\[\\\]\^_`{|}~", r"\x{80}-\x{10FFFF}"]

SPACES = r"[\x20\x09-\x0D]+"
#: Names of the columns that are added; any such columns of the input would be replaced.
FEATURES = "_quality_features"


class Reference(NamedTuple):
    """Shares of the character classes and of the common words, the rest last in both; the common words; the median of
    the characters' distances and the root mean square of sqrt(n) times the deviations from it, if they are known."""

    chars: list[float]
    words: list[float]
    common: list[str]
    middle: float | None = None
    spread: float | None = None

    def limit(self) -> str:
        return char_limit("cast(null as double)" if self.middle is None else f"{self.middle!r}D", f"{self.spread or 0.0!r}D")


def char_limit(middle: str, spread: str) -> str:
    """Limit of the characters' distance, as SQL; that of the first references without a median."""
    root = f"sqrt(greatest({FEATURES}.n_chars, 1))"
    return f"if({middle} is null, {CHAR_LIMIT}D + {CHAR_SLACK}D / {root}, greatest({CHAR_LIMIT}D, {middle} + {DEVIATIONS}D * {spread} / {root}))"


def literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def by_language(values: dict[str, str], language: str, kind: str) -> str:
    """The value (SQL) of the row's language, or null."""
    entries = ", ".join(f"{literal(lang)}, {value}" for lang, value in sorted(values.items()))
    return f"element_at(map({entries}), cast(`{language}` as string))" if values else f"cast(null as {kind})"


def learnt_words(docs: DataFrame, text: str = "text", language: str = "lang") -> dict[str, list[str]]:
    """The words that are in most documents of every language that ``COMMON`` has not; a few words per language."""
    lang = F.col(language).cast("string")
    others = docs.where(lang.isNotNull() & ~lang.isin(list(COMMON))).select(lang.alias("lang"), F.col(text).cast("string").alias("text"))
    out = {r.lang: [] for r in others.select("lang").distinct().collect()}
    if not out:
        return out
    words = F.array_distinct(F.filter(F.split("text", SPACES), lambda w: F.length(w).between(1, LONGEST)))
    n = others.select("lang", F.explode(words).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    ranked = n.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word")))
    for r in ranked.where(F.col("rank") <= LEARNT).orderBy("lang", "rank").collect():
        out[r.lang].append(r.word)
    return out


def with_features(docs: DataFrame, text: str = "text", language: str = "lang", learnt: dict[str, list[str]] | None = None) -> DataFrame:
    """``docs`` with a struct ``FEATURES``: the base counts and both histograms, with the row's language's learnt words."""
    t, words, lines, grams = ("_quality_text", "_quality_words", "_quality_lines", "_quality_grams")
    df = docs.withColumn(t, F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumn(words, F.array_remove(F.split(t, SPACES), ""))
    df = df.withColumn(lines, F.expr(rf"filter(split({t}, '\\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    five = ", ".join(f"get({words}, i + {k})" for k in range(5))
    df = df.withColumn(grams, F.expr(f"if(size({words}) < 5, array(), transform(sequence(0, size({words}) - 5), i -> xxhash64({five})))"))
    # Windows sorted by hash beside their places, only where some hash is there twice.
    ordered = F.expr(f"if(size(array_distinct({grams})) < size({grams}), sort_array(transform({grams}, (h, i) -> struct(h, i))), null)")
    df = df.withColumn("_quality_ordered", ordered)
    twice = "filter(_quality_ordered, (x, j) -> get(_quality_ordered, j - 1).h <=> x.h or get(_quality_ordered, j + 1).h <=> x.h)"
    df = df.withColumn("_quality_twice", F.expr(f"sort_array(transform({twice}, x -> x.i))"))
    covered = "aggregate(transform(_quality_twice, (p, j) -> least(5, coalesce(get(_quality_twice, j + 1) - p, 5))), 0L, (a, x) -> a + x)"
    every = sorted({w for ws in COMMON.values() for w in ws})
    quoted = ", ".join(f"'{w}'" for w in every)
    common = f"concat(' ', array_join(filter({words}, w -> w in ({quoted})), '  '), ' ')"
    df = df.withColumn("_quality_common", F.expr(common))
    counts = f"transform(array({quoted}), w -> cast((length(_quality_common) - length(replace(_quality_common, concat(' ', w, ' '), ''))) / (length(w) + 2) as long))"
    own = by_language({lang: f"array({', '.join(map(literal, ws))})" for lang, ws in (learnt or {}).items() if ws}, language, "array<string>")
    df = df.withColumn("_quality_learnt", F.expr(own))
    df = df.withColumn("_quality_own", F.expr(f"concat(' ', array_join(filter({words}, w -> array_contains(_quality_learnt, w)), '  '), ' ')"))
    own_counts = "transform(_quality_learnt, w -> cast((length(_quality_own) - length(replace(_quality_own, concat(' ', w, ' '), ''))) / (length(w) + 2) as long))"
    kinds = [F.length(F.regexp_replace(t, f"[^{c}]+", "")).cast("long") for c in CLASSES]
    features = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.expr(covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.length(t).cast("long").alias("n_chars"),
        F.array(*kinds, (F.length(t) - F.length(F.array_join(words, ""))).cast("long")).alias("chars"),
        F.expr(counts).alias("words"),
        F.expr(own_counts).alias("own"),
    )
    df = df.withColumn(FEATURES, features)
    added = [c for c in df.columns if c.startswith("_quality_") and c != FEATURES and c not in docs.columns]
    return df.drop(*added)


def base_failed() -> Column:
    f = F.col(FEATURES)
    return (f["n_words"] < 10) | (100 * f["n_repeat_words"] > 20 * f["n_words"])


def references(featured: DataFrame, language: str = "lang", learnt: dict[str, list[str]] | None = None) -> dict[str, Reference]:
    """Shares of the character classes and of the language's common words, one row per language of ``COMMON`` and
    ``learnt`` that has a document which does not fail the base rules.

    They are taken twice: over all documents that do not fail the base rules, and again over those of them that the
    first references keep, so that junk does not become part of what is normal; so are the spreads of the distances to
    them. ``featured`` should be stored."""
    first = shares(featured, language, learnt)
    return with_spreads(featured, shares(only_kept(verdict(featured, first, language)), language, learnt), language)


def with_spreads(featured: DataFrame, known: dict[str, Reference], language: str) -> dict[str, Reference]:
    """``known`` with the spread of the distances of all documents it keeps. Equal distances of texts of one length count
    once, so that copies do not narrow it; no language has less than the spread of all."""
    near = only_kept(verdict(featured, known, language)).where(F.col(f"{FEATURES}.n_chars") >= MIN_CHARS)
    v = F.col("_quality_verdict")
    near = near.select(v["reference"].alias("lang"), F.col(f"{FEATURES}.n_chars").alias("n"), v["char_distance"].alias("c")).distinct()
    sums = [F.sum(F.col("n") * F.col("c") * F.col("c")).alias("ncc"), F.sum(F.col("n") * F.col("c")).alias("nc"), F.sum("n").alias("n")]
    rows = near.groupBy("lang").agg(F.percentile_approx("c", 0.5, 10000).alias("middle"), F.count("*").alias("docs"), *sums).collect()
    squares = {r["lang"]: max(0.0, r["ncc"] - 2 * r["middle"] * r["nc"] + r["middle"] ** 2 * r["n"]) for r in rows if r["lang"] in known}
    every = sum(squares.values()) / max(1, sum(r["docs"] for r in rows if r["lang"] in known))
    spread = {r["lang"]: (r["middle"], max(every, squares[r["lang"]] / r["docs"]) ** 0.5) for r in rows if r["lang"] in known}
    return {lang: r._replace(middle=spread[lang][0], spread=spread[lang][1]) if lang in spread else r for lang, r in known.items()}


def only_kept(judged: DataFrame) -> DataFrame:
    """The rows of ``verdict`` that are kept. A list of the verdict alone is exploded first: the filter stays above
    it, where it would otherwise be pushed below every projection and repeat their expressions in one another."""
    return judged.withColumn("_quality_kept", F.explode(F.array("_quality_verdict.kept"))).where("_quality_kept")


def shares(featured: DataFrame, language: str, learnt: dict[str, list[str]] | None = None) -> dict[str, Reference]:
    f = F.col(FEATURES)
    every = sorted({w for ws in COMMON.values() for w in ws})
    common = {**(learnt or {}), **COMMON}
    lang = F.col(language).cast("string")
    good = featured.where(lang.isNotNull() & ~base_failed())
    classes = range(len(CLASSES) + 1)
    sums = [F.sum(f["chars"][i]).alias(f"c{i}") for i in classes] + [F.sum(f["words"][i]).alias(f"w{i}") for i in range(len(every))]
    sums += [F.sum(F.get(f["own"], F.lit(i))).alias(f"o{i}") for i in range(LEARNT)]
    rows = good.groupBy(lang.alias("lang")).agg(F.sum(f["n_chars"]).alias("chars"), F.sum(f["n_words"]).alias("words"), *sums).collect()
    out = {}
    for r in sorted((r for r in rows if r["lang"] in common), key=lambda r: r["lang"]):
        bins = [f"w{every.index(w)}" if r["lang"] in COMMON else f"o{i}" for i, w in enumerate(common[r["lang"]])]
        chars = [r[f"c{i}"] / r["chars"] for i in classes]
        words = [r[b] / r["words"] for b in bins]
        out[r["lang"]] = Reference(chars + [max(0.0, 1 - sum(chars))], words + [max(0.0, 1 - sum(words))], common[r["lang"]])
    return out


def numbers(values: list[float]) -> str:
    return "array(" + ", ".join(f"{x!r}D" for x in values) + ")"


def distance(shares: str, reference: str) -> str:
    """Jensen-Shannon distance of an array of shares to a reference, as SQL."""
    terms = "if(p > 0, p * log2(2 * p / (p + q)), 0D) + if(q > 0, q * log2(2 * q / (p + q)), 0D)"
    return f"sqrt(greatest(0D, aggregate(zip_with({shares}, {reference}, (p, q) -> {terms}), 0D, (a, x) -> a + x) / 2))"


def verdict(featured: DataFrame, known: dict[str, Reference], language: str = "lang") -> DataFrame:
    """``featured`` with base_failed, kept, and char_distance, word_distance and reference of the nearest language, as
    a struct ``_quality_verdict``."""
    every = sorted({w for ws in COMMON.values() for w in ws})
    f = FEATURES
    spread = f"greatest({f}.n_chars, 1)"
    rest = f"{f}.n_chars - aggregate({f}.chars, 0L, (a, x) -> a + x)"
    df = featured.withColumn("_quality_chars", F.expr(f"transform(concat({f}.chars, array({rest})), x -> x / {spread})"))

    def choice(name: str, counts: str, chars: str, words: str, lang: str, limit: str) -> str:
        """The distances to one language, whose words' shares become the column ``name``."""
        nonlocal df
        df = df.withColumn(name, F.expr(f"transform({counts}, x -> x / greatest({f}.n_words, 1))"))
        shares = f"concat({name}, array(1D - aggregate({name}, 0D, (a, x) -> a + x)))"
        chars_far = f"if({f}.n_chars < {MIN_CHARS}, 0D, {distance('_quality_chars', chars)})"
        words_far = f"if({f}.n_words < {MIN_WORDS}, 0D, {distance(shares, words)})"
        return f"named_struct('c', {chars_far}, 'w', {words_far}, 'lang', {lang}, 'most', {limit})"

    choices = []
    for lang in (x for x in known if x in COMMON):
        picked = ", ".join(f"{f}.words[{every.index(w)}]" for w in known[lang].common)
        chars, words = numbers(known[lang].chars), numbers(known[lang].words)
        choices.append(choice(f"_quality_words_{lang}", f"array({picked})", chars, words, literal(lang), known[lang].limit()))
    choices = f"array({', '.join(choices)})" if choices else None
    others = {lang: r for lang, r in known.items() if lang not in COMMON}
    if others:
        values = {
            lang: f"named_struct('c', {numbers(r.chars)}, 'w', {numbers(r.words)}, 'm', cast({r.middle if r.middle is not None else 'null'} as double), 's', {r.spread or 0.0!r}D)"
            for lang, r in others.items()
        }
        df = df.withColumn("_quality_reference", F.expr(by_language(values, language, "")))
        counts = f"coalesce({f}.own, array())"
        most = char_limit("_quality_reference.m", "_quality_reference.s")
        own = choice("_quality_words", counts, "_quality_reference.c", "_quality_reference.w", f"cast(`{language}` as string)", most)
        own = f"filter(array(if(_quality_reference is null, null, {own})), x -> x is not null)"
        choices = f"concat({choices}, {own})" if choices else own
    if choices:
        df = df.withColumn("_quality_choices", F.expr(choices))
        over = f"greatest(x.c / x.most, x.w / {WORD_LIMIT}D)"
        nearest = F.expr(f"array_min(transform(_quality_choices, x -> struct({over} as far, x.c as c, x.w as w, x.lang as lang)))")
    else:
        nearest = F.expr("struct(0D as far, 0D as c, 0D as w, cast(null as string) as lang)")
    df = df.withColumn("_quality_nearest", nearest)
    judged = F.coalesce(F.expr(by_language({lang: "true" for lang in known}, language, "boolean")), F.lit(False))
    out = F.struct(
        base_failed().alias("base_failed"),
        (~base_failed() & (~judged | (F.col("_quality_nearest.far") <= 1))).alias("kept"),
        F.coalesce("_quality_nearest.c", F.lit(0.0)).alias("char_distance"),
        F.coalesce("_quality_nearest.w", F.lit(0.0)).alias("word_distance"),
        F.col("_quality_nearest.lang").alias("reference"),
    )
    added = [c for c in df.columns if c.startswith("_quality_") and c != FEATURES and c not in featured.columns]
    return df.withColumn("_quality_verdict", out).drop(*[c for c in added if c != "_quality_verdict"])


def judged(docs: DataFrame, id_column: str = "doc_id", text: str = "text", language: str = "lang") -> DataFrame:
    """Base counts, distances and verdict of every document."""
    slim = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), F.col(language).alias("lang"))
    learnt = learnt_words(slim)
    featured = stored(with_features(slim, learnt=learnt).drop("text"), "features")
    out = verdict(featured, references(featured, learnt=learnt))
    counts = [F.col(f"{FEATURES}.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    names = ("base_failed", "kept", "char_distance", "word_distance", "reference")
    return out.select("doc_id", *counts, *[F.col(f"_quality_verdict.{c}") for c in names])


def kept(docs: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """``docs`` without the rejected documents; no text is shuffled. A row is carried as one value, so that its columns
    may have any name."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    whole = docs.select(row.alias("doc"), F.col(text).alias("text"), F.col(language).alias("lang"))
    slim = whole.drop("doc")
    learnt = learnt_words(slim)
    known = references(stored(with_features(slim, learnt=learnt).drop("text"), "features"), learnt=learnt)
    return only_kept(verdict(with_features(whole, learnt=learnt), known)).select("doc.*")
