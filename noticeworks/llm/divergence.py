"""Quality rules by distribution divergence, with built-in expressions only.

A document's histogram of character classes and its histogram of common words are held against
the mean histograms of its language by the Jensen-Shannon distance (base 2, so from 0 to 1).
Every document of the table with enough words enters the reference of its language with equal
weight. Short documents have noisy histograms; the limits widen with one over the square root of
the number of words, and below a minimum length the divergence says nothing.

Defined results: a null text is an empty one; empty and short texts fail the length rule; a null
or rare language is a language like any other, with the reference of its own documents; a
language without a long enough document has no reference and is judged by the base rules alone;
repeated rows are judged one by one; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.functions.text import once
from noticeworks.llm.common import SPACE_CLASS, SPACES, columns, numbered, place_of, stored

# Frequent words of four languages, the bins of the word histogram.
COMMON_WORDS = {
    "en": "the of and to in a is that it for on was be as with by",
    "de": "der die und in den von zu das mit sich des auf für ist im dem",
    "fr": "de la le et les des en un du une que est pour qui dans a",
    "es": "de la que el en y a los se del las un por con no una",
}
BINS = sorted({word for words in COMMON_WORDS.values() for word in words.split()})

# The character classes that are counted; all other characters are the last bin.
SMALL = r"a-zß-ÿ"
UPPER = r"A-ZÀ-Þ"
SYMBOLS = r"#*$%&|<>"
CLASSES = [SPACE_CLASS, "0-9", SYMBOLS, UPPER]

MIN_WORDS = 10            # base rule: fewer words fail
MAX_REPEATED = 20         # base rule: percent of words inside repeated 5-word windows
GUARD_WORDS = 30          # shorter documents are neither compared nor part of a reference
CHAR_LIMIT = 0.30         # a larger distance of the character classes alone fails
WORD_LIMIT = 0.55         # a larger distance of the common words alone fails
PAIR_LIMITS = (0.10, 0.24)  # both distances larger than these together fail
LENGTH_SLACK = 0.5        # divided by the root of the number of words, added to single limits


def _removed(text: Column, class_: str) -> Column:
    # Split and join: a replacement costs several times as much per match.
    return F.array_join(F.split(text, f"[{class_}]+"), "")


def _counts(text: Column, marks: Column) -> Column:
    """Characters of every class; ``marks`` is the text without small letters."""
    named = [F.length(marks) - F.length(_removed(marks, class_)) for class_ in CLASSES]
    rest = reduce(lambda a, b: a - b, named, F.length(marks))
    return F.array(*[c.cast("long") for c in [*named, rest, F.length(text) - F.length(marks)]])


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{SPACE_CLASS}]+"))


def _profile(docs: DataFrame, *keep: Column) -> DataFrame:
    """Words, character-class counts and shares of the common words of every text."""
    # Letters are most of a text: one pass takes them out, the counts read what is left.
    marks = _removed(F.col("text"), SMALL)
    split = docs.select(*keep, "text", once(_words(F.col("text")).alias("words"), marks.alias("marks")))
    common = F.filter("words", lambda w: w.isin(*BINS))
    counted = split.select(
        *keep, "text", "words", once(
            _counts(F.col("text"), F.col("marks")).alias("classes"), common.alias("common"),
            F.size("words").cast("long").alias("n_words")))
    # One lambda over the bins: written out bin by bin, the generated code is too long to be compiled.
    per_word = F.transform(
        F.array(*map(F.lit, BINS)), lambda w: (F.size("common") - F.size(F.array_remove(F.col("common"), w))).cast("double"))
    rest = F.array((F.col("n_words") - F.size("common")).cast("double"))
    total = reduce(lambda a, b: a + b, [F.col("classes")[i] for i in range(len(CLASSES) + 2)])
    return counted.select(
        *keep, "text", "words", "n_words", "classes",
        once(
            F.transform("classes", lambda c: F.try_divide(c.cast("double"), total.cast("double"))).alias("class_shares"),
            F.transform(F.concat(per_word, rest), lambda c: F.try_divide(c, F.col("n_words").cast("double"))).alias("word_shares"),
        ),
    )


def references(docs: DataFrame, guard_words: int = GUARD_WORDS) -> DataFrame:
    """Mean histograms per language over all documents that are long enough: ref_lang, two arrays."""
    return _means(_profile(docs, F.col("lang")), guard_words)


def _means(profile: DataFrame, guard_words: int) -> DataFrame:
    shares = profile.where(F.col("n_words") >= guard_words)
    sizes = {"class_shares": len(CLASSES) + 2, "word_shares": len(BINS) + 1}
    means = [F.avg(F.col(c)[i]).alias(f"{c}_{i}") for c, n in sizes.items() for i in range(n)]
    table = shares.groupBy("lang").agg(*means)
    return table.select(
        F.col("lang").alias("ref_lang"),
        *[F.array(*[F.col(f"{c}_{i}") for i in range(n)]).alias(f"ref_{c}") for c, n in sizes.items()],
    )


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two share arrays of equal length."""
    def part(a, mean):
        return F.when(a > 0, a * F.log2(a / mean)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda x, y: x + y) / 2))


def _repeated_words(docs: DataFrame, *keep: str) -> DataFrame:
    """Adds n_repeat_words: words inside 5-word windows that the text holds twice or more."""
    w = F.col("words")
    starts = F.when(F.size(w) >= 5, F.sequence(F.lit(0), F.size(w) - 5)).otherwise(F.array().cast("array<int>"))
    hashed = docs.select(*keep, once(
        F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)])).alias("windows")))
    # Only texts with a repeated window pay for sorting: equal windows become neighbours.
    h = F.col("windows")
    ordered = F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at")))),
    )
    ranked = hashed.select(*keep, once(ordered.alias("ordered")))
    o = F.col("ordered")
    twice = F.filter(
        o, lambda e, i: (F.coalesce(F.get(o, i - 1)["h"] == e["h"], F.lit(False)))
        | (F.coalesce(F.get(o, i + 1)["h"] == e["h"], F.lit(False))))
    found = ranked.select(*keep, once(F.array_sort(F.transform(twice, lambda e: e["at"])).alias("at")))
    a = F.col("at")
    # A window covers five words, less what the window before it has covered.
    covered = F.transform(a, lambda x, i: F.when(i == 0, 5).otherwise(F.least(F.lit(5), x - F.get(a, i - 1))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select(*keep, F.coalesce(total, F.lit(0)).alias("n_repeat_words"))


def measures(docs: DataFrame, *keep: Column) -> DataFrame:
    """Base measures and histograms of every document. ``docs`` has lang and text."""
    names = [docs.select(k).columns[0] for k in keep]
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    profile = _profile(docs, *keep, F.col("lang"))
    counted = profile.select(
        *names, "lang", "words", "n_words", "class_shares", "word_shares",
        (F.length("text") - F.col("classes")[0]).alias("word_chars"),
        F.col("classes")[2].alias("n_symbols"),
        once(lines.alias("lines")),
    ).withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    return _repeated_words(
        counted, *names, "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "class_shares", "word_shares")


def judged(docs: DataFrame, refs: DataFrame, *keep: Column, guard_words: int = GUARD_WORDS) -> DataFrame:
    """Every document with measures, distances, base_failed and kept."""
    names = [docs.select(k).columns[0] for k in keep]
    return _judged(measures(docs, *keep), refs, names, guard_words)


def _judged(m: DataFrame, refs: DataFrame, names: list[str], guard_words: int) -> DataFrame:
    both = m.join(refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    long_enough = (F.col("n_words") >= guard_words) & F.col("ref_class_shares").isNotNull()
    measured = both.select(
        *names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.when(long_enough, distance(F.col("class_shares"), F.col("ref_class_shares"))).alias("class_distance"),
        F.when(long_enough, distance(F.col("word_shares"), F.col("ref_word_shares"))).alias("word_distance"),
    )
    slack = LENGTH_SLACK / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)).cast("double"))
    c, w = F.col("class_distance"), F.col("word_distance")
    diverges = (c > CHAR_LIMIT) | (w > F.lit(WORD_LIMIT) + slack) | ((c > F.lit(PAIR_LIMITS[0]) + slack) & (w > PAIR_LIMITS[1]))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    out = measured.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(diverges, F.lit(False)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, measures, distances, base_failed and kept."""
    own = columns(docs, "doc_id", "lang", "text").withColumn("text", F.coalesce("text", F.lit("")))
    # The histograms serve twice, for the references and against them: texts are measured once.
    measured = stored(measures(own, F.col("doc_id")), "measures")
    return _judged(measured, stored(_means(measured, GUARD_WORDS), "language_references"), ["doc_id"], GUARD_WORDS)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns unchanged."""
    plain = numbered(docs)
    whole_row = F.struct(*plain.columns).alias("row_of_document")
    own = plain.select(
        whole_row, place_of(docs, "lang").alias("lang"), F.coalesce(place_of(docs, "text"), F.lit("")).alias("text"))
    refs = stored(references(own), "language_references")
    kept = judged(own, refs, F.col("row_of_document")).where("kept")
    return kept.select("row_of_document.*").toDF(*docs.columns)
