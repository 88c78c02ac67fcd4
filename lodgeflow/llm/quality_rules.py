"""Quality rules by distribution divergence, in DataFrame functions only.

Each document gets two histograms: character classes, and the common words of each
language (one bin per word, one for all other words).  A language's references are
the summed histograms of all documents tagged with it that pass the base rules.  A
document is rejected if its Jensen-Shannon distance (base 2, square root) to the
nearest reference is too large, in classes alone or summed over both histograms.
Texts shorter than the guards are not judged by divergence.

Defined results: null and empty texts have no words and fail the base rules; rows with
unknown or null ``lang`` add to no reference but are judged; with no reference at all
only the base rules decide; repeated rows are judged one by one; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CHARS, text_of, without, written

#: The most common words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "as", "with", "be", "by", "are", "this", "at", "from"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "des", "auf", "ist", "im", "nicht", "ein", "eine", "als", "auch", "es", "an", "in"],
    "fr": ["de", "la", "le", "et", "les", "des", "un", "que", "pour", "dans", "en", "au", "par", "sur", "qui", "pas", "plus", "avec", "une", "est"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al"],
}

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Least length for a verdict by character classes, and for one by both histograms.
GUARD_CHARS = 200
GUARD_WORDS = 120
MAX_CLASS_DISTANCE = 0.3
MAX_SUM_OF_DISTANCES = 0.46

#: Character classes, tried in this order; what is left over counts as "other".
CLASSES = {
    "lower": "[a-z]+",
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "space": SPACE,
    "stop": "[.,;:!?'\"()-]+",
    "symbol": "[#*$%&|<>]+",
}


def all_common_words() -> list[str]:
    return sorted({w for words in COMMON_WORDS.values() for w in words})


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def with_repeats(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in 3-word windows found twice or more in ``words``.

    Windows are compared as 64-bit hashes within one document.  Positions are sorted
    only in documents where some window repeats.
    """
    w = F.col("words")
    windows = F.when(F.size(w) >= 3, F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))))
    df = df.withColumn("_w3", windows)
    df = df.withColumn("_s", F.when(
        F.size(F.array_distinct("_w3")) < F.size("_w3"),
        F.sort_array(F.transform("_w3", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_s")
    again = F.filter(s, lambda x, i: (F.get(s, i + 1)["h"].eqNullSafe(x["h"]))
                     | ((i > 0) & F.get(s, i - 1)["h"].eqNullSafe(x["h"])))
    df = df.withColumn("_at", F.transform(again, lambda x: x["i"]))
    at = F.col("_at")
    covered = F.size(F.array_distinct(F.concat(
        at, F.transform(at, lambda i: i + 1), F.transform(at, lambda i: i + 2))))
    return df.withColumn("n_repeat_words", F.when(at.isNull(), 0).otherwise(covered).cast("long")) \
             .drop("_w3", "_s", "_at")


def measures(documents: DataFrame) -> DataFrame:
    """Counts and histograms of each document, one narrow pass."""
    df = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.xxhash64(text_of()).alias("text_key"), text_of().alias("text"))
    df = df.withColumn("words", words_of(F.col("text"))).withColumn("n_chars", F.length("text").cast("long"))
    df = with_repeats(df.withColumn("n_words", F.size("words").cast("long")))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    # Common words of all languages, written apart, then counted one by one.
    known = all_common_words()
    forms = [f for w in known for f in (w, w.capitalize())]
    hits = F.filter("words", lambda x: x.isin(forms))
    df = df.withColumn("_hits", F.concat(
        F.lit(" "), F.array_join(F.transform(hits, lambda x: F.lower(x)), "  "), F.lit(" ")))
    for name, pattern in CLASSES.items():
        df = df.withColumn("_left", F.regexp_replace("text", pattern, ""))
        df = df.withColumn(f"c_{name}", (F.length("text") - F.length("_left")).cast("long"))
        df = df.drop("text").withColumnRenamed("_left", "text")
    counts = [((F.length("_hits") - F.length(F.replace(F.col("_hits"), F.lit(f" {w} "), F.lit(""))))
               / (len(w) + 2)).cast("long") for w in known]
    return df.select(
        "doc_id", "text_key", "lang", "n_words", "n_chars", (F.col("n_chars") - F.col("c_space")).alias("word_chars"),
        F.col("c_symbol").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        F.array(*[F.col(f"c_{c}") for c in CLASSES], F.length("text").cast("long")).alias("classes"),
        F.array(*counts).alias("common"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def shares(counts: Column) -> Column:
    """The counts as shares of their sum."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def language_words(language: str) -> Column:
    """Histogram of one language's common words, and of all other words."""
    known = all_common_words()
    own = [F.get("common", F.lit(known.index(w))).cast("double") for w in COMMON_WORDS[language]]
    return F.array(*own, F.col("n_words").cast("double") - sum(own[1:], own[0]))


def references(found: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Shares of classes and words by language: a row for each language of
    ``COMMON_WORDS``, so at most that many come to the driver."""
    rows = {}
    tagged = found.where(~base_failed() & F.col("lang").isin(list(COMMON_WORDS)))
    known = all_common_words()
    n, m = len(CLASSES) + 1, len(known)
    sums = tagged.groupBy("lang").agg(
        F.sum("n_words").alias("n_words"),
        F.array(*[F.sum(F.get("classes", F.lit(i))) for i in range(n)]).alias("classes"),
        F.array(*[F.sum(F.get("common", F.lit(i))) for i in range(m)]).alias("common"))
    for r in sums.collect():
        own = [r["common"][known.index(w)] for w in COMMON_WORDS[r["lang"]]]
        words = [*own, r["n_words"] - sum(own)]
        rows[r["lang"]] = ([x / sum(r["classes"]) for x in r["classes"]], [x / sum(words) for x in words])
    return dict(sorted(rows.items()))


def js_distance(p: Column, q: list[float]) -> Column:
    """Jensen-Shannon distance, 0 to 1, of shares ``p`` to reference ``q``."""
    ref = F.array(*[F.lit(float(x)) for x in q])

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, ref, lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def nearest(distances: list[Column]) -> Column:
    return F.least(*distances) if len(distances) > 1 else distances[0] if distances else F.lit(0.0)


def quality_rules(documents: DataFrame) -> DataFrame:
    """One row per document: base counts, base_failed, kept, both distances, and text_key, a
    hash of the text that tells rows with equal doc_id apart."""
    found = written(measures(documents), "quality-measures")
    refs = references(found)
    df = found.withColumn("_c", shares(F.transform("classes", lambda x: x.cast("double"))))
    for k in refs:
        df = df.withColumn(f"_w_{k}", shares(language_words(k)))
    df = df.withColumns({
        "class_distance": nearest([js_distance(F.col("_c"), c) for c, _ in refs.values()]),
        "word_distance": nearest([js_distance(F.col(f"_w_{k}"), w) for k, (_, w) in refs.items()])})
    strange = ((F.col("n_chars") >= GUARD_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)) | (
        (F.col("n_words") >= GUARD_WORDS)
        & (F.col("class_distance") + F.col("word_distance") > MAX_SUM_OF_DISTANCES))
    return df.withColumn("base_failed", base_failed()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~strange).alias("kept"), "class_distance", "word_distance", "text_key")


def kept_documents(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, all columns as they are."""
    return without(documents, quality_rules(documents).where(~F.col("kept")))
