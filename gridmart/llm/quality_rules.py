"""Quality rules, line first: lines that fail a rule go, and a document goes if it loses too much of its text.

Spark's own functions only. Every rule looks at one row, so the scan is the only stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import boxed, carried

#: Words, symbols and lines of the measures.
WORD = r"[^\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 8

#: Rules for lines. The SQL of the query uses the same texts.
NOT_ORNAMENT = r"[^#*$%&|<>!@^~=+]+"
NOT_SEPARATOR = r"[^|»›•·]+"
SENTENCE_END = r"[.!?:;…。！？｡．।॥؟۔։።፧፨។៕။܀᙮᠃᠉‽⁇⁈⁉][\"')\]”’»]*([\x20\x09-\x0D]|\z)"
GOES_ON = r"^[\x20\x09-\x0D]*[\p{Ll}\p{Lo}]"
WRAPPED_CHARS = 30  # shorter lines are not parts of wrapped prose
BOILERPLATE = (
    r"(?i)all rights reserved|privacy policy|terms of (use|service)|accept (all )?cookies|cookie (policy|settings)"
    r"|enable javascript|lorem ipsum|click here|sign up for|skip to (main )?content|powered by"
)
BOILERPLATE_CHARS = 200  # longer lines are prose, whatever phrase they hold
ORNAMENT_CHARS = 20  # shorter lines are not judged by their share of ornaments
MAX_ORNAMENTS = 0.08  # of a line's characters
MAX_SEPARATORS = 0.03  # of a line's characters
MAX_LOST = 0.5  # of a document's characters that are not blank

RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_removed", "lost_share", "clean_text")


def _left(text: Column, pattern: str) -> Column:
    """Characters of ``text`` outside ``pattern``."""
    return F.length(F.regexp_replace(text, pattern, ""))


def _goes_on(line: Column, before: Column, after: Column) -> Column:
    """Whether a line is wrapped prose: no sentence need end in it, as the next line carries on.

    That one starts with a letter that is not a capital, or lines here are of like length.
    """
    size = F.length(line)
    alike = lambda other: (4 * F.length(other) >= 3 * size) & (3 * F.length(other) <= 4 * size)
    return (size >= WRAPPED_CHARS) & after.rlike(r"[^\x20\x09-\x0D]") & (after.rlike(GOES_ON) | alike(after) | alike(before))


def line_fails(line: Column, before: Column, after: Column) -> Column:
    """Whether a line, between its neighbours, breaks a rule; a blank line breaks none."""
    size = F.length(line)
    unpunctuated = ~line.rlike(SENTENCE_END) & ~_goes_on(line, before, after)
    ornate = (size >= ORNAMENT_CHARS) & (_left(line, NOT_ORNAMENT) > F.lit(MAX_ORNAMENTS) * size)
    navigation = _left(line, NOT_SEPARATOR) > F.lit(MAX_SEPARATORS) * size
    boilerplate = (size <= BOILERPLATE_CHARS) & line.rlike(BOILERPLATE)
    return line.rlike(r"[^\x20\x09-\x0D]") & (unpunctuated | ornate | navigation | boilerplate)


def _line(index: Column) -> Column:
    return F.coalesce(F.get("__lines", index), F.lit(""))


def with_repeat_words(read: DataFrame) -> DataFrame:
    """``read`` with ``__repeated``: words inside windows of ``WINDOW`` words that the text holds twice or more.

    Windows are compared by hash. Most texts repeat none, which a set of the hashes shows; only for the others are
    windows sorted, and their places merged from left to right. Each step is a column of its own: an expression
    inside a lambda would be computed for every element.
    """
    starts = F.sequence(F.lit(0), F.col("__n") - WINDOW)
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get("__hashes", i + k) for k in range(WINDOW)]))
    windowed = read.withColumn("__windows", F.when(F.col("__n") > WINDOW, windows))
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    sorted_windows = windowed.withColumn("__placed", F.when(repeats, placed)).drop("__windows")
    near = lambda i, by: F.get("__placed", i + by)["h"]
    again = F.transform("__placed", lambda p, i: F.when((p["h"] == near(i, -1)) | (p["h"] == near(i, 1)), p["i"]))
    places = sorted_windows.withColumn("__places", F.sort_array(F.filter(again, lambda i: i.isNotNull()))).drop("__placed")
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    merge = lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"))
    merged = F.aggregate("__places", start, merge, lambda a: a["n"])
    return places.withColumn("__repeated", F.coalesce(merged, F.lit(0).cast("long"))).drop("__places")


def quality_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures of their whole texts, the cleaned text, and the verdict ``kept``.

    Columns added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines_removed,
    lost_share (of the characters that are not blank) and clean_text (lines that pass, joined by line feeds).

    A line without the end of a sentence fails, unless it is prose wrapped to some width: the mark may then stand in a later
    line of its paragraph. A null or empty text has no words, so it fails; its clean_text is empty. Texts may have any length. Rows are judged one by one: repeated rows, null or
    shared ids and ties change nothing. Input columns named like a result are replaced; an empty table gives an
    empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(
        boxed(carried(docs, *RESULTS)),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("__words"),
        F.split(text, "\n", -1).alias("__lines"),
    )
    hashed = read.select(
        "*",
        F.size("__words").alias("__n"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"),
        F.filter("__lines", lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("__worded"),
        F.filter("__lines", lambda line, i: ~line_fails(line, _line(i - 1), _line(i + 1))).alias("__passed"),
    )
    measures = F.struct(
        F.col("__n").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        _left(F.coalesce(F.col("__in.text"), F.lit("")), NOT_SYMBOL).cast("long").alias("n_symbols"),
        (F.size("__worded") - F.size(F.array_distinct("__worded"))).cast("long").alias("n_dup_lines"),
        F.col("__repeated").alias("n_repeat_words"),
        (F.size("__lines") - F.size("__passed")).cast("long").alias("n_lines_removed"),
        F.array_join("__passed", "\n").alias("clean_text"),
    )
    # A generator, so that a filter on a result is not rewritten in terms of the words and computed a second time.
    measured = with_repeat_words(hashed).select("__in", F.inline(F.array(measures)))
    left = _left(F.col("clean_text"), r"[\x20\x09-\x0D]+")
    lost = F.when(F.col("word_chars") == 0, F.lit(0.0)).otherwise(1 - left / F.col("word_chars"))
    judged = measured.withColumns({
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        "lost_share": lost,
    })
    verdict = judged.withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= MAX_LOST))
    return verdict.select("__in.*", *RESULTS)
