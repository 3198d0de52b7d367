"""Line-first quality rules, in DataFrame functions only.

Each line is judged by itself (punctuation, navigation, boilerplate); failing lines are
removed, and a document that loses too much of its text that way is rejected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import let, packed, unpacked

SPACES = "[\\x20\\x09-\\x0D]+"
A_WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A document must keep at least this share of its word characters.
MIN_KEPT_PERCENT = 50
#: A line may have this many marks ([#*$%&|<>!]) for each hundred words.
MAX_MARKS_PERCENT = 50
MARKS = "[#*$%&|<>!]"
#: Two separators, or one that ends the line, make a menu.
NAVIGATION = r"(\||»|›|>>).*(\||»|›|>>)|(\||»|›|>>)[\x20\x09-\x0D]*$"
#: A sentence end inside the line is enough: a last sentence may be cut off.
ENDS = r"[.!?…。！？][\"'”’»)\]]*([\x20\x09-\x0D]|$)"
BOILERPLATE = (
    r"all rights reserved|cookie|privacy policy|terms of (use|service)|click here|sign up|log in|subscribe|javascript|"
    r"lorem ipsum|read more|share (this|on)|back to top|skip to"
)

#: junk_line takes separators and phrases for a sign of junk only in lines of at most this many words,
#: or where there is a separator for every so many words, or where the phrases make up half of the line.
SHORT_LINE, WORDS_PER_ITEM = 10, 5
#: Bars and >> anywhere; » and › only between blanks, as they are quotation marks elsewhere.
BARS = r"\||>>"
SEPARATORS = BARS + r"|(?<=[\x20\x09])[»›](?=[\x20\x09])"
OPENING_QUOTE = "[«‹]"
PHRASES = (
    r"\b(all rights reserved|cookies?|privacy policy|terms of (use|service)|click here|sign up|log in|subscribe|javascript|"
    r"lorem ipsum|read more|share (this|on)|back to top|skip to)\b"
)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES, -1), lambda w: w != "")


def _chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words inside windows of `window` words that are found twice or more in the array.

    Windows are compared by a 64-bit hash of their words' hashes. Sorting puts equal windows
    next to each other, so a text of n words costs n log n.
    """

    none = F.lit(0).cast("long")

    def of_hashes(h: Column) -> Column:
        return let(F.transform(F.sequence(F.lit(1), F.size(h) - (window - 1)), lambda i: F.xxhash64(F.slice(h, i, window))), of_windows)

    def of_windows(w: Column) -> Column:
        # most texts repeat nothing, which a hash set finds out without a sort
        alone = F.size(F.array_distinct(w)) == F.size(w)
        return F.when(alone, none).otherwise(let(F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), (i + 1).alias("i")))), of_sorted))

    def of_sorted(s: Column) -> Column:
        same = F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))))
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), covered)

    def covered(at: Column) -> Column:
        parts = F.transform(at, lambda p, k: F.when(k == 0, F.lit(window)).otherwise(F.least(F.lit(window), p - F.get(at, k - 1))))
        return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x)

    count = let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)
    return F.when(F.size(words) >= window, count).otherwise(none)


def _unpunctuated(line: Column) -> Column:
    """No sentence end at all, or too many marks for its words."""
    marks = F.regexp_count(line, F.lit(MARKS))
    marks = F.when(marks == 0, F.lit(False)).otherwise(marks * 100 > F.size(_words(line)) * MAX_MARKS_PERCENT)
    return ~line.rlike(ENDS) | marks


def line_fails(line: Column) -> Column:
    """Does a line with a word fail the punctuation, navigation or boilerplate rule, as the check SQL states them?

    Each rule reads one line. Navigation and boilerplate also meet prose: quoted phrases in » and long lines
    that name a cookie.
    """
    return _unpunctuated(line) | line.rlike(NAVIGATION) | F.lower(line).rlike(BOILERPLATE)


def junk_line(line: Column) -> Column:
    """Does a line with a word fail the punctuation rule, or is it a menu or boilerplate as a whole?

    A menu has two separators, or a bar or >> at its end. Of a long line the separators or
    phrases must make up most, so prose that holds some stays.
    """
    short = F.size(_words(line)) <= SHORT_LINE

    def menu(n: Column) -> Column:
        return (n >= 2) & (short | (F.size(_words(line)) <= n * WORDS_PER_ITEM))

    separators = F.when(line.rlike(OPENING_QUOTE), F.regexp_count(line, F.lit(BARS))).otherwise(F.regexp_count(line, F.lit(SEPARATORS)))
    navigation = line.rlike(NAVIGATION) & (let(separators, menu) | (short & line.rlike(rf"({BARS})[\x20\x09-\x0D]*$")))

    def mostly(lower: Column) -> Column:
        rest = F.char_length(F.regexp_replace(lower, PHRASES, ""))
        return lower.rlike(PHRASES) & (short | (rest * 2 <= F.char_length(lower)))

    return _unpunctuated(line) | navigation | let(F.lower(line), mostly)


def judge(df: DataFrame, text_col: str = "text", fails: Callable[[Column], Column] = line_fails) -> DataFrame:
    """All rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, kept_chars, clean_text.

    clean_text is the text without the lines that `fails` holds of (lines without a word stay). Null texts
    count as empty: no words, base_failed, not kept. Extra columns named like an added one
    give way to it. Nothing is shuffled; the work of a row is n log n in its words.
    """
    rows = packed(df, text_col).select("row", F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))

    def measured(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), _chars(words).alias("word_chars"), repeated_words(words).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        with_word = F.filter(lines, lambda x: x.rlike(A_WORD))
        clean = F.filter(lines, lambda x: F.when(x.rlike(A_WORD), ~fails(x)).otherwise(F.lit(True)))
        return F.struct(
            let(with_word, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            F.array_join(clean, "\n").alias("clean_text"),
        )

    rows = rows.select("row", "body", let(_words(F.col("body")), measured).alias("w"), let(F.split(F.col("body"), "\n", -1), of_lines).alias("l"))
    unchanged = F.col("l.clean_text") == F.col("body")
    rows = rows.select(
        "row",
        F.col("w.n_words").alias("n_words"),
        F.col("w.word_chars").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.col("l.n_dup_lines").alias("n_dup_lines"),
        F.col("w.n_repeat_words").alias("n_repeat_words"),
        F.when(unchanged, F.col("w.word_chars")).otherwise(_chars(_words(F.col("l.clean_text")))).alias("kept_chars"),
        F.col("l.clean_text").alias("clean_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    rows = rows.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("kept_chars") * 100 >= F.col("word_chars") * MIN_KEPT_PERCENT)
    )
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_chars", "clean_text")
    return unpacked(rows, df.columns, *added)
