"""Quality rules, line first: bad lines go, then documents that lost too much text.

Everything is built-in column functions in one projection: no shuffle, no Python. A line without a word
is neither counted nor judged. A line fails if one of these holds:

    punctuation   no sentence ends in it
    navigation    separators stand between its words (three at least, a fifth of the words)
    symbols       symbol characters in three tenths of its words or more
    shouting      capitals are over two fifths of its characters
    boilerplate   a phrase of licences, notices, site furniture or placeholder text

A document is rejected if less than ``LEAST_KEPT`` percent of the characters of its lines remain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rillwork.llm.common import SPACE, WORD, free_name, quoted

LEAST_WORDS, MOST_REPEATED, LEAST_KEPT = 50, 50, 50

SYMBOLS = "#*$%&|<>"
#: Marks that end a sentence in the scripts that have one (Latin, CJK, Devanagari, Arabic, Armenian, Ethiopic,
#: Burmese, Khmer, Tibetan), and the letters of scripts without any (Thai, Lao): a line may just end in them.
ENDS, UNMARKED = ".!?…。！？।॥۔؟։።፧။។៕།", "\u0e01-\u0eff"
SENTENCE_END = rf"[{ENDS}][\"'»”’)\]]*([{SPACE}]|\z)|[{UNMARKED}][{SPACE}]*\z"
SEPARATORS = "|»›•·>/"
SEPARATOR = rf"(?:^|[{SPACE}])[{SEPARATORS}](?=[{SPACE}]|\z)"
SYMBOL_WORD = rf"(?:^|[{SPACE}])[^{SPACE}{SYMBOLS}]*[{SYMBOLS}]"
BOILERPLATE = (r"(?i)licensed under|all rights reserved|terms of (?:use|service)|privacy policy"
               r"|(?:use|accept|uses) cookies|enable javascript|lorem ipsum|click here|copyright ©"
               r"|subscribe to our|sign up for|powered by|skip to (?:main )?content")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once per row."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more. Windows are sorted by hash, so equal
    ones are neighbours; their words are compared as well."""
    def window(word, i):
        return F.struct(F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)).alias("h"),
                        i.alias("i"))

    def equal(a, b):
        same = a["h"] == b["h"]
        for k in range(3):
            same = same & (F.get(words, a["i"] + k) == F.get(words, b["i"] + k))
        return F.coalesce(same, F.lit(False))

    def covered(ordered):
        twice = F.filter(ordered, lambda x, i: equal(x, F.get(ordered, i - 1))
                         | equal(x, F.get(ordered, i + 1)))["i"]
        return let(twice, lambda at: F.size(F.array_union(F.array_union(
            at, F.transform(at, lambda p: p + 1)), F.transform(at, lambda p: p + 2))))

    windows = F.sort_array(F.transform(F.slice(words, F.lit(1), F.size(words) - 2), window))
    return F.when(F.size(words) < 4, 0).otherwise(let(windows, covered)).cast("bigint")


def line_fails(line: Column) -> Column:
    separators = matches(line, SEPARATOR)
    words = matches(line, WORD)
    capitals = F.length(F.regexp_replace(line, r"\P{Lu}+", ""))
    return (~line.rlike(SENTENCE_END)
            | (separators >= 3) & (separators * 5 >= words)
            | (matches(line, SYMBOL_WORD) * 10 >= words * 3)
            | (capitals * 5 > F.length(line) * 2)
            | line.rlike(BOILERPLATE))


def assess(df: DataFrame, text_col: str = "text", to: str = "quality") -> DataFrame:
    """The frame with a struct column; one of that name is replaced, all others stay:

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (bigint), n_lines and n_failed_lines
    (bigint; lines with a word), line_chars and kept_chars (bigint), cleaned (text of the lines that pass,
    joined by \\n), base_failed and kept (boolean). A null text counts as an empty one: no words, so it
    fails. Rows are judged on their own; equal rows get equal results.
    """
    text = F.coalesce(quoted(text_col), F.lit(""))

    def by_words(words):
        return F.struct(F.size(words).cast("bigint").alias("n_words"),
                        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
                        repeated_words(words).alias("n_repeat_words"))

    def by_lines(lines):
        judged = F.transform(lines, lambda x: F.struct(x.alias("line"), line_fails(x).alias("fails")))
        return let(judged, lambda j: F.struct(
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            F.size(lines).cast("bigint").alias("n_lines"), total(lines).alias("line_chars"),
            F.filter(j, lambda x: ~x["fails"])["line"].alias("passed")))

    def total(lines):
        return F.aggregate(lines, F.lit(0).cast("bigint"), lambda n, x: n + F.length(x))

    split = F.array_remove(F.split(text, rf"[{SPACE}]+"), "")
    with_word = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    w, l, symbols = (free_name(df, c) for c in ("__w", "__l", "__symbols"))
    found = df.withColumns({w: let(split, by_words), l: let(with_word, by_lines),
                            symbols: matches(text, f"[{SYMBOLS}]").cast("bigint")})
    n, kept = F.col(f"{w}.n_words"), total(F.col(f"{l}.passed"))
    failed = (n < LEAST_WORDS) | (F.col(f"{w}.n_repeat_words") * 100 > n * MOST_REPEATED)
    result = F.struct(
        n.alias("n_words"), F.col(f"{w}.word_chars"), F.col(symbols).alias("n_symbols"),
        F.col(f"{l}.n_dup_lines"), F.col(f"{w}.n_repeat_words"), F.col(f"{l}.n_lines"),
        (F.col(f"{l}.n_lines") - F.size(f"{l}.passed")).alias("n_failed_lines"), F.col(f"{l}.line_chars"),
        kept.alias("kept_chars"), F.array_join(f"{l}.passed", "\n").alias("cleaned"),
        failed.alias("base_failed"),
        (~failed & (kept * 100 >= F.col(f"{l}.line_chars") * LEAST_KEPT)).alias("kept"))
    return found.withColumn(to, result).drop(w, l, symbols)
