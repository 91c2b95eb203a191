"""Line-first cleaning by built-in expressions only.

Each line is judged by itself: punctuation (symbols, shouting, long lines without any end of
a sentence), navigation (items between separators) and boilerplate phrases. Failing lines
go; a document that loses too much of its text with them is rejected, as is one that fails
the base rules on its whole text. No shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

BLANK = " \t\n\x0b\x0c\r"
BLANKS, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
# Found in lines whose words are not each followed by one space and a word, up to the last.
UNEVEN = r"[\x09-\x0D]|\x20\x20|^\x20|\x20\z|^\z"
SYMBOLS = "#*$%&|<>"
SEPARATORS = r"(?<![^\x20\x09-\x0D])[|»›·•>/](?![^\x20\x09-\x0D])"
SENTENCE_END = ".!?…。！？"
BOILERPLATE = (
    r"(?i)\b(accept (all )?cookies|uses? cookies|cookie (policy|settings)|privacy policy"
    r"|terms of (use|service)|all rights reserved|enable javascript|lorem ipsum|licen[sc]ed under"
    r"|subscribe to our|sign up for|click here|skip to content|share on (facebook|twitter))\b"
)
WINDOW = 8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANK))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANKS))


def _number_of(text: Column, characters: str) -> Column:
    """How many of some characters are in a text; most texts have none and are only searched."""
    pattern = "[" + "".join("\\" + c for c in characters) + "]"
    without = F.length(F.translate(text, characters, ""))
    return F.when(text.rlike(pattern), F.length(text) - without).otherwise(F.lit(0))


def _visible(text: Column) -> Column:
    """Number of characters that are not blank."""
    bare = F.replace(text, F.lit(" "), F.lit(""))
    return F.length(bare) - _number_of(bare, BLANK[1:])


def repeated_words(words: Column) -> Column:
    """Number of words inside windows of eight that occur more than once in the text.

    Only texts in which some window repeats (by hash) are sorted; a window is then told by
    96 bits of two hashes. Texts of fewer than nine words have none.
    """

    def windows(of: Callable[[Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1), of)

    def mark(i: Column) -> Column:
        part = F.slice(words, i, WINDOW)
        return F.struct(F.xxhash64(part).alias("a"), F.hash(part).alias("b"), i.alias("i"))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))

    def starts(marks: Column) -> Column:
        kept = F.filter(
            marks,
            lambda x, k: same(x, F.get(marks, k - 1)) | same(x, F.get(marks, k + 1)),
        )
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        ends = F.transform(
            at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(ends, F.lit(0).cast("bigint"), lambda total, n: total + n)

    plain = windows(lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    repeats = let(plain, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    exact = let(F.sort_array(windows(mark)), lambda marks: let(starts(marks), covered))
    return F.when((F.size(words) > WINDOW) & repeats, exact).otherwise(F.lit(0).cast("bigint"))


def _number_of_words(line: Column) -> Column:
    """Number of words of a line; spaces are counted only where they tell it."""
    spaces = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(line.rlike(UNEVEN), F.regexp_count(line, F.lit(WORD))).otherwise(spaces + 1)


def line_failures(line: Column) -> Column:
    """Names of the rules that a line breaks; lines without a word break none."""
    words = _number_of_words(line)
    symbols = _number_of(line, SYMBOLS)
    shouts = F.length(line) - F.length(F.replace(line, F.lit("!"), F.lit("")))
    separators = F.regexp_count(line, F.lit(SEPARATORS))
    rules = {
        "punctuation": ((symbols > 0) & (symbols * 10 > _visible(line)))
        | ((shouts >= 3) & (shouts * 3 > words))
        | ((words >= 10) & ~line.rlike(f"[{SENTENCE_END}]")),
        "navigation": line.rlike(SEPARATORS) & (separators * 5 >= words),
        "boilerplate": line.rlike(BOILERPLATE),
    }
    named = F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    return F.array_compact(named)


def clean_lines(rows: DataFrame, text: str = "text", max_lost: float = 0.5, min_words: int = 20,
                max_repeated: int = 30) -> DataFrame:
    """``rows`` with the counts of the base rules, both verdicts and ``cleaned``.

    New columns replace given ones of their names: ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, lines_removed, chars_removed`` (long), ``base_failed, kept``
    (boolean), ``cleaned`` (the lines that pass, joined by line feeds). Characters are counted
    without blanks; ``max_lost`` is the share of them that may go, exactly that much included.
    A null text counts as empty, has no words and so fails the base rules. Rows that repeat
    are judged alike; an empty table gives an empty one.
    """
    given = [c for c in rows.columns]
    body = F.coalesce(F.col(text), F.lit(""))
    zero = F.lit(0).cast("bigint")
    frame = rows.select(
        *[F.col(f"`{c}`").alias(f"_given_{k}") for k, c in enumerate(given)],
        body.alias("_body"),
        words_of(body).alias("_words"),
        F.transform(
            F.split(body, "\n"),
            lambda x: F.struct(
                x.alias("line"),
                _visible(x).cast("bigint").alias("chars"),
                (F.size(line_failures(x)) > 0).alias("failed"),
            ),
        ).alias("_lines"),
    )
    lines = F.col("_lines")
    full = F.transform(F.filter(lines, lambda x: x["chars"] > 0), lambda x: x["line"])
    visible = F.aggregate(lines, zero, lambda n, x: n + x["chars"])
    frame = frame.select(
        "*",
        F.size("_words").cast("bigint").alias("n_words"),
        visible.alias("word_chars"),
        _number_of(F.col("_body"), SYMBOLS).cast("bigint").alias("n_symbols"),
        let(full, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size(F.filter(lines, lambda x: x["failed"])).cast("bigint").alias("lines_removed"),
        F.aggregate(lines, zero, lambda n, x: n + F.when(x["failed"], x["chars"]).otherwise(zero)).alias(
            "chars_removed"
        ),
        F.array_join(
            F.transform(F.filter(lines, lambda x: ~x["failed"]), lambda x: x["line"]), "\n"
        ).alias("cleaned"),
    )
    frame = frame.withColumn(
        "base_failed",
        (F.col("n_words") < min_words)
        | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words")),
    ).withColumn(
        "kept", ~F.col("base_failed") & (F.col("chars_removed") <= F.lit(max_lost) * F.col("word_chars"))
    )
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines_removed",
           "chars_removed", "base_failed", "kept", "cleaned"]
    return frame.select(
        *[F.col(f"_given_{k}").alias(c) for k, c in enumerate(given) if c not in new], *new
    )
