"""Text expressions. All are built-in column expressions and stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns, defaults and limits that results depend on.
WHITESPACE = "".join(
    map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
MARKUP = "<[^<]+?>"
SENTENCE_END = "[.!?]+"
PREVIEW_CHARS = 50
SOURCE_PREVIEW_CHARS = 100
DISPLAY_PREVIEW_CHARS = 200
ELLIPSIS = "..."
LOADER_SUFFIXES = (".txt", ".md", ".pdf")
EMAIL = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"[0-9][0-9 ().-]{7,}[0-9]"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends; ``trim`` alone removes only spaces."""
    return F.btrim(text, F.lit(WHITESPACE))


def has_content(text: Column) -> Column:
    """Whether anything but white space is in the text; looks no further than needed."""
    return text.rlike(f"[^{WHITESPACE}]")


def strip_markup(html: Column) -> Column:
    """Remove tags. Character entities are left as they are."""
    return F.regexp_replace(html, MARKUP, "")


def sentences(text: Column) -> Column:
    """Array of stripped, non-empty sentences without their closing punctuation."""
    parts = F.transform(F.split(text, SENTENCE_END), strip)
    return F.filter(parts, lambda s: s != "")


def word_count(text: Column) -> Column:
    """Number of words parted by white space.

    Counting the parts of a stripped text takes a tenth of the time of counting matches.
    """
    bare = strip(text)
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, f"[{WHITESPACE}]+")))


def sentence_count(text: Column) -> Column:
    """Number of non-empty sentences: runs without closing punctuation that hold a word."""
    return F.regexp_count(text, F.lit(f"[^.!?{WHITESPACE}][^.!?]*"))


def universal_newlines(text: Column) -> Column:
    """What reading in text mode does to line ends."""
    return F.regexp_replace(text, "\r\n?", "\n")


def preview(text: Column, chars: int = PREVIEW_CHARS) -> Column:
    return F.substring(text, 1, chars)


def source_preview(text: Column, chars: int = SOURCE_PREVIEW_CHARS) -> Column:
    """Preview in which the ellipsis always follows, also after a short text."""
    return F.concat(preview(text, chars), F.lit(ELLIPSIS))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def file_suffix(path: Column) -> Column:
    """Last suffix with its dot, case kept; empty without one (also for ``.name``)."""
    return F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1)


def loader_file_type(path: Column) -> Column:
    """Suffix without its dot, as the directory loader records it."""
    return F.substring(file_suffix(path), 2, 1 << 30)


def upload_file_type(name: Column) -> Column:
    """Lower-cased part after the last dot; the whole name if it has none."""
    return F.regexp_extract(F.lower(name), r"([^.]*)$", 1)


def has_supported_suffix(path: Column) -> Column:
    return F.lower(file_suffix(path)).isin(*LOADER_SUFFIXES)


def strategy_label(prefix: str, size: int, overlap: int) -> str:
    return f"{prefix}-{size}-overlap-{overlap}"


def words_per_sentence(text: Column) -> Column:
    """Readability measure: mean sentence length in words, 0 for a text without words."""
    return F.round(word_count(text) / F.greatest(sentence_count(text), F.lit(1)), 2)


def contains_pii(text: Column) -> Column:
    """Whether the text holds something shaped like an e-mail address or phone number.

    The patterns start on one character only, so long runs are not scanned again
    from each of their characters; texts without ``@`` skip the first one.
    """
    return (text.contains("@") & text.rlike(EMAIL)) | text.rlike(PHONE)
