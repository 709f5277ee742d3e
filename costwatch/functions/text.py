"""Text expressions: normalising, tokenising, parsing and display formats."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from costwatch import settings
from costwatch.functions.measures import decimal_text

# Characters of Unicode white space. Java's plain \s covers ASCII only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Token patterns of the two text indexes.
LEXICAL_TOKEN = r"[a-z0-9]+(?:-[a-z0-9]+)*"
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once, however often `body` uses it."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(c, F.lit(WHITESPACE))


def normalize_text(c: Column) -> Column:
    """Lower case, single blanks, no outer blanks."""
    blanks = F.translate(F.lower(c), WHITESPACE, " " * len(WHITESPACE))
    collapsed = let(
        blanks, lambda t: F.when(t.contains("  "), F.regexp_replace(t, " {2,}", " ")).otherwise(t)
    )
    return F.trim(collapsed)


def tokenize(c: Column) -> Column:
    """Alphanumeric tokens in text order; hyphenated words and dates stay whole."""
    return F.regexp_extract_all(F.lower(c), F.lit(LEXICAL_TOKEN), F.lit(0))


def bigrams(tokens: Column) -> Column:
    """Neighbouring tokens, joined by a blank."""

    def pairs(t: Column) -> Column:
        n = F.greatest(F.size(t) - 1, F.lit(0))
        return F.zip_with(
            F.slice(t, 1, n), F.slice(t, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)
        )

    return let(tokens, pairs)


def word_ngrams(c: Column, stop_words: Sequence[str]) -> Column:
    """Words of two or more characters and their bigrams; stop words go before pairing."""
    words = F.regexp_extract_all(F.lower(c), F.lit(WORD_TOKEN), F.lit(0))
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(*stop_words))
    return let(words, lambda w: F.concat(w, bigrams(w)))


def matches_any(normal: Column, patterns: Sequence[str]) -> Column:
    """Whether a pattern is found in normalised text.

    Plain phrases are looked up as substrings, without those that hold another phrase. The
    other patterns run as regular expressions, and only where all their fixed parts occur:
    an alternation over whole texts costs many times more.
    """
    plain = [p for p in patterns if re.escape(p).replace("\\ ", " ") == p]
    found = [normal.contains(p) for p in plain if not any(q != p and q in p for q in plain)]
    for pattern in patterns:
        if pattern not in plain:
            parts = [p for p in re.split(r"\(.*?\)|.\?|\.\*", pattern) if p.strip()]
            fixed = reduce(Column.__and__, [normal.contains(p) for p in parts])
            found.append(fixed & normal.rlike(pattern))
    return reduce(Column.__or__, found)


def has_positive_evidence(text: Column) -> Column:
    return let(normalize_text(text), lambda t: matches_any(t, settings.POSITIVE_PATTERNS))


def has_negative_evidence(text: Column) -> Column:
    return let(normalize_text(text), lambda t: matches_any(t, settings.NEGATIVE_PATTERNS))


def note_snippet(text: Column) -> Column:
    """First sentence of the note behind its marker, cut to 60 characters."""
    marker = settings.NOTE_MARKER
    note = F.when(text.contains(marker), F.split(text, marker)[1]).otherwise(text)
    sentence = F.substring_index(note, ".", 1)
    return F.concat(
        strip(F.substring(sentence, 1, 60)),
        F.when(F.char_length(sentence) > 60, "...").otherwise(""),
    )


def signed_percent(pct: Column) -> Column:
    """`+12.3` / `-4.0`, ties to even."""
    size = F.abs(pct)
    number = F.when(size == float("inf"), "inf").otherwise(
        decimal_text(size, 1)
    )
    return F.concat(F.when(pct >= 0, "+").otherwise("-"), number)


def comparison_text(pct: Column, phrase: str) -> Column:
    return F.when(pct.isNull() | F.isnan(pct), "N/A").otherwise(
        F.concat(signed_percent(pct), F.lit("% " + phrase))
    )


def extract_percent(text: Column) -> Column:
    """First percentage in a display string, else the whole string."""
    found = F.regexp_extract(text, r"[+-]?\d+\.?\d*%", 0)
    return F.when(found != "", found).otherwise(text)


def parse_number(text: Column) -> Column:
    """First signed decimal in a string; null if there is none."""
    return F.regexp_extract(text, r"[-+]?\d+(?:\.\d+)?", 0).try_cast("double")


def clean_note_id(note_id: Column) -> Column:
    """Trimmed id; blank and the usual words for a missing value become null."""
    trimmed = strip(note_id)
    return F.when(~F.lower(trimmed).isin("", "none", "nan", "na"), trimmed)


def format_money(amount: Column) -> Column:
    return F.when(amount.isNull() | F.isnan(amount), "N/A").otherwise(
        F.concat(F.lit("₹"), decimal_text(amount, 2))
    )


def status_label(flagged: Column) -> Column:
    label = F.lit(None).cast("string")
    for verdict, text in settings.STATUS_LABELS.items():
        label = F.when(flagged == verdict, text).otherwise(label)
    return label


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))).cast("bigint")
