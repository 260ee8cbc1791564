"""Text functions: normal form and hash of markdown, counts, hints, markers, file names."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# What a lower-cased page behind a wall says, in order, and the signal it gives.
PAYWALL = [
    ("sign up to read this article for free", "signup_gate"),
    ("become a premium subscriber", "premium_gate"),
    ("purchase this article", "purchase_gate"),
    ("already a subscriber? [log in]", "subscriber_login_gate"),
    ("just want immediate access to this one article? purchase it now", "purchase_gate"),
]
_SPACE = r"(?U)\s+"


def nfc(text: Column) -> Column:
    """Unicode composition; there is no built-in, so this is the one Arrow UDF of the text functions.

    Characters below U+0300 are composed already: only texts with others are sent to Python.
    """

    @F.pandas_udf("string")
    def compose(batch: pd.Series) -> pd.Series:
        return batch.map(lambda x: x if x is None else unicodedata.normalize("NFC", x))

    return F.coalesce(compose(F.when(text.rlike(r"[^\x00-\x{2FF}]"), text)), text)


def normalize_markdown(text: Column, composed: bool = False) -> Column:
    """The form of markdown that is hashed. ``composed``: the text is known to be NFC, so no Python is needed."""
    t = F.coalesce(text, F.lit(""))
    t = t if composed else nfc(t)
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", "")
    t = F.regexp_replace(t, "[ \t]+", " ")
    t = F.regexp_replace(t, "\r\n?", "\n")
    lines = F.transform(F.split(t, "\n"), lambda x: strip(x))
    return F.lower(strip(F.array_join(lines, "\n")))


def strip(text: Column) -> Column:
    """Without Unicode white space at the ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def hash_markdown(text: Column, composed: bool = False) -> Column:
    return F.sha2(normalize_markdown(text, composed), 256)


def word_count(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(F.filter(F.split(text, _SPACE), lambda x: x != "")))


def sentence_count(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(F.filter(F.split(text, "[.!?。！？]+"), lambda x: strip(x) != "")))


def needs_expansion(summary: Column, chars: int = 220, sentences: int = 4) -> Column:
    s = strip(F.coalesce(summary, F.lit("")))
    return (s == "") | (F.length(s) < chars) | (sentence_count(s) < sentences)


def summary_hint(text: Column) -> Column:
    """The first three non-blank lines without leading '#', joined by blanks, at most 480 characters."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n"), lambda x: strip(F.regexp_replace(strip(x), "^#+|#+$", ""))), lambda x: x != "")
    return F.rtrim(F.substring(F.array_join(F.slice(lines, 1, 3), " "), 1, 480))


def paywall_signal(text: Column) -> Column:
    """The signal of the first marker in the text, or null."""
    low = F.lower(text)
    out = F.when(F.contains(low, F.lit(PAYWALL[0][0])), PAYWALL[0][1])
    for marker, signal in PAYWALL[1:]:
        out = out.when(F.contains(low, F.lit(marker)), signal)
    return out


def json_object(text: Column) -> Column:
    """From the first '{' to the last '}' of a text; '' where there is none."""
    return F.regexp_extract(text, r"(?s)\{.*\}", 0)


def one_line(text: Column) -> Column:
    """Unit separators and line ends become blanks; null gives ''."""
    return F.translate(F.coalesce(text, F.lit("")), "\x1f\r\n", "   ")


def file_name(title: Column) -> Column:
    """Slashes and colons become '_'; letters, digits, '_', blanks, '.' and '-' stay; at most 80 characters."""
    return F.substring(F.regexp_replace(F.translate(F.coalesce(title, F.lit("")), "/:", "__"), r"[^\p{L}\p{N}_ .\-]", ""), 1, 80)


def prompt(template: str, retry_note: Column | None = None, **fields: Column) -> Column:
    """A template with ``%s`` for each field in order; null fields read 'N/A'. A retry note that is not blank follows as a paragraph."""
    text = F.format_string(template, *[F.coalesce(c.cast("string"), F.lit("N/A")) for c in fields.values()])
    return text if retry_note is None else F.concat(text, F.when(F.trim(retry_note) != "", F.concat(F.lit("\n\n"), F.trim(retry_note))).otherwise(F.lit("")))


def with_defaults(answer: Column, hint: Column, stage: str) -> Column:
    """A model answer (title, priority_level) with defaults: the hint or 'Untitled' for the title; the priority is 'low' where the answer is analysed and 'medium' where it is written."""
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    return F.struct(F.coalesce(blank(answer["title"]), blank(hint), F.lit("Untitled")).alias("title"), F.coalesce(blank(answer["priority_level"]), F.lit({"analysis": "low", "write": "medium"}[stage])).alias("priority_level"))
