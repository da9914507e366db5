"""Text cleaning as native Column expressions.

The steps run in the order of :func:`clean_document`; each is usable alone. Flags: ``(?d)``
makes only ``\\n`` end a line and ``(?U)`` makes ``\\s``/``\\w`` Unicode-aware.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define what is removed. Two are written so that they stay
# linear on very long tokens, with the same matches: an email is sought only at the start of a
# token (it always takes the whole token), and path parts never give characters back.
PGP_BLOCK = r"(?s)-----BEGIN PGP.*?-----END PGP.*?-----"
QUOTE_LINE = r"(?md)^[>|]+.*$"
EMAIL = r"(?U)(?<!\S)\S+@\S+\.\S+"
URL = r"(?U)https?://\S+|www\.\S+"
FILE_PATH = r"(?U)(?:[A-Za-z]:\\|/)(?:[\w.\-]++[/\\])++[\w.\-]*"
HEADER_LINE = r"(?U)^\s*[A-Za-z\-]+:\s+\S.*$"
NON_ALPHA_LINE = r"(?md)^[^a-zA-Z]*$"
NEWLINE_RUN = r"\n{3,}"
SPACE_RUN = r"[ \t]{2,}"
EDGE_SPACE = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"
ANY_INK = r"(?U)[^\s\x1c-\x1f]"
RULE_LINE = r"(?U)^[\s\x1c-\x1f]*-*[\s\x1c-\x1f]*$"
ATTRIBUTION = r"writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\||^>"
MAX_HEADER_LINES = 8
MIN_CLEAN_LENGTH = 30


def blank_to_empty(text: Column) -> Column:
    return F.when(text.isNull() | ~text.rlike(ANY_INK), F.lit("")).otherwise(text)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated a single time, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _remove(text: Column, pattern: str, *marks: str) -> Column:
    """Delete ``pattern`` from texts that contain one of ``marks``, which every match contains.

    The containment test is a byte search; texts without a mark skip the regular expression.
    """

    def strip(t: Column) -> Column:
        present = F.lit(False)
        for mark in marks:
            present = present | t.contains(mark)
        return F.when(present, F.regexp_replace(t, pattern, "")).otherwise(t)

    return _once(text, strip)


def strip_pgp(text: Column) -> Column:
    return _remove(text, PGP_BLOCK, "-----BEGIN PGP")


def strip_quote_lines(text: Column) -> Column:
    return _remove(text, QUOTE_LINE, ">", "|")


def strip_emails(text: Column) -> Column:
    return _remove(text, EMAIL, "@")


def strip_urls(text: Column) -> Column:
    return _remove(text, URL, "http", "www.")


def strip_paths(text: Column) -> Column:
    return _remove(text, FILE_PATH, "/", "\\")


def drop_header_zone(text: Column, max_lines: int = MAX_HEADER_LINES) -> Column:
    """Drop the leading run of ``Name: value`` lines, at most ``max_lines`` of them."""

    def after_headers(lines: Column) -> Column:
        # One flag per line of the head; the first 0 ends the zone.
        flags = F.transform(F.slice(lines, 1, max_lines), lambda line: line.rlike(HEADER_LINE).cast("int"))
        dropped = _once(flags, lambda f: F.coalesce(F.nullif(F.array_position(f, 0), F.lit(0)) - 1, F.size(f)))
        kept = _once(dropped.cast("int"), lambda n: F.slice(lines, n + 1, F.size(lines) - n))
        return F.array_join(kept, "\n")

    # Most texts start with an ordinary line: those are left untouched.
    return _once(
        text,
        lambda t: F.when(
            F.substring_index(t, "\n", 1).rlike(HEADER_LINE), _once(F.split(t, "\n", -1), after_headers)
        ).otherwise(t),
    )


def blank_nonalpha_lines(text: Column) -> Column:
    return F.regexp_replace(text, NON_ALPHA_LINE, "")


def collapse_newlines(text: Column) -> Column:
    return F.regexp_replace(text, NEWLINE_RUN, "\n\n")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, SPACE_RUN, " ")


def strip_ends(text: Column) -> Column:
    """Unicode-aware strip (the built-in ``trim`` removes U+0020 only)."""

    def strip(t: Column) -> Column:
        padded = F.substring(t, 1, 1).rlike(EDGE_SPACE) | F.substring(t, -1, 1).rlike(EDGE_SPACE)
        return F.when(padded, F.regexp_replace(t, EDGE_SPACE, "")).otherwise(t)

    return _once(text, strip)


CLEANING_STEPS = (
    blank_to_empty,
    strip_pgp,
    strip_quote_lines,
    strip_emails,
    strip_urls,
    strip_paths,
    drop_header_zone,
    blank_nonalpha_lines,
    collapse_newlines,
    collapse_spaces,
    strip_ends,
)


def clean_document(text: Column) -> Column:
    for step in CLEANING_STEPS:
        text = step(text)
    return text


def strip_sections(
    text: Column, headers: bool = True, footers: bool = True, quotes: bool = True
) -> Column:
    """Remove message header, signature and quoted lines, in that order.

    Header: everything up to the first empty line (all of it if there is none). Footer: from
    the last line made only of dashes or blanks, unless that is the first line. Quotes: lines
    that quote or introduce a quotation.
    """
    if headers:
        text = _once(
            text,
            lambda t: _once(
                F.instr(t, "\n\n"),
                lambda at: F.when(at > 0, F.substring(t, at + 2, F.length(t))).otherwise(F.lit("")),
            ),
        )
    if footers:

        def before_footer(t: Column) -> Column:
            def keep(lines: Column) -> Column:
                flags = F.transform(lines, lambda line: line.rlike(RULE_LINE).cast("int"))
                from_end = F.nullif(F.array_position(F.reverse(flags), 1), F.lit(0))
                return _once(
                    (F.size(lines) - from_end).cast("int"),
                    lambda n: F.when(n > 0, F.array_join(F.slice(lines, 1, n), "\n")).otherwise(t),
                )

            return _once(F.split(strip_ends(t), "\n", -1), keep)

        text = _once(text, before_footer)
    if quotes:
        kept = F.filter(F.split(text, "\n", -1), lambda line: ~line.rlike(ATTRIBUTION))
        text = F.array_join(kept, "\n")
    return text


def preview(text: Column, n: int = 500) -> Column:
    return F.substring(text, 1, n)


def short_category(category: Column) -> Column:
    return F.element_at(F.split(category, r"\.", -1), -1)


def cache_key(text: Column) -> Column:
    """Identity of a query: hash of its stripped, lower-cased text."""
    return F.sha2(F.lower(strip_ends(text)).cast("binary"), 256)
