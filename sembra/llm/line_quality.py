"""Line-first cleaning: rules drop lines, and documents that lose too much text are rejected.

Every ``\\n``-split line with a word is judged by three rules.

* Punctuation: it must end in a terminal mark (closing quotes and brackets may follow) or be a
  long line with a mark inside; symbols may not exceed a share of its word characters, nor may
  half of the words of a longer line end in ``!`` or ``?``.
* Navigation: stand-alone separators (``|``, ``»`` ...) may not be two or more and a quarter of
  its words.
* Boilerplate: a line of at most ``LineRules.boilerplate_words`` words holds no notice phrase.

Lines that fail are removed. A document is kept unless it fails the base (fewer than 50 words, or
over half of its words in repeated 3-word windows) or loses more than ``LineRules.max_lost_percent``
of its word characters. All counts are integers over the whole text. Null and empty texts have no
words, fail the base and are not kept; repeated rows are judged each by itself.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sembra.llm.common import keep_rows, map_columns

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SEPARATORS = ("|", "»", "›", "·", "•", "→", "/", ">")
#: Phrases of notices, menus and prompts.
BOILERPLATE = (
    "licensed under", "all rights reserved", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "accept cookies", "uses cookies", "javascript", "lorem ipsum", "click here",
    "subscribe", "sign up", "log in", "read more", "share this", "copyright", "powered by",
    "skip to content", "back to top",
)
TERMINAL = re.compile(r"[.!?…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*\Z")
NOTICE = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())
COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " lost_chars long, n_lost_lines long, base_failed boolean, kept boolean"
)


@dataclass(frozen=True)
class LineRules:
    long_line_words: int = 10
    symbol_percent: int = 10
    shout_words: int = 4
    boilerplate_words: int = 30
    max_lost_percent: int = 40
    min_words: int = 50
    max_repeat_percent: int = 50


def word_chars(text: str) -> int:
    """Code points in words, which ASCII white space separates."""
    return len(text) - sum(text.count(c) for c in SPACES)


def repeated_words(words: list) -> int:
    """Words covered by 3-word windows that are found twice or more, first ones included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total = end = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def line_fails(line: str, words: list[bytes], rules: LineRules) -> bool:
    """Whether a line with words breaks a punctuation, navigation or boilerplate rule."""
    n = len(words)
    if not TERMINAL.search(line) and not (
        n >= rules.long_line_words and any(mark in line for mark in ".!?;:,")
    ):
        return True
    symbols = sum(line.count(c) for c in SYMBOLS)
    if 100 * symbols > rules.symbol_percent * word_chars(line):
        return True
    if n >= rules.shout_words and 2 * (line.count("!") + line.count("?")) >= n:
        if 2 * sum(w.endswith((b"!", b"?")) for w in words) >= n:
            return True
    if any(s in line for s in SEPARATORS):
        alone = sum(w.decode() in SEPARATORS for w in words)
        if alone >= 2 and 4 * alone >= n:
            return True
    return n <= rules.boilerplate_words and NOTICE.search(line.encode().lower()) is not None


def clean_lines(text: str | None, rules: LineRules) -> tuple[list[str], int, int, int, int]:
    """(kept lines with a word, lines with a word, distinct ones, removed ones, removed characters)."""
    kept, seen, n, lost, chars = [], set(), 0, 0, 0
    for line in (text or "").split("\n"):
        words = line.encode().split()
        if not words:
            continue
        n += 1
        seen.add(line)
        if line_fails(line, words, rules):
            lost += 1
            chars += word_chars(line)
        else:
            kept.append(line)
    return kept, n, len(seen), lost, chars


def judge(text: str | None, rules: LineRules) -> tuple:
    """The values of ``COLUMNS`` for one text."""
    text = text or ""
    words = text.encode().split()
    n, chars = len(words), word_chars(text)
    repeated = repeated_words(words)
    _, lines, distinct, lost_lines, lost = clean_lines(text, rules)
    failed = n < rules.min_words or 100 * repeated > rules.max_repeat_percent * n
    kept = not failed and 100 * lost <= rules.max_lost_percent * chars
    symbols = sum(text.count(c) for c in SYMBOLS)
    return n, chars, symbols, lines - distinct, repeated, lost, lost_lines, failed, kept


def line_quality(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: LineRules = LineRules()) -> DataFrame:
    """``key`` and ``COLUMNS``, one row per row of ``docs``; a narrow job without a shuffle."""
    selected = docs.select(key, text)
    kind = selected.schema[0].dataType.simpleString()

    def make():
        def run(keys, texts):
            return keys, *(zip(*(judge(t, rules) for t in texts)) if texts else [[]] * 9)

        return run

    return map_columns(selected, f"`{key}` {kind}, {COLUMNS}", make)


def cleaned_texts(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: LineRules = LineRules()) -> DataFrame:
    """``key`` and the text without its failing lines (empty if none is left)."""
    selected = docs.select(key, text)
    kind = selected.schema[0].dataType.simpleString()
    return map_columns(
        selected, f"`{key}` {kind}, text string",
        lambda: lambda keys, texts: (keys, ["\n".join(clean_lines(t, rules)[0]) for t in texts]),
    )


def keep_good(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    return keep_rows(docs, text, lambda: lambda value: judge(value, rules)[-1])


def quality_sql(rules: LineRules = LineRules()) -> str:
    """The same rows in DuckDB SQL over the view ``documents``."""
    word = "'[^\\x20\\x09-\\x0D]+'"
    seps = ", ".join(f"'{s}'" for s in SEPARATORS)
    notices = "|".join(re.escape(p) for p in BOILERPLATE).replace("\\ ", " ")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (
  SELECT rid, line, regexp_extract_all(line, {word}) AS words,
         length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
),
judged AS (
  SELECT rid, line, chars,
    (NOT regexp_matches(line, '[.!?…。！？]["''”’»)\\]]*[\\x20\\x09-\\x0D]*\\z')
     AND NOT (len(words) >= {rules.long_line_words} AND regexp_matches(line, '[.!?;:,]')))
    OR 100 * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > {rules.symbol_percent} * chars
    OR (len(words) >= {rules.shout_words}
        AND 2 * len(list_filter(words, lambda w: w[-1:] IN ('!', '?'))) >= len(words))
    OR (len(list_filter(words, lambda w: w IN ({seps}))) >= 2
        AND 4 * len(list_filter(words, lambda w: w IN ({seps}))) >= len(words))
    OR (len(words) <= {rules.boilerplate_words}
        AND regexp_matches(translate(line, '{upper}', '{upper.lower()}'), '{notices}')) AS fails
  FROM lines WHERE len(words) > 0
),
by_line AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines,
         coalesce(sum(chars) FILTER (fails), 0) AS lost_chars, count(*) FILTER (fails) AS n_lost_lines
  FROM judged GROUP BY rid
),
placed AS (
  SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS i
  FROM (SELECT rid, regexp_extract_all(t, {word}) AS words FROM d)
),
ahead AS (
  SELECT rid, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2
  FROM placed WINDOW o AS (PARTITION BY rid ORDER BY i)
),
windows AS (
  SELECT rid, i, w2 IS NOT NULL AND count(*) OVER (PARTITION BY rid, w, w1, w2) > 1 AS again FROM ahead
),
covered AS (
  SELECT rid, again OR coalesce(lag(again, 1) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS inside
  FROM windows WINDOW o AS (PARTITION BY rid ORDER BY i)
),
by_word AS (SELECT rid, count(*) AS n_words, count(*) FILTER (inside) AS n_repeat_words FROM covered GROUP BY rid),
counted AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(lost_chars, 0) AS lost_chars, coalesce(n_lost_lines, 0) AS n_lost_lines
  FROM d LEFT JOIN by_line USING (rid) LEFT JOIN by_word USING (rid)
),
based AS (
  SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed
  FROM counted
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(lost_chars AS BIGINT) AS lost_chars,
  CAST(n_lost_lines AS BIGINT) AS n_lost_lines, base_failed,
  NOT base_failed AND 100 * lost_chars <= {rules.max_lost_percent} * word_chars AS kept
FROM based"""
