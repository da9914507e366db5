"""Cleaning against Python's own regular expressions on hand-written texts."""

import re

import pytest
from pyspark.sql import functions as F

from sembra.functions import text as tx
from sembra.sources.corpus import clean_corpus, clean_report

PATTERNS = {
    "strip_pgp": (re.compile(r"-----BEGIN PGP.*?-----END PGP.*?-----", re.DOTALL), ""),
    "strip_quote_lines": (re.compile(r"^[>|]+.*$", re.MULTILINE), ""),
    "strip_emails": (re.compile(r"\S+@\S+\.\S+"), ""),
    "strip_urls": (re.compile(r"https?://\S+|www\.\S+"), ""),
    "strip_paths": (re.compile(r"(?:[A-Za-z]:\\|/)(?:[\w.\-]+[/\\])+[\w.\-]*"), ""),
    "blank_nonalpha_lines": (re.compile(r"^[^a-zA-Z]*$", re.MULTILINE), ""),
    "collapse_newlines": (re.compile(r"\n{3,}"), "\n\n"),
    "collapse_spaces": (re.compile(r"[ \t]{2,}"), " "),
}

TEXTS = [
    "",
    "   \n\t ",
    "\u00a0\u2003",
    "\x1c\x1fabc\x1d",
    "plain words only",
    "Subject: a\nFrom: b\nbody: not header because body starts? x\n\nrest",
    "Subject: \nFrom: b\ntext",
    "A: 1\nB: 2\nC: 3\nD: 4\nE: 5\nF: 6\nG: 7\nH: 8\nI: 9\nJ: 10\nbody",
    "  Indented: yes\nNext: line\nbody text",
    "A: 1\nB: 2",
    "> quoted\n > protected by a space\n|bar\n>> deep",
    "a@b.c",
    "(see joe@example.com), now",
    "bad@ address@ x@y z@w.q!",
    "http://a.b/c?d#e www.site.org HTTP://UP.ORG ftp://x",
    "/tmp /tmp/a C:\\dir\\sub\\f.txt /usr/local/bin/x-y_z.tar.gz and/or a//b",
    "/" + "ab/" * 3000 + "end",
    "x" * 5000 + "@" + "y" * 10 + ".com tail",
    "-----BEGIN PGP MESSAGE-----\nabc\n-----END PGP MESSAGE-----\nkeep",
    "-----BEGIN PGP A-----\nno end",
    "Только кириллица\nand latin\n123\n---\n\n456\nlast",
    "١٢٣ ٤٥٦\nword",
    "a\n\n\n\n\nb\n\nc",
    "a  b\t\tc \t d",
    "line\rwith cr\u2028and ls\x85nel\nnext",
    "no-break\u00a0space@host.org\u00a0rest",
    "e\u0301clat na\u00efve 中文 only\n中文\nend",
    "In article <x@y.z> bob wrote:\n> hi\nok\n--\nsig",
    "😀 emoji text with more than thirty characters inside",
]


#: What the header rule and the whole chain leave of ``TEXTS``, as literals.
WITHOUT_HEADERS = [
    TEXTS[0],  # unchanged
    TEXTS[1],  # unchanged
    TEXTS[2],  # unchanged
    TEXTS[3],  # unchanged
    TEXTS[4],  # unchanged
    '\nrest',
    TEXTS[6],  # unchanged
    'I: 9\nJ: 10\nbody',
    'body text',
    '',
    TEXTS[10],  # unchanged
    TEXTS[11],  # unchanged
    TEXTS[12],  # unchanged
    TEXTS[13],  # unchanged
    TEXTS[14],  # unchanged
    TEXTS[15],  # unchanged
    TEXTS[16],  # unchanged
    TEXTS[17],  # unchanged
    TEXTS[18],  # unchanged
    TEXTS[19],  # unchanged
    TEXTS[20],  # unchanged
    TEXTS[21],  # unchanged
    TEXTS[22],  # unchanged
    TEXTS[23],  # unchanged
    TEXTS[24],  # unchanged
    TEXTS[25],  # unchanged
    TEXTS[26],  # unchanged
    TEXTS[27],  # unchanged
    TEXTS[28],  # unchanged
]
CLEANED = [
    TEXTS[0],  # unchanged
    '',
    '',
    'abc',
    TEXTS[4],  # unchanged
    'rest',
    TEXTS[6],  # unchanged
    'I: 9\nJ: 10\nbody',
    'body text',
    '',
    '> protected by a space',
    '',
    '(see now',
    'bad@ address@ x@y',
    'HTTP://UP.ORG ftp://x',
    '/tmp and/or a//b',
    '',
    'tail',
    'keep',
    TEXTS[19],  # unchanged
    'and latin\n\nlast',
    'word',
    'a\n\nb\n\nc',
    'a b c d',
    TEXTS[24],  # unchanged
    'no-break\xa0\xa0rest',
    'éclat naïve 中文 only\n\nend',
    'In article bob wrote:\n\nok\n\nsig',
    TEXTS[28],  # unchanged
]


def apply(spark, step):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    return [r["out"] for r in frame.select("id", step(F.col("text")).alias("out")).orderBy("id").collect()]


@pytest.mark.parametrize("name", sorted(PATTERNS))
def test_step_equals_python(spark, name):
    pattern, by = PATTERNS[name]
    assert apply(spark, getattr(tx, name)) == [pattern.sub(by, t) for t in TEXTS]


def test_header_zone(spark):
    assert apply(spark, tx.drop_header_zone) == WITHOUT_HEADERS


def test_strip_ends(spark):
    assert apply(spark, tx.strip_ends) == [t.strip() for t in TEXTS]


def test_blank(spark):
    assert apply(spark, tx.blank_to_empty) == [t if t.strip() else "" for t in TEXTS]


def test_whole_chain(spark):
    assert apply(spark, tx.clean_document) == CLEANED


def test_null_text_becomes_empty(spark):
    frame = spark.createDataFrame([(1, None)], "doc_id int, text string")
    assert frame.select(tx.clean_document(F.col("text")).alias("t")).first()["t"] == ""
    assert clean_report(frame).first().asDict() == {"kept": 0, "discarded": 1}


def test_length_limit_counts_characters(spark):
    texts = ["a" * 29, "a" * 30, "é" * 29 + "a", "  " + "b" * 30 + "  ", "😀" * 15 + "a" * 15, None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    assert sorted(r["doc_id"] for r in clean_corpus(frame).collect()) == [1, 2, 3, 4]
    assert clean_report(frame).first().asDict() == {"kept": 4, "discarded": 2}


def test_sections(spark):
    cases = {
        "From: a\nTo: b\n\nbody\n-- \nsig": "body",
        "no blank line at all": "",
        "h\n\nfirst\n>quoted\nJoe wrote:\nlast": "first\nlast",
        "h\n\none line": "one line",
        "h\n\n---\nafter": "---\nafter",
    }
    frame = spark.createDataFrame(list(enumerate(cases)), "id int, text string")
    found = [r["t"] for r in frame.orderBy("id").select(tx.strip_sections(F.col("text")).alias("t")).collect()]
    assert found == list(cases.values())


def test_cache_key(spark):
    frame = spark.createDataFrame([(" What?\n",), ("what?",), ("WHAT?\u00a0",)], "q string")
    assert frame.select(tx.cache_key(F.col("q")).alias("k")).distinct().count() == 1
