"""Spelling variants: vocabulary acceptor, one-edit transducer and acceptor again, composed.

Words are the maximal runs of Latin letters of all texts, lower-cased in A-Z. Two words are near if
one insertion, deletion or replacement of a code point makes one of the other.

The composition of an acceptor with the one-edit transducer and the acceptor accepts exactly the
pairs of near words. Its states are (p, e, q): acceptor states p and q, and e edits spent (0 or 1).
With no edit spent p and q are the same state; after the edit both read the same letters until both
accept. ``accepted_pairs`` enumerates the accepted pairs of one minimised acceptor: per state the
pairs of continuations whose first letters hold the edit, found once however many paths lead there,
and no state from which no pair can be reached is entered. An edit within a run of equal letters has
many places; the last one counts, so each pair is found once.

Work is dealt by initial state, so no task needs the whole vocabulary:

* late edits. Pairs with ``HEAD`` equal first letters meet in the composition that starts in the
  state reached by these letters: the acceptor of what follows them.
* early edits. All other near pairs have ``HEAD`` equal last letters; they meet in the composition of
  the acceptors of the reversed words, started in the state reached by those, and only states with at
  most ``HEAD`` letters to go are edited.

An initial state with more than ``most_words`` words is left by one more letter, again and again,
until all have fewer: pairs that share that letter go on with it, and the pairs whose edit lies
exactly there have equal rests, so they meet under (letters so far, rest), which at most one word
for each letter can have. Nothing is cut off; a hot beginning only means more initial states.

``n_near`` and forms come from the pairs by partial aggregation; roots by pointer jumping over the
forms (a form is several times as frequent, so chains are short). Null and empty texts have no words; a null
id counts as the empty text in the hash that drops letters; repeated rows count as often as they
occur; of equally frequent near words the first in code-point order is the form. Whole texts are
read; extra columns are not looked at. No words give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sembra.llm.common import LOWER, UPPER, map_batches
from sembra.session import lookup_join, materialize

#: Fixed by the contract: runs of these code points are words.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
TO_LOWER = str.maketrans(UPPER, LOWER)
HEAD = 3
COUNTED_WORDS = 200_000
PAIRS_A_BATCH = 20_000


@dataclass(frozen=True)
class SpellingRules:
    drop_one_in: int = 199  # runs whose hash this divides lose a letter; 0: none
    min_length: int = 2 * HEAD
    min_count: int = 5
    form_ratio: int = 5
    most_words: int = 5_000  # of one acceptor

    def __post_init__(self):
        if self.min_length < 2 * HEAD:
            raise ValueError(f"words need at least {2 * HEAD} letters for their beginnings and ends to be apart")


# --- the vocabulary ---


def word_counts(docs: DataFrame, text: str, key: str, rules: SpellingRules) -> DataFrame:
    """(word, n): the words of all texts and how often they occur; written once."""

    def run(batches):
        counts: Counter = Counter()
        for keys, texts in batches:
            for doc, value in zip(keys, texts):
                head = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(RUN.findall((value or "").translate(TO_LOWER))).items():
                    if rules.drop_one_in:
                        h = zlib.crc32(word.encode(), head)
                        if h % rules.drop_one_in == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                    if len(word) >= rules.min_length:
                        counts[word] += n
            if len(counts) > COUNTED_WORDS:
                yield list(counts.items())
                counts.clear()
        yield list(counts.items())

    partial = map_batches(docs.select(key, text), "word string, n long", run)
    whole = partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rules.min_count)
    return materialize(whole, "vocabulary")


# --- automata ---


class Acceptor:
    """Minimal acyclic acceptor of sorted distinct strings; equal states are merged as soon as no
    further string can change them. ``arcs[s]`` maps letters to states, ``final[s]`` accepts."""

    def __init__(self, strings):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        path: list[tuple[int, str]] = []  # (state, letter) of the last string, not yet merged
        last = ""

        def settle(depth: int) -> None:
            while len(path) > depth:
                state, letter = path.pop()
                child = self.arcs[state][letter]
                signature = (self.final[child], *self.arcs[child].items())
                self.arcs[state][letter] = known.setdefault(signature, child)

        for string in strings:
            depth, most = 0, min(len(string), len(last))
            while depth < most and string[depth] == last[depth]:
                depth += 1
            settle(depth)
            state = self.arcs[path[-1][0]][path[-1][1]] if path else 0
            for letter in string[depth:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[state][letter] = len(self.arcs) - 1
                path.append((state, letter))
                state = len(self.arcs) - 1
            self.final[state] = True
            last = string
        settle(0)


def common_strings(acceptor: Acceptor, p: int, q: int, most: int | None):
    """Strings, of at most ``most`` letters, that are accepted from both states."""
    arcs, final = acceptor.arcs, acceptor.final
    letters: list[str] = []
    stack = [(p, q, 0, "")]
    while stack:
        p, q, depth, letter = stack.pop()
        del letters[max(0, depth - 1) :]
        letters.append(letter)
        if final[p] and final[q]:
            yield "".join(letters)
        if most is not None and depth >= most:
            continue
        other = arcs[q]
        for c, to in arcs[p].items():
            if c in other:
                stack.append((to, other[c], depth + 1, c))


def edits_at(acceptor: Acceptor, state: int, most: int | None) -> list[tuple[str, str]]:
    """Pairs of continuations of ``state`` that differ by one edit of their first letters.

    ``most`` bounds the letters of the longer one.
    """
    arcs, found = acceptor.arcs[state], []
    rest = None if most is None else most - 1
    letters = list(arcs)
    for i, c in enumerate(letters):
        for d in letters[:i]:  # (p, 0, p) -> (p.c, 1, p.d): replacement
            found += [(c + x, d + x) for x in common_strings(acceptor, arcs[c], arcs[d], rest)]
        # (p, 0, p) -> (p.c, 1, p): deletion, seen from the other side insertion; not if c follows.
        found += [(c + x, x) for x in common_strings(acceptor, arcs[c], state, rest) if not x.startswith(c)]
    return found


def accepted_pairs(acceptor: Acceptor, most: int | None = None):
    """Pairs (u, w), each in one order, that the composition accepts; with ``most``, those with at most
    so many letters from the edit to the end."""
    n = len(acceptor.arcs)
    edits: dict[int, list] = {}
    # A walk in post-order finds which states can reach an edit.
    live = bytearray(n)
    done = bytearray(n)
    stack = [(0, False)]
    while stack:
        state, left = stack.pop()
        if left:
            edits[state] = edits_at(acceptor, state, most)
            live[state] = bool(edits[state]) or any(live[to] for to in acceptor.arcs[state].values())
        elif not done[state]:
            done[state] = 1
            stack.append((state, True))
            stack.extend((to, False) for to in acceptor.arcs[state].values() if not done[to])
    letters: list[str] = []
    walk = [(0, 0, "")]
    while walk:
        state, depth, letter = walk.pop()
        if not live[state]:
            continue
        del letters[max(0, depth - 1) :]
        letters.append(letter)
        if edits[state]:
            head = "".join(letters)
            for a, b in edits[state]:
                yield head + a, head + b
        walk.extend((to, depth + 1, c) for c, to in acceptor.arcs[state].items())


# --- initial states ---


def initial_states(words: DataFrame, rules: SpellingRules) -> DataFrame:
    """(late, head, rest, place, n): words by the initial state from which they are composed.

    ``head`` and ``rest`` make up the word (reversed where ``late`` is false). Where ``place`` is
    not null the edit lies exactly there, between ``head`` and the rest that equal words share.
    """
    forward = words.select(F.lit(True).alias("late"), F.col("word").alias("w"), "n")
    backward = words.select(F.lit(False).alias("late"), F.reverse("word").alias("w"), "n")
    open_, size = forward.union(backward), HEAD
    whole = None
    while True:
        named = open_.withColumn("head", F.substring("w", 1, size))
        hot = named.groupBy("late", "head").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > rules.most_words)
        hot = materialize(hot.select("late", "head"), "hot-states")
        rest, none = F.substr("w", F.lit(size + 1)), F.lit(None).cast("string")
        if hot.isEmpty():
            small = named.select("late", "head", rest.alias("rest"), none.alias("place"), "n")
            return small if whole is None else whole.union(small)
        marked = materialize(lookup_join(named, hot.withColumn("hot", F.lit(True)), ["late", "head"], "w", "left"), "states")
        small = marked.where("hot is null").select("late", "head", rest.alias("rest"), none.alias("place"), "n")
        split = marked.where("hot")
        # The edit of a pair lies at this letter: one word has it before the shared rest, the other too or not at all.
        here = split.select("late", "head", rest.alias("rest"), F.explode(F.array(rest, F.substr("w", F.lit(size + 2)))).alias("place"), "n")
        # Early edits lie within the last letters of the reversed words only.
        here = here.where(F.col("late") | (F.length("rest") <= HEAD)).distinct()
        whole = small.union(here) if whole is None else whole.union(small).union(here)
        open_ = split.where(F.length("w") > size).select("late", "w", "n")
        size += 1


def composed_pairs(states: DataFrame) -> DataFrame:
    """(a, b, na, nb): every pair of near words once, with their counts."""

    def groups(batches):
        name, strings = None, {}
        for late, heads, rests, places, counts in batches:
            for key, rest, n in zip(zip(late, heads, places), rests, counts):
                if key != name:
                    if len(strings) > 1:
                        yield name, strings
                    name, strings = key, {}
                strings[rest] = n
        if len(strings) > 1:
            yield name, strings

    def run(batches):
        rows = []
        for (late, head, place), strings in groups(batches):
            acceptor = Acceptor(sorted(strings))
            for a, b in accepted_pairs(acceptor, None if late else HEAD):
                if place is not None and not edit_at_start(a, b, place):
                    continue
                u, w = head + a, head + b
                if not late:
                    u, w = u[::-1], w[::-1]
                    if u[:HEAD] == w[:HEAD]:
                        continue  # found from their beginnings
                rows.append((u, w, strings[a], strings[b]))
                if len(rows) >= PAIRS_A_BATCH:
                    yield rows
                    rows = []
        yield rows

    dealt = states.repartition("late", "head", "place").sortWithinPartitions("late", "head", "place", "rest")
    return map_batches(dealt.select("late", "head", "rest", "place", "n"), "a string, b string, na long, nb long", run)


def edit_at_start(a: str, b: str, place: str) -> bool:
    """Whether the last possible place of the pair's edit is its first letter, before ``place``."""
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    if len(a) == len(b):
        return a[1:] == b[1:] == place
    return longer[1:] == shorter == place and longer[:1] != shorter[:1]


# --- forms ---


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: the last word that forms lead to, by pointer jumping."""
    found = forms.select("word", F.col("form").alias("root"))
    while True:
        found = materialize(found, "roots")
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = found.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        found = materialize(found, "roots")
        if found.where("moved").isEmpty():
            return found.select("word", "root")
        found = found.select("word", "root")


def spelling_variants(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: SpellingRules = SpellingRules()) -> DataFrame:
    """word, form, root, n, n_near and form_n, one row per word."""
    words = word_counts(docs, text, key, rules)
    pairs = materialize(composed_pairs(initial_states(words, rules)), "near-words")
    both = pairs.union(pairs.select("b", "a", "nb", "na"))
    # max_by keeps the first in code-point order of the most frequent: bytes of UTF-8 sort like code points.
    best = F.min_by(F.struct(F.col("b").alias("form"), F.col("nb").alias("form_n")), F.struct(-F.col("nb"), F.col("b")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left")
    enough = F.col("best.form_n") >= rules.form_ratio * F.col("n")
    known = materialize(
        known.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.form")).alias("form"), F.when(enough, F.col("best.form_n")).alias("form_n"),
        ), "spelling-forms",
    )
    roots = follow(known.where("form is not null"))
    whole = known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return whole.select("word", "form", "root", "n", "n_near", "form_n")


def variants_sql(rules: SpellingRules = SpellingRules()) -> str:
    """The contract's rows in DuckDB SQL over the view ``documents``: near words by deleted letters."""
    return f"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, 0 AS step, CAST(i AS BIGINT) AS r FROM range(256) t(i)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END FROM bits WHERE step < 8
),
crc AS (SELECT list(r ORDER BY byte) AS t FROM bits WHERE step = 8),
runs AS (
  SELECT doc_id, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
  GROUP BY ALL
),
hashed AS (
  SELECT w, n, xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)), '..'), lambda x: CAST(('0x' || x) AS BIGINT)),
    lambda h, b: xor(h // 256, t[xor(h % 256, b) + 1]), CAST(4294967295 AS BIGINT))) AS h
  FROM runs, crc
),
dropped AS (
  SELECT n, CASE WHEN h % {rules.drop_one_in} = 0 THEN substr(w, 1, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word
  FROM hashed
),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM dropped WHERE length(word) >= {rules.min_length} GROUP BY word HAVING sum(n) >= {rules.min_count}
),
less AS MATERIALIZED (
  SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
near AS (
  SELECT a.word AS a, a.n AS na, b.word AS b, b.n AS nb FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
),
ranked AS (SELECT *, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY nb DESC, encode(b)) AS k FROM near),
best AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN nb >= {rules.form_ratio} * n THEN b END AS form, CASE WHEN nb >= {rules.form_ratio} * n THEN nb END AS form_n
  FROM words LEFT JOIN (SELECT * FROM ranked WHERE k = 1) ON a = word
),
chains AS (
  SELECT word, word AS root, form AS next FROM best
  UNION ALL
  SELECT c.word, c.next, b.form FROM chains c JOIN best b ON b.word = c.next
)
SELECT b.word, b.form, c.root, b.n, CAST(b.n_near AS BIGINT) AS n_near, b.form_n
FROM best b JOIN chains c ON c.word = b.word AND c.next IS NULL"""
