"""License scans: Aho-Corasick for tags and notices, shunting-yard for expressions.

One automaton finds notice phrases in the normalised words of a text (lower-case
words joined by single spaces), a second finds identifier tags in the text
itself.  The expression behind a tag is parsed by the shunting-yard method:
``WITH`` binds tighter than ``AND``, which binds tighter than ``OR``.

Null texts count as empty; a text without matches has no labels (an empty
string), null word places and score 0.  Malformed expressions give the labels of
the identifiers that they name and lower the score.  An expression ends with its
line, or where another tag begins, so the time for a text grows with its length
alone.  Long texts are scanned whole; repeated rows come out as often as they went
in; an empty table gives an empty one; columns beyond the two named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import lean, short_batches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: The phrases whose places are counted, and their labels: fixed values.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notices and the labels that they give.
NOTICES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl-1.0",
    "isc license": "isc",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
TAGS = ("spdx-license-identifier:", "license-expression:", "license-id:")
#: Beginnings of identifiers and the labels they come to.
FAMILIES = {"apache": "apache", "mit": "mit", "gpl": "gpl", "agpl": "agpl", "lgpl": "lgpl"}
#: How freely a label lets a text be used.
FREEDOM = {"mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "bsl-1.0": 1.0, "cc0": 1.0, "public-domain": 1.0, "cc-by": 0.9, "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.3, "agpl": 0.2, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "cc-by-nc-sa": 0.1, "cc-by-nc-nd": 0.1, "proprietary": 0.0}
UNKNOWN = 0.4
BINDS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*(?::[a-z0-9][a-z0-9.+-]*)?")
LINE = re.compile(r"[^\r\n]*")


def label_of(identifier: str) -> str:
    """The label of one identifier: its family, or itself without a version suffix such as -only or +."""
    plain = re.sub(r"(-only|-or-later|\+)$", "", identifier)
    return next((v for k, v in FAMILIES.items() if re.match(rf"{k}(?![a-z])", plain)), plain)


def to_postfix(tokens: list[str]) -> tuple[list[str], bool]:
    """The expression in postfix order, and whether it was well formed."""
    out, waiting, sound, operand = [], [], True, False
    for token in tokens:
        if token == "(":
            sound &= not operand
            waiting.append(token)
        elif token == ")":
            sound &= operand
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if waiting:
                waiting.pop()
            else:
                sound = False
        elif token in BINDS:
            sound &= operand
            operand = False
            while waiting and BINDS.get(waiting[-1], 0) >= BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
        else:
            if operand:
                sound = False
                break
            out.append(token)
            operand = True
    while waiting:
        token = waiting.pop()
        if token == "(":
            sound = False
        else:
            out.append(token)
    return out, sound and operand


def evaluate(expression: str) -> tuple[set[str], float, bool]:
    """labels, freedom and soundness of an expression.

    A choice (or) is as free as its freer side, a conjunction (and) as its less
    free side, and an exception (with) adds freedom to its left side.
    """
    tokens = TOKEN.findall(expression)
    postfix, sound = to_postfix(tokens)
    stack: list[tuple[set[str], float]] = []
    for token in postfix:
        if token not in BINDS:
            label = label_of(token)
            stack.append(({label}, FREEDOM.get(label, UNKNOWN)))
        elif len(stack) < 2:
            sound = False
        else:
            right, left = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left[0], min(1.0, left[1] + 0.1)))
            else:
                stack.append((left[0] | right[0], (max if token == "or" else min)(left[1], right[1])))
    if not stack:
        return set(), 0.0, False
    labels = set().union(*(x[0] for x in stack))
    return labels, min(x[1] for x in stack), sound and len(stack) == 1


@lru_cache(maxsize=4)
def automata(base: tuple, notices: tuple, tags: tuple):
    import ahocorasick

    words, marks = ahocorasick.Automaton(), ahocorasick.Automaton()
    phrases: dict[str, list] = {}
    for counted, table in ((True, base), (False, notices)):
        for phrase, label in table:
            phrases.setdefault(phrase, []).append((label, counted))
    for phrase, said in phrases.items():
        words.add_word(f" {phrase} ", (len(phrase) + 1, said))
    for tag in tags:
        marks.add_word(tag, tag)
    words.make_automaton()
    marks.make_automaton()
    return words, marks


def scan(text: str | None, base: Mapping[str, str] = BASE, notices: Mapping[str, str] = NOTICES, tags: tuple[str, ...] = TAGS) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one whole text."""
    words, marks = automata(tuple(base.items()), tuple(notices.items()), tuple(tags))
    lower = (text or "").translate(LOWER) if text and not text.isascii() else (text or "").lower()
    found = WORD.findall(lower)
    joined = f" {' '.join(found)} "
    starts, base_labels, labels, freedoms, sound = [], set(), set(), [], True
    # Places come in order of their ends, so the words before them are counted piecewise.
    at = place = 0
    for end, (back, said) in words.iter(joined):
        begin = end - back
        counted = [label for label, is_base in said if is_base]
        if counted:
            place += joined.count(" ", at, begin) if begin >= at else -joined.count(" ", begin, at)
            at = begin
            starts += [place] * len(counted)
            base_labels.update(counted)
        labels.update(label for label, _ in said)
    tagged = [(end + 1, end + 1 - len(tag)) for end, tag in marks.iter(lower)]
    for (begin, _), (_, stop) in zip(tagged, [*tagged[1:], (0, len(lower))]):
        named, freedom, good = evaluate(LINE.match(lower, begin, max(begin, stop))[0])
        labels |= named
        freedoms.append(freedom)
        sound &= good
    # The longest of nested Creative Commons notices stands for them.
    labels -= {a for a in labels if a.startswith("cc-by") and any(b.startswith(a + "-") for b in labels)} - base_labels
    freedoms += [FREEDOM.get(label, UNKNOWN) for label in labels]
    score = min(freedoms, default=0.0) * (1.0 if sound else 0.5)
    return len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", base: Mapping[str, str] = BASE, notices: Mapping[str, str] = NOTICES, tags: tuple[str, ...] = TAGS) -> DataFrame:
    """One row per row of ``docs``; score is the freedom of the least free licence found, halved if an expression is malformed."""
    short_batches(docs.sparkSession)
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(t.as_py(), base, notices, tags) for t in batch.column(1)]
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(lean(run), SCHEMA)
