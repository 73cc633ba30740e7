"""Licence scan: Aho-Corasick over words, shunting-yard over tag expressions.

The text is lower-cased (A to Z) and reduced to its words, joined by single blanks;
one automaton finds identifier tags and notice phrases in it, so a phrase matches
however its words are spaced or punctuated.  Behind every identifier tag the original
text is read as an expression (``MIT OR (Apache-2.0 WITH x AND BSD-2-Clause)``) that a
shunting-yard parser turns into alternatives: each is a set of licences that have to
hold together.  A tag counts where a sign (``:``, ``=``, ``>``) stands behind it, and a
name where it is a licence's: one of a known family, a reference, or letters with a
version.  Reading ends at the next tag, where the text is no expression any more, at a
name that is none,
or at a line break that neither stands in brackets nor leaves an operand to come.  A
broken expression keeps the licences read up to the fault; one of too many alternatives
stays as it is written.

Nulls and empty texts have no words, no labels and score 0.  Texts are read whole,
repeated rows each on their own; columns other than id and text are not read.

The score is the confidence that the document states a licence:
1 - product(1 - evidence), over the distinct kinds of evidence found.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyard.llm.common import column, map_columns

# Bytes: every byte of a non-ASCII character is at least 0x80 and part of a word.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Phrases and labels that the base counts are made of.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Notices: words that stand together, the label, and how surely they state a licence.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.9),
    "licensed under the mit": ("mit", 0.8),
    "released under the mit": ("mit", 0.8),
    "licensed under the apache license": ("apache", 0.9),
    "apache license version 2 0": ("apache-2.0", 0.9),
    "gnu general public license": ("gpl", 0.8),
    "general public license version 2": ("gpl-2.0", 0.9),
    "general public license version 3": ("gpl-3.0", 0.9),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "bsd license": ("bsd", 0.7),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "isc license": ("isc", 0.7),
    "creative commons attribution": ("cc-by", 0.7),
    "cc by": ("cc-by", 0.4),
    "licensed under cc by": ("cc-by", 0.8),
    "cc by sa": ("cc-by-sa", 0.7),
    "cc by nc": ("cc-by-nc", 0.7),
    "cc by nd": ("cc-by-nd", 0.7),
    "cc0 1 0": ("cc0", 0.7),
    "all rights reserved": ("proprietary", 0.5),
    "public domain": ("public-domain", 0.4),
}

TAGS = ("spdx license identifier", "spdx licenseid", "license expression")
TAG_WEIGHT, BASE_WEIGHT = 0.95, 0.6

TOKEN = re.compile(rb"[()\n]|[0-9A-Za-z.+:-]+")
NAMED = re.compile(rb"[0-9A-Za-z]")
SIGN = re.compile(rb"[:=>]")  # what makes a tag of words that prose also has
BEFORE = re.compile(rb"[^0-9A-Za-z\x80-\xff(]*")  # between a tag and its expression
#: Families of licence identifiers that stand without a version or before one.
FAMILIES = (
    "afl agpl apache apsl artistic beerware blessing bsd bsl bzip2 cc cddl cecill cpal cpl curl ecl"
    " efl epl eupl fsfap ftl gfdl gpl hpnd icu ijg imagemagick intel ipl isc json latex libpng libtiff"
    " lgpl linux-openib lpl lppl mirros mit mpl ms-pl ms-rl mulanpsl ncsa netcdf nokia ntp odbl odc-by"
    " ofl openldap openssl osl pddl php postgresql psf python qpl rpl ruby sgi sissl sleepycat smlnj tcl"
    " unicode unlicense upl vim w3c wtfpl x11 xnet zend zlib zpl"
).split()
LICENCE = re.compile(
    rf"(?:{'|'.join(FAMILIES)})(?:-[0-9a-z.-]+)?\+?"
    r"|(?:documentref-[0-9a-z.-]+:)?(?:licenseref|additionref)-[0-9a-z.-]+"
    r"|[0-9a-z.-]+-exception(?:-[0-9a-z.-]+)?"
    r"|0bsd|[a-z][a-z.-]*[0-9][0-9a-z.-]*\+?"
)
OPERATORS = {"or": 1, "and": 2, "with": 3}
LIMIT = 4096

Alternatives = frozenset[frozenset[str]]


class Expression:
    """A licence expression: its licences, and its alternatives while they are few.

    Beyond ``limit`` alternatives the expression is only the tree of its parts.
    """

    __slots__ = ("alternatives", "licences", "parts")

    def __init__(self, name: str) -> None:
        self.parts: str | tuple[Expression, str, Expression] = name
        self.licences: set[str] = {name}
        self.alternatives: Alternatives | None = frozenset({frozenset({name})})

    @classmethod
    def of(cls, left: Expression, op: str, right: Expression, limit: int) -> Expression:
        out = cls.__new__(cls)
        out.parts, out.alternatives = (left, op, right), None
        a, b = left.alternatives, right.alternatives
        if a is not None and b is not None:
            if op == "or":
                out.alternatives = both if len(both := a | b) <= limit else None
            elif len(a) * len(b) <= limit:
                if op == "and":
                    out.alternatives = frozenset(x | y for x in a for y in b)
                else:  # an exception qualifies the licence before it
                    pairs = ((x, y) for x in a for y in b)
                    out.alternatives = frozenset(frozenset(f"{i} with {j}" for i in x for j in y) for x, y in pairs)
        if op != "with":  # the larger set takes in the smaller; the parts need theirs no more
            more, less = sorted((left.licences, right.licences), key=len, reverse=True)
            more |= less
            out.licences = more
        elif len(left.licences) * len(right.licences) <= limit:
            out.licences = {f"{i} with {j}" for i in left.licences for j in right.licences}
        else:
            out.licences = {out.text()}
        return out

    def text(self) -> str:
        if self.alternatives is not None:
            return " OR ".join(sorted(" AND ".join(sorted(a)) for a in self.alternatives))
        pieces, todo = [], [self]
        while todo:
            part = todo.pop()
            if isinstance(part, str):
                pieces.append(part)
            elif isinstance(part.parts, str):
                pieces.append(part.parts)
            else:
                left, op, right = part.parts
                around = [self._within(left, op), [f" {op if op == 'with' else op.upper()} "], self._within(right, op)]
                todo += [x for group in reversed(around) for x in reversed(group)]
        return "".join(pieces)

    @staticmethod
    def _within(part: Expression, op: str) -> list:
        loose = not isinstance(part.parts, str) and OPERATORS[part.parts[1]] < OPERATORS[op]
        return ["(", part, ")"] if loose else [part]


def read_expression(
    text: bytes,
    start: int = 0,
    end: int | None = None,
    limit: int = LIMIT,
    names: re.Pattern | None = None,
) -> Expression | None:
    """The licence expression at a place of a text, by a shunting-yard parser.

    ``with`` binds closest, then ``and``, then ``or``.  Reading stops where the text is
    no expression any more (two names in a row, a stray bracket, the end of a line
    after a whole expression) or a name is none of ``names``.
    """
    output: list[Expression] = []
    stack: list[str] = []
    depth, operand_next, broken = 0, True, False

    def apply(op: str) -> None:
        right, left = output.pop(), output.pop()
        output.append(Expression.of(left, op, right, limit))

    for m in TOKEN.finditer(text, start, len(text) if end is None else end):
        word = m[0].decode("latin-1").lower()
        if word == "\n":
            if not operand_next and not depth:
                break
            broken = True
            continue
        if (operand_next or broken) and word not in ("(", ")") and not NAMED.search(m[0]):
            continue  # comment marks at the start of a line
        broken = False
        if operand_next:
            if word == "(":
                stack.append(word)
                depth += 1
            elif word == ")" or word in OPERATORS:
                break
            else:
                name = word.rstrip(".:-")
                if names and not names.fullmatch(name):
                    break
                output.append(Expression(name))
                operand_next = False
        elif word == ")":
            if not depth:
                break
            while stack[-1] != "(":
                apply(stack.pop())
            stack.pop()
            depth -= 1
        elif word in OPERATORS:
            while stack and stack[-1] != "(" and OPERATORS[stack[-1]] >= OPERATORS[word]:
                apply(stack.pop())
            stack.append(word)
            operand_next = True
        else:
            break
    if operand_next and stack and output:  # an operator without a right side
        while stack and stack[-1] == "(":
            stack.pop()
        if stack:
            stack.pop()
    while stack and output:
        op = stack.pop()
        if op != "(" and len(output) > 1:
            apply(op)
    return output[-1] if output else None


def parse_expression(text: bytes, limit: int = LIMIT) -> Alternatives | None:
    """Alternatives of a licence expression; None if there are more than ``limit``."""
    found = read_expression(text, limit=limit)
    return found.alternatives if found else frozenset()


class Scanner:
    """Finds phrases and tags in one text; built once per task."""

    def __init__(self) -> None:
        phrases: dict[str, dict] = {}
        for phrase, label in BASE.items():
            phrases.setdefault(phrase, {})["base"] = label
        for phrase, found in NOTICES.items():
            phrases.setdefault(phrase, {})["notice"] = found
        for phrase in TAGS:
            phrases.setdefault(phrase, {})["tag"] = len(phrase.split())
        self.automaton = ahocorasick.Automaton()
        for phrase, what in phrases.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 1, what))
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> dict:
        lowered = text.lower()  # bytes: A to Z only
        found = WORD.findall(lowered)
        joined = (b" " + b" ".join(found) + b" ").decode("latin-1")
        starts, base, labels, evidence, tags = [], set(), set(), {}, []
        for end, (width, what) in self.automaton.iter(joined):
            if "base" in what:
                starts.append(end - width)
                base.add(what["base"])
                evidence["base", what["base"]] = BASE_WEIGHT
            if "notice" in what:
                label, weight = what["notice"]
                labels.add(label)
                evidence["notice", label] = max(weight, evidence.get(("notice", label), 0))
            if "tag" in what:
                tags.append((end, what["tag"]))
        expressions = self._tagged(lowered, text, joined, tags) if tags else []
        for e in expressions:
            for licence in e.licences:
                labels.add(licence)
                evidence["tag", licence] = TAG_WEIGHT
        doubt = 1.0
        for _, weight in sorted(evidence.items()):
            doubt *= 1 - weight
        return {
            "n_words": len(found),
            "n_base": len(starts),
            "first_word": joined.count(" ", 0, min(starts)) if starts else None,
            "last_word": joined.count(" ", 0, max(starts)) if starts else None,
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | labels)),
            "score": 1 - doubt,
            "expressions": [e.text() for e in expressions],
        }

    @staticmethod
    def _tagged(lowered: bytes, text: bytes, joined: str, tags: list[tuple[int, int]]) -> list[Expression]:
        """The expression behind every tag, up to the next tag at most."""
        places = [m.span() for m in WORD.finditer(lowered)]
        starts, ends, word, at = [], [], 0, 0
        for end, width in tags:
            word, at = word + joined.count(" ", at, end), end
            starts.append(places[word - width][0])
            ends.append(places[word - 1][1])
        found = []
        for here, limit in zip(ends, [*starts[1:], len(text)], strict=True):
            between = BEFORE.match(text, here, limit)
            if SIGN.search(between[0]) and (e := read_expression(text, between.end(), limit, names=LICENCE)):
                found.append(e)
        return found


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
    " labels string, score double, expressions array<string>"
)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence statements of every document; one row each, no shuffle."""
    raw = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), column(docs, text_col, "string").cast("binary").alias("text")
    )

    def make():
        scanner = Scanner()

        def work(rows):
            found = [scanner.scan(t or b"") for t in rows["text"]]
            out = {k: [f[k] for f in found] for k in found[0]}
            return out | {"doc_id": rows["doc_id"]}

        return work

    return map_columns(raw, SCHEMA, make)
