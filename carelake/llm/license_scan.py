"""Licence scan: phrases by an Aho-Corasick automaton, expressions by a shunting-yard parser.

A text is reduced to its words (ASCII lower case; maximal runs of digits, ASCII letters and
all characters beyond ASCII) joined by single spaces. One automaton finds every place where
the words of a phrase stand consecutively. Where an identifier tag or a grant ("licensed
under", unless negated) is found, the licence expression after it is read from the raw text, ordered by the
shunting-yard method (with binds tighter than and, and tighter than or) and evaluated. Operators stand in capitals or
small letters; identifiers may end in a plus; exceptions follow "with"; a token that names no licence ends the expression.

Cases: a null or empty text has no words, no labels, null places and score 0. Repeated
rows give one result each; null ids are passed through; an empty table gives an empty result;
other columns are not read. An expression that doesn't parse adds no label. All work stays in
the scan's task; memory is one Arrow batch and the automaton.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import zip_longest

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notice phrases of the method, with labels and weights of evidence.
NOTICES = {
    "mit license": ("mit", 0.8),
    "apache license": ("apache", 0.8),
    "apache license version 2 0": ("apache-2.0", 0.9),
    "apache license 2 0": ("apache-2.0", 0.9),
    "bsd license": ("bsd", 0.8),
    "isc license": ("isc", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "creative commons attribution": ("cc-by", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nc": ("cc-by-nc", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "creative commons zero": ("cc0-1.0", 0.8),
    "dedicated to the public domain": ("public-domain", 0.8),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
}
BASE_WEIGHT = {"cc-by": 0.6, "gpl": 0.7, "reserved": 0.5}
TAG_WEIGHT, GRANT_WEIGHT = 0.95, 0.85

# Identifiers that an expression may name outside a tag. Families by their versions; the names
# without versions; exceptions that may follow "with".
FAMILIES = {
    "gpl": "1.0 2.0 3.0", "lgpl": "2.0 2.1 3.0", "agpl": "1.0 3.0", "gfdl": "1.1 1.2 1.3", "apache": "1.0 1.1 2.0",
    "mpl": "1.0 1.1 2.0", "epl": "1.0 2.0", "cddl": "1.0 1.1", "eupl": "1.0 1.1 1.2", "artistic": "1.0 2.0",
    "afl": "1.1 1.2 2.0 2.1 3.0", "osl": "1.0 1.1 2.0 2.1 3.0", "ofl": "1.0 1.1", "cecill": "1.0 1.1 2.0 2.1",
    "zpl": "1.1 2.0 2.1", "php": "3.0 3.01", "python": "2.0", "psf": "2.0", "bsl": "1.0", "upl": "1.0", "cpl": "1.0", "ipl": "1.0",
    "ecl": "1.0 2.0", "lppl": "1.0 1.1 1.2 1.3a 1.3c", "odbl": "1.0", "odc-by": "1.0", "pddl": "1.0", "cc0": "1.0",
    "cc-by": "1.0 2.0 2.5 3.0 4.0", "cc-by-sa": "1.0 2.0 2.5 3.0 4.0", "cc-by-nc": "1.0 2.0 2.5 3.0 4.0",
    "cc-by-nd": "1.0 2.0 2.5 3.0 4.0", "cc-by-nc-sa": "1.0 2.0 2.5 3.0 4.0", "cc-by-nc-nd": "1.0 2.0 2.5 3.0 4.0",
    "bsd": "1-clause 2-clause 3-clause 4-clause 2-clause-patent 3-clause-clear"}
GNU = ("gpl", "lgpl", "agpl", "gfdl")
NAMES = ("mit mit-0 isc zlib unlicense 0bsd wtfpl x11 ncsa ruby vim curl openssl postgresql beerware ms-pl ms-rl blessing "
         "libpng sleepycat w3c json icu hpnd tcl fsfap naist-2003")
EXCEPTIONS = frozenset("classpath-exception-2.0 llvm-exception gcc-exception-2.0 gcc-exception-3.1 autoconf-exception-2.0 "
                       "autoconf-exception-3.0 bison-exception-2.2 font-exception-2.0 linux-syscall-note "
                       "openvpn-openssl-exception gpl-cc-1.0 swift-exception u-boot-exception-2.0 libtool-exception".split())
KNOWN = frozenset(NAMES.split()) | frozenset(
    f"{f}-{v}{s}" for f, versions in FAMILIES.items() for v in versions.split()
    for s in (("", "-only", "-or-later") if f in GNU else ("",)))
#: Those that permit any use with at most a notice.
PERMISSIVE = frozenset("mit mit-0 apache-2.0 bsd-2-clause bsd-3-clause isc zlib unlicense cc0-1.0 cc-by-4.0 cc-by-3.0 0bsd "
                       "bsl-1.0 x11 ncsa upl-1.0 curl postgresql".split())
RANK = {"or": 1, "and": 2, "with": 3}

TRIGGERS = ("spdx license identifier", "licensed under", "released under")
_TRIGGER = re.compile(r"(spdx-license-identifier\s*:|(?:licensed|released)\s+under)", re.I)
_NOT = re.compile(r"(?:\b(?:not|never|neither|nor|no\s+longer)|n['\u2019]t)(?:\s+\w+)?\s+\Z", re.I)
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.:+-]*")
_OPERATORS = frozenset("and or with AND OR WITH".split())
_REFERENCE = re.compile(r"(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")
_FILLER = frozenset("the a an either terms of license".split())

#: Everything but digits, a-z and bytes beyond ASCII becomes a space; A-Z are lower-cased.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
                  for c in range(256))


def _is_operand(raw: str, known_only: bool, before: str | None) -> bool:
    """Whether a token names a licence after ``before`` (an operator as written, or None at the start). Known identifiers
    do, with or without a plus. After a tag, also references, any first name or exception, and later ones that
    look like an identifier: with a digit or a hyphen, or in capitals after an operator in capitals."""
    t = raw.lower()
    if before is not None and before.lower() == "with":
        return t in EXCEPTIONS or not known_only
    if t.removesuffix("+") in KNOWN:
        return True
    if known_only:
        return False
    return before is None or _REFERENCE.fullmatch(t) is not None or re.search("[0-9-]", raw) is not None \
        or raw.isupper() and before.isupper()


def read_expression(text: str, known_only: bool, start: int = 0, end: int | None = None) -> list[str]:
    """The longest run of tokens from ``start`` in ``text`` that can be an expression; a token that is no operand where one
    is expected ends it. Operands on later lines than the first one must be known."""
    out: list[str] = []
    depth, operand, before = 0, True, None  # operand: one is expected next
    first = start
    for m in _TOKEN.finditer(text, start, len(text) if end is None else end):
        raw = m.group()
        raw = raw if raw in "()" else raw.rstrip(".:")
        t = raw.lower()
        if operand and not out and t in _FILLER:
            continue
        if t == "(" and operand:
            depth += 1
        elif t == ")" and not operand and depth:
            depth -= 1
        elif raw in _OPERATORS and not operand:
            operand, before = True, raw
        elif operand and t not in RANK and t not in "()":
            later = out and "\n" in text[first:m.start()]
            if not _is_operand(raw, bool(known_only or later), before):
                break
            operand = False
        else:
            break
        if not out:
            first = m.start()
        out.append(t)
    while out and (out[-1] in RANK or out[-1] == "("):
        depth -= out.pop() == "("
    return out if depth == 0 else []


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operators wait on a stack until one that binds less follows."""
    out: list[str] = []
    stack: list[str] = []
    for t in tokens:
        if t in RANK:
            while stack and stack[-1] != "(" and RANK[stack[-1]] >= RANK[t]:
                out.append(stack.pop())
            stack.append(t)
        elif t == "(":
            stack.append(t)
        elif t == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            out.append(t)
    return out + stack[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], bool]:
    """Licences named (exceptions aside) and whether a permissive choice is open."""
    stack: list[tuple[set[str], bool]] = []
    for t in postfix:
        if t == "with":  # an exception only adds permissions
            stack.pop()
        elif t in RANK:
            (a, x), (b, y) = stack.pop(), stack.pop()
            stack.append((a | b, x and y if t == "and" else x or y))
        else:
            stack.append(({t}, t.removesuffix("+") in PERMISSIVE))
    return stack[-1]


def build_automaton() -> ahocorasick.Automaton:
    found: dict[str, list] = {}
    for p, label in BASE.items():
        found.setdefault(p, []).append(("base", label, BASE_WEIGHT[label]))
    for p, (label, w) in NOTICES.items():
        found.setdefault(p, []).append(("notice", label, w))
    for p in TRIGGERS:
        found.setdefault(p, []).append(("trigger", p, 0.0))
    a = ahocorasick.Automaton()
    for p, v in found.items():
        a.add_word(f" {p} ", (len(p) + 2, v))
    a.make_automaton()
    return a


def scan_text(raw: bytes, automaton: ahocorasick.Automaton) -> tuple:
    words = raw.translate(_TO_WORDS).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    n_base, first, last, at, index, trigger = 0, None, None, 0, 0, False
    base: set[str] = set()
    evidence: dict[str, float] = {}
    for end, (size, hits) in automaton.iter(line):
        start = end - size + 1
        index += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
        at = start
        for kind, label, weight in hits:
            if kind == "trigger":
                trigger = True
                continue
            evidence[label] = max(weight, evidence.get(label, 0.0))
            if kind == "base":
                n_base += 1
                base.add(label)
                first = index if first is None else min(first, index)
                last = index if last is None else max(last, index)
    expression, permissive = None, None
    if trigger:
        text = raw.decode("utf-8", "replace")
        found = list(_TRIGGER.finditer(text))
        for m, after in zip_longest(found, found[1:]):  # an expression ends before the next trigger
            tag = m.group(1)[0] in "sS"
            if not tag and _NOT.search(text, max(0, m.start() - 32), m.start()):
                continue
            postfix = to_postfix(read_expression(text, not tag, m.end(), after and after.start()))
            if postfix:
                named, open_choice = evaluate(postfix)
                for x in named:
                    evidence[x] = max(TAG_WEIGHT if tag else GRANT_WEIGHT, evidence.get(x, 0.0))
                if expression is None:
                    expression, permissive = " ".join(postfix), open_choice
    miss = 1.0
    for label in sorted(evidence):
        miss *= 1.0 - evidence[label]
    return (len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(evidence)),
            1.0 - miss, expression, permissive)


_FIELDS = [("n_words", pa.int64(), "bigint"), ("n_base", pa.int64(), "bigint"),
           ("first_word", pa.int64(), "bigint"), ("last_word", pa.int64(), "bigint"),
           ("base_labels", pa.string(), "string"), ("labels", pa.string(), "string"),
           ("score", pa.float64(), "double"), ("expression", pa.string(), "string"),
           ("permissive", pa.bool_(), "boolean")]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: phrase places, labels, the first expression (postfix) and a score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            rows = [scan_text(t.as_py() or b"", automaton) for t in texts]
            cols = list(zip(*rows)) or [()] * len(_FIELDS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, t) for c, (_, t, _) in zip(cols, _FIELDS, strict=True)]],
                names=["doc_id", *[f[0] for f in _FIELDS]])

    schema = "doc_id bigint, " + ", ".join(f"{n} {s}" for n, _, s in _FIELDS)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(run, schema)
