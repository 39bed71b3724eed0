"""License scans: notice phrases, identifier tags, licence expressions.

One Aho-Corasick automaton holds all phrases and the words of the tags; it reads
each whole text once, as lower-case words joined by single spaces.  Where the
identifier tag occurs, the longest valid expression right after it on the line
is read from the text, turned to postfix order by a shunting-yard parser
(``with`` binds tightest, then ``and``, then ``or``) and evaluated against a set
of accepted licences.  What follows on the line (the end of a comment, another
sentence) is left out: a word that can't continue the expression, a dash or a
closing dot ends it, and ``and`` or ``or`` continue it only before a known
identifier, a ``LicenseRef-`` or a bracket.  Looser tags (``License: ``,
``@license ``, ``"license": ``) count where all their identifiers are known.

Edge cases: null and empty texts give no words, no labels and score 0; a
tag without a valid expression yields no identifiers; repeated rows are scanned alike;
overlapping and repeated phrases all count, and a phrase that another begins
with counts beside it; texts of any length are read whole, line by line for
tags; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from .common import ASCII_LOWER, ASCII_UPPER, arrow_rows, text_bytes

#: fixed values: the base phrases and their labels
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: further notice phrases and their labels
MORE_PHRASES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license v2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license v3": "gpl-3",
    "gnu lesser general public license version 2 1": "lgpl-2.1",
    "gnu lesser general public license v2 1": "lgpl-2.1",
    "gnu lesser general public license version 3": "lgpl-3",
    "gnu lesser general public license v3": "lgpl-3",
    "gnu affero general public license version 3": "agpl-3",
    "gnu affero general public license v3": "agpl-3",
    "eclipse public license": "epl",
    "boost software license": "bsl-1.0",
    "do what the fuck you want to public license": "wtfpl",
    "mozilla public license": "mpl",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "permission is hereby granted free of charge": "mit",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
#: words that a looser tag has
LOOSE = ("license", "licence")
#: fixed values: identifiers of licences in common use
KNOWN = frozenset({
    "0bsd", "aal", "afl-2.1", "afl-3.0", "apache-1.0", "apache-1.1", "apache-2.0", "apsl-2.0", "artistic-1.0", "artistic-2.0",
    "blueoak-1.0.0", "bsd-1-clause", "bsd-2-clause", "bsd-2-clause-patent", "bsd-3-clause", "bsd-3-clause-clear",
    "bsd-3-clause-lbnl", "bsd-4-clause", "bsl-1.0", "busl-1.1", "bzip2-1.0.6", "cc-by-1.0", "cc-by-2.0", "cc-by-2.5",
    "cc-by-3.0", "cc-by-4.0", "cc-by-nc-3.0", "cc-by-nc-4.0", "cc-by-nc-nd-3.0", "cc-by-nc-nd-4.0", "cc-by-nc-sa-3.0",
    "cc-by-nc-sa-4.0", "cc-by-nd-3.0", "cc-by-nd-4.0", "cc-by-sa-2.0", "cc-by-sa-2.5", "cc-by-sa-3.0", "cc-by-sa-4.0",
    "cc0-1.0", "cddl-1.0", "cddl-1.1", "cecill-2.1", "cecill-b", "cecill-c", "cpal-1.0", "cpl-1.0", "curl", "ecl-2.0",
    "efl-2.0", "epl-1.0", "epl-2.0", "eupl-1.1", "eupl-1.2", "ftl", "hpnd", "icu", "ijg", "intel", "ipl-1.0", "isc", "json",
    "libpng", "libpng-2.0", "lppl-1.3c", "mit", "mit-0", "mpl-1.0", "mpl-1.1", "mpl-2.0", "ms-pl", "ms-rl", "mulanpsl-2.0",
    "ncsa", "ntp", "odbl-1.0", "ofl-1.0", "ofl-1.1", "openssl", "osl-3.0", "php-3.0", "php-3.01", "postgresql", "psf-2.0",
    "python-2.0", "qpl-1.0", "ruby", "sleepycat", "sspl-1.0", "unicode-3.0", "unlicense", "upl-1.0", "vim", "w3c", "wtfpl",
    "x11", "zlib", "zpl-2.1"})
#: fixed values: licences that come with "-only", "-or-later" and "+" too
VERSIONED = ("agpl-1.0", "agpl-3.0", "gfdl-1.1", "gfdl-1.2", "gfdl-1.3", "gpl-1.0", "gpl-2.0", "gpl-3.0", "lgpl-2.0",
             "lgpl-2.1", "lgpl-3.0")
#: licences that an expression may use to count as accepted
ACCEPTED = frozenset({"mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "cc0-1.0", "unlicense", "zlib"})

#: lower-cases A-Z and turns every byte outside 0-9, a-z and 0x80-0xFF to a space
_WORDS = bytearray(range(256))
for _b in range(128):
    _c = chr(_b)
    _WORDS[_b] = ord(_c.lower()) if _c in ASCII_UPPER else _b if _c in ASCII_LOWER or _c.isdigit() else 32
_WORDS = bytes(_WORDS)

_TAGGED = re.compile(rb"spdx-license-identifier:[ \t]*([A-Za-z0-9.+() \t-]*)", re.IGNORECASE)
_LOOSELY = re.compile(rb"(?:@licen[sc]e|licen[sc]e[\"']?[ \t]*[:=])[ \t]*[\"']?([A-Za-z0-9.+() \t-]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+-]+")
_RANK = {"or": 1, "and": 2, "with": 3}


def known(identifier: str) -> bool:
    """Is the lower-case identifier one in common use, or the author's own (``LicenseRef-``)?"""
    stem = identifier.removesuffix("+").removesuffix("-only").removesuffix("-or-later")
    return identifier in KNOWN or stem in VERSIONED or identifier.removesuffix("+") in KNOWN or identifier.startswith("licenseref-")


def leading(text: str) -> str:
    """The longest valid licence expression that ``text`` begins with, its
    tokens lower-cased and joined by blanks; empty if there is none."""
    read, valid, depth, want_operand = [], 0, 0, True
    for m in _TOKEN.finditer(text):
        whole = m[0].lower()
        t = whole.rstrip(".-")
        if not t.strip(".+-"):
            break  # dots and dashes only
        operand = t not in _RANK and t not in ("(", ")")
        if want_operand != (operand or t == "(") or (t == ")" and not depth):
            break
        if operand and read and read[-1] in ("and", "or") and not known(t):
            break  # the words of a sentence, not of an expression
        read.append(t)
        depth += (t == "(") - (t == ")")
        want_operand = t == "(" or t in _RANK
        if not want_operand and not depth:
            valid = len(read)
        if t != whole:
            break  # the end of a sentence or comment
    return " ".join(read[:valid])


def postfix(expression: str) -> list[str]:
    """Licence expression in postfix order; ``[]`` if it is malformed."""
    out, held, want_operand = [], [], True
    for t in _TOKEN.findall(expression.lower()):
        if t in _RANK:
            if want_operand:
                return []
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[t]:
                out.append(held.pop())
            held.append(t)
            want_operand = True
        elif t == ")":
            if want_operand or "(" not in held:
                return []
            while (top := held.pop()) != "(":
                out.append(top)
        elif not want_operand:
            return []  # two operands in a row
        elif t == "(":
            held.append(t)
        else:
            out.append(t)
            want_operand = False
    if want_operand or "(" in held:
        return []
    return out + held[::-1]


def accepted(expression: list[str], licences=ACCEPTED) -> bool:
    """Value of a postfix expression: a licence holds if it is accepted, an
    exception after ``with`` leaves the licence's value as it is."""
    stack: list[bool] = []
    for t in expression:
        if t not in _RANK:
            stack.append(t in licences)
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left if t == "with" else left and right if t == "and" else left or right)
    return bool(stack) and stack[0]


def identifiers(expression: list[str]) -> set[str]:
    """Licence identifiers of a postfix expression, exceptions left out."""
    stack: list[set[str]] = []
    for t in expression:
        if t not in _RANK:
            stack.append({t})
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left if t == "with" else left | right)
    return stack[0] if stack else set()


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase in [*BASE_PHRASES, *MORE_PHRASES, TAG, *LOOSE]:
        a.add_word(f" {phrase} ", (phrase, phrase.count(" ") + 1))
    a.make_automaton()
    return a


def scan(text: bytes) -> dict:
    """Findings of one text (UTF-8)."""
    words = text.translate(_WORDS).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    n_base = tags = notices = loose = 0
    first = last = None
    base, labels, exprs = set(), set(), []
    at, seen = 0, 0  # spaces counted so far
    for end, (phrase, size) in automaton().iter(line):
        seen += line.count(" ", at, end + 1)
        at = end + 1
        start = seen - 1 - size
        if phrase in BASE_PHRASES:
            n_base += 1
            first = start if first is None else min(first, start)
            last = start if last is None else max(last, start)
            base.add(BASE_PHRASES[phrase])
        elif phrase == TAG:
            tags += 1
        elif phrase in LOOSE:
            loose += 1
        else:
            notices += 1
            labels.add(MORE_PHRASES[phrase])
    if tags:
        for m in _TAGGED.finditer(text):
            if p := postfix(leading(m[1].decode())):
                exprs.append(p)
                labels |= identifiers(p)
    if loose:
        for m in _LOOSELY.finditer(text):
            p = postfix(leading(m[1].decode()))
            if p and all(map(known, identifiers(p))):
                exprs.append(p)
                labels |= identifiers(p)
    places = n_base + notices + len(exprs)
    return {"n_words": len(words), "n_base": n_base, "first_word": first, "last_word": last,
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | labels)),
            "score": 1.0 - 0.5 ** min(places, 60) if places else 0.0,
            "expressions": len(exprs), "accepted": all(map(accepted, exprs)) if exprs else None}


_SCHEMA = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
           "score double, expressions bigint, accepted boolean")


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: the id, word count, base places and labels, all
    labels, a score (1 - 0.5 to the number of findings), the number of licence
    expressions and whether all of them are accepted (null without any)."""
    names = [c.split()[0] for c in _SCHEMA.split(", ")]

    def run(batches):
        for b in batches:
            found = [scan(t) for t in text_bytes(b, text_column)]
            yield {id_column: b.column(0)} | {n: [x[n] for x in found] for n in names}

    src = docs.select(id_column, text_column)
    return arrow_rows(src, f"{id_column} {src.schema[id_column].dataType.simpleString()}, {_SCHEMA}", run)
