"""License scans: one automaton pass for phrases, a parser for expressions.

Every text is lower-cased (A-Z), cut into words and joined again with single
blanks; an Aho-Corasick automaton then finds all notice phrases at once,
whatever punctuation or line breaks stood between their words. Where it meets
the identifier tag, the expression behind the tag is read from the text
itself, put into postfix order by a shunting-yard parser, and evaluated.

Cases: a null or empty text has no words, no labels and score 0; malformed
expressions keep the identifiers that can be read and are marked; repeated
rows and null ids give one row each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.text import ALNUM_LOWER, LOWER_ASCII

# Phrases and labels that the scan has to report.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Further notices with the label and the weight of evidence of each.
NOTICES = {
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "bsd license": ("bsd", 0.8),
    "isc license": ("isc", 0.8),
    "eclipse public license": ("epl", 0.9),
    "creative commons attribution": ("cc-by", 0.8),
    "cc by nc": ("cc-by-nc", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "permission is hereby granted free of charge": ("mit", 0.7),
    "redistribution and use in source and binary forms": ("bsd", 0.7),
    "released into the public domain": ("public-domain", 0.8),
    "all rights reserved": ("all-rights-reserved", 0.4),
}
BASE_WEIGHT = 0.8
TAG_WEIGHT = 0.95
TAG = "spdx license identifier"
TAG_PATTERN = re.compile(rb"spdx[- ]license[- ]identifier[ \t]*:[ \t]*([^\r\n]*)")
TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")

#: Identifiers that leave reuse free, whole; any other restricts.
FREE = frozenset("""
0bsd afl-3.0 apache apache-1.0 apache-1.1 apache-2.0 artistic-2.0 blueoak-1.0.0 bsd bsd-1-clause bsd-2-clause
bsd-2-clause-patent bsd-3-clause bsd-4-clause bsl-1.0 cc-by cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc0
cc0-1.0 isc mit mit-0 mit-cmu ncsa postgresql psf-2.0 python-2.0 unicode-3.0 unlicense wtfpl x11 zlib zpl-2.1
""".split())
#: Identifiers that restrict reuse and are known as licences.
RESTRICTING = frozenset("""
agpl agpl-3.0 cc-by-nc-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc-by-nc-sa-4.0 cddl-1.0 epl-1.0 epl-2.0 eupl-1.2
gfdl-1.3 gpl gpl-1.0 gpl-2.0 gpl-3.0 lgpl lgpl-2.0 lgpl-2.1 lgpl-3.0 mpl-1.1 mpl-2.0 osl-3.0 proprietary
""".split())
#: The label of an identifier that is neither.
UNKNOWN = "unknown-license"
#: A slash between two identifiers is an old way to write "or".
SLASH = re.compile(r"(?<=[a-z0-9.+-])/(?=[a-z0-9])")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in BASE_PHRASES.items():
        found.add_word(f" {phrase} ", ("base", phrase, label, BASE_WEIGHT))
    for phrase, (label, weight) in NOTICES.items():
        found.add_word(f" {phrase} ", ("notice", phrase, label, weight))
    found.add_word(f" {TAG} ", ("tag", TAG, "", TAG_WEIGHT))
    found.make_automaton()
    return found


def whole(identifier: str) -> str:
    """An identifier without its version clause."""
    return identifier.removesuffix("+").removesuffix("-or-later").removesuffix("-only")


def is_known(identifier: str) -> bool:
    return whole(identifier) in FREE | RESTRICTING or identifier.startswith("licenseref-")


def postfix(expression: str) -> tuple[list[str], bool]:
    """Shunting-yard: the expression in postfix order, and whether it was well formed.

    Reading stops at the first word that can't continue the expression
    (``MIT */`` ends after ``MIT``), so trailing comment marks do no harm.
    """
    out: list[str] = []
    ops: list[str] = []
    sound, operand_next = True, True
    for m in TOKEN.finditer(SLASH.sub(" or ", expression)):
        token = m.group()
        if token in PRECEDENCE:
            if operand_next:
                sound = False
                continue
            while ops and ops[-1] != "(" and PRECEDENCE[ops[-1]] >= PRECEDENCE[token]:
                out.append(ops.pop())
            ops.append(token)
            operand_next = True
        elif token == "(":
            if not operand_next:
                break
            ops.append(token)
        elif token == ")":
            if operand_next or "(" not in ops:
                sound = False
                break
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
        else:
            if not operand_next:
                break
            out.append(token)
            operand_next = False
    if operand_next:
        sound = False
    while ops:
        op = ops.pop()
        if op == "(":
            sound = False
        else:
            out.append(op)
    return out, sound


def evaluate(expression: str) -> tuple[list[str], bool | None]:
    """Identifiers of an expression, and whether it leaves reuse free.

    ``or`` lets the reader choose, so one free side is enough; ``and`` needs
    both; ``with`` adds an exception, which only ever widens the left side.
    The verdict is None where nothing could be read.
    """
    order, sound = postfix(expression)
    stack: list[bool] = []
    names: list[str] = []
    exception: str | None = None
    for token in order:
        if token in PRECEDENCE:
            if len(stack) < 2:
                continue
            right, left = stack.pop(), stack.pop()
            if token == "with":
                stack.append(left)
            else:
                stack.append((left or right) if token == "or" else (left and right))
        else:
            names.append(token)
            stack.append(whole(token) in FREE)
    # An exception's name stands right of "with"; it is no licence of its own.
    for m in re.finditer(r"\bwith\s+([a-z0-9][a-z0-9.+-]*)", expression):
        exception = m.group(1)
        if exception in names:
            names.remove(exception)
    return names, (stack[-1] if stack and sound else None)


def scan_text(text: bytes | None, found: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base labels, labels, score, expressions, reuse)."""
    data = text or b""
    words = data.translate(ALNUM_LOWER).split()
    joined = " " + b" ".join(words).decode("latin-1") + " "
    n_base, first, last = 0, None, None
    base: set[str] = set()
    labels: set[str] = set()
    evidence: dict[str, float] = {}
    tagged = False
    seen, at = 0, 0  # blanks counted so far, up to where
    for end, (kind, phrase, label, weight) in found.iter(joined):
        if kind == "tag":
            tagged = True
            continue
        evidence[phrase] = weight
        labels.add(label)
        if kind == "base":
            start = end - len(phrase) - 1
            if start >= at:
                seen += joined.count(" ", at, start)
                at = start
                word = seen
            else:
                word = joined.count(" ", 0, start)
            n_base += 1
            base.add(label)
            first = word if first is None else min(first, word)
            last = word if last is None else max(last, word)
    expressions: list[str] = []
    verdicts: list[bool] = []
    if tagged:
        for m in TAG_PATTERN.finditer(data.translate(LOWER_ASCII)):
            line = m.group(1).decode("utf-8").strip()
            names, free = evaluate(line)
            if names:
                expressions.append(line)
                labels.update(n if is_known(n) else UNKNOWN for n in names)
                evidence[TAG] = TAG_WEIGHT
            if free is not None:
                verdicts.append(free)
    doubt = 1.0
    for key in sorted(evidence):
        doubt *= 1.0 - evidence[key]
    reuse = None if not verdicts else ("free" if all(verdicts) else "restricted")
    return (
        len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)),
        1.0 - doubt if evidence else 0.0, expressions, reuse,
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: places of the base phrases, labels, expressions, score.

    Map-only: no shuffle, one text in memory at a time beside its batch.
    """
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        fields = pa.schema([
            ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
            ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
            ("expressions", pa.list_(pa.string())), ("reuse", pa.string()),
        ])
        for batch in batches:
            rows = [scan_text(t, found) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
            arrays = [pa.array(c, type=f.type) for c, f in zip(cols, fields, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", *fields.names])

    return docs.mapInArrow(
        scan,
        f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, expressions array<string>, reuse string",
    )
