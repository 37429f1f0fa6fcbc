"""Licence scan: an Aho-Corasick automaton finds identifier tags and notice
phrases, a shunting-yard parser evaluates the expressions behind the tags.

A text's ASCII capitals are lowered and it is read as words, runs of ASCII
digits, ASCII letters and all characters above ASCII.  The automaton runs
over the words, parted by single spaces, so a phrase is found wherever its
words stand consecutively.  Behind an identifier tag the rest of the line is
parsed as an expression of identifiers, AND, OR, WITH and parentheses; WITH
binds closest, OR least.  An expression gives the labels of its identifiers
and its demand: OR offers the mildest of its parts, AND asks for the
strictest, WITH eases its licence by one degree.

Score: the chance that at least one of the findings is real, each taken as
independent with the confidence of its kind (0 without findings).

Defined cases: a null text is the empty text (no words, no labels, score 0);
an expression that does not parse gives the identifiers known in it and no
demand; nested parentheses of any depth are read without recursion; any
length of text is scanned whole; rows are scanned alone; other columns pass
through, those whose names clash with the new ones give way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from velolake.llm.common import extended, slices

# Notice phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICE_PHRASES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
# Prefixes of identifiers, their labels and degrees of demand
# (0 asks for nothing, 1 for notices, 2 for shared changes, 3 for a shared
# work, 4 for a shared service or no commerce).
FAMILIES = (
    ("agpl", "agpl", 4), ("lgpl", "lgpl", 2), ("gpl", "gpl", 3), ("apache", "apache", 1), ("mit", "mit", 1), ("bsd", "bsd", 1),
    ("0bsd", "bsd", 0), ("isc", "isc", 1), ("mpl", "mpl", 2), ("epl", "epl", 2), ("cc0", "cc0", 0), ("cc-by-nc", "cc-by-nc", 4),
    ("cc-by-nd", "cc-by-nd", 4), ("cc-by-sa", "cc-by-sa", 3), ("cc-by", "cc-by", 1), ("unlicense", "public-domain", 0),
)
CONFIDENCE = {"tag": 0.98, "base": 0.9, "notice": 0.8}
BINDING = {"with": 3, "and": 2, "or": 1}

TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")
TAG_LINE = re.compile(r"spdx-license-identifier[ \t]*:?([^\n]*)")
#: bytes: capitals lowered, what is part of no word a space
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, phrases in (("notice", NOTICE_PHRASES), ("base", BASE_PHRASES), ("tag", {TAG: ""})):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (kind, label, len(phrase) + 1, phrase.count(" ") + 1))
    found.make_automaton()
    return found


def family(identifier: str) -> tuple[str, int] | None:
    return next(((label, degree) for prefix, label, degree in FAMILIES if identifier.startswith(prefix)), None)


def postfix(tokens: list[str]) -> list[str] | None:
    """Tokens of an expression in postfix order (Dijkstra's shunting yard);
    None if they are no expression."""
    out, waiting, operand = [], [], False
    for t in tokens:
        if t == "(":
            if operand:
                return None
            waiting.append(t)
        elif t == ")":
            if not operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif t in BINDING:
            if not operand:
                return None
            while waiting and waiting[-1] != "(" and BINDING[waiting[-1]] >= BINDING[t]:
                out.append(waiting.pop())
            waiting.append(t)
            operand = False
        else:
            if operand:
                return None
            out.append(t)
            operand = True
    if not operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(expression: str) -> tuple[set[str], int | None]:
    """Labels of an expression's identifiers, and the demand of the whole
    (None if it does not parse or no identifier of it is known)."""
    tokens = TOKEN.findall(expression.lower())
    order = postfix(tokens)
    known = {f[0] for t in tokens if t not in BINDING and (f := family(t))}
    if order is None:
        return known, None
    stack: list[int | None] = []
    for t in order:
        if t not in BINDING:
            f = family(t)
            stack.append(f[1] if f else None)
            continue
        right, left = stack.pop(), stack.pop()
        if t == "with":  # the right side names an exception
            stack.append(None if left is None else max(left - 1, 0))
        else:
            both = [x for x in (left, right) if x is not None]
            stack.append((min if t == "or" else max)(both) if both else None)
    return known, stack[0]


def scan_text(text: str) -> tuple[int, list[tuple[str, str, int, int]], list[str], int | None]:
    """Words; findings (kind, label, first word, words) by place; labels;
    the strictest demand of the tags' expressions."""
    words = text.encode("utf-8").translate(WORD_BYTES).split()
    if not words:
        return 0, [], [], None
    packed = b" " + b" ".join(words) + b" "
    found, labels, demand, tagged = list(automaton().iter(packed.decode("latin-1"))), set(), None, False
    # a place's word is the number of spaces before it
    spaces = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32) if found else np.zeros(0, np.int64)
    places = np.searchsorted(spaces, [end - data[2] for end, data in found]).tolist()
    findings = []
    for (_, (kind, label, _, n)), first in zip(found, places):
        findings.append((kind, label, first, n))
        tagged = tagged or kind == "tag"
        if label:
            labels.add(label)
    if tagged:
        for expression in TAG_LINE.findall(text.lower()):
            known, degree = evaluate(expression)
            labels |= known
            demand = max((x for x in (demand, degree) if x is not None), default=None)
    findings.sort(key=lambda f: f[2])
    return len(words), findings, sorted(labels), demand


FINDING = StructType([StructField("kind", StringType()), StructField("label", StringType()), StructField("word", LongType()), StructField("n", LongType())])
SCAN = StructType(
    [
        StructField("n_words", LongType()),
        StructField("findings", ArrayType(FINDING)),
        StructField("labels", ArrayType(StringType())),
        StructField("demand", IntegerType()),
        StructField("score", DoubleType()),
    ]
)


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``findings``, ``labels``, ``demand``, ``score``."""
    kept, schema = extended(df, SCAN)
    source, places = df.columns.index(text), [df.columns.index(k) for k in kept]
    finding = pa.struct([("kind", pa.string()), ("label", pa.string()), ("word", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [scan_text(x or "") for x in batch.column(source).to_pylist()]
            score = []
            for _, findings, _, _ in rows:
                missed = 1.0
                for f in findings:
                    missed *= 1 - CONFIDENCE[f[0]]
                score.append(1 - missed)
            new = [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([[dict(zip(("kind", "label", "word", "n"), f)) for f in r[1]] for r in rows], pa.list_(finding)),
                pa.array([r[2] for r in rows], pa.list_(pa.string())),
                pa.array([r[3] for r in rows], pa.int32()),
                pa.array(score, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(p) for p in places] + new, names=schema.names)

    return df.mapInArrow(run, schema)


def digest(documents: DataFrame) -> DataFrame:
    """Per document: base places and labels, all labels, score, demand."""
    made = scan(documents.select("doc_id", "text"))
    base = F.filter("findings", lambda f: f["kind"] == "base")
    starts = F.transform(base, lambda f: f["word"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return made.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(F.transform(base, lambda f: f["label"])).alias("base_labels"), joined(F.col("labels")).alias("labels"), "score", "demand",
    )
