"""Licence scan: notice phrases and identifier tags by one Aho-Corasick automaton, expressions by shunting-yard.

A text is read as words of digits, A-Z (lower-cased) and all characters from U+0080 on; whatever lies
between two words counts as one gap. One automaton over those bytes finds, in a single pass and at
every place, the base phrases, further notice phrases, the words that grant a licence ("released under")
and the words of an identifier tag. A find counts if it starts and ends with whole words of one text. Behind
a tag the text itself is read on: identifiers, parentheses, ``and``, ``or`` and ``with`` go through a
shunting-yard parser to reverse Polish notation, which is then evaluated. A licence weighs as much as what
it asks for (``WEIGHTS``); ``or`` takes the lighter side, ``and`` the heavier one, and ``with`` an exception
makes a licence one step lighter. Each text is judged alone, by its partition, without a shuffle.

``find_licenses`` gives each row's finds with byte offsets; ``license_report`` sums them up.

Edge cases: a null text is an empty one, with no words, no finds, empty labels and score 0; a find may overlap
another, and all count; the expression ends at the line's end or where the grammar allows no next
token, what is left open is closed and marks the find as malformed; an identifier that no rule knows is
``other``; equal rows are reported alike; ids may be null or repeat; an empty table gives an empty
result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import LOWER, slices, text_bytes, with_text

# Phrases and their labels that every report counts as base.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Further phrases of licence notices.
NOTICES = {
    "gnu general public licence": "gpl",
    "gnu gpl": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache licence": "apache",
    "mit licence": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "boost software license": "boost",
    "isc license": "isc",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "free and unencumbered software released into the public domain": "unlicense",
}

# Words that grant a licence when a phrase follows within ``REACH`` words.
GRANTS = (
    "licensed under", "licenced under", "released under", "distributed under", "available under", "published under",
    "provided under", "under the terms of", "subject to the terms of",
)
REACH = 12
TAG = "spdx license identifier"

# The family of an identifier is that of its longest known beginning.
FAMILIES = {
    "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "apache": "apache", "mit": "mit", "bsd": "bsd", "0bsd": "bsd",
    "mpl": "mpl", "epl": "epl", "eupl": "eupl", "bsl-1.0": "boost", "isc": "isc", "cc-by": "cc-by",
    "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc0": "cc0", "unlicense": "unlicense",
}
OTHER = "other"

# What a family asks for, from nothing to no free use; an unknown one weighs most.
LEVELS = ("permissive", "weak copyleft", "copyleft", "restricted", "unknown")
WEIGHTS = {
    "mit": 0, "apache": 0, "bsd": 0, "boost": 0, "isc": 0, "cc0": 0, "unlicense": 0, "cc-by": 0,
    "lgpl": 1, "mpl": 1, "epl": 1, "eupl": 1, "gpl": 2, "agpl": 2, "cc-by-sa": 2, "cc-by-nc": 3, "cc-by-nd": 3,
}
UNKNOWN = len(LEVELS) - 1

# How sure a find is.
SURE, GRANTED, NAMED, DOUBTFUL = 1.0, 0.9, 0.7, 0.5

WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True
STEP = 1 << 20  # bytes that the automaton is given at a time
_NEXT = re.compile(rb"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.\-]*\+?))")
_SIGN = re.compile(rb"[\"' \t]*[:=]?[\"' \t]*")
BINDS = {"or": 1, "and": 2, "with": 3}


# --- expressions ---------------------------------------------------------------------------------


def tokens(data, start: int, end: int) -> Iterator[tuple[str, int]]:
    """Lower-cased identifiers, operators and parentheses from ``start`` on, each with its end."""
    while found := _NEXT.match(data, start, end):
        start = found.end()
        yield (found[1] or found[2]).decode().lower(), start


def parse(found: Iterator[tuple[str, int]], start: int = 0) -> tuple[list[str], int, bool]:
    """Reverse Polish notation of the longest expression at the front, its end, and whether it is well formed."""
    out: list[str] = []
    waiting: list[str] = []
    end, operand, deep = start, True, 0  # ``operand``: whether one comes next
    for token, stop in found:
        if token == "(":
            if not operand:
                break
            waiting.append(token)
            deep += 1
        elif token == ")":
            if operand or not deep:
                break
            deep -= 1
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif token in BINDS:
            if operand:
                break
            while waiting and BINDS.get(waiting[-1], 0) >= BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        else:
            if not operand:
                break
            out.append(token)
            operand = False
        end = stop
    whole = not operand and not deep
    if operand:  # drop the last operator, which lacks a right side, and what was opened behind it
        while waiting and waiting.pop() == "(":
            pass
    while waiting:
        if (top := waiting.pop()) != "(":
            out.append(top)
    return out, end, whole


def family(identifier: str) -> str:
    known = [f for f in FAMILIES if identifier.startswith(f)]
    return FAMILIES[max(known, key=len)] if known else OTHER


def evaluate(notation: list[str]) -> tuple[list[str], int, str]:
    """Families, weight and plain form of an expression in reverse Polish notation."""
    stack: list[tuple[frozenset[str], int, object]] = []
    for token in notation:
        if token not in BINDS:
            name = family(token)
            stack.append((frozenset([name]), WEIGHTS.get(name, UNKNOWN), token))
            continue
        right, left = stack.pop(), stack.pop()
        said = (left[2], token, right[2])
        if token == "with":
            stack.append((left[0], max(0, left[1] - 1) if left[1] < UNKNOWN else UNKNOWN, said))
        else:
            stack.append((left[0] | right[0], (min if token == "or" else max)(left[1], right[1]), said))
    names, weight, said = stack[0]
    return sorted(names), weight, _plain(said)


def _plain(tree) -> str:
    """The expression in full parentheses; a loop, as expressions may be long."""
    out, left = [], [tree]
    while left:
        part = left.pop()
        if isinstance(part, str):
            out.append(part)
        else:
            left += [")", part[2], f" {part[1]} ", part[0], "("]
    return "".join(out)


# --- the automaton -------------------------------------------------------------------------------

_AUTOMATON: list[ahocorasick.Automaton] = []


def automaton() -> ahocorasick.Automaton:
    """All phrases with their kind, label and length; built once in a process."""
    if not _AUTOMATON:
        made = ahocorasick.Automaton()
        for kind, phrases in (
            ("base", BASE), ("notice", NOTICES), ("grant", dict.fromkeys(GRANTS)), ("tag", {TAG: None})
        ):
            for phrase, label in phrases.items():
                made.add_word(phrase, (kind, label, len(phrase)))
        made.make_automaton()
        _AUTOMATON.append(made)
    return _AUTOMATON[0]


LONGEST = max(map(len, [*BASE, *NOTICES, *GRANTS, TAG]))


def matches(data: np.ndarray) -> Iterator[tuple[int, int, str, str | None]]:
    """Start, end, kind and label of every phrase, in the order of their ends."""
    search = automaton().iter
    for at in range(0, len(data), STEP):
        first = max(0, at - LONGEST)
        for last, (kind, label, length) in search(data[first : at + STEP].tobytes().decode("latin-1")):
            end = first + last + 1
            if end > at:  # the overlap was searched before
                yield end - length, end, kind, label


def scan(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """Words of each text, and the finds ``(text, start, end, word, kind, labels, weight, said, score)``."""
    inside = WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    gaps = ~inside
    gaps[1:] &= inside[:-1]
    kept = np.flatnonzero(inside | gaps)
    plain = np.where(inside, LOWER[data], np.uint8(0x20))[kept]
    words = np.concatenate(([0], np.cumsum(begins)))
    first = words[bounds[:-1]]
    counts = words[bounds[1:]] - first
    out: list[tuple] = []
    granted: dict[int, int] = {}  # text -> word behind its last grant
    raw = memoryview(data)
    # A phrase is reported where it ends, so a grant comes before the phrase that it grants.
    for a, b, kind, label in matches(plain):
        start, last = int(kept[a]), int(kept[b - 1])
        if not (begins[start] and stops[last]):
            continue
        text = int(np.searchsorted(bounds, start, "right")) - 1
        if last >= bounds[text + 1]:
            continue
        word = int(words[start] - first[text])
        here = start - int(bounds[text])
        until = last + 1 - int(bounds[text])
        if kind == "grant":
            granted[text] = int(words[last + 1] - first[text])
        elif kind == "tag":
            limit = int(bounds[text + 1])
            at = _SIGN.match(raw, last + 1, limit).end()
            notation, end, whole = parse(tokens(raw, at, limit), at)
            if notation:
                names, weight, said = evaluate(notation)
                score = SURE if whole and weight < UNKNOWN else DOUBTFUL
                out.append((text, here, end - int(bounds[text]), word, kind, names, LEVELS[weight], said, score))
        else:
            near = 0 <= word - granted.get(text, -REACH - 1) <= REACH
            weight = LEVELS[WEIGHTS[label]]
            out.append((text, here, until, word, kind, [label], weight, None, GRANTED if near else NAMED))
    return counts, out


FIND = ("array<struct<start:long,end:long,word:long,kind:string,labels:array<string>,level:string,"
        "expression:string,score:double>>")
_FIND = pa.list_(pa.struct([
    ("start", pa.int64()), ("end", pa.int64()), ("word", pa.int64()), ("kind", pa.string()),
    ("labels", pa.list_(pa.string())), ("level", pa.string()), ("expression", pa.string()), ("score", pa.float64()),
]))


def find_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``n_words`` and ``finds``: byte offsets, word number, kind (base, notice or tag), labels,
    level, the tag's expression in full parentheses, and a score."""
    rows = with_text(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = [f.name for f in _FIND.value_type]

    def run(batches):
        for batch in batches:
            data, bounds = text_bytes(batch.column(1))
            for a, b in slices(bounds):
                counts, found = scan(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                finds: list[list[dict]] = [[] for _ in range(b - a)]
                for text, *values in found:
                    finds[text].append(dict(zip(names, values)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()), pa.array(finds, _FIND)],
                    ["doc_id", "n_words", "finds"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, finds {FIND}").withColumnRenamed("doc_id", id_col)


def license_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the finds summed up: base places, labels, best score, and the heaviest level of its tags."""
    found = find_licenses(df, id_col, text_col)
    base = F.filter("finds", lambda x: x["kind"] == "base")
    starts = F.transform("_base", lambda x: x["word"])

    def joined(finds):
        return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform(finds, lambda x: x["labels"])))), ",")

    tags = F.transform(F.filter("finds", lambda x: x["kind"] == "tag"), lambda x: x["level"])
    ranks = F.array(*[F.lit(x) for x in LEVELS])
    heaviest = F.array_max(F.transform(tags, lambda x: F.array_position(ranks, x)))
    return found.withColumn("_base", base).select(
        id_col,
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined("_base").alias("base_labels"),
        joined("finds").alias("labels"),
        F.coalesce(F.array_max(F.transform("finds", lambda x: x["score"])), F.lit(0.0)).alias("score"),
        F.try_element_at(ranks, heaviest.cast("int")).alias("tag_level"),
    )
