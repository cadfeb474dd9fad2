"""Operator 13: licence scans by an Aho-Corasick automaton and a shunting-yard parser of licence expressions.

Texts are lower-cased (A-Z) and cut into words of ASCII letters, digits and all characters beyond ASCII. One automaton finds the notice
phrases and the identifier tags among the words. After a tag and a colon stands a licence expression, which is parsed in the text itself
and evaluated: `or` leaves the choice (the least restrictive side), `and` binds to both (the most restrictive one), `with` an exception
turns a licence that spreads to the whole work into one that spreads to its own files. What a document's notices and expressions ask for
together is its score: 0 for nothing found or nothing asked for, 1 for no use without leave.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import read_table, starts, text_slices

# Phrases whose places are counted, and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Further phrases. A phrase that opens with "the" or is common in prose is left out.
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "european union public licence": "eupl", "boost software license": "bsl",
    "bsd license": "bsd", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc", "zlib license": "zlib", "sil open font license": "ofl", "permission is hereby granted free of charge": "mit",
    "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc by nc": "cc-by-nc", "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by", "cc0": "cc0", "dedicated to the public domain": "public-domain", "all rights reserved": "all-rights-reserved",
}
# An expression follows these words and a colon.
TAGS = ("spdx license identifier", "license expression")
# What a label asks for: 0 nothing, 0.1 naming, 0.4 its own files under the same terms, 0.7 the whole work, 0.9 uses excluded, 1 leave.
LEVELS = {
    "cc0": 0.0, "public-domain": 0.0, "unlicense": 0.0, "0bsd": 0.0, "wtfpl": 0.0, "mit": 0.1, "bsd": 0.1, "isc": 0.1, "zlib": 0.1, "bsl": 0.1,
    "apache": 0.1, "cc-by": 0.1, "ofl": 0.1, "python": 0.1, "psf": 0.1, "artistic": 0.1, "lgpl": 0.4, "mpl": 0.4, "epl": 0.4, "eupl": 0.7,
    "gpl": 0.7, "agpl": 0.7, "cc-by-sa": 0.7, "cc-by-nd": 0.9, "cc-by-nc": 0.9, "cc-by-nc-sa": 0.9, "cc-by-nc-nd": 0.9, "all-rights-reserved": 1.0,
}
OWN_TERMS = "licenseref"  # label of LicenseRef-...: terms that stand elsewhere
WITH_EXCEPTION, UNSEEN = 0.4, 1.0
STRENGTH = {"or": 1, "and": 2, "with": 3}

_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:\-]*)")
_COLON = re.compile(r"[\"'`]*[ \t]*:[ \t]*[\"'`]*")


def licence_label(name: str) -> str | None:
    """Label of a licence id of an expression (``Apache-2.0`` is apache), None for a word that is no licence id."""
    low = name.lower().rstrip("+.:")
    if low.startswith("licenseref-") or ":licenseref-" in low:
        return OWN_TERMS
    while low:
        if low in LEVELS:
            return low
        low = low.rpartition("-")[0]
    return None


def parse_expression(text: str) -> tuple[list[str], float, int] | None:
    """Labels in order, level and length of the licence expression that ``text`` opens with; None if it opens with none.

    Shunting yard: operands go to one stack, operators wait on the other until a weaker one or a bracket comes. The expression is the
    longest beginning that is complete: it ends before a word that fits no further, so prose may follow.
    """
    values: list[tuple[float, bool]] = []  # level, and whether it is the name of an exception
    waiting: list[str] = []
    labels: list[str] = []
    good: tuple[list[str], float, int] | None = None

    def reduce(values: list, op: str) -> None:
        right, left = values.pop(), values.pop()
        if op == "with":
            values.append((min(left[0], WITH_EXCEPTION), False))
        else:
            values.append(((min if op == "or" else max)(left[0], right[0]), False))

    at, operand = 0, True  # whether an operand is due
    while m := _TOKEN.match(text, at):
        word, low = m[1], m[1].lower()
        if operand:
            if word == "(" and (not waiting or waiting[-1] != "with"):
                waiting.append("(")
            elif waiting and waiting[-1] == "with":
                if not low.rstrip(".").endswith(("-exception", "-note", "exception")) and "-exception-" not in low:
                    break
                values.append((0.0, True))
                operand = False
            elif (label := licence_label(word)) is not None:
                labels.append(label)
                values.append((LEVELS.get(label, UNSEEN), False))
                operand = False
            else:
                break
        elif word == ")":
            if "(" not in waiting:
                break
            while (op := waiting.pop()) != "(":
                reduce(values, op)
        elif low in STRENGTH:
            while waiting and waiting[-1] != "(" and STRENGTH[waiting[-1]] >= STRENGTH[low]:
                reduce(values, waiting.pop())
            waiting.append(low)
            operand = True
        else:
            break
        at = m.end()
        if not operand and "(" not in waiting:
            left = list(values)
            for op in reversed(waiting):
                reduce(left, op)
            good = list(labels), left[0][0], at
    return good


@functools.cache
def _automaton():
    """Automaton over words with a space on either side; values: kind, label, number of words."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE_PHRASES), ("phrase", MORE_PHRASES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in phrases.items():
            automaton.add_word(f" {phrase} ", (kind, label, len(phrase.split()), len(phrase) + 1))
    automaton.make_automaton()
    return automaton


@functools.cache
def _word_table() -> np.ndarray:
    """Lower-case byte of each byte of a word, a space for the others."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32
    return table


BETWEEN = b" \n "  # documents stand between spaces; after the mapping only these line ends remain, and no phrase holds one


def scan_texts(texts: list[str]) -> tuple[list[int], list[list[tuple]]]:
    """Number of words, and the finds (kind, label, word, words, level, expression) of each text in order of their place."""
    encoded = [t.encode() for t in texts]
    raw = b" " + BETWEEN.join(encoded) + b" "
    at = starts(np.fromiter(map(len, encoded), np.int64, len(encoded)) + len(BETWEEN))[:-1] + 1
    data = _word_table()[np.frombuffer(raw, np.uint8)]
    data[at[1:] - 2] = 10
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    places = np.flatnonzero(keep)
    words = data[keep]
    first = np.flatnonzero((words[1:] != 32) & (words[1:] != 10) & (words[:-1] == 32)) + 1
    doc_first = np.searchsorted(places[first], at)
    ends = np.append(doc_first[1:], len(first))
    found: list[list[tuple]] = [[] for _ in texts]
    covered: list[tuple[int, int]] = [(-1, -1)] * len(texts)
    hits = sorted(((end - v[3], v) for end, v in _automaton().iter(words.tobytes().decode("latin-1"))), key=lambda h: (h[0], h[1][0] != "tag"))
    numbers = np.searchsorted(first, [h[0] for h in hits]) if hits else []
    for number, (_, (kind, label, n, _)) in zip(map(int, numbers), hits, strict=True):
        doc = int(np.searchsorted(doc_first, number, side="right")) - 1
        word = number - int(doc_first[doc])
        if kind != "tag":
            # A phrase inside an expression's text asks for nothing beside it.
            inside = covered[doc][0] <= word < covered[doc][1]
            found[doc].append((kind, label, word, n, None if inside else LEVELS[label], None))
            continue
        # The raw end of the tag's last word.
        start = int(places[first[number + n - 1]])
        while start < len(raw) and data[start] != 32:
            start += 1
        stop = int(at[doc]) + len(encoded[doc])
        line = raw[start:stop if (cut := raw.find(b"\n", start, stop)) < 0 else cut].decode("utf-8", "replace")
        if (colon := _COLON.match(line)) and (parsed := parse_expression(line[colon.end():])):
            labels, level, length = parsed
            text = line[colon.end():colon.end() + length].strip()
            till = start + len(line[:colon.end() + length].encode())
            after = int(np.searchsorted(places[first], till)) - int(doc_first[doc])
            covered[doc] = (word, after)
            found[doc] += [("expression", label, word, after - word, level, text) for label in dict.fromkeys(labels)]
    return (ends - doc_first).tolist(), found


FIND = "struct<kind:string,label:string,word:long,n_words:long,level:double,expression:string>"


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words`` and ``finds`` of each row; other columns are ignored.

    A find has a kind (base, phrase or expression), a label, its first word's number, its number of words, the level of what it asks for
    (an expression's labels all carry the level of the whole; null for a phrase inside an expression) and the expression's text. All
    places are found, whatever their number, overlapping ones too. Rows are kept one for one; a null text counts as empty and has no
    words, a null id stays null.
    """
    kind = pa.struct([("kind", pa.string()), ("label", pa.string()), ("word", pa.int64()), ("n_words", pa.int64()),
                      ("level", pa.float64()), ("expression", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in kind]
        for part, texts in text_slices(batches):
            n, found = scan_texts(texts)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(n, pa.int64()),
                pa.array([[dict(zip(names, x, strict=True)) for x in own] for own in found], pa.list_(kind))], ["doc_id", "n_words", "finds"])

    return (docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text")
            .mapInArrow(run, f"doc_id long, n_words long, finds array<{FIND}>"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places, labels and score of the licence notices of every whole text of ``documents``."""
    found = scan_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"))

    def labels(of: str) -> F.Column:
        return F.expr(f"array_join(array_sort(array_distinct(transform({of}, x -> x.label))), ',')")

    base = "filter(finds, x -> x.kind = 'base')"
    return found.select(
        "doc_id", "n_words", F.expr(f"cast(size({base}) as long)").alias("n_base"),
        F.expr(f"array_min(transform({base}, x -> x.word))").alias("first_word"),
        F.expr(f"array_max(transform({base}, x -> x.word))").alias("last_word"),
        labels(base).alias("base_labels"), labels("finds").alias("labels"),
        F.expr("coalesce(array_max(transform(finds, x -> x.level)), 0D)").alias("score"), "finds")
