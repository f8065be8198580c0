"""License scan: an Aho-Corasick automaton finds identifier tags and notice phrases, and a shunting-yard parser
evaluates the and/or/with expressions behind the tags."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.frames import narrow, text_groups

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices that the scan knows besides, as words in lower case.
NOTICES = {
    "apache license version 2 0": "apache-2.0",
    "apache software license": "apache",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "this is free and unencumbered software": "unlicense",
    "proprietary and confidential": "proprietary",
}

#: How much a license asks of a user, 0 (nothing) to 1 (no use without consent).
BURDEN = {
    "cc0": 0.05, "unlicense": 0.05, "mit": 0.1, "bsd": 0.1, "isc": 0.1, "zlib": 0.1, "apache": 0.15, "cc-by": 0.2,
    "mpl": 0.4, "epl": 0.4, "cc-by-sa": 0.5, "lgpl": 0.5, "gpl": 0.7, "agpl": 0.8, "cc-by-nc": 0.8, "cc-by-nd": 0.8,
    "proprietary": 1.0, "reserved": 1.0,
}
UNKNOWN_BURDEN = 0.5

TAG = "spdx-license-identifier:"
_TAG_WORDS = "spdx license identifier"
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_RANK = {"or": 1, "and": 2, "with": 3}
_DIGITS = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
#: Bytes of words as they are, A-Z in lower case, everything else a blank.
_WORDS = bytes(b if b in _DIGITS else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def burden(label: str) -> float:
    """The burden of a label: of its longest known beginning, so ``gpl-3.0-only`` counts as ``gpl``."""
    known = [k for k in BURDEN if label == k or label.startswith((k + "-", k + "+"))]
    return BURDEN[max(known, key=len)] if known else UNKNOWN_BURDEN


def expression_tokens(text: str) -> list[str]:
    """The longest run of tokens at the start of ``text`` that is an expression; empty if there is none."""
    tokens: list[str] = []
    depth, want, valid = 0, True, 0  # want: an operand comes next
    at = 0
    while m := _TOKEN.match(text, at):
        token = m[1].rstrip(".:") if m[1] not in "()" else m[1]
        word = token.lower()
        if want:
            if token == "(":
                depth += 1
            elif token == ")" or word in _RANK:
                break
            else:
                want = False
        elif token == ")" and depth:
            depth -= 1
        elif word in _RANK:
            want = True
        else:
            break
        tokens.append(word)
        if not want and not depth:
            valid = len(tokens)
        if m[1] != token:  # a full stop ends it
            break
        at = m.end()
    return tokens[:valid]


def to_postfix(tokens: Sequence[str]) -> list[str]:
    """Shunting-yard: ``with`` binds closest, then ``and``, then ``or``."""
    out: list[str] = []
    waiting: list[str] = []
    for token in tokens:
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif token in _RANK:
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[token]:
                out.append(waiting.pop())
            waiting.append(token)
        else:
            out.append(token)
    return out + waiting[::-1]


def evaluate(tokens: Sequence[str]) -> tuple[list[str], float]:
    """The labels that hold and their burden: ``or`` takes the lighter side (the left one of equals), ``and`` both
    sides with the heavier burden, and an exception halves the burden of the license it goes with."""
    stack: list[tuple[list[str], float]] = []
    for token in to_postfix(tokens):
        if token not in _RANK:
            stack.append(([token], burden(token)))
            continue
        (labels_b, b), (labels_a, a) = stack.pop(), stack.pop()
        if token == "or":
            stack.append((labels_a, a) if a <= b else (labels_b, b))
        elif token == "and":
            stack.append((labels_a + labels_b, max(a, b)))
        else:
            stack.append((labels_a, a / 2))
    labels, score = stack[0]
    return sorted(set(labels)), score


class Scanner:
    def __init__(self, base: Mapping[str, str], notices: Mapping[str, str]):
        import ahocorasick

        self.find = ahocorasick.Automaton()
        found: dict[str, list[tuple[str, str]]] = {}
        for kind, phrases in (("base", base), ("notice", notices), ("tag", {_TAG_WORDS: ""})):
            for phrase, label in phrases.items():
                found.setdefault(phrase, []).append((kind, label))
        for phrase, what in found.items():
            # every byte is one character here; a phrase stands between blanks
            spaced = f" {phrase.encode().decode('latin-1')} "
            self.find.add_word(spaced, (len(spaced), phrase.count(" ") + 1, what))
        self.find.make_automaton()

    def scan(self, text: str) -> tuple[int, list[dict], list[dict]]:
        """Number of words, the phrases found, and the expressions behind tags."""
        words = text.encode().translate(_WORDS).split()
        spaced = b" " + b" ".join(words) + b" "
        hits = sorted((end + 1 - size, n, what) for end, (size, n, what) in self.find.iter(spaced.decode("latin-1")))
        matches, tagged, at, word = [], False, 0, 0
        for start, n, what in hits:
            word += spaced.count(b" ", at, start)
            at = start
            for kind, label in what:
                if kind == "tag":
                    tagged = True
                else:
                    matches.append({"kind": kind, "label": label, "start_word": word, "n_words": n})
        return len(words), matches, list(self.expressions(text)) if tagged else []

    @staticmethod
    def expressions(text: str) -> Iterator[dict]:
        for m in re.finditer(re.escape(TAG), text, re.IGNORECASE):
            line = text[m.end() : text.find("\n", m.end()) if "\n" in text[m.end() :] else len(text)]
            if tokens := expression_tokens(line):
                labels, score = evaluate(tokens)
                yield {"expression": " ".join(tokens), "labels": labels, "burden": score}


SCHEMA = (
    "doc_id long, n_words long, matches array<struct<kind:string,label:string,start_word:long,n_words:int>>, "
    "expressions array<struct<expression:string,labels:array<string>,burden:double>>, score double"
)


def scan(docs: DataFrame, base: Mapping[str, str] = BASE, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    """Words, phrases and license expressions of every whole text.

    Words are runs of 0-9, a-z and characters beyond ASCII after A-Z is lowered. A phrase matches wherever its words
    stand one after the other, overlaps included. ``score`` is the heaviest burden of anything found, 0 for nothing.
    A null or empty text has no words and nothing found; null and repeated doc_ids and repeated rows are kept; other
    columns are ignored; an empty table gives no rows. A tag without a readable expression counts for nothing.
    """
    match = pa.struct([("kind", pa.string()), ("label", pa.string()), ("start_word", pa.int64()), ("n_words", pa.int32())])
    expression = pa.struct([("expression", pa.string()), ("labels", pa.list_(pa.string())), ("burden", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for batch, texts in text_groups(batches):
            n, matches, found = zip(*map(scanner.scan, texts), strict=True)
            scores = [max([0.0, *(burden(m["label"]) for m in ms), *(x["burden"] for x in es)]) for ms, es in zip(matches, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(matches, pa.list_(match)), pa.array(found, pa.list_(expression)), pa.array(scores, pa.float64())],
                ["doc_id", "n_words", "matches", "expressions", "score"],
            )

    return narrow(docs).mapInArrow(run, SCHEMA)


def digest(scanned: DataFrame) -> DataFrame:
    """One row per document: counts, places and labels of base phrases, and all labels."""
    base = F.filter("matches", lambda m: m["kind"] == "base")
    rows = scanned.withColumn("_base", base)
    starts = F.transform("_base", lambda m: m["start_word"])

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    every = F.concat(F.transform("matches", lambda m: m["label"]), F.flatten(F.transform("expressions", lambda x: x["labels"])))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(F.transform("_base", lambda m: m["label"])).alias("base_labels"),
        joined(every).alias("labels"),
        "score",
    )
