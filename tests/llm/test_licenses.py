import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import frame
from tidewheel.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    "CC-BY 4.0, cc by; CC BY-NC 4.0", "GNU General Public License general public license", "ALL rights\nreserved. all rights  reserved", None, "",
    "ccby cc bye cc by", "é cc by ünï", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
    "SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause\nmore", "spdx-license-identifier: GPL-3.0-or-later WITH Classpath-exception-2.0.", "SPDX-License-Identifier: OR", "x " * 20000 + "all rights reserved",
]


def brute(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = WORDS.findall(lowered)
    found = []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_digest_equals_brute_force(spark, docs, messy):
    rows = [*enumerate(TEXTS)]
    found = {r.doc_id: r for r in licenses.digest(licenses.scan(frame(spark, rows))).collect()}
    for i, text in rows:
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert found[0].labels == "cc-by,cc-by-nc" and found[7].labels == "apache-2.0" and found[8].labels == "mit"
    assert found[9].labels == "bsd-3-clause,mit" and found[9].score == 0.1
    assert found[10].score == licenses.BURDEN["gpl"] / 2 and found[11].labels == "" and found[4].score == 0
    many = licenses.digest(licenses.scan(docs)).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in many) == sorted((str(d), brute(t)[0]) for d, t in messy)


def test_empty_table(no_docs):
    assert licenses.digest(licenses.scan(no_docs)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["cc", "by", "nc", "CC", "-", ".", "all", "rights", "reserved", "é", "general", "public", "license", "\n"]), max_size=25), st.sampled_from([" ", "", "-"]))
def test_scan_equals_brute_force(parts, between):
    text = between.join(parts)
    n, matches, _ = licenses.Scanner(licenses.BASE, {}).scan(text)
    starts = [m["start_word"] for m in matches]
    assert (n, len(matches), min(starts, default=None), max(starts, default=None), ",".join(sorted({m["label"] for m in matches}))) == brute(text)


def test_expressions():
    def of(text):
        return licenses.evaluate(licenses.expression_tokens(text))

    assert of("MIT") == (["mit"], 0.1)
    assert of(" GPL-2.0 OR MIT AND CC0-1.0") == (["cc0-1.0", "mit"], 0.1)
    assert of("(GPL-2.0 OR MIT) AND AGPL-3.0 trailing words") == (["agpl-3.0", "mit"], 0.8)
    assert of("LGPL-2.1 WITH some-exception OR Proprietary") == (["lgpl-2.1"], 0.25)
    assert licenses.expression_tokens("MIT OR") == ["mit"] and licenses.expression_tokens("(MIT") == [] and licenses.expression_tokens("") == []
    assert licenses.to_postfix(["a", "or", "b", "and", "c", "with", "d"]) == ["a", "b", "c", "d", "with", "and", "or"]
