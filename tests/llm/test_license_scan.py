import re
from itertools import product
from re import _constants as sre, _parser

import pytest

from millrace.llm.license_scan import BASE_PHRASES, build_rules, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in BASE_PHRASES.items() for p in [phrase.split()]
              for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


def test_base_matches_plain_version(documents, odd_documents):
    for docs in (documents.select("doc_id", "text"), odd_documents):
        for r in scan_licenses(docs).collect():
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(r["text"])
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
            assert (r.score > 0) == bool(r.labels)


def test_hundreds_of_rules_in_order():
    rules = build_rules()
    assert len(rules) > 300 and [r["priority"] for r in rules] == sorted(r["priority"] for r in rules)


@pytest.mark.parametrize(("text", "labels"), [
    ("Licensed under the Apache License, Version 2.0 (the License)", "apache-2.0"),
    ("SPDX-License-Identifier: MPL-2.0", "mpl-2.0"),
    ("GNU General Public License version 3 or later", "gpl,gpl-3.0-or-later"),
    ("GNU Lesser General Public License v2.1", "gpl,lgpl-2.1"),
    ("CC BY-SA 4.0 and the MIT License", "cc-by,cc-by-sa-4.0,mit"),
    ("Er kam mit einer Lizenz", ""),
    ("cc by cc by", "cc-by"),
    ("This is in the public domain? This work is in the public domain!", "public-domain"),
    ("émit license", ""),
])
def test_labels(spark, text, labels):
    assert scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().labels == labels


def test_contained_detections_are_suppressed(spark):
    text = "released under the terms of the Apache License, Version 2.0 / Apache License"
    found = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().licenses
    assert [(x.first, x.end, x.label) for x in found] == [(0, 11, "apache-2.0"), (11, 13, "apache")]


def test_clashing_columns_and_empty_table(odd_documents, no_documents):
    out = scan_licenses(odd_documents)
    assert out.columns.count("labels") == 1 and out.count() == 12
    assert scan_licenses(no_documents).count() == 0


def test_filters_do_not_repeat_the_work(documents):
    found = scan_licenses(documents).filter("score > 0")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate") and found.count() >= 0


def alternatives(parsed):
    """Texts of every alternative of an expression; what may be missing is left out, single characters also kept."""
    choices = []
    for op, arg in parsed:
        if op is sre.LITERAL:
            choices.append([chr(arg)])
        elif op is sre.IN:
            choices.append(["x"] if arg[0][0] is sre.NEGATE else [chr(c) for _, c in arg])
        elif op is sre.NOT_LITERAL:
            choices.append(["x"])
        elif op is sre.BRANCH:
            choices.append([t for branch in arg[1] for t in alternatives(branch)])
        elif op is sre.SUBPATTERN:
            choices.append(alternatives(arg[3]))
        else:
            assert op is sre.MAX_REPEAT, op
            least, _, inner = arg
            one = alternatives(inner)
            choices.append([t * least for t in one] if least else ["", *[t for t in one if len(t) == 1]])
    return ["".join(c) for c in product(*choices)]


def test_gate_opens_on_every_alternative():
    closed = set()
    rules = build_rules()
    by_pattern = {}
    for r in rules:
        by_pattern.setdefault((r["label"], r["pattern"]), []).append(r)
    for (label, pattern), same in by_pattern.items():
        for text in alternatives(_parser.parse(pattern)):
            words = set(text.split())
            assert re.fullmatch(pattern, text)
            if not any(r["keyword"] in words and (not r["partners"] or words & set(r["partners"])) for r in same):
                closed.add((label, text))
    assert not closed


@pytest.mark.parametrize(("text", "labels", "n"), [
    ("for noncommercial use only", "non-commercial", 1),
    ("for noncommercial use only. Not commercial.", "non-commercial", 1),
    ("Universal Permissive License 1.0 (UPL 1.0)", "upl-1.0", 2),
    ("PSF License", "psf", 1),
    ("ASL 2.0", "apache-2.0", 1),
    ("BSL 1.0", "boost-1.0", 1),
    ("GPLv3, LGPLv2.1 or Apache2", "apache-2.0,gpl-3.0,lgpl-2.1", 3),
    ("GPL and GPLv3", "gpl-3.0", 1),
    ("creative commons zero", "cc0-1.0", 1),
    ("Expat licence", "mit", 1),
    ("MS-PL or Ms-RL", "ms-pl,ms-rl", 2),
    ("BSD-2-Clause, BSD 3", "bsd-2-clause,bsd-3-clause", 2),
    ("BSD 3-Clause License", "bsd-3-clause", 1),
    ("The expat parser on BSD 4.3 with zlib", "", 0),
])
def test_short_forms_and_alternatives(spark, text, labels, n):
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.labels, len(row.licenses)) == (labels, n)
