from __future__ import annotations

import re

import pytest

from partyard.llm.licenses import BASE, parse_expression, read_expression, scan_licenses


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [(i, label) for p, label in BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in found]
    return (
        len(words),
        len(found),
        min(starts) if starts else None,
        max(starts) if starts else None,
        ",".join(sorted({label for _, label in found})),
    )


TEXTS = [
    "MIT License and the Apache-License; GNU General Public License, MIT license mit license",
    "summit license, mit licenses, MitKLicense",
    "kéy MIT\nLICENSE é general public  license",
    "no licence here",
]


def test_base_counts(spark, odd_docs):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs = docs.unionByName(odd_docs.select("doc_id", "text"))
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    expected = sorted((str(i), *map(str, brute(t))) for i, t in texts)
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    got = {tuple(str(r[c]) for c in columns) for r in scan_licenses(docs).collect()}
    assert sorted(got) == sorted(set(expected))


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("MIT", [["mit"]]),
        ("MIT OR Apache-2.0 AND BSD-2-Clause", [["apache-2.0", "bsd-2-clause"], ["mit"]]),
        ("(MIT OR Apache-2.0) AND ISC", [["apache-2.0", "isc"], ["isc", "mit"]]),
        ("GPL-2.0+ WITH Classpath-exception-2.0 OR MIT", [["gpl-2.0+ with classpath-exception-2.0"], ["mit"]]),
        ("MIT OR", [["mit"]]),
        ("(MIT OR (ISC", [["isc"], ["mit"]]),
        ("MIT and more words", [["mit", "more"]]),
        ("OR MIT", []),
        ("", []),
    ],
)
def test_expressions(text, expected):
    assert sorted(sorted(a) for a in parse_expression(text.encode())) == expected


def test_tags_add_labels(spark):
    text = "// SPDX-License-Identifier: MIT OR (Apache-2.0 WITH LLVM-exception)\nThe MIT License."
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == "apache-2.0 with llvm-exception,mit"
    assert row.base_labels == "mit" and 0.95 < row.score < 1


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a SPDX-License-Identifier: MIT b SPDX-License-Identifier: ISC OR 0BSD c", "mit | 0bsd OR isc"),
        ("SPDX-License-Identifier: MIT SPDX-License-Identifier: ISC", "mit | isc"),
        ("# SPDX-License-Identifier: (MIT OR\n#   ISC) AND 0BSD\nand more", "0bsd AND isc | 0bsd AND mit"),
        ("// SPDX-License-\n// Identifier: MIT\nor so", "mit"),
        ("SPDX-License-Identifier:\r\nMIT\r\nISC", "mit"),
        ("-- SPDX-License-Identifier: (MIT\n-- AND ISC)\n", "isc AND mit"),
        ("é SPDX-License-Identifier: MIT é", "mit"),
    ],
)
def test_every_tag_is_read(spark, text, expected):
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    found = [" | ".join(sorted(x.split(" OR ")) if " AND " in x else [x]) for x in row.expressions]
    assert " | ".join(found) == expected
    assert row.score > 0.94


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("The license expression must be reviewed", []),
        ("SPDX-License-Identifier: see below", []),
        ("the SPDX license identifier is in every file", []),
        ("the SPDX license identifier MIT has", []),
        ("SPDX-License-Identifier: NONE", []),
        ("SPDX-License-Identifier: MIT and see the file", ["mit"]),
        ("SPDX-License-Identifier: LicenseRef-Own-terms OR Zlib", ["licenseref-own-terms OR zlib"]),
        ("license_expression = 'BSD-3-Clause'", ["bsd-3-clause"]),
        ("SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0", ["gpl-2.0-or-later with classpath-exception-2.0"]),
        ("SPDX-License-Identifier: EUPL-1.2+ AND Unlicense.", ["eupl-1.2+ AND unlicense"]),
    ],
)
def test_only_licence_names_count(spark, text, expected):
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.expressions == expected
    assert row.score == (pytest.approx(0.95, abs=0.05) if expected else 0)


def test_large_expressions_keep_their_alternatives(spark):
    pairs = [f"(a{i} OR b{i})" for i in range(13)]
    text = f"SPDX-License-Identifier: {' AND '.join(pairs)}"
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.expressions == [" AND ".join(pairs)]
    assert set(row.labels.split(",")) == {f"{k}{i}" for k in "ab" for i in range(13)}
    many = [f"l{i}" for i in range(5000)]
    assert read_expression(" OR ".join(many).encode()).text() == " OR ".join(many)
    deep = "(" * 50_000 + "MIT" + ")" * 50_000
    assert read_expression(deep.encode()).text() == "mit"
    mixed = read_expression(b"((a OR b) AND (c OR d) OR e) WITH x", limit=2)
    assert mixed.text() == "((a OR b) AND (c OR d) OR e) with x"
    assert mixed.licences == {"((a OR b) AND (c OR d) OR e) with x"}


def test_many_matches_stay_linear(spark):
    row = scan_licenses(spark.createDataFrame([(1, "mit license " * 200_000)], "doc_id long, text string")).first()
    assert (row.n_base, row.first_word, row.last_word) == (200_000, 0, 399_998)


def test_empty_and_clashing(no_docs, clashing_docs, odd_docs):
    assert scan_licenses(no_docs).count() == 0
    assert scan_licenses(clashing_docs).count() == odd_docs.count()
