import duckdb
import re

from tessera.llm.licenses import REACH, rules, scan_licenses, scan_sql

TEXTS = [
    None, "", "no licence here at all", "All Rights Reserved.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
    "cc by cc by all rights reserved general public license", "CC BY", "xcc by ccby", "Released under the MIT License. Licensed under the Apache License, Version 2.0, or the MIT license",
    "SPDX-License-Identifier: GPL-2.0", "apache apache license", "Ünïcode cc by cc by", "licensed under creative commons attribution share alike 4.0 international",
    "word " * 300 + "gnu general public license v2 " * 200,
]


def test_scan_equals_sql_over_places_and_pairs(spark):
    rows = [(i, x) for i, x in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[4])]
    found = scan_licenses(spark.createDataFrame([(*x, "clash") for x in rows], "doc_id long, text string, labels string"))
    assert found.columns == ["doc_id", "text", "n_words", "n_base", "first_word", "last_word", "base_labels", "places", "labels", "score"]
    ours = sorted(map(repr, (tuple(r) for r in found.drop("text", "places").collect())))
    base = duckdb.connect()
    base.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    base.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert ours == sorted(map(repr, base.execute(scan_sql()).fetchall()))


def test_suppression_and_empty_tables(spark):
    row = scan_licenses(spark.createDataFrame([(1, "licensed under the apache license version 2 0")], "doc_id long, text string")).first()
    assert row["labels"] == "apache-2.0" and len(row["places"]) == 1 and row["score"] == 1.0
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rules_begin_with_their_keyword_and_fit_the_window():
    assert len(rules()) > 300
    for _, word, pattern, _, priority in rules():
        assert re.fullmatch(r"[a-z0-9]+", word) and priority in (1, 2, 3, 4)
        assert len(re.sub(r"\(\?[=:]|[()?|\[\]]", " ", pattern).split()) <= 2 * REACH


def test_names_that_begin_with_common_words_and_short_identifiers(spark):
    want = {
        "Common Development and Distribution License": "cddl-1.0", "an Open Database License here": "odbl-1.0", "the Modified BSD License": "bsd-3-clause", "a New BSD License": "bsd-3-clause",
        "Original BSD License": "bsd-4-clause", "the 3-clause BSD license": "bsd-3-clause", "a BSD license": "bsd", "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
        "SPDX-License-Identifier: ISC": "isc", "SPDX-License-Identifier: EPL-2.0": "epl-2.0", "SPDX-License-Identifier: Zlib": "zlib", "SPDX-License-Identifier: OFL-1.1": "ofl-1.1",
        "license: Apache-2.0": "apache-2.0", "a new and open common 3": "",
    }
    rows = list(enumerate(want))
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["text"]: r["labels"] for r in found.collect()} == want
    base = duckdb.connect()
    base.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    base.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(map(repr, (tuple(r) for r in found.drop("text", "places").collect()))) == sorted(map(repr, base.execute(scan_sql()).fetchall()))
