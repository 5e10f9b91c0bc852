import pytest

from varloom.llm import licenses

GPL = """/* This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details. */"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
MIT = ". ".join(licenses.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-as-is", "mit-liability"))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Some words.\nLicensed under the Apache License, Version 2.0.", {"Apache-2.0": 1}),
        ("no end of sentence\nReleased under the MIT License.\nAnd more", {"MIT": 1}),
        ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0": 1}),
        ("LICENSED UNDER CC BY-NC 4.0! Licensed under CC BY 4.0", {"CC-BY-NC-4.0": 1, "CC-BY-4.0": 1}),
        ("x. Released under\nthe MIT License. y. Licensed under MIT.", {"MIT": 2}),
        (GPL, {"GPL-3.0-or-later": 1}),
        (MIT, {"MIT": 1}),
        ("# SPDX-License-Identifier: MPL-2.0\ncode", {"MPL-2.0": 1}),
        ("SPDX-License-Identifier: GPL-3.0-or-later", {"GPL-3.0-or-later": 1}),
        ("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND LGPL-2.1-only\nx", {"MIT": 1, "Apache-2.0": 1, "LGPL-2.1": 1}),
        ("SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0", {"GPL-2.0-or-later": 1}),
        ("SPDX-License-Identifier: Zlib\n" + "a line\n" * 50 + "MIT", {"Zlib": 1}),
        ("SPDX-License-Identifier: no such name\nMIT", {}),
        ("SPDX-License-Identifier:", {}),
        (LGPL, {"LGPL-2.1-or-later": 1}),
        (LGPL.replace("Lesser", "Affero").replace("2.1", "3").replace("library", "program"), {"AGPL-3.0-or-later": 1}),
        (MIT.replace("The above", "one\ntwo\nthree\nThe above"), {"MIT": 1}),
        (MIT.replace("The above", "one\ntwo\nthree\nfour\nThe above"), {}),
        ("word " * 400_000 + "\nLicensed under MIT.", {"MIT": 1}),
        ("MIT\nApache 2.0 License", {}),
        ("We licensed under the table a thing.", {}),
        ("Licensed under the Apache License, Version 2.0 without more", {}),
        ("", {}),
        (None, {}),
    ],
)
def test_texts(spark, text, want):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert {r.license: r.matches for r in licenses.scan(df).collect()} == want


def test_a_longer_rule_takes_its_sentences_from_shorter_ones(spark):
    text = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. Licensed under MIT.'
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert {r.license: r.matches for r in licenses.scan(df).collect()} == {"Apache-2.0": 1, "MIT": 1}


def test_every_known_sentence_has_an_anchor_or_needs_a_tag():
    for sentence, name in licenses.known().items():
        if sentence.startswith("tag:"):
            assert name.startswith("name:")
            continue
        assert any(a in sentence for a in licenses.ANCHORS), sentence
        assert sentence == licenses.plain(sentence)
    assert any(a in licenses.TAG.lower() for a in licenses.ANCHORS)


def test_repeats_null_keys_clashing_names_and_no_rows(spark):
    rows = [(None, "Licensed under MIT.", 1), (2, "Licensed under MIT. Licensed under MIT.", 2), (2, "Licensed under MIT.", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license int").withColumn("row", df_col())
    assert {(r.doc_id, r.license, r.matches) for r in licenses.scan(df).collect()} == {(None, "MIT", 1), (2, "MIT", 2)}
    assert licenses.scan(df.limit(0)).collect() == []


def df_col():
    from pyspark.sql import functions as F

    return F.lit("x")


def test_no_python_runs_on_executors(spark):
    from conftest import plan_of

    df = spark.range(1).selectExpr("id AS doc_id", "'Licensed under MIT.' AS text")
    plan = plan_of(licenses.scan(df))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
