import re

import duckdb
import pandas as pd

from jatoba.llm import licenses
from tests.llm.frames import AWKWARD, documents, with_clashing_columns

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""
CASES = [
    ("Some prose.\nReleased under the MIT License.\nMore prose.", "MIT", ""),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", ""),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0", ""),
    ("LICENSED  under the\n\tApache License, Version 2.0.", "Apache-2.0", ""),
    (MIT, "MIT", ""),
    (APACHE, "Apache-2.0", ""),
    ("// SPDX-License-Identifier: BSD-3-Clause\nint x;", "BSD-3-Clause", ""),
    ("License: GPLv3\n\nLicensed under the MIT License. Licensed under GPLv3.", "GPL-3.0,MIT", ""),
    ("you may not use this file except in compliance with the License.", "", "ApacheComply"),
    ('Licensed under the Apache License, Version 2.0 (the "License"); something else. you may not use this file except in compliance with the License.', "", "ApacheUnder,ApacheComply"),
    ("A heading\nReleased under the MIT License\nmore", "MIT", ""),
    ("He was licensed under the bridge. A free software talk.", "", ""),
    ("All rights reserved.", "", "AllRights"),
]


def test_cases(spark):
    rows = [(i, c[0]) for i, c in enumerate(CASES)] + AWKWARD
    found = licenses.recognise(with_clashing_columns(documents(spark, rows))).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for i, (text, licences, rest) in enumerate(CASES):
        assert (by_id[i].licenses, by_id[i].sentence_ids) == (licences, rest), text
        assert by_id[i].n_licenses == len([x for x in licences.split(",") if x])
    assert all((r.licenses, r.sentence_ids, r.n_licenses) == ("", "", 0) for r in found if r.doc_id is None or r.doc_id >= 900)
    assert licenses.recognise(documents(spark, [])).collect() == []


def test_equals_its_sql(spark):
    rows = [(i, c[0]) for i, c in enumerate(CASES)] + AWKWARD
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    want = sorted(map(repr, con.sql(licenses.SQL).fetchall()))
    assert sorted(repr(tuple(r)) for r in licenses.recognise(documents(spark, rows)).collect()) == want


def test_every_known_sentence_has_a_cue_and_every_rule_known_sentences():
    known = licenses.known_sentences()
    cue = re.compile(licenses.CUES)
    texts = [t for ts in licenses.SENTENCES.values() for t in ts]
    loose = [t for t in texts if not cue.search(t)]
    assert loose == []
    assert all(cue.search(form + name) for form in licenses.FORMS for name in ["x"] if "icense" in form)
    for _, steps in licenses.RULES:
        assert all(s in known.values() for s in steps)


def test_plan_is_native(spark):
    plan = licenses.recognise(documents(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "UDF" not in plan and "Exchange" not in plan


def test_no_known_sentence_is_skipped(spark):
    """In normal form, and with its words on different lines or apart by other marks."""
    known = list(licenses.known_sentences())
    cue = re.compile(licenses.CUES)
    assert [s for s in known if not (cue.search(s) and cue.search(s.replace(" ", "\n")) and cue.search(s.replace(" ", "_ -")))] == []
    texts = ["Released under GPLv3.", "Released under MIT.", "Distributed under the terms of Apache-2.0.", "Available under CC BY 4.0.",
             "Published under CC0 1.0.", "All rights\nreserved.", "This is free and unencumbered software released into the public\ndomain."]
    rows = list(enumerate(texts))
    found = licenses.recognise(documents(spark, rows)).orderBy("doc_id").collect()
    assert [r.licenses or r.sentence_ids for r in found] == ["GPL-3.0", "MIT", "Apache-2.0", "CC-BY-4.0", "CC0-1.0", "AllRights", "Unlicense"]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    assert sorted(map(tuple, found)) == sorted(con.sql(licenses.SQL).fetchall())
