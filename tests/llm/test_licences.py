"""Licence scan: canonical forms and whole-text matches."""

from tidegauge.llm import licences

SCHEMA = "doc_id long, text string"


def test_variants_of_known_texts(spark):
    mit = licences.MIT_TEXT
    rows = [
        (1, "Copyright (c) 2020 Some One\n\n" + mit.upper()),
        (2, mit.replace(" ", "\n ").replace("sublicense", "sublicence").replace('"', "“")),
        (3, "The MIT License (MIT)\n\n© 2019, 2021 A\nAll rights reserved.\n" + mit),
        (4, mit + " One more word."),
        (5, "intro\nThis work is LICENCED under the  GNU General Public License (version 3)\nLicensed under CC BY-NC 4.0.\nend"),
        (6, "Released under the MIT License.\nReleased under the MIT License!"),
        (7, None), (8, ""), (9, "...\n"), (None, "Licensed under the Apache License, Version 2.0."),
        (10, "licensed under the apache licence v2.0"), (10, "MIT"), (11, "x " * 50000),
    ]
    docs = spark.createDataFrame([(*row, "clash") for row in rows], SCHEMA + ", licence string")
    got = [(row.doc_id, row.licence, row.notices, row.n_notices) for row in licences.scan(docs).collect()]
    expected = [
        (1, "MIT", None, 0), (2, "MIT", None, 0), (3, "MIT", None, 0), (4, None, None, 0),
        (5, None, "CC-BY-NC-4.0,GPL-3.0-only", 2), (6, None, "MIT", 2), (7, None, None, 0), (8, None, None, 0),
        (9, None, None, 0), (None, "Apache-2.0", "Apache-2.0", 1), (10, "Apache-2.0", "Apache-2.0", 1),
        (10, None, None, 0), (11, None, None, 0),
    ]
    key = lambda row: tuple(map(str, row))
    # a text of one line is known as a whole and as a line
    assert sorted(((d, w, n, k) for d, w, n, k in got if d not in (1, 2, 3)), key=key) == sorted(
        (row for row in expected if row[0] not in (1, 2, 3)), key=key
    )
    assert {(d, w) for d, w, _, _ in got if d in (1, 2, 3)} == {(1, "MIT"), (2, "MIT"), (3, "MIT")}


def test_long_texts(spark):
    texts = {name: (licences.LONG_TEXTS / f"{name}.txt").read_text() for name in (*licences.LONG, "BSD-2-Clause")}
    rows = [(name, text) for name, text in texts.items()]
    rows += [(name, "\n\n" + text.replace(" ", "  ").upper()) for name, text in texts.items()]
    rows += [(None, text.replace(" not ", " ")) for text in texts.values() if " not " in text]
    bsd = texts["BSD-2-Clause"].partition("\n")[2]
    rows.append(("BSD-2-Clause", "BSD 2-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n" + bsd.replace(", ", ",\n")))
    rows.append(("BSD-3-Clause", "Copyright 2021 A\n" + bsd.replace("THIS SOFTWARE IS", "3. " + licences.THIRD_CLAUSE + "\nTHIS SOFTWARE IS")))
    rows.append(("Apache-2.0", texts["Apache-2.0"].partition("END OF TERMS")[0]))
    rows.append(("Apache-2.0", "Copyright 2020 A\n" + texts["Apache-2.0"].partition("[name of copyright owner]")[2]))
    header = texts["GPL-3.0-only"].partition("<name of author>\n")[2].partition("\nAlso add")[0]
    rows.append(("GPL-3.0-or-later", "Copyright (C) 2020 A\n" + header))
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], SCHEMA)
    got = {row.doc_id: row.licence for row in licences.scan(docs).collect()}
    assert got == {i: name for i, (name, _) in enumerate(rows)}


def test_own_texts(spark):
    docs = spark.createDataFrame([(1, "Do, as You  like!"), (2, "do as you like, but")], SCHEMA)
    got = licences.scan(docs, [("FREE", "do as you like")]).orderBy("doc_id").collect()
    assert [row.licence for row in got] == ["FREE", None]
    assert [row.licence for row in licences.scan(docs, []).collect()] == [None, None]


def test_empty(spark):
    assert licences.scan(spark.createDataFrame([], SCHEMA)).collect() == []
