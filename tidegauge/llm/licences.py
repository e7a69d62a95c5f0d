"""Licence scan by canonical digests, in DataFrame functions only.

A text is brought to a canonical form: lower case, copyright lines removed, equivalent
spellings made one, punctuation and white space made single spaces. Known licence texts
and notices go through the same expressions; a digest of the whole canonical text is
the key of a hash join. The same is done for every line, so that a notice inside a
document is found by its own whole text; a match is always of an entire text or line.

The known texts are fixed: short ones are here, long ones in ``licence_texts``, read by
the driver. They are ``KNOWN_MOST`` rows at most, and their digests are broadcast.
"""

from __future__ import annotations

from itertools import product
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.frames import let
from tidegauge.sources.workspace import Scratch

#: Bound of the broadcast table of known texts.
KNOWN_MOST = 2_000

# Names by which notices call a licence, and its SPDX identifier.
NAMES = (
    ("Apache-2.0", ("the Apache License, Version 2.0", "the Apache License 2.0", "Apache-2.0", "Apache 2.0")),
    ("MIT", ("the MIT License", "MIT")),
    ("ISC", ("the ISC License", "ISC")),
    ("BSD-2-Clause", ("the BSD 2-Clause License", "BSD-2-Clause")),
    ("BSD-3-Clause", ("the BSD 3-Clause License", "BSD-3-Clause")),
    ("GPL-2.0-only", ("the GNU General Public License, version 2", "GPL-2.0", "GPLv2")),
    ("GPL-3.0-only", ("the GNU General Public License, version 3", "GPL-3.0", "GPLv3")),
    ("LGPL-2.1-only", ("the GNU Lesser General Public License, version 2.1", "LGPL-2.1")),
    ("LGPL-3.0-only", ("the GNU Lesser General Public License, version 3", "LGPL-3.0")),
    ("AGPL-3.0-only", ("the GNU Affero General Public License, version 3", "AGPL-3.0")),
    ("MPL-2.0", ("the Mozilla Public License, version 2.0", "MPL-2.0")),
    ("CC0-1.0", ("CC0 1.0", "CC0-1.0")),
    ("CC-BY-4.0", ("CC BY 4.0", "the Creative Commons Attribution 4.0 International License")),
    ("CC-BY-SA-4.0", ("CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 International License")),
    ("CC-BY-NC-4.0", ("CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 International License")),
    ("CC-BY-ND-4.0", ("CC BY-ND 4.0", "the Creative Commons Attribution-NoDerivatives 4.0 International License")),
)
NOTICES = (
    "Licensed under {}.",
    "Released under {}.",
    "Distributed under {}.",
    "Available under {}.",
    "This work is licensed under {}.",
    "This program is licensed under {}.",
    "This software is released under {}.",
    "SPDX-License-Identifier: {}",
)

# The wording of short licences.
NO_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING'
    " ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,"
    " DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR"
    " PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION"
    " WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
MIT_TEXT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
    " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
    " and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions"
    " of the Software.\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO'
    " THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE"
    " AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF"
    " CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
    " DEALINGS IN THE SOFTWARE."
)
ISC_TEXT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
)
ZERO_BSD_TEXT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted.\n"
)
TEXTS = (
    ("MIT", MIT_TEXT),
    ("MIT", "MIT License\n" + MIT_TEXT),
    ("MIT", "The MIT License (MIT)\n" + MIT_TEXT),
    ("ISC", ISC_TEXT + NO_WARRANTY),
    ("ISC", "ISC License\n" + ISC_TEXT + NO_WARRANTY),
    ("0BSD", ZERO_BSD_TEXT + NO_WARRANTY),
    ("0BSD", "Zero-Clause BSD\n" + ZERO_BSD_TEXT + NO_WARRANTY),
)

#: Entire texts, one file for each identifier.
LONG_TEXTS = Path(__file__).with_name("licence_texts")
LONG = ("Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0")
END = "END OF TERMS AND CONDITIONS"
#: Headers that a long text asks for: its identifier, what comes before and after, the header's identifier.
HEADERS = (
    ("Apache-2.0", "[name of copyright owner]\n", None, "Apache-2.0"),
    ("GPL-2.0-only", "<name of author>\n", "\nAlso add information", "GPL-2.0-or-later"),
    ("GPL-3.0-only", "<name of author>\n", "\nAlso add information", "GPL-3.0-or-later"),
    ("LGPL-2.1-only", "<name of author>\n", "\nAlso add information", "LGPL-2.1-or-later"),
)
THIRD_CLAUSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission.\n"
)

# Spellings that mean the same: a text that must be there, a pattern and
# what it becomes. They see lower case, with single spaces for punctuation.
SPELLINGS = (
    ("licence", r"\b(sub)?licence(d|s)?\b", "$1license$2"),
    ("copyright owner", r"\bcopyright owner", "copyright holder"),
    ("non commercial", r"\bnon commercial\b", "noncommercial"),
    ("non infringement", r"\bnon infringement\b", "noninfringement"),
    ("share alike", r"\bshare alike\b", "sharealike"),
    ("no derivatives", r"\bno derivatives\b", "noderivatives"),
    ("version ", r"\bversion (\d)", "v$1"),
    ("v ", r"\bv (\d)", "v$1"),
    ("https", r"\bhttps\b", "http"),
    ("and or", r"\band or\b", "and"),
)
COPYRIGHT_LINE = r"(?m)^[^\w\n]*(?:copyright|\(c\)|©)[^\n]*(?:\d{4}|\(c\)|©)[^\n]*$"
RIGHTS_LINE = r"(?m)^[^\w\n]*all rights reserved[^\w\n]*$"


def _replaced(text: Column, needed: tuple[str, ...], pattern: str, one: str) -> Column:
    """A replacement that costs a plain search where its texts are absent."""

    def replace(value: Column) -> Column:
        there = F.contains(value, F.lit(needed[0]))
        for other in needed[1:]:
            there = there | F.contains(value, F.lit(other))
        return F.when(there, F.regexp_replace(value, pattern, one)).otherwise(value)

    return let(text, replace)


def _spelled(text: Column) -> Column:
    for needed, pattern, one in SPELLINGS:
        text = _replaced(text, (needed,), pattern, one)
    return text


def _digest(form: Column) -> Column:
    return F.when(form != "", F.sha2(form, 256))


def canonical(text: Column) -> Column:
    """``lines``, the canonical lines of a text, and ``whole``, all of it as one."""
    plain = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    plain = _replaced(plain, ("copyright", "(c)", "©"), COPYRIGHT_LINE, "")
    plain = _replaced(plain, ("all rights reserved",), RIGHTS_LINE, "")
    plain = F.regexp_replace(plain, r"[^\p{L}\p{N}\n]+", " ")

    def forms(value: Column) -> Column:
        lines = F.transform(F.split(_spelled(value), "\n"), lambda line: F.trim(line))
        whole = _spelled(F.trim(F.regexp_replace(value, r"[ \n]+", " ")))
        return F.struct(lines.alias("lines"), whole.alias("whole"))

    return let(plain, forms)


def _long_text(name: str) -> str:
    return (LONG_TEXTS / f"{name}.txt").read_text(encoding="utf-8")


def long_texts() -> list[tuple[str, str]]:
    """Texts of many lines, with and without what follows their terms, and the headers they ask for."""
    found = []
    for name in LONG:
        text = _long_text(name)
        terms, end, _ = text.partition(END)
        found += [(name, form) for form in dict.fromkeys((text, terms + end, terms))]
    for name, before, after, licence in HEADERS:
        header = _long_text(name).partition(before)[2]
        found.append((licence, header.partition(after)[0] if after else header))
    return found


def bsd_texts() -> list[tuple[str, str]]:
    """The BSD licences, with and without heading and numbers, for one holder or several."""
    body = _long_text("BSD-2-Clause").partition("\n")[2]
    found = []
    for clauses, numbered, several in product((2, 3), (True, False), (True, False)):
        text = body
        if clauses == 3:
            text = text.replace("THIS SOFTWARE IS PROVIDED", f"3. {THIRD_CLAUSE}\nTHIS SOFTWARE IS PROVIDED")
        for i in () if numbered else (1, 2, 3):
            text = text.replace(f"{i}. ", "* ")
        if several:
            text = text.replace("THE COPYRIGHT HOLDER OR", "THE COPYRIGHT HOLDERS OR")
        for heading in ("", f"BSD {clauses}-Clause License\n", f"The BSD {clauses}-Clause License\n"):
            found.append((f"BSD-{clauses}-Clause", heading + text))
    return found


def known_texts() -> list[tuple[str, str]]:
    """Identifier and wording of all known texts: entire ones, and notices by rule."""
    notices = [(spdx, notice.format(name)) for spdx, names in NAMES for name in names for notice in NOTICES]
    return [*TEXTS, *long_texts(), *bsd_texts(), *notices]


def known_digests(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """``digest, size, licence``, one row per digest; of two licences the first by name."""
    if len(texts) > KNOWN_MOST:
        raise ValueError(f"{len(texts)} known texts; at most {KNOWN_MOST} are broadcast")
    rows = F.array(*(F.struct(F.lit(name).alias("licence"), F.lit(words).alias("wording")) for name, words in texts))
    named = spark.range(1).select(F.inline(rows)) if texts else spark.range(0).selectExpr("'' licence", "'' wording")
    return (
        named.select("licence", canonical(F.col("wording"))["whole"].alias("whole"))
        .groupBy(_digest(F.col("whole")).alias("digest"), F.length("whole").alias("size"))
        .agg(F.min("licence").alias("licence"))
        .where("digest is not null")
    )


def scan(docs: DataFrame, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """Licences of each document, one row per row of ``docs``.

    ``doc_id``; ``licence``, if the entire text is a known one; ``notices``, the
    licences of its lines that are entire known texts, distinct, sorted and joined by
    commas, null if none; ``n_notices``, the number of such lines. A null text has no
    lines, and a text or line that is empty in canonical form matches nothing. Rows
    that repeat each give a row. Other columns are ignored. ``texts`` are pairs of
    identifier and wording to look for instead of those known here.
    """
    scratch = Scratch(docs.sparkSession, "licences")
    known = scratch.table(known_digests(docs.sparkSession, known_texts() if texts is None else texts), "known")
    # as many sizes as known texts at most
    sizes = [row[0] for row in known.select("size").distinct().orderBy("size").collect()] or [-1]
    fits = F.array(*(F.lit(size) for size in sizes))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    likely = F.filter("lines", lambda line: F.array_contains(fits, F.length(line)))
    rows = scratch.table(
        own.select("doc_id", canonical(F.col("text")).alias("form"))
        .select("doc_id", "form.whole", "form.lines")
        .select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.when(F.array_contains(fits, F.length("whole")), _digest(F.col("whole"))).alias("digest"),
            F.transform(likely, _digest).alias("lines"),
        ),
        "rows",
    )
    few = F.broadcast(known.drop("size"))
    notices = (
        rows.select("row", F.explode("lines").alias("digest"))
        .join(few, "digest")
        .groupBy("row")
        .agg(
            F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("notices"),
            F.count("*").alias("n_notices"),
        )
    )
    return (
        rows.join(few, "digest", "left")
        .join(notices, "row", "left")
        .select("doc_id", "licence", "notices", F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"))
    )
