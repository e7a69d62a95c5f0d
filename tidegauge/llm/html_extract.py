"""HTML extraction by nearest-URL page differencing.

Pages of a host are put in the order of their URL paths, and each is compared with the
page before and the page after it. All visible lines of the two, menus, headers and
footers included, are aligned by a longest common subsequence; aligned lines are the
site's and not the page's. Of the neighbours that a page shares lines of text with, or
else of both, the one whose path agrees longest counts.

Differencing decides about all lines except those of an article that are not mostly
links: a passage that two articles quote is part of both. For the same reason two pages
that share more than half of the characters of their text count as copies of one page,
and are no neighbours.

What differencing can't tell, as adverts differ from page to page and some pages have no
neighbour, HTML or class names do: lines that they mark as menus, headers, adverts and
the like go in any case, and so do lines outside of a page's article or main element.
The other lines are the page's text here.

Only hashes of lines are sorted and aligned. Pages are taken apart twice, as texts are
shuffled only once that way, to the lines that go.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.html_blocks import lines_of
from tidegauge.llm.tokens import list_array, pieces, signed
from tidegauge.sources.workspace import Scratch

#: Pages that share more than this part of the shorter one's characters are copies.
COPY_SHARE = 0.5
#: Lines of an article stay. Open ones stay if differencing lets them. The site's are no
#: text, whether differencing finds them or only their marks tell.
OWN, OPEN, SITE = range(3)


def _lengths(a: np.ndarray, masks: dict, width: int) -> np.ndarray:
    """For each prefix of the other list, the length of its common subsequence with ``a``."""
    full = (1 << width) - 1
    row = full
    for value in a.tolist():
        hit = row & masks.get(value, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes((width + 7) // 8, "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits[:width].astype(np.int64))])


def _masks(b: np.ndarray) -> dict:
    masks: dict[int, int] = {}
    for i, value in enumerate(b.tolist()):
        masks[value] = masks.get(value, 0) | (1 << i)
    return masks


def common_lines(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of one longest common subsequence.

    Lines that only one of them has are left out first. The rest is halved again and
    again, so memory stays linear in the number of lines; lengths come from one machine
    word per 64 lines.
    """
    in_a, in_b = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    found: list[tuple[int, int]] = []
    work = [(0, len(in_a), 0, len(in_b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[in_a[a0]] == b[in_b[b0]]:
            found.append((in_a[a0], in_b[b0]))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[in_a[a1 - 1]] == b[in_b[b1 - 1]]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((in_a[a1], in_b[b1]))
        if a0 == a1 or b0 == b1:
            continue
        left, right = a[in_a[a0:a1]], b[in_b[b0:b1]]
        if len(left) == 1:
            same = np.flatnonzero(right == left[0])
            if len(same):
                found.append((in_a[a0], in_b[b0 + same[0]]))
            continue
        half = len(left) // 2
        ahead = _lengths(left[:half], _masks(right), len(right))
        back = _lengths(left[half:][::-1], _masks(right[::-1]), len(right))[::-1]
        cut = int(np.argmax(ahead + back))
        if not (ahead + back)[cut]:
            continue
        work += [(a0, a0 + half, b0, b0 + cut), (a0 + half, a1, b0 + cut, b1)]
    found.sort()
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)


def _lines(page: str | None) -> tuple[list[str], list[int]]:
    """The visible lines of a page, and whether each is ``OWN``, ``OPEN`` or the ``SITE``'s."""
    blocks = lines_of(page)
    article = any(block.main for block in blocks)
    kinds = [
        SITE if block.marked or article and not block.main else OPEN if block.links or not block.main else OWN
        for block in blocks
    ]
    return [block.text for block in blocks], kinds


def _by_page(pages: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``work`` to ``page, page_id, url, host, path, html`` of bounded numbers of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, batch.column("html")):
                yield work(piece)

    url, page = F.col("url").cast("string"), F.col("html").cast("string")
    return pages.select(
        F.xxhash64(F.col("page_id").cast("string"), url, page).alias("page"),
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        _host(url).alias("host"),
        _path(url).alias("path"),
        page.alias("html"),
    ).mapInArrow(run, schema)


def _extracted(pages: DataFrame) -> DataFrame:
    """The visible lines of each page, as hashes, with their kinds and the sizes of text lines."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        hashes, sizes, kinds, ends = [], [], [], [0]
        for page in piece.column("html").to_pylist():
            lines, own = _lines(page)
            hashes += [xxhash.xxh3_64_intdigest(line.encode()) for line in lines]
            sizes += [0 if kind == SITE else len(line) for line, kind in zip(lines, own, strict=True)]
            kinds += own
            ends.append(ends[-1] + len(lines))
        kept = ["page", "host", "path"]
        return pa.RecordBatch.from_arrays(
            [
                *(piece.column(name) for name in kept),
                list_array(signed(np.array(hashes, dtype=np.uint64)), np.array(ends)),
                list_array(np.array(sizes, dtype=np.int32), np.array(ends)),
                list_array(np.array(kinds, dtype=np.int8), np.array(ends)),
            ],
            [*kept, "hashes", "sizes", "kinds"],
        )

    return _by_page(
        pages, work, "page long, host string, path string, hashes array<long>, sizes array<int>, kinds array<tinyint>"
    )


def _texts(pages: DataFrame) -> DataFrame:
    """The text of each page, all lines but the site's, and the number of its lines."""

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts = [], []
        for page in piece.column("html").to_pylist():
            lines, kinds = _lines(page)
            own = [line for line, kind in zip(lines, kinds, strict=True) if kind != SITE]
            texts.append("\n".join(own))
            counts.append(len(own))
        kept = ["page", "page_id", "url"]
        return pa.RecordBatch.from_arrays(
            [
                *(piece.column(name) for name in kept),
                pa.array(texts, pa.string()),
                pa.array(counts, pa.int64()),
            ],
            [*kept, "whole", "n_lines"],
        )

    return _by_page(pages, work, "page long, page_id long, url string, whole string, n_lines long")


def _agreement(a: str, b: str) -> int:
    """Characters that two paths begin with alike."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``page, texts, nearness, gone, n_shared`` of both pages of each pair that are not copies.

    ``texts`` says whether lines of the two texts agree; ``gone`` counts lines of the text.
    """
    for batch in batches:
        pages, texts, near, gone, shared = [], [], [], [], []
        for row in batch.to_pylist():
            a, b = (np.array(row[name], dtype=np.int64) for name in ("hashes", "next_hashes"))
            kinds = [np.array(row[name], dtype=np.int8) for name in ("kinds", "next_kinds")]
            places = common_lines(a, b)
            if not len(places[0]):
                continue
            in_text = [own != SITE for own in kinds]
            agree = places[0][in_text[0][places[0]] & in_text[1][places[1]]]
            same = sum(row["sizes"][i] for i in agree.tolist())
            if same > COPY_SHARE * min(sum(row["sizes"]), sum(row["next_sizes"])):
                continue
            nearness = 2 * _agreement(row["path"], row["next_path"])
            for first, page in enumerate((row["page"], row["next_page"])):
                lines = places[first][kinds[first][places[first]] != OWN]
                open_lines = lines[kinds[first][lines] == OPEN]
                pages.append(page)
                texts.append(same > 0)
                near.append(nearness + first)  # of two equally near, the page before
                gone.append((np.cumsum(in_text[first])[open_lines] - 1).tolist())
                shared.append(len(lines))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(pages, pa.int64()),
                pa.array(texts, pa.bool_()),
                pa.array(near, pa.int64()),
                pa.array(gone, pa.list_(pa.int64())),
                pa.array(shared, pa.int64()),
            ],
            ["page", "texts", "nearness", "gone", "n_shared"],
        )


def _neighbours(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """Each page with the next of its host, in the order of paths, over ranges.

    Inside a range the next row is the next page. Between ranges, the last page of one
    goes with the first of the following: one row per range.
    """
    order = ["host", "path", "page"]
    kept = [*order, "hashes", "sizes", "kinds"]
    ranged = scratch.table(
        lines.select(*kept)
        .where(F.expr("host <> ''") & F.exists("kinds", lambda kind: kind != SITE))
        .repartitionByRange(*order)
        .withColumn("part", F.spark_partition_id()),
        "ranged",
    )
    inside = Window.partitionBy("part").orderBy(*order)
    following = F.lead(F.struct(*kept)).over(inside)
    paired = ranged.withColumn("next", following)
    columns = [*kept, *(F.col(f"next.{name}").alias(f"next_{name}") for name in kept)]
    within = paired.where("next is not null and host = next.host").select(*columns)
    edges = ranged.groupBy("part").agg(
        F.max(F.struct(*order)).alias("last"), F.min(F.struct(*order)).alias("first")
    )
    across = (
        edges.withColumn("next", F.lead("first").over(Window.orderBy("part")))
        .where("last.host = next.host")
        .select(F.col("last.page").alias("page"), F.col("next.page").alias("next_page"))
    )
    one = ranged.select(*kept)
    other = ranged.select(*(F.col(name).alias(f"next_{name}") for name in kept))
    # Few rows are at the ends of ranges; only these are looked at for repeated rows.
    last = one.join(F.broadcast(across), "page").dropDuplicates(["page", "next_page"])
    first = other.join(F.broadcast(across.select("next_page")), "next_page").dropDuplicates(["next_page"])
    between = last.join(first, "next_page")
    return within.union(between.select(*within.columns))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, n_lines, n_shared`` of every row of ``pages``.

    ``text`` joins the lines that stay by line breaks, in the order of the page; white
    space inside a line is one space. ``n_chars`` counts its code points; ``n_lines``
    its lines before differencing; ``n_shared`` the lines of the page that differencing
    deleted, its menus and the like included. A null or empty html gives an empty text. A page whose url is
    null or has no host is compared with none. Rows that repeat are treated alike and
    each give a row. Other columns are ignored.
    """
    scratch = Scratch(pages.sparkSession, "html")
    found = scratch.table(_extracted(pages), "extracted")
    pairs = _neighbours(found, scratch).where(F.arrays_overlap("hashes", "next_hashes"))
    nearest = F.max_by(F.struct("gone", "n_shared"), F.struct("texts", "nearness"))
    gone = scratch.table(
        pairs.mapInArrow(_align, "page long, texts boolean, nearness long, gone array<long>, n_shared long")
        .groupBy("page")
        .agg(nearest.alias("nearest"))
        .select("page", "nearest.*")
        .where("n_shared > 0"),
        "gone",
    )
    scratch.drop("extracted", "ranged")
    stay = F.filter(F.split("whole", "\n"), lambda line, i: ~F.array_contains("gone", i.cast("long")))
    return (
        _texts(pages)
        .join(gone.hint("shuffle_hash"), "page", "left")
        .withColumn("text", F.when(F.size("gone") > 0, F.array_join(stay, "\n")).otherwise(F.col("whole")))
        .select(
            "page_id",
            "url",
            "text",
            F.length("text").cast("long").alias("n_chars"),
            "n_lines",
            F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared"),
        )
    )
