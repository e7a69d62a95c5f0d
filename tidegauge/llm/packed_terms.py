"""Distinct terms of a piece of text, counted by sorting them as machine words.

Terms go to buckets by their length in bytes. Up to eight bytes are one big-endian
``uint64``, up to sixteen two, so equal terms are equal numbers and their order is that of
the bytes; a radix sort of sixteen-bit digits brings them together. Longer terms lie in
buckets of twice the width each, as rows of bytes that are sorted as such. Terms hold no
zero byte, so padding with zeros keeps them apart. In each bucket equal neighbours are
counted as runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from tidegauge.llm.tokens import LOWER, split_words, text_bytes

#: Bytes that end a term: all ASCII but letters.
NO_LETTER = np.zeros(256, dtype=bool)
NO_LETTER[[i for i in range(128) if not chr(i).isalpha()]] = True
#: Bytes of terms laid out as rows at a time.
ROWS_BYTES = 32 << 20


class Counted(NamedTuple):
    """Runs of equal terms in one group: the term, its group, occurrences and texts."""

    term: pa.Array
    group: np.ndarray
    n: np.ndarray
    texts: np.ndarray


def radix_order(digits: np.ndarray, order: np.ndarray) -> np.ndarray:
    """``order`` stably sorted by 64-bit ``digits``, sixteen bits at a time."""
    for shift in (0, 16, 32, 48):
        part = (digits >> np.uint64(shift)).astype(np.uint16)
        if len(part) and part.min() != part.max():
            order = order[np.argsort(part[order], kind="stable")]
    return order


def _rows(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The lower-cased bytes of terms, one per row, zeros behind them."""
    columns = np.arange(width)
    at = starts[:, None] + columns
    np.minimum(at, len(data) - 1, out=at)
    return np.where(columns < lengths[:, None], LOWER[data[at]], 0).astype(np.uint8)


def _strings(rows: np.ndarray) -> pa.Array:
    """Rows without their zeros, as strings."""
    filled = rows != 0
    offsets = np.concatenate([[0], np.cumsum(filled.sum(axis=1))]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(offsets), pa.py_buffer(rows[filled])).cast(pa.string())


def _bucket(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, group, text) -> Counted:
    """Count the terms of one bucket, which come by group and then text."""
    rows = _rows(data, starts, lengths, width)
    if width <= 16:
        packed = rows.view(">u8").astype(np.uint64).reshape(len(rows), width // 8)
        order = np.arange(len(rows))
        for column in reversed(range(width // 8)):
            order = radix_order(packed[:, column], order)
        packed = packed[order]
        differs = (packed[1:] != packed[:-1]).any(axis=1)
    else:
        whole = rows.view(f"S{width}")[:, 0]
        order = np.argsort(whole, kind="stable")
        differs = whole[order][1:] != whole[order][:-1]
    group, text = group[order], text[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = differs | (group[1:] != group[:-1])
    first = np.flatnonzero(new)
    changes = new.copy()
    changes[1:] |= text[1:] != text[:-1]
    n = np.diff(np.append(first, len(rows)))
    return Counted(_strings(rows[order[first]]), group[first], n, np.add.reduceat(changes.astype(np.int64), first))


def count_terms(texts: pa.Array, group: np.ndarray) -> Iterator[Counted]:
    """Counts of each term in each group, as one or more parts per length bucket.

    ``group`` numbers the group of each text. A term that is in several parts has its
    texts counted apart in each, and no text is in two parts of one bucket.
    """
    data, bounds = text_bytes(texts)
    terms = split_words(data, bounds, NO_LETTER)
    text = np.repeat(np.arange(len(texts)), np.diff(terms.first))
    lengths = terms.ends - terms.starts
    width = 8
    while len(lengths):
        own = np.flatnonzero((lengths <= width) & (lengths > (width // 2 if width > 8 else 0)))
        for part in _parts(own, text, max(1, ROWS_BYTES // width)):
            part = part[np.argsort(group[text[part]], kind="stable")]
            yield _bucket(data, terms.starts[part], lengths[part], width, group[text[part]], text[part])
        if width >= lengths.max():
            return
        width *= 2


def _parts(own: np.ndarray, text: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Slices of about ``most`` terms that end where a text ends."""
    at = 0
    while at < len(own):
        to = len(own)
        if at + most < to:
            to = int(np.searchsorted(text[own], text[own[at + most]], side="right"))
        yield own[at:to]
        at = to
