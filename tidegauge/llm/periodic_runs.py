"""Periodic runs of words: a sparse diagonal table of matches at each lag.

A run of period ``q`` is a stretch of words each equal to the one ``q`` before it, so it
is a diagonal of matches at lag ``q``: every word's earlier occurrences at that lag add
one to the diagonal's match length, and a diagonal that ends long enough is a run. The
match length must reach ``q``, which bounds what has to be kept:

* Lags below ``DENSE`` are compared outright.
* A lag in ``[L, 2 L)`` needs ``L`` matches in a row, so only earlier occurrences of a
  word's whole window of ``L`` words count. Windows of ``2 L`` words come from those of
  ``L`` that recur, so ever fewer words take part.
* Windows that recur within half of their length lie in a run of a shorter period.
  Matches inside that run belong to it and add nothing, and matches between two such
  runs begin where one of them begins; the increments up to where one ends are one entry.

So a text of ``n`` words has of the order of ``n`` entries per scale, also if it repeats a
single word. All texts of a piece are treated at once, as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import as_texts, by_piece
from tidegauge.llm.tokens import AS_IS, ODD, hash_words, mix, text_bytes, words_of

#: Fewest words of a run.
LEAST_LENGTH = 12
#: Lags below this are compared word by word; larger ones by windows of this many words.
DENSE = LEAST_LENGTH

Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def least_matches(period: int) -> int:
    """Matches at lag ``period`` that a run needs: two periods, twelve words in all."""
    return max(period, LEAST_LENGTH - period)


def short_periods(words: np.ndarray, text: np.ndarray) -> Iterator[Found]:
    """Start, end and period of runs of every lag below ``DENSE``."""
    for lag in range(1, min(DENSE, len(words))):
        same = np.zeros(len(words) - lag + 2, dtype=np.int8)
        same[1:-1] = (words[lag:] == words[:-lag]) & (text[lag:] == text[:-lag])
        turns = np.flatnonzero(np.diff(same))
        begins, ends = turns[::2], turns[1::2]
        enough = ends - begins >= least_matches(lag)
        yield begins[enough], ends[enough] + lag, np.full(enough.sum(), lag)


def _earlier(keys: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each key of ``at``, the places in sorted ``keys`` from ``size`` to ``2 size - 1`` below it."""
    low = np.searchsorted(keys, at - 2 * size + 1)
    high = np.searchsorted(keys, at - size, side="right")
    n = high - low
    own = np.repeat(np.arange(len(at)), n)
    return own, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[own]


def _matches(places: np.ndarray, classes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches of windows at lags from ``size`` to ``2 size - 1``: place, lag, increments.

    ``places`` ascend within each of ``classes``, which ascend too. A pair of windows
    inside one run of a shorter period is left out; a pair in two such runs is there
    only where one of the runs begins, with all increments up to where one ends.
    """
    n = len(places)
    follows = np.zeros(n + 1, dtype=bool)
    follows[1:-1] = (classes[1:] == classes[:-1]) & (np.diff(places) <= size // 2)
    inside = follows[:-1] | follows[1:]
    in_order = np.argsort(places)
    lined, kept = places[in_order], inside[in_order]
    joins = np.zeros(n, dtype=bool)
    joins[1:] = kept[1:] & kept[:-1] & (np.diff(lined) == 1)
    run_lined = np.cumsum(~joins)
    run = np.empty(n, dtype=np.int64)
    run[in_order] = run_lined
    last_of = np.zeros(run_lined[-1] + 1 if n else 1, dtype=np.int64)
    last_of[run_lined] = lined  # the last place written is the run's last
    begins = np.empty(n, dtype=bool)
    begins[in_order] = ~joins
    heads = np.flatnonzero(~inside | begins)
    others = np.flatnonzero(inside & ~begins)

    far = int(places.max(initial=0)) + 2 * size + 1
    keys = classes * far + places
    own, other = _earlier(keys, keys[heads], size)
    late, early = heads[own], other
    own, other = _earlier(keys[heads], keys[others], size)
    late, early = np.concatenate([late, others[own]]), np.concatenate([early, heads[other]])
    both = inside[late] & inside[early]
    apart = ~(both & (run[late] == run[early]))
    late, early, both = late[apart], early[apart], both[apart]
    left = np.minimum(last_of[run[late]] - places[late], last_of[run[early]] - places[early])
    return places[late], places[late] - places[early], np.where(both, left + 1, 1)


def _diagonals(place: np.ndarray, lag: np.ndarray, steps: np.ndarray, size: int) -> Found:
    """Add up each diagonal's increments without a gap; those that end long enough."""
    order = np.lexsort((place, lag))
    place, lag, steps = place[order], lag[order], steps[order]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + steps[:-1])
    first = np.flatnonzero(new)
    length = np.add.reduceat(steps, first) + size - 1 if len(first) else np.zeros(0, dtype=np.int64)
    place, lag = place[first], lag[first]
    enough = length >= lag
    return (place - lag)[enough], (place + length)[enough], lag[enough]


def long_periods(words: np.ndarray, text: np.ndarray) -> Iterator[Found]:
    """Start, end and period of runs from ``DENSE`` on, one scale of lags at a time."""
    size, n = DENSE, len(words)
    if n < 2 * size:
        return
    window = np.zeros(n - size + 1, dtype=np.uint64)
    for j, place in enumerate(np.arange(size, dtype=np.uint64) * ODD[4]):
        window += mix(words[j : j + len(window)] + place)
    places = np.flatnonzero(text[: len(window)] == text[size - 1 :])
    window = mix(window[places] + text[places].astype(np.uint64) * ODD[3])
    while len(places):
        order = np.argsort(window, kind="stable")
        ranked = window[order]
        same = np.zeros(len(ranked) + 1, dtype=bool)
        same[1:-1] = ranked[1:] == ranked[:-1]
        again = same[:-1] | same[1:]
        if not again.any():
            return
        classes = np.cumsum(~same[:-1])[again]
        recurring = order[again]
        yield _diagonals(*_matches(places[recurring], classes, size), size)

        recurring.sort()
        places, window = places[recurring], window[recurring]
        second = np.searchsorted(places, places + size)
        second[second == len(places)] = 0
        whole = places[second] == places + size
        window = mix(window[whole] * ODD[1] + window[second[whole]] * ODD[2])
        places, size = places[whole], 2 * size


def find_runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of each run, by start and then period.

    ``words`` are word hashes of all texts, and ``first`` the bounds of each text. A
    stretch found with a multiple of its period is found with the period too, as the
    same stretch, so the least one counts.
    """
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found = [*short_periods(words, text), *long_periods(words, text)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end, period = (np.concatenate(column).astype(np.int64) for column in zip(*found, strict=True))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.ones(len(start), dtype=bool)
    least[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _later_periods(start: np.ndarray, end: np.ndarray, period: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words some run contains after its first period."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:-1]) > 0


def collapse(docs: DataFrame) -> DataFrame:
    """Each text's periodic runs of words, and its words without their repetitions.

    ``doc_id``; ``n_words``; ``runs``, an array of ``start, length, period`` by start and
    then period, numbered in words from 0; ``collapsed``, the words that no run contains
    after its first period, joined by single blanks. A run is maximal, with its smallest
    period, two periods and twelve words long at least. A null text is an empty one,
    without runs. Rows that repeat each give a row; other columns are ignored. A text of
    any length is one piece of work of a few dozen bytes a word. Words count as equal by
    64-bit hashes.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        data, bounds = text_bytes(piece.column("text"))
        words = words_of(piece.column("text"))
        start, end, period = find_runs(hash_words(words, AS_IS), words.first)
        later = _later_periods(start, end, period, len(words.starts))
        own = np.searchsorted(start, words.first)
        raw, texts = data.tobytes(), []
        for i in range(piece.num_rows):
            kept = raw[bounds[i] : bounds[i + 1]].split()
            if own[i] < own[i + 1]:
                drop = later[words.first[i] : words.first[i + 1]].tolist()
                kept = [word for word, gone in zip(kept, drop, strict=True) if not gone]
            texts.append(b" ".join(kept))
        of_text = np.searchsorted(words.first, start, side="right") - 1
        fields = {"start": start - words.first[of_text], "length": end - start, "period": period}
        runs = pa.StructArray.from_arrays([pa.array(column) for column in fields.values()], list(fields))
        return pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                pa.array(np.diff(words.first)),
                pa.ListArray.from_arrays(pa.array(own.astype(np.int32)), runs),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "runs", "collapsed"],
        )

    run = "struct<start: long, length: long, period: long>"
    schema = f"doc_id long, n_words long, runs array<{run}>, collapsed string"
    return by_piece(as_texts(docs), ["doc_id", "text"], work, schema)


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; a tenth of the texts, by the CRC-32 of the id, made periodic.

    With ``g`` the CRC's tenth, the words from number ``g mod n`` on repeat their first
    ``1 + left / (3 + g mod 8)``, where ``left`` words are left. A null id or text stays
    as it is.
    """
    texts = as_texts(docs)
    blank = r"[\x20\x09-\x0D]+"
    periodic = texts.select(
        "doc_id",
        "text",
        F.crc32(F.col("doc_id").cast("string")).alias("h"),
        F.filter(F.split("text", blank), lambda word: word != "").alias("words"),
    ).where("h % 10 = 0 and size(words) > 0")
    periodic = periodic.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("int(g % size(words))"))
    periodic = periodic.withColumn("p", F.expr("int(1 + (size(words) - a) div (3 + g % 8))"))
    repeated = F.expr("array_join(transform(words, (w, i) -> words[if(i < a, i, a + (i - a) % p)]), ' ')")
    h = F.crc32(F.col("doc_id").cast("string"))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rest = texts.where(~(F.coalesce(h % 10 == 0, F.lit(False)) & has_words))
    return rest.unionByName(periodic.select("doc_id", repeated.alias("text")))


def digests(docs: DataFrame) -> DataFrame:
    """Counts and digests of the runs and collapsed texts of ``docs``, one row per row.

    The longest run (ties: smallest start, then period) gives ``start, length, period``
    and ``exponent_milli``, nulls without runs.
    """
    longest = F.array_max(
        F.transform("runs", lambda run: F.struct(run["length"], -run["start"], -run["period"]))
    )
    listed = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    return (
        collapse(docs)
        .withColumn("longest", longest)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            (-F.col("longest.col2")).alias("start"),
            F.col("longest.length").alias("length"),
            (-F.col("longest.col3")).alias("period"),
            F.expr("1000 * longest.length div -longest.col3").alias("exponent_milli"),
            F.sha2(lines, 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )
