"""Source divergence audit against plain counting."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegauge.llm import packed_terms, source_audit

UPPER = {code: code + 32 for code in range(65, 91)}
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[str]:
    return [term.translate(UPPER) for term in TERM.findall(text or "")]


def plain_audit(rows: list[tuple]) -> list[tuple]:
    counts, langs, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found, lang = terms(text), lang or ""
        counts[lang, source or ""].update(found)
        langs[lang].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in langs:
        kept = sorted(term for term, n in docs[lang].items() if n >= 3)
        sources = sorted((source for other, source in counts if other == lang), key=str.encode)

        def shares(count, kept=kept):
            total = sum(count[term] for term in kept) + len(kept)
            return {term: 1 + 10**9 * (count[term] + 1) // total for term in kept}

        p = {source: shares(counts[lang, source]) for source in sources}
        q = shares(langs[lang])
        for source in sources:
            far = [
                (sum((p[source][t] - p[other][t]) ** 2 // p[other][t] for t in kept), other)
                for other in sources
                if other != source
            ]
            high = [
                ((p[source][t] - q[t]) ** 2 // q[t], t)
                for t in kept
                if counts[lang, source][t] and p[source][t] > q[t]
            ]
            for part, values in (("pair", far), ("term", high)):
                values.sort(key=lambda row: (-row[0], row[1].encode()))
                values = values[:200] if part == "term" else values
                out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(values)]
    return sorted(out)


PIECES = st.sampled_from(
    ["a", "B", "ab", "é", "漢字", "abcdefgh", "ABCDEFGHI", "abcdefghijklmnop", "q" * 17, "Q" * 40, "x" * 33, " ", "-", "\n", "1", "İ", "\x00"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(PIECES, max_size=25).map("".join), st.integers(0, 2)), min_size=1, max_size=8))
def test_counts_of_a_piece(rows):
    texts = [text for text, _ in rows]
    parts = list(packed_terms.count_terms(pa.array(texts), np.array([group for _, group in rows])))
    n, docs = Counter(), Counter()
    for part in parts:
        for term, group, count, seen in zip(part.term.to_pylist(), part.group, part.n, part.texts, strict=True):
            n[term, int(group)] += int(count)
            docs[term, int(group)] += int(seen)
    expected_n, expected_docs = Counter(), Counter()
    for text, group in rows:
        expected_n.update((term, group) for term in terms(text))
        expected_docs.update((term, group) for term in set(terms(text)))
    assert (n, docs) == (expected_n, expected_docs)


def test_radix_order_is_stable():
    values = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64) >> np.uint64(40)
    values = np.concatenate([values, values, np.array([0, 2**64 - 1], dtype=np.uint64)])
    order = packed_terms.radix_order(values, np.arange(len(values)))
    assert (order == np.argsort(values, kind="stable")).all()


def test_long_terms_and_parts(monkeypatch):
    monkeypatch.setattr(packed_terms, "ROWS_BYTES", 64)
    texts = ["z" * 100_000 + " a b c", "z" * 100_000 + " a a", None, "", "z" * 99_999, "a"]
    n, docs = Counter(), Counter()
    for part in packed_terms.count_terms(pa.array(texts), np.zeros(6, dtype=np.int64)):
        for term, count, seen in zip(part.term.to_pylist(), part.n, part.texts, strict=True):
            n[term] += int(count)
            docs[term] += int(seen)
    assert n == {"z" * 100_000: 2, "z" * 99_999: 1, "a": 4, "b": 1, "c": 1}
    assert docs == {"z" * 100_000: 2, "z" * 99_999: 1, "a": 3, "b": 1, "c": 1}


def test_exact_shares(spark):
    """Counts beyond what a long holds after scaling, and sums past 2**53."""
    rows = [(0, 0, 1), (10**15, 10**15, 1), (123_456_789_012, 9 * 10**17, 10**9)]
    frame = spark.createDataFrame(rows, "n long, total long, terms long")
    got = [row.p for row in frame.select("n", source_audit.share("n", "total", "terms").alias("p")).orderBy("n").collect()]
    assert got == [1 + 10**9 * (n + 1) // (total + v) for n, total, v in sorted(rows)]
    frame = spark.createDataFrame([(10**9 + 1, 1), (1, 10**9 + 1), (3, 7)], "p long, q long")
    got = [row.f for row in frame.select(source_audit.divergence("p", "q").alias("f")).collect()]
    assert got == [10**18, (10**9) ** 2 // (10**9 + 1), 16 // 7]


def test_audit(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "BLOCK", 16)
    monkeypatch.setattr(source_audit, "HELD", 8)
    generator = np.random.default_rng(5)
    names = ["apple", "Apple", "pear", "漢字", "a" * 20, "b" * 9, "plum", "fig", "é", "kiwi", "lime", "oak"]
    rows = []
    for i in range(150):
        source = ["s1", "s2", "s10", None, "é", "hot", "hot", "hot"][i % 8]
        picked = generator.choice(names, generator.integers(0, 9), p=np.arange(12, 0, -1) / 78)
        rows.append((" 1".join(picked), ["en", "de", None][i % 3], source))
    rows += [(None, "xx", "a"), ("once only", "xx", "b"), ("", "xx", "b"), ("one one", "yy", "a"), ("lone", "zz", None)]
    rows += [("one two", "yy", "a"), ("one two", "yy", "a")]
    docs = spark.createDataFrame([(*row, 7, "x") for row in rows], "text string, lang string, source string, n int, term string")
    assert sorted(map(tuple, source_audit.audit(docs).collect())) == plain_audit(rows)
    assert source_audit.audit(docs.limit(0)).collect() == []


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(row) for row in docs.select("text", "lang", "source").collect()]
    assert sorted(map(tuple, source_audit.audit(docs).collect())) == plain_audit(rows)
