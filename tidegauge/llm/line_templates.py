"""Line dedup by a log-template tree.

The tree has a fixed depth: a line goes down by its number of tokens, then by its
leading tokens, to a leaf. Tokens with a digit count as variable from the start. In a
leaf, a token is constant where nearly as many of the leaf's lines have it at its place
as share the line's other tokens; the rest are variable fields. The constant tokens and
the places of the variable ones are the line's template; a line that has too few
constants, because nothing else in its leaf is like it, is a template of its own.

A template recurs when it occurs in several documents. Copies of a document share all
templates, so templates alone would delete every copied document. Documents therefore
count by what surrounds a template: fully if less than half of their words are in
recurring templates, and otherwise by the words of their own lines as a share of those
that recur. A line that begins or ends like one of another document is an edit of it
and no line of its own, so near copies show nothing, while pages of little text under
much boilerplate add up. Templates with enough such documents are boilerplate, and all
their lines are dropped, everywhere.

Texts are split into lines on executors; what is shuffled is one small row per line,
tokens only of lines in leaves that hold different lines of different documents, and
texts only of documents with lines to drop.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.frames import bitmap_table, by_piece, hash_bitmap, in_bitmap, let, lookup, split_by
from tidegauge.llm.tokens import AS_IS, ODD, SMALL_PIECE, hash_words, list_array, mix, signed, split_words, text_bytes
from tidegauge.sources.workspace import Scratch

#: Leading tokens on the way to a leaf.
DEPTH = 4
#: Lines of fewer tokens are left alone.
LEAST_TOKENS = 3
#: A token is constant if it has this share of the line's usual support.
STEADY = 0.8
#: Least share of constant tokens in a template of several lines.
ALIKE = 0.6
#: Documents with other content that a template must occur in to be dropped.
LEAST_DOCS = 3
#: Documents of which less than this share of words recurs count fully.
OWN_SHARE = 0.5
#: Most tokens at either end of a line that an edit of it has too.
EDGE = 4
#: What a document that counts fully adds up to.
WHOLE = 1_000_000
FILTER_BITS = 24

DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
VARIABLE = np.uint64(0x5DEECE66D)


#: Stripped from both ends of a line before it is hashed.
ENDS = " \t\r\x0b\x0c"
#: The seed of Spark's xxhash64, so that both sides agree on a line's hash.
SEED = 42


def line_hashes(text: str | None) -> np.ndarray:
    """One hash per line, of its bytes without blanks at the ends."""
    lines = (text or "").split("\n")
    return np.fromiter(
        (xxhash.xxh64_intdigest(line.strip(ENDS).encode(), SEED) for line in lines), np.uint64, len(lines)
    )


def line_hash(line: Column) -> Column:
    """The same hash in Spark."""
    return F.xxhash64(F.trim(line, F.lit(ENDS)))


def tokens_of(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all lines, variable ones alike, and each line's first."""
    data, bounds = text_bytes(lines)
    words = split_words(data, bounds)
    hashes = hash_words(words, AS_IS)
    digits = np.concatenate([[0], np.cumsum(DIGIT[data])])
    hashes[digits[words.ends] > digits[words.starts]] = VARIABLE
    return hashes, words.first


def leaves_of(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The leaf of each line: its number of tokens and its first ``DEPTH`` ones."""
    n = np.diff(first)
    leaf = n.astype(np.uint64)
    for place in range(DEPTH):
        has = n > place
        leaf[has] = mix(leaf[has] * ODD[place] + hashes[first[:-1][has] + place])
    return leaf


def edges_of(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The beginning and the end of each line: up to ``EDGE`` tokens, half of its tokens at most."""
    width = np.clip(np.diff(first) // 2, 1, EDGE)
    head, tail = width.astype(np.uint64), width.astype(np.uint64) + np.uint64(EDGE)
    for place in range(EDGE):
        has = (width > place) & (np.diff(first) > 0)
        head[has] = mix(head[has] * ODD[place] + hashes[first[:-1][has] + place])
        tail[has] = mix(tail[has] * ODD[place] + hashes[first[1:][has] - 1 - place])
    return head, tail


def _parts(texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All lines, their hashes, and each text's first line."""
    lines = [(text or "").split("\n") for text in texts]
    first = np.concatenate([[0], np.cumsum([len(own) for own in lines])]).astype(np.int64)
    hashes = [line_hashes(text) for text in texts]
    return [line for own in lines for line in own], np.concatenate(hashes) if hashes else np.zeros(0), first


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc, line, leaf, head, tail, tokens, words`` of each distinct line of each distinct text of a piece.

    ``doc`` is a hash of the text, so exact copies are one document. ``words`` counts
    the line as often as the text has it.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = list(dict.fromkeys(piece.column("text").to_pylist()))
        lines, hashes, first = _parts(texts)
        tokens, at = tokens_of(pa.array(lines, pa.string()))
        n, leaf = np.diff(at), leaves_of(tokens, at)
        head, tail = edges_of(tokens, at)
        docs, kept, words = [], [], []
        for i, text in enumerate(texts):
            own = slice(first[i], first[i + 1])
            _, index, inverse = np.unique(hashes[own], return_index=True, return_inverse=True)
            docs.append(np.full(len(index), xxhash.xxh64_intdigest((text or "").encode(), SEED), dtype=np.uint64))
            kept.append(index + first[i])
            words.append(np.bincount(inverse, weights=n[own]).astype(np.int64))
        if not docs:
            docs, kept, words = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        rows = np.concatenate(kept)
        long = n[rows] > 0
        return pa.RecordBatch.from_arrays(
            [
                pa.array(signed(np.concatenate(docs)[long])),
                pa.array(signed(hashes[rows][long])),
                pa.array(signed(leaf[rows][long])),
                pa.array(signed(head[rows][long])),
                pa.array(signed(tail[rows][long])),
                pa.array(n[rows][long], pa.int64()),
                pa.array(np.concatenate(words)[long]),
            ],
            ["doc", "line", "leaf", "head", "tail", "tokens", "words"],
        )

    schema = "doc long, line long, leaf long, head long, tail long, tokens long, words long"
    return by_piece(docs, ["text"], work, schema, SMALL_PIECE)


def _tokens_in(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """``line, leaf, tokens`` of the distinct lines of each piece that ``wanted`` lets pass."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        lines, hashes, _ = _parts(list(dict.fromkeys(piece.column("text").to_pylist())))
        some = np.flatnonzero(in_bitmap(sent.value, hashes.astype(np.uint64)))
        own, index = np.unique(hashes[some], return_index=True)
        tokens, first = tokens_of(pa.array([lines[i] for i in some[index]], pa.string()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(signed(own.astype(np.uint64))),
                pa.array(signed(leaves_of(tokens, first))),
                list_array(signed(tokens), first),
            ],
            ["line", "leaf", "tokens"],
        )

    return by_piece(docs, ["text"], work, "line long, leaf long, tokens array<long>")


def _templates(docs: DataFrame, lines: DataFrame, scratch: Scratch) -> DataFrame:
    """``line, template`` of the lines that share a template with other lines."""
    leaves = lines.groupBy("leaf").agg(
        *(f(name).alias(f"{kind}_{name}") for name in ("doc", "line") for kind, f in (("a", F.min), ("z", F.max)))
    )
    mixed = leaves.where("a_doc <> z_doc and a_line <> z_line").select("leaf")
    several = scratch.table(lookup(lines, mixed, "leaf", ["doc"]).select("line").distinct(), "several")
    found = _tokens_in(docs, hash_bitmap(several, "line", FILTER_BITS)).join(several, "line")
    placed = scratch.table(
        found.dropDuplicates(["line"]).select("line", "leaf", F.posexplode("tokens").alias("place", "token")),
        "placed",
    )
    support = placed.groupBy("leaf", "place", "token").agg(F.count("*").alias("support"))
    whole = (
        placed.join(support, ["leaf", "place", "token"])
        .groupBy("line", "leaf")
        .agg(F.sort_array(F.collect_list(F.struct("place", "token", "support"))).alias("tokens"))
    )
    supports = F.sort_array(F.transform("tokens", lambda x: x["support"]))
    usual = let(supports, lambda x: F.element_at(x, (F.size(x) / 2).cast("int") + 1))

    def name(usual: Column) -> Column:
        steady = F.transform("tokens", lambda x: F.when(x["support"] >= STEADY * usual, x["token"]).otherwise(0))
        return let(steady, lambda kept: F.when((usual > 1) & _alike(kept), F.xxhash64("leaf", kept)))

    named = whole.select("line", let(usual, name).alias("template"))
    return named.where("template is not null")


def _alike(kept: Column) -> Column:
    return F.size(F.filter(kept, lambda token: token != 0)) >= ALIKE * F.size(kept)


def _evidence(lines: DataFrame, marked: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc, weight`` of the documents that show a template among lines of their own."""
    shares = scratch.table(
        marked.groupBy("doc")
        .agg(F.sum("words").alias("all"), F.sum(F.when(F.col("recurs"), F.col("words"))).alias("again"))
        .where("again < all"),
        "shares",
    )
    telling = F.col("again") < OWN_SHARE * F.col("all")
    own = scratch.table(
        marked.where("recurs is null")
        .join(shares.where(~telling).select("doc", "again"), "doc")
        .select("doc", "line", "words", "again")
        .join(lines.select("doc", "line", "head", "tail"), ["doc", "line"]),
        "own",
    )
    edges = scratch.table(own.select(F.explode(F.array("head", "tail")).alias("edge")).distinct(), "edges")
    shared = scratch.table(
        lookup(lines.select("doc", F.explode(F.array("head", "tail")).alias("edge")), edges, "edge", ["doc"])
        .groupBy("edge")
        .agg(F.min("doc").alias("a"), F.max("doc").alias("z"))
        .where("a <> z")
        .select("edge"),
        "shared",
    )
    for end in ("head", "tail"):
        own = lookup(own, shared.withColumnRenamed("edge", end), end, ["doc"], "left_anti")
    weak = own.groupBy("doc").agg(
        F.least(F.lit(WHOLE), (WHOLE * F.sum("words") / F.max("again")).cast("long")).alias("weight")
    )
    return shares.where(telling).select("doc", F.lit(WHOLE).cast("long").alias("weight")).union(weak)


def boilerplate(docs: DataFrame, scratch: Scratch, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``doc, gone``: of each text's hash, those of its lines whose templates recur."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    found = lines_of(texts).dropDuplicates(["doc", "line"])
    lines = scratch.table(found, "lines")
    long = lines.where(F.col("tokens") >= LEAST_TOKENS)
    templates = scratch.table(_templates(texts, long, scratch), "templates")
    named = scratch.table(
        lookup(lines.drop("leaf", "head", "tail"), templates, "line", ["doc"], "left").withColumn(
            "template", F.coalesce("template", "line")
        ),
        "named",
    )
    recurring = (
        named.groupBy("template")
        .agg(F.min("doc").alias("a"), F.max("doc").alias("z"))
        .where("a <> z")
        .select("template", F.lit(True).alias("recurs"))
    )
    marked = scratch.table(lookup(named, recurring, "template", ["doc"], "left"), "marked")
    dropped = (
        marked.where(F.col("recurs") & (F.col("tokens") >= LEAST_TOKENS))
        .select("template", "doc")
        .distinct()
        .join(_evidence(lines, marked, scratch), "doc")
        .groupBy("template")
        .agg(F.sum("weight").alias("weight"))
        .where(F.col("weight") >= least_docs * WHOLE)
        .select("template")
    )
    result = scratch.table(
        lookup(marked.where("recurs").select("template", "line", "doc"), dropped, "template", ["doc"])
        .groupBy("doc")
        .agg(F.collect_list("line").alias("gone")),
        "dropped",
    )
    scratch.drop(
        "lines", "several", "placed", "templates", "named", "marked", "shares", "own", "edges", "shared"
    )
    return result


def _cleaned(docs: DataFrame, scratch: Scratch, least_docs: int) -> DataFrame:
    """``row, text, n_lines, n_dropped``: the text without boilerplate lines."""
    dropped = boilerplate(docs, scratch, least_docs)
    text = F.col("row.text").cast("string")
    doc = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = docs.select(F.struct("*").alias("row"))
    marks = bitmap_table(dropped.select("doc"), FILTER_BITS, scratch, "marks")
    touched, others = split_by(rows, doc, marks, FILTER_BITS)
    touched = touched.withColumn("doc", doc).withColumn("doc_id", F.col("row.doc_id").cast("long"))
    found = lookup(touched, dropped, "doc", ["doc_id"], "left").select("row", text.alias("text"), "gone")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line: ~F.array_contains("gone", line_hash(line)))
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n")))
    return (
        found.withColumn("kept", F.when(F.col("gone").isNull(), lines).otherwise(kept))
        .select(
            "row",
            F.array_join("kept", "\n").alias("text"),
            n_lines.alias("n_lines"),
            F.coalesce(F.size(lines) - F.size("kept"), F.lit(0)).alias("n_dropped"),
        )
        .union(others.select("row", text, n_lines, F.lit(0)))
    )


def drop_report(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of every row: its text without boilerplate.

    Dropped lines go with their line break; what is left keeps its order. A null text
    stays null, with no lines; an empty one has one empty line, which is never dropped,
    nor are blank lines and lines of fewer than three tokens. Rows that repeat are
    treated alike and each give a row. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "line-templates")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _cleaned(own, scratch, least_docs).select(
        "row.doc_id", "text", F.col("n_lines").cast("long"), F.col("n_dropped").cast("long")
    )


def drop_lines(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The rows of ``docs`` with the text of :func:`drop_report`, all other columns as they are."""
    scratch = Scratch(docs.sparkSession, "line-templates-keep")
    clean = _cleaned(docs, scratch, least_docs)
    return clean.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")
