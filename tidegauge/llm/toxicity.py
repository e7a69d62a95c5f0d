"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over the words that a
text has. Each model also sees the probabilities of the categories before it. In
training these are out of fold: every labelled document gets the earlier categories'
probabilities from models that were fitted without it, so a later model learns how far
to trust them.

Models are fitted on at most ``TRAIN_ROWS`` labelled documents, those with the smallest
hash of their id; all documents are scored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import linear
from tidegauge.llm.frames import as_texts, by_piece
from tidegauge.llm.tokens import BETWEEN, LOWER, hash_words, list_array, signed, split_words, text_bytes

#: Labelled documents that models are fitted on at most.
TRAIN_ROWS = 20_000
#: Words that the models use: those that tell most about any category.
VOCABULARY = 256
#: Labelled documents that a word must occur in.
LEAST_DOCS = 5
FOLDS = 4

# Terms by which a toxic document belongs to a category of its own.
SEEDS = {
    "insult": ("clown", "idiot", "loser", "moron", "stupid"),
    "contempt": ("disgusting", "pathetic", "scum", "trash", "worthless"),
}
CHAIN = (*SEEDS, "toxic")


class Model(NamedTuple):
    words: np.ndarray  # hashes, sorted
    weights: tuple[np.ndarray, ...]  # of each category in turn
    cuts: tuple[float, ...]


def words_in(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and each text's first."""
    words = split_words(*text_bytes(texts), BETWEEN)
    return hash_words(words, LOWER), words.first


def seed_hashes() -> dict[str, np.ndarray]:
    return {name: words_in(pa.array(list(terms)))[0] for name, terms in SEEDS.items()}


def presence(hashes: np.ndarray, first: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which of the sorted ``words`` each text has, as a matrix of 0 and 1."""
    out = np.zeros((len(first) - 1, len(words)), dtype=np.float32)
    if len(words) and len(hashes):
        at = np.searchsorted(words, hashes)
        at[at == len(words)] = 0
        known = words[at] == hashes
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        out[text[known], at[known]] = 1
    return out


def labelled(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> pa.Table:
    """``fold, toxic, words`` of the sample; ``words`` are distinct hashes."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        hashes, first = words_in(piece.column("text"))
        own = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        flat = np.concatenate(own) if own else np.zeros(0, dtype=np.uint64)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), piece.column("toxic"), list_array(signed(flat), ends)],
            ["doc_id", "toxic", "words"],
        )

    # at most TRAIN_ROWS pairs of an id and a label are sent to the texts
    sample = as_texts(docs).join(F.broadcast(known), "doc_id")
    found = by_piece(sample, ["doc_id", "toxic", "text"], work, "doc_id long, toxic int, words array<long>")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    return (
        found.dropDuplicates(["doc_id"]).select("doc_id", fold.alias("fold"), "toxic", "words").toArrow()
    ).sort_by("doc_id")


def informative(hashes: np.ndarray, text: np.ndarray, targets: np.ndarray, most: int) -> np.ndarray:
    """The words whose presence depends most on any category, by chi-square."""
    words, at, times = np.unique(hashes, return_inverse=True, return_counts=True)
    n, best = len(targets), np.zeros(len(words))
    for column in targets.T:
        good = column.sum()
        both = np.bincount(at, weights=column[text], minlength=len(words))
        if 0 < good < n:
            expected = times * good / n
            spread = expected * (1 - good / n) * (1 - times / (n + 1))
            best = np.maximum(best, (np.abs(both - expected) - 0.5).clip(0) ** 2 / np.maximum(spread, 1e-9))
    best[times < LEAST_DOCS] = 0
    top = np.argsort(-best, kind="stable")[:most]
    return np.sort(words[top[best[top] > 0]])


def fit_chain(sample: pa.Table) -> Model:
    """A model of each category of the chain, from the labelled sample."""
    lists = sample.column("words").combine_chunks()
    first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    hashes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    toxic = sample.column("toxic").to_numpy().astype(float)
    folds = sample.column("fold").to_numpy()
    targets = [
        toxic * (presence(hashes, first, np.sort(seeds)).sum(axis=1) > 0) for seeds in seed_hashes().values()
    ]
    targets = np.column_stack([*targets, toxic])
    words = informative(hashes, text, targets, VOCABULARY)
    seen = presence(hashes, first, words).astype(float)
    weights, cuts = [], []
    for target in targets.T:
        unseen = np.zeros(len(target))
        for fold in range(FOLDS):
            rest = folds != fold
            unseen[~rest] = linear.predict(seen[~rest], linear.fit(seen[rest], target[rest]))
        weights.append(linear.fit(seen, target))
        cuts.append(linear.best_cut(unseen, target))
        seen = np.column_stack([seen, unseen])
    return Model(words, tuple(weights), tuple(cuts))


def probabilities(seen: np.ndarray, model: Model) -> np.ndarray:
    """One column for each category, each model fed with the columns before."""
    for weights in model.weights:
        seen = np.column_stack([seen, linear.predict(seen, weights)])
    return seen[:, seen.shape[1] - len(model.weights) :]


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, a probability per category (``p_insult, p_contempt, p_toxic``) and ``toxic``.

    ``toxic`` holds where the last category's probability exceeds the cut of highest F1
    among the unseen predictions in training. A null or empty text has no words and
    gets the models' intercepts. Labels that are null or not 0 or 1, and of documents
    that are not there, are left out; a document labelled both ways counts as toxic.
    Without any toxic label nothing is toxic. Rows that repeat each give a row, and the
    first of rows with one id is trained on. Other columns are ignored.
    """
    model = fit_chain(labelled(docs, labels))
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        model = Model(*sent.value)
        hashes, first = words_in(piece.column("text"))
        p = probabilities(presence(hashes, first, model.words), model)
        return pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id"),
                *(pa.array(column.astype(float)) for column in p.T),
                pa.array(p[:, -1] > model.cuts[-1]),
            ],
            ["doc_id", *(f"p_{name}" for name in CHAIN), "toxic"],
        )

    schema = ", ".join(["doc_id long", *(f"p_{name} double" for name in CHAIN), "toxic boolean"])
    return by_piece(as_texts(docs), ["doc_id", "text"], work, schema)
