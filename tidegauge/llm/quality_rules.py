"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every rule rejects a document whose score exceeds a cutoff. Cutoffs come from a fixed
grid, lenient to strict, and are chosen per stratum (language) on labelled documents:
for each cutoff the number ``k`` of the ``n`` good documents that it rejects gives the
exact binomial probability of so few if the true rate of false rejection were the
allowed one. Cutoffs are certified, in order, as long as that probability is below the
error level divided by the number of rules and strata (Bonferroni over these; within a
rule the order is fixed in advance, so no further division is needed). With confidence
``1 - ERROR``, then, no stratum loses more than ``RISK`` of its good documents. Of the
certified cutoffs the one that separates best is used; without labels or with too few,
none is, and the rule rejects nothing there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.frames import lookup
from tidegauge.sources.workspace import Scratch

#: Share of good documents that the rules together may reject in a stratum.
RISK = 0.05
#: Probability that the promise above fails anywhere.
ERROR = 0.05
#: Good documents weigh so much more than bad ones when cutoffs are compared.
GOOD_WEIGHT = 20
RULES = ("symbols", "repeats", "dup_lines", "capitals")
#: Cutoffs of every rule, lenient to strict; scores are shares from 0 to 1.
GRID = (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.175, 0.15, 0.125, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03)

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
LEAST_WORDS = 50
MOST_REPEATED = 50


def _repeated(words: str, n: str) -> list[tuple[str, str]]:
    """Steps that count words in three-word windows that occur twice or more.

    Windows are 64-bit hashes. A sort of hashes whose low bits are replaced by the
    window's place brings equal windows side by side; the full hashes are compared.
    """
    return [
        ("hashes", f"slice(transform({words}, (w, i) -> xxhash64(w, get({words}, i + 1), get({words}, i + 2))), 1, greatest({n} - 2, 0))"),
        ("high", f"shiftleft(-1L, cast(ceil(log2({n} + 2)) as int))"),
        ("sorted", "sort_array(transform(hashes, (h, i) -> (h & high) | i))"),
        (
            "twice",
            "filter(transform(sorted, (x, i) -> if((x & high) = (get(sorted, i + 1) & high)"
            " and get(hashes, cast(x & ~high as int)) = get(hashes, cast(get(sorted, i + 1) & ~high as int)),"
            " i, -1)), i -> i >= 0)",
        ),
        (
            "windows",
            "array_distinct(flatten(transform(twice, i ->"
            " array(get(sorted, i) & ~high, get(sorted, i + 1) & ~high))))",
        ),
        ("n_repeat_words", "cast(size(array_distinct(flatten(transform(windows, p -> array(p, p + 1, p + 2))))) as bigint)"),
    ]


def measured(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the base counts of ``text`` and the rules' scores as columns."""
    steps = docs.withColumn("body", F.coalesce(text.cast("string"), F.lit("")))
    steps = steps.withColumn("words", F.filter(F.split("body", BLANKS), lambda word: word != ""))
    steps = steps.withColumn("n_words", F.size("words").cast("long"))
    inner = []
    for name, step in _repeated("words", "n_words"):
        steps = steps.withColumn(name, F.expr(step))
        inner.append(name)
    lines = F.filter(F.split("body", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    steps = (
        steps.withColumn("lines", lines)
        .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
        .withColumn("n_symbols", F.length(F.regexp_replace("body", SYMBOLS, "")).cast("long"))
        .withColumn("n_capitals", F.length(F.regexp_replace("body", "[^\\p{Lu}]+", "")).cast("long"))
        .withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    )
    return (
        steps.drop("body", "words", "lines", *(name for name in inner if name != "n_repeat_words"))
        .withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        )
        .withColumn("symbols", _share("n_symbols", "word_chars"))
        .withColumn("repeats", _share("n_repeat_words", "n_words"))
        .withColumn("dup_lines", _share("n_dup_lines", "n_lines"))
        .withColumn("capitals", _share("n_capitals", "word_chars"))
    )


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series at n + 8, taken back to n; good to 1e-12."""
    z = n + F.lit(9.0)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    shifted = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series
    product = n + F.lit(1.0)
    for step in range(2, 9):
        product = product * (n + F.lit(float(step)))
    return shifted - F.log(product)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial of n and p, exactly; 1 where k reaches the mean."""
    sure = k >= n * p
    top = F.when(sure, F.lit(0)).otherwise(k).cast("long")
    # sixty standard deviations below, terms vanish in double precision
    low = F.greatest(F.lit(0), top - 60 * F.ceil(F.sqrt(n * p) + 1)).cast("long")
    sum_ = F.aggregate(
        F.sequence(low, top),
        F.lit(0.0),
        lambda total, i: total
        + F.exp(
            log_factorial(n) - log_factorial(i) - log_factorial(n - i)
            + i * math.log(p) + (n - i) * math.log1p(-p)
        ),
    )
    return F.when(sure, F.lit(1.0)).otherwise(sum_)


def thresholds(scored: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """``stratum`` and one cutoff per rule; null where the rule rejects nothing.

    ``scored`` has ``doc_id, stratum, base_failed`` and the scores. Only labelled
    documents that pass the base count. All counts are grouped sums, pre-aggregated.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where("doc_id is not null and quality is not null").dropDuplicates(["doc_id", "quality"])
    graded = scored.where("not base_failed").join(known, "doc_id")
    grid = F.array(*(F.lit(cut) for cut in GRID))
    # the most lenient cutoff that rejects the document; one past the end if none does
    first = lambda rule: F.size(F.filter(grid, lambda cut: F.col(rule) <= cut))
    rows = graded.select(
        "stratum",
        "quality",
        F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), first(r).alias("step")) for r in RULES))).alias("x"),
    )
    counts = scratch.table(
        rows.groupBy("stratum", "x.rule", "x.step").agg(
            F.sum((F.col("quality") == 1).cast("long")).alias("good"),
            F.sum((F.col("quality") == 0).cast("long")).alias("bad"),
        ),
        "counts",
    )
    strata = max(1, counts.select("stratum").distinct().count())
    level = ERROR / (len(RULES) * strata)
    steps = (
        counts.select("stratum", "rule")
        .distinct()
        .select("*", F.posexplode(grid).alias("step", "cut"))
        .join(counts, ["stratum", "rule", "step"], "left")
    )
    up_to = Window.partitionBy("stratum", "rule").orderBy("step")
    totals = counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n"))
    tried = (
        steps.select(
            "stratum",
            "rule",
            "cut",
            F.coalesce(F.sum("good").over(up_to), F.lit(0)).alias("k"),
            F.coalesce(F.sum("bad").over(up_to), F.lit(0)).alias("caught"),
        )
        .join(totals, ["stratum", "rule"])
        .where(binomial_tail(F.col("k"), F.col("n"), RISK / len(RULES)) <= level)
        .where(F.col("caught") > GOOD_WEIGHT * F.col("k"))
    )
    gain = F.col("caught") - GOOD_WEIGHT * F.col("k")
    chosen = tried.groupBy("stratum", "rule").agg(F.max(F.struct(gain.alias("gain"), "cut")).alias("best"))
    return chosen.groupBy("stratum").agg(
        *(F.max(F.when(F.col("rule") == rule, F.col("best.cut"))).alias(f"{rule}_cut") for rule in RULES)
    )


def _stratum(lang: Column) -> Column:
    return F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), lang.cast("string")))


def _judged(scored: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """``scored`` with ``kept``; every stratum is looked up without gathering its rows."""
    cuts = scratch.table(thresholds(scored, labels, scratch), "cuts")
    found = lookup(scored, cuts, "stratum", ["doc_id", "n_words"], "left")
    over = [F.coalesce(F.col(rule) > F.col(f"{rule}_cut"), F.lit(False)) for rule in RULES]
    rejected = F.col("base_failed")
    for one in over:
        rejected = rejected | one
    return found.withColumn("kept", ~rejected)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The base counts, the scores and the verdict of every row of ``docs``.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept``, then the rules' scores. Words are runs of other than space and the control
    characters 9 to 13. A null text has no words, so it fails the base, as any text of
    fewer than 50 words. A null language is a stratum of its own. Labels with a null,
    and of documents that are not there, count for nothing; a document labelled both
    ways counts as both. Rows that repeat each give a row. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "quality-rules")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _stratum(F.col("lang")).alias("stratum"), "text"
    )
    scored = scratch.table(measured(own, F.col("text")).drop("text"), "scored")
    return _judged(scored, labels, scratch).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *RULES
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns."""
    scratch = Scratch(docs.sparkSession, "quality-keep")
    rows = docs.select(F.struct("*").alias("row")).select(
        "row",
        F.col("row.doc_id").cast("long").alias("doc_id"),
        _stratum(F.col("row.lang")).alias("stratum"),
    )
    scored = scratch.table(measured(rows, F.col("row.text")), "scored")
    return _judged(scored, labels, scratch).where("kept").select("row.*")
