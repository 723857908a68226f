"""Operator 1. Quality rules with risk-controlled cutoffs.

Every rule turns a text into an integer level from 0 to 100 and rejects the
text if the level is over a cutoff. Cutoffs are chosen per stratum from a
labelled holdout:

* ``H(c)``: "cutoff ``c`` rejects at least a share ``alpha / n_rules`` of the
  good texts of the stratum". It is refuted if the exact binomial tail
  ``P(Bin(n, alpha / n_rules) <= k)`` is at most ``delta / (n_strata * n_rules)``,
  where ``k`` of the ``n`` good holdout texts are over ``c`` (the exact, i.e.
  Clopper-Pearson, upper bound on the false-rejection rate is then below
  ``alpha / n_rules``).
* Within a stratum and rule the cutoffs are tested in a fixed sequence from
  lenient (99) to strict (0), up to the first that is not refuted; between
  strata and rules the level is divided (Bonferroni). So with probability
  ``1 - delta`` all refuted cutoffs are safe at once, and as the rules' shares
  add up, at most ``alpha`` of the good texts of any stratum are rejected.
* Among the safe cutoffs the one that rejects most bad minus ``cost`` times
  good holdout texts is taken; with equals next to it, the middle of that run
  (rounded down) leaves room on either side. A cutoff that gains nothing,
  or a stratum with too few labels to refute anything, sets no rule: it keeps
  its texts.

Texts are never truncated. Edge cases: a null or empty text has no words, all
counts are 0 and it fails the base rules; null strata form the stratum ``""``;
label rows that repeat a document count once (the lower label); null labels are
ignored; with no labels at all every text that passes the base rules is kept;
repeated documents are judged row by row; other columns of the input are kept
out of the result, so clashing names do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, released, saved

ALPHA, DELTA, COST = 0.10, 0.05, 5
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
RULES = ("symbols", "capitals", "repeats", "dup_lines")
SYMBOLS = b"#*$%&|<>"
#: A strata table of at most so many rows is broadcast to the texts (some 40 bytes a row).
BROADCAST_STRATA = 10_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def text_counts(chars: str) -> tuple[int, ...]:
    """The COUNTS of one text; bytes.split() splits at exactly \\x20 and \\x09-\\x0D."""
    text = chars.encode()
    words = text.split()
    n = len(words)
    if not n:
        return (0, 0, text_symbols(text), 0, 0, 0, 0)
    word_chars = len(chars) - (len(text) - sum(map(len, words)))  # white space is one byte a character
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (n, word_chars, text_symbols(text), len(lines) - len(set(lines)), repeated_words(words),
            len(lines), len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")))


def text_symbols(text: bytes) -> int:
    return len(text) - len(text.translate(None, SYMBOLS))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-2] * len(seen) + ids[1:-1], return_inverse=True)[1]  # exact at any vocabulary
    _, group, count = np.unique(pairs * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[group] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        rows = np.array([text_counts(t or "") for t in texts], np.int64).reshape(len(texts), len(COUNTS))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("stratum"), *(pa.array(rows[:, k]) for k in range(len(COUNTS)))],
            names=["doc_id", "stratum", *COUNTS])


def measure(docs: DataFrame, stratum: str | None = "lang") -> DataFrame:
    """doc_id, stratum and the COUNTS of every text (narrow; one pass, no shuffle)."""
    prepare(docs.sparkSession)
    strata = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum else F.lit("")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), strata.alias("stratum"),
                         F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(released(_count_batches), "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def _percent(part: str, whole: str) -> Column:
    """Whole-number percentage, 0 to 100; 0 of nothing is 0."""
    return F.expr(f"int(least(100, (100 * {part}) div greatest({whole}, 1)))")


#: Labelled ids (8 bytes each) go out to the documents up to this number; beyond it all documents are counted.
BROADCAST_LABELS = 100_000
LEVELS = {"symbols": ("n_symbols", "n_words"), "capitals": ("n_capitals", "word_chars"),
          "repeats": ("n_repeat_words", "n_words"), "dup_lines": ("n_dup_lines", "n_lines")}


def with_levels(measured: DataFrame) -> DataFrame:
    return measured.withColumns({"base_failed": base_failed(), **{f"level_{r}": _percent(*LEVELS[r]) for r in RULES}})


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed from the greatest term outwards until the terms vanish.

    Below the mean the terms fall from k downwards, above it those of the other tail from
    k + 1 upwards: some standard deviations of terms at any n, the rest is under 1e-18 of the sum."""
    if k >= n:
        return 1.0
    log = lambda i: (math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                     + i * math.log(p) + (n - i) * math.log1p(-p))
    lower = k < n * p
    terms, total = [], 0.0
    for i in range(k, -1, -1) if lower else range(k + 1, n + 1):
        terms.append(math.exp(log(i)))
        total += terms[-1]
        if terms[-1] <= 1e-18 * total:
            break
    tail = math.fsum(terms)
    return min(1.0, tail) if lower else max(0.0, 1.0 - tail)


def choose_cutoff(levels: np.ndarray, good: np.ndarray, bad: np.ndarray, risk: float, level: float,
                  cost: float) -> tuple[int | None, int, int]:
    """(cutoff or None, good texts, good texts over it) of one stratum and rule.

    ``levels`` with the numbers of good and bad holdout texts at each."""
    g, b = np.zeros(101, np.int64), np.zeros(101, np.int64)
    np.add.at(g, levels, good)
    np.add.at(b, levels, bad)
    over = lambda x: x.sum() - np.cumsum(x)  # noqa: E731  at index c: those with a level over c
    good_over, bad_over, n = over(g), over(b), int(g.sum())
    best, run = 0, []
    for c in range(99, -1, -1):
        if n == 0 or binomial_tail(int(good_over[c]), n, risk) > level:
            break
        gain = bad_over[c] - cost * good_over[c]
        if gain > best:
            best, run = gain, [c]
        elif run and gain == best and c == run[-1] - 1:
            run.append(c)
    if not run:
        return None, n, 0
    c = (run[0] + run[-1]) // 2
    return c, n, int(good_over[c])


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
            cost: float = COST) -> DataFrame:
    """One row per stratum and rule: stratum, rule, cutoff (null: no rule), n_good, n_false.

    ``measured`` is joined with the labels once; the histogram of levels (at
    most 101 rows per stratum, rule and label, pre-aggregated before the
    shuffle) is all that the choice needs."""
    label = (labels.where("doc_id is not null and quality is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")))
    held = with_levels(measured).where(~F.col("base_failed")).join(label, "doc_id")
    stacked = held.select("stratum", (F.col("quality") >= 1).alias("is_good"), F.explode(F.array(
        *(F.struct(F.lit(r).alias("rule"), F.col(f"level_{r}").alias("level")) for r in RULES))).alias("x"))
    hist = (stacked.groupBy("stratum", "x.rule", "x.level")
            .agg(F.sum(F.col("is_good").cast("long")).alias("good"), F.sum((~F.col("is_good")).cast("long")).alias("bad")))
    hist = saved(hist, "rule-levels")
    n_strata = max(1, hist.select("stratum").distinct().count())
    risk, level = alpha / len(RULES), delta / (n_strata * len(RULES))

    def choose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        c, n, k = choose_cutoff(pdf.level.to_numpy(), pdf.good.to_numpy(), pdf.bad.to_numpy(), risk, level, cost)
        out = pd.DataFrame({"stratum": [key[0]], "rule": [key[1]], "cutoff": pd.array([c], dtype="Int32"),
                            "n_good": [n], "n_false": [k]})
        return out

    return hist.groupBy("stratum", "rule").applyInPandas(
        choose, "stratum string, rule string, cutoff int, n_good long, n_false long")


def judge(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", alpha: float = ALPHA,
          delta: float = DELTA, cost: float = COST) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, failed_rules and kept."""
    measured = saved(measure(docs, stratum), "rule-counts")
    chosen = saved(cutoffs(measured, labels, alpha, delta, cost), "rule-cutoffs")
    wide = chosen.groupBy("stratum").agg(*(
        F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES))
    if wide.count() <= BROADCAST_STRATA:
        wide = F.broadcast(wide)
    judged = with_levels(measured).join(wide, "stratum", "left")
    failed = F.filter(F.array(*(F.when(F.col(f"level_{r}") > F.col(f"cut_{r}"), F.lit(r)) for r in RULES)),
                      lambda r: r.isNotNull())
    return (judged.withColumn("failed_rules", F.array_join(failed, ","))
            .select("doc_id", "stratum", *COUNTS, "base_failed", "failed_rules",
                    (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept")))


def keep_rows(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text the rules keep, with the columns of ``docs``.

    The verdict depends on text and stratum alone, so the cutoffs (at most one
    row per rule for each stratum that has some hundred labels) go to the documents and the counts are taken in the same pass: no join on
    document ids, hence null or repeated ids are no special case."""
    # cutoffs need the counts of labelled rows only: others are read once, by the filter
    ids = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("__rule_id")).distinct()
    few = ids.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    held = docs.join(F.broadcast(ids), F.col("doc_id").cast("long") == F.col("__rule_id"), "left_semi") if few else docs
    measured = saved(measure(held, options.get("stratum", "lang")), "rule-counts")
    params = {k: options[k] for k in ("alpha", "delta", "cost") if k in options}
    cut = {(r.stratum, r.rule): r.cutoff for r in cutoffs(measured, labels, **params).where("cutoff is not null").collect()}
    stratum = options.get("stratum", "lang")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            strata = b.column(stratum).cast(pa.string()).to_pylist() if stratum else [""] * len(texts)
            yield b.filter(pa.array([_kept(t or "", s or "", cut) for t, s in zip(texts, strata)], pa.bool_()))

    return docs.mapInArrow(released(keep), docs.schema)


def _kept(text: str, stratum: str, cut: dict[tuple[str, str], int]) -> bool:
    x = dict(zip(COUNTS, text_counts(text)))
    if x["n_words"] < MIN_WORDS or 100 * x["n_repeat_words"] > MAX_REPEAT_PCT * x["n_words"]:
        return False
    return all(min(100, 100 * x[part] // max(1, x[whole])) <= cut.get((stratum, r), 100)
               for r, (part, whole) in LEVELS.items())
