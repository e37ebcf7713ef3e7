"""Quality rules whose cutoffs are chosen under risk control.

Fixed base rules reject very short and very repetitive texts. Three further rules (share of symbols, of repeated
lines, of words in repeated 5-word windows) get their cutoffs from labelled documents, stratum by stratum: a cutoff
is used only if an exact binomial test shows that the rule there rejects at most `alpha` of the good documents.
Each rule tests its cutoffs in a fixed order, from the most lenient on, and stops at the first that fails; levels are
shared out over strata and rules (Bonferroni), so all statements hold together with probability 1 - delta.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_SPACE, identified, materialize, scratch, slices

SYMBOLS = "#*$%&|<>"  # fixed value of the contract
#: rule -> its cutoffs, most lenient first; a document is rejected if its share exceeds the cutoff
GRIDS = {
    "symbol_share": (1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "repeat_share": (0.19, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
}
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


class Counter:
    """Base counts of texts; words get numbers that hold within one batch."""

    def __init__(self, window: int = 5):
        self.window = window
        self.power = np.random.default_rng(7).integers(1, 2**63, window, dtype=np.uint64) | np.uint64(1)

    def _repeats(self, words: np.ndarray) -> int:
        """Words that lie in a window found at least twice in the text."""
        n = len(words) - self.window + 1
        if n < 2:
            return 0
        mixed = np.zeros(n, np.uint64)
        for k in range(self.window):
            mixed += words[k : k + n] * self.power[k]
        order = np.argsort(mixed, kind="stable")
        same = mixed[order[1:]] == mixed[order[:-1]]
        if not same.any():
            return 0
        a, b = order[:-1][same], order[1:][same]
        for k in range(self.window):
            if (words[a + k] != words[b + k]).any():  # a collision: count by the words themselves
                rows = np.lib.stride_tricks.sliding_window_view(words, self.window)
                _, which, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
                hit = times[which.reshape(-1)] > 1
                break
        else:
            hit = np.zeros(n, bool)
            hit[a] = hit[b] = True
        edge = np.zeros(len(words) + 1, np.int64)
        starts = np.flatnonzero(hit)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + self.window, -1)
        return int((np.cumsum(edge[:-1]) > 0).sum())

    def __call__(self, texts: list[str | None]) -> list[tuple[int, ...]]:
        numbers: dict[bytes, int] = {}
        out = []
        for text in texts:
            if not text:
                out.append((0, 0, 0, 0, 0, 0))
                continue
            words = text.encode("utf-8", "surrogatepass").split()
            codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, len(words))
            chars = len(text) - sum(map(text.count, ASCII_SPACE))
            seen: set[str] = set()
            lines = repeated = 0
            for line in text.split("\n"):
                if line.strip(ASCII_SPACE):
                    lines += 1
                    repeated += line in seen
                    seen.add(line)
            out.append((len(words), chars, sum(map(text.count, SYMBOLS)), repeated, self._repeats(codes), lines))
        return out


def count_features(docs: DataFrame, stratum: str = "lang", text_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, stratum and the base counts of every whole text; null and empty texts have none of anything."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for b in parts:
            for held in slices(b, text_bytes):
                columns = list(zip(*counter(held.column("text").to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [held.column("doc_id"), held.column("stratum"), *(pa.array(c, pa.int64()) for c in columns)],
                    ["doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, f"doc_id long, stratum string, {FEATURES}")


def with_shares(features: DataFrame) -> DataFrame:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return features.withColumns({
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        "symbol_share": F.col("n_symbols") / words, "repeat_share": F.col("n_repeat_words") / words, "dup_line_share": F.col("n_dup_lines") / lines,
    })


def binomial_tail(rejected: int, n: int, rate: float) -> float:
    """P(at most `rejected` of n at the given rate): the exact p-value of "the true rate is at least this"."""
    if n == 0:
        return 1.0
    log_rate, log_rest = math.log(rate), math.log1p(-rate)
    total = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * log_rate + (n - k) * log_rest) for k in range(rejected + 1))
    return min(1.0, total)


def choose_cutoffs(labelled: DataFrame, alpha: float, delta: float) -> DataFrame:
    """stratum and, for each rule, its cutoff (null: none shown to be safe).

    labelled: stratum, quality and the shares of labelled documents that pass the base rules. Counts by stratum, rule
    and cutoff are made before the groups meet, so a group has one row for each cutoff at most.
    """
    good = labelled.where("quality = 1")
    counts = good.groupBy("stratum").agg(F.count("*").alias("n"), *(F.count(F.when(F.col(rule) > cut, 1)).alias(f"{rule}_{k}") for rule, grid in GRIDS.items() for k, cut in enumerate(grid)))
    strata = counts.count()
    level, share = delta / max(1, strata * len(GRIDS)), alpha / len(GRIDS)

    def choose(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for table in parts:
            rows = []
            for row in table.to_dict("records"):
                cuts = []
                for rule, grid in GRIDS.items():
                    best = None
                    for k, cut in enumerate(grid):
                        if binomial_tail(int(row[f"{rule}_{k}"]), int(row["n"]), share) > level:
                            break
                        best = cut
                    cuts.append(best)
                rows.append((row["stratum"], *cuts))
            yield pd.DataFrame(rows, columns=["c_stratum", *(f"c_{r}" for r in GRIDS)]).astype({f"c_{r}": "float64" for r in GRIDS})

    return counts.mapInPandas(choose, "c_stratum string, " + ", ".join(f"c_{r} double" for r in GRIDS))


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = 0.03, delta: float = 0.05, small: int = 10_000) -> DataFrame:
    """Verdict on every row of docs (doc_id, text, the stratum column, any others).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_rule. Null
    texts have no words and fail the base rules; a null stratum is a stratum of its own. Labels (doc_id, quality) of
    no document, with null quality or of documents that fail the base rules are not used; a document with several
    labels counts as good only if all say so. Strata without enough labels get no cutoff, so nothing is rejected there
    beyond the base rules. Repeated doc_ids are judged one by one.
    """
    features = with_shares(materialize(count_features(docs, stratum), scratch(spark, "quality")))
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("l_doc_id")).agg(F.min("quality").alias("quality"))
    labelled = features.where("not base_failed").join(marks, F.col("doc_id") == F.col("l_doc_id")).select("stratum", "quality", *GRIDS)
    cuts = materialize(choose_cutoffs(labelled, alpha, delta), scratch(spark, "cutoffs"))
    if cuts.count() <= small:
        cuts = F.broadcast(cuts)
    failed = F.when(F.col("base_failed"), "base")
    for rule in GRIDS:
        failed = failed.when(F.col(rule) > F.col(f"c_{rule}"), rule)
    out = features.join(cuts, F.col("stratum") == F.col("c_stratum"), "left").withColumn("failed_rule", failed)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("failed_rule").isNull().alias("kept"), "failed_rule")


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """docs without the rejected rows; columns as they are, whatever their names.

    Each row has its own verdict, also rows that repeat a doc_id or have none (these have no label). Null and empty
    texts go, as they have no words; texts of any length count whole. An empty table gives no row.
    """
    rows = identified(spark, docs)
    column = lambda name: F.col(f"_col{docs.columns.index(name)}")
    marks = labels.select(F.col("doc_id").cast("long").alias("mark"), "quality")
    named = rows.select(F.col("_row").alias("doc_id"), column("doc_id").cast("long").alias("key"))
    own = marks.join(named, F.col("mark") == F.col("key")).select("doc_id", "quality")
    narrow = rows.select(F.col("_row").alias("doc_id"), column("text").alias("text"), column(stratum).alias(stratum))
    verdict = judge(spark, narrow, own, stratum, **options).where("kept").select(F.col("doc_id").alias("v_row"))
    return rows.join(verdict, F.col("_row") == F.col("v_row"), "left_semi").drop("_row").toDF(*docs.columns)
