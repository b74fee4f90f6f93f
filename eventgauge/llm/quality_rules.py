"""Quality rules: a decision list learned by sequential covering, run as Spark expressions.

Statistics of a text are built-in expressions; the rules are threshold conjunctions over them
and become one ordered CASE expression, so texts never leave the JVM.  The rules are learned on
the driver from the statistics (numbers, no texts) of at most `SAMPLE` labelled rows a class:
a rule is grown condition by condition by the gain in information on two thirds of the rows
left, pruned on the other third, and taken if it is precise enough there; then the rows it
covers are taken away and the next rule is sought.

Defined results: a null text has no words; texts without words fail the base rule; equal rows
are judged each; null ids are kept; without labelled rows of both classes the list is empty and
only the base rule decides; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventgauge.llm.shared import SPACE, labelled_sample, texts

#: Labelled rows of each class that are used at most.
SAMPLE = 10_000
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = (
    "n_words", "word_length", "symbol_share", "upper_share", "mark_share", "dup_line_share", "repeat_share",
    "line_words",
)


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def with_repeats(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words from the column `words`.

    Windows of three words are hashed to 64 bits and sorted with their places inside the row;
    equal neighbours are repeated windows, and the words they cover are counted from the gaps
    between their places.  Every step is a column, so nothing is computed twice.
    """
    n = F.size("words")
    window = lambda i: F.struct(
        F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i")
    )
    grams = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    same = lambda x, k: (
        F.coalesce(F.get("grams", k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("grams", k + 1)["h"] == x["h"], F.lit(False))
    )
    found = rows.withColumn("grams", F.sort_array(grams))
    found = found.withColumn("hits", F.sort_array(F.transform(F.filter("grams", same), lambda x: x["i"])))
    gaps = F.transform("hits", lambda x, k: F.least(F.coalesce(F.get("hits", k + 1) - x, F.lit(3)), F.lit(3)))
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.withColumn("n_repeat_words", total).drop("grams", "hits")


def statistics(documents: DataFrame) -> DataFrame:
    """doc_id, the counts of the base rule, and the features of the learned rules."""
    text = F.col("text")
    rows = documents.select(
        "*",
        F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    rows = with_repeats(rows).select(
        *[c for c in documents.columns if c != "text"],
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        _count(text, UPPER).alias("n_upper"),
        _count(text, "!?").alias("n_marks"),
    )
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return rows.select(
        "*",
        (F.col("word_chars") / words).alias("word_length"),
        (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("n_upper") / chars).alias("upper_share"),
        (F.col("n_marks") / words).alias("mark_share"),
        (F.col("n_dup_lines") / lines).alias("dup_line_share"),
        (F.col("n_repeat_words") / words).alias("repeat_share"),
        (F.col("n_words") / lines).alias("line_words"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, data: dict[str, np.ndarray]) -> np.ndarray:
        return data[self.feature] >= self.threshold if self.above else data[self.feature] < self.threshold

    def column(self) -> Column:
        own = F.col(self.feature)
        return own >= F.lit(self.threshold) if self.above else own < F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    """Texts for which all conditions hold are of low quality."""

    conditions: tuple[Condition, ...]
    precision: float
    covered: int

    def holds(self, data: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.holds(data) for c in self.conditions])

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out


def grow(data: dict[str, np.ndarray], bad: np.ndarray, most: int) -> list[Condition]:
    """Conditions, each the one with the most information gained about the rows it keeps."""
    inside = np.ones(len(bad), bool)
    out: list[Condition] = []
    while len(out) < most:
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        if not p or not n:
            break
        before, best = math.log2(p / (p + n)), (1e-9, None)
        for feature in FEATURES:
            values = data[feature][inside]
            # Every quantile that some row reaches is a threshold; so is the least value above 0.
            cuts = np.unique(np.quantile(values, np.linspace(0.005, 0.995, 100), method="higher"))
            positive = values[values > 0]
            cuts = np.unique(np.append(cuts, positive.min() if len(positive) else 0.0))
            order = np.argsort(values, kind="stable")
            ranked, hits = values[order], np.concatenate([[0], np.cumsum(bad[inside][order])])
            at = np.searchsorted(ranked, cuts, side="left")
            for above in (True, False):
                p1 = hits[-1] - hits[at] if above else hits[at]
                all1 = len(ranked) - at if above else at
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p1 > 0, p1 * (np.log2(p1 / all1) - before), 0.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), Condition(feature, above, float(cuts[k])))
        if best[1] is None:
            break
        out.append(best[1])
        inside &= best[1].holds(data)
    return out


def prune(conditions: list[Condition], data: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Condition, ...]:
    """The leading conditions with the best (right - wrong) / covered on rows not used to grow."""
    best, kept = -2.0, conditions[:1]
    inside = np.ones(len(bad), bool)
    for k, c in enumerate(conditions):
        inside &= c.holds(data)
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        value = (p - n) / (p + n) if p + n else -1.0
        if value > best + 1e-12:
            best, kept = value, conditions[: k + 1]
    return tuple(kept)


def learn(
    data: dict[str, np.ndarray], bad: np.ndarray, rules: int = 16, conditions: int = 4, precision: float = 0.97,
    least: float = 0.002,
) -> list[Rule]:
    """The decision list.  Rows come in an order that says nothing of them; every third one prunes."""
    left = np.ones(len(bad), bool)
    part = np.arange(len(bad)) % 3 == 0
    out: list[Rule] = []
    while len(out) < rules:
        growing, pruning = left & ~part, left & part
        if bad[growing].sum() < 5 or not bad[pruning].any():
            break
        found = grow({k: v[growing] for k, v in data.items()}, bad[growing], conditions)
        if not found:
            break
        kept = prune(found, {k: v[pruning] for k, v in data.items()}, bad[pruning])
        rule = Rule(kept, 0.0, 0)
        mine = rule.holds(data) & left
        for side in (pruning, growing):
            p, n = int(bad[mine & side].sum()), int((~bad[mine & side]).sum())
            if p < max(2, least * bad[side].sum()) or p < precision * (p + n):
                return out
        out.append(Rule(kept, float(bad[mine].mean()), int(mine.sum())))
        left &= ~mine
    return out


def fitted(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> list[Rule]:
    sample = statistics(labelled_sample(documents, labels, "quality", per_class))
    # By a hash of the id, so that the rules do not depend on how the table is partitioned.
    order = ["place", "doc_id", "label", *FEATURES]
    rows = sample.withColumn("place", F.xxhash64(F.lit(7), "doc_id")).select(*order).toPandas()
    rows = rows.sort_values(order, kind="stable")
    data = {f: rows[f].to_numpy(float) for f in FEATURES}
    return learn(data, rows["label"].to_numpy() == 0)


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression: the place of the first rule that holds, else null."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules))):
        out = F.when(rule.column(), F.lit(k)).otherwise(out)
    return out


def judged(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the five counts, base_failed, kept, and the rule that decided."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return statistics(texts(documents)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), verdict(rules).alias("rule"),
    ).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
