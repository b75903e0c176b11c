"""Quality rules: base limits, and a decision list learned from labelled statistics.

``statistics`` measures every text. ``learn_rules`` grows, by sequential covering, conjunctions of thresholds that
single out low quality, prunes each on held-out rows, and stops when no rule is precise enough. ``keep`` turns the
ordered rules into one Spark conditional expression.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import bounded_sample, free_name, map_batches

SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines"]
#: What the rules look at, as shares so that they hold at any length.
FEATURES = {
    "mean_word": "word_chars / n_words",
    "symbol_share": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "upper_share": "n_upper / word_chars",
    "mark_share": "n_marks / n_words",
}


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS; words are runs of bytes other than space and \\t to \\r."""
    raw = (text or "").encode()
    words = raw.split()
    chars = sum(map(len, words)) - (len(raw) - len(text or ""))
    lines = raw.split(b"\n")
    full = [line for line in lines if line.split()]
    triples = list(zip(words, words[1:], words[2:], strict=False))
    count = Counter(triples)
    repeated = 0
    if len(count) < len(triples):
        twice = np.array([count[t] > 1 for t in triples], bool)
        inside = np.zeros(len(words), bool)
        for k in range(3):
            inside[k: k + len(twice)] |= twice
        repeated = int(inside.sum())
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return (
        len(words), chars, symbols, len(full) - len(set(full)), repeated, upper,
        raw.count(b"!") + raw.count(b"?"), len(full),
    )


def statistics(docs: DataFrame, text: str = "text", column: str = "stats") -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct of COUNTS, and its name (underscores in front if it is taken).

    Null and blank texts count zero everywhere. Rows and other columns stay as they are.
    """
    name = free_name(docs, column)
    place = docs.columns.index(text)
    fields = ",".join(f"{c}:bigint" for c in COUNTS)
    schema = docs.withColumn(name, F.lit(None).cast(f"struct<{fields}>")).schema

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(t.as_py()) for t in batch.column(place).cast(pa.string())]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.StructArray.from_arrays(columns, COUNTS)], names=schema.names
        )

    return map_batches(docs, fn, schema), name


def features(stats: Column) -> dict[str, Column]:
    """The features of a struct of COUNTS; a share of nothing is zero."""
    out = {}
    for name, formula in FEATURES.items():
        top, low = (stats[part] for part in formula.split(" / "))
        out[name] = F.when(low > 0, top / low).otherwise(F.lit(0.0))
    return out


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


@dataclass(frozen=True)
class Rule:
    """Rejects where all of its (feature, above, threshold) conditions hold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def matches(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(rows.values()))), bool)
        for name, above, limit in self.conditions:
            out &= rows[name] > limit if above else rows[name] <= limit
        return out

    def expression(self, values: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, above, limit in self.conditions:
            out = out & (values[name] > limit if above else values[name] <= limit)
        return out


def _precision(hit: np.ndarray, bad: np.ndarray) -> float:
    """Share of bad rows among those hit, with one good row added for safety."""
    return float((hit & bad).sum() / (hit.sum() + 1)) if hit.any() else 0.0


def _grow(rows: dict[str, np.ndarray], bad: np.ndarray, most: int, cuts: int) -> Rule:
    """Adds, while any good row is left, the condition of the largest information gain."""
    conditions: tuple = ()
    inside = np.ones(len(bad), bool)
    while (inside & ~bad).any() and len(conditions) < most:
        p, n = (inside & bad).sum(), inside.sum()
        best, choice = 1e-9, None
        for name, values in rows.items():
            for limit in np.unique(np.quantile(values[inside], np.linspace(0, 1, cuts), method="lower")):
                for above in (True, False):
                    hit = inside & (values > limit if above else values <= limit)
                    q = (hit & bad).sum()
                    if q:
                        gain = q * (np.log2(q / hit.sum()) - np.log2(p / n))
                        if gain > best:
                            best, choice = gain, (name, above, float(limit))
        if choice is None:
            break
        conditions += (choice,)
        inside &= Rule((choice,)).matches(rows)
    return Rule(conditions)


def _prune(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Drops final conditions as long as precision on held-out rows does not fall."""
    best = rule
    for k in range(len(rule.conditions) - 1, 0, -1):
        shorter = Rule(rule.conditions[:k])
        if _precision(shorter.matches(rows), bad) >= _precision(best.matches(rows), bad):
            best = shorter
    return best


def fit_rules(
    rows: dict[str, np.ndarray], bad: np.ndarray, held: np.ndarray, precision: float = 0.9, most_rules: int = 12,
    most_conditions: int = 4, cuts: int = 65,
) -> list[Rule]:
    """Sequential covering: rules grown on rows not ``held``, pruned and judged on those held out.

    The list stays readable by its limits: ``most_rules`` rules of ``most_conditions`` conditions each, thresholds at the
    ``cuts`` inner quantiles of a column. They bound the classifier, not the rows it judges; covering ends earlier at the
    first rule whose precision on held-out rows is below ``precision``.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < most_rules and (left & bad & ~held).any():
        grow = {k: v[left & ~held] for k, v in rows.items()}
        test = {k: v[left & held] for k, v in rows.items()}
        rule = _grow(grow, bad[left & ~held], most_conditions, cuts)
        if not rule.conditions:
            break
        rule = _prune(rule, test, bad[left & held])
        if _precision(rule.matches(test), bad[left & held]) < precision:
            break
        rules.append(rule)
        left &= ~rule.matches(rows)
    return rules


def learn_rules(
    stats: DataFrame, column: str, labels: DataFrame, key: str = "doc_id", label: str = "quality",
    most_rows: int = 20_000, **settings,
) -> list[Rule]:
    """Rules from the rows of ``stats`` that have a label (0 is low quality); nulls in key or label teach nothing.

    The fit sees at most ``most_rows`` labelled rows, those with the smallest hash of their key; every third of them is
    held out for pruning. No labelled rows, or labels of one kind only, give no rules.
    """
    known = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label")).dropna()
    joined = stats.select(F.col(key).alias("_key"), *[v.alias(n) for n, v in features(F.col(column)).items()]).join(
        known, "_key"
    )
    sample = bounded_sample(joined, "_key", most_rows).select("_label", *FEATURES).collect()
    if not sample:
        return []
    table = np.array([tuple(map(float, r)) for r in sample])
    rows = {name: table[:, i + 1] for i, name in enumerate(FEATURES)}
    return fit_rules(rows, table[:, 0] == 0, np.arange(len(table)) % 3 == 2, **settings)


def keep(stats: Column, rules: list[Rule]) -> Column:
    """False where a base limit fails or a rule rejects, in that order; else true."""
    verdict = F.when(base_failed(stats), F.lit(False))
    values = features(stats)
    for rule in rules:
        verdict = verdict.when(rule.expression(values), F.lit(False))
    return verdict.otherwise(F.lit(True))
