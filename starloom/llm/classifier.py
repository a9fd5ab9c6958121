"""Quality classifier: regularised quadratic discriminant analysis.

A text becomes a dozen statistics, logged so that they spread about normally.
Each class is a normal distribution; its covariance is shrunk towards the
diagonal of the pooled one. The score compares the two log-densities, that is
Mahalanobis distances through the inverse Cholesky factors, worked out once.
Class sums are Spark aggregates over every labelled row; only they reach the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import let, python_ready, settled, stored, text_of, word_array

FEATURES = (
    "words", "word_length", "symbols", "marks", "capitals", "digits", "stops",
    "distinct", "doubled", "lines", "repeated_lines", "long_words",
)
_SHORT_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "it", "der", "die", "das", "und", "ist", "ein", "nicht",
    "le", "la", "les", "de", "des", "et", "un", "une", "du", "que", "el", "los", "y", "en", "por", "con", "se",
)
_SHORT_FORMS = tuple(dict.fromkeys(form for word in _SHORT_WORDS for form in (word, word.capitalize())))


def statistics(text: Column) -> Column:
    """array<double> of the FEATURES of a text; an empty text has finite values too."""

    def log_share(part: Column, whole: Column, floor: float, usual: float, weight: int) -> Column:
        """Log of a share, drawn to a usual one in short texts as if they had ``weight`` more."""
        return F.log((part + usual * weight) / (whole + weight) + F.lit(floor))

    def share_of_chars(pattern: str, chars: Column, floor: float, usual: float = 0.0) -> Column:
        return log_share(F.regexp_count(text, F.lit(pattern)), chars, floor, usual, 100)

    def of(words: Column, lines: Column) -> Column:
        n, rows = F.size(words), F.size(lines)
        chars = F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))
        doubled = F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False)))
        values = (
            F.log(n + 20),
            F.log((chars + 100) / (n + 20)),
            share_of_chars(r"[#*$%&|<>~^=_{}\[\]\\/@]", chars, 0.002),
            share_of_chars(r"[!?]", chars, 0.002),
            share_of_chars(r"\p{Lu}", chars, 0.01, 0.03),
            share_of_chars(r"\p{Nd}", chars, 0.002),
            log_share(F.size(F.filter(words, lambda w: w.isin(*_SHORT_FORMS))), n, 0.02, 0.3, 20),
            log_share(F.size(F.array_distinct(words)), n, 0.01, 0.8, 20),
            log_share(F.size(doubled), n, 0.01, 0.02, 20),
            F.log((n + 60) / (rows + 1)),
            log_share(rows - F.size(F.array_distinct(lines)), rows, 0.02, 0.0, 3),
            log_share(F.size(F.filter(words, lambda w: F.length(w) > 12)), n, 0.01, 0.05, 20),
        )
        return F.array(*[v.cast("double") for v in values])

    return let(word_array(text), lambda words: let(F.split(text, "\n", -1), lambda lines: of(words, lines)))


@dataclass(frozen=True)
class Discriminant:
    """Class means and inverse Cholesky factors; row 0 is class 0."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        logs = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True):
            y = (x - mean) @ factor.T
            logs.append(constant - 0.5 * np.einsum("ij,ij->i", y, y))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(labelled: DataFrame, shrinkage: float = 0.1, ridge: float = 1e-3) -> Discriminant | None:
    """Fit on (x array<double>, label 0 or 1). None where a class has fewer than two rows."""
    p = len(FEATURES)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    x = [F.col("x")[i] for i in range(p)]
    rows = (
        labelled.groupBy("label")
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(v) for v in x]).alias("sums"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("products"),
        )
        .collect()
    )
    found = {r["label"]: r for r in rows if r["n"] > 1}
    if not {0, 1} <= found.keys():
        return None
    means, covariances, sizes = [], [], []
    for label in (0, 1):
        n, mean = found[label]["n"], np.array(found[label]["sums"]) / found[label]["n"]
        second = np.zeros((p, p))
        for (i, j), value in zip(pairs, found[label]["products"], strict=True):
            second[i, j] = second[j, i] = value / n
        means.append(mean)
        covariances.append(second - np.outer(mean, mean))
        sizes.append(n)
    pooled = np.average(covariances, axis=0, weights=sizes)
    target = np.diag(np.diag(pooled)) + ridge * np.eye(p)
    factors, constants = [], []
    for covariance, n in zip(covariances, sizes, strict=True):
        lower = np.linalg.cholesky((1 - shrinkage) * covariance + shrinkage * target)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(n / sum(sizes)) - np.log(np.diag(lower)).sum())
    return Discriminant(np.array(means), np.array(factors), np.array(constants))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")), F.lit(0)) % 4 == 2


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    shrinkage: float = 0.1,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id (unless kept), the ``keep`` columns, held_out, score, predicted of every row.

    Labels are learnt from the rows that are not held out, by id; labels other
    than 0 and 1, or of unknown ids, are not used. Neither labels nor ids enter a
    score. A null text counts as empty; repeated rows are scored row by row and
    labels of a repeated id count for each of its rows. Without two labelled rows
    of both classes every score is 0.5. Empty tables give an empty result; columns
    other than the named ones are not read.
    """
    facts = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        *[F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(keep)],
        statistics(text_of(text_col)).alias("x"),
    )
    # whole texts are kept as compressed files
    facts = stored(facts) if keep else settled(facts)
    known = labels.select(
        F.col(f"`{id_col}`").alias("k"), F.col(f"`{label_col}`").cast("int").alias("label")
    ).filter(F.col("label").isin(0, 1) & ~held_out(F.col("k")))
    model = fit(facts.join(known, F.col("id") == F.col("k")).select("x", "label"), shrinkage)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

    python_ready(docs.sparkSession, 10_000)
    scored = facts.select(
        *([] if id_col in keep else [F.col("id").alias(id_col)]),
        *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)],
        held_out(F.col("id")).alias("held_out"),
        (F.lit(0.5) if model is None else score("x")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
