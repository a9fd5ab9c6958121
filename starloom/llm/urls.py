"""URL filter: domain rules first, then logistic regression on hashed character n-grams.

Host and path are cut into runs of three to five bytes, each hashed into one of
``2 ** bits`` weights; host and path hash apart. The model is fitted on a small
labelled table of URLs, by Newton-free gradient descent with L2 on the driver,
at most ``max_labelled`` rows: that bound is checked. URLs are judged in Arrow
batches with the weights, whose size is fixed by ``bits``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import lower_ascii, python_ready

#: Verdict by rule, written "host/path" (fixed values).
RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}
_GRAMS = (3, 4, 5)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.substring(text, at + 3, F.length(text))
    return F.when(at > 0, lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise("")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.substring(text, at + 3, F.length(text))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, slash, start = rule.partition("/")
        fits = (host == domain) | host.endswith("." + domain)
        chosen = F.when(fits & path.startswith(slash + start), F.lit(rule)).otherwise(chosen)
    return chosen


def _codes(values: list[bytes], salt: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of every value."""
    lengths = np.fromiter(map(len, values), dtype=np.int64, count=len(values))
    data = np.frombuffer(b"".join(values), dtype=np.uint8).astype(np.uint64)
    row = np.repeat(np.arange(len(values)), lengths)
    rows, buckets = [], []
    for n in _GRAMS:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, salt * 31 + n, dtype=np.uint64)
        for k in range(n):
            code = (code ^ data[k : len(data) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        inside = row[: len(code)] == row[n - 1 :]
        rows.append(row[: len(code)][inside])
        buckets.append((code[inside] >> np.uint64(64 - bits)).astype(np.int64))
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(rows), np.concatenate(buckets)


def _features(hosts: list[str], paths: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value): counts scaled so that a row's squares sum to about 1."""
    a = _codes([b"^" + h.encode() + b"$" for h in hosts], 1, bits)
    b = _codes([p.encode() + b"$" if p else b"" for p in paths], 2, bits)
    row, bucket = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    size = np.bincount(row, minlength=len(hosts)).astype(float)
    return row, bucket, 1 / np.sqrt(size[row])


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float
    bits: int

    def score(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability of "block"."""
        row, bucket, value = _features(hosts, paths, self.bits)
        z = np.bincount(row, weights=self.weights[bucket] * value, minlength=len(hosts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(
    labelled: DataFrame,
    bits: int = 16,
    l2: float = 1e-4,
    steps: int = 400,
    max_labelled: int = 20_000,
) -> UrlModel:
    """Fit on (url string, blocked boolean). Rows with a null in either are left out.

    More than ``max_labelled`` rows, or only one class, are errors. Rows are
    sorted first, so the fit does not depend on their order; repeated rows count
    as often as they occur.
    """
    usable = labelled.select("url", F.col("blocked").cast("boolean").alias("blocked")).dropna()
    rows = (
        usable.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "blocked")
        .limit(max_labelled + 1)
        .toPandas()
        .sort_values(["host", "path", "blocked"])
    )
    if len(rows) > max_labelled:
        raise ValueError(f"more than {max_labelled} labelled urls")
    y = rows["blocked"].to_numpy(dtype=float)
    if not 0 < y.sum() < len(y):
        raise ValueError("labelled urls of both kinds are needed")
    row, bucket, value = _features(list(rows["host"]), list(rows["path"]), bits)
    w, b = np.zeros(1 << bits), 0.0
    velocity, pull = np.zeros_like(w), 0.0
    for _ in range(steps):
        z = np.bincount(row, weights=w[bucket] * value, minlength=len(y)) + b
        error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
        gradient = np.bincount(bucket, weights=error[row] * value, minlength=len(w)) / len(y) + l2 * w
        velocity, pull = 0.9 * velocity - 4.0 * gradient, 0.9 * pull - 4.0 * error.mean()
        w, b = w + velocity, b + pull
    return UrlModel(w.astype(np.float32), float(b), bits)


#: The small labelled table: URLs, each written out by hand, with "blocked" or "allowed" before a tab.
LABELLED = Path(__file__).with_name("labelled_urls.tsv")


def seed_urls(spark: SparkSession, path: Path = LABELLED) -> DataFrame:
    """The default labelled table (url, blocked): some hundred distinct URLs of many kinds of hosts and paths."""
    rows = [line.split("\t") for line in path.read_text(encoding="utf-8").splitlines() if line]
    return spark.createDataFrame([(url, label == "blocked") for label, url in rows], "url string, blocked boolean")


def judge_urls(
    pages: DataFrame,
    model: UrlModel,
    rules: dict[str, str] = RULES,
    threshold: float = 0.5,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row.

    verdict is the rule's where one fits, else "block" from ``threshold`` on. A
    null url, or one without ``://``, has an empty host and path: no rule fits
    and the model judges the empty strings. Repeated rows are judged row by row,
    an empty table gives an empty result; other columns are not read.
    """

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for host, path in parts:
            yield pd.Series(model.score(list(host), list(path)))

    python_ready(pages.sparkSession, 10_000)
    read = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        host_of(F.col(f"`{url_col}`")).alias("host"),
        path_of(F.col(f"`{url_col}`")).alias("path"),
    )
    scored = read.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "score", score("host", "path")
    )
    by_rule = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    by_model = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    verdict = F.when(F.col("rule").isNotNull(), by_rule[F.col("rule")]).otherwise(by_model)
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
