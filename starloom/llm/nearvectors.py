"""Embedding near-duplicates by spherical-cap filters.

Filter directions are the words of a product code: a unit vector is cut into
blocks (after a random rotation), each block has a list of random directions,
and every combination of one direction per block is a filter. A vector passes
the filters whose direction it exceeds by a threshold; list decoding finds them
from the sorted scores of the blocks, without looking at the other
combinations. Vectors that share a filter are compared in double precision.

The code grows with the number of vectors, so filters stay sparse; a crowded
filter is cut into blocks whose pairs are compared apart. A pair that shares
several filters counts at the smallest of them, so links are never counted
twice and pairs are not written out: a block gives, per vector, its number of
links and one edge to the smallest vector it hangs on. Equal vectors are one
vector with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import settled, python_ready
from starloom.llm.components import by_group, components


#: Rows of a filter up to which it is compared together with others.
_SHORT = 24


@lru_cache(maxsize=8)
def product_code(dim: int, size: int, seed: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """A rotation, and ``size`` unit directions for each half of the dimensions."""
    rng = np.random.default_rng([seed, dim, size])
    rotation, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    halves = []
    for width in (dim // 2, dim - dim // 2):
        code = rng.standard_normal((size, max(width, 1)))[:, :width]
        halves.append(code / np.maximum(np.linalg.norm(code, axis=1, keepdims=True), 1e-300))
    return rotation, (halves[0], halves[1])


def decode(vectors: np.ndarray, size: int, cap: float, floor: int, seed: int) -> list[np.ndarray]:
    """For each unit vector the sorted numbers of the filters with a score of ``cap`` or more.

    A vector that lies badly for the code, with fewer than ``floor`` such filters, gets a
    lower cap: the score of its ``floor``-th best filter. That one lies among the sums of
    the i-th and j-th best block scores with i * j <= floor.
    """
    rotation, (first, second) = product_code(vectors.shape[1], size, seed)
    turned = vectors @ rotation
    half = first.shape[1]
    a = turned[:, :half] @ first.T / math.sqrt(2)
    b = turned[:, half:] @ second.T / math.sqrt(2)
    floor = min(floor, size * size)
    pairs = [(i, j) for i in range(min(floor, size)) for j in range(min(floor // (i + 1), size))]
    left_best, right_best = (np.array(side) for side in zip(*pairs, strict=True))
    order = np.argsort(-b, axis=1)
    found = []
    for k in range(len(vectors)):
        best = b[k, order[k]]
        top = -np.partition(-a[k], min(floor, size) - 1)[: min(floor, size)]
        sums = -np.sort(-top)[left_best] + best[right_best]
        own = min(cap, -np.partition(-sums, floor - 1)[floor - 1])
        left = np.flatnonzero(a[k] >= own - best[0])
        counts = np.searchsorted(-best, a[k, left] - own, side="right")
        total = int(counts.sum())
        place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        found.append(np.sort(np.repeat(left, counts).astype(np.int64) * size + order[k, place]))
    return found


def _unit(raw: list[np.ndarray]) -> np.ndarray:
    x = np.array(raw, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _roots(links: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each position of a symmetric link matrix."""
    n = len(links)
    label = np.arange(n)
    near = [np.flatnonzero(row) for row in links]
    while True:
        new = np.array([min(label[k], label[near[k]].min()) if len(near[k]) else label[k] for k in range(n)])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links_of_block(
    own: int, x: np.ndarray, passed: list[np.ndarray], first: np.ndarray, second: np.ndarray, least: float
) -> np.ndarray:
    """Symmetric matrix of the links that this filter and this pair of blocks count."""
    close = x @ x.T >= least
    np.fill_diagonal(close, False)
    # a pair of two blocks belongs to one vector of each; within one block both sides are all
    close &= (first[:, None] & second[None, :]) | (second[:, None] & first[None, :])
    busy = np.flatnonzero(close.any(axis=1))
    if not len(busy):
        return close
    lower = [p[: np.searchsorted(p, own)] for p in (passed[k] for k in busy)]
    names = np.unique(np.concatenate(lower)) if len(lower) else np.zeros(0)
    if len(names):
        table = np.zeros((len(busy), len(names)), dtype=np.float32)
        for row, p in enumerate(lower):
            table[row, np.searchsorted(names, p)] = 1
        earlier = (table @ table.T) > 0
        close[np.ix_(busy, busy)] &= ~earlier
    return close


def _with_links(x: np.ndarray, first: np.ndarray, least: float) -> np.ndarray:
    """For each run of rows, which ``first`` begins, whether two of its unit vectors are ``least`` close or more.

    Most runs are short and hold no such pair: rows are compared with the one that stands
    k places on, for all runs at once.
    """
    sizes = np.diff(np.append(first, len(x)))
    run = np.repeat(np.arange(len(first)), sizes)
    close = np.zeros(len(first), dtype=bool)
    for k in range(1, int(sizes[sizes <= _SHORT].max(initial=0))):
        left = np.flatnonzero((run[:-k] == run[k:]) & (sizes[run[:-k]] <= _SHORT))
        near = np.einsum("ij,ij->i", x[left], x[left + k]) >= least
        close[run[left[near]]] = True
    for r in np.flatnonzero(sizes > _SHORT):
        part = x[first[r] : first[r] + sizes[r]]
        products = part @ part.T
        np.fill_diagonal(products, -2.0)
        close[r] = bool((products >= least).any())
    return close


def link_vectors(
    vectors: DataFrame,
    least: float = 0.9,
    filters_per_vector: float = 24,
    filters_per_doubling: float = 2.2,
    filters_per_row: float = 64,
    block: int = 512,
    seed: int = 7,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Links are cosines of ``least`` or more among pairs that share a filter; none
    is below it. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do vectors of different lengths. Equal
    vectors link with each other. A repeated id is a vector per row. A null id
    links with nothing and is its own component (null). An empty table gives an
    empty result; other columns are not read.

    Pairs right at a cosine of 0.9 share a filter with a chance of about 0.97,
    pairs at 0.95 of 0.99 (64 dimensions, see the tests).
    """
    python_ready(vectors.sparkSession)
    # single-precision entries travel as such, and are compared in double precision
    width = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    source = vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast(f"array<{width}>").alias("v")
    )
    sound = (
        F.col("id").isNotNull()
        & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    rows = source.select("id", F.when(sound, F.transform("v", lambda x: x + F.lit(0.0).cast(width))).alias("v"))
    valid = rows.filter(F.col("v").isNotNull())
    classes = settled(
        valid.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    )
    count = classes.count()
    size = max(16, math.ceil(math.sqrt(filters_per_row * max(count, 1))))
    # a larger code has higher caps, under which fewer filters are shared: more filters make up for it
    floor = math.ceil(filters_per_doubling * math.log2(max(count, 2)))
    tail = min(0.5, filters_per_vector / size**2)
    z = NormalDist().inv_cdf(1 - tail)
    number = "int" if size**2 < 1 << 31 else "bigint"

    def cap_of(dim: int) -> float:
        # P(<x, c> > t) on the sphere falls as (1 - t^2)^((d-1)/2): equal to the normal tail at z
        return math.sqrt(max(0.0, 1 - math.exp(-z * z / max(dim - 1, 1))))

    def passes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["v"].map(len)
            for dim in sorted(lengths.unique()):
                part = batch[lengths == dim]
                found = decode(_unit(list(part["v"])), size, cap_of(dim), floor, seed)
                yield pd.DataFrame(
                    {
                        "cls": part["cls"].to_numpy(),
                        "rep": part["rep"].to_numpy(),
                        "weight": part["weight"].to_numpy(),
                        "dim": np.full(len(part), dim, dtype="int32"),
                        "v": list(part["v"]),
                        "passed": found,
                    }
                )

    kind = dict(source.dtypes)["id"]
    decoded = settled(
        classes.withColumn("cls", F.monotonically_increasing_id()).mapInPandas(
            passes, f"cls long, rep {kind}, weight long, dim int, v array<{width}>, passed array<{number}>"
        )
    )
    crowds = settled(
        decoded.select("dim", F.explode("passed").alias("f"))
        .groupBy("dim", "f")
        .agg(F.count("*").alias("members"))
        .filter("members > 1")
        .select(
            F.col("dim").alias("d"), F.col("f").alias("g"), F.ceil(F.col("members") / block).cast("int").alias("blocks")
        )
    )
    # which filters of a vector have other members is found by numbers alone; then vectors travel once to
    # meet that list, and once to each filter on it
    shared = (
        decoded.select("cls", "dim", F.explode("passed").alias("f"))
        .join(crowds, (F.col("dim") == F.col("d")) & (F.col("f") == F.col("g")))
        .groupBy("cls")
        .agg(F.collect_list(F.struct("f", "blocks")).alias("filters"))
    )
    members = decoded.join(shared.withColumnRenamed("cls", "of"), F.col("cls") == F.col("of")).select(
        *[c for c in decoded.columns if c != "cls"], F.explode("filters").alias("filter")
    ).select("*", "filter.f", "filter.blocks")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = members.withColumn("mine", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    dealt = dealt.select(
        "dim", "f", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
        "mine", "rep", "weight", "v", "passed",
    )
    keys = ["dim", "f", "lo", "hi"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in by_group(batches, keys, 4_000):
            out: list[tuple] = []
            names = [frame[k].to_numpy() for k in keys]
            reps, weights, mine = (frame[c].to_numpy() for c in ("rep", "weight", "mine"))
            new = np.concatenate([[True], np.any([n[1:] != n[:-1] for n in names], axis=0)])
            for dim in np.unique(names[0]):
                own = np.flatnonzero(names[0] == dim)  # sorted by it: one stretch of the frame
                x = _unit(list(frame["v"].iloc[own[0] : own[-1] + 1]))
                first = np.flatnonzero(new[own])
                # a little lower, as sums in another order may differ in the last digit
                close = _with_links(x, first, least - 1e-9)
                ends = np.append(first[1:], len(own))
                for a, b in zip(first[close], ends[close], strict=True):
                    at = own[a:b]
                    f, lo, hi = (n[at[0]] for n in names[1:])
                    links = _links_of_block(
                        f, x[a:b], [frame["passed"].iat[k] for k in at], mine[at] == lo, mine[at] == hi, least
                    )
                    busy = np.flatnonzero(links.any(axis=1))
                    if not len(busy):
                        continue
                    busy = busy[np.argsort(reps[at][busy], kind="stable")]
                    part = links[np.ix_(busy, busy)]
                    roots = _roots(part)
                    sums = part @ weights[at][busy]
                    out += zip(reps[at][busy], sums, reps[at][busy][roots], strict=True)
            if out:
                yield pd.DataFrame(out, columns=["a", "links", "b"])

    found = settled(
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInPandas(compare, f"a {kind}, links long, b {kind}")
    )
    linked = found.groupBy("a").agg(F.sum("links").alias("links"))
    labels = components(found.select("a", "b"))
    facts = settled(
        classes.join(linked, F.col("rep") == F.col("a"), "left")
        .join(labels, F.col("rep") == F.col("id"), "left")
        .select(
            F.col("v").alias("w"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    done = rows.join(facts, F.col("v") == F.col("w"), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return done.withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))
    )
