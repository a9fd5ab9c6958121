"""Mix sources to target weights by capped water-filling.

Each source is to give words in proportion to its weight, but at most
``max_epochs`` times its own words. What a clamped source cannot give is shared
out among the others by weight until none is above its cap. Repeating that
ends at one water level, which a running sum over the sources finds directly:
in order of cap per weight, the clamped sources are a prefix. The running sums go over
ranges of sources, so their number has no bound.

A target of 2.3 epochs is two whole repetitions of every document and a seeded
0.3 of one: documents are taken whole in the order of a seeded hash until the
remaining words are reached; the document at the limit is cut there.

Everything is DataFrame code. The order within a source is never sorted as a
whole: sums by hash prefix find the prefix that holds the limit, twice, and
only the documents under that prefix are ordered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import settled, text_of, word_count

#: Hex digits that tell the documents of a source apart, step by step.
_PREFIXES = (2, 5)


#: Sources up to which their plan, a row of numbers for each, is broadcast; beyond, Spark joins as it sees fit.
BROADCAST_SOURCES = 100_000


def _running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """For each name of ``sums`` its sum over all earlier rows (``name_before``) and over all rows (``name_all``).

    Rows are put into ranges and summed inside them; only one row per range meets the others.
    """
    ranged = settled(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    )
    per_range = ranged.groupBy("range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "range",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_offset") for n in sums],
        *[F.sum(n).over(Window.partitionBy()).alias(f"{n}_all") for n in sums],
    )
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: bounded by the number of partitions
    joined = ranged.join(F.broadcast(offsets), "range")
    return joined.withColumns(
        {f"{n}_before": F.col(f"{n}_offset") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()}
    ).drop("range", *[f"{n}_offset" for n in sums])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """Target words of each source; input and output hold one row per source.

    sizes: source, source_size. Weights go to the sources in code-point order,
    null last, and repeat. The targets sum to the sum of all sizes. There may be any number of
    sources. An empty table gives an empty result; sources without words get 0.
    """
    if not weights or any(not isinstance(w, int) or w < 1 for w in weights):
        raise ValueError("weights must be positive whole numbers")
    common = math.lcm(*weights)
    by_name = F.col("source").asc_nulls_last()
    named = _running(sizes.select("source", "source_size"), [by_name], {"place": F.lit(1).cast("long")})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place_before") % len(weights) + 1).cast("int"))
    weighed = named.select(
        "source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * max_epochs).alias("cap")
    )
    by_level = F.col("source_size") * F.lit(common) / F.col("weight")
    filled = _running(
        weighed,
        [by_level.asc(), by_name],
        {"cap": F.col("cap"), "weight": F.col("weight"), "words": F.col("source_size")},
    ).withColumns(
        {"left": F.col("words_all") - F.col("cap_before"), "weights_left": F.col("weight_all") - F.col("weight_before")}
    )
    filled = settled(filled.select("source", "source_size", "weight", "cap", "left", "weights_left"))
    fits = (
        F.col("left").cast("double") * F.col("weight")
        <= F.col("cap").cast("double") * F.col("weights_left")
    )
    # the first source that is not clamped has the most weight left
    first = F.max(F.when(fits, F.struct(F.col("weights_left").alias("w"), F.col("left").alias("words"))))
    level = filled.agg(first.alias("level")).scalar()
    share = level["words"].cast("double") * F.col("weight") / level["w"].cast("double")
    return filled.select(
        "source",
        "source_size",
        "weight",
        F.least(F.col("cap").cast("double"), F.coalesce(share, F.col("cap").cast("double"))).alias("target"),
    )


def _limit(sized: DataFrame, plan: DataFrame, seed_order: Column) -> DataFrame:
    """One step: the first hash group of each source whose running size passes the quota.

    plan: source, quota, under (words before the group looked at), prefix (of that group).
    """
    groups = sized.groupBy("source", seed_order.alias("at")).agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("at")
    running = groups.withColumn("through", F.sum("words").over(order))
    asked = plan.withColumnRenamed("source", "s")
    joined = running.join(asked, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    passed = joined.filter(F.col("under") + F.col("through") > F.col("quota"))
    first = passed.groupBy("source").agg(
        F.min(F.struct("at", "words", "through", "quota", "under")).alias("f")
    )
    return first.select(
        "source",
        F.col("f.quota").alias("quota"),
        (F.col("f.under") + F.col("f.through") - F.col("f.words")).alias("under"),
        F.col("f.at").alias("at"),
        F.col("f.words").alias("words"),
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    max_epochs: int = 3,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns id, the ``keep`` columns, source, size, source_size, target (its
    source's), copies (whole repetitions), part (words of one more repetition)
    and taken = copies * size + part. Taken words of a source are its target
    to within one word per row at the limit; ``taken`` <= max_epochs * size.

    Nulls: a null text has no words, a null source is a source of its own, a
    null id is an id like any other. Repeated rows each count and share the
    limit evenly. Empty tables give an empty result. Only the named columns
    are read; an output name replaces an input column of that name.
    """
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))))
    sized = settled(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").alias("source"),
            word_count(text_of(text_col)).alias("size"),
            key.alias("h"),
        )
    )
    sizes = (
        sized.groupBy("source", F.substring("h", 1, _PREFIXES[0]).alias("at"))
        .agg(F.sum("size").alias("words"))
        .groupBy("source")
        .agg(F.sum("words").alias("source_size"))
    )
    targets = source_targets(sizes, weights, max_epochs)
    goal = F.floor(F.col("target") + 0.5).cast("long")
    some = F.when(F.col("source_size") > 0, F.col("source_size"))
    plan = settled(
        targets.withColumn("copies", F.coalesce(F.floor(goal / some), F.lit(0)).cast("long"))
        .withColumn("quota", F.coalesce(goal - F.col("copies") * F.col("source_size"), F.lit(0)))
    )
    small = plan.count() <= BROADCAST_SOURCES
    per_source = F.broadcast if small else lambda rows: rows
    # the limit of the last, partial repetition: among few prefixes, then under one, then exactly
    open_ = plan.filter("quota > 0").select("source", "quota", F.lit(0).cast("long").alias("under"))
    rows = sized
    for digits in _PREFIXES:
        found = _limit(rows, open_, F.substring("h", 1, digits))
        rows = rows.join(
            per_source(found.select(F.col("source").alias("s"), F.col("at").alias("p"))),
            F.col("source").eqNullSafe(F.col("s")) & (F.substring("h", 1, digits) == F.col("p")),
        ).drop("s", "p")
        open_ = found.select("source", "quota", "under")
    last = _limit(rows, open_, F.col("h")).select(
        F.col("source").alias("s"),
        F.col("at").alias("limit"),
        (F.col("quota") - F.col("under")).alias("rest"),
        F.col("words").alias("limit_words"),
    )
    plan = plan.join(last, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "weight")
    plan = plan.withColumnRenamed("source", "s")
    plan = settled(plan.coalesce(1) if small else plan)
    part = (
        F.when(F.col("limit").isNull() | (F.col("h") > F.col("limit")), F.lit(0))
        .when(F.col("h") < F.col("limit"), F.col("size"))
        .otherwise(F.floor(F.col("size") * F.col("rest") / F.col("limit_words")))
        .cast("long")
    )
    if keep:
        read = docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").alias("source"),
            word_count(text_of(text_col)).alias("size"),
            key.alias("h"),
            *[F.col(f"`{c}`").alias(f"kept {i}") for i, c in enumerate(keep)],
        )
    else:
        read = sized
    return (
        read.join(per_source(plan), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("part", part)
        .select(
            F.col("id").alias(id_col),
            *[F.col(f"`kept {i}`").alias(c) for i, c in enumerate(keep)],
            F.col("source").alias(source_col) if source_col not in keep else F.col("source").alias("source"),
            "size",
            "source_size",
            "target",
            "copies",
            "part",
            (F.col("copies") * F.col("size") + F.col("part")).alias("taken"),
        )
    )


def first_words(text: Column, count: Column) -> Column:
    """The text up to the end of its count-th word; the blanks in between stay."""
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(pieces, 1, count.cast("int")), "")


def mixed_documents(docs: DataFrame, text_col: str = "text", **options: object) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of docs.

    The document at a source's limit appears once more with its first ``part``
    words. Documents that are not taken at all do not appear. Same rules for
    nulls, ties and empty tables as :func:`mix_sources`; a document without
    words appears ``copies`` times.
    """
    columns = docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col(f"`{options.get('id_col', 'doc_id')}`").alias("id"),
        F.col(f"`{options.get('source_col', 'source')}`").alias("source"),
        F.col(f"`{text_col}`").alias("text"),
    )
    named = {k: v for k, v in options.items() if k not in ("id_col", "source_col")}
    mixed = mix_sources(packed, id_col="id", source_col="source", text_col="text", keep=("row",), **named)
    times = F.flatten(
        F.array(
            F.array_repeat(F.lit(-1).cast("long"), F.col("copies").cast("int")),
            F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<bigint>")),
        )
    )
    taken = mixed.select("row", "size", F.explode(times).alias("words"))
    whole = (F.col("words") < 0) | (F.col("words") >= F.col("size"))
    cut = F.when(whole, F.col(f"row.`{text_col}`")).otherwise(
        first_words(F.col(f"row.`{text_col}`"), F.col("words"))
    )
    return taken.select(
        *[(cut if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in columns]
    )
