"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document is its set of distinct word shingles. Its MinHash values are written
into several signature orders (trees), each a short run of values. Every tree is
sorted as a whole, over ranges; neighbours in this order have the longest common prefixes.
Candidates are neighbours whose common prefix reaches the depth of their region. The depth
adapts: four values where few documents share them, five or six where many do.
Neighbours whose whole signatures do not allow a link are dropped.

Candidates are then confirmed on full sets, recomputed from the texts, for each
document those with the most equal values. That is enough where these links hold. Where a
cluster of candidates falls apart on confirmation, all its pairs across the parts that could reach the
threshold are confirmed too, so no link is lost to that choice. Crowded
clusters are cut into blocks, so no task holds a whole group. Equal
sets are one class with a number of its own, signature and text are those of one
of its rows, and only classes are paired; ids come back in at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import python_ready, settled, stored, text_of
from starloom.llm.components import by_group, components

_TREES = 20
#: Common prefixes that make candidates, from the shallowest; each tree has this many values at most.
_DEPTHS = (4, 5, 6)
_VALUES = _TREES * _DEPTHS[-1]
#: How far apart neighbours stand at most in a short region, and in one of more than ``_LONG`` documents.
_NEAR, _NEXT, _LONG = 8, 2, 64
#: Candidates of a document that are confirmed first: those with the most equal values.
_BEST = 3
#: Rows of a signature order that are held at a time.
_STRETCH = 20_000
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_FACTORS = _mixed(np.arange(1, 2 * _VALUES + 65, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; A-Z lower-cased, words split at blanks.

    A text with fewer words than ``width`` has its whole sequence as the one
    shingle; one without words has none.
    """
    words = [t.encode().lower().split() for t in texts]
    counts = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(counts)
    flat = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for found in words for w in found), dtype=np.uint64, count=int(counts.sum())
    )
    code = np.zeros(max(len(flat) - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        code += flat[k : k + len(code)] * _FACTORS[k]
    code = _mixed(code)
    sets = []
    for n, end in zip(counts, ends, strict=True):
        if n >= width:
            sets.append(np.unique(code[end - n : end - width + 1]))
        elif n:
            whole = (flat[end - n : end] * _FACTORS[16 : 16 + n]).sum(keepdims=True) + _U(n)
            sets.append(_mixed(whole))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (uint32) of non-empty sets, one row each."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), _VALUES), dtype=np.uint32)
    step = 1 << 15
    if len(flat) <= step:
        for k in range(_VALUES):
            h = (flat * _FACTORS[2 * k + 32] + _FACTORS[2 * k + 33]) >> _U(32)
            out[:, k] = np.minimum.reduceat(h, starts)
        return out
    if len(sets) > 1:  # in halves, so that the numbers stay in the cache
        middle = len(sets) // 2
        return np.concatenate([signatures(sets[:middle]), signatures(sets[middle:])])
    for k in range(_VALUES):
        lowest = min(
            int(((flat[at : at + step] * _FACTORS[2 * k + 32] + _FACTORS[2 * k + 33]) >> _U(32)).min())
            for at in range(0, len(flat), step)
        )
        out[0, k] = lowest
    return out


def _orders(values: np.ndarray) -> list[list[bytes]]:
    """Every tree's values of each row, as bytes that sort like the values."""
    width = _DEPTHS[-1]
    laid = values.astype(">u4")
    return [[row[t * width : (t + 1) * width].tobytes() for t in range(_TREES)] for row in laid]


def _neighbours(
    tree: np.ndarray, order: np.ndarray, known: int, crowded: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of neighbours with a common prefix of their region's depth, in sorted rows of trees.

    Pairs within the first ``known`` rows were told before.
    """
    count = len(tree)
    if count < 2:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    equal = (order[1:] == order[:-1]) & (tree[1:] == tree[:-1])[:, None]
    common = np.cumprod(equal, axis=1).sum(axis=1)

    def members(depth: int) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(common < depth)])
        return np.bincount(run)[run]

    depth, size = np.full(count, _DEPTHS[-1]), members(_DEPTHS[-1])
    for shallower in reversed(_DEPTHS[:-1]):
        found = members(shallower)
        lowered = found <= crowded
        depth[lowered], size[lowered] = shallower, found[lowered]
    left, right = [], []
    shared = common
    for k in range(1, min(_NEAR, count - 1) + 1):
        if k > 1:
            shared = np.minimum(shared[:-1], common[k - 1 :])
        at = np.flatnonzero(shared >= depth[: count - k])
        at = at[(at + k >= known) & ((k <= _NEXT) | (size[at] <= _LONG))]
        left.append(at)
        right.append(at + k)
    return np.concatenate(left), np.concatenate(right)


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, None, :] == b[None, :, :]).sum(axis=2, dtype=np.int32)


def _blocked(df: DataFrame, id_name: str, blocks: str) -> DataFrame:
    """Each row once for every pair of blocks that its block is part of: columns lo, hi."""
    mine = F.pmod(F.xxhash64(id_name), F.col(blocks)).cast("int")
    return (
        df.withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
        .withColumn("lo", F.least("mine", "other"))
        .withColumn("hi", F.greatest("mine", "other"))
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct()


def _candidates(reps: DataFrame, least: int, crowded: int) -> DataFrame:
    """Neighbours (a, b, agree) of all signature orders whose signatures agree in ``least`` values or more."""
    spark = reps.sparkSession
    keys = ["tree", "order", "rep"]
    rows = reps.select("rep", F.posexplode("orders").alias("tree", "order")).select(*keys)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        held: list[pd.DataFrame] = []
        known = 0

        def told(frame: pd.DataFrame) -> pd.DataFrame:
            order = np.frombuffer(b"".join(frame["order"]), dtype=">u4").reshape(len(frame), -1)
            left, right = _neighbours(frame["tree"].to_numpy(), order, known, crowded)
            rep = frame["rep"].to_numpy()
            a, b = np.minimum(rep[left], rep[right]), np.maximum(rep[left], rep[right])
            return pd.DataFrame({"a": a, "b": b, "part": -1, "tree": -1, "order": b""})

        def end(frame: pd.DataFrame, last: int) -> pd.DataFrame:
            row = frame.iloc[-1 if last else 0]
            return pd.DataFrame({"a": [row["rep"]], "b": [last], "part": [part], "tree": [row["tree"]], "order": [row["order"]]})

        for batch in batches:
            if batch.empty:
                continue
            if not held:
                yield end(batch, 0)
            held.append(batch)
            if sum(map(len, held)) >= _STRETCH:
                frame = pd.concat(held, ignore_index=True)
                yield told(frame)
                held, known = [frame.iloc[-_NEAR:]], _NEAR
        if held:
            frame = pd.concat(held, ignore_index=True)
            if len(frame) > 1:
                yield told(frame)
            yield end(frame, 1)

    walked = settled(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .mapInPandas(walk, "a long, b long, part int, tree int, order binary")
    )
    # the ends of each range: two rows per partition, where neighbours may stand in two of them
    ends = sorted(walked.filter("part >= 0").collect(), key=lambda r: (r["part"], r["b"]))
    least_common = 4 * _DEPTHS[0]
    over = [
        (min(x["a"], y["a"]), max(x["a"], y["a"]))
        for x, y in zip(ends[1::2], ends[2::2], strict=False)
        if x["tree"] == y["tree"] and x["order"][:least_common] == y["order"][:least_common]
    ]
    pairs = walked.filter("part < 0").select("a", "b").unionByName(spark.createDataFrame(over, "a long, b long")).distinct()

    @F.pandas_udf("int")
    def agreement(x: pd.Series, y: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(m), dtype=np.uint8).reshape(len(x), _VALUES) for m in (x, y))
        return pd.Series((a == b).sum(axis=1), index=x.index, dtype="int32")

    marks = reps.select(F.col("rep").alias("r"), "marks")
    seen = (
        pairs.join(marks, F.col("a") == F.col("r"))
        .select("a", "b", F.col("marks").alias("x"))
        .join(marks, F.col("b") == F.col("r"))
        .select("a", "b", agreement("x", "marks").alias("agree"))
    )
    return settled(seen.filter(F.col("agree") >= least))


def _best_pairs(pairs: DataFrame) -> DataFrame:
    """Of each document's candidates the best few, as pairs; a document has a bounded number of them."""
    sides = pairs.select(F.col("a").alias("v"), F.col("b").alias("w"), "agree").unionByName(
        pairs.select(F.col("b").alias("v"), F.col("a").alias("w"), "agree")
    )
    place = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("agree"), "w"))
    best = sides.withColumn("place", place).filter(F.col("place") <= _BEST)
    return settled(_ordered(best.select(F.col("v").alias("a"), F.col("w").alias("b"))))


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Candidates whose documents are in different parts, as the parts' names (a, b)."""
    own = parts.select(F.col("id").alias("i"), "component")
    left = pairs.join(own, F.col("a") == F.col("i"), "left").select("b", F.coalesce("component", "a").alias("pa"))
    both = left.join(own, F.col("b") == F.col("i"), "left").select("pa", F.coalesce("component", "b").alias("pb"))
    return settled(both.filter("pa != pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct())


def _crossing(
    reps: DataFrame,
    apart: DataFrame,
    parts: DataFrame,
    texts: DataFrame,
    kind: str,
    width: int,
    percent: int,
    least: int,
    block: int,
) -> DataFrame:
    """Links between the parts into which a cluster of candidates fell apart on confirmation.

    Every two documents of different parts whose signatures allow a link are compared on
    full sets, best agreement first, until their parts are linked. The texts meet in
    pairs of blocks; only links leave a task.
    """
    clusters = components(apart).select(F.col("id").alias("p"), F.col("component").alias("cluster"))
    inside = parts.select("id", F.col("component").alias("part"))
    # a document without any link is a part of its own
    alone = clusters.select(F.col("p").alias("id"), F.col("p").alias("part")).join(inside.select("id"), "id", "left_anti")
    named = settled(inside.unionByName(alone).join(clusters, F.col("part") == F.col("p")).select("id", "cluster", "part"))
    broken = settled(
        named.groupBy("cluster")
        .agg(F.count("*").alias("members"))
        .select(F.col("cluster").alias("c"), F.ceil(F.col("members") / block).cast("int").alias("blocks"))
    )
    members = settled(
        named.join(broken, F.col("cluster") == F.col("c"))
        .join(reps.select("rep", "marks"), F.col("id") == F.col("rep"))
        .select("id", "cluster", "part", "marks", "blocks")
    )
    full = members.join(
        texts.select(F.col("id").alias("t"), "text").filter(F.col("text") != ""), F.col("id") == F.col("t")
    )
    keys = ["cluster", "lo", "hi"]
    dealt = _blocked(full, "id", "blocks").select(*keys, "mine", "id", "part", "marks", "text")

    def cross(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in by_group(batches, keys, 400):
            for (_, lo, hi), at in frame.groupby(keys, sort=False).indices.items():
                ids, part, mine = (frame[c].to_numpy()[at] for c in ("id", "part", "mine"))
                if (part == part[0]).all():
                    continue
                sets = shingle_sets(list(frame["text"].iloc[at]), width)
                codes = np.frombuffer(b"".join(frame["marks"].iloc[at]), dtype=np.uint8).reshape(len(at), _VALUES)
                found = _link_parts(
                    part, np.flatnonzero(mine == lo), np.flatnonzero(mine == hi), codes, sets, percent, least
                )
                if found:
                    yield pd.DataFrame([(ids[i], ids[j]) for i, j in found], columns=["a", "b"])

    found = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(cross, f"a {kind}, b {kind}")
    return settled(found)


def _link_parts(
    part: np.ndarray, a: np.ndarray, b: np.ndarray, codes: np.ndarray, sets: list[np.ndarray], percent: int, least: int
) -> list[tuple[int, int]]:
    """Confirmed links between rows ``a`` and ``b`` of different parts; linked parts count as one."""
    root = {p: p for p in part}

    def find(p):
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    left, right, seen = [], [], []
    for start in range(0, len(a), 64):
        some = a[start : start + 64]
        agree = _agreement(codes[some], codes[b])
        i, j = np.nonzero((agree >= least) & (part[some][:, None] != part[b][None, :]))
        left.append(some[i])
        right.append(b[j])
        seen.append(agree[i, j])
    if not left:
        return []
    left, right = np.concatenate(left), np.concatenate(right)
    order = np.argsort(-np.concatenate(seen), kind="stable")
    found = []
    for i, j in zip(left[order], right[order], strict=True):
        p, q = find(part[i]), find(part[j])
        if p != q and _similar(sets[i], sets[j], percent):
            root[p] = q
            found.append((i, j))
    return found


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * common >= percent * united, for sorted sets."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(
    pairs: DataFrame, texts: DataFrame, kind: str, width: int, percent: int, salt_rows: int
) -> DataFrame:
    """The pairs whose full sets reach the threshold.

    Pairs are dealt out by their first document, and a text goes where its pairs are: a
    document has a bounded number of them, so it is copied as often at most.
    """
    buckets = max(1, -(-pairs.count() // salt_rows))
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(buckets)))
    wanted = dealt.select("salt", F.explode(F.array("a", "b")).alias("want")).distinct()
    keyed = texts.join(wanted, F.col("id") == F.col("want")).select(
        "salt", F.col("id").alias("a"), F.col("id").alias("b"), "text"
    )
    asked = dealt.select("salt", "a", "b", F.lit(None).cast("string").alias("text"))
    keys = ["salt"]

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in by_group(batches, keys, 400):
            text = frame["text"].notna().to_numpy()
            for at in frame.groupby(keys, sort=False).indices.values():
                has = at[text[at]]
                ids = frame["a"].to_numpy()[has]
                sets = dict(zip(ids, shingle_sets(list(frame["text"].iloc[has]), width), strict=True))
                ask = at[~text[at]]
                kept = []
                for a, b in zip(frame["a"].to_numpy()[ask], frame["b"].to_numpy()[ask], strict=True):
                    if _similar(sets[a], sets[b], percent):
                        kept.append((a, b))
                if kept:
                    yield pd.DataFrame(kept, columns=["a", "b"])

    rows = keyed.unionByName(asked).repartition(*keys).sortWithinPartitions(*keys)
    return settled(rows.mapInPandas(confirm, f"a {kind}, b {kind}"))


def _row_key(id_: Column, text: Column) -> Column:
    """Equal for rows of one id (or no id) and one text."""
    return F.concat(F.md5(text), F.lit(":"), F.coalesce(id_.cast("string"), F.lit("null")))


def _grouped(
    source: DataFrame, width: int, percent: int, crowded: int, block: int, salt_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Facts of every row of source (id, text, key), and the component of every set.

    Facts: id, n, digest. Sets: set (a digest), lowest (struct none, id, key: the first
    row of its component, by id with null last). Ids play no part in linking.
    """
    python_ready(source.sparkSession)
    # agreement of signatures at the threshold, less four standard deviations
    share = percent / 100
    least = int(_VALUES * share - 4 * (_VALUES * share * (1 - share)) ** 0.5)
    kind = dict(source.dtypes)["id"]

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = shingle_sets(list(batch["text"]), width)
            full = [k for k, s in enumerate(sets) if len(s)]
            marks: list[bytes | None] = [None] * len(sets)
            orders: list[list[bytes] | None] = [None] * len(sets)
            digests: list[bytes | None] = [None] * len(sets)
            if full:
                values = signatures([sets[k] for k in full])
                bytes_ = ((values * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
                laid = _orders(values)
                for row, k in enumerate(full):
                    marks[k], orders[k] = bytes_[row].tobytes(), laid[row]
                    digests[k] = xxhash.xxh3_128_digest(sets[k].tobytes())
            yield pd.DataFrame(
                {
                    "id": batch["id"], "key": batch["key"], "n": [len(s) for s in sets],
                    "digest": digests, "marks": marks, "orders": orders,
                }
            )

    # ids travel as text: pandas would turn whole numbers with nulls into doubles
    facts = settled(
        source.withColumn("id", F.col("id").cast("string"))
        .mapInPandas(describe, "id string, key string, n long, digest binary, marks binary, orders array<binary>")
        .withColumn("id", F.col("id").cast(kind))
    )
    first_row = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    classes = settled(
        facts.filter(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min(first_row).alias("row"), F.first("marks").alias("marks"), F.first("orders").alias("orders"))
        .select(F.monotonically_increasing_id().alias("rep"), F.col("digest").alias("set"), "row", "marks", "orders")
    )
    reps = classes.select("rep", "marks", "orders")
    first = _candidates(reps, least, crowded)
    meet = first.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = meet.join(classes, F.col("id") == F.col("rep")).select("rep", F.col("row.key").alias("want"))
    texts = stored(
        source.groupBy("key").agg(F.first("text").alias("text"))
        .join(wanted, F.col("key") == F.col("want"))
        .select(F.col("rep").alias("id"), "text")
    )
    links = _confirmed(_best_pairs(first), texts, "long", width, percent, salt_rows)
    parts = settled(components(links))
    apart = _apart(first, parts)
    if not apart.isEmpty():
        more = _crossing(reps, apart, parts, texts, "long", width, percent, least, block // 2)
        if not more.isEmpty():
            parts = settled(components(links.unionByName(more)))
    placed = settled(
        classes.select("rep", "set", "row")
        .join(parts, F.col("rep") == F.col("id"), "left")
        .select("set", "row", "component")
    )
    lowest = settled(
        placed.filter(F.col("component").isNotNull())
        .groupBy(F.col("component").alias("c"))
        .agg(F.min("row").alias("first"))
    )
    sets = placed.join(lowest, F.col("component") == F.col("c"), "left").select(
        "set", F.coalesce("first", "row").alias("lowest")
    )
    return facts.select("id", "n", "digest"), settled(sets)


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    crowded: int = 2048,
    block: int = 512,
    salt_rows: int = 128,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Linked are documents with 100 * common >= percent * united shingles. Null
    texts and texts without words have no shingles and link with nothing. A
    repeated id is judged row by row: each row has the component of its own text,
    named by the smallest id in it. A null id links with nothing and is kept. Empty tables give an empty result;
    other columns are not read. Ids are whole numbers.

    A signature has 120 values in 20 trees. A pair at the threshold shares no prefix of
    four values in any of them with a chance of 3 in 100,000, of six (crowded regions) with 2 in
    1,000; there, and where others stand between the two, its cluster offers it again.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    kind = dict(source.dtypes)["id"]
    known = source.filter(F.col("id").isNotNull()).withColumn("key", _row_key(F.col("id"), F.col("text")))
    facts, sets = _grouped(known, width, percent, crowded, block, salt_rows)
    linked = facts.join(sets, F.col("digest") == F.col("set"), "left").select(
        "id", "n", F.coalesce("lowest.id", "id").alias("component")
    )
    bare = source.filter(F.col("id").isNull())

    def sizes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([len(s) for s in shingle_sets(list(texts), width)], dtype="int64")

    count = F.pandas_udf(sizes, "long")
    rest = bare.select("id", count("text").alias("n"), F.lit(None).cast(kind).alias("component"))
    return linked.unionByName(rest).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def one_of_each(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    crowded: int = 2048,
    block: int = 512,
    salt_rows: int = 128,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of docs, as they are, with one row left of each group of near-duplicates.

    Groups are those of :func:`near_duplicates`, but rows without an id take part. Left is
    the row with the smallest id (null last); among repeated rows of one id and text the
    first by the other columns, which must have an order. Texts without words link with
    nothing: one row is left for each id, and one for all without an id.
    """
    id_, text = F.col(f"`{id_col}`"), text_of(text_col)
    source = docs.select(id_.alias("id"), text.alias("text"))
    source = source.withColumn("key", _row_key(F.col("id"), F.col("text")))
    _, sets = _grouped(source, width, percent, crowded, block, salt_rows)
    picks = sets.select(F.col("lowest.key").alias("picked key")).distinct()
    worded = text.rlike(r"[^\x20\x09-\x0D]")
    key = F.when(worded, _row_key(id_, text)).otherwise(_row_key(id_, F.lit("")))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    place = F.row_number().over(Window.partitionBy("row key").orderBy(*others, F.col(f"`{text_col}`")))
    rows = docs.withColumn("row key", key).withColumn("row place", place).filter("`row place` = 1")
    return (
        rows.join(picks, F.col("row key") == F.col("picked key"), "left")
        .filter(F.col("picked key").isNotNull() | ~worded)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
