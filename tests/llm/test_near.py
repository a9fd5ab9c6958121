"""Near-duplicate documents and vectors, components and packing, against brute force."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import neardup, nearvectors, packing
from starloom.llm.components import components
from starloom.llm.tokens import load


def roots(vertices, links):
    parent = {v: v for v in vertices}

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in vertices}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(5)
    n = 120
    pairs = {
        "path": [(i, i + 1) for i in range(n - 1)],
        "star": [(n, i) for i in range(n)] + [(i, i) for i in range(3)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(90)],
        "none": [],
    }[shape]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {v for a, b in pairs if a != b for v in (a, b)}
    assert got == roots(linked, [(a, b) for a, b in pairs if a != b])


# ---- documents -------------------------------------------------------------------


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near_texts():
    """Groups around a base: copies near and far from the threshold, a star, a chain, exact copies."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(4000)}"
    texts = ["", None, " \n", "one two", "ONE two", "one two three four", "É a b c d", "é a b c d"]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([12, 60, 150]))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(("\n" if rng.random() < 0.3 else " ").join(copy))
    base = [word() for _ in range(200)]
    texts.append(" ".join(base))
    for k in range(30):  # each near the base, hardly near each other
        copy = list(base)
        for j in (k * 6, k * 6 + 100, k * 6 + 50):
            copy[j % 200] = word()
        texts.append(" ".join(copy))
    chain = [word() for _ in range(100)]
    for k in range(25):
        chain = chain[:]
        chain[(k * 4) % 100] = word()
        texts.append(" ".join(chain))
    texts += ["Same text with several words in it here"] * 40
    return texts


def brute(texts, width):
    sets = [shingles(t, width) for t in texts]
    links = [
        (i, j)
        for i in range(len(texts))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    return sets, roots(range(len(texts)), links)


@pytest.mark.parametrize("width,crowded,block,salt", [(4, 2048, 512, 128), (5, 8, 6, 5)])
def test_near_documents_equal_brute_force(spark, width, crowded, block, salt):
    texts = near_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("id", F.lit("clash"))
    got = neardup.near_duplicates(df, width, crowded=crowded, block=block, salt_rows=salt).collect()
    sets, expected = brute(texts, width)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        i: (len(sets[i]), expected[i], expected[i] == i) for i in range(len(texts))
    }


def test_near_documents_edge_cases(spark):
    df = spark.createDataFrame(
        [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (3, "A b c d e f")], "doc_id long, text string"
    )
    got = sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect())
    assert got == [("1", 1, True), ("1", 1, True), ("3", 1, False), ("None", None, True)]
    assert neardup.near_duplicates(df.limit(0)).collect() == []


def test_near_documents_pair_classes_not_rows(spark, monkeypatch):
    rng = random.Random(11)
    one, two = ([f"w{rng.randrange(4000)}" for _ in range(120)] for _ in range(2))
    near = lambda words: " ".join([*words[:-1], "other"])
    rows = [(1, near(one)), (5, " ".join(one)), (5, " ".join(two)), (9, near(two))]
    rows += [(7, near(one) + " more")] * 300
    seen = []
    candidates = neardup._candidates
    monkeypatch.setattr(neardup, "_candidates", lambda reps, *a: seen.append(reps.count()) or candidates(reps, *a))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert seen == [5]
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [
        (1, 1, True), (5, 1, False), (5, 5, True), *[(7, 1, False)] * 300, (9, 5, False),
    ]


def test_signatures_of_long_sets_equal_those_in_parts():
    values = np.random.default_rng(1).integers(0, 2**63, 70_000).astype(np.uint64)
    long = neardup.signatures([np.unique(values)])[0]
    halves = [neardup.signatures([np.unique(part)])[0] for part in np.array_split(values, 5)]
    assert (long == np.min(halves, axis=0)).all()


# ---- vectors ---------------------------------------------------------------------


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    dim = 24
    vectors = [rng.standard_normal(dim) for _ in range(150)]
    for k in range(15):
        for _ in range(6):
            vectors.append(vectors[k] + 0.08 * rng.standard_normal(dim))
    centre = rng.standard_normal(dim)
    vectors += [centre + 0.1 * rng.standard_normal(dim) for _ in range(60)]
    vectors += [vectors[3] * 2.5, vectors[3], vectors[3], -vectors[4]]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    n = len(rows)
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [1.0, None], [float("inf")] * dim, [1.0, 2.0], [2.0, 4.0]]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit("clash"))
    unit = np.array(vectors)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    expected = roots(range(n), list(zip(*np.nonzero(close), strict=True)))
    for block in (512, 16):
        got = {r["vec_id"]: r for r in nearvectors.link_vectors(df, block=block).collect()}
        found = sum(got[i]["n_links"] for i in range(n))
        assert found >= 0.97 * close.sum()
        for i in range(n):
            assert got[i]["n_links"] <= close[i].sum()
        agree = [got[i]["component_id"] == expected[i] for i in range(n)]
        assert np.mean(agree) >= 0.97
        for i in range(6):
            row = got[n + i]
            assert (row["n_links"], row["component_id"], row["kept"]) == (0, n + i, True)
        assert got[n + 7]["component_id"] == n + 6 and got[n + 6]["n_links"] == 1
    assert nearvectors.link_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("cosine,least", [(0.9, 0.95), (0.95, 0.985)])
def test_chance_of_a_shared_filter(cosine, least):
    import math
    from statistics import NormalDist

    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.standard_normal((600, 64))
    u -= (u * x).sum(axis=1, keepdims=True) * x
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    y = cosine * x + math.sqrt(1 - cosine**2) * u
    rows = 50_000
    size = math.ceil(math.sqrt(64 * rows))
    z = NormalDist().inv_cdf(1 - 24 / size**2)
    cap = math.sqrt(1 - math.exp(-z * z / 63))
    floor = math.ceil(2.2 * math.log2(rows))
    pairs = zip(nearvectors.decode(x, size, cap, floor, 7), nearvectors.decode(y, size, cap, floor, 7), strict=True)
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in pairs]) >= least


def test_decoding_lists_exactly_the_filters_above_the_cap():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((40, 10))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotation, (a, b) = nearvectors.product_code(10, 30, 7)
    turned = x @ rotation
    scores = ((turned[:, :5] @ a.T)[:, :, None] + (turned[:, 5:] @ b.T)[:, None, :]) / np.sqrt(2)
    for row, found in zip(scores.reshape(40, -1), nearvectors.decode(x, 30, 0.6, 5, 7), strict=True):
        cap = min(0.6, np.sort(row)[-5])
        assert set(found) >= set(np.flatnonzero(row >= cap + 1e-9))
        assert set(found) <= set(np.flatnonzero(row >= cap - 1e-9))


# ---- packing ---------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return [*load(PATH).encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("buffer,parts", [(1 << 20, 1), (3000, 3)])
def test_packed_pieces_rebuild_the_documents(spark, buffer, parts):
    rng = random.Random(6)
    words = ["the", "Cat", "naïve", "x<|endoftext|>y", "don't", "123", "漢字", "…", "é", "a b c"]
    texts = ["", None, "  ", "word"] + [
        rng.choice([" ", "\n", "\t "]).join(rng.choice(words) for _ in range(rng.choice([1, 30, 300, 1200, 4000]))) for _ in range(40)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("offset", F.lit("clash"))
    rows = packing.pack_documents(df.repartition(parts), PATH, buffer_tokens=buffer, step_tokens=8192).collect()
    for i, text in enumerate(texts):
        ids = ids_of(text)
        pieces = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in pieces) == np.array(ids, dtype="<u4").tobytes()
        assert [r["start"] for r in pieces] == list(np.cumsum([0, *[r["length"] for r in pieces]])[:-1])
        assert {r["doc_tokens"] for r in pieces} == {len(ids)}
    sequences = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sequences.get(r["sequence_id"], (0, 0))[0]
        sequences[r["sequence_id"]] = (r["offset"] + r["length"], r["sequence_length"])
    for used, size in sequences.values():
        assert used == size <= 2048 and used & (used - 1) == 0
    assert packing.pack_documents(df.limit(0), PATH).collect() == []


def test_windows_are_full_and_cut_little():
    rng = random.Random(7)
    pieces = [(rng.randint(1, 5000), i, 0) for i in range(400)]
    windows, waiting = packing.fill_windows(pieces)
    rest = packing.cut_rest(waiting)
    for window in windows:
        assert sum(p[0] for p in window) in packing.TIERS
    covered = sorted((d, s, n) for w in [*windows, *rest] for n, d, s in w)
    assert sum(n for _, _, n in covered) == sum(p[0] for p in pieces)
    assert len(covered) == len({(d, s) for d, s, _ in covered})
    assert sum(p[0] for p in waiting) < 2 * 2048
    whole = sum(1 for n, d, s in pieces if n <= 2048 and sum(c[0] == d for c in covered) == 1)
    assert whole >= 0.6 * sum(n <= 2048 for n, _, _ in pieces)


def test_steps_hold_equal_work():
    lengths = [2048] * 50 + [1024] * 31 + [256] * 77
    groups = packing.balance(lengths, 16 * 2048)
    sums = {}
    for n, g in zip(lengths, groups, strict=True):
        sums[g] = sums.get(g, 0) + n
    assert max(sums.values()) - min(sums.values()) <= 2048


def test_tiers_are_checked(spark):
    with pytest.raises(ValueError, match="powers of two"):
        packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH, tiers=(100, 2048))


def test_crc_of_ids(spark):
    df = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    row = packing.pack_documents(df, PATH).select(F.crc32("ids").alias("c"), "ids").orderBy("start").first()
    assert row["c"] == zlib.crc32(bytes(row["ids"]))


def test_words_of_a_batch_equal_whole_texts(monkeypatch):
    rng = random.Random(9)
    parts = ["The", "the", "  ", " ", "\n", "\t", "\x0b", "don't", "1234", "é", "東京", "🙂", "\x1c", "\x85", "\xa0", "!?", ".", ",", "A.B", "x,'s", "'re", "É", "\u0958", "İ", "I\u0307", "ς", "ǅ", "_a", "a_", "..."]
    specials = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|"]
    texts = ["", " ", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(200))]
    texts += ["".join(rng.choice(parts + specials) for _ in range(30)) for _ in range(100)]
    encode, whole = packing.encoder(PATH), packing.load(PATH)
    for limit, large in ((packing._CACHE, 1 << 30), (30, 1 << 30), (30, 0)):
        monkeypatch.setattr(packing, "_CACHE", limit)
        monkeypatch.setattr(packing, "_LARGE", large)
        for some in (texts[:200], texts[200:], *([t] for t in texts)):
            flat, ends = encode(pa.array(["skipped", *some]).slice(1))
            for k, text in enumerate(some):
                assert flat[ends[k] : ends[k + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids, text
    flat, ends = encode(pa.array([], pa.string()))
    assert len(flat) == 0 and ends.tolist() == [0]


@pytest.mark.parametrize("crowded", [1, 6, 1000])
def test_neighbours_have_common_prefixes_of_their_depth(crowded, monkeypatch):
    monkeypatch.setattr(neardup, "_LONG", 5)
    rng = np.random.default_rng(crowded)
    rows = sorted((int(t), *map(int, v)) for t, v in zip(rng.integers(0, 3, 400), rng.integers(0, 3, (400, 6)), strict=True))
    tree, order = np.array([r[0] for r in rows]), np.array([r[1:] for r in rows], dtype=">u4")

    def run(i, depth):
        return sum(r[: depth + 1] == rows[i][: depth + 1] for r in rows)

    want = set()
    for i in range(len(rows)):
        depth = next((d for d in neardup._DEPTHS[:-1] if run(i, d) <= crowded), neardup._DEPTHS[-1])
        for k in range(1, neardup._NEAR + 1):
            if i + k < len(rows) and rows[i][: depth + 1] == rows[i + k][: depth + 1]:
                if k <= neardup._NEXT or run(i, depth) <= 5:
                    want.add((i, i + k))
    left, right = neardup._neighbours(tree, order, 0, crowded)
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == want
    late = neardup._neighbours(tree, order, 100, crowded)
    assert set(zip(*(x.tolist() for x in late), strict=True)) == {p for p in want if p[1] >= 100}
    for few in (0, 1):
        assert len(neardup._neighbours(tree[:few], order[:few], 0, crowded)[0]) == 0


def test_neighbours_meet_over_ranges(spark):
    """Equal signatures dealt over many ranges, with a few rows each, stay one chain in every tree."""
    count = 60
    marks, orders = bytes(neardup._VALUES), [bytes(4 * neardup._DEPTHS[-1])] * neardup._TREES
    reps = spark.createDataFrame([(k, marks, orders) for k in range(count)], "rep long, marks binary, orders array<binary>")
    kept = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = {(r["a"], r["b"]) for r in neardup._candidates(reps, 80, 2048).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept[1])
    assert {(k, k + 1) for k in range(count - 1)} <= pairs
    best = neardup._best_pairs(spark.createDataFrame([(a, b, 100) for a, b in pairs], "a long, b long, agree int"))
    assert 0 < best.count() <= 3 * count
