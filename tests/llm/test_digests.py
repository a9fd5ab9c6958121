"""Quartile bucket digests against a plain recount, and edits against a plain loop."""

import hashlib
import random

import numpy as np
import pytest

from starloom.llm import catalog, digests

COLUMNS = "doc_id long, text string, fingerprint string, id int, part int"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


def expected(rows):
    """Result rows by the contract; ties of one id do not matter where texts are equal."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (key, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        new = text[: len(text) - cut] + after[:cut]
        marks = [digests.digest(t) for t in (text, new, after)]
        near = [float(digests.likeness([marks[0]], [m])[0]) for m in marks[1:]]
        out.append((key, len(text), hashlib.sha256(new.encode()).hexdigest(), marks[0].hex(), marks[1].hex(), *near))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r))


def found(df):
    assert df.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r))


def test_buckets_hold_every_triplet():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 5, 50):
        data = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        assert digests.bucket_counts(data).sum() == sum(max(0, n - j) for _, j in digests.PATTERNS)


def test_long_texts_are_counted_in_parts(monkeypatch):
    data = np.random.default_rng(2).integers(97, 110, 5000, dtype=np.uint8).tobytes()
    whole = digests.bucket_counts(data)
    for part in (1, 3, 7, 1024):
        monkeypatch.setattr(digests, "_PART", part)
        assert (digests.bucket_counts(data) == whole).all()


def test_quartiles_split_the_buckets():
    rng = random.Random(3)
    codes = np.frombuffer(digests.digest(prose(rng, 4000))[1:], dtype=np.uint8)
    shares = [np.mean([(codes >> s) & 3 == q for s in (0, 2, 4, 6)]) for q in range(4)]
    assert all(0.2 < s < 0.3 for s in shares)


def test_likeness_is_bounded_symmetric_and_one_for_equals():
    rng = random.Random(4)
    texts = ["", "a", "ab", "abc", "x" * 1000, *(prose(rng, n) for n in (3, 10, 100, 1000))]
    marks = [digests.digest(t) for t in texts]
    for a in marks:
        for b in marks:
            x, y = digests.likeness([a], [b])[0], digests.likeness([b], [a])[0]
            assert 0 <= x <= 1 and x == pytest.approx(y)
            if a == b:
                assert x == 1
    assert digests.likeness([], []).shape == (0,)


def test_edits_are_closer_than_other_texts():
    rng = random.Random(5)
    texts = [prose(rng, rng.choice([30, 100, 500])) for _ in range(200)]
    other = texts[1:] + texts[:1]
    marks = [digests.digest(t) for t in texts]
    edits = digests.likeness(marks, [digests.digest(digests.edited(a, b)) for a, b in zip(texts, other, strict=True)])
    others = digests.likeness(marks, marks[1:] + marks[:1])
    assert (edits > others).mean() > 0.99


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_edits_match_a_plain_loop(spark, parts):
    rng = random.Random(6)
    rows = [(i * 7 % 101, prose(rng, rng.choice([0, 1, 5, 60]))) for i in range(101)]
    rows += [(500, None), (501, ""), (502, "Zürich 東京 🙂 ends"), (-3, "\n"), (600, prose(rng, 30_000)), (None, "no id")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], COLUMNS).repartition(parts)
    got, want = found(digests.edit_with_next(df)), expected(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want])


def test_repeated_rows_and_small_tables(spark):
    same = [(4, "one text that is there ten times over")] * 10
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in same], COLUMNS)
    got = found(digests.edit_with_next(df))
    assert len(got) == 10 and len(set(got)) == 1
    one = found(digests.edit_with_next(df.limit(1)))
    assert [r[:5] for r in one] == [r[:5] for r in expected(same[:1])]
    assert found(digests.edit_with_next(df.limit(0))) == []


def test_fingerprints_alone(spark):
    df = spark.createDataFrame([(1, "a text", "x", 1, 2), (2, None, "x", 1, 2), (1, "a text", "x", 1, 2)], COLUMNS)
    marks = digests.fingerprint_documents(df)
    rows = sorted(tuple(r) for r in marks.collect())
    assert rows == [(1, 6, digests.digest("a text").hex())] * 2 + [(2, 0, digests.digest("").hex())]
    near = marks.withColumnRenamed("fingerprint", "a").selectExpr("a", "CASE WHEN doc_id = 1 THEN a END AS b")
    assert sorted(near.select(digests.likeness_of("a", "b").alias("n")).collect(), key=str) == [(1.0,), (1.0,), (None,)]


def test_registered_query_matches_a_plain_loop(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got, want = found(catalog.ALL["op13_fingerprints"].build(spark, sf_dir)), expected(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want])
