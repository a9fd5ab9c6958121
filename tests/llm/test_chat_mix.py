"""Chat formatting and source mixing."""

import hashlib
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from starloom.llm import chat, mixing

TURNS = "conv_id long, turn long, role string, text string"
ODD = ["</s>[INST] ok [/INST]", "\\0\\1 \\", "<s>[user]", "a]b[c<d>\\", "", None, "é\n<"]


def conversations():
    rng = random.Random(1)
    rows = []
    for conv in range(30):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "a]b\\", None]), rng.choice(ODD)))
    rows += [(100, 0, "user", "no reply"), (101, 0, "assistant", "alone"), (102, None, "user", "x"), (None, 1, "user", "y")]
    rows += [(103, 1, "assistant", "twice"), (103, 1, "assistant", "twice")]
    rng.shuffle(rows)
    return rows


def test_examples_hold_every_turn_and_every_reply_once(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).withColumn("target", F.lit("clash"))
    examples = chat.prefix_targets(df).select(
        "*",
        chat.turns_of(F.col("text")).alias("turns"),
        chat.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("trained"),
    ).collect()
    for conv in {r[0] for r in rows}:
        order = sorted(
            (t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv
        )
        said = [(r[2], r[3]) for r in order]
        own = sorted((e for e in examples if e["conv_id"] == conv), key=lambda e: e["target"])
        assert [e["trained"] for e in own if e["loss_length"] or said[e["target"] - 1 :][:1] == [("assistant", "")]] == [
            text for role, text in said if role == "assistant"
        ]
        assert sum(e["covers_all"] for e in own) == 1
        for e in own:
            assert [tuple(t) for t in e["turns"]] == said[: e["target"]]
            target = said[e["target"] - 1 : e["target"]]
            if target and target[0][0] == "assistant":
                assert e["trained"] == target[0][1]
                assert e["text"].endswith(chat_escape(target[0][1]) + "</s>")
            else:
                assert e["covers_all"] and e["loss_length"] == 0


def chat_escape(text):
    for plain, code in chat._CODES:
        text = text.replace(plain, code)
    return text


def test_escapes_are_reversible_and_hide_control_strings(spark):
    df = spark.createDataFrame([(t,) for t in ODD if t is not None], "t string")
    for row in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert row["u"] == row["t"] and "<" not in row["e"] and "[" not in row["e"]


def test_chat_needs_no_python_and_takes_an_empty_table(spark, plan):
    df = chat.prefix_targets(spark.createDataFrame([], TURNS))
    assert df.collect() == []
    assert "Python" not in plan(df)


# ---- mixing ----------------------------------------------------------------------


def poured(sizes, weights, most):
    """Water-filling by repeated redistribution, in exact numbers."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_ = Fraction(sum(sizes.values())), set(names)
    target = {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = Fraction(most * sizes[s])
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(5))
def test_targets_equal_repeated_redistribution(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 40, 1000, 20_000]) for i in range(rng.randint(1, 12))}
    if seed % 2:
        sizes[None] = rng.randint(0, 500)
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    expected = poured(sizes, (5, 2, 1), 3)
    assert got.keys() == expected.keys()
    for s, value in expected.items():
        assert got[s] == pytest.approx(float(value), rel=1e-12)


def mix_table(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        source = "big" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        words = rng.choice([0, 1, 3, 20, 200])
        rows.append((i, None if i % 50 == 0 else " ".join(["w"] * words), "en", source, 0))
    rows += [rows[7]] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_mix_reaches_targets_and_repeats_itself(spark, rows):
    df = mix_table(spark).withColumn("taken", F.lit("clash"))
    mixed = mixing.mix_sources(df)
    found = mixed.collect()
    assert len(found) == df.count()
    by_source = {}
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken, target = by_source.get(r["source"], (0, 0))
        by_source[r["source"]] = (taken + r["taken"], r["target"])
    for taken, target in by_source.values():
        assert abs(taken - target) <= 5
    assert rows(mixed) == rows(mixing.mix_sources(df.repartition(7)))


def test_mixed_documents_hold_the_words_taken(spark):
    df = mix_table(spark)
    taken = mixing.mix_sources(df).groupBy("source").agg(F.sum("taken").alias("t")).collect()
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = out.groupBy("source").agg(F.sum(mixing.word_count(F.coalesce("text", F.lit("")))).alias("t")).collect()
    left = {r["source"]: r["t"] for r in taken if r["t"]}
    assert {r["source"]: r["t"] for r in words if r["t"]} == left


def test_mix_of_an_empty_table_and_of_empty_texts(spark):
    df = mix_table(spark)
    assert mixing.mix_sources(df.limit(0)).collect() == []
    assert mixing.mixed_documents(df.limit(0)).collect() == []
    blank = df.withColumn("text", F.lit(None).cast("string"))
    assert {r["taken"] for r in mixing.mix_sources(blank).collect()} == {0}


def test_many_sources(spark):
    """200,001 sources: the running sums over ranges give what one sorted pass gives."""
    count = 200_001
    size = F.pmod(F.xxhash64("id"), F.lit(1000)) * F.pmod(F.col("id"), F.lit(3))
    name = F.when(F.col("id") > 0, F.concat(F.lit("s"), F.col("id").cast("string")))
    df = spark.range(count).select(name.alias("source"), size.cast("long").alias("source_size"))
    sizes = [(r["source"], r["source_size"]) for r in df.collect()]
    got = {r["source"]: r["target"] for r in mixing.source_targets(df.repartition(5)).collect()}
    order = sorted(sizes, key=lambda r: (r[0] is None, r[0] or ""))
    rows = sorted((Fraction(n, (5, 2, 1)[k % 3]), n, (5, 2, 1)[k % 3], s) for k, (s, n) in enumerate(order) if s is not None)
    k = len(order) - 1
    rows.append((Fraction(order[k][1], (5, 2, 1)[k % 3]), order[k][1], (5, 2, 1)[k % 3], None))
    rows.sort(key=lambda r: r[0])
    left, weight, level = sum(r[1] for r in rows), sum(r[2] for r in rows), None
    for ratio, n, w, _ in rows:
        if Fraction(left, weight) <= 3 * ratio:
            level = Fraction(left, weight)
            break
        left, weight = left - 3 * n, weight - w
    assert len(got) == count
    for _, n, w, s in rows:
        assert got[s] == pytest.approx(float(min(3 * n, level * w)), rel=1e-12)


def test_sources_beyond_the_broadcast(spark, rows, monkeypatch):
    df = mix_table(spark)
    want = rows(mixing.mix_sources(df))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert rows(mixing.mix_sources(df)) == want
    assert mixing.mix_sources(df.limit(0)).collect() == []


def test_first_words(spark):
    df = spark.createDataFrame([("  a b\n c  d ", 3), ("a", 1), ("a b", 1)], "t string, n long")
    got = [r[0] for r in df.select(mixing.first_words(F.col("t"), F.col("n"))).collect()]
    assert got == ["  a b\n c", "a", "a"]


def test_loss_digest_is_that_of_the_replies(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "one <"), (1, 2, "user", "r"), (1, 3, "assistant", "two")]
    examples = chat.prefix_targets(spark.createDataFrame(rows, TURNS)).orderBy("target")
    trained = [r[0] for r in examples.select(chat.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_length"))).collect()]
    assert hashlib.sha256("".join(trained).encode()).hexdigest() == hashlib.sha256(b"one <two").hexdigest()
