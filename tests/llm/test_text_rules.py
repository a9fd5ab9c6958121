"""Rules, words and token counts."""

import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starloom.llm import rules, tokens
from starloom.llm.common import lower_ascii, text_of, word_array, word_count

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra=""):
    """A documents table; ``extra`` adds a column whose name clashes with an output."""
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn(extra, F.lit("clash")) if extra else df


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def texts_with_repeats():
    rng = random.Random(3)
    made = ["", " \n\t ", "one", "a b\n\na b\n", "x " * 30, "é ß z 漢 # $", "%%% |||\n\r\n%%% |||\r"]
    for size in (7, 8, 9, 15, 16, 17, 60):
        made.append(" ".join(["w"] * size))
        made.append(" ".join(str(i) for i in range(size)) + " " + " ".join(str(i) for i in range(size)))
    for _ in range(60):
        made.append("".join(rng.choice(["a", "b", "c", " ", " ", "\n", "# ", "the "]) for _ in range(rng.randint(1, 300))))
    base = " ".join(f"u{i}" for i in range(3000))
    made.append(base + "\n" + base[:400] + " tail")
    return [*made, None]


def test_rule_counts_equal_brute_force(spark):
    texts = texts_with_repeats()
    got = rules.judge(documents(spark, texts, "counts")).orderBy("doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for row, text in zip(got, texts, strict=True):
        expected = brute_counts(text)
        assert tuple(row["counts"][n] for n in names) == expected, text
        assert row["base_failed"] == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (row["kept"] and row["base_failed"])
        assert row["kept"] == (not row["base_failed"] and not row["failed"])


def test_rules_name_what_fails_and_keep_columns(spark):
    good = "The cat of the house and a dog in the garden " + " ".join(f"word{i} and the" for i in range(30))
    bad = {"symbols": good.replace("word", "%#$% word"), "capitals": good.upper(), "marks": good.replace(" ", "!! ")}
    df = documents(spark, [good, *bad.values()])
    rows = rules.judge(df, keep=tuple(df.columns)).orderBy("doc_id").collect()
    assert rows[0]["kept"] and rows[0]["failed"] == [] and rows[0]["source"] == "s"
    for row, name in zip(rows[1:], bad, strict=True):
        assert name in row["failed"] and not row["kept"]


def test_rules_run_without_python(spark, plan):
    text = plan(rules.judge(documents(spark, ["a"])))
    assert "Python" not in text and "Arrow" not in text


def test_a_filter_on_the_verdict_holds_one_copy_of_the_counts(spark):
    df = documents(spark, ["a"])
    kept = rules.judge(df, keep=tuple(df.columns)).filter("kept").select(*df.columns)
    text = kept._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") == 2  # words and lines


def test_length_alone_fails_no_text(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(2000)] + ["the", "of"] * 100
    long = " ".join(rng.choice(words) for _ in range(300_000))
    poor = " ".join(rng.choice(words[:20] + ["the"]) for _ in range(5000))
    got = rules.judge(documents(spark, [long, poor])).orderBy("doc_id").collect()
    assert got[0]["kept"] and got[0]["failed"] == []
    assert got[1]["failed"] == ["distinct_words"]
    for row, text in zip(got, (long, poor), strict=True):
        found = WORD.findall(text)
        blocks = [found[k : k + rules.BLOCK] for k in range(0, len(found), rules.BLOCK)]
        assert row["counts"]["n_distinct_words"] == sum(len(set(b)) for b in blocks)


def test_rules_of_an_empty_table(spark):
    assert rules.judge(documents(spark, [])).collect() == []


def test_words_and_lower_case(spark):
    texts = ["", "A\x0bB\x0cC d E", "É A", "\n"]
    got = documents(spark, texts).select(
        word_array(lower_ascii(text_of("text"))).alias("w"), word_count(text_of("text")).alias("n")
    )
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in texts]
    assert [(r["w"], r["n"]) for r in got.collect()] == [(WORD.findall(t), len(WORD.findall(t))) for t in lowered]


# ---- token counts ----------------------------------------------------------------

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "b", " ", "  ", "\n", "1", "23", "'s", "'", "<|endoftext|>", "<|", "|>", "é", "ß", "漢", "🙂", " ", "\t",
    "\x1c", "\x85", "don't", "the ", " ", "<|endoftext|", ".", "word", "　", "́",
]


def whole(text):
    return len(tokens.load(PATH).encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("seed", range(4))
def test_spliced_chunks_equal_the_whole_text(seed):
    rng = random.Random(seed)
    tokenizer = tokens.load(PATH)
    count = tokens._by_pieces(tokenizer)
    for _ in range(250):
        some = rng.sample(PIECES, rng.randint(1, len(PIECES)))
        text = "".join(rng.choice(some) for _ in range(rng.choice([1, 5, 40, 300, 800])))
        expected = whole(text)
        assert count([text]) == [expected], text
        assert tokens.count_spliced(tokenizer, text, rng.choice([40, 90, 200]), rng.choice([1, 16])) == expected, text


@pytest.mark.parametrize("text", ["a" * 9000, " " * 9000, "ab " * 4000, "1" * 5000 + " x", "é" * 5000, "<|endoftext|>" * 700])
def test_texts_without_early_boundaries_widen_the_overlap(text):
    assert tokens.count_spliced(tokens.load(PATH), text, 512, 16) == whole(text)


def test_token_counts_of_a_table(spark):
    texts = ["", "Hello world", "x <|endoftext|> y", "word " * 3000, None, "word " * 3000]
    df = documents(spark, texts, "n_tokens")
    got = tokens.count_tokens(df, PATH, huge=2000, overlap=64).orderBy("doc_id").collect()
    for row, text in zip(got, texts, strict=True):
        text = text or ""
        assert (row["n_tokens"], row["n_bytes"]) == (whole(text), len(text.encode()))
        assert row["over_limit"] == (whole(text) > 1024)
        assert row["resynchronised"] == (len(text) > 2000)
    assert tokens.count_tokens(documents(spark, []), PATH).collect() == []
