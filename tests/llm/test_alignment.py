"""Pair bitmaps against a plain alignment of whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from starloom.llm import alignment, catalog

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = "doc_id long, text string, a int, block string, docs int"


@pytest.fixture(scope="module")
def plain():
    """Tokens of a whole text: lists of (id, bytes) of A and B."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = alignment.byte_alphabet()

    def tokens(text):
        left = [(k, bytes(alphabet[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for k in b.encode(text):
            piece = b.id_to_piece(k)
            right.append((k, bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()))
        return left, right

    return tokens


def grouped(tokens, text):
    if not text:
        return None
    left, right = tokens(text)
    whole = (" " + text).encode()
    if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return None
    out, sizes = [], [0, 0]
    rest = [left[::-1], right[::-1]]
    while rest[0] or rest[1]:
        group = ([], [])
        while not group[0] or sizes[0] != sizes[1]:
            side = 0 if sizes[0] <= sizes[1] else 1
            k, x = rest[side].pop()
            group[side].append(k)
            sizes[side] += len(x)
        out.append(group)
    return out


def expected(tokens, rows):
    docs = [(key, grouped(tokens, text)) for key, text in rows]
    held = [Counter((p, q) for x, y in groups or [] for p in x for q in y) for _, groups in docs]
    count = Counter(pair for c in held for pair in c)
    top = defaultdict(int)
    for (p, _), n in count.items():
        top[p] = max(top[p], n)
    out = []
    for (key, groups), links in zip(docs, held, strict=True):
        groups = groups or []
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            key, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(m for (p, q), m in links.items() if count[p, q] == top[p]),
            sum(m * count[pair] for pair, m in links.items()),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  ", "a\nb", "a\r\nb", "x;\r\ny", "\r", "\r\n", "a\r", "a \r\n\r\n b", "\ta",
    "a\t\tb", "a b", "a　b", "a​b ​ c", "don't we'll 'S", "<|endoftext|> x<|endoftext|>", "<s></s><unk>",
    "<0x0A>", "a▁b", "▁", "ﬁne ① ½", "﻿x", "naïve Zürich 東京タワー 🙂🙂 fin", "\x00a\x1cb\x85c", "1234567 3.14", "   lead",
    "the the the the", "a b ", "é é", "!!!???...", " \n \n x", "word" * 60, "\U0001f9d1‍\U0001f680",
    "x" * 300, "the " * 300,
]


def scrambled(rng, n):
    return "".join(rng.choice(["the", " of", " ", "\n", "\r", "\t", "é", "1", "'s", "東", "!", "ing", " ", "x", "{", "🙂"]) for _ in range(n))


@pytest.mark.parametrize("parts", [1, 4])
def test_alignment_matches_a_plain_one(spark, plain, parts):
    rng = random.Random(1)
    texts = ODD + [scrambled(rng, rng.choice([3, 10, 60])) for _ in range(400)] + ["the river of the"] * 5
    rows = list(enumerate(texts)) + [(3, "one id, two texts"), (3, "one id, two texts"), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], COLUMNS).repartition(parts)
    assert found(alignment.align_documents(df, A, B)) == expected(plain, rows)


def test_small_caches_and_long_texts(plain):
    """Units in parts and a cache that starts anew change nothing."""
    rng = random.Random(2)
    texts = [scrambled(rng, rng.choice([0, 5, 40, 900])) for _ in range(60)] + ["the of " * 200] * 3
    rows = list(enumerate(texts))
    aligner = alignment.Aligner(A, B)
    keep = alignment._CACHE, alignment._PART, alignment._SHORT
    alignment._CACHE, alignment._PART, alignment._SHORT = 50, 7, 5
    try:
        for _, text in rows:
            groups = grouped(plain, text) or []
            shown = []
            for part in aligner.units(text) if text else []:
                (numbers,) = aligner.code([part])
                shown += [aligner.texts[k] for k in numbers]
            assert ";".join(shown) == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    finally:
        alignment._CACHE, alignment._PART, alignment._SHORT = keep


def test_bitmaps_give_their_postings_back():
    rng = np.random.default_rng(3)
    for pairs, docs, top in ((1, 1, 1), (5, 4096, 9), (300, 700, 3), (2, 256, 1), (2, 257, 70_000)):
        keys = np.unique(rng.integers(0, pairs, pairs * docs) << alignment._PLACE | rng.integers(0, docs, pairs * docs))
        links = rng.integers(1, top + 1, len(keys))
        per_pair = rng.integers(1, 100, pairs)
        want = np.zeros(alignment.BLOCK_DOCS, dtype=np.int64)
        np.add.at(want, keys & (alignment.BLOCK_DOCS - 1), links * per_pair[keys >> alignment._PLACE])
        got = np.zeros_like(want)
        counted, total = Counter(), Counter()
        for plane, own, popcounts, bits in alignment.planes(keys, links):
            weight = 1 if plane == 0 else 1 << (plane - 1)
            got += alignment.per_position(popcounts, bits, [weight * per_pair[own]])[0]
            for pair, n in zip(own.tolist(), popcounts.tolist(), strict=True):
                counted[pair] += n * (plane == 0)
                total[pair] += n * weight
        assert (got == want).all()
        assert counted == Counter((keys >> alignment._PLACE).tolist())
        assert sum(total.values()) == links.sum()


def test_no_rows(spark):
    assert alignment.align_documents(spark.createDataFrame([], COLUMNS), A, B).collect() == []


def test_registered_query(spark, plain):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    short = [(k, t) for k, t in rows if len(t or "") < 3000]
    got = {r["doc_id"]: r for r in catalog.ALL["op11_alignment"].build(spark, sf_dir).collect()}
    assert sorted(got) == sorted(k for k, _ in rows)
    docs = {k: grouped(plain, t) for k, t in rows}
    held = {k: Counter((p, q) for x, y in g or [] for p in x for q in y) for k, g in docs.items()}
    count = Counter(pair for c in held.values() for pair in c)
    for k, _ in short:
        assert got[k]["n_links"] == sum(held[k].values())
        assert got[k]["count_sum"] == sum(m * count[pair] for pair, m in held[k].items())
        assert got[k]["n_groups"] == len(docs[k] or [])
