"""Token counts; huge texts by overlap resynchronisation.

A text of up to ``huge`` characters goes to the tokenizer as a whole. A longer
one is cut into chunks that overlap. Two neighbours are spliced at a position
where both begin a pre-token (a unit that the tokenizer encodes on its own):
from such a position on, the split into pre-tokens depends only on the text to
the right, so the left chunk is right before it and the right chunk after it.
Near a cut a chunk is not trusted: a pre-token, or a special string, that
reaches the cut may be another one in the whole text. Where no common start
lies in the trusted part, the overlap is doubled and the chunk encoded again,
at most until it spans both neighbours.

In a batch, texts are encoded by distinct pieces (a run of blanks with the
word after it): a piece that follows a non-blank begins at such a safe start
itself, so the pieces of a text are encoded apart with the same ids.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import python_ready, text_of

#: Characters that the tokenizer's pattern takes for blanks (Unicode White_Space).
_BLANK = "".join(
    map(
        chr,
        (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000),
    )
)
_PIECE = re.compile(f"[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+")
#: Entries of the piece cache of a Python worker; it starts anew when full.
_CACHE = 1_000_000


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a file, once per worker process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def longest_special(tokenizer) -> int:
    return max((len(t.content) for t in tokenizer.get_added_tokens_decoder().values()), default=0)


def _starts(encoding) -> dict[int, int]:
    """Position in the text -> tokens before it, for every pre-token start.

    A leading blank of a pre-token is not in its offsets, in either neighbour.
    """
    found: dict[int, int] = {}
    before = None
    for k, (word, span) in enumerate(zip(encoding.word_ids, encoding.offsets, strict=True)):
        if word != before:
            found[span[0]] = k
            before = word
    return found


def count_spliced(tokenizer, text: str, chunk: int = 32_768, overlap: int = 256) -> int:
    """Tokens of one text by overlapping chunks; the same number as encoding it whole."""
    size = len(text)
    if size <= chunk + overlap:
        return len(tokenizer.encode(text, add_special_tokens=False).ids)
    margin = longest_special(tokenizer) + 2
    overlap = max(overlap, 4 * margin)

    def encode(a: int, b: int):
        return tokenizer.encode(text[a:b], add_special_tokens=False)

    a, b = 0, min(size, chunk + overlap)
    left = encode(a, b)
    begin, total = 0, 0  # of the left chunk, tokens before ``begin`` are counted already
    while b < size:
        width = overlap
        while True:
            start = max(a, b - width)
            end = min(size, max(b, start + chunk + overlap) if width == overlap else b + width + chunk)
            right = encode(start, end)
            # trusted: clear of the left chunk's end and of the right chunk's start
            trusted = range(start + margin if start else 0, b - margin)
            here, there = _starts(left), _starts(right)
            common = [
                p for p in here if p + a in trusted and p + a - start in there and here[p] >= begin
            ]
            if common:
                p = max(common)
                total += here[p] - begin
                begin = there[p + a - start]
                a, b, left = start, end, right
                break
            if start == a or width > 2 * (b - a):
                # nothing to splice on in the whole left chunk: encode it with what follows
                grown = min(size, b + max(chunk, b - a))
                left = encode(a, grown)
                b = grown
                break
            width *= 2
    return total + len(left.ids) - begin


def _by_pieces(tokenizer) -> Callable[[list[str]], list[int]]:
    cache = _piece_cache(id(tokenizer))

    def count(texts: list[str]) -> list[int]:
        pieces = [_PIECE.findall(t) for t in texts]
        new = list({p for found in pieces for p in found if p not in cache})
        if len(cache) + len(new) > _CACHE:
            cache.clear()
            new = list({p for found in pieces for p in found})
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            coded = tokenizer.encode_batch_fast(part, add_special_tokens=False)
            cache.update(zip(part, map(len, coded), strict=True))
        return [sum(map(cache.__getitem__, found)) for found in pieces]

    return count


@lru_cache(maxsize=4)
def _piece_cache(_: int) -> dict[str, int]:
    return {}


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 1024,
    huge: int = 32_768,
    overlap: int = 256,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, resynchronised of every row.

    A null text counts as empty (0 bytes, 0 tokens). Texts of more than ``huge``
    characters are counted by resynchronisation in chunks of ``huge``, so the
    tokenizer never holds more than a few chunks. Repeated rows are counted row
    by row; an empty table gives an empty result; other columns are not read.
    The tokenizer must be byte-level BPE without a normalizer.
    """

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = load(tokenizer_path)
        count = _by_pieces(tokenizer)
        for texts in batches:
            numbers = pd.Series(0, index=texts.index, dtype="int64")
            large = texts.str.len() > huge
            if large.any():
                numbers[large] = [count_spliced(tokenizer, t, huge, overlap) for t in texts[large]]
            numbers[~large] = count(list(texts[~large]))
            yield numbers

    python_ready(docs.sparkSession)
    read = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    return read.select(
        F.col("id").alias(id_col),
        F.octet_length("text").cast("long").alias("n_bytes"),
        tokens("text").alias("n_tokens"),
        (F.length("text") > huge).alias("resynchronised"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
