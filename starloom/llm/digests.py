"""Document fingerprints: a quartile bucket digest.

Every window of five bytes gives six byte triplets that start at its first or
second byte; each triplet, hashed with the number of its pattern, counts in one
of 512 buckets. A digest keeps for each bucket the quartile of its count among
all buckets (two bits), and the logarithm of the text's length (one byte). So it
is bounded, equal texts have equal digests, and a local edit moves few buckets.

Two digests are compared by the sum of their quartile steps. Texts of one
language share part of their triplets, so the sum is set against what two
independent digests with these shares of quartiles would give: likeness is 1 for
equal quartiles and 0 where they agree no better than by chance. The difference
in length damps it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import python_ready, stored, text_of

BUCKETS = 512
#: Offsets of the second and third byte of the triplets of a window.
PATTERNS = ((1, 2), (1, 3), (2, 3), (2, 4), (3, 4), (1, 4))
#: Bytes that are counted at a time, so that a very long text needs little memory.
_PART = 1 << 20
_STEPS = np.abs(np.arange(4)[:, None] - np.arange(4)[None, :])


def bucket_counts(data: bytes) -> np.ndarray:
    """How many triplets of a text fall into each bucket."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    for at in range(0, len(data), _PART):
        part = np.frombuffer(data[at : at + _PART + 4], dtype=np.uint8).astype(np.uint32)
        starts = min(_PART, len(data) - at)
        first = part * np.uint32(2654435761)
        for number, (i, j) in enumerate(PATTERNS, start=1):
            n = min(starts, len(part) - j)
            if n <= 0:
                continue
            mixed = first[:n] ^ ((part[i : i + n] + np.uint32(number << 8)) * np.uint32(2246822519))
            mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(3266489917)
            mixed = (mixed ^ part[j : j + n]) * np.uint32(2654435761)
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(2246822519)
            counts += np.bincount(mixed >> shift, minlength=BUCKETS)
    return counts


def digest(text: str) -> bytes:
    """Length byte and two bits for each bucket."""
    data = text.encode("utf-8", "surrogatepass")
    counts = bucket_counts(data)
    ranked = np.sort(counts)
    codes = sum((counts > ranked[BUCKETS * q // 4 - 1]).astype(np.uint8) for q in (1, 2, 3))
    packed = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], dtype=np.uint8)
    return bytes([min(255, round(6 * np.log2(len(data) + 1)))]) + packed.astype(np.uint8).tobytes()


def likeness(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Likeness of digests pair by pair, from 0 to 1; equal digests have 1."""
    if not len(left):
        return np.zeros(0)
    a, b = (np.frombuffer(b"".join(side), dtype=np.uint8).reshape(len(side), -1) for side in (left, right))
    apart = np.abs(a[:, 0].astype(np.int16) - b[:, 0]) / 6
    codes = [((x[:, 1:, None] >> np.array([6, 4, 2, 0], dtype=np.uint8)) & 3).reshape(len(x), -1) for x in (a, b)]
    steps = np.abs(codes[0].astype(np.int8) - codes[1].astype(np.int8)).sum(axis=1)
    shares = [np.stack([(c == q).mean(axis=1) for q in range(4)], axis=1) for c in codes]
    chance = np.einsum("ni,ij,nj->n", shares[0], _STEPS, shares[1]) * BUCKETS
    agreed = np.where(steps == 0, 1.0, np.maximum(0.0, 1 - steps / np.maximum(chance, 1e-9)))
    return agreed / (1 + apart / 2)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, fingerprint (lowercase hex) of every row.

    A null text counts as empty; a text of fewer than three bytes has no triplet
    and only its length tells it apart. Repeated rows are told row by row; an
    empty table gives an empty result; other columns are not read.
    """

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([digest(t).hex() for t in texts], index=texts.index, dtype="object")

    python_ready(docs.sparkSession)
    read = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    return read.select(
        F.col("id").alias(id_col), F.length("text").cast("long").alias("n_chars"), made("text").alias("fingerprint")
    )


def likeness_of(left: str, right: str):
    """Likeness of two columns of fingerprints; null where one is."""

    @F.pandas_udf("double")
    def compared(a: pd.Series, b: pd.Series) -> pd.Series:
        out = pd.Series(np.nan, index=a.index, dtype="float64")
        known = a.notna() & b.notna()
        out[known] = likeness([bytes.fromhex(x) for x in a[known]], [bytes.fromhex(x) for x in b[known]])
        return out

    return F.nanvl(compared(F.col(left), F.col(right)), F.lit(None).cast("double"))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the following one."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_RESULT = (
    "doc_id {id}, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _judged(ids: list, texts: list[str], marks: list[bytes], following: list[str], after: list[bytes]) -> dict:
    """Columns of the result for texts with the text that follows each."""
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    new = [digest(t) for t in changed]
    return {
        "doc_id": pd.Series(ids, dtype="object"),
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in changed],
        "fingerprint": marks,
        "edited_fingerprint": new,
        "near_edited": likeness(marks, new),
        "near_next": likeness(marks, after),
    }


def _ids(values: pd.Series) -> list:
    return [None if pd.isna(v) else v for v in values]


def edit_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness.

    Documents stand by descending id, rows without an id last, rows of one id by
    a hash of the text; the last is followed by the first, a single one by itself.
    The edited text has its last third replaced by as many characters, or all, of the text that follows.
    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint (lowercase
    hex), near_edited, near_next. A null text counts as empty, repeated rows
    count one by one, an empty table gives an empty result, and other columns are
    not read.

    Texts travel once, to ranges of ids; a row's number spreads the copies of one row over
    ranges. Each task streams its range and keeps one text. Only the first and the last text of a
    range are stored, and joined with those of its neighbours.
    """
    spark = docs.sparkSession
    python_ready(spark)
    kind = dict(docs.dtypes)[id_col]
    result = _RESULT.format(id=kind)
    names = [c.split()[0] for c in result.split(", ")]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        ids: list = []
        texts: list[str] = []
        marks: list[bytes] = []
        begun = False
        for batch in batches:
            if batch.empty:
                continue
            found = list(batch["text"])
            ids, texts = ids + _ids(batch["id"]), texts + found
            marks = marks + [digest(t) for t in found]
            if not begun:
                begun = True
                yield pd.DataFrame({"part": [part], "place": ["first"], "text": texts[:1], "fingerprint": marks[:1]})
            if len(texts) > 1:
                yield pd.DataFrame(_judged(ids[:-1], texts[:-1], marks[:-1], texts[1:], marks[1:]))
            ids, texts, marks = ids[-1:], texts[-1:], marks[-1:]
        if texts:
            yield pd.DataFrame(
                {"part": [part], "place": ["last"], "text": texts, "fingerprint": marks,
                 "doc_id": pd.Series(ids, dtype="object")}
            )

    columns = names + ["part", "place", "text"]

    def padded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in stream(batches):
            frame = frame.reindex(columns=columns)
            yield frame.astype({c: "object" for c in columns}).where(frame.notna(), None)

    def join_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame(
                _judged(_ids(b["doc_id"]), list(b["text"]), list(b["fingerprint"]), list(b["next_text"]), list(b["next_mark"]))
            )

    text = text_of(text_col)
    order = [F.col("id").desc_nulls_last(), F.col("hash"), F.col("number")]
    read = docs.select(
        F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("number"),
    )
    ranged = read.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    out = stored(ranged.mapInPandas(padded, f"{result}, part long, place string, text string"))
    done = out.filter(F.col("place").isNull()).select(*names)
    # one number per range comes to the driver
    parts = sorted(r["part"] for r in out.filter("place = 'first'").select("part").collect())
    turns = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part long, after long")
    first = out.filter("place = 'first'").select(
        F.col("part").alias("after"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_mark")
    )
    last = out.filter("place = 'last'").select("part", "doc_id", "text", "fingerprint")
    ends = last.join(turns, "part").join(first, "after").select("doc_id", "text", "fingerprint", "next_text", "next_mark")
    whole = done.unionByName(ends.mapInPandas(join_ends, result))
    return whole.select(
        F.col("doc_id").alias(id_col),
        "n_chars",
        *[F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
        "near_edited",
        "near_next",
    )
