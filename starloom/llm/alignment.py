"""Alignment of two tokenizers by inverted pair bitmaps.

A text is cut into units, runs of blanks with the word after them, at places that
no token of either tokenizer can span. So both end a token there, groups never
cross units, and the tokens, groups and linked pairs of a unit are worked out
once per worker and looked up afterwards.

Documents are numbered inside blocks of bounded size. A block keeps for every
linked pair of ids the compressed bitmap of its documents (positions where they
are few, bits where they are many) and, for documents that hold the pair more
than once, planes with the binary digits of the further links. Bitmaps of
one pair are disjoint over blocks, so their union is their concatenation: popcounts of the document
bitmaps add up to the pair's number of documents, weighted popcounts of all planes to its links. The
scores of a pair then return along its bitmaps to the documents.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import python_ready, stored

#: Documents and postings of a block; positions take ``_PLACE`` bits of a key.
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 21
_PLACE = 12
_ID = 21  # bits of a token id
#: A bitmap with more documents than this is kept as bits, which then take less room than positions.
_FEW = BLOCK_DOCS // 16
#: Units in the cache of a Python worker, and the longest unit that is kept there.
_CACHE = 300_000
_SHORT = 64
#: Units that are encoded in one go.
_JOINED = 256
#: Units that are handled at a time, so that a very long text needs little memory.
_PART = 200_000
#: Characters with the Unicode property White_Space.
BLANKS = "".join(
    map(
        chr,
        (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000),
    )
)
_SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def unit_pattern(pieces: list[str]) -> re.Pattern | None:
    """Units for a vocabulary of pieces; None where even a space may stand inside a piece.

    A unit ends where a blank follows another character, unless some piece joins
    that blank to what stands before it.
    """
    long = [p for p in pieces if len(p) > 1]
    if any(_SPACE in p.lstrip(_SPACE) for p in long):
        return None
    glued = "".join(c for c in BLANKS if c != " " and any(c in p for p in long))
    blank = f"[{re.escape(BLANKS)}]"
    solid = f"[^{re.escape(BLANKS)}]+"
    if not glued:
        return re.compile(f"{blank}*{solid}|{blank}+")
    joint = f"[{re.escape(glued)}]{blank}*"
    return re.compile(f"{blank}*{solid}(?:{joint}{solid})*(?:{joint}\\Z)?|{blank}+")


class _Grown:
    """An array that rows are appended to."""

    def __init__(self, *shape: int) -> None:
        self.room = np.zeros((1 << 12, *shape), dtype=np.int64)
        self.used = 0

    def add(self, rows: np.ndarray) -> None:
        while self.used + len(rows) > len(self.room):
            self.room = np.concatenate([self.room, np.zeros_like(self.room)])
        self.room[self.used : self.used + len(rows)] = rows
        self.used += len(rows)

    @property
    def rows(self) -> np.ndarray:
        return self.room[: self.used]


class Aligner:
    """Units of texts with their tokens, groups and pairs for two tokenizers."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * (max(self.a.get_vocab(with_added_tokens=True).values()) + 1)
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            if all(c in alphabet for c in token):
                self.a_bytes[number] = bytes(alphabet[c] for c in token)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(_SPACE, " ").encode()
            for k, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))
        self.blank = self.b.piece_to_id(_SPACE)
        self.pattern = unit_pattern([p for k, p in enumerate(pieces) if not self.b.is_byte(k)])
        if max(len(self.a_bytes), len(pieces)) >> _ID:
            raise ValueError("a vocabulary has more ids than a pair key can hold")
        self.known: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.known.clear()
        self.texts: list[str] = []  # groups of a unit, as written in the digest
        self.facts = _Grown(5)  # n_a, n_b, n_groups, n_links, sound
        self.pairs = _Grown(2)  # key, links
        self.ends = _Grown()
        self.ends.add(np.zeros(1, dtype=np.int64))

    def _one(self, unit: str) -> tuple[list[int], list[int]]:
        """Ids of one unit. A leading space is the one that B adds by itself."""
        a = self.a.encode(unit, add_special_tokens=False).ids
        if unit == " ":
            return a, [self.blank]
        if unit[0] == " ":
            return a, self.b.encode(unit[1:], num_threads=1)
        b = self.b.encode(unit, num_threads=1)
        return a, b[1:] if b and b[0] == self.blank else [0]

    def _same(self, data: bytes, a: list[int], b: list[int]) -> bool:
        """Whether both sides give the text back."""
        return all(
            b"".join(map(side.__getitem__, ids)) == data for side, ids in ((self.a_bytes, a), (self.b_bytes, b))
        )

    def _encode(self, units: list[str]) -> tuple[list[str], list[np.ndarray], list[np.ndarray], list[str]]:
        """Sound units in an order of their own, the ids of A and B of all of them, and the other units.

        Units that a blank begins and no blank ends can stand one after the other without
        changing each other's tokens, so many are encoded in one go.
        """
        regular = [u for u in units if u[0] in BLANKS and u[-1] not in BLANKS and len(u) <= _SHORT]
        single = [u for u in units if u[0] not in BLANKS or u[-1] in BLANKS or len(u) > _SHORT]
        sound: list[str] = []
        of_a: list[np.ndarray] = []
        of_b: list[np.ndarray] = []
        parts = [regular[at : at + _JOINED] for at in range(0, len(regular), _JOINED)]
        joined = ["a" + "".join(p) for p in parts]
        coded = self.a.encode_batch_fast([" " + x for x in joined], add_special_tokens=False)
        for part, text, found, b in zip(parts, joined, coded, self.b.encode(joined, num_threads=1), strict=True):
            a = found.ids
            stops = np.cumsum([2, *(len(u.encode()) for u in part)])
            x, y = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
            ends = np.cumsum(self.a_sizes[x]), np.cumsum(self.b_sizes[y])
            if self._same(b" " + text.encode(), a, b) and all(np.isin(stops, e, assume_unique=True).all() for e in ends):
                sound += part
                of_a.append(x[ends[0] > 2])
                of_b.append(y[ends[1] > 2])
            else:
                single += part
        odd = []
        for unit in single:
            a, b = self._one(unit)
            if self._same(unit.encode("utf-8", "surrogatepass"), a, b):
                sound.append(unit)
                of_a.append(np.array(a, dtype=np.int64))
                of_b.append(np.array(b, dtype=np.int64))
            else:
                odd.append(unit)
        return sound, of_a, of_b, odd

    def _align(self, units: list[str]) -> list[str]:
        """Facts, digest texts and pairs of new units; returns them in the order of their numbers."""
        sound, of_a, of_b, odd = self._encode(units)
        if sound:
            a, b = np.concatenate(of_a), np.concatenate(of_b)
            a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
            common = np.intersect1d(a_ends, b_ends, assume_unique=True)
            of_unit = np.searchsorted(np.cumsum([len(u.encode()) for u in sound]), common)
            upto = [np.searchsorted(ends, common, side="right") for ends in (a_ends, b_ends)]
            n_a, n_b = (np.diff(u, prepend=0) for u in upto)
            n_groups = np.bincount(of_unit, minlength=len(sound))
            first = np.cumsum(n_groups) - n_groups
            facts = [np.add.reduceat(x, first) for x in (n_a, n_b, np.ones_like(n_a), n_a * n_b)]
            self.facts.add(np.stack([*facts, np.ones(len(sound), dtype=np.int64)], axis=1))
            self.texts += self._shown(a.tolist(), b.tolist(), n_a.tolist(), n_b.tolist(), n_groups.tolist())
            self._link(a, b, upto[0] - n_a, upto[1] - n_b, n_a, n_b, of_unit, len(sound))
        if odd:
            self.facts.add(np.zeros((len(odd), 5), dtype=np.int64))
            self.texts += [""] * len(odd)
            self.ends.add(np.full(len(odd), self.pairs.used))
        return sound + odd

    @staticmethod
    def _shown(a: list[int], b: list[int], n_a: list[int], n_b: list[int], n_groups: list[int]) -> list[str]:
        shown, x, y = [], 0, 0
        for m, n in zip(n_a, n_b, strict=True):
            if m == n == 1:
                shown.append(f"{a[x]}|{b[y]}")
            else:
                shown.append(f"{','.join(map(str, a[x : x + m]))}|{','.join(map(str, b[y : y + n]))}")
            x, y = x + m, y + n
        out, at = [], 0
        for count in n_groups:
            out.append(shown[at] if count == 1 else ";".join(shown[at : at + count]))
            at += count
        return out

    def _link(
        self, a: np.ndarray, b: np.ndarray, a_first: np.ndarray, b_first: np.ndarray,
        n_a: np.ndarray, n_b: np.ndarray, of_unit: np.ndarray, units: int,
    ) -> None:
        """Distinct pairs of each unit with their links: every token of A with every one of B in its group."""
        links = n_a * n_b
        small = links <= 1024
        many = links[small]
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        width = np.repeat(n_b[small], many)
        left = a[np.repeat(a_first[small], many) + step // width]
        right = b[np.repeat(b_first[small], many) + step % width]
        keys = [np.repeat(of_unit[small], many) << 2 * _ID | left << _ID | right]
        amounts = [np.ones(len(step), dtype=np.int64)]
        for g in np.flatnonzero(~small):
            x, m = np.unique(a[a_first[g] : a_first[g] + n_a[g]], return_counts=True)
            y, n = np.unique(b[b_first[g] : b_first[g] + n_b[g]], return_counts=True)
            keys.append((of_unit[g] << 2 * _ID | x[:, None] << _ID | y[None, :]).ravel())
            amounts.append((m[:, None] * n[None, :]).ravel())
        key, amount = _added(np.concatenate(keys), np.concatenate(amounts))
        counts = np.bincount(key >> 2 * _ID, minlength=units)
        before = self.pairs.used
        self.pairs.add(np.stack([key & ((1 << 2 * _ID) - 1), amount], axis=1))
        self.ends.add(before + np.cumsum(counts))

    def units(self, text: str) -> Iterator[list[str]]:
        """Units of a space and the text, in parts."""
        whole = " " + text
        if self.pattern is None:
            yield [whole]
        elif len(whole) < 4 * _PART:
            yield self.pattern.findall(whole)
        else:
            found = self.pattern.finditer(whole)
            while part := [m[0] for m in islice(found, _PART)]:
                yield part

    def code(self, parts: list[list[str]]) -> list[list[int]]:
        """Numbers of the units of each part; the facts of a unit stand at its number."""
        known = self.known
        if len(self.texts) > _CACHE:
            self._clear()
        new = list(dict.fromkeys(u for part in parts for u in part if u not in known))
        own: dict[str, int] = {}
        for at in range(0, len(new), 4096):
            first = len(self.texts)
            for number, unit in enumerate(self._align(new[at : at + 4096]), start=first):
                (known if len(unit) <= _SHORT else own)[unit] = number
        if not own:
            return [list(map(known.__getitem__, part)) for part in parts]
        return [[own[u] if u in own else known[u] for u in part] for part in parts]


@lru_cache(maxsize=2)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


def _added(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sum of their amounts."""
    if not len(keys):
        return keys, amounts
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(amounts, first)


def planes(keys: np.ndarray, links: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """Bitmaps of sorted postings (pair and position in one key): plane, pairs, popcounts, bits.

    Plane 0 has every document of a pair; plane k has those whose further links
    have the binary digit k - 1. Rows of few documents come before those of many.
    """
    pairs, places = keys >> _PLACE, (keys & ((1 << _PLACE) - 1)).astype("<u2")
    more = links - 1
    for plane in range(1 + int(more.max(initial=0)).bit_length()):
        chosen = np.ones(len(keys), dtype=bool) if plane == 0 else (more >> (plane - 1) & 1).astype(bool)
        if not chosen.any():
            continue
        own, place = pairs[chosen], places[chosen]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        docs = np.diff(np.append(first, len(own)))
        few = docs <= _FEW
        if few.any():
            kept = place[np.repeat(few, docs)]
            ends = np.concatenate([[0], np.cumsum(docs[few]) * 2]).astype("<i4")
            bits = pa.Array.from_buffers(
                pa.binary(), int(few.sum()), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(kept.tobytes())]
            )
            yield plane, own[first[few]], docs[few], bits
        if not few.all():
            many = ~few
            rows = np.zeros((int(many.sum()), BLOCK_DOCS), dtype=np.uint8)
            rows[np.repeat(np.arange(len(rows)), docs[many]), place[np.repeat(many, docs)]] = 1
            packed = np.packbits(rows, axis=1)
            yield plane, own[first[many]], docs[many], pa.array([r.tobytes() for r in packed], pa.binary())


def per_position(docs: np.ndarray, bits: pa.Array, amounts: list[np.ndarray]) -> list[np.ndarray]:
    """For each array of amounts per bitmap, their sum at each position whose bit is set."""
    few = docs <= _FEW
    out = [np.zeros(BLOCK_DOCS, dtype=np.int64) for _ in amounts]
    if few.any():
        places = np.frombuffer(b"".join(bits.filter(pa.array(few)).to_pylist()), dtype="<u2")
        for total, amount in zip(out, amounts, strict=True):
            np.add.at(total, places, np.repeat(amount[few], docs[few]))
    if not few.all():
        rows = np.frombuffer(b"".join(bits.filter(pa.array(~few)).to_pylist()), dtype=np.uint8)
        rows = np.unpackbits(rows.reshape(-1, BLOCK_DOCS // 8), axis=1)
        for total, amount in zip(out, amounts, strict=True):
            for at in range(0, len(rows), 256):
                total += amount[~few][at : at + 256] @ rows[at : at + 256].astype(np.int64)
    return out


_DOCUMENT = "block long, place int, id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_POSTING = "a int, b int, plane int, docs int, bits binary"


def index(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of documents (place is set) and of pair bitmaps (a is set), by block.

    Blocks are formed inside a partition from whole documents; a task holds one block and
    one document at a time.
    """
    kind = dict(docs.dtypes)[id_col]
    read = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    python_ready(docs.sparkSession)
    schema = f"{_DOCUMENT.format(id=kind)}, {_POSTING}"
    names = [c.split()[0] for c in schema.split(", ")]
    types = {
        "block": pa.int64(), "place": pa.int32(), "id": None, "groups_sha256": pa.string(), "a": pa.int32(),
        "b": pa.int32(), "plane": pa.int32(), "docs": pa.int32(), "bits": pa.binary(),
    }

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_path, piece_path)
        block, id_type = TaskContext.get().partitionId() << 32, pa.int64()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        place = postings = 0

        def batch_of(count: int, columns: dict) -> pa.RecordBatch:
            arrays = []
            for name in names:
                wanted = (id_type if name == "id" else types.get(name)) or pa.int64()
                given = columns.get(name)
                arrays.append(pa.nulls(count, wanted) if given is None else pa.array(given, wanted) if not isinstance(given, pa.Array) else given)
            return pa.RecordBatch.from_arrays(arrays, names)

        def bitmaps() -> Iterator[pa.RecordBatch]:
            keys, links = _added(*(np.concatenate(side) for side in zip(*held, strict=True)))
            for plane, pairs, found, bits in planes(keys, links):
                count = len(pairs)
                yield batch_of(
                    count,
                    {"block": np.full(count, block), "a": (pairs >> _ID).astype(np.int32), "plane": np.full(count, plane),
                     "b": (pairs & ((1 << _ID) - 1)).astype(np.int32), "docs": found.astype(np.int32), "bits": bits},
                )

        for batch in batches:
            id_type = batch.column("id").type
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                texts = some.column("text").to_pylist()
                parts, owner = [], []
                for k, text in enumerate(texts):
                    if text and _SPACE not in text:
                        for part in aligner.units(text):
                            parts.append(part)
                            owner.append(k)
                coded = aligner.code(parts)
                facts, pairs, ends = aligner.facts.rows, aligner.pairs.rows, aligner.ends.rows
                shown = aligner.texts
                totals = np.zeros((len(texts), 4), dtype=np.int64)
                sound = np.array([bool(t) and _SPACE not in t for t in texts])
                numbers = [np.array(c, dtype=np.int64) for c in coded]
                for k, found in zip(owner, numbers, strict=True):
                    own = facts[found]
                    totals[k] += own[:, :4].sum(axis=0)
                    sound[k] &= bool(own[:, 4].all())
                totals[~sound] = 0
                digests = [hashlib.sha256() if ok else None for ok in sound]
                seen = [False] * len(texts)
                for k, found in zip(owner, coded, strict=True):
                    if sound[k]:
                        text = ";".join(map(shown.__getitem__, found))
                        digests[k].update((";" + text if seen[k] else text).encode())
                        seen[k] = True
                for k in range(len(texts)):
                    if place == BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                        if held:
                            yield from bitmaps()
                        held, place, postings, block = [], 0, 0, block + 1
                    if k == 0 or place == 0:
                        start, placed, first = k, [], block
                    placed.append(place)
                    mine = [f for o, f in zip(owner, numbers, strict=True) if o == k] if sound[k] else []
                    if mine:
                        units, times = np.unique(np.concatenate(mine), return_counts=True)
                        sizes = ends[units + 1] - ends[units]
                        total = int(sizes.sum())
                        at_pair = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(ends[units], sizes)
                        keys, links = _added(pairs[at_pair, 0], pairs[at_pair, 1] * np.repeat(times, sizes))
                        held.append((keys << _PLACE | place, links))
                        postings += len(keys)
                    place += 1
                    if k + 1 == len(texts) or place == BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                        span = slice(start, k + 1)
                        yield batch_of(
                            k + 1 - start,
                            {"block": np.full(k + 1 - start, first), "place": np.array(placed, dtype=np.int32),
                             "id": some.column("id").slice(start, k + 1 - start),
                             **{n: totals[span, c] for c, n in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                             "groups_sha256": [d.hexdigest() if d else "" for d in digests[span]]},
                        )
        if held:
            yield from bitmaps()

    return read.mapInArrow(build, schema)


def pair_counts(indexed: DataFrame) -> DataFrame:
    """a, b, n_docs, n_links, best of every linked pair; best marks the largest n_docs of its a, ties included."""
    weight = F.expr("CASE WHEN plane = 0 THEN 1L ELSE shiftleft(1L, plane - 1) END")
    counted = (
        indexed.filter(F.col("a").isNotNull())
        .groupBy("a", "b")
        .agg(
            F.sum(F.when(F.col("plane") == 0, F.col("docs")).otherwise(0)).alias("n_docs"),
            F.sum(weight * F.col("docs")).alias("n_links"),
        )
    )
    # rows of one a are bounded by the other vocabulary
    return counted.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a")))


def align_documents(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    A is a byte-level BPE (tokenizers file) that reads a space and the text, B a
    piece model that adds this space itself; special strings inside texts are plain text. A
    null or empty text, and one that the tokens of A or B do not give back byte
    by byte, has no tokens: zeros and an empty digest. Repeated rows are documents of their own, an
    empty table gives an empty result, other columns are not read.
    """
    indexed = stored(index(docs, byte_path, piece_path, id_col, text_col))
    kind = dict(docs.dtypes)[id_col]
    scored = (
        indexed.filter(F.col("a").isNotNull())
        .select(F.col("block").alias("held_in"), "a", "b", "plane", "docs", "bits")
        .join(pair_counts(indexed).select("a", "b", "n_docs", "best"), ["a", "b"])
        .select("held_in", "plane", "docs", "bits", "n_docs", "best")
    )
    documents = indexed.filter(F.col("place").isNotNull()).select(*[c.split()[0] for c in _DOCUMENT.split(", ")])

    def back(documents: pa.Table, scored: pa.Table) -> pa.Table:
        best = total = np.zeros(BLOCK_DOCS, dtype=np.int64)
        if scored.num_rows:
            plane = scored.column("plane").to_numpy().astype(np.int64)
            weight = np.where(plane == 0, 1, 1 << np.maximum(plane - 1, 0))
            top = scored.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
            best, total = per_position(
                scored.column("docs").to_numpy(),
                scored.column("bits").combine_chunks(),
                [weight * top, weight * scored.column("n_docs").to_numpy()],
            )
        place = documents.column("place").to_numpy()
        kept = documents.drop_columns(["block", "place"])
        return kept.append_column("n_best", pa.array(best[place])).append_column("count_sum", pa.array(total[place]))

    out = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    joined = documents.groupBy("block").cogroup(scored.groupBy("held_in")).applyInArrow(back, out)
    return joined.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
