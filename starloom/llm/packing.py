"""Hierarchical multi-length packing of token documents.

A document is tokenized and ended by one id; its whole windows of the longest
tier stand alone. What is left goes to the shortest tier that holds it. Tiers
are packed from the longest: a piece opens a window of its tier, the gap takes
the longest pieces of shorter tiers that fit, and what then remains is filled by
cutting one shorter piece. So windows are full, and each takes one cut at most.
Pieces without filler wait for the next documents; at the end of a partition
they are joined and cut into powers of two. No window holds padding.

Sequences of a buffer are dealt to step groups, the longest first, each to the
group with the fewest tokens, so that training steps hold about equal work and
every tier.

Partitions are packed on their own, in buffers of bounded size: no shuffle, and a
lost partition is packed again to the same result from the same input split.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import python_ready, text_of
from starloom.llm.tokens import load

TIERS = (256, 512, 1024, 2048)
#: Words in the cache of a Python worker; it starts anew when full.
_CACHE = 700_000
#: Bytes of a batch up to which its texts are rewritten before they are split.
_LARGE = 1 << 30
_ID = 4  # bytes of an id: unsigned, little-endian


#: Words that are joined by blanks to be encoded in one go.
_JOINED = 256


class _Words:
    """Ids of the words met so far, one after the other, with the place of each word."""

    def __init__(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype="<u4")
        self.starts = np.zeros(1 << 16, dtype=np.int64)

    def add(self, words: list[str], tokenizer, last: np.ndarray) -> None:
        """Encodes new words, many of them joined by blanks in one go.

        ``last`` marks the ids that end a unit of the tokenizer. A word of letters is one unit, which
        counting its marks confirms; tokens of other words are told apart by where they begin.
        """
        plain = [w for w in words if w.isalpha()]
        rest = [w for w in words if not w.isalpha()]
        parts = [plain[at : at + _JOINED] for at in range(0, len(plain), _JOINED)]
        for at in range(0, len(parts), 16):
            some = parts[at : at + 16]
            coded = tokenizer.encode_batch_fast([" ".join(p) for p in some], add_special_tokens=False)
            for part, found in zip(some, coded, strict=True):
                ids = np.array(found.ids, dtype="<u4")
                ends = np.flatnonzero(last[ids]) + 1
                if len(ends) == len(part) and ends[-1] == len(ids):
                    self._append(part, ids, np.diff(ends, prepend=0))
                else:
                    rest += part
        for at in range(0, len(rest), _JOINED):
            part = rest[at : at + _JOINED]
            found = tokenizer.encode(" ".join(part), add_special_tokens=False)
            begin = np.cumsum([0, *(len(w) + 1 for w in part[:-1])])
            spans = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)
            owner = np.searchsorted(begin, spans[:, 0], side="right") - 1
            self._append(part, np.array(found.ids, dtype="<u4"), np.bincount(owner, minlength=len(part)))

    def _append(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.places)
        used = int(self.starts[first])
        while first + len(words) >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        while used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used : used + len(ids)] = ids
        self.starts[first + 1 : first + 1 + len(words)] = used + np.cumsum(counts)
        self.places.update(zip(words, range(first, first + len(words)), strict=True))


@lru_cache(maxsize=4)
def _word_cache(_: str) -> list[_Words]:
    return [_Words()]


def _unit_ends(tokenizer) -> np.ndarray:
    """For each id whether it ends a unit; none does where the model writes no such mark."""
    mark = getattr(tokenizer.model, "end_of_word_suffix", None)
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    last[[k for token, k in vocabulary.items() if mark and token.endswith(mark)]] = True
    return last


def encoder(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Ids of a batch of texts in one array, and where each text's ids begin and end in it.

    For a tokenizer that drops blanks, lowers case, and takes letters and marks apart: it splits at
    every blank, so the words of a batch are dictionary-encoded and each distinct word is
    encoded once. A mark after one of a-z is a word of its own, and A-Z are lowered before; neither
    changes an id, and there are fewer words. Texts with a special string stay as they are.
    """
    tokenizer, cache = load(path), _word_cache(path)
    last = _unit_ends(tokenizer)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    opening = special[0][:2] if special and len({c[:2] for c in special}) == 1 else ""

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        small = texts.nbytes < _LARGE
        if not small:
            texts = texts.cast(pa.large_string())  # words of a batch may need 64-bit places
        elif opening and not pc.any(pc.match_substring(texts, opening)).as_py():
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([.,;:!?])", r"\1 \2")
        split = pc.ascii_split_whitespace(texts)
        coded = split.values.slice(split.offsets[0].as_py()).dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(cache[0].places) + len(words) > _CACHE:
            cache[0] = _Words()
        known = cache[0]
        known.add([w for w in words if w not in known.places], tokenizer, last)
        own = np.fromiter(map(known.places.__getitem__, words), dtype=np.int64, count=len(words))
        number = own[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else own
        sizes = known.starts[number + 1] - known.starts[number]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(ends[-1]) + np.repeat(known.starts[number] - ends[:-1], sizes)
        offsets = split.offsets.to_numpy(zero_copy_only=False)
        return known.ids[at], ends[offsets - offsets[0]]

    return encode


#: A piece: length, number of its document, start in it.
Piece = tuple[int, int, int]


def fill_windows(pieces: list[Piece], tiers: tuple[int, ...] = TIERS) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows of the tiers' sizes, and the pieces for which there was no filler.

    Every token of the input is in exactly one place of the output.
    """
    longest = tiers[-1]
    windows: list[list[Piece]] = []
    pool: list[Piece] = []
    for length, doc, start in pieces:
        whole = length // longest * longest
        windows += [[(longest, doc, start + at)] for at in range(0, whole, longest)]
        if length > whole:
            pool.append((length - whole, doc, start + whole))
    pool.sort()
    waiting: list[Piece] = []
    for tier, below in zip(reversed(tiers), [*reversed(tiers[:-1]), 0], strict=True):
        while pool and pool[-1][0] > below:
            opened = [pool.pop()]
            gap = tier - opened[0][0]
            # only pieces of shorter tiers are filler, in the lowest tier all are
            while gap and pool:
                at = bisect_right(pool, (gap, 1 << 62, 0)) - 1
                if at >= 0:
                    piece = pool.pop(at)
                    opened.append(piece)
                    gap -= piece[0]
                    continue
                length, doc, start = pool.pop(0)
                opened.append((gap, doc, start))
                insort(pool, (length - gap, doc, start + gap))
                gap = 0
            if gap:
                waiting += opened
            else:
                windows.append(opened)
    return windows, waiting


def cut_rest(pieces: list[Piece], tiers: tuple[int, ...] = TIERS) -> list[list[Piece]]:
    """The last pieces of a partition, joined and cut into powers of two, the longest first."""
    rest = sum(p[0] for p in pieces)
    windows: list[list[Piece]] = []
    queue = list(reversed(pieces))
    while rest:
        room = min(tiers[-1], 1 << (rest.bit_length() - 1))
        rest -= room
        opened: list[Piece] = []
        while room:
            length, doc, start = queue.pop()
            taken = min(length, room)
            opened.append((taken, doc, start))
            if length > taken:
                queue.append((length - taken, doc, start + taken))
            room -= taken
        windows.append(opened)
    return windows


def balance(lengths: list[int], step_tokens: int) -> list[int]:
    """Step group of each sequence: groups of about step_tokens with near equal sums."""
    groups = max(1, round(sum(lengths) / step_tokens))
    heap = [(0, g) for g in range(groups)]
    chosen = [0] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        tokens, g = heapq.heappop(heap)
        chosen[k] = g
        heapq.heappush(heap, (tokens + lengths[k], g))
    return chosen


SCHEMA = (
    "doc_id {id}, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long, step_id long"
)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    tiers: tuple[int, ...] = TIERS,
    buffer_tokens: int = 1 << 20,
    step_tokens: int = 32 * 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset,
    sequence_length, step_id.

    A null or empty text is the end id alone. Repeated rows are documents of their
    own. Empty tables give an empty result; other columns are not read. tiers
    are rising powers of two. sequence_id and step_id hold the partition in their
    upper bits. A task holds ``buffer_tokens`` and one document at a time.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers must be rising powers of two")
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        base = TaskContext.get().partitionId() << 40
        sequences = steps = number = held = 0
        ids: dict[int, tuple[object, bytes]] = {}
        pieces: list[Piece] = []
        id_type = pa.int64()

        def table(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequences, steps
            counts = np.array([len(w) for w in windows])
            length, doc, start = np.array([p for w in windows for p in w], dtype=np.int64).T
            first = np.cumsum(counts) - counts
            sizes = np.add.reduceat(length, first)
            groups = np.array(balance(sizes.tolist(), step_tokens))
            through = np.cumsum(length)
            coded = [ids[d] for d in doc.tolist()]
            columns = [
                pa.array([key for key, _ in coded], id_type),
                start,
                length,
                pa.array(
                    [c[a:b] for (_, c), a, b in zip(coded, (start * _ID).tolist(), ((start + length) * _ID).tolist(), strict=True)],
                    pa.binary(),
                ),
                np.array([len(c) // _ID for _, c in coded]),
                base + sequences + np.repeat(np.arange(len(windows)), counts),
                through - length - np.repeat(through[first] - length[first], counts),
                np.repeat(sizes, counts),
                base + steps + np.repeat(groups, counts),
            ]
            sequences += len(windows)
            steps += int(groups.max()) + 1
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        for batch in batches:
            id_type = batch.column("id").type
            flat, ends = encode(batch.column("text"))
            whole, ends = flat.tobytes(), (ends * _ID).tolist()
            for key, a, b in zip(batch.column("id").to_pylist(), ends[:-1], ends[1:], strict=True):
                ids[number] = (key, whole[a:b] + end)
                pieces.append(((b - a) // _ID + 1, number, 0))
                held += (b - a) // _ID + 1
                number += 1
                if held >= buffer_tokens:
                    windows, pieces = fill_windows(pieces, tiers)
                    if windows:
                        yield table(windows)
                    ids = {doc: ids[doc] for _, doc, _ in pieces}
                    held = sum(p[0] for p in pieces)
        windows, pieces = fill_windows(pieces, tiers)
        windows += cut_rest(pieces, tiers)
        if windows:
            yield table(windows)

    python_ready(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    read = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    packed = read.mapInArrow(pack, SCHEMA.format(id=kind))
    return packed.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else packed
