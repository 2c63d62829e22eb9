"""Byte-level BPE encoding and decoding of whole texts.

Encoding works on the pieces (words) of a block of documents at once. Every adjacent pair of symbols
that can merge is indexed with all places where it stands; the ranks that have places are applied in
ascending order, and each merge moves the places of its neighbours to the lists of their new pairs. A
merge only makes pairs of higher rank, so one pass over the ranks gives what merging each piece on its own
gives. Encoded pieces are kept for later blocks, KEEP of them at most.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.llm.common import ship, text_of

#: Documents are encoded in blocks of so many characters; so many pieces are remembered at most.
BLOCK, KEEP = 1_000_000, 500_000
#: New pieces are merged so many characters at a time, and ids decoded so many at a time.
MERGED, DECODED = 500_000, 1 << 17
#: The byte-level pre-tokenising pattern.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return letters


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        letters = _byte_letters()
        values = {letter: b for b, letter in letters.items()}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        self.width = max([*vocab.values(), *self.special.values()]) + 1
        self.ranks, self.made = {}, []
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a] * self.width + vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.sorted_keys = np.array(sorted(self.ranks), dtype=np.int64)
        self.sorted_ranks = np.array([self.ranks[k] for k in self.sorted_keys.tolist()], dtype=np.int64)
        self.letter_ids = np.array(self.byte_ids, dtype=np.int64)
        self.token_bytes = [b""] * self.width
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(values[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.sizes = np.array([len(t) for t in self.token_bytes])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(self.token_bytes), dtype=np.uint8)
        self.find = regex.compile(PIECE).findall
        special = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({special})").split if special else None
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """The text's pieces; a special token's string is a piece of its own."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.find(text)
        return [p for part in self.cut(text) for p in ([part] if part in self.special else self.find(part))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = [self.pieces(t) for t in texts]
        new = set().union(*split) - self.known.keys()
        if len(self.known) + len(new) > KEEP:
            self.known = {}
            new = set().union(*split)
        known = self.known
        for words in self._portions(new):
            known.update(self._merge(words))
        return [b"".join([known[p] for p in pieces]) for pieces in split]

    @staticmethod
    def _portions(words: Iterable[str]) -> Iterator[list[str]]:
        part, size = [], 0
        for word in words:
            part.append(word)
            size += len(word)
            if size >= MERGED:
                yield part
                part, size = [], 0
        yield part

    def _merge(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        width, rank_of = self.width, self.ranks.get
        words = list(words)
        for word in self.special:
            if word in words:
                words.remove(word)
                yield word, np.array([self.special[word]], dtype="<u4").tobytes()
        encoded = [w.encode() for w in words]
        sizes = np.array([len(e) for e in encoded], dtype=np.int64)
        # The words' bytes as symbols, -1 around each word; merged symbols become -2. Neither is in a key of a merge.
        every = np.full(int(sizes.sum()) + len(words) + 1, -1, dtype=np.int64)
        letters = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        every[np.arange(len(letters)) + np.repeat(np.arange(1, len(words) + 1), sizes)] = self.letter_ids[letters]
        symbols = every.tolist()
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        keys = every[:-1] * width + every[1:]
        at = np.minimum(np.searchsorted(self.sorted_keys, keys), len(self.sorted_keys) - 1)
        held_at = np.flatnonzero((self.sorted_keys[at] == keys) & (every[:-1] >= 0) & (every[1:] >= 0))
        first = self.sorted_ranks[at[held_at]]
        order = np.argsort(first, kind="stable")
        found, cuts = np.unique(first[order], return_index=True)
        index = {r: p.tolist() for r, p in zip(found.tolist(), np.split(held_at[order], cuts[1:]))} if len(found) else {}
        places = index.get
        active = list(index)
        heapq.heapify(active)
        pair_of, push = self._pairs(), heapq.heappush
        while active:
            rank = heapq.heappop(active)
            (a, b), made = pair_of[rank], self.made[rank]
            for place in sorted(index.pop(rank)):
                right = after[place]
                if symbols[place] != a or symbols[right] != b:
                    continue
                symbols[place], symbols[right] = made, -2
                beyond = after[place] = after[right]
                before[beyond] = place
                left = before[place]
                if (other := rank_of(symbols[left] * width + made)) is not None:
                    if (held := places(other)) is None:
                        index[other] = [left]
                        push(active, other)
                    else:
                        held.append(left)
                if (other := rank_of(made * width + symbols[beyond])) is not None:
                    if (held := places(other)) is None:
                        index[other] = [place]
                        push(active, other)
                    else:
                        held.append(place)
        done = np.array(symbols, dtype=np.int64)
        # What is left of a word lies between its separators.
        left = done[done != -2]
        ends = np.flatnonzero(left == -1)
        raw = left.astype("<u4").tobytes()
        for word, start, end in zip(words, (ends[:-1] * 4 + 4).tolist(), (ends[1:] * 4).tolist()):
            yield word, raw[start:end]

    @lru_cache(maxsize=1)  # noqa: B019 - one vocabulary per worker
    def _pairs(self) -> list[tuple[int, int]]:
        out = [(0, 0)] * len(self.made)
        for key, rank in self.ranks.items():
            out[rank] = divmod(key, self.width)
        return out

    def library(self):
        """The same encoding by a library: the ids are the ranks of the tokens, which is checked here."""
        if self.made != list(range(256, 256 + len(self.made))) or sorted(self.byte_ids) != list(range(256)):
            raise ValueError("the vocabulary's ids are not in the order of its merges")
        plain = {self.token_bytes[i]: i for i in range(256 + len(self.made))}
        return tiktoken.Encoding("own", pat_str=PIECE, mergeable_ranks=plain, special_tokens=self.special)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; special tokens stay, numbers without a token give nothing."""
        return b"".join(self._letters(ids[i : i + DECODED]) for i in range(0, len(ids), DECODED)).decode("utf-8", "replace")

    def _letters(self, ids: np.ndarray) -> bytes:
        ids = ids[(ids >= 0) & (ids < self.width)]
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        return self.letters[np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - sizes), sizes)].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def library(path: str) -> tiktoken.Encoding:
    return vocabulary(path).library()


def blocks(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches in slices of about BLOCK characters, with the texts of a column."""
    for batch in batches:
        values = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for row, size in enumerate(sizes):
            total += size
            if total >= BLOCK:
                yield batch.slice(start, row + 1 - start), values.slice(start, row + 1 - start).to_pylist()
                start, total = row + 1, 0
        if start < len(values):
            yield batch.slice(start), values.slice(start).to_pylist()


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(encoded) + 1, dtype=np.int32)
    np.cumsum([len(e) // 4 for e in encoded], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(encoded), dtype="<u4").astype(np.int32))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` (array of int) of every row of ``docs`` (doc_id, text) by the byte-level vocabulary file at ``path``.

    A null text is empty and has no ids; repeated rows each get their row; columns beside doc_id and text
    are not read. A special token's string in a text becomes that token. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for rows, texts in blocks(batches, "_text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), id_lists(words.encode(texts))], names=["doc_id", "ids"])

    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("_text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``text``, what the ids stand for. Null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                lists = part.column(1)
                ids, ends = pc.fill_null(lists.flatten(), -1).to_numpy(), np.cumsum(pc.fill_null(pc.list_value_length(lists), 0))
                texts = pa.array([words.decode(i) for i in np.split(ids, ends[:-1])], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], names=["doc_id", "ids", "text"])

    ship(encoded.sparkSession)
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())]))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: what ``decode`` returns for ``encode(docs, path)``, both in one pass of the same worker.

    The ids of a text do not leave the worker in between, and a task holds one vocabulary instead of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for rows, texts in blocks(batches, "_text"):
            encoded = words.encode(texts)
            decoded = pa.array([words.decode(np.frombuffer(e, dtype="<u4")) for e in encoded], pa.string())
            yield pa.RecordBatch.from_arrays([rows.column(0), id_lists(encoded), decoded], names=["doc_id", "ids", "text"])

    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("_text"))
    fields = [rows.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("text", T.StringType())]
    return rows.mapInArrow(run, T.StructType(fields))


def digests(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what ``decode`` returns."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
