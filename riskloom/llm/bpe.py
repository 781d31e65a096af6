"""Byte-level BPE by backtracking over longest token matches, and decoding through an offset table.

Merging pair by pair is replaced by a search from left to right: an Aho-Corasick automaton over the
vocabulary gives the longest token at a place, and the token is taken if it may stand after the one
before it. Two tokens may stand together if merging their joint bytes gives exactly those two; where
no shorter prefix fits either, the token before is given up. Places that failed are never tried
again, so the work is linear in the text, and the result is the one of the merges.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from riskloom.llm.base import slices

#: How byte-level tokenizers cut a text before merging (fixed value of the vocabulary's format).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Pieces, and pairs of tokens, that a worker remembers in each of two generations. Results do not depend on it.
REMEMBERED = 150_000
LONG_PIECE = 200


def _byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write bytes: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}


def _tokens(spec: dict) -> tuple[dict[str, bytes], dict[bytes, int], dict[str, int]]:
    """From a tokenizers file: its words as bytes, the ids of those bytes, and the ids of the special texts."""
    letters = _byte_letters()
    raw = {word: bytes(letters[c] for c in word) for word in spec["model"]["vocab"] if all(c in letters for c in word)}
    ids = {raw[word]: i for word, i in spec["model"]["vocab"].items() if word in raw}
    return raw, ids, {t["content"]: t["id"] for t in spec.get("added_tokens", [])}


class Recalled(dict):
    """What ``find`` says of a key, remembered in two generations.

    A full young generation becomes the old one, whose keys return to the young when they are asked
    for again: what recurs stays, and at most twice ``limit`` keys are held. Keys that do not fit are never kept.
    """

    def __init__(self, find, limit: int, fits=lambda key: True) -> None:
        super().__init__()
        self.find, self.limit, self.fits, self.old = find, limit, fits, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.find(key)
            if not self.fits(key):
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Offsets:
    """The decoder: the bytes of all tokens in one string, and where those of each id begin and end."""

    def __init__(self, content: bytes) -> None:
        _, ids, special = _tokens(json.loads(content))
        table = {i: t for t, i in ids.items()} | {i: t.encode() for t, i in special.items()}
        size = max(table, default=-1) + 1
        self.offsets = np.concatenate(([0], np.cumsum(np.array([len(table.get(i, b"")) for i in range(size)], np.int64))))
        self.blob = np.frombuffer(b"".join(table.get(i, b"") for i in range(size)), np.uint8)

    def decode_flat(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of token ids; ``ends`` cuts them into texts. An id outside the table is an error."""
        lengths = self.offsets[ids + 1] - self.offsets[ids]
        stops = np.cumsum(lengths)
        at = np.repeat(self.offsets[ids] - (stops - lengths), lengths) + np.arange(int(stops[-1]) if len(stops) else 0)
        whole = self.blob[at].tobytes()
        cuts = np.concatenate(([0], np.concatenate(([0], stops))[ends]))
        return [whole[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


class Vocabulary:
    """Tokens, merges and the encoder's tables, from a tokenizers JSON file's bytes."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        raw, self.ids, self.special = _tokens(spec)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.rank: dict[tuple[bytes, bytes], int] = {}
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}
        self.age: dict[bytes, int] = {}  # the merge that makes a token; single bytes are older than all
        for r, (a, b) in enumerate(merges):
            pair = raw[a], raw[b]
            self.rank.setdefault(pair, r)
            if pair[0] + pair[1] not in self.halves:
                self.halves[pair[0] + pair[1]], self.age[pair[0] + pair[1]] = pair, r
        self.usable = {t for t in self.ids if len(t) == 1 or t in self.halves and self.together(*self.halves[t], whole=True)}
        # From here on tokens are ids: bytes, length and longest usable prefix (-1: none) by id.
        size = max(self.ids.values(), default=-1) + 1
        self.token, self.length, self.shorter = [b""] * size, [0] * size, [-1] * size
        self.automaton = ahocorasick.Automaton()
        for t in self.usable:
            i = self.ids[t]
            self.token[i], self.length[i] = t, len(t)
            self.shorter[i] = next((self.ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.usable), -1)
            self.automaton.add_word(t.decode("latin-1"), (i, len(t) - 1))
        self.automaton.make_automaton()
        self.pairs = Recalled(self._pair, REMEMBERED)
        self.split_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def together(self, a: bytes, b: bytes, whole: bool = False) -> bool:
        """Whether merging the bytes of ``a`` and ``b`` stops at these two tokens (``whole``: just before it joins them).

        The seam is opened step by step: the token whose merge came later is taken apart, towards
        the seam. A merge across the seam that would have come before the parts were joined means
        that the two tokens never arise side by side.
        """
        own = self.rank.get((a, b)) if whole else None
        limit = len(self.rank) + len(self.halves) + 1
        old = lambda t: self.age.get(t, -1)
        while True:
            across = self.rank.get((a, b))
            if across is not None and across != own and across < limit:
                return False
            if own is not None and across == own:
                own = None
            if old(a) < 0 and old(b) < 0:
                return True
            if old(a) > old(b):
                # What lies right of the seam was complete by then: a merge across must come before this one.
                limit, a = old(a), self.halves[a][1]
            else:
                # Of equal merges the left one happens first.
                limit, b = old(b) + 1, self.halves[b][0]

    def _pair(self, pair: int) -> bool:
        return self.together(self.token[pair >> 32], self.token[pair & 0xFFFFFFFF])

    def _longest(self, piece: bytes) -> list[int]:
        """The longest token that starts at each byte (-1: none), from one pass of the automaton."""
        best = [-1] * len(piece)
        for end, (token, before) in self.automaton.iter(piece.decode("latin-1")):
            best[end - before] = token  # ends rise, so the last token from a start is the longest
        return best

    def encode_piece(self, piece: bytes) -> list[int]:
        if piece in self.usable:
            return [self.ids[piece]]
        longest, tokens, place, stop = self._longest(piece), [], 0, len(piece)
        length, shorter, pairs = self.length, self.shorter, self.pairs
        failed = bytearray(stop + 1)
        token = longest[0]
        while place < stop:
            if token >= 0 and not failed[place + length[token]] and (not tokens or pairs[tokens[-1] << 32 | token]):
                tokens.append(token)
                place += length[token]
                token = longest[place] if place < stop else -1
            elif token >= 0 and shorter[token] >= 0:
                token = shorter[token]
            elif tokens:
                failed[place] = 1
                token = tokens.pop()
                place -= length[token]
            else:
                raise ValueError("the vocabulary does not cover all bytes")
        return tokens

    def encode(self, text: str, memory: _Memory) -> list[int]:
        if self.split_special is None:
            parts = [text]
        else:
            parts = self.split_special.split(text)
        out: list[int] = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part])
            else:
                out.extend(chain.from_iterable(map(memory.__getitem__, PIECES.findall(part))))
        return out


class _Memory(Recalled):
    """Piece to ids. Very long pieces are encoded each time."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__(lambda piece: vocabulary.encode_piece(piece.encode()), REMEMBERED, lambda piece: len(piece) <= LONG_PIECE)


@lru_cache(maxsize=1)
def _encoder(content: bytes) -> tuple[Vocabulary, _Memory]:
    vocabulary = Vocabulary(content)
    return vocabulary, _Memory(vocabulary)


@lru_cache(maxsize=1)
def _decoder(content: bytes) -> Offsets:
    return Offsets(content)


def _texts(table: Offsets, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.array([t.decode("utf-8", "replace") for t in table.decode_flat(ids, ends)], pa.string())


def encoded(docs: DataFrame, vocabulary: bytes, keep: tuple[str, ...] = ("doc_id",), text: str = "text", back: bool = False) -> DataFrame:
    """``keep`` columns and ``ids array<int>`` for every row; a null text is empty and has no ids.

    With ``back`` also ``decoded``, the text that the ids give; one worker does both, so that a task
    needs no second process. ``vocabulary`` is the content of the tokenizer's file (its size is the
    vocabulary's, not the data's); each worker builds the tables once. Rows stay where they are: no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = [f"k{i}" for i in range(len(keep))]
    narrow = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kept = narrow.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, memory = _encoder(shared.value)
        for batch in slices(batches, "text", 1_000_000):
            flat, ends = [], [0]
            for value in batch.column("text").to_pylist():
                flat.extend(words.encode(value, memory))
                ends.append(len(flat))
            marks = np.array(flat, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(marks))
            extra = [_texts(_decoder(shared.value), marks, np.array(ends[1:], np.int64))] if back else []
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), ids, *extra], names=[*names, "ids", *["decoded"] * back])

    made = [StructField("ids", ArrayType(IntegerType())), *[StructField("decoded", StringType())] * back]
    out = narrow.mapInArrow(run, StructType([*kept, *made]))
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *[f.name for f in made])


def decoded(tokens: DataFrame, vocabulary: bytes, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``text`` for rows with ``ids``; bytes that are no UTF-8 become the replacement sign. Null ids are empty."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary)
    names = [f"k{i}" for i in range(len(keep))]
    narrow = tokens.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kept = narrow.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _decoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column("ids")
                counts = np.asarray(pa.compute.list_value_length(lists), np.int64)
                values = _texts(words, np.asarray(lists.flatten(), np.int64), np.cumsum(counts))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), values], names=[*names, "text"])

    out = narrow.mapInArrow(run, StructType([*kept, StructField("text", StringType())]))
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "text")
