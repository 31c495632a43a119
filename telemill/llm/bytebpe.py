"""Byte-level BPE encoding and decoding by backtracking over longest matches.

Every token is a word of an Aho-Corasick automaton over Latin-1 characters, one per byte. From
the left, the longest token that starts here is taken if it may stand next to the token before
it: two tokens may when the merges of their joined bytes give just these two, which is worked
out once per pair and remembered. A sequence whose neighbours all agree is the merges' own
result, and the result for a prefix is unique; so where no token fits, the last one gives way to
the next shorter and its end is never tried again. Time is linear in the bytes of a piece.

Texts are cut by the vocabulary's pattern first. Its ``\\p{L}`` and ``\\p{N}`` depend on the
version of Unicode: the classes are asked of the library whose results are to be met, and texts
with characters on which the ``regex`` module differs are cut by explicit ranges.

Null and empty texts have no ids and decode to no bytes. Repeated rows are encoded each by
itself. An empty table gives no rows. Only the id and text columns are read. An id outside the
vocabulary can't be decoded and raises.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame

from telemill.llm.common import Memo, arrow_map, per_worker, strings, texts

PIECES = 250_000  # encoded pieces kept per worker
PAIRS = 400_000  # judged pairs of tokens kept per worker


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens that merging the lowest-ranked neighbours, the first of equals, leaves of a short piece."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        joined = [ranks.get(a + b, len(ranks)) for a, b in zip(parts, parts[1:])]
        best = min(joined, default=len(ranks))
        if best == len(ranks):
            return parts
        at = joined.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


class Codec:
    """Encoder of pieces and decoder of ids for one table of ranks (from 0, without gaps)."""

    def __init__(self, ranks: dict[bytes, int]):
        if sorted(ranks.values()) != list(range(len(ranks))):
            raise ValueError("ranks must count from 0 without gaps")
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks = ranks
        self.tokens = sorted(ranks, key=ranks.get)
        self.sizes = [len(t) for t in self.tokens]
        self.reach = max(self.sizes)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self._shorter: dict[int, int | None] = {}
        self._steps: dict[int, tuple] = {}
        self._agree: dict[tuple[int, int], bool] = {}

    def steps(self, token: int) -> tuple[list[int], list[bytes], list[bytes]]:
        """How a token is merged: the rank of each step, and the first and the last part before each
        step and at the end. Steps end with an endless rank."""
        if token not in self._steps:
            body, never = self.tokens[token], len(self.ranks)
            parts = [body[i : i + 1] for i in range(len(body))]
            ranks, first, last = [], [parts[0]], [parts[-1]]
            while len(parts) > 1:
                joined = [self.ranks.get(a + b, never) for a, b in zip(parts, parts[1:])]
                at = joined.index(min(joined))
                if joined[at] == never:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                ranks.append(joined[at])
                first.append(parts[0])
                last.append(parts[-1])
            self._steps[token] = [*ranks, never], first, last
        return self._steps[token]

    def agree(self, left: int, right: int) -> bool:
        """Whether merging leaves the two tokens as they are when one follows the other.

        Until a merge crosses the border, each side's steps are those it takes alone, the lower rank
        first and the left side first of equals; so they are played against each other, and the
        pair at the border must never be next.
        """
        found = self._agree.get((left, right))
        if found is None:
            if len(self._agree) >= PAIRS:
                self._agree.clear()
            found = self._agree[left, right] = self._border_holds(left, right)
        return found

    def _border_holds(self, left: int, right: int) -> bool:
        (mine, _, last), (theirs, first, _) = self.steps(left), self.steps(right)
        never = len(self.ranks)
        if last[-1] != self.tokens[left] or first[-1] != self.tokens[right]:
            return False  # a token that merges never make
        i = j = 0
        while True:
            crossing = self.ranks.get(last[i] + first[j], never)
            if crossing < mine[i] and crossing <= theirs[j] and crossing < never:
                return False
            if mine[i] == theirs[j] == never:
                return True
            if mine[i] <= theirs[j]:
                i += 1
            else:
                j += 1

    def shorter(self, token: int) -> int | None:
        """The longest token that begins this one."""
        if token not in self._shorter:
            body = self.tokens[token]
            self._shorter[token] = next((self.ranks[body[:n]] for n in range(len(body) - 1, 0, -1) if body[:n] in self.ranks), None)
        return self._shorter[token]

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        chars, dead = piece.decode("latin-1"), bytearray(len(piece) + 1)
        # Only as far as a token may reach: the automaton copies what it is given.
        longest = lambda at: next(self.automaton.iter_long(chars[at : at + self.reach]))[1]
        ids, at, token = [], 0, longest(0)
        while True:
            while token is not None and (dead[at + self.sizes[token]] or ids and not self.agree(ids[-1], token)):
                token = self.shorter(token)
            if token is None:
                dead[at] = 1
                if not ids:
                    raise ValueError("the ranks are no merge table: a piece has no encoding")
                at -= self.sizes[ids[-1]]
                token = self.shorter(ids.pop())
                continue
            ids.append(token)
            at += self.sizes[token]
            if at == len(piece):
                return ids
            token = longest(at)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache
def differing(classes: tuple[str, ...] = (r"\p{L}", r"\p{N}")) -> tuple[str, dict[str, str]]:
    """Characters on which the ``regex`` module and tiktoken differ, and tiktoken's classes, as ranges."""
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    single = {bytes([b]): b for b in range(256)}
    doubtful, ranges = set(), {}
    for name in classes:
        own = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={})
        members = set(bytes(own.encode_ordinary(every)).decode())
        doubtful |= members ^ set(regex.findall(name, every))
        ranges[name] = _as_ranges(members)
    return _as_ranges(doubtful), ranges


def _as_ranges(chars: set[str]) -> str:
    points = np.array(sorted(map(ord, chars)), np.int64)
    starts = np.flatnonzero(np.diff(points, prepend=-2) != 1)
    ends = np.append(starts[1:], len(points)) - 1
    return "".join(f"\\U{points[s]:08X}-\\U{points[e]:08X}" for s, e in zip(starts, ends))


class Cutter:
    """Cuts texts at the matches of a pattern, as tiktoken would."""

    def __init__(self, pattern: str):
        self.pattern = pattern
        self.plain = regex.compile(pattern).findall
        doubtful, self.ranges = differing()
        self.doubtful = regex.compile(f"[{doubtful}]").search if doubtful else lambda text: None
        self._exact = None

    def exact(self, text: str) -> list[str]:
        if self._exact is None:
            self._exact = regex.compile(explicit(self.pattern, self.ranges)).findall
        return self._exact(text)

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or not self.doubtful(text):
            return self.plain(text)
        return self.exact(text)


def explicit(pattern: str, ranges: dict[str, str]) -> str:
    """The pattern with its Unicode classes written as ranges, bracketed where they stand alone."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        name = next((n for n in ranges if pattern.startswith(n, at)), None)
        if name:
            out.append(ranges[name] if inside else f"[{ranges[name]}]")
            at += len(name)
            continue
        step = 2 if pattern[at] == "\\" else 1
        inside = (inside or pattern[at] == "[") and pattern[at] != "]"
        out.append(pattern[at : at + step])
        at += step
    return "".join(out)


class Encoder:
    """Texts to little-endian unsigned 32-bit ids and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.codec, self.cut = Codec(ranks), Cutter(pattern)
        self.pieces = Memo(self._piece, PIECES)

    def _piece(self, piece: str) -> bytes:
        ids = self.codec.encode_piece(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.cut(text)))

    def decode(self, ids: bytes) -> bytes:
        return self.codec.decode(np.frombuffer(ids, "<u4"))


def encoder(vocabulary: str, pattern: str = public_tokenizers.PATTERN) -> Encoder:
    """The worker's encoder for a file of ranks; one for both directions, as workers take turns."""
    return per_worker(("bytebpe", vocabulary, pattern), lambda: Encoder(read_ranks(vocabulary), pattern))


def encode(docs: DataFrame, vocabulary: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) for every row: ids as little-endian unsigned 32-bit integers. One pass, no shuffle."""
    rows = texts(docs, id_col, text_col)

    def work(batch):
        ids = list(map(encoder(vocabulary, pattern).encode, strings(batch.column(1))))
        yield {"doc_id": batch.column(0), "n_tokens": [len(x) // 4 for x in ids], "ids": ids}

    return arrow_map(rows, work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary")


def decode(encoded: DataFrame, vocabulary: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the bytes that the ids stand for; null ids stand for none."""
    rows = encoded.select("doc_id", "n_tokens", "ids")

    def work(batch):
        ids = [x or b"" for x in batch.column(2).to_pylist()]
        own = encoder(vocabulary, pattern)
        yield {"doc_id": batch.column(0), "n_tokens": batch.column(1), "ids": ids, "decoded": list(map(own.decode, ids))}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, work, f"doc_id {kind}, n_tokens long, ids binary, decoded binary")
