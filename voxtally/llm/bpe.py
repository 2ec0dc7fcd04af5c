"""Byte-pair encoding and decoding with a tokenization automaton.

The merge list is compiled into a deterministic automaton over tokens.  It starts
with one state and an arc for each byte.  Each merge ``u v -> w``, in order,
adds a gadget: ``w`` gets an arc wherever ``u`` has one (and ``v`` may follow),
its state is a copy of the state after ``v``, and the arc ``v`` out of the state
after ``u`` goes.  A token sequence is the encoding of its text exactly when the
finished automaton has a path for it.

The finished table has a cell for every pair of tokens, so only what gadgets
changed is stored: for a state the one it copies, for an arc the one it copies, and
the removed arcs.  A cell is looked up by following the copies back through the
gadgets, and kept once known.  Of the paths that spell a word exactly one is
accepted; it is found from left to right.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from voxtally.llm.common import map_batches, present, whole_documents

#: Fixed value: how byte-level vocabularies cut text before merging.
SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

#: A space that more white space or the end follows.
CROWDED = regex.compile(r" (?:\s|\Z)")

#: Words, and cells of the table, that a task remembers; both only save time.
REMEMBERED_WORDS = 400_000
REMEMBERED_CELLS = 1_000_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Pieces(dict):
    """Piece of a text to the packed ids of its encoding."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        found = self[piece] = np.array(self.automaton.path(piece.encode()), "<u4").tobytes()
        return found


class _Words(_Pieces):
    """Run of pieces to the packed ids of all of them."""

    def __missing__(self, run: str) -> bytes:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        found = self[run] = b"".join(map(self.automaton.pieces.__getitem__, SPLIT.findall(run)))
        return found


class Automaton:
    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as f:
            told = json.load(f)
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.labels: dict[int, bytes] = {i: text.encode() for text, i in self.special.items()}
        ids = told["model"]["vocab"]
        as_bytes = lambda text: bytes(letters[c] for c in text)
        #: Spelling of the arcs that can be reached.
        self.arcs: dict[bytes, int] = {}
        self.made: dict[int, int] = {}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.removed: dict[tuple[int, int], int] = {}
        self.cells: dict[tuple[int, int], bool] = {}
        for text, i in ids.items():
            if text not in self.special:
                self.labels[i] = as_bytes(text)
                if len(self.labels[i]) == 1:
                    self.arcs[self.labels[i]], self.made[i] = i, -1
        for step, merge in enumerate(told["model"]["merges"]):
            u, v = merge.split(" ") if isinstance(merge, str) else merge
            self.add_gadget(step, ids[u], ids[v], ids[u + v])
        #: Length of the longest arc that begins with three bytes, and the next shorter arc along an arc's label.
        self.reach: dict[bytes, int] = {}
        self.shorter: dict[int, int] = {}
        for label, token in self.arcs.items():
            self.reach[label[:3]] = max(len(label), self.reach.get(label[:3], 2))
            self.shorter[token] = next((self.arcs[label[:k]] for k in range(len(label) - 1, 0, -1) if label[:k] in self.arcs), -1)
        self.pieces, self.words = _Pieces(self), _Words(self)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def add_gadget(self, step: int, u: int, v: int, w: int) -> None:
        """Merge ``u v`` into ``w``; a merge whose arcs earlier gadgets removed can never happen."""
        if u not in self.made or v not in self.made or w in self.made or not self._follow(u, v, step):
            return
        self.made[w], self.left[w], self.right[w] = step, u, v
        self.removed[u, v] = step
        self.arcs[self.labels[w]] = w

    def _follow(self, x: int, y: int, before: int = 1 << 62) -> bool:
        """Whether the state after ``x`` had an arc ``y`` when ``before`` gadgets were in place."""
        removed, made = self.removed, self.made
        while True:
            if removed.get((x, y), before) < before:
                return False
            if made[x] < 0 and made[y] < 0:
                return True
            if made[x] >= made[y]:
                before, x = made[x], self.right[x]
            else:
                before, y = min(before, made[y] + 1), self.left[y]

    def follows(self, x: int, y: int) -> bool:
        known = self.cells.get((x, y))
        if known is None:
            if len(self.cells) >= REMEMBERED_CELLS:
                self.cells.clear()
            known = self.cells[x, y] = self._follow(x, y)
        return known

    def path(self, word: bytes) -> list[int]:
        """The accepted path that spells ``word``.

        The longest arc comes first, then shorter ones.  A place is reached by one path only, namely the
        encoding of what is before it, so a place from which nothing leads on need never be tried again.
        """
        labels, shorter, cells, n = self.labels, self.shorter, self.cells, len(word)
        tokens: list[int] = []
        places = [0]
        dead: set[int] = set()
        start, token = 0, self._longest(word, 0)
        while True:
            while token >= 0:
                end = start + len(labels[token])
                if end not in dead:
                    if not tokens:
                        break
                    known = cells.get((tokens[-1], token))
                    if known or known is None and self.follows(tokens[-1], token):
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                if end == n:
                    return tokens
                places.append(end)
                start, token = end, self._longest(word, end)
            else:
                dead.add(places.pop())
                start, token = places[-1], shorter[tokens.pop()]

    def _longest(self, word: bytes, start: int) -> int:
        arcs = self.arcs
        for end in range(min(len(word), start + self.reach.get(word[start : start + 3], 2)), start, -1):
            token = arcs.get(word[start:end])
            if token is not None:
                return token
        raise ValueError("the vocabulary lacks a byte")

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.specials is None or not any(s in text for s in self.special):
            return self.encode_ordinary(text)
        return b"".join(
            np.array([self.special[part]], "<u4").tobytes() if part in self.special else self.encode_ordinary(part)
            for part in self.specials.split(text)
        )

    def encode_ordinary(self, text: str) -> bytes:
        """As ``encode``, but special tokens' strings are ordinary text.

        Pieces begin at every space between two other characters, so what is between such spaces can be remembered.
        """
        if CROWDED.search(text):
            return b"".join(map(self.pieces.__getitem__, SPLIT.findall(text)))
        first, *rest = text.split(" ")
        look = self.words.__getitem__
        return look(first) + b"".join([look(" " + run) for run in rest])

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, one after another."""
        return b"".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@cache
def automaton(file: str) -> Automaton:
    """Compiled once in each worker."""
    return Automaton(file)


@contextmanager
def coding(file: str) -> Iterator[Automaton]:
    """A worker's automaton for one task.  The worker goes on to other stages and takes the automaton along, but no words and
    cells: any of them would keep the memory of those around it."""
    coder = automaton(file)
    try:
        yield coder
    finally:
        coder.pieces.clear()
        coder.words.clear()
        coder.cells.clear()


def tokenize(documents: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, ``token_ids`` (array of int) and ``decoded`` of every whole text.

    A null text is an empty one: no tokens.  Special tokens' strings in a text become their id, as the file says.
    Rows are treated alone, so repeated rows give repeated results, and a null ``doc_id`` stays null.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with coding(vocabulary) as coder:
            for batch in batches:
                packed = [coder.encode(present(t)) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"),
                    pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in packed], pa.list_(pa.int32())),
                    pa.array([coder.decode(p) for p in packed], pa.string()),
                ], ["doc_id", "token_ids", "decoded"])

    return map_batches(whole_documents(documents), work, "doc_id long, token_ids array<int>, decoded string")


def digests(documents: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """Token count and digests of ids and decoded text for every document, without moving either; on request the ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with coding(vocabulary) as coder:
            for batch in batches:
                counts, ids, decoded, kept = [], [], [], []
                for text in batch.column("text"):
                    packed = coder.encode(present(text.as_py()))
                    counts.append(len(packed) // 4)
                    ids.append(hashlib.sha256(packed).hexdigest())
                    decoded.append(hashlib.sha256(coder.decode(packed).encode()).hexdigest())
                    if with_ids:
                        kept.append(np.frombuffer(packed, np.int32))
                arrays = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    arrays.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return map_batches(whole_documents(documents), work, SCHEMA + (", token_ids array<int>" if with_ids else ""))
