"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point.  A run of three letters is bound into one
vector: the first letter's vector permuted twice, times the second's permuted once, times the third's.  A
document is the sum (bundle) of its runs' vectors, a language the bundle of its documents, and a document gets
the language whose profile has the largest cosine.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.common import crc_remainder, map_batches, mix, modest, present, whole_documents

UNKNOWN = "und"
_BOUNDARY = 0
_COLUMNS = 4096  # different runs bundled by one product of matrices
_TEXTS = 256  # texts bundled together
_ROWS = 4 * _TEXTS  # rows whose texts are unpacked together, however many a session puts into a batch


@dataclass(frozen=True)
class Profiles:
    """One unit vector for each language; their number is that of the different labels."""

    languages: tuple[str, ...]
    vectors: np.ndarray


@cache
def _is_letter() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(sys.maxunicode + 1)])


@cache
def _letters() -> np.ndarray:
    """Lower-case letter of each code point, or the boundary mark for what is no letter."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
        elif unicodedata.category(c) in ("Mn", "Mc"):
            table[code] = code  # vowel signs and accents belong to their letter
    return table


def runs(text: str) -> np.ndarray:
    """The three-letter runs of a text, words marked off by one boundary, packed into 63 bits each."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not _is_letter()[codes].any():  # accents alone are no text in a language
        return np.empty(0, np.uint64)
    letters = _letters()[codes]
    letters = np.concatenate([[_BOUNDARY], letters, [_BOUNDARY]])
    letters = letters[np.concatenate([[True], (letters[1:] != _BOUNDARY) | (letters[:-1] != _BOUNDARY)])].astype(np.uint64)
    return letters[:-2] << np.uint64(42) | letters[1:-1] << np.uint64(21) | letters[2:]


def letter_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """Random signs, the same on every machine."""
    words = mix((codes.astype(np.uint64)[:, None] << np.uint64(16)) + np.arange(1, dimensions // 64 + 1, dtype=np.uint64))
    bits = np.unpackbits(mix(words).view(np.uint8).reshape(len(codes), -1), axis=1)
    return (bits.astype(np.int8) * 2 - 1)[:, :dimensions]


def run_vectors(packed: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors of packed runs."""
    parts = [packed >> np.uint64(42), packed >> np.uint64(21) & np.uint64(0x1FFFFF), packed & np.uint64(0x1FFFFF)]
    alphabet = np.unique(np.concatenate(parts))
    base = letter_vectors(alphabet, dimensions)
    a, b, c = (np.roll(base, shift, axis=1)[np.searchsorted(alphabet, part)] for shift, part in zip((2, 1, 0), parts, strict=True))
    return a * b * c


def bundles(texts: list[np.ndarray], dimensions: int) -> np.ndarray:
    """The sum of the bound vectors of each text's runs: exact whole numbers."""
    out = np.zeros((len(texts), dimensions))
    sizes = [len(t) for t in texts]
    if not sum(sizes):
        return out
    different, column = np.unique(np.concatenate(texts), return_inverse=True)
    row = np.repeat(np.arange(len(texts)), sizes)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, len(different), _COLUMNS):
        last = min(first + _COLUMNS, len(different))
        lo, hi = np.searchsorted(column, (first, last))
        counts = np.bincount(row[lo:hi] * (last - first) + column[lo:hi] - first, minlength=len(texts) * (last - first))
        vectors = run_vectors(different[first:last], dimensions).astype(np.float32)
        out += counts.reshape(len(texts), -1).astype(np.float32) @ vectors
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, len(batch), _ROWS):
            yield batch.slice(first, _ROWS)


def learn(documents: DataFrame, dimensions: int = 1024) -> Profiles:
    """Profiles from ``text`` and ``lang`` of every given row; rows without either teach nothing.

    Each task bundles its rows by language; only those sums are shuffled, one number for each language and
    dimension, and the driver gets as many vectors as there are languages.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in _parts(batches):
            texts, languages = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for first in range(0, len(texts), _TEXTS):
                by: dict[str, list[np.ndarray]] = {}
                for text, lang in zip(texts[first : first + _TEXTS], languages[first : first + _TEXTS], strict=True):
                    by.setdefault(lang, []).append(runs(text))
                for lang, found in by.items():
                    sums[lang] = sums.get(lang, 0) + bundles([np.concatenate(found)], dimensions)[0].astype(np.int64)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(range(dimensions), pa.int32()), pa.array(vector)], ["lang", "place", "total"]
            )

    taught = documents.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).dropna()
    sums = map_batches(taught, work, "lang string, place int, total long").groupBy("lang", "place").agg(F.sum("total").alias("total"))
    with modest(documents.sparkSession):
        rows = sums.collect()
    languages = sorted({r.lang for r in rows})
    vectors = np.zeros((len(languages), dimensions))
    for r in rows:
        vectors[languages.index(r.lang), r.place] = r.total
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Profiles(tuple(languages), vectors / np.where(norms == 0, 1, norms))


def identify(documents: DataFrame, profiles: Profiles, *keep: str) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row, from the whole text and nothing else.

    ``score`` is the cosine with the language's profile, at least 0.  Null texts, texts without a letter, and all texts
    when no language was learned, are ``und`` with score 0.  Of equal cosines the first language by name counts.
    ``keep`` names columns to hand through.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            names, scores, _ = predictions(batch.column("text").to_pylist(), profiles)
            handed = [batch.column(c) for c in ("doc_id", *keep)]
            yield pa.RecordBatch.from_arrays([*handed, pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", *keep, "lang_pred", "score"])

    rows = whole_documents(documents, *[F.col(c) for c in keep])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return map_batches(rows, work, f"{schema}, lang_pred string, score double")


def predictions(texts: list[str | None], profiles: Profiles) -> tuple[list[str], list[float], list[int]]:
    """Language, cosine and number of runs of each text."""
    languages, vectors = profiles.languages, profiles.vectors
    names: list[str] = []
    scores: list[float] = []
    sizes: list[int] = []
    for first in range(0, len(texts), _TEXTS):
        found = [runs(present(t)) for t in texts[first : first + _TEXTS]]
        sizes += map(len, found)
        if not languages:
            names += [UNKNOWN] * len(found)
            scores += [0.0] * len(found)
            continue
        own = bundles(found, vectors.shape[1])
        norms = np.linalg.norm(own, axis=1)
        cosines = np.round(own @ vectors.T / np.where(norms == 0, 1, norms)[:, None], 9)
        best = cosines.argmax(axis=1)
        names += [languages[b] if len(f) else UNKNOWN for b, f in zip(best, found, strict=True)]
        scores += np.clip(cosines[np.arange(len(found)), best], 0, 1).tolist()
    return names, scores, sizes


#: Cosine that a text of ``LONG`` runs or more in a learned language has at least.  Vectors of other letters are as good as
#: random, with cosines about zero; a few words of a known language may have no more.
LEAST_SCORE, LONG = 0.1, 100


def identified(documents: DataFrame, profiles: Profiles, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents, all columns, that are in some learned language.

    Null texts and texts without a letter go, and so do those of ``LONG`` runs or more with less than ``least_score``.
    Where no language was learned, no document can be told to be in another one: all with a letter stay.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            texts = batch.column("text").cast(pa.string()).to_pylist()
            if not profiles.languages:
                stays = [len(runs(present(t))) > 0 for t in texts]
            else:
                stays = [n != UNKNOWN and (size < LONG or score >= least_score) for n, score, size in zip(*predictions(texts, profiles), strict=True)]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return map_batches(documents, work, documents.schema)


def held_out(documents: DataFrame) -> F.Column:
    """The quarter of the documents that teaches nothing."""
    return crc_remainder("doc_id", 4) == 2
