"""Language identification with hyperdimensional profiles.

Every character owns a pseudo-random bit vector (a hash of its code point). A letter trigram is bound by XOR of its
three characters' vectors, the first permuted twice, the second once; a text is the bundle (sum over trigrams, as
+1/-1 vectors) and so is a language. A text gets the language whose prototype has the largest cosine.

Bundling is linear, so prototypes are bundled from trigram counts per language: documents contribute counts, and only
distinct (language, trigram) rows ever meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.llm.common import in_slices

UNKNOWN = "und"
DIMENSIONS = 1024
SEED = 2016
# Documents whose trigrams meet in one matrix product, in bytes of text.
SLICE_BYTES = 400_000
_MASK = (1 << 64) - 1
_letters: list[np.ndarray] = []


@dataclass(frozen=True)
class LanguageModel:
    """Prototype vectors, one row per language."""

    languages: tuple[str, ...]
    prototypes: np.ndarray


def _letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def character_vectors(points: np.ndarray, dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """(n, dimensions / 64) words of pseudo-random bits, a pure function of code point and seed (SplitMix64)."""
    words = dimensions // 64
    with np.errstate(over="ignore"):
        z = points.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(1, words + 1, dtype=np.uint64)
        z = (z + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def gram_bits(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """0/1 matrix of bound trigram vectors; a permutation is a rotation by one 64-bit word."""
    points = np.stack([(grams >> np.int64(s)) & np.int64(0x1FFFFF) for s in (42, 21, 0)])
    letters, at = np.unique(points, return_inverse=True)
    table, at = character_vectors(letters, dimensions), at.reshape(points.shape)
    bound = np.roll(table, 2, axis=1)[at[0]] ^ np.roll(table, 1, axis=1)[at[1]] ^ table[at[2]]
    return np.unpackbits(bound.view(np.uint8), axis=1)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All trigrams (packed code points) of lower-cased texts and the row each comes from.

    Whatever is not a letter separates words and counts as one space, also before the first and after the last.
    """
    lowered = [t.lower() for t in texts]
    points = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letter_table()[points]
    row = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    keep = letter[1:] | letter[:-1]
    kept = np.where(letter, points, 32)[1:][keep].astype(np.int64)
    row = row[keep]
    # Each row now reads "word word word "; the space that ends it also stands before its first word.
    first = np.flatnonzero(np.diff(row, prepend=-1))
    kept, row = np.insert(kept, first, 32), np.insert(row, first, row[first])
    if len(kept) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    packed = (kept[:-2] << 42) | (kept[1:-1] << 21) | kept[2:]
    whole = row[:-2] == row[2:]
    return packed[whole], row[:-2][whole]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def _count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language, summed over slices before they are shuffled."""
    for batch in in_slices(batches, "text", 4 * SLICE_BYTES):
        names, codes = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
        grams, row = trigrams(_texts(batch))
        order = codes[row]
        for k, name in enumerate(names):
            found, n = np.unique(grams[order == k], return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * len(found), pa.string()), "gram": pa.array(found, pa.int64()),
                "n": pa.array(n, pa.int64())})


def fit(labelled: DataFrame, dimensions: int = DIMENSIONS) -> LanguageModel:
    """Prototypes from all rows of ``labelled`` (text, lang) that have both.

    Only languages x dimensions numbers reach the driver. Without labelled text there are no languages.
    """
    counts = (
        labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
        .mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )

    def bundle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            grams, n = batch.column("gram").to_numpy(), batch.column("n").to_numpy()
            for lo in range(0, len(grams), 4096):
                bits = 1.0 - 2.0 * gram_bits(grams[lo:lo + 4096], dimensions)
                for lang in set(langs[lo:lo + 4096]):
                    here = langs[lo:lo + 4096] == lang
                    vector = n[lo:lo + 4096][here].astype(float) @ bits[here]
                    sums[lang] = sums.get(lang, 0.0) + vector
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * dimensions), "dim": pa.array(range(dimensions), pa.int32()),
                "value": pa.array(vector, pa.float64())})

    rows = (
        counts.mapInArrow(bundle, "lang string, dim int, value double")
        .groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect()
    )
    languages = tuple(sorted({r["lang"] for r in rows}))
    prototypes = np.zeros((len(languages), dimensions))
    for r in rows:
        prototypes[languages.index(r["lang"]), r["dim"]] = r["value"]
    return LanguageModel(languages, prototypes)


def classify(texts: list[str], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Language and cosine (0 where negative) per text; ``und`` and 0 without a letter or without languages."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    grams, row = trigrams(texts)
    if not len(grams) or not model.languages:
        return names, scores
    distinct, at = np.unique(grams, return_inverse=True)
    rows, which = np.unique(row, return_inverse=True)
    units = model.prototypes / np.maximum(np.linalg.norm(model.prototypes, axis=1, keepdims=True), 1e-12)
    bundles = np.zeros((len(rows), units.shape[1]), np.float32)
    for lo in range(0, len(distinct), 8192):
        here = (at >= lo) & (at < lo + 8192) if len(distinct) > 8192 else slice(None)
        width = min(8192, len(distinct) - lo)
        counts = np.bincount(which[here] * width + (at[here] - lo), minlength=len(rows) * width)
        counts = counts.reshape(len(rows), width).astype(np.float32)
        bits = gram_bits(distinct[lo:lo + width], units.shape[1]).astype(np.float32)
        bundles += counts.sum(axis=1, keepdims=True) - 2 * (counts @ bits)
    cosines = bundles @ units.T / np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-12)
    best = cosines.argmax(axis=1)
    for r, k, cosine in zip(rows, best, cosines[np.arange(len(rows)), best], strict=True):
        names[r] = model.languages[k]
        scores[r] = min(1.0, max(0.0, float(cosine)))
    return names, scores


def identify(docs: DataFrame, model: LanguageModel, keys: list[str]) -> DataFrame:
    """``keys`` of every document, ``lang_pred`` and ``score`` (cosine with that language's prototype, 0 to 1).

    A null text, or one without a letter, is ``und`` with score 0; whole texts are read, repeated rows are scored alike.
    """
    source = docs.select(*keys, "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keys)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text", SLICE_BYTES):
            names, scores = classify(_texts(batch), model)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*keys, "lang_pred", "score"])

    return source.mapInArrow(score, f"{fields}, lang_pred string, score double")


def recognised(docs: DataFrame, model: LanguageModel, min_score: float) -> DataFrame:
    """Documents, all columns, whose text is in a known language with at least ``min_score``."""

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text", SLICE_BYTES):
            names, scores = classify(_texts(batch), model)
            yield batch.filter(pa.array([n != UNKNOWN and s >= min_score for n, s in zip(names, scores, strict=True)]))

    return docs.mapInArrow(keep, docs.schema)


def held_out(doc_id: Column) -> Column:
    """A third of the documents, by the CRC of their id, from which nothing is learned; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the documents that are not held out."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    named = identify(docs, model, ["doc_id"])
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
