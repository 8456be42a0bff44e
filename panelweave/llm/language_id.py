"""Language of texts by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. The vector of an n-gram is the
product (binding) of its letters' vectors, each rotated (permuted) by its place;
a text's vector is the sum (bundle) of its n-grams' vectors; a language's
prototype is the sum of its training texts' vectors, each divided by the number
of its n-grams. The prototype with the highest cosine gives the language.

The bundle is linear in the n-gram counts. Training therefore sums counts inside
each task and multiplies by the n-gram vectors once; only one vector for each
language and task is shuffled, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm.texts import keyed_text, map_documents, py_remainder, remainder

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
UNDETERMINED = "und"
# Texts unrelated to a prototype have cosines around 0 with a deviation of 1/sqrt(dim), 0.03 at 1024. Of the
# 10,000 documents of sf0.1, one (of a single word) lies below 0.05; all of sf0.01 lie above 0.08.
LEAST_COSINE = 0.05
# A text contradicts its `lang` if another prototype is nearer by more than chance and short texts make it.
LEAST_MARGIN = 0.15
_BITS = 21  # bits of a code point
_ROWS = 16_384  # n-gram vectors a task keeps at most
_SLICE = 4096  # n-gram vectors multiplied at once
_BATCH = 64  # texts multiplied at once


class Codebook:
    """N-gram vectors made from seeded letter vectors; rows are made when first met."""

    def __init__(self, dim: int, seed: int) -> None:
        self.dim, self.seed = dim, seed
        self.letters: dict[int, np.ndarray] = {}
        self.kind = np.full(0x110000, -1, np.int8)  # -1 not met yet, 0 no letter, 1 letter
        self.clear()

    def clear(self) -> None:
        self.row: dict[int, int] = {}
        self.matrix = np.empty((1024, self.dim), np.float32)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            rng = np.random.default_rng([self.seed, point])
            self.letters[point] = rng.integers(0, 2, self.dim).astype(np.float32) * 2 - 1
        return self.letters[point]

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Rows of the matrix for distinct trigram codes."""
        if len(self.row) + len(codes) > max(_ROWS, len(codes)):
            self.clear()
        found = np.empty(len(codes), np.int64)
        for i, code in enumerate(codes.tolist()):
            at = self.row.get(code)
            if at is None:
                at = self.row[code] = len(self.row)
                if at == len(self.matrix):
                    self.matrix = np.concatenate([self.matrix, np.empty_like(self.matrix)])
                mask = (1 << _BITS) - 1
                a, b, c = code >> 2 * _BITS, code >> _BITS & mask, code & mask
                self.matrix[at] = np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)
            found[i] = at
        return found

    def trigrams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigram codes of the letters of a text and their counts; words are bounded by 0."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        kind = self.kind[points]
        if (kind < 0).any():
            for p in np.unique(points[kind < 0]).tolist():
                self.kind[p] = chr(p).isalpha()
            kind = self.kind[points]
        points = np.concatenate([[0], np.where(kind > 0, points, 0), [0]])
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
        points = points[keep]
        if len(points) < 3:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.unique(points[:-2] << 2 * _BITS | points[1:-1] << _BITS | points[2:], return_counts=True)

    def bundle(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One vector for each text."""
        out = np.zeros((len(grams), self.dim), np.float32)
        filled = [i for i, (codes, _) in enumerate(grams) if len(codes)]
        if not filled:
            return out
        every = np.unique(np.concatenate([grams[i][0] for i in filled]))
        for begin in range(0, len(every), _SLICE):
            part = every[begin : begin + _SLICE]
            counts = np.zeros((len(grams), len(part)), np.float32)
            for i in filled:
                codes, n = grams[i]
                lo, hi = np.searchsorted(codes, [part[0], part[-1] + 1])
                counts[i, np.searchsorted(part, codes[lo:hi])] = n[lo:hi]
            at = self.rows(part)
            out += counts @ self.matrix[at]
        return out


def fit_prototypes(
    docs: DataFrame, dim: int = 1024, seed: int = 17, modulus: int = 4, held: int = 2,
    key: str = "doc_id", text: str = "text", lang: str = "lang",
) -> dict[str, np.ndarray]:
    """Unit prototype of each language, from rows with a language whose key's remainder is not `held`."""
    rows = docs.filter(F.col(lang).isNotNull() & (remainder(key, modulus) != held)).select(
        F.col(lang).cast("string").alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = _codebook(dim, seed)
        total: dict[str, np.ndarray] = {}

        def flush(weights: dict[str, dict[int, float]]) -> None:
            for name, own in weights.items():
                codes = np.array(sorted(own), np.int64)
                vector = book.bundle([(codes, np.array([own[c] for c in codes.tolist()]))])[0]
                total[name] = total.get(name, 0) + vector.astype(np.float64)
            weights.clear()

        weights: dict[str, dict[int, float]] = {}
        for batch in batches:
            for name, body in zip(batch["lang"], batch["text"]):
                codes, n = book.trigrams(body)
                own = weights.setdefault(name, {})
                for code, share in zip(codes.tolist(), (n / max(1, n.sum())).tolist()):
                    own[code] = own.get(code, 0.0) + share
                if len(own) > 4 * _ROWS:
                    flush(weights)
        flush(weights)
        for name, vector in total.items():
            yield pd.DataFrame({"lang": name, "i": np.arange(dim, dtype=np.int32), "x": vector})

    summed = (
        rows.mapInPandas(sums, "lang string, i int, x double")
        .groupBy("lang", "i").agg(F.sum("x").alias("x"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
    )
    found = {}
    for row in summed.collect():  # one vector for each language
        vector = np.array([x["x"] for x in row["v"]])
        norm = np.linalg.norm(vector)
        if norm:
            found[row["lang"]] = vector / norm
    return dict(sorted(found.items()))


def _named(prototypes: dict[str, np.ndarray], dim: int) -> tuple[list[str], np.ndarray]:
    return list(prototypes), np.array(list(prototypes.values()), np.float32).reshape(len(prototypes), dim)


@lru_cache(maxsize=1)
def _codebook(dim: int, seed: int) -> Codebook:
    """One for each Python worker, whatever the number of its tasks."""
    return Codebook(dim, seed)


def _predict(
    book: Codebook, names: list[str], table: np.ndarray, texts: list[str], sharpness: float
) -> tuple[list[str], list[float], np.ndarray]:
    """Language and softmax share of each text, and its cosines with all prototypes."""
    if not names:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts), np.zeros((len(texts), 0))
    predicted, scores, all_cosines = [], [], []
    for begin in range(0, len(texts), _BATCH):
        vectors = book.bundle([book.trigrams(t) for t in texts[begin : begin + _BATCH]])
        norms = np.linalg.norm(vectors, axis=1)
        known = norms > 0
        cosines = (vectors @ table.T) / np.where(known, norms, 1)[:, None]
        best = cosines.argmax(axis=1)
        odds = np.exp(sharpness * (cosines - cosines.max(axis=1, keepdims=True)))
        share = odds.max(axis=1) / odds.sum(axis=1)
        predicted += [names[b] if k else UNDETERMINED for b, k in zip(best, known)]
        scores += [float(s) if k else 0.0 for s, k in zip(share, known)]
        all_cosines.append(cosines)
    return predicted, scores, np.concatenate([np.zeros((0, len(names))), *all_cosines])


def predict_language(
    docs: DataFrame, prototypes: dict[str, np.ndarray], dim: int = 1024, seed: int = 17,
    modulus: int = 4, held: int = 2, sharpness: float = 20.0, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    score is the softmax of the cosines times `sharpness`, taken at the predicted
    language. A missing or empty text, a text without letters, and every text if
    nothing was learned get `und` and 0. Ties go to the first name. Repeated rows
    give repeated results; further columns of the input are not read.
    """
    names, table = _named(prototypes, dim)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = _codebook(dim, seed)
        for batch in batches:
            keys = [None if pd.isna(k) else int(k) for k in batch["doc_id"]]
            predicted, scores, _ = _predict(book, names, table, batch["text"].tolist(), sharpness)
            yield pd.DataFrame(
                {
                    "doc_id": pd.array(keys, dtype="Int64"),
                    "held_out": [py_remainder(k, modulus) == held for k in keys],
                    "lang_pred": predicted, "score": scores,
                }
            )

    return keyed_text(docs, key, text).mapInPandas(work, SCHEMA)


def identify_language(docs: DataFrame, dim: int = 1024, seed: int = 17) -> DataFrame:
    """Learn the prototypes from `docs` and predict all its rows."""
    return predict_language(docs, fit_prototypes(docs, dim, seed), dim, seed)


def keep_known(
    docs: DataFrame, prototypes: dict[str, np.ndarray], dim: int = 1024, seed: int = 17, sharpness: float = 20.0,
    least: float = LEAST_COSINE, margin: float = LEAST_MARGIN,
) -> DataFrame:
    """The rows of the documents table whose text is in a learned language. Rows stay where they are.

    least   cosine with the best prototype below which a text is in none of the languages
    margin  by which the best cosine exceeds that of `lang` where the text contradicts it

    The predicted language replaces a `lang` that is missing, was not learned or is contradicted.
    """
    names, table = _named(prototypes, dim)
    place = {x: i for i, x in enumerate(names)}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        predicted, _, cosines = _predict(_codebook(dim, seed), names, table, texts, sharpness)
        decided = []
        for lang, best, own in zip(batch.column("lang").to_pylist(), predicted, cosines):
            if best == UNDETERMINED or own.max() < least:
                decided.append(None)
            else:
                decided.append(best if lang not in place or own.max() - own[place[lang]] >= margin else lang)
        found = pa.array(decided, batch.schema.field("lang").type)
        columns = {n: batch.column(n) for n in batch.schema.names}
        columns["lang"] = found
        return pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema).filter(found.is_valid())

    return map_documents(docs, work)
