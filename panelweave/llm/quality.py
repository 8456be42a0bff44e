"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded as a vector of surface
statistics and a learned hidden layer; gated attention, tanh(Vh) * sigmoid(Uh),
weights the passages, the weights sum to one in each document, and a logistic
unit scores the weighted passage vector. Only document labels are learned from.
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

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
PASSAGE = 96  # words of a passage
_LOWER, _UPPER, _DIGIT, _SPACE, _STOP, _SYMBOL, _OTHER = range(1, 8)
FEATURES = 21


class PassageEncoder:
    """Surface statistics of passages of PASSAGE words; the last one may be shorter."""

    def __init__(self) -> None:
        self.kind = np.zeros(0x110000, np.uint8)

    def _kinds(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kind[points]
        if not kinds.all():
            for p in np.unique(points[kinds == 0]).tolist():
                c = chr(p)
                self.kind[p] = (
                    _UPPER if c.isupper() else _LOWER if c.isalpha() else _DIGIT if c.isdigit()
                    else _SPACE if c.isspace() else _STOP if c in ".,;:!?'\"()-" else _SYMBOL if p < 128 else _OTHER
                )
            kinds = self.kind[points]
        return kinds

    def encode(self, text: str) -> np.ndarray:
        """One row for each passage; a text without words is one row of zeros."""
        words = text.split()
        if not words:
            return np.zeros((1, FEATURES), np.float32)
        rows = []
        for begin in range(0, len(words), PASSAGE):
            part = words[begin : begin + PASSAGE]
            n, joined = len(part), " ".join(part)
            share = np.bincount(self._kinds(joined), minlength=8)[1:] / len(joined)
            folded = [w.lower() for w in part]
            counts: dict[str, int] = {}
            for w in folded:
                counts[w] = counts.get(w, 0) + 1
            pairs = set(zip(folded, folded[1:]))
            same = sum(a == b for a, b in zip(folded, folded[1:]))
            lengths = [len(w) for w in part]
            rows.append(
                [
                    *share,
                    len(counts) / n,
                    max(counts.values()) / n,
                    len(pairs) / max(1, n - 1),
                    same / max(1, n - 1),
                    sum(w.isupper() for w in part) / n,
                    sum(not w[-1].isalnum() for w in part) / n,
                    sum(not any(map(str.isalnum, w)) for w in part) / n,
                    sum(w.endswith((".", "!", "?")) for w in part) / n,
                    sum(lengths) / n / 10,
                    max(lengths) / 50,
                    np.log1p(n) / 5,
                    joined.count("!") / len(joined),
                    joined.count("|") / len(joined),
                    np.log1p(len(words)) / 10,
                ]
            )
        return np.array(rows, np.float32)


@lru_cache(maxsize=1)
def _encoder() -> PassageEncoder:
    return PassageEncoder()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Hidden layer, gated attention and logistic unit, trained by Adam on whole bags."""

    def __init__(self, hidden: int = 16, attention: int = 8, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        start = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.mean, self.scale, self.constant = np.zeros(FEATURES), np.ones(FEATURES), None
        self.p = {
            "W": start(FEATURES, hidden), "b": np.zeros(hidden), "V": start(hidden, attention),
            "U": start(hidden, attention), "w": start(attention), "o": start(hidden), "c": np.zeros(1),
        }

    def _forward(self, x: np.ndarray, starts: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        h = np.tanh((x - self.mean) / self.scale @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["o"] + p["c"])}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 300, rate: float = 0.02, decay: float = 1e-4) -> AttentionModel:
        """Without rows the score is 0.5, with rows of one label only it is that label's."""
        if len(set(labels.tolist())) < 2:
            self.constant = float(labels[0]) if len(labels) else 0.5
            return self
        x = np.concatenate(bags).astype(np.float64)
        sizes = np.array([len(b) for b in bags])
        starts, bag = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(bags)), sizes)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        xn, p = (x - self.mean) / self.scale, self.p
        first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        for step in range(1, epochs + 1):
            f = self._forward(x, starts, bag)
            dy = (f["y"] - labels) / len(labels)
            dz = dy[:, None] * p["o"]
            da = (dz[bag] * f["h"]).sum(axis=1)
            de = f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[bag])
            dt, dg = de[:, None] * p["w"] * f["g"], de[:, None] * p["w"] * f["t"]
            dt, dg = dt * (1 - f["t"] ** 2), dg * f["g"] * (1 - f["g"])
            dh = f["a"][:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
            dh *= 1 - f["h"] ** 2
            grads = {
                "W": xn.T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
                "w": (f["t"] * f["g"]).T @ de, "o": f["z"].T @ dy, "c": np.array([dy.sum()]),
            }
            for k, grad in grads.items():
                grad = grad + decay * p[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                p[k] = p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(bags), self.constant)
        sizes = np.array([len(b) for b in bags])
        starts, bag = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(bags)), sizes)
        return self._forward(np.concatenate(bags).astype(np.float64), starts, bag)["y"]


def fit_quality(
    docs: DataFrame, labels: DataFrame, sample_docs: int = 4000, modulus: int = 5, held: int = 0,
    seed: int = 5, key: str = "doc_id", text: str = "text", label: str = "quality",
) -> AttentionModel:
    """Train on at most `sample_docs` labelled documents whose key's remainder is not `held`.

    The sample is the labelled rows with the least hash of the key, so it is the
    same on every run. Only their passage vectors reach the driver: some tens of
    numbers for every 96 words of the sample.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & (remainder(key, modulus) != held))
        .select(F.col(key).cast("long").alias("doc_id"), (F.col(label) > 0).cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_docs)
    )
    rows = keyed_text(docs, key, text).join(F.broadcast(chosen), "doc_id")  # sample_docs rows at most

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = PassageEncoder()
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "y": batch["y"], "bag": [encoder.encode(t).tobytes() for t in batch["text"]]}
            )

    found = rows.mapInPandas(work, "doc_id long, y double, bag binary").toPandas()
    found = found.sort_values(["doc_id", "y", "bag"], kind="stable")
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in found["bag"]]
    return AttentionModel(seed=seed).fit(bags, found["y"].to_numpy(dtype=float))


def score_quality(
    docs: DataFrame, model: AttentionModel, threshold: float = 0.3, modulus: int = 5, held: int = 0,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from the whole text alone.

    A missing text is empty; an empty text is a bag of one passage without words.
    Repeated rows give repeated results; further columns are not read.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = PassageEncoder()
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.iloc[begin : begin + 256]
                keys = [None if pd.isna(k) else int(k) for k in part["doc_id"]]
                scores = model.score([encoder.encode(t) for t in part["text"]])
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(keys, dtype="Int64"),
                        "held_out": [py_remainder(k, modulus) == held for k in keys],
                        "score": scores, "predicted": (scores >= threshold).astype(np.int32),
                    }
                )

    return keyed_text(docs, key, text).mapInPandas(work, SCHEMA)


def classify_quality(docs: DataFrame, labels: DataFrame, sample_docs: int = 4000) -> DataFrame:
    """Learn from the labelled rows and score all rows of `docs`."""
    return score_quality(docs, fit_quality(docs, labels, sample_docs))


def keep_good(docs: DataFrame, model: AttentionModel, threshold: float = 0.3) -> DataFrame:
    """The rows of the documents table that are not rejected, unchanged. Rows stay where they are."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder, texts = _encoder(), [t or "" for t in batch.column("text").to_pylist()]
        scores = [
            model.score([encoder.encode(t) for t in texts[i : i + 256]]) for i in range(0, len(texts), 256)
        ]
        return batch.filter(pa.array(np.concatenate([[], *scores]) >= threshold))

    return map_documents(docs, work)
