"""Personal data in texts: fixed patterns, made consistent by a skip-chain conditional random field.

Tokens that hold a digit or an @ are the nodes; all other tokens are observed to
be outside. Neighbouring nodes share a chain potential. Nodes whose letters and
digits are the same or similar, however distant, share a skip potential, so that
an entity has the same label wherever a document repeats it. Spans of the fixed
patterns are observed labels; loopy sum-product message passing gives the
marginals of the others. A confident run of nodes becomes a further span if skip
edges link one of its nodes to an observed entity of the same kind, or if the run
alone meets its kind's pattern (which had missed it among its neighbours), so
that documents without personal data are left alone.

The potentials are learned piecewise from the labels the patterns give: counts of
(feature, label), of neighbouring labels and of labels joined by a skip edge, all
summed over the whole corpus. Features are hashed, so these tables are bounded.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm.texts import keyed_text, map_documents

KINDS = ("email", "ip", "card", "phone")
SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)
BUCKETS = 4096
_N = len(KINDS) + 1  # labels: 0 outside, then the kinds

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never begins inside a run of digits, so looking behind only saves time
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_NOT_WORD = re.compile(r"[\W_]+")
_DIGITS = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # start, label, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: a match begins where the run of local characters before it does."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            yield begin, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then kind; code points, end exclusive."""
    found: list[Span] = []
    if "@" in text:
        found += [(a, 1, b) for a, b in _emails(text)]
    if _SIGN.search(text):
        for m in _IP.finditer(text):
            if all(len(p) < 20 and int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 2, m.end()))
        for m in _CARD.finditer(text):
            digits = _DIGITS.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 3, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                    found.append((m.start(), 4, m.end()))
    return sorted(found)


def nodes(text: str) -> list[tuple[int, int]]:
    """Runs without white space that hold a digit or an @."""
    found, done = [], 0
    for m in _SIGN.finditer(text):
        at = m.start()
        if at < done:
            continue
        begin = at
        while begin > done and not text[begin - 1].isspace():
            begin -= 1
        end = at
        while end < len(text) and not text[end].isspace():
            end += 1
        found.append((begin, end))
        done = end
    return found


def _features(text: str, begin: int, end: int) -> list[int]:
    token = text[begin:end]
    short = token if len(token) <= 64 else token[:32] + token[-32:]
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", short))
    digits = sum(c.isdigit() for c in token)
    before = text[max(0, begin - 24) : begin].split()
    names = (
        f"s{shape}", f"r{re.sub(r'9+', '9', shape)}", f"n{min(digits, 20)}", f"l{min(len(token), 40) // 4}",
        f"p{before[-1].lower() if before else ''}", f"@{'@' in token}{token.count('.')}", f"+{token[0]}{token[-1]}",
    )
    return [zlib.crc32(n.encode()) % BUCKETS for n in names]


def _keys(token: str) -> list[str]:
    """Normal forms that make two tokens the same or similar; weak ones have none."""
    plain = _NOT_WORD.sub("", token).lower()
    digits = _DIGITS.sub("", token)
    keys = [f"w{plain}"] if len(plain) >= 5 else []
    if len(digits) >= 7:
        keys.append(f"d{digits[-7:]}")
    return keys


class Graph:
    """Nodes and edges of a batch of documents; documents are separate components."""

    def __init__(self) -> None:
        self.features: list[list[int]] = []
        self.label: list[int] = []
        self.place: list[tuple[int, int, int]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, doc: int, text: str, base: list[Span]) -> None:
        last: dict[str, int] = {}
        before, at = None, 0
        for begin, end in nodes(text):
            i = len(self.label)
            while at < len(base) and base[at][2] <= begin:
                at += 1
            label = next((k for a, k, b in base[at : at + 4] if a < end and b > begin), 0)
            self.features.append(_features(text, begin, end))
            self.label.append(label)
            self.place.append((doc, begin, end))
            if before is not None and text[before:begin].isspace():
                self.chain.append((i - 1, i))
            before = end
            for j in {last[k] for k in _keys(text[begin:end]) if k in last}:
                self.skip.append((j, i))
            last |= dict.fromkeys(_keys(text[begin:end]), i)


    def supported(self) -> np.ndarray:
        """For each node and label: whether skip edges lead to an observed node of that label."""
        root = list(range(len(self.label)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for a, b in self.skip:
            root[find(b)] = find(a)
        roots = np.array([find(i) for i in range(len(root))], dtype=np.int64)
        seen = np.zeros((len(root), _N), bool)
        seen[roots, np.array(self.label, dtype=np.int64)] = True
        return seen[roots]


class Potentials:
    """Log potentials from the summed counts."""

    def __init__(self, counts: dict[tuple[str, int, int], int], smooth: float = 0.5) -> None:
        unary, chain, skip = np.full((BUCKETS, _N), smooth), np.full((_N, _N), smooth), np.full((_N, _N), smooth)
        prior = np.full(_N, smooth)
        for (kind, a, b), n in counts.items():
            if kind == "u":
                unary[a, b] += n
            elif kind == "l":
                prior[b] += n
            elif kind == "c":
                chain[a, b] += n
            else:
                skip[a, b] += n
                skip[b, a] += n
        self.prior = np.log(prior / prior.sum())
        rows = (unary + 2 * prior / prior.sum()) / (unary + 2 * prior / prior.sum()).sum(axis=1, keepdims=True)
        self.unary = np.log(rows) - self.prior
        # a pair's factor is how much more often its labels meet than by chance, so that the
        # single labels' frequencies are counted once
        self.chain = np.log(chain / chain.sum()) - np.log(np.outer(chain.sum(1), chain.sum(0)) / chain.sum() ** 2)
        self.skip = np.log(skip / skip.sum()) - np.log(np.outer(skip.sum(1), skip.sum(0)) / skip.sum() ** 2)


def marginals(graph: Graph, p: Potentials, rounds: int = 12, weight: float = 0.3, damping: float = 0.3) -> np.ndarray:
    """Loopy sum-product over chain and skip edges; observed labels are clamped."""
    n = len(graph.label)
    label = np.array(graph.label)
    local = p.prior + weight * p.unary[np.array(graph.features)].sum(axis=1)
    local = np.where(label[:, None] == 0, local, np.where(np.arange(_N) == label[:, None], 0.0, -50.0))
    edges = np.array(graph.chain + graph.skip, dtype=np.int64).reshape(-1, 2)
    if len(edges):
        factor = np.concatenate(
            [np.broadcast_to(p.chain, (len(graph.chain), _N, _N)), np.broadcast_to(p.skip, (len(graph.skip), _N, _N))]
        )
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        factor = np.concatenate([factor, factor.transpose(0, 2, 1)])  # [edge, from, to]
        m = len(edges)
        back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        message = np.zeros((2 * m, _N))
        for _ in range(rounds):
            belief = local.copy()
            np.add.at(belief, target, message)
            out = (belief[source] - message[back])[:, :, None] + factor
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            message = damping * message + (1 - damping) * new
        np.add.at(local, target, message)
    local = np.exp(local - local.max(axis=1, keepdims=True))
    return local / local.sum(axis=1, keepdims=True) if n else local


def _trim(text: str, begin: int, end: int) -> tuple[int, int]:
    while begin < end and not (text[begin].isalnum() or text[begin] in "+("):
        begin += 1
    while end > begin and not text[end - 1].isalnum():
        end -= 1
    return begin, end


def added_spans(graph: Graph, share: np.ndarray, texts: list[str], base: list[list[Span]], least: float) -> list[list[Span]]:
    """Linked or matching runs of neighbouring unobserved nodes of one confident kind, clear of base spans."""
    found: list[list[Span]] = [[] for _ in texts]
    joined = {j for _, j in graph.chain}
    best = share.argmax(axis=1) if len(share) else []
    supported = graph.supported()
    run: tuple[int, int, int, int, bool] | None = None  # document, start, end, label, supported

    def close() -> None:
        if run:
            doc, begin, end, label, linked = run
            begin, end = _trim(texts[doc], begin, end)
            linked = linked or (0, label, end - begin) in base_spans(texts[doc][begin:end])
            if linked and begin < end and not any(a < end and b > begin for a, _, b in base[doc]):
                found[doc].append((begin, label, end))

    for i, (doc, begin, end) in enumerate(graph.place):
        label = int(best[i])
        if graph.label[i] or not label or share[i, label] < least:
            close()
            run = None
        elif run and i in joined and run[3] == label and run[0] == doc:
            run = (doc, run[1], end, label, run[4] or bool(supported[i, label]))
        else:
            close()
            run = (doc, begin, end, label, bool(supported[i, label]))
    close()
    return found


def learn_potentials(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Potentials:
    """Counts of the whole corpus, summed in tasks and then in Spark; a bounded table is collected."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            graph = Graph()
            for i, t in enumerate(batch["text"]):
                if _SIGN.search(t):
                    graph.add(i, t, base_spans(t))
            for features, label in zip(graph.features, graph.label):
                total.update([("u", f, label) for f in features])
                total["l", 0, label] += 1
            total.update([("c", graph.label[a], graph.label[b]) for a, b in graph.chain])
            total.update([("s", graph.label[a], graph.label[b]) for a, b in graph.skip])
        if total:
            yield pd.DataFrame([(*k, n) for k, n in total.items()], columns=["kind", "a", "b", "n"])

    rows = (
        keyed_text(docs, key, text).select("text")
        .mapInPandas(count, "kind string, a int, b int, n long")
        .groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    )
    return Potentials({(r["kind"], r["a"], r["b"]): r["n"] for r in rows.collect()})


def find_in_batch(texts: list[str], p: Potentials, least: float = 0.9) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base and added spans of each text."""
    graph, base = Graph(), [base_spans(t) for t in texts]
    for i, t in enumerate(texts):
        if _SIGN.search(t):
            graph.add(i, t, base[i])
    if not graph.label:
        return base, [[] for _ in texts]
    return base, added_spans(graph, marginals(graph, p), texts, base, least)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k - 1]}:{a}:{b}" for a, k, b in sorted(spans))


def find_personal_data(docs: DataFrame, p: Potentials | None = None, least: float = 0.9, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans (base and added), n_added of every row.

    least  marginal probability from which a label adds a span

    A missing text is empty; a text without spans has empty `spans`. Texts are
    read whole. Repeated rows give repeated results; an empty table gives none;
    further columns are not read.
    """
    p = p or learn_potentials(docs, key, text)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, more = find_in_batch(batch["text"].tolist(), p, least)
            counts = [Counter(k for _, k, _ in own) for own in base]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    **{f"n_{name}": [c[k] for c in counts] for k, name in enumerate(KINDS, 1)},
                    "base_sha256": [hashlib.sha256(joined(own).encode()).hexdigest() for own in base],
                    "spans": [joined(a + b) for a, b in zip(base, more)],
                    "n_added": [len(b) for b in more],
                }
            )

    return keyed_text(docs, key, text).mapInPandas(work, SCHEMA)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span, or union of overlapping spans, replaced by its first kind in brackets."""
    parts, done = [], 0
    for begin, kind, end in sorted(spans):
        if begin >= done:
            parts += [text[done:begin], f"[{KINDS[kind - 1].upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def mask_personal_data(docs: DataFrame, p: Potentials | None = None, least: float = 0.9) -> DataFrame:
    """The documents table with all spans replaced in `text`; `n_chars` follows. A missing text stays missing."""
    p = p or learn_potentials(docs)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        whole = ["" if t is None else t for t in texts]
        base, more = find_in_batch(whole, p, least)
        clean = [None if o is None else mask(t, a + b) for o, t, a, b in zip(texts, whole, base, more)]
        columns = {n: batch.column(n) for n in batch.schema.names} | {"text": pa.array(clean, batch.schema.field("text").type)}
        return pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    masked = map_documents(docs, work)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars").cast("long")))
