"""Exact deduplication of texts by Patricia-trie owners.

Texts are equal when they are identical after every character of
`[\\x20\\x09-\\x0D]` is deleted. Of equal texts the row with the most code points
in its original text, then the smallest doc_id, owns the group.

Plan, with one shuffle of distinct texts and one join:

1. Each input task normalises its texts and inserts the full UTF-8 bytes into a
   compressed radix (Patricia) trie. A terminal node keeps the best owner and
   the number of rows of its string, so a group of copies leaves a task as one
   row however many copies the task read: a hot group is summed before the
   shuffle. Every row also leaves with its group key (byte length, 64-bit
   content hash and SHA-256 of the normalised text).
2. The distinct rows are dealt by (length, content hash) and sorted by it.
   A task inserts the strings of one (length, hash) partition into a trie of
   its own, which again compares full byte strings, so unequal texts with equal
   hashes stay apart. When the key changes, the finished subtree is written out
   and dropped: a task holds the strings of one key at a time and the sort
   spills to disk, not the trie.
3. Rows meet their group's owner by a join on the key; adaptive execution splits
   the partition of a hot group on the row side.

Defined results: a missing text counts as the empty text; a missing doc_id
ranks after every doc_id as an owner and is carried as missing; repeated rows
(equal doc_id and text) are all returned and all counted in `group_size`, and
each of them is `kept` when it is the owner (`doc_id` equal to `keep_id`, two
missing ids equal); an empty table gives an empty result; columns other than
doc_id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.lineage import durable

# fixed value of the contract: the characters deleted before texts are compared
_BLANKS = re.compile(rb"[\x20\x09-\x0D]+")
_NO_ID = 1 << 63  # a missing doc_id ranks after every doc_id

KEYED = pa.schema([
    ("doc_id", pa.int64()), ("nlen", pa.int64()), ("h", pa.int64()), ("text_sha256", pa.string()),
    ("norm", pa.binary()), ("best_chars", pa.int64()), ("best_id", pa.int64()), ("copies", pa.int64()),
])
OWNERS = pa.schema([
    ("nlen", pa.int64()), ("h", pa.int64()), ("text_sha256", pa.string()),
    ("keep_id", pa.int64()), ("group_size", pa.int64()),
])


class _Node:
    __slots__ = ("edges", "owner", "copies", "tag")

    def __init__(self) -> None:
        self.edges: dict[int, tuple[bytes, _Node]] = {}
        self.owner: tuple[int, int] | None = None  # (-code points, id): least is best
        self.copies = 0
        self.tag = None


def _shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the common start of `label` and `key[at:]`."""
    if key.startswith(label, at):
        return len(label)
    lo, hi = 1, min(len(label), len(key) - at)  # label[0] == key[at] holds
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if key.startswith(label[:mid], at):
            lo = mid
        else:
            hi = mid - 1
    return lo


class PatriciaTrie:
    """Compressed radix trie of byte strings whose terminal nodes own groups.

    `insert` walks edge labels by whole-slice comparison and splits an edge
    where a new string leaves it; the terminal node of a string keeps the least
    owner rank and the number of rows inserted with it.
    """

    def __init__(self) -> None:
        self.root = _Node()
        self.terminals = 0

    def insert(self, key: bytes, rank: tuple[int, int], copies: int = 1) -> _Node:
        node, at = self.root, 0
        while at < len(key):
            edge = node.edges.get(key[at])
            if edge is None:
                leaf = _Node()
                node.edges[key[at]] = (key[at:], leaf)
                node, at = leaf, len(key)
                break
            label, child = edge
            m = _shared(label, key, at)
            if m < len(label):
                middle = _Node()
                middle.edges[label[m]] = (label[m:], child)
                node.edges[key[at]] = (label[:m], middle)
                child = middle
            node, at = child, at + m
        if node.copies == 0:
            self.terminals += 1
        node.copies += copies
        node.owner = rank if node.owner is None else min(node.owner, rank)
        return node

    def terminals_in_order(self) -> Iterator[tuple[bytes, _Node]]:
        """Terminal nodes and their strings, depth first in byte order."""
        stack = [(b"", self.root)]
        while stack:
            prefix, node = stack.pop()
            if node.copies:
                yield prefix, node
            for first in sorted(node.edges, reverse=True):
                label, child = node.edges[first]
                stack.append((prefix + label, child))


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _id(rank: int) -> int | None:
    return None if rank == _NO_ID else rank


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their keys; the distinct strings of the task with owner and count."""
    trie = PatriciaTrie()
    rows: dict[str, list] = {name: [] for name in KEYED.names}
    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = batch.column(1).to_pylist()
        for doc_id, text in zip(ids, texts):
            text = text or ""
            norm = _BLANKS.sub(b"", text.encode("utf-8"))
            rank = (-len(text), _NO_ID if doc_id is None else doc_id)
            node = trie.insert(norm, rank)
            if node.tag is None:
                node.tag = (len(norm), _signed(xxhash.xxh3_64_intdigest(norm)), hashlib.sha256(norm).hexdigest())
            nlen, h, digest = node.tag
            for name, value in zip(("doc_id", "nlen", "h", "text_sha256"), (doc_id, nlen, h, digest)):
                rows[name].append(value)
            for name in ("norm", "best_chars", "best_id", "copies"):
                rows[name].append(None)
        if len(rows["doc_id"]) >= 8192:
            yield pa.RecordBatch.from_pydict(rows, KEYED)
            rows = {name: [] for name in KEYED.names}
    for norm, node in trie.terminals_in_order():
        nlen, h, digest = node.tag
        for name, value in zip(KEYED.names, (None, nlen, h, digest, norm, -node.owner[0], _id(node.owner[1]), node.copies)):
            rows[name].append(value)
        if len(rows["doc_id"]) >= 1024:
            yield pa.RecordBatch.from_pydict(rows, KEYED)
            rows = {name: [] for name in KEYED.names}
    yield pa.RecordBatch.from_pydict(rows, KEYED)


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct string, from rows sorted by (length, hash)."""
    out: dict[str, list] = {name: [] for name in OWNERS.names}
    trie, current = PatriciaTrie(), None

    def flush() -> None:
        for _, node in trie.terminals_in_order():
            nlen, h, digest = node.tag
            best = node.owner[1]
            for name, value in zip(OWNERS.names, (nlen, h, digest, _id(best), node.copies)):
                out[name].append(value)

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for nlen, h, digest, norm, chars, best, copies in zip(*cols):
            if (nlen, h) != current:
                flush()
                trie, current = PatriciaTrie(), (nlen, h)
            node = trie.insert(norm, (-chars, _NO_ID if best is None else best), copies)
            node.tag = (nlen, h, digest)
        if len(out["nlen"]) >= 4096:
            yield pa.RecordBatch.from_pydict(out, OWNERS)
            out = {name: [] for name in OWNERS.names}
    flush()
    yield pa.RecordBatch.from_pydict(out, OWNERS)


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    `keep_id` is the doc_id of the group's owner (most code points in the
    original text, then least doc_id); see the module text for defined results.
    """
    source = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    keyed = durable(source.mapInArrow(_first_pass, _ddl(KEYED)))
    distinct = keyed.filter("norm IS NOT NULL").select("nlen", "h", "text_sha256", "norm", "best_chars", "best_id", "copies")
    owners = (
        distinct.repartition("nlen", "h")
        .sortWithinPartitions("nlen", "h")
        .mapInArrow(_owners, _ddl(OWNERS))
    )
    rows = keyed.filter("norm IS NULL").select("doc_id", "nlen", "h", "text_sha256")
    joined = rows.join(owners, ["nlen", "h", "text_sha256"])
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
