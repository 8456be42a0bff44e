"""Alignment of two tokenizations of the same texts, with corpus-wide pair counts.

A text is encoded by a byte-level BPE (`" " + text`, tokens as their
byte-level decoded bytes) and by a SentencePiece model (`text`; the model adds
the leading space; pieces in UTF-8 with U+2581 as space and `<0xHH>` as byte
HH). Special-token strings inside texts are plain text. Byte offsets where an A
token and a B token both end cut the two sequences into groups. A link is a
pair of an A occurrence and a B occurrence that end at the same offset, so each
group has one link: its last A and last B token.

Counting, by minimal perfect hashing of the distinct pairs:

1. One task per split aligns its texts once and writes, per document, its
   figures and its links as 64-bit keys `a << 32 | b`, packed in one binary
   value per document. Tokenising costs about
   750 CPU seconds a GB, so later passes read these links instead of
   tokenising again.
2. The distinct keys of all documents are found by Spark (made distinct in
   each task first). Their number has a bound from the vocabularies alone: the shorter
   token of a link is a suffix of the longer one, so a key is fixed by its
   longer token and a suffix length, and there are at most the summed byte
   lengths of both vocabularies. The keys are checked against that bound,
   then a minimal perfect hash (hash and displace: buckets of about four keys,
   each given the first seed that sends its keys to free places of a table of
   0.9 load, places ranked to 0..m-1) maps them to dense slots, each slot
   storing its key for verification.
3. Every task adds its links into a dense count vector indexed by the hash,
   verifying each key; the vectors are summed in a tree.
4. Slot by slot the best count of each B id is found; a last pass looks up
   each link's count and whether it is its B id's best (ties included).

Defined results: a missing, empty or unrepresentable text (joined A or B bytes
differ from `" " + text`) has no tokens: zeros and an empty `groups_sha256`;
a missing doc_id is carried as missing; repeated rows are aligned and counted
each time; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.lineage import durable
from panelweave.llm.packing import StreamEncoder

ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
_MASK = np.uint64(0xFFFFFFFF)
_ROWS = 256  # texts encoded or looked up at once, at most
_BYTES = 1 << 19  # and their text bytes, at most (or one longer text alone)
_KEYS = 1 << 20  # keys a task gathers before it makes them distinct


def byte_level_alphabet() -> dict[str, int]:
    """Character of the byte-level vocabulary -> byte.

    Fixed value: printable bytes 0x21-0x7E, 0xA1-0xAC and 0xAE-0xFF stand for
    themselves; the other bytes, in increasing order, are the characters from
    U+0100 on.
    """
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {chr(b): b for b in kept}
    extra = 0
    for b in range(256):
        if b not in kept:
            chars[chr(0x100 + extra)] = b
            extra += 1
    return chars


class Vocabularies:
    """The two encoders and the bytes of every id.

    ranks  file of the byte-level vocabulary as ranks, see `StreamEncoder`
    """

    def __init__(self, byte_bpe: str, pieces: str, ranks: str | None = None) -> None:
        import sentencepiece

        # each distinct chunk is encoded once; texts with the strings of special tokens are encoded whole
        self.stream = StreamEncoder(byte_bpe, ranks)
        self.a = self.stream.tokenizer
        self.a.encode_special_tokens = True
        alphabet = byte_level_alphabet()
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [b""] * size
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode())
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        # ids as text, followed by each of the three separators
        self.signs = max(len(self.a_bytes), len(self.b_bytes))
        self.written = [f"{i}{sign}" for sign in ",|;" for i in range(self.signs)]

    def key_bound(self) -> int:
        """Most distinct linked pairs there can be (see the module text)."""
        return int(self.a_len.sum() + self.b_len.sum())


def align(v: Vocabularies, text: str | None, ids_a: np.ndarray | None = None, ids_b: list[int] | None = None) -> tuple:
    """(n_a, n_b, n_groups, n_links, groups text, link keys) of one text."""
    empty = (0, 0, 0, 0, "", np.empty(0, np.int64))
    if not text:
        return empty
    if ids_a is None:
        ids_a = np.array(v.a.encode(" " + text, add_special_tokens=False).ids, np.int64)
        ids_b = v.b.encode(text)
    want = (" " + text).encode()
    a, b = np.asarray(ids_a, np.int64), np.asarray(ids_b, np.int64)
    if len(a) == 0 or len(b) == 0 or a.max() >= len(v.a_bytes) or b.max() >= len(v.b_bytes):
        return empty
    ends_a, ends_b = np.cumsum(v.a_len[a]), np.cumsum(v.b_len[b])
    if ends_a[-1] != len(want) or ends_b[-1] != len(want):
        return empty
    if b"".join(map(v.a_bytes.__getitem__, a.tolist())) != want or b"".join(map(v.b_bytes.__getitem__, ids_b)) != want:
        return empty
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    last_a, last_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
    keys = (a[last_a] << 32) | b[last_b]
    return len(a), len(b), len(common), len(common), groups_text(v, a, b, last_a, last_b), keys


def groups_text(v: Vocabularies, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
    """`a1,a2|b1;a3|b2,b3`: ids of each group, A before B, groups in order.

    Every id is written with the separator that follows it (',' inside a side,
    '|' after the last A id, ';' after the last B id of a group, nothing at the
    very end). An id stands behind all ids of its own side before it, and the
    other side's ids of earlier groups (and of its own group, for a B id).
    """
    end_a, end_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    end_a[last_a], end_b[last_b] = True, True
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    coded = np.empty(len(a) + len(b), np.int64)
    coded[np.arange(len(a)) + np.repeat(last_b + 1 - size_b, size_a)] = a + v.signs * end_a
    coded[np.arange(len(b)) + np.repeat(last_a + 1, size_b)] = b + 2 * v.signs * end_b
    return "".join(map(v.written.__getitem__, coded.tolist()))[:-1]


_LOADED: dict[tuple, Vocabularies] = {}


def vocabularies(byte_bpe: str, pieces: str, ranks: str | None = None) -> Vocabularies:
    """The vocabularies, loaded once in each worker process."""
    key = (byte_bpe, pieces, ranks)
    # one thread per task: tasks are the parallelism, and threads would each hold their own buffers
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if key not in _LOADED:
        _LOADED[key] = Vocabularies(byte_bpe, pieces, ranks)
    return _LOADED[key]


def _chunks(texts: list) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most `_ROWS` rows and `_BYTES` bytes; a longer text is a run of its own.

    The encodings of a run are held at once, so runs are bounded by size, not only by rows.
    """
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and (i - start >= _ROWS or size + n > _BYTES):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def _aligner(byte_bpe: str, pieces: str, ranks: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(byte_bpe, pieces, ranks)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, stop in _chunks(texts):
                part = texts[start:stop]
                live = [i for i, t in enumerate(part) if t]
                enc_a = v.stream.encode([" " + part[i] for i in live])
                enc_b = v.b.encode([part[i] for i in live], num_threads=1)
                found = {
                    i: align(v, part[i], np.frombuffer(ea, "<u4"), eb) for i, ea, eb in zip(live, enc_a, enc_b)
                }
                rows = [found.get(i) or align(v, None) for i in range(len(part))]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": ids[start:stop],
                        "n_a": [r[0] for r in rows],
                        "n_b": [r[1] for r in rows],
                        "n_groups": [r[2] for r in rows],
                        "n_links": [r[3] for r in rows],
                        "groups_sha256": [hashlib.sha256(r[4].encode()).hexdigest() if r[0] else "" for r in rows],
                        "links": [r[5].astype("<i8").tobytes() for r in rows],
                    },
                    schema=pa.schema([
                        ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                        ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary()),
                    ]),
                )

    return run


def _mix(x: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    """A 64-bit mixer of keys under a seed, or each under its own (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) ^ np.asarray(seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys, by hash and displace.

    Keys fall into buckets of about four; buckets, largest first, each take the
    first seed that sends all their keys to free places of a table of 0.9
    load. The places taken are ranked, so the slots are exactly 0..m-1, and
    `keys[slot]` verifies a lookup.
    """

    def __init__(self, keys: np.ndarray) -> None:
        keys = np.unique(keys.astype(np.int64))
        self.m = len(keys)
        self.buckets = max(1, -(-self.m // 4))
        self.places = max(1, int(self.m / 0.9) + 1)
        bucket = (_mix(keys, 0) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        taken = np.zeros(self.places, bool)
        self.seeds = np.zeros(self.buckets, np.int64)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] == 0:
                break
            members = keys[order[starts[b] : starts[b + 1]]]
            seed = 1
            while True:
                at = (_mix(members, seed) % np.uint64(self.places)).astype(np.int64)
                if not taken[at].any() and len(np.unique(at)) == len(at):
                    taken[at] = True
                    self.seeds[b] = seed
                    break
                seed += 1
        self.rank = np.cumsum(taken) - 1
        self.keys = np.empty(self.m, np.int64)
        self.keys[self.slots(keys)] = keys

    def slots(self, keys: np.ndarray) -> np.ndarray:
        bucket = (_mix(keys, 0) % np.uint64(self.buckets)).astype(np.int64)
        return self.rank[(_mix(keys, self.seeds[bucket]) % np.uint64(self.places)).astype(np.int64)]

    def verified_slots(self, keys: np.ndarray) -> np.ndarray:
        slots = self.slots(keys)
        if self.m == 0 or not np.array_equal(self.keys[slots], keys):
            raise ValueError("a key outside the hashed set")
        return slots


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of at most `_ROWS` rows: the keys of a part are held unpacked, so parts are small."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all rows of a column of packed links, and where each row's keys begin and end."""
    packed = column.to_pylist()
    offsets = np.cumsum([0] + [len(x) // 8 for x in packed])
    return np.frombuffer(b"".join(packed), "<i8"), offsets


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct keys of a task."""
    seen, new, held = np.empty(0, np.int64), [], 0
    for part in _slices(batches):
        new.append(np.unique(_unpack(part.column(0))[0]))
        held += len(new[-1])
        if held > len(seen) + _KEYS:
            seen, new, held = np.unique(np.concatenate([seen, *new])), [], 0
    yield pa.RecordBatch.from_pydict({"key": np.unique(np.concatenate([seen, *new]))})


def _counter(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mph = table.value
        counts = np.zeros(mph.m, np.int64)
        for part in _slices(batches):
            flat = _unpack(part.column(0))[0]
            if len(flat):
                counts += np.bincount(mph.verified_slots(flat), minlength=mph.m)
        yield pa.RecordBatch.from_pydict({"counts": [counts.tobytes()]})

    return run


def _lookup(table, counted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mph, (counts, best) = table.value, counted.value
        for batch in _slices(batches):
            keys, offsets = _unpack(batch.column("links"))
            slots = mph.verified_slots(keys) if len(keys) else np.empty(0, np.int64)
            sums = [np.concatenate([[0], np.cumsum(x[slots])]) for x in (best.astype(np.int64), counts)]
            n_best, total = (s[offsets[1:]] - s[offsets[:-1]] for s in sums)
            out = batch.drop_columns(["links"])
            out = out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
            yield out.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


def align_tokenizers(
    df: DataFrame, byte_bpe: str, pieces: str, key: str = "doc_id", text: str = "text", ranks: str | None = None
) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ranks  file of the byte-level vocabulary as ranks; if given, new chunks are encoded from it
    """
    spark = df.sparkSession
    source = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    aligned = durable(source.mapInArrow(_aligner(byte_bpe, pieces, ranks), ALIGNED))
    keys = aligned.select("links").mapInArrow(_distinct, "key long").distinct()
    found = np.array([r.key for r in keys.collect()], np.int64)
    bound = Vocabularies(byte_bpe, pieces).key_bound()
    if len(found) > bound:
        raise ValueError(f"{len(found)} linked pairs, more than the bound {bound} of the vocabularies")
    table = spark.sparkContext.broadcast(PerfectHash(found))
    vectors = aligned.select("links").mapInArrow(_counter(table), "counts binary")
    zero = np.zeros(table.value.m, np.int64)
    counts = vectors.rdd.map(lambda r: np.frombuffer(r[0], np.int64)).treeAggregate(
        zero, lambda acc, v: acc + v, lambda x, y: x + y, depth=2
    )
    b_ids = (table.value.keys.astype(np.uint64) & _MASK).astype(np.int64)
    top = np.zeros(int(b_ids.max()) + 1 if len(b_ids) else 1, np.int64)
    np.maximum.at(top, b_ids, counts)
    best = (counts == top[b_ids]) & (counts > 0)
    counted = spark.sparkContext.broadcast((counts, best))
    return aligned.mapInArrow(_lookup(table, counted), RESULT)
