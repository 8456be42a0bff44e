"""Jaccard join of texts on their sets of word n-grams, by banded MinHash.

Texts with the same set of n-grams are one class and go on as one. Each class has
a MinHash signature cut into bands; classes that share a band hash meet through
the least of them, and the connected sets of these meetings are the candidates.
Inside a candidate set every pair is verified on the full n-gram sets. A large
set is cut into chunks and each pair of chunks is a task of its own, so neither
pairs nor whole sets are ever rows or single tasks. Joins whose sides grow with
the table are hinted to be merged, so the plan is the same at every size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.lineage import durable
from panelweave.llm.components import components
from panelweave.llm.texts import keyed_text, sliced

_MULTIPLIER = 0x9E3779B97F4A7C15
_KNOWN = 200_000  # words whose hashes a task remembers
_BITS = 1 << 24  # of the bitmap that keeps unwanted rows out of a shuffle
_COLUMNS = 8192  # n-grams compared at once


def choose_bands(similarity: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows: the most rows whose bands reach the recall within `hashes` values.

    Two sets of that similarity share one of b bands of r rows with probability
    1 - (1 - similarity**r)**b; more rows let fewer unlike pairs through.
    """
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(similarity**rows)))
        if bands * rows > hashes:
            break
        best = (bands, rows)
    return best


class GramSet:
    """64-bit hashes of the word n-grams of a text: lower case, cut at white space.

    A text of fewer than `n` words has one n-gram of all its words; a text
    without words has none.
    """

    def __init__(self, n: int) -> None:
        self.n = n
        self.words: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.words) > _KNOWN:
            self.words.clear()
        known, hashes = self.words, []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            hashes.append(h)
        h = np.array(hashes, np.uint64)
        n = min(self.n, len(h))
        grams = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            grams = grams * np.uint64(_MULTIPLIER) + h[i : len(h) - n + 1 + i]
            grams ^= grams >> np.uint64(29)
        return np.unique(grams)


class Signer:
    """Band hashes of a set of n-grams."""

    def __init__(self, bands: int, rows: int, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        count = bands * rows
        self.shape = (bands, rows)
        self.a = rng.integers(1, 1 << 63, (count, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, (count, 1), dtype=np.uint64)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for begin in range(0, len(grams), 1024):
            least = np.minimum(least, (self.a * grams[begin : begin + 1024] + self.b).min(axis=1))
        band = np.arange(self.shape[0], dtype=np.uint64)
        for column in least.reshape(self.shape).T:
            band = (band ^ column) * np.uint64(_MULTIPLIER)
            band ^= band >> np.uint64(31)
        return band.view(np.int64)


def _classes(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """row, doc_id, text_hash, two halves of the class key, and the band hashes of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sign = GramSet(n), Signer(bands, rows)
        for batch in sliced(batches):
            keys, signed = [], []
            for t in batch["text"].to_pylist():
                own = grams(t)
                keys.append(xxhash.xxh3_128_intdigest(own.tobytes()))
                signed.append(sign(own) if len(own) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"], batch["doc_id"], batch["text_hash"],
                    pa.array(np.array([k >> 64 for k in keys], np.uint64).view(np.int64)),
                    pa.array(np.array([k & (1 << 64) - 1 for k in keys], np.uint64).view(np.int64)),
                    pa.array(signed, pa.list_(pa.int64())),
                ],
                ["row", "doc_id", "text_hash", "k1", "k2", "bands"],
            )

    keyed = keyed_text(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text"
    )
    return keyed.mapInArrow(work, "row long, doc_id long, text_hash long, k1 long, k2 long, bands array<long>")


def _candidates(reps: DataFrame) -> DataFrame:
    """Edges between each class and the least class of its bands."""
    met = reps.select(F.col("rep"), F.posexplode("bands").alias("band", "h"))
    least = met.groupBy("band", "h").agg(F.min("rep").alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return met.join(least.hint("merge"), ["band", "h"]).select(F.col("rep").alias("u"), "v").filter("u != v").distinct()


def _local_roots(linked: np.ndarray) -> np.ndarray:
    """Least index reachable through a symmetric boolean matrix."""
    root = np.arange(len(linked))
    while True:
        new = np.where(linked, root[None, :], len(root)).min(axis=1)
        new = np.minimum(root, new)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Symmetric boolean matrix of pairs at or above the similarity."""
    sizes = np.array([len(s) for s in sets], np.float64)
    grams, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(int))
    shared = np.bincount(column, minlength=len(grams)) > 1  # others are in no intersection
    place = np.cumsum(shared) - 1
    owner, column = owner[shared[column]], place[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for begin in range(0, int(shared.sum()), _COLUMNS):
        lo, hi = np.searchsorted(column, [begin, begin + _COLUMNS])
        block = np.zeros((len(sets), _COLUMNS), np.float32)
        block[owner[lo:hi], column[lo:hi] - begin] = 1
        common += block @ block.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= (similarity - 1e-9) * union
    np.fill_diagonal(linked, False)
    return linked


def _bitmap(rows: DataFrame) -> Broadcast[np.ndarray]:
    """Bits at the low parts of the text hashes: 2 MB at every size of the table.

    With very many rows more bits are set and fewer other rows are kept back;
    the join that follows decides.
    """
    low = F.col("text_hash").bitwiseAND(F.lit(_BITS - 1))
    set_ = rows.groupBy(F.shiftright(low, 3).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), low.bitwiseAND(F.lit(7)).cast("int"))).alias("bits")
    ).toPandas()
    table = np.zeros(_BITS // 8, np.uint8)
    table[set_["at"].to_numpy(np.int64)] = set_["bits"].to_numpy(np.int64)
    return rows.sparkSession.sparkContext.broadcast(table)


def _verify(docs: DataFrame, placed: DataFrame, n: int, similarity: float, chunk: int) -> DataFrame:
    """rep, links (rows of other classes at or above the similarity), root (of the links inside one task)."""
    sizes = placed.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    small = max(1, math.ceil(placed.count() / chunk))
    pieces = F.ceil(F.col("members") / chunk).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int")
    spread = (
        placed.join(sizes, "root").withColumn("pieces", pieces).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select(
            "doc_id", "text_hash", "rep", "size", "root", "own",
            F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
            # sets of one chunk share tasks; each pair of chunks of a larger one has its own
            F.when(F.col("pieces") == 1, F.pmod(F.xxhash64("root"), F.lit(small))).otherwise(F.lit(-1)).alias("shared"),
        )
        .withColumn("key", F.when(F.col("shared") >= 0, F.lit(0)).otherwise(F.col("root")))
    )

    bits = _bitmap(placed)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = GramSet(n), bits.value
        for batch in sliced(batches):
            h = batch["text_hash"].to_numpy() & (_BITS - 1)
            part = batch.filter(pa.array(table[h >> 3] >> (h & 7) & 1 > 0))
            sets = pa.array([of(t).tobytes() for t in part["text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["text_hash"], sets], ["doc_id", "text_hash", "grams"])

    # texts stay where they are: only n-grams of rows that may be wanted are shuffled
    found = (
        keyed_text(docs).withColumn("text_hash", F.xxhash64("text"))
        .mapInArrow(grams, "doc_id long, text_hash long, grams binary")
    )
    wanted = placed.select("rep", "doc_id", "text_hash").withColumnsRenamed({"doc_id": "_d", "text_hash": "_t"})
    found = found.join(
        wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t"))
    ).select("rep", "grams")
    blocks = spread.drop("doc_id", "text_hash").join(found.hint("merge"), "rep")

    def work(block: pd.DataFrame) -> pd.DataFrame:
        out = []
        block = block.drop_duplicates(["rep", "root"]).sort_values(["root", "rep"])  # repeated rows of the input
        for _, part in block.groupby("root", sort=False):
            sets = [np.frombuffer(g, np.uint64) for g in part["grams"]]
            linked = _links(sets, similarity)
            reps, weight, own = part["rep"].to_numpy(), part["size"].to_numpy(), part["own"].to_numpy()
            if part["first"].iloc[0] != part["second"].iloc[0]:
                linked &= own[:, None] != own[None, :]  # pairs inside a chunk are counted in its own task
            root = reps[_local_roots(linked)]
            links = (linked * weight[None, :]).sum(axis=1)
            keep = links > 0
            out.append(pd.DataFrame({"rep": reps[keep], "links": links[keep], "root": root[keep]}))
        return pd.concat(out) if out else pd.DataFrame({"rep": [], "links": [], "root": []})

    return blocks.groupBy("shared", "key", "first", "second").applyInPandas(work, "rep long, links long, root long")


def near_duplicates(
    docs: DataFrame, n: int = 5, similarity: float = 0.8, recall: float = 0.995, hashes: int = 256, chunk: int = 256,
) -> DataFrame:
    """doc_id, text_hash, class_id, group_id, n_links, first_of_group of every row.

    n            words of an n-gram
    similarity   least Jaccard similarity of a link
    recall       probability that two texts of just this similarity become
                 candidates by their bands; sets the number of bands and rows
    hashes       most MinHash values of a text
    chunk        classes compared with each other in one task

    class_id is the least doc_id with the same set of n-grams, n_links the number
    of other rows linked to the row (rows of its class included), group_id the
    least doc_id connected through links; first_of_group marks one row of each
    group. A missing text is empty; texts without words are one class. A missing
    doc_id is kept and ignored in the ids of classes and groups that have another. Repeated
    rows are members of the same class. Further columns are not read.
    """
    bands, rows = choose_bands(similarity, recall, hashes)
    every = durable(_classes(docs, n, bands, rows))
    members = every.groupBy("k1", "k2").agg(
        F.min("row").alias("rep"), F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("size")
    )
    classes = durable(members)
    reps = every.select(F.col("row").alias("rep"), "doc_id", "text_hash", "bands").join(
        classes.select("rep", "size", "class_id").hint("merge"), "rep"
    )
    near = components(_candidates(reps)).withColumnRenamed("node", "rep")
    placed = durable(reps.drop("bands", "class_id").join(near, "rep"))
    found = durable(_verify(docs, placed, n, similarity, chunk))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    grouped = (
        classes.join(links, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("root", F.coalesce("root", "rep"))
    )
    named = grouped.groupBy("root").agg(F.min("class_id").alias("group_id"))
    table = grouped.join(named, "root").select(
        "k1", "k2", "class_id", "group_id", "root", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")
    )
    return every.select("row", "doc_id", "text_hash", "k1", "k2").join(table.hint("merge"), ["k1", "k2"]).select(
        "doc_id", "text_hash", "class_id", "group_id", "n_links", (F.col("row") == F.col("root")).alias("first_of_group")
    )


def drop_near_duplicates(docs: DataFrame, n: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents table with one row of each group; a repeated row stays once."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]

    def key(doc_id: str, text_hash: Column) -> list[Column]:
        """Of one document; a missing doc_id is equal to itself."""
        known = F.col(doc_id).cast("long")
        return [F.coalesce(known, F.lit(0)).alias("_d"), known.isNull().alias("_n"), text_hash.alias("_h")]

    kept = near_duplicates(docs, n, similarity).filter("first_of_group").select(*key("doc_id", F.col("text_hash")))
    keyed = docs.select(*columns, *key("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit("")))))
    # one key for the join and for repeated rows, so that texts are shuffled and sorted once
    same = ["_d", "_n", "_h"]
    return keyed.join(kept.hint("merge"), same, "left_semi").dropDuplicates(same).select(*columns)
