"""Packing of token streams into training sequences with balanced attention cost.

A document's ids are cut into full sequences and a rest. The rests are packed
block by block: a block has just enough sequences for its tokens; the rests are
taken by descending length, each goes to the sequence of the lowest estimated
cost (linear plus quadratic in the length of each piece) that still has room for
it, and a rest that no sequence has room for is cut over those of lowest cost.
So a block wastes less than one sequence, whatever its lengths are.

Blocks are dealt by a hash of the document; their number follows the number of
documents, so a task's work does not grow with the corpus.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm.texts import keyed_text

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
_STREAM = "doc_id long, row long, doc_tokens long, full array<long>, rest binary"
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]|[\x85᠎​⁠﻿]")
_LATIN = 0x250  # code units below are Latin letters, their marks and signs
_ODD = np.array([u >= _LATIN or chr(u) not in " \n" and bool(_OTHER_SPACE.match(chr(u))) for u in range(1 << 16)])
_CACHED = 300_000  # chunks whose ids a task remembers; later new ones are encoded each time they come


class StreamEncoder:
    """Ids of whole texts as little-endian bytes.

    The pattern that splits a text before its merges never joins what stands
    before a blank or a line feed with what follows it, if no other white space
    is near. Such a text is cut there and the ids of its chunks are remembered;
    every other text is encoded whole.

    ranks  file of the same vocabulary as ranks; if given, texts of Latin letters
           without other white space are encoded from it, to the same ids: whole,
           which takes less than to cut them and to look their chunks up. New
           chunks of Latin letters in other texts are encoded from it too
    """

    def __init__(self, path: str, ranks: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.ranked = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranked = tiktoken.Encoding(
                "stream", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
            ).encode_ordinary

    def _plain(self, text: str) -> bool:
        """Whether the ranks give the same ids."""
        units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")
        return not _ODD[units].any() and not any(s in text for s in self.special)

    def _new(self, chunks: list[str]) -> dict[str, bytes]:
        latin = [c for c in chunks if c.isascii() or max(c) < "\u0250"] if self.ranked else []
        found = {c: np.array(self.ranked(c), "<u4").tobytes() for c in latin}
        others = [c for c in chunks if c not in found]
        for c, coded in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            found[c] = np.array(coded.ids, "<u4").tobytes()
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        known, chunks, whole, missing = self.known, [], [], {}
        for text in texts:
            if self.ranked and self._plain(text):
                chunks.append(np.array(self.ranked(text), "<u4").tobytes())
                continue
            if _OTHER_SPACE.search(text) or any(s in text for s in self.special):
                chunks.append(None)
                whole.append(text)
                continue
            own = _CHUNK.findall(text)
            chunks.append(own)
            missing.update(dict.fromkeys(c for c in own if c not in known))
        new = self._new(list(missing))
        full = len(known) >= _CACHED
        known.update(new)
        rest = iter(self.tokenizer.encode_batch_fast(whole, add_special_tokens=False))
        coded = [
            own if isinstance(own, bytes)
            else np.array(next(rest).ids, "<u4").tobytes() if own is None else b"".join(map(known.__getitem__, own))
            for own in chunks
        ]
        if full:
            for c in new:
                del known[c]
        return coded


@lru_cache(maxsize=1)
def _encoder(path: str, ranks: str | None) -> StreamEncoder:
    """One encoder for each Python worker, whatever the number of its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return StreamEncoder(path, ranks)


def encode_streams(
    docs: DataFrame, path: str, capacity: int, end: int, ranks: str | None = None,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: doc_id, row, doc_tokens, the crc32 of each full sequence, and the ids of the rest."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path, ranks)
        step, stop = 4 * capacity, np.array([end], "<u4").tobytes()
        for batch in batches:
            texts = batch["text"].tolist()
            for begin in range(0, len(texts), 256):
                part = batch.iloc[begin : begin + 256]
                streams = [s + stop for s in encoder.encode(texts[begin : begin + 256])]
                cuts = [len(s) // step * step for s in streams]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(), "row": part["row"].to_numpy(),
                        "doc_tokens": [len(s) // 4 for s in streams],
                        "full": [[zlib.crc32(s[i : i + step]) for i in range(0, c, step)] for s, c in zip(streams, cuts)],
                        "rest": [s[c:] for s, c in zip(streams, cuts)],
                    }
                )

    rows = keyed_text(docs, key, text).withColumn("row", F.monotonically_increasing_id())
    return rows.mapInPandas(work, _STREAM)


def balance(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Pieces (item, start in the item, length) of each sequence of a block."""
    count = -(-sum(lengths) // capacity)
    room = np.full(count, capacity, np.int64)
    spent = np.zeros(count)
    filled: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        left = lengths[item]
        fits = room >= left
        if fits.any():
            targets = [int(np.where(fits, spent, np.inf).argmin())]
        else:  # cut over those of lowest cost
            targets = np.argsort(np.where(room > 0, spent, np.inf), kind="stable").tolist()
        at = 0
        for s in targets:
            n = min(left, int(room[s]))
            filled[s].append((item, at, n))
            room[s] -= n
            spent[s] += linear * n + quadratic * n * n
            at, left = at + n, left - n
            if not left:
                break
    return filled


def pack(
    docs: DataFrame, path: str, ranks: str | None = None, capacity: int = 1024, end: int = 0, block_docs: int = 2048,
    linear: float = 1.0, quadratic: float = 1.0 / 1024, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    path        file of the tokenizer; the ids of a text are followed by `end`
    ranks       file of the same vocabulary as ranks, see `StreamEncoder`
    capacity    most tokens of a sequence
    block_docs  documents of a block on average; sets the number of blocks
    linear, quadratic  estimated cost of a piece of n tokens: linear*n + quadratic*n*n

    A missing or empty text is the single id `end`. A text of any length is cut
    into as many sequences as it needs. Repeated rows are packed each on its own;
    ties in length keep the order of (doc_id, row). An empty table gives no rows.
    Further columns of the input are not read.
    """
    blocks = max(1, round(docs.count() / block_docs))
    streams = encode_streams(docs, path, capacity, end, ranks, key, text).withColumn(
        "block", F.pmod(F.xxhash64("row", "doc_id"), F.lit(blocks))
    )

    def work(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["doc_id", "row"], kind="stable", na_position="first").reset_index(drop=True)
        first, sequence, rows = int(block["block"].iloc[0]) << 32, 0, []
        ids = [None if pd.isna(d) else int(d) for d in block["doc_id"]]
        totals = block["doc_tokens"].tolist()
        for doc, total, full in zip(ids, totals, block["full"]):
            for i, crc in enumerate(full):
                rows.append((doc, i * capacity, capacity, int(crc), total, first + sequence, 0))
                sequence += 1
        rests = block["rest"].tolist()
        items = [i for i, r in enumerate(rests) if r]
        for own in balance([len(rests[i]) // 4 for i in items], capacity, linear, quadratic):
            offset = 0
            for item, at, n in own:
                i = items[item]
                crc = zlib.crc32(rests[i][4 * at : 4 * (at + n)])
                rows.append((ids[i], len(block["full"][i]) * capacity + at, n, crc, totals[i], first + sequence, offset))
                offset += n
            sequence += 1
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return streams.groupBy("block").applyInPandas(work, SCHEMA)
