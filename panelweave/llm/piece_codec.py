"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is encoded as the model's own merges would: the best-scored adjacent pair
is merged first, taken from an agenda. With dropout, each candidate merge on the
agenda is skipped if its bit of a keyed hash is set, at the dropout rate, so repeated
words get varied segmentations, all of them sequences of the model's pieces that
decode to the same text. The key is made of the seed, the document, the place of
the word and the word, so results do not depend on partitions or retries.

No piece reaches over the beginning of a word, so words are encoded one by one.
Every occurrence has bits of its own. Where none of its first merges is skipped the
model's own segmentation holds, found once for each word. The short words of a batch
with skips keep one agenda each, all of them advanced together, candidate by candidate.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from panelweave.llm.texts import keyed_text

_SPACE = "▁"
_WORD = re.compile(r"▁+[^▁\n]*|[^▁\n]+|\n+")
_SIGN = "\0" + _SPACE  # no word of a text ends in the sign after another character
_MASK = (1 << 64) - 1
_NONE = float("-inf")
_SHORT = 48  # characters up to which a word's agenda is a plain list
_CHARS = 2_000_000  # characters of texts encoded at once
_KNOWN = 200_000  # words whose segmentation without skips a worker remembers
_COLUMN = 21  # characters up to which words with skips share their steps: 64 bits are enough for all their candidates


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def skip_bits(keys: np.ndarray, dropout: float) -> np.ndarray:
    """64 bits for each key, each set with probability `dropout` (in steps of 1/256).

    A bit with probability 0.b1b2...b8 is made of eight hashed bits, from the last
    binary digit on: or-ed where the digit is 1, and-ed where it is 0.
    """
    level = min(255, round(dropout * 256))
    out = np.zeros(len(keys), np.uint64)
    for i in range(8):
        h = _mixed(keys + np.uint64(0x9E3779B97F4A7C15 * (i + 1) & _MASK))
        out = out | h if level >> i & 1 else out & h
    return out


class PieceCodec:
    """Pieces of a model file, and the agenda."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model = model  # segments words none of whose merges is skipped
        size = model.get_piece_size()
        self.bytes = [0] * 256
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.table: list[bytes] = []
        self.known: dict[str, list[int]] = {}  # segmentations without skips
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.table.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.table.append(b"")
            else:
                self.ids[piece] = i
                self.score[piece] = model.get_score(i)
                self.table.append(piece.replace(_SPACE, " ").encode())
        crossing = [p for p in self.ids if "\n" in p and p.strip("\n") or _SPACE in p.lstrip(_SPACE)]
        if crossing:
            raise ValueError(f"pieces reach over word beginnings: {crossing[:3]}")
        # a candidate is a pair of pieces that makes a piece: their ids, and its id and the rank of its score
        rank = {s: r for r, s in enumerate(sorted(set(self.score.values())))}
        pairs = sorted(
            (self.ids[p[:k]] * size + self.ids[p[k:]], i, rank[self.score[p]])
            for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids
        )
        self.size = size
        self.pairs, self.made, self.rank = np.array([*pairs, (np.iinfo(np.int64).max, 0, 0)], np.int64).T.copy()
        self.chars = np.full(0x110000, -1, np.int32)  # id of each character that is a piece
        for p, i in self.ids.items():
            if len(p) == 1:
                self.chars[ord(p)] = i

    def words(self, text: str) -> list[str]:
        """Words of the prefixed text; a literal word-begin sign is a word of its own, to be written as bytes."""
        if _SPACE not in text:
            return _WORD.findall(_SPACE + text.replace(" ", _SPACE))
        found: list[str] = []
        for i, part in enumerate(text.split(_SPACE)):
            found += [_SIGN] if i else []
            found += _WORD.findall(("" if i else _SPACE) + part.replace(" ", _SPACE))
        return found

    def segment(self, word: str, skips: int = 0) -> list[int]:
        """Ids of a word; the i-th candidate merge that leaves the agenda is skipped if bit i of `skips` is set."""
        if word == _SIGN:
            return [self.bytes[b] for b in _SPACE.encode()]
        out = []
        for symbol in (self._merge_short if len(word) <= _SHORT else self._merge_long)(word, skips):
            i = self.ids.get(symbol)
            if i is None:
                out += [self.bytes[b] for b in symbol.encode()]
            else:
                out.append(i)
        return out

    def _merge_short(self, word: str, skips: int) -> list[str]:
        """The agenda as a plain list of scores, beside the symbols."""
        score, symbols = self.score.get, list(word)
        scores = [score(a + b, _NONE) for a, b in zip(symbols, symbols[1:])]
        while scores:
            best = max(scores)
            if best == _NONE:
                break
            i = scores.index(best)
            skip, skips = skips & 1, skips >> 1
            if skip:
                scores[i] = _NONE
                continue
            pair = symbols[i] + symbols[i + 1]
            symbols[i : i + 2] = [pair]
            del scores[i]
            if i:
                scores[i - 1] = score(symbols[i - 1] + pair, _NONE)
            if i < len(scores):
                scores[i] = score(pair + symbols[i + 1], _NONE)
        return symbols

    def _merge_long(self, word: str, skips: int) -> list[str]:
        """The agenda as a heap, for words of any length."""
        score, symbols, n = self.score.get, list(word), len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            pair = symbols[left] + symbols[right]
            s = score(pair)
            if s is not None:
                heapq.heappush(agenda, (-s, left, right, pair))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if after[left] != right or not symbols[left] or symbols[left] + symbols[right] != pair:
                continue
            follow = after[right]
            skip, skips = skips & 1, skips >> 1
            if skip:
                continue
            symbols[left], symbols[right], after[left] = pair, "", follow
            if before[left] >= 0:
                offer(before[left], left)
            if follow < n:
                before[follow] = left
                offer(left, follow)
        return [s for s in symbols if s]

    def _segment_column(self, symbol: np.ndarray, skips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces left of words of one length, word after word, and their number in each word.

        symbol  (place, word): ids of the characters
        skips   bits of each word
        Each word's agenda is a column: (rank of the score, place from the right) of the candidate that
        begins at each place, or -1.
        """
        n, count = symbol.shape
        symbol, skips, order = symbol.copy(), skips.copy(), np.arange(n)[:, None]
        left, right = np.repeat(order - 1, count, 1), np.repeat(order + 1, count, 1)
        made, agenda = np.zeros((n, count), np.int64), np.full((n, count), -1, np.int64)
        whole, column = np.ones((n, count), bool), np.arange(count)

        def offer(place: np.ndarray, after: np.ndarray, word: np.ndarray) -> None:
            key = symbol[place, word] * np.int64(self.size) + symbol[after, word]
            at = np.searchsorted(self.pairs, key)
            made[place, word] = self.made[at]
            agenda[place, word] = np.where(self.pairs[at] == key, self.rank[at] * 32 + 31 - place, -1)

        for i in range(n - 1):
            offer(np.full(count, i), np.full(count, i + 1), column)
        while len(column):
            best = agenda[:, column].max(axis=0) if len(column) < count else agenda.max(axis=0)
            column, best = column[best >= 0], best[best >= 0]
            place = 31 - (best & 31)
            agenda[place, column] = -1
            merge = skips[column] & np.uint64(1) == 0
            skips[column] >>= np.uint64(1)
            word, place = column[merge], place[merge]
            gone = right[place, word]
            symbol[place, word] = made[place, word]
            agenda[gone, word], whole[gone, word] = -1, False
            before, after = left[place, word], right[gone, word]
            right[place, word] = after
            on = after < n
            left[after[on], word[on]] = place[on]
            offer(place[on], after[on], word[on])
            on = before >= 0
            offer(before[on], place[on], word[on])
        return symbol.T[whole.T], whole.sum(axis=0)

    def _segment_all(self, words: list[str], skips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with skips of at most 64 candidates, one after another, and their number in each word."""
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        length = np.array(list(map(len, words)))
        symbols = self.chars[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
        begin = np.cumsum(length) - length
        known = np.minimum.reduceat(symbols, begin) >= 0
        counts, ids = np.empty(len(words), np.int64), []
        order: list[np.ndarray] = []
        for n in np.unique(length[known]).tolist():
            rows = np.flatnonzero(known & (length == n))
            found, counts[rows] = self._segment_column(symbols[begin[rows] + np.arange(n)[:, None]].astype(np.int64), skips[rows])
            ids.append(found)
            order.append(rows)
        for i in np.flatnonzero(~known).tolist():  # with characters that are written as bytes
            own = self.segment(words[i], int(skips[i]))
            counts[i] = len(own)
            ids.append(np.array(own, np.int64))
            order.append(np.array([i]))
        rows = np.concatenate(order)
        starts = np.empty(len(words), np.int64)
        starts[rows] = np.cumsum(counts[rows]) - counts[rows]
        shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
        return np.concatenate(ids)[np.arange(len(shift)) + shift].astype(np.int32), counts

    def _skips(self, key: int, word: str, dropout: float) -> int:
        """Bits for every candidate of a word: it has fewer than three for each character."""
        count = -(-3 * len(word) // 64)
        keys = np.uint64(key) + np.arange(count, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return int.from_bytes(skip_bits(keys, dropout).tobytes(), "little")

    def encode(
        self, texts: list[str], keys: list[int], dropout: float, seed: int, variants: int | None = None
    ) -> list[np.ndarray]:
        """Ids of each text; keys: one number for each text that its hashes depend on.

        variants  number of keys by document and place, if they are to be so few; by default each place has its own
        """
        words, sizes = [], []
        for t in texts:
            own = self.words(t) if t else []
            words += own
            sizes.append(len(own))
        if not words:
            return [np.empty(0, np.int32) for _ in texts]
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        distinct = list(number)
        varied, varied_counts = [], np.empty(0, np.int64)  # ids of the words with skips
        plain = np.ones(len(words), bool)
        if dropout:
            sizes_ = np.array(sizes)
            place = np.arange(len(words)) - np.repeat(np.cumsum(sizes_) - sizes_, sizes_)
            key = np.repeat(np.array([k & _MASK for k in keys], np.uint64), sizes_)
            key = _mixed(_mixed(key ^ np.uint64(seed & _MASK)) + place.astype(np.uint64))
            if variants:
                key %= np.uint64(variants)
            hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], np.uint64)
            key = _mixed(_mixed(hashed + np.uint64(seed & _MASK))[at] + key)
            length = np.array([len(w) for w in distinct])[at]
            bits = skip_bits(key, dropout)
            # fewer than len(word) candidates leave the agenda before one is skipped, fewer than 3 len(word) - 2 at all
            ones = lambda n: (np.uint64(1) << n.astype(np.uint64)) - np.uint64(1)
            short = length <= _COLUMN
            plain = (bits & ones(np.minimum(length, 64) - 1)) == 0
            plain[length > 64] = False
            bits = np.where(short, bits & ones(np.minimum(3 * (length - 1), 63)), bits)
            special = at == number[_SIGN] if _SIGN in number else np.zeros(len(words), bool)
            rest, some = np.flatnonzero(~plain & (~short | special)), np.flatnonzero(~plain & short & ~special)
            for i, k in zip(rest.tolist(), key[rest].tolist()):
                varied.append(np.array(self.segment(words[i], self._skips(k, words[i], dropout)), np.int32))
            ids, counts = self._segment_all([words[i] for i in some.tolist()], bits[some])
            varied_counts = np.concatenate([[len(x) for x in varied], counts]).astype(np.int64)
            varied.append(ids)
            at[np.concatenate([rest, some])] = len(distinct) + np.arange(len(rest) + len(some))
        needed = np.zeros(len(distinct), bool)
        needed[at[plain]] = True
        known = self.known
        whole = [
            w for w, n in zip(distinct, needed.tolist())
            if n and w not in known and len(w) > 1 and w[0] == _SPACE and "\0" not in w
        ]
        found = dict(zip(whole, self.model.encode([w[1:].replace(_SPACE, " ") for w in whole], num_threads=1)))
        pieces = []
        for word, n in zip(distinct, needed.tolist()):
            own = (known.get(word) or found.get(word)) if n else []
            pieces.append(self.segment(word) if own is None else own)
        if len(known) < _KNOWN:
            known.update((w, ids) for w, ids in found.items() if len(w) <= _SHORT)
        lengths = np.concatenate([np.array(list(map(len, pieces)), np.int64), varied_counts])
        flat = np.concatenate([np.fromiter(chain.from_iterable(pieces), np.int32), *varied])
        begins, counts = (np.cumsum(lengths) - lengths)[at], lengths[at]
        ends = np.cumsum(counts)
        ids = flat[np.arange(ends[-1]) + np.repeat(begins - (ends - counts), counts)]
        bounds = np.concatenate([[0], ends])[np.cumsum(sizes)]
        return np.split(ids, bounds[:-1])

    def decode(self, ids) -> str:
        """Text of ids: bytes are joined before they are read, the prefix is taken off."""
        return b"".join(map(self.table.__getitem__, np.asarray(ids).tolist())).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=1)
def _codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def _encoded(
    codec: PieceCodec, batches: Iterator[pd.DataFrame], dropout: float, seed: int, variants: int | None
) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    for batch in batches:
        sizes = batch["text"].str.len().cumsum() // _CHARS
        for _, part in batch.groupby(sizes.to_numpy(), sort=False):
            keys = [xxhash.xxh3_64_intdigest("" if pd.isna(k) else str(int(k))) for k in part["doc_id"]]
            yield part, codec.encode(part["text"].tolist(), keys, dropout, seed, variants)


def encode_texts(
    docs: DataFrame, path: str, dropout: float = 0.1, seed: int = 7, variants: int | None = None,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, text, ids of every row.

    dropout   rate at which candidate merges are skipped; 0 gives the model's own encoding
    variants  number of keys by document and place, if they are to be so few; by default each place has its own

    A missing or empty text has no ids. Repeated rows have the same ids. Further
    columns are not read.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, ids in _encoded(_codec(path), batches, dropout, seed, variants):
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "text": part["text"].to_numpy(), "ids": ids})

    return keyed_text(docs, key, text).mapInPandas(work, "doc_id long, text string, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The input's columns with `decoded`; missing ids decode to the empty text."""
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(path)
        for batch in batches:
            yield batch.assign(decoded=["" if x is None else codec.decode(x) for x in batch[ids]])

    return encoded.mapInPandas(work, schema)


def round_trip(
    docs: DataFrame, path: str, dropout: float = 0.1, seed: int = 7, variants: int | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_ids, ids_hash, decoded_sha256, lossless of every row: texts are encoded and decoded in one pass."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(path)
        for part, ids in _encoded(codec, batches, dropout, seed, variants):
            decoded = [codec.decode(x) for x in ids]
            yield pd.DataFrame(
                {
                    "doc_id": part["doc_id"].to_numpy(), "n_ids": [len(x) for x in ids],
                    "ids_hash": [xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) for x in ids],
                    "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in decoded],
                    "lossless": [a == b for a, b in zip(decoded, part["text"])],
                }
            )

    schema = "doc_id long, n_ids long, ids_hash long, decoded_sha256 string, lossless boolean"
    return keyed_text(docs, key, text).mapInPandas(work, schema)
