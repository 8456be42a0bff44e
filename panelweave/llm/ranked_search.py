"""Exact top-k BM25 search over shards, with block maxima and bounds of whole shards.

Each task indexes the texts it reads as one or more shards: postings by term, and
for each term the greatest impact in every block of documents. Documents are
ordered by their most frequent term and their length, so that blocks are alike
and their bounds are tight.

A single query (`Shard.search`): the bounds of its terms are added up by
block (those of terms of many documents by document first, the best document's sum
standing for the block, which is less than the sum of maxima); blocks are scored from the highest bound down, and all blocks whose bound
is below the k-th best score so far are skipped: none of their documents can be
among the best k.

Many queries (`Shard.search_many`, what the operator uses): whole texts as queries have so many terms that
the bounds of most blocks reach the k-th score, and adding up the bounds takes longer than the scores.
The only bound is that of the shard. Scores of terms of many documents are one matrix product for many queries, those of others are summed
by posting, in single precision; documents that may be among the best k with such a score are then
scored exactly. Some shards are searched first; their k-th best scores are what a document of any other shard has to reach.

Counts of documents and their mean length are global, so the shards' results are merged exactly.
Queries are taken in blocks of a bounded number of terms, each sent to all shards.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelweave.lineage import durable
from panelweave.llm.packed import dump, load
from panelweave.llm.texts import keyed_text

BLOCK = 64  # documents of a block
OFTEN = 8  # terms of at least one in so many of a shard's documents are also kept by document
DENSE = 16  # the same for searches at once
_WORD = re.compile(r"\w+")
_PIECE_CHARS = 4_000_000
_SHARD_CHARS = 32_000_000
_SCORES = 1 << 20  # scores held at once
_QUERIES = 512  # queries prepared at once
_POSTINGS = 1 << 16  # postings summed at once, few enough for the processor's cache
_QUERY_TERMS = 4_000_000  # terms of the queries sent to the shards at once
_EARLY = 16  # the shards of one in so many tasks are searched first


def _terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Term hash, document and count of every distinct pair, sorted by term; lengths of the documents."""
    words: list[str] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        own = _WORD.findall(t.lower())
        words += own
        sizes[i] = len(own)
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), sizes
    code, distinct = pd.factorize(np.array(words, dtype=object))
    key, n = np.unique(code * len(texts) + np.repeat(np.arange(len(texts)), sizes), return_counts=True)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], np.uint64)[key // len(texts)]
    order = np.argsort(hashes, kind="stable")
    return hashes[order], (key % len(texts))[order], n[order], sizes


def build_shards(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (data, rows, words, early): a packed shard, its number of documents and of words, and whether it is searched first."""

    def shard(pieces: list[tuple]) -> pd.DataFrame:
        first, ids, known, sizes, h, d, n = 0, [], [], [], [], [], []
        for own_ids, own_known, (hashes, doc, count, size) in pieces:
            ids.append(own_ids)
            known.append(own_known)
            sizes.append(size)
            h.append(hashes)
            d.append(doc + first)
            n.append(count)
            first += len(size)
        ids, known, sizes = np.concatenate(ids), np.concatenate(known), np.concatenate(sizes)
        h, d, n = np.concatenate(h), np.concatenate(d), np.concatenate(n)
        terms, place = np.unique(h, return_inverse=True)
        main = np.full(len(sizes), -1, np.int64)  # the most frequent term of each document
        order = np.lexsort((place, n, d))
        last = np.flatnonzero(np.append(d[order][1:] != d[order][:-1], True)) if len(d) else order
        main[d[order][last]] = place[order][last]
        rank = np.empty(len(sizes), np.int64)
        by = np.lexsort((ids, sizes, main))
        rank[by] = np.arange(len(sizes))
        order = np.lexsort((rank[d], place))
        postings = np.bincount(place, minlength=len(terms)).astype(np.uint32)
        data = dump(
            terms, postings, rank[d][order].astype(np.uint32), n[order].astype(np.uint32),
            sizes[by].astype(np.uint32), ids[by], known[by],
        )
        early = TaskContext.get().partitionId() % _EARLY == 0
        return pd.DataFrame({"data": [data], "rows": [len(sizes)], "words": [int(sizes.sum())], "early": [early]})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces: list[tuple] = []
        chars = 0
        for batch in batches:
            cuts = batch["text"].str.len().cumsum() // _PIECE_CHARS
            for _, rows in batch.groupby(cuts.to_numpy(), sort=False):
                known = rows["doc_id"].notna().to_numpy()
                pieces.append((rows["doc_id"].fillna(0).to_numpy(np.int64), known, _terms(rows["text"].tolist())))
                chars += int(rows["text"].str.len().sum())
                if chars >= _SHARD_CHARS:
                    yield shard(pieces)
                    pieces, chars = [], 0
        if pieces:
            yield shard(pieces)

    return keyed_text(docs, key, text).mapInPandas(work, "data binary, rows long, words long, early boolean")


def _document_counts(shards: DataFrame) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                terms, postings = load(data, 2)
                yield pd.DataFrame({"term": terms.view(np.int64), "df": postings.astype(np.int64)})

    return shards.select("data").mapInPandas(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """query_id, query (one number for each row), term: the distinct terms of every query."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, query, text_ in zip(batch["query"], batch["doc_id"], batch["text"]):
                terms = np.array(sorted({xxhash.xxh3_64_intdigest(w) for w in _WORD.findall(text_.lower())}), np.uint64)
                yield pd.DataFrame(
                    {"query": np.full(len(terms), row), "query_id": pd.Series([query] * len(terms), dtype="Int64"), "term": terms.view(np.int64)}
                )

    rows = keyed_text(queries, key, text).withColumn("query", F.monotonically_increasing_id())
    return rows.mapInPandas(work, "query long, query_id long, term long")


class Shard:
    """A loaded shard with the impacts of its postings.

    Single searches use the greatest impacts by term and block. Many searches at once use the greatest of
    each term, and the postings by document, in which the few documents near the best k are scored exactly.
    """

    def __init__(self, data: bytes, mean: float, k1: float, b: float) -> None:
        self.terms, postings, doc, count, sizes, self.ids, self.known = load(data)
        self.doc = doc.astype(np.intp)  # as bincount takes them, not turned again by every search
        self.postings = postings.astype(np.int64)
        self.ends = np.cumsum(self.postings)
        n = count.astype(np.float64)
        self.impact = n * (k1 + 1) / (n + k1 * (1 - b + b * sizes[self.doc] / mean))
        self.blocks = -(-len(self.ids) // BLOCK)

    def _cells(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The postings of one term in one range of `size` documents: first, end, range and greatest impact; first cell of each term."""
        at = self.doc // size
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1]
        new[self.ends[:-1]] = True
        begin = np.flatnonzero(new)
        greatest = np.maximum.reduceat(self.impact, begin) if len(at) else self.impact
        first = np.searchsorted(begin, np.concatenate([[0], self.ends]))
        return begin, np.append(begin[1:], len(at)), at[begin], greatest, first

    @cached_property
    def by_block(self) -> tuple:
        begin, end, block, greatest, first = self._cells(BLOCK)
        # impacts of the terms of many documents by document, which takes no more than a few times their postings
        is_often = (self.postings * OFTEN >= len(self.ids)) & (self.postings >= BLOCK)
        often = np.flatnonzero(is_often)
        by_document = np.zeros((len(often), self.blocks * BLOCK), np.float32)
        for i, t in enumerate(often.tolist()):
            own = slice(self.ends[t] - self.postings[t], self.ends[t])
            by_document[i, self.doc[own]] = self.impact[own]
            greatest[first[t] : first[t + 1]] = 0
        return begin, end, block, greatest, first, is_often, self.terms[often], by_document

    @property
    def begin(self) -> np.ndarray:
        """First posting of each (term, block)."""
        return self.by_block[0]

    @property
    def end(self) -> np.ndarray:
        return self.by_block[1]

    @property
    def first(self) -> np.ndarray:
        """First (term, block) of each term."""
        return self.by_block[4]

    @cached_property
    def dense(self) -> tuple[np.ndarray, np.ndarray]:
        """Row of each term in the impacts by document of the terms that many documents have, or -1; these impacts."""
        often = np.flatnonzero((self.postings * DENSE >= len(self.ids)) & (self.postings > 1))
        row = np.full(len(self.terms), -1, np.int64)
        row[often] = np.arange(len(often))
        impacts = np.zeros((len(often), len(self.ids)), np.float32)
        spot = _ranges(self.ends[often] - self.postings[often], self.ends[often])
        impacts[np.repeat(np.arange(len(often)), self.postings[often]), self.doc[spot]] = self.impact[spot]
        return row, impacts

    @cached_property
    def paired(self) -> np.ndarray:
        """Document and impact of each posting, in half of the bytes and beside each other, as a search reads many."""
        out = np.empty(len(self.doc), [("doc", np.int32), ("impact", np.float32)])
        out["doc"], out["impact"] = self.doc, self.impact
        return out.view(np.int64)

    @cached_property
    def greatest(self) -> np.ndarray:
        """The greatest impact of each term."""
        return np.maximum.reduceat(self.impact, self.ends - self.postings) if len(self.ends) else self.impact

    @cached_property
    def by_document(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Term and impact of the postings by document and term; first posting of each document."""
        small = len(self.ids) <= 1 << 16  # numbers of two bytes are sorted by digits
        order = np.argsort(self.doc.astype(np.uint16) if small else self.doc, kind="stable")
        term = np.repeat(np.arange(len(self.terms), dtype=np.int32), self.postings)
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.doc, minlength=len(self.ids)))])
        return term[order], self.impact[order], starts

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Place of each term in the shard, -1 for others."""
        at = np.searchsorted(self.terms, terms)
        found = at < len(self.terms)
        found[found] = self.terms[at[found]] == terms[found]
        return np.where(found, at, -1)

    def search_all(
        self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, least: np.ndarray | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """What `search` finds for each of the (terms, weights)."""
        starts = np.concatenate([[0], np.cumsum([len(terms) for terms, _ in queries], dtype=np.int64)])
        none = [(np.empty(0, np.uint64), np.empty(0))]
        terms, weights = (np.concatenate(x) for x in zip(*(queries or none)))
        return self.search_many(starts, self.places(terms), weights, k, least)

    def search_many(
        self, starts: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int, least: np.ndarray | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Documents and scores of the best k of each query, and the number of documents scored.

        starts  first term of each query, and the end of the last
        at      place of each term in the shard, -1 for others
        least   score by query that its best k of all shards certainly reach: documents below it are left out

        Queries whose terms' greatest impacts do not reach their least score are not searched. Queries
        with similar terms should stand together, as their matrix product has a row for each dense term of any of them.
        """
        n = len(starts) - 1
        least = np.zeros(n) if least is None else least
        of = np.repeat(np.arange(n), np.diff(starts))
        here = at >= 0
        of, at, weights = of[here], at[here], weights[here]
        bound = np.bincount(of, weights=weights * self.greatest[at], minlength=n) * (1 + 1e-9)
        here = ((bound > 0) & (bound >= least))[of]
        of, at, weights = of[here], at[here], weights[here]
        starts = np.searchsorted(of, np.arange(n + 1))
        step = max(1, _SCORES // max(1, len(self.ids)))
        for first in range(0, n, step):
            some = range(first, min(first + step, n))
            own = slice(starts[some[0]], starts[some[-1] + 1])
            yield from self._search_some(starts[first : some[-1] + 2] - own.start, at[own], weights[own], k, least[first : some[-1] + 1])

    def _search_some(
        self, starts: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int, least: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """`search_many` for as many queries as are worked on at once."""
        docs, rows = len(self.ids), len(starts) - 1
        row, impacts = self.dense
        over = 1 + 1e-6 * (4 + len(impacts))  # more than single precision loses
        # terms of many documents: one product for all queries
        place, of = row[at], np.repeat(np.arange(rows), np.diff(starts))
        often = place >= 0
        used, place_ = np.unique(place[often], return_inverse=True)
        given = np.zeros((rows, len(used)), np.float32)
        given[of[often], place_] = weights[often]
        from_often = given @ (impacts if len(used) == len(impacts) else impacts[used])
        # other terms: posting by posting, a few queries at once
        at_, weights_, of_ = at[~often], weights[~often].astype(np.float32), of[~often]
        end, size = self.ends[at_], self.postings[at_]
        begin, upto, paired = (end - size).tolist(), end.tolist(), self.paired
        cuts = np.searchsorted(of_, np.arange(rows + 1)).tolist()
        summed = np.concatenate([[0], np.cumsum(size)])[cuts].tolist()
        first = 0
        while first < rows:
            last = first + 1  # of the queries worked on now
            while last < rows and summed[last + 1] - summed[first] <= _POSTINGS:
                last += 1
            own = slice(cuts[first], cuts[last])
            # whole ranges are copied faster than posting by posting
            pairs = np.concatenate([paired[:0], *(paired[lo:hi] for lo, hi in zip(begin[own], upto[own]))]).view(np.int32)
            place = pairs[::2] + np.repeat((of_[own] - first) * docs, size[own])
            part = pairs.view(np.float32)[1::2] * np.repeat(weights_[own], size[own])
            total = np.bincount(place, weights=part, minlength=(last - first) * docs).reshape(-1, docs)
            total = total + from_often[first:last]  # without postings the first is of whole numbers
            for i in range(first, last):
                terms = slice(starts[i], starts[i + 1])
                yield self._best(total[i - first], at[terms], weights[terms], k, least[i], over)
            first = last

    def _best(
        self, total: np.ndarray, at: np.ndarray, weights: np.ndarray, k: int, least: float, over: float
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and exact scores of the best k by their nearly exact scores."""
        if not len(at):
            return np.empty(0, np.int64), np.empty(0), 0
        docs = np.flatnonzero(total >= least / over if least > 0 else total > 0)
        if len(docs) > k:  # the k-th best score is at least
            sums = total[docs]
            docs = docs[sums * over**2 >= np.partition(sums, len(sums) - k)[len(sums) - k]]
        if not len(docs):
            return docs, np.empty(0), len(total)
        term, impact, first = self.by_document
        self._weight[at] = weights
        begin, end = first[docs], first[docs + 1]
        spot = _ranges(begin, end)
        parts = self._weight[term[spot]] * impact[spot]
        self._weight[at] = 0
        scores = np.bincount(np.repeat(np.arange(len(docs)), end - begin), weights=parts, minlength=len(docs))
        if len(docs) > k:
            best = np.lexsort((self.ids[docs], -scores))[:k]
            docs, scores = docs[best], scores[best]
        return docs, scores, len(total)

    @cached_property
    def _weight(self) -> np.ndarray:
        return np.zeros(len(self.terms))

    def often_scores(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """By query and document: the score from terms of many documents, in single precision."""
        *_, often, by_document = self.by_block
        own = np.zeros((len(queries), len(often)), np.float32)
        for i, (terms, weights) in enumerate(queries):
            _, at, of = np.intersect1d(often, terms, assume_unique=True, return_indices=True)
            own[i, at] = weights[of]
        return own @ by_document

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the best k (ties: least id first), and the number of blocks scored."""
        _, _, block_of, greatest, first, is_often, names, _ = self.by_block
        (often,) = self.often_scores([(terms, weights)])
        often = often.astype(np.float64).reshape(self.blocks, BLOCK)
        rounded = 1e-6 * (4 + len(names))  # more than single precision loses, as a share
        over = 1 + rounded
        at = self.places(terms)
        at, weights = at[at >= 0], weights[at >= 0]
        if not len(at):
            return np.empty(0, np.int64), np.empty(0), 0
        begin, end = first[at], first[at + 1]
        cells = _ranges(begin, end)
        block, weight = block_of[cells], np.repeat(weights, end - begin)
        bound = np.bincount(block, weights=weight * greatest[cells], minlength=self.blocks) * (1 + 1e-9)
        bound += often.max(axis=1) * over
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        docs, sums, least, done, step = np.empty(0, np.int64), np.empty(0), 0.0, 0, 4
        rare = np.repeat(~is_often[at], end - begin)
        cells_, block_, weight_ = cells[rare], block[rare], weight[rare]
        while done < len(order) and bound[order[done]] >= least:
            batch = order[done : done + step]
            batch = batch[bound[batch] >= least]
            done, step = done + len(batch), step * 2
            total = self._sums(cells_, block_, weight_, batch).reshape(-1, BLOCK)[batch] + often[batch]
            hit = np.flatnonzero(total.ravel() * over >= least) if least else np.flatnonzero(total.ravel() > 0)
            docs = np.concatenate([docs, batch[hit // BLOCK] * BLOCK + hit % BLOCK])
            sums = np.concatenate([sums, total.ravel()[hit]])
            if len(docs) >= k:  # the k-th best score is at least
                least = np.partition(sums, len(sums) - k)[len(sums) - k] * (1 - rounded)
                near = sums * over >= least
                docs, sums = docs[near], sums[near]
        scores = self._sums(cells, block, weight, docs // BLOCK)[docs]
        if len(docs) > k:
            best = np.lexsort((self.ids[docs], -scores))[:k]
            docs, scores = docs[best], scores[best]
        return docs, scores, done

    def _sums(self, cells: np.ndarray, block: np.ndarray, weight: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Scores by document from the cells that lie in some of the blocks."""
        chosen = np.zeros(self.blocks, bool)
        chosen[wanted] = True
        chosen = np.flatnonzero(chosen[block])
        begin, end = self.begin[cells[chosen]], self.end[cells[chosen]]
        spot, part = _ranges(begin, end), np.repeat(weight[chosen], end - begin)
        part *= self.impact[spot]
        return np.bincount(self.doc[spot], weights=part, minlength=self.blocks * BLOCK)


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of several ranges."""
    size = end - begin
    ends = np.cumsum(size)
    out = np.repeat(begin - (ends - size), size)
    out += np.arange(len(out))
    return out


def _query_blocks(weighted: DataFrame, spark: SparkSession) -> list[bytes]:
    """The queries as packed blocks of about half of _QUERY_TERMS terms.

    A block holds its queries (number, id, whether that is known, number of terms), the place of each of their
    terms among the distinct terms of the block, and these with their weights.
    """

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        terms, place = np.unique(rows["term"].to_numpy().view(np.uint64), return_inverse=True)
        weight = np.empty(len(terms))
        weight[place] = rows["weight"].to_numpy()
        query = rows["query"].to_numpy()
        order = np.lexsort((place, query))
        query, place = query[order], place[order]
        starts = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
        first = order[starts]
        data = dump(
            query[starts], rows["query_id"].to_numpy(np.int64)[first], rows["known"].to_numpy(bool)[first],
            np.diff(np.append(starts, len(query))).astype(np.uint32), place.astype(np.uint32), terms, weight,
        )
        return pd.DataFrame({"data": [data]})

    groups = max(1, math.ceil(weighted.count() / (_QUERY_TERMS // 2)))
    rows = weighted.select(
        "query", F.coalesce("query_id", F.lit(0)).alias("query_id"), F.col("query_id").isNotNull().alias("known"), "term", "weight",
        F.pmod(F.xxhash64("query"), F.lit(groups)).alias("block"),
    )
    packed = rows.groupBy("block").applyInPandas(pack, "data binary")
    return [bytes(row["data"]) for row in packed.toLocalIterator()]


def _searcher(sent: Broadcast, mean: float, k: int, k1: float, b: float) -> Callable:
    """Searches a packed block of queries in packed shards; `sent` has the block and the queries' least scores, if they are known."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, low = sent.value
        query, query_id, known, sizes, place, terms, weight = load(block)
        starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        least = np.zeros(len(query)) if low is None else low.copy()
        for batch in batches:
            for value in batch["data"]:
                shard = Shard(value, mean, k1, b)
                at = shard.places(terms)
                for lo in range(0, len(query), _QUERIES):
                    cut = starts[lo : lo + _QUERIES + 1]
                    own = place[cut[0] : cut[-1]]
                    best = list(shard.search_many(cut - cut[0], at[own], weight[own], k, least[lo : lo + _QUERIES]))
                    found, scores = (np.concatenate(x) for x in list(zip(*best))[:2])
                    of = lo + np.repeat(np.arange(len(best)), [len(x[0]) for x in best])
                    yield pd.DataFrame(
                        {
                            "query": query[of], "query_id": pd.Series(query_id[of], dtype="Int64").where(pd.Series(known[of])),
                            "doc_id": pd.Series(shard.ids[found], dtype="Int64").where(pd.Series(shard.known[found])),
                            "score": scores,
                        }
                    )
                    for i, (_, own_scores, _) in enumerate(best, lo):
                        if len(own_scores) == k:  # no shard after this one needs to give less
                            least[i] = max(least[i], own_scores.min())

    return work


def search(
    docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.2, b: float = 0.75,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """query_id, rank, doc_id, score: the exact best k rows of `docs` for every row of `queries`.

    A query is the set of the distinct terms of its whole text: runs of letters,
    digits and underscores in lower case. Ties go to the least doc_id. A query
    without terms, or whose terms no document has, has no results; fewer than k
    matching rows are all returned. Missing texts are empty; repeated rows are
    ranked each; rows without a doc_id are ranked as 0 and returned as missing.
    Further columns are not read.
    """
    spark = docs.sparkSession
    shards = durable(build_shards(docs, key, text))
    rows, words = shards.agg(F.sum("rows"), F.sum("words")).first()
    rows, mean = rows or 0, max(1.0, (words or 0) / max(1, rows or 0))
    idf: Column = F.log(1 + (F.lit(rows) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = durable(
        _query_terms(queries, key, text).join(_document_counts(shards), "term")
        .select("query", "query_id", "term", idf.alias("weight"))
    )
    blocks = _query_blocks(weighted, spark)

    def searched(some: DataFrame, least: list) -> DataFrame | None:
        found = None
        for block, low in zip(blocks, least):
            part = some.select("data").mapInPandas(
                _searcher(spark.sparkContext.broadcast((block, low)), mean, k, k1, b),
                "query long, query_id long, doc_id long, score double",
            )
            found = part if found is None else found.unionByName(part)
        return found

    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    # some shards are searched first: their k-th best score is a bound for the search of all others
    early = durable(searched(shards.filter("early"), [None] * len(blocks)))
    last = Window.partitionBy("query").orderBy(F.desc("score"))
    reached = early.withColumn("_rn", F.row_number().over(last)).filter(F.col("_rn") == k).select("query", "score")
    reached = reached.toPandas()  # one row of 16 bytes by query
    low = pd.Series(reached["score"].to_numpy(float), index=reached["query"].to_numpy(np.int64))
    least = [low.reindex(load(block, 1)[0]).fillna(0.0).to_numpy() for block in blocks]
    results = early.unionByName(searched(shards.filter("NOT early"), least))
    best = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), F.coalesce("doc_id", F.lit(0)))
    return (
        results.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "doc_id", "score")
    )
