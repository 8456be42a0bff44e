"""Hierarchical Pitman-Yor language model: Gibbs-sampled seating, averaged predictions.

A word is a customer of the restaurant of its context (the word before it, told
apart by its full 64-bit hash); all restaurants share one parent, the unigram
restaurant, whose base is uniform over the words and one unknown word. A table of
a restaurant is a customer of the parent. The predictive probability is

    P(w|u) = (c_uw - d t_uw + (s + d t_u) P(w)) / (s + c_u)

with c customers, t tables, discount d and strength s, and likewise for P(w) over
the base; it is averaged over the seatings sampled after a burn-in.

Sampling is blocked Gibbs: all customers of one dish leave their restaurant and
are seated anew given everything else. The number of tables t they take then has
probability proportional to a**t S(c, t), with a the weight of a new table and S
the generalised Stirling number of the discount; it is drawn from the exact
numbers up to EXACT customers and from their saddle-point form beyond.

Spark's part: each block of texts sends its (word, context, document) counts,
packed as columns, to the partition of the word, so all a dish needs is in one
task; words that make up much of the corpus are dealt by word and context instead,
so no task holds one. The restaurants are a table that grows with the corpus,
dealt by ranges of the context's hash into shards: before the first sweep each part
is told the customers, dishes and places of its contexts, and after every sweep the
parts send their tables by place and are told the sums over all parts. What no
sweep changes is written once; a sweep's rows are deleted when the next ones are
written, and a sample keeps its numbers of tables only. Only the
tables of the frequent words and the overall sums pass through the driver. Parts
sample at the same time, each given all tables of the sweep before, so each
averaged prediction sums to one over the words. The number of parts depends on
the texts alone. Each task returns a packed column of sums for the documents of
each block, and these are added up.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.lineage import discard, durable, shuffles_released
from panelweave.llm.packed import dump, load
from panelweave.llm.texts import keyed_text, py_remainder

EXACT = 96  # customers of a dish up to which the Stirling numbers are tabled
_END = xxhash.xxh3_64_intdigest(b"\n")  # no word is white space
_BEGIN = xxhash.xxh3_64_intdigest(b"\n\n")
_BLOCK_CHARS = 3_000_000
_PART_CHARS = 16_000_000
_PARTS = 32  # at least, on few texts


def words_of(text: str) -> list[bytes]:
    """Words cut at blanks and \\x09-\\x0D, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _mix(w: np.ndarray, context: np.ndarray) -> np.ndarray:
    x = (w ^ context * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(31)


def _deal(w: np.ndarray, context: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    x = w * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    if len(hot):
        x = np.where(np.isin(w, hot), _mix(x, context), x)
    return (x % np.uint64(parts)).astype(np.int32)


def _gaps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, which pack better than the numbers; cumsum turns them back."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _numbers(gaps: np.ndarray) -> np.ndarray:
    return np.cumsum(gaps, dtype=gaps.dtype)


def _block(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hash, context and document of every token of a block."""
    words: list[bytes] = []
    sizes = []
    for t in texts:
        own = words_of(t)
        words += own
        words.append(b"\n")
        sizes.append(len(own) + 1)
    code, distinct = pd.factorize(np.array(words, dtype=object))
    del words
    w = np.array([xxhash.xxh3_64_intdigest(x) for x in distinct], np.uint64)[code]
    context = np.concatenate([np.array([_BEGIN], np.uint64), w[:-1]])
    context[np.cumsum(sizes)[:-1]] = _BEGIN
    return w, context, np.repeat(np.arange(len(texts), dtype=np.uint32), sizes)


def _counted(keyed: DataFrame, hot: np.ndarray, parts: int, modulus: int, held: int) -> DataFrame:
    """Rows (part, data): what a block sends to a part."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pieces = batch["text"].str.len().cumsum() // _BLOCK_CHARS
            for _, rows in batch.groupby(pieces.to_numpy(), sort=False):
                ids = rows["row"].to_numpy()
                keys = [None if pd.isna(k) else int(k) for k in rows["doc_id"]]
                known = np.array([k is not None for k in keys])
                train = np.array([py_remainder(k, modulus) != held for k in keys])
                w, context, doc = _block(rows["text"].tolist())
                part = _deal(w, context, hot, parts)
                order = np.lexsort((doc, context, w, part))
                w, context, doc, part = w[order], context[order], doc[order], part[order]
                new_pair = np.ones(len(w), bool)
                new_pair[1:] = (w[1:] != w[:-1]) | (context[1:] != context[:-1]) | (part[1:] != part[:-1])
                new = new_pair.copy()
                new[1:] |= doc[1:] != doc[:-1]
                at = np.flatnonzero(new)
                count = np.diff(np.append(at, len(w))).astype(np.uint32)
                pair = np.cumsum(new_pair)[at] - 1  # pair of each entry
                first = np.flatnonzero(new_pair)
                trained = np.bincount(pair, weights=count * train[doc[at]], minlength=len(first)).astype(np.uint32)
                doc, entries = doc[at], np.bincount(pair, minlength=len(first)).astype(np.uint32)
                docs = np.array([k or 0 for k in keys], np.int64)
                out = []
                bounds = np.searchsorted(part[first], np.arange(parts + 1))
                spans = np.concatenate([[0], np.cumsum(entries, dtype=np.int64)])
                for p in range(parts):
                    lo, hi = bounds[p], bounds[p + 1]
                    if lo < hi:
                        a, b = spans[lo], spans[hi]
                        own, sizes = np.unique(w[first[lo:hi]], return_counts=True)
                        u, place = np.unique(context[first[lo:hi]], return_inverse=True)
                        out.append((p, dump(
                            _gaps(own), sizes.astype(np.uint32), _gaps(u), place.astype(np.uint32), trained[lo:hi],
                            entries[lo:hi], doc[a:b], count[a:b], np.diff(ids, prepend=0), np.diff(docs, prepend=0), known, train,
                        )))
                yield pd.DataFrame(out, columns=["part", "data"])

    return keyed.mapInPandas(work, "part int, data binary")


def _merged(sent: DataFrame) -> DataFrame:
    """One row for each part: its pairs with their training counts, and the entries of all blocks."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        part, sent_ = int(rows["part"].iloc[0]), rows["data"].tolist()
        del rows
        # only the pairs of all blocks are held at once; entries are read block by block
        columns = [load(d, 5) for d in sent_]
        sizes = [len(c[3]) for c in columns]
        words, u = (np.unique(np.concatenate([_numbers(c[i]) for c in columns])) for i in (0, 2))
        key = np.concatenate([
            np.repeat(np.searchsorted(words, _numbers(c[0])), c[1]) * len(u) + np.searchsorted(u, _numbers(c[2]))[c[3]]
            for c in columns
        ])
        trained = np.concatenate([c[4] for c in columns])
        del columns
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        pair = np.empty(len(key), np.int32)
        pair[order] = np.cumsum(new) - 1
        del order
        trained = np.bincount(pair, weights=trained).astype(np.uint32)
        word, context = np.divmod(key[new], len(u))
        del key, new
        sizes_ = np.bincount(word, minlength=len(words)).astype(np.uint32)
        pairs = dump(_gaps(words), sizes_, _gaps(u), context.astype(np.uint32), trained)
        del words, u, word, context, trained
        entries, at = [], 0
        for d, size in zip(sent_, sizes):
            own, at = pair[at : at + size], at + size
            data = dump(np.diff(own, prepend=np.int32(0)).astype(np.int32), *load(d)[5:])
            entries.append(struct.pack("<Q", len(data)) + data)
        return pd.DataFrame({"part": [part], "pairs": [pairs], "entries": [b"".join(entries)]})

    return sent.groupBy("part").applyInPandas(work, "part int, pairs binary, entries binary")


def _totals(parts: DataFrame, hot: np.ndarray) -> dict[tuple[str, int], list[int]]:
    """Sums over all parts: by frequent word, and overall. Bounded by their number."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for value in batch["pairs"]:
                w, sizes, _, _, c = load(value)
                w = _numbers(w)
                word = np.repeat(np.arange(len(w)), sizes)
                seen = c > 0
                tokens = np.bincount(word, weights=c, minlength=len(w)).astype(np.int64)
                dishes = np.bincount(word[seen], minlength=len(w))
                often = np.isin(w, hot)
                rows = [("word", int(x) - (1 << 63), int(a), int(b), 0, 0) for x, a, b in zip(w[often], tokens[often], dishes[often])]
                rows.append(("all", 0, int((c == 1).sum()), int((c == 2).sum()), int(tokens.sum()), int((tokens[~often] > 0).sum())))
                rows.append(("root", 0, int((dishes[~often] == 1).sum()), int((dishes[~often] == 2).sum()), int(seen.sum()), 0))
                yield pd.DataFrame(rows, columns=["kind", "id", "a", "b", "c", "d"])

    summed = (
        parts.select("pairs").mapInPandas(work, "kind string, id long, a long, b long, c long, d long")
        .groupBy("kind", "id").agg(*[F.sum(x).alias(x) for x in "abcd"])
    )
    return {(r["kind"], r["id"]): [r[x] for x in "abcd"] for r in summed.collect()}


def _messages(part: int, shards: int, u: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(part, shard, data) for each shard that has some of the sorted contexts u."""
    bounds = np.searchsorted(u, np.array([(k << 64) // shards for k in range(shards)], np.uint64)).tolist() + [len(u)]
    for k, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        if lo < hi:
            yield part, k, dump(_gaps(u[lo:hi]), *[c[lo:hi] for c in columns])


def _exchanged(sent: DataFrame) -> DataFrame:
    """Rows (part, shard, data): the tables over all parts at the places whose gaps each part sent, in its order."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        columns = [load(d) for d in rows["data"]]
        places = [_numbers(c[0]) for c in columns]
        sums = np.bincount(np.concatenate(places), weights=np.concatenate([c[1] for c in columns])).astype(np.uint32)
        return pd.DataFrame({"part": rows["part"], "shard": rows["shard"], "data": [dump(sums[x]) for x in places]})

    return sent.groupBy("shard").applyInPandas(work, "part int, shard int, data binary")


def _received(rows: pd.DataFrame, columns: int) -> list[np.ndarray]:
    """Columns for all contexts of a part, from the answers of all shards."""
    loaded = [load(d) for d in rows.sort_values("shard")["data"]]
    return [np.concatenate([x[i] for x in loaded]) if loaded else np.empty(0, np.int64) for i in range(columns)]


def _restaurants(parts: DataFrame, shards: int) -> DataFrame:
    """Rows (part, shard, data): customers and dishes of a part's contexts, whether a pair of them has several
    customers anywhere, and the gaps between their places among the shard's contexts that have such pairs."""

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, pairs in zip(batch["part"], batch["pairs"]):
                _, _, u, context, c = load(pairs)
                sums = [np.bincount(context, weights=x, minlength=len(u)).astype(np.uint32) for x in (c, c > 0, c > 1)]
                yield pd.DataFrame(list(_messages(int(part), shards, _numbers(u), *sums)), columns=["part", "shard", "data"])

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        columns = [load(d) for d in rows["data"]]
        u, at = np.unique(np.concatenate([_numbers(c[0]) for c in columns]), return_inverse=True)
        customers, dishes, several = (
            np.bincount(at, weights=np.concatenate([c[i] for c in columns]), minlength=len(u)).astype(np.int64)
            for i in range(1, 4)
        )
        live = several > 0
        place = (np.cumsum(live) - 1).astype(np.uint32)
        own = np.split(at, np.cumsum([len(c[0]) for c in columns])[:-1])
        return pd.DataFrame({
            "part": rows["part"], "shard": rows["shard"],
            "data": [dump(customers[x], dishes[x], live[x], _gaps(place[x[live[x]]])) for x in own],
        })

    messages = parts.select("part", "pairs").mapInPandas(sent, "part int, shard int, data binary")
    return messages.groupBy("shard").applyInPandas(summed, "part int, shard int, data binary")


def _lgamma(z: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by 8."""
    shift = np.ones_like(z)
    for i in range(8):
        shift = shift * (z + i)
    z = z + 8
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) - np.log(shift)


@lru_cache(maxsize=8)
def _stirling(d: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers, [customers, tables]."""
    table = np.full((EXACT + 1, EXACT + 1), -np.inf)
    table[1, 1] = 0.0
    t = np.arange(1, EXACT + 1)
    for n in range(1, EXACT):
        with np.errstate(divide="ignore"):
            stay = np.log(np.maximum(n - d * t, 0))
        table[n + 1, 1:] = np.logaddexp(table[n, :-1], stay + table[n, 1:])
    return table


@lru_cache(maxsize=8)
def _saddle(d: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log(customers/table), and the exponent and variance of a table there.

    The numbers of t tables are coefficients of ((1 - (1-x)**d) / d)**t / t!.
    """
    y = np.exp(np.linspace(np.log(1e-150), np.log(1 - 1e-6), 40_000))[::-1]  # 1 - x, from x near 0
    x, f = 1 - y, -np.expm1(d * np.log(y))
    r = x * d * y ** (d - 1) / f
    slope = r * (1 + x * (1 - d) / y - r)  # x dr/dx
    return np.log(r), np.log(f) - r * np.log1p(-y), slope


@lru_cache(maxsize=8)
def _correction(d: float) -> np.ndarray:
    """What the saddle-point form lacks for few tables, taken from the exact numbers' last row."""
    t = np.arange(1, EXACT // 2 + 1, dtype=float)
    lacks = _stirling(d)[EXACT, 1 : len(t) + 1] - _plain_form(np.full(len(t), float(EXACT)), t, d)
    return lacks - lacks[-1]


def _log_stirling(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    lacks = _correction(d)
    return _plain_form(c, t, d) + np.interp(t, np.arange(1, len(lacks) + 1), lacks)


def _plain_form(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """Saddle-point form, less the terms that do not depend on t."""
    log_r, exponent, variance = _saddle(d)
    at = np.log(c / t)
    return (
        t * np.interp(at, log_r, exponent) - _lgamma(t + 1.0) - t * np.log(d)
        - 0.5 * np.log(t * np.maximum(np.interp(at, log_r, variance), 1e-12))
    )


def seat(c: np.ndarray, a: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with c customers each, if a new table has weight a and discount d."""
    tables = np.ones(len(c), np.int64)
    log_a, table = np.log(a), _stirling(d)
    order = np.argsort(c, kind="stable")
    ends = np.searchsorted(c[order], np.arange(EXACT + 2))
    for n in range(2, EXACT + 1):
        rows = order[ends[n] : ends[n + 1]]
        if len(rows):
            p = table[n, 1 : n + 1] + log_a[rows, None] * np.arange(1, n + 1)
            p = np.exp(p - p.max(axis=1, keepdims=True)).cumsum(axis=1)
            tables[rows] = 1 + (p < rng.random(len(rows))[:, None] * p[:, -1:]).sum(axis=1)
    rows = order[ends[EXACT + 1] :]
    if len(rows):
        n, w = c[rows].astype(float), log_a[rows]
        log_p = lambda t: t * w + _log_stirling(n, t, d)
        low, high = np.ones(len(rows)), n - 1
        while (high - low > 1).any():  # the mode lies where the log probability stops rising
            middle = np.floor((low + high) / 2)
            rises = log_p(middle + 1) > log_p(middle)
            low, high = np.where(rises & (high - low > 1), middle, low), np.where(~rises & (high - low > 1), middle, high)
        mode = np.maximum(1, high)
        bend = 2 * log_p(mode) - log_p(np.maximum(mode - 1, 1)) - log_p(np.minimum(mode + 1, n))
        step = np.maximum(1, np.round(np.sqrt(1 / np.maximum(bend, 1e-9)) / 4))
        within = np.floor(rng.random(len(rows)) * step) - np.floor(step / 2)
        best, chosen = np.full(len(rows), -np.inf), mode
        for k in range(-20, 21):  # five deviations to each side
            t = mode + k * step + within
            inside = (t >= 1) & (t <= n)
            drawn = np.where(inside, log_p(np.clip(t, 1, n)), -np.inf) + rng.gumbel(size=len(rows))
            best, chosen = np.where(drawn > best, drawn, best), np.where(drawn > best, t, chosen)
        tables[rows] = chosen.astype(np.int64)
    return tables


def _discount(one: int, two: int) -> float:
    return min(0.95, max(0.05, one / (one + 2 * two))) if one else 0.5


_SWEEP = "kind string, part int, shard int, id long, n long, data binary"


def _rows(kind: str, rows) -> pd.DataFrame:
    """Rows of _SWEEP from (part, shard, id, n, data)."""
    out = pd.DataFrame(list(rows), columns=["part", "shard", "id", "n", "data"])
    out.insert(0, "kind", kind)
    return out


def _root(
    customers: np.ndarray, tables: np.ndarray, all_customers: int, all_tables: int, strength: float, d0: float, base: float
) -> np.ndarray:
    """Probability of words in the root."""
    own = np.maximum(customers - d0 * tables.astype(float), 0)
    return (own + (strength + d0 * all_tables) * base) / (strength + all_customers)


def _sampled(
    parts: DataFrame, restaurants: DataFrame, totals: dict, hot: np.ndarray, seed: int, sweeps: int, burn: int,
    strength: float, d1: float, d0: float, vocabulary: int,
) -> tuple[list[DataFrame], dict[int, tuple[int, int]]]:
    """Rows (part, data) of each sample: its number, tables of the pairs with several customers and of the contexts
    that have such pairs, customers and tables of the words in the root; and for each number the root's own."""
    base = 1 / (vocabulary + 1)
    hot = np.sort(hot)
    # what the driver knows: all root customers and tables, those of each frequent word
    root_all, root_tables = totals.get(("root", 0), [0] * 4)[2], vocabulary
    hot_c = np.array([totals.get(("word", int(x) - (1 << 63)), [0] * 4)[1] for x in hot], np.int64)
    hot_t = np.minimum(hot_c, 1)

    def first(key, pairs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(pairs):
            return _rows("state", [])
        w, sizes, _, at, c = load(pairs["pairs"].iloc[0])
        w = _numbers(w)
        _, dishes, live = _received(answers, 3)
        gaps = {int(k): load(d)[3] for k, d in zip(answers["shard"], answers["data"])}
        word = np.repeat(np.arange(len(w), dtype=np.uint32), sizes)
        on = c > 1
        place = (np.cumsum(live) - 1).astype(np.uint32)
        alone = np.bincount(word[c == 1], minlength=len(w)).astype(np.uint32)
        index = np.searchsorted(hot, w) if len(hot) else np.zeros(len(w), np.int64)
        often = np.where(np.isin(w, hot), index, -1).astype(np.int32)
        single = np.bincount(at[c == 1], minlength=len(live)).astype(np.uint32)[live]
        least = alone + np.bincount(word[on], minlength=len(w))
        shard = np.array(sorted(gaps), np.int32)
        own = [gaps[k] for k in shard.tolist()]
        fixed = dump(
            _gaps(word[on]), place[at[on]], c[on], alone, often, single,
            np.concatenate([*own, np.empty(0, np.uint32)]), shard, np.array([len(x) for x in own], np.int64),
        )
        state = dump(np.ones(int(on.sum()), np.uint32), np.minimum(least, 1).astype(np.uint32))
        part = int(key[0])
        return pd.concat([
            _rows("fixed", [(part, 0, 0, 0, fixed)]), _rows("state", [(part, 0, 0, 0, state)]),
            _rows("tables", [(part, 0, 0, 0, dump(dishes[live].astype(np.uint32)))]),
        ])

    def sweep(number: int, root_all: int, root_tables: int, hot_c: np.ndarray, hot_t: np.ndarray):
        def work(rows: pd.DataFrame) -> pd.DataFrame:
            part = int(rows["part"].iloc[0])
            value = dict(zip(rows["kind"], rows["data"]))
            word, place, c, alone, often, single, gaps, shard, lengths = load(value["fixed"])
            word = _numbers(word)
            t, root_t = load(value["state"])
            (tables,) = _received(rows[rows["kind"] == "tables"], 1)
            by_driver = often >= 0
            root_c = alone + np.bincount(word, weights=t, minlength=len(alone))
            root_c[by_driver] = hot_c[often[by_driver]]
            root_t[by_driver] = hot_t[often[by_driver]]
            new_root = strength + d0 * root_tables
            p = _root(root_c, root_t, root_all, root_tables, strength, d0, base)
            out = []
            if number > burn:
                data = dump(np.array([number], np.uint32), t, tables, root_c.astype(np.int64), root_t)
                out.append(_rows("sample", [(part, 0, 0, 0, data)]))
            if number < sweeps:
                rng = np.random.default_rng([seed, part, number])
                t = seat(c.astype(np.int64), (strength + d1 * tables)[place] * p[word], d1, rng).astype(np.uint32)
                own = np.bincount(word, weights=t, minlength=len(alone)) + alone
                root_t, on = np.minimum(own, 1), np.flatnonzero((own > 1) & ~by_driver)
                root_t[on] = seat(np.rint(own[on]).astype(np.int64), np.full(len(on), new_root * base), d0, rng)
                state = dump(t, root_t.astype(np.uint32))
                sent = (single + np.bincount(place, weights=t, minlength=len(single))).astype(np.uint32)
                ends = np.cumsum(lengths)
                messages = [
                    (part, k, 0, 0, dump(gaps[b - n : b], sent[b - n : b]))
                    for k, b, n in zip(shard.tolist(), ends.tolist(), lengths.tolist()) if n
                ]
                sums = [(part, 0, -1, int(own.sum())), (part, 0, -2, int(root_t[~by_driver].sum()))]
                sums += [(part, 0, int(i), int(n)) for i, n in zip(often[by_driver], own[by_driver])]
                out.append(_rows("state", [(part, 0, 0, 0, state)]))
                out.append(_rows("sent", messages))
                out.append(_rows("sum", [(*x, None) for x in sums]))
            return pd.concat(out)

        return work

    at = durable(
        parts.select("part", "pairs").groupBy("part").cogroup(restaurants.groupBy("part")).applyInPandas(first, _SWEEP)
    )
    columns, unchanged, roots = ["kind", "part", "shard", "data"], at, {}
    fixed, answers = at.filter("kind = 'fixed'").select(columns), at.filter("kind = 'tables'").select(columns)
    samples = []
    for number in range(sweeps + 1):
        state = at.filter("kind = 'state'").select(columns)
        before, at = at, durable(
            fixed.unionByName(state).unionByName(answers).groupBy("part")
            .applyInPandas(sweep(number, root_all, root_tables, hot_c, hot_t), _SWEEP)
        )
        if before is not unchanged:
            discard(before)
        if number > burn:
            roots[number] = root_all, root_tables
            samples.append(durable(at.filter("kind = 'sample'").select("part", "data")))
        if number < sweeps:
            sums = {r["id"]: r["n"] for r in at.filter("kind = 'sum'").groupBy("id").agg(F.sum("n").alias("n")).collect()}
            new_root = strength + d0 * root_tables
            hot_c = np.array([sums.get(i, 0) for i in range(len(hot))], np.int64)
            hot_t = np.minimum(hot_c, 1)
            on = np.flatnonzero(hot_c > 1)
            rng = np.random.default_rng([seed, 1 << 31, number])
            hot_t[on] = seat(hot_c[on], np.full(len(on), new_root * base), d0, rng)
            root_all, root_tables = sums.get(-1, 0), sums.get(-2, 0) + int(hot_t.sum())
            answers = _exchanged(at.filter("kind = 'sent'").select("part", "shard", "data"))
            answers = answers.select(F.lit("tables").alias("kind"), "part", "shard", "data")
    discard(at)
    discard(unchanged)
    return samples, roots


def _scored(
    parts: DataFrame, totals: dict, hot: np.ndarray, seed: int, burn: int, samples: int, strength: float, shards: int
) -> DataFrame:
    ones, twos, tokens, vocabulary = totals.get(("all", 0), [0] * 4)
    root_ones, root_twos, _, _ = totals.get(("root", 0), [0] * 4)
    frequent = {k[1]: v for k, v in totals.items() if k[0] == "word"}
    vocabulary += sum(v[0] > 0 for v in frequent.values())
    d1, d0 = _discount(ones, twos), _discount(root_ones, root_twos)
    with shuffles_released(parts.sparkSession):
        restaurants = durable(_restaurants(parts, shards))
        kept, roots = _sampled(parts, restaurants, totals, hot, seed, burn + samples, burn, strength, d1, d0, vocabulary)
    known_ = restaurants.select("part", "shard", "data")
    for x in kept:
        known_ = known_.unionByName(x.select("part", F.lit(-1).alias("shard"), "data"))

    def predictions(w, sizes, at, c, known: pd.DataFrame):
        """Averaged probability of each pair, training count of each word."""
        word = np.repeat(np.arange(len(w)), sizes)
        count = np.bincount(word, weights=c, minlength=len(w))
        for i in np.flatnonzero(np.isin(w, hot)).tolist():
            count[i] = frequent[int(w[i]) - (1 << 63)][0]
        customers, tables, live = _received(known[known["shard"] >= 0], 3)
        t, on = (c > 0).astype(float), c > 1
        total = np.zeros(len(c))
        # the samples are added in one order, so that sums do not move
        for number, *sample in sorted((load(d) for d in known["data"][known["shard"] < 0]), key=lambda x: x[0][0]):
            t[on], tables[live], root_c, root_t = sample
            p = _root(root_c, root_t, *roots[int(number[0])], strength, d0, 1 / (vocabulary + 1))
            total += (np.maximum(c - d1 * t, 0) + (strength + d1 * tables[at]) * p[word]) / (strength + customers[at])
        return total / samples, count, word

    def work(key, rows_: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = []
        for pairs, entries in zip(rows_["pairs"], rows_["entries"]):
            w, sizes, _, at, c = load(pairs)
            p, count, word = predictions(_numbers(w), sizes, at, c, known)
            score = np.log10(p)
            plain = np.log10((count + 1) / (tokens + vocabulary + 1))[word]
            seen, at = count[word] > 0, 0
            while at < len(entries):
                (size,) = struct.unpack_from("<Q", entries, at)
                pair, own, doc, n, rows, ids, with_id, train = load(entries[at + 8 : at + 8 + size])
                at += 8 + size
                pair = np.repeat(np.cumsum(pair.astype(np.int64)), own)
                total = lambda x: np.bincount(doc, weights=n * x, minlength=len(rows))  # noqa: B023, E731
                data = dump(
                    rows, ids, with_id, train, total(np.ones(len(pair))).astype(np.uint32),
                    total(seen[pair]).astype(np.uint32), total(plain[pair]), total(score[pair]),
                )
                out.append((rows[0], data))
        return pd.DataFrame(out, columns=["block", "data"])

    def added(sent: pd.DataFrame) -> pd.DataFrame:
        parts_ = [load(d) for d in sent["data"]]
        rows, ids, with_id, train = parts_[0][:4]
        found, known, plain, score = (np.sum([x[i] for x in parts_], axis=0) for i in range(4, 8))
        return pd.DataFrame(
            {
                "doc_id": pd.Series(np.cumsum(ids), dtype="Int64").where(pd.Series(with_id)), "held_out": ~train,
                "n_tokens": found.astype(np.int64), "n_known": known.astype(np.int64), "train_tokens": tokens,
                "base_score": plain, "score": score, "perplexity": 10 ** (-score / found),
            }
        )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, perplexity double"
    )
    # a block is named by its first row
    sent = parts.groupBy("part").cogroup(known_.groupBy("part")).applyInPandas(work, "block long, data binary")
    return sent.groupBy("block").applyInPandas(added, schema)


def _frequent_words(keyed: DataFrame, chars: int, parts: int, sample_chars: int) -> np.ndarray:
    """Hashes of words that make up a large share of a part, by a sample of texts; used for placement only."""
    if parts == 1:
        return np.empty(0, np.uint64)
    every = max(1, chars // sample_chars)
    sample = keyed.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch["text"]:
                own = words_of(t)
                counts.update(own)
                counts[b"\n"] += 1
        total = sum(counts.values())
        common = [(xxhash.xxh3_64_intdigest(w) - (1 << 63), n) for w, n in counts.items() if n * 16 * parts >= total]
        yield pd.DataFrame([*common, (None, total)], columns=["w", "n"]).astype({"w": "Int64"})

    sums = {r["w"]: r["n"] for r in sample.mapInPandas(work, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()}
    total = sums.pop(None, 0)
    return np.array([w + (1 << 63) for w, n in sums.items() if n * 4 * parts >= total], np.uint64)


def score_texts(
    docs: DataFrame, modulus: int = 7, held: int = 2, seed: int = 23, burn: int = 2, samples: int = 4,
    strength: float = 1.0, sample_chars: int = 5_000_000, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row.

    Rows whose key's remainder is not `held` are learned from; all are scored.

    burn, samples  Gibbs sweeps before and while predictions are averaged
    strength       of all restaurants; discounts follow from the counts of counts
    sample_chars   size of the sample that finds words to be split over tasks

    score is the log10 probability of the text with its end. A missing text is
    empty: it is its end. Repeated rows count and are scored each. Without rows to
    learn from every word is unknown; an empty table gives no rows. Further
    columns are not read.
    """
    keyed = keyed_text(docs, key, text).withColumn("row", F.monotonically_increasing_id())
    chars = keyed.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    # by the texts alone, so that scores are the same on any number of cores
    parts = max(_PARTS, -(-chars // _PART_CHARS))
    hot = _frequent_words(keyed, chars, parts, sample_chars)
    with shuffles_released(docs.sparkSession):
        merged = durable(_merged(_counted(keyed, hot, parts, modulus, held)))
        totals = _totals(merged, hot)
    return _scored(merged, totals, hot, seed, burn, samples, strength, parts)
