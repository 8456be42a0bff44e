"""Spelling variants: words one edit apart, found by FM-index search schemes.

Words are the maximal runs of `[A-Za-z\\u00C0-\\u00FF]` with A-Z lower-cased.
An occurrence whose key `crc32("<doc_id>:<run>")` is divisible by 199 loses its
code point at `key % length` (a missing doc_id is the empty text). Distinct
results of at least 6 code points and 5 occurrences are the vocabulary.

Two words are near when one insertion, deletion or substitution of a code point
turns one into the other. If the edit lies in the right half of a word of length
L, the left half (L // 2 >= 3 code points) occurs unchanged at the start of its
near word; if it lies in the left half, the right half occurs unchanged at its
end. So the vocabulary is indexed twice, in shards of equal first three code
points and of equal last three code points, and a word searches the two
shards of its keys:

* in a shard of last letters, an FM-index of the delimited words
  (`#w1#w2#...#`) matches `#` and the right half exactly by backward search,
  then extends to the left across the left half allowing one edit, then `#`;
* in a shard of first letters, the same search runs on the reversed words, so
  the left half is matched exactly and the extension crosses the right half.

Together the two orientations form the bidirectional index, and the two
schemes find every pair at distance one. Only code points present in the
current suffix-array interval are tried as substitutes or insertions, so the
search visits intervals, not the alphabet. A shard of more than
`patterns_per_task` words is split by the hash of the searching word, with the
shard's index sent to each part; a shard never holds more than its own words.

A word's form is its near word of largest n (ties: least in code-point order)
when that n is at least 5 times its own; roots follow forms to their end by
pointer doubling, a fixed number of joins: n grows fivefold along a chain, so a
chain is shorter than log5 of all occurrences < 64.

Defined results: missing texts have no runs; texts without letters, empty
tables and words without near words give no rows or null forms; repeated rows
count every occurrence; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.lineage import durable

# fixed values of the contract
RUN = "([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIVISOR, LEAST_CHARS, LEAST_COUNT, FORM_FACTOR = 199, 6, 5, 5

_SEP = 0


def _suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; `s` ends with a unique least symbol."""
    n = len(s)
    rank = s.astype(np.int64)
    k = 1
    while True:
        second = np.full(n, -1, np.int64)
        second[: n - k] = rank[k:] if k < n else second[:0]
        order = np.lexsort((second, rank))
        a, b = rank[order], second[order]
        change = np.empty(n, bool)
        change[0] = True
        change[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(change) - 1
        rank = new
        if rank.max() == n - 1 or k >= n:
            return order
        k *= 2


class FMIndex:
    """FM-index of `#w1#w2#...#` over the code points of the words, with locate.

    The rank of a symbol before a place is a binary search in the sorted places
    of that symbol in the BWT, so the index holds one number per text place.
    """

    def __init__(self, words: list[str]) -> None:
        symbols = sorted({c for w in words for c in w})
        self.code = {c: i + 1 for i, c in enumerate(symbols)}
        self.sigma = len(symbols) + 1
        text, starts = [_SEP], []
        for w in words:
            starts.append(len(text) - 1)  # place of the '#' before the word
            text.extend(self.code[c] for c in w)
            text.append(_SEP)
        t = np.array(text + [-1], np.int64)  # a sentinel less than '#'
        sa = _suffix_array(t)
        self.sa = sa
        self.bwt = np.where(sa > 0, t[sa - 1], -1)
        self.n = len(t)
        counts = np.bincount(t[t >= 0], minlength=self.sigma)
        self.first = (np.concatenate([[1], 1 + np.cumsum(counts)[:-1]])).tolist()  # the sentinel sorts first
        order = np.argsort(self.bwt, kind="stable")
        bounds = np.searchsorted(self.bwt[order], np.arange(self.sigma + 1))
        # places[c]: sorted places of symbol c in the BWT; a rank is a binary search in it
        self.places = [order[bounds[c] : bounds[c + 1]].tolist() for c in range(self.sigma)]
        self.symbols = self.bwt.tolist()
        self.starts = np.array(starts, np.int64)
        self.words = words

    def rank(self, c: int, i: int) -> int:
        """Count of symbol c in bwt[:i]."""
        return bisect_left(self.places[c], i)

    def extend(self, lo: int, hi: int, c: int) -> tuple[int, int]:
        f = self.first[c]
        return f + bisect_left(self.places[c], lo), f + bisect_left(self.places[c], hi)

    def present(self, lo: int, hi: int) -> list[int]:
        """Symbols other than '#' in bwt[lo:hi]."""
        if hi - lo <= 2 * self.sigma:
            return sorted({c for c in self.symbols[lo:hi] if c > 0})
        return [c for c in range(1, self.sigma) if self.rank(c, hi) > self.rank(c, lo)]

    def word_at(self, lo: int) -> str:
        return self.words[int(np.searchsorted(self.starts, self.sa[lo]))]

    def near(self, pattern: str, cut: int) -> set[str]:
        """Words one edit from `pattern` whose part pattern[cut:] is unchanged at their end."""
        code = self.code
        if any(c not in code for c in pattern[cut:]):
            return set()
        lo, hi = self.extend(0, self.n, _SEP)
        for c in reversed(pattern[cut:]):
            lo, hi = self.extend(lo, hi, code[c])
            if lo >= hi:
                return set()
        found: set[str] = set()
        wanted = [code.get(c, -1) for c in pattern[:cut]]
        for i in range(cut, -1, -1):
            # the edit comes after the exact match of pattern[i:], at place i
            self._edit(lo, hi, wanted, i, found)
            if i == 0:
                break
            c0 = wanted[i - 1]
            if c0 <= 0:
                break
            lo, hi = self.extend(lo, hi, c0)
            if lo >= hi:
                break
        found.discard(pattern)
        return found

    def _edit(self, lo: int, hi: int, wanted: list[int], i: int, found: set[str]) -> None:
        """One edit at place i of the rest pattern[:i], then an exact match and '#'."""
        present = self.present(lo, hi)
        if i > 0:
            self._exact(lo, hi, wanted, i - 1, found)  # the word lacks pattern[i - 1]
        for c in present:
            a, b = self.extend(lo, hi, c)
            if i > 0 and c != wanted[i - 1]:
                self._exact(a, b, wanted, i - 1, found)  # substitution
            self._exact(a, b, wanted, i, found)  # the word has c more

    def _exact(self, lo: int, hi: int, wanted: list[int], i: int, found: set[str]) -> None:
        """Match pattern[:i] exactly to the left, then '#'."""
        for j in range(i - 1, -1, -1):
            c = wanted[j]
            if c <= 0:
                return
            places, f = self.places[c], self.first[c]
            lo, hi = f + bisect_left(places, lo), f + bisect_left(places, hi)
            if lo >= hi:
                return
        a, b = self.extend(lo, hi, _SEP)
        if a < b:
            found.add(self.word_at(a))


def _shard_search(rows: pd.DataFrame) -> pd.DataFrame:
    """Near pairs of one shard: all its words are indexed, those marked search."""
    reverse = bool(rows.reverse.iloc[0])
    words = sorted(set(rows.word))
    fm = FMIndex([w[::-1] for w in words] if reverse else words)
    out_w, out_v = [], []
    for w in rows.word[rows.search]:
        length = len(w)
        if reverse:
            hits = {v[::-1] for v in fm.near(w[::-1], length - length // 2)}
        else:
            hits = fm.near(w, length // 2)
        out_w.extend([w] * len(hits))
        out_v.extend(sorted(hits))
    return pd.DataFrame({"word": pd.Series(out_w, dtype=object), "near": pd.Series(out_v, dtype=object)})


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): occurrences after the keyed deletion, words of 6 code points and 5 occurrences or more."""
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"),
        F.explode(F.regexp_extract_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(RUN), F.lit(1))).alias("run"),
    )
    low = F.translate("run", UPPER, LOWER)
    runs = runs.select(low.alias("run"), F.crc32(F.encode(F.concat("k", F.lit(":"), low), "UTF-8")).alias("h"))
    cut = F.expr(f"concat(substring(run, 1, CAST(h % char_length(run) AS INT)), substring(run, CAST(h % char_length(run) AS INT) + 2))")
    word = F.when(F.col("h") % DIVISOR == 0, cut).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.char_length("word") >= LEAST_CHARS) & (F.col("n") >= LEAST_COUNT))


def near_pairs(words: DataFrame, patterns_per_task: int = 20_000) -> DataFrame:
    """(word, near): every ordered pair of vocabulary words one edit apart."""
    index = words.select("word", F.lit(True).alias("reverse"), F.substring("word", 1, 3).alias("key")).unionByName(
        words.select("word", F.lit(False).alias("reverse"), F.expr("substring(word, -3, 3)").alias("key"))
    )
    shard = ["reverse", "key"]
    parts = (
        index.groupBy(*shard).agg(F.count(F.lit(1)).alias("m"))
        .select(*shard, F.ceil(F.col("m") / patterns_per_task).cast("int").alias("parts"))
    )
    spread = index.join(parts, shard).select(
        *shard, "word",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("own"),
    )
    spread = spread.select(*shard, "part", "word", (F.col("part") == F.col("own")).alias("search"))
    found = spread.groupBy(*shard, "part").applyInPandas(_shard_search, "word string, near string")
    return found.distinct()


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", patterns_per_task: int = 20_000) -> DataFrame:
    """word, form, root, n, n_near, form_n for every vocabulary word (see the module text)."""
    words = durable(vocabulary(docs, key, text))
    pairs = near_pairs(words, patterns_per_task)
    scored = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = scored.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near").alias("near"))).alias("top"),
    )
    forms = durable(
        words.join(best, "word", "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("top.neg") >= FORM_FACTOR * F.col("n"), F.col("top.near")).alias("form"),
            F.when(-F.col("top.neg") >= FORM_FACTOR * F.col("n"), -F.col("top.neg")).cast("long").alias("form_n"),
        )
    )
    pointer = forms.select("word", F.coalesce("form", "word").alias("to"))
    for _ in range(6):  # 2**6 steps: longer than any chain
        pointer = durable(pointer.alias("a").join(pointer.alias("b"), F.col("a.to") == F.col("b.word")).select(
            F.col("a.word").alias("word"), F.col("b.to").alias("to")
        ))
    return forms.join(pointer.withColumnRenamed("to", "root"), "word").select(
        "word", "form", "root", F.col("n").cast("long").alias("n"), "n_near", "form_n"
    )
