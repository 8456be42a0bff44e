"""Fingerprints of texts by a homomorphic multiset hash of their paragraphs.

Each paragraph is hashed to a wide vector; a text's fingerprint is the sum of
its paragraphs' vectors, lane by lane modulo a power of two. Equal multisets of
paragraphs have equal fingerprints in whatever order, and paragraphs can be
inserted or deleted by adding or subtracting their vectors (`combine`).

The vector has two parts. Wide lanes (20 bits, three to a long) carry equality.
Narrow lanes (30 bits, two to a long, more than any text has sentences) add one
random bit for each sentence of the paragraph, and for each run of SHINGLE words of a
sentence of more than LONG words, so that long texts without sentence ends are
compared too; the number of both is a lane of its own. From these sums the likeness
of two texts follows without the texts: the counts, centred by half that number, are
random signs whose cosine estimates the overlap.

Only SQL functions are used. A row's fingerprint is computed inside the row, so
nothing is shuffled for it; lanes are packed so that one addition of longs adds
two or three lanes, with guard bits against carries. The bits of sentences and shingles
are counted eight to a long, in runs of at most 127 hashes, before they meet the lanes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.lineage import durable
from panelweave.llm.texts import keyed_text
from panelweave.operators.ordering import with_row_index

WIDE = 22  # longs of three 20-bit lanes
_WIDE_MASK = sum(((1 << 20) - 1) << s for s in (0, 21, 42))
_SIGNS = 2  # hashes of a sentence; each gives 30 longs of two lanes
_PLACES = (0, 31)
_NARROW_MASK = sum(((1 << 30) - 1) << s for s in _PLACES)
NARROW = 30 * _SIGNS
LANES = 2 * NARROW
LONG = 32  # words of a sentence above which its shingles are hashed beside it
SHINGLE = 4
_RUN = 127  # hashes whose bits are counted in bytes; more could overflow the topmost
_BYTES = 0x0101010101010101


def _sum(items: Column, width: int, mask: int, lane) -> Column:
    """Sum over items of the vector lane(item, 0), lane(item, 1) ... modulo the lanes' powers."""
    zero, places = F.array_repeat(F.lit(0).cast("long"), width), F.sequence(F.lit(0), F.lit(width - 1))
    add = lambda total, item: F.zip_with(
        total, places, lambda x, i: (x + lane(item, i)).bitwiseAND(F.lit(mask))
    )
    return F.aggregate(items, zero, add)


def _with(value: Column, body) -> Column:
    """body(value), the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _bit_counts(hashes: Column) -> Column:
    """For j from 0 to 29: how many of the hashes have bit j, and bit j + 31 at bit 31; modulo the lanes' powers."""

    def shifted(x: Column, by) -> Column:
        return F.call_function("shiftrightunsigned", x, by if isinstance(by, Column) else F.lit(by))

    def in_bytes(run: Column) -> Column:
        """Byte i of the r-th long counts bit 8 * i + r."""
        return F.array(*[
            F.aggregate(run, F.lit(0).cast("long"), lambda s, h: s + shifted(h, r).bitwiseAND(F.lit(_BYTES)))  # noqa: B023
            for r in range(8)
        ])

    def count(counted: Column, bit: Column) -> Column:
        word = F.element_at(counted, bit.bitwiseAND(F.lit(7)) + 1)
        return shifted(word, bit.bitwiseAND(F.lit(56))).bitwiseAND(F.lit(255))

    runs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(hashes) / _RUN).cast("int")),
        lambda i: in_bytes(F.slice(hashes, i * _RUN + 1, F.lit(_RUN))),
    )
    return _sum(
        runs, 30, _NARROW_MASK,
        lambda counted, j: count(counted, j) + F.shiftleft(count(counted, j + _PLACES[1]), _PLACES[1]),
    )


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n")


def sentences(text: Column) -> Column:
    """Sentences of all paragraphs; a sentence ends after ., ! or ? before a blank, or with its paragraph."""
    return F.filter(F.split(text, r"(?<=[.!?]) +|\n"), lambda s: s != "")


def likeness_items(text: Column) -> Column:
    """Hashes of the sentences, and of the shingles of long sentences."""

    def runs(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(words) - SHINGLE + 1)
        found = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, F.lit(SHINGLE))))
        return F.when(F.size(words) > LONG, found).otherwise(F.array().cast("array<bigint>"))

    def of(found: Column) -> Column:
        words = F.transform(found, lambda s: F.split(s, r"\s+"))  # bound once for all runs of a sentence
        return F.concat(F.transform(found, lambda s: F.xxhash64(s)), F.flatten(F.transform(words, runs)))

    return _with(sentences(text), of)


def fingerprint(text: Column) -> Column:
    """Array of longs: the wide lanes, the narrow lanes, the number of sentences and shingles.

    A missing text has the fingerprint of the empty text.
    """
    text = F.coalesce(text, F.lit(""))
    wide = _sum(
        F.transform(paragraphs(text), lambda p: F.sha2(p, 256)), WIDE, _WIDE_MASK,
        lambda p, i: F.xxhash64(p, i).bitwiseAND(F.lit(_WIDE_MASK)),
    )

    def narrow(items: Column) -> Column:
        counts = [_with(F.transform(items, lambda s: F.xxhash64(s, F.lit(k))), _bit_counts) for k in range(_SIGNS)]  # noqa: B023
        return F.concat(*counts, F.array(F.size(items).cast("long")))

    return F.concat(wide, _with(likeness_items(text), narrow))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint after inserting (sign 1) or deleting (sign -1) the paragraphs that make up `b`."""

    def part(begin: int, width: int, mask: int) -> Column:
        x, y = F.slice(a, begin, width), F.slice(b, begin, width)
        if sign > 0:
            return F.zip_with(x, y, lambda p, q: (p + q).bitwiseAND(F.lit(mask)))
        guard = mask << 1 & ~mask  # one bit above each lane, against borrows
        return F.zip_with(x, y, lambda p, q: (p.bitwiseOR(F.lit(guard)) - q).bitwiseAND(F.lit(mask)))

    count = F.element_at(a, -1) + sign * F.element_at(b, -1)
    return F.concat(
        part(1, WIDE, _WIDE_MASK), part(WIDE + 1, NARROW, _NARROW_MASK), F.array(count)
    )


def _signed(f: Column) -> Column:
    """Centred counts of the narrow lanes: 2*count - number of items."""
    n = F.element_at(f, -1)
    return F.flatten(
        F.transform(
            F.slice(f, WIDE + 1, NARROW),
            lambda x: F.transform(
                F.array(*[F.shiftright(x, s) for s in _PLACES]),
                lambda v: (v.bitwiseAND(F.lit((1 << 30) - 1)) * 2 - n).cast("double"),
            ),
        )
    )


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def with_likeness(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add columns with the likeness of two fingerprint columns: name -> (first, second).

    0 to 1: share of common sentences and shingles estimated from two fingerprints; 1 only for
    equal ones. Texts without sentences are like nothing but themselves, and a
    long text without blanks is one item. Each vector is centred once for all its
    pairs.
    """
    used = sorted({c for pair in pairs.values() for c in pair})
    df = df.withColumns({f"_s_{c}": _signed(F.col(c)) for c in used})
    df = df.withColumns({f"_n_{c}": _dot(F.col(f"_s_{c}"), F.col(f"_s_{c}")) for c in used})
    out = {}
    for name, (a, b) in pairs.items():
        norm = F.sqrt(F.col(f"_n_{a}") * F.col(f"_n_{b}"))
        cosine = F.when(norm > 0, _dot(F.col(f"_s_{a}"), F.col(f"_s_{b}")) / norm).otherwise(F.lit(0.0))
        out[name] = F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(
            F.greatest(F.lit(0.0), F.least(F.lit(0.999999), cosine))
        )
    return df.withColumns(out).drop(*[f"_{k}_{c}" for k in "sn" for c in used])


def as_text(f: Column) -> Column:
    """Fixed-width hexadecimal text of a fingerprint."""
    return F.array_join(F.transform(f, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def edit_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has the last floor(n_chars/2) code points replaced by the
    first as many of the next document's text, by descending doc_id (after the
    last: the first; a missing key comes last). Rows with the same doc_id are
    versions of one document: they share the next document, and of its versions
    the one with the least text hash counts. A single document is its own next.
    A missing text is empty; an empty table gives no rows.

    Only the distinct keys are put in order, by a range sort without a
    single-task window. Texts are shuffled once by their key; each then sends the
    document before it no more than the code points that document replaces.
    """
    least = -(1 << 63)
    rows = keyed_text(docs, key, text).select(F.coalesce("doc_id", F.lit(least)).alias("k"), "text")
    n = F.length("text")
    ids = rows.groupBy("k").agg(F.max(F.floor(n / 2)).cast("int").alias("need"))
    placed = durable(with_row_index(ids, [F.col("k").desc()], "at"))
    total = placed.agg(F.count(F.lit(1)).alias("total"))  # one row
    after = placed.crossJoin(F.broadcast(total)).select(
        F.pmod(F.col("at") + 1, "total").alias("at"), F.col("k").alias("before"), "need"
    )
    links = placed.select("k", "at").join(after, "at").select("k", "before", "need")
    heads = (
        rows.join(links, "k")
        .select(
            F.col("before").alias("k"),
            F.struct(
                F.xxhash64("text").alias("h"),
                F.substring(F.col("text"), F.lit(1), F.col("need")).alias("head"),
                fingerprint(F.col("text")).alias("x"),
            ).alias("next"),
        )
        .groupBy("k").agg(F.min("next").alias("next"))
    )
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.head"), F.lit(1), half)
    )
    prints = (
        rows.join(heads, "k")
        .select("k", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), F.col("next.x").alias("x"))
        .select(
            F.when(F.col("k") != least, F.col("k")).alias("doc_id"), "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            fingerprint(F.col("text")).alias("f"), fingerprint(F.col("edited")).alias("e"), "x",
        )
    )
    return with_likeness(prints, {"near_edited": ("f", "e"), "near_next": ("f", "x")}).select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"), "near_edited", "near_next",
    )
