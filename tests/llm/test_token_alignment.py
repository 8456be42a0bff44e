"""Cross-tokenizer alignment against brute force; the perfect hash; edge rows."""

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from brute_alignment import alignment
from panelweave.llm.token_alignment import PerfectHash, Vocabularies, align_tokenizers

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(-(2**62), 2**62, 20_000))
    mph = PerfectHash(keys)
    slots = mph.slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    assert np.array_equal(mph.verified_slots(keys[::7]), slots[::7])
    try:
        mph.verified_slots(np.array([12345678901], np.int64))
        assert 12345678901 in set(keys.tolist())
    except ValueError:
        pass
    assert PerfectHash(np.empty(0, np.int64)).m == 0


def test_key_bound_holds_for_the_vocabularies():
    v = Vocabularies(A, B)
    assert 50_000 < v.key_bound() < 2_000_000


def test_against_brute_force_with_edges(spark):
    long = "The quick brown fox, naïve café — 数字 1234 <|endoftext|> <s> </s>\n\tend. " * 800
    rows = [
        (1, "Hello  world\n\nnew line"), (1, "Hello  world\n\nnew line"), (2, None), (3, ""), (None, "no key at all"),
        (4, long), (5, "   "), (6, "tab\tand\rcarriage"), (7, "ﬁ ligature ①"), (8, "emoji 🙂 and ZWJ 👩‍👩‍👧"),
    ] + [(10 + i, f"word{i} and the same words again, the same words") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df = df.withColumns({c: F.lit("x") for c in ("links", "counts", "n_a", "key", "groups_sha256")})
    got = align_tokenizers(df, A, B).collect()
    assert len(got) == len(rows)
    expected = alignment(rows)
    for r in got:
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == expected[r.doc_id], r.doc_id
    zeros = [r for r in got if r.doc_id in (2, 3)]
    assert all(r.n_a == 0 and r.groups_sha256 == "" for r in zeros)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokenizers(df, A, B).count() == 0


def test_each_key_is_displaced_by_its_own_seed():
    """One pass over the keys, however many seeds the hash has: as for each key alone."""
    import numpy as np

    from panelweave.llm import token_alignment as ta

    keys = np.random.default_rng(3).integers(0, 1 << 47, 4000)
    table, calls, mix = ta.PerfectHash(keys), [], ta._mix
    ta._mix = lambda x, seed: calls.append(len(x)) or mix(x, seed)
    try:
        slots = table.verified_slots(np.unique(keys))
    finally:
        ta._mix = mix
    assert len(calls) == 2 and sorted(slots.tolist()) == list(range(table.m))


def test_groups_text_by_places():
    """Special strings, odd blanks and long runs; encoded by chunks and as a whole."""
    import numpy as np
    import public_tokenizers

    from panelweave.llm import token_alignment as ta

    path = public_tokenizers.path
    v = ta.Vocabularies(path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), path("byte_bpe_50k.tiktoken"))
    specials = "".join(v.stream.special)
    for text in ("a", "Hello world, hello", "x  y\tz\n\nü 漢字", f"one {specials} two", "<|endoftext|>", "é" * 50):
        ids_b = v.b.encode(text)
        whole = v.a.encode(" " + text, add_special_tokens=False).ids
        assert np.frombuffer(v.stream.encode([" " + text])[0], "<u4").tolist() == whole
        n_a, n_b, n_groups, _, written, _ = ta.align(v, text, np.array(whole), ids_b)
        if n_a:
            sides = [[side.split(",") for side in group.split("|")] for group in written.split(";")]
            assert [int(i) for a, _ in sides for i in a] == whole and [int(i) for _, b in sides for i in b] == ids_b
            assert len(sides) == n_groups
