"""Spelling variants by FM-index search schemes against brute force; edge rows."""

import random

from pyspark.sql import functions as F

from brute_variants import one_edit, variants
from panelweave.llm.spelling_variants import FMIndex, spelling_variants


def test_index_finds_every_word_one_edit_away():
    rng = random.Random(3)
    alphabet = "abcdeé"
    words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(5, 9))) for _ in range(600)})
    fm, rev = FMIndex(words), FMIndex([w[::-1] for w in words])
    for w in words[:200] + ["abcdeab", "éééééé"]:
        got = fm.near(w, len(w) // 2) | {v[::-1] for v in rev.near(w[::-1], len(w) - len(w) // 2)}
        assert got == {v for v in words if one_edit(w, v)}, w


def rows_for(spark, rows, extra=()):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit("x") for c in extra})


def check(spark, rows, extra=()):
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(rows_for(spark, rows, extra), patterns_per_task=7).collect()}
    assert got == variants(rows)
    return got


def test_planted_variants_and_edges(spark):
    rows = [(i, "colour colour colour colour colour") for i in range(10)]  # n large: a form
    rows += [(100 + i, "Colour; colours: colur. Ëcolour") for i in range(5)]
    rows += [(200, None), (201, ""), (202, "1234 !!"), (None, "colour colour colour colour colour"), (203, "x" * 30000)]
    rows += [(300, "abcdefgh abcdefgx abcdefgy abcdefgz abcdefgh") for _ in range(6)]  # ties of n
    rows += [(400, "tablex tabley tablez tablew tablev")] * 5
    got = check(spark, rows, extra=("word", "near", "role", "part", "to", "n", "key", "len", "reverse"))
    assert got["colours"][:2] == ("colour", "colour") and got["colours"][4] == got["colour"][2]
    assert got["colour"][0] is None and got["colour"][1] == "colour"


def test_chains_and_random_corpus(spark):
    rng = random.Random(11)
    base = ["balance", "ballance", "balanse", "ballanse", "particular", "particuler", "partikuler", "stationery", "stationary"]
    rows = [(i, " ".join(rng.choice(base[: rng.randint(1, len(base))]) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(df).count() == 0
