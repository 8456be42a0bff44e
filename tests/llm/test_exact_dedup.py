"""Exact deduplication by Patricia-trie owners: brute force, edge rows, the trie itself."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from panelweave.llm.exact_dedup import PatriciaTrie, exact_duplicates


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]", "", t or "") for i, (_, t) in enumerate(rows)}
    out = []
    for i, (doc_id, text) in enumerate(rows):
        group = [j for j in norm if norm[j] == norm[i]]
        best = min(group, key=lambda j: (-len(rows[j][1] or ""), rows[j][0] is None, rows[j][0] or 0))
        keep = rows[best][0]
        out.append((doc_id, keep, len(group), doc_id == keep, hashlib.sha256(norm[i].encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, parts=3, extra=None):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    if extra:
        df = df.withColumns({c: F.lit("x") for c in extra})
    got = exact_duplicates(df).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str), df


def test_against_brute_force(spark):
    rng = random.Random(7)
    base = ["alpha beta", "alpha  beta\n", "alphabet a", "gamma", "", "é t é", "ét é", "x" * 5000]
    rows = [(i % 250, rng.choice(base) + " " * rng.randint(0, 2) if rng.random() > 0.1 else None) for i in range(300)]
    got, _ = run(spark, rows, parts=5)
    assert sorted(got, key=str) == brute(rows)


def test_edge_rows(spark):
    long = "word " * 40000
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (None, "ab  "), (3, None), (4, ""), (5, long), (6, long.replace(" ", "\n")),
            (None, "only missing"), (7, "tie"), (8, "tie")]
    got, _ = run(spark, rows, extra=["keep_id", "nlen", "h", "norm", "copies", "text_sha256"])
    assert sorted(got, key=str) == brute(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r[0], []).append(r)
    assert by_id[None][0][1] in (None, 2)
    only = [r for r in got if r[4] == hashlib.sha256(b"onlymissing").hexdigest()][0]
    assert only[1] is None and only[3] is True  # a missing id owns its own group
    assert [r[1] for r in by_id[7]] == [7] and by_id[8][0][3] is False  # ties: least doc_id
    assert by_id[3][0][1] == 3 and by_id[4][0][2] == 2  # empty and missing are one group, least id


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_duplicates(df).count() == 0


def test_trie_splits_and_orders():
    trie = PatriciaTrie()
    words = [b"abc", b"abd", b"ab", b"", b"abc", b"b" * 1000, b"b" * 999 + b"c"]
    for i, w in enumerate(words):
        trie.insert(w, (0, i))
    found = [(s, n.copies, n.owner[1]) for s, n in trie.terminals_in_order()]
    assert [s for s, _, _ in found] == sorted(set(words))
    assert dict((s, c) for s, c, _ in found)[b"abc"] == 2
    assert dict((s, o) for s, _, o in found)[b"abc"] == 0
    assert trie.terminals == len(set(words))
