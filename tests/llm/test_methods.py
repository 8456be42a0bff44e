"""Corpus operators against brute force, exact distributions and round trips."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from panelweave.llm import (
    components, html_main, language_id, multiset_hash, near_duplicates, packed, packing, personal_data, piece_codec,
    pitman_yor, quality, ranked_search,
)

PATH = public_tokenizers.path
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_packed_columns():
    columns = [np.arange(5), np.array([], np.uint16), np.array([True, False]), np.array([1.5])]
    again = packed.load(packed.dump(*columns))
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(columns, again, strict=True))
    assert len(packed.load(packed.dump(*columns), 2)) == 2


def test_tables_follow_the_exact_distribution():
    def exact(c, a, d):
        ways = {(0, 0): 1.0}
        for _ in range(c):
            new = Counter()
            for (m, t), v in ways.items():
                new[m + 1, t + 1] += v
                if t:
                    new[m + 1, t] += v * (m - d * t)
            ways = new
        p = np.array([ways[c, t] * a**t for t in range(1, c + 1)])
        return p / p.sum()

    rng = np.random.default_rng(1)
    for c, a, d in ((2, 0.5, 0.7), (12, 1.3, 0.6), (90, 5.0, 0.8), (140, 0.3, 0.7), (140, 4.0, 0.8)):
        t = pitman_yor.seat(np.full(20_000, c), np.full(20_000, a), d, rng)
        assert 0.5 * np.abs(np.bincount(t, minlength=c + 1)[1:] / 20_000 - exact(c, a, d)).sum() < 0.03
    assert pitman_yor.seat(np.array([10**6]), np.array([1e-3]), 0.8, rng).tolist() == [1]


@pytest.mark.parametrize("part_chars", [10**9, 60_000])
def test_scores_of_a_language_model(docs, texts, monkeypatch, part_chars):
    monkeypatch.setattr(pitman_yor, "_PART_CHARS", part_chars)
    out = pitman_yor.score_texts(docs).toPandas().set_index("doc_id")
    word, fold = re.compile(r"[^\x20\x09-\x0D]+"), str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    tokens = {i: [*word.findall(t.translate(fold)), "\n"] for i, t in texts.items()}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for i in train for w in tokens[i])
    n, v = sum(c.values()), len(c)
    assert set(out.train_tokens) == {n} and len(out) == len(texts)
    for i, own in tokens.items():
        row = out.loc[i]
        assert (row.n_tokens, row.n_known) == (len(own), sum(c[w] > 0 for w in own))
        assert row.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own))
    held = out[out.held_out]
    assert held.score.sum() > held.base_score.sum() and (out.score < 0).all()


def test_unknown_words_are_less_likely(spark):
    train = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    known = ["a", "b", "c", "d"]
    rows = [(i, ["a b a", "b c", "c a a a", "d", *known][k % 8]) for k, i in enumerate(train)]
    rows += list(zip(held, [*known, "unknown"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r.text: r.score for r in pitman_yor.score_texts(df).join(df, "doc_id").filter("held_out").collect()}
    assert score["unknown"] < min(score[w] for w in known) and sum(10 ** score[w] for w in known) < 1


def test_contexts_have_restaurants_of_their_own(spark):
    import xxhash

    seen: dict[int, str] = {}
    for i in range(10_000):  # two words whose hashes agree in their last twelve bits
        low = xxhash.xxh3_64_intdigest(f"w{i}".encode()) % 4096
        if low in seen:
            break
        seen[low] = f"w{i}"
    a, b = seen[low], f"w{i}"
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = [(i, (f"{a} x", f"{b} y")[k % 2]) for k, i in enumerate(train)] + list(zip(held, [f"{a} x", f"{a} y", f"{b} x", f"{b} y"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = pitman_yor.score_texts(df).join(df, "doc_id").filter("held_out").collect()
    score = {r.text: r.score for r in out}
    assert score[f"{a} x"] > score[f"{a} y"] + 1.5 and score[f"{b} y"] > score[f"{b} x"] + 1.5


def test_a_language_model_deletes_what_no_later_step_reads(spark):
    import os
    from urllib.parse import urlparse

    from panelweave import lineage

    folder = urlparse(lineage.scratch_folder(spark)).path
    df = spark.createDataFrame([(i, f"a b{i % 7} c a b{i % 5}") for i in range(60)], "doc_id long, text string")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert pitman_yor.score_texts(df, burn=2, samples=3).count() == 60
    left = set(os.listdir(folder)) - before
    assert len(left) == 2 + 3  # pairs with their entries, restaurants, and one table for each sample
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_ascending_numbers_are_sent_as_gaps():
    for x in (np.array([3, 9, 2**64 - 1], np.uint64), np.array([0, 0, 5], np.uint32), np.empty(0, np.uint64)):
        gaps = pitman_yor._gaps(x)
        assert gaps.dtype == x.dtype and pitman_yor._numbers(gaps).tolist() == x.tolist()


def test_base_spans_are_the_patterns():
    rng = random.Random(1)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card = re.compile(r"[0-9]([\x20-]?[0-9])+")
    for _ in range(2000):
        s = "".join(rng.choice("12.@a- +") for _ in range(40))
        assert [m.span() for m in email.finditer(s)] == list(personal_data._emails(s))
        assert [m.span() for m in ip.finditer(s)] == [m.span() for m in personal_data._IP.finditer(s)]
        assert [m.span() for m in card.finditer(s)] == [m.span() for m in personal_data._CARD.finditer(s)]


def test_labels_are_made_consistent(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    p = personal_data.learn_potentials(docs)
    texts = [
        "Call +1 (706) 555-3138 or (706) 555.3138 now", "card 4644348398010899 and 4644.3483.9801.0899",
        "in 2024 and 300.1.2.3 there were 1234 days, 555-3138", "",
    ]
    base, more = personal_data.find_in_batch(texts, p, least=0.5)
    found = [[t[a:b] for a, _, b in own] for t, own in zip(texts, more)]
    assert found == [["(706) 555.3138"], ["4644.3483.9801.0899"], [], []]
    assert personal_data.mask(texts[0], base[0] + more[0]) == "Call [PHONE] or [PHONE] now"


def test_search_is_exact(docs, texts):
    out = ranked_search.search(docs, docs.filter("doc_id % 10 = 0"), k=5).toPandas()
    words = {i: re.findall(r"\w+", t.lower()) for i, t in texts.items()}
    mean, n = sum(map(len, words.values())) / len(words), len(words)
    counts = {i: Counter(w) for i, w in words.items()}
    df = Counter(w for c in counts.values() for w in c)
    for q in [i for i in words if i % 10 == 0]:
        scores = {}
        for i, c in counts.items():
            scores[i] = sum(
                math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * len(words[i]) / mean))
                for w in set(words[q]) if w in c
            )
        best = sorted((s for s in scores.values() if s), reverse=True)[:5]
        assert out[out.query_id == q].sort_values("rank").score.tolist() == pytest.approx(best)


def test_documents_of_postings_are_ready_to_be_counted():
    data = packed.dump(
        np.array([3], np.uint64), np.array([2], np.uint32), np.array([0, 1], np.uint32), np.array([1, 2], np.uint32),
        np.array([4, 5], np.uint32), np.array([7, 8], np.int64), np.array([True, True]),
    )
    shard = ranked_search.Shard(data, 4.5, 1.2, 0.75)
    assert shard.doc.dtype == np.intp  # else every search would turn them again
    docs, scores, _ = shard.search(np.array([3], np.uint64), np.array([1.0]), 5)
    assert shard.ids[docs].tolist() == [7, 8] and scores == pytest.approx(shard.impact)
    assert ranked_search._ranges(np.array([5, 2, 9]), np.array([7, 2, 10])).tolist() == [5, 6, 9]


def test_blocks_are_pruned():
    rng = np.random.default_rng(0)
    doc, sizes = np.repeat(np.arange(6400), 5), np.full(6400, 50, np.uint32)
    term = rng.integers(0, 400, len(doc)).astype(np.uint64)
    term[:320] = np.arange(320) % 5 + 1000  # one block with terms of its own
    key, n = np.unique(term * 10_000 + doc.astype(np.uint64), return_counts=True)
    terms, place = np.unique(key // 10_000, return_inverse=True)
    data = packed.dump(
        terms, np.bincount(place).astype(np.uint32), (key % 10_000).astype(np.uint32), n.astype(np.uint32), sizes,
        np.arange(6400), np.ones(6400, bool),
    )
    shard = ranked_search.Shard(data, 50.0, 1.2, 0.75)
    found, _, scored = shard.search(np.array([3, 1000, 1001, 1002], np.uint64), np.array([0.1, 5.0, 5.0, 5.0]), 10)
    assert found.max() < 64 and scored < 10 < shard.blocks


def _shard(doc, term, rows, ids):
    key, n = np.unique(term.astype(np.uint64) * 100_000 + doc.astype(np.uint64), return_counts=True)
    terms, place = np.unique(key // 100_000, return_inverse=True)
    data = packed.dump(
        terms, np.bincount(place).astype(np.uint32), (key % 100_000).astype(np.uint32), n.astype(np.uint32),
        np.full(rows, 9, np.uint32), ids, np.ones(rows, bool),
    )
    return ranked_search.Shard(data, 9.0, 1.2, 0.75)


def test_frequent_terms_are_bounded_by_document():
    doc = np.append(np.arange(6400), [700, 701, 702])  # every document has one of two terms, three of one block have both
    shard = _shard(doc, np.append(np.arange(6400) % 2, [1, 0, 1]), 6400, np.arange(6400))
    found, scores, scored = shard.search(np.array([0, 1], np.uint64), np.array([1.0, 1.0]), 3)
    assert found.tolist() == [700, 701, 702] and scored < 10 < shard.blocks  # the maxima of all blocks are the same


def test_searches_at_once_are_exact():
    rng = np.random.default_rng(3)
    for rows in (1, 63, 1000, 3000):
        doc = np.repeat(np.arange(rows), 12)
        term = np.minimum(rng.zipf(1.3, len(doc)), 500)
        term[doc % 5 == 4] = np.repeat(term[doc == 0][None], (np.arange(rows) % 5 == 4).sum(), 0).ravel()  # copies tie
        shard = _shard(doc, term, rows, rng.permutation(rows))
        queries = [
            (q, rng.random(len(q)) + 0.01)
            for q in (np.unique(rng.integers(1, 520, n)).astype(np.uint64) for n in (1, 3, 30, 400, 0, 5))
        ]
        impact = np.zeros((521, rows))
        impact[np.repeat(shard.terms.astype(int), np.bincount(np.searchsorted(shard.first, np.arange(len(shard.begin)), "right") - 1, shard.end - shard.begin).astype(int)), shard.doc] = shard.impact
        for (terms, weights), (found, scores, _) in zip(queries, shard.search_all(queries, 10), strict=True):
            total = np.zeros(rows)
            for t, w in zip(terms, weights):
                total += w * impact[int(t)]
            order = np.lexsort((shard.ids, -total))
            order = order[total[order] > 0][:10]
            by = np.lexsort((shard.ids[found], -scores))
            assert found[by].tolist() == order.tolist() and scores[by].tolist() == total[order].tolist()


def test_documents_below_a_known_score_are_left_out():
    rng = np.random.default_rng(5)
    doc = np.repeat(np.arange(900), 20)
    shard = _shard(doc, np.minimum(rng.zipf(1.3, len(doc)), 700), 900, rng.permutation(900))
    queries = [(q, rng.random(len(q)) + 0.01) for q in (np.unique(rng.integers(1, 700, n)).astype(np.uint64) for n in (2, 40, 300))]
    best = [sorted(zip((-s).tolist(), shard.ids[d].tolist())) for d, s, _ in shard.search_all(queries, 10)]
    least = np.array([-found[2][0] for found in best])
    few = [sorted(zip((-s).tolist(), shard.ids[d].tolist())) for d, s, _ in shard.search_all(queries, 10, least)]
    assert few == [[x for x in found if x[0] <= found[2][0]] for found in best] and all(len(x) >= 3 for x in few)
    (found, _, searched), *_ = shard.search_all(queries, 10, np.full(3, 1e9))
    assert not len(found) and searched == 0  # the greatest impacts do not reach it


def test_queries_are_sent_in_blocks_of_distinct_terms(spark):
    rows = [(7, None, 5, 0.5), (7, None, -2, 2.0), (9, 4, 5, 0.5), (8, 2**60 + 1, 6, 1.0)]
    (block,) = ranked_search._query_blocks(spark.createDataFrame(rows, "query long, query_id long, term long, weight double"), spark)
    query, ids, known, sizes, place, terms, weight = packed.load(block)
    assert (query.tolist(), ids.tolist(), known.tolist(), sizes.tolist()) == ([7, 8, 9], [0, 2**60 + 1, 4], [False, True, True], [2, 1, 1])
    assert terms[place].tolist() == [5, 2**64 - 2, 6, 5] and weight[place].tolist() == [0.5, 2.0, 1.0, 0.5]


def test_codec_matches_the_model_and_decodes(texts):
    import sentencepiece

    codec, model = piece_codec.PieceCodec(PATH("piece_bpe_32k.model")), sentencepiece.SentencePieceProcessor(model_file=PATH("piece_bpe_32k.model"))
    sample = [*list(texts.values())[:60], "", "  a  b\n\n c", "日本語 🙂", "\t x\r\n", "aaaa" * 300, "<s> </s> <0x41>"]
    keys = list(range(len(sample)))
    assert [x.tolist() for x in codec.encode(sample, keys, 0, 1, 4)] == model.encode(sample)
    sample += ["a ▁ b▁", "", "▁", "\0▁"]
    keys = list(range(len(sample)))
    varied = codec.encode(sample, keys, 0.2, 1, 4)
    assert [codec.decode(x) for x in varied] == sample
    assert [x.tolist() for x in codec.encode(sample, keys, 0.2, 1, 4)] == [x.tolist() for x in varied]
    assert sum(map(len, varied)) > sum(map(len, codec.encode(sample, keys, 0, 1, 4)))
    words = list({w for t in sample for w in codec.words(t)})[:3000]
    assert all(codec._merge_short(w, m) == codec._merge_long(w, m) for w in words for m in (0, 0b100100, 0b11))
    bits = piece_codec.skip_bits(np.arange(20_000, dtype=np.uint64), 0.1)
    assert np.unpackbits(bits.view(np.uint8)).mean() == pytest.approx(0.1, abs=0.005)


def test_every_occurrence_has_skips_of_its_own():
    codec = piece_codec.PieceCodec(PATH("piece_bpe_32k.model"))
    word = "internationalization"
    texts = [" ".join([word] * 200)] * 2
    found = codec.encode(texts, [1, 2], 0.3, 7)
    assert [codec.decode(x) for x in found] == texts
    of = lambda n: Counter(tuple(codec.encode([f"{'a ' * k}{word}"], [5], 0.3, 7)[0].tolist()[-n:]) for k in range(300))
    assert len(of(6)) > 20 and found[0].tolist() != found[1].tolist()
    long = [f"{'x' * 70} {word * 5} {'b' * 30}", "z" * 64 + " " + "y" * 65]
    assert [codec.decode(x) for x in codec.encode(long, [3, 4], 0.3, 7)] == long
    agenda = [w for w in codec.words(" ".join([word, "the", "of"] * 50))]
    for i, (w, k) in enumerate(zip(agenda, range(1, len(agenda) + 1))):
        low = k & (1 << 3 * (len(w) - 1)) - 1
        assert codec.segment(w, low) == codec.segment(w, low | 1 << 3 * (len(w) - 1))


def test_short_words_with_skips_share_their_steps(monkeypatch):
    codec = piece_codec.PieceCodec(PATH("piece_bpe_32k.model"))
    words = [w for w in codec.words("the quick  brown fox\n\njumps over lazy dogs, étés 日本 1999 internationalise") for _ in range(50)]
    skips = np.array([(i * 0x9E3779B97F4A7C15 >> 7) & (1 << 3 * (len(w) - 1)) - 1 for i, w in enumerate(words)], np.uint64)
    ids, counts = codec._segment_all(words, skips)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [codec.segment(w, int(m)) for w, m in zip(words, skips)]
    calls, plain = [], codec.segment
    monkeypatch.setattr(codec, "segment", lambda word, skips=0: calls.append(word) or plain(word, skips))
    text = " ".join(f"word{i} hundred" for i in range(400))
    assert codec.decode(codec.encode([text], [1], 0.3, 7)[0]) == text
    assert len(calls) < 40  # no word with skips is segmented by itself


def test_texts_are_shuffled_once_and_worked_on_in_pieces(spark):
    import pyarrow as pa

    from panelweave.llm.texts import ROWS, map_documents, sliced

    rows = [(i % 40, f"one two three four five six {i % 40}", "en", "s", 1) for i in range(60)] + [(None, "a b", "en", "s", 1)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = near_duplicates.drop_near_duplicates(frame)
    tree = kept._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in tree and "Exchange" not in tree.split("SortMergeJoin")[0]  # none between the join and the repeated rows
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, i) for i in range(40)] + [(True, None)]
    batch = pa.record_batch({"x": list(range(2 * ROWS + 5))})
    assert [b.num_rows for b in sliced(iter([batch]))] == [ROWS, ROWS, 5]
    many = spark.range(3000, numPartitions=1).selectExpr("id doc_id", "'t' text", "'en' lang", "'s' source", "1L n_chars")

    def work(b):
        return pa.RecordBatch.from_arrays([*[b.column(i) for i in range(4)], pa.array([b.num_rows] * b.num_rows, pa.int64())], schema=b.schema)

    out = map_documents(many, work)
    assert out.agg(F.max("n_chars"), F.count("*")).first()[:] == (ROWS, 3000)


@pytest.mark.parametrize("chunk", [256, 3])
def test_links_and_groups_by_brute_force(spark, docs, texts, chunk):
    base = "one two three four five six seven eight nine ten " * 6
    extra = [(10_000 + i, f"{base} tail{i} end{i % 3}", "en", "s", 1) for i in range(9)]
    df = docs.union(spark.createDataFrame(extra, docs.schema))
    out = near_duplicates.near_duplicates(df, chunk=chunk).toPandas().set_index("doc_id")
    of = near_duplicates.GramSet(5)
    sets = {i: set(of(t).tolist()) for i, t in [*texts.items(), *[(e[0], e[1]) for e in extra]]}
    links, parent, ids = Counter(), {i: i for i in sets}, sorted(sets)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {i: int(r.n_links) for i, r in out.iterrows()} == {i: links[i] for i in ids}
    assert {i: int(r.group_id) for i, r in out.iterrows()} == {i: find(i) for i in ids}
    assert out.first_of_group.sum() == len({find(i) for i in ids})


def test_bands_reach_the_recall():
    for similarity in (0.6, 0.8, 0.9):
        bands, rows = near_duplicates.choose_bands(similarity, 0.995, 256)
        assert bands * rows <= 256 and 1 - (1 - similarity**rows) ** bands >= 0.995


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3)]
    out = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}


def test_quality_and_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.classify_quality(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (out.predicted == out.quality).mean() > 0.97
    out = language_id.identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (out.lang_pred == out.lang).mean() > 0.97


def test_attention_gradients():
    rng = np.random.default_rng(2)
    bags = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 3, 5, 2)]
    labels = np.array([0.0, 1.0, 0.0, 1.0])
    model = quality.AttentionModel(hidden=4, attention=3).fit(bags, labels, epochs=400)
    assert (np.abs(model.score(bags) - labels) < 0.2).all()


def test_fingerprints(spark, docs, texts):
    out = multiset_hash.edit_report(docs).toPandas().set_index("doc_id")
    order = sorted(texts, reverse=True)
    for at, i in enumerate(order):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[order[(at + 1) % len(order)]][:half]
        assert out.loc[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and out.loc[i].n_chars == len(texts[i])
    assert out.fingerprint.nunique() == len(set(texts.values())) and out.near_edited.mean() > out.near_next.mean() + 0.3
    rows = [("a. b.\nc d.\ne", "e\na. b.\nc d.", "a. b.\ne", "c d.")]
    df = spark.createDataFrame(rows, "whole string, moved string, part string, rest string")
    df = df.select(*[multiset_hash.fingerprint(F.col(c)).alias(c) for c in df.columns])
    whole, part, rest = F.col("whole"), F.col("part"), F.col("rest")
    got = df.select(
        whole == F.col("moved"), multiset_hash.combine(part, rest) == whole, multiset_hash.combine(whole, rest, -1) == part
    ).first()
    assert all(got)


@pytest.mark.parametrize("n", [0, 1, 126, 127, 128, 1000])
def test_bits_are_counted_in_runs(spark, n):
    rng = random.Random(n)
    hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(n)] + [-1] * n
    df = spark.createDataFrame([(hashes,)], "h array<long>").select(multiset_hash._bit_counts(F.col("h")).alias("x"))
    bit = lambda j: sum(h >> j & 1 for h in hashes)
    assert df.first().x == [bit(j) + (bit(j + 31) << 31) for j in range(30)]


def test_sentences_are_split_once(spark):
    df = spark.createDataFrame([("a. b",)], "t string").select(multiset_hash.fingerprint(F.col("t")).alias("f"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 3  # paragraphs, sentences, words


def test_likeness_of_long_texts(spark):
    words = [f"w{i}" for i in range(400)]
    other = [f"v{i}" for i in range(200)]
    many = "same. " * 40_000
    rows = [(" ".join(words), " ".join(words[:200] + other), " ".join(other), many + "a. b.", many + "c. d.")]
    df = spark.createDataFrame(rows, "x string, half string, none string, p string, q string")
    df = df.select(*[multiset_hash.fingerprint(F.col(c)).alias(c) for c in df.columns])
    got = multiset_hash.with_likeness(df, {"a": ("x", "half"), "b": ("x", "none"), "c": ("p", "q")}).select("a", "b", "c").first()
    assert 0.25 < got.a < 0.75 and got.b < 0.25 and got.c > 0.99


def test_packing_is_gapless_and_true(docs, texts):
    from tokenizers import Tokenizer

    out = packing.pack(docs, PATH("byte_bpe_50k.json"), PATH("byte_bpe_50k.tiktoken"), block_docs=64).toPandas()
    model = Tokenizer.from_file(PATH("byte_bpe_50k.json"))
    for i, own in out.sort_values("start").groupby("doc_id"):
        ids = np.array([*model.encode(texts[i], add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in own.itertuples():
            assert (r.start, r.doc_tokens) == (at, len(ids)) and zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for _, own in out.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= 1024
    full = out.groupby("sequence_id").length.sum()
    assert (1024 - full).sum() <= 1024 * 4


def test_odd_texts_are_encoded_like_the_tokenizer():
    from tokenizers import Tokenizer

    encoder, model = packing.StreamEncoder(PATH("byte_bpe_50k.json"), PATH("byte_bpe_50k.tiktoken")), Tokenizer.from_file(PATH("byte_bpe_50k.json"))
    odd = ["", " ", "\n\n a", "a b  c", "x<|endoftext|>y", "it's  don't\t!", "日本 ½²", "a\r\n b", "  \n  ", "é ß"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(odd)] == [model.encode(t, add_special_tokens=False).ids for t in odd]


def test_latin_texts_are_encoded_whole_like_the_tokenizer():
    from tokenizers import Tokenizer

    encoder, model = packing.StreamEncoder(PATH("byte_bpe_50k.json"), PATH("byte_bpe_50k.tiktoken")), Tokenizer.from_file(PATH("byte_bpe_50k.json"))
    rng = random.Random(8)
    odd = {"\t", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0"}
    signs = [chr(u) for u in range(0x250) if chr(u) not in odd]
    texts = ["".join(rng.choice([*signs, *" \n'stle1 \n'"]) for _ in range(60)) for _ in range(1500)]
    texts += ["".join(rng.choice("ab é\n1'") for _ in range(60)) for _ in range(500)] + [" " * 3000 + "a" + "\n" * 3000]
    want = [x.ids for x in model.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    assert not encoder.known  # no text was cut
    assert not any(encoder._plain(f"a{c}b") for c in [*odd, "\u0250", "\U0001f600", "<|endoftext|>"])


def test_balance_spreads_cost():
    rng = random.Random(4)
    lengths = [rng.randint(1, 900) for _ in range(300)]
    filled = packing.balance(lengths, 1024, 1.0, 1 / 1024)
    assert len(filled) == -(-sum(lengths) // 1024)
    got = Counter()
    for own in filled:
        for item, _, n in own:
            got[item] += n
    assert [got[i] for i in range(300)] == lengths


def test_main_text_between_boilerplate():
    page = (
        "<html><head><title>t</title><script>var a='<p>';</script></head><body><nav><ul><li><a href='/'>Home</a></ul></nav>"
        "<div class='ad banner'>Buy now, this is a rather long advert text that nobody wants to read at all.</div>"
        "<div id=content><h1>Head &amp; line</h1><p>First  paragraph<br>goes on with quite a lot of words in it.</p>"
        "<p>Second one, also long enough to count as text in a page.<p>Unclosed</div>"
        "<div class='comments'><p>I disagree with all of this, says a reader at length.</p></div><footer>&copy; x</footer>"
    )
    want = "Head & line\nFirst paragraph goes on with quite a lot of words in it.\nSecond one, also long enough to count as text in a page.\nUnclosed"
    assert html_main.main_text(page) == want


def test_main_text_is_found_by_its_lines():
    body = "<p>A first paragraph of the story that is long enough to count as text of the page, by far.<p>A second one, which goes on."
    text = html_main.main_text(f"<div>{body}</div>")
    assert text.count("\n") == 1
    teaser = "<div class=ad>x</div><article class=card><p>Short teaser</article>"
    comment = "<article class=comment><p>I disagree with all of this, says a reader at length, and then goes on about it a lot.</article>"
    for page in (
        f"<div id=content>{body}</div>{teaser}", f"<div id=content>{body}</div>{comment}",
        f"<div class='content has-sidebar'>{body}</div>", f"<div class='site no-sidebar'>{body}</div>",
        f"<nav><a href=/>Home</a></nav><div>{body}</div><div class=site-footer>Some words at the end</div>",
        f"<article>{body}</article><div class='ad'>x</div><p>All rights reserved",
    ):
        assert html_main.main_text(page) == text, page
