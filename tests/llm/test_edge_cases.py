"""Every corpus operator on missing values, empty and long texts, repeated rows, clashing columns and empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from panelweave.llm import (
    html_main, language_id, multiset_hash, near_duplicates, packing, personal_data, piece_codec, pitman_yor,
    quality, ranked_search,
)

PATH = public_tokenizers.path
CLASHES = ["row", "block", "part", "at", "k", "h", "rep", "root", "query", "term", "bag", "y", "_s_f", "own", "size"]


def edge_rows():
    long = " ".join(f"word{i % 997} of the corpus" for i in range(6000))
    same = "the quick brown fox jumps over the lazy dog and runs away from it"
    return [
        (1, same, "en"), (1, same, "en"), (2, same, None), (3, None, None), (4, "", "en"), (5, long, "en"),
        (6, "été à la plage avec ma mère", "fr"), (7, "12345 !!! ???", "fr"), (None, "no key here", "en"),
        (8, "a\tb\n\n\nc  d", None), (9, same.upper() + " mail a.b@c.example.com", "en"),
    ]


@pytest.fixture(scope="module")
def edges(spark):
    df = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string")
    df = df.withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 1), (5, 0), (7, 0), (6, None), (None, 1), (99, 1)], "doc_id long, quality int")


OPERATORS = {
    "language": lambda d, s: language_id.identify_language(d),
    "quality": lambda d, s: quality.classify_quality(d, s),
    "packing": lambda d, s: packing.pack(d, PATH("byte_bpe_50k.json"), PATH("byte_bpe_50k.tiktoken")),
    "multiset": lambda d, s: multiset_hash.edit_report(d),
    "personal": lambda d, s: personal_data.find_personal_data(d),
    "codec": lambda d, s: piece_codec.round_trip(d, PATH("piece_bpe_32k.model")),
    "near": lambda d, s: near_duplicates.near_duplicates(d),
    "scoring": lambda d, s: pitman_yor.score_texts(d),
    "search": lambda d, s: ranked_search.search(d, d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_edge_rows(edges, labels, name):
    out = OPERATORS[name](edges, labels).toPandas()
    n = len(edge_rows())
    if name not in ("packing", "search"):
        assert len(out) == n
    if name == "packing":
        assert len(out.groupby(["sequence_id"]).length.sum()[lambda s: s > 1024]) == 0
        assert out[out.start == 0].shape[0] == n and out[out.doc_id == 5].length.sum() == out[out.doc_id == 5].doc_tokens.iloc[0]
    if name == "search":
        top = out[(out.query_id == 5) & (out["rank"] == 1)]
        assert top.doc_id.tolist() == [5] and 4 not in set(out.query_id) and out["rank"].max() <= 9
    if name == "language":
        assert set(out[out.doc_id.isin([3, 4, 7])].lang_pred) == {"und"} and out.score.between(0, 1).all()
    if name == "quality":
        assert out.score.between(0, 1).all()
    if name == "multiset":
        assert out[out.doc_id.isin([1, 2])].fingerprint.nunique() == 1 and out[out.doc_id.isin([3, 4])].fingerprint.nunique() == 1
    if name == "codec":
        assert out.lossless.all() and out[out.doc_id.isin([3, 4])].n_ids.tolist() == [0, 0]
    if name == "near":
        assert out[out.doc_id.isin([1, 2])].n_links.tolist() == [3, 3, 3] and out[out.doc_id.isin([1, 2, 9])].first_of_group.sum() == 1
        assert set(out[out.doc_id.isin([1, 2, 9])].group_id) == {1} and out[out.doc_id == 5].n_links.tolist() == [0]
    if name == "scoring":
        assert (out.score < 0).all() and out[out.doc_id.isin([3, 4])].n_tokens.tolist() == [1, 1]
    if name == "personal":
        assert out[out.doc_id == 9].n_email.tolist() == [1] and out[out.doc_id != 9].n_email.sum() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(edges, labels, name):
    assert OPERATORS[name](edges.limit(0), labels.limit(0)).count() == 0


def test_nothing_to_learn(edges, labels):
    out = quality.classify_quality(edges, labels.limit(0)).toPandas()
    assert set(out.score) == {0.5} and set(out.predicted) == {1}
    out = language_id.identify_language(edges.withColumn("lang", F.lit(None).cast("string"))).toPandas()
    assert set(out.lang_pred) == {"und"}


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "v", "<p>one</p>"), (3, "v", "<p>one</p>"), (None, "w", "plain & simple")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = html_main.extract_main(df).orderBy("page_id").collect()
    assert [r.text for r in out] == ["plain & simple", "", "", "one", "one"] and [r.n_chars for r in out] == [14, 0, 0, 3, 3]
    assert html_main.extract_main(df.limit(0)).count() == 0
