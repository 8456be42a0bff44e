"""The pipeline's stages on the smallest tables."""

import corpus_pipeline
from conftest import SMALL
from panelweave.lineage import durable
from panelweave.llm import language_id
from panelweave.llm.registry import QUERIES


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts, seen = docs.columns, [docs.count()], [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, SMALL))
        counts.append(docs.count())
        seen.append(docs)
        if stage is not corpus_pipeline.packing:
            assert docs.columns == columns
    assert counts[0] > counts[1] >= counts[2] > counts[3] == counts[4] <= counts[5]
    assert seen[2].exceptAll(seen[0]).count() == 0 and seen[3].exceptAll(seen[2]).count() == 0
    texts = [r.text for r in seen[4].collect()]
    assert not any("@" in t and ".example." in t for t in texts) and any("[EMAIL]" in t for t in texts)
    tokens = docs.select("doc_id", "doc_tokens").distinct()
    assert tokens.count() == counts[4]


def test_language_decides(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prototypes = language_id.fit_prototypes(docs)
    french = docs.filter("lang = 'fr' and n_chars > 500").first().text
    rows = [
        (1, french, "en"), (2, french, None), (3, "Быстрая коричневая лиса прыгает через ленивую собаку", "en"),
        (4, "zxqv wkjh qqpf zzxt vbnq", "fr"), (5, "12345 !!!", "en"), (6, "", None), (7, french, "fr"),
    ]
    planted = spark.createDataFrame([(*r, "s", len(r[1])) for r in rows], docs.schema)
    out = language_id.keep_known(planted, prototypes).collect()
    assert {(r.doc_id, r.lang) for r in out} == {(1, "fr"), (2, "fr"), (7, "fr")}
    learned = docs.filter(language_id.remainder("doc_id", 4) != 2).filter("text rlike '\\\\p{L}'")
    assert learned.exceptAll(language_id.keep_known(learned, prototypes)).count() == 0


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
