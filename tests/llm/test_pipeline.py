"""The pipeline on planted documents, stage by stage, and the registry."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import registry
from quarry.llm.simhash import fingerprint
from tests.llm.helpers import prose

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents (and extra, clashing columns), labels, benchmark."""
    rng = random.Random(21)
    root = tmp_path_factory.mktemp("pipeline")
    rows, labels = [], []
    items = [prose(rng, 30) + "." for _ in range(5)]
    for i in range(400):
        text = prose(rng, rng.randint(30, 90))
        toxic = int(i % 5 == 1)
        if toxic:
            text += " you vorplax " + prose(rng, 5)
        if i % 40 == 2:
            text += " " + items[i % 5]
        if i % 40 == 3:
            text += " write to jo.smith@mail.example.com or +1 (415) 555-2671"
        rows.append([i, text, "en", "src", len(text), 1.0, toxic])
        labels.append((i, 1, toxic))
    for i in range(400, 420):                      # copies of clean document 0
        rows.append([i, rows[0][1], "en", "src", len(rows[0][1]), 1.0, 0])
    rows += [[500, None, None, None, None, None, 0], [501, "", "en", "src", 0, 1.0, 0],
             [None, prose(rng, 40), "en", "src", 0, 1.0, 0], [4, rows[4][1], "en", "src", rows[4][4], 2.0, 0]]
    spark.createDataFrame([r[:6] for r in rows], "doc_id long, text string, lang string, source string, n_chars long, `score` double") \
        .repartition(4).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), rows


def test_stages(spark, tables):
    root, rows = tables
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns = docs.columns
    toxic = {r[0] for r in rows if r[6]}
    leaked = {i for i in range(400) if i % 40 == 2}

    clean = corpus_pipeline.written(corpus_pipeline.toxicity_stage(spark, docs, root), "t")
    assert clean.columns == columns
    ids = [r.doc_id for r in clean.select("doc_id").collect()]
    assert not toxic & set(ids)
    assert len(ids) == len(rows) - len(toxic)

    single = corpus_pipeline.written(corpus_pipeline.near_duplicates_stage(spark, clean, root), "n")
    assert single.columns == columns
    kept = single.collect()
    fps = fingerprint([r.text for r in kept]).tolist()
    assert all((a ^ b).bit_count() > 4 for k, a in enumerate(fps) for b in fps[:k])
    assert not {r.doc_id for r in kept} & set(range(400, 420))
    assert {0, 4, None} <= {r.doc_id for r in kept}
    assert sum(r.doc_id == 4 for r in kept) == 1
    assert len(kept) == len(ids) - 20 - 1 - 1       # copies, the repeated row, one of the two empty texts

    decon = corpus_pipeline.written(corpus_pipeline.decontamination_stage(spark, single, root), "d")
    assert decon.columns == columns
    assert {r.doc_id for r in kept} - {r.doc_id for r in decon.collect()} == leaked - toxic

    private = corpus_pipeline.written(corpus_pipeline.pii_stage(spark, decon, root), "p")
    assert private.columns == columns
    assert private.count() == decon.count()
    texts = " ".join(r.text or "" for r in private.collect())
    assert "jo.smith@" not in texts and "555-2671" not in texts
    assert private.where(F.col("n_chars") != F.length("text")).count() == 0

    packed = corpus_pipeline.packing_stage(spark, private, root)
    assert packed.select("doc_id").distinct().count() == private.select("doc_id").distinct().count()
    total = corpus_pipeline.run(spark, root).agg(F.sum("length")).first()[0]
    assert total == packed.agg(F.sum("length")).first()[0]


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(5)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    rows = [(5, a, 1), (5, b, 2), (3, b, 3), (None, c, 4), (None, c, 5), (None, c, 5), (7, d, 6), (7, d, 6), (7, d, 7), (None, d, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(3)
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates_stage(spark, docs, "").collect()]
    assert sorted(r[1] for r in kept) == sorted([a, b, c, d])       # no group is lost, none keeps two
    assert {(5, a, 1), (3, b, 3)} <= set(kept)
    assert {r[0] for r in kept if r[1] == c} == {None} and {r[0] for r in kept if r[1] == d} == {7}
    assert set(kept) <= set(rows)


def test_leaks_without_id_go(spark, tmp_path):
    rng = random.Random(6)
    items = [prose(rng, 30) + "." for _ in range(3)]
    texts = [prose(rng, 80) for _ in range(40)]
    rows = [(i if i % 4 else None, t) for i, t in enumerate(texts)]
    rows += [(None, f"{prose(rng, 20)} {items[0]} {prose(rng, 20)}"), (1, f"{prose(rng, 20)} {items[1]}")]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path)).collect()]
    assert sorted(kept, key=str) == sorted(rows[:40], key=str)      # both leaks go; the clean rows without id or of id 1 stay


def test_stage_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "pii", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_registry_has_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14))


def test_embedding_query_equals_its_sql(spark, duck):
    from quarry.catalog import Entry
    from tests.conftest import SF01
    from tools.oracle_check import compare
    entry = Entry("op7", registry.QUERIES["op7_embedding_dedup"], registry.ORACLE_SQL["op7_embedding_dedup"], "batch")
    problems, n, _ = compare(spark, duck, "op7", entry, SF01)
    assert not problems and n == 500


SCHEMAS = {
    "op1_quality": {"doc_id", "held_out", "score", "predicted"},
    "op4_simhash": {"doc_id", "fingerprint", "component_id"},
    "op5_suffix_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op6_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op7_embedding_dedup": {"vec_id", "n_links", "component_id", "kept"},
    "op8_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op9_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op10_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op11_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op12_collocations": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
    "op13_prefix_trie": {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"},
}
KEYS = {"op7_embedding_dedup": ("embeddings", "vec_id"), "op12_collocations": ("documents", "lang"),
        "op13_prefix_trie": ("conversations", "conv_id")}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_queries_cover_their_table(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert SCHEMAS.get(name, set()) <= set(df.columns)
    table, key = KEYS.get(name, ("documents", "doc_id"))
    all_ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    ids = {r[0] for r in df.select(key).collect()}
    partial = {"op2_decontamination", "op12_collocations", "op13_prefix_trie"}      # leaks, frequent phrases, smallest members
    assert ids <= all_ids if name in partial else ids == all_ids


def test_empty_tables_pass_through(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"),
                         ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_kept_texts_are_not_shuffled(spark, tables):
    """No exchange of the removal holds a text but behind the bit map."""
    from quarry.llm.keep import divided
    from quarry.plans.inspect import plan_text
    docs = corpus_pipeline._keyed(spark.read.parquet(f"{tables[0]}/documents.parquet"))
    gone = docs.where("doc_id % 7 = 0").select(*corpus_pipeline.KEY)
    sure, doubtful = divided(docs, gone, corpus_pipeline.KEY[0])
    assert "Exchange" not in plan_text(sure)
    n_gone = docs.where("doc_id % 7 = 0").count()
    assert doubtful.count() == n_gone and sure.count() == docs.count() - n_gone
    full, all_doubtful = divided(docs, gone, corpus_pipeline.KEY[0], bits=10)      # a map too small decides nothing wrongly
    assert full.count() + all_doubtful.count() == docs.count()
    assert full.join(gone, list(corpus_pipeline.KEY), "left_semi").count() == 0
