"""Every stage of the corpus pipeline, and ``run``, on awkward rows, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tierone.llm import exact_dedup, simhash

PROSE = "the quick brown fox jumps over the lazy dog while seven other animals watch it from a distance and wonder " \
        "whether they should join the game or rather wait until the evening comes and the field is quiet again"
OTHER = "prices of grain rose again last month as heavy rain delayed the harvest in most northern districts of the " \
        "country while exports to the usual markets fell by a tenth against the same month of the year before"
PASSAGE = "which of the following four planets has the largest number of known moons today"
ROWS = [  # doc_id, text, lang, source, then columns the operators use names of
    (1, PROSE, "en", "a"), (2, PROSE + "  ", "en", "a"), (2, PROSE + "  ", "en", "b"), (None, PROSE, "en", None),
    (3, "\t" + PROSE, "en", "a"), (3, OTHER, "en", "b"), (4, None, None, None), (4, "", None, "a"),
    (None, OTHER + " so " + PASSAGE + " or not", "en", "a"), (None, OTHER.replace("tenth", "third"), "en", "a"),
    (5, "x", "en", "c"), (6, "long " * 20_000, "en", "c"), (7, "Ünïcödé wörds ßind hier", "de", "c")]
SCHEMA = "doc_id long, text string, lang string, source string, `__key` string, `__gone` int, `__sha` string, " \
         "`key` string, size string, taken string, kept string, `odd name.x` string, m map<string,int>"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", i, "s", "y", "z", "t", "no", "q", {"a": 1}) for i, r in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    frame(spark, ROWS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (5, 0, 0), (6, None, None), (None, 1, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("q1", PASSAGE), (None, None), ("q2", "")],
                          "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_stages_keep_whole_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns and after.schema.simpleString() == docs.schema.simpleString(), name
        kept = rows_of(after)
        assert set(kept) <= set(rows_of(docs)) and kept, name
    mixed = corpus_pipeline.mixing_stage(spark, docs, folder).collect()
    assert len(mixed) == len(ROWS) and all(0 <= r.taken <= 3 * r["size"] for r in mixed)


def test_one_row_of_each_near_group_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = simhash.keep_first(docs.select("doc_id", "text", "source")).collect()
    groups = simhash.near_groups(docs)
    roots = {(r.doc_id, r.key): r.root for r in groups.collect()}
    assert len(kept) == len(set(roots.values()))
    texts = [r.text for r in kept]
    assert sum(PROSE[:40] in (t or "") for t in texts) == 1 and (1, PROSE, "a") in {tuple(r) for r in kept}
    # Components without any id, and two near copies under one id, keep one row each.
    nameless = spark.createDataFrame([(None, PROSE), (None, PROSE + " "), (None, PROSE), (9, OTHER), (9, OTHER + " ")],
                                     "doc_id long, text string")
    assert sorted(r.doc_id or 0 for r in simhash.keep_first(nameless).collect()) == [0, 9]


def test_exact_stage_keeps_the_same_row_in_every_run(spark):
    rows = [(1, "a b", i, {"x": i}) for i in range(20)] + [(1, "a  b", 3, None), (None, "ab", 1, None)]
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, n int, m map<string,int>").repartition(parts, "n")
        assert [(r.doc_id, r.text, r.n) for r in exact_dedup.keep_exact(docs).collect()] == [(1, "a  b", 3)]


def test_contaminated_texts_go_and_clean_ones_with_their_id_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    after = corpus_pipeline.decontamination_stage(spark, docs, folder)
    assert rows_of(after) == [r for r in rows_of(docs) if PASSAGE not in r]


def test_run_over_awkward_rows(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    texts = [r.text for r in rows]
    assert sum(PROSE[:40] in (t or "") for t in texts) == 1 and not any(PASSAGE in (t or "") for t in texts)
    assert all(r.__getitem__("__key") == "k" and r["odd name.x"] == "q" for r in rows)
    assert sum(not t for t in texts) <= 1


def test_empty_tables(spark, folder, tmp_path):
    empty = frame(spark, ROWS).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, empty, folder)
        assert after.count() == 0 and set(empty.columns) <= set(after.columns), name
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    for stage in (corpus_pipeline.quality_stage, corpus_pipeline.decontamination_stage):
        assert stage(spark, docs, str(tmp_path)).count() == docs.count()
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).select(F.count(F.lit(1))).first()[0] == 0
