"""The registered queries against their SQL, and the pipeline against its stages' meaning."""

from __future__ import annotations

import oracle
import pytest
from llm_frames import AWKWARD

import __spark_entry__ as entry
import corpus_pipeline
from caseloom.llm import queries
from caseloom.llm.near_dups import near_duplicates

FOLDER = entry.SMOKE_DIR


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    con = oracle.connection(FOLDER)
    assert oracle.differences(spark, con, queries.QUERIES[name], queries.ORACLES[name], FOLDER) == ""


def test_thirteen_queries_and_the_pipeline():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "decontamination", "packing"]


def test_pipeline_over_awkward_rows(spark, tmp_path):
    good = [" ".join(f"word{(i * 7 + j * j) % 997}" for j in range(80)) for i in range(24)]
    bad = [" ".join(f"spam{j % 5}##" for j in range(80)) + f" x{i}" for i in range(24)]
    toxic = [t + " vileword vilething vileword" for t in good[:12]]
    item = " ".join(f"question{j}" for j in range(30))
    texts = [(i, t) for i, t in enumerate(good + bad + toxic)]
    texts += [(900, good[0] + " " + item), (901, good[1]), (902, good[1] + " more")] + [(2_000 + k, t) for k, (_, t) in enumerate(AWKWARD)]
    texts += [(None, good[2]), (None, good[5] + " " + item)]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(not 24 <= i < 48), int(i >= 48)) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        assert docs.columns == before.columns
        kept[name] = {r.doc_id for r in docs.collect()}
    assert not any(item in (r.text or "") for r in docs.collect())  # a copy without id goes, too
    assert not kept["toxicity"] & set(range(48, 60)) and set(range(24)) <= kept["toxicity"]
    assert not kept["quality"] & set(range(24, 48)) and set(range(24)) <= kept["quality"]
    groups = {r.doc_id for r in near_duplicates(before, percent=80).filter("kept").collect()}
    assert 901 not in kept["near_duplicates"] and 1 in kept["near_duplicates"] and kept["near_duplicates"] >= groups - {None}
    assert 900 not in kept["decontamination"] and 5 in kept["decontamination"]
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == kept["decontamination"]


def test_pipeline_stages_take_empty_tables_and_clashing_names(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    clashing = docs.select("doc_id", "text", "lang", "source", "n_chars", docs["text"].alias("Text"), docs["doc_id"].alias("DOC_ID"))
    again = clashing.toDF("doc_id", "text", "lang", "source", "n_chars", "text", "doc_id")
    for name, stage in corpus_pipeline.STAGES:
        plain = sorted(r.doc_id for r in stage(spark, docs, FOLDER).collect())
        for frame in (clashing, again):
            got = stage(spark, frame, FOLDER)
            assert sorted(r[0] for r in got.collect()) == plain
            assert name == "packing" or got.columns == frame.columns
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
