from __future__ import annotations

import time

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as entry
from telemaque import workspace
from telemaque.llm import decontam, linededup, linking, minhash, quality
from tests.llm.helpers import SMALL, hostile
from tests.llm.test_counts_and_rules import brute_counts, check_packed
from tests.llm.test_duplicates import brute_groups
from tests.llm.test_texts import brute_contamination


def test_stages_do_what_brute_force_does(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = stage(spark, docs, SMALL).cache()
        kept = {r["doc_id"]: r["text"] for r in out.collect()}
        assert out.columns == docs.columns
        if name == "quality_rules":
            for i, text in rows:
                n, *_, again = brute_counts(text)
                assert not (i in kept and (n < 50 or 100 * again > 50 * n))
        elif name == "line_dedup":
            gone = {(r["doc_id"], r["line_no"]) for r in linededup.line_classes(docs).where("not kept").collect()}
            for i, text in rows:
                lines = [x for n, x in enumerate(text.split("\n")) if (i, n) not in gone]
                assert kept.get(i, "").strip() == "\n".join(lines).strip()
        elif name == "near_dedup":
            _, component = brute_groups(rows, minhash.SHINGLE)
            assert set(kept) == {i for i, c in component.items() if i == c}
        else:
            assert set(kept) == {i for i, *_, hit in brute_contamination(rows, items) if not hit}
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    check_packed(packed, 2048)
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_stages_on_hostile_and_empty_tables(spark):
    plain = hostile(spark).select("doc_id", "text", "source", F.lit("x").alias("lang"), F.col("n_words").alias("n_chars"))
    for docs in (plain, plain.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SMALL).count()


def test_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{n}" for n in range(1, 14)} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]
    assert decontam.WINDOW == 10 and quality.Limits().min_words == 50


def test_stages_drop_rows_without_an_id_and_repeated_rows(spark):
    text, other = (" ".join(f"{x}{i}" for i in range(60)) for x in "wv")
    passage = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(None, text), (3, text), (3, text), (None, text + " more"), (None, other), (None, other), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stages = dict(corpus_pipeline.STAGES)
    left = stages["near_dedup"](spark, docs, SMALL)
    assert left.columns == docs.columns
    assert sorted((tuple(r) for r in left.collect()), key=str) == sorted([(3, text), (None, other), (4, "")], key=str)
    leaked = docs.union(spark.createDataFrame([(None, f"{text} {passage}"), (4, f"x {passage}")], docs.schema))
    assert sorted(map(str, stages["decontamination"](spark, leaked, SMALL).collect())) == sorted(map(str, docs.collect()))


def test_stages_leave_nothing_but_what_their_rows_are_read_from(spark, tmp_path, monkeypatch):
    """Shuffle files and tables stored on the way once took more disk than the stages' own results."""

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{text}\n{text[:-i]}\n{i} lines") for i in range(1, 9)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/docs")
    docs, before = spark.read.parquet(f"{tmp_path}/docs"), spark.conf.get(linking.CLEANUP, None)
    try:
        spark._jvm.System.gc()
        time.sleep(2)
        at_first = shuffled()
        for name, kinds in (("line_dedup", ["classed", "first"]), ("near_dedup", ["firsts", "rows"])):
            monkeypatch.setattr(workspace, "shared_root", lambda _, name=name: f"{tmp_path}/{name}")
            docs_after = dict(corpus_pipeline.STAGES)[name](spark, docs, SMALL)
            docs_after.write.parquet(f"{tmp_path}/{name}-out")
            assert sorted(x.name.split("-")[0] for x in (tmp_path / name / "telemaque").iterdir()) == kinds
        for _ in range(20):
            if shuffled() <= at_first:
                break
            time.sleep(0.5)
        assert shuffled() <= at_first
    finally:
        spark.conf.unset(linking.CLEANUP) if before is None else spark.conf.set(linking.CLEANUP, before)


def test_the_texts_of_near_dedup_and_decontamination_are_not_shuffled(spark):
    """A few ids go to the texts, whatever Spark takes the size of a table to be."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("near_dedup", "decontamination"):
            out = dict(corpus_pipeline.STAGES)[name](spark, docs, SMALL)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "LeftAnti" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
