"""The pipeline and the registered queries on the smallest tables."""

import re
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from quaver.llm import decontam, linededup, quality, simhash
from quaver.session import table

DIR = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()


def test_stages_are_the_operators_in_turn(spark):
    docs = table(spark, DIR, "documents")
    names = docs.columns
    judged = {r.doc_id: r for r in quality.query(docs, table(spark, DIR, "labels")).collect()}
    kept = corpus_pipeline.quality_rules(spark, docs, DIR).cache()
    assert {r.doc_id for r in kept.collect()} == {k for k, r in judged.items() if r.kept} and kept.columns == names
    lines = corpus_pipeline.line_dedup(spark, kept, DIR).cache()
    drops = {r.doc_id: r.n_dropped for r in linededup.query(kept).collect()}
    was = {r.doc_id: r.text for r in kept.collect()}
    assert {r.doc_id: len(was[r.doc_id].split("\n")) - (len(r.text.split("\n")) if r.text or not drops[r.doc_id] else 0) for r in lines.collect()} == drops
    one = corpus_pipeline.near_dedup(spark, lines, DIR).cache()
    assert sorted(r.doc_id for r in one.collect()) == sorted({r.component_id for r in simhash.query(lines).collect()}) and one.columns == names
    clean = corpus_pipeline.decontamination(spark, one, DIR)
    bad = {r.doc_id for r in decontam.query(one, table(spark, DIR, "benchmark")).collect() if r.contaminated}
    ids = {r.doc_id for r in clean.collect()}
    assert ids == {r.doc_id for r in one.collect()} - bad and clean.columns == names
    assert {r.doc_id for r in corpus_pipeline.run(spark, DIR).collect()} == ids


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    df = entry.queries()[name](spark, DIR)
    found = con.execute(entry.oracle_sql()[name])
    columns = sorted(c[0] for c in found.description)
    place = [[c[0] for c in found.description].index(c) for c in columns]
    assert sorted(df.columns) == columns
    assert sorted(str([r[c] for c in columns]) for r in df.collect()) == sorted(str([r[i] for i in place]) for r in found.fetchall())


def test_empty_tables(spark, tmp_path):
    for t in TABLES:
        table(spark, DIR, t).where("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    for name, run in entry.queries().items():
        if re.match("op|pipeline", name):
            assert run(spark, str(tmp_path)).count() == (name == "op3_chat_formatting")


def test_extra_columns(spark, tmp_path):
    for t in TABLES:
        shutil.copy(f"{DIR}/{t}.parquet", tmp_path / f"{t}.parquet")
    docs = table(spark, DIR, "documents").limit(60).withColumn("found_before", F.lit(1)).withColumn("fp", F.lit("x"))
    shutil.rmtree(tmp_path / "documents.parquet", ignore_errors=True)
    (tmp_path / "documents.parquet").unlink(missing_ok=True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
