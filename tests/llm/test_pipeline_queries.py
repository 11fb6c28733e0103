import os
import subprocess
import sys
from collections import Counter

import corpus_pipeline
from repflow.llm.queries import ORACLE, QUERIES
from .brute import LOW, components

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_every_dealt_operator_is_registered():
    assert [n.split("_")[0] for n in sorted((q for q in QUERIES if q != "pipeline"), key=lambda q: int(q[2:].split("_")[0]))] == [
        f"op{i}" for i in range(1, 14)]
    assert "pipeline" in QUERIES and set(ORACLE) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard", "mix_sources", "pack_sequences"]


def _stage(spark, name, df, path):
    dict(corpus_pipeline.STAGES)[name](spark, df, "/root/testdata/sf0.001").write.parquet(path)
    return spark.read.parquet(path)


def test_filter_stages_against_brute_force(spark, small, tmp_path):
    a = _stage(spark, "language_id", small, str(tmp_path / "a"))
    assert a.columns == small.columns and a.count() == small.where(small.text.rlike(r"\p{L}")).count()
    b = _stage(spark, "exact_dedup", a, str(tmp_path / "b"))
    rows = {r.doc_id: r.text for r in a.collect()}
    last = {}
    for d in sorted(rows):
        last[rows[d].translate(LOW)] = d
    assert {r.doc_id for r in b.collect()} == set(last.values())
    c = _stage(spark, "ngram_jaccard", b, str(tmp_path / "c"))
    want = {comp for _, _, comp in components([(r.doc_id, r.text) for r in b.collect()])}
    assert Counter(r.doc_id for r in c.collect()) == Counter(want) and c.columns == small.columns


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    for k, df in enumerate((odd_docs, no_docs)):
        for name, _ in corpus_pipeline.STAGES:
            out = _stage(spark, name, df, str(tmp_path / f"{k}-{name}"))
            assert name == "pack_sequences" or out.columns == df.columns
            df = out if name != "pack_sequences" else df
    assert out.count() == 0


def test_stages_write_as_many_files_as_their_texts_ask_for(spark, odd_docs, tmp_path):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    docs = odd_docs.unionByName(odd_docs.withColumn("doc_id", odd_docs.doc_id + 100)).repartition(60).localCheckpoint()
    try:
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, "").write.parquet(str(tmp_path / name))
            assert len(list((tmp_path / name).glob("part-*"))) <= spark.sparkContext.defaultParallelism, name
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_the_rest_imports_without_this_package(tmp_path):
    for name in ("repflow", "__spark_entry__.py"):
        os.symlink(os.path.join(ROOT, name), tmp_path / name) if name.endswith(".py") else None
    os.makedirs(tmp_path / "repflow")
    for name in os.listdir(os.path.join(ROOT, "repflow")):
        if name != "llm":
            os.symlink(os.path.join(ROOT, "repflow", name), tmp_path / "repflow" / name)
    code = ("import sys; sys.path.insert(0, '.'); exec(open('__spark_entry__.py').read().replace('__file__', \"'./x'\")); "
            "q = queries(); assert q and not any(n.startswith('op') and n[2:3].isdigit() for n in q) and 'pipeline' not in q")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})
