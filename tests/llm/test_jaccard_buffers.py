import tracemalloc

import numpy as np

from repflow.llm.jaccard import _by_bucket


def _unpacked(rows):
    for x, planes, names, local in rows:
        p = np.frombuffer(planes, np.uint8).reshape(6, -1)
        wide = np.zeros((p.shape[1], 8), np.uint8)
        wide[:, :6] = p.T
        yield from ((x, int(t), int(names[i])) for t, i in zip(wide.view(np.uint64).ravel(), np.frombuffer(local, "<u2")))


def test_every_token_of_every_text_in_its_bucket():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 1 << 48, n, dtype=np.uint64) for n in (5, 1, 40, 7)] + [np.array([9, 10], np.uint64)]
    names = [0, 3, 59_999, 8, 9]
    want = sorted((int(t) % 7, int(t), d) for ts, d in zip(texts, names) for t in ts)
    assert sorted(_unpacked(_by_bucket(list(zip(texts, names)), 7))) == want
    assert list(_by_bucket([], 7)) == []


def test_bytes_held_for_a_token():
    rng = np.random.default_rng(4)
    tracemalloc.start()
    own = [(rng.integers(0, 1 << 48, 4_000, dtype=np.uint64), i) for i in range(250)]      # a million tokens, 8 bytes each
    tracemalloc.reset_peak()
    for _ in _by_bucket(own, 500):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * 1_000_000              # 64 with wide arrays held all at once


def test_small_tables_are_not_written_in_a_file_for_each_partition(spark, odd_docs, monkeypatch):
    from pathlib import Path

    from repflow.llm import jaccard, tables

    paths = []
    monkeypatch.setattr(tables, "scratch", lambda s, name, made=tables.scratch: paths.append(made(s, name)) or paths[-1])
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(odd_docs).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert (9, 8) in got and (14, 13) in got
    files = [len(list(Path(p.removeprefix("file:")).glob("part-*"))) for p in paths]
    assert len(files) > 8 and max(files) <= max(spark.sparkContext.defaultParallelism, odd_docs.rdd.getNumPartitions())
