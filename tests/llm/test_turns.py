import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from repflow.llm.queries import ORACLE, QUERIES
from repflow.llm.turns import chunk_nodes, conversation_trie, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def _key(row):
    role, text = row[2] or "", row[3] or ""
    return (row[1] is not None, row[1] or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16])


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=_key):
        own[r[0]].append((r[2] or "", r[3] or ""))
    seqs = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        seqs[c] = own.get(base, [])[:h] + t[h:] if rebuild else t
    members = defaultdict(list)
    for c, t in seqs.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0) + sum(saved[c] for c in children[node])
    out = []
    for node, m in members.items():
        ends = sorted(c for c in m if len(seqs[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def _got(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                   for r in df.collect()), key=lambda r: r[:2])


def _random(rng, n, words, most):
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(0, most))):
            rows.append((int(c), t, "user" if t % 2 else "assistant", str(rng.choice(words))))
    return rows


@pytest.mark.parametrize("cells", [1 << 20, 40, 1])
def test_random_conversations(spark, cells):
    rng = np.random.default_rng(cells)
    rows = _random(rng, 300, ["a", "bé", "ccc"], 9) + [(c, t, "user", "same") for c in range(1000, 1100) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    for rebuild in (True, False):
        assert _got(conversation_trie(df, rebuild=rebuild, cells=cells)) == brute(rows, rebuild)


def test_one_chunk_is_as_many():
    rng = np.random.default_rng(4)
    lens = rng.integers(0, 6, 50)
    raw = rng.integers(0, 2, (int(lens.sum()), 1)).astype(np.uint8).repeat(16, axis=1)
    open_, path, depth = chunk_nodes(raw, np.ones(len(raw), np.int64), lens, np.arange(50), 0)[:3]
    assert not all(open_) and {p for o, p in zip(open_, path) if o} == {0, 1} and max(depth) == lens.max()


def test_odd_input(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 2, "", "é" * 100_000), (None, 1, "user", "gone"), (2, 1, "user", ""),
            (3, None, "a", "b"), (3, None, "ab", ""), (-4, 1, "user", "neg"), (-5, 1, "user", "neg"), (0, 5, None, "base"), (0, 4, "r", None)]
    rows += [(7, t, "user", f"t{t % 3}") for t in range(3000)] + [(8, t, "user", f"t{t % 3}") for t in range(2990)]
    rows += [(c, t, "user", "hi") for c in range(20, 60) for t in range(c % 4)] + [(c, 0, "u", "one") for c in range(70, 90)]
    df = (spark.createDataFrame(rows, SCHEMA).withColumn("turns", F.lit("clash")).withColumn("depth", F.lit(1)).withColumn("ids", F.lit(None).cast("int")))
    assert _got(conversation_trie(df, rebuild=True)) == brute(rows)
    assert _got(conversation_trie(df)) == brute(rows, False)
    empty = df.limit(0)
    assert conversation_trie(empty, rebuild=True).collect() == [] and conversation_trie(empty).collect() == []


def test_only_turnless_conversations(spark):
    seqs = spark.createDataFrame([(3, []), (1, [])], "conv_id long, turns array<struct<id: binary, size: long>>")
    assert _got(prefix_trie(seqs)) == [(1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,3").hexdigest())]


def test_query_equals_sql_and_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    got = _got(QUERIES["op11_conversation_trie"](spark, folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    sql = con.execute(ORACLE["op11_conversation_trie"])
    names = [d[0] for d in sql.description]
    want = [dict(zip(names, r)) for r in sql.fetchall()]
    order = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert got == sorted((tuple(r[c] for c in order) for r in want), key=lambda r: r[:2])
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rows)
