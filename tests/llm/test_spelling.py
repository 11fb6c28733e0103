import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from repflow.llm.queries import ORACLE, QUERIES
from repflow.llm.spelling import checksums, group_variants, near_pairs, spelling_variants, word_counts
from tests.llm.brute import LOW

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(rows, every=199, least_length=6, least_count=5):
    count = Counter()
    for d, t in rows:
        for run in RUN.findall(t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= least_length and n >= least_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(words, factor=5):
    links = {w: [] for w in words}
    by_cut = {}
    for w in words:                       # words that share a deletion neighbour or are one are the only candidates
        for c in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            by_cut.setdefault(c, set()).add(w)
    for group in by_cut.values():
        for a in group:
            links[a] += [b for b in group if near(a, b)]
    form, out = {}, {}
    for w, other in links.items():
        other = sorted(set(other), key=lambda o: (-words[o], o))
        links[w] = other
        form[w] = other[0] if other and words[other[0]] >= factor * words[w] else None
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(links[w]), words[form[w]] if form[w] else None)
    return out


def _got(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_checksums_equal_zlib():
    rng = np.random.default_rng(1)
    buf = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = np.sort(rng.choice(4000, 200, replace=False))
    ends = np.minimum(np.append(starts[1:], 5000), starts + rng.integers(1, 90, 200))
    state = rng.integers(0, 2**32, 200).astype(np.uint32)
    want = [zlib.crc32(buf[s:e].tobytes(), int(c)) for s, e, c in zip(starts, ends, state)]
    assert checksums(buf, starts, ends, state).tolist() == want


def test_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    words = {"".join(rng.choice(list("abé"), rng.integers(1, 9))) for _ in range(900)} | {"aaaaaa", "aaaaaaa", "z" * 400, "z" * 401, "y" + "z" * 400, "z" * 399 + "y", "z" * 200 + "xz" + "z" * 200, "z" * 200 + "xy" + "z" * 200}
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = [(r.x, r.y) for r in near_pairs(df).collect()]
    want = {frozenset((a, b)) for a in words for b in words if near(a, b)}
    assert len(got) == len(want) and {frozenset(p) for p in got} == want


def test_groups_chains_and_ties(spark):
    words = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "abcdxg": 125, "abcyxg": 625, "abzyxg": 3124, "lonely": 7, "lonelyy": 34}
    assert _got(group_variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute_groups(words)
    assert brute_groups(words)["abcdef"][:2] == ("abcdeg", "abcyxg")
    with pytest.raises(ValueError):
        group_variants(spark.createDataFrame([("a", 1)], "word string, n long"), factor=1)


def test_a_chunk_shared_by_all_words(spark):
    """Words with one common front: the halves of the rest keep them apart."""
    rng = np.random.default_rng(3)
    words = {"prefix" + "".join(rng.choice(list("abcdefgh"), 6)): int(rng.integers(5, 500)) for _ in range(3000)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert _got(group_variants(df)) == brute_groups(words)


def test_odd_input(spark, odd_docs, no_docs):
    words = "colour Colour ÉCOLE école cölour colou× naïveté×÷ " * 4
    rows = [(1, words), (1, words), (None, words), (2, None), (3, ""), (4, "- 12 中文 é"), (5, "a" * 200_000 + " x" * 10), (6, "a" * 200_000 + " colours" * 60),
            (7, ("a" * 200_000 + " ") * 3)] + [(i, "colour harbour harbours") for i in range(100, 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    words = brute_words(rows)
    assert any(len(w) == 5 + 6 or w == "harbor" or len(w) > 100 for w in words)
    assert {r.word: r.n for r in word_counts(df).collect()} == words
    assert _got(spelling_variants(df)) == brute_groups({w: n for w, n in words.items() if len(w) < 1000}) | {
        w: (None, w, n, 0, None) for w, n in words.items() if len(w) >= 1000}
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert {r.word: r.n for r in word_counts(odd_docs, least_count=1).collect()} == brute_words(odd, least_count=1)
    assert spelling_variants(no_docs).collect() == []


def test_query_equals_brute_force(spark):
    table = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{table}/documents.parquet").collect()]
    words = brute_words(rows)
    got = _got(QUERIES["op12_spelling_variants"](spark, table))
    assert got == brute_groups(words) and any(v[0] for v in got.values())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{table}/documents.parquet'")
    rows = con.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({ORACLE['op12_spelling_variants']})").fetchall()
    assert {r[0]: r[1:] for r in rows} == got
