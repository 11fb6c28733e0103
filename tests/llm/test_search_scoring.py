import math
import random
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from repflow.llm import jaccard as J
from repflow.llm.ann import chi2_quantile, nearest
from repflow.llm.ctw import _summed, grams_of, lgamma, score_texts, stream, subtree
from repflow.llm.jaccard import jaccard_components
from .brute import base_scores, components
from .conftest import mod


def _joined(df, **kw):
    return Counter(tuple(r) for r in jaccard_components(df, **kw).select("doc_id", "n_shingles", "component_id").collect())


def test_jaccard_join_equals_brute_force(spark, small, odd_docs, no_docs):
    for df in (small, odd_docs):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        assert _joined(df) == Counter(components(rows))
    assert _joined(no_docs) == Counter()


def test_jaccard_join_of_chains_hot_groups_and_shared_passages(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(40)]
    base = [rnd.choice(vocab) for _ in range(60)]
    texts = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(60)] = f"edit{rnd.randrange(10_000)}"
        texts.append(" ".join(w))
    chain = [f"c{i}" for i in range(80)]
    for i in range(12):                        # each links with the next, the ends do not
        texts.append(" ".join(chain[2 * i:2 * i + 50]))
    for i in range(80):                        # a shared passage with few words of their own
        texts.append(" ".join(passage + [rnd.choice(vocab) for _ in range(rnd.randint(0, 12))]))
    rnd.shuffle(texts)
    rows = list(enumerate(texts + texts[:20]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    want = Counter(components(rows))
    assert _joined(df) == want
    assert _joined(df, frequent=2, heavy_share=0.9) == want          # token combinations, no heavy token
    assert _joined(df, frequent=2, heavy_share=0.01) == want


def test_verification_grid_gives_the_same_links(spark, small, monkeypatch):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    monkeypatch.setattr(J, "PAIRS_PER_BLOCK", 3)
    assert _joined(small) == Counter(components(rows))


def _nearest_brute(rows, every, k):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    return {q: sorted((math.dist(v, w), i) for i, w in ok if i != q and len(w) == len(v))[:k] for q, v in ok if q % every == 0}


def test_nearest_on_odd_vectors(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, [1.0] * 6) for i in range(40)] + [(300, None), (301, [0.0] * 6), (302, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (310, [float("nan")] * 6), (320, [float("inf")] + [1.0] * 5), (None, [2.0] * 6), (330, [1.0, 2.0]), (331, [1.0, 2.5]), (340, [])]
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id bigint, embedding array<double>, label int, score double")
    for kw in ({}, {"block_rows": 25, "query_rows": 3}):
        got = {}
        for r in nearest(df, 10, k=4, confidence=0.999999, **kw).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        want = _nearest_brute(rows, 10, 4)
        assert set(got) == {q for q, v in want.items() if v}
        for q, v in got.items():
            v.sort()
            assert [x[0] for x in v] == list(range(1, len(v) + 1))
            assert [x[1] for x in v] == [i for _, i in want[q]] and np.allclose([x[2] for x in v], [d for d, _ in want[q]])
    assert nearest(df.limit(0), 10).count() == 0


def test_nearest_with_repeated_rows(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(60)] + [(100 + i, [1.0, 0.0, 2.0, 1.0, 1.0, 1.0]) for i in range(14)]
    odd = [(201, [1.0, -0.0, 2.0, 1.0, 1.0, 1.0]), (202, [3.0, 0.0, 2.0, 1.0, 1.0, 1.0]), (202, [-1.0, 0.0, 2.0, 1.0, 1.0, 1.0])]     # 202 twice at one distance
    want = {q: sorted(set(_nearest_brute(rows + odd, 10, 99)[q]))[:10] for q in _nearest_brute(rows + odd, 10, 1)}
    for times in (2, 20):
        df = spark.createDataFrame([r for r in rows for _ in range(times if r[0] % 3 else 1)] + odd * times, "vec_id bigint, embedding array<double>").repartition(5)
        for kw in ({}, {"block_rows": 25, "query_rows": 3}):
            got = {}
            for r in nearest(df, 10, confidence=0.999999, **kw).collect():
                got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
            assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}


def test_nearest_recall_with_production_parameters(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    want = _nearest_brute(rows, 100, 10)
    got = {}
    for r in nearest(df, 100).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {i for _, i in v}) / 10 for q, v in want.items()]) >= 0.9


def test_chi_square_quantile():
    assert abs(chi2_quantile(0.95, 8) - 15.507) < 1e-3 and abs(chi2_quantile(0.5, 2) - 1.3863) < 1e-3


def test_lgamma():
    x = np.array([0.5, 1.0, 1.5, 3.25, 17.0, 1e3, 1e7])
    assert np.allclose(lgamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-10)


def _ctw_prob(history, symbols, depth):
    """Mixed probability of every symbol after ``history`` by direct recursion; ``symbols``: the training stream."""
    def counts(ctx, prefix, k):
        n = [0, 0]
        for i, s in enumerate(symbols):
            back = bytes(reversed(symbols[max(0, i - len(ctx)):i])) + b"\0" * max(0, len(ctx) - i)
            if back == ctx and s >> (8 - k) == prefix:
                n[(s >> (7 - k)) & 1] += 1
        return n

    def kt(n0, n1):
        return math.lgamma(n0 + .5) + math.lgamma(n1 + .5) - math.lgamma(n0 + n1 + 1) - math.log(math.pi)

    def log_w(ctx, prefix, k):
        n0, n1 = counts(ctx, prefix, k)
        if len(ctx) == depth:
            return kt(n0, n1)
        kids = sum(log_w(ctx + bytes([c]), prefix, k) for c in set(symbols) | {0} if sum(counts(ctx + bytes([c]), prefix, k)))
        return np.logaddexp(kt(n0, n1), kids) - math.log(2)

    out = []
    full = bytes(reversed(history[-depth:])) + b"\0" * max(0, depth - len(history))
    for s in range(256):
        p = 1.0
        for k in range(8):
            prefix, bit, q = s >> (8 - k), (s >> (7 - k)) & 1, None
            for d in range(depth, -1, -1):
                n = counts(full[:d], prefix, k)
                if not sum(n):
                    continue
                e = (n[bit] + .5) / (sum(n) + 1)
                if q is None or d == depth:
                    q = e
                else:
                    stop = math.exp(kt(*n) - math.log(2) - log_w(full[:d], prefix, k))
                    q = stop * e + (1 - stop) * q
            p *= 0.5 if q is None else q
        out.append(p)
    return out


def test_context_tree_weighting_matches_direct_recursion():
    text = b"abab ba "
    sym = np.frombuffer(text, np.uint8)
    g = grams_of(sym, np.array([0]), 2)
    u, n = np.unique(g, return_counts=True)
    history = b"ab"
    asked = np.array([s | history[1] << 8 | history[0] << 16 for s in range(256)], np.uint64)
    keys = np.union1d(u, asked)
    counts = np.zeros(len(keys))
    counts[np.searchsorted(keys, u)] = n
    mixed, _ = subtree(keys, counts, 2, 0)
    got = np.where(np.isnan(mixed), 0.5, mixed).prod(1)[np.searchsorted(keys, asked)]
    assert np.allclose(got, _ctw_prob(history, text, 2)) and abs(got.sum() - 1) < 1e-9


def test_stream_and_grams_of_texts_and_the_bytes_they_hold():
    import pyarrow as pa

    from repflow.llm.textkernel import utf8, words

    for texts in (["", "a", " Ab  cd\té ", "x", "", "QQQQQQQQQ z"], ["", ""], ["b"], []):
        buf, off = utf8(pa.array(texts, pa.string()))
        symbols, begin = stream(buf, *words(buf, off))
        want = [b"".join(w + b" " for w in t.encode().lower().split()) + b"\n" for t in texts]
        assert symbols.tobytes() == b"".join(want) and begin.tolist() == [sum(map(len, want[:i])) for i in range(len(want))]
        for depth in range(2, 8):
            grams = [sum(x[i - k] << 8 * k for k in range(min(i, depth) + 1)) for x in want for i in range(len(x))]
            assert grams_of(symbols, begin, depth).tolist() == grams
    key, n = _summed(np.array([3, 5, 3, 9, 5], np.uint64), np.array([1, 0, 2, 4, 8]))
    assert key.tolist() == [3, 5, 9] and n.tolist() == [3, 8, 4]
    buf, off = utf8(pa.array(["some words of a text " * 25_000]))
    at = words(buf, off)
    tracemalloc.start()
    grams_of(*stream(buf, *at), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 33 * len(buf)               # 41 with a place in 8 bytes for every byte


def test_scores_match_counts_on_both_paths(small, odd_docs, no_docs):
    import zlib

    for df in (small, odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        want = base_scores(rows, lambda d: zlib.crc32(str(d).encode()) % 7 != 2)
        got = {r.doc_id: r for r in score_texts(df, mod(7, 2)).collect()}
        other = {r.doc_id: r.score for r in score_texts(df, mod(7, 2), max_shared=0, chunk_bytes=50_000).collect()}
        assert set(got) == set(want)
        for d, (n, known, total, base) in want.items():
            r = got[d]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9)
            assert r.score < 0 and math.isclose(r.score, other[d], rel_tol=1e-9)
    assert score_texts(odd_docs, mod(7, 2)).count() == odd_docs.count()
    assert score_texts(no_docs, mod(7, 2)).count() == 0
    everything_held = score_texts(small, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens) for r in everything_held} == {(0, 0)}


def test_held_out_texts_score_better_than_word_counts(mid):
    r = score_texts(mid, mod(7, 2)).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]
