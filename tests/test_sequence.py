import random

import pytest
from pyspark.sql import functions as F

from brute import bulk_hits, six_frames
from repflow.operators import sequence as seq

# hand-written edge reads: null, empty, lengths 1-5, N inside, lower case,
# a pattern twice, nested patterns, a pattern across a stop, RNA
EDGE_READS = [
    ("r_null", None, 1), ("r_empty", "", 1), ("r1", "A", 1), ("r2", "AT", 2), ("r3", "ATG", 3),
    ("r4", "ATGC", 4), ("r5", "ATGCC", 5), ("rN", "ATGNNNTGGTGGTGG", 1), ("rlow", "atgtggtggtggtaa", 2),
    ("rtwice", "TGGTGGAAATGGTGG", 1), ("rnest", "ATGTGGTGGTGGTGG", None), ("rstop", "TGGTAATGG", 1),
    ("rrna", "AUGUGGUGGUGG", 1), ("rbad", "ATGXTGG", 1), (None, "TGGTGGTGG", 7),
]
PATTERNS = ["WW", "WWW", "MWW", "W", "K", "W*W", "", None, "ww", "MW", "CHP", "PP", "HH", "GG"]


def _spark_hits(spark, reads, patterns, engine="arrow"):
    r = spark.createDataFrame(reads, "read_id string, sequence string, count bigint")
    p = spark.createDataFrame([(x,) for x in patterns], "`CDR3.aa` string")
    idx = seq.index_patterns(p, "CDR3.aa")
    fr = seq.frames(r, keep=["read_id", "count"], engine=engine)
    h = seq.find_occurrences(fr, idx)
    out = h.select(seq._frame_id("read_id").alias("read_id"), "CDR3_match", "count").collect()
    return sorted([tuple(x) for x in out], key=lambda t: (t[0], t[1], -1 if t[2] is None else t[2]))


@pytest.mark.parametrize("engine", ["arrow", "native"])
def test_edge_reads_match_brute_force(spark, engine):
    assert _spark_hits(spark, EDGE_READS, PATTERNS, engine) == bulk_hits(EDGE_READS, PATTERNS)


def test_match_bulk_schema_with_and_without_count(spark):
    p = spark.createDataFrame([("WW",)], "`CDR3.aa` string")
    with_c = spark.createDataFrame([("a", "TGGTGG", 3)], "read_id string, sequence string, count bigint")
    no_c = with_c.drop("count")
    assert seq.match_bulk(with_c, p).columns == ["read_id", "CDR3_match", "count"]
    assert seq.match_bulk(no_c, p).columns == ["read_id", "CDR3_match"]
    assert seq.match_bulk(no_c, p).collect()[0]["read_id"] == "a|+0"


def test_missing_column_raises(spark):
    r = spark.createDataFrame([("a", "TGG")], "id string, seq string")
    p = spark.createDataFrame([("W",)], "`CDR3.aa` string")
    with pytest.raises(ValueError, match="available"):
        seq.match_bulk(r, p)


def test_frames_engines_agree_and_strands_swap(spark):
    rnd = random.Random(7)
    reads = [(f"r{i}", "".join(rnd.choice("ACGTN") for _ in range(rnd.randint(0, 40)))) for i in range(200)]
    df = spark.createDataFrame(reads, "read_id string, sequence string")
    a = sorted(tuple(r) for r in seq.frames(df, keep=["read_id"], engine="arrow").collect())
    n = sorted(tuple(r) for r in seq.frames(df, keep=["read_id"], engine="native").collect())
    assert a == n
    expect = sorted((rid, s, f, p) for rid, sq in reads for s, f, p in six_frames(sq))
    assert a == expect
    # reverse complement of a read swaps its strands
    comp = {"A": "T", "C": "G", "G": "C", "T": "A", "N": "N"}
    rc = [(rid, "".join(comp[b] for b in reversed(sq))) for rid, sq in reads]
    b = seq.frames(spark.createDataFrame(rc, "read_id string, sequence string"), keep=["read_id"]).collect()
    swapped = sorted((r["read_id"], "-" if r["strand"] == "+" else "+", r["frame"], r["protein"]) for r in b)
    assert swapped == a


def test_random_reads_short_and_long_patterns(spark):
    rnd = random.Random(11)
    reads = [(f"r{i}", "".join(rnd.choice("ACGT") for _ in range(rnd.randint(0, 60))), i % 3) for i in range(150)]
    prots = [p for _, s, _ in reads for _, _, p in six_frames(s)]
    pats = set()
    for p in prots[:300]:
        if len(p) >= 2:
            i = rnd.randrange(len(p))
            pats.add(p[i:i + rnd.randint(1, 7)])
    pats = sorted(pats)
    assert _spark_hits(spark, reads, pats) == bulk_hits(reads, pats)


def test_empty_pattern_db_gives_typed_empty_result(spark):
    r = spark.createDataFrame([("a", "TGGTGG", 1)], "read_id string, sequence string, count bigint")
    p = spark.createDataFrame([], "`CDR3.aa` string")
    out = seq.match_bulk(r, p)
    assert out.count() == 0 and out.columns == ["read_id", "CDR3_match", "count"]


@pytest.mark.parametrize("head_len", [2, 3, 4])
def test_shuffle_path_and_head_lengths_agree(spark, head_len):
    rnd = random.Random(23)
    reads = [(f"r{i}", "".join(rnd.choice("ACGT") for _ in range(rnd.randint(10, 50))), 1) for i in range(80)]
    prots = [p for _, s, _ in reads for _, _, p in six_frames(s)]
    pats = sorted({p[i:i + rnd.randint(1, 6)] for p in prots[:120] if p for i in [rnd.randrange(len(p))]})
    r = spark.createDataFrame(reads, "read_id string, sequence string, count bigint")
    p = spark.createDataFrame([(x,) for x in pats], "`CDR3.aa` string")
    idx = seq.index_patterns(p, "CDR3.aa", head_len=head_len, broadcast_max_bytes=0)   # force the shuffle join
    assert not idx.broadcast_patterns
    h = seq.find_occurrences(seq.frames(r, keep=["read_id", "count"]), idx)
    got = sorted(tuple(x) for x in h.select(seq._frame_id("read_id").alias("read_id"), "CDR3_match", "count").collect())
    assert got == bulk_hits(reads, pats)


def test_filter_holds_every_member_and_few_others(spark):
    import numpy as np

    from repflow.functions.bloom import RollingHash, build_filter, passes

    rng = np.random.default_rng(1)
    words = {"".join(rng.choice(list("ACDEFGHIKLMNPQRSTVWY"), rng.integers(5, 14))) for _ in range(5000)}
    bloom = build_filter(spark.createDataFrame([(w,) for w in words], "pattern string"), "pattern", len(words))

    def share(strings):
        text = np.frombuffer("".join(strings).encode(), np.uint8)
        n = np.array([len(s) for s in strings])
        return passes(RollingHash(text).of(np.cumsum(n) - n, n), bloom).mean()

    assert share(sorted(words)) == 1.0
    others = {"".join(rng.choice(list("ACDEFGHIKLMNPQRSTVWY"), 9)) for _ in range(20_000)} - words
    assert share(sorted(others)) < 0.03


def test_search_with_the_filter_equals_search_without(spark):
    import random

    rnd = random.Random(4)
    letters = "ACDEFG"
    pats = [("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 12))),) for _ in range(3000)]
    proteins = [(i, "".join(rnd.choice(letters + "*") for _ in range(rnd.randint(0, 200)))) for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(proteins, "id int, protein string")
    patterns = spark.createDataFrame(pats, "pattern string")
    plain, filtered = (seq.index_patterns(patterns, bloom_min=n) for n in (10**9, 1))
    got = [sorted((r["id"], r["pos"], r["CDR3_match"]) for r in seq.find_occurrences(df, i).collect()) for i in (plain, filtered)]
    want = sorted((i, k + 1, p) for i, t in proteins if t for p in {x[0] for x in pats} for k in range(len(t)) if t.startswith(p, k))
    assert got[0] == got[1] == want and plain.tables.value[4] is None and filtered.tables.value[4] is not None
    # windows that reach the join: the hits and few others
    windows = 0
    for _, t in proteins:
        if t:
            import numpy as np
            text = np.frombuffer(t.encode(), np.uint8)
            windows += sum(len(s) for s, _ in seq._windows(text, np.array([0, len(text)]), filtered.head_len, filtered.tables.value))
    assert len(want) <= windows <= 1.05 * len(want) + 50
