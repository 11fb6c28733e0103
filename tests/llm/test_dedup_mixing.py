import hashlib
from collections import Counter, defaultdict

import pytest

from repflow.llm.dedup import exact_dedup
from repflow.llm.mixing import mix_sources, mixed_documents
from .brute import LOW, WORD


def _groups(rows, best):
    g = defaultdict(list)
    for d, t in rows:
        g[hashlib.sha256((t or "").translate(LOW).encode()).hexdigest()].append(d)
    out = []
    for h, ids in g.items():
        known = [i for i in ids if i is not None]
        keep = best(known) if known else None
        out += [(i, keep, len(ids), i == keep, h) for i in ids]
    return Counter(out)


@pytest.mark.parametrize("keep,best", [("largest", max), ("smallest", min)])
def test_exact_dedup_of_odd_rows(odd_docs, keep, best):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = exact_dedup(odd_docs.repartition(5), keep=keep, fan=2).collect()
    assert Counter(tuple(r) for r in got) == _groups(rows, best)


def test_exact_dedup_of_one_hot_text(spark):
    rows = [(i, "Same text" if i % 3 else f"text {i // 30}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(13)
    assert Counter(tuple(r) for r in exact_dedup(df, fan=3).collect()) == _groups(rows, max)


def test_empty_tables(no_docs):
    assert exact_dedup(no_docs).count() == 0 and mix_sources(no_docs).count() == 0 and mixed_documents(no_docs).count() == 0


def test_exact_dedup_rejects_unknown_rule(no_docs):
    with pytest.raises(ValueError):
        exact_dedup(no_docs, keep="first")


def _targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, clamped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in clamped)
        free = sum(w[s] for s in sizes if s not in clamped)
        new = {s for s in sizes if s not in clamped and w[s] * left > most * sizes[s] * free}
        if not new:
            return {s: most * sizes[s] if s in clamped else w[s] * left / free for s in sizes}
        clamped |= new


def _check_mix(df):
    got = mix_sources(df).collect()
    src = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in df.collect()]
    sizes = Counter()
    for _, s, n in src:
        sizes[s] += n
    want = _targets(sizes)
    by_source = {s: [x for x in src if x[1] == s] for s in sizes}
    for s, rows in by_source.items():
        ids = Counter((d, n) for d, _, n in rows)
        own = [r for r in got if (r.doc_id, r.size) in ids and r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6]
        assert len(own) >= len(rows)
    assert all(0 <= r.copies <= 3 and r.taken == r.size * r.copies for r in got)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, n) for d, _, n in src)
    return got, sizes, want


def test_mix_of_odd_rows_and_targets(odd_docs, mid):
    _check_mix(odd_docs)
    df = mid.limit(3000)
    got, sizes, want = _check_mix(df)
    source = {r.doc_id: r.source for r in df.collect()}
    taken = Counter()
    for r in got:
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] + 20 for s in sizes)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mix_sources(df.repartition(7)).collect()))


def test_mixed_documents_repeat_rows_as_planned(small):
    want = {r.doc_id: r.copies for r in mix_sources(small).collect() if r.copies}
    mixed = mixed_documents(small)
    assert mixed.columns == small.columns
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == Counter(want)


def test_no_task_of_the_dedup_needs_two_python_workers(odd_docs):
    import re

    from repflow.llm.dedup import exact_dedup as dedup

    plan = dedup(odd_docs)._jdf.queryExecution().sparkPlan().toString()
    lines = [re.sub(r"^[\s:+|-]*", "", x) for x in plan.splitlines()]
    assert any(x.startswith("MapInArrow") for x in lines)
    for a, b in zip(lines, lines[1:]):
        if a.startswith("MapInArrow"):
            after = next(x for x in lines[lines.index(a) + 1:] if not x.startswith(("Project", "*")))
            assert not after.startswith("MapInArrow") and not b.startswith("MapInArrow")
