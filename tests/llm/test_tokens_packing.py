import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from repflow.llm.encode import Encoder, vocabulary
from repflow.llm.packing import best_cuts, pack
from repflow.llm.textkernel import utf8
from repflow.llm.tokenbin import KEY, Shard, build_index, find_slots, key_hash, to_bytes, token_shards

ODD = ["", None, "  a  b \n c\t d\n\n e", "it's 'S don't  '' we'll\n'll x", "\n\n a", "   ", "<|endoftext|> a <|endoftext|>b <|STARTOFTEXT|>",
       "中文 字 a。b\nc", "a\n\nb\nc \n d", "x   y  z\n a", "\r\n a\r\nb \x1c c \x85 d", "ΑΣ ΑΣ a İ I", "a |b | c |", "x, y; z:a b,c .d ,e f|endoftext|>g",
       "a élan\nß, ÿ; ×, a×, ÷. é́, é", "мир, труд\nмай 字 字, αβγ, δ ŝ, ŝ", "Ü, é. ñ! x , y　.  z", "É é", "UPPER!! CASE!! Words,and.more?yes:no;ok", "tab\tsep\vvert\fform", "x" * 5000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library_on_whole_texts(mid, name):
    texts = ODD + [r.text for r in mid.select("text").limit(400).collect()] + ODD
    import pyarrow as pa

    buf, off = utf8(pa.array(texts, pa.string()))
    enc = Encoder(vocabulary(name))
    for _ in range(2):                       # fresh, then from the table
        ids, starts, first = enc.encode(buf, off)
        at = first[np.searchsorted(starts, off)]
        got = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
        assert got == [e.ids for e in enc.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_go_to_the_model_and_the_rest_to_the_whole_tokenizer(name):
    import pyarrow as pa

    texts = [f"start élan{i % 7} ünder stone{'abcdefgh'[i % 8]} œuvre ñandú naïve$$$ word### 100% a*b cost$5 ÉCOLE ß ÿ Ÿ ×a÷ ét" for i in range(40)]
    enc, given = Encoder(vocabulary(name)), []
    whole = enc._ids
    enc._ids = lambda xs: given.extend(xs) or whole(xs)
    buf, off = utf8(pa.array(texts, pa.string()))
    ids, starts, first = enc.encode(buf, off)
    at = first[np.searchsorted(starts, off)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert given and not any(w in x for w in (" ünder", " stonea", " ñandú", " naïve", " word") for x in given)


def _least(places, penalty, size):
    f = [0.0] + [float("inf")] * (len(places) - 1)
    for j in range(1, len(places)):
        f[j] = min(f[i] + size - (places[j] - places[i]) + penalty[j] for i in range(j) if places[j] - places[i] <= size)
    return f[-1]


def test_cuts_cost_least():
    rng = np.random.default_rng(8)
    for _ in range(60):
        places = np.concatenate([[0], np.cumsum(rng.integers(1, 30, rng.integers(1, 40)))])
        penalty = rng.choice([0.0, 4.0, 12.0], len(places))
        cuts = best_cuts(places, penalty, 40)
        cost = sum(40 - (places[b] - places[a]) + penalty[b] for a, b in zip(cuts[:-1], cuts[1:]))
        assert cuts[0] == 0 and cuts[-1] == len(places) - 1 and abs(cost - _least(places, penalty, 40)) < 1e-9
        assert all(places[b] - places[a] <= 40 for a, b in zip(cuts[:-1], cuts[1:]))


def _pieces(df, **kw):
    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = df.collect()
    got = pack(df, **kw).collect()
    by_doc = defaultdict(list)
    for p in got:
        by_doc[p.doc_id].append(p)
    texts = defaultdict(list)
    for r in rows:
        texts[r.doc_id].append(t.encode(r.text or "", add_special_tokens=False).ids + [1])
    assert set(by_doc) == set(texts)
    for d, docs in texts.items():
        if len(docs) == 1:
            at, ids = 0, np.array(docs[0], "<u4")
            for p in sorted(by_doc[d], key=lambda p: p.start):
                assert (p.start, p.doc_tokens) == (at, len(ids)) and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
                at += p.length
            assert at == len(ids)
        else:
            assert sum(p.length for p in by_doc[d]) == sum(map(len, docs))
    seqs = defaultdict(list)
    for p in got:
        seqs[p.sequence_id].append((p.offset, p.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= kw.get("size", 2048)
    return sum(p.length for p in got), len(seqs)


def test_packing_covers_every_id_with_little_padding(mid, odd_docs, no_docs):
    n, seqs = _pieces(mid.limit(600).select("doc_id", "text"), shards=2)
    assert 1 - n / (2048 * seqs) < 0.02
    _pieces(odd_docs)
    _pieces(odd_docs, size=64, shards=3)
    assert pack(no_docs).count() == 0


def test_perfect_hash_fills_every_slot_once():
    for n in (0, 1, 2, 63, 1000, 20_000):
        keys = np.zeros(n, KEY)
        keys["id"] = np.arange(n) * 7 - 5
        h = key_hash(keys)
        assert sorted(find_slots(h, *build_index(h)).tolist()) == list(range(n))


def test_equal_hashes_end_and_get_another_seed(monkeypatch):
    from repflow.llm import tokenbin

    with pytest.raises(ValueError):
        build_index(np.array([7, 7, 9], np.uint64))
    keys = np.zeros(50, KEY)
    keys["id"] = np.arange(50)

    def clashing(k, seed=0):                     # the first seed takes keys 3 and 4 for one
        h = key_hash(k, seed)
        return np.where(k["id"] == 4, key_hash(np.array([(3, 0, 0)], KEY), 0), h) if seed == 0 else h

    monkeypatch.setattr(tokenbin, "key_hash", clashing)
    shard = Shard(to_bytes(keys, np.ones(50, np.int64), np.arange(50), 2))
    found, first, n = shard.get(keys)
    assert shard.seed == 1 and found.all() and first.tolist() == list(range(50)) and (n == 1).all()


def test_shard_lookup_and_foreign_keys():
    keys = np.array([(5, 0, 0), (5, 0, 1), (0, 1, 0), (0, 0, 0), (-9, 0, 0)], KEY)
    counts = np.array([2, 1, 1, 3, 1])
    shard = Shard(to_bytes(keys, counts, np.arange(8), 2))
    found, first, n = shard.get(keys)
    assert found.all() and first.tolist() == [0, 2, 3, 4, 7] and n.tolist() == counts.tolist()
    other = np.zeros(5000, KEY)
    other["id"] = np.arange(100, 5100)
    assert not shard.get(other)[0].any()
    with pytest.raises(ValueError):
        Shard(b"\0" * 100)


@pytest.mark.parametrize("shard_ids", [300, 4_000_000])
def test_token_shards_round_trip(odd_docs, no_docs, shard_ids):
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = sorted((tuple(r) for r in token_shards(odd_docs, shard_ids=shard_ids, shards=3).collect()), key=lambda r: r[1])
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "", r.doc_id) for r in odd_docs.collect()))
    at, want = 0, []
    for *_, text, d in rows:
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [2], "<u4")
        want.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert token_shards(no_docs).count() == 0


def test_pieces_do_not_depend_on_how_many_tasks_run_the_shards(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text")
    apart, together = pack(docs, shards=5).collect(), pack(docs, shards=5).coalesce(1).collect()
    assert sorted(map(str, apart)) == sorted(map(str, together))
    assert len({r.sequence_id for r in together}) == len({(r.sequence_id, 0) for r in together if r.offset == 0}) == sum(r.offset == 0 for r in together)
