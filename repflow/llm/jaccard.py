"""N-gram Jaccard join by token-combination prefixes.

Tokens are the distinct ``k``-word shingles of a text.  Sets with
``|x & y| >= t |x | y|`` share all but ``floor((1 - t) |x|)`` tokens of either, so they share one of the first
``floor((1 - t) |x|) + 1`` in any common order, and ``c`` of them when the prefix is ``c - 1`` longer.

1. Every text becomes its set's size and digest.  Equal sets are one class from here on.
   The same scan counts very frequent tokens (lossy counts: a token in ``heavy_share`` of the texts is surely found).
2. Common order: by growing frequency in the classes, the heavy tokens last.  Tokens are dealt by hash,
   packed, to buckets of bounded size that find those shared by two or more
   classes; a class whose unshared tokens alone exceed the allowed
   difference has no partner and drops out.  The others keep their extended prefixes.
   The numbers of shared tokens per frequency class bound the overlap of a pair.
3. Within each token's list the members are verified against the list's most
   central one; verified links give first components.  Only pairs that
   could still join two components are candidates from then on.
4. Rare tokens are indexed singly.  Tokens of the frequent class (lists longer than
   ``frequent`` that still hold several components) are met in combinations
   of two, of which linked sets share one in their extended prefixes: the larger token is the
   join key and carries the smaller ones; a condition on each pair of its list leaves a pair
   once, in its smallest shared combination.
5. Candidates of fitting size are verified on the whole shingle sets of the
   texts themselves.  Components come from label propagation with pointer jumps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repflow.llm.tables import even, n_slices, stored
from repflow.llm.textkernel import runs, set_digest, shingle_sets, utf8

TOKENS_PER_BUCKET = 2_000_000
TOKENS_PER_FILE = 8_000_000              # of all sets' tokens, for a file of any stored table
ROWS_PER_FILE = 200_000                  # of all texts, for a file of a table with a few rows a text
FLUSH, FLUSH_TEXTS = 2_000_000, 60_000
HEAVY = (1 << 31) - 1
CLASS_ENDS = (2, 8, 32, 128)             # frequency classes of shared tokens; above these one more, and the heavy tokens
CLASSES = len(CLASS_ENDS) + 2
PAIRS_PER_BLOCK, BYTES_PER_SIDE = 20_000, 32 << 20


def _digest(s: np.ndarray) -> int:
    return int.from_bytes(set_digest(s)[:8], "little", signed=True)


def summaries(docs: DataFrame, k: int, heavy_share: float) -> DataFrame:
    """Rows ``(kind, id, d, n)``: 0 a text's id, digest and set size; 1 a token ``d`` and its count in one run of texts."""
    def summarise(batches):
        for b in batches:
            buf, off = utf8(b.column("text"))
            for i, j in runs(off):
                sets = shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], k)
                ds = [_digest(s) for s in sets]
                once = [sets[x] for x in dict(zip(ds, range(j - i))).values()]
                u, c = np.unique(np.concatenate(once), return_counts=True)
                often = c >= max(8, heavy_share / 2 * (j - i))
                m = int(often.sum())
                yield pa.record_batch([
                    pa.array([0] * (j - i) + [1] * m, pa.int8()),
                    pa.concat_arrays([b.column("id").slice(i, j - i), pa.nulls(m, pa.int64())]),
                    pa.array(np.concatenate([np.array(ds, np.int64), u[often].view(np.int64)])),
                    pa.array(np.concatenate([np.array([len(s) for s in sets], np.int64), c[often]]))],
                    names=["kind", "id", "d", "n"])

    return docs.mapInArrow(summarise, "kind tinyint, id long, d long, n long")


def _by_bucket(own: list, buckets: int):
    """``(bucket, byte planes of its sorted tokens, texts, each token's place among the texts)`` of ``own``, pairs (tokens, text), which is emptied.

    Few and narrow arrays at a time: an executor holds several such buffers.
    """
    if not own:
        return
    token = np.concatenate([x[0] for x in own])
    doc = np.repeat(np.array([x[1] for x in own], np.uint16), [len(x[0]) for x in own])
    own.clear()
    at = (token % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((token, at))
    at = at[order]
    cuts = np.searchsorted(at, np.arange(buckets + 1))
    del at
    doc = doc[order]
    token = token[order]
    del order
    for x in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(cuts[x], cuts[x + 1])
        names, local = np.unique(doc[part], return_inverse=True)
        # six byte planes: the high ones of sorted tokens compress well
        planes = np.ascontiguousarray(token[part].view(np.uint8).reshape(-1, 8)[:, :6].T)
        yield x, planes.tobytes(), names, local.astype("<u2").tobytes()


def prefix_index(docs: DataFrame, k: int, per_cent: int, heavy: np.ndarray, buckets: int) -> DataFrame:
    """``(token, d, n, shared, central)``: extended prefixes, in the common order, of the classes that may have a partner.

    ``shared`` are the numbers of a set's tokens that other classes hold, per frequency class.  Tokens are
    told apart by 48 bits here; texts are verified on their own sets later.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(heavy)

    def deal(batches):
        often = shared.value
        held: list = []
        seen: dict[int, tuple[int, int]] = {}

        def emit():
            ds = np.fromiter(seen, np.int64, len(seen))
            facts = np.array(list(seen.values()), np.int64).reshape(-1, 2)
            cols: list[list] = [[], [], [], [], []]
            for heavy_part in (0, 1):
                own = [held[x] for x in range(heavy_part, len(held), 2) if len(held[x][0])]
                held[heavy_part::2] = [None] * len(held[heavy_part::2])
                for x, planes, doc, local in _by_bucket(own, buckets):
                    for c, v in zip(cols, (x, heavy_part, planes, local, ds[doc].tobytes())):
                        c.append(v)
            # the classes' own facts travel with the buckets too
            to = (ds.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            for x in np.unique(to).tolist():
                rows = np.flatnonzero(to == x)
                for c, v in zip(cols, (x, 2, facts[rows].tobytes(), b"", ds[rows].tobytes())):
                    c.append(v)
            held.clear()
            seen.clear()
            return pa.record_batch([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32())] + [
                pa.array(c, pa.binary()) for c in cols[2:]], names=["bucket", "kind", "token", "doc", "ds"])

        size = 0
        for b in batches:
            buf, off = utf8(b.column("text"))
            for i, j in runs(off):
                for s in shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], k):
                    d = _digest(s)
                    if not len(s) or d in seen:
                        continue
                    need = len(s) * (100 - per_cent) // 100 + 2
                    common = np.isin(s, often) if len(often) else np.zeros(len(s), bool)
                    plain = s[~common] >> np.uint64(16)
                    held.append((plain, len(seen)))                      # even places: plain tokens, odd places: heavy ones
                    held.append((s[common][:max(0, need - len(plain))] >> np.uint64(16), len(seen)))
                    seen[d] = (len(s), len(plain))
                    size += len(plain)
                    if size > FLUSH or len(seen) >= FLUSH_TEXTS:
                        yield emit()
                        size = 0
        if seen:
            yield emit()

    def share(t: pa.Table) -> pa.Table:
        token, own, part, facts = [], [], [], {}
        for kind, tk, dc, ds in zip(*(t[c].to_pylist() for c in ("kind", "token", "doc", "ds"))):
            ds = np.frombuffer(ds, np.int64)
            if kind == 2:
                facts.update(zip(ds.tolist(), np.frombuffer(tk, np.int64).reshape(-1, 2).tolist()))
                continue
            planes = np.frombuffer(tk, np.uint8).reshape(6, -1)
            wide = np.zeros((planes.shape[1], 8), np.uint8)
            wide[:, :6] = planes.T
            token.append(wide.view(np.uint64).ravel())
            own.append(ds[np.frombuffer(dc, "<u2")])
            part.append(np.full(len(token[-1]), kind, np.uint8))
        token, own, part = (np.concatenate(x) if x else np.zeros(0, ty) for x, ty in
                            ((token, np.uint64), (own, np.int64), (part, np.uint8)))
        order = np.lexsort((own, token))
        token = token[order]
        own = own[order]
        part = part[order]
        del order
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (own[1:] != own[:-1])]) if len(token) else np.zeros(0, bool)
        token, own, part = token[new], own[new], part[new]
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
        count = np.diff(np.append(starts, len(token)))           # equal tokens lie together
        df = np.repeat(count, count)
        keep = (df >= 2) | (part == 1)
        m = len(facts)
        return pa.table({
            "d": np.concatenate([own[keep], np.fromiter(facts, np.int64, m)]),
            "token": np.concatenate([token[keep].view(np.int64), np.array([x[0] for x in facts.values()], np.int64)]),
            "rank": np.concatenate([np.where(part == 1, HEAVY, df)[keep].astype(np.int64), np.full(m, -1, np.int64)]),
            "first": np.concatenate([np.zeros(int(keep.sum()), np.int64), np.array([x[1] for x in facts.values()], np.int64)])})

    dealt = docs.select("text").mapInArrow(deal, "bucket int, kind int, token binary, doc binary, ds binary")
    rows = dealt.groupBy("bucket").applyInArrow(share, "d long, token long, rank long, first long")

    def choose(t: pa.Table) -> pa.Table:
        d, token, rank, first = (t[c].to_numpy() for c in ("d", "token", "rank", "first"))
        order = np.lexsort((token, rank, d))
        d, token, rank, first = d[order], token[order], rank[order], first[order]
        start = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(d))))
        # every class has one row of facts (rank -1, first in its group; a second one says the same)
        fact = rank < 0
        n, a = token[start], first[start]
        ordered = ~fact & (rank < HEAVY)
        sums = np.concatenate([[0], np.cumsum(ordered)])
        in_order = sums[np.append(start[1:], len(d))] - sums[start]
        alone = a - in_order                                    # ordered tokens that no other class has
        allowed = n * (100 - per_cent) // 100
        place = sums[:-1] - sums[start][group]                  # place among the class's shared ordered tokens
        keep = ~fact & (alone <= allowed)[group] & (~ordered | (place < (allowed + 2 - alone)[group]))
        g = group[keep]
        # how many classes hold a set's tokens, on average (a heavy token counts as many)
        held = np.bincount(group, np.where(ordered, rank, 0), len(start)) + (n - a) * 1e6
        of = np.where(rank == HEAVY, CLASSES - 1, np.searchsorted(CLASS_ENDS, rank))
        shared = np.bincount((group * CLASSES + of)[ordered], minlength=len(start) * CLASSES).reshape(-1, CLASSES)
        shared[:, -1] = n - a
        flat = pa.array(shared[g].astype(np.int32).ravel())
        shared = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, CLASSES, dtype=np.int32)), flat)
        return pa.table({"token": token[keep], "d": d[keep], "n": n[g], "shared": shared, "central": (held / n)[g]})

    return rows.withColumn("to", F.pmod("d", F.lit(buckets))).groupBy("to").applyInArrow(
        choose, "token long, d long, n long, shared array<int>, central double")


def _fits(na: Column, sa: Column, nb: Column, sb: Column, per_cent: int) -> Column:
    """Whether two sets can link: a common token is in one frequency class, so the smaller counts bound the overlap."""
    most = F.least(F.get(sa, F.lit(0)), F.get(sb, F.lit(0)))
    for c in range(1, CLASSES):
        most = most + F.least(F.get(sa, F.lit(c)), F.get(sb, F.lit(c)))
    return most * (100 + per_cent) >= (na + nb) * per_cent


def _own_text(rows: DataFrame, k: int) -> DataFrame:
    """The rows ``(d, text)`` whose text has the set ``d`` (an id may be repeated with other texts)."""
    def own(batches):
        for b in batches:
            buf, off = utf8(b.column("text"))
            d = b.column("d").to_numpy()
            ok = np.zeros(len(d), bool)
            for i, j in runs(off):
                ok[i:j] = [_digest(s) == x for s, x in zip(shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], k), d[i:j])]
            yield b.filter(pa.array(ok))

    return rows.mapInArrow(own, "d long, text string")


def verify(pairs: DataFrame, texts: DataFrame, k: int, per_cent: int) -> DataFrame:
    """The stored pairs ``(a, b)`` whose shingle sets link, by the whole texts ``(d, text)``.

    Pairs are dealt to a grid of blocks by the hashes of both sides; a text travels once to
    every block that holds a pair of its, and its set is built there once.
    """
    n_pairs = pairs.count()
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    side = max(1, int(np.ceil(np.sqrt(n_pairs / PAIRS_PER_BLOCK))), int(np.ceil(n_bytes / BYTES_PER_SIDE)))
    at = lambda c, n: F.pmod(F.xxhash64(c, F.lit(n)), F.lit(side)).cast("int")
    placed = pairs.select(at("a", 1).alias("i"), at("b", 2).alias("j"), "a", "b")
    wanted = placed.select("i", "j", F.explode(F.array("a", "b")).alias("w")).distinct()
    sent = wanted.join(texts, wanted["w"] == texts["d"]).select(F.col("i").alias("ti"), F.col("j").alias("tj"), "d", "text")

    def check(p: pa.Table, t: pa.Table) -> pa.Table:
        buf, off = utf8(t["text"])
        sets = {}
        for i, j in runs(off):
            sets.update(zip(t["d"].slice(i, j - i).to_pylist(), shingle_sets(buf[off[i]:off[j]], off[i:j + 1] - off[i], k)))
        ok = np.zeros(len(p), bool)
        for r, (a, b) in enumerate(zip(p["a"].to_pylist(), p["b"].to_pylist())):
            x, y = sets[a], sets[b]
            inter = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
            ok[r] = 100 * inter >= per_cent * (len(x) + len(y) - inter)
        return p.select(["a", "b"]).filter(pa.array(ok))

    return placed.groupBy("i", "j").cogroup(sent.groupBy("ti", "tj")).applyInArrow(check, "a long, b long")


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """``(node, label)``: the smallest node reachable, for every node of ``(a, b)``; ``files`` as in ``stored``."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links", files)
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels", files)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        jump = step.select(F.col("node").alias("at"), F.col("label").alias("further"))
        new = stored(step.join(jump, step["label"] == jump["at"]).select("node", F.least("label", "further").alias("label"), "was"), "labels", files)
        labels, changed = new.select("node", "label"), new.where("label <> was").limit(1).count()
        if not changed:
            return labels


def _pairs(index: DataFrame, per_cent: int) -> DataFrame:
    """Candidate pairs of one token that could join two components.

    With a column ``before`` (the frequent tokens of the set below ``token``) only pairs that have exactly
    one of them in common: ``token`` is then the larger one of their smallest shared combination.
    """
    combined = "before" in index.columns
    x, y = (index.select("token", *[F.col(c).alias(c + side) for c in ("d", "n", "shared", "label", *["before"] * combined)])
            for side in ("_x", "_y"))
    fit = (F.col("label_x") < F.col("label_y")) & _fits(F.col("n_x"), F.col("shared_x"), F.col("n_y"), F.col("shared_y"), per_cent)
    if combined:
        fit = fit & (F.size(F.array_intersect("before_x", "before_y")) == 1)
    pairs = x.withColumnRenamed("token", "token_x").join(y.withColumnRenamed("token", "token_y"), (F.col("token_x") == F.col("token_y")) & fit)
    return pairs.select(F.least("d_x", "d_y").alias("a"), F.greatest("d_x", "d_y").alias("b"))


def jaccard_components(docs: DataFrame, k: int = 5, per_cent: int = 75, heavy_share: float = 0.02, frequent: int = 32,
                       id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per input row: components, not all links.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; two texts link when
    ``100 |x & y| >= per_cent |x | y|`` of their shingle sets.  ``component_id`` is the smallest id
    reachable by links.  Texts of fewer than ``k`` words are one shingle;
    null texts and texts without words have the empty set and link with nothing, themselves under other
    ids included.  Null ids are never smallest unless alone; repeated rows are linked texts.
    An empty table gives no rows; other columns are ignored.  The first pass is stored in at most ``files`` files.  Shingles and
    sets are told apart by 64-bit hashes.
    """
    if not 50 <= per_cent <= 100:
        raise ValueError("per_cent is 50 to 100")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    seen = stored(summaries(src, k, heavy_share), "summaries", files)
    rows = seen.where("kind = 0").select("id", "d", "n")
    total = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    n_rows, n_tokens = int(total[0]), int(total[1] or 0)
    # at most (mean set size / (heavy_share / 2)) tokens can be that frequent
    heavy = seen.where("kind = 1").groupBy("d").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= max(64, heavy_share / 2 * n_rows)).select("d").toPandas()["d"].to_numpy(np.int64)
    heavy = np.sort(heavy.view(np.uint64))
    buckets = max(n_slices(docs), -(-n_tokens // TOKENS_PER_BUCKET))
    # a table of a few rows for each partition is not written in as many files: every file costs a task and a process to set its mode
    files = even(docs, -(-n_tokens // TOKENS_PER_FILE))
    few = min(files, even(docs, -(-n_rows // ROWS_PER_FILE)))
    index = stored(prefix_index(src, k, per_cent, heavy, buckets), "prefixes", files)
    lists = index.groupBy("token").agg(F.count(F.lit(1)).alias("members"),
                                       F.max(F.struct("central", "d", "n", "shared")).alias("hub")).where("members > 1")
    met = stored(index.join(lists, "token"), "lists", files)            # the members of lists of two or more
    texts = met.select("d").distinct()
    first = rows.groupBy("d").agg(F.min("id").alias("id"))
    texts = texts.join(first, "d").withColumnRenamed("id", "rep")
    texts = stored(_own_text(src.join(texts, src["id"].eqNullSafe(texts["rep"])).select("d", "text"), k), "texts", files)
    central = met.where((F.col("d") != F.col("hub.d")) & _fits(F.col("n"), F.col("shared"), F.col("hub.n"), F.col("hub.shared"), per_cent)) \
        .select(F.least("d", F.col("hub.d")).alias("a"), F.greatest("d", F.col("hub.d")).alias("b")).distinct()
    central = stored(central, "central", files)
    links = stored(verify(central, texts, k, per_cent), "links", files)
    labels = components(links, few)
    open_ = met.select("token", "d", "n", "shared").join(labels.select(F.col("node").alias("d"), "label"), "d", "left") \
        .withColumn("label", F.coalesce("label", "d"))
    mixed = open_.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("members")) \
        .where("lo < hi").select("token", "members")
    open_ = stored(open_.join(mixed, "token"), "open", files)           # lists that still hold several components
    of_two = open_.where(F.col("members") > frequent)
    mine = of_two.groupBy(F.col("d").alias("own")).agg(F.sort_array(F.collect_list("token")).alias("hot"))
    of_two = of_two.join(mine, F.col("d") == F.col("own")).withColumn(
        "before", F.slice("hot", F.lit(1), F.array_position("hot", F.col("token")).cast("int") - 1)).drop("hot", "own")
    more = _pairs(open_.where(F.col("members") <= frequent), per_cent).union(_pairs(of_two.where(F.size("before") > 0), per_cent))
    more = stored(more.distinct(), "pairs", files)
    more = stored(more.join(central, ["a", "b"], "left_anti"), "candidates", files)
    found = stored(verify(more, texts, k, per_cent), "links", files)
    if found.limit(1).count():
        labels = components(links.unionByName(found), few)
    lab = labels.select(F.col("node").alias("d"), "label")
    named = rows.where("n > 0").groupBy("d").agg(F.min("id").alias("id")).join(lab, "d", "left") \
        .select("d", "id", F.coalesce("label", "d").alias("label"))
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    by_set = named.join(least, "label").select(F.col("d").alias("set"), "component_id")
    return rows.join(by_set, (F.col("d") == F.col("set")) & (F.col("n") > 0), "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
