"""Prefix trie of conversations.

Every turn gets an id (128 bits of the SHA-256 of role and text); a conversation is the row of
its turns' ids.  Rows are dealt to shards by ranges of (ids, conversation), so that the members
of every node lie next to each other in the order of the shards.  A task takes its sorted shard in
chunks of bounded size as padded matrices of dense turn ids:

* ``numpy.lexsort`` orders the rows; a row starts a new node at every depth from its first changed
  column on (change masks, OR-accumulated along the columns);
* ``reduceat`` over the starts of a depth gives its nodes' members, smallest ids and children, and,
  over suffix sums along the columns, the sums over whole subtrees.

Only the nodes on the path of a chunk's first or last row can go on in another chunk.  These are
kept open, named by a hash of their prefix, and recombined by grouping.  What open nodes add to the
subtrees above them goes along one of their paths (suffix sums again), which holds all their
ancestors; a closed node with an open parent finds it by its chunk's path and depth.

Held in one task: the ids and sizes of the turns of one conversation (40 bytes a turn, no texts), and a
matrix of at most ``CELLS`` cells or one conversation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repflow.llm.tables import n_slices, stored

CELLS = 1 << 20
ROWS = 1 << 17
NODE = ("open boolean, path long, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved long, size long, deeper boolean, ends string, first_end long")
NAMES = [c.split()[0] for c in NODE.split(", ")]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """``(conv_id, turns)``: per conversation its turns in order, each ``(id, size)``.

    Ordered by turn, null first; equal turns by their ids.  Null role or text counts as empty, rows without a
    conversation id take no part.  ``size`` is the UTF-8 length of the text.
    """
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    told = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.col(turn_col).cast("long")
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(turn.isNotNull().alias("has"), F.coalesce(turn, F.lit(0)).alias("turn"),
                 F.unhex(F.substring(told, 1, 32)).alias("id"), F.octet_length(text).cast("long").alias("size")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["size"].alias("size"))).alias("turns"))


def rebuilt(seqs: DataFrame, step: int = 5, heads: int = 9) -> DataFrame:
    """``seqs`` with each conversation ``c`` rebuilt: the first ``h`` turns of ``c - c % step``, then its own behind its first ``h``.

    ``h`` is crc32 of the decimal ``c`` mod ``heads``.  Only heads of fewer than ``heads`` turns are joined, to ``2 * step`` ids at most.
    """
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    first = (seqs.where(c % step == 0).select(c.alias("__base"), F.slice("turns", 1, heads - 1).alias("head")))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", F.lit(1), F.lit(0)))
    return (seqs.withColumn("__base", c - c % step).join(first, "__base", "left")
            .select("conv_id", F.concat(head, own).alias("turns")))


def _matrix(values: np.ndarray, lens: np.ndarray, fill) -> np.ndarray:
    out = np.full((len(lens), max(1, int(lens.max()))), fill, values.dtype)
    out[np.arange(out.shape[1]) < lens[:, None]] = values
    return out


def chunk_nodes(raw: np.ndarray, sizes: np.ndarray, lens: np.ndarray, conv: np.ndarray, path: int) -> list[list]:
    """Columns of ``NODE`` of one chunk: ``raw`` (turns x 16 bytes), ``sizes`` flat, rows in any order.

    ``path`` names the path of the first row in order, ``path + 1`` that of the last.
    """
    lane = raw.view(">u8")
    by = np.lexsort((lane[:, 1], lane[:, 0]))
    fresh = np.ones(len(by), dtype=bool)
    fresh[1:] = (lane[by[1:]] != lane[by[:-1]]).any(1)
    dense = np.empty(len(by), np.int32)
    dense[by] = np.cumsum(fresh) - 1
    ids, size = _matrix(dense, lens, np.int32(-1)), _matrix(sizes, lens, np.int64(0))
    first = np.cumsum(lens) - lens
    order = np.lexsort((conv, *ids.T[::-1]))
    ids, size, lens, conv, first = ids[order], size[order], lens[order], conv[order], first[order]
    n_rows, top = len(lens), int(lens.max())
    change = np.ones((n_rows, top + 1), dtype=bool)
    change[1:, 0] = False
    change[1:, 1:] = (ids[1:] != ids[:-1])[:, :top]
    np.logical_or.accumulate(change, axis=1, out=change)

    starts, least, own, leaf, closed = [], [], np.zeros(change.shape, np.int64), np.zeros(change.shape, np.int64), np.zeros(change.shape, bool)
    for d in range(top + 1):
        b = np.flatnonzero(change[:, d])
        starts.append(b)
        least.append(np.minimum.reduceat(conv, b))
        inner = b[1:-1]                                 # the first and the last group may go on outside
        if len(inner):
            node = lens[inner] >= d
            closed[inner, d] = node
            own[inner, d] = np.where(node, (b[2:] - inner - 1) * size[inner, d - 1], 0)
            leaf[inner, d] = node & (np.maximum.reduceat(lens, b)[1:-1] == d)
    own = np.ascontiguousarray(np.cumsum(own[:, ::-1], axis=1)[:, ::-1])
    leaf = np.cumsum(leaf[:, ::-1], axis=1)[:, ::-1]

    out: list[list] = [[] for _ in NAMES]

    def add(*columns):
        n = len(columns[2])
        for held, c in zip(out, columns):
            held.extend(c.tolist() if isinstance(c, np.ndarray) else c if isinstance(c, list) else [c] * n)

    def ends(s: int, n: int) -> str:
        return ",".join(map(str, conv[s:s + n].tolist()))

    for d in range(1, top + 1):
        b = starts[d]
        pick = np.flatnonzero(closed[b, d])
        if not len(pick):
            continue
        at = b[pick]
        parent = np.searchsorted(starts[d - 1], at, side="right") - 1
        last = len(starts[d - 1]) - 1
        told = np.array([path, path + 1])[((parent == last) & (parent > 0)).astype(int)]
        is_open = (parent == 0) | (parent == last)
        n_ends = np.add.reduceat((lens == d).astype(np.int64), b)[pick].tolist()
        digests = [hashlib.sha256(ends(s, n).encode()).hexdigest() if n else NO_ENDS for s, n in zip(at.tolist(), n_ends)]
        children = np.add.reduceat(closed[:, d + 1].astype(np.int64), b)[pick] if d < top else np.zeros(len(at), np.int64)
        above = least[d - 1][parent]
        add(False, [int(p) if o else None for p, o in zip(told, is_open)], np.full(len(at), d), None, None, least[d][pick],
            [None if o else int(c) for c, o in zip(above, is_open)], np.diff(np.append(b, n_rows))[pick], children,
            np.add.reduceat(leaf[:, d], b)[pick], np.add.reduceat(own[:, d], b)[pick], 0, False, digests, None)

    for side, row in ((0, 0), (1, n_rows - 1)):
        hashed, key = hashlib.blake2b(digest_size=16), None
        held = raw[first[row]:first[row] + lens[row]]
        for d in range(int(lens[row]) + 1):
            if d:
                hashed.update(held[d - 1].tobytes())
            key, above = hashed.copy().digest(), key
            b = starts[d]
            s, e = (0, int(b[1]) if len(b) > 1 else n_rows) if side == 0 else (int(b[-1]), n_rows)
            if side and s == 0:                          # on the first row's path as well, counted there
                add(True, path + side, [d], key, above, None, None, 0, 0, 0, 0, int(size[row, d - 1]) if d else 0, False, "", None)
                continue
            n = int((lens[s:e] == d).sum())
            add(True, path + side, [d], key, above, int(conv[s:e].min()), None, e - s, int(closed[s:e, d + 1].sum()) if d < top else 0,
                int(leaf[s:e, d].sum()), int(own[s:e, d].sum()), int(size[row, d - 1]) if d else 0, bool((lens[s:e] > d).any()),
                ends(s, n), int(conv[s]) if n else None)
    return out


def _cuts(lens: np.ndarray, cells: int = CELLS) -> list[int]:
    """Row bounds of chunks of at most ``cells`` padded cells and ``ROWS`` rows (a longer row stands alone)."""
    cuts, widest = [0], 0
    for i, n in enumerate(lens.tolist()):
        widest = max(widest, n, 1)
        if i > cuts[-1] and ((i + 1 - cuts[-1]) * widest > cells or i - cuts[-1] >= ROWS):
            cuts.append(i)
            widest = max(n, 1)
    return cuts + [len(lens)]


def _shards(seqs: DataFrame, cells: int) -> DataFrame:
    def to_nodes(batches):
        path = TaskContext.get().partitionId() << 33
        held = []                                       # (raw, sizes, lens, conv) of rows not yet worked through

        def made(parts):
            nonlocal path
            raw, sizes, lens, conv = (np.concatenate(x) for x in zip(*parts))
            first = np.concatenate([[0], np.cumsum(lens)])
            cuts = _cuts(lens, cells)
            for a, b in zip(cuts[:-1], cuts[1:]):
                columns = chunk_nodes(raw[first[a]:first[b]], sizes[first[a]:first[b]], lens[a:b], conv[a:b], path)
                path += 2
                whole = pa.table({f.name: pa.array(c, f.type) for f, c in zip(schema, columns)})
                yield from whole.to_batches(max_chunksize=20_000)

        n = 0
        for b in batches:
            turns = b.column("turns")
            lens = np.diff(turns.offsets.to_numpy()).astype(np.int64)
            flat = turns.flatten()
            ids = flat.field("id")
            data = np.frombuffer(ids.buffers()[2], np.uint8)[ids.offset * 16:(ids.offset + len(ids)) * 16] if len(ids) else np.zeros(0, np.uint8)
            held.append((data.reshape(-1, 16), flat.field("size").to_numpy(zero_copy_only=False).astype(np.int64), lens,
                         b.column("conv_id").to_numpy(zero_copy_only=False)))
            n += len(data) // 16 + len(lens)
            if n > cells:
                yield from made(held)
                held, n = [], 0
        if held and sum(len(h[2]) for h in held):
            yield from made(held)

    schema = pa.schema([("open", pa.bool_()), ("path", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()),
                        *[(c, pa.int64()) for c in NAMES[5:12]], ("deeper", pa.bool_()), ("ends", pa.string()), ("first_end", pa.int64())])
    seqs = stored(seqs, "turns-sequences")
    ids = F.transform("turns", lambda x: x["id"])
    dealt = (seqs.withColumn("ids", ids).repartitionByRange(n_slices(seqs), "ids", "conv_id")
             .sortWithinPartitions("ids", "conv_id").select("conv_id", "turns"))
    return stored(dealt.mapInArrow(to_nodes, NODE), "turns-nodes")


def _digests(pieces: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: the pieces of a key in order, streamed through one digest (a digest cannot be split)."""
    def to_digest(batches):
        key, sha = None, None
        for b in batches:
            done = []
            for k, text in zip(b.column("key").to_pylist(), b.column("ends").to_pylist()):
                if k != key:
                    if sha is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            yield pa.record_batch([pa.array([k for k, _ in done], pa.binary()), pa.array([s for _, s in done], pa.string())], names=["key", "ends_sha256"])
        if sha is not None:
            yield pa.record_batch([pa.array([key], pa.binary()), pa.array([sha.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    return (pieces.where("first_end IS NOT NULL").select("key", "first_end", "ends").repartition("key")
            .sortWithinPartitions("key", "first_end").mapInArrow(to_digest, "key binary, ends_sha256 string"))


def prefix_trie(seqs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Nodes of the prefix trie of ``(conv_id, turns)`` rows (distinct, non-null ids; see ``sequences``).

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``: smallest member, depth, the
    parent's smallest member (root: null), members, children, childless nodes in the subtree, over the subtree the sum of
    (members - 1) times the size of the last turn, digest of the ids of the members that end here.
    """
    nodes = _shards(seqs, cells)
    parts = nodes.where("open")
    one = stored(parts.groupBy("key").agg(
        F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"),
        F.max("size").alias("size"), F.max("deeper").alias("deeper"), F.min("path").alias("owner")), "turns-open")
    # what an open node itself adds goes up along the path that owns it
    way = Window.partitionBy("path").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    owned = F.col("path") == F.col("owner")
    paths = stored(parts.select("path", "depth", "key").join(one.select("key", "conv_id", "n_convs", "size", "deeper", "owner"), "key").select(
        "path", "depth", "key", "conv_id", F.sum(F.when(owned & ~F.col("deeper"), 1).otherwise(0)).over(way).alias("leaves"),
        F.sum(F.when(owned, (F.col("n_convs") - 1) * F.col("size")).otherwise(0)).over(way).alias("saved")), "turns-paths")
    more = paths.groupBy("key").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    children = one.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more_children"))
    parent = one.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    zero = F.lit(0).cast("long")
    opened = (one.join(more, "key").join(children, "key", "left").join(parent, "parent_key", "left").join(_digests(parts), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", (F.col("n_children") + F.coalesce("more_children", zero)).alias("n_children"),
        (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"), (F.col("saved") + F.col("more_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")))
    closed = nodes.where(~F.col("open")).select("path", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                                F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
    above = paths.select("path", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("__above"))
    under = closed.where("path IS NOT NULL").join(above, ["path", "depth"]).withColumn("parent_conv_id", F.col("__above"))
    return opened.unionByName(closed.where("path IS NULL").select(*opened.columns)).unionByName(under.select(*opened.columns))


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", rebuild: bool = False, cells: int = CELLS) -> DataFrame:
    """``prefix_trie`` of the conversations' turns, optionally each rebuilt first (``rebuilt``).

    Repeated rows are turns of their own; conversations without a turn end at the root.  An empty table gives
    no rows; other columns are ignored.
    """
    seqs = sequences(conversations, conv_col, turn_col, role_col, text_col)
    return prefix_trie(rebuilt(stored(seqs, "turns-own")) if rebuild else seqs, cells)
