"""SentencePiece ids of whole texts and back, by a table of prefixes.

Merges are taken by score, leftmost first, so the ids of a text are the only
sequence in which every two neighbours are *compatible*: merging their joint
characters gives back just the two.  Each prefix of a text therefore has one
last token.  An automaton over the vocabulary names the pieces that end at a
character; of these the one compatible with the last token of the prefix
before it is stored.  Walking the stored tokens back from the end gives the
ids, in time linear in the text whatever its length.  Characters outside the
vocabulary merge with nothing and become their bytes.

A text is first cut wherever no piece holds the two bytes around the cut; such
stretches do not depend on each other, and each distinct one is worked out
once per worker (bounded table).  Within a batch they are told apart by a 64-bit hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repflow.llm.encode import vocabulary
from repflow.llm.textkernel import runs, segment_hash, utf8

MARK = "▁"                       # white space inside pieces
NONE, OTHER = -1, -2                  # no token yet; a character outside the vocabulary
MAX_CACHED = 250_000                  # of each of two generations
RUN_BYTES = 4 << 20
_PIECES: dict[str, "Pieces"] = {}


class Pieces:
    """A BPE piece vocabulary with byte fallback, read once per worker."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        if sp.normalize(" a  b\téﬁ") != MARK * 2 + "a" + MARK * 2 + "b\téﬁ":
            raise ValueError(f"{path}: needs a model that only marks white space and puts one mark before a text")
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(p[1:-1], 16): i for i, p in enumerate(names) if sp.is_byte(i)}
        if len(self.byte_id) != 256:
            raise ValueError(f"{path}: needs byte fallback")
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.score = {names[i]: sp.get_score(i) for i in plain}
        self.id = {names[i]: i for i in plain}
        self.name = names
        self.automaton = ahocorasick.Automaton()
        joined = np.zeros(1 << 16, dtype=bool)
        self.out = [b""] * n                                  # bytes of each id in a decoded text
        for i in plain:
            self.automaton.add_word(names[i], (len(names[i]), i))
            self.out[i] = names[i].replace(MARK, " ").encode()
            b = np.frombuffer(self.out[i], np.uint8).astype(np.int64)
            joined[b[:-1] * 256 + b[1:]] = True
        for value, i in self.byte_id.items():
            self.out[i] = bytes([value])
        self.automaton.make_automaton()
        self.apart = ~joined                                  # no piece holds these two bytes in a row
        self.pairs: dict[tuple[int, int], bool] = {}
        self.cache: dict[bytes, tuple[bytes, int, bytes]] = {}
        self.older: dict[bytes, tuple[bytes, int, bytes]] = {}

    def merged(self, text: str) -> list[str]:
        """The merges carried out one by one (short strings: pairs of pieces)."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last`` (or stand first, or after a foreign character)."""
        key = (last if last >= 0 else NONE, token)
        ok = self.pairs.get(key)
        if ok is None:
            want = [self.name[token]] if last < 0 else [self.name[last], self.name[token]]
            ok = self.pairs[key] = self.merged("".join(want)) == want
            if len(self.pairs) > 4 * MAX_CACHED:
                self.pairs.clear()
        return ok

    def encode(self, text: str) -> list[int]:
        """Ids of a text whose white space is marked."""
        whole = self.id.get(text)
        if whole is not None and self.compatible(NONE, whole):
            return [whole]
        last, pairs, compatible = [OTHER] * (len(text) + 1), self.pairs, self.compatible
        last[0] = NONE
        for end, (length, token) in self.automaton.iter(text):
            if last[end + 1] != OTHER:
                continue
            before = last[end + 1 - length]
            ok = pairs.get((before if before >= 0 else NONE, token))
            if ok or (ok is None and compatible(before, token)):
                last[end + 1] = token
        ids, i = [], len(text)
        while i:
            token = last[i]
            if token == OTHER:
                ids.extend(self.byte_id[b] for b in reversed(text[i - 1].encode()))
                i -= 1
            else:
                ids.append(token)
                i -= len(self.name[token])
        ids.reverse()
        return ids

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of a text from its ids, with the white space put before it."""
        return b"".join([self.out[i] for i in ids])

    def stretch(self, raw: bytes) -> tuple[bytes, int, bytes]:
        """``(decimal ids, id count, decoded bytes)`` of one stretch."""
        got = self.cache.get(raw)
        if got is None:
            got = self.older.get(raw)
            if got is None:
                ids = self.encode(raw.decode("utf-8", "replace").replace(" ", MARK))
                text = self.decode(ids)
                got = (",".join(map(str, ids)).encode(), len(ids), raw if text == raw else text)
            if len(raw) <= 64:
                if len(self.cache) >= MAX_CACHED:
                    self.cache, self.older = {}, self.cache
                self.cache[raw] = got
        return got

    def batch(self, buf: np.ndarray, off: np.ndarray):
        """Per document ``(ids as decimal text, id count, decoded bytes)``."""
        size = np.diff(off)
        # one white space before every non-empty text; the mark itself reads as white space
        flat = np.insert(buf, off[:-1][size > 0], 32)
        at = off + np.concatenate([[0], np.cumsum(size > 0)])
        raw = flat.tobytes()
        if MARK.encode() in raw:
            texts = [raw[a:b].replace(MARK.encode(), b" ") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            raw, at = b"".join(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            flat = np.frombuffer(raw, np.uint8)
        if not len(flat):
            return [(b"", 0, b"")] * len(size)
        cut = np.zeros(len(flat), dtype=bool)
        cut[1:] = self.apart[flat[:-1].astype(np.uint16) * 256 + flat[1:]] & ((flat[1:] & 0xC0) != 0x80)
        cut[at[:-1][size > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(flat))
        _, one, inv = np.unique(segment_hash(flat, starts, ends), return_index=True, return_inverse=True)
        known = [self.stretch(raw[a:b]) for a, b in zip(starts[one].tolist(), ends[one].tolist())]
        ids = np.array([k[0] for k in known], dtype=object)[inv]
        text = np.array([k[2] for k in known], dtype=object)[inv]
        count = np.concatenate([[0], np.cumsum(np.array([k[1] for k in known], np.int64)[inv])])
        first = np.searchsorted(starts, at)
        return [(b",".join(ids[a:b].tolist()), int(count[b] - count[a]), b"".join(text[a:b].tolist())[1:])
                for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def pieces(path: str) -> Pieces:
    """The worker's vocabulary of a model file."""
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def encoded(docs: DataFrame, make, schema: str, id_col: str, text_col: str, model: str | None) -> DataFrame:
    """``doc_id`` and the columns that ``make(decimal ids, id count, decoded bytes)`` gives per row of ``docs``."""
    path = model or vocabulary("piece_bpe_32k.model")

    def to_rows(batches):
        table = pieces(path)
        for b in batches:
            buf, off = utf8(b.column("text"))
            for i, j in runs(off, RUN_BYTES):
                got = [make(*x) for x in table.batch(buf[off[i]:off[j]], off[i:j + 1] - off[i])]
                yield pa.record_batch([b.column("doc_id").slice(i, j - i)] + [pa.array(c) for c in zip(*got)], names=names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", *[c.split()[0] for c in schema.split(",")]]
    return src.mapInArrow(to_rows, f"doc_id long, {schema}")


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """``(doc_id, ids array<int>, decoded)``: the ids of each whole text and the text that they decode to.

    Equal to the library's ids and ``decode``.  Null texts count as empty: no ids, empty text.
    Rows are independent: repeated rows and ids give a row each, a null id stays null.  A text of any
    length is worked through in linear time (one stretch without a cut is held in memory).
    An empty table gives no rows; other columns are ignored.
    """
    return encoded(docs, lambda ids, n, text: (np.fromstring(ids, np.int32, sep=",") if n else np.zeros(0, np.int32),
                                               text.decode()), "ids array<int>, decoded string", id_col, text_col, model)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: digests of what ``encode_texts`` gives, per row."""
    return encoded(docs, lambda ids, n, text: (n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()),
                   "n_tokens long, ids_sha256 string, decoded_sha256 string", id_col, text_col, model)
