"""Token ids of whole texts, batch by batch.

A text is cut where both tokenizers always start a new piece: before a space
that a solid character follows, before a line feed between two such
characters, and between a letter and one of ``,.;:!?#$%&*``.  Solid are printable ASCII and blocks
without white space or combining marks.  The ids of a stretch between two cuts then do not depend
on its neighbours, so each distinct stretch is given to the tokenizers library
once per worker and the ids of a batch are gathered with numpy.  Stretches are
told apart by a 64-bit hash.  One that is a space and letters is a single piece for the
pre-tokenizer, so the library's model gets it at once, spelled as the pre-tokenizer spells it.
"""

from __future__ import annotations

import os
import re

import numpy as np

from repflow.llm.textkernel import LOWER, segment_hash

PRINTABLE = np.zeros(256, dtype=bool)
PRINTABLE[0x21:0x7F] = True
# first bytes of characters that are neither white space nor combining: printable ASCII, Latin-1 letters and
# Latin Extended-A (C3 to C5), Greek and Cyrillic (CE to D1), CJK ideographs (E4 to E9)
SOLID = PRINTABLE.copy()
SOLID[[0xC3, 0xC4, 0xC5, *range(0xCE, 0xD2), *range(0xE4, 0xEA)]] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
STOPS = np.zeros(256, dtype=bool)
STOPS[list(b",.;:!?#$%&*")] = True
ODD = np.zeros(256, dtype=bool)
ODD[[32, *range(9, 14), *b"|<"]] = True
BETWEEN = " |"                       # one id of its own between two stretches that start with white space
JOINED = 1000
LATIN = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
MAX_CACHED = 600_000                 # stretches of the table and of the one before it
_ENCODERS: dict[str, "Encoder"] = {}


def _letters(buf: np.ndarray) -> np.ndarray:
    """Last bytes of ASCII and Latin-1 letters (not the signs of multiplication and division)."""
    letter = LETTER[buf]
    letter[1:] |= (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    return letter


def stretches(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the independent stretches, document starts included (empty documents have none)."""
    follows = np.concatenate([SOLID[buf[1:]], [False]])
    letter_before = np.concatenate([[False], _letters(buf)[:-1]])
    before = np.concatenate([[False], PRINTABLE[buf[:-1]]]) | letter_before
    cut = follows & ((buf == 32) | ((buf == 10) & before))
    edges = offsets[1:-1]
    cut[np.maximum(edges - 1, 0)[edges > 0]] = False     # a text's last byte has no follower
    cut |= STOPS[buf] & letter_before
    cut[offsets[:-1][offsets[:-1] < len(buf)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids by the tokenizers library, with a bounded table of stretches already seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.small = np.uint16 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        between = self._ids([BETWEEN])[0]
        self.between = between[0] if len(between) == 1 else None
        self.length = self._lengths()
        # a vocabulary that lower-cases and drops white space gives equal ids to stretches that differ in these alone
        self.fold = np.arange(256, dtype=np.uint8)
        if '"type":"Lowercase"' in self.tokenizer.to_str() and self._ids(["\nAbc"]) == self._ids([" abc"]):
            self.fold = LOWER.copy()
            self.fold[10] = 32
        self.word = self._spelling()
        self._reset()
        self.former = (self.keys, self.at, self.n, self.ids)

    def _spelling(self) -> re.Pattern | None:
        """Pattern of the stretches that are one piece, a space and Latin letters; None if the library's parts do not show that."""
        self.model, normal, pre = self.tokenizer.model, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        letters = [c for c in LATIN if normal is None or normal.normalize_str(f"a{c}a") == f"a{c}a"]
        pieces = pre.pre_tokenize_str(" a") if pre is not None else []
        if len(pieces) != 1 or not pieces[0][0].endswith("a"):
            return None
        self.lead, self.spelled = pieces[0][0][:-1], {}
        for c in letters:
            (piece, _), *more = pre.pre_tokenize_str(f" a{c}a")
            if more or not (piece.startswith(f"{self.lead}a") and piece.endswith("a")):
                return None
            self.spelled[ord(c)] = piece[len(self.lead) + 1:-1]
        words = [f" {w}" for c in letters for w in (c, f"{c}the", f"un{c}s")] + [f" {''.join(letters)}"]
        return re.compile(f" [{''.join(letters)}]+") if self._of_words(words) == self._ids(words) else None

    def _of_words(self, words: list[str]) -> list[list[int]]:
        ids = self.model.tokenize
        return [[t.id for t in ids(self.lead + w[1:].translate(self.spelled))] for w in words]

    def _lengths(self) -> np.ndarray | None:
        """Bytes per id of a byte-level vocabulary, where the ids themselves tell which stretch they belong to."""
        if '"type":"ByteLevel"' not in self.tokenizer.to_str():
            return None
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        length = np.zeros(max(names.values()) + 1, np.int64)
        length[list(names.values())] = [len(x) for x in names]
        return length if all(length[x].sum() == len(t) for t, x in ((t, self._ids([t])[0]) for t in (" abc", "\nAbc", " abc, d"))) else None

    def _reset(self):
        self.keys, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.new = (self.keys, self.at, self.n)
        self.ids = np.zeros(0, self.small)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, parts: list[bytes], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(order, id counts, flat ids)`` of new stretches; ``plain`` ones that are no words are handed over many at a time."""
        order, counts, flat = [], [], []
        if self.word is not None:
            texts = [x.decode("utf-8", "replace") for x in parts]
            named = np.array([self.word.fullmatch(x) is not None for x in texts], bool)
            order.append(np.flatnonzero(named))
            got = self._of_words([texts[i] for i in order[0].tolist()])
            counts.append(np.fromiter(map(len, got), np.int64, len(got)))
            flat.append(np.fromiter((x for ids in got for x in ids), np.uint32, int(counts[0].sum())))
            plain, odd = plain & ~named, ~(plain | named)
        else:
            odd = ~plain
        rest = np.flatnonzero(odd).tolist()
        which = np.flatnonzero(plain)
        groups = [which[k:k + JOINED] for k in range(0, len(which), JOINED)]
        between = BETWEEN.encode() if self.length is None else b""
        joined = [(between.join([parts[i] for i in g])).decode("utf-8", "replace") for g in groups]
        for g, ids in zip(groups, self._ids(joined)):
            ids = np.array(ids, np.uint32)
            if self.length is not None:
                edge, end = np.cumsum([len(parts[i]) for i in g]), np.cumsum(self.length[ids])
                last = np.minimum(np.searchsorted(end, edge), len(end) - 1)
                if end[-1] == edge[-1] and (end[last] == edge).all():      # every stretch ends with an id
                    order.append(g)
                    counts.append(np.diff(last, prepend=-1))
                    flat.append(ids)
                else:
                    rest += g.tolist()
                continue
            is_between = ids == self.between
            at = np.flatnonzero(is_between)
            if len(at) == len(g) - 1:
                order.append(g)
                counts.append(np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1)
                flat.append(ids[~is_between])
            else:
                rest += g.tolist()
        got = self._ids([parts[i].decode("utf-8", "replace") for i in rest])
        order.append(np.array(rest, np.int64))
        counts.append(np.fromiter(map(len, got), np.int64, len(got)))
        flat += [np.array(x, np.uint32) for x in got]
        return np.concatenate(order), np.concatenate(counts), np.concatenate(flat)

    def _recall(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(which, id counts, flat ids)`` of the stretches of the former table."""
        keys, at, n, ids = self.former
        if not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int32), ids
        i = np.minimum(np.searchsorted(keys, u), len(keys) - 1)
        which = np.flatnonzero(keys[i] == u)
        at, n = at[i[which]], n[i[which]]
        first = np.cumsum(n) - n
        return which, n, ids[np.arange(int(n.sum())) + np.repeat(at - first, n)]

    def _merge(self):
        keys = np.concatenate([self.keys, self.new[0]])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.n = (np.concatenate([x, y])[order] for x, y in zip((self.keys, self.at, self.n), self.new))
        self.new = (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))

    def _find(self, u: np.ndarray):
        at, n, known = np.zeros(len(u), np.int32), np.zeros(len(u), np.int32), np.zeros(len(u), bool)
        for keys, a, m in ((self.keys, self.at, self.n), self.new):
            if len(keys):
                i = np.minimum(np.searchsorted(keys, u), len(keys) - 1)
                hit = keys[i] == u
                at[hit], n[hit] = a[i[hit]], m[i[hit]]
                known |= hit
        return at, n, known

    def encode(self, buf: np.ndarray, offsets: np.ndarray):
        """``(ids, starts, first)``: all ids, per stretch its first byte and its first id (one more entry each)."""
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)
        starts = stretches(buf, offsets)
        if self.fold[65] != 65 and not ((buf[:-1] == 60) & (buf[1:] == 124)).any():      # "<|" may begin a special token
            buf = self.fold[buf]
        ends = np.append(starts[1:], len(buf))
        u, one, inv = np.unique(segment_hash(buf, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(self.new[0]) > MAX_CACHED // 2:      # stretches met again come back from the former table
            self._merge()
            self.former = (self.keys, self.at, self.n, self.ids)
            self._reset()
        at, n, known = self._find(u)
        fresh = np.flatnonzero(~known)
        if len(fresh):
            raw = buf.tobytes()
            s, e = starts[one[fresh]], ends[one[fresh]]
            # one space or line feed, then one word without white space, separator or special token
            odd = np.concatenate([[0], np.cumsum(ODD[buf])])
            plain = ODD[buf[s]] & ((buf[s] == 32) | (buf[s] == 10)) & (odd[e] - odd[s] == 1) & (PRINTABLE[buf] | _letters(buf))[e - 1]
            was, m, flat = self._recall(u[fresh])
            rest = np.delete(np.arange(len(fresh)), was)
            if len(rest):
                order, more, ids = self._fresh([raw[i:j] for i, j in zip(s[rest].tolist(), e[rest].tolist())],
                                               plain[rest] & (self.between is not None or self.length is not None))
                was, m, flat = np.concatenate([was, rest[order]]), np.concatenate([m, more]), np.concatenate([flat, ids])
            fresh = fresh[was]
            m = m.astype(np.int32)
            a = (len(self.ids) + np.cumsum(m) - m).astype(np.int32)
            self.ids = np.concatenate([self.ids, flat.astype(self.small)])
            at[fresh], n[fresh] = a, m
            k = np.concatenate([self.new[0], u[fresh]])
            order = np.argsort(k)
            self.new = (k[order], np.concatenate([self.new[1], a])[order], np.concatenate([self.new[2], m])[order])
            if len(self.new[0]) > 20_000 + len(self.keys) // 4:
                self._merge()
        each = n[inv].astype(np.int64)
        first = np.concatenate([[0], np.cumsum(each)])
        ids = self.ids[np.arange(first[-1]) + np.repeat(at[inv] - first[:-1], each)].astype(np.uint32)
        return ids, np.append(starts, len(buf)), first


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
