"""Brute-force references for property tests (plain Python, tiny inputs only)."""

from repflow.functions.codon import CODON_BASES, STANDARD_CODE, UNKNOWN_AA, IUPAC_NUCLEOTIDES

COMP = {"A": "T", "C": "G", "G": "C", "T": "A"}


def translate(seq: str, frame: int) -> str:
    out = []
    for i in range(frame, len(seq) - 2, 3):
        c = seq[i:i + 3]
        if all(b in CODON_BASES for b in c):
            idx = 16 * CODON_BASES.index(c[0]) + 4 * CODON_BASES.index(c[1]) + CODON_BASES.index(c[2])
            out.append(STANDARD_CODE[idx])
        else:
            out.append(UNKNOWN_AA)
    return "".join(out)


def six_frames(read: str):
    s = read.upper().replace("U", "T")
    if any(ch not in IUPAC_NUCLEOTIDES for ch in s):
        return []
    rc = "".join(COMP.get(b, b) for b in reversed(s))
    return [("+", f, translate(s, f)) for f in range(3)] + [("-", f, translate(rc, f)) for f in range(3)]


def bulk_hits(reads, patterns):
    """reads: list of (read_id, seq, count); every occurrence, stop-free patterns only."""
    pats = {p for p in patterns if p and "*" not in p}
    out = []
    for rid, seq, cnt in reads:
        if seq is None:
            continue
        for strand, frame, prot in six_frames(seq):
            for p in pats:
                start = prot.find(p)
                while start != -1:
                    out.append((f"{'' if rid is None else rid}|{strand}{frame}", p, cnt))
                    start = prot.find(p, start + 1)
    return sorted(out, key=lambda t: (t[0], t[1], -1 if t[2] is None else t[2]))
