"""Genetic code and six-frame translation as native Spark expressions.

Translation stays JVM-side: each codon becomes an index into a 64-letter
string (``instr`` over ``TCAG`` gives each base its digit), evaluated in a
higher-order ``transform`` over the codon positions.  No Python touches a row.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (standard genetic code, must match for right results) ----
# Bases in codon-table order, and the amino acid for each codon when the 64
# codons are listed with first, second and third base each running T, C, A, G.
CODON_BASES = "TCAG"
STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
STOP = "*"
UNKNOWN_AA = "X"
# IUPAC nucleotide letters accepted in a read (others reject the read).
IUPAC_NUCLEOTIDES = "ACGTURYSWKMBDHVN"
# Frame labels in output order.
FRAME_ORDER = (("+", 0), ("+", 1), ("+", 2), ("-", 0), ("-", 1), ("-", 2))
# ---------------------------------------------------------------------------


def normalise_nucleotides(seq: Column) -> Column:
    """Upper-case and map RNA ``U`` to ``T``."""
    return F.translate(F.upper(seq), "U", "T")


def reverse_complement(seq: Column) -> Column:
    """Reverse complement of an upper-case ACGT string (other letters kept)."""
    return F.translate(F.reverse(seq), "ACGT", "TGCA")


def is_valid_read(seq: Column) -> Column:
    """True when every letter is an IUPAC nucleotide code (empty is valid)."""
    return seq.rlike(f"^[{IUPAC_NUCLEOTIDES}]*$")


def translate_frame(seq: Column, offset: int, code: str = STANDARD_CODE) -> Column:
    """Protein of one forward frame of ``seq`` (already normalised).

    Codon ``k`` starts at ``offset + 3k + 1``.  A codon with any letter
    outside ``TCAG`` translates to ``X``.
    """
    n_codons = F.floor((F.length(seq) - F.lit(offset)) / F.lit(3)).cast("int")

    def aa(k: Column) -> Column:
        start = k * 3 + F.lit(offset + 1)
        d1 = F.instr(F.lit(CODON_BASES), F.substring(seq, start, 1))
        d2 = F.instr(F.lit(CODON_BASES), F.substring(seq, start + 1, 1))
        d3 = F.instr(F.lit(CODON_BASES), F.substring(seq, start + 2, 1))
        idx = (d1 - 1) * 16 + (d2 - 1) * 4 + d3
        ok = (d1 > 0) & (d2 > 0) & (d3 > 0)
        return F.when(ok, F.substring(F.lit(code), idx, 1)).otherwise(F.lit(UNKNOWN_AA))

    positions = F.when(n_codons > 0, F.sequence(F.lit(0), n_codons - 1)).otherwise(
        F.array().cast("array<int>"))
    return F.array_join(F.transform(positions, aa), "")


def six_frames(seq: Column, code: str = STANDARD_CODE) -> Column:
    """``array<struct<strand, frame, protein>>`` in the order +0 +1 +2 -0 -1 -2."""
    rc = reverse_complement(seq)
    items = []
    for strand, frame in FRAME_ORDER:
        src = seq if strand == "+" else rc
        items.append(F.struct(F.lit(strand).alias("strand"),
                              F.lit(frame).alias("frame"),
                              translate_frame(src, frame, code).alias("protein")))
    return F.array(*items)


# --- vectorised Arrow kernel (fast path) -----------------------------------
# Same translation as ``translate_frame`` computed over a whole Arrow batch at
# once with numpy: one gather per codon position across all reads, no Python
# loop over rows.  Used through ``arrow_udf``; Spark still partitions the work.

def _kernel_tables(code: str):
    import numpy as np
    digit = np.full(256, 4, dtype=np.uint8)          # 4 marks a non-TCAG letter
    for i, ch in enumerate(CODON_BASES.encode()):
        digit[ch] = i
    # index 0..63 -> amino acid; any codon holding a 4 maps to 'X' (index 64+)
    aa = np.frombuffer((code + UNKNOWN_AA).encode(), dtype=np.uint8)
    return digit, aa


def _translate_batch(arr, code: str = STANDARD_CODE):
    """pa.StringArray of normalised reads -> six pa.StringArray proteins."""
    import numpy as np
    import pyarrow as pa

    digit, aa = _kernel_tables(code)
    arr = arr.cast(pa.large_string()) if arr.type != pa.large_string() else arr
    n = len(arr)
    if arr.null_count:
        arr = pa.compute.fill_null(arr, "")
    bufs = arr.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64)[arr.offset:arr.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    d = digit[data]
    starts = offsets[:-1]
    lengths = offsets[1:] - starts
    # complement in digit space: T<->A (0<->2), C<->G (1<->3); unknown stays 4
    comp = np.array([2, 3, 0, 1, 4], dtype=np.uint8)
    out = []
    for strand, frame in FRAME_ORDER:
        k = np.maximum((lengths - frame) // 3, 0)
        total = int(k.sum())
        out_off = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(k, out=out_off[1:])
        row = np.repeat(np.arange(n), k)
        j = np.arange(total, dtype=np.int64) - out_off[:-1][row]
        if strand == "+":
            p = starts[row] + frame + 3 * j
            b1, b2, b3 = d[p], d[p + 1], d[p + 2]
        else:
            # rc position q maps to original position L-1-q, complemented
            last = starts[row] + lengths[row] - 1 - frame - 3 * j
            b1, b2, b3 = comp[d[last]], comp[d[last - 1]], comp[d[last - 2]]
        idx = b1.astype(np.int64) * 16 + b2 * 4 + b3
        idx = np.where((b1 > 3) | (b2 > 3) | (b3 > 3), 64, idx)
        letters = aa[idx]
        out.append(pa.LargeStringArray.from_buffers(
            n, pa.py_buffer(out_off.tobytes()), pa.py_buffer(letters.tobytes())).cast(pa.string()))
    return out


def six_frames_arrow_udf(code: str = STANDARD_CODE):
    """``arrow_udf`` mapping a normalised read to ``struct<p0,p1,p2,m0,m1,m2>``."""
    from pyspark.sql.functions import arrow_udf

    names = [f"{'p' if s == '+' else 'm'}{f}" for s, f in FRAME_ORDER]

    @arrow_udf(", ".join(f"{c} string" for c in names))
    def six_frame_proteins(seq: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(_translate_batch(seq, code), names=names)

    return six_frame_proteins, names
