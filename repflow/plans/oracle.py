"""DuckDB twins of the fixture derivations, as named CTEs.

``with_ctes(body, *names)`` prefixes a query body with the CTEs it needs
(dependencies resolved in order).  The driver tables are views in DuckDB.
Written independently of the Spark code: the search twin is a brute-force
``contains`` join that counts every start position.
"""

from __future__ import annotations

from repflow.functions.codon import CODON_BASES, STANDARD_CODE

_CODON = (
    "CASE WHEN instr('{b}', substring(src, f + 3*k + 1, 1)) > 0 "
    "AND instr('{b}', substring(src, f + 3*k + 2, 1)) > 0 "
    "AND instr('{b}', substring(src, f + 3*k + 3, 1)) > 0 "
    "THEN substring('{c}', CAST((instr('{b}', substring(src, f + 3*k + 1, 1)) - 1) * 16 "
    "+ (instr('{b}', substring(src, f + 3*k + 2, 1)) - 1) * 4 "
    "+ instr('{b}', substring(src, f + 3*k + 3, 1)) AS BIGINT), 1) ELSE 'X' END"
).format(b=CODON_BASES, c=STANDARD_CODE)


def translate_sql(src: str, frame: str) -> str:
    """DuckDB expression: protein of frame ``frame`` of nucleotide text ``src``."""
    body = _CODON.replace("src", src).replace("f + ", f"{frame} + ")
    return (f"array_to_string(list_transform(range(0, CAST((length({src}) - {frame}) // 3 AS BIGINT)), "
            f"lambda k: {body}), '')")


DNA = ("translate(regexp_replace(lower({t}), '[^a-z]', '', 'g'), "
       "'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')")

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "docs_dna": ((), f"SELECT doc_id, {DNA.format(t='text')} AS dna FROM documents"),
    "reads": (("docs_dna",), """
        SELECT CAST(doc_id AS VARCHAR) || '_' || CAST(piece AS VARCHAR) AS read_id,
               substring(dna, CAST(piece * 90 + 1 AS BIGINT), 90) AS sequence,
               CAST(piece % 5 + 1 AS BIGINT) AS count,
               'U' || CAST(piece % 50 AS VARCHAR) AS UMI,
               'Z:BC' || CAST(doc_id % 400 AS VARCHAR) || '-1' AS CB
        FROM (SELECT doc_id, dna, unnest(range(0, CAST(ceil(length(dna) / 90.0) AS BIGINT))) AS piece
              FROM docs_dna)"""),
    "frames": (("reads",), f"""
        SELECT read_id, count, UMI, CB, strand, frame,
               {translate_sql('src', 'frame')} AS protein
        FROM (SELECT r.*, s.strand, s.frame,
                     CASE WHEN s.strand = '+' THEN upper(r.sequence)
                          ELSE translate(reverse(upper(r.sequence)), 'ACGT', 'TGCA') END AS src
              FROM reads r CROSS JOIN (VALUES ('+', 0), ('+', 1), ('+', 2), ('-', 0), ('-', 1), ('-', 2))
                   AS s(strand, frame)
              WHERE r.sequence IS NOT NULL)"""),
    "pats": ((), f"""
        SELECT DISTINCT aa FROM (
          SELECT substring(p, CAST(i AS BIGINT), CAST(6 + i % 8 AS BIGINT)) AS aa
          FROM (SELECT p, unnest(range(1, length(p) + 1)) AS i
                FROM (SELECT {translate_sql(DNA.format(t='text'), '0')} AS p FROM benchmark)))
        WHERE length(aa) >= 6 AND NOT contains(aa, '*')"""),
    "hits": (("frames", "pats"), """
        SELECT read_id, strand, frame, count, UMI, CB, aa AS CDR3_match, pos
        FROM (SELECT f.*, p.aa, unnest(range(1, length(f.protein) - length(p.aa) + 2)) AS pos
              FROM frames f JOIN pats p ON contains(f.protein, p.aa))
        WHERE substring(protein, CAST(pos AS BIGINT), length(aa)) = aa"""),
    "matches": ((), """
        SELECT concat('SRR', CAST(1000 + l_suppkey AS VARCHAR)) AS sample,
               concat(CASE WHEN l_partkey % 4 = 0 THEN 'A' ELSE 'C' END,
                      translate(CAST(l_partkey % 500 AS VARCHAR), '0123456789', 'ASRLGQYEFW'),
                      repeat('G', CAST(l_partkey % 35 AS INTEGER))) AS CDR3_match,
               CAST(l_quantity AS BIGINT) AS count,
               CASE WHEN l_suppkey % 2 = 0 THEN 'Biopsy' ELSE 'Blood' END AS Tissue
        FROM lineitem"""),
    "metadata": ((), """
        SELECT s_suppkey AS ord, concat('SRR', CAST(1000 + s_suppkey AS VARCHAR)) AS Run,
               CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(s_suppkey % 60 AS VARCHAR) END AS patient_id,
               CASE s_suppkey % 5 WHEN 0 THEN 'UC active' WHEN 1 THEN 'cd' WHEN 2 THEN 'CONTROL'
                    WHEN 3 THEN NULL ELSE 'other' END AS Disease,
               CASE WHEN s_acctbal > 5000 THEN 'active' ELSE 'inactive' END AS target
        FROM supplier"""),
    "expr": ((), """
        SELECT concat('CELL', CAST(l_orderkey % 1500 AS VARCHAR)) AS cell,
               concat(CASE WHEN l_partkey % 300 < 15 THEN 'MT-' ELSE 'G' END,
                      CAST(l_partkey % 300 AS VARCHAR)) AS gene,
               CAST(sum(l_quantity) AS DOUBLE) AS value
        FROM lineitem GROUP BY 1, 2"""),
    "expr_wide": ((), """
        SELECT concat('CELL', CAST(l_orderkey % 600 AS VARCHAR)) AS cell,
               concat(CASE WHEN l_partkey % 2000 < 20 THEN 'MT-' ELSE 'G' END,
                      CAST(l_partkey % 2000 AS VARCHAR)) AS gene,
               CAST(sum(l_quantity) AS DOUBLE) AS value
        FROM lineitem GROUP BY 1, 2"""),
    "contigs": ((), """
        SELECT DISTINCT concat('SRX', CAST(1000 + l_suppkey % 16 AS VARCHAR), '_vdj') AS sample,
               concat('BC', CAST(l_orderkey % 400 AS VARCHAR), '-1') AS barcode,
               concat('C', translate(CAST(l_partkey % 700 AS VARCHAR), '0123456789', 'ASRLGQYEFW'),
                      repeat('G', CAST(l_partkey % 35 AS INTEGER))) AS cdr3
        FROM lineitem WHERE l_linenumber = 1"""),
    "igblast": ((), """
        SELECT CAST(event_id AS VARCHAR) AS sequence_id, value / 1e7 AS v_support, value / 2e7 AS j_support,
               80 + value % 20 AS v_identity, 80 + (value * 3) % 20 AS j_identity
        FROM events"""),
    "dict_a": ((), """
        SELECT 'SRX' || CAST(1000 + i AS VARCHAR) AS srx, 'P' || CAST(i // 2 AS VARCHAR) AS patient,
               CASE WHEN i % 2 = 0 THEN 'tumor' ELSE 'LNM' END AS sample_type, CAST(i AS INTEGER) AS ord
        FROM range(0, 16) t(i)"""),
    "dict_b": ((), """
        SELECT 'SRX' || CAST(2000 + i AS VARCHAR) AS srx, 'P' || CAST(i // 2 AS VARCHAR) AS patient,
               CASE WHEN i % 2 = 0 THEN 'tumor' ELSE 'LNM' END AS sample_type, CAST(i AS INTEGER) AS ord
        FROM range(0, 16) t(i)"""),
    "sc_matches": ((), """
        SELECT CAST((l_orderkey * 7 + l_linenumber) % 12000 AS VARCHAR) AS seq_id,
               concat('C', translate(CAST((l_partkey + l_suppkey) % 700 AS VARCHAR), '0123456789', 'ASRLGQYEFW'),
                      repeat('G', CAST((l_partkey + l_suppkey) % 35 AS INTEGER))) AS CDR3_match,
               'U' || CAST(l_linenumber AS VARCHAR) AS UMI,
               CASE WHEN l_linenumber = 7 THEN NULL
                    ELSE 'Z:BC' || CAST(l_orderkey % 400 AS VARCHAR) || CASE WHEN l_linenumber = 3 THEN '*' ELSE '-1' END
               END AS CB
        FROM lineitem"""),
    "publicness": ((), """
        SELECT concat('C', translate(CAST(l_partkey % 700 AS VARCHAR), '0123456789', 'ASRLGQYEFW'),
                      repeat('G', CAST(l_partkey % 35 AS INTEGER))) AS CDR3_match,
               l_discount * 10 AS publicness_score, l_orderkey * 10 + l_linenumber AS ord
        FROM lineitem"""),
    "expr_bc": (("expr",), "SELECT *, replace(cell, 'CELL', 'BC') || '-1' AS barcode FROM expr"),
    "cell_types": (("expr_bc",), """
        SELECT barcode AS Cell_Barcode, label AS Annotation_Label FROM (
          SELECT barcode, label, row_number() OVER (PARTITION BY barcode ORDER BY s DESC, label) AS rn FROM (
            SELECT barcode, CASE WHEN g < 100 THEN 'CD4 T cells' WHEN g < 200 THEN 'B cells'
                                 WHEN g < 300 THEN 'Monocytes' END AS label, sum(value) AS s
            FROM (SELECT barcode, CAST(regexp_extract(gene, '(\\d+)', 1) AS INTEGER) AS g, value FROM expr_bc)
            GROUP BY 1, 2))
        WHERE rn = 1"""),
}


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named fixture CTEs (plus ``extra`` CTEs, in order) then ``body``."""
    parts = [f"{n} AS ({CTES[n][1]})" for n in _order(names)]
    for n, q in (extra or {}).items():
        parts.append(f"{n} AS ({q})")
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
