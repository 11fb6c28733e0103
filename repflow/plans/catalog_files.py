"""Registered queries: file sources and sinks, end to end on data Spark derives.

Each query writes a fixture derived from the driver tables into a fresh
folder under the session's checkpoint dir (shared storage on a cluster), then
runs the library's reader/writer over it.  The DuckDB twin computes the same
result straight from the driver tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from repflow.operators import repertoire as P
from repflow.operators.ranks import running_before
from repflow.plans import fixtures as fx
from repflow.plans.oracle import with_ctes
from repflow.plans.partitioning import sorted_pieces
from repflow.plans.registry import r6, register
from repflow.session import shared_dir
from repflow.sinks import files as SK
from repflow.sources import files as SRC


def _scratch(spark, name):
    return shared_dir(spark, f"repflow-fixtures/{name}-{uuid.uuid4().hex[:12]}")


@register("match_folder_richness", "SRC-6 SRC-7 SNK-1 AGG-1", with_ctes(
    "SELECT sample, count(DISTINCT CDR3_match) AS Unique_CDR3_Count FROM matches GROUP BY sample", "matches"))
def q_folder(spark, sf):
    out = _scratch(spark, "matches")
    m = fx.matches(spark, sf).withColumn("source_file", F.concat("sample", F.lit(".dedup.parquet")))
    SK.write_matches(m.drop("sample"), out)
    scanned = SRC.scan_match_folder(spark, out, name_pattern=r"output=matched_([^/.]+)")
    return P.richness(scanned)


def _write_series_matrix(spark, sf, path):
    s = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))
    k = F.col("k")
    grp = F.when(k % 2 == 1, "blood").otherwise("biopsy")
    disease = (F.when(k % 5 == 0, "UC active").when(k % 5 == 1, "cd").when(k % 5 == 2, "CONTROL")
               .when(k % 5 == 3, None).otherwise("other"))
    # one file per group and 500 samples: a line of the format holds all of a file's samples
    part = F.concat(grp, F.lit("-"), F.floor(k / 500).cast("string"))
    cells = s.select(part.alias("grp"), k,
                     F.concat(F.lit('"P'), (k % 60).cast("string"), F.lit(" sample "), k.cast("string"), F.lit('"')).alias("t"),
                     F.concat(F.lit('"GSM'), k.cast("string"), F.lit('"')).alias("g"),
                     F.concat(F.lit('"BioSample: biosample/SAMN'), k.cast("string"), F.lit('"')).alias("b"),
                     F.concat(F.lit('"SRA: srx'), k.cast("string"), F.lit('"')).alias("r"),
                     F.when(disease.isNull(), F.lit('"tissue: colon"'))
                      .otherwise(F.concat(F.lit('"ibd_disease: '), disease, F.lit('"'))).alias("d"),
                     F.concat(F.lit('"age: '), (k % 80).cast("string"), F.lit('"')).alias("a"))
    per = cells.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("k", "t", "g", "b", "r", "d", "a"))).alias("x"))

    def line(key, field):
        return F.concat(F.lit(key + "\t"), F.array_join(F.transform("x", lambda e: e[field]), "\t"))

    body = [("!Series_title\t\"derived cohort\"", None), ("!Sample_title", "t"), ("!Sample_geo_accession", "g"),
            ("!Sample_relation", "r"), ("!Sample_relation", "b"), ("!Sample_characteristics_ch1", "d"),
            ("!Sample_characteristics_ch1", "a"), ("!series_matrix_table_begin", None),
            ("\"ID_REF\"\t\"GSM0\"", None), ("!Sample_title\t\"after the table\"", None)]
    items = [F.struct(F.lit(i).alias("i"), (line(key, f) if f else F.lit(key)).alias("value"))
             for i, (key, f) in enumerate(body)]
    lines = per.select("grp", F.inline(F.array(*items)))
    (lines.repartition("grp").sortWithinPartitions("grp", "i").select("grp", "value")
     .write.partitionBy("grp").text(path))


@register("series_matrix_parse", "SRC-11 PVT-4 SCL-7 SCL-8", with_ctes("""
    SELECT 'P' || CAST(s_suppkey % 60 AS VARCHAR) || ' sample ' || CAST(s_suppkey AS VARCHAR) AS Title,
           'GSM' || CAST(s_suppkey AS VARCHAR) AS GSM_ID, 'SAMN' || CAST(s_suppkey AS VARCHAR) AS BioSample,
           CASE s_suppkey % 5 WHEN 0 THEN 'UC active' WHEN 1 THEN 'cd' WHEN 2 THEN 'CONTROL' WHEN 3 THEN NULL
                ELSE 'other' END AS Disease,
           CAST(s_suppkey % 60 AS VARCHAR) AS patient_id
    FROM supplier"""))
def q_series(spark, sf):
    path = _scratch(spark, "series")
    _write_series_matrix(spark, sf, path)
    return SRC.parse_series_matrix(spark, path).select("Title", "GSM_ID", "BioSample", "Disease", "patient_id")


@register("incremental_match", "SNK-4 SNK-1", with_ctes("""
    SELECT CAST(CAST(split_part(read_id, '_', 1) AS BIGINT) % 4 AS INTEGER) AS file_group, count(*) AS n_matches
    FROM hits GROUP BY 1""", "hits"))
def q_incremental(spark, sf):
    from repflow.streaming.incremental import match_stream

    base = _scratch(spark, "incremental")
    src, out, ckpt = f"{base}/reads", f"{base}/out", f"{base}/checkpoint"
    reads = fx.reads(spark, sf).select("read_id", "sequence", "count",
                                      (F.split_part("read_id", F.lit("_"), F.lit(1)).cast("bigint") % 4).alias("g"))
    pats = fx.patterns(spark, sf)
    schema = T.StructType([T.StructField("read_id", T.StringType()), T.StructField("sequence", T.StringType()),
                           T.StructField("count", T.LongType())])
    # half of the reads first, the other half arrives later: the rerun only takes the new files
    reads.where("g < 2").drop("g").write.mode("append").parquet(src)
    match_stream(spark, src, pats, out, ckpt, schema)
    reads.where("g >= 2").drop("g").write.mode("append").parquet(src)
    match_stream(spark, src, pats, out, ckpt, schema)
    match_stream(spark, src, pats, out, ckpt, schema)          # nothing new: output unchanged
    res = spark.read.parquet(out)
    return res.groupBy((F.split_part("read_id", F.lit("_"), F.lit(1)).cast("bigint") % 4).cast("int").alias("file_group")) \
        .agg(F.count(F.lit(1)).alias("n_matches"))


def _write_mtx(spark, sf, folder):
    e = fx.expression_barcoded(spark, sf)
    bc = running_before(e.select("barcode").distinct(), [], ["barcode"]).withColumn("c", F.col("before") + 1)
    ft = running_before(e.select("gene").distinct(), [], ["gene"]).withColumn("g", F.col("before") + 1)
    bc.orderBy("c").select("barcode").coalesce(1).write.text(f"{folder}/barcodes.tsv")
    ft.orderBy("g").select(F.concat(F.lit("ENSG"), F.col("g").cast("string"), F.lit("\t"), "gene",
                                    F.lit("\tGene Expression")).alias("value")).coalesce(1).write.text(f"{folder}/features.tsv")
    ent = e.join(bc, "barcode").join(ft, "gene")
    n = ent.agg(F.countDistinct("g"), F.countDistinct("c"), F.count(F.lit(1))).first()
    head = ["%%MatrixMarket matrix coordinate real general", "% derived", " ".join(map(str, n))]
    spark.createDataFrame([("\n".join(head),)], "value string").coalesce(1).write.text(f"{folder}/matrix.mtx")
    # the entries follow in as many files as there are tasks
    ent.select(F.concat_ws(" ", F.col("g").cast("string"), F.col("c").cast("string"), F.col("value").cast("string")).alias("value")) \
        .write.mode("append").text(f"{folder}/matrix.mtx")


@register("tenx_mtx_read", "SRC-12 SCL-4 PVT-5", with_ctes(
    "SELECT replace(barcode, '-1', '') AS cell, gene, round(value, 6) AS value FROM expr_bc", "expr_bc"))
def q_mtx(spark, sf):
    folder = _scratch(spark, "mtx")
    _write_mtx(spark, sf, folder)
    coo = SRC.read_10x_mtx(spark, folder)
    return coo.select("cell", "gene", r6("value").alias("value"))


@register("publicness_csv", "SRC-13 DED-1 SNK-6", with_ctes("""
    SELECT CDR3_match, round(publicness_score, 6) AS publicness_score FROM (
      SELECT *, row_number() OVER (PARTITION BY CDR3_match ORDER BY ord) AS rn FROM publicness) WHERE rn = 1""",
    "publicness"))
def q_publicness(spark, sf):
    path = _scratch(spark, "publicness")
    pub = sorted_pieces(fx.publicness(spark, sf), "ord").select("CDR3_match", "publicness_score")     # files in order of ord
    SK.write_csv(pub, path, files=0)
    p = SRC.read_publicness(spark, path)
    return p.select("CDR3_match", r6("publicness_score").alias("publicness_score"))


@register("vdj_csv_prefixed", "SRC-9 SNK-6", with_ctes("""
    SELECT sample AS vdj_sample, barcode AS vdj_barcode, cdr3 AS vdj_cdr3 FROM contigs""", "contigs"))
def q_vdj_csv(spark, sf):
    path = _scratch(spark, "vdj")
    SK.write_csv(fx.contigs(spark, sf), path, files=0)
    return SRC.read_prefixed_csv(spark, path, "vdj_").select("vdj_sample", "vdj_barcode", "vdj_cdr3")
