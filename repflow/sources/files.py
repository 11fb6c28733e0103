"""File sources (SRC-2..14): discovery, scans with file identity, text formats.

Every scan is one Spark read over all files; file identity comes from the
hidden ``_metadata`` column, never from a driver loop over files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repflow.functions import scalar as S
from repflow.schema import col_ref, validate_columns

# --- fixed values ------------------------------------------------------------
SERIES_END = "!series_matrix_table_begin"
BIOSAMPLE_MARKER = "BioSample:"
DISEASE_MARKER = "ibd_disease:"
# -----------------------------------------------------------------------------


def raw_name(column: str):
    """A file name as it is on disk; the metadata columns hold it percent-encoded."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """SRC-2: ``path, name, length, modificationTime`` of matching files (non-recursive).

    A distributed listing through the ``binaryFile`` source (content pruned).
    Raises ``ValueError`` when nothing matches; a single file must match ``glob``.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "false").load(path)
          .select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime"))
    if df.limit(1).count() == 0:
        raise ValueError(f"No input matching {glob} at {path}")
    return df


def scan_with_source(spark: SparkSession, path: str, columns, glob: str = "*.parquet",
                     ignore_corrupt: bool = False, merge_schema: bool = True) -> DataFrame:
    """SRC-3/4/5/6/8: read every file of a folder once, with ``source_file`` = file name.

    Required columns are checked against the merged schema at plan time.  A
    broken file ends the job unless ``ignore_corrupt`` is asked for; then compare
    :func:`row_counts` with the rows read, as the match run does.
    """
    df = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "false")
          .option("ignoreCorruptFiles", str(ignore_corrupt).lower())
          .option("mergeSchema", str(merge_schema).lower()).parquet(path))
    validate_columns(df, list(columns), path)
    return df.select(*[F.col(col_ref(c)) for c in columns], raw_name("_metadata.file_name").alias("source_file"))


def scan_by_name(spark: SparkSession, path: str, glob: str, columns=None, fmt: str = "parquet", sep: str = ",") -> DataFrame:
    """SRC-8: every file whose name matches ``glob``, with ``source_file`` and the accession ``srx`` of its name (SCL-6).

    ``fmt`` is ``parquet`` or ``csv`` (with header, all columns as text).  ``columns`` are checked at plan time.
    Files without an accession in their name have a null ``srx``; ``ValueError`` when nothing matches.
    """
    list_files(spark, path, glob)
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "false")
    df = reader.option("mergeSchema", "true").parquet(path) if fmt == "parquet" else reader.option("header", "true").option("sep", sep).csv(path)
    if columns:
        validate_columns(df, list(columns), path)
    name = raw_name("_metadata.file_name")
    return df.select(*[F.col(col_ref(c)) for c in (columns or df.columns)], name.alias("source_file"), S.extract_srx(name).alias("srx"))


def row_counts(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """``source_file, footer_rows`` by the files' footers (no column is read); a file without footer is absent."""
    return (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "false")
            .option("ignoreCorruptFiles", "true").option("mergeSchema", "true").parquet(path)
            .groupBy(raw_name("_metadata.file_name").alias("source_file")).agg(F.count(F.lit(1)).alias("footer_rows")))


def scan_match_folder(spark: SparkSession, folder: str, seq_col: str = "CDR3_match",
                      name_pattern: str | None = None, ignore_corrupt: bool = False) -> DataFrame:
    """SRC-6/7: ``sample, CDR3_match`` of a folder of match tables (one sample per file).

    The sample name is the file name with ``matched_``, ``.dedup`` and
    ``.parquet`` removed; with ``name_pattern`` (a regex with one group) it is
    extracted from the full path instead (e.g. ``sample=([^/]+)`` for a
    partitioned layout).
    """
    df = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
          .option("ignoreCorruptFiles", str(ignore_corrupt).lower()).option("mergeSchema", "true").parquet(folder))
    validate_columns(df, [seq_col], folder)
    if name_pattern:
        sample = F.regexp_extract(F.col("_metadata.file_path"), name_pattern, 1)
    else:
        sample = S.normalise_sample_name(raw_name("_metadata.file_name"))
    return df.select(sample.alias("sample"), F.col(col_ref(seq_col)).alias("CDR3_match"))


def read_prefixed_csv(spark: SparkSession, path: str, prefix: str, sep: str = ",") -> DataFrame:
    """SRC-9: CSV/TSV with header, every column renamed ``prefix + name``."""
    df = spark.read.option("header", "true").option("sep", sep).option("inferSchema", "true").csv(path)
    return df.toDF(*[prefix + c for c in df.columns])


def read_run_table(spark: SparkSession, path: str, tissue: str) -> DataFrame:
    """SRC-10: the three run-table columns renamed per tissue."""
    df = spark.read.option("header", "true").csv(path)
    validate_columns(df, ["Sample Name", "Experiment", "Run"], path)
    return df.select(F.col("`Sample Name`").alias(f"GSM_ID_{tissue}"),
                     F.col("Experiment").alias(f"Experiment_{tissue}"), F.col("Run").alias(f"Run_{tissue}"))


def with_line_numbers(raw: DataFrame, name: str = "line_no", file_col: str = "file") -> DataFrame:
    """0-based line number within each file of a raw file scan (JVM only, distributed).

    ``raw`` must come straight from ``spark.read`` (it needs ``_metadata``).
    Rows of one split are read in file order, so ``monotonically_increasing_id``
    orders them; split sizes (one row per split) give each split's offset in
    its file, and rows are numbered only inside their own split.
    """
    d = raw.select("*", F.col("_metadata.file_path").alias(file_col),
                   F.col("_metadata.file_block_start").alias("__s"), F.monotonically_increasing_id().alias("__m"))
    sizes = d.groupBy(file_col, "__s").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(file_col).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select(file_col, "__s", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    d = d.join(F.broadcast(offs), [file_col, "__s"])     # one row per split
    w = Window.partitionBy(file_col, "__s").orderBy("__m")
    return d.withColumn(name, F.col("__o") + F.row_number().over(w) - 1).drop("__s", "__m", "__o")


def parse_series_matrix(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11 + PVT-4: series-matrix header files -> one row per sample.

    Reading stops at the first line holding ``!series_matrix_table_begin``;
    quotes are dropped.  A relation line counts only if it holds
    ``BioSample:`` (each cell -> URL tail), a characteristics line only if it
    holds ``ibd_disease:`` (each cell -> trimmed text after the marker, null
    where a cell lacks it); the last qualifying line of each kind wins.
    ``patient_id`` is the first digit run of the title.  All files in one job.
    """
    lines = with_line_numbers(spark.read.text(path))
    lines = lines.select("file", "line_no", F.trim(F.replace(F.col("value"), F.lit('"'), F.lit(""))).alias("line"))
    end = lines.where(F.col("line").contains(SERIES_END)).groupBy("file").agg(F.min("line_no").alias("__end"))
    lines = lines.join(F.broadcast(end), "file", "left") \
        .where(F.col("__end").isNull() | (F.col("line_no") < F.col("__end")))
    ln = F.col("line")
    kind = (F.when(ln.startswith("!Sample_title"), "Title")
            .when(ln.startswith("!Sample_geo_accession"), "GSM_ID")
            .when(ln.startswith("!Sample_relation") & ln.contains(BIOSAMPLE_MARKER), "BioSample")
            .when(ln.startswith("!Sample_characteristics") & ln.contains(DISEASE_MARKER), "Disease"))
    lines = lines.withColumn("kind", kind).where(F.col("kind").isNotNull())
    last = lines.groupBy("file", "kind").agg(F.max("line_no").alias("line_no"))
    lines = lines.join(last, ["file", "kind", "line_no"], "left_semi")
    cells = lines.select("file", "kind", F.posexplode(F.slice(F.split("line", "\t"), 2, 1 << 30)).alias("pos", "cell"))
    c = F.col("cell")
    tail = S.url_tail(F.trim(F.replace(c, F.lit(BIOSAMPLE_MARKER + " "), F.lit(""))))
    disease = F.when(c.contains(DISEASE_MARKER), F.trim(F.element_at(F.split(c, DISEASE_MARKER), 2)))
    value = F.when(F.col("kind") == "BioSample", tail).when(F.col("kind") == "Disease", disease).otherwise(c)
    cells = cells.select("file", "kind", "pos", value.alias("v"))
    out = cells.groupBy("file", "pos").pivot("kind", ["Title", "GSM_ID", "BioSample", "Disease"]).agg(F.first("v"))
    return out.withColumn("patient_id", S.first_digits(F.col("Title")))


def read_10x_mtx(spark: SparkSession, folder: str, gene_symbols: bool = True) -> DataFrame:
    """SRC-12: 10x ``matrix.mtx`` + ``barcodes.tsv`` + ``features.tsv`` -> COO ``(cell, gene, value)``.

    The matrix is genes x cells (1-based coordinates); barcodes lose every
    ``-1`` (SCL-4).  Lookup tables are numbered by :func:`with_line_numbers`.  The entries are
    neither numbered nor shuffled: of each file with a ``%%MatrixMarket`` banner the first line that is no comment holds
    the sizes and is left out; ``matrix.mtx`` may also be a folder whose further files hold entries only.
    """
    def numbered(name):
        t = spark.read.option("sep", "\t").csv(f"{folder}/{name}")
        return with_line_numbers(t, "__i").withColumn("__i", F.col("__i") + 1).drop("file")

    bc = numbered("barcodes.tsv*").select(F.col("__i").alias("__c"),
                                          S.clean_expression_barcode(F.col("_c0")).alias("cell"))
    ft = numbered("features.tsv*")
    gcol = "_c1" if gene_symbols and "_c1" in ft.columns else "_c0"
    ft = ft.select(F.col("__i").alias("__g"), F.col(gcol).alias("gene"))
    lines = spark.read.text(f"{folder}/matrix.mtx*").select("value", F.col("_metadata.file_path").alias("file"),
                                                            F.monotonically_increasing_id().alias("__m"))
    comment = F.col("value").startswith("%")
    first = lines.groupBy("file").agg(F.bool_or(F.col("value").startswith("%%MatrixMarket")).alias("__banner"),
                                      F.min(F.when(~comment & (F.trim("value") != ""), F.col("__m"))).alias("__m")).where("__banner")
    mtx = lines.where(~comment & (F.trim("value") != "")).join(F.broadcast(first.select("file", "__m")), ["file", "__m"], "left_anti")     # one row per file
    parts = F.split(F.trim("value"), r"\s+")
    coo = mtx.select(parts[0].cast("long").alias("__g"), parts[1].cast("long").alias("__c"),
                     parts[2].cast("double").alias("value"))
    return coo.join(bc, "__c").join(ft, "__g").select("cell", "gene", "value")


def read_publicness(spark: SparkSession, path: str) -> DataFrame:
    """SRC-13: publicness CSV, first row per sequence in file order.

    Grouped minima of (file, split, row): no row is numbered and no sequence's rows are sorted.
    """
    df = spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    validate_columns(df, ["CDR3_match", "publicness_score"], path)
    df = df.select("CDR3_match", "publicness_score", F.col("_metadata.file_path").alias("__file"),
                   F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__row"))
    firsts = df.groupBy("CDR3_match", "__file", "__start").agg(
        F.min("__row").alias("__first"), F.min_by("publicness_score", "__row").alias("publicness_score"))     # one row per sequence and split
    return firsts.groupBy("CDR3_match").agg(F.min_by("publicness_score", F.struct("__file", "__start", "__first")).alias("publicness_score"))


# SRC-14: source folders and output name per sample type
SAMPLE_TYPE_PATHS = {"tumor": ("Tumor", "sc_breast_cache_Tumor.csv"), "lnm": ("LNM", "sc_breast_cache_LNM.csv")}


def paths_for(sample_type: str) -> tuple[str, str]:
    """SRC-14: folder and cache name for a sample type; unknown type -> ``ValueError``."""
    key = sample_type.lower()
    if key not in SAMPLE_TYPE_PATHS:
        raise ValueError(f"Unknown sample type {sample_type!r}; expected one of {sorted(SAMPLE_TYPE_PATHS)}")
    return SAMPLE_TYPE_PATHS[key]
