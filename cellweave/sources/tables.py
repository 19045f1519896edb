"""Annotation, interval, barcode and matrix files."""

from __future__ import annotations

import io
import zipfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.seq import revcomp_upper
from cellweave.operators.features import attribute, named


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """chrom, source, feature, start (from 0), end, score, strand, frame, attributes; comments and short lines left out."""
    columns = "chrom string, source string, feature string, start string, end string, score string, strand string, frame string, attributes string"
    rows = spark.read.csv(path, sep="\t", comment="#", schema=columns, quote="", mode="PERMISSIVE")
    return rows.filter("attributes IS NOT NULL").select(
        "chrom", "source", "feature", (F.expr("try_cast(start AS BIGINT)") - 1).alias("start"), F.expr("try_cast(end AS BIGINT)").alias("end"),
        "score", "strand", "frame", "attributes",
    )


def gtf_features(gtf: DataFrame, kind: str) -> DataFrame:
    """chrom, start, end, strand, label (name, else id) and transcript_id of one kind of record.

    Exons need a transcript; their label is NA where the gene has none.
    """
    label = F.coalesce(named(attribute(F.col("attributes"), "gene_name")), named(attribute(F.col("attributes"), "gene_id")))
    rows = gtf.filter(F.col("feature") == kind).select(
        "chrom", "start", "end", "strand", label.alias("label"), attribute(F.col("attributes"), "transcript_id").alias("transcript_id")
    )
    if kind == "exon":
        return rows.filter("transcript_id IS NOT NULL").fillna("NA", ["label"])
    return rows.filter("label IS NOT NULL")


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start, end, name, score, strand; a bad score is 0 and rows with bad coordinates are left out."""
    rows = spark.read.csv(path, sep="\t", schema="chrom string, start string, end string, name string, score string, strand string", mode="PERMISSIVE")
    cast = lambda c, t: F.expr(f"try_cast({c} AS {t})")
    return rows.select(
        "chrom", cast("start", "BIGINT").alias("start"), cast("end", "BIGINT").alias("end"), "name",
        F.coalesce(cast("score", "INT"), F.lit(0)).alias("score"), F.coalesce("strand", F.lit(".")).alias("strand"),
    ).filter("start IS NOT NULL AND end IS NOT NULL")


def read_whitelist(spark: SparkSession, path: str, reverse: bool = False) -> DataFrame:
    """barcode: distinct entries of a text, gzip or zip file, cut before the first dash."""
    if path.endswith(".zip"):
        def members(content: bytes) -> list[str]:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                return z.read(z.namelist()[0]).decode().splitlines()

        lines = spark.read.format("binaryFile").load(path).select(F.explode(F.udf(members, "array<string>")("content")).alias("value"))
    else:
        lines = spark.read.text(path)
    entry = F.trim(F.substring_index(F.trim("value"), "-", 1))
    rows = lines.select(entry.alias("barcode")).filter("barcode <> ''")
    return rows.select((revcomp_upper(F.col("barcode")) if reverse else F.col("barcode")).alias("barcode")).distinct()


def read_matrix(spark: SparkSession, path: str, feature: str = "gene") -> DataFrame:
    """Long form (feature, barcode, n) of a tab-separated matrix whose first line names the cells; zeros left out.

    A negative or non-integer count raises an error.
    """
    wide = spark.read.csv(path, sep="\t", header=True, mode="FAILFAST")
    cells = wide.columns[1:]
    if len(set(cells)) < len(cells) or any(not c.strip() for c in cells):
        raise ValueError("cells of a matrix must have different names")
    named_cells = F.array(*(F.struct(F.lit(c).alias("barcode"), F.col(f"`{c}`").alias("n")) for c in cells))
    long = wide.select(F.col(wide.columns[0]).alias(feature), F.explode(named_cells).alias("_c")).select(feature, "_c.*")
    bad = ~F.coalesce(F.col("n"), F.lit("")).rlike(r"^\d+$")
    checked = F.when(bad, F.raise_error(F.concat(F.lit("not a count: "), F.coalesce("n", F.lit("NULL"))))).otherwise(F.col("n").cast("long"))
    return long.select(feature, "barcode", checked.alias("n")).filter("n > 0")


def write_mex(matrix: DataFrame, path: str, feature: str = "gene") -> None:
    """Features, barcodes and entries (numbered from 1, by name) as three folders of text for a sparse matrix.

    Numbers come from range-sorted running counts, so that no task holds all names.
    """
    from cellweave.operators.prefix import running_sum

    numbered = {}
    for column in (feature, "barcode"):
        names = matrix.select(column).distinct().withColumn("_one", F.lit(1).cast("long"))
        numbered[column] = running_sum(names, [], [column], {f"_{column}": "_one"}, name="names")[0].select(column, f"_{column}")
        numbered[column].orderBy(f"_{column}").select(F.col(column).alias("value")).write.option("compression", "gzip").text(f"{path}/{column}s")
    entries = matrix.join(numbered[feature], feature).join(numbered["barcode"], "barcode")
    line = F.concat_ws(" ", F.col(f"_{feature}").cast("string"), F.col("_barcode").cast("string"), F.col("n").cast("string"))
    sizes = matrix.agg(F.countDistinct(feature), F.countDistinct("barcode"), F.count("*")).first()
    head = matrix.sparkSession.createDataFrame(
        [(0, "%%MatrixMarket matrix coordinate integer general"), (1, " ".join(map(str, sizes)))], "_k int, value string"
    )
    body = entries.select(F.lit(2).alias("_k"), line.alias("value"), F.col("_barcode").alias("_b"), F.col(f"_{feature}").alias("_f"))
    head.selectExpr("_k", "value", "0L AS _b", "0L AS _f").unionByName(body).orderBy("_k", "_b", "_f").select("value").write.option("compression", "gzip").text(f"{path}/matrix")


def prefix_reference(gtf: DataFrame, prefix: str) -> DataFrame:
    """Contigs and ids of a GTF with a species prefix; already prefixed contigs are an error."""
    twice = F.col("chrom").startswith(f"{prefix}_")
    chrom = F.when(twice, F.raise_error(F.concat(F.lit("already prefixed: "), F.col("chrom")))).otherwise(F.concat_ws("_", F.lit(prefix), "chrom"))
    ids = F.regexp_replace("attributes", r'((?:gene_id|gene_name|transcript_id) ")', f"$1{prefix}_")
    return gtf.withColumns({"chrom": chrom, "attributes": ids})


def prefixed(name: Column, prefix: str) -> Column:
    """`name` with the prefix of its species; one that has it already stays."""
    return F.when(name.startswith(f"{prefix}_"), name).otherwise(F.concat_ws("_", F.lit(prefix), name))


def prefix_sizes(sizes: DataFrame, prefix: str) -> DataFrame:
    """chrom, size with prefixed contigs."""
    return sizes.select(prefixed(F.col("chrom"), prefix).alias("chrom"), "size")


def prefix_bed(bed: DataFrame, prefix: str) -> DataFrame:
    """A BED table with prefixed contigs; of a name of parts joined by | the first and the third are prefixed too."""
    part = lambda x, i: F.when(i.isin(0, 2) & (x != ""), prefixed(x, prefix)).otherwise(x)
    names = F.array_join(F.transform(F.split("name", r"\|", -1), part), "|")
    return bed.withColumns({"chrom": prefixed(F.col("chrom"), prefix), "name": names})


def prefix_fasta(lines: DataFrame, prefix: str) -> DataFrame:
    """FASTA lines (`value`) whose headers have prefixed contigs; a description behind the contig stays."""
    header = F.regexp_extract("value", r"^>(\S+)\s*(.*)$", 1)
    rest = F.regexp_extract("value", r"^>(\S+)\s*(.*)$", 2)
    made = F.concat(F.lit(">"), prefixed(header, prefix), F.when(rest != "", F.concat(F.lit(" "), rest)).otherwise(""))
    return lines.withColumn("value", F.when(header != "", made).otherwise(F.col("value")))


def mixed_reference(parts: dict[str, DataFrame], prefix) -> DataFrame:
    """The tables of several species under each other, each prefixed by one of the functions above."""
    return reduce(DataFrame.unionByName, [prefix(df, name) for name, df in parts.items()])


# Names of the column of barcodes in a list of 10-base codes.
TEN_COLUMNS = ("sequence", "seq", "barcode", "cellbarcode", "序列")


def read_tens(spark: SparkSession, path: str) -> DataFrame:
    """ten: the 10-base codes of a text, comma or tab list in upper case; the column is found by its header, else the first is taken."""
    first = spark.read.text(path).filter(F.trim("value") != "").first()
    head = first[0] if first else ""
    sep = "," if "," in head else "\t"
    names = [c.strip().strip("\ufeff").lower() for c in head.split(sep)]
    at = next((i for i, c in enumerate(names) if c in TEN_COLUMNS), None)
    cells = F.split("value", sep)
    rows = spark.read.text(path).filter(F.trim("value") != "").select("value", F.upper(F.trim(F.get(cells, F.lit(at or 0)))).alias("ten"))
    named_column = F.lower(F.trim(F.regexp_replace(F.get(cells, F.lit(at or 0)), "\ufeff", ""))).isin(*TEN_COLUMNS)
    return rows.filter(~named_column & (F.col("ten") != "")).select("ten")


def read_tmap(spark: SparkSession, path: str) -> DataFrame:
    """qry_id, ref_id, class_code of a tab-separated comparison of assembled with reference transcripts."""
    return spark.read.csv(path, sep="\t", header=True).select("qry_id", "ref_id", "class_code")
