"""Readers and writers of variant text, regions, pedigrees, annotations and tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.expr import contig_rank, parse_locus
from gridloom.sources import bgzip


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(p) and files.getFileStatus(p).isDirectory()


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(f.getPath().toString() for f in found if f.getPath().getName().endswith(suffix))


def text_lines(spark: SparkSession, path: str | list[str], force_blocks: bool = False) -> DataFrame:
    """(value, file): lines of plain, gzip and block-gzip files, or of folders.

    Files named .bgz, folders that hold such files, and with force_blocks all files, are read by blocks, many tasks a file;
    a plain gzip file is one task.
    """
    paths = [path] if isinstance(path, str) else list(path)

    def blocked(p: str) -> bool:
        return force_blocks or p.endswith(".bgz") or (not p.endswith(".gz") and is_folder(spark, p) and bool(list_files(spark, p, ".bgz")))

    by_blocks = [p for p in paths if blocked(p)]
    others = [p for p in paths if p not in by_blocks]
    plain = spark.read.text(others).withColumn("file", F.input_file_name()) if others else None
    if not by_blocks:
        return plain
    lines = bgzip.read_lines(spark, by_blocks)
    return lines if plain is None else plain.unionByName(lines)


def vcf_samples(spark: SparkSession, path: str | list[str], force_bgz: bool = False) -> list[str]:
    """Sample names of the header line; text without such a line is no VCF and fails."""
    head = text_lines(spark, path, force_bgz).filter(F.col("value").startswith("#CHROM")).select("value").first()
    if head is None:
        raise ValueError(f"no #CHROM line in {path}")
    return head[0].split("\t")[9:]


def read_vcf(spark: SparkSession, path: str | list[str], header: str | None = None, skip_invalid: bool = True, info: dict[str, str] | None = None, force_bgz: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sites, samples, cells) of VCF text; header names a file that holds the header when the shards have none.

    Sites have alts as an array, filters as a sorted set and the info fields asked for (name -> Spark type; arrays by
    element type in "array<...>"). force_bgz reads .gz names by blocks. Cells are long: alleles as an index array (missing for no call), phased, n_alt, gq,
    dp and ad. Sites on contigs that are not known, or without a position, are skipped or fail the read.
    """
    names = vcf_samples(spark, header or path, force_bgz and header is None)
    f = F.split("value", "\t")
    rows = text_lines(spark, path, force_bgz).filter(~F.col("value").startswith("#") & (F.col("value") != "")).withColumn("f", f)
    at = lambda i: F.get("f", F.lit(i))
    position = at(1).try_cast("bigint")
    known = contig_rank(at(0)).isNotNull() & position.isNotNull()
    rows = rows.filter(known) if skip_invalid else rows.withColumn("f", F.when(known, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("invalid locus: "), F.col("value")))))
    pairs = F.map_from_entries(F.transform(F.split(at(7), ";"), lambda p: F.struct(F.substring_index(p, "=", 1), F.when(p.contains("="), F.substring(p, F.length(F.substring_index(p, "=", 1)) + 2, F.length(p))))))
    site = {
        "contig": at(0), "contig_rank": contig_rank(at(0)), "position": position, "rsid": F.nullif(at(2), F.lit(".")), "ref": at(3), "alts": F.filter(F.split(at(4), ","), lambda a: a != "."),
        "qual": F.nullif(at(5), F.lit(".")).try_cast("double"), "filters": F.when(at(6) != ".", F.array_sort(F.filter(F.split(at(6), ";"), lambda x: x != "PASS"))), "file": F.col("file"),
    }
    for name, kind in (info or {}).items():
        value = F.nullif(F.try_element_at("__info", F.lit(name)), F.lit("."))
        site[name] = F.map_contains_key(F.col("__info"), name) if kind == "boolean" else F.split(value, ",").try_cast(kind) if kind.startswith("array") else value.try_cast(kind)
    rows = rows.withColumn("vid", F.xxhash64(at(0), at(1), at(3), at(4)))
    sites = rows.withColumn("__info", pairs).select("vid", *[v.alias(k) for k, v in site.items()])
    samples = spark.createDataFrame([(i, s) for i, s in enumerate(names)], "sid long, s string")
    cells = rows.select("vid", F.split(at(8), ":").alias("format"), F.posexplode(F.slice("f", 10, max(1, len(names)))).alias("sid", "call")) if names else rows.limit(0).select("vid", F.array().cast("array<string>").alias("format"), F.lit(0).alias("sid"), F.lit("").alias("call"))
    values = F.split("call", ":")

    def of(key: str) -> Column:
        i = F.array_position("format", F.lit(key))
        return F.nullif(F.when(i > 0, F.get(values, (i - 1).cast("int"))), F.lit("."))

    alleles = F.transform(F.split(of("GT"), "[/|]"), lambda a: a.try_cast("int"))
    alleles = F.when(~F.exists(alleles, lambda a: a.isNull()), alleles)
    cells = cells.select("vid", F.col("sid").cast("long").alias("sid"), alleles.alias("alleles"), of("GT").contains("|").alias("phased"), F.size(F.filter(alleles, lambda a: a > 0)).alias("n_alt"), of("GQ").try_cast("int").alias("gq"), of("DP").try_cast("int").alias("dp"), F.transform(F.split(of("AD"), ","), lambda x: x.try_cast("int")).alias("ad"))
    return sites, samples, cells.withColumn("n_alt", F.when(F.col("alleles").isNotNull(), F.col("n_alt")))


def with_chromosome(df: DataFrame, pattern: str = r"chr([0-9]+|X|Y)") -> DataFrame:
    """chromosome taken from the name of the file each row was read from."""
    return df.withColumn("chromosome", F.regexp_extract("file", pattern, 0))


def _csv_lines(spark: SparkSession, path: str, sep: str, header: bool, impute: bool) -> DataFrame:
    """Delimited text of a block-gzip file: the first line names the columns and is left out wherever it stands."""
    lines = text_lines(spark, path).select("value").filter("value <> ''")
    first = lines.first()
    if first is None:
        return spark.createDataFrame([], "value string")
    names = first[0].split(sep)
    body = lines.filter(F.col("value") != first[0]) if header else lines
    d = body.select(F.split("value", F.lit("\\Q" + sep + "\\E"), -1).alias("f")).select(*[F.nullif(F.get("f", F.lit(i)), F.lit("")).alias(n if header else f"_c{i}") for i, n in enumerate(names)])
    if impute:
        kinds = {c: "bigint" if not bad_int else "double" if not bad_float else "string" for c, bad_int, bad_float in _kinds(d)}
        d = d.select(*[F.col(f"`{c}`").try_cast(k).alias(c) for c, k in kinds.items()])
    return d


def _kinds(d: DataFrame) -> list[tuple[str, int, int]]:
    """(column, values that are no integer, values that are no number), in one pass."""
    bad = lambda c, kind: F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(kind).isNull())
    row = d.agg(*[x.alias(f"x{2 * i + j}") for i, c in enumerate(d.columns) for j, x in enumerate((bad(c, "bigint"), bad(c, "double")))]).first()
    return [(c, row[2 * i], row[2 * i + 1]) for i, c in enumerate(d.columns)]


def read_table(spark: SparkSession, path: str, header: bool = True, types: dict[str, str] | None = None, sep: str = "\t", impute: bool = False, min_partitions: int | None = None) -> DataFrame:
    """Delimited text; without a header the columns are f0, f1, ...; types may name "locus" for contig:position."""
    d = spark.read.csv(path, sep=sep, header=header, inferSchema=impute) if not path.endswith(".bgz") else _csv_lines(spark, path, sep, header, impute)
    d = d if header else d.toDF(*[f"f{i}" for i in range(len(d.columns))])
    for c, kind in (types or {}).items():
        d = d.withColumn(c, parse_locus(c) if kind == "locus" else F.col(c).try_cast(kind))
    return d.repartition(min_partitions) if min_partitions else d


def read_matrix_text(spark: SparkSession, path: str, row_key: str, value: str = "x") -> DataFrame:
    """(row key, col, value) of a delimited matrix whose header names the columns."""
    d = read_table(spark, path)
    return d.unpivot([row_key], [c for c in d.columns if c != row_key], "col", value)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """Regions of a BED file: 0-based half-open in the file, 1-based half-open (contig, start, end) here."""
    lines = text_lines(spark, path).filter(~F.col("value").rlike(r"^(#|track|browser|\s*$)"))
    f = F.split("value", r"\s+")
    return lines.select(F.get(f, F.lit(0)).alias("contig"), (F.get(f, F.lit(1)).cast("bigint") + 1).alias("start"), (F.get(f, F.lit(2)).cast("bigint") + 1).alias("end"), F.get(f, F.lit(3)).alias("name"))


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """An interval list: contig:start-end lines (half-open), or contig, start, end columns (end included)."""
    t = text_lines(spark, path).filter(~F.col("value").rlike(r"^([@#]|\s*$)"))
    colon = r"^([^:\s]+):([0-9]+)-([0-9]+)\s*$"
    f, by_text = F.split("value", "\t"), F.col("value").rlike(colon)
    part = lambda i: F.when(by_text, F.regexp_extract("value", colon, i + 1)).otherwise(F.get(f, F.lit(i)))
    return t.select(part(0).alias("contig"), part(1).cast("bigint").alias("start"), (part(2).cast("bigint") + F.when(by_text, 0).otherwise(1)).alias("end"))


def read_fam(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Pedigree: fam_id, proband, father, mother ("0" is missing), is_female, phenotype."""
    d = spark.read.csv(path, sep=sep).toDF("fam_id", "proband", "father", "mother", "sex", "phenotype")
    return d.select("fam_id", "proband", F.nullif("father", F.lit("0")).alias("father"), F.nullif("mother", F.lit("0")).alias("mother"), F.when(F.col("sex") == "2", True).when(F.col("sex") == "1", False).alias("is_female"), "phenotype")


def read_json_annotations(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a line; its `input` field is a tab-joined VCF row that gives the key."""
    full = T._parse_datatype_string(schema)
    d = spark.read.text(path).select(F.from_json("value", full).alias("j"))
    f = F.split("j.input", "\t")
    at = lambda i: F.get(f, F.lit(i))
    return d.select(at(0).alias("contig"), at(1).try_cast("bigint").alias("position"), at(3).alias("ref"), at(4).alias("alt"), "j.*")


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as columns with dotted names."""

    def walk(kind: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in kind.fields:
            p = (*path, f.name)
            out += walk(f.dataType, p) if isinstance(f.dataType, T.StructType) else [F.col(".".join(f"`{x}`" for x in p)).alias(sep.join(p))]
        return out

    return df.select(*walk(df.schema, ()))


def export_table(df: DataFrame, path: str, sep: str = "\t", header: bool = True, compression: str | None = "gzip") -> None:
    """Flattened text export; arrays and maps as JSON. compression "bgzip" writes block-gzip, a header line in each part."""
    d = flatten(df)
    nested = [f.name for f in d.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType))]
    d = d.withColumns({n: F.to_json(F.col(f"`{n}`")) for n in nested}) if nested else d
    if compression == "bgzip":
        text = F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in d.columns])
        bgzip.write_lines(_with_head(d.select(text.alias("value")), sep.join(d.columns) if header else None), path)
        return
    d.write.mode("overwrite").csv(path, sep=sep, header=header, compression=compression)


def _with_head(lines: DataFrame, head: str | None) -> DataFrame:
    """lines with a head before the first line of each partition."""
    if head is None:
        return lines

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([head], pa.string())], names=["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["value"])

    return lines.mapInArrow(add, "value string")


def _info_text(sites: DataFrame, names: list[str]) -> Column:
    """key=value pairs of the fields that are not missing, flags by name alone, "." where there is none."""
    kinds, parts = dict(sites.dtypes), []
    for n in names:
        v = F.array_join(F.transform(n, lambda x: x.cast("string")), ",", ".") if kinds[n].startswith("array") else F.col(n).cast("string")
        parts.append(F.when(F.col(n), F.lit(n)) if kinds[n] == "boolean" else F.when(F.col(n).isNotNull(), F.concat(F.lit(f"{n}="), v)))
    return F.coalesce(F.nullif(F.array_join(F.array_compact(F.array(*parts)), ";"), F.lit("")), F.lit(".")) if parts else F.lit(".")


def _call_text(cells: DataFrame) -> tuple[list[str], Column]:
    """(format names, text of a call) from the fields that the cells have."""
    gt = F.array_join(F.transform("alleles", lambda a: a.cast("string")), "/")
    if "phased" in cells.columns:
        gt = F.when(F.col("phased"), F.array_join(F.transform("alleles", lambda a: a.cast("string")), "|")).otherwise(gt)
    fields = {"GT": F.coalesce(gt, F.lit("./."))}
    for name in ("ad", "dp", "gq"):
        if name in cells.columns:
            text = F.array_join(F.transform(name, lambda x: x.cast("string")), ",", ".") if name == "ad" else F.col(name).cast("string")
            fields[name.upper()] = F.coalesce(F.nullif(text, F.lit("")), F.lit("."))
    return list(fields), F.concat_ws(":", *fields.values())


def vcf_lines(sites: DataFrame, cells: DataFrame | None = None, samples: DataFrame | None = None, info: list[str] | None = None) -> DataFrame:
    """(contig_rank, position, line): one tab-joined line a site.

    Calls are laid out over all samples in order of sid, so a cell that is missing, or a site without cells, gives "./."
    in its place. QUAL, INFO (the fields named), phase and the fields AD, DP and GQ are written where they are there;
    missing filters are ".", an empty set is PASS.
    """
    qual = F.when(F.col("qual") == F.floor("qual"), F.col("qual").cast("bigint").cast("string")).otherwise(F.col("qual").cast("string")) if "qual" in sites.columns else F.lit(None).cast("string")
    filters = F.when(F.col("filters").isNull(), ".").when(F.size("filters") > 0, F.array_join("filters", ";")).otherwise("PASS")
    head = [
        F.col("contig"), F.col("position").cast("string"), F.coalesce("rsid", F.lit(".")), F.col("ref"), F.coalesce(F.nullif(F.array_join("alts", ","), F.lit("")), F.lit(".")),
        F.coalesce(qual, F.lit(".")), filters, _info_text(sites, info or []),
    ]
    d = sites
    if cells is not None:
        names, call = _call_text(cells)
        calls = cells.groupBy("vid").agg(F.map_from_entries(F.collect_list(F.struct(F.col("sid").cast("long"), call.alias("call")))).alias("__calls"))
        order = samples.agg(F.array_sort(F.collect_list(F.col("sid").cast("long"))).alias("__order"))  # one row, as wide as a line
        d = d.join(calls, "vid", "left").crossJoin(F.broadcast(order))
        line = F.transform("__order", lambda i: F.coalesce(F.try_element_at("__calls", i), F.lit("./.")))
        head += [F.lit(":".join(names)), F.array_join(line, "\t")]
    return d.select(contig_rank("contig").alias("contig_rank"), "position", F.concat_ws("\t", *head).alias("line"))


def export_vcf(sites: DataFrame, path: str, cells: DataFrame | None = None, samples: DataFrame | list[str] | None = None, info: list[str] | None = None, bgzip_shards: bool = False) -> None:
    """Sorted shards of lines below path/shards, gzip or block-gzip, and one header below path/header.

    samples: (sid, s), or names whose places are the sids.
    """
    spark = sites.sparkSession
    if isinstance(samples, list):
        samples = spark.createDataFrame(list(enumerate(samples)), "sid long, s string")
    cols = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"])
    head = spark.createDataFrame([(0, "##fileformat=VCFv4.2"), (1, cols)], "k int, value string")
    if cells is not None:
        names = samples.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("sid").cast("long"), "s"))), lambda x: x["s"]), "\t").alias("names"))
        head = head.crossJoin(F.broadcast(names)).select("k", F.when(F.col("k") == 1, F.concat_ws("\t", "value", F.lit("FORMAT"), "names")).otherwise(F.col("value")).alias("value"))
    head.coalesce(1).sortWithinPartitions("k").select("value").write.mode("overwrite").text(f"{path}/header")
    lines = vcf_lines(sites, cells, samples, info).repartitionByRange("contig_rank", "position").sortWithinPartitions("contig_rank", "position")
    if bgzip_shards:
        bgzip.write_lines(lines.select("line"), f"{path}/shards")
    else:
        lines.select("line").write.mode("overwrite").text(f"{path}/shards", compression="gzip")


def export_by_contig(df: DataFrame, path: str) -> None:
    """One write with a folder per contig."""
    df.repartition("contig").write.mode("overwrite").partitionBy("contig").parquet(path)


def export_plink_text(sites: DataFrame, samples: DataFrame, cells: DataFrame, path: str) -> None:
    """Text map and transposed genotypes (tped) with a tfam sample list; calls as allele letters, 0 for missing."""
    order = [r[0] for r in samples.orderBy("sid").select("sid").collect()]
    samples.orderBy("sid").select(F.concat_ws(" ", F.lit("0"), "s", F.lit("0"), F.lit("0"), F.when(F.col("is_female"), "2").otherwise("1"), F.lit("-9"))).coalesce(1).write.mode("overwrite").text(f"{path}/tfam")
    call = F.when(F.col("n_alt") == 0, F.concat_ws(" ", "ref", "ref")).when(F.col("n_alt") == 1, F.concat_ws(" ", "ref", "alt")).when(F.col("n_alt") == 2, F.concat_ws(" ", "alt", "alt"))
    by = cells.join(sites.select("vid", "ref", "alt"), "vid").groupBy("vid").agg(F.map_from_entries(F.collect_list(F.struct("sid", F.coalesce(call, F.lit("0 0")).alias("c")))).alias("m"))
    line = F.concat_ws(" ", F.regexp_replace("contig", "chr", ""), F.concat_ws(":", "contig", "position", "ref", "alt"), F.lit("0"), F.col("position").cast("string"), *[F.coalesce(F.try_element_at("m", F.lit(s)), F.lit("0 0")) for s in order])
    sites.join(by, "vid").select(line).write.mode("overwrite").text(f"{path}/tped")
