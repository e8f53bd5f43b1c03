"""The driver's tables and genotype-shaped views over them, as DataFrames and as DuckDB text.

A cohort is three tables: rows (sites, key vid), cols (samples, key sid) and entries (one row a cell, key (vid, sid)).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

SAMPLES = """SELECT c_custkey AS sid, concat('S', lpad(cast(c_custkey AS string), 6, '0')) AS s, c_mktsegment AS cohort, r_name AS pop,
  c_custkey % 2 = 0 AS is_female
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""

VARIANTS = """SELECT p_partkey AS vid,
  CASE WHEN p_partkey % 24 < 22 THEN concat('chr', cast(p_partkey % 24 + 1 AS string)) WHEN p_partkey % 24 = 22 THEN 'chrX' ELSE 'chrY' END AS contig,
  p_partkey * 37 + 1000 AS position,
  CASE WHEN p_partkey % 10 = 8 THEN concat(substr('ACGT', cast(1 + p_size % 4 AS int), 1), repeat('G', cast(1 + p_size % 5 AS int)))
    ELSE substr('ACGT', cast(1 + p_size % 4 AS int), 1) END AS ref,
  CASE WHEN p_partkey % 10 < 6 THEN substr('ACGT', cast(1 + (p_size + 1 + p_partkey % 3) % 4 AS int), 1)
    WHEN p_partkey % 10 < 8 THEN concat(substr('ACGT', cast(1 + p_size % 4 AS int), 1), repeat('T', cast(1 + p_size % 5 AS int)))
    WHEN p_partkey % 10 = 8 THEN substr('ACGT', cast(1 + p_size % 4 AS int), 1) ELSE '*' END AS alt,
  cast(p_partkey * 13 % 300 AS double) * 0.1 AS QD, cast(p_partkey * 7 % 800 AS double) * 0.1 AS FS, cast(p_partkey * 11 % 600 AS double) * 0.1 + 10.0 AS MQ,
  1 + p_partkey % 5 AS AC, p_partkey % 4 = 0 AS was_split, p_partkey % 3 = 0 AS hapmap, p_partkey % 5 = 0 AS omni
FROM {part}"""

DENSE = """SELECT p_partkey AS vid, c_custkey AS sid,
  CASE WHEN h % 20 = 0 THEN NULL WHEN h < 20 + p_partkey % 40 THEN 2 WHEN h < 40 + p_partkey % 50 THEN 1 ELSE 0 END AS n_alt,
  h2 % 100 AS gq, h2 % 37 + 2 AS dp, h2 % 19 AS ad_alt
FROM (SELECT p_partkey, c_custkey, (p_partkey * 7919 + c_custkey * 104729 + (p_partkey * c_custkey) % 251) % 101 AS h,
    (p_partkey * 31337 + c_custkey * 2741) % 997 AS h2
  FROM {part} CROSS JOIN {customer} WHERE p_partkey < 200 AND c_custkey < 150) q"""

SPARSE = """SELECT l_partkey AS vid, o_custkey AS sid, min((l_orderkey + l_linenumber) % 3) AS n_alt, max(l_quantity) AS dp, count(*) AS n_dup
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY l_partkey, o_custkey"""

FAM = """SELECT c_custkey AS proband, c_custkey - 2 AS father, c_custkey - 1 AS mother, c_custkey - 2 AS fam_id, c_custkey % 2 = 0 AS is_female
FROM {customer} WHERE c_custkey % 3 = 2 AND c_custkey < 150"""

ANNOTATED = f"""SELECT v.*, vid % 6 = 0 AS transmitted_singleton, CASE WHEN vid % 3 <> 0 THEN cast(vid % 37 AS double) / 36 END AS p_de_novo,
  CASE WHEN vid % 4 = 0 THEN 'HIGH' WHEN vid % 4 = 1 THEN 'MEDIUM' WHEN vid % 4 = 2 THEN 'LOW' END AS confidence,
  CASE WHEN vid % 5 = 0 THEN 'synonymous_variant' WHEN vid % 5 = 1 THEN 'missense_variant' END AS consequence,
  CASE WHEN vid % 29 = 0 THEN 'De novo constitutive' WHEN vid % 29 = 1 THEN 'Maternally inherited' END AS inheritance,
  vid % 3 AS unrelated_ac, vid % 4 AS errors, vid % 2 AS t, vid % 7 AS u, vid % 3 AS n_transmitted, vid % 4 AS n_untransmitted, AC AS ac_raw,
  vid % 7 = 0 AS mills, vid % 11 = 0 AS kgp_phase1_hc, QD < 2 OR FS > 60 OR MQ < 30 AS fail_hard_filters, cast(vid * 13 % 300 AS double) / 300 AS score
FROM ({VARIANTS}) v"""

VIEWS = {"v_annotated": ANNOTATED, "v_samples": SAMPLES, "v_variants": VARIANTS, "v_entries": DENSE, "v_sparse": SPARSE, "v_fam": FAM}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text})


def duck(query: str) -> str:
    """query with the views it names in front, as DuckDB reads it."""
    used = [n for n in VIEWS if n in query]
    ctes = [f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in used]
    if not ctes:
        return query
    body = query.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {', '.join(ctes)}, {body[5:]}"
    return f"WITH {', '.join(ctes)} {body}"


@dataclass
class Cohort:
    """Sites, samples and cells; constants holds what the whole cohort shares, as plain Python values."""

    rows: DataFrame
    cols: DataFrame
    entries: DataFrame
    constants: dict = field(default_factory=dict)

    @classmethod
    def load(cls, spark: SparkSession, sf_dir: str, sparse: bool = False) -> Cohort:
        return cls(*(view(spark, sf_dir, n) for n in ("v_variants", "v_samples", "v_sparse" if sparse else "v_entries")))

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Cohort:
        constants = json.loads(spark.read.text(f"{path}/constants", wholetext=True).first()[0])
        return cls(*(spark.read.parquet(f"{path}/{n}") for n in ("rows", "cols", "entries")), constants)

    def write(self, path: str, mode: str = "overwrite") -> None:
        """Rows and entries sorted by site within range partitions, so that site filters prune files; constants as JSON."""
        key = [c for c in ("contig_rank", "position", "vid") if c in self.rows.columns]
        self.rows.repartitionByRange(*key).sortWithinPartitions(*key).write.mode(mode).parquet(f"{path}/rows")
        self.cols.write.mode(mode).parquet(f"{path}/cols")
        self.entries.repartitionByRange("vid").sortWithinPartitions("vid", "sid").write.mode(mode).parquet(f"{path}/entries")
        text = self.rows.sparkSession.createDataFrame([(json.dumps(self.constants),)], "value string")
        text.coalesce(1).write.mode(mode).text(f"{path}/constants")

    def table(self) -> DataFrame:
        """Cells with the fields of both axes; the sample axis is the small one."""
        clash = [c for c in self.rows.columns if c != "vid" and c in self.entries.columns]
        return self.entries.join(self.cols, "sid").join(self.rows.drop(*clash), "vid")

    def count(self) -> tuple[int, int]:
        return self.rows.count(), self.cols.count()

    def filter_rows(self, p) -> Cohort:
        rows = self.rows.filter(p)
        return Cohort(rows, self.cols, self.entries.join(rows.select("vid"), "vid", "left_semi"), self.constants)

    def filter_cols(self, p) -> Cohort:
        cols = self.cols.filter(p)
        return Cohort(self.rows, cols, self.entries.join(cols.select("sid"), "sid", "left_semi"), self.constants)

    def filter_entries(self, p) -> Cohort:
        """Cells that fail become missing: their row goes from the long form, site and sample stay."""
        return Cohort(self.rows, self.cols, self.entries.filter(p), self.constants)

    def unfilter_entries(self) -> Cohort:
        """Every cell of the grid is there again, with missing fields where it had been filtered."""
        grid = self.rows.select("vid").crossJoin(self.cols.select("sid"))
        return Cohort(self.rows, self.cols, grid.join(self.entries, ["vid", "sid"], "left"), self.constants)

    def union_rows(self, other: Cohort) -> Cohort:
        return Cohort(self.rows.unionByName(other.rows), self.cols, self.entries.unionByName(other.entries), self.constants)

    def annotate_constants(self, **values) -> Cohort:
        return Cohort(self.rows, self.cols, self.entries, {**self.constants, **values})
