"""CSV export for BI tools (S9, S10, B-1, B-2).

Spark writes a directory of part files per output. Its CSV writer trims
leading/trailing spaces and does not quote them by default, which would
change padded values; both are switched off here so a round trip keeps every
value. Only outputs that are small by construction (the yearly summary) are
gathered into one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.operators.reports import explode_list
from marquee.schema import KEY, UNKNOWN


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Write ``df``; ``single_file`` gathers the (small) result into one file,
    sorted rows in their order."""
    if single_file:
        order = "_row"
        df = df.withColumn(order, F.monotonically_increasing_id())
        df = df.repartition(1).sortWithinPartitions(order).drop(order)
    (df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", False)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path))
    return path


def read_csv_export(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read an export back with the writer's options (for round-trip checks)."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path))


def title_countries(titles: DataFrame, key: str = KEY, exclude: str = UNKNOWN) -> DataFrame:
    """B-1: (show_id, country) bridge from the comma list (trimmed tokens)."""
    return explode_list(titles, "country", "country", key=key, exclude=exclude)


def export_for_bi(spark: SparkSession, titles: DataFrame, genres: DataFrame, out_dir: str,
                  summary: DataFrame | None = None, summary_view: str = "yearly_summary",
                  require_dir: bool = False) -> dict[str, str]:
    """B-2: write titles, genres, title_countries and (if available) the yearly
    summary. The summary comes from ``summary`` or, failing that, from a
    session/catalog view named ``summary_view``; if neither exists it is
    skipped and the other exports still succeed.
    """
    out_dir = out_dir.rstrip("/")
    if require_dir:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(out_dir)
        if not p.getFileSystem(spark._jsc.hadoopConfiguration()).isDirectory(p):
            raise FileNotFoundError(f"export folder does not exist: {out_dir}")
    written = {
        "titles": write_csv(titles, f"{out_dir}/titles.csv"),
        "genres": write_csv(genres, f"{out_dir}/genres.csv"),
        "title_countries": write_csv(title_countries(titles), f"{out_dir}/title_countries.csv"),
    }
    if summary is None and spark.catalog.tableExists(summary_view):
        summary = spark.table(summary_view)
    if summary is not None:
        written["yearly_summary"] = write_csv(summary, f"{out_dir}/yearly_summary.csv", single_file=True)
    return written
