"""Readers of proxy tables. All read text with a fixed schema and coerce, so a bad field becomes null and files split."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import number, to_ka, whole

#: Columns of the tab tables by place.
METHANE_TAB = ("depth_m", "depth_ref", "age_edc1_ka", "age_ka", "value", "value_std")
ISOTOPE_TAB = ("depth_m", "age_ka", "value")
SAMPLE_TEXT, SAMPLE_WHOLE = ("site_name", "entity_name"), ("site_id", "entity_id", "sample_id")
SAMPLE_NUMBER = ("age_bp", "d18o_permille", "d13c_permille", "latitude", "longitude", "depth_sample")
SITE_COLUMNS = ("site_id", "site_name", "wkt", "n_d18o_samples", "n_d13c_samples")


def read_tab_series(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], series_id: str) -> DataFrame:
    """A tab table with a metadata block and a column line: rows (series_id, depth_m, age_ka, value).

    Only rows whose depth and value are numbers stay, which also drops the header, so the read needs no line numbers.
    Other columns may be empty; empty first or last fields keep their place.
    """
    raw = spark.read.csv(paths if isinstance(paths, str) else list(paths), sep="\t", quote="", schema=", ".join(f"{c} string" for c in columns))
    rows = raw.select(F.lit(series_id).alias("series_id"), *[number(F.col(c)).alias(c) for c in ("depth_m", "age_ka", "value")])
    return rows.dropna(subset=["depth_m", "value"])


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df, or a ValueError that names the columns it lacks and those it has. Runs no job."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def first_lines(spark: SparkSession, path: str) -> dict[str, str]:
    """The first line of each file of a path or glob, by its path in plain letters. The driver opens the files side by side through Spark's file systems
    and reads no more than that; files without a line are left out."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = spark.read.text(path).inputFiles()

    def first(uri: str) -> tuple[str, str | None]:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        stream = at.getFileSystem(conf).open(at)
        try:
            codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
            plain = codec.createInputStream(stream) if codec else stream
            return at.toString(), jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        return {f: line for f, line in pool.map(first, files) if line is not None}


def as_path(file: str) -> str:
    """A file's name as a path that Spark takes for this file only, whatever marks of a glob are in it."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", file)


def header_names(line: str, sep: str = ",") -> list[str]:
    """The names in a header line: in lower case, without quotes, blanks or a byte-order mark around them."""
    return [c.strip("\ufeff \"\t\r").lower() for c in line.split(sep)]


def read_by_header(spark: SparkSession, path: str, need: Sequence[str], sep: str = ",", escape: str = "\\") -> DataFrame:
    """Delimited files as text columns named by each file's own header, and `source`, the file.

    Files may differ in their columns and in the order of these: those of one header are read together, and a column that
    some lack is null there. A file that lacks one of `need` raises and names it.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted(first_lines(spark, path).items()):
        groups.setdefault(tuple(header_names(line, sep)), []).append(file)
    parts = []
    for names, files in sorted(groups.items()):
        if missing := [c for c in need if c not in names]:
            raise ValueError(f"missing columns {missing}; found {list(names)} in {files[:5]}")
        schema = ", ".join(f"`{c}` string" for c in names)
        parts.append(spark.read.csv([as_path(f) for f in files], header=True, schema=schema, enforceSchema=True, sep=sep, escape=escape).withColumn("source", F.input_file_name()))
    if not parts:
        raise ValueError(f"missing columns {list(need)}; found no header in {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Sample tables by glob: one wide schema, optional columns null where a file lacks them, age in ka, file name kept.

    Each file is read by its own header (read_by_header). Rows without an age are dropped.
    """
    raw = read_by_header(spark, path, ("site_id", "site_name", "entity_id", "sample_id", "age_bp", "d18o_permille", "d13c_permille"))
    get = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    rows = raw.select(*[whole(get(c)).alias(c) for c in SAMPLE_WHOLE], *[get(c).alias(c) for c in SAMPLE_TEXT], *[number(get(c)).alias(c) for c in SAMPLE_NUMBER], "source")
    return rows.withColumn("age_ka", to_ka(F.col("age_bp"))).dropna(subset=["age_bp"])


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Site tables by glob, each by its own header; rows without site_id or geometry are dropped, missing counts stay null."""
    raw = read_by_header(spark, path, SITE_COLUMNS, escape='"')
    return raw.select(whole(F.col("site_id")).alias("site_id"), "site_name", "wkt", whole(F.col("n_d18o_samples")).alias("n_d18o"), whole(F.col("n_d13c_samples")).alias("n_d13c")).dropna(subset=["site_id", "wkt"])


def read_delimited_proxy(spark: SparkSession, path: str, proxy: str, sep: str = ";", scale: float = 1.0, offset: float = 0.0, required: Sequence[str] = ("depth", "age")) -> DataFrame:
    """Tables with `depth`, `age` and the proxy's column, each by its own header, in any case and with a byte-order mark: (series_id,
    age, value), ages shifted to their datum, rows without age or value dropped. A file that lacks the proxy's column or one of
    `required` raises."""
    raw = read_by_header(spark, path, tuple(dict.fromkeys((*required, "age", proxy.lower()))), sep)
    rows = raw.select(F.lit(proxy).alias("series_id"), (number(F.col("age")) * scale + offset).alias("age"), number(F.col(proxy.lower())).alias("value"))
    return rows.dropna(subset=["age", "value"])


def load_sources(spark: SparkSession, configs: Sequence[dict]) -> tuple[DataFrame, DataFrame]:
    """All sources that can be read, and a table (series_id, status, rows) of all that were asked for.

    A config has series_id, path and the options of read_delimited_proxy. A missing file or column is noted and skipped
    before anything is read. The sources are counted in one job; only if that fails is each counted by itself, so that a
    file which fails while it is read is noted and skipped as well, and the others go on.
    """
    parts: list[DataFrame] = []
    status: list[list] = []

    def noted(at: int, e: Exception) -> None:
        status[at][1:] = f"skipped: {str(e).splitlines()[0][:200]}", 0

    for c in configs:
        status.append([c["series_id"], "ok", 0])
        try:
            parts.append(read_delimited_proxy(spark, c["path"], c["series_id"], c.get("sep", ";"), c.get("scale", 1.0), c.get("offset", 0.0), c.get("required", ("depth", "age"))))
        except (PySparkException, Py4JJavaError, ValueError) as e:
            noted(len(status) - 1, e)
    at = [i for i, s in enumerate(status) if s[1] == "ok"]
    try:
        tagged = [p.select(F.lit(i).alias("i")) for i, p in zip(at, parts)]
        for r in reduce(DataFrame.unionByName, tagged).groupBy("i").count().collect() if tagged else ():
            status[r.i][2] = r["count"]
    except (PySparkException, Py4JJavaError):
        for i, p in zip(at, parts):
            try:
                status[i][2] = p.count()
            except (PySparkException, Py4JJavaError) as e:
                noted(i, e)
    good = [p for i, p in zip(at, parts) if status[i][1] == "ok"]
    rows = reduce(DataFrame.unionByName, good) if good else spark.createDataFrame([], "series_id string, age double, value double")
    return rows, spark.createDataFrame([tuple(s) for s in status], "series_id string, status string, rows long")
