"""Tables in and out: CSV loads, bulk writes, the dataset cache, district feature tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

SAVE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}

CATALOG_SCHEMA = T.StructType([
    T.StructField("feature_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("feature_category_primary", T.StringType()),
    T.StructField("exclude_when_modeling", T.IntegerType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """CSV with a header line that names the columns; None for a blank header.

    With a schema the header must agree with it; without one all columns are text."""
    head = spark.read.text(path).head(1)
    if not head or not head[0][0].strip():
        log.warning("no data to load in %s", path)
        return None
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def cast_columns(df: DataFrame, dtype: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast the named columns; unknown columns or types are an error."""
    unknown = sorted(set(dtype) - set(df.columns))
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    for c, t in dtype.items():
        if not isinstance(t, (str, T.DataType)):
            raise ValueError(f"the type of {c} is not a Spark SQL type")
    return df.withColumns({c: F.col(c).cast(t) for c, t in dtype.items()})


def write_table(df: DataFrame, target: str, if_exists: str = "fail", dtype: Mapping[str, str | T.DataType] | None = None,
                fmt: str = "parquet", as_table: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Bulk write to a path, or to a catalog table with `as_table`.

    if_exists: fail (error), replace, append."""
    if if_exists not in SAVE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(SAVE_MODES)}")
    out = df if dtype is None else cast_columns(df, dtype)
    writer = out.write.mode(SAVE_MODES[if_exists]).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(target) if as_table else writer.save(target)


def csv_to_table(spark: SparkSession, csv_path: str, target: str, schema: T.StructType | str | None = None,
                 as_table: bool = False) -> bool:
    """Append a CSV to a table; False when the file has no header."""
    df = read_csv(spark, csv_path, schema)
    if df is None:
        return False
    write_table(df, target, "append", as_table=as_table)
    return True


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The parquet table at the path, or None when there is none."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        df = reader.parquet(path)
        df.schema
        return df
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def cached(spark: SparkSession, path: str, build) -> DataFrame:
    """The dataset at `path`; built and written first when it is not there.

    What counts is a one-row note beside it that is written last. Files without it are
    the rest of a job that died: they are written over."""
    note = f"{path.rstrip('/')}.complete"
    found = read_if_exists(spark, note, "complete boolean")
    if found is None or found.isEmpty():
        build().write.mode("overwrite").parquet(path)
        spark.createDataFrame([(True,)], "complete boolean").coalesce(1).write.mode("overwrite").parquet(note)
    return spark.read.parquet(path)


def load_feature_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Feature catalog CSV: feature, table, category, exclusion flag."""
    catalog = read_csv(spark, path, CATALOG_SCHEMA)
    if catalog is None:
        raise ValueError(f"no feature catalog in {path}")
    return catalog


@dataclass(frozen=True)
class DistrictTables:
    """The materialised feature tables of one district."""

    cohort: DataFrame
    static: DataFrame
    yearly: DataFrame
    label: DataFrame
    catalog: DataFrame | None


# Table names below a district.
DISTRICT_TABLES = {
    "cohort": "_cohort",
    "static": "_cohort_feature",
    "yearly": "_cohort_by_year_feature",
    "label": "_label",
    "catalog": "_feature_category",
}


def save_district(root: str, district: str, if_exists: str = "replace", **tables: DataFrame) -> None:
    """Materialise feature tables below root/district."""
    for role, df in tables.items():
        write_table(df, f"{root.rstrip('/')}/{district}/{DISTRICT_TABLES[role]}", if_exists)


def load_district(spark: SparkSession, district: str, root: str | None = None,
                  jdbc: Mapping[str, str] | None = None, with_catalog: bool = False) -> DistrictTables:
    """Feature tables of a district from parquet below `root`, or over JDBC.

    `jdbc` holds reader options (url, driver, and for parallel reads
    partitionColumn, lowerBound, upperBound, numPartitions), with `with_catalog`
    when the feature catalog is there. Below `root` the catalog is optional; any
    other missing table is an error."""
    if (root is None) == (jdbc is None):
        raise ValueError("give either root or jdbc")

    def read(name: str) -> DataFrame | None:
        if root is not None:
            return read_if_exists(spark, f"{root.rstrip('/')}/{district}/{name}")
        return spark.read.format("jdbc").options(**{**jdbc, "dbtable": f"{district}.{name}"}).load()

    found = {}
    for role, name in DISTRICT_TABLES.items():
        if role == "catalog" and jdbc is not None and not with_catalog:
            found[role] = None
            continue
        found[role] = read(name)
        if found[role] is None and role != "catalog":
            raise ValueError(f"district {district!r} has no table {name}")
    return DistrictTables(**found)
