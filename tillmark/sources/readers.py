"""File and table sources."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillmark.functions.keys import short_name
from tillmark.sources import schemas


def table_name(file_name: str) -> str | None:
    """Table of a CSV file: the stem with '-' as '_'; None for lookup files, which are loaded on their own."""
    stem = re.sub(r"\.csv$", "", file_name.rsplit("/", 1)[-1])
    return None if stem in schemas.SEEDS else stem.replace("-", "_")


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast by name; a value that does not parse becomes null instead of failing the load."""
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV scan bound by the names in the file's header; other columns are left out, a missing one is an error."""
    text = spark.read.csv(path, header=True, inferSchema=False)
    missing = [name for name in schema.names if name not in text.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return typed(text, schema)


def load_raw(spark: SparkSession, path: str) -> tuple[str, DataFrame] | None:
    """(table, frame) of one raw CSV file, None for a lookup file."""
    table = table_name(path)
    if table is None:
        return None
    if table not in schemas.RAW:
        return table, spark.read.csv(path, header=True, inferSchema=True)
    return table, read_csv(spark, path, schemas.struct(schemas.RAW[table]))


def raw_files(spark: SparkSession, folder: str) -> list[str]:
    """The CSV files of a folder but the lookup files."""
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*.csv")
    found = files.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(files) or []
    return [path for path in sorted(f.getPath().toString() for f in found) if table_name(path)]


def load_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every raw CSV file of a folder by its table; lookup files are left to ``load_seed``."""
    return dict(load_raw(spark, path) for path in raw_files(spark, folder))


def judged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every record of a CSV file with what is wrong with it: file, record, reasons (empty where it loads whole).

    A reason is the name of a column whose text does not parse and so becomes null, or ``fields`` for a record with too
    few or too many of them.  The record is the line of the file where its fields do not fit, else its fields as CSV.
    """
    names = spark.read.csv(path, header=True, inferSchema=False).columns
    line = next(n for n in ("_line", *(f"_line{i}" for i in range(len(names)))) if n not in names)
    as_text = StructType([StructField(n, StringType()) for n in (*names, line)])
    # All columns are asked for, so that the parser sees how many fields a record has.
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": line, "columnPruning": False}
    text = spark.read.schema(as_text).options(**options).csv(path)
    lost = [
        F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields
        if f.name in names
    ]
    broken = F.when(F.col(line).isNotNull(), F.lit("fields"))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.coalesce(F.col(line), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]))).alias("record"),
        F.array_compact(F.array(broken, *lost)).alias("reasons"),
    )


def load_seed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", schemas.struct(schemas.SEEDS[name]))


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A path (anything with a slash) or the name of a catalog table."""
    return spark.read.parquet(source) if "/" in source else spark.read.table(source)


def sales_lines(st_sales: DataFrame) -> DataFrame:
    """Curated sales under the raw column names, only the columns that the customer models read."""
    return st_sales.select(
        F.col("sales_date").alias("SalesDate"),
        F.col("customer_id").alias("CustomerID"),
        F.col("product_id").alias("ProductID"),
        F.col("total_price").alias("TotalPrice"),
        F.col("quantity").alias("Quantity"),
        F.col("discount").alias("Discount"),
        F.col("transaction_number").alias("TransactionNumber"),
    )


SALES_LINE_COLUMNS = (
    "SalesDate", "CustomerID", "ProductID", "TotalPrice", "Quantity", "Discount", "TransactionNumber",
)


def sales_source(spark: SparkSession, curated: str, raw: str | DataFrame) -> DataFrame:
    """The curated sales table, or the raw one (or frame) where the curated table is missing or lacks a column.

    Both problems show up while the plan is analysed, before any task runs; failures of later tasks are not covered.
    """
    try:
        return sales_lines(read_table(spark, curated))
    except AnalysisException:
        lines = read_table(spark, raw) if isinstance(raw, str) else raw
        return lines.select(*SALES_LINE_COLUMNS)


def product_labels(products: DataFrame, categories: DataFrame | None) -> DataFrame:
    """Product id, name, category and price for the customer models."""
    base = products.select(
        F.col("ProductID").alias("product_id"),
        F.col("ProductName").alias("product_name"),
        F.col("CategoryID").alias("category_id"),
        F.col("Price").alias("product_price"),
    )
    if categories is None:
        return base.withColumn("category_name", F.lit(None).cast("string"))
    names = categories.select(F.col("CategoryID").alias("category_id"), F.col("CategoryName").alias("category_name"))
    return base.join(names, "category_id", "left")


def customer_labels(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("CustomerID").alias("customer_id"), short_name("FirstName", "LastName").alias("customer_name")
    )


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], schemas.struct(ddl))


def require_rows(df: DataFrame, label: str) -> DataFrame:
    """Stop early where a table that everything depends on has no row.  Runs one job that reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{label} is empty; nothing can be built from it")
    return df
