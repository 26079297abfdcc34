"""Raw tables, labels, panels and predictions: read and write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnpanel.schema import RAW_TABLES, SCHEMAS


def read_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", "")
    return reader.format(fmt).load(path)


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Use all cores on a table stored in very few splits.

    A single-row-group file is read, and everything up to the first shuffle is
    computed, by one task.  If the scan has fewer splits than half the cores,
    rows are redistributed by their unique ``key`` (no hot key, and no dependence
    on arrival order); a table of a real size has more splits and is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores, *key)


def load_tables(
    spark: SparkSession, root: str, dataset: str, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """The five raw tables of one dataset (train, test1, test2), schemas declared."""
    return {
        name: read_table(spark, f"{root}/{dataset}_{name}.{fmt}", SCHEMAS[name], fmt)
        for name in RAW_TABLES
    }


def load_label(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Labels or predictions: acc_id, survival_time, amount_spent."""
    return read_table(spark, path, SCHEMAS["label"], fmt)


def write_raw(df: DataFrame, root: str, dataset: str, table: str, fmt: str = "parquet") -> str:
    """Store a raw table under the name ``load_tables`` looks for."""
    path = f"{root}/{dataset}_{table}.{fmt}"
    columns = SCHEMAS[table].fieldNames()
    _write(df.select(*columns), fmt).mode("overwrite").save(path)
    return path


def write_panel(df: DataFrame, root: str, dataset: str, variant: str, fmt: str = "parquet") -> str:
    """Store a panel.  ``variant`` is ``raw`` (before imputation) or ``imputed``;
    datasets are partitions, so reading one prunes the others."""
    path = f"{root}/panel_{variant}"
    writer = _write(df.withColumn("dataset", F.lit(dataset)), fmt).mode("overwrite")
    # replace this dataset's partition only
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("dataset").save(path)
    return path


def read_panel(
    spark: SparkSession, root: str, dataset: str, variant: str, schema=None, fmt: str = "parquet"
) -> DataFrame:
    if schema is not None and "dataset" not in schema.fieldNames():
        schema = schema.add("dataset", "string")
    df = read_table(spark, f"{root}/panel_{variant}", schema, fmt)
    return df.where(F.col("dataset") == dataset).drop("dataset")


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """A prediction table: one row per account, with the columns and types of a label table."""
    fields = SCHEMAS["label"].fields
    return write_labels(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]), path, fmt)


def read_predictions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored prediction table; an account that appears twice is an error when it is read."""
    df = load_label(spark, path, fmt)
    rows = F.count(F.lit(1)).over(Window.partitionBy("acc_id"))
    once = F.when(rows == 1, F.col("acc_id")).otherwise(
        F.raise_error(F.concat(F.lit("more than one prediction for account "), F.col("acc_id").cast("string"))).cast("long"))
    return df.withColumn("acc_id", once)


def write_labels(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Label and prediction files.  Row order is no property of the storage;
    sort when the rows are shown."""
    _write(df, fmt).mode("overwrite").save(path)
    return path


def _write(df: DataFrame, fmt: str):
    writer = df.write.format(fmt)
    return writer.option("header", True) if fmt == "csv" else writer


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
