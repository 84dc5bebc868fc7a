"""Table sinks and stages: database options, INSERT text, parameter-named stages, generated rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablework.session import scratch_path


def jdbc_options(url: str, dbtable: str, driver: str, *, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None, parts: int | None = None,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Options for ``spark.read.jdbc``/``df.write.jdbc``; with a partition column the read is split."""
    options = {"url": url, "dbtable": dbtable, "driver": driver, "fetchsize": str(fetch_size)}
    if partition_column:
        if None in (lower, upper, parts):
            raise ValueError("a partition column needs lower, upper and parts")
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                    "numPartitions": str(parts)}
    return options


def read_database(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def write_database(df: DataFrame, mode: str = "append", **options):
    df.write.format("jdbc").options(**jdbc_options(**options)).mode(mode).save()


def _literal(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.coalesce(c.cast("string"), F.lit("null"))
    quoted = F.concat(F.lit("'"), F.replace(c.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    return F.coalesce(quoted, F.lit("null"))


def render_inserts(df: DataFrame, table: str, columns: dict[str, str] | None = None) -> DataFrame:
    """One INSERT statement per row; ``columns`` maps data columns to table columns."""
    columns = columns or {c: c for c in df.columns}
    kinds = dict(df.dtypes)
    head = f"INSERT INTO {table}({', '.join(columns.values())}) VALUES("
    values = F.concat_ws(", ", *[_literal(c, kinds[c]) for c in columns])
    return df.select(F.concat(F.lit(head), values, F.lit(")")).alias("statement"))


def stage_path(root: str, name: str, **params) -> str:
    """The one place a stage path is built, for the writer and the reader alike."""
    return "/".join([root, name, *[f"{k}={v}" for k, v in params.items()]])


def _complete(spark: SparkSession, path: str) -> bool:
    """Was the stage written to the end? Spark leaves its commit marker last; half a stage has none."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def stage(df: DataFrame, root: str, name: str, mode: str = "overwrite", **params) -> DataFrame:
    """Write a result to its parameter-named folder and read it back."""
    path = stage_path(root, name, **params)
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reuse_or_build(spark: SparkSession, root: str, name: str, build: Callable[[], DataFrame], **params) -> DataFrame:
    """Read the stage when it is complete, otherwise build and write it."""
    path = stage_path(root, name, **params)
    return spark.read.parquet(path) if _complete(spark, path) else stage(build(), root, name, **params)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Materialise once in the shared folder where several consumers read the same rows."""
    return stage(df, scratch_path(df.sparkSession, name), "rows")


def billing_periods(clients: DataFrame, client: str, periods: str, prefix: str = "M") -> DataFrame:
    """Periods ``M001 .. Mnnn`` per client, padded to the width of the client's number of periods."""
    width = F.length(F.col(periods).cast("string"))
    numbers = clients.select(client, periods, F.explode(F.sequence(F.lit(1), F.col(periods).cast("int"))).alias("i"))
    period = F.concat(F.lit(prefix), F.lpad(F.col("i").cast("string"), width, F.lit("0")))
    return numbers.select(period.alias("billingperiod"), F.col(client).alias("client_id"))


def seeded_digest(seed: int, key: str) -> Column:
    """Text that orders rows at random, the same for a seed and a key wherever the row lies."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))


def random_integers(df: DataFrame, name: str, low: int, high: int, seed: int, key: str) -> DataFrame:
    """Add uniform integers in [low, high] that follow from the seed and the row's key, whatever the partitioning."""
    number = F.conv(F.substring(seeded_digest(seed, key), 1, 12), 16, 10).cast("bigint")
    return df.withColumn(name, (F.pmod(number, F.lit(high - low + 1)) + low).cast("int"))
