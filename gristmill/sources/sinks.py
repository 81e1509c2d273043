"""Parquet tables that take each natural key once: read keys, anti-join, append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.text import deterministic_id
from gristmill.operators.dedup import insert_if_absent, minus_seen, two_key_dedup
from gristmill.schemas import NATURAL_KEYS, TABLES, ddl
from gristmill.session import stage


class Store:
    """The tables below one folder; a single writer at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def create_all(self) -> None:
        """Empty tables where there are none yet."""
        for name in TABLES:
            self.spark.createDataFrame([], ddl(name)).write.mode("ignore").parquet(self.path(name))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(ddl(table)).parquet(self.path(table))

    def exists(self, table: str, **key: str) -> bool:
        rows = self.read(table)
        for column, value in key.items():
            rows = rows.filter(F.col(column) == value)
        return not rows.isEmpty()

    @staticmethod
    def id_of(table: str, *keys: str) -> Column:
        """The identifier of a table's row by its natural key."""
        return deterministic_id(F.lit(table), *[F.col(k) for k in keys])

    def upsert(self, table: str, rows: DataFrame, order: list) -> int:
        """Appends the first row of each key that the table lacks; the number of rows appended. Rows without an identifier of
        their own get that of their key."""
        keys = NATURAL_KEYS[table]
        if table == "products":  # a second key that is unique where it is not null: a row that hits either is refused
            stored = self.read(table)
            new = minus_seen(rows, stored, keys)
            new = new.filter("dedup_key is null").unionByName(minus_seen(new.filter("dedup_key is not null"), stored, ["dedup_key"]))
            new = two_key_dedup(new.withColumn("_address", F.struct(*keys)), "_address", "dedup_key", order).filter("outcome = 'kept'").drop("outcome", "_address")
        else:
            new = insert_if_absent(rows, self.read(table), keys, order)
        if "id" not in new.columns:
            new = new.withColumn("id", self.id_of(table, *keys))
        columns = [c.split()[0] for c in _columns(ddl(table))]
        shaped = stage(new.select(*[F.col(c) if c in new.columns else F.lit(None).alias(c) for c in columns]).to(self.read(table).schema), f"append-{table}")
        n = shaped.count()
        if n:
            shaped.write.mode("append").parquet(self.path(table))
        return n

    def append(self, table: str, rows: DataFrame) -> None:
        columns = [c.split()[0] for c in _columns(ddl(table))]
        shaped = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in columns])
        shaped.to(self.read(table).schema).write.mode("append").parquet(self.path(table))


    def append_run(self, table: str, rows: DataFrame, run: str) -> None:
        """Appends a run's rows, unless the run has rows there already."""
        if self.read(table).filter(F.col("crawl_run_id") == run).isEmpty():
            self.append(table, rows.withColumn("crawl_run_id", F.lit(run)))


def _columns(schema: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[start:i].strip())
            start = i + 1
    return out


def export(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A table as files of another format; nested columns become JSON in flat formats."""
    if fmt == "csv":
        flat = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes]
        df.select(*flat).write.mode("error").option("header", True).csv(path)
    else:
        df.write.mode("error").format(fmt).save(path)
