"""Namespace, table sink, descriptions and the data dictionary.

Tables are written as parquet under the schema's LOCATION, which defaults to
a folder of the session's checkpoint dir (shared storage on a cluster), never
to a machine-local warehouse. Comments are re-applied after every overwrite:
an overwrite replaces the table and drops column comments.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .conform import ORDER_MONTH


@dataclass(frozen=True)
class Namespace:
    """A1: ``catalog.schema`` (the catalog defaults to the session catalog)."""
    schema: str = "supply_chain"
    catalog: str = "spark_catalog"

    def fq(self, table: str) -> str:
        return f"`{self.catalog}`.`{self.schema}`.`{table}`"

    @classmethod
    def from_conf(cls, spark: SparkSession) -> "Namespace":
        """A1: the namespace from ``quartermaster.catalog`` / ``quartermaster.schema``
        (the reference reads its catalog name from a notebook parameter)."""
        return cls(schema=spark.conf.get("quartermaster.schema", cls.schema),
                   catalog=spark.conf.get("quartermaster.catalog", cls.catalog))


# Table and column descriptions of the star (our wording of the reference's
# descriptions; purchase_orders is described too).
TABLE_COMMENTS = {
    "suppliers": "Approved suppliers: one region and country each, contracted lead time and a "
                 "reliability score.",
    "products": "Product catalogue: one category and one sourcing supplier per product, standard "
                "cost and unit weight.",
    "purchase_orders": "Purchase order lines from placement to delivery: product, supplier, order, "
                       "expected and actual delivery dates, quantity, unit price and status.",
    "inventory_snapshots": "Weekly stock counts per product and warehouse with reorder point and "
                           "quantity on order.",
}
COLUMN_COMMENTS = {
    "suppliers": {
        "supplier_id": "Supplier key", "supplier_name": "Supplier display name",
        "region": "Region the supplier operates in", "country": "Country of the supplier",
        "lead_time_days": "Contracted calendar days from order to expected delivery",
        "reliability_rating": "Historical reliability score, 1 (worst) to 5 (best)"},
    "products": {
        "product_id": "Product key", "product_name": "Product display name",
        "category": "Product category", "unit_cost": "Standard cost per unit",
        "supplier_id": "Key of the supplier of this product", "weight_kg": "Weight per unit in kg"},
    "purchase_orders": {
        "order_id": "Purchase order key", "product_id": "Key of the ordered product",
        "supplier_id": "Key of the supplier", "order_date": "Date the order was placed",
        "expected_delivery_date": "Date the supplier committed to (ETA)",
        "actual_delivery_date": "Date the order was received; NULL until delivered",
        "quantity": "Units ordered", "unit_cost": "Price per unit at order time",
        "status": "delivered, in_transit, delayed or cancelled"},
    "inventory_snapshots": {
        "snapshot_date": "Date of the weekly count", "product_id": "Key of the product",
        "warehouse": "Warehouse location", "quantity_on_hand": "Units in stock",
        "reorder_point": "Stock level below which replenishment is triggered",
        "quantity_on_order": "Units ordered and not yet received"},
}


def _q(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def ensure_schema(spark: SparkSession, ns: Namespace, location: str | None = None) -> str:
    """A2: CREATE SCHEMA IF NOT EXISTS, located under the checkpoint dir."""
    loc = location or scratch_path(spark, f"warehouse/{ns.schema}.db")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{ns.catalog}`.`{ns.schema}` LOCATION '{_q(loc)}'")
    return loc


def describe_table(spark: SparkSession, ns: Namespace, table: str, comment: str | None = None,
                   column_comments: Mapping[str, str] | None = None) -> None:
    """Table comment and column comments."""
    if comment:
        spark.sql(f"COMMENT ON TABLE {ns.fq(table)} IS '{_q(comment)}'")
    for col, text in (column_comments or {}).items():
        spark.sql(f"ALTER TABLE {ns.fq(table)} ALTER COLUMN `{col}` COMMENT '{_q(text)}'")


def save_table(df: DataFrame, ns: Namespace, table: str, comment: str | None = None,
               column_comments: Mapping[str, str] | None = None,
               partition_by: Sequence[str] = ()) -> None:
    """A4: overwrite (schema replaced) as parquet, then re-apply descriptions."""
    w = df.write.format("parquet").mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(ns.fq(table))
    # Spark cannot ALTER a partition column, so partition keys keep no comment.
    cols = {k: v for k, v in (column_comments or {}).items()
            if k in df.columns and k not in partition_by}
    describe_table(df.sparkSession, ns, table, comment, cols)


def replace_table(df: DataFrame, ns: Namespace, table: str, comment: str | None = None,
                  column_comments: Mapping[str, str] | None = None, partition_by: Sequence[str] = ()) -> str:
    """Replace rows, schema and descriptions in one step; the version's folder.

    The new version is written whole into a folder of its own. Then one catalog
    operation, CREATE OR REPLACE VIEW, points the name at it, with the new schema
    and the descriptions. A write that dies leaves the old version in place, and
    readers who have planned on an older version keep reading its files until
    ``drop_versions`` removes them.
    """
    spark = df.sparkSession
    ensure_schema(spark, ns)
    if _kind(spark, ns, table) not in (None, "VIEW"):
        raise ValueError(f"{ns.fq(table)} is a stored table; a replaceable one is a view of its current version")
    folder = f"{versions_path(spark, ns, table)}/v={uuid.uuid4().hex}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(folder)
    described = ", ".join(f"`{c}`" + (f" COMMENT '{_q(column_comments[c])}'" if c in (column_comments or {}) else "")
                          for c in df.columns)
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {ns.fq(table)} ({described}) "
              + (f"COMMENT '{_q(comment)}' " if comment else "") + f"AS SELECT {columns} FROM parquet.`{folder}`")
    return folder


def versions_path(spark: SparkSession, ns: Namespace, table: str) -> str:
    return scratch_path(spark, f"versions/{ns.schema}/{table}")


def _kind(spark: SparkSession, ns: Namespace, table: str) -> str | None:
    name = f"{ns.schema}.{table}"
    return spark.catalog.getTable(name).tableType if spark.catalog.tableExists(name) else None


def current_version(spark: SparkSession, ns: Namespace, table: str) -> str:
    """The folder that the table's name points at."""
    text = spark.sql(f"SHOW CREATE TABLE {ns.fq(table)}").first()[0]
    return text.rsplit("FROM parquet.`", 1)[1].split("`", 1)[0]


def drop_versions(spark: SparkSession, ns: Namespace, table: str, keep: Sequence[str] = ()) -> list[str]:
    """Remove the folders of versions that are neither current nor in ``keep``; what was removed."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(versions_path(spark, ns, table))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = {x.rsplit("/", 1)[1] for x in (current_version(spark, ns, table), *keep)}
    gone = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName() not in held]
    for p in gone:
        fs.delete(p, True)
    return [p.toString() for p in gone]


def save_star(star, ns: Namespace) -> None:
    """Write the four star tables with their descriptions.

    Physical layout for scale: order lines partitioned by order month and
    inventory by snapshot date, so month filters and the latest-snapshot
    filter prune whole folders.
    """
    spark = star.spark
    ensure_schema(spark, ns)
    tables = star.tables()
    layout = {"purchase_orders": ("order_month",), "inventory_snapshots": ("snapshot_date",)}
    for name, df in tables.items():
        if name == "purchase_orders":
            df = df.withColumn("order_month", F.trunc("order_date", "month"))
        save_table(df, ns, name, TABLE_COMMENTS.get(name), COLUMN_COMMENTS.get(name),
                   layout.get(name, ()))


def register_star(star, ns: Namespace) -> None:
    """A11 over a written star: expose its parquet folders as external catalog
    tables (no data is copied) and attach the descriptions."""
    if not star.path:
        raise ValueError("the star is not written; use save_star")
    spark = star.spark
    ensure_schema(spark, ns)
    partitioned = {"inventory_snapshots": ("snapshot_date",), "purchase_orders": (ORDER_MONTH,)}
    for name in star.tables():
        spark.catalog.createTable(f"{ns.schema}.{name}", path=f"{star.path}/{name}", source="parquet")
        if name in partitioned:              # register the existing partition folders
            spark.sql(f"ALTER TABLE {ns.fq(name)} RECOVER PARTITIONS")
        cols = {k: v for k, v in COLUMN_COMMENTS.get(name, {}).items()
                if k not in partitioned.get(name, ())}
        describe_table(spark, ns, name, TABLE_COMMENTS.get(name), cols)


def data_dictionary(spark: SparkSession, ns: Namespace) -> DataFrame:
    """(table_name, column_name, data_type, comment) of every table in ``ns``.

    Reads catalog metadata only (table and column descriptions), no data.
    """
    rows = []
    for t in spark.catalog.listTables(ns.schema):
        if t.isTemporary:
            continue
        for c in spark.catalog.listColumns(t.name, ns.schema):
            rows.append((t.name, c.name, c.dataType, c.description, t.description))
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, "
                                       "comment string, table_comment string")


def preview(df: DataFrame, n: int = 5, by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a stated order (all columns when ``by`` is None)."""
    return df.orderBy(*(by or df.columns)).limit(n)
