"""Queries of table sources and sinks: each writes, reads back and returns what it read."""

from __future__ import annotations

from pyspark.sql import functions as F

from featuremart.catalogue import training as training_queries
from featuremart.catalogue.registry import Tables, fresh_table, query, with_ctes
from featuremart.operators.joins import spine
from featuremart.plans import training
from featuremart.sources.storage import scratch_path
from featuremart.sources.tables import (
    export_parquet,
    load,
    load_path,
    refresh,
    replace_partition,
    replace_partition_path,
    row_numbers,
    small_table,
    table_location,
    write_table,
)

_ORDERS = "select o_orderkey, o_custkey, o_orderstatus from orders"


def _orders(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")


@query("orc_table", _ORDERS)
def orc_table(t: Tables):
    name, path = fresh_table(t.spark, "orc_table")
    write_table(_orders(t), name, files=3, path=path)
    return load(t.spark, name)


@query("catalog_scan", "select o_orderkey as id, o_custkey as owner, o_orderstatus from orders where o_orderstatus = 'F'")
def catalog_scan(t: Tables):
    """A catalog table read under other column names; the filter reaches the files."""
    name, path = fresh_table(t.spark, "catalog_scan")
    write_table(_orders(t), name, path=path)
    renamed = load(t.spark, name, {"o_orderkey": "id", "o_custkey": "owner"})
    return renamed.where(F.col("o_orderstatus") == "F")


@query("partitioned_table", _ORDERS + " where o_orderstatus = 'O'")
def partitioned_table(t: Tables):
    name, path = fresh_table(t.spark, "partitioned_table")
    write_table(_orders(t), name, partition_by=["o_orderstatus"], path=path)
    return load(t.spark, name).where(F.col("o_orderstatus") == "O")


_REPLACED = """
select o_orderkey, o_custkey, o_orderstatus from orders where o_orderstatus <> 'F'
union all select o_orderkey, -o_custkey, o_orderstatus from orders where o_orderstatus = 'F'
"""


@query("partition_replace", _REPLACED)
def partition_replace(t: Tables):
    """One partition is replaced twice; the others stay."""
    name, path = fresh_table(t.spark, "partition_replace")
    replace_partition(_orders(t), name, "o_orderstatus", path=path)
    changed = _orders(t).where("o_orderstatus = 'F'").withColumn("o_custkey", -F.col("o_custkey"))
    for _ in range(2):
        replace_partition(changed, name, "o_orderstatus")
    return refresh(t.spark, name)


@query("partition_replace_path", _REPLACED)
def partition_replace_path(t: Tables):
    path = scratch_path(t.spark, "partition_replace_path")
    replace_partition_path(_orders(t), path, "o_orderstatus")
    changed = _orders(t).where("o_orderstatus = 'F'").withColumn("o_custkey", -F.col("o_custkey"))
    for _ in range(2):
        replace_partition_path(changed, path, "o_orderstatus")
    return load_path(t.spark, path)


@query("parquet_export", _ORDERS)
def parquet_export(t: Tables):
    path = scratch_path(t.spark, "parquet_export")
    frame = _orders(t)
    export_parquet(frame, path)
    return load_path(t.spark, path, schema=frame.schema)


@query("table_location", _ORDERS)
def located_table(t: Tables):
    """The table's files read from the folder the catalog names."""
    name, path = fresh_table(t.spark, "table_location")
    write_table(_orders(t), name, path=path)
    return load_path(t.spark, table_location(t.spark, name), "orc")


@query(
    "small_table",
    """
    select o_orderkey, cast(grade as bigint) as grade
    from orders join (values ('F', 1), ('O', 2), ('P', 3)) v(s, grade) on s = o_orderstatus
    """,
)
def small_table_join(t: Tables):
    grades = small_table(t.spark, [("F", 1), ("O", 2), ("P", 3)], "o_orderstatus string, grade int")
    return t.orders.join(F.broadcast(grades), "o_orderstatus").select("o_orderkey", "grade")


@query("row_numbers", "select c_custkey, cast(k as bigint) as slot from customer, (select unnest([0, 1, 2, 3]) as k)")
def generated_rows(t: Tables):
    return spine(t.customer.select("c_custkey"), row_numbers(t.spark, 4, "slot"))


_TARGETS = "mobile_id, mobile_acc_id, mobile_msisdn, target_active_churn, table_business_month"


@query(
    "target_table",
    with_ctes(training_queries.COHORT_CTES, f"select {_TARGETS} from cohorts"),
    training_queries.LABEL_ROLES,
)
def target_table(t: Tables):
    """All cohort months written at once, then the first one again."""
    name, _ = fresh_table(t.spark, "target_table")
    targets = training_queries.targets_frame(t)
    months = [c.month for c in training_queries.COHORTS]
    training.target_table(targets, name, months)
    training.target_table(targets, name, months[:1])
    return refresh(t.spark, name)


@query("saved_split", "select doc_id, cast(toxic as bigint) as toxic, lang from labels join documents using (doc_id)")
def saved_split(t: Tables):
    """A set stored as a table and exported from there."""
    name, _ = fresh_table(t.spark, "saved_split")
    path = scratch_path(t.spark, "saved_split")
    rows = t.labels.select("doc_id", "toxic").join(t.documents.select("doc_id", "lang"), "doc_id")
    training.save_split(rows, name, path)
    return load_path(t.spark, path)
