"""File sources, sinks, conversion, export and streaming queries.

Each writes the whole of a given table in some form and reads it back.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from dimflow import storage
from dimflow.functions.rules import Rule
from dimflow.plans.base import load, query
from dimflow.schemas import conform
from dimflow.sources.files import archive_loaded, convert_to_parquet
from dimflow.sources.files import merge_csv as merge_files
from dimflow.sources.json_arrays import read_json_array
from dimflow.sources.jdbc import export_table as export
from dimflow.sources.tables import read_csv, read_json, read_table, write_csv, write_parquet, write_table
from dimflow.streaming.ingest import file_stream, ingest_stream as run_ingest, validate_stream as run_validation

_ORDERS = "SELECT * FROM orders"
_ORDERS_TEXT = "SELECT " + ", ".join(
    f"CAST({c} AS string) AS {c}" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
) + ", strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate FROM orders"


def _orders_csv(spark, sf_dir):
    path = storage.scratch_dir(spark, "orders_csv")
    orders = load(spark, sf_dir, "orders")
    write_csv(orders, path)
    return path, orders.schema


def _write_arrays(df, path):
    """JSON documents of one array each, a document per task."""

    def document(batches):
        mark = "[\n"
        for batch in batches:
            for record in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"value": [mark + record]})
                mark = ","
        if mark == ",":
            yield pa.RecordBatch.from_pydict({"value": ["]"]})

    df.select(F.to_json(F.struct(*df.columns))).mapInArrow(document, "value string").write.text(path)


@query(_ORDERS)
def csv_scan_typed(spark, sf_dir):
    path, schema = _orders_csv(spark, sf_dir)
    return read_csv(spark, path, schema)


@query(_ORDERS_TEXT)
def csv_scan_strings(spark, sf_dir):
    path, _ = _orders_csv(spark, sf_dir)
    return read_csv(spark, path)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan_inferred(spark, sf_dir):
    path = storage.scratch_dir(spark, "customer_csv")
    write_csv(load(spark, sf_dir, "customer"), path)
    return read_csv(spark, path, infer=True).withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query(_ORDERS)
def json_lines_scan(spark, sf_dir):
    path = storage.scratch_dir(spark, "orders_json")
    orders = load(spark, sf_dir, "orders")
    write_table(orders, "json", {"path": path})
    return read_json(spark, path, orders.schema)


@query("SELECT * FROM customer")
def json_array_scan(spark, sf_dir):
    """JSON documents of one large array each, over many lines."""
    path = storage.scratch_dir(spark, "customer_arrays")
    customer = load(spark, sf_dir, "customer")
    _write_arrays(customer, path)
    return read_json_array(spark, path, customer.schema)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def seed_rows(spark, sf_dir):
    """Seed rows from a CSV into a typed table."""
    root = storage.scratch_dir(spark, "seed")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    write_csv(nation, f"{root}/raw")
    write_table(conform(read_csv(spark, f"{root}/raw"), nation.schema), "parquet", {"path": f"{root}/table"})
    return spark.read.parquet(f"{root}/table")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")
def parquet_scan(spark, sf_dir):
    orders = read_table(spark, "parquet", {"path": f"{sf_dir}/orders.parquet"})
    return orders.where("o_orderdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00'").select("o_orderkey", "o_totalprice")


@query(_ORDERS)
def table_overwrite(spark, sf_dir):
    path = storage.scratch_dir(spark, "orders_table")
    orders = load(spark, sf_dir, "orders")
    write_parquet(orders.withColumn("o_custkey", -F.col("o_custkey")), path)
    write_parquet(orders, path, skip_empty=True)
    return spark.read.parquet(path)


@query(f"{_ORDERS} UNION ALL {_ORDERS}")
def table_append(spark, sf_dir):
    path = storage.scratch_dir(spark, "orders_table")
    for _ in range(2):
        write_table(load(spark, sf_dir, "orders"), "parquet", {"path": path})
    return read_table(spark, "parquet", {"path": path})


_CUSTOMERS = "concat(c_name, ' é') AS name", "CAST(c_nationkey AS string) AS nation", "c_mktsegment AS segment"
_SUPPLIERS = "concat(s_name, ' é') AS name", "CAST(s_suppkey AS string) AS supplier", "CAST(s_nationkey AS string) AS nation"


@query(f"SELECT {', '.join(_CUSTOMERS)} FROM customer UNION ALL BY NAME SELECT {', '.join(_SUPPLIERS)} FROM supplier")
def merge_csv(spark, sf_dir):
    root = storage.scratch_dir(spark, "merge")
    write_csv(load(spark, sf_dir, "customer").selectExpr(*_CUSTOMERS), f"{root}/customers")
    suppliers = load(spark, sf_dir, "supplier").selectExpr(*_SUPPLIERS)
    suppliers.write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{root}/suppliers")
    return merge_files(spark, root)


@query(f"SELECT {', '.join(_CUSTOMERS)} FROM customer UNION ALL BY NAME SELECT {', '.join(_SUPPLIERS)} FROM supplier")
def merge_by_name(spark, sf_dir):
    customers = load(spark, sf_dir, "customer").selectExpr(*_CUSTOMERS)
    return customers.unionByName(load(spark, sf_dir, "supplier").selectExpr(*_SUPPLIERS), allowMissingColumns=True)


def _converted(spark, sf_dir):
    """Orders as many CSV files, customers as JSON Lines, and a format that is not converted."""
    root = storage.scratch_dir(spark, "convert")
    load(spark, sf_dir, "orders").write.option("header", True).option("maxRecordsPerFile", 2000).csv(f"{root}/raw/orders")
    load(spark, sf_dir, "customer").write.option("maxRecordsPerFile", 2000).json(f"{root}/raw/customer")
    load(spark, sf_dir, "part").write.parquet(f"{root}/raw/part")
    return root, convert_to_parquet(spark, f"{root}/raw", f"{root}/bronze")


@query("""
    SELECT 'csv' AS format, 'loaded' AS status, count(*) AS row_count FROM orders
    UNION ALL SELECT 'json', 'loaded', count(*) FROM customer
    UNION ALL SELECT 'parquet', 'unsupported', NULL
""")
def convert_manifest(spark, sf_dir):
    _, manifest = _converted(spark, sf_dir)
    return manifest.groupBy("format", "status").agg(F.sum("row_count").alias("row_count"))


@query(f"SELECT 'json' AS format, * FROM customer UNION ALL BY NAME SELECT 'csv' AS format, * FROM ({_ORDERS_TEXT})")
def convert_rows(spark, sf_dir):
    """The rows of both converted tables, with all their columns."""
    _, manifest = _converted(spark, sf_dir)
    found = []
    for fmt in ("json", "csv"):
        targets = manifest.where((F.col("format") == fmt) & F.col("target").isNotNull()).select("target").collect()
        found.append(spark.read.parquet(*[r.target for r in targets]).withColumn("format", F.lit(fmt)))
    found = found[0].unionByName(found[1], allowMissingColumns=True)
    return found.withColumn("c_nationkey", F.col("c_nationkey").cast("int"))  # JSON does not tell integers apart


@query(_ORDERS)
def archived_files(spark, sf_dir):
    """Loaded files move to the archive as they are, and only those; doing it again changes nothing."""
    root, manifest = _converted(spark, sf_dir)
    for _ in range(2):
        journal = archive_loaded(spark, manifest, f"{root}/raw", f"{root}/archive", "2024-06-30")
    left = manifest.where("status = 'loaded'").count() - journal.where("state = 'moved'").count()
    if left or not storage.list_names(spark, f"{root}/raw/part"):
        raise RuntimeError("files were left behind or moved that must stay")
    return read_csv(spark, f"{root}/archive/RAW_ARCHIVE/2024-06-30/orders", load(spark, sf_dir, "orders").schema)


@query(_ORDERS)
def export_table(spark, sf_dir):
    jobs = {"orders_export": {"db_type": "parquet", "table_name": "orders"}}
    out = export(spark, "orders_export", jobs, {"parquet": {"path": sf_dir}}, storage.scratch_dir(spark, "export"))
    return read_csv(spark, out, load(spark, sf_dir, "orders").schema)


@query(_ORDERS)
def ingest_stream(spark, sf_dir):
    """Two runs over the same arrivals: the second adds nothing."""
    root = storage.scratch_dir(spark, "ingest")
    path, schema = _orders_csv(spark, sf_dir)
    for _ in range(2):
        run_ingest(file_stream(spark, path, schema), f"{root}/orders", f"{root}/checkpoint")
    return spark.read.schema(schema).parquet(f"{root}/orders")


@query("""
    SELECT *, o_orderpriority <> '4-NOT SPECIFIED' AS priority_valid, o_totalprice > 1000 AS price_valid,
        CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' AND o_totalprice > 1000 THEN 'valid' ELSE 'quarantine' END AS outcome
    FROM orders
""")
def validate_stream(spark, sf_dir):
    root = storage.scratch_dir(spark, "validate")
    schema = load(spark, sf_dir, "orders").schema
    rules = [
        Rule("priority_valid", F.col("o_orderpriority") != "4-NOT SPECIFIED"),
        Rule("price_valid", F.col("o_totalprice") > 1000),
    ]
    # A glob, as a stream's path may be a directory or a pattern but not one file.
    stream = file_stream(spark, f"{sf_dir}/orders.parquet*", schema, fmt="parquet")
    run_validation(stream, rules, f"{root}/orders", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/orders").drop("batch_id")
