"""JDBC sources: connection options, partitioned reads and table exports.

Driver jars are supplied by the user; credentials come from the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from dimflow.sources.tables import read_table, write_csv

# URL form, default port and driver class per database.
DIALECTS = {
    "postgresql": ("jdbc:postgresql://{host}:{port}/{dbname}", 5432, "org.postgresql.Driver"),
    "mysql": ("jdbc:mysql://{host}:{port}/{dbname}", 3306, "com.mysql.cj.jdbc.Driver"),
    "mssql": (
        "jdbc:sqlserver://{host}:{port};databaseName={dbname}", 1433, "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    ),
    "oracle": ("jdbc:oracle:thin:@//{host}:{port}/{dbname}", 1521, "oracle.jdbc.OracleDriver"),
    "sqlite": ("jdbc:sqlite:{dbname}", None, "org.sqlite.JDBC"),
    "snowflake": (
        "jdbc:snowflake://{account}.snowflakecomputing.com/?db={dbname}&schema={schema}&warehouse={warehouse}&role={role}",
        None,
        "net.snowflake.client.jdbc.SnowflakeDriver",
    ),
}


def jdbc_options(db_type: str, config: Mapping[str, str]) -> dict[str, str]:
    """Spark JDBC options for a database type and its connection settings."""
    try:
        url, port, driver = DIALECTS[db_type.lower()]
    except KeyError:
        raise ValueError(f"unsupported database type {db_type!r}; known: {sorted(DIALECTS)}") from None
    fields = dict(config)
    if port is not None:
        fields["port"] = config.get("port") or port
    try:
        options = {"url": url.format(**fields), "driver": driver}
    except KeyError as missing:
        raise ValueError(f"{db_type} needs the setting {missing}") from None
    return options | {k: config[k] for k in ("user", "password") if k in config}


@dataclass(frozen=True)
class ReadSplit:
    """Numeric, date or timestamp column along which tasks divide a table."""

    column: str
    lower: str
    upper: str
    partitions: int


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    split: ReadSplit | None = None,
    predicates: Sequence[str] = (),
) -> DataFrame:
    """A table or ``(subquery) alias`` read in parallel.

    Needs ``split`` or ``predicates`` (one task each, which must cover the table without
    overlap): an undivided read would pass the whole table through one task.
    """
    if split is not None:
        divided = {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.partitions),
        }
        return spark.read.format("jdbc").options(**options, **divided, dbtable=table).load()
    if predicates:
        properties = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(options["url"], table, predicates=list(predicates), properties=properties)
    raise ValueError(f"reading {table} needs a split column or predicates")


def export_table(
    spark: SparkSession,
    job: str,
    jobs: Mapping[str, Mapping[str, str]],
    connections: Mapping[str, Mapping[str, str]],
    out_dir: str,
    split: ReadSplit | None = None,
    predicates: Sequence[str] = (),
) -> str:
    """Export the table a named job refers to as CSV under ``out_dir/<job>.csv``; returns that path.

    ``jobs`` maps a name to its ``db_type`` and ``table_name``; ``connections`` maps a
    db_type to its settings. A db_type that is a Spark file format (such as "parquet")
    reads ``<path>/<table_name>.<format>``.
    """
    params = jobs.get(job)
    if not params or not params.get("db_type") or not params.get("table_name"):
        raise ValueError(f"job {job!r} must define db_type and table_name")
    db_type, table = params["db_type"], params["table_name"]
    config = connections[db_type]
    if db_type in ("parquet", "orc"):
        rows = read_table(spark, db_type, {"path": f"{config['path']}/{table}.{db_type}"})
    else:
        rows = read_jdbc(spark, jdbc_options(db_type, config), table, split, predicates)
    target = f"{out_dir}/{job}.csv"
    write_csv(rows, target)
    return target
