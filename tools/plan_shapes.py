"""Compare plan shapes: wall time, shuffle bytes and the longest task, from Spark's event log.

Usage: python tools/plan_shapes.py [sf_dir] [copies]

``copies`` repeats the given tables under new keys to reach a size where shapes differ.
"""

from __future__ import annotations

import json
import statistics
import sys
import tempfile
import time
from functools import reduce
from operator import and_
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from dimflow import storage  # noqa: E402
from dimflow.entities import POLICY  # noqa: E402
from dimflow.operators.facts import daily_user_metrics  # noqa: E402
from dimflow.operators.lookup import flag_unique, lookup_join  # noqa: E402
from dimflow.operators.scd import scd2_merge  # noqa: E402
from dimflow.plans.base import load  # noqa: E402
from dimflow.plans.inputs import AS_OF, BINDINGS, LOADED_AT, derive, snapshot  # noqa: E402
from dimflow.plans.warehouse import event_fact, event_types  # noqa: E402
from dimflow.session import get_session  # noqa: E402


def four_branches(dim, source):
    """Type 2 merge written as one filtered branch per row class, all over the same join."""
    d = dim.where("is_active").select(*(F.col(c).alias(f"d_{c}") for c in dim.columns))
    s = source.select(*(F.col(c).alias(f"s_{c}") for c in POLICY.columns))
    joined = d.join(s, F.col("d_policy_id") == F.col("s_policy_id"), "full_outer")
    same = reduce(and_, (F.col(f"d_{c}").eqNullSafe(F.col(f"s_{c}")) for c in POLICY.tracked))
    both = F.col("d_policy_id").isNotNull() & F.col("s_policy_id").isNotNull()

    def branch(rows, side, active):
        return rows.select(*(F.col(f"{side}_{c}").alias(c) for c in POLICY.columns), F.lit(active).alias("is_active"))

    branches = [
        branch(joined.where(both & same), "d", True),
        branch(joined.where(both & ~same), "d", False),
        branch(joined.where(both & ~same), "s", True),
        branch(joined.where(F.col("d_policy_id").isNull()), "s", True),
        branch(joined.where(F.col("s_policy_id").isNull()), "d", True),
    ]
    return reduce(lambda a, b: a.unionByName(b), branches)


def two_aggregations(fact, event_types):
    """Daily metrics as a distinct count, a filtered aggregation and a join between them."""
    keyed = fact.join(event_types, F.col("event_type") == F.col("event_type_name"), "left")
    logins = keyed.groupBy("user_id", "event_date").agg(F.count_distinct("log_id").alias("n"))
    bought = keyed.where("event_type = 'purchase'").groupBy("user_id", "event_date").agg(
        F.sum("quantity").alias("total_quantity"), F.sum("total_amount").alias("total_amount"),
        F.avg("unit_price").alias("unit_price"), F.max("event_type_key").alias("event_type_key"),
    )
    return logins.join(bought, ["user_id", "event_date"], "left").na.fill(0)


def window_count(df, keys):
    from pyspark.sql import Window

    return df.withColumn("alone", F.count(F.lit(1)).over(Window.partitionBy(*keys)) == 1)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    log_dir = tempfile.mkdtemp(prefix="run-")
    spark = get_session(
        "plan-shapes", master="local[8]", spark__driver__memory="20g", spark__sql__shuffle__partitions="32",
        spark__eventLog__enabled="true", spark__eventLog__dir=f"file:{log_dir}", spark__eventLog__compress="false",
        spark__eventLog__rolling__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def stored(df, name):
        path = storage.scratch_dir(spark, name)
        df.repartition(16).write.parquet(path)
        return spark.read.parquet(path)

    def repeat(table, key):
        rows = load(spark, sf_dir, table).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        return rows.withColumn(key, F.col(key) + F.col("copy") * 10_000_000).drop("copy")

    b = BINDINGS["policy"]
    orders = repeat("orders", "o_orderkey")
    dim = stored(scd2_merge(None, derive(orders, b.columns), POLICY, LOADED_AT, unique_source=True), "dim")
    source = stored(derive(orders, snapshot(b)), "source")
    stored(repeat("events", "event_id"), "e").createOrReplaceTempView("e")
    events = spark.table("e").selectExpr("*", "CAST(get_json_object(props, '$.k') AS int) AS k")
    fact = event_fact(spark, sf_dir).limit(0).unionByName(
        events.selectExpr(
            "event_id AS log_id", "user_id", "CAST(ts AS date) AS event_date", "event_type",
            "CAST(k AS decimal(10,2)) AS quantity", "CAST(value AS decimal(12,2)) AS unit_price",
            "CAST(value * k AS decimal(14,2)) AS total_amount",
        )
    )
    types = stored(event_types(spark, sf_dir), "types")
    # One key on a third of the lines, no key on a ninth.
    lines = stored(
        repeat("lineitem", "l_orderkey").selectExpr(
            "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", "l_returnflag",
            "CASE WHEN l_partkey % 3 = 0 THEN 1 WHEN l_partkey % 9 = 1 THEN NULL ELSE l_orderkey END AS k",
        ),
        "lines",
    )
    parents = stored(orders.selectExpr("o_orderkey AS key", "o_orderpriority AS priority", "o_totalprice AS price"), "parents")
    columns = {"priority": "priority", "price": "price"}

    only = sys.argv[3] if len(sys.argv) > 3 else ""
    shapes = {
        "type 2 merge: one pass": lambda: scd2_merge(dim, source, POLICY, AS_OF, unique_source=True),
        "type 2 merge: branch per class": lambda: four_branches(dim, source),
        "daily metrics: co-partitioned, null-safe": lambda: daily_user_metrics(fact, types, checkout="purchase"),
        "daily metrics: two aggregations and a join": lambda: two_aggregations(fact, types),
        "skewed lookup: plain join": lambda: lookup_join(lines, parents, {"k": "key"}, columns),
        "skewed uniqueness: counts joined back": lambda: flag_unique(lines, ["k"], "alone"),
        "skewed uniqueness: window": lambda: window_count(lines, ["k"]),
    }
    shapes = {name: build for name, build in shapes.items() if only in name}
    spans = {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(4 * 1024**2))
    times = {name: [] for name in shapes}
    for _ in range(4):  # rounds, so that all shapes meet an equally warm JVM; the first round is not counted
        for name, build in shapes.items():
            begin = time.time()
            build().write.format("noop").mode("overwrite").save()
            times[name].append(time.time() - begin)
            spans[name] = (int(begin * 1000), int(time.time() * 1000))
    shapes = {name: statistics.median(t[1:]) for name, t in times.items()}
    app = spark.sparkContext.applicationId
    spark.stop()

    tasks = []
    for line in next(Path(log_dir).glob(f"{app}*")).open():
        event = json.loads(line)
        if event["Event"] == "SparkListenerTaskEnd":
            info, metrics = event["Task Info"], event.get("Task Metrics", {})
            tasks.append((
                info["Launch Time"], info["Finish Time"] - info["Launch Time"],
                metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"],
            ))
    print(f"{'shape':45} {'seconds':>8} {'shuffle MB':>11} {'longest task s':>15}")
    for name, seconds in shapes.items():
        begin, end = spans[name]
        own = [t for t in tasks if begin <= t[0] <= end]
        print(f"{name:45} {seconds:8.2f} {sum(t[2] for t in own) / 1e6:11.1f} {max(t[1] for t in own) / 1000:15.2f}")


if __name__ == "__main__":
    main()
