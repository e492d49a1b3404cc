"""Type 1 and type 2 dimension queries."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, functions as F

from dimflow import storage
from dimflow.entities import ENTITIES, WEBSHOP_TYPE1_TRACKED, EntitySpec
from dimflow.operators.cleanse import prepare
from dimflow.operators.incremental import insert_ignore as first_of_new_keys
from dimflow.operators.scd import scd1_merge, scd2_history as merge_history, scd2_merge
from dimflow.plans.base import load, query, register
from dimflow.plans.inputs import (
    AS_OF, BINDINGS, CLOSED_AT, LOADED_AT, Binding, derive, older, repeated, select_list, snapshot,
)
from dimflow.schemas import conform
from dimflow.sources.dimension_store import DimensionStore
from dimflow.sources.key_ranges import rows_of_files

LATER = "2024-09-30 00:00:00"


def _stamp(spec: EntitySpec, at: str) -> str:
    return f"CAST(TIMESTAMP '{at}' AS {spec.stamp_type.simpleString().removesuffix('_ntz')})"


def _never(spec: EntitySpec) -> str:
    return f"CAST(NULL AS {spec.stamp_type.simpleString().removesuffix('_ntz')})"


def _source(spark, sf_dir, b: Binding):
    """The new snapshot with every record given twice."""
    table = load(spark, sf_dir, b.table)
    return derive(table, snapshot(b)).unionByName(derive(table, repeated(b)))


def versioned_dim(spark, sf_dir, b: Binding, spec: EntitySpec):
    """An open and a closed version of every row."""
    table = load(spark, sf_dir, b.table)

    def version(columns, opened, closed):
        stamps = {spec.start: F.lit(opened), spec.active: F.lit(closed is None), spec.end: F.lit(closed)}
        if spec.updated:
            stamps[spec.updated] = F.lit(closed or opened)
        return conform(derive(table, columns).withColumns(stamps), spec.dim_schema)

    return version(b.columns, LOADED_AT, None).unionByName(version(older(b), "2023-01-01 00:00:00", CLOSED_AT))


def _prepared(spark, sf_dir, b: Binding, spec: EntitySpec):
    return prepare(_source(spark, sf_dir, b), spec, AS_OF)


def _scd2_sql(b: Binding, spec: EntitySpec, absent: str = "keep", first_load: bool = False) -> str:
    """The merge as one filtered branch per row class."""
    cols, (key,) = spec.columns, spec.key
    upd = spec.updated
    now, never = _stamp(spec, AS_OF), _never(spec)
    required = " AND ".join(f"{c} IS NOT NULL" for c in {*spec.required, key})
    order = ", ".join(f"{c} NULLS FIRST" for c in cols if c != key)
    same = " AND ".join(f"d.{c} IS NOT DISTINCT FROM s.{c}" for c in spec.tracked)

    def row(side: str, start: str, updated: str, active: str, end: str) -> str:
        stamps = {spec.start: start, spec.active: active, spec.end: end} | ({upd: updated} if upd else {})
        return ", ".join([f"{side}.{c}" for c in cols] + [f"{e} AS {c}" for c, e in stamps.items()])

    def version(columns, opened, closed):
        start, end = _stamp(spec, opened), _stamp(spec, closed) if closed else never
        stamps = {spec.start: start, spec.active: str(closed is None).lower(), spec.end: end}
        if upd:
            stamps[upd] = _stamp(spec, closed or opened)
        return f"SELECT {select_list(columns | stamps)} FROM {b.table}"

    ctes = f"""WITH raw AS (
        SELECT {select_list(snapshot(b))} FROM {b.table} UNION ALL SELECT {select_list(repeated(b))} FROM {b.table}
    ), s AS (
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM raw WHERE {required}
        ) t WHERE rn = 1
    ), dim AS (
        {version(b.columns, LOADED_AT, None)} UNION ALL {version(older(b), '2023-01-01 00:00:00', CLOSED_AT)}
    ), d AS (SELECT * FROM dim WHERE {spec.active}), h AS (SELECT * FROM dim WHERE NOT {spec.active})
    """
    if first_load:
        return f"{ctes} SELECT {row('s', now, now, 'true', never)} FROM s"
    both = f"FROM d JOIN s ON d.{key} = s.{key} WHERE"
    kept = row("d", f"d.{spec.start}", f"d.{upd}", "true", never)
    expired = row("d", f"d.{spec.start}", now, "false", now)
    branches = [
        f"SELECT {row('d', f'd.{spec.start}', now, 'true', never)} {both} {same}",
        f"SELECT {expired} {both} NOT ({same})",
        f"SELECT {row('s', now, never, 'true', never)} {both} NOT ({same})",
        f"SELECT {row('s', now, never, 'true', never)} FROM s WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.{key} = s.{key})",
        f"SELECT {row('h', f'h.{spec.start}', f'h.{upd}', 'false', f'h.{spec.end}')} FROM h",
    ]
    if absent != "drop":
        gone = kept if absent == "keep" else expired
        branches.append(f"SELECT {gone} FROM d WHERE NOT EXISTS (SELECT 1 FROM s WHERE d.{key} = s.{key})")
    return ctes + " UNION ALL ".join(branches)


def _scd2(spark, sf_dir, entity: str, **options):
    b, spec = BINDINGS[entity], ENTITIES[entity]
    return scd2_merge(versioned_dim(spark, sf_dir, b, spec), _prepared(spark, sf_dir, b, spec), spec, AS_OF, **options)


for _name in ENTITIES:
    register(f"scd2_{_name}", partial(_scd2, entity=_name), _scd2_sql(BINDINGS[_name], ENTITIES[_name]))

for _policy in ("expire", "drop"):
    register(
        f"scd2_absent_{_policy}",
        partial(_scd2, entity="customer", absent=_policy),
        _scd2_sql(BINDINGS["customer"], ENTITIES["customer"], absent=_policy),
    )


@query(_scd2_sql(BINDINGS["policy"], ENTITIES["policy"], first_load=True))
def scd2_first_load(spark, sf_dir):
    b, spec = BINDINGS["policy"], ENTITIES["policy"]
    return scd2_merge(None, _prepared(spark, sf_dir, b, spec), spec, AS_OF)


def _twice_merged_sql(b: Binding, spec: EntitySpec) -> str:
    """First load of the table itself, then a merge of its snapshot at a later time."""
    cols, (key,) = spec.columns, spec.key
    first, later, never = _stamp(spec, AS_OF), _stamp(spec, LATER), _never(spec)
    same = " AND ".join(f"d.{c} IS NOT DISTINCT FROM s.{c}" for c in spec.tracked)
    d, s = (", ".join(f"{side}.{c}" for c in cols) for side in "ds")
    stamps = "{} AS insert_date, {} AS update_date, {} AS is_active, {} AS end_date".format
    return f"""WITH d AS (SELECT {select_list(b.columns)} FROM {b.table}),
    s AS (SELECT {select_list(snapshot(b))} FROM {b.table})
    SELECT {d}, {stamps(first, later, 'true', never)} FROM d JOIN s ON d.{key} = s.{key} WHERE {same}
    UNION ALL SELECT {d}, {stamps(first, later, 'false', later)} FROM d JOIN s ON d.{key} = s.{key} WHERE NOT ({same})
    UNION ALL SELECT {s}, {stamps(later, never, 'true', never)} FROM d JOIN s ON d.{key} = s.{key} WHERE NOT ({same})
    UNION ALL SELECT {s}, {stamps(later, never, 'true', never)} FROM s WHERE s.{key} NOT IN (SELECT {key} FROM d)
    UNION ALL SELECT {d}, {stamps(first, first, 'true', never)} FROM d WHERE d.{key} NOT IN (SELECT {key} FROM s)
    """


@query(_twice_merged_sql(BINDINGS["customer"], ENTITIES["customer"]))
def dimension_store(spark, sf_dir):
    b, spec = BINDINGS["customer"], ENTITIES["customer"]
    table = load(spark, sf_dir, b.table)
    store = DimensionStore(spark, storage.scratch_dir(spark, "dim_customer"), spec)
    store.merge(derive(table, b.columns), AS_OF)
    store.merge(derive(table, snapshot(b)), LATER)
    return store.read()


#: Changes of a customer by the remainder of the key: when they take effect, some late and some at once.
_CHANGES = [(0, "2023-03-01"), (1, "2023-06-15"), (2, "2024-02-01"), (3, "2024-05-05"), (0, "2024-08-08"), (1, "2022-01-01")]


def _changes(b: Binding) -> list[tuple[dict[str, str], str, str]]:
    """Per change its columns, the rows that have it, and its effective time: every third takes the values of the version in force."""
    parts = []
    for i, (rest, at) in enumerate(_CHANGES):
        columns = b.columns if i % 3 == 2 else b.columns | {"city": f"'City {i}'"}
        parts.append((columns, f"c_custkey % 4 = {rest}", f"TIMESTAMP_NTZ '{at} 00:00:00'"))
    return parts


def _history_sql(b: Binding, spec: EntitySpec) -> str:
    """The same by the points in time: at each the change or version that starts last before it is in force."""
    cols, (key,) = spec.columns, spec.key
    now = _stamp(spec, AS_OF)
    changes = " UNION ALL ".join(
        f"SELECT {select_list(columns)}, {at.replace('TIMESTAMP_NTZ', 'TIMESTAMP')} AS since FROM {b.table} WHERE {where}" for columns, where, at in _changes(b)
    )

    def version(columns, opened, closed):
        end = _stamp(spec, closed) if closed else _never(spec)
        return f"SELECT {select_list(columns)}, {_stamp(spec, opened)} AS since, {end} AS until, {_stamp(spec, closed or opened)} AS upd FROM {b.table}"

    values = ", ".join(cols)
    empty = ", ".join(key if c == key else f"NULL AS {c}" for c in cols)
    tracked = " AND ".join(f"{c} IS NOT DISTINCT FROM p_{c}" for c in spec.tracked)
    lags = ", ".join(f"lag({c}) OVER w AS p_{c}" for c in spec.tracked)
    return f"""WITH c AS ({changes}),
    dim AS ({version(b.columns, LOADED_AT, None)} UNION ALL {version(older(b), '2023-01-01 00:00:00', CLOSED_AT)}),
    d AS (SELECT * FROM dim WHERE {key} IN (SELECT {key} FROM c)),
    points AS (
        SELECT {values}, since, NULL AS until, NULL AS upd, 0 AS kind FROM c
        UNION ALL SELECT {values}, since, until, upd, 1 FROM d WHERE (({key}, since) NOT IN (SELECT ({key}, since) FROM c))
        UNION ALL SELECT {empty}, until, until, upd, 2 FROM d WHERE until IS NOT NULL
            AND ({key}, until) NOT IN (SELECT ({key}, since) FROM c) AND ({key}, until) NOT IN (SELECT ({key}, since) FROM d)),
    steps AS (SELECT *, {lags}, lag(kind = 2) OVER w AS p_gap FROM points WINDOW w AS (PARTITION BY {key} ORDER BY since)),
    new AS (SELECT * FROM steps WHERE p_gap IS NULL OR (kind = 2) <> p_gap OR NOT ({tracked})),
    lasting AS (SELECT *, lead(since) OVER (PARTITION BY {key} ORDER BY since) AS next FROM new)
    SELECT {values}, since AS {spec.start}, CASE WHEN kind = 0 THEN NULL WHEN until IS NOT DISTINCT FROM next THEN upd ELSE {now} END AS {spec.updated},
        next IS NULL AS {spec.active}, next AS {spec.end} FROM lasting WHERE kind < 2
    UNION ALL SELECT {values}, since, upd, until IS NULL, until FROM dim WHERE {key} NOT IN (SELECT {key} FROM c)
    """


@query(_history_sql(BINDINGS["customer"], ENTITIES["customer"]))
def scd2_history(spark, sf_dir):
    """Several effective dates of a customer in one load, some within closed versions and some before all others."""
    b, spec = BINDINGS["customer"], ENTITIES["customer"]
    table = load(spark, sf_dir, b.table)
    parts = [derive(table.where(where), columns | {"at": at}) for columns, where, at in _changes(b)]
    return merge_history(versioned_dim(spark, sf_dir, b, spec), reduce(DataFrame.unionByName, parts), spec, "at", AS_OF)


_TYPE1 = BINDINGS["webshop_customer"]
_TYPE1_OLD = _TYPE1.columns | {"gender": "'U'", "ins_dt": "DATE '2024-01-01'", "upd_dt": "CAST(NULL AS date)"}


@query(f"""
    WITH t AS (SELECT {select_list(_TYPE1_OLD)} FROM customer), s AS (SELECT {select_list(snapshot(_TYPE1))} FROM customer),
    j AS (
        SELECT t.*, s.firstname AS sf, s.lastname AS sl, s.email AS se, s.currentaddressid AS sa, s.id IS NOT NULL AND (
            t.firstname IS DISTINCT FROM s.firstname OR t.lastname IS DISTINCT FROM s.lastname
            OR t.email IS DISTINCT FROM s.email OR t.currentaddressid IS DISTINCT FROM s.currentaddressid) AS changed
        FROM t LEFT JOIN s ON t.id = s.id
    )
    SELECT id, CASE WHEN changed THEN sf ELSE firstname END AS firstname, CASE WHEN changed THEN sl ELSE lastname END AS lastname,
        gender, CASE WHEN changed THEN se ELSE email END AS email, dateofbirth,
        CASE WHEN changed THEN sa ELSE currentaddressid END AS currentaddressid, ins_dt,
        CASE WHEN changed THEN DATE '2024-06-30' ELSE upd_dt END AS upd_dt
    FROM j
    UNION ALL
    SELECT id, firstname, lastname, gender, email, dateofbirth, currentaddressid, DATE '2024-06-30', NULL
    FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = s.id)
""")
def scd1_webshop_customer(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    return scd1_merge(
        derive(customer, _TYPE1_OLD), derive(customer, snapshot(_TYPE1)), ["id"], WEBSHOP_TYPE1_TRACKED, "2024-06-30"
    )


@query("""
    SELECT c_custkey, c_name, c_acctbal FROM (
        SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY c_name, c_acctbal) AS rn FROM (
            SELECT c_custkey, c_name, c_acctbal FROM customer
            UNION ALL SELECT c_custkey, concat('Again ', c_name), c_acctbal FROM customer)
    ) i WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def insert_ignore(spark, sf_dir):
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    again = customer.withColumn("c_name", F.concat(F.lit("Again "), "c_name"))
    target = load(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").selectExpr("o_custkey AS c_custkey")
    return first_of_new_keys(target, customer.unionByName(again), ["c_custkey"])


@query("""
    WITH known AS (SELECT DISTINCT o_custkey AS c_custkey, 'known' AS c_name FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT c_custkey, c_name FROM known
    UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM known)
""")
def insert_ignore_files(spark, sf_dir):
    """Two upserts of the customers into a stored table, which read only the files that may hold a key of theirs."""
    path = storage.scratch_dir(spark, "keyed")
    urgent = load(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    known = urgent.selectExpr("o_custkey AS c_custkey", "'known' AS c_name").distinct()
    known.repartitionByRange("c_custkey").write.parquet(path)
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for _ in range(2):
        new = first_of_new_keys(rows_of_files(spark, path, customer, ["c_custkey"]), customer, ["c_custkey"])
        new.write.mode("append").parquet(path)
    return spark.read.parquet(path)
