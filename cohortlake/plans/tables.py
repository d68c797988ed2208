"""The study record view over the star schema tables, for the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.contract import RECORDS


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _from_lineitem() -> dict[str, Column]:
    status = F.array(*[F.lit(s) for s in ("active", "completed", "withdrawn", "adverse_event")])
    return {
        "patient_id": F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")),
        "drug": F.when(F.col("l_partkey") % 97 != 0, F.col("l_returnflag")),
        "dosage_mg": F.when(F.col("l_suppkey") % 41 != 0, F.col("l_quantity") * 10),
        "age": (F.col("l_partkey") % 58 + 18).cast("int"),
        "status": status[F.col("l_linenumber") % 4],
        "outcome_score": F.when(
            (F.col("l_orderkey") + F.col("l_linenumber")) % 10 != 0,
            F.round(F.col("l_discount") * 1000) + F.col("l_partkey") % 7,
        ),
    }


def trial_records(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One study record per line item, with the given columns (all by default).

    Only tables that supply a wanted column are joined. Nothing is hinted: sizes decide which
    sides are broadcast, and adaptive execution splits skewed keys.
    """
    wanted = list(columns) or RECORDS.names
    df = load(spark, sf_dir, "lineitem")
    own = _from_lineitem()
    joined: dict[str, Column] = {}
    if {"trial_id", "enrollment_date"} & set(wanted):
        orders = load(spark, sf_dir, "orders")
        df = df.join(orders, df["l_orderkey"] == orders["o_orderkey"])
        joined["trial_id"] = F.col("o_orderpriority")
        joined["enrollment_date"] = F.col("o_orderdate").cast("date")
    if "weight_kg" in wanted:
        part = load(spark, sf_dir, "part")
        df = df.join(part, df["l_partkey"] == part["p_partkey"])
        joined["weight_kg"] = F.col("p_size") * F.lit(1.5) + F.lit(45.0)
    if "site" in wanted:
        supplier = load(spark, sf_dir, "supplier")
        nation = load(spark, sf_dir, "nation")
        sites = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
        df = df.join(sites, df["l_suppkey"] == sites["s_suppkey"])
        joined["site"] = F.col("n_name")
    expressions = own | joined
    return df.select(*[expressions[name].alias(name) for name in wanted])


# The same view for a second engine.
RECORDS_SQL = """
SELECT cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar) AS patient_id,
       o_orderpriority AS trial_id,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_returnflag END AS drug,
       n_name AS site,
       CASE WHEN l_suppkey % 41 = 0 THEN NULL ELSE l_quantity * 10 END AS dosage_mg,
       cast(18 + l_partkey % 58 AS integer) AS age,
       cast(p_size * cast(1.5 AS double) + 45 AS double) AS weight_kg,
       cast(o_orderdate AS date) AS enrollment_date,
       CASE l_linenumber % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'completed'
            WHEN 2 THEN 'withdrawn' ELSE 'adverse_event' END AS status,
       CASE WHEN (l_orderkey + l_linenumber) % 10 = 0 THEN NULL
            ELSE round(l_discount * 1000) + l_partkey % 7 END AS outcome_score
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
""".strip()
