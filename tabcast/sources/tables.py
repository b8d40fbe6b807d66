"""Table sources: the driver's parquet tables and the shipment-shaped stand-in input.

``raw_shipments`` only gives rows in the raw schema the reference's jobs expect (key,
measures, text flags, text dates, free-text address, target); it does none of the
jobs' work. Missing cells come from orders without line items and from a fixed
rule on the key's md5, the same rule the DuckDB oracle uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

KEY = "o_orderkey"
TARGET = "Transport_Cost"

# Raw shipment schema (reference column names, our key).
RAW_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.LongType(), False),
        T.StructField("Supplier_Name", T.StringType()),
        T.StructField("Supplier_Reliability", T.DoubleType()),
        T.StructField("Equipment_Height", T.DoubleType()),
        T.StructField("Equipment_Width", T.DoubleType()),
        T.StructField("Equipment_Weight", T.DoubleType()),
        T.StructField("Equipment_Value", T.DoubleType()),
        T.StructField("Base_Transport_Fee", T.DoubleType()),
        T.StructField("Equipment_Type", T.StringType()),
        T.StructField("CrossBorder_Shipping", T.StringType()),
        T.StructField("Urgent_Shipping", T.StringType()),
        T.StructField("Installation_Service", T.StringType()),
        T.StructField("Transport_Method", T.StringType()),
        T.StructField("Fragile_Equipment", T.StringType()),
        T.StructField("Hospital_Info", T.StringType()),
        T.StructField("Rural_Hospital", T.StringType()),
        T.StructField("Order_Placed_Date", T.StringType()),
        T.StructField("Delivery_Date", T.StringType()),
        T.StructField("Hospital_Location", T.StringType()),
        T.StructField(TARGET, T.DoubleType()),
    ]
)

RAW_CATEGORICAL = (
    "Equipment_Type",
    "CrossBorder_Shipping",
    "Urgent_Shipping",
    "Installation_Service",
    "Transport_Method",
    "Fragile_Equipment",
    "Hospital_Info",
    "Rural_Hospital",
)
RAW_NUMERIC = (
    "Supplier_Reliability",
    "Equipment_Height",
    "Equipment_Width",
    "Equipment_Weight",
    "Equipment_Value",
    "Base_Transport_Fee",
)

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table; timestamps are cast to DATE by callers that need dates."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _nibble(h: Column, pos: int) -> Column:
    return F.substring(h, pos, 1)


def _mmddyy(d: Column) -> Column:
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(two(F.month(d)), F.lit("/"), two(F.dayofmonth(d)), F.lit("/"), two(F.year(d) % 100))


def raw_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in raw input: one row per order (key ``o_orderkey``), reference column names.

    The plan is lazy: projections and filters reach the source scans. Callers that read it in many
    passes write or persist what they use.

    Joins are left to Catalyst/AQE (sort-merge for the large sides; small dimension sides
    are broadcast by the optimizer only when their measured size is under the threshold).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_shipdate"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    lines = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(supp, li.l_suppkey == supp.s_suppkey)
        .groupBy("l_orderkey")
        .agg(
            F.min("l_suppkey").alias("min_supp"),
            (F.max("s_acctbal") / F.lit(1000.0)).alias("reliability"),
            F.max("p_size").cast("double").alias("height"),
            F.max("l_quantity").alias("width"),
            F.sum("l_quantity").alias("weight"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("value"),
            (F.max("l_tax") * F.lit(1000.0)).alias("fee"),
            F.min("p_type").alias("ptype"),
            F.min("s_nationkey").alias("min_snat"),
            F.max("s_nationkey").alias("max_snat"),
            F.max("l_shipdate").cast("date").alias("ship"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    base = (
        orders.join(cust, orders.o_custkey == cust.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .withColumn("h", F.md5(F.col(KEY).cast("string")))
    )
    h = F.col("h")
    letters = F.lit(_LETTERS)
    state = F.concat(
        F.substring(letters, F.col("n_nationkey") % 26 + 1, 1),
        F.substring(letters, (F.col("n_regionkey") * 5 + F.col("c_custkey")) % 26 + 1, 1),
    )
    zip5 = F.lpad((F.col("c_custkey") * 37 % 100000).cast("string"), 5, "0")
    custs = F.col("c_custkey").cast("string")
    address = (
        F.when(_nibble(h, 3) == "0", F.lit(None).cast("string"))
        .when(_nibble(h, 3) == "1", F.lit("Missing"))
        .when(_nibble(h, 2) == "a", F.concat(F.lit("PSC "), custs, F.lit(", Box 7, APO AE "), zip5))
        .when(_nibble(h, 2) == "b", F.concat(F.lit("USNS Vessel, fpo AP "), zip5))
        .when(_nibble(h, 2) == "c", F.concat(custs, F.lit(" Harbor Rd, Suite "), zip5))
        .otherwise(F.concat(custs, F.lit(" Main St, City "), custs, F.lit(", "), state, F.lit(" "), zip5))
    )
    order_date = F.col("o_orderdate").cast("date")
    null_if = lambda cond, x: F.when(cond, F.lit(None)).otherwise(x)
    return base.select(
        F.col(KEY),
        F.concat(F.lit("Supplier#"), F.col("min_supp").cast("string")).alias("Supplier_Name"),
        null_if(_nibble(h, 5).isin("0", "1", "2"), F.col("reliability")).cast("double").alias("Supplier_Reliability"),
        null_if(_nibble(h, 6) == "0", F.col("height")).cast("double").alias("Equipment_Height"),
        F.col("width").cast("double").alias("Equipment_Width"),
        null_if(_nibble(h, 7) == "0", F.col("weight")).cast("double").alias("Equipment_Weight"),
        F.col("value").cast("double").alias("Equipment_Value"),
        null_if(_nibble(h, 8) == "0", F.col("fee")).cast("double").alias("Base_Transport_Fee"),
        F.col("ptype").alias("Equipment_Type"),
        F.when(F.col("min_snat").isNull(), F.lit(None).cast("string"))
        .when((F.col("min_snat") == F.col("c_nationkey")) & (F.col("max_snat") == F.col("c_nationkey")), F.lit("No"))
        .otherwise(F.lit("Yes"))
        .alias("CrossBorder_Shipping"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("Yes")).otherwise(F.lit("No")).alias(
            "Urgent_Shipping"
        ),
        null_if(_nibble(h, 9) == "0", F.col("o_orderstatus")).cast("string").alias("Installation_Service"),
        F.col("o_orderpriority").alias("Transport_Method"),
        F.when(F.col("height") > 40, F.lit("Yes")).when(F.col("height").isNotNull(), F.lit("No")).alias(
            "Fragile_Equipment"
        ),
        null_if(_nibble(h, 10) == "0", F.col("c_mktsegment")).cast("string").alias("Hospital_Info"),
        F.when(_nibble(h, 11) == "0", F.lit(None).cast("string"))
        .when(F.col("n_regionkey").isin(0, 2), F.lit("Yes"))
        .otherwise(F.lit("No"))
        .alias("Rural_Hospital"),
        F.when(_nibble(h, 4) == "f", F.lit("13/45/99")).otherwise(_mmddyy(order_date)).alias("Order_Placed_Date"),
        _mmddyy(F.col("ship")).alias("Delivery_Date"),
        address.alias("Hospital_Location"),
        (F.col("o_totalprice") / F.lit(10.0) + F.col("c_acctbal")).alias(TARGET),
    )


def split_raw(raw: DataFrame, test_frac: float = 0.1, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Labelled (train) and unlabelled (test) raw rows: hash hold-out on the key; test loses the target."""
    from tabcast.operators.split import holdout_flag

    flagged = raw.withColumn("__test", holdout_flag(KEY, test_frac, seed))
    train = flagged.filter(~F.col("__test")).drop("__test")
    test = flagged.filter(F.col("__test")).drop("__test", TARGET)
    return train, test
