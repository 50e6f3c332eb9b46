"""Driver test tables and the dirty landing derived from them.

``dirty_landing`` turns lineitem x orders x customer x part into raw landing
text with every defect the validation rules look for (bad ids, padded or
NULL products, bad quantities and prices, two date widths, impossible
dates, NULL addresses, bad postal codes, lower-case states, yearly price
changes) and three arrival batches. ``LANDING_SQL`` is the same derivation
for the DuckDB oracle.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Product family suffix by p_partkey % 9, and the three batch stamps.
FAMILIES = ("Monitor", "AA Batteries", "Headphones", "TV", "Washing Machine", "Phone",
            "Laptop", "Cable", "Gadget")
BATCH_STAMPS = ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00")
# Orders after this instant count as "in the future" in the driver queries.
AS_OF = "2000-06-30 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _s(c: Column) -> Column:
    return c.cast("string")


def dirty_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread(table(spark, sf_dir, "lineitem")).select(
        F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"),
        F.col("l_quantity").cast("int").alias("q"), F.col("l_partkey").alias("pk"))
    od = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ok"), F.col("o_orderdate").alias("d"), F.col("o_custkey").alias("ck"))
    cu = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ck"), F.col("c_nationkey").alias("nk"), F.col("c_mktsegment").alias("seg"))
    pa = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pk"), "p_name")

    ok, d, ck, nk = F.col("ok"), F.col("d"), F.col("ck"), F.col("nk")
    fam = F.element_at(F.array(*[F.lit(x) for x in FAMILIES]), (F.col("pk") % 9 + 1).cast("int"))
    even = ok % 2 == 0
    yr = _s(F.year(d))
    hour_text = F.concat(
        F.lpad(_s(F.month(d)), 2, "0"), F.lit("/"), F.lpad(_s(F.dayofmonth(d)), 2, "0"), F.lit("/"),
        F.when(even, yr).otherwise(F.substring(yr, 3, 2)), F.lit(" "),
        F.when(even, _s(ok % 24)).otherwise(F.lpad(_s(ok % 24), 2, "0")), F.lit(":"))
    letter = F.expr("chr(65 + nk)")
    address = F.concat(
        _s(ck), F.lit(" "), F.col("seg"), F.lit(" St, City"), _s(nk % 20), F.lit(", "),
        F.when(ck % 10 == 0, F.lower(letter)).otherwise(letter), F.lit("Z "),
        F.when(ck % 53 == 0, F.lit("N/A")).otherwise(_s(nk * 37 + 10000)))
    # Orders meet their customers first, so the line items are dealt twice and not three times, and an order's items end side by side.
    # Texts that an order's items share are made once a customer or order.
    cu = cu.select("ck", address.alias("address"))
    od = od.join(cu, "ck").select("ok", F.year(d).alias("y"), hour_text.alias("hour_text"), F.when(ok % 59 != 0, F.col("address")).alias("address"))
    b = (li.join(pa, "pk").join(od, "ok")
         .withColumn("prod", F.concat(F.col("p_name"), F.lit(" "), fam)))
    stamp = F.element_at(F.array(*[F.lit(s).cast("timestamp") for s in BATCH_STAMPS]), (ok % 3 + 1).cast("int"))

    return b.select(
        F.when(ok % 97 == 0, "Order ID").when(ok % 89 == 0, "").otherwise(_s(ok)).alias("order_id"),
        F.when(ok % 101 == 0, F.lit(None).cast("string"))
        .when(ok % 5 == 0, F.concat(F.lit(" "), F.col("prod"), F.lit(" ")))
        .otherwise(F.col("prod")).alias("product"),
        F.when(ok % 79 == 0, "0").when(ok % 73 == 0, "two").when(ok % 103 == 0, F.lit(None))
        .otherwise(_s(F.col("q"))).alias("quantity_ordered"),
        F.when(ok % 83 == 0, "12.345").when(ok % 67 == 0, "0")
        .otherwise(F.concat(_s(F.length("prod") + (F.col("y") - 1995) * 5 + 10), F.lit(".95")))
        .alias("price_each"),
        F.when(ok % 71 == 0, F.lit(None).cast("string")).when(ok % 61 == 0, "13/45/1999 10:00")
        .otherwise(F.concat("hour_text", F.lpad(_s(F.col("ln")), 2, "0"))).alias("order_date"),
        F.col("address").alias("purchase_address"),
        stamp.alias("updated_at"),
    )


LANDING_SQL = """
SELECT CASE WHEN ok % 97 = 0 THEN 'Order ID' WHEN ok % 89 = 0 THEN '' ELSE CAST(ok AS VARCHAR) END AS order_id,
  CASE WHEN ok % 101 = 0 THEN NULL WHEN ok % 5 = 0 THEN ' ' || prod || ' ' ELSE prod END AS product,
  CASE WHEN ok % 79 = 0 THEN '0' WHEN ok % 73 = 0 THEN 'two' WHEN ok % 103 = 0 THEN NULL ELSE CAST(q AS VARCHAR) END AS quantity_ordered,
  CASE WHEN ok % 83 = 0 THEN '12.345' WHEN ok % 67 = 0 THEN '0'
       ELSE CAST(10 + length(prod) + (year(d) - 1995) * 5 AS VARCHAR) || '.95' END AS price_each,
  CASE WHEN ok % 71 = 0 THEN NULL WHEN ok % 61 = 0 THEN '13/45/1999 10:00'
       ELSE lpad(CAST(month(d) AS VARCHAR), 2, '0') || '/' || lpad(CAST(day(d) AS VARCHAR), 2, '0') || '/' ||
            CASE WHEN ok % 2 = 0 THEN CAST(year(d) AS VARCHAR) ELSE substring(CAST(year(d) AS VARCHAR), 3, 2) END || ' ' ||
            CASE WHEN ok % 2 = 0 THEN CAST(ok % 24 AS VARCHAR) ELSE lpad(CAST(ok % 24 AS VARCHAR), 2, '0') END || ':' ||
            lpad(CAST(ln AS VARCHAR), 2, '0') END AS order_date,
  CASE WHEN ok % 59 = 0 THEN NULL ELSE CAST(ck AS VARCHAR) || ' ' || seg || ' St, City' || CAST(nk % 20 AS VARCHAR) || ', ' ||
       CASE WHEN ck % 10 = 0 THEN lower(chr(65 + nk)) ELSE chr(65 + nk) END || 'Z ' ||
       CASE WHEN ck % 53 = 0 THEN 'N/A' ELSE CAST(10000 + nk * 37 AS VARCHAR) END END AS purchase_address,
  CASE ok % 3 WHEN 0 THEN TIMESTAMP '2024-01-01 00:00:00' WHEN 1 THEN TIMESTAMP '2024-01-02 00:00:00'
       ELSE TIMESTAMP '2024-01-03 00:00:00' END AS updated_at
FROM (
  SELECT l.l_orderkey AS ok, l.l_linenumber AS ln, CAST(l.l_quantity AS INT) AS q, o.o_orderdate AS d,
         c.c_custkey AS ck, c.c_nationkey AS nk, c.c_mktsegment AS seg,
         p.p_name || ' ' || CASE p.p_partkey % 9
           WHEN 0 THEN 'Monitor' WHEN 1 THEN 'AA Batteries' WHEN 2 THEN 'Headphones' WHEN 3 THEN 'TV'
           WHEN 4 THEN 'Washing Machine' WHEN 5 THEN 'Phone' WHEN 6 THEN 'Laptop' WHEN 7 THEN 'Cable'
           ELSE 'Gadget' END AS prod
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey) b
"""
