"""The test tables read as raw listings (see FIXTURES.md section 2).

One listing per order line joined to its part, supplier and nation. The joins
carry no hints: the sizes of the sides grow with the data, so the engine picks
broadcast or shuffle by measured size.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _every(key: Column, n: int) -> Column:
    return key % n == 0


def _cuisine(h: Column) -> Column:
    first = F.when(_every(h, 3), F.col("p_type")).otherwise(F.col("p_brand"))
    added = [(3, " ,Grill"), (4, ",, Bakery"), (5, ", Snacks,Juices "), (6, ", Desserts")]
    tails = [F.when(h % 7 >= least, text).otherwise("") for least, text in added]
    return F.when(_every(h, 101), None).when(_every(h, 103), " , ").otherwise(F.concat(first, *tails))


def _rating(h: Column, q: Column) -> Column:
    tenths = (25 + q % 26).cast("string")
    point = F.concat(F.substring(tenths, 1, 1), F.lit("."), F.substring(tenths, 2, 1))
    return F.when(_every(h, 5), "--").when(_every(h, 23), "NEW").when(_every(h, 1009), None).otherwise(point)


def _rating_count(h: Column, q: Column) -> Column:
    thousands = F.concat((1 + h % 9).cast("string"), F.lit("K+ ratings"))
    plain = F.concat((q * 10).cast("string"), F.lit("+ ratings"))
    return F.when(_every(h, 5), "Too Few Ratings").when(_every(h, 7), thousands).otherwise(plain)


def _price(h: Column, ep: Column) -> Column:
    usual = F.concat(F.lit("₹"), (50 + ep % 900).cast("string"), F.lit(" for two"))
    return F.when(_every(h, 19997), "₹199246 for two").otherwise(usual)


def _offer(h: Column) -> Column:
    text = F.concat(F.lit("Flat "), (h % 60).cast("string"), F.lit("% off\r\n Free delivery "))
    return F.when(_every(h, 5), None).when(_every(h, 37), "  ").otherwise(text)


def raw_listings(spark: SparkSession, sf_dir: str, part: int = 0, parts: int = 1) -> DataFrame:
    """Raw listings with the ten raw columns, exact duplicates included.

    With `parts`, only the listings of every so many-th order line of a file, from line `part` on: all parts together are all listings.
    """

    def table(name: str, *columns: str, rows: Column | None = None) -> DataFrame:
        found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return (found if rows is None else found.filter(rows)).select(*columns)

    lines = table(
        "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_linestatus",
        rows=None if parts == 1 else F.col("_metadata.row_index") % parts == part,
    )
    parts = table("part", "p_partkey", "p_name", "p_brand", "p_type")
    suppliers = table("supplier", "s_suppkey", "s_name", "s_nationkey")
    nations = table("nation", "n_nationkey", "n_name")
    # Tasks read whole row groups, so a file with few of them has few readers. Its narrow lines are dealt
    # out evenly, whatever their keys, before they become wide rows that are compared with each other.
    lines = lines.repartition(F.monotonically_increasing_id())
    # One table at a time: the engine knows the size of a table, but only a rough
    # bound on the size of a join, and would shuffle where it need not.
    joined = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    keyed = joined.withColumns(
        {
            "h": F.expr("l_orderkey*31 + l_linenumber*17 + l_partkey*7 + l_suppkey"),
            "q": F.floor("l_quantity").cast("long"),
            "ep": F.floor("l_extendedprice").cast("long"),
        }
    )
    # Every 50th row appears twice: repeated in place, so nothing is joined twice.
    h, q, ep = F.col("h"), F.col("q"), F.col("ep")
    copies = F.when(_every(h, 50), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    repeated = keyed.withColumn("copy", F.explode(copies))
    name = F.col("p_name")
    veg = F.when(F.col("l_linestatus") != "F", "No").when(_every(h, 2), "Yes").otherwise(" yes ")
    return repeated.select(
        F.when(_every(h, 13), F.concat(F.lit("  "), name, F.lit(" "))).otherwise(name).alias("Restaurant Name"),
        _cuisine(h).alias("Cuisine"),
        _rating(h, q).alias("Rating"),
        _rating_count(h, q).alias("Number of Ratings"),
        _price(h, ep).alias("Average Price"),
        F.when(~_every(h, 31), (h % 5).cast("double")).alias("Number of Offers"),
        _offer(h).alias("Offer Name"),
        F.when(~_every(h, 97), F.col("s_name")).alias("Area"),
        veg.alias("Pure Veg"),
        F.col("n_name").alias("Location"),
    )
