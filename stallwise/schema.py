"""Column layouts of the raw file, the clean table and the warehouse table."""

from pyspark.sql import types as T

from stallwise.fixed_values import RAW_NAMES

RAW = T.StructType(
    [
        T.StructField(name, T.DoubleType() if name == "Number of Offers" else T.StringType())
        for name in RAW_NAMES
    ]
)

CLEAN = T.StructType(
    [
        T.StructField("restaurant_name", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("cuisine", T.StringType()),
        T.StructField("primary_cuisine", T.StringType()),
        T.StructField("cuisine_count", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("rating_status", T.StringType()),
        T.StructField("rating_count", T.DoubleType()),
        T.StructField("cost_for_two", T.IntegerType()),
        T.StructField("is_pure_veg", T.BooleanType()),
        T.StructField("offer_count", T.IntegerType()),
        T.StructField("offer_name", T.StringType()),
    ]
)

WAREHOUSE_RATING = T.DecimalType(3, 1)

# What a store holds: both ratings, and where a row stood when it was written.
STORE = T.StructType(
    CLEAN.fields
    + [T.StructField("warehouse_rating", WAREHOUSE_RATING), T.StructField("load_position", T.LongType())]
)

# What the cleaning job learns about a row on the way, kept beside it: how often
# it was in the raw file, which raw columns were empty (a bit each, in their
# order), what had to be filled in, and a price that was a typing error.
FIGURES = T.StructType(
    [
        T.StructField("copies", T.LongType()),
        T.StructField("raw_nulls", T.IntegerType()),
        T.StructField("no_area", T.BooleanType()),
        T.StructField("no_cuisine", T.BooleanType()),
        T.StructField("price_before", T.LongType()),
    ]
)

# Columns that may be empty; every other clean column must hold a value.
NULLABLE = ("rating", "rating_count")
