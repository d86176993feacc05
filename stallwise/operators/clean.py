"""The cleaning job: raw listing rows to the typed clean table.

One wide shuffle (exact duplicates), everything else is narrow.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import fixed_values as V
from stallwise import schema
from stallwise.functions import text as X


def rename_raw(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(V.RAW_NAMES)


def drop_duplicates(raw: DataFrame) -> DataFrame:
    """One of each group of equal rows; nulls equal each other.

    Runs on raw values, so rows that differ only in blanks all stay. Copies
    merge inside each input task before the shuffle, so a large group of
    copies arrives as one row per task.
    """
    return raw.dropDuplicates()


def duplicate_count(raw: DataFrame) -> DataFrame:
    """How many rows drop_duplicates removes."""
    copies = raw.groupBy(*raw.columns).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def read_price(raw_price: Column) -> Column:
    """Price as written, before the correction of typing errors."""
    return X.first_digits(raw_price)


def correct_price(price: Column) -> Column:
    kept = F.substring(price.cast("string"), 1, V.PRICE_KEEP_DIGITS).cast("long")
    return F.when(price > V.PRICE_LIMIT, kept).otherwise(price)


def rating_status(raw_rating: Column, stripped: Column) -> Column:
    """Junk text counts as Rated; only the exact "--" or no text is Unrated."""
    return (
        F.when(raw_rating.isNull() | (raw_rating == V.NO_RATING), V.STATUS_UNRATED)
        .when(F.upper(stripped) == V.NEW_RATING, V.STATUS_NEW)
        .otherwise(V.STATUS_RATED)
    )


def _stripped(raw: DataFrame) -> DataFrame:
    names = [c for c in ("restaurant_name", "location", "area", "cuisine") if c in raw.columns]
    return raw.withColumns({name: X.strip_or_null(F.col(name)) for name in names})


def _worked_once(unique_raw: DataFrame) -> DataFrame:
    """Every text that later columns use more than once, worked out once.

    Kept in projections of their own: a projection is not merged into the next
    one when that would repeat a costly expression.
    """
    return (
        _stripped(rename_raw(unique_raw))
        .withColumns(
            {
                "cuisine_list": X.comma_list(F.col("cuisine")),
                "rating_text": X.strip(F.col("rating_raw")),
                "count_body": X.count_body(F.col("rating_count_raw")),
                "price": read_price(F.col("cost_for_two_raw")),
                "offer_lines": X.lines_to_one(F.col("offer_name_raw")),
            }
        )
        .withColumn("count_digits", X.count_digits(F.col("count_body")))
        .withColumn("count_value", X.parse_number(F.col("count_digits")))
        # An empty list, a missing cell and the word itself all mean "Unknown".
        .withColumn("cuisine", F.coalesce("cuisine_list", F.lit(V.UNKNOWN_CUISINE)))
    )


def clean_rows(unique_raw: DataFrame, *others: str | Column) -> DataFrame:
    """The narrow part of the job, on rows without exact duplicates; `others` are columns to carry along."""
    cuisine = F.col("cuisine")
    known = cuisine != V.UNKNOWN_CUISINE
    rating = X.parse_number(F.col("rating_text"))
    in_thousands = F.col("count_body").contains("k")
    veg = F.lower(X.strip(F.col("pure_veg_raw"))) == V.VEG_YES
    # Not-a-number counts as missing.
    offers = F.coalesce(F.nanvl("offer_count", F.lit(0.0)), F.lit(0.0))
    return _worked_once(unique_raw).select(
        "restaurant_name",
        "location",
        F.coalesce("area", "location").alias("area"),
        "cuisine",
        X.first_item(cuisine).alias("primary_cuisine"),
        F.when(known, X.item_count(cuisine)).otherwise(0).alias("cuisine_count"),
        (F.rint(rating * 100.0) / 100.0).alias("rating"),
        rating_status(F.col("rating_raw"), F.col("rating_text")).alias("rating_status"),
        F.when(in_thousands, F.col("count_value") * 1000.0).otherwise(F.col("count_value")).alias("rating_count"),
        correct_price(F.col("price")).cast("int").alias("cost_for_two"),
        F.coalesce(veg, F.lit(False)).alias("is_pure_veg"),
        offers.cast("int").alias("offer_count"),
        F.coalesce("offer_lines", F.lit(V.NO_OFFER)).alias("offer_name"),
        *others,
    )


def clean_listings(raw: DataFrame) -> DataFrame:
    """Raw rows to the 13 clean columns.

    A price without digits becomes null here and is an error of the contract
    (see operators.contract), which keeps such rows out of the warehouse.
    """
    return clean_rows(drop_duplicates(raw)).select(*schema.CLEAN.names)


def clean_with_figures(raw: DataFrame) -> DataFrame:
    """The clean columns and those of schema.FIGURES, by the same single shuffle.

    The reports on duplicates, empty cells, corrections and imputations are sums
    over these columns, so they need not see the raw file again.
    """
    copies = raw.groupBy(*[F.col(f"`{n}`") for n in raw.columns]).agg(F.count("*").alias("copies"))
    bits = [F.col(f"`{n}`").isNull().cast("int") * (1 << i) for i, n in enumerate(raw.columns)]
    marked = copies.withColumns(
        {
            "raw_nulls": reduce(Column.__add__, bits),
            "no_area": X.strip_or_null(F.col("Area")).isNull(),
            "no_cuisine": X.strip_or_null(F.col("Cuisine")).isNull(),
        }
    )
    corrected = F.when(F.col("price") > V.PRICE_LIMIT, F.col("price")).alias("price_before")
    return clean_rows(marked, "copies", "raw_nulls", "no_area", "no_cuisine", corrected).select(
        *schema.CLEAN.names, *schema.FIGURES.names
    )


def price_corrections(raw: DataFrame) -> DataFrame:
    """Rows whose price was a typing error: name, location, price before and after.

    The condition reads a duplicate key, so it is applied before the shuffle.
    """
    price = read_price(F.col("cost_for_two_raw"))
    rows = rename_raw(drop_duplicates(raw)).filter(price > V.PRICE_LIMIT)
    return _stripped(rows).select(
        "restaurant_name",
        "location",
        price.alias("price_before"),
        correct_price(price).alias("price_after"),
    )


def imputed_counts(raw: DataFrame) -> DataFrame:
    """How many areas and cuisines the cleaning job has to fill in.

    Only rows that lack one are told apart, so only those are shuffled.
    """
    rows = _stripped(rename_raw(drop_duplicates(raw)))
    no_area, no_cuisine = F.col("area").isNull(), F.col("cuisine").isNull()
    return rows.filter(no_area | no_cuisine).agg(
        F.count_if(no_area).alias("missing_area"), F.count_if(no_cuisine).alias("missing_cuisine")
    )


def to_warehouse(clean: DataFrame) -> DataFrame:
    """The clean table with the warehouse's one-decimal rating.

    A rating the type cannot hold stops the job.
    """
    return clean.withColumn("rating", F.col("rating").cast(schema.WAREHOUSE_RATING))
