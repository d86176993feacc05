"""What each named query must return, as SQL over the test tables.

The SQL rebuilds raw listings, cleans them and aggregates with means of its
own: bands are joined from value lists, ratios are rounded on whole numbers.
Ratings are handled in tenths (`r10`), review counts as whole numbers (`k`).
"""

from stallwise import fixed_values as V
from stallwise.catalog import TEST_MAJOR_CITIES, TEST_METRO_CITIES, TEST_SLICERS

_LISTINGS = r"""
keyed AS (
  SELECT l_orderkey*31 + l_linenumber*17 + l_partkey*7 + l_suppkey AS h,
         CAST(floor(l_quantity) AS BIGINT) AS q, CAST(floor(l_extendedprice) AS BIGINT) AS ep,
         l_linestatus, p_name, p_brand, p_type, s_name, n_name
  FROM lineitem, part, supplier, nation
  WHERE p_partkey = l_partkey AND s_suppkey = l_suppkey AND n_nationkey = s_nationkey),
bound AS (
  SELECT h,
    CASE WHEN h%13=0 THEN '  ' || p_name || ' ' ELSE p_name END AS raw_name,
    CASE WHEN h%101=0 THEN NULL WHEN h%103=0 THEN ' , '
         ELSE (CASE WHEN h%3=0 THEN p_type ELSE p_brand END)
              || (CASE WHEN h%7>=3 THEN ' ,Grill' ELSE '' END)
              || (CASE WHEN h%7>=4 THEN ',, Bakery' ELSE '' END)
              || (CASE WHEN h%7>=5 THEN ', Snacks,Juices ' ELSE '' END)
              || (CASE WHEN h%7>=6 THEN ', Desserts' ELSE '' END) END AS raw_cuisine,
    CASE WHEN h%5=0 THEN '--' WHEN h%23=0 THEN 'NEW' WHEN h%1009=0 THEN NULL
         ELSE left(CAST(25+q%26 AS VARCHAR), 1) || '.' || right(CAST(25+q%26 AS VARCHAR), 1) END AS raw_rating,
    CASE WHEN h%5=0 THEN 'Too Few Ratings' WHEN h%7=0 THEN CAST(1+h%9 AS VARCHAR) || 'K+ ratings'
         ELSE CAST(q*10 AS VARCHAR) || '+ ratings' END AS raw_count,
    CASE WHEN h%19997=0 THEN '₹199246 for two'
         ELSE '₹' || CAST(50+ep%900 AS VARCHAR) || ' for two' END AS raw_price,
    CASE WHEN h%31=0 THEN NULL ELSE CAST(h%5 AS DOUBLE) END AS raw_offers,
    CASE WHEN h%5=0 THEN NULL WHEN h%37=0 THEN '  '
         ELSE 'Flat ' || CAST(h%60 AS VARCHAR) || '% off' || chr(13) || chr(10) || ' Free delivery ' END AS raw_offer,
    CASE WHEN h%97=0 THEN NULL ELSE s_name END AS raw_area,
    CASE WHEN l_linestatus='F' THEN (CASE WHEN h%2=0 THEN 'Yes' ELSE ' yes ' END) ELSE 'No' END AS raw_veg,
    n_name AS raw_location
  FROM keyed),
raw AS (
  SELECT * EXCLUDE (h) FROM bound UNION ALL SELECT * EXCLUDE (h) FROM bound WHERE h%50=0),
uniq AS (SELECT DISTINCT * FROM raw),
parsed AS (
  SELECT *, trim(raw_location) AS loc,
    list_filter(list_transform(string_split(coalesce(raw_cuisine, ''), ','), lambda x: trim(x)),
                lambda x: x <> '') AS items,
    list_filter(list_transform(string_split_regex(coalesce(raw_offer, ''), '[\r\n]+'), lambda x: trim(x)),
                lambda x: x <> '') AS parts,
    TRY_CAST(raw_rating AS DOUBLE) AS score,
    CAST(regexp_extract(raw_price, '[0-9]+') AS BIGINT) AS price
  FROM uniq),
clean AS (
  SELECT trim(raw_name) AS restaurant_name, loc AS location, coalesce(trim(raw_area), loc) AS area,
    CASE WHEN len(items)=0 THEN 'Unknown' ELSE array_to_string(items, ', ') END AS cuisine,
    coalesce(items[1], 'Unknown') AS primary_cuisine,
    CAST(len(items) AS INTEGER) AS cuisine_count,
    score AS rating,
    CASE WHEN raw_rating IS NULL OR raw_rating='--' THEN 'Unrated' WHEN raw_rating='NEW' THEN 'New'
         ELSE 'Rated' END AS rating_status,
    CASE WHEN raw_count LIKE '%K+%' THEN 1000.0 ELSE 1.0 END
      * TRY_CAST(regexp_extract(raw_count, '^[0-9]+') AS DOUBLE) AS rating_count,
    CAST(CASE WHEN price > 50000 THEN CAST(left(CAST(price AS VARCHAR), 3) AS BIGINT) ELSE price END AS INTEGER)
      AS cost_for_two,
    trim(raw_veg) ILIKE 'yes' AS is_pure_veg,
    CAST(trunc(coalesce(raw_offers, 0)) AS INTEGER) AS offer_count,
    CASE WHEN len(parts)=0 THEN 'No Offer' ELSE array_to_string(parts, ' | ') END AS offer_name
  FROM parsed),
w AS (
  SELECT *, CAST(round(rating*10) AS BIGINT) AS r10, CAST(rating_count AS BIGINT) AS k,
         offer_count AS o, cost_for_two AS c, is_pure_veg AS veg
  FROM clean)
"""


def _with(body: str, extra: str = "") -> str:
    return f"WITH {_LISTINGS}{',' + extra if extra else ''}\n{body}"


def _up(num: str, den: str, places: int) -> str:
    """num/den rounded half up on whole numbers (never negative here)."""
    scale = 10**places
    return f"(CAST((2*({num})*{scale} + ({den})) // (2*({den})) AS DOUBLE) / {scale})"


def _even(value: str, places: int) -> str:
    """A double rounded half to even on its scaled value."""
    scale = float(10**places)
    return f"(round_even(({value})*{scale}, 0) / {scale})"


def _pct(num: str, den: str, places: int = 2) -> str:
    return _even(f"CAST({num} AS DOUBLE)/{den}*100.0", places)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def _closed(tiers) -> str:
    """Tier rows (label, lo, hi, pos); the open ends and the catch-all become wide ranges."""
    rows = []
    for pos, (label, low, high) in enumerate(tiers, start=1):
        rows.append(f"({_text(label)}, {low if low is not None else 'NULL'}, "
                    f"{high if high is not None else 'NULL'}, {pos})")
    return "(VALUES " + ", ".join(rows) + ") AS t(label, lo, hi, pos)"


def _tier(column: str, tiers, pick: str = "label") -> str:
    """The first tier that holds the value, as a scalar subquery."""
    return (f"(SELECT arg_min({pick}, pos) FROM {_closed(tiers)} "
            f"WHERE (lo IS NULL OR {column} >= lo) AND (hi IS NULL OR {column} <= hi))")


def _bins(bins, scale: int = 1) -> str:
    rows = [f"({i}, {_text(label)}, {round(low * scale)}, {round(high * scale)})"
            for i, (label, low, high) in enumerate(bins, start=1)]
    return "(VALUES " + ", ".join(rows) + ") AS b(bin_order, band, lo, hi)"


R = _up("sum(r10)", "10*count(r10)", 2)
COST0 = _up("sum(c)", "count(c)", 0)
REVIEWS0 = _up("sum(k)", "count(k)", 0)
OFFERS1 = _up("sum(o)", "count(o)", 1)
RATED = "FROM w WHERE r10 IS NOT NULL"


def _share(condition: str, places: int = 1) -> str:
    return _up(f"100*count(*) FILTER (WHERE {condition})", "count(*)", places)


def _quality() -> dict[str, str]:
    raw_columns = [("Restaurant Name", "raw_name"), ("Cuisine", "raw_cuisine"), ("Rating", "raw_rating"),
                   ("Number of Ratings", "raw_count"), ("Average Price", "raw_price"),
                   ("Number of Offers", "raw_offers"), ("Offer Name", "raw_offer"), ("Area", "raw_area"),
                   ("Pure Veg", "raw_veg"), ("Location", "raw_location")]
    clean_columns = [("restaurant_name", "string"), ("location", "string"), ("area", "string"),
                     ("cuisine", "string"), ("primary_cuisine", "string"), ("cuisine_count", "int"),
                     ("rating", "double"), ("rating_status", "string"), ("rating_count", "double"),
                     ("cost_for_two", "int"), ("is_pure_veg", "boolean"), ("offer_count", "int"),
                     ("offer_name", "string")]

    def profile(columns, table: str, places: int) -> str:
        return " UNION ALL ".join(
            f"SELECT {_text(name)} AS column_name, {_text(kind)} AS data_type, "
            f"count(*) - count({column}) AS null_count, {_pct(f'(count(*) - count({column}))', 'count(*)', places)} "
            f"AS null_pct FROM {table}"
            for name, kind, column in columns
        )

    raw_profile = profile([(n, "double" if n == "Number of Offers" else "string", c) for n, c in raw_columns], "raw", 2)
    clean_profile = profile([(n, k, n) for n, k in clean_columns], "clean", 1)
    required = [name for name, _ in clean_columns if name not in ("rating", "rating_count")]
    rules = [(f"{n}_missing", f"{n} IS NULL") for n in required]
    rules += [(f"{n}_too_long", f"length({n}) > {limit}") for n, limit in
              (("location", 150), ("area", 150), ("primary_cuisine", 100), ("rating_status", 50))]
    rules += [("rating_out_of_range", "abs(rating) >= 99.95")]
    broken = " UNION ALL ".join(
        f"SELECT {_text(rule)} AS rule, count(*) AS violations FROM clean WHERE {condition}" for rule, condition in rules
    )

    def describe(value: str, places: int, source: str) -> str:
        stats = [("count", f"count({value})"), ("mean", f"sum({value})/count({value})"),
                 ("std", f"stddev_samp({value})"), ("min", f"min({value})"),
                 ("25%", f"quantile_cont({value}, 0.25)"), ("50%", f"quantile_cont({value}, 0.5)"),
                 ("75%", f"quantile_cont({value}, 0.75)"), ("max", f"max({value})")]
        return " UNION ALL ".join(
            f"SELECT {_text(n)} AS statistic, "
            f"{f'CAST({e} AS DOUBLE)' if n == 'count' else _even(f'CAST({e} AS DOUBLE)', places)} AS value FROM {source}"
            for n, e in stats
        )

    def top(key: str, n: int) -> str:
        return _with(f"SELECT {key}, count(*) AS n FROM clean WHERE {key} IS NOT NULL GROUP BY {key} "
                     f"ORDER BY n DESC, {key} LIMIT {n}")

    return {
        "clean_listings": _with("SELECT * FROM clean"),
        "clean_csv_round_trip": _with("SELECT * FROM clean"),
        "raw_csv_clean": _with("SELECT * FROM clean"),
        "raw_null_profile": _with(raw_profile),
        "clean_null_profile": _with(clean_profile),
        "row_counts": _with("SELECT 'raw' AS stage, count(*) AS row_count, 10 AS column_count FROM raw "
                            "UNION ALL SELECT 'clean', count(*), 13 FROM uniq"),
        "duplicate_count": _with("SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM uniq) AS duplicate_rows"),
        "price_corrections": _with("SELECT trim(raw_name) AS restaurant_name, loc AS location, price AS price_before, "
                                   "price // 1000 AS price_after FROM parsed WHERE price = 199246"),
        "imputed_counts": _with("SELECT count(*) FILTER (WHERE raw_area IS NULL) AS missing_area, "
                                "count(*) FILTER (WHERE raw_cuisine IS NULL) AS missing_cuisine FROM uniq"),
        "contract_violations": _with(broken),
        "warehouse_ids": _with("SELECT count(*) AS listings, count(*) AS distinct_ids, CAST(1 AS BIGINT) AS first_id, "
                               "count(*) AS last_id FROM clean"),
        "load_in_batches": _with("SELECT * FROM clean"),
        "load_ids": _with("SELECT count(*) AS listings, count(*) AS distinct_ids, CAST(1 AS BIGINT) AS first_id, "
                          "count(*) AS last_id FROM clean"),
        "load_replaced": _with("SELECT * FROM clean WHERE NOT is_pure_veg"),
        "warehouse_kpis": _with(f"SELECT {_up('sum(c)', 'count(c)', 1)} AS avg_cost, {R} AS avg_rating, "
                                f"count(*) FILTER (WHERE veg) AS veg_count, count(*) AS total, "
                                f"{_share('veg')} AS veg_pct FROM w"),
        "executive_kpis": _with(f"SELECT count(*) AS outlets, {_up('sum(c)', 'count(c)', 2)} AS mean_cost, "
                                f"quantile_cont(CAST(c AS DOUBLE), 0.5) AS median_cost, {R} AS mean_rating, "
                                f"sum(rating_count) AS total_reviews, count(*) FILTER (WHERE veg) AS pure_veg, "
                                f"{_share('veg')} AS veg_pct FROM w"),
        "describe_cost": _with(describe("c", 1, "w")),
        "describe_rating": _with(describe("rating", 2, "w")),
        "status_distribution": _with("SELECT rating_status, count(*) AS n FROM clean GROUP BY ALL"),
        "veg_distribution": _with("SELECT is_pure_veg, count(*) AS n FROM clean GROUP BY ALL"),
        "veg_mean_cost": _with(f"SELECT is_pure_veg, {_even('CAST(sum(c) AS DOUBLE)/count(c)', 2)} AS avg_cost "
                               "FROM w GROUP BY is_pure_veg"),
        "top_locations": top("location", 5),
        "top_cuisines": top("primary_cuisine", 5),
        "top10_locations": top("location", 10),
        "top10_cuisines": top("primary_cuisine", 10),
        "warehouse_top_locations": top("location", 5),
        "warehouse_top_cuisines": top("primary_cuisine", 5),
    }


def _business() -> dict[str, str]:
    menu, price, promo = V.REPORT_MENU_MODELS, V.REPORT_PRICE_TIERS, V.REPORT_PROMO_TIERS
    q07 = (f"SELECT {_tier('cuisine_count', menu)} AS restaurant_model, count(*) AS total_restaurants, "
           f"{R} AS avg_rating, {COST0} AS avg_cost, {REVIEWS0} AS avg_review_count {RATED} GROUP BY 1")
    q09 = (f"SELECT {_tier('c', price)} AS price_tier, count(*) AS total_restaurants, {R} AS avg_rating, "
           f"{REVIEWS0} AS avg_review_volume, {OFFERS1} AS avg_active_offers {RATED} GROUP BY 1")
    q12 = (f"SELECT {_tier('o', promo)} AS promotional_activity, count(*) AS restaurant_count, {R} AS avg_rating, "
           f"{REVIEWS0} AS avg_reviews_received, {COST0} AS avg_price {RATED} GROUP BY 1")

    def lift(report: str, segment: str, first: str, second: str, metric: str) -> str:
        return _with(
            f"SELECT a.{segment} AS first_segment, b.{segment} AS second_segment, a.{metric} AS first_value, "
            f"b.{metric} AS second_value, round(a.{metric}/b.{metric}, 4) AS ratio, "
            f"round((a.{metric}/b.{metric} - 1)*100, 1) AS lift_pct FROM profile a, profile b "
            f"WHERE a.{segment} = {_text(first)} AND b.{segment} = {_text(second)}",
            f"profile AS ({report})",
        )

    quadrant_names = ("(VALUES " + ", ".join(
        f"({str(high).lower()}, {str(cheap).lower()}, {_text(label)})"
        for (high, cheap), label in V.QUADRANTS.items()) + ") AS g(high, cheap, label)")
    return {
        "q01_city_share": _with(
            f"SELECT location, n AS restaurant_count, {_up('100*n', 'whole', 2)} AS pct_market_share, "
            "CAST((SELECT count(DISTINCT x.n) FROM sizes x WHERE x.n >= s.n) AS INTEGER) AS city_rank "
            "FROM sizes s, (SELECT sum(n) AS whole FROM sizes) ORDER BY n DESC, location LIMIT 10",
            "sizes AS (SELECT location, count(*) AS n FROM w GROUP BY location)"),
        "q02_veg_penetration": _with(
            f"SELECT location, count(*) AS total_restaurants, count(*) FILTER (WHERE veg) AS pure_veg_count, "
            f"{_share('veg')} AS veg_percentage, "
            f"{_up('sum(r10) FILTER (WHERE veg)', '10*count(r10) FILTER (WHERE veg)', 2)} AS avg_veg_rating, "
            f"{_up('sum(r10) FILTER (WHERE NOT veg)', '10*count(r10) FILTER (WHERE NOT veg)', 2)} AS avg_nonveg_rating "
            "FROM w GROUP BY location HAVING count(*) >= 1000 ORDER BY veg_percentage DESC, location LIMIT 10"),
        "q03_city_top_cuisine": _with(
            f"SELECT location, top_cuisine, outlet_count, {_up('100*outlet_count', 'whole', 1)} AS market_share_percentage "
            "FROM (SELECT location, primary_cuisine AS top_cuisine, n AS outlet_count, "
            "sum(n) OVER (PARTITION BY location) AS whole, "
            "row_number() OVER (PARTITION BY location ORDER BY n DESC, primary_cuisine) AS place FROM pairs) "
            f"WHERE place = 1 AND location IN {_list(TEST_MAJOR_CITIES)}",
            "pairs AS (SELECT location, primary_cuisine, count(*) AS n FROM w GROUP BY ALL)"),
        "q04_cold_start": _with(
            f"SELECT location, count(*) AS total_listings, count(*) - count(r10) AS unrated_count, "
            f"{_up('100*(count(*) - count(r10))', 'count(*)', 1)} AS unrated_percentage, count(r10) AS rated_count "
            "FROM w GROUP BY location HAVING count(*) >= 1000 ORDER BY unrated_percentage DESC, location LIMIT 10"),
        "q05_dominant_cuisines": _with(
            f"SELECT primary_cuisine, count(*) AS outlet_count, "
            f"{_up('100*count(*)', '(SELECT count(*) FROM w)', 2)} AS cuisine_share_pct, {COST0} AS avg_cost_for_two, "
            f"{R} AS avg_rating, {OFFERS1} AS avg_offers FROM w GROUP BY primary_cuisine "
            "ORDER BY outlet_count DESC, primary_cuisine LIMIT 10"),
        "q06_cuisine_prices": _with(
            f"SELECT primary_cuisine, count(*) AS restaurant_count, {COST0} AS avg_cost, min(c) AS min_cost, "
            f"max(c) AS max_cost, {R} AS avg_rating FROM w GROUP BY primary_cuisine HAVING count(*) >= 100 "
            "ORDER BY avg_cost DESC, primary_cuisine LIMIT 10"),
        "q07_menu_models": _with(q07),
        "q08_rating_consistency": _with(
            f"SELECT primary_cuisine, count(*) AS total_outlets, {R} AS mean_rating, "
            "round(stddev_samp(rating), 2) AS rating_std_dev, min(r10)/10.0 AS min_rating, max(r10)/10.0 AS max_rating "
            f"{RATED} GROUP BY primary_cuisine HAVING count(*) >= 1000 "
            "ORDER BY mean_rating DESC, rating_std_dev, primary_cuisine LIMIT 10").replace(
                "min(r10)/10.0", "CAST(min(r10) AS DOUBLE)/10").replace("max(r10)/10.0", "CAST(max(r10) AS DOUBLE)/10"),
        "q09_price_tiers": _with(q09),
        "q10_metro_top": _with(
            "SELECT CAST(place AS INTEGER) AS city_rank, location, restaurant_name, primary_cuisine, rating, "
            "rating_count, cost_for_two FROM (SELECT *, dense_rank() OVER (PARTITION BY location "
            f"ORDER BY r10 DESC NULLS FIRST, k DESC NULLS FIRST) AS place FROM w WHERE k >= 50) "
            f"WHERE place <= 3 AND location IN {_list(TEST_METRO_CITIES)}"),
        "q11_city_ticket_size": _with(
            f"SELECT location, count(*) AS restaurant_count, {COST0} AS avg_ticket_size, {R} AS avg_city_rating, "
            f"{_up('sum(k)', '1000', 1)} AS total_reviews_in_k {RATED} GROUP BY location HAVING count(*) >= 1500 "
            "ORDER BY avg_ticket_size DESC, location LIMIT 10"),
        "q12_promotion_effect": _with(q12),
        "q13_discount_reliance": _with(
            f"SELECT primary_cuisine, count(*) AS total_outlets, count(*) FILTER (WHERE o >= 2) AS heavy_discount_outlets, "
            f"{_share('o >= 2')} AS discount_reliance_pct, {COST0} AS avg_cost FROM w GROUP BY primary_cuisine "
            "HAVING count(*) >= 500 ORDER BY discount_reliance_pct DESC, primary_cuisine LIMIT 10"),
        "q14_quadrants": _with(
            f"SELECT label AS strategic_quadrant, count(*) AS restaurant_count, "
            f"{_up('100*count(*)', 'any_value(n)', 1)} AS pct_of_rated, {R} AS avg_rating, "
            f"{COST0} AS avg_cost_for_two, {REVIEWS0} AS avg_ratings_volume "
            f"FROM w, (SELECT sum(r10) AS s, sum(c) AS cs, count(*) AS n {RATED}) m, {quadrant_names} "
            "WHERE r10 IS NOT NULL AND g.high = (r10*n >= s) AND g.cheap = (c*n < cs) GROUP BY label"),
        "q15_national_chains": _with(
            f"SELECT restaurant_name, count(DISTINCT location) AS cities_present, count(*) AS total_outlets, "
            f"{R} AS avg_brand_rating, {COST0} AS avg_brand_cost, CAST(sum(k) AS DOUBLE) AS total_customer_reviews "
            "FROM w GROUP BY restaurant_name HAVING count(DISTINCT location) >= 15 "
            "ORDER BY cities_present DESC, total_outlets DESC, restaurant_name LIMIT 10"),
        "lift_menu": lift(q07, "restaurant_model", menu[0][0], menu[2][0], "avg_review_count"),
        "lift_promo": lift(q12, "promotional_activity", promo[2][0], promo[0][0], "avg_reviews_received"),
        "lift_price": lift(q09, "price_tier", price[2][0], price[0][0], "avg_review_volume"),
    }


def _exploration() -> dict[str, str]:
    whole = "(SELECT count(*) FROM w)"

    def ranked_counts(key: str, n: int, count: str) -> str:
        return f"SELECT {key}, count(*) AS {count} FROM w WHERE {key} IS NOT NULL GROUP BY {key} " \
               f"ORDER BY {count} DESC, {key} LIMIT {n}"

    def distribution(value: str, bins, scale: int = 1) -> str:
        return _with(
            f"SELECT bin_order, band, n AS count, {_pct('n', 'sum(n) OVER ()')} AS pct_share FROM per_bin",
            f"per_bin AS (SELECT bin_order, band, count({value}) AS n FROM {_bins(bins, scale)} "
            f"LEFT JOIN w ON {value} > lo AND {value} <= hi GROUP BY ALL)")

    def rating_by(value: str, bins) -> str:
        mean = _even("CAST(sum(r10*10) AS DOUBLE)/(count(r10)*100)", 2)
        median = _even("quantile_cont(CAST(r10*10 AS DOUBLE), 0.5)/100.0", 2)
        share = _pct("count(*) FILTER (WHERE r10 >= 40)", "nullif(count(r10), 0)")
        return _with(f"SELECT bin_order, band, count(r10) AS count, {mean} AS mean, {median} AS median, "
                     f"CASE WHEN count(r10) > 0 THEN {share} END AS pct_rated_4_plus FROM {_bins(bins)} "
                     f"LEFT JOIN (SELECT * {RATED}) w ON {value} > lo AND {value} <= hi GROUP BY ALL")

    def one(value: str, table: str = "w") -> str:
        return f"(SELECT {value} FROM {table} GROUP BY {value} HAVING {value} IS NOT NULL " \
               f"ORDER BY count(*) DESC, {value} LIMIT 1)"

    def rank(value: str) -> str:
        return f"(rank() OVER (ORDER BY {value}) + (count(*) OVER (PARTITION BY {value}) - 1) / 2.0)"

    def side(metric: str, value: str) -> str:
        def of(flag: str) -> str:
            return f"(SELECT {value} FROM w WHERE veg = {flag})"
        return f"SELECT {_text(metric)} AS metric, {of('false')} AS non_veg, {of('true')} AS pure_veg"

    comparison = [
        ("total_count", "CAST(count(restaurant_name) AS DOUBLE)"),
        ("pct_share", _pct("count(*)", f"any_value({whole})")),
        ("avg_price", _even("CAST(sum(c) AS DOUBLE)/count(c)", 2)),
        ("median_price", _even("quantile_cont(CAST(c AS DOUBLE), 0.5)", 2)),
        ("avg_rating", _even("CAST(sum(r10*10) AS DOUBLE)/(count(r10)*100)", 2)),
        ("median_rating", _even("quantile_cont(CAST(r10*10 AS DOUBLE), 0.5)/100.0", 2)),
        ("avg_reviews", _even("CAST(sum(k) AS DOUBLE)/count(k)", 2)),
        ("avg_offers", _even("CAST(sum(o) AS DOUBLE)/count(o)", 2)),
    ]
    scaled = " + ".join(
        f"(({c}) - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) * {weight}"
        for c, weight in (("r", 0.35), ("k", 0.30), ("n", 0.20), ("o", 0.15)))
    return {
        "e01_top_locations_cumulative": _with(
            f"SELECT location, restaurant_count, {_pct('restaurant_count', whole)} AS pct_share, "
            f"{_pct('sum(restaurant_count) OVER (ORDER BY restaurant_count DESC, location)', whole)} AS cumulative_pct "
            f"FROM ({ranked_counts('location', 15, 'restaurant_count')})"),
        "e01_unique_locations": _with("SELECT count(DISTINCT location) AS unique_locations FROM w"),
        "e02a_primary_cuisines": _with(
            f"SELECT primary_cuisine, outlet_count, {_pct('outlet_count', whole)} AS pct_share "
            f"FROM ({ranked_counts('primary_cuisine', 10, 'outlet_count')})"),
        "e02b_all_cuisines": _with(
            f"SELECT cuisine_item, count(*) AS total_listings_offering, {_pct('count(*)', f'any_value({whole})')} "
            "AS pct_of_all_restaurants FROM (SELECT unnest(string_split(cuisine, ', ')) AS cuisine_item FROM w) "
            "GROUP BY cuisine_item ORDER BY total_listings_offering DESC, cuisine_item LIMIT 10"),
        "e03a_rating_summary": _with(
            f"SELECT {_even('CAST(sum(r10) AS DOUBLE)/count(r10)*10.0/100.0', 2)} AS mean, "
            f"{_even('quantile_cont(CAST(r10*10 AS DOUBLE), 0.5)/100.0', 2)} AS median, "
            f"CAST({one('r10')} AS DOUBLE)/10 AS mode, {_even('stddev_samp(rating)', 2)} AS std, "
            f"{_even('quantile_cont(CAST(r10*10 AS DOUBLE), 0.25)/100.0', 2)} AS q1, "
            f"{_even('quantile_cont(CAST(r10*10 AS DOUBLE), 0.75)/100.0', 2)} AS q3 FROM w"),
        "e03b_rating_bins": distribution("r10", V.RATING_BINS, 10),
        "e04a_price_summary": _with(
            f"SELECT {_even('CAST(sum(c) AS DOUBLE)/count(c)', 2)} AS mean, "
            f"{_even('quantile_cont(CAST(c AS DOUBLE), 0.5)', 2)} AS median, CAST({one('c')} AS DOUBLE) AS mode, "
            f"{_even('quantile_cont(CAST(c AS DOUBLE), 0.25)', 2)} AS q1, "
            f"{_even('quantile_cont(CAST(c AS DOUBLE), 0.75)', 2)} AS q3 FROM w"),
        "e04b_price_bins": distribution("c", V.PRICE_BINS),
        "e05a_price_rating_corr": _with(
            f"SELECT {_even('corr(c, r10)', 4)} AS pearson, {_even('corr(rc, rr)', 4)} AS spearman "
            f"FROM (SELECT c, r10, {rank('c')} AS rc, {rank('r10')} AS rr {RATED})"),
        "e05b_rating_by_price": rating_by("c", V.PRICE_BINS),
        "e06a_rating_reviews_corr": _with(
            f"SELECT {_even('corr(rating, rating_count)', 4)} AS pearson {RATED} AND k IS NOT NULL"),
        "e06b_rating_by_popularity": rating_by("k", V.POPULARITY_BINS),
        "e07_veg_comparison": _with(" UNION ALL ".join(side(*item) for item in comparison)),
        "e08_offer_distribution": _with(
            f"SELECT offer_count, count(*) AS restaurants, {_pct('count(*)', f'any_value({whole})')} AS pct_share "
            "FROM w GROUP BY offer_count"),
        "e08_offer_share": _with(
            f"SELECT count(*) FILTER (WHERE o > 0) AS restaurants_with_offer, "
            f"{_pct('count(*) FILTER (WHERE o > 0)', 'count(*)')} AS pct_share FROM w"),
        "e09a_gold_share": _with(
            f"SELECT count(*) FILTER (WHERE r10 >= 45 AND k >= 1000) AS gold_count, "
            f"{_pct('count(*) FILTER (WHERE r10 >= 45 AND k >= 1000)', 'count(*)')} AS pct_of_all FROM w"),
        "e09b_gold_top": _with(
            "SELECT restaurant_name, location, primary_cuisine, rating, rating_count, cost_for_two FROM w "
            "WHERE r10 >= 45 AND k >= 1000 ORDER BY r10 DESC, k DESC, 1, 2, 3, 6 LIMIT 10"),
        "e10_city_score": _with(
            f"SELECT location, n AS total_restaurants, {_even('r', 2)} AS avg_rating, {_even('k', 2)} AS avg_reviews, "
            f"{_even('m', 2)} AS median_cost, {_even('score', 2)} AS composite_score "
            f"FROM (SELECT *, ({scaled}) * 100 AS score FROM cities) ORDER BY score DESC, location LIMIT 10",
            "cities AS (SELECT location, count(restaurant_name) AS n, CAST(sum(r10) AS DOUBLE)/(count(r10)*10) AS r, "
            "CAST(sum(k) AS DOUBLE)/count(k) AS k, quantile_cont(CAST(c AS DOUBLE), 0.5) AS m, "
            "CAST(sum(o) AS DOUBLE)/count(*) AS o FROM w WHERE location IS NOT NULL GROUP BY location "
            "HAVING count(restaurant_name) >= 500)"),
    }


def _views() -> dict[str, str]:
    cuts = "(VALUES " + ", ".join(
        f"({_text(label)}, {round(float(low) * 10) if low else -1000}, {pos})"
        for pos, (label, low) in enumerate(V.VIEW_RATING_TIERS, start=1)) + ") AS t(label, lo, pos)"
    enriched = (
        "v AS (SELECT restaurant_name, location AS city, area, cuisine AS all_cuisines, primary_cuisine, cuisine_count, "
        "rating, rating_status, coalesce(rating_count, 0.0) AS review_count, cost_for_two, is_pure_veg, offer_count, "
        f"offer_name, {_tier('c', V.VIEW_PRICE_TIERS)} AS price_tier, "
        f"{_tier('c', V.VIEW_PRICE_TIERS, 'pos')} AS price_tier_sort, "
        f"coalesce((SELECT arg_min(label, pos) FROM {cuts} WHERE r10 >= lo), {_text(V.VIEW_RATING_NONE)}) AS rating_tier, "
        f"coalesce((SELECT min(pos) FROM {cuts} WHERE r10 >= lo), 5) AS rating_tier_sort, "
        f"{_tier('cuisine_count', V.VIEW_KITCHEN_MODELS)} AS kitchen_model, "
        f"{_tier('o', V.VIEW_PROMO_TIERS)} AS promotional_tier, "
        "CASE is_pure_veg WHEN true THEN 'Pure Veg' ELSE 'Non-Veg / Mixed' END AS veg_category, r10 FROM w)")

    # Measures, each over the rows of one group.
    n, k = "count(*)", "sum(review_count)"
    rating = "(CAST(sum(r10) AS DOUBLE)/10/count(r10))"
    cost = "(CAST(sum(cost_for_two) AS DOUBLE)/count(cost_for_two))"
    nat_rating = f"(SELECT {rating} FROM v)"
    nat_cost = f"(SELECT {cost} FROM v)"
    whole_k = f"CAST({k} AS BIGINT)"
    millions = f"CAST(CAST({_up(whole_k, '1000000', 1)} AS DECIMAL(18,1)) AS VARCHAR) || 'M Reviews'"
    thousands = f"CAST(CAST({_up(whole_k, '1000', 1)} AS DECIMAL(18,1)) AS VARCHAR) || 'K Reviews'"
    few = f"format('{{:,}}', {whole_k}) || ' Reviews'"
    volume = f"CASE WHEN {k} >= 1000000 THEN {millions} WHEN {k} >= 1000 THEN {thousands} ELSE {few} END"
    rating_card = (f"coalesce(CAST(CAST({_up('sum(r10)', '10*count(r10)', 2)} AS DECIMAL(18,2)) AS VARCHAR) || ' ⭐', 'N/A')")
    cost_card = f"'₹' || format('{{:,}}', CAST({_up('sum(cost_for_two)', 'count(cost_for_two)', 0)} AS BIGINT))"

    def counted(condition: str) -> str:
        return f"count(*) FILTER (WHERE {condition})"

    def mean_reviews(condition: str) -> str:
        return (f"(sum(review_count) FILTER (WHERE {condition}) / "
                f"nullif(count(*) FILTER (WHERE {condition}), 0))")

    def over_rows(part: str) -> str:
        return f"(CAST({part} AS DOUBLE)/count(*))"

    many, none = mean_reviews("offer_count >= 3"), mean_reviews("offer_count = 0")
    lift = f"coalesce((coalesce({many}, 0.0) - {none})/nullif({none}, 0), 0.0)"
    difference = f"(coalesce({rating}, 0.0) - {nat_rating})"
    note = (f"CASE WHEN {difference} < 0 THEN '▼ ' ELSE '▲ +' END || "
            f"CAST(CAST(round({difference}, 2) AS DECIMAL(18,2)) AS VARCHAR) || ' vs National Avg'")
    city_title = (f"CASE WHEN count(DISTINCT city) = 1 THEN {_text(V.CITY_TITLE_ONE)} || min(city) "
                  f"ELSE {_text(V.CITY_TITLE_ALL)} END")
    before, after = V.CUISINE_TITLE_ONE
    cuisine_title = (f"CASE WHEN count(DISTINCT primary_cuisine) = 1 THEN {_text(before)} || min(primary_cuisine) || "
                     f"{_text(after)} ELSE {_text(V.CUISINE_TITLE_ALL)} END")
    value = {
        "total_restaurants": n, "total_review_volume": k, "total_reviews_formatted": volume,
        "average_rating": rating, "average_rating_kpi": rating_card, "average_cost_for_two": cost,
        "average_cost_kpi": cost_card, "pure_veg_restaurants": counted("is_pure_veg"),
        "pure_veg_share": over_rows(counted("is_pure_veg")), "unrated_restaurants": counted("r10 IS NULL"),
        "cold_start_share": over_rows(counted("r10 IS NULL")), "restaurants_with_deals": counted("offer_count > 0"),
        "promo_penetration": over_rows(counted("offer_count > 0")), "avg_reviews_aggressive_offers": many,
        "avg_reviews_no_offers": none, "discount_review_lift": lift, "national_avg_rating": nat_rating,
        "national_avg_cost": nat_cost, "rating_vs_national": difference, "rating_variance_indicator": note,
        "city_title": city_title, "cuisine_title": cuisine_title,
        "average_reviews": f"({k}/count(*))", "cities_present": "count(DISTINCT city)",
    }

    def measured(names, by=(), where: str = "true", tail: str = "") -> str:
        columns = list(by) + [f"{value[name]} AS {name}" for name in names]
        group = f" GROUP BY {', '.join(by)}" if by else ""
        return _with(f"SELECT {', '.join(columns)} FROM v WHERE {where}{group} {tail}", enriched)

    slicers = " AND ".join(
        f"{name} IN {_list([chosen] if isinstance(chosen, str) else chosen)}" for name, chosen in TEST_SLICERS.items())
    benchmarks = ["total_restaurants", "average_rating", "average_cost_for_two", "national_avg_rating",
                  "national_avg_cost", "rating_vs_national", "rating_variance_indicator"]
    promotions = ["restaurants_with_deals", "promo_penetration", "avg_reviews_aggressive_offers",
                  "avg_reviews_no_offers", "discount_review_lift"]
    kpis = ["total_restaurants", "average_cost_kpi", "average_rating_kpi", "pure_veg_share", "total_reviews_formatted"]
    titles = ["city_title", "cuisine_title"]
    chain = measured(["cities_present", "average_rating", "average_cost_for_two", "total_review_volume"],
                     ["restaurant_name"],
                     tail="ORDER BY cities_present DESC, count(*) DESC, restaurant_name LIMIT 10")

    def largest(key: str) -> str:
        return measured(["total_restaurants"], [key], tail=f"ORDER BY total_restaurants DESC, {key} LIMIT 10")

    replaced_filter = _with(
        "SELECT a.city, a.is_pure_veg, a.n AS total_restaurants, b.veg AS pure_veg_restaurants, "
        "CAST(b.veg AS DOUBLE)/a.n AS pure_veg_share "
        "FROM (SELECT city, is_pure_veg, count(*) AS n FROM v GROUP BY ALL) a "
        "JOIN (SELECT city, count(*) FILTER (WHERE is_pure_veg) AS veg FROM v GROUP BY ALL) b USING (city)", enriched)
    replaced_slicer = _with(
        "SELECT a.city, a.n AS total_restaurants, restaurants_with_deals, "
        "CAST(restaurants_with_deals AS DOUBLE)/a.n AS promo_penetration, avg_reviews_aggressive_offers, "
        "avg_reviews_no_offers, discount_review_lift "
        "FROM (SELECT city, count(*) AS n FROM v WHERE offer_count IN (1, 2) GROUP BY ALL) a "
        f"JOIN (SELECT city, {counted('offer_count > 0')} AS restaurants_with_deals, "
        f"{many} AS avg_reviews_aggressive_offers, {none} AS avg_reviews_no_offers, {lift} AS discount_review_lift "
        "FROM v GROUP BY city) b USING (city)", enriched)
    everything = list(value)
    found = {
        "vw1_listings_enriched": _with("SELECT * EXCLUDE (r10) FROM v", enriched),
        "vw2_city_summary": _with(
            f"SELECT location AS city, count(*) AS total_restaurants, {R} AS avg_rating, {COST0} AS avg_cost_for_two, "
            f"count(*) FILTER (WHERE veg) AS pure_veg_count, {_share('veg')} AS veg_percentage, "
            f"count(*) - count(r10) AS unrated_count, {_share('r10 IS NULL')} AS unrated_percentage, "
            "CAST(coalesce(sum(k), 0) AS DOUBLE) AS total_reviews_volume, "
            "count(DISTINCT primary_cuisine) AS unique_cuisines_count FROM w GROUP BY location"),
        "vw3_cuisine_matrix": _with(
            f"SELECT primary_cuisine, count(*) AS total_outlets, "
            f"{_up('100*count(*)', '(SELECT count(*) FROM w)', 2)} AS market_share_pct, {COST0} AS avg_cost, "
            f"{R} AS avg_rating, coalesce({REVIEWS0}, 0) AS avg_review_count, "
            f"count(*) FILTER (WHERE o >= 2) AS heavy_discount_outlets, {_share('o >= 2')} AS discount_reliance_pct, "
            f"{_share('veg')} AS veg_share_pct FROM w GROUP BY primary_cuisine HAVING count(*) >= 50"),
        "m_all_measures": measured(everything),
        "m_kpi_row": measured(kpis),
        "m_by_city_vs_national": measured(benchmarks, ["city"]),
        "m_promotions_by_city": measured(promotions, ["city"]),
        "m_cold_start_by_city": measured(["unrated_restaurants", "cold_start_share"], ["city"]),
        "m_sliced": measured(benchmarks + promotions, ["primary_cuisine"], slicers),
        "m_kpi_sliced": measured(kpis, where=slicers),
        "m_replaced_filter": replaced_filter,
        "m_replaced_slicer": replaced_slicer,
        "m_titles": measured(titles),
        "m_titles_one_city": measured(titles, ["veg_category"], "city = 'NATION_3' AND primary_cuisine = 'ECONOMY'"),
        "d03_top_cities": largest("city"),
        "d04_veg_split": measured(["total_restaurants"], ["veg_category"]),
        "d05_city_scatter": measured(["average_cost_for_two", "average_rating", "total_review_volume"], ["city"]),
        "d06_top_cuisines": largest("primary_cuisine"),
        "d07_kitchen_models": measured(["average_rating", "total_review_volume"], ["kitchen_model"]),
        "d08_cuisine_table": measured(
            ["total_restaurants", "average_cost_for_two", "average_rating", "promo_penetration"], ["primary_cuisine"]),
        "d09_promotion_tiers": measured(["average_reviews", "average_rating"], ["promotional_tier"]),
        "d10_price_tiers": measured(["average_rating", "total_review_volume"], ["price_tier", "price_tier_sort"]),
        "d11_chains": chain,
    }
    return found | {
        "vw2_kept_city_summary": found["vw2_city_summary"],
        "vw3_kept_cuisine_matrix": found["vw3_cuisine_matrix"],
    }


_NET_PRICES = """
net AS (
  SELECT n_name AS city, l_extendedprice * (1 - l_discount) AS net_price, l_quantity AS quantity
  FROM lineitem, supplier, nation WHERE s_suppkey = l_suppkey AND n_nationkey = s_nationkey)
"""


def _unbounded() -> dict[str, str]:
    shares = " UNION ALL ".join(
        f"SELECT city, CAST({s} AS DOUBLE) AS share, round(quantile_cont(net_price, {s}), 6) AS quantile, count(*) AS rows "
        "FROM net GROUP BY city" for s in (0.25, 0.5, 0.75))
    rank = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0"
    return {
        "e11_price_quartiles_by_city": f"WITH {_NET_PRICES} {shares}",
        "e12_price_rank_correlation": f"WITH {_NET_PRICES}, ranked AS (SELECT {rank.format('net_price')} AS a, "
                                      f"{rank.format('quantity')} AS b FROM net) "
                                      "SELECT count(*) AS pairs, round(corr(a, b), 9) AS spearman FROM ranked",
    }


def statements() -> dict[str, str]:
    return _quality() | _business() | _exploration() | _views() | _unbounded()
