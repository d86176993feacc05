"""Fixed values.

Everything in this file is a value that results depend on: words, labels,
edges, thresholds and titles. There is no logic here.
"""

# Texts that mean "missing" when a raw file is read.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Characters removed from both ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Raw column -> working name.
RAW_NAMES = {
    "Restaurant Name": "restaurant_name",
    "Cuisine": "cuisine",
    "Rating": "rating_raw",
    "Number of Ratings": "rating_count_raw",
    "Average Price": "cost_for_two_raw",
    "Number of Offers": "offer_count",
    "Offer Name": "offer_name_raw",
    "Area": "area",
    "Pure Veg": "pure_veg_raw",
    "Location": "location",
}

# Words in raw cells.
MISSING_AFTER_STRIP = "nan"
NO_RATING = "--"
NEW_RATING = "NEW"
TOO_FEW_RATINGS = "Too Few Ratings"
VEG_YES = "yes"

# Words in clean cells.
UNKNOWN_CUISINE = "Unknown"
NO_OFFER = "No Offer"
STATUS_RATED = "Rated"
STATUS_NEW = "New"
STATUS_UNRATED = "Unrated"

# A price above the limit is a typing error; its first digits are the price.
PRICE_LIMIT = 50000
PRICE_KEEP_DIGITS = 3

# Longest texts and largest rating the warehouse table takes.
TEXT_LIMITS = {"location": 150, "area": 150, "primary_cuisine": 100, "rating_status": 50}
RATING_OVERFLOW = 99.95

# Price tiers of the reports: (label, lowest cost, highest cost); the last takes the rest.
REPORT_PRICE_TIERS = (
    ("Budget (< Rs.200)", None, 199),
    ("Mid-Range (Rs.200-400)", 200, 400),
    ("Upper Mid-Range (Rs.401-700)", 401, 700),
    ("Premium (> Rs.700)", None, None),
)

# Price tiers of the enriched view.
VIEW_PRICE_TIERS = (
    ("Budget (< ₹200)", None, 199),
    ("Mid-Range (₹200-₹400)", 200, 400),
    ("Upper Mid (₹401-₹700)", 401, 700),
    ("Premium (> ₹700)", None, None),
)

# Rating tiers of the enriched view: (label, lowest rating).
VIEW_RATING_TIERS = (
    ("⭐ 4.5+ Elite", "4.5"),
    ("⭐ 4.0 - 4.4 Popular", "4.0"),
    ("⭐ 3.5 - 3.9 Average", "3.5"),
    ("⭐ Below 3.5 Underperformer", None),
)
VIEW_RATING_NONE = "⚪ Unrated (Cold-Start)"

# Menu models by number of cuisines; the last takes the rest, 0 included.
REPORT_MENU_MODELS = (
    ("1. Single Cuisine (Specialist)", 1, 1),
    ("2. Multi-Cuisine (2-4 Cuisines)", 2, 4),
    ("3. Generalist (5+ Cuisines)", None, None),
)
VIEW_KITCHEN_MODELS = (
    ("Single Cuisine Specialist", 1, 1),
    ("Multi-Cuisine (2-4)", 2, 4),
    ("Generalist (5+ Cuisines)", None, None),
)

# Promotion tiers by number of offers; the last takes the rest.
REPORT_PROMO_TIERS = (
    ("No Offers", 0, 0),
    ("1-2 Offers", 1, 2),
    ("3+ Offers (Aggressive)", None, None),
)
VIEW_PROMO_TIERS = (
    ("No Offers", 0, 0),
    ("1-2 Offers (Moderate)", 1, 2),
    ("3+ Offers (Aggressive)", None, None),
)

VEG_LABEL = "Pure Veg"
NON_VEG_LABEL = "Non-Veg / Mixed"

# Quadrants: rating at or above the mean, cost below the mean.
QUADRANTS = {
    (True, True): "1. Value Champions (High Rating, Low Price)",
    (True, False): "2. Premium Leaders (High Rating, High Price)",
    (False, True): "3. Budget Underperformers (Low Rating, Low Price)",
    (False, False): "4. Overpriced Risk (Low Rating, High Price)",
}

# Bins of the exploration reports: (label, above, up to); values outside get no bin.
RATING_BINS = (
    ("< 3.0", 0.0, 3.0),
    ("3.0 - 3.4", 3.0, 3.5),
    ("3.5 - 3.9", 3.5, 4.0),
    ("4.0 - 4.4", 4.0, 4.5),
    ("4.5 - 5.0", 4.5, 5.0),
)
PRICE_BINS = (
    ("Budget (<= 150)", 0, 150),
    ("Affordable (151 - 250)", 150, 250),
    ("Mid-Range (251 - 500)", 250, 500),
    ("Premium (501 - 1000)", 500, 1000),
    ("Luxury (> 1000)", 1000, 10000),
)
POPULARITY_BINS = (
    ("Micro (2-9)", 0, 9),
    ("Niche (10-49)", 9, 49),
    ("Moderate (50-99)", 49, 99),
    ("High (100-499)", 99, 499),
    ("Very High (500-999)", 499, 999),
    ("Massive (1K-4.9K)", 999, 4999),
    ("Superstar (5K+)", 4999, 100000),
)

# Cities named by the reports.
MAJOR_CITIES = (
    "Mumbai", "Bangalore", "Hyderabad", "Kolkata", "Delhi",
    "Jaipur", "Lucknow", "Ahmedabad", "Pune", "Chandigarh",
)
METRO_CITIES = ("Bangalore", "Mumbai", "Hyderabad", "Kolkata", "Delhi")

# Thresholds of the reports.
CITY_MIN_LISTINGS = 1000
TICKET_CITY_MIN_LISTINGS = 1500
SCORE_CITY_MIN_LISTINGS = 500
CUISINE_PRICE_MIN_LISTINGS = 100
CUISINE_CONSISTENCY_MIN_LISTINGS = 1000
CUISINE_DISCOUNT_MIN_LISTINGS = 500
CUISINE_MATRIX_MIN_LISTINGS = 50
HEAVY_DISCOUNT_OFFERS = 2
CHAIN_MIN_CITIES = 15
METRO_MIN_REVIEWS = 50
METRO_TOP = 3
REPORT_TOP = 10
LOCATION_TOP = 15
WELL_RATED = 4.0
HIGH_RATED = 4.2
GOLD_RATING = 4.5
GOLD_REVIEWS = 1000

# Weights of the city score.
CITY_SCORE_WEIGHTS = {
    "avg_rating": 0.35,
    "avg_reviews": 0.30,
    "total_restaurants": 0.20,
    "avg_offers": 0.15,
}

# Offer counts the promotion measures compare.
AGGRESSIVE_OFFERS = 3

# Display texts of the measures.
REVIEWS_SUFFIX = " Reviews"
RATING_SUFFIX = " ⭐"
RATING_MISSING = "N/A"
CURRENCY_SIGN = "₹"
ABOVE_BENCHMARK = "▲ +"
BELOW_BENCHMARK = "▼ "
BENCHMARK_SUFFIX = " vs National Avg"
CITY_TITLE_ALL = "All India Restaurant Performance & Market Overview"
CITY_TITLE_ONE = "Market Intelligence Deep Dive — "
CUISINE_TITLE_ALL = "Cuisine Landscape & Menu Economics (All Cuisines)"
CUISINE_TITLE_ONE = ("Deep Dive Analysis: ", " Category")
