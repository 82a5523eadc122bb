"""Review warehouse: business, review and user documents to dimensions and a fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.functions.cleaning import (
    first_contained_label,
    first_true_label,
    last_item_is,
    list_size,
    null_if,
    python_flags,
    python_literal,
    text_to_boolean,
)
from starwright.functions.timeparts import text_to_timestamp
from starwright.operators.dimensions import dimension_with_id, new_surrogates
from starwright.operators.matching import attach_dimension
from starwright.operators.quality import non_empty_check
from starwright.schemas import BUSINESS, REVIEW, review_star, user_schema
from starwright.sinks.files import write_json
from starwright.sinks.tables import create_table
from starwright.sources.files import read_json
from starwright.sources.staging import stage_table
from starwright.storage import exists, intermediates, written

# Label priorities and the sentinel for "no label".
AMBIENCES = [
    "romantic", "classy", "hipster", "touristy", "casual", "intimate", "divey", "trendy",
    "upscale",
]
CATEGORIES = [
    "American", "Mexican", "Italian", "Canadian", "Japanese", "Indian", "Chinese",
    "Middle Eastern",
]
NO_AMBIENCE = "N/A"
NO_ALCOHOL = "none"
# Loaded table -> file it comes from.
FILES = {
    "state": "state", "category": "category", "ambience": "ambience", "users": "user",
    "business_reviews": "business_reviews",
}
BY_YEAR = {"partition_by": ["year"], "keep_partition_columns": True, "compression": "gzip"}
BOOLEAN_ATTRIBUTES = {
    "take_credit_cards": "BusinessAcceptsCreditCards",
    "good_for_kids": "GoodForKids",
    "happy_hour": "HappyHour",
    "restaurants_takeout": "RestaurantsTakeOut",
}


def clean_business(business: DataFrame) -> DataFrame:
    """One row per business with its attributes as plain typed columns.

    The ambience text is parsed once, then labelled.
    """
    attribute = {name: F.col(f"attributes.{name}") for name in
                 ("Alcohol", "Ambience", "Smoking", "WiFi", *BOOLEAN_ATTRIBUTES.values())}
    flagged = business.withColumn("_flags", python_flags(attribute["Ambience"], AMBIENCES))
    return flagged.select(
        "business_id",
        "state",
        "is_open",
        "review_count",
        F.col("stars").alias("business_stars"),
        null_if(python_literal(attribute["Alcohol"]), NO_ALCOHOL).alias("alcohol"),
        first_true_label(F.col("_flags"), AMBIENCES, NO_AMBIENCE).alias("ambience"),
        *[text_to_boolean(attribute[raw]).alias(name) for name, raw in BOOLEAN_ATTRIBUTES.items()],
        python_literal(attribute["Smoking"]).alias("smoking"),
        python_literal(attribute["WiFi"]).alias("wifi"),
        first_contained_label(F.col("categories"), CATEGORIES).alias("restaurant_category"),
    )


# Dimension -> its value and id columns.
DIMENSIONS = {
    "state": ("state", "state_id"),
    "category": ("restaurant_category", "category_id"),
    "ambience": ("ambience", "ambience_id"),
}


def dimension_values(clean: DataFrame, name: str) -> DataFrame:
    """Businesses that have a value of the dimension."""
    return clean.filter(F.col("ambience") != NO_AMBIENCE) if name == "ambience" else clean


def _dimension(clean: DataFrame, name: str) -> DataFrame:
    return dimension_with_id(dimension_values(clean, name), *DIMENSIONS[name])


def state_dimension(clean: DataFrame) -> DataFrame:
    return _dimension(clean, "state")


def category_dimension(clean: DataFrame) -> DataFrame:
    return _dimension(clean, "category")


def ambience_dimension(clean: DataFrame) -> DataFrame:
    return _dimension(clean, "ambience")


def user_dimension(users: DataFrame, since: str, as_of_year: int) -> DataFrame:
    """Users with list fields counted; elite means so in the year before ``as_of_year``."""
    joined = text_to_timestamp(F.col(since))
    return users.select(
        "user_id",
        "name",
        F.col("review_count").alias("user_review_count"),
        since,
        list_size(F.col("friends")).alias("user_friend_count"),
        F.col("useful").alias("useful_vote_cnt"),
        F.col("funny").alias("funny_vote_cnt"),
        F.col("cool").alias("cool_vote_cnt"),
        F.col("average_stars").alias("user_average_stars"),
        list_size(F.col("elite"), empty_as_zero=True).alias("user_elite_year_cnt"),
        last_item_is(F.col("elite"), as_of_year - 1).alias("is_user_elite"),
        F.col("fans").alias("user_fans"),
        F.year(joined).alias("year"),
        F.month(joined).alias("month"),
    )


def business_with_ids(
    clean: DataFrame, category: DataFrame, ambience: DataFrame, state: DataFrame
) -> DataFrame:
    """Businesses with a known state, their labels replaced by dimension ids."""
    with_ids = attach_dimension(clean, category, "restaurant_category", "category_id")
    with_ids = attach_dimension(with_ids, ambience, "ambience", "ambience_id")
    return attach_dimension(with_ids, state, "state", "state_id", how="inner")


def business_reviews(with_ids: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per review of a business that has its ids."""
    written_on = text_to_timestamp(F.col("date"))
    counted = reviews.select(
        "review_id",
        "user_id",
        "business_id",
        F.col("stars").alias("review_stars"),
        F.col("cool").alias("review_cool"),
        F.col("funny").alias("review_funny"),
        F.col("useful").alias("review_useful"),
        F.year(written_on).alias("year"),
        F.month(written_on).alias("month"),
    )
    return counted.join(with_ids, "business_id").select(
        *with_ids.columns, *[name for name in counted.columns if name != "business_id"]
    )


def build(
    spark: SparkSession, source: str, output: str, *, since: str, as_of_year: int
) -> dict[str, DataFrame]:
    """Write the four dimensions and the fact as JSON; return them read back.

    Businesses are cleaned once and dimensions numbered once, so the ids in
    the fact are those in the dimension files. Ids go onto the businesses, the
    smaller side; written, they join the reviews at their true size, and a
    business with very many reviews is split by AQE.
    """
    users = read_json(spark, f"{source}/user.json", user_schema(since))
    reviews = read_json(spark, f"{source}/review.json", REVIEW)
    with intermediates(spark):
        business = read_json(spark, f"{source}/business.json", BUSINESS)
        clean = written(clean_business(business), "clean")
        state, category, ambience = (
            state_dimension(clean),
            category_dimension(clean),
            ambience_dimension(clean),
        )
        with_ids = written(business_with_ids(clean, category, ambience, state), "business")
        tables = {
            "state": (state, {}),
            "category": (category, {}),
            "ambience": (ambience, {}),
            "user": (user_dimension(users, since, as_of_year), BY_YEAR),
            "business_reviews": (business_reviews(with_ids, reviews), BY_YEAR),
        }
        for name, (table, layout) in tables.items():
            write_json(table, f"{output}/{name}.json", **layout)
    return {
        name: read_json(spark, f"{output}/{name}.json", table.schema).select(*table.columns)
        for name, (table, _) in tables.items()
    }


def refresh(
    spark: SparkSession, source: str, output: str, name: str, *, since: str, as_of_year: int
) -> None:
    """Bring one of the five JSON outputs up to date, reading only what it needs.

    Dimensions grow: values that are stored keep their ids, new ones get the
    next, so a fact written before still points to the right rows. The fact
    takes its ids from the stored dimensions: refresh those first if businesses
    have changed.
    """
    if name == "user":
        users = read_json(spark, f"{source}/user.json", user_schema(since))
        write_json(user_dimension(users, since, as_of_year), f"{output}/user.json", **BY_YEAR)
        return
    clean = clean_business(read_json(spark, f"{source}/business.json", BUSINESS))
    with intermediates(spark):
        if name in DIMENSIONS:
            path = f"{output}/{name}.json"
            if exists(spark, path):
                stored = read_json(spark, path, review_star(since)[name])
                known = dimension_values(clean, name)
                write_json(new_surrogates(stored, known, *DIMENSIONS[name]), path, mode="append")
            else:
                write_json(_dimension(clean, name), path)
        elif name == "business_reviews":
            stored = review_star(since)
            state, category, ambience = (
                read_json(spark, f"{output}/{dimension}.json", stored[dimension])
                for dimension in DIMENSIONS
            )
            with_ids = written(business_with_ids(clean, category, ambience, state), "business")
            reviews = read_json(spark, f"{source}/review.json", REVIEW)
            write_json(
                business_reviews(with_ids, reviews), f"{output}/business_reviews.json", **BY_YEAR
            )
        else:
            raise ValueError(f"no output {name!r}")


def load(spark: SparkSession, database: str, output: str, *, since: str) -> dict[str, DataFrame]:
    """Create the typed tables, replace their rows by the JSON outputs, check the fact."""
    for name, columns in review_star(since).items():
        create_table(spark, f"{database}.{name}", columns)
        stage_table(
            spark, f"{database}.{name}", f"{output}/{FILES[name]}.json", columns, is_json=True
        )
    non_empty_check(spark, f"{database}.business_reviews")
    return {name: spark.table(f"{database}.{name}") for name in FILES}
