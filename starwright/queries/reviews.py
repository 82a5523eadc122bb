"""The review warehouse on documents derived from the test tables.

Parts stand for businesses, order lines for reviews, customers for users.
"""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.plans import reviews as plan
from starwright.queries.registry import REGISTRY, Tables, query
from starwright.schemas import review_star
from starwright.sinks.files import write_json
from starwright.sinks.tables import create_database
from starwright.sources.files import read_json
from starwright.storage import scratch_dir

SINCE, AS_OF_YEAR = "member_since", 2024

CLEAN_SQL = """clean AS (SELECT 'B' || CAST(p_partkey AS VARCHAR) AS business_id,
    CASE WHEN p_size % 10 <> 0 THEN 'ST' || CAST(p_size % 10 AS VARCHAR) END AS state,
    CAST(p_size % 2 AS BIGINT) AS is_open, CAST(p_size AS BIGINT) AS review_count,
    p_size / 10.0 AS business_stars, CASE WHEN p_size % 3 = 1 THEN 'full_bar' END AS alcohol,
    CASE WHEN p_size % 7 = 0 THEN 'N/A' WHEN p_size % 5 = 0 THEN 'romantic'
      WHEN p_size % 4 = 0 THEN 'classy' WHEN p_size % 3 = 0 THEN 'trendy' ELSE 'N/A' END AS ambience,
    CASE WHEN p_size % 3 = 0 THEN TRUE WHEN p_size % 3 = 1 THEN FALSE END AS take_credit_cards,
    p_size % 2 = 0 AS good_for_kids, CASE WHEN p_size % 5 = 0 THEN TRUE END AS happy_hour,
    p_size % 2 = 1 AS restaurants_takeout,
    CASE WHEN p_size % 2 = 0 THEN 'no' ELSE 'outdoor' END AS smoking,
    CASE WHEN p_size % 4 <> 0 THEN 'free' END AS wifi,
    CASE WHEN p_type = 'ECONOMY' THEN 'Mexican' WHEN p_type = 'PROMO' THEN 'American'
      WHEN p_type = 'STANDARD' THEN 'Middle Eastern' END AS restaurant_category FROM part)"""


def _dimension_sql(column: str, identifier: str, where: str = "TRUE") -> str:
    return f"""SELECT {column}, CAST(row_number() OVER (ORDER BY {column}) AS BIGINT) AS {identifier}
    FROM (SELECT DISTINCT {column} FROM clean WHERE {column} IS NOT NULL AND {where}) d"""


DIMENSIONS_SQL = f"""state AS ({_dimension_sql("state", "state_id")}),
    category AS ({_dimension_sql("restaurant_category", "category_id")}),
    ambience AS ({_dimension_sql("ambience", "ambience_id", "ambience <> 'N/A'")})"""


def _choice(column, *branches):
    """Text by the first true condition."""
    chosen = F.lit(None).cast("string")
    for condition, value in reversed(branches):
        chosen = F.when(condition, value).otherwise(chosen)
    return chosen.alias(column)


def _flag(condition):
    return F.when(condition, "True").otherwise("False")


def _business(t: Tables) -> DataFrame:
    """Businesses with their attributes as the text of Python literals."""
    size, kind = F.col("p_size"), F.col("p_type")
    ambience = F.concat(
        F.lit("{'romantic': "), _flag(size % 5 == 0), F.lit(", u'classy': "), _flag(size % 4 == 0),
        F.lit(", 'casual': None, 'trendy': "), _flag(size % 3 == 0), F.lit("}"),
    )
    attributes = F.struct(
        _choice("Alcohol", (size % 3 == 0, "u'none'"), (size % 3 == 1, "'full_bar'")),
        _choice("Ambience", (size % 7 == 0, "None"), (F.lit(True), ambience)),
        _choice("BusinessAcceptsCreditCards", (size % 3 == 0, "True"), (size % 3 == 1, "False")),
        _flag(size % 2 == 0).alias("GoodForKids"),
        _choice("HappyHour", (size % 5 == 0, "True"), (F.lit(True), "None")),
        _flag(size % 2 == 1).alias("RestaurantsTakeOut"),
        _choice("Smoking", (size % 2 == 0, "u'no'"), (F.lit(True), "'outdoor'")),
        _choice("WiFi", (size % 4 != 0, "u'free'"), (F.lit(True), "None")),
    )
    return t.part.select(
        F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("business_id"),
        F.col("p_name").alias("name"),
        _choice("state", (size % 10 != 0, F.concat(F.lit("ST"), (size % 10).cast("string")))),
        (size / 10).alias("stars"),
        size.cast("long").alias("review_count"),
        (size % 2).cast("long").alias("is_open"),
        _choice(
            "categories",
            (kind == "ECONOMY", "Burgers, Mexican, Chinese"),
            (kind == "PROMO", "Chinese, American"),
            (kind == "STANDARD", "Nightlife, Middle Eastern"),
            (kind == "LARGE", "Plumbers"),
        ),
        attributes.alias("attributes"),
    )


def _reviews(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("review_id"),
        F.concat(F.lit("U"), F.col("l_suppkey").cast("string")).alias("user_id"),
        F.concat(F.lit("B"), F.col("l_partkey").cast("string")).alias("business_id"),
        F.col("l_quantity").alias("stars"),
        F.when(F.col("l_linenumber") == 7, "unknown")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("date"),
        F.col("l_returnflag").alias("text"),
        F.col("l_linenumber").cast("long").alias("useful"),
        F.col("l_suppkey").alias("funny"),
        F.col("l_orderkey").alias("cool"),
    )


def _users(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        F.concat(F.lit("U"), key.cast("string")).alias("user_id"),
        F.col("c_name").alias("name"),
        (key % 50).alias("review_count"),
        F.when(key % 11 == 0, "soon")
        .otherwise(F.concat(F.lit("20"), F.lpad((key % 20).cast("string"), 2, "0"), F.lit("-03-05")))
        .alias(SINCE),
        _choice("friends", (key % 4 == 0, "None"), (key % 4 == 1, "U1, U2, U3"), (key % 4 == 2, "U7")),
        (key % 3).alias("useful"),
        (key % 5).alias("funny"),
        (key % 7).alias("cool"),
        (key % 13).alias("fans"),
        _choice("elite", (key % 3 == 0, ""), (key % 3 == 1, "2012,2023"), (F.lit(True), "2015")),
        F.col("c_acctbal").alias("average_stars"),
    )


@query(f"WITH {CLEAN_SQL} SELECT * REPLACE (CAST(business_stars AS DOUBLE) AS business_stars) FROM clean")
def review_businesses(t: Tables) -> DataFrame:
    return plan.clean_business(_business(t))


@query(f"WITH {CLEAN_SQL} {_dimension_sql('state', 'state_id')}")
def review_states(t: Tables) -> DataFrame:
    return plan.state_dimension(plan.clean_business(_business(t)))


@query(f"WITH {CLEAN_SQL} {_dimension_sql('restaurant_category', 'category_id')}")
def review_categories(t: Tables) -> DataFrame:
    return plan.category_dimension(plan.clean_business(_business(t)))


@query(f"""WITH {CLEAN_SQL} {_dimension_sql("ambience", "ambience_id", "ambience <> 'N/A'")}""")
def review_ambiences(t: Tables) -> DataFrame:
    return plan.ambience_dimension(plan.clean_business(_business(t)))


@query(
    """SELECT 'U' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name,
    c_custkey % 50 AS user_review_count, CASE WHEN c_custkey % 11 = 0 THEN 'soon'
      ELSE '20' || lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0') || '-03-05' END AS member_since,
    CAST(CASE c_custkey % 4 WHEN 1 THEN 3 WHEN 3 THEN NULL ELSE 1 END AS INT) AS user_friend_count,
    c_custkey % 3 AS useful_vote_cnt, c_custkey % 5 AS funny_vote_cnt, c_custkey % 7 AS cool_vote_cnt,
    c_acctbal AS user_average_stars,
    CAST(CASE c_custkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS INT) AS user_elite_year_cnt,
    c_custkey % 3 = 1 AS is_user_elite, c_custkey % 13 AS user_fans,
    CASE WHEN c_custkey % 11 <> 0 THEN CAST(2000 + c_custkey % 20 AS INT) END AS year,
    CASE WHEN c_custkey % 11 <> 0 THEN CAST(3 AS INT) END AS month FROM customer"""
)
def review_users(t: Tables) -> DataFrame:
    return plan.user_dimension(_users(t), SINCE, AS_OF_YEAR)


def _sources(t: Tables) -> AbstractContextManager[str]:
    """Businesses, reviews and users as compressed JSON files."""

    def write(path: str) -> None:
        write_json(_business(t), f"{path}/business.json", compression="gzip")
        write_json(_reviews(t), f"{path}/review.json", compression="gzip")
        write_json(_users(t), f"{path}/user.json", compression="gzip")

    return t.source_files("review-sources", write)


@query(
    f"""WITH {CLEAN_SQL}, {DIMENSIONS_SQL} SELECT business_id, is_open, review_count,
    CAST(business_stars AS DOUBLE) AS business_stars, alcohol, take_credit_cards, good_for_kids,
    happy_hour, restaurants_takeout, smoking, wifi, category_id, ambience_id, state_id,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
      || CAST(l_suppkey AS VARCHAR) AS review_id,
    'U' || CAST(l_suppkey AS VARCHAR) AS user_id, l_quantity AS review_stars,
    l_orderkey AS review_cool, l_suppkey AS review_funny, CAST(l_linenumber AS BIGINT) AS review_useful,
    CASE WHEN l_linenumber <> 7 THEN CAST(extract(year FROM l_shipdate) AS INT) END AS year,
    CASE WHEN l_linenumber <> 7 THEN CAST(extract(month FROM l_shipdate) AS INT) END AS month
    FROM lineitem JOIN clean ON business_id = 'B' || CAST(l_partkey AS VARCHAR)
    LEFT JOIN category ON clean.restaurant_category = category.restaurant_category
    LEFT JOIN ambience ON clean.ambience = ambience.ambience
    JOIN state ON clean.state = state.state"""
)
def review_warehouse(t: Tables) -> DataFrame:
    """The whole build from JSON documents; the fact read back from its files."""
    output = scratch_dir(t.spark, "review-warehouse")
    with _sources(t) as source:
        tables = plan.build(t.spark, source, output, since=SINCE, as_of_year=AS_OF_YEAR)
    return tables["business_reviews"]


# --- the loaded tables ----------------------------------------------------------------


def _loaded(t: Tables) -> dict[str, DataFrame]:
    """Every output built by a run of its own, dimensions first, and loaded into typed tables."""
    output = scratch_dir(t.spark, "review-tasks")
    with _sources(t) as source:
        for name in ("state", "category", "ambience", "user", "business_reviews"):
            plan.refresh(t.spark, source, output, name, since=SINCE, as_of_year=AS_OF_YEAR)
    location = scratch_dir(t.spark, "db")
    database = create_database(t.spark, "starwright_" + location[-12:], location)
    return plan.load(t.spark, database, output, since=SINCE)


def _plain(df: DataFrame) -> DataFrame:
    """Whole-number decimals and 32-bit ids as long integers, for comparison."""
    names = [
        name for name, kind in df.dtypes
        if kind == "decimal(18,0)" or name in ("state_id", "category_id", "ambience_id")
    ]
    return df.withColumns({name: F.col(name).cast("long") for name in names})


@query(REGISTRY["review_warehouse"].sql)
def review_loaded_facts(t: Tables) -> DataFrame:
    return _plain(_loaded(t)["business_reviews"])


@query(f"SELECT * EXCLUDE (year, month) FROM ({REGISTRY['review_users'].sql}) u")
def review_loaded_users(t: Tables) -> DataFrame:
    return _plain(_loaded(t)["users"])


@query(REGISTRY["review_states"].sql)
def review_loaded_states(t: Tables) -> DataFrame:
    return _plain(_loaded(t)["state"])


@query(REGISTRY["review_categories"].sql)
def review_loaded_categories(t: Tables) -> DataFrame:
    return _plain(_loaded(t)["category"])


@query(REGISTRY["review_ambiences"].sql)
def review_loaded_ambiences(t: Tables) -> DataFrame:
    return _plain(_loaded(t)["ambience"])


# --- a dimension that grows under a fact ------------------------------------------------


@query(
    f"""WITH {CLEAN_SQL} SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
      || '-' || CAST(l_suppkey AS VARCHAR) AS review_id, clean.state AS state
    FROM lineitem JOIN clean ON business_id = 'B' || CAST(l_partkey AS VARCHAR)
    WHERE clean.state > (SELECT min(state) FROM clean)"""
)
def review_fact_after_new_state(t: Tables) -> DataFrame:
    """The first state comes when the fact is written already, and shifts no id in it."""

    def write(path: str) -> None:
        business = _business(t)
        first = business.agg(F.min("state")).first()[0]
        write_json(
            business.filter(F.col("state") > first), f"{path}/business.json", compression="gzip"
        )
        write_json(_reviews(t), f"{path}/review.json", compression="gzip")

    output = scratch_dir(t.spark, "review-growth")
    with t.source_files("review-sources-before", write) as before:
        for name in ("state", "category", "ambience", "business_reviews"):
            plan.refresh(t.spark, before, output, name, since=SINCE, as_of_year=AS_OF_YEAR)
    with _sources(t) as source:
        plan.refresh(t.spark, source, output, "state", since=SINCE, as_of_year=AS_OF_YEAR)
    stored = review_star(SINCE)
    fact, states = (
        read_json(t.spark, f"{output}/{name}.json", stored[name])
        for name in ("business_reviews", "state")
    )
    return fact.join(states, "state_id").select("review_id", "state")
