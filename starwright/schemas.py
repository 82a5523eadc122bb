"""Schemas of the sources and of the tables built from them."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "text": T.StringType(),
    "bool": T.BooleanType(),
    "time": T.TimestampType(),
    "number": T.DecimalType(18, 0),
    # The widths of the warehouse's text columns, which a write checks.
    "varchar": T.VarcharType(256),
    "letter": T.CharType(1),
    "digest": T.VarcharType(32),
}


def schema(**columns: str | T.DataType) -> T.StructType:
    """Struct type from ``name="type"`` pairs, in order."""
    return T.StructType(
        [T.StructField(name, _TYPES.get(kind, kind)) for name, kind in columns.items()]
    )


# Field names and order of the source files.

SONG = schema(
    num_songs="long", artist_id="text", artist_latitude="double", artist_longitude="double",
    artist_location="text", artist_name="text", song_id="text", title="text",
    duration="double", year="long",
)

ACTIVITY_LOG = schema(
    artist="text", auth="text", firstName="text", gender="text", itemInSession="long",
    lastName="text", length="double", level="text", location="text", method="text",
    page="text", registration="double", sessionId="long", song="text", status="long",
    ts="long", userAgent="text", userId="text",
)

ACTIVITY_CSV = schema(
    artist="text", auth="text", firstName="text", gender="text", itemInSession="text",
    lastName="text", length="text", level="text", location="text", method="text",
    page="text", registration="text", sessionId="text", song="text", status="text",
    ts="text", userId="text",
)

ACTIVITY_CSV_KEPT = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level",
    "location", "sessionId", "song", "userId",
]

BUSINESS_ATTRIBUTES = schema(
    Alcohol="text", Ambience="text", BusinessAcceptsCreditCards="text", GoodForKids="text",
    HappyHour="text", RestaurantsTakeOut="text", Smoking="text", WiFi="text",
)

BUSINESS = schema(
    business_id="text", name="text", address="text", city="text", state="text",
    postal_code="text", latitude="double", longitude="double", stars="double",
    review_count="long", is_open="long", categories="text", attributes=BUSINESS_ATTRIBUTES,
)

REVIEW = schema(
    review_id="text", user_id="text", business_id="text", stars="double", date="text",
    text="text", useful="long", funny="long", cool="long",
)


def user_schema(since: str) -> T.StructType:
    """Users; ``since`` names the field with the date a user joined."""
    return schema(
        user_id="text", name="text", review_count="long", **{since: "text"}, friends="text",
        useful="long", funny="long", cool="long", fans="long", elite="text",
        average_stars="double",
    )


# Columns and order of the warehouse tables. Whole-number decimals
# drop the fraction of what is loaded into them.

WAREHOUSE_EVENTS = schema(
    artist="varchar", auth="varchar", first_name="varchar", gender="letter", item_session="number",
    last_name="varchar", length="number", level="varchar", location="varchar", method="varchar",
    page="varchar", registration="number", session_id="number", song="varchar", status="number",
    ts="time", user_agent="varchar", user_id="number",
)

WAREHOUSE_SONGS = schema(
    num_songs="number", artist_id="varchar", artist_latitude="number", artist_longitude="number",
    artist_location="varchar", artist_name="varchar", song_id="varchar", title="varchar",
    duration="number", year="number",
)

WAREHOUSE_STAR = {
    "songplays": schema(
        songplay_id="long", start_time="time", user_id="number", level="varchar", song_id="varchar",
        artist_id="varchar", session_id="varchar", location="varchar", user_agent="varchar",
    ),
    "users": schema(
        user_id="number", first_name="varchar", last_name="varchar", gender="varchar", level="varchar"
    ),
    "songs": schema(
        song_id="varchar", title="varchar", artist_id="varchar", year="number", duration="number"
    ),
    "artists": schema(
        artist_id="varchar", name="varchar", location="varchar", latitude="number", longitude="number"
    ),
    "time": schema(
        start_time="time", hour="number", day="number", week="number", month="number",
        year="number", weekday="varchar",
    ),
}

UPSERT_STAR = {
    "songplays": schema(
        songplay_id="long", start_time="time", user_id="int", level="text", song_id="text",
        artist_id="text", session_id="int", location="text", user_agent="text",
    ),
    "users": schema(
        user_id="int", first_name="text", last_name="text", gender="text", level="text"
    ),
    "songs": schema(song_id="text", title="text", artist_id="text", year="int", duration="double"),
    "artists": schema(
        artist_id="text", name="text", location="text", latitude="double", longitude="double"
    ),
    "time": schema(
        start_time="time", hour="int", day="int", week="int", month="int", year="int",
        weekday="text",
    ),
}

INCREMENTAL_EVENTS = schema(
    artist="varchar", auth="varchar", firstname="varchar", gender="varchar", iteminsession="int",
    lastname="varchar", length="number", level="varchar", location="varchar", method="varchar",
    page="varchar", registration="number", sessionid="int", song="varchar", status="int",
    ts="long", useragent="varchar", userid="int",
)

INCREMENTAL_SONGS = schema(
    num_songs="int", artist_id="varchar", artist_name="varchar", artist_latitude="number",
    artist_longitude="number", artist_location="varchar", song_id="varchar", title="varchar",
    duration="number", year="int",
)

INCREMENTAL_STAR = {
    "songplays": schema(
        playid="digest", start_time="time", userid="int", level="varchar", songid="varchar",
        artistid="varchar", sessionid="int", location="varchar", user_agent="varchar",
    ),
    "users": schema(
        userid="int", first_name="varchar", last_name="varchar", gender="varchar", level="varchar"
    ),
    "songs": schema(songid="varchar", title="varchar", artistid="varchar", year="int", duration="number"),
    "artists": schema(
        artistid="varchar", name="varchar", location="varchar", latitude="number", longitude="number"
    ),
    "time": schema(
        start_time="time", hour="int", day="int", week="int", month="varchar", year="int",
        weekday="varchar",
    ),
}



def review_star(since: str) -> dict[str, T.StructType]:
    """The loaded review tables; ``since`` names the users' column with the date they joined."""
    return {
        "state": schema(state="text", state_id="int"),
        "category": schema(restaurant_category="text", category_id="int"),
        "ambience": schema(ambience="text", ambience_id="int"),
        "users": schema(
            user_id="text", name="text", user_review_count="number", **{since: "text"},
            user_friend_count="int", useful_vote_cnt="number", funny_vote_cnt="number",
            cool_vote_cnt="number", user_average_stars="double", user_elite_year_cnt="int",
            is_user_elite="bool", user_fans="number",
        ),
        "business_reviews": schema(
            business_id="text", is_open="number", review_count="number", business_stars="double",
            alcohol="text", take_credit_cards="bool", good_for_kids="bool", happy_hour="bool",
            restaurants_takeout="bool", smoking="text", wifi="text", category_id="int",
            ambience_id="int", state_id="int", review_cool="number", review_funny="number",
            review_id="text", review_stars="double", review_useful="number", user_id="text",
            year="int", month="int",
        ),
    }


VARCHAR_WIDTH = 256
