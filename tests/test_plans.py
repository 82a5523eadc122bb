"""Whole builds on small files with hand-written expectations."""

import csv
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starwright.operators.intervals import interval_slice_ms
from starwright.plans import incremental, lake, lookups, reviews, upserts, warehouse
from starwright.schemas import (
    ACTIVITY_CSV,
    ACTIVITY_LOG,
    BUSINESS,
    INCREMENTAL_EVENTS,
    INCREMENTAL_SONGS,
    review_star,
)
from starwright.storage import scratch_dir

# 2018-11-20 10:00:00.250 UTC, a Tuesday.
T0 = 1542708000250
STAMP = datetime(2018, 11, 20, 10, 0, 0, 250000)

SONGS = [
    ("S1", "Tune", "A1", 2000, 200.25, "Ann", "Here", 10.5, -20.5),
    ("S2", "Tune", "A1", 2001, 200.25, "Ann", "There", None, None),
    ("S3", "Air", "A2", 0, 100.75, "Bob", "", None, None),
    ("S4", "Air", "A3", 0, 100.25, "Bob", "", None, None),
]
# user, level, page, artist, song, length, ts, session, item
LOG = [
    ("1", "free", "NextSong", "Ann", "Tune", 200.25, T0, 7, 0),
    ("1", "paid", "NextSong", "Bob", "Air", 100.75, T0 + 1000, 7, 1),
    ("2", "free", "NextSong", "Cy", "Other", 50.0, T0 + 2000, 8, 0),
    ("2", "paid", "Home", None, None, None, T0 + 9000, 8, 1),
    ("", "free", "Home", None, None, None, T0 + 9500, 9, 0),
]


def dump(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(row) + "\n" for row in rows))


@pytest.fixture
def music(tmp_path):
    names = [
        "song_id", "title", "artist_id", "year", "duration", "artist_name", "artist_location",
        "artist_latitude", "artist_longitude",
    ]
    for i, song in enumerate(SONGS):
        dump(tmp_path / "songs" / f"d{i}" / f"{i}.json", [{"num_songs": 1, **dict(zip(names, song))}])
    log = [
        {
            **dict.fromkeys(ACTIVITY_LOG.names),
            "userId": user, "level": level, "page": page, "artist": artist, "song": song,
            "length": length, "ts": ts, "sessionId": session, "itemInSession": item,
            "firstName": f"F{user}", "lastName": "L", "gender": "X", "location": "loc",
            "userAgent": "ua", "status": 200, "registration": 1.5e12,
        }
        for user, level, page, artist, song, length, ts, session, item in LOG
    ]
    dump(tmp_path / "log" / "2018" / "11" / "a.json", log[:2])
    dump(tmp_path / "log" / "2018" / "11" / "b.json", log[2:])
    return f"{tmp_path}/songs", f"{tmp_path}/log"


def rows(df, *columns):
    plain = [F.col(n).cast("timestamp_ntz") if t == "timestamp" else F.col(n) for n, t in df.dtypes]
    chosen = df.select(*[c.alias(n) for c, n in zip(plain, df.columns)])
    return sorted(map(tuple, chosen.select(*columns).collect() if columns else chosen.collect()), key=str)


def test_lake(spark, music, tmp_path):
    for _ in range(2):
        tables = lake.build(spark, *music, f"{tmp_path}/lake")
    assert {name: table.count() for name, table in tables.items()} == {
        "songs": 4, "artists": 4, "users": 2, "time": 3, "songplays": 3,
    }
    assert rows(tables["users"], "userId", "level") == [("1", "paid"), ("2", "free")]
    assert rows(tables["songplays"], "userId", "song_id", "year", "month") == [
        ("1", "S1", 2018, 11), ("1", "S2", 2018, 11), ("1", "S3", 2018, 11),
    ]
    first = rows(tables["time"], "start_time", "hour", "day", "week", "month", "year", "weekday")[0]
    assert first == (STAMP, 10, 20, 47, 11, 2018, 3)


def test_warehouse(spark, music, database):
    tables = warehouse.build(spark, database, *music)
    # Lengths compare as whole seconds, so a play of Air matches both recordings.
    plays = rows(tables["songplays"], "user_id", "song_id")
    assert plays == [(1, "S1"), (1, "S2"), (1, "S3"), (1, "S4")]
    assert sorted(r.songplay_id for r in tables["songplays"].collect()) == [1, 2, 3, 4]
    # All pages count for users; a blank id is no user.
    assert rows(tables["users"], "user_id", "level") == [(1, "paid"), (2, "paid")]
    assert rows(tables["artists"], "artist_id", "location", "latitude")[0] == ("A1", "Here", 10)
    assert rows(tables["time"], "weekday") == [("2",)] * 4


def test_upserts(spark, music, database):
    upserts.build(spark, database, *music)
    tables = upserts.build(spark, database, *music)
    assert {name: table.count() for name, table in tables.items()} == {
        "songplays": 6, "users": 2, "songs": 4, "artists": 3, "time": 3,
    }
    assert rows(tables["users"], "user_id", "first_name", "level") == [(1, "F1", "paid"), (2, "F2", "free")]
    # The first artist row stays; a play matches at most one song, or none.
    assert rows(tables["artists"], "artist_id", "location")[0] == ("A1", "Here")
    assert rows(tables["songplays"].distinct(), "user_id", "song_id", "artist_id") == [
        (1, "S1", "A1"), (1, "S1", "A1"), (1, "S3", "A2"), (1, "S3", "A2"),
        (2, None, None), (2, None, None),
    ]
    assert rows(tables["time"], "weekday") == [("Tuesday",)] * 3


@pytest.mark.parametrize("repeatable", [False, True])
def test_incremental(spark, music, database, repeatable):
    for _ in range(2):
        tables = incremental.run(spark, database, *music, date(2018, 12, 1), repeatable=repeatable)
    runs = 1 if repeatable else 2
    plays = rows(tables["songplays"], "userid", "songid")
    expected = [(1, "S1"), (1, "S2"), (1, "S3"), (1, "S4"), (2, None)] * runs
    assert plays == sorted(expected, key=str)
    assert len(rows(tables["songplays"].select("playid").distinct())) == 3
    assert rows(tables["users"], "userid", "level") == [(1, "free"), (1, "paid"), (2, "free")]
    assert rows(tables["time"], "start_time", "month", "weekday")[0] == (
        STAMP.replace(microsecond=0), "11", "2",
    )


def test_interval_and_page_reach_the_staging_scan(spark, conf, tmp_path):
    conf(maxMetadataStringLength="5000", debug__maxToStringFields="100")
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in INCREMENTAL_EVENTS)
    spark.sql(f"SELECT {columns}").write.parquet(f"{tmp_path}/events")
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in INCREMENTAL_SONGS)
    spark.sql(f"SELECT {columns}").write.parquet(f"{tmp_path}/songs")
    events, songs = spark.read.parquet(f"{tmp_path}/events"), spark.read.parquet(f"{tmp_path}/songs")
    recent = interval_slice_ms(events, "ts", date(2018, 11, 15), date(2018, 12, 1))
    plan = incremental.songplays(recent, songs)._jdf.queryExecution().executedPlan().toString()
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line and "/events" in line]
    for pushed in ("GreaterThanOrEqual(ts,", "LessThan(ts,", "EqualTo(page,NextSong)"):
        assert pushed in scan
    read = scan[scan.index("ReadSchema"):]
    assert "registration" not in read and "firstname" not in read


def test_incremental_run_without_plays_fails_its_check(spark, music, database):
    with pytest.raises(ValueError, match="0 rows"):
        incremental.run(spark, database, *music, date(2018, 11, 15))


def test_lookup_tables(spark, tmp_path):
    source = tmp_path / "csv"
    source.mkdir()
    kept = ["artist", "firstName", "itemInSession", "lastName", "length", "sessionId", "song", "userId"]
    data = {
        "a.csv": [("Faith", "Syl", 4, "Cruz", 495.3073, 338, "Music", 10), ("", "No", 5, "One", "", 338, "", 10)],
        "b.csv": [
            ("Faith", "Syl", 0, "Cruz", 1.5, 182, "All, Hands", 10),
            ('The "X"', "Syl", 2, "Cruz", 2.5, 182, "Two", 10),
            ("Mid", "Syl", 1, "Cruz", 2.5, 182, "One", 10),
            ("Faith", "Sara", 3, "J", 1.5, 9, "All, Hands", 95),
            ("Faith", "Sarah", 4, "J", 1.5, 9, "All, Hands", 95),
        ],
    }
    for name, lines in data.items():
        with open(source / name, "w", newline="") as file:
            writer = csv.writer(file)
            writer.writerow(ACTIVITY_CSV.names)
            for line in lines:
                values = dict(zip(kept, line))
                writer.writerow([values.get(column, "") for column in ACTIVITY_CSV.names])
    tables = lookups.build(spark, str(source), f"{tmp_path}/out")
    assert {name: table.count() for name, table in tables.items()} == {
        "songs": 6, "user_activity": 6, "user_list": 5,
    }
    (song,) = lookups.song_at(tables["songs"], 338, 4).collect()
    assert (song.artist, round(song.length, 4), song.song) == ("Faith", 495.3073, "Music")
    heard = lookups.session_of_user(tables["user_activity"], 10, 182).collect()
    assert [(row.artist, row.song) for row in heard] == [
        ("Faith", "All, Hands"), ("Mid", "One"), ('The "X"', "Two"),
    ]
    # One row per song and user, the last one loaded.
    assert rows(lookups.listeners(tables["user_list"], "All, Hands")) == [("Sarah", "J"), ("Syl", "Cruz")]
    written = spark.read.csv(f"{tmp_path}/out/events_csv", header=True, escape='"')
    assert written.count() == 6 and len(written.columns) == 11


def test_review_warehouse(spark, tmp_path):
    def business(identifier, state, categories, **attributes):
        return {
            "business_id": identifier, "state": state, "categories": categories, "stars": 4.5,
            "review_count": 3, "is_open": 1, "attributes": attributes or None, "hours": {"Monday": "9-5"},
        }

    dump(
        tmp_path / "business.json",
        [
            business("b1", "NV", "Mexican, American", Alcohol="u'none'", Ambience="None", WiFi="u'free'"),
            business("b2", "AZ", None, Alcohol="'full_bar'", Smoking="u'no'", GoodForKids="True",
                     Ambience="{'romantic': False, 'classy': False, 'trendy': True, u'upscale': True}"),
            business("b3", None, "Indian", Ambience="{'romantic': True}"),
            business("b4", "NV", "Plumbers", Ambience="{'oops"),
            business("b5", "AZ", "Indian"),
        ],
    )
    dump(
        tmp_path / "review.json",
        [
            {"review_id": f"r{i}", "user_id": "u1", "business_id": b, "stars": 5, "date": d,
             "text": "...", "useful": 1, "funny": 2, "cool": 3}
            for i, (b, d) in enumerate(
                [("b1", "2018-03-04"), ("b2", "2017-12-31"), ("b2", "soon"), ("b3", "2018-01-01"), ("zz", "2018-01-01")]
            )
        ],
    )
    dump(
        tmp_path / "user.json",
        [
            {"user_id": f"u{i}", "name": "n", "review_count": 1, "since": "2012-05-06", "friends": friends,
             "elite": elite, "useful": 1, "funny": 1, "cool": 1, "fans": 1, "average_stars": 3.5}
            for i, (friends, elite) in enumerate(
                [("u1, u2", ""), ("None", "None"), (None, "2017"), ("u9", "2016,2017"), ("u9", "2017,2018")]
            )
        ],
    )
    for _ in range(2):
        tables = reviews.build(spark, str(tmp_path), f"{tmp_path}/out", since="since", as_of_year=2018)
    assert rows(tables["state"], "state_id", "state") == [(1, "AZ"), (2, "NV")]
    assert rows(tables["category"], "category_id", "restaurant_category") == [(1, "American"), (2, "Indian")]
    assert rows(tables["ambience"], "ambience_id", "ambience") == [(1, "romantic"), (2, "trendy")]
    fact = tables["business_reviews"]
    assert rows(fact, "review_id", "state_id", "category_id", "ambience_id", "year", "month") == [
        ("r0", 2, 1, None, 2018, 3), ("r1", 1, None, 2, 2017, 12), ("r2", 1, None, 2, None, None),
    ]
    assert rows(fact, "review_id", "alcohol", "wifi", "smoking", "good_for_kids", "happy_hour") == [
        ("r0", None, "free", None, None, None),
        ("r1", "full_bar", None, "no", True, None),
        ("r2", "full_bar", None, "no", True, None),
    ]
    assert rows(
        tables["user"], "user_id", "user_friend_count", "user_elite_year_cnt", "is_user_elite", "year", "month"
    ) == [
        ("u0", 2, 0, False, 2012, 5), ("u1", 1, 1, False, 2012, 5), ("u2", None, 1, True, 2012, 5),
        ("u3", 1, 2, True, 2012, 5), ("u4", 1, 2, False, 2012, 5),
    ]


def test_command_line(spark, music, tmp_path):
    from starwright.__main__ import main

    songs, log = music
    main(["lake", "--songs", songs, "--log", log, "--output", f"{tmp_path}/cli"])
    assert spark.read.parquet(f"{tmp_path}/cli/songplays").count() == 3
    name = f"cli_{tmp_path.name.replace('-', '_')}"
    main(
        ["--input-bytes", "1000", "incremental", "--songs", songs, "--log", log, "--database", name,
         "--location", f"{tmp_path}/db", "--execution-date", "2018-12-01", "--repeatable"]
    )
    assert spark.table(f"{name}.songplays").count() == 5


def test_an_empty_review_fact_fails_the_load(spark, database):
    output = scratch_dir(spark, "review-outputs")
    for name, columns in review_star("since").items():
        empty = spark.createDataFrame([], columns)
        empty.write.json(f"{output}/{reviews.FILES[name]}.json")
    with pytest.raises(ValueError, match="0 rows"):
        reviews.load(spark, database, output, since="since")


def test_refreshing_an_unknown_review_output_fails(spark):
    source = scratch_dir(spark, "review-documents")
    spark.createDataFrame([], BUSINESS).write.json(f"{source}/business.json")
    with pytest.raises(ValueError, match="no output 'reviews'"):
        reviews.refresh(spark, source, source, "reviews", since="since", as_of_year=2024)


def test_a_repeatable_run_writes_its_facts_once(spark, database, music, monkeypatch):
    """times are taken from the interval's facts as they were loaded, not from a second copy of them."""
    monkeypatch.setattr(incremental, "written", lambda df, label: pytest.fail(f"{label} is written twice"))
    for _ in range(2):
        tables = incremental.run(spark, database, *music, date(2018, 12, 1), repeatable=True, buckets=4)
    stamps = lambda name: sorted(r[0] for r in tables[name].select("start_time").collect())
    assert stamps("time") == stamps("songplays") and stamps("time")
