"""What the music star builds share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The page that marks a play, and the keys that tie it to a song.
PLAY_PAGE = "NextSong"
SONG_MATCH = {"artist": "artist_name", "song": "title", "length": "duration"}


def only_plays(log: DataFrame) -> DataFrame:
    return log.filter(F.col("page") == PLAY_PAGE)
