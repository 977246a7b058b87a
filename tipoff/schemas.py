"""Explicit schemas of every layer. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, BOOL = T.StringType(), T.IntegerType(), T.BooleanType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def strings(*names: str) -> dict[str, T.DataType]:
    return {name: STRING for name in names}


_RECORD = strings("source_url", "parameters", "content_hash", "raw_data") | {"created_at": TIMESTAMP}
BRONZE_SCOREBOARD = struct(date=STRING, **_RECORD, year=STRING, month=STRING)
BRONZE_TEAMS = struct(**_RECORD, bucket=STRING)

# The superset of the payload shapes; absent fields parse to null.
_TEAM = struct(
    **strings("id", "location", "name", "abbreviation", "displayName", "color", "alternateColor", "score")
)
_COMPETITOR = struct(
    **strings("id", "type", "homeAway"),
    winner=BOOL,
    score=STRING,
    team=_TEAM,
    statistics=T.ArrayType(struct(**strings("name", "displayValue"))),
)
_VENUE = struct(
    **strings("id", "fullName"), capacity=INT, address=struct(**strings("city", "state", "country"))
)
_STATUS = struct(
    type=struct(**strings("id", "name", "state"), completed=BOOL, **strings("description", "detail"))
)
_COMPETITION = struct(
    **strings("id", "date"),
    attendance=INT,
    neutralSite=BOOL,
    conferenceCompetition=BOOL,
    type=struct(**strings("id", "abbreviation")),
    venue=_VENUE,
    competitors=T.ArrayType(_COMPETITOR),
    status=_STATUS,
)
_EVENT = struct(
    **strings("id", "uid", "date", "name", "shortName"),
    season=struct(year=INT, type=INT, slug=STRING),
    competitions=T.ArrayType(_COMPETITION),
)
_ITEM = struct(
    **strings("id", "uid", "guid", "slug", "location", "name", "nickname", "abbreviation"),
    **strings("displayName", "shortDisplayName", "color", "alternateColor"),
    active=BOOL,
    allstar=BOOL,
)

CORRUPT = "_corrupt"
SCOREBOARD_PAYLOAD = struct(events=T.ArrayType(_EVENT), **{CORRUPT: STRING})
TEAM_PAGE_PAYLOAD = struct(
    count=INT, pageIndex=INT, pageSize=INT, pageCount=INT, items=T.ArrayType(_ITEM), **{CORRUPT: STRING}
)

SILVER_GAMES = struct(
    **strings("game_id", "season_id"),
    season_type=INT,
    date=TIMESTAMP,
    **strings("home_team_id", "away_team_id", "venue_id"),
    home_score=INT,
    away_score=INT,
    status=STRING,
    neutral_site=BOOL,
    conference_game=BOOL,
)
SILVER_TEAMS = struct(
    **strings("team_id", "name", "abbreviation", "location", "conference_id", "logo_url", "color", "alternate_color")
)
SILVER_CONFERENCES = struct(**strings("conference_id", "name", "short_name", "logo_url"))
SILVER_SEASONS = struct(season_id=STRING, name=STRING, start_date=DATE, end_date=DATE, year=INT)
SILVER_VENUES = struct(
    venue_id=STRING, name=STRING, capacity=INT, **strings("city", "state", "country")
)

# Request group ids and the conference or division each one selects.
CONFERENCE_GROUPS = [
    ("50", "Division I", None),
    ("2", "Atlantic Coast Conference", "ACC"),
    ("21", "Pacific-12 Conference", "Pac-12"),
    ("9", "Big West Conference", None),
    ("11", "Conference USA", None),
    ("13", "Metro Atlantic Athletic Conference", "MAAC"),
    ("30", "Western Athletic Conference", "WAC"),
    ("5", "Big East Conference", None),
    ("8", "Big Ten Conference", None),
    ("23", "Southeastern Conference", "SEC"),
    ("62", "Division II", None),
    ("63", "Division III", None),
]

# Team statistics of the silver layer, whole numbers first, then percentages.
COUNT_STATISTICS = [
    "points",
    "field_goals_made",
    "field_goals_attempted",
    "three_point_made",
    "three_point_attempted",
    "free_throws_made",
    "free_throws_attempted",
    "rebounds",
    "offensive_rebounds",
    "defensive_rebounds",
    "assists",
    "steals",
    "blocks",
    "turnovers",
    "fouls",
]
PERCENT_STATISTICS = {
    "field_goal_pct": ("field_goals_made", "field_goals_attempted"),
    "three_point_pct": ("three_point_made", "three_point_attempted"),
    "free_throw_pct": ("free_throws_made", "free_throws_attempted"),
}

# The payload statistic names known so far and their silver columns.
STATISTIC_COLUMNS = {
    "rebounds": "rebounds",
    "assists": "assists",
    "fieldGoalPct": "field_goal_pct",
}
