"""Schemas of the input files and of the keyed tables.

Fixed values: field names and types are those of the stored data and cannot be chosen here.
"""

from __future__ import annotations

CORRUPT = "_corrupt_record"

RATINGS = "user_id int, movie_id int, rating int, rated_at long"
USERS = "user_id int, gender string, age int, occupation int, zip string"
MOVIES = "movie_id int, title string, genres string"

PERSON = "username string, password string, mail string"

COMMITS = "author string, author_email string, commit string, date string"

DEVICE_STRUCT = (
    "struct<ai:string,am:bigint,appkey:string,c:string,cc:bigint,ch:string,dateTime:string,"
    "fr:bigint,h:bigint,im:string,ir:boolean,la:string,mac:string,om:bigint,pn:string,"
    "sv:bigint,t:string,w:bigint>"
)
SESSION_ARRAY = "array<struct<e:bigint,s:bigint>>"
LOG_RECORD = f"us {DEVICE_STRUCT}, se {SESSION_ARRAY}, {CORRUPT} string"

DEVICES = "device_id string, imei string, mac string, android_id string, uuid string, first_time string"
APP_DEVICES = (
    "id string, first_time string, app_key string, channel string, country string, "
    "pkg_name string, device_id string, language string, model string"
)
CHANNEL_STATISTICS = (
    "`@timestamp` string, actives bigint, startAvg float, agent string, app_id string, "
    "app_key string, channel string, channel_id string, country string, create_time string, "
    "day bigint, id string, keep1 bigint, keep1Ratio float, keep3 bigint, keep3Ratio float, "
    "keep7 bigint, keep7Ratio float, keep30 bigint, keep30Ratio float, news bigint, "
    "pkg_name string, source string, starts bigint, total bigint, type string"
)

# Relational tables of the statistics database.
TEST_USER = (
    "id bigint, uuid string, im string, mac string, ai string, t string, c string, la string, "
    "create_time string"
)
TEST_COUNTRY = (
    "id bigint, uuid string, country_code string, country_name string, region_code string, "
    "language_code string"
)
TEST_USER_HISTORY = (
    "id bigint, user_id bigint, app_id bigint, pkg_name string, channel_name string, "
    "create_time string"
)
APP = (
    "id int, name string, pkg_name string, version_code string, version_name string, "
    "description string, created_user bigint, created_time timestamp"
)
APP_DEVICE = (
    "id bigint, app_id int, device_id string, imei string, cu_ref string, model string, "
    "language string, country string, channel_id int, first_time timestamp"
)
CHANNEL = (
    "id int, app_id int, name string, type string, agent string, source string, `group` string, "
    "tracker string, tracker_link string, description string, created_user bigint, "
    "created_time timestamp"
)
CHANNEL_STATISTICS_DAY = (
    "id bigint, app_id int, app_id_local int, channel_id int, news int, actives int, starts int, "
    "total int, keep_1 int, keep_3 int, keep_7 int, keep_30 int, agent string, source string, "
    "`group` string, country string, news_by_hour string, actives_by_hour string, "
    "starts_by_hour string, day timestamp"
)
SOURCE = "id int, name string, description string, created_user bigint, created_time timestamp"

# Per-game season tables.
SEASON_STATS = (
    "Rk int, Player string, Pos string, Age int, Tm string, G int, GS int, MP double, FG double, "
    "FGA double, `FG%` double, `3P` double, `3PA` double, `3P%` double, `2P` double, "
    "`2PA` double, `2P%` double, `eFG%` double, FT double, FTA double, `FT%` double, ORB double, "
    "DRB double, TRB double, AST double, STL double, BLK double, TOV double, PF double, PTS double"
)
