"""DuckDB statements that answer the registered queries independently of the Spark code.

``TABLES`` holds named subqueries that build on one another, from the given tables up to the star;
``statement`` puts together those that a query needs. Averages and ratios are rounded as decimals,
dates and times are shown as text.
"""

from __future__ import annotations

import re


def rounded(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(30,10)), {digits}) AS DOUBLE)"


def padded(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN '  ' || {value} || ' ' ELSE {value} END"


def quoted(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN 'null' ELSE '\"' || {column} || '\"' END"


def hashed(columns: list[str]) -> str:
    members = " || ', ' || ".join(f"'\"{c}\": ' || {quoted(c)}" for c in sorted(columns))
    return f"md5('{{' || {members} || '}}')"


def whole(column: str) -> str:
    return f"TRY_CAST(trim({column}) AS BIGINT)"


def cased(column: str) -> str:
    return f"upper(trim({column})[1:1]) || lower(trim({column})[2:])"


def truth(column: str) -> str:
    return f"CASE WHEN lower(trim({column})) IN ('true', '1') THEN 1 ELSE 0 END"


RAW_COLUMNS = {
    "listeners": "listener_id email username first_name last_name birth_date city country subscription_type created_at",
    "artists": "artist_id name genre country formed_year monthly_listeners",
    "tracks": "track_id title artist_id album duration_ms genre release_date explicit",
    "streams": "stream_id listener_id track_id streamed_at duration_played_ms device_type shuffle_mode offline_mode",
}
RAW_COLUMNS = {name: columns.split() for name, columns in RAW_COLUMNS.items()}

TABLES: dict[str, str] = {}

# --- raw records --------------------------------------------------------------------------------------

TABLES["raw_listeners"] = f"""
    SELECT 'usr_' || c_custkey AS listener_id,
           'User' || c_custkey || '@Example.com' AS email,
           {padded("c_custkey % 50 = 0", "'user' || c_custkey")} AS username,
           {padded("c_custkey % 50 = 0", "split_part(c_name, '#', 1)")} AS first_name,
           split_part(c_name, '#', 2) AS last_name,
           CASE WHEN c_custkey % 40 = 7 THEN 'None' WHEN c_custkey % 97 = 5 THEN 'unknown'
                ELSE CAST(DATE '1955-01-01' + CAST(c_custkey * 13 % 20000 AS INTEGER) AS VARCHAR) END AS birth_date,
           CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '   ' WHEN c_custkey % 13 = 0 THEN 'None'
                ELSE ' City ' || n_name END AS city,
           n_name AS country,
           CASE WHEN c_custkey % 101 = 50 THEN 'trial' WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN ' Premium '
                ELSE 'free' END AS subscription_type,
           strftime(TIMESTAMP '2018-01-01' + to_days(CAST(c_custkey * 17 % 2000 AS INTEGER))
                    + to_seconds(c_custkey % 86400), '%Y-%m-%dT%H:%M:%S') AS created_at
    FROM customer JOIN nation ON n_nationkey = c_nationkey"""

TABLES["raw_artists"] = f"""
    SELECT 'art_' || lpad(CAST(number AS VARCHAR), CAST(greatest(3, length(CAST(number AS VARCHAR))) AS INTEGER), '0') AS artist_id,
           {padded("number % 10 = 0", "p_brand")} AS name,
           CASE number % 5 WHEN 0 THEN lower(kind) WHEN 1 THEN ' ' || kind ELSE kind END AS genre,
           'NATION_' || number AS country,
           CASE WHEN number % 7 = 0 THEN 'None' ELSE CAST(1950 + 2 * number AS VARCHAR) END AS formed_year,
           CAST(number ** 4 * 3 AS BIGINT)::VARCHAR AS monthly_listeners
    FROM (SELECT p_brand, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS number, arg_min(p_type, p_partkey) AS kind
          FROM part GROUP BY p_brand)"""

TABLES["raw_tracks"] = f"""
    SELECT 'trk_' || p_partkey AS track_id,
           {padded("p_partkey % 50 = 0", "p_name")} AS title,
           {padded("p_partkey % 30 = 3", "artist")} AS artist_id,
           CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 17 = 4 THEN 'None' WHEN p_partkey % 19 = 5 THEN ''
                ELSE p_name || ' LP' END AS album,
           CAST(p_size * 10000 AS VARCHAR) AS duration_ms,
           {padded("p_partkey % 50 = 2", "kind")} AS genre,
           CASE WHEN p_partkey % 333 = 40 THEN 'not-a-date'
                WHEN p_partkey % 50 = 1 THEN strftime(released, '%m/%d/%Y')
                ELSE strftime(released, '%Y-%m-%d') END AS release_date,
           CASE p_partkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN '1' ELSE 'False' END AS explicit
    FROM (SELECT *, DATE '1990-01-01' + CAST(p_partkey * 7 % 12000 AS INTEGER) AS released,
                 CASE WHEN p_partkey % 10 = 0 THEN lower(p_type) ELSE p_type END AS kind,
                 CASE WHEN p_partkey % 90 = 89 THEN 'art_999'
                      ELSE 'art_' || lpad(split_part(p_brand, '#', 2), CAST(greatest(3, length(split_part(p_brand, '#', 2))) AS INTEGER), '0') END AS artist
          FROM part)"""

TABLES["event_streams"] = f"""
    SELECT event_id,
           'str_' || event_id AS stream_id,
           CASE WHEN event_id % 250 = 17 THEN 'usr_unknown' WHEN event_id % 50 = 0 THEN '  usr_' || user_id || ' '
                ELSE 'usr_' || user_id END AS listener_id,
           'trk_' || (CAST(json_extract_string(props, '$.k') AS BIGINT)
                      + CASE WHEN event_id % 200 = 0 THEN 1000000 ELSE 0 END) AS track_id,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS streamed_at,
           CASE event_id % 700 WHEN 11 THEN '-5' WHEN 12 THEN '4000000'
                ELSE CAST(CAST(ROUND(value * 1000) AS BIGINT) AS VARCHAR) END AS duration_played_ms,
           CASE WHEN event_id % 500 = 123 THEN 'console' WHEN event_id % 50 = 3 THEN '  ' || device || ' '
                ELSE device END AS device_type,
           CASE WHEN event_id % 3 = 0 THEN 'True' ELSE 'False' END AS shuffle_mode,
           CASE WHEN event_id % 10 = 0 THEN '1' ELSE 'False' END AS offline_mode
    FROM (SELECT *, CASE event_type WHEN 'view' THEN 'mobile' WHEN 'click' THEN 'desktop' WHEN 'signup' THEN 'tablet'
                                    WHEN 'error' THEN 'smart_speaker' WHEN 'purchase' THEN 'web' END AS device
          FROM events)"""

TABLES["raw_streams"] = """
    SELECT * EXCLUDE (event_id) FROM event_streams
    UNION ALL SELECT * EXCLUDE (event_id) FROM event_streams WHERE event_id % 100 = 0
    UNION ALL SELECT * EXCLUDE (event_id) REPLACE ('1' AS duration_played_ms) FROM event_streams
              WHERE event_id % 997 = 5"""

FILE_OF = {"listeners": "listeners.json", "artists": "artists.json", "tracks": "tracks.json", "streams": "streams.csv"}
for _name, _columns in RAW_COLUMNS.items():
    TABLES[f"bronze_{_name}"] = f"""
    SELECT {', '.join(_columns)}, '{FILE_OF[_name]}' AS _source_file,
           '2024-02-01T00:00:00+00:00' AS _loaded_at, {hashed(_columns)} AS _row_hash
    FROM raw_{_name}"""

# --- silver -------------------------------------------------------------------------------------------

TABLES["clean_listeners"] = """
    SELECT DISTINCT trim(listener_id) AS listener_id, trim(lower(email)) AS email, trim(username) AS username,
           trim(first_name) AS first_name, trim(last_name) AS last_name, TRY_CAST(birth_date AS DATE) AS birth_date,
           nullif(nullif(trim(city), ''), 'None') AS city, trim(country) AS country,
           trim(lower(subscription_type)) AS subscription_type,
           date_trunc('second', TRY_CAST(created_at AS TIMESTAMP)) AS created_at
    FROM raw_listeners"""
TABLES["clean_artists"] = f"""
    SELECT DISTINCT trim(artist_id) AS artist_id, trim(name) AS name, {cased("genre")} AS genre,
           trim(country) AS country, TRY_CAST({whole("formed_year")} AS INTEGER) AS formed_year,
           {whole("monthly_listeners")} AS monthly_listeners
    FROM raw_artists"""
TABLES["clean_tracks"] = f"""
    SELECT DISTINCT trim(track_id) AS track_id, trim(title) AS title, trim(artist_id) AS artist_id,
           nullif(nullif(trim(album), ''), 'None') AS album, {whole("duration_ms")} AS duration_ms,
           {cased("genre")} AS genre,
           coalesce(TRY_CAST(release_date AS DATE), CAST(try_strptime(release_date, '%m/%d/%Y') AS DATE))
               AS release_date,
           {truth("explicit")} AS explicit
    FROM raw_tracks"""
TABLES["clean_streams"] = f"""
    SELECT trim(stream_id) AS stream_id, trim(listener_id) AS listener_id, trim(track_id) AS track_id,
           date_trunc('second', TRY_CAST(streamed_at AS TIMESTAMP)) AS streamed_at,
           {whole("duration_played_ms")} AS duration_played_ms, trim(device_type) AS device_type,
           {truth("shuffle_mode")} AS shuffle_mode, {truth("offline_mode")} AS offline_mode
    FROM (SELECT DISTINCT * FROM raw_streams)"""

TABLES["listeners"] = """
    SELECT * FROM clean_listeners WHERE subscription_type IN ('free', 'premium')
    QUALIFY count(*) OVER (PARTITION BY listener_id) = 1 AND count(*) OVER (PARTITION BY email) = 1"""
TABLES["artists"] = "SELECT * FROM clean_artists QUALIFY count(*) OVER (PARTITION BY artist_id) = 1"
TABLES["tracks"] = """
    SELECT t.* FROM clean_tracks t WHERE artist_id IN (SELECT artist_id FROM artists) AND release_date IS NOT NULL
    QUALIFY count(*) OVER (PARTITION BY track_id) = 1"""
TABLES["candidates"] = """
    SELECT * FROM clean_streams
    WHERE track_id IN (SELECT track_id FROM tracks) AND listener_id IN (SELECT listener_id FROM listeners)"""
TABLES["streams"] = "SELECT * FROM candidates QUALIFY count(*) OVER (PARTITION BY stream_id) = 1"

TABLES["rejected"] = """
    SELECT 'tracks' AS source_table, track_id AS source_id, 'Invalid artist_id: ' || artist_id AS rejection_reason
    FROM raw_tracks WHERE trim(artist_id) NOT IN (SELECT artist_id FROM artists)
    UNION ALL
    SELECT DISTINCT 'streams', stream_id, 'Invalid track_id: ' || track_id
    FROM raw_streams WHERE trim(track_id) NOT IN (SELECT track_id FROM tracks)
    UNION ALL
    SELECT DISTINCT 'streams', stream_id, 'Invalid listener_id: ' || listener_id
    FROM raw_streams WHERE trim(track_id) IN (SELECT track_id FROM tracks)
                       AND trim(listener_id) NOT IN (SELECT listener_id FROM listeners)
    UNION ALL
    SELECT 'listeners', listener_id, 'Unknown subscription_type'
    FROM clean_listeners WHERE subscription_type NOT IN ('free', 'premium')
    UNION ALL
    SELECT 'tracks', track_id, 'Missing or unreadable release_date'
    FROM clean_tracks WHERE release_date IS NULL AND artist_id IN (SELECT artist_id FROM artists)
    UNION ALL
    SELECT 'streams', stream_id, 'Duplicate stream_id: ' || stream_id
    FROM (SELECT stream_id FROM candidates QUALIFY count(*) OVER (PARTITION BY stream_id) > 1)"""

# --- star -----------------------------------------------------------------------------------------------


def numbered(natural_key: str) -> str:
    return f"row_number() OVER (ORDER BY md5({natural_key})[1:3], {natural_key})"


def calendar(first: str, last: str) -> str:
    return f"""
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
           CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
           monthname(d) AS month_name, CAST(strftime(d, '%W') AS INTEGER) + 1 AS week_of_year,
           CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
           CAST(dayofweek(d) IN (0, 6) AS INTEGER) AS is_weekend,
           CAST(strftime(d, '%m%d') IN ('0101', '0704', '1111', '1225') AS INTEGER) AS is_holiday
    FROM generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY) AS days(d)"""


TABLES["dim_date"] = calendar("2024-01-01", "2024-12-31")
TABLES["dim_device"] = """
    SELECT * FROM (VALUES (1, 'mobile', 'mobile'), (2, 'tablet', 'mobile'), (3, 'desktop', 'desktop'),
                          (4, 'web', 'desktop'), (5, 'smart_speaker', 'other'))
                  AS devices(device_key, device_type, device_category)"""
TABLES["dim_artist"] = f"""
    SELECT {numbered("artist_id")} AS artist_key, artist_id, name, genre, country, formed_year,
           2024 - formed_year AS years_active, monthly_listeners,
           CASE WHEN monthly_listeners >= 1000000 THEN 'superstar' WHEN monthly_listeners >= 100000 THEN 'star'
                WHEN monthly_listeners >= 10000 THEN 'established' ELSE 'emerging' END AS popularity_tier
    FROM artists"""
TABLES["dim_listener"] = f"""
    SELECT {numbered("listener_id")} AS listener_key, listener_id, email, username,
           concat_ws(' ', first_name, last_name) AS full_name, birth_date,
           CASE WHEN age IS NULL THEN 'Unknown' WHEN age >= 55 THEN '55+' WHEN age >= 45 THEN '45-54'
                WHEN age >= 35 THEN '35-44' WHEN age >= 25 THEN '25-34' WHEN age >= 18 THEN '18-24'
                ELSE 'Under 18' END AS age_group,
           city, country, subscription_type, created_at,
           CAST(trunc(epoch(TIMESTAMP '2024-12-31' - created_at) / 86400.0 / 30.44) AS INTEGER) AS tenure_months
    FROM (SELECT *, (DATE '2024-01-01' - birth_date) / 365.25 AS age FROM listeners)"""
TABLES["dim_track"] = f"""
    SELECT {numbered("track_id")} AS track_key, track_id, title, artist_key, album, duration_ms,
           CASE WHEN duration_ms > 300000 THEN 'long' WHEN duration_ms >= 180000 THEN 'medium' ELSE 'short' END
               AS duration_bucket,
           t.genre, release_date, CAST(year(release_date) AS INTEGER) AS release_year, explicit
    FROM tracks t JOIN dim_artist USING (artist_id)"""


def fact(source: str, days: str) -> str:
    return f"""
    SELECT date_key, listener_key, track_key, device_key, stream_id, streamed_at, duration_played_ms,
           {rounded("duration_played_ms * 1e2 / duration_ms", 2)} AS duration_played_pct,
           shuffle_mode, offline_mode,
           CASE WHEN duration_played_ms * 10 >= duration_ms * 9 THEN 1 ELSE 0 END AS is_full_play
    FROM {source} s JOIN dim_listener USING (listener_id) JOIN dim_track USING (track_id)
         JOIN dim_device USING (device_type) JOIN {days} d ON d.full_date = CAST(s.streamed_at AS DATE)"""


TABLES["fact"] = fact("streams", "dim_date")

TABLES["line_dates"] = calendar("1995-01-01", "2001-12-31")
TABLES["line_streams"] = """
    SELECT l_orderkey || '-' || l_linenumber AS stream_id, 'usr_' || o_custkey AS listener_id,
           'trk_' || l_partkey AS track_id, l_shipdate + to_hours(l_orderkey % 24) AS streamed_at,
           CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS duration_played_ms,
           ['mobile', 'desktop', 'tablet', 'smart_speaker', 'web'][l_orderkey % 5 + 1] AS device_type,
           CAST(l_returnflag = 'R' AS INTEGER) AS shuffle_mode, CAST(l_linestatus = 'O' AS INTEGER) AS offline_mode
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""
TABLES["line_fact"] = fact("line_streams", "line_dates")


def plays(fact_name: str, days: str) -> str:
    """The star flattened, one row per play."""
    return f"""
    SELECT f.*, l.listener_id, l.full_name AS listener_name, l.email, l.age_group, l.country, l.subscription_type,
           l.tenure_months, t.track_id, t.title, t.album, t.genre, t.release_year, t.duration_bucket, t.explicit,
           t.duration_ms, a.artist_id, a.artist_key, a.name AS artist_name, a.genre AS artist_genre,
           a.country AS artist_country, a.popularity_tier, a.years_active, a.monthly_listeners,
           v.device_type, v.device_category, d.full_date, d.year, d.quarter, d.month, d.month_name, d.week_of_year,
           d.day_of_week, d.day_name, d.is_weekend, d.is_holiday
    FROM {fact_name} f JOIN dim_listener l USING (listener_key) JOIN dim_track t USING (track_key)
         JOIN dim_artist a USING (artist_key) JOIN dim_device v USING (device_key) JOIN {days} d USING (date_key)"""


TABLES["plays"] = plays("fact", "dim_date")
TABLES["line_plays"] = plays("line_fact", "line_dates")


def statement(select: str) -> str:
    """The query together with the named subqueries it needs, in order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(TABLES[name])

    visit(select)
    if not needed:
        return select.strip()
    parts = ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name]})" for name in TABLES if name in needed)
    return f"WITH {parts}\n{select.strip()}"


# --- views ------------------------------------------------------------------------------------------------

N = "count(*)"
MS = "sum(duration_played_ms)"


def total(expression: str) -> str:
    """A sum as a 64-bit number."""
    return f"CAST(sum({expression}) AS BIGINT)"


def minutes(expression: str = MS, digits: int = 1) -> str:
    return rounded(f"{expression} / 60000.0", digits)


def hours(expression: str = MS) -> str:
    return rounded(f"{expression} / 3600000.0", 1)


def rate(flag: str) -> str:
    return rounded(f"avg({flag}) * 100", 1)


COMPLETION = rounded("avg(duration_played_pct)", 1)


def view_stream_details(source: str = "plays") -> str:
    return f"""
    SELECT stream_id, CAST(streamed_at AS VARCHAR) AS streamed_at, listener_id, listener_name, email AS listener_email,
           age_group, country AS listener_country, subscription_type, tenure_months, track_id, title AS track_title,
           album, duration_ms AS track_duration_ms, {rounded("duration_ms / 1000.0", 1)} AS track_duration_sec,
           duration_bucket, genre, release_year, explicit, artist_id, artist_name, artist_genre, popularity_tier,
           years_active AS artist_years_active, device_type, device_category, CAST(full_date AS VARCHAR) AS stream_date,
           year, quarter, month, month_name, week_of_year, day_of_week, day_name, is_weekend, is_holiday,
           duration_played_ms, {rounded("duration_played_ms / 1000.0", 1)} AS duration_played_sec,
           {rounded("duration_played_ms / 60000.0", 2)} AS duration_played_min,
           {rounded("duration_played_pct", 1)} AS completion_pct, is_full_play, shuffle_mode, offline_mode
    FROM {source}"""


def view_listener_summary(source: str = "plays") -> str:
    return f"""
    SELECT listener_id, listener_name AS full_name, email, age_group, country, subscription_type, tenure_months,
           {N} AS total_streams, {total("is_full_play")} AS full_plays, {total("shuffle_mode")} AS shuffle_streams,
           {total("offline_mode")} AS offline_streams, count(DISTINCT track_id) AS unique_tracks,
           count(DISTINCT artist_id) AS unique_artists, count(DISTINCT genre) AS unique_genres,
           CAST({MS} AS BIGINT) AS total_ms, {minutes()} AS total_minutes, {hours()} AS total_hours,
           {COMPLETION} AS avg_completion_pct, {rounded(f"{MS} / ({N} * 1000.0)", 1)} AS avg_stream_duration_sec,
           {rate("is_full_play")} AS full_play_pct, {rate("shuffle_mode")} AS shuffle_pct,
           {rate("offline_mode")} AS offline_pct, CAST(min(full_date) AS VARCHAR) AS first_stream_date,
           CAST(max(full_date) AS VARCHAR) AS last_stream_date, count(DISTINCT full_date) AS active_days
    FROM {source} GROUP BY ALL"""


def view_track_popularity(source: str = "plays") -> str:
    return f"""
    SELECT *, rank() OVER (ORDER BY stream_count DESC) AS overall_rank,
           rank() OVER (PARTITION BY genre ORDER BY stream_count DESC) AS genre_rank
    FROM (SELECT track_id, title, album, artist_name, artist_id, genre, release_year, duration_bucket, explicit,
                 {N} AS stream_count, count(DISTINCT listener_key) AS unique_listeners,
                 {total("is_full_play")} AS full_plays, {minutes()} AS total_minutes_played,
                 {COMPLETION} AS avg_completion_pct, {rate("is_full_play")} AS full_play_rate
          FROM {source} GROUP BY ALL)"""


def view_artist_popularity(source: str = "plays") -> str:
    return f"""
    SELECT *, rank() OVER (ORDER BY total_streams DESC) AS overall_rank,
           rank() OVER (PARTITION BY genre ORDER BY total_streams DESC) AS genre_rank
    FROM (SELECT artist_id, artist_name, artist_genre AS genre, artist_country AS country, popularity_tier,
                 years_active, monthly_listeners, count(DISTINCT track_id) AS tracks_in_catalog,
                 count(DISTINCT album) AS albums, {N} AS total_streams,
                 count(DISTINCT listener_id) AS unique_listeners, {total("is_full_play")} AS full_plays,
                 {minutes()} AS total_minutes_played, {hours()} AS total_hours_played,
                 {COMPLETION} AS avg_completion_pct
          FROM {source} GROUP BY ALL)"""


def view_genre_trends(source: str = "plays") -> str:
    return f"""
    SELECT year, month, month_name, genre, {N} AS stream_count, count(DISTINCT listener_id) AS unique_listeners,
           count(DISTINCT track_id) AS unique_tracks, count(DISTINCT artist_id) AS unique_artists,
           {hours()} AS total_hours, {COMPLETION} AS avg_completion_pct,
           {rounded("count(*) * 1e2 / any_value(month_total)", 1)} AS month_share_pct
    FROM {source} JOIN (SELECT year, month, count(*) AS month_total FROM {source} GROUP BY ALL) USING (year, month)
    GROUP BY year, month, month_name, genre"""


def view_daily_platform_stats(source: str = "plays") -> str:
    return f"""
    SELECT CAST(full_date AS VARCHAR) AS full_date, year, month, month_name, day_name, is_weekend, is_holiday,
           {N} AS total_streams, count(DISTINCT listener_id) AS active_listeners,
           count(DISTINCT track_id) AS unique_tracks_played, count(DISTINCT artist_id) AS unique_artists_played,
           {hours()} AS total_hours_streamed, {COMPLETION} AS avg_completion_pct,
           {rate("is_full_play")} AS full_play_rate, {rate("shuffle_mode")} AS shuffle_pct,
           {rate("offline_mode")} AS offline_pct
    FROM {source} GROUP BY ALL"""


def view_top_artists(source: str = "plays", limit: int = 5) -> str:
    return f"""
    SELECT listener_id, listener_name, artist_id, artist_name, artist_genre, popularity_tier, {N} AS stream_count,
           {total("is_full_play")} AS full_plays, {minutes()} AS minutes_listened,
           row_number() OVER (PARTITION BY listener_id ORDER BY {MS} DESC, artist_id) AS artist_rank
    FROM {source} GROUP BY listener_id, listener_name, artist_id, artist_name, artist_genre, popularity_tier
    QUALIFY artist_rank <= {limit}"""


def view_top_tracks(source: str = "plays", limit: int = 5) -> str:
    return f"""
    SELECT listener_id, listener_name, track_id, title AS track_title, album, artist_name, genre, {N} AS play_count,
           {total("is_full_play")} AS full_plays, {minutes()} AS minutes_listened,
           {COMPLETION} AS avg_completion_pct,
           row_number() OVER (PARTITION BY listener_id ORDER BY {N} DESC, track_id) AS track_rank
    FROM {source} GROUP BY listener_id, listener_name, track_id, title, album, artist_name, genre
    QUALIFY track_rank <= {limit}"""


def view_top_genre(source: str = "plays") -> str:
    return f"""
    SELECT listener_id, listener_name, genre AS top_genre, streams AS stream_count, unique_tracks, unique_artists,
           {minutes("ms")} AS minutes_listened,
           CASE WHEN {minutes("ms")} <> 0 THEN 100.0::DOUBLE END AS genre_share_pct,
           CASE WHEN listener_ms <> 0 THEN {rounded("ms * 1e2 / listener_ms", 1)} END AS genre_share_of_total_pct
    FROM (SELECT listener_id, listener_name, genre, {N} AS streams, count(DISTINCT track_id) AS unique_tracks,
                 count(DISTINCT artist_id) AS unique_artists, {MS} AS ms,
                 sum({MS}) OVER (PARTITION BY listener_id) AS listener_ms,
                 row_number() OVER (PARTITION BY listener_id ORDER BY {MS} DESC, genre) AS place
          FROM {source} GROUP BY listener_id, listener_name, genre)
    WHERE place = 1"""


def view_personality(
    source: str = "plays", artists: int = 80, genres: int = 3, shuffle: float = 0.7, full: float = 0.85,
    offline: float = 0.5, streams: int = 2500,
) -> str:
    return f"""
    SELECT listener_id, listener_name,
           CASE WHEN unique_artists >= {artists} THEN 'Explorer' WHEN unique_genres <= {genres} THEN 'Genre Loyalist'
                WHEN shuffled > {shuffle} * total_streams THEN 'The Shuffler'
                WHEN finished > {full} * total_streams THEN 'Deep Listener'
                WHEN stored > {offline} * total_streams THEN 'Offline Adventurer'
                WHEN total_streams > {streams} THEN 'Power User' ELSE 'Casual Listener' END AS listening_personality,
           total_streams, unique_artists, unique_tracks, unique_genres,
           {rounded("shuffled * 1e2 / total_streams", 1)} AS shuffle_pct,
           {rounded("finished * 1e2 / total_streams", 1)} AS full_play_pct,
           {rounded("stored * 1e2 / total_streams", 1)} AS offline_pct
    FROM (SELECT listener_id, listener_name, {N} AS total_streams, count(DISTINCT artist_id) AS unique_artists,
                 count(DISTINCT track_id) AS unique_tracks, count(DISTINCT genre) AS unique_genres,
                 sum(shuffle_mode) AS shuffled, sum(is_full_play) AS finished, sum(offline_mode) AS stored
          FROM {source} GROUP BY ALL)"""


def view_monthly_trends(source: str = "plays") -> str:
    return f"""
    SELECT listener_id, listener_name, month, month_name, {N} AS streams, count(DISTINCT track_id) AS unique_tracks,
           count(DISTINCT artist_id) AS unique_artists, {minutes()} AS minutes_listened, {hours()} AS hours_listened
    FROM {source} GROUP BY ALL"""


def view_peak_times(source: str = "plays") -> str:
    return f"""
    SELECT listener_id, listener_name, time_of_day, {N} AS stream_count,
           row_number() OVER (PARTITION BY listener_id ORDER BY {N} DESC, time_of_day) AS time_rank,
           {rounded(f"{N} * 1e2 / sum({N}) OVER (PARTITION BY listener_id)", 1)} AS pct_of_listening
    FROM (SELECT listener_id, listener_name,
                 CASE WHEN hour(streamed_at) < 5 THEN 'Late Night' WHEN hour(streamed_at) < 9 THEN 'Early Morning'
                      WHEN hour(streamed_at) < 12 THEN 'Morning' WHEN hour(streamed_at) < 15 THEN 'Midday'
                      WHEN hour(streamed_at) < 18 THEN 'Afternoon' WHEN hour(streamed_at) < 21 THEN 'Evening'
                      ELSE 'Night' END AS time_of_day
          FROM {source})
    GROUP BY listener_id, listener_name, time_of_day
    QUALIFY time_rank <= 3"""


def view_weekday_weekend(source: str = "plays") -> str:
    return f"""
    SELECT listener_id, listener_name, weekday_streams, weekend_streams,
           {minutes("weekday_ms")} AS weekday_minutes, {minutes("weekend_ms")} AS weekend_minutes,
           {rounded("weekday_streams / 260.0", 1)} AS avg_weekday_streams,
           {rounded("weekend_streams / 104.0", 1)} AS avg_weekend_streams,
           CASE WHEN weekend_streams * 5 > weekday_streams * 2 THEN 'Weekend Warrior' ELSE 'Weekday Listener' END
               AS listener_type
    FROM (SELECT listener_id, listener_name, count(*) FILTER (is_weekend = 0) AS weekday_streams,
                 count(*) FILTER (is_weekend = 1) AS weekend_streams,
                 coalesce({MS} FILTER (is_weekend = 0), 0) AS weekday_ms,
                 coalesce({MS} FILTER (is_weekend = 1), 0) AS weekend_ms
          FROM {source} GROUP BY ALL)"""


def view_discovery(source: str = "plays") -> str:
    met = ", ".join(f"count(DISTINCT artist_id) FILTER (track_quarter = {q}) AS q{q}_new_artists" for q in range(1, 5))
    first = ", ".join(
        f"count(DISTINCT artist_id) FILTER (artist_quarter = {q}) AS first_q{q}_artists" for q in range(1, 5)
    )
    return f"""
    SELECT listener_id, listener_name, count(DISTINCT artist_id) AS total_artists_played,
           count(DISTINCT track_id) AS total_tracks_played, {met}, {first}
    FROM (SELECT listener_id, listener_name, artist_id, track_id,
                 quarter(min(streamed_at) OVER (PARTITION BY listener_id, track_id)) AS track_quarter,
                 quarter(min(streamed_at) OVER (PARTITION BY listener_id, artist_id)) AS artist_quarter
          FROM {source})
    GROUP BY listener_id, listener_name"""


def view_year_in_review(source: str = "plays") -> str:
    return f"""
    SELECT listener_id, listener_name, subscription_type, country, {N} AS total_streams,
           {minutes(digits=0)} AS total_minutes, {hours()} AS total_hours, count(DISTINCT full_date) AS days_active,
           count(DISTINCT track_id) AS unique_tracks, count(DISTINCT artist_id) AS unique_artists,
           count(DISTINCT genre) AS unique_genres, {COMPLETION} AS avg_completion_pct,
           {total("is_full_play")} AS full_plays, {rate("is_full_play")} AS full_play_rate,
           {rate("shuffle_mode")} AS shuffle_pct, {rate("offline_mode")} AS offline_pct,
           {rounded(f"percent_rank() OVER (ORDER BY {MS}) * 100", 0)} AS listening_percentile
    FROM {source} GROUP BY listener_id, listener_name, subscription_type, country"""


VIEWS = {
    "v_stream_details": view_stream_details,
    "v_listener_summary": view_listener_summary,
    "v_track_popularity": view_track_popularity,
    "v_artist_popularity": view_artist_popularity,
    "v_genre_trends": view_genre_trends,
    "v_daily_platform_stats": view_daily_platform_stats,
    "v_top_artists_by_listener": view_top_artists,
    "v_top_tracks_by_listener": view_top_tracks,
    "v_top_genre_by_listener": view_top_genre,
    "v_listening_personality": view_personality,
    "v_monthly_trends_by_listener": view_monthly_trends,
    "v_peak_listening_times": view_peak_times,
    "v_weekday_vs_weekend": view_weekday_weekend,
    "v_discovery_stats": view_discovery,
    "v_year_in_review_summary": view_year_in_review,
}
