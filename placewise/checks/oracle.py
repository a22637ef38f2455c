"""The same reports as SQL over the same tables."""

from __future__ import annotations

from placewise.functions.keywords import POSITIVE_WORDS

# Words of the invented texts, for the search of whole words.
ADDED_WORDS = ("der", "LA")

_K = "cast(json_extract_string(e.props, '$.k') AS integer)"

POSTS = f"""WITH posts AS (
  SELECT cast(e.event_id AS varchar) AS id, cast(e.user_id AS varchar) AS author_id,
    strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at, e.ts AS ts, e.event_type AS source,
    CASE WHEN e.event_id % 4 = 0 THEN 'RT @user' || cast(e.user_id % 20 AS varchar) || ' ' || d.text
         ELSE d.text END AS text,
    coalesce({_K} % 3 = 0, false) AS placed,
    CASE WHEN {_K} % 3 = 0 THEN pn.n_name END AS place,
    CASE WHEN {_K} % 3 = 0 THEN cast(pn.n_nationkey AS varchar) END AS place_id,
    un.n_name AS location, c.c_name AS username,
    CASE c.c_nationkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'null' END AS gender,
    c.c_mktsegment AS country, c.c_custkey % 50 + 50 AS probability, c.c_nationkey AS total_names
  FROM events e
  LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation un ON un.n_nationkey = c.c_nationkey
  LEFT JOIN nation pn ON pn.n_nationkey = {_K} % 25)
"""

_PLACES = """'[{"full_name":"' || place || '","id":"' || place_id || '"}]'"""
_LOCATIONS = """'["' || location || '"]'"""
_POSITIVE = "(" + " OR ".join(f"text LIKE '%{word}%'" for word in POSITIVE_WORDS) + ")"
_ANY_CASE = "(" + " OR ".join(f"lower(text) LIKE '%{word}%'" for word in POSITIVE_WORDS) + ")"
_HANDLE = r"regexp_extract(text, '\A.*(@\w+)\s+.*\z', 1)"


def _share(key: str, count: str) -> str:
    return f"""SELECT {key}, count(*) AS {count},
      cast(count(*) AS double) / cast(sum(count(*)) OVER () AS double) AS ratio
    FROM posts WHERE placed GROUP BY {key}"""


def _hourly(ts: str) -> str:
    return f"""SELECT cast(hour({ts}) AS integer) AS Time_In_EST,
      count(*) FILTER (WHERE NOT placed) AS Tweets_Not_Having_Address,
      count(*) FILTER (WHERE placed) AS Tweets_Having_Address FROM posts GROUP BY 1"""


_BOTH = "HAVING count(*) FILTER (WHERE NOT placed) > 0 AND count(*) FILTER (WHERE placed) > 0"
_HOURLY_GEO = _hourly("ts") + " " + _BOTH

_WHOLE_WORDS = rf"regexp_matches(text, '(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{'|'.join((*POSITIVE_WORDS, *ADDED_WORDS))})(?:[^\p{{L}}\p{{N}}_]|$)')"


def _positive_counts(positive: str) -> str:
    return f"""SELECT cast(hour(ts) AS integer) AS Time_In_EST,
      count(*) FILTER (WHERE placed) AS Tweets_Having_Address,
      count(*) FILTER (WHERE placed AND positive) AS positive_tweet_having_address,
      count(*) FILTER (WHERE NOT placed AND positive) AS positive_tweet_not_having_address
    FROM (SELECT ts, placed, {positive} AS positive FROM posts) GROUP BY 1"""


def _in_all_counts(positive: str) -> str:
    return f"""SELECT * FROM ({_positive_counts(positive)}) WHERE Tweets_Having_Address > 0
      AND positive_tweet_having_address > 0 AND positive_tweet_not_having_address > 0"""


def _windowed(key: str) -> str:
    return f"""SELECT strftime(ts, '%Y-%m-%d') AS day, {key}, count(*) AS n FROM posts
      GROUP BY 1, 2, date_trunc('day', ts)
      HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM posts)"""


def _windowed_top(key: str, name: str, items: int) -> str:
    """Closed days, with every value ranked and the error that a summary of so many places has."""
    return f"""SELECT day, CAST(row_number() OVER (PARTITION BY day ORDER BY n DESC, {name}) AS integer) AS rank, {name}, n,
        CAST(sum(n) OVER (PARTITION BY day) AS bigint) AS posts, CAST(floor(sum(n) OVER (PARTITION BY day) * 3.5 / {items}) AS bigint) AS error
      FROM ({_windowed(key)}) WHERE {name} IS NOT NULL"""


def _part(files: int) -> str:
    lowest, highest = ("(SELECT epoch_us(%s(ts)) FROM posts)" % f for f in ("min", "max"))
    return f"cast(floor((epoch_us(ts) - {lowest}) * {files} / cast({highest} - {lowest} + 1 AS double)) AS integer)"


_LANDED = "SELECT id, author_id, created_at, source, text, place, username, location FROM posts"

_PAIRS = """t AS (
  SELECT a.author_id, a.place, b.location FROM posts a JOIN posts b ON a.author_id = b.author_id
  WHERE a.placed)"""

_QUERIES = {
    "place_text": "SELECT place AS Place, text AS Tweet FROM posts WHERE placed",
    "text_feed": "SELECT text FROM posts",
    "geo_feed": f"SELECT author_id, created_at AS Created, {_PLACES} AS Place FROM posts WHERE placed",
    "author_feed": f"""SELECT {_LOCATIONS} AS Location, text AS Text, '["' || username || '"]' AS Name,
      author_id FROM posts""",
    "by_location": f"SELECT {_LOCATIONS} AS Location, count(*) AS Total_Tweets_By_Location FROM posts GROUP BY 1",
    "by_each_location": "SELECT location AS Location, count(*) AS Total_Tweets_By_Location FROM posts GROUP BY 1",
    "device_share": _share("source", "Tot_Tweets_By_Device"),
    "gender_share": _share("gender", "Tot_Tweets_By_Gender"),
    "record_share": _share("gender", "Tot_Tweets_By_Gender"),
    "enriched_genders": "SELECT id, username, username AS name, gender, country, probability, total_names FROM posts WHERE placed",
    "hourly_geo": _HOURLY_GEO,
    "hourly_geo_tz": _hourly("(ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York'") + " " + _BOTH,
    "hourly_geo_join": """SELECT Time_In_EST, Tweets_Not_Having_Address, Tweets_Having_Address
      FROM (SELECT cast(hour(ts) AS integer) AS Time_In_EST, count(*) AS Tweets_Not_Having_Address
            FROM posts WHERE NOT placed GROUP BY 1)
      JOIN (SELECT cast(hour(ts) AS integer) AS Time_In_EST, count(*) AS Tweets_Having_Address
            FROM posts WHERE placed GROUP BY 1) USING (Time_In_EST)""",
    "top_hours": _HOURLY_GEO + " ORDER BY Tweets_Having_Address DESC, Time_In_EST LIMIT 20",
    "positive_hourly": _in_all_counts(_POSITIVE),
    "positive_hourly_words": _in_all_counts(_WHOLE_WORDS),
    "positive_counts_any_case": _positive_counts(_ANY_CASE),
    "place_vs_profile": f"SELECT place, location, count(*) AS n FROM t GROUP BY 1, 2",
    "place_vs_profile_rows": f"""SELECT a.author_id AS ID, a.Created, a.Location_Per_Tweet, b.Tweet_Content,
        b.Location_Per_User
      FROM (SELECT author_id, created_at AS Created, {_PLACES} AS Location_Per_Tweet FROM posts WHERE placed) a
      JOIN (SELECT author_id, md5(text) AS Tweet_Content, {_LOCATIONS} AS Location_Per_User FROM posts) b
        ON a.author_id = b.author_id""",
    "location_match": """SELECT author_id, count(*) AS pairs,
        count(*) FILTER (WHERE lower(place) = lower(location)) AS equal,
        count(*) FILTER (WHERE contains(lower(place), lower(location))) AS holding,
        count(*) FILTER (WHERE contains(lower(place), lower(location))) / cast(count(*) AS double) AS rate
      FROM t WHERE place IS NOT NULL AND location IS NOT NULL GROUP BY 1""",
    "share_by_region": """SELECT r_name AS attribute, count(*) FILTER (WHERE placed) AS placed, count(*) AS posts,
        count(*) FILTER (WHERE placed) / cast(count(*) AS double) AS share
      FROM posts LEFT JOIN nation n ON n.n_name = location LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY 1""",
    "top_handles": f"SELECT {_HANDLE} AS value, count(*) AS count FROM posts WHERE {_HANDLE} <> '' GROUP BY 1",
    "every_handle": r"""SELECT value, count(*) AS count
      FROM (SELECT unnest(regexp_extract_all(text, '@\w+')) AS value FROM posts) GROUP BY 1""",
    "landed_posts": _LANDED,
    "post_schema_drift": """SELECT * FROM (VALUES ('data.id', 'string', 'bigint', 'retyped'), ('data.lang', NULL, 'string', 'unknown'),
        ('data.text', 'string', NULL, 'missing'), ('includes.users[].id', 'string', NULL, 'missing'), ('includes.users[].location', 'string', NULL, 'missing'),
        ('includes.users[].name', 'string', NULL, 'missing'), ('includes.users[].username', 'string', NULL, 'missing')) AS drift(path, declared, found, drift)
      WHERE (SELECT count(*) FROM posts) > 0""",
    "stream_fresh_genders": f"""SELECT id, username, CASE WHEN known THEN username END AS name, CASE WHEN known THEN gender ELSE 'null' END AS gender,
        CASE WHEN known THEN country END AS country, CASE WHEN known THEN cast(probability AS varchar) END AS probability,
        CASE WHEN known THEN cast(total_names AS varchar) END AS total_names, batch
      FROM (SELECT *, cast(author_id AS bigint) % 4 <= batch AS known FROM (SELECT *, {_part(4)} AS batch FROM posts WHERE placed))""",
    "torn_lines_by_batch": f"""SELECT batch, count(*) AS lines, count(*) FILTER (WHERE cast(id AS bigint) % 50 = 0) AS torn
      FROM (SELECT id, {_part(3)} AS batch FROM posts UNION ALL SELECT id, -1 AS batch FROM posts) GROUP BY batch""",
    "stream_device": "SELECT source, count(*) AS Tot_Tweets_By_Device FROM posts WHERE placed GROUP BY 1",
    "stream_gender": "SELECT gender, count(*) AS Tot_Tweets_By_Gender FROM posts WHERE placed GROUP BY 1",
    "stream_hourly": _hourly("ts"),
    "stream_positive": _positive_counts(_POSITIVE),
    "stream_windowed_device": _windowed("source"),
    "stream_windowed_location": _windowed(f"{_LOCATIONS} AS Location"),
    "stream_windowed_handles": _windowed(f"nullif({_HANDLE}, '') AS value"),
    "stream_sorted_location": f"""SELECT *, CAST(row_number() OVER (ORDER BY Total_Tweets_By_Location DESC, Location) AS integer) AS position
      FROM (SELECT {_LOCATIONS} AS Location, count(*) AS Total_Tweets_By_Location FROM posts GROUP BY 1)""",
    "stream_top_locations": _windowed_top("location", "location", 2048),
    "stream_top_handles": _windowed_top(f"nullif({_HANDLE}, '') AS value", "value", 2048),
    "stream_top_handles_exact": "SELECT day, rank, value, n FROM (" + _windowed_top(f"nullif({_HANDLE}, '') AS value", "value", 2048) + ") WHERE rank <= 5",
    "stream_top_recall": """SELECT strftime(time_bucket(INTERVAL 10 DAY, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d') AS day, true AS recall_of_nine_tenths,
        true AS within_error, count(*) AS posts FROM posts GROUP BY time_bucket(INTERVAL 10 DAY, ts, TIMESTAMP '1970-01-01')
      HAVING time_bucket(INTERVAL 10 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 10 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM posts)""",
}

# A live report must leave what its batch form gives, and a spread join what the plain one gives.
_SAME = {
    "place_vs_profile_spread": "place_vs_profile_rows",
    "stream_place_text": "place_text",
    "stream_text_feed": "text_feed",
    "stream_geo_feed": "geo_feed",
    "stream_device_share": "device_share",
    "stream_enriched_genders": "enriched_genders",
    "stream_gender_share": "record_share",
    "stream_by_location": "by_location",
    "stream_handles": "top_handles",
    "stream_landed_posts": "landed_posts",
}


# Locations as people write them, and the words of a name with one space between them.
_WRITTEN = """CASE cast(author_id AS bigint) % 6 WHEN 0 THEN 'Old Town, ' || location WHEN 1 THEN lower(location) || '(north-west)!'
      WHEN 2 THEN 'born in ' || location || ' / now CHINA' WHEN 3 THEN 'somewhere  nice'
      WHEN 4 THEN substr(location, 1, 4) || substr(location, 6) ELSE location END"""


def _plain(name: str) -> str:
    return f"trim(regexp_replace(lower({name}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def _blocks(name: str) -> str:
    return f"list_append(list_filter(string_split({name}, ' '), lambda w: length(w) >= 3), substr({name}, 1, 3))"


_QUERIES |= {
    "share_by_named_region": f"""SELECT attribute, count(*) FILTER (WHERE placed) AS placed, count(*) AS posts,
        count(*) FILTER (WHERE placed) / cast(count(*) AS double) AS share
      FROM (SELECT placed, {_plain(_WRITTEN)} AS written FROM posts)
      LEFT JOIN (SELECT written, arg_min(attribute, (-words, -length(name), spot)) AS attribute FROM
          (SELECT written, attribute, name, len(string_split(name, ' ')) AS words, strpos(' ' || written || ' ', ' ' || name || ' ') AS spot
           FROM (SELECT DISTINCT {_plain(_WRITTEN)} AS written FROM posts),
             (SELECT {_plain("n_name")} AS name, r_name AS attribute FROM nation JOIN region ON r_regionkey = n_regionkey
              UNION SELECT {_plain("r_name")}, r_name FROM region))
        WHERE spot > 0 GROUP BY written) USING (written) GROUP BY 1""",
    "location_agreement": f"""SELECT author_id, count(*) AS pairs, count(*) FILTER (WHERE lower(place) = lower(written)) AS equal,
        count(*) FILTER (WHERE contains(lower(place), lower(written))) AS holding, count(*) FILTER (WHERE near) AS near,
        count(*) FILTER (WHERE near) / cast(count(*) AS double) AS rate
      FROM (SELECT *, a = b OR (list_has_any({_blocks("a")}, {_blocks("b")}) AND levenshtein(a, b) <= greatest(length(a), length(b)) // 4) AS near
            FROM (SELECT *, {_plain("place")} AS a, {_plain("written")} AS b FROM (SELECT author_id, place, {_WRITTEN} AS written FROM t )
                  WHERE place IS NOT NULL AND written IS NOT NULL)) GROUP BY 1""",
}


def _sql(query: str) -> str:
    pairs = ",\n" + _PAIRS + "\n" if " FROM t " in query else ""
    return POSTS + pairs + query


SQL: dict[str, str] = {name: _sql(query) for name, query in _QUERIES.items()}
SQL |= {name: SQL[twin] for name, twin in _SAME.items()}
