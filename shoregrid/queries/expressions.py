"""Scalar, array and JSON expressions, one projection each."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoregrid.functions import arrays, media, moments, numbers, text, wind
from shoregrid.queries import query
from shoregrid.queries.inputs import CENTS_SQL, LAT_SQL, LON_SQL, cents, station_lat, station_lon, table

NTZ = "timestamp_ntz"


@query("""
SELECT p_partkey, p_brand[:5] AS head, p_name[3:6] AS middle, p_name[-4:-2] AS tail, p_name[-1] AS last,
       url[-8:-6] AS id_part
FROM part LEFT JOIN pages ON page_id = p_partkey
""")
def text_slices(spark, sf_dir):
    """Slices from the front and from the end."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("p_partkey"), "url")
    name = F.col("p_name")
    return (
        table(spark, sf_dir, "part")
        .join(pages, "p_partkey", "left")
        .select(
            "p_partkey",
            text.left(F.col("p_brand"), 5).alias("head"),
            text.between_positions(name, 3, 6).alias("middle"),
            text.tail_slice(name, -4, -2).alias("tail"),
            text.tail_slice(name, -1, -1).alias("last"),
            text.tail_slice(F.col("url"), -8, -6).alias("id_part"),
        )
    )


@query("""
SELECT page_id, split_part(url, '/', -1) AS last_part, split_part(url, '://', 1) AS scheme,
       split_part(split_part(url, 'example.', 2), '/', 1) AS zone,
       regexp_replace(url, '[aeiou]', '_') AS first_vowel, regexp_replace(url, '[aeiou]', '_', 'g') AS all_vowels
FROM pages
""")
def text_parts(spark, sf_dir):
    """Parts of a split text; first and all matches replaced."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        text.part(url, "/", -1).alias("last_part"),
        text.part(url, "://", 1).alias("scheme"),
        text.part(text.part(url, "example.", 2), "/", 1).alias("zone"),
        text.replace_first(url, "[aeiou]", "_").alias("first_vowel"),
        F.regexp_replace(url, "[aeiou]", "_").alias("all_vowels"),
    )


@query("""
SELECT p_partkey, lower(p_brand) || '-' || upper(p_type) AS label, replace('"' || p_name || '"', '"', '') AS bare,
       printf('%03d', p_size) AS padded, url_decode('a%2Fb%20' || p_partkey) AS decoded,
       CASE WHEN p_size > 25 THEN 'large' WHEN p_size > 10 THEN 'medium' ELSE 'small' END AS class
FROM part
""")
def text_building(spark, sf_dir):
    key = F.col("p_partkey").cast("string")
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lower("p_brand"), F.lit("-"), F.upper("p_type")).alias("label"),
        text.unquote(F.concat(F.lit('"'), F.col("p_name"), F.lit('"'))).alias("bare"),
        text.zero_pad(size, 3).alias("padded"),
        F.url_decode(F.concat(F.lit("a%2Fb%20"), key)).alias("decoded"),
        F.when(size > 25, "large").when(size > 10, "medium").otherwise("small").alias("class"),
    )


@query(f"""
SELECT event_id, make_timestamp(y, m, d, h, CASE WHEN mi >= 60 THEN 0 ELSE mi END, 0.0) AS built
FROM (SELECT event_id, year(ts) AS y, month(ts) AS m, day(ts) AS d, hour(ts) AS h, {CENTS_SQL} % 100 AS mi FROM events)
""")
def built_times(spark, sf_dir):
    """Times built from text parts, with impossible minutes taken as 0."""
    ts = F.col("ts")
    parts = [F.date_format(ts, p) for p in ("yyyy", "MM", "dd", "HH")]
    minute = (cents(F.col("value")) % 100).cast("string")
    built = moments.observation_time(*parts, minute)
    return table(spark, sf_dir, "events").select("event_id", built.cast(NTZ).alias("built"))


@query("""
SELECT event_id, date_trunc('hour', ts) AS compact, date_trunc('day', ts) AS day,
       date_trunc('minute', ts) AS zoned, strftime(ts, '%Y-%m-%d %H:%M') AS shown,
       date_trunc('second', ts) + INTERVAL 10 HOUR AS photo
FROM events
""")
def parsed_times(spark, sf_dir):
    """Times parsed from the formats found in file names, listings, inventories and photo tags."""
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        moments.compact_hour(F.date_format(ts, "yyyyMMddHH")).cast(NTZ).alias("compact"),
        moments.iso_day(F.date_format(ts, "yyyy-MM-dd")).cast(NTZ).alias("day"),
        moments.zoned_minute(F.date_format(ts, "yyyy-MM-dd HH:mm")).cast(NTZ).alias("zoned"),
        F.date_format(ts, "yyyy-MM-dd HH:mm").alias("shown"),
        media.photo_time(F.date_format(ts, "yyyy:MM:dd HH:mm:ss"), F.lit("-10:00"))
        .cast(NTZ)
        .alias("photo"),
    )


@query("""
SELECT event_id, date_trunc('month', ts) AS month, CAST(year(ts) AS INTEGER) AS year,
       CAST(minute(ts) AS INTEGER) AS minute, time_bucket(INTERVAL 30 MINUTE, ts) AS half_hour,
       date_trunc('hour', ts + INTERVAL 30 MINUTE) AS nearest,
       date_diff('second', date_trunc('hour', ts), date_trunc('second', ts)) AS seconds,
       ts - INTERVAL 30 MINUTE AS earlier, date_trunc('day', ts - INTERVAL 45 DAY) AS available_from
FROM events
""")
def time_arithmetic(spark, sf_dir):
    from shoregrid.streaming.ingest import availability

    ts = F.col("ts")
    start, _ = availability(ts)
    return table(spark, sf_dir, "events").select(
        "event_id",
        moments.truncate("MONTH", ts).alias("month"),
        F.year(ts).alias("year"),
        F.minute(ts).alias("minute"),
        moments.half_hour(ts).alias("half_hour"),
        moments.nearest_hour(ts).alias("nearest"),
        F.timestamp_diff("SECOND", moments.truncate("HOUR", ts), moments.truncate("SECOND", ts))
        .alias("seconds"),
        (ts - F.expr(moments.HALF_HOUR)).alias("earlier"),
        start.cast(NTZ).alias("available_from"),
    )


@query("""
SELECT l_orderkey, l_linenumber, round(l_extendedprice * l_discount, 2) AS to_cents,
       round(l_quantity / 8, 2) AS eighth, CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS half,
       CAST(floor(l_extendedprice / 7) AS BIGINT) AS sevenths, round(sqrt(l_extendedprice), 6) AS root,
       round(pow(l_discount, 2), 6) AS square, l_quantity % 7 AS rest,
       CASE WHEN l_tax <> 0 THEN round(l_discount / l_tax, 6) END AS ratio
FROM lineitem
""")
def rounding(spark, sf_dir):
    """Rounding of binary values and division that may meet zero."""
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.round_half_away(price * F.col("l_discount"), 2).alias("to_cents"),
        numbers.round_half_away(quantity / 8, 2).alias("eighth"),
        numbers.to_int_half_even(quantity / 2).alias("half"),
        F.floor(price / 7).alias("sevenths"),
        numbers.round_half_away(F.sqrt(price), 6).alias("root"),
        numbers.round_half_away(F.pow("l_discount", F.lit(2.0)), 6).alias("square"),
        (quantity % 7).alias("rest"),
        numbers.round_half_away(F.try_divide("l_discount", "l_tax"), 6).alias("ratio"),
    )


@query("""
SELECT event_id, round(sqrt(u * u + v * v), 6) AS speed,
       round((degrees(atan2(-u, -v)) + 360e0) % 360e0, 6) AS direction
FROM (SELECT event_id, value - 60e0 AS u, value * 0.5e0 - 40e0 AS v FROM events)
""")
def wind_from_components(spark, sf_dir):
    u, v = F.col("value") - 60.0, F.col("value") * 0.5 - 40.0
    return table(spark, sf_dir, "events").select(
        "event_id",
        numbers.round_half_away(wind.wind_speed(u, v), 6).alias("speed"),
        numbers.round_half_away(wind.wind_from(u, v), 6).alias("direction"),
    )


@query("""
SELECT vec_id, CAST(len(joined) AS INTEGER) AS n, CAST(joined[1] AS DOUBLE) AS first_value,
       CAST(rest[1] AS DOUBLE) AS second_value, CAST(len(rest) AS INTEGER) AS n_rest,
       CAST(joined[200] AS DOUBLE) AS beyond, list_contains(ids, CAST(vec_id AS INTEGER)) AS listed
FROM (SELECT vec_id, list_concat([CAST(label AS FLOAT)], embedding, CAST(NULL AS FLOAT[])) AS joined,
             embedding[2:] AS rest, [1, 2, 3, label] AS ids FROM embeddings)
""")
def list_expressions(spark, sf_dir):
    """Concatenation with a missing list, slices, positions outside, membership."""
    vector = F.col("embedding")
    joined = arrays.concat_lists(
        "float", F.array(F.col("label").cast("float")), vector, F.lit(None).cast("array<float>")
    )
    rest = arrays.slice_from(vector, 2)
    ids = F.array(F.lit(1), F.lit(2), F.lit(3), F.col("label"))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.size(joined).alias("n"),
        F.get(joined, 0).cast("double").alias("first_value"),
        F.get(rest, 0).cast("double").alias("second_value"),
        F.size(rest).alias("n_rest"),
        F.get(joined, 199).cast("double").alias("beyond"),
        F.array_contains(ids, F.col("vec_id").cast("int")).alias("listed"),
    )


@query("""
SELECT doc_id, list_filter(words, lambda w: length(w) > 6)[1] AS long_word,
       list_filter(list_zip(words, range(1, len(words) + 1)), lambda z: length(z[1]) > 6)[1][2] AS at
FROM (SELECT doc_id, str_split(text, ' ') AS words FROM documents)
""")
def first_matching_element(spark, sf_dir):
    """The first element of zipped lists that passes a test."""
    words = F.split("text", " ")
    zipped = F.arrays_zip(words.alias("w"), F.sequence(F.lit(1), F.size(words)).alias("i"))
    hit = arrays.first_match(zipped, lambda z: F.length(z["w"]) > 6)
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", hit.alias("hit"))
        .select("doc_id", F.col("hit.w").alias("long_word"), F.col("hit.i").cast("long").alias("at"))
    )


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.missing') AS missing FROM events
""")
def json_paths(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )


@query(f"""
SELECT event_id, CAST(floor(abs(lon)) AS INTEGER) AS degrees,
       CAST(floor((abs(lon) - floor(abs(lon))) * 60) AS INTEGER) AS minutes,
       CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END AS east_west, round(lat, 6) AS signed_lat, round(lon, 6) AS signed_lon
FROM (SELECT event_id, {LON_SQL} AS lon, {LAT_SQL} AS lat FROM events)
""")
def degrees_minutes(spark, sf_dir):
    """Degrees to degrees and minutes with a hemisphere letter, and back."""
    lon, lat = station_lon(F.col("user_id")), station_lat(F.col("user_id"))
    dms = media.to_dms(lon)
    letter = media.hemisphere(lon, "E", "W")
    return table(spark, sf_dir, "events").select(
        "event_id",
        dms["degrees"].alias("degrees"),
        dms["minutes"].alias("minutes"),
        letter.alias("east_west"),
        numbers.round_half_away(
            media.signed_degrees(F.abs(lat), media.hemisphere(lat, "N", "S")), 6
        ).alias("signed_lat"),
        numbers.round_half_away(media.signed_degrees(F.abs(lon), letter), 6).alias("signed_lon"),
    )


@query("""
SELECT event_id, spot, date_trunc('minute', ts) + INTERVAL 10 HOUR AS taken, lat, lon
FROM (SELECT *, (['jocko''s', 'laniakea', 'alamoanabeachpark', 'hi-haleiwa', 'sunsetbeach', 'nowhere'])[user_id % 6 + 1] AS spot FROM events)
LEFT JOIN (VALUES ('jocko''s', 21.6217e0, -158.0838e0), ('laniakea', 21.6190e0, -158.0852e0),
                  ('alamoanabeachpark', 21.291794e0, -157.848113e0), ('hi-haleiwa', 21.6028e0, -158.1074e0),
                  ('sunsetbeach', 33.88073e0, -78.51223e0)) s(spot, lat, lon) USING (spot)
""")
def clip_places(spark, sf_dir):
    """Spot and UTC time out of clip names; unknown spots keep no place."""
    from shoregrid.plans.media import place_clips

    names = [*[s for s, _, _ in media_spots()], "nowhere"]
    spot = F.get(F.array(*[F.lit(n) for n in names]), (F.col("user_id") % 6).cast("int"))
    clip = F.concat(
        F.lit("clip_"), spot, F.lit("_"), F.date_format("ts", "yyyyMMdd_HHmm"), F.lit("(1).mp4")
    )
    clips = table(spark, sf_dir, "events").select("event_id", clip.alias("name"))
    return place_clips(clips, "name").select(
        "event_id", "spot", F.col("taken").cast(NTZ).alias("taken"), "lat", "lon"
    )


def media_spots():
    from shoregrid.fixed_values import SPOTS

    return SPOTS
