"""Statistics, projections, text and date rules, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import arrays, dates, numeric, text
from tallyforge.operators import describe, ordering
from tallyforge.plans.registry import query
from tallyforge.plans.views import Tables, with_views

# ---------------------------------------------------------------- aggregations


@query(
    "AGG-16 AGG-1 AGG-3 SRC-8",
    with_views(
        "purchases",
        """, counts AS (SELECT product, count(*) AS n FROM purchases GROUP BY product),
        best AS (SELECT product, n FROM counts ORDER BY n DESC, product LIMIT 1)
        SELECT count(*) AS purchases, count(DISTINCT "user") AS buyers, round(sum(price), 2) AS revenue,
               (SELECT product FROM best) AS best_product, (SELECT n FROM best) AS best_count
        FROM purchases""",
    ),
)
def purchase_summary(t: Tables) -> DataFrame:
    return describe.purchase_report(t.purchases).withColumn("revenue", F.round("revenue", 2))


@query("AGG-1", "SELECT count(*) AS n FROM lineitem")
def row_count(t: Tables) -> DataFrame:
    return describe.row_count(t.lineitem)


@query(
    "AGG-2",
    with_views(
        "users",
        """SELECT count(DISTINCT user_id) AS distinct_user_id, count(DISTINCT occupation) AS distinct_occupation,
           count(DISTINCT zip) AS distinct_zip FROM users""",
    ),
)
def user_distinct_counts(t: Tables) -> DataFrame:
    return describe.distinct_counts(t.users, ["user_id", "occupation", "zip"])


@query(
    "AGG-3",
    """SELECT round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem""",
)
def total_revenue(t: Tables) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.agg(F.round(F.sum(net), 2).alias("revenue"))


@query(
    "AGG-4 AGG-5",
    with_views(
        "ratings",
        "SELECT min(rating) AS min_rating, max(rating) AS max_rating, round(avg(rating), 6) AS mean_rating FROM ratings",
    ),
)
def rating_range_and_mean(t: Tables) -> DataFrame:
    return t.ratings.agg(
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.round(F.avg("rating"), 6).alias("mean_rating"),
    )


@query(
    "AGG-6",
    with_views(
        "ratings",
        """SELECT count(*) AS n, round(avg(rating), 6) AS mean, round(stddev_pop(rating), 6) AS stdev,
           max(rating) AS "max", min(rating) AS "min" FROM ratings""",
    ),
)
def rating_summary(t: Tables) -> DataFrame:
    s = describe.summary(t.ratings, "rating")
    return s.withColumns({"mean": F.round("mean", 6), "stdev": F.round("stdev", 6)})


@query("AGG-7", with_views("ratings", "SELECT CAST(median(rating) AS DOUBLE) AS median_rating FROM ratings"))
def rating_median(t: Tables) -> DataFrame:
    return ordering.exact_median(t.ratings, "rating", "median_rating")


@query("AGG-7", "SELECT CAST(floor(median(l_extendedprice)) AS BIGINT) AS median_price FROM lineitem")
def price_median(t: Tables) -> DataFrame:
    m = ordering.exact_median(t.lineitem, "l_extendedprice", "m")
    return m.select(F.floor("m").alias("median_price"))


@query("AGG-8", with_views("users", "SELECT occupation, count(*) AS n FROM users GROUP BY occupation"))
def users_by_occupation(t: Tables) -> DataFrame:
    return describe.count_by(t.users, "occupation")


@query("AGG-9", with_views("ratings", "SELECT rating, count(*) AS n FROM ratings GROUP BY rating"))
def rating_value_counts(t: Tables) -> DataFrame:
    return describe.count_by(t.ratings, "rating")


@query("AGG-10", with_views("ratings", "SELECT user_id, count(*) AS n FROM ratings GROUP BY user_id"))
def ratings_per_user(t: Tables) -> DataFrame:
    return describe.count_by(t.ratings, "user_id")


@query(
    "AGG-11",
    with_views(
        "ratings",
        """SELECT user_id, part, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items
           FROM (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY item_id) - 1) // 4096 AS part FROM ratings)
           GROUP BY user_id, part""",
    ),
)
def items_of_each_user(t: Tables) -> DataFrame:
    lists = describe.member_lists(t.ratings, "user_id", ["item_id"])
    return lists.select("user_id", "part", F.array_join("members", ",").alias("items"))


@query(
    "AGG-12",
    with_views(
        "ratings",
        """SELECT round(count(*) / count(DISTINCT user_id), 6) AS rows_per_user_id,
           round(count(*) / count(DISTINCT item_id), 6) AS rows_per_item_id FROM ratings""",
    ),
)
def ratings_per_user_and_item(t: Tables) -> DataFrame:
    r = describe.rows_per_distinct(t.ratings, ["user_id", "item_id"])
    return r.select(*[F.round(c, 6).alias(c) for c in r.columns])


@query(
    "AGG-13",
    with_views(
        "ratings",
        """SELECT rating, count(*) AS n, round(count(*) / (SELECT count(*) FROM ratings), 6) AS share
           FROM ratings GROUP BY rating""",
    ),
)
def rating_shares(t: Tables) -> DataFrame:
    return describe.shares(t.ratings, "rating").withColumn("share", F.round("share", 6))


@query(
    "AGG-14",
    """WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS total FROM lineitem),
       binned AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19) AS BIGINT) AS bin
                  FROM lineitem, b),
       c AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin)
       SELECT bin, round(lo + bin * ((hi - lo) / 20), 4) AS "left", n,
              round(n / (total * ((hi - lo) / 20)), 9) AS density FROM c, b""",
)
def price_histogram(t: Tables) -> DataFrame:
    h = describe.histogram(t.lineitem, "l_extendedprice", 20)
    return h.select("bin", F.round("left", 4).alias("left"), "n", F.round("density", 9).alias("density"))


@query(
    "AGG-14",
    with_views(
        "ratings",
        """, per_user AS (SELECT user_id, CAST(count(*) AS DOUBLE) AS n FROM ratings GROUP BY user_id),
        b AS (SELECT min(n) AS lo, max(n) AS hi, count(*) AS total FROM per_user),
        binned AS (SELECT CAST(least(floor((n - lo) / ((hi - lo) / 200)), 199) AS BIGINT) AS bin FROM per_user, b),
        c AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin)
        SELECT bin, round(lo + bin * ((hi - lo) / 200), 4) AS "left", n,
               round(n / (total * ((hi - lo) / 200)), 9) AS density FROM c, b""",
    ),
)
def user_activity_histogram(t: Tables) -> DataFrame:
    per_user = describe.count_by(t.ratings, "user_id")
    h = describe.histogram(per_user, "n", 200)
    return h.select("bin", F.round("left", 4).alias("left"), "n", F.round("density", 9).alias("density"))


@query(
    "AGG-14 FN-11",
    with_views(
        "years",
        """SELECT CAST(CASE WHEN 2000 - year >= 30 THEN 3 WHEN 2000 - year >= 20 THEN 2
                            WHEN 2000 - year >= 10 THEN 1 ELSE 0 END AS BIGINT) AS bin, count(*) AS n
           FROM years WHERE year <> 1900 AND 2000 - year BETWEEN 0 AND 100 GROUP BY 1""",
    ),
)
def item_age_bands(t: Tables) -> DataFrame:
    dated = t.years.where("year <> 1900")  # the year that stands for none
    ages = dated.select(dates.age_in_years(F.col("year"), 2000).alias("age"))
    return describe.edge_histogram(ages, "age", [0, 10, 20, 30, 100])


@query(
    "AGG-15",
    with_views(
        "cells",
        """SELECT CAST(pos AS BIGINT) AS pos, round(avg(x), 6) AS mean, round(min(x), 6) AS "min",
           round(max(x), 6) AS "max", round(var_samp(x), 6) AS variance,
           CAST(count(*) FILTER (WHERE x <> 0) AS BIGINT) AS non_zero FROM cells GROUP BY pos""",
    ),
)
def vector_column_summary(t: Tables) -> DataFrame:
    s = describe.column_summary(t.vectors, "features")
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "min", "max", "variance")]
    return s.select(F.col("pos").cast("long").alias("pos"), *rounded, "non_zero")


@query(
    "AGG-18",
    with_views("ratings", "SELECT user_id, rating, count(*) AS n FROM ratings GROUP BY user_id, rating"),
)
def rating_distribution_per_user(t: Tables) -> DataFrame:
    return describe.count_by(t.ratings, "user_id", "rating")


# ------------------------------------------------- projections, filters, cleaning


@query("PRJ-1", with_views("users", "SELECT user_id, occupation, CAST(trunc(balance) AS BIGINT) AS balance FROM users"))
def user_projection(t: Tables) -> DataFrame:
    return t.users.select("user_id", "occupation", F.col("balance").cast("bigint").alias("balance"))


@query("PRJ-2", with_views("ratings", "SELECT user_id, item_id, rating FROM ratings ORDER BY user_id, item_id LIMIT 10"))
def first_ratings(t: Tables) -> DataFrame:
    return ordering.top(t.ratings.select("user_id", "item_id", "rating"), ["user_id", "item_id"], 10)


@query("PRJ-3", with_views("items", "SELECT item_id, release FROM items WHERE release <> ''"))
def items_with_release(t: Tables) -> DataFrame:
    return t.items.where(F.col("release") != "").select("item_id", "release")


@query("PRJ-4", with_views("ratings", "SELECT user_id, item_id, rating FROM ratings WHERE user_id = 7"))
def ratings_of_one_user(t: Tables) -> DataFrame:
    return t.ratings.where(F.col("user_id") == 7).select("user_id", "item_id", "rating")


@query("PRJ-5 UDF-1", with_views("items years", "SELECT item_id, CAST(year AS INTEGER) AS year FROM years"))
def release_years(t: Tables) -> DataFrame:
    return t.years


@query(
    "PRJ-6 SRC-6",
    """SELECT doc_id AS id, CASE WHEN n_chars % 7 = 0 THEN 0.0 ELSE CAST(n_chars AS DOUBLE) END AS chars
       FROM documents""",
)
def missing_numbers_as_zero(t: Tables) -> DataFrame:
    raw = F.when(F.col("n_chars") % 7 == 0, "?").otherwise(F.col("n_chars").cast("string"))
    return t.documents.select(F.col("doc_id").alias("id"), text.number_or_zero(raw).alias("chars"))


@query(
    "PRJ-7",
    with_views(
        "cells",
        """SELECT id, CAST(count(*) FILTER (WHERE x > 0) AS BIGINT) AS positive, round(sum(greatest(x, 0.0)), 6) AS total
           FROM cells GROUP BY id""",
    ),
)
def clamped_vectors(t: Tables) -> DataFrame:
    clamped = arrays.non_negative(F.col("features"))
    return t.vectors.select(
        "id",
        F.size(F.filter(clamped, lambda x: x > 0)).cast("long").alias("positive"),
        F.round(arrays.total(clamped), 6).alias("total"),
    )


@query("PRJ-8", "SELECT page_id, replace(html, '\"', '') AS html FROM pages")
def pages_without_quotes(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.without_quotes(F.col("html")).alias("html"))


@query(
    "PRJ-9",
    with_views(
        "years",
        """, m AS (SELECT CAST(floor(median(year)) AS INTEGER) AS med FROM years WHERE year <> 1900)
        SELECT item_id, CAST(CASE WHEN year = 1900 THEN med ELSE year END AS INTEGER) AS year, year = 1900 AS imputed
        FROM years, m""",
    ),
)
def imputed_years(t: Tables) -> DataFrame:
    valid = t.years.where(F.col("year") != text.UNKNOWN_YEAR)
    med = ordering.exact_median(valid, "year", "m").select(F.floor("m").cast("int")).scalar()
    marked = t.years.withColumn("imputed", F.col("year") == text.UNKNOWN_YEAR)
    return describe.impute_sentinel(marked, "year", text.UNKNOWN_YEAR, med)


@query(
    "PRJ-9 WIN-2",
    with_views(
        "years",
        """, numbered AS (SELECT item_id, year, row_number() OVER (ORDER BY item_id) - 1 AS position FROM years)
        SELECT CAST(min(position) AS BIGINT) AS first_position, count(*) AS n FROM numbered WHERE year = 1900""",
    ),
)
def sentinel_positions(t: Tables) -> DataFrame:
    numbered = ordering.global_index(t.years, ["item_id"], "position")
    return numbered.where(F.col("year") == text.UNKNOWN_YEAR).agg(
        F.min("position").alias("first_position"), F.count(F.lit(1)).alias("n")
    )


@query(
    "PRJ-10",
    with_views(
        "ratings",
        "SELECT user_id, item_id, CAST(CASE WHEN rating < 3 THEN 0 ELSE 1 END AS INTEGER) AS signal FROM ratings",
    ),
)
def implicit_signal(t: Tables) -> DataFrame:
    return t.ratings.select("user_id", "item_id", numeric.to_signal(F.col("rating"), 3).alias("signal"))


# --------------------------------------------------------------- scalar functions


@query(
    "FN-1",
    """WITH toks AS (
         SELECT doc_id AS id, CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' OR text IS NULL THEN []
                                   ELSE string_split(rtrim(text, ' '), ' ') END AS tokens FROM documents)
       SELECT id, len(tokens) AS tokens, len(list_filter(tokens, lambda w: w = '')) AS empty FROM toks""",
)
def space_tokens(t: Tables) -> DataFrame:
    toks = F.coalesce(text.split_on_space(F.col("text")), F.array().cast("array<string>"))
    return t.lines.select(
        "id",
        F.size(toks).cast("long").alias("tokens"),
        F.size(F.filter(toks, lambda w: w == "")).cast("long").alias("empty"),
    )


@query(
    "FN-3 FN-4 FN-5 FN-7",
    with_views(
        "items",
        r"""SELECT item_id, trim(regexp_replace(raw_title, '\(\d+\)', '')) AS title,
            trim(regexp_replace(raw_title, '\(\w+\).*', '')) AS short_title,
            regexp_replace(raw_title, '[,():]', '', 'g') AS bare, right(raw_title, 5) AS tail FROM items""",
    ),
)
def title_rules(t: Tables) -> DataFrame:
    raw = F.col("raw_title")
    return t.items.select(
        "item_id",
        text.title_without_year(raw).alias("title"),
        text.title_before_bracket(raw).alias("short_title"),
        text.without_title_marks(raw).alias("bare"),
        text.last_chars(raw, 5).alias("tail"),
    )


@query(
    "FN-6",
    with_views(
        "items",
        "SELECT item_id, array_to_string(string_split(regexp_replace(raw_title, '[,():]', '', 'g'), ' '), '|') AS tokens FROM items",
    ),
)
def joined_title_tokens(t: Tables) -> DataFrame:
    tokens = text.split_on_space(text.without_title_marks(F.col("raw_title")))
    return t.items.select("item_id", text.joined(tokens, "|").alias("tokens"))


@query(
    "FN-8",
    with_views(
        "ratings",
        """SELECT printf('%.2f', avg(rating)) AS mean_rating, printf('%.4f', count(*) / count(DISTINCT user_id)) AS per_user
           FROM ratings""",
    ),
)
def formatted_rating_stats(t: Tables) -> DataFrame:
    return t.ratings.agg(
        numeric.fixed_decimals(F.avg("rating"), 2).alias("mean_rating"),
        numeric.fixed_decimals(F.count(F.lit(1)) / F.count_distinct("user_id"), 4).alias("per_user"),
    )


@query(
    "FN-9 FN-10",
    """WITH h AS (SELECT CAST(hour(ts) AS INTEGER) AS hour FROM events)
       SELECT hour, CASE WHEN hour BETWEEN 7 AND 11 THEN 'morning' WHEN hour BETWEEN 12 AND 13 THEN 'lunch'
                         WHEN hour BETWEEN 14 AND 17 THEN 'afternoon' WHEN hour BETWEEN 18 AND 22 THEN 'evening'
                         ELSE 'night' END AS part, count(*) AS n
       FROM h GROUP BY 1, 2""",
)
def events_by_part_of_day(t: Tables) -> DataFrame:
    hour = dates.hour_of_day(dates.epoch_seconds(F.col("ts")))
    by_hour = describe.count_by(t.events.select(hour.alias("hour")), "hour")
    return by_hour.select("hour", dates.part_of_day(F.col("hour")).alias("part"), "n")


@query(
    "FN-11",
    with_views("years", "SELECT CAST(2000 - year AS INTEGER) AS age, count(*) AS n FROM years WHERE year <> 1900 GROUP BY 1"),
)
def item_ages(t: Tables) -> DataFrame:
    valid = t.years.where(F.col("year") != text.UNKNOWN_YEAR)
    return describe.count_by(valid.select(dates.age_in_years(F.col("year"), 2000).alias("age")), "age")


@query(
    "FN-12",
    """SELECT l_returnflag AS flag, round(avg(ln(l_extendedprice)), 6) AS mean_log,
       round(avg(sqrt(l_extendedprice)), 6) AS mean_sqrt, round(avg(exp(l_discount)), 6) AS mean_exp,
       round(avg(abs(l_quantity - 25)), 6) AS mean_abs, round(avg(pow(l_tax, 2)), 6) AS mean_square
       FROM lineitem GROUP BY 1""",
)
def math_transforms(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    return t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.round(F.avg(F.ln(price)), 6).alias("mean_log"),
        F.round(F.avg(F.sqrt(price)), 6).alias("mean_sqrt"),
        F.round(F.avg(F.exp("l_discount")), 6).alias("mean_exp"),
        F.round(F.avg(F.abs(F.col("l_quantity") - 25)), 6).alias("mean_abs"),
        F.round(F.avg(F.pow("l_tax", F.lit(2))), 6).alias("mean_square"),
    )


@query(
    "FN-13 FN-14 FN-15",
    with_views(
        "cells",
        """, q AS (SELECT pos, x AS y FROM cells WHERE id = 0)
        SELECT id, round(sum(x * y), 6) AS dot, round(sqrt(sum(x * x)), 6) AS norm,
               round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 6) AS cosine,
               round(sqrt(sum((x - y) * (x - y))), 6) AS distance, round(sum((x - y) * (x - y)), 6) AS squared
        FROM cells JOIN q USING (pos) GROUP BY id""",
    ),
)
def vector_arithmetic(t: Tables) -> DataFrame:
    probe = t.vectors.where(F.col("id") == 0).select("features").scalar()
    v = t.vectors.withColumn("q", probe)
    f, q = F.col("features"), F.col("q")
    return v.select(
        "id",
        F.round(arrays.dot(f, q), 6).alias("dot"),
        F.round(arrays.norm(f), 6).alias("norm"),
        F.round(arrays.cosine(f, q), 6).alias("cosine"),
        F.round(arrays.distance(f, q), 6).alias("distance"),
        F.round(arrays.squared_distance(f, q), 6).alias("squared"),
    )


@query(
    "FN-16",
    """WITH raw AS (SELECT l_orderkey, l_linenumber, l_quantity AS a, l_discount * 100 AS b, l_tax * 100 AS c FROM lineitem)
       SELECT l_linenumber AS line, round(sum(a / sqrt(a*a + b*b + c*c)), 4) AS a, round(sum(b / sqrt(a*a + b*b + c*c)), 4) AS b,
              round(sum(c / sqrt(a*a + b*b + c*c)), 4) AS c FROM raw GROUP BY 1""",
)
def unit_vectors(t: Tables) -> DataFrame:
    v = F.array("l_quantity", F.col("l_discount") * 100, F.col("l_tax") * 100)
    units = t.lineitem.select(F.col("l_linenumber").alias("line"), arrays.unit(v).alias("u"))
    return units.groupBy("line").agg(*[F.round(F.sum(F.col("u")[i]), 4).alias(n) for i, n in enumerate("abc")])


@query(
    "FN-17",
    with_views(
        "cells",
        """SELECT id, bool_and(abs(abs(x) - abs(-x)) <= 0.000001) AS mirrored,
           bool_and(abs(abs(x) - abs(x + 0.01)) <= 0.000001) AS shifted FROM cells GROUP BY id""",
    ),
)
def equal_up_to_sign(t: Tables) -> DataFrame:
    f = F.col("features")
    return t.vectors.select(
        "id",
        arrays.same_up_to_sign(f, F.transform(f, lambda x: -x)).alias("mirrored"),
        arrays.same_up_to_sign(f, F.transform(f, lambda x: x + 0.01)).alias("shifted"),
    )


@query(
    "FN-18",
    """SELECT vec_id AS id, round(list_sum(list_transform(embedding[1:3] || embedding[62:64], lambda x: CAST(x AS DOUBLE))), 6) AS ends,
       list_contains(list_transform(embedding, lambda x: x > 0.3), true) AS has_large FROM embeddings""",
)
def sliced_vectors(t: Tables) -> DataFrame:
    f = F.col("features")
    ends = F.concat(F.slice(f, 1, 3), F.slice(f, 62, 3))
    large = F.array_contains(F.transform(f, lambda x: x > 0.3), True)
    return t.vectors.select("id", F.round(arrays.total(ends), 6).alias("ends"), large.alias("has_large"))


@query(
    "FN-19 SRC-14",
    """SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1""",
)
def map_lookup(t: Tables) -> DataFrame:
    props = F.from_json("value", "map<string,bigint>")
    inverted = F.map_from_entries(F.transform(F.map_entries(props), lambda e: F.struct(e["value"], e["key"])))
    return t.messages.where(inverted[props["k"]] == "k").groupBy(props["k"].alias("k")).agg(
        F.count(F.lit(1)).alias("n")
    )


# ------------------------------------------------------- sorting, windows, sets


@query(
    "SRT-1",
    with_views(
        "ratings",
        """, c AS (SELECT item_id, count(*) AS n FROM ratings GROUP BY item_id)
        SELECT item_id, n, CAST(row_number() OVER (ORDER BY n DESC, item_id) - 1 AS BIGINT) AS place FROM c""",
    ),
)
def items_by_popularity(t: Tables) -> DataFrame:
    counts = describe.count_by(t.ratings, "item_id")
    return ordering.global_index(counts, [F.desc("n"), "item_id"], "place")


@query(
    "SRT-2 WIN-1 SET-1",
    with_views(
        "users",
        """SELECT zip, CAST(row_number() OVER (ORDER BY zip) - 1 AS BIGINT) AS idx FROM (SELECT DISTINCT zip FROM users)""",
    ),
)
def sorted_distinct_zips(t: Tables) -> DataFrame:
    return ordering.global_index(t.users.select("zip").distinct(), ["zip"])


@query(
    "SRT-3",
    with_views(
        "ratings",
        """SELECT user_id, item_id, rating, ts FROM ratings ORDER BY rating DESC, ts DESC, user_id, item_id LIMIT 20""",
    ),
)
def top_ratings(t: Tables) -> DataFrame:
    return ordering.top(
        t.ratings.select("user_id", "item_id", "rating", "ts"),
        [F.desc("rating"), F.desc("ts"), "user_id", "item_id"],
        20,
    )


@query(
    "SRT-5 JN-4",
    with_views(
        "ratings items",
        """, ranked AS (SELECT user_id, item_id, rating,
               row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM ratings)
        SELECT user_id, rank, item_id, raw_title, rating FROM ranked JOIN items USING (item_id) WHERE rank <= 10""",
    ),
)
def favourites_of_each_user(t: Tables) -> DataFrame:
    best = ordering.top_per_key(t.ratings, ["user_id"], [F.desc("rating"), "item_id"], 10)
    titled = best.join(t.items.select("item_id", "raw_title"), "item_id")
    return titled.select("user_id", F.col("rank").cast("long").alias("rank"), "item_id", "raw_title", "rating")


@query(
    "WIN-2",
    """SELECT l_orderkey, CAST(min(idx) AS BIGINT) AS first_idx, CAST(max(idx) AS BIGINT) AS last_idx FROM (
         SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) - 1 AS idx FROM lineitem) GROUP BY 1""",
)
def line_index_per_order(t: Tables) -> DataFrame:
    numbered = ordering.global_index(t.lineitem.select("l_orderkey"), ["l_orderkey"])
    return numbered.groupBy("l_orderkey").agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"))


@query(
    "WIN-3",
    """WITH d AS (SELECT CAST(epoch(o_orderdate) AS BIGINT) // 86400 AS day,
                         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
                  FROM orders GROUP BY 1)
       SELECT day, CAST(sum(cents) OVER (ORDER BY day) AS BIGINT) AS running FROM d""",
)
def running_daily_spend(t: Tables) -> DataFrame:
    day = dates.day_number(F.col("o_orderdate"))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    daily = t.orders.groupBy(day.alias("day")).agg(F.sum(cents).alias("cents"))
    return ordering.running_sum(daily, ["day"], {"running": "cents"}).select("day", "running")


@query("SET-1", with_views("ratings", "SELECT DISTINCT user_id FROM ratings"))
def rating_users(t: Tables) -> DataFrame:
    return t.ratings.select("user_id").distinct()


@query(
    "SET-2",
    """SELECT 'orders' AS source, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders
       UNION ALL SELECT 'lineitem', count(*), round(avg(l_extendedprice), 4) FROM lineitem
       UNION ALL SELECT 'part', count(*), round(avg(p_retailprice), 4) FROM part""",
)
def stacked_metrics(t: Tables) -> DataFrame:
    def metric(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(column), 4).alias("mean")).select(
            F.lit(name).alias("source"), "n", "mean"
        )

    return (
        metric(t.orders, "o_totalprice", "orders")
        .unionByName(metric(t.lineitem, "l_extendedprice", "lineitem"))
        .unionByName(metric(t.part, "p_retailprice", "part"))
    )
