"""Joins, dictionaries, encodings, scaling and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import text
from tallyforge.operators import describe, encode, joins, ordering, splits
from tallyforge.plans.registry import query
from tallyforge.plans.views import Tables, with_views

CATEGORIES = ["flag", "status", "priority", "month", "line"]
NUMBERS = ["quantity", "discount", "tax"]

# ------------------------------------------------------------------------- joins


@query(
    "JN-1",
    """SELECT o_orderstatus AS status, count(*) AS n, round(sum(l_quantity), 2) AS quantity
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def lines_by_order_status(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    lines = t.lineitem.select("l_orderkey", "l_quantity")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


def item_mean_predictions(t: Tables) -> DataFrame:
    """A simple deterministic predictor: every item's mean rating, for each observed pair."""
    means = t.ratings.groupBy("item_id").agg(F.avg("rating").alias("predicted"))
    return t.ratings.select("user_id", "item_id").join(means, "item_id")


@query(
    "JN-2 JN-8",
    with_views(
        "ratings",
        """, means AS (SELECT item_id, avg(rating) AS predicted FROM ratings GROUP BY item_id)
        SELECT user_id, item_id, rating AS actual, round(predicted, 6) AS predicted
        FROM ratings JOIN means USING (item_id)""",
    ),
)
def actual_and_predicted(t: Tables) -> DataFrame:
    actual = t.ratings.select("user_id", "item_id", F.col("rating").alias("actual"))
    both = joins.paired(actual, item_mean_predictions(t), ["user_id", "item_id"])
    return both.withColumn("predicted", F.round("predicted", 6))


@query(
    "JN-3 FE-12",
    with_views(
        "ratings users vectors",
        """, numbered AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY item_id, rating) - 1) // 4096 AS part
                     FROM ratings),
        lists AS (SELECT user_id, part, string_agg(item_id || '=' || CAST(rating AS INTEGER), ',' ORDER BY item_id) AS rated
                     FROM numbered GROUP BY user_id, part)
        SELECT u.user_id, u.occupation, u.zip, part, rated, round(features[1], 6) AS first_factor
        FROM users u JOIN lists USING (user_id) JOIN vectors v ON v.id = u.user_id""",
    ),
)
def users_with_ratings_and_factors(t: Tables) -> DataFrame:
    lists = describe.member_lists(t.ratings, "user_id", ["item_id", "rating"])
    rated = F.transform("members", lambda m: F.concat_ws("=", m["item_id"], m["rating"].cast("int")))
    factors = t.vectors.select(F.col("id").alias("user_id"), "features")
    return (
        t.users.join(lists, "user_id")
        .join(factors, "user_id")
        .select(
            "user_id", "occupation", "zip", "part",
            F.array_join(rated, ",").alias("rated"),
            F.round(F.col("features")[0], 6).alias("first_factor"),
        )
    )


@query(
    "FE-12",
    with_views(
        "ratings",
        """SELECT item_id, count(*) AS n, CAST(sum(rating) AS BIGINT) AS total FROM ratings GROUP BY item_id""",
    ),
)
def rating_lists_match_rows(t: Tables) -> DataFrame:
    """Item totals read back from the per-user lists must equal those of the raw rows."""
    lists = describe.member_lists(t.ratings, "user_id", ["item_id", "rating"])
    back = lists.select(F.explode("members").alias("m"))
    return back.groupBy("m.item_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("m.rating").cast("long").alias("total")
    )


@query(
    "JN-4 PRJ-11",
    with_views(
        "items",
        """, names AS (SELECT kind, CAST(row_number() OVER (ORDER BY kind) - 1 AS INTEGER) AS pos
                     FROM (SELECT DISTINCT p_type AS kind FROM part))
        SELECT item_id, coalesce(string_agg(names.kind, '|' ORDER BY pos), '') AS tags
        FROM items LEFT JOIN names ON (p_size >> pos) & 1 = 1 GROUP BY item_id""",
    ),
)
def item_tags(t: Tables) -> DataFrame:
    """Indicator flags to sorted lists of names; an item without flags has an empty list."""
    names = encode.dictionary(t.items, "kind").select(F.col("value").alias("tag"), F.col("idx").alias("pos"))
    places = F.transform("flags", lambda flag, i: F.when(flag == 1, i.cast("long")))
    on = t.items.select("item_id", F.explode_outer(F.array_compact(places)).alias("pos"))
    tagged = joins.lookup_join(on, names, "pos", "left")
    ordered = F.sort_array(F.collect_list(F.when(F.col("tag").isNotNull(), F.struct("pos", "tag"))))
    return tagged.groupBy("item_id").agg(
        F.array_join(F.transform(ordered, lambda p: p["tag"]), "|").alias("tags")
    )


@query(
    "JN-7 SET-3",
    with_views(
        "ratings",
        """SELECT user_id, item_id FROM ratings r
           WHERE NOT EXISTS (SELECT 1 FROM ratings t WHERE t.user_id = r.user_id AND t.item_id = r.item_id
                             AND t.rating >= 4)""",
    ),
)
def ratings_without_liked(t: Tables) -> DataFrame:
    liked = t.ratings.where(F.col("rating") >= 4)
    return joins.without_keys(t.ratings.select("user_id", "item_id"), liked, ["user_id", "item_id"])


# -------------------------------------------------------------------- dictionaries


@query(
    "FE-1 WIN-1",
    with_views(
        "rentals",
        """SELECT priority, CAST(row_number() OVER (ORDER BY priority) - 1 AS BIGINT) AS idx
           FROM (SELECT DISTINCT priority FROM rentals)""",
    ),
)
def priority_dictionary(t: Tables) -> DataFrame:
    return encode.dictionary(t.rentals, "priority", "priority")


@query(
    "FE-2",
    with_views(
        "users",
        """, d AS (SELECT occupation, row_number() OVER (ORDER BY occupation) - 1 AS idx,
                        count(*) OVER () AS k FROM (SELECT DISTINCT occupation FROM users))
        SELECT user_id, array_to_string(list_transform(range(0, k), lambda i: CAST(i = idx AS INTEGER)), '') AS code
        FROM users JOIN d USING (occupation)""",
    ),
)
def occupation_one_hot(t: Tables) -> DataFrame:
    d = encode.dictionary(t.users, "occupation")
    coded = encode.with_index(t.users, d, "occupation", "i")
    bits = F.transform(encode.hot(F.col("i"), d.count()), lambda x: x.cast("int").cast("string"))
    return coded.select("user_id", F.array_join(bits, "").alias("code"))


_RENTAL_DICTS = ", ".join(
    f"""d_{c} AS (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS i_{c},
                         count(*) OVER () AS k_{c} FROM (SELECT DISTINCT {c} FROM rentals))"""
    for c in CATEGORIES
)


@query(
    "FE-3",
    with_views(
        "rentals",
        f""", {_RENTAL_DICTS}
        SELECT flag, status, priority, month, line, i_flag || ',' || (k_flag + i_status) || ',' ||
               (k_flag + k_status + i_priority) || ',' || (k_flag + k_status + k_priority + i_month) || ',' ||
               (k_flag + k_status + k_priority + k_month + i_line) AS hot,
               CAST(k_flag + k_status + k_priority + k_month + k_line + 3 AS INTEGER) AS width, count(*) AS n,
               round(sum(quantity), 2) AS quantity, round(sum(discount), 2) AS discount, round(sum(tax), 2) AS tax
        FROM rentals JOIN d_flag USING (flag) JOIN d_status USING (status) JOIN d_priority USING (priority)
             JOIN d_month USING (month) JOIN d_line USING (line) GROUP BY ALL""",
    ),
)
def rental_encoding(t: Tables) -> DataFrame:
    encoder = encode.MixedEncoder(CATEGORIES, NUMBERS).fit(t.rentals)
    rows = encoder.positions(t.rentals)
    return rows.groupBy(
        *CATEGORIES, F.array_join("hot", ",").alias("hot"), F.lit(encoder.width).alias("width")
    ).agg(F.count(F.lit(1)).alias("n"), *[F.round(F.sum(n), 2).alias(n) for n in NUMBERS])


@query(
    "FE-3 FE-5",
    with_views(
        "labelled",
        """, d AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS idx, count(*) OVER () AS k
                 FROM (SELECT DISTINCT category FROM labelled))
        SELECT id, label, array_to_string(list_transform(range(0, k), lambda i: CAST(i = idx AS INTEGER)), '') AS code,
               x0, x1, x2, x3 FROM labelled JOIN d USING (category)""",
    ),
)
def category_and_numbers(t: Tables) -> DataFrame:
    rows = t.labelled.select("id", "label", "category", *[F.col("numbers")[i].alias(f"x{i}") for i in range(4)])
    encoder = encode.MixedEncoder(["category"], ["x0", "x1", "x2", "x3"]).fit(rows)
    k = encoder.category_width
    wide = encoder.dense_features(rows)
    bits = F.transform(F.slice("features", 1, k), lambda x: x.cast("int").cast("string"))
    tail = [F.col("features")[k + i].alias(f"x{i}") for i in range(4)]
    return wide.select("id", "label", F.array_join(bits, "").alias("code"), *tail)


@query(
    "FE-4",
    with_views(
        "rentals",
        """SELECT CAST(line AS DOUBLE) AS line, CAST(month AS DOUBLE) AS month, count(*) AS n,
                  round(sum(quantity), 2) AS quantity FROM rentals GROUP BY 1, 2""",
    ),
)
def ordinal_rentals(t: Tables) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    raw = t.rentals.withColumns({c: F.col(c).cast("double") for c in ("line", "month")})
    v = encode.ordinal_features(raw, ["line", "month", *NUMBERS]).select(vector_to_array("features").alias("f"))
    return v.groupBy(F.col("f")[0].alias("line"), F.col("f")[1].alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("f")[2]), 2).alias("quantity")
    )



_TERMS_SQL = """, toks AS (SELECT item_id, unnest(string_split(regexp_replace(raw_title, '[,():]', '', 'g'), ' ')) AS term FROM items),
    terms AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS idx FROM (SELECT DISTINCT term FROM toks))"""


@query("FE-6 UDF-2", with_views("items", _TERMS_SQL + "SELECT term, idx FROM terms"))
def title_terms(t: Tables) -> DataFrame:
    tokens = text.split_on_space(text.without_title_marks(F.col("raw_title")))
    return encode.term_dictionary(t.items, tokens).withColumnRenamed("value", "term")


@query(
    "FE-7",
    with_views(
        "items",
        _TERMS_SQL
        + """SELECT item_id, coalesce(string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx), '') AS terms
             FROM (SELECT DISTINCT items.item_id, idx FROM items LEFT JOIN toks USING (item_id) LEFT JOIN terms USING (term))
             GROUP BY item_id""",
    ),
)
def title_vectors(t: Tables) -> DataFrame:
    tokens = text.split_on_space(text.without_title_marks(F.col("raw_title")))
    bags = encode.bag_of_terms(t.items, "item_id", tokens, encode.term_dictionary(t.items, tokens))
    return bags.select("item_id", F.array_join("terms", ",").alias("terms"))


@query(
    "FE-6",
    r"""WITH toks AS (SELECT DISTINCT unnest(string_split_regex(lower(text), '\W+')) AS term FROM documents)
        SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS idx FROM toks WHERE term <> ''""",
)
def document_terms(t: Tables) -> DataFrame:
    return encode.term_dictionary(t.lines, text.words(F.col("text"))).withColumnRenamed("value", "term")


@query(
    "FE-8",
    with_views(
        "cells",
        """, s AS (SELECT pos, avg(x) AS m, stddev_samp(x) AS sd FROM cells GROUP BY pos)
        SELECT id, round(sum((x - m) / sd * (pos + 1)), 4) AS checksum, round(max((x - m) / sd), 5) AS largest
        FROM cells JOIN s USING (pos) GROUP BY id""",
    ),
)
def standardised_vectors(t: Tables) -> DataFrame:
    scaler = encode.fit_scaler(t.vectors, "features")
    weights = F.transform(F.sequence(F.lit(1), F.size("scaled")), lambda i: i.cast("double"))
    from tallyforge.functions.arrays import dot

    return encode.scaled(t.vectors, scaler, "features").select(
        "id",
        F.round(dot(F.col("scaled"), weights), 4).alias("checksum"),
        F.round(F.array_max("scaled"), 5).alias("largest"),
    )


@query(
    "FE-8",
    with_views(
        "cells",
        """, s AS (SELECT pos, avg(x) AS m FROM cells GROUP BY pos)
        SELECT id, round(sqrt(sum((x - m) * (x - m))), 6) AS length FROM cells JOIN s USING (pos) GROUP BY id""",
    ),
)
def centred_vectors(t: Tables) -> DataFrame:
    from tallyforge.functions.arrays import norm

    centred = encode.scaled(t.vectors, encode.fit_scaler(t.vectors, "features", with_std=False), "features")
    return centred.select("id", F.round(norm(F.col("scaled")), 6).alias("length"))


@query(
    "FE-9",
    with_views(
        "rentals",
        """SELECT flag, round(avg(ln(target)), 6) AS mean_log, round(avg(sqrt(target)), 5) AS mean_sqrt,
                  round(exp(avg(ln(target))), 3) AS back_log, round(pow(avg(sqrt(target)), 2), 3) AS back_sqrt
           FROM rentals GROUP BY flag""",
    ),
)
def transformed_targets(t: Tables) -> DataFrame:
    from tallyforge.operators.linear import TRANSFORMS

    log, root = TRANSFORMS["log"], TRANSFORMS["sqrt"]
    target = F.col("target")
    means = t.rentals.groupBy("flag").agg(
        F.avg(log.forward(target)).alias("a"), F.avg(root.forward(target)).alias("b")
    )
    return means.select(
        "flag",
        F.round("a", 6).alias("mean_log"),
        F.round("b", 5).alias("mean_sqrt"),
        F.round(log.inverse(F.col("a")), 3).alias("back_log"),
        F.round(root.inverse(F.col("b")), 3).alias("back_sqrt"),
    )


# -------------------------------------------------------------------------- splits

_HASH = "CAST(('0x' || substr(md5('{seed}:' || user_id || ':' || item_id), 1, 8)) AS BIGINT) % 100"


@query(
    "FE-10",
    with_views(
        "ratings",
        f"""SELECT user_id, item_id, CAST(CASE WHEN {_HASH.format(seed=123)} < 60 THEN 0 ELSE 1 END AS INTEGER) AS part
            FROM ratings""",
    ),
)
def hashed_split(t: Tables) -> DataFrame:
    keyed = t.ratings.select("user_id", "item_id")
    return splits.hash_split(keyed, ["user_id", "item_id"], [60, 40], seed=123)


@query(
    "FE-11",
    with_views(
        "ratings",
        f"""SELECT CASE WHEN {_HASH.format(seed=42)} < 20 THEN 'test' ELSE 'train' END AS part, count(*) AS n,
                   CAST(sum(rating) AS BIGINT) AS total FROM ratings GROUP BY 1""",
    ),
)
def sample_and_complement(t: Tables) -> DataFrame:
    test, train = splits.sample_and_rest(t.ratings, ["user_id", "item_id"], 20, seed=42)
    both = test.withColumn("part", F.lit("test")).unionByName(train.withColumn("part", F.lit("train")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").cast("long").alias("total"))


@query(
    "WIN-4 TUN-3",
    with_views(
        "ratings",
        """, s AS (SELECT user_id, item_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS seq FROM ratings),
        c AS (SELECT user_id, item_id, row_number() OVER (ORDER BY ts, item_id, user_id) AS g FROM s WHERE seq BETWEEN 1 AND 10)
        SELECT user_id, item_id, coalesce(g <= 5000, false) AS is_test FROM s LEFT JOIN c USING (user_id, item_id)""",
    ),
)
def leave_ten_out(t: Tables) -> DataFrame:
    r = t.ratings.select("user_id", "item_id", "ts")
    out = splits.leave_out(r, "user_id", ["ts", "item_id", "user_id"], 1, 10, max_test=5000)
    return out.select("user_id", "item_id", "is_test")


@query(
    "WIN-4",
    with_views(
        "ratings",
        """SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS seq FROM ratings""",
    ),
)
def rating_sequence(t: Tables) -> DataFrame:
    numbered = splits.sequence_per_user(t.ratings.select("user_id", "item_id", "ts"), "user_id", ["ts", "item_id"])
    return numbered.select("user_id", "item_id", "seq")


@query(
    "WIN-5 TUN-3",
    with_views(
        "ratings",
        """, s AS (SELECT user_id, item_id, row_number() OVER (ORDER BY ts, user_id, item_id) - 1 AS idx,
                        count(*) OVER () AS n FROM ratings)
        SELECT user_id, item_id, CAST(idx * 5 // n AS INTEGER) AS fold FROM s""",
    ),
)
def five_folds(t: Tables) -> DataFrame:
    r = t.ratings.select("user_id", "item_id", "ts")
    return splits.consecutive_folds(r, ["ts", "user_id", "item_id"], 5).select("user_id", "item_id", "fold")
