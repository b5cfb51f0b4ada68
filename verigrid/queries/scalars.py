"""Typing, predicates, scalar functions (PRJ*, FN*, SRC14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from verigrid.functions import dates, geometry, identity, text, typing
from verigrid.queries.registry import query


def money(name: str):
    return F.col(name).cast("decimal(18,2)")


@query(
    "prj01",
    """
    WITH raw AS (
        SELECT event_id, CASE event_type WHEN 'error' THEN '  '
            WHEN 'signup' THEN concat('n/a ', props) ELSE json_extract_string(props, '$.k') END AS k_raw,
            CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN '-12.50'
                ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS amount_raw
        FROM events)
    SELECT event_id, k_raw, TRY_CAST(NULLIF(TRIM(k_raw), '') AS INTEGER) AS k,
        CASE WHEN NULLIF(TRIM(k_raw), '') IS NULL THEN 'MISSING'
             WHEN TRY_CAST(k_raw AS INTEGER) IS NULL THEN 'UNPARSEABLE'
             WHEN TRY_CAST(k_raw AS INTEGER) < 5 OR TRY_CAST(k_raw AS INTEGER) > 90 THEN 'OUT_OF_RANGE'
             ELSE 'VALID' END AS k_status,
        TRY_CAST(amount_raw AS DECIMAL(18,2)) AS amount,
        CASE WHEN amount_raw IS NULL THEN 'MISSING' WHEN TRY_CAST(amount_raw AS DECIMAL(18,2)) < 0 THEN 'NEGATIVE'
             ELSE 'VALID' END AS amount_status
    FROM raw""",
)
def prj01(t):
    kind = F.col("event_type")
    raw = t.events.select(
        "event_id",
        F.when(kind == "error", "  ")
        .when(kind == "signup", F.concat(F.lit("n/a "), "props"))
        .otherwise(F.get_json_object("props", "$.k"))
        .alias("k_raw"),
        F.when(kind == "signup", "-12.50")
        .when(kind != "error", money("value").cast("string"))
        .alias("amount_raw"),
    )
    k, k_status = typing.typed(F.col("k_raw"), "int", 5, 90)
    amount, amount_status = typing.typed(F.col("amount_raw"), "decimal(18,2)", 0, below="NEGATIVE")
    return raw.select(
        "event_id", "k_raw", k.alias("k"), k_status.alias("k_status"),
        amount.alias("amount"), amount_status.alias("amount_status"),
    )


@query(
    "prj02",
    """
    WITH p AS (
        SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN NULL ELSE c_acctbal / 500 END AS lat,
            CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 110 + c_nationkey * 1.0 END AS lon FROM customer)
    SELECT c_custkey, CASE WHEN lat IS NULL AND lon IS NULL THEN 'MISSING_PAIR'
        WHEN lat IS NULL OR lon IS NULL THEN 'PARTIAL_PAIR'
        WHEN NOT (lat >= 4 AND lat <= 18 AND lon >= 112 AND lon <= 130) THEN 'OUT_OF_RANGE'
        ELSE 'VALID_PAIR' END AS coordinate_status FROM p""",
)
def prj02(t):
    segment = F.col("c_mktsegment")
    points = t.customer.select(
        "c_custkey",
        F.when(~segment.isin("BUILDING", "FURNITURE"), F.col("c_acctbal") / 500).alias("lat"),
        F.when(segment != "BUILDING", 110 + F.col("c_nationkey") * 1.0).alias("lon"),
    )
    status = typing.coordinate_status(F.col("lat"), F.col("lon"), (4, 18, 112, 130))
    return points.select("c_custkey", status.alias("coordinate_status"))


@query(
    "prj03",
    r"""SELECT p_partkey, regexp_replace(upper(trim(concat('  ', p_name, '   ', p_type, chr(9), p_brand, ' '))), '\s+', ' ', 'g') AS name_standardized
        FROM part""",
)
def prj03(t):
    raw = F.concat(F.lit("  "), "p_name", F.lit("   "), "p_type", F.lit("\t"), "p_brand", F.lit(" "))
    return t.part.select("p_partkey", text.standardize(raw).alias("name_standardized"))


@query(
    "prj04",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'OPEN' ELSE 'OTHER' END AS order_state
       FROM orders""",
)
def prj04(t):
    state = typing.decode(F.col("o_orderstatus"), {"F": "FINISHED", "O": "OPEN"}, "OTHER")
    return t.orders.select("o_orderkey", state.alias("order_state"))


@query(
    "prj07",
    """SELECT l_orderkey, CAST(COUNT(DISTINCT l_returnflag) AS BIGINT) AS flag_count,
         CASE WHEN COUNT(DISTINCT l_returnflag) = 1 THEN MAX(l_returnflag) END AS return_flag
       FROM lineitem GROUP BY l_orderkey""",
)
def prj07(t):
    flags = t.lineitem.groupBy("l_orderkey").agg(
        F.countDistinct("l_returnflag").alias("flag_count"), F.max("l_returnflag").alias("flag")
    )
    return flags.select(
        "l_orderkey", "flag_count",
        typing.publish_if_single(F.col("flag"), F.col("flag_count")).alias("return_flag"),
    )


@query(
    "prj08",
    """
    WITH coded AS (
        SELECT c_custkey, concat(lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0'), lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0'),
               lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')) AS code FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT c_custkey, code, concat(substr(code, 1, 2), '00000000') AS region_code, concat(substr(code, 1, 5), '00000') AS area_code FROM coded""",
)
def prj08(t):
    coded = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        F.concat(
            F.lpad((F.col("n_regionkey") + 1).cast("string"), 2, "0"),
            F.lpad((F.col("n_nationkey") + 1).cast("string"), 3, "0"),
            F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0"),
        ).alias("code"),
    )
    code = F.col("code")
    return coded.select(
        "c_custkey", "code",
        typing.parent_code(code, 2, 10).alias("region_code"),
        typing.parent_code(code, 5, 10).alias("area_code"),
    )


@query(
    "prj09",
    r"""
    SELECT CAST(COUNT(*) AS BIGINT) AS orders,
        CAST(COUNT(*) FILTER (WHERE regexp_matches(o_orderpriority, '^[0-9]-[A-Z]+$')) AS BIGINT) AS one_word_priority,
        CAST(COUNT(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS BIGINT) AS known_status,
        CAST(COUNT(*) FILTER (WHERE o_totalprice BETWEEN 1000 AND 100000) AS BIGINT) AS mid_price,
        CAST(COUNT(*) FILTER (WHERE starts_with(o_orderpriority, '1')) AS BIGINT) AS urgent,
        CAST(COUNT(*) FILTER (WHERE instr(o_orderpriority, 'SPECIFIED') > 0) AS BIGINT) AS not_specified
    FROM orders""",
)
def prj09(t):
    priority = F.col("o_orderpriority")
    return t.orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(priority.rlike("^[0-9]-[A-Z]+$")).alias("one_word_priority"),
        F.count_if(F.col("o_orderstatus").isin("F", "O")).alias("known_status"),
        F.count_if(F.col("o_totalprice").between(1000, 100000)).alias("mid_price"),
        F.count_if(priority.startswith("1")).alias("urgent"),
        F.count_if(F.instr(priority, "SPECIFIED") > 0).alias("not_specified"),
    )


@query(
    "fn01",
    """
    WITH raw AS (SELECT p_partkey, concat(' ', replace(p_name, ' ', ' , '), ',', p_type, ', ,', lower(p_type), ', ', p_type) AS listed FROM part)
    SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(listed, ','), lambda x: trim(x)), lambda x: x <> ''))), '|') AS tokens
    FROM raw""",
)
def fn01(t):
    listed = F.concat(
        F.lit(" "), F.regexp_replace("p_name", " ", " , "), F.lit(","), "p_type", F.lit(", ,"),
        F.lower("p_type"), F.lit(", "), "p_type",
    )
    return t.part.select("p_partkey", F.array_join(text.tokens(listed), "|").alias("tokens"))


FN02_NAMES = r"""
    SELECT p_partkey, concat(CASE WHEN p_size < 15 THEN 'STO. ' WHEN p_size < 25 THEN 'ST ' WHEN p_size < 35 THEN 'STA ' ELSE '' END,
        replace(upper(p_name), ' ', CASE WHEN p_size > 40 THEN '-' ELSE '  ' END), ' ', CAST(p_size AS VARCHAR),
        CASE WHEN p_type = 'PROMO' THEN '¹²' WHEN p_type = 'LARGE' THEN ' **' ELSE '' END) AS name FROM part"""

#: Words put together, a blank left only where a letter is missing beside it; takes a list of words.
JOIN_WORDS = r"list_reduce(%s, lambda done, word: done || CASE WHEN regexp_matches(right(done, 1), '\p{L}') AND regexp_matches(left(word, 1), '\p{L}') THEN '' ELSE ' ' END || word)"
LONG_WORD = "CASE WHEN w IN ('STO', 'STO.') THEN 'SANTO' WHEN w IN ('STA', 'STA.') THEN 'SANTA' WHEN w IN ('ST', 'ST.') THEN 'SAINT' ELSE w END"

FN02_SQL = f"""
    WITH names AS ({FN02_NAMES}),
    words AS (SELECT p_partkey, name, list_filter(string_split(rtrim(translate(name, '⁰¹²³⁴⁵⁶⁷⁸⁹', ''), ' *'), ' '), lambda w: w <> '') AS words FROM names),
    long AS (SELECT p_partkey, name, list_transform(words, lambda w: replace({LONG_WORD}, '-', '')) AS words FROM words)
    SELECT p_partkey, name, {JOIN_WORDS % 'words'} AS match_key FROM long"""


def place_like_names(t):
    """Part names dressed with abbreviations, separators and footnote marks."""
    size, kind = F.col("p_size"), F.col("p_type")
    prefix = F.when(size < 15, "STO. ").when(size < 25, "ST ").when(size < 35, "STA ").otherwise("")
    upper = F.upper("p_name")
    body = F.when(size > 40, F.regexp_replace(upper, " ", "-")).otherwise(
        F.regexp_replace(upper, " ", "  ")
    )
    mark = F.when(kind == "PROMO", "¹²").when(kind == "LARGE", " **").otherwise("")
    return t.part.select(
        "p_partkey", F.concat(prefix, body, F.lit(" "), size.cast("string"), mark).alias("name")
    )


@query("fn02", FN02_SQL)
def fn02(t):
    names = place_like_names(t)
    return names.select("p_partkey", "name", text.match_key(F.col("name")).alias("match_key"))


@query(
    "fn03",
    rf"""
    WITH names AS ({FN02_NAMES})
    SELECT p_partkey, NULLIF(regexp_replace(regexp_replace(name, '\s*\*+$', ''), '\s*[0-9]+$', ''), '') AS without_footnote FROM names""",
)
def fn03(t):
    return place_like_names(t).select(
        "p_partkey", text.strip_footnote(F.col("name")).alias("without_footnote")
    )


@query(
    "fn04",
    """SELECT s_suppkey, CASE WHEN s_acctbal >= 5000 THEN concat('S', CAST(s_nationkey AS VARCHAR)) ELSE s_name END AS short_name FROM supplier""",
)
def fn04(t):
    label = F.when(
        F.col("s_acctbal") >= 5000,
        F.concat("s_name", F.lit(" (S"), F.col("s_nationkey").cast("string"), F.lit(") ")),
    ).otherwise(F.col("s_name"))
    return t.supplier.select("s_suppkey", text.short_label(label).alias("short_name"))


@query(
    "fn05",
    """SELECT event_id, concat('{"id":', CAST(event_id AS VARCHAR), ',"at":[', CAST(user_id AS VARCHAR), ',-', CAST(user_id AS VARCHAR), '.5],"name":"', event_type, CASE WHEN user_id % 2 = 0 THEN concat(' \\"', CAST(user_id AS VARCHAR), '\\" \\\\') ELSE '' END, '"}') AS json FROM events""",
)
def fn05(t):
    """Every second name holds escaped quotes, a number between them and an escaped backslash."""
    user = F.col("user_id").cast("string")
    more = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit(' \\"'), user, F.lit('\\" \\\\'))).otherwise("")
    quoted = F.concat(
        F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('","at":["'), user,
        F.lit('","-'), user, F.lit('.5"],"name":"'), "event_type", more, F.lit('"}'),
    )
    return t.events.select("event_id", text.unquote_numbers(quoted).alias("json"))


@query(
    "fn06",
    """SELECT p_partkey, CAST(p_size * (p_size + 3) AS DOUBLE) * CASE WHEN p_size % 2 = 0 THEN 1 ELSE -1 END AS signed_area FROM part""",
)
def fn06(t):
    width, height = F.col("p_size").cast("double"), (F.col("p_size") + 3).cast("double")
    zero = F.lit(0.0)
    counter = F.array(
        F.array(zero, zero), F.array(width, zero), F.array(width, height),
        F.array(zero, height), F.array(zero, zero),
    )
    ring = F.when(F.col("p_size") % 2 == 0, counter).otherwise(F.reverse(counter))
    return t.part.select("p_partkey", geometry.ring_area(ring).alias("signed_area"))


@query(
    "fn07",
    """
    WITH d AS (SELECT l_orderkey, MIN(l_shipdate)::DATE AS lo, MAX(l_shipdate)::DATE AS hi, MAX(l_returnflag) AS f FROM lineitem GROUP BY 1),
    p AS (SELECT l_orderkey, CASE WHEN f = 'R' THEN hi ELSE lo END AS start_date, CASE WHEN f = 'A' THEN NULL WHEN f = 'R' THEN lo ELSE hi END AS end_date FROM d)
    SELECT l_orderkey, CASE WHEN start_date IS NULL OR end_date < start_date THEN NULL
        ELSE start_date + INTERVAL 24 MONTH < least(coalesce(end_date, DATE '1999-06-30'), DATE '1999-06-30') END AS long_running FROM p""",
)
def fn07(t):
    spans = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_shipdate").cast("date").alias("lo"),
        F.max("l_shipdate").cast("date").alias("hi"),
        F.max("l_returnflag").alias("flag"),
    )
    swapped = F.col("flag") == "R"
    start = F.when(swapped, F.col("hi")).otherwise(F.col("lo"))
    end = F.when(swapped, F.col("lo")).when(F.col("flag") != "A", F.col("hi"))
    as_of = F.lit("1999-06-30").cast("date")
    return spans.select(
        "l_orderkey", dates.spans_more_than(start, end, as_of, 24).alias("long_running")
    )


@query(
    "fn08",
    """SELECT c_custkey, CAST(floor((c_acctbal / 500) * 10) AS BIGINT) AS cell_lat, CAST(floor((100 + c_acctbal / 300) * 10) AS BIGINT) AS cell_lon FROM customer""",
)
def fn08(t):
    return t.customer.select(
        "c_custkey",
        geometry.grid_cell(F.col("c_acctbal") / 500, 10).alias("cell_lat"),
        geometry.grid_cell(100 + F.col("c_acctbal") / 300, 10).alias("cell_lon"),
    )


@query(
    "fn09",
    """SELECT o_orderkey, sha256(concat('{"o_orderkey":', CAST(o_orderkey AS VARCHAR), ',"o_orderstatus":"', o_orderstatus, '","o_orderpriority":"', o_orderpriority, '"}')) AS content_hash FROM orders""",
)
def fn09(t):
    return t.orders.select(
        "o_orderkey",
        identity.row_hash(["o_orderkey", "o_orderstatus", "o_orderpriority"]).alias("content_hash"),
    )


@query(
    "fn10",
    """SELECT o_orderstatus, sha256(concat_ws('|', CAST(COUNT(*) AS VARCHAR), strftime(MAX(o_orderdate), '%Y-%m-%d'), '', 'map_v2', 'rule_v1')) AS run_id FROM orders GROUP BY o_orderstatus""",
)
def fn10(t):
    return t.orders.groupBy("o_orderstatus").agg(
        identity.run_id(
            F.count(F.lit(1)), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd"),
            F.lit(None), "map_v2", "rule_v1",
        ).alias("run_id")
    )


@query(
    "src14",
    r"""
    WITH raw AS (SELECT p_partkey, concat(CASE WHEN p_type = 'PROMO' THEN 'about ' ELSE '' END,
        CAST((p_size * 1000 + p_partkey) // 1000 AS VARCHAR), ',', lpad(CAST((p_size * 1000 + p_partkey) % 1000 AS VARCHAR), 3, '0'),
        CASE WHEN p_type = 'SMALL' THEN '.5' WHEN p_type = 'LARGE' THEN 'E2' ELSE '' END, ' a') AS cell FROM part),
    hit AS (SELECT p_partkey, cell, replace(regexp_extract(cell, '^-?[0-9,]*\.?[0-9]+([eE][-+]?[0-9]+)?', 0), ',', '') AS n FROM raw)
    SELECT p_partkey, cell, TRY_CAST(NULLIF(n, '') AS DOUBLE) AS number,
        CASE WHEN TRY_CAST(NULLIF(n, '') AS DOUBLE) = floor(TRY_CAST(NULLIF(n, '') AS DOUBLE)) THEN CAST(TRY_CAST(NULLIF(n, '') AS DOUBLE) AS BIGINT) END AS whole_count FROM hit""",
)
def src14(t):
    amount = F.col("p_size") * 1000 + F.col("p_partkey")
    kind = F.col("p_type")
    cell = F.concat(
        F.when(kind == "PROMO", "about ").otherwise(""),
        F.floor(amount / 1000).cast("string"), F.lit(","),
        F.lpad((amount % 1000).cast("string"), 3, "0"),
        F.when(kind == "SMALL", ".5").when(kind == "LARGE", "E2").otherwise(""), F.lit(" a"),
    )
    cells = t.part.select("p_partkey", cell.alias("cell"))
    return cells.select(
        "p_partkey", "cell",
        typing.to_number(F.col("cell")).alias("number"),
        typing.to_count(F.col("cell")).alias("whole_count"),
    )
