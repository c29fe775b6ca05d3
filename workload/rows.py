"""Cleaning, columns, lookups, set operations and files."""

from __future__ import annotations

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.scalar import convert, file_stem, map_code, normalize_name, total_seconds
from seriesmill.functions.metrics import mean_abs_dev
from seriesmill.operators import clean, columns, lookups
from seriesmill.operators.blocks import long_series
from seriesmill.operators.windows import RollingSpec, rolling
from seriesmill.plans.preparation import Step, build_features, default_features, plot_series, preprocess
from seriesmill.schema import LABELS, FillRule
from seriesmill.sources import files
from workload.tables import labels, measurements, neat, query, rounded, scratch, table, with_m
from workload.windows import BLOCK_ROWS

LABELS_SQL = "lab AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'OD' ELSE 'ID' END AS target FROM labels)"
MARKED_SQL = """marked AS (SELECT m.*, CASE lab.target WHEN 'OD' THEN 0 WHEN 'ID' THEN 1 ELSE -1 END AS target
               FROM m LEFT JOIN lab USING (id))"""
GROW = "OVER (PARTITION BY id ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

# ---------------------------------------------------------------- whole pipeline

# Bounds, infinities and the first 300 gaps of a channel; no series here has more gaps.
CLEAN_SQL = """clean AS (SELECT id, time, kind, least(greatest(coalesce(ch0, 0), 0), 1000) AS ch0,
                         least(greatest(ch1, 0), 1000) AS ch1, least(greatest(ch2, 0), 1000) AS ch2 FROM m)"""
_MEDIAN = "(PARTITION BY id ORDER BY time ROWS BETWEEN 119 PRECEDING AND CURRENT ROW)"


def recordings(spark, sf_dir, *more):
    return measurements(spark, sf_dir).select("id", "time", "ch0", "ch1", "ch2", *more)


@query("flagship", with_m("""
    SELECT target, count(*) AS n, round(avg(med), 4) + 0.0 AS median_ch0
    FROM (SELECT c.id, median(CAST(c.ch0 AS FLOAT)) OVER (PARTITION BY c.id ORDER BY c.time
                 ROWS BETWEEN 119 PRECEDING AND CURRENT ROW) AS med,
                 CASE lab.target WHEN 'OD' THEN 0 WHEN 'ID' THEN 1 ELSE -1 END AS target
          FROM clean c LEFT JOIN lab USING (id)) GROUP BY target""", CLEAN_SQL, LABELS_SQL))
def flagship(spark, sf_dir):
    """Clean, mark, rolling median per recording, average of it per defect type."""
    rows = recordings(spark, sf_dir)
    found = long_series(rows)  # one check for all steps
    rows = preprocess(rows, found=found)
    marked = lookups.mark_target(rows, labels(spark, sf_dir))
    spec = RollingSpec("ch0", "median", window=120, min_periods=1, name="med")
    featured = rolling(marked, [spec], found=found, keep=["target"])
    out = featured.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.avg("med").alias("median_ch0"))
    return rounded(out, 4, "median_ch0")


@query("preprocess", with_m("""
    SELECT id, time, CAST(CAST(ch0 AS FLOAT) AS DOUBLE) AS ch0, CAST(CAST(ch1 AS FLOAT) AS DOUBLE) AS ch1,
           CAST(CAST(ch2 AS FLOAT) AS DOUBLE) + 0.0 AS ch2 FROM clean""", CLEAN_SQL))
def preprocessed(spark, sf_dir):
    out = preprocess(recordings(spark, sf_dir))
    return out.select("id", "time", *[neat(F.col(c), None).alias(c) for c in ("ch0", "ch1", "ch2")])


@query("build_features", with_m(
    "SELECT id, time, " + ", ".join(
        f"round(CASE WHEN count({c}) OVER {_MEDIAN} >= 1 THEN median({c}) OVER {_MEDIAN} END, 6) + 0.0 "
        f"AS {c}_median_120_shift_0" for c in ("ch0", "ch1", "ch2")) + " FROM m"))
def features(spark, sf_dir):
    out, new = build_features(recordings(spark, sf_dir), default_features(min_periods=1), keep=[])
    return rounded(out.select("id", "time", *new), 6, *new)


@query("named_steps", with_m("""
    SELECT id, time, round(CASE WHEN count(*) OVER w >= 1 THEN avg(least(greatest(ch2, 0), 50)) OVER w END, 6) + 0.0 AS y
    FROM m WINDOW w AS (PARTITION BY id ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def named_steps(spark, sf_dir):
    """Named steps chained as a Spark ML pipeline."""
    rows = recordings(spark, sf_dir).select("id", "time", "ch2")
    spec = RollingSpec("ch2", "mean", window=3, min_periods=1, name="y")
    steps = Pipeline(stages=[Step("clip", bounds={"ch2": (0, 50)}), Step("rolling", specs=[spec])])
    return rounded(steps.fit(rows).transform(rows).select("id", "time", "y"), 6, "y")


@query("plot_series", with_m("""
    SELECT m.id, m.time, value, CASE WHEN kind = 'view' THEN round(value / 2, 6) + 0.0 END AS score,
           (row_number() OVER (PARTITION BY m.id ORDER BY m.time) - 1) // 20 AS chunk_id
    FROM m WHERE id IN (SELECT id FROM m WHERE kind = 'view' AND id % 3 = 0)"""))
def plotted(spark, sf_dir):
    m = measurements(spark, sf_dir).select("id", "time", "value", "kind")
    chosen = m.where((F.col("kind") == "view") & (F.col("id") % 3 == 0))
    predictions = chosen.select("id", "time", neat(F.col("value") / 2, 6).alias("score"))
    return plot_series(m.drop("kind"), predictions, rows=20)


# ---------------------------------------------------------------- cleaning

@query("clip", with_m("""
    SELECT id, time, CASE WHEN ch0 IS NULL THEN NULL ELSE least(greatest(ch0, 5), 40) END AS ch0,
           round(greatest(ch2, 0), 6) + 0.0 AS ch2 FROM m"""))
def clip(spark, sf_dir):
    rows = recordings(spark, sf_dir).select("id", "time", "ch0", "ch2")
    return rounded(clean.clip(rows, {"ch0": (5, 40), "ch2": (0, None), "absent": (0, 1)}), 6, "ch2")


@query("inf_to_null", with_m("SELECT id, time, CASE WHEN isinf(ch0_inf) THEN NULL ELSE ch0_inf END AS ch0_inf FROM m"))
def inf_to_null(spark, sf_dir):
    return clean.inf_to_null(measurements(spark, sf_dir).select("id", "time", "ch0_inf"))


@query("nan_to_null", with_m("SELECT id, time, ch0 FROM m"))
def nan_to_null(spark, sf_dir):
    rows = measurements(spark, sf_dir).select("id", "time", "ch0")
    return clean.nan_to_null(rows.withColumn("ch0", F.coalesce("ch0", F.lit(float("nan")))))


FILL_SQL = with_m(f"""
    SELECT id, time,
           CASE WHEN ch0 IS NULL AND count(*) FILTER (WHERE ch0 IS NULL) {GROW} <= 3 THEN -5.0 ELSE ch0 END AS ch0
    FROM m""")


@query("fill_value", FILL_SQL)
def fill_value(spark, sf_dir):
    rows = measurements(spark, sf_dir).select("id", "time", "ch0")
    return clean.fill(rows, {"ch0": FillRule(-5, "ffill", 3)})


@query("fill_value_blocked", FILL_SQL)
def fill_value_blocked(spark, sf_dir):
    rows = measurements(spark, sf_dir).select("id", "time", "ch0")
    return clean.fill(rows, {"ch0": FillRule(-5, "ffill", 3)}, max_rows=BLOCK_ROWS)


@query("fill_constant", with_m("SELECT id, time, coalesce(ch0, 0.0) AS ch0 FROM m"))
def fill_constant(spark, sf_dir):
    return clean.fill(measurements(spark, sf_dir).select("id", "time", "ch0"), {"ch0": FillRule(0)})


def filled(spark, sf_dir, method, limit, **kw):
    rows = measurements(spark, sf_dir).select("id", "time", "ch0")
    return clean.fill(rows, {"ch0": FillRule(method=method, limit=limit)}, **kw)


def carry_sql(fn: str, frame: str) -> str:
    over = f"OVER (PARTITION BY id ORDER BY time ROWS BETWEEN {frame})"
    return with_m(f"SELECT id, time, {fn}(ch0 IGNORE NULLS) {over} AS ch0 FROM m")


_FORWARD, _BACKWARD = "last_value", "first_value"
_TO_HERE, _FROM_HERE = "UNBOUNDED PRECEDING AND CURRENT ROW", "CURRENT ROW AND UNBOUNDED FOLLOWING"

for _name, _fn, _method, _limit, _frame in (
    ("ffill", _FORWARD, "ffill", 1, "1 PRECEDING AND CURRENT ROW"),
    ("ffill_unlimited", _FORWARD, "ffill", None, _TO_HERE),
    ("bfill", _BACKWARD, "bfill", 1, "CURRENT ROW AND 1 FOLLOWING"),
    ("bfill_unlimited", _BACKWARD, "bfill", None, _FROM_HERE),
):
    _sql = carry_sql(_fn, _frame)
    query(_name, _sql)(lambda spark, sf_dir, m=_method, n=_limit: filled(spark, sf_dir, m, n))
    query(f"{_name}_blocked", _sql)(
        lambda spark, sf_dir, m=_method, n=_limit: filled(spark, sf_dir, m, n, max_rows=BLOCK_ROWS))


@query("replace_nonpositive", with_m("""
    SELECT id, time, round(CASE WHEN ch0 <= 0 THEN 0.01 ELSE ch0 END, 6) AS ch0,
           round(CASE WHEN ch2 <= 0 THEN 0.01 ELSE ch2 END, 6) AS ch2 FROM m"""))
def replace_nonpositive(spark, sf_dir):
    m = recordings(spark, sf_dir)
    out = clean.replace_nonpositive(m.select("time", "ch0", "ch2", F.col("id").cast("string").alias("key")))
    return rounded(out.select(F.col("key").cast("long").alias("id"), "time", "ch0", "ch2"), 6, "ch0", "ch2")


@query("fill_label", with_m("SELECT DISTINCT m.id, coalesce(l.quality, 0) AS target FROM m LEFT JOIN labels l ON l.doc_id = m.id"))
def fill_label(spark, sf_dir):
    truth = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("target"))
    ids = measurements(spark, sf_dir).select("id").distinct()
    return clean.fill_label(lookups.attach(ids, truth, ["id"]))


# ---------------------------------------------------------------- columns

@query("cast_declared", """
    SELECT event_id, TRY_CAST(event_type AS DOUBLE) AS event_type, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value,
           CAST(user_id AS VARCHAR) AS user_id FROM events""")
def cast_declared(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "user_id")
    out = columns.cast_declared(rows, {"event_type": "double", "value": "float", "user_id": "string", "no": "int"})
    return out.withColumns({"event_id": F.col("event_id").cast("long"), "value": F.col("value").cast("double")})


def narrow_sql(*names: str) -> str:
    def kind(c: str) -> str:
        tests = [(b, n) for b, n in ((8, "tinyint"), (16, "smallint"), (32, "int"))]
        cases = " ".join(f"WHEN min({c}) > -{2 ** (b - 1)} AND max({c}) < {2 ** (b - 1) - 1} THEN '{n}'"
                         for b, n in tests)
        return f"SELECT '{c}' AS name, CASE {cases} ELSE 'bigint' END AS type FROM lineitem"
    return " UNION ALL ".join(kind(c) for c in names) + " UNION ALL SELECT 'l_tax', 'float'"


@query("narrow_types", narrow_sql("l_orderkey", "l_suppkey", "l_linenumber"))
def narrow_types(spark, sf_dir):
    """The types the columns end up with."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_tax")
    narrow = columns.narrow_types(rows)
    pairs = [F.struct(F.lit(c).alias("name"), F.typeof(F.any_value(c)).alias("type")) for c in narrow.columns]
    return narrow.agg(F.array(*pairs).alias("s")).select(F.inline("s"))


@query("dedupe_columns", with_m("SELECT id, time, coalesce(ch0, 0.0) AS x FROM m"))
def dedupe_columns(spark, sf_dir):
    m = measurements(spark, sf_dir)
    twice = m.select("id", F.col("ch0").alias("x"), "time", F.coalesce("ch0", F.lit(0.0)).alias("x"))
    return columns.dedupe_columns(twice)


@query("drop_columns", with_m("SELECT id, time, kind FROM m"))
def drop_columns(spark, sf_dir):
    return columns.drop_columns(measurements(spark, sf_dir), ["ch0", "ch1", "ch2", "ch0_inf", "value"])


@query("select_columns", with_m("SELECT kind, id, time FROM m"))
def select_columns(spark, sf_dir):
    return columns.select_columns(measurements(spark, sf_dir), ["kind", "id", "time"])


def profile_sql(name: str, floating: bool, numeric: bool = True) -> str:
    def when(text):
        return text if numeric else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{name}' AS "column", count(*) AS rows, count({name}) AS filled,
        round(count({name}) / CAST(count(*) AS DOUBLE), 9) AS fill_rate,
        {f"count(*) FILTER (WHERE isinf({name}))" if floating else "0"} AS n_inf,
        {f"count(*) FILTER (WHERE isnan({name}))" if floating else "0"} AS n_nan,
        {when(f"CAST(min({name}) AS DOUBLE)")} AS min_value, {when(f"CAST(max({name}) AS DOUBLE)")} AS max_value
        FROM m"""


@query("profile_columns", with_m(" UNION ALL ".join([
    profile_sql("id", False), profile_sql("ch0", True), profile_sql("ch1", True), profile_sql("ch0_inf", True),
    profile_sql("kind", False, False)])))
def profile_columns(spark, sf_dir):
    rows = measurements(spark, sf_dir).select("id", "ch0", "ch1", "ch0_inf", "kind")
    return rounded(columns.profile_columns(rows), 9, "fill_rate")


# ---------------------------------------------------------------- filters

@query("filter_eq", with_m("SELECT id, time, ch0 FROM m WHERE kind = 'view'"))
def filter_eq(spark, sf_dir):
    return lookups.filter_eq(measurements(spark, sf_dir), "kind", "view").select("id", "time", "ch0")


@query("filter_in", with_m("SELECT id, time, id IN (SELECT doc_id FROM labels) AS listed FROM m"))
def filter_in(spark, sf_dir):
    m, keys = measurements(spark, sf_dir).select("id", "time"), labels(spark, sf_dir)
    listed = lookups.filter_in(m, keys).withColumn("listed", F.lit(True))
    return listed.unionByName(lookups.filter_in(m, keys, keep=False).withColumn("listed", F.lit(False)))


@query("threshold", with_m("SELECT id, time, CASE WHEN ch0 / 100 > 0.5 THEN 1 ELSE 0 END AS y FROM m"))
def threshold(spark, sf_dir):
    return measurements(spark, sf_dir).select("id", "time", lookups.threshold(F.col("ch0") / 100).alias("y"))


# ---------------------------------------------------------------- joins and sets

@query("mark_target", with_m("SELECT id, time, target FROM marked", LABELS_SQL, MARKED_SQL))
def mark_target(spark, sf_dir):
    m = measurements(spark, sf_dir).select("id", "time")
    return lookups.mark_target(m, labels(spark, sf_dir))


@query("mark_target_last_wins", with_m("""
    SELECT m.id, m.time, CASE last.target WHEN 'OD' THEN 0 WHEN 'ID' THEN 1 ELSE -1 END AS target
    FROM m LEFT JOIN (SELECT o_custkey AS id, arg_max(CASE o_orderstatus WHEN 'F' THEN 'OD' WHEN 'O' THEN 'ID' ELSE 'P' END,
                             o_orderkey) AS target FROM orders GROUP BY 1) last USING (id)"""))
def mark_target_last_wins(spark, sf_dir):
    """Several labels per recording and names without a code."""
    status = F.col("o_orderstatus")
    many = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("at"),
        F.when(status == "F", "OD").when(status == "O", "ID").otherwise("P").alias("target"))
    return lookups.mark_target(measurements(spark, sf_dir).select("id", "time"), many, order="at")


@query("mark_target_last_file", with_m("""
    SELECT m.id, m.time, CASE WHEN l.doc_id IS NULL THEN -1 WHEN (l.quality = 1) = (l.doc_id % 2 = 1) THEN 0 ELSE 1 END AS target
    FROM m LEFT JOIN labels l ON l.doc_id = m.id"""))
def mark_target_last_file(spark, sf_dir):
    """Labels in two files that share keys: the last file in order of names wins."""
    folder, rows = scratch(spark), labels(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    turned = rows.where("CAST(id AS BIGINT) % 2 = 0").withColumn("target", F.when(F.col("target") == "OD", "ID").otherwise("OD"))
    for name, part in (("1", rows), ("2", turned)):
        part.write.option("header", True).csv(f"{folder}/{name}")
    read = files.read_csv(spark, f"{folder}/*", LABELS, position="place").withColumn("id", F.col("id").cast("long"))
    return lookups.mark_target(measurements(spark, sf_dir).select("id", "time"), read, order="place")


@query("mark_target_joined", with_m("SELECT id, time, target FROM marked", LABELS_SQL, MARKED_SQL))
def mark_target_joined(spark, sf_dir):
    """Labels that come from a join and have no order."""
    numbered = labels(spark, sf_dir).select("id").join(labels(spark, sf_dir), "id")
    return lookups.mark_target(measurements(spark, sf_dir).select("id", "time"), numbered)


@query("decode_groups", """
    SELECT c_custkey, c_nationkey AS group_id, n_name AS name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def decode_groups(spark, sf_dir):
    mapping = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("group_id"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("group_id"))
    return lookups.decode_groups(rows, mapping)


@query("decode_group_lists", """
    SELECT c_custkey, c_nationkey AS group_id, r_name AS name
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def decode_group_lists(spark, sf_dir):
    """Names that stand for a list of groups."""
    nations = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(
        F.collect_list("n_nationkey").alias("group_id"))
    mapping = table(spark, sf_dir, "region").join(nations, "r_regionkey").select(F.col("r_name").alias("name"), "group_id")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("group_id"))
    return lookups.decode_groups(rows, mapping)


@query("attach_predictions", with_m("""
    SELECT coalesce(m.id, p.id) AS id, coalesce(m.time, p.time) AS time, m.ch0, p.score
    FROM (SELECT * FROM m WHERE kind <> 'view') m FULL JOIN
         (SELECT id, time, ch1 AS score FROM m WHERE kind <> 'click') p ON m.id = p.id AND m.time = p.time"""))
def attach_predictions(spark, sf_dir):
    m = measurements(spark, sf_dir)
    scores = m.where("kind <> 'click'").select("id", "time", F.col("ch1").alias("score"))
    return lookups.attach_predictions(m.where("kind <> 'view'").select("id", "time", "ch0"), scores)


_JOIN_BACK = with_m("SELECT id, time, n FROM m JOIN (SELECT id, count(ch0) AS n FROM m GROUP BY id) USING (id)")


@query("join_back", _JOIN_BACK)
def join_back(spark, sf_dir):
    m = measurements(spark, sf_dir)
    per_group = m.groupBy("id").agg(F.count("ch0").alias("n"))
    return lookups.attach(m.select("id", "time"), per_group, ["id"])


@query("join_back_heavy", _JOIN_BACK)
def join_back_heavy(spark, sf_dir):
    """As with a table too large to broadcast: only keys with many rows go that way."""
    m = measurements(spark, sf_dir)
    per_group = m.groupBy("id").agg(F.count("ch0").alias("n"))
    return lookups.attach(m.select("id", "time"), per_group, ["id"], max_rows=70, broadcast_rows=10)


@query("audit_missing", with_m("SELECT doc_id AS id, doc_id IN (SELECT id FROM m) AS done FROM labels"))
def audit_missing(spark, sf_dir):
    return lookups.audit_missing(labels(spark, sf_dir), measurements(spark, sf_dir))


@query("missing_ids", with_m("SELECT doc_id AS id FROM labels WHERE doc_id NOT IN (SELECT id FROM m)"))
def missing_ids(spark, sf_dir):
    return lookups.missing_ids(labels(spark, sf_dir), measurements(spark, sf_dir))


@query("union_rows", with_m("SELECT id, ch0, NULL AS ch1 FROM m UNION ALL SELECT id, NULL, ch1 FROM m"))
def union_rows(spark, sf_dir):
    m = measurements(spark, sf_dir)
    return lookups.union_rows(m.select("id", "ch0"), m.select("ch1", "id"))


@query("except_ids", with_m("SELECT id FROM m EXCEPT SELECT doc_id FROM labels"))
def except_ids(spark, sf_dir):
    return lookups.except_ids(measurements(spark, sf_dir), labels(spark, sf_dir))


@query("intersect_ids", with_m("SELECT id FROM m INTERSECT SELECT doc_id FROM labels"))
def intersect_ids(spark, sf_dir):
    return lookups.intersect_ids(measurements(spark, sf_dir), labels(spark, sf_dir))


@query("distinct_ids", with_m("SELECT DISTINCT id FROM m"))
def distinct_ids(spark, sf_dir):
    return lookups.distinct_ids(measurements(spark, sf_dir))


@query("value_counts", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def value_counts(spark, sf_dir):
    return lookups.value_counts(table(spark, sf_dir, "lineitem"), "l_suppkey", 1)


# ---------------------------------------------------------------- scalar functions

def convert_sql(expr: str) -> str:
    return with_m(f"SELECT id, time, round(round_even(CAST(CAST({expr} AS FLOAT) AS DOUBLE), 3), 3) + 0.0 AS y FROM m")


for _name, _method, _expr in (
    ("ratio", "divide", "ch0 / nullif(ch1, 0)"),
    ("difference", "subtract", "ch0 - ch1"),
    ("normalize", "normalize", "(ch0 - ch1) / nullif(ch1, 0)"),
):
    query(_name, convert_sql(_expr))(lambda spark, sf_dir, m=_method: rounded(
        convert(recordings(spark, sf_dir), "ch0", "ch1", m, "y").select("id", "time", "y"), 3, "y"))


@query("normalize_name", "SELECT p_partkey, upper(replace(p_name, ' ', '')) AS name FROM part")
def names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", normalize_name(F.col("p_name")).alias("name"))


@query("file_stem", "SELECT page_id, regexp_extract(parse_filename(url), '^(.*?)(\\.[^.]*)?$', 1) AS stem FROM pages")
def stems(spark, sf_dir):
    last = F.element_at(F.split("url", "/"), -1)
    return table(spark, sf_dir, "pages").select("page_id", file_stem(last).alias("stem"))


@query("map_code", "SELECT event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 END AS code FROM events")
def codes(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", map_code(F.col("event_type"), {"view": 0, "click": 1}).alias("code"))


@query("total_seconds", """
    SELECT l_orderkey, l_linenumber, l_shipdate, epoch_us(l_shipdate) / 1e6 - epoch_us(TIMESTAMP '1995-01-01') / 1e6 AS s
    FROM lineitem""")
def seconds(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("start", F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"))
    return rows.select("l_orderkey", "l_linenumber", "l_shipdate", total_seconds(rows, "start", "l_shipdate").alias("s"))


@query("math_functions", """
    SELECT l_orderkey, l_linenumber, l_shipdate, round(abs(l_discount - 0.05), 6) AS a, round(sqrt(l_quantity), 6) AS s,
           round(ln(l_extendedprice), 6) AS l, CAST(l_quantity AS INTEGER) AS q FROM lineitem""")
def math_functions(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.round(F.abs(F.col("l_discount") - 0.05), 6).alias("a"),
        F.round(F.sqrt("l_quantity"), 6).alias("s"), F.round(F.ln("l_extendedprice"), 6).alias("l"),
        F.col("l_quantity").cast("int").alias("q"))


@query("mean_abs_dev", with_m("""
    SELECT id, CAST(CAST(avg(abs(value - c)) AS FLOAT) AS DOUBLE) AS mad
    FROM m JOIN (SELECT id, avg(value) AS c FROM m GROUP BY id) USING (id) GROUP BY id"""))
def deviation(spark, sf_dir):
    return rounded(mean_abs_dev(measurements(spark, sf_dir), "value", ["id"]), None, "mad")


# ---------------------------------------------------------------- files

@query("read_csv", "SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN quality = 1 THEN 'OD' ELSE 'ID' END AS target FROM labels")
def read_csv(spark, sf_dir):
    folder = scratch(spark)
    out = labels(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    out.write.option("header", True).option("lineSep", "\r\n").csv(folder)
    return files.read_csv(spark, folder, LABELS)


_BAD = "CASE WHEN doc_id % 7 = 0 THEN 'cell' WHEN doc_id % 11 = 0 THEN 'surplus' ELSE 'none' END"


@query("read_csv_rejects", f"""
    SELECT kind, CASE WHEN kind = 'none' THEN 'rows' ELSE 'rejects' END AS part, count(*) AS n,
           CAST(sum(CASE WHEN kind = 'none' THEN quality END) AS BIGINT) AS total
    FROM (SELECT {_BAD} AS kind, quality FROM labels) GROUP BY ALL""")
def read_csv_rejects(spark, sf_dir):
    """Lines with a cell of the wrong type or one too many, kept apart from the others."""
    folder = scratch(spark)
    value = F.when(F.expr(_BAD) == "cell", "oops").when(F.expr(_BAD) == "surplus", "1,2").otherwise(F.col("quality").cast("string"))
    lines = table(spark, sf_dir, "labels").select(F.concat_ws(",", F.col("doc_id").cast("string"), value).alias("value"))
    lines.repartition(3).mapInPandas(_with_header, "value string").write.text(folder)
    good, bad = files.read_csv_parts(spark, folder, T.StructType([T.StructField("id", T.LongType()), T.StructField("quality", T.LongType())]))
    kind = F.when(F.col("line").endswith("oops"), "cell").otherwise("surplus")
    total = F.sum("quality").alias("total")
    return good.agg(F.lit("none").alias("kind"), F.lit("rows").alias("part"), F.count(F.lit(1)).alias("n"), total).unionByName(
        bad.groupBy(kind.alias("kind")).agg(F.lit("rejects").alias("part"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("total")))


def _with_header(parts):
    """Lines of a file with the names of its columns first."""
    yield pd.DataFrame({"value": ["id,quality"]})
    yield from parts


@query("read_snapshot", with_m("SELECT id, time, ch0, ch1 FROM m"))
def read_snapshot(spark, sf_dir):
    """Written as compressed parquet and read back."""
    m = measurements(spark, sf_dir).select("id", "time", "ch0", "ch1")
    return files.read_snapshot(spark, files.write_snapshot(m, f"{scratch(spark)}/m"))


@query("write_snapshot", with_m("SELECT kind, count(*) AS n FROM m GROUP BY kind"))
def write_snapshot(spark, sf_dir):
    path = files.write_snapshot(measurements(spark, sf_dir).select("id", "time", "kind"), f"{scratch(spark)}/m")
    return files.read_snapshot(spark, path).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("read_latest", with_m("SELECT id, time, 'new' AS state FROM m"))
def read_latest(spark, sf_dir):
    folder = scratch(spark)
    m = measurements(spark, sf_dir).select("id", "time")
    for state in ("old", "new"):
        files.write_snapshot(m.withColumn("state", F.lit(state)), f"{folder}/{state}")
    return files.read_latest(spark, folder)


@query("read_directory", "SELECT 'EVENTS' AS id, event_type, count(*) AS n FROM events GROUP BY event_type")
def read_directory(spark, sf_dir):
    rows = files.read_directory(spark, sf_dir, "events.parquet")
    return rows.groupBy("id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("read_groups", with_m("SELECT id, time, ch1 FROM m WHERE id IN (1, 2, 3, 5, 8)"))
def read_groups(spark, sf_dir):
    folder = scratch(spark)
    files.write_groups(measurements(spark, sf_dir).select("id", "time", "ch1"), folder, buckets=8)
    return files.read_groups(spark, folder, [1, 2, 3, 5, 8], buckets=8)


@query("chunk_rows", with_m(
    "SELECT id, time, (row_number() OVER (PARTITION BY id ORDER BY time) - 1) // 20 AS chunk_id FROM m"))
def chunk_rows(spark, sf_dir):
    return files.chunk_rows(measurements(spark, sf_dir).select("id", "time"), 20)
