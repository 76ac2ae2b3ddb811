"""Registered queries: one per operator, each over the driver's tables.

``register(name, sql)`` records the Spark query (``fn(spark, sf_dir)``) and,
when the operator is SQL-expressible, the equivalent DuckDB statement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions import text as tx
from corpusprep.operators import leakage as lk
from corpusprep.operators import split as sp
from corpusprep.plans import sqlparts as S
from corpusprep.sources import tables as tb

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


GK = ["workbook", "sheet"]


# ---------------------------------------------------------------- inputs
def d_split(spark, sf):
    """D: documents by language, split by source, with tagged text."""
    d = tb.docs_by_lang(spark, sf).withColumn("ctext", tx.tagged_text(["text"]))
    return sp.stratified_split(d, "source")


def v_split(spark, sf):
    v = tb.chat_by_role(spark, sf).withColumn("ctext", tx.tagged_text(["text"]))
    return sp.stratified_split(v, "turn_class")


D_SPLIT = S.split(S.with_text(S.D, ["text"]), "source")
V_SPLIT = S.split(S.with_text(S.V, ["text"]), "turn_class")


# ---------------------------------------------------------------- W1 W2 A3
@register("seeded_shuffle", f"""
SELECT workbook, sheet, row_idx,
       CAST(row_number() OVER (PARTITION BY workbook, sheet ORDER BY {S.shuffle_key()}, row_idx) AS BIGINT)
         AS shuffle_pos
FROM ({S.D}) d""")
def q_seeded_shuffle(spark, sf):
    return sp.seeded_shuffle(tb.docs_by_lang(spark, sf)).select(*GK, "row_idx", "shuffle_pos")


@register("stratified_split", f"SELECT workbook, sheet, row_idx, source, split FROM ({S.split(S.D, 'source')}) x")
def q_stratified_split(spark, sf):
    return sp.stratified_split(tb.docs_by_lang(spark, sf), "source").select(*GK, "row_idx", "source", "split")


@register("split_counts", f"""
SELECT workbook, sheet, CAST(count_if(split = 'train') AS BIGINT) AS train_count,
       CAST(count_if(split = 'test') AS BIGINT) AS test_count
FROM ({S.split(S.L, 'lang')}) x GROUP BY workbook, sheet""")
def q_split_counts(spark, sf):
    return sp.split_counts(sp.stratified_split(tb.docs_by_block(spark, sf), "lang"))


# ---------------------------------------------------------------- A4 U1 A6 A7
@register("exact_dup_count", f"""
WITH t AS (SELECT workbook, sheet, ctext, bool_or(split = 'train') AS a, bool_or(split = 'test') AS b
           FROM ({D_SPLIT}) x GROUP BY workbook, sheet, ctext)
SELECT workbook, sheet, CAST(count_if(a AND b) AS BIGINT) AS exact_duplicates
FROM t GROUP BY workbook, sheet""")
def q_exact_dup_count(spark, sf):
    return lk.exact_duplicates(d_split(spark, sf), "ctext")


@register("text_intersect", f"""
SELECT workbook, sheet, md5(ctext) AS text_md5, CAST(length(ctext) AS INTEGER) AS text_len FROM (
  SELECT workbook, sheet, ctext FROM ({D_SPLIT}) x WHERE split = 'train'
  INTERSECT
  SELECT workbook, sheet, ctext FROM ({D_SPLIT}) x WHERE split = 'test') i""")
def q_text_intersect(spark, sf):
    s = d_split(spark, sf)
    tr = s.where("split = 'train'").select(*GK, "ctext")
    te = s.where("split = 'test'").select(*GK, "ctext")
    return tr.intersect(te).select(*GK, F.md5("ctext").alias("text_md5"),
                                   F.length("ctext").cast("int").alias("text_len"))


_EXACT_REPORT = f"""
WITH s AS ({D_SPLIT}),
c AS (SELECT workbook, sheet, count_if(split = 'train') AS num_train, count_if(split = 'test') AS num_test
      FROM s GROUP BY workbook, sheet),
t AS (SELECT workbook, sheet, ctext, bool_or(split = 'train') AS a, bool_or(split = 'test') AS b
      FROM s GROUP BY workbook, sheet, ctext),
e AS (SELECT workbook, sheet, count_if(a AND b) AS exact_duplicates FROM t GROUP BY workbook, sheet),
r AS (SELECT c.workbook, c.sheet, c.num_train, c.num_test, coalesce(e.exact_duplicates, 0) AS exact_duplicates
      FROM c LEFT JOIN e ON c.workbook = e.workbook AND c.sheet = e.sheet)"""


@register("leakage_rollup", _EXACT_REPORT.replace("WITH s AS", "WITH RECURSIVE s AS") + f""",
{S.near(GK)},
p AS (SELECT workbook, sheet, sum(pairs) AS pairs FROM near GROUP BY workbook, sheet),
w AS (SELECT r.*, coalesce(p.pairs, 0) AS near_duplicates
      FROM r LEFT JOIN p ON p.workbook IS NOT DISTINCT FROM r.workbook AND p.sheet IS NOT DISTINCT FROM r.sheet)
SELECT workbook, sheet, CAST(grouping_id(workbook, sheet) AS INTEGER) AS level,
       CAST(sum(num_train) AS BIGINT) AS num_train, CAST(sum(num_test) AS BIGINT) AS num_test,
       CAST(sum(exact_duplicates) AS BIGINT) AS exact_duplicates, CAST(sum(near_duplicates) AS BIGINT) AS near_duplicates
FROM w GROUP BY ROLLUP (workbook, sheet)""")
def q_leakage_rollup(spark, sf):
    return lk.leakage_rollup(lk.sheet_report(d_split(spark, sf), "ctext"))


@register("exact_leakage_gate", _EXACT_REPORT + """
SELECT CAST(sum(num_train + num_test) AS BIGINT) AS total_records,
       CAST(sum(exact_duplicates) AS BIGINT) AS exact_duplicates,
       round(CAST(sum(exact_duplicates) AS DOUBLE) / sum(num_train + num_test), 4)
         AS leakage_ratio,
       CASE WHEN CAST(sum(exact_duplicates) AS DOUBLE) / sum(num_train + num_test) <= 0.01
            THEN 'PASS' ELSE 'FAIL' END AS status
FROM r""")
def q_exact_leakage_gate(spark, sf):
    return lk.leakage_gate(lk.sheet_report(d_split(spark, sf), "ctext", threshold=None))


# ---------------------------------------------------------------- J3 A5 A7 (near)
@register("near_dup_pairs")
def q_near_dup_pairs(spark, sf):
    p = lk.near_duplicate_pairs(d_split(spark, sf), "ctext")
    return p.select(*GK, F.md5("train_text").alias("train_md5"), F.md5("test_text").alias("test_md5"),
                    F.round("similarity", 6).alias("similarity"), "pairs")


@register("leakage_by_group")
def q_leakage_by_group(spark, sf):
    return lk.sheet_report(v_split(spark, sf), "ctext")


@register("leakage_gate")
def q_leakage_gate(spark, sf):
    return lk.leakage_gate(lk.sheet_report(d_split(spark, sf), "ctext"))


# ======================================================================
# labels, filters, text (step 1)
# ======================================================================
from corpusprep.functions import casts as cs  # noqa: E402
from corpusprep.functions import names as nm  # noqa: E402
from corpusprep.operators import filters as fl  # noqa: E402
from corpusprep.operators import labels as lb  # noqa: E402
from corpusprep.operators.ranking import shuffle_key  # noqa: E402
from corpusprep.sources import typed as ty  # noqa: E402

def _sql_norm(e: str) -> str:
    return f"replace(replace(lower({S.strip(e)}), 'aws_', ''), 'amazon_', '')"


def _raw_names(spark, sf):
    p = tb.read_table(spark, sf, "part")
    return p.select("p_partkey", F.concat(F.lit("  AWS_"), F.col("p_brand"), F.lit("_Amazon_"),
                                          F.col("p_type"), F.lit(" ")).alias("raw_name"))


_RAW_NAMES_SQL = "SELECT p_partkey, '  AWS_' || p_brand || '_Amazon_' || p_type || ' ' AS raw_name FROM part"


@register("normalize_name", f"SELECT p_partkey, {_sql_norm('raw_name')} AS name FROM ({_RAW_NAMES_SQL}) x")
def q_normalize_name(spark, sf):
    return _raw_names(spark, sf).select("p_partkey", nm.normalize_name(F.col("raw_name")).alias("name"))


_SKIP = ["Brand#1", " AWS_brand#12 ", "", "amazon_BRAND#3"]
_SKIP_NORM = sorted({nm.normalize_name_py(s) for s in _SKIP if s.strip()})


@register("skip_groups", f"""
SELECT workbook, sheet, CAST(count(*) AS BIGINT) AS n_rows FROM ({S.R}) r
WHERE {_sql_norm('sheet')} NOT IN ({', '.join(repr(s) for s in _SKIP_NORM)})
GROUP BY workbook, sheet""")
def q_skip_groups(spark, sf):
    kept = fl.skip_groups(tb.parts_by_brand(spark, sf), _SKIP)
    return fl.group_sizes(kept)


def _mixed_raw(spark, sf):
    """Raw cells of parts (by brand) and customers (by segment) in one frame."""
    p = tb.as_cells(tb.parts_by_brand(spark, sf), ["p_name", "p_type", "p_size", "p_retailprice"])
    c = tb.as_cells(tb.customers_by_segment(spark, sf), ["c_name", "c_nationkey", "c_acctbal"])
    return p.unionByName(c)


_MIXED_KV = f"""
SELECT 'part' AS workbook, p_brand AS sheet, p_partkey AS row_idx, k AS column_name, v AS value FROM part,
  (VALUES ('p_name'), ('p_type'), ('p_size'), ('p_retailprice')) c(k),
  LATERAL (SELECT CASE k WHEN 'p_name' THEN p_name WHEN 'p_type' THEN p_type
                  WHEN 'p_size' THEN CAST(p_size AS VARCHAR) ELSE CAST(p_retailprice AS VARCHAR) END AS v) x
UNION ALL
SELECT 'customer', c_mktsegment, c_custkey, k, v FROM customer,
  (VALUES ('c_name'), ('c_nationkey'), ('c_acctbal')) c(k),
  LATERAL (SELECT CASE k WHEN 'c_name' THEN c_name WHEN 'c_nationkey' THEN CAST(c_nationkey AS VARCHAR)
                  ELSE CAST(c_acctbal AS VARCHAR) END AS v) x"""


@register("groups_with_columns", f"""
SELECT workbook, sheet, bool_and_cols AS has_all FROM (
  SELECT workbook, sheet,
         count(DISTINCT CASE WHEN column_name IN ('p_name', 'p_type') THEN column_name END) = 2 AS bool_and_cols
  FROM ({_MIXED_KV}) kv GROUP BY workbook, sheet) g""")
def q_groups_with_columns(spark, sf):
    cat = fl.column_catalog(_mixed_raw(spark, sf))
    return fl.groups_with_columns(cat, ["p_name", "p_type"]).select(*GK, "has_all")


@register("pick_label_column", f"""
SELECT workbook, sheet,
  CASE WHEN bool_or(column_name = 'label') THEN 'label' WHEN bool_or(column_name = 'c_nationkey') THEN 'c_nationkey'
       WHEN bool_or(column_name = 'p_type') THEN 'p_type' END AS label_col
FROM ({_MIXED_KV}) kv GROUP BY workbook, sheet""")
def q_pick_label_column(spark, sf):
    cat = fl.column_catalog(_mixed_raw(spark, sf))
    return fl.pick_label_column(cat, ["label", "c_nationkey", "p_type"]).select(*GK, "label_col")


@register("complete_groups", f"""
SELECT workbook, sheet, CAST(count_if(split = 'train') AS BIGINT) AS train_count,
       CAST(count_if(split = 'test') AS BIGINT) AS test_count
FROM ({S.split(S.Q, 'toxic')}) x GROUP BY workbook, sheet
HAVING count_if(split = 'train') > 0 AND count_if(split = 'test') > 0""")
def q_complete_groups(spark, sf):
    return fl.complete_groups(sp.stratified_split(tb.docs_labelled(spark, sf), "toxic"))


_TAG_COLS = ["p_name", "p_type", "p_size"]


@register("tagged_text", f"""
SELECT workbook, sheet, row_idx, {S.tagged(_TAG_COLS)} || ' [P_COLOR] ' AS text FROM ({S.R}) r""")
def q_tagged_text(spark, sf):
    r = tb.parts_by_brand(spark, sf)
    return r.select(*GK, "row_idx", tx.tagged_text(_TAG_COLS + ["p_color"], present=r.columns).alias("text"))


@register("delimited_text", f"""
SELECT workbook, sheet, row_idx,
       coalesce(p_name, 'nan') || ' | ' || coalesce(p_type, 'nan') || ' | ' || coalesce(CAST(p_size AS VARCHAR), 'nan')
         AS text
FROM ({S.R}) r""")
def q_delimited_text(spark, sf):
    r = tb.parts_by_brand(spark, sf)
    return r.select(*GK, "row_idx", tx.delimited_text(["p_name", "p_type", "p_size"]).alias("text"))


@register("text_preview", f"""
SELECT workbook, sheet, arg_min(substr(ctext, 1, 250), {S.shuffle_key()} || ':' || lpad(CAST(row_idx AS VARCHAR), 20, '0'))
  AS preview
FROM ({D_SPLIT}) x WHERE split = 'train' GROUP BY workbook, sheet""")
def q_text_preview(spark, sf):
    s = d_split(spark, sf).where("split = 'train'")
    order = F.concat(shuffle_key("row_idx"), F.lit(":"), F.lpad(F.col("row_idx").cast("string"), 20, "0"))
    return s.groupBy(*GK).agg(F.min_by(tx.preview(F.col("ctext")), order).alias("preview"))


@register("csv_list", f"""
SELECT conv_id, turn, CAST(len(l) AS INTEGER) AS n_items, md5(array_to_string(l, '|')) AS items_md5 FROM (
  SELECT conv_id, turn,
         list_filter(list_transform(string_split(text, ','), lambda x: {S.strip('x')}), lambda x: x <> '') AS l
  FROM conversations) c""")
def q_csv_list(spark, sf):
    c = tb.read_table(spark, sf, "conversations")
    items = tx.csv_list(F.col("text"))
    return c.select("conv_id", "turn", F.size(items).cast("int").alias("n_items"),
                    F.md5(F.array_join(items, "|")).alias("items_md5"))


@register("safe_json", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -1 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
FROM events""")
def q_safe_json(spark, sf):
    """JSON cast with a default; every third text is broken on purpose."""
    e = tb.read_table(spark, sf, "events")
    props = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    default = F.named_struct(F.lit("k"), F.lit(-1).cast("bigint"))
    return e.select("event_id", cs.safe_json(props, "k bigint", default)["k"].alias("k"))


@register("safe_cast", """
SELECT event_id,
  coalesce(CASE WHEN regexp_full_match(trim(json_extract_string(props, '$.k')), '[+-]?[0-9]+')
                THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END, -1) AS k,
  coalesce(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE), 0.0) AS value_num,
  coalesce(CASE WHEN regexp_full_match(trim(props), '[+-]?[0-9]+') THEN TRY_CAST(props AS BIGINT) END, -1)
    AS props_int,
  CASE WHEN lower(CAST(user_id % 3 AS VARCHAR)) IN ('true', '1', 'yes', 'y') THEN true
       WHEN lower(CAST(user_id % 3 AS VARCHAR)) IN ('false', '0', 'no', 'n') THEN false ELSE false END AS flag
FROM events""")
def q_safe_cast(spark, sf):
    e = tb.read_table(spark, sf, "events")
    return e.select(
        "event_id",
        cs.safe_int(F.get_json_object("props", "$.k"), -1).alias("k"),
        cs.safe_float(F.col("value").cast("string"), 0.0).alias("value_num"),
        cs.safe_int(F.col("props"), -1).alias("props_int"),
        cs.safe_bool((F.col("user_id") % 3).cast("string"), False).alias("flag"))


@register("label_map_first_seen", f"""
SELECT workbook, sheet, label_col, label,
       CAST(row_number() OVER (PARTITION BY workbook, sheet, label_col ORDER BY first_idx) - 1 AS INTEGER) AS label_id
FROM (SELECT workbook, sheet, 'source' AS label_col, source AS label, min(row_idx) AS first_idx
      FROM ({S.D}) d GROUP BY workbook, sheet, source) f""")
def q_label_map_first_seen(spark, sf):
    return lb.label_map_first_seen(tb.docs_by_lang(spark, sf), ["source"])


_SORTED_MAP = f"""
SELECT workbook, sheet, label,
       CAST(row_number() OVER (PARTITION BY workbook, sheet ORDER BY label) - 1 AS INTEGER) AS label_id,
       CAST(count(*) OVER (PARTITION BY workbook, sheet) AS INTEGER) AS num_labels
FROM (SELECT DISTINCT workbook, sheet, CAST(turn_class AS VARCHAR) AS label FROM ({V_SPLIT}) x
      WHERE split = 'train') t"""


@register("label_map_sorted", _SORTED_MAP)
def q_label_map_sorted(spark, sf):
    return lb.label_map_sorted(v_split(spark, sf), "turn_class")


@register("label_encode", f"""
SELECT s.workbook, s.sheet, s.row_idx, s.split, CAST(coalesce(m.label_id, -1) AS INTEGER) AS label_id
FROM ({V_SPLIT}) s LEFT JOIN ({_SORTED_MAP}) m
  ON s.workbook = m.workbook AND s.sheet = m.sheet AND CAST(s.turn_class AS VARCHAR) = m.label""")
def q_label_encode(spark, sf):
    s = v_split(spark, sf)
    m = lb.label_map_sorted(s, "turn_class")
    return lb.label_encode(s, m, "turn_class").select(*GK, "row_idx", "split", "label_id")


@register("label_decode", f"""
SELECT s.workbook, s.sheet, s.row_idx, m.label AS label
FROM ({V_SPLIT}) s JOIN ({_SORTED_MAP}) m
  ON s.workbook = m.workbook AND s.sheet = m.sheet AND CAST(s.turn_class AS VARCHAR) = m.label""")
def q_label_decode(spark, sf):
    s = v_split(spark, sf)
    m = lb.label_map_sorted(s, "turn_class")
    enc = lb.label_encode(s, m, "turn_class").select(*GK, "row_idx", "label_id")
    return lb.label_decode(enc, m).select(*GK, "row_idx", "label")


@register("distinct_labels", f"SELECT DISTINCT workbook, sheet, CAST(lang AS VARCHAR) AS label FROM ({S.L}) l")
def q_distinct_labels(spark, sf):
    return lb.distinct_labels(tb.docs_by_block(spark, sf), "lang")


@register("union_parts", f"""
SELECT workbook, sheet, split, has_extra, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT workbook, sheet, split, true AS has_extra FROM ({D_SPLIT}) x WHERE split = 'train'
  UNION ALL
  SELECT workbook, sheet, split, false FROM ({D_SPLIT}) x WHERE split = 'test') u
GROUP BY workbook, sheet, split, has_extra""")
def q_union_parts(spark, sf):
    s = d_split(spark, sf).select(*GK, "split")
    tr, te = sp.split_parts(s)
    u = sp.union_parts(tr.withColumn("extra", F.lit(1)), te)
    return u.groupBy(*GK, "split", F.col("extra").isNotNull().alias("has_extra")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("file_stem", r"SELECT page_id, regexp_replace(url, '\.[^.]+$', '') AS stem FROM pages")
def q_file_stem(spark, sf):
    return tb.read_table(spark, sf, "pages").select("page_id", tx.file_stem(F.col("url")).alias("stem"))


_PART_SCHEMA = T.StructType([
    T.StructField("p_name", T.StringType()), T.StructField("p_size", T.LongType()),
    T.StructField("p_retailprice", T.DoubleType()), T.StructField("p_color", T.StringType())])


@register("typed_projection", f"""
SELECT workbook, sheet, row_idx, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice,
       CAST(NULL AS VARCHAR) AS p_color FROM ({S.R}) r""")
def q_typed_projection(spark, sf):
    raw = tb.as_cells(tb.parts_by_brand(spark, sf), ["p_name", "p_type", "p_size", "p_retailprice"])
    return ty.typed_projection(raw, _PART_SCHEMA)


@register("infer_types", f"""
SELECT workbook, sheet, column_name AS "column",
  CASE WHEN bool_and(regexp_full_match(trim(value), '[+-]?[0-9]+') AND TRY_CAST(value AS BIGINT) IS NOT NULL)
       THEN 'bigint'
       WHEN bool_and(TRY_CAST(value AS DOUBLE) IS NOT NULL) THEN 'double' ELSE 'string' END AS type
FROM ({_MIXED_KV}) kv WHERE value IS NOT NULL GROUP BY workbook, sheet, column_name""")
def q_infer_types(spark, sf):
    return ty.infer_types(_mixed_raw(spark, sf))


@register("split_last_label", f"""
SELECT workbook, sheet, toxic AS label, split, CAST(count(*) AS BIGINT) AS n
FROM ({S.split(S.Q, 'toxic')}) x GROUP BY workbook, sheet, toxic, split""")
def q_split_last_label(spark, sf):
    q = tb.docs_labelled(spark, sf)
    s = sp.split_by_labels(q, ["quality", "toxic", "not_a_column"])
    return s.groupBy(*GK, F.col("toxic").alias("label"), "split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("split_combination", f"""
WITH q AS (SELECT * FROM ({S.Q}) x WHERE toxic IS NOT NULL AND quality IS NOT NULL),
c AS (SELECT workbook, sheet, toxic, quality, n, sum(n) OVER (PARTITION BY workbook, sheet ORDER BY toxic, quality) AS upto
      FROM (SELECT workbook, sheet, toxic, quality, count(*) AS n FROM q GROUP BY workbook, sheet, toxic, quality) y),
r AS (SELECT q.*, row_number() OVER (PARTITION BY workbook, sheet, toxic, quality ORDER BY {S.shuffle_key()}, row_idx) AS nth FROM q)
SELECT r.workbook, r.sheet, r.row_idx, r.toxic, r.quality,
       CASE WHEN nth <= floor(upto * CAST({S.FRAC} AS DOUBLE)) - floor((upto - n) * CAST({S.FRAC} AS DOUBLE))
            THEN 'train' ELSE 'test' END AS split
FROM r JOIN c ON r.workbook = c.workbook AND r.sheet IS NOT DISTINCT FROM c.sheet AND r.toxic = c.toxic AND r.quality = c.quality""")
def q_split_combination(spark, sf):
    s = sp.split_by_combination(tb.docs_labelled(spark, sf), ["toxic", "not_a_column", "quality"])
    return s.select(*GK, "row_idx", "toxic", "quality", "split")


_MIXED_LABELS = ("SELECT 'part' AS workbook, p_brand AS sheet, p_partkey AS row_idx, p_type AS label FROM part "
                 "UNION ALL SELECT 'customer', c_mktsegment, c_custkey, CAST(c_nationkey AS VARCHAR) FROM customer")


def _mixed_frame(spark, sf):
    """Parts and customers in one frame: each sheet has only its own columns."""
    return tb.parts_by_brand(spark, sf).unionByName(tb.customers_by_segment(spark, sf), allowMissingColumns=True)


@register("split_mixed_columns", f"""
SELECT workbook, sheet, CAST(count_if(split = 'train') AS BIGINT) AS train_count,
       CAST(count_if(split = 'test') AS BIGINT) AS test_count
FROM ({S.split(_MIXED_LABELS, 'label')}) x GROUP BY workbook, sheet""")
def q_split_mixed_columns(spark, sf):
    return sp.split_counts(sp.split_by_labels(_mixed_frame(spark, sf), ["p_type", "c_nationkey"]))


@register("label_map_mixed_columns", f"""
SELECT workbook, sheet, label_col, label,
       CAST(row_number() OVER (PARTITION BY workbook, sheet, label_col ORDER BY first_idx) - 1 AS INTEGER) AS label_id
FROM (SELECT workbook, sheet, CASE workbook WHEN 'part' THEN 'p_type' ELSE 'c_nationkey' END AS label_col, label,
             min(row_idx) AS first_idx FROM ({_MIXED_LABELS}) d GROUP BY workbook, sheet, label) f""")
def q_label_map_mixed_columns(spark, sf):
    return lb.label_map_first_seen(_mixed_frame(spark, sf), ["p_type", "c_nationkey"])


@register("tagged_text_mixed_columns", """
SELECT 'part' AS workbook, p_brand AS sheet, p_partkey AS row_idx, '[P_NAME] ' || trim(p_name) || ' [C_NAME] ' AS text FROM part
UNION ALL SELECT 'customer', c_mktsegment, c_custkey, '[P_NAME]  [C_NAME] ' || trim(c_name) FROM customer""")
def q_tagged_text_mixed_columns(spark, sf):
    marked, has = fl.with_presence(_mixed_frame(spark, sf), ["p_name", "c_name"])
    return marked.select(*GK, "row_idx", tx.tagged_text(["p_name", "c_name"], has).alias("text"))


@register("sample_rows_per_group", f"""
SELECT workbook, sheet, CAST(rn AS INTEGER) AS rn, md5(ctext) AS text_md5 FROM (
  SELECT workbook, sheet, ctext, row_number() OVER (PARTITION BY workbook, sheet
         ORDER BY {S.shuffle_key()}, row_idx) AS rn
  FROM ({D_SPLIT}) x WHERE split = 'test') t WHERE rn <= 5""")
def q_sample_rows_per_group(spark, sf):
    from corpusprep.operators.report import first_rows
    s = d_split(spark, sf).where("split = 'test'")
    return first_rows(s, 5).select(*GK, F.col("rn").cast("int").alias("rn"), F.md5("ctext").alias("text_md5"))


@register("argmax_class", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings""")
def q_argmax_class(spark, sf):
    from corpusprep.operators.classify import argmax
    e = tb.read_table(spark, sf, "embeddings")
    return e.select("vec_id", argmax(F.col("embedding")).alias("argmax"))


# ======================================================================
# tokens and classifier (steps 2 and 4)
# ======================================================================
from corpusprep.operators import classify as cl  # noqa: E402
from corpusprep.operators import tokens as tk  # noqa: E402


def l_split(spark, sf):
    d = tb.docs_by_block(spark, sf).withColumn("ctext", tx.tagged_text(["text"]))
    return sp.stratified_split(d, "lang")


L_SPLIT = S.split(S.with_text(S.L, ["text"]), "lang")
VOCAB_N = 2000


@register("word_tokens", f"SELECT doc_id, CAST(len({S.words('text')}) AS INTEGER) AS n_tokens FROM documents")
def q_word_tokens(spark, sf):
    d = tb.read_table(spark, sf, "documents")
    return d.select("doc_id", F.size(tx.word_tokens(F.col("text"))).cast("int").alias("n_tokens"))


def _vocab_sql(split_sql: str, n: int = VOCAB_N) -> str:
    return f"""
SELECT token, CAST(row_number() OVER (ORDER BY cnt DESC, token) + 3 AS INTEGER) AS token_id, cnt AS "count" FROM (
  SELECT token, CAST(count(*) AS BIGINT) AS cnt FROM (
    SELECT unnest({S.words('ctext')}) AS token FROM ({split_sql}) x WHERE split = 'train') t
  GROUP BY token ORDER BY cnt DESC, token LIMIT {n}) v"""


@register("vocabulary", _vocab_sql(D_SPLIT))
def q_vocabulary(spark, sf):
    return tk.vocabulary(d_split(spark, sf), "ctext", VOCAB_N)


@register("encode_tokens", f"""
WITH voc AS ({_vocab_sql(V_SPLIT)}),
vm AS (SELECT map(list(token), list(token_id)) AS m FROM voc),
s AS (SELECT workbook, sheet, row_idx, split,
             list_transform(list_slice({S.words('ctext')}, 1, 126),
                            lambda t: coalesce(vm.m[t], 1)) AS ids
      FROM ({V_SPLIT}) x, vm)
SELECT workbook, sheet, row_idx, split,
       array_to_string(list_concat([2], ids, [3], list_transform(range(126 - len(ids)), lambda i: 0)), ' ')
         AS input_ids,
       CAST(len(ids) + 2 AS INTEGER) AS mask_sum
FROM s""")
def q_encode_tokens(spark, sf):
    s = v_split(spark, sf)
    voc = tk.vocabulary(s, "ctext", VOCAB_N)
    e = tk.encode(s, "ctext", voc, keys=GK + ["row_idx"], max_length=128)
    return e.select(*GK, "row_idx", "split", F.array_join("input_ids", " ").alias("input_ids"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("int").alias("mask_sum"))


_NB = "WITH " + S.nb_ctes(L_SPLIT, "lang")


def _nb_eval(spark, sf):
    return cl.nb_evaluate(l_split(spark, sf), "ctext", "lang")


@register("nb_token_counts", _NB + """
SELECT workbook, sheet, label, label_id, CAST(n_docs AS BIGINT) AS n_docs, CAST(total AS BIGINT) AS total,
       CAST(vocab_size AS BIGINT) AS vocab_size, round(log_prior, 9) AS log_prior FROM cls""")
def q_nb_token_counts(spark, sf):
    m = cl.nb_fit(l_split(spark, sf), "ctext", "lang")
    return m["classes"].select(*GK, "label", "label_id", "n_docs", "total", "vocab_size",
                               F.round("log_prior", 9).alias("log_prior"))


@register("nb_predict", _NB + """
SELECT workbook, sheet, row_idx, label, label_id, pred_id, pred_label FROM ev""")
def q_nb_predict(spark, sf):
    return _nb_eval(spark, sf).select(*GK, "row_idx", "label", "label_id", "pred_id", "pred_label")


@register("nb_confidence", _NB + """
SELECT workbook, sheet, row_idx, pred_label, round(confidence, 4) AS confidence FROM ev""")
def q_nb_confidence(spark, sf):
    return _nb_eval(spark, sf).select(*GK, "row_idx", "pred_label", F.round("confidence", 4).alias("confidence"))


@register("clf_accuracy", _NB + """
SELECT workbook, sheet, round(avg(CAST(pred_id = label_id AS DOUBLE)), 9) AS accuracy FROM ev GROUP BY workbook, sheet""")
def q_clf_accuracy(spark, sf):
    a = cl.accuracy(_nb_eval(spark, sf))
    return a.select(*GK, F.round("accuracy", 9).alias("accuracy"))


@register("clf_report", _NB + """
SELECT workbook, sheet, class_id, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM repf""")
def q_clf_report(spark, sf):
    r = cl.class_report(_nb_eval(spark, sf))
    return r.select(*GK, "class_id", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("clf_weighted_f1", _NB + """
SELECT workbook, sheet, round(sum(f1 * support) / sum(support), 9) AS f1,
       round(avg(f1), 9) AS macro_f1 FROM repf GROUP BY workbook, sheet""")
def q_clf_weighted_f1(spark, sf):
    avgs = cl.report_averages(cl.class_report(_nb_eval(spark, sf)))
    return avgs.select(*GK, F.round("weighted_f1", 9).alias("f1"), F.round("macro_f1", 9).alias("macro_f1"))


@register("training_summary", _NB + """,
acc AS (SELECT workbook, sheet, avg(CAST(pred_id = label_id AS DOUBLE)) AS accuracy FROM ev GROUP BY workbook, sheet),
wf AS (SELECT workbook, sheet, sum(f1 * support) / sum(support) AS f1 FROM repf GROUP BY workbook, sheet),
cnts AS (SELECT workbook, sheet, count_if(split = 'train') AS ntr, count_if(split = 'test') AS nte FROM s
         GROUP BY workbook, sheet),
nl AS (SELECT workbook, sheet, count(*) AS num_labels FROM lmap GROUP BY workbook, sheet)
SELECT c.workbook, c.sheet, CAST(nl.num_labels AS INTEGER) AS num_labels, round(acc.accuracy, 9) AS accuracy,
       round(wf.f1, 9) AS f1, CAST(c.ntr AS BIGINT) AS num_train_samples, CAST(c.nte AS BIGINT) AS num_test_samples
FROM cnts c JOIN nl ON c.workbook = nl.workbook AND c.sheet = nl.sheet
LEFT JOIN acc ON c.workbook = acc.workbook AND c.sheet = acc.sheet
LEFT JOIN wf ON c.workbook = wf.workbook AND c.sheet = wf.sheet""")
def q_training_summary(spark, sf):
    s = l_split(spark, sf)
    pred = cl.nb_evaluate(s, "ctext", "lang")
    lmap = lb.label_map_sorted(s, "lang")
    t = cl.training_summary(s, pred, lmap)
    return t.select(*GK, "num_labels", F.round("accuracy", 9).alias("accuracy"), F.round("f1", 9).alias("f1"),
                    "num_train_samples", "num_test_samples")


@register("clf_record", _NB + """,
named AS (SELECT r.*, m.label FROM repf r LEFT JOIN lmap m
          ON r.workbook = m.workbook AND r.sheet = m.sheet AND r.class_id = m.label_id),
entries AS (
  SELECT workbook, sheet, 'class' AS kind, label AS entry, precision, recall, f1, support FROM named
  UNION ALL
  SELECT workbook, sheet, 'macro avg', NULL, avg(precision), avg(recall), avg(f1), sum(support) FROM repf GROUP BY workbook, sheet
  UNION ALL
  SELECT workbook, sheet, 'weighted avg', NULL, sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1 * support) / sum(support), sum(support) FROM repf GROUP BY workbook, sheet),
acc AS (SELECT workbook, sheet, avg(CAST(pred_id = label_id AS DOUBLE)) AS accuracy FROM ev GROUP BY workbook, sheet)
SELECT e.workbook, e.sheet, round(acc.accuracy, 9) AS accuracy, kind, entry, round(precision, 9) AS precision,
       round(recall, 9) AS recall, round(f1, 9) AS f1, CAST(support AS BIGINT) AS support
FROM entries e JOIN acc ON e.workbook = acc.workbook AND e.sheet = acc.sheet""")
def q_clf_record(spark, sf):
    s = l_split(spark, sf)
    rec = cl.report_record(cl.nb_evaluate(s, "ctext", "lang"), lb.label_map_sorted(s, "lang"))
    entry = lambda kind, e, label: F.struct(F.lit(kind).alias("kind"), label.alias("entry"), *[
        e[c].alias(c) for c in ("precision", "recall", "f1", "support")])
    none = F.lit(None).cast("string")
    entries = F.concat(F.transform("per_class", lambda e: entry("class", e, e["label"])),
                       F.array(entry("macro avg", F.col("macro_avg"), none), entry("weighted avg", F.col("weighted_avg"), none)))
    return rec.select(*GK, F.round("accuracy", 9).alias("accuracy"), F.explode(entries).alias("e")).select(
        *GK, "accuracy", "e.kind", "e.entry", *[F.round(f"e.{c}", 9).alias(c) for c in ("precision", "recall", "f1")], "e.support")


@register("training_master_summary", _NB + """,
acc AS (SELECT workbook, sheet, avg(CAST(pred_id = label_id AS DOUBLE)) AS accuracy FROM ev GROUP BY workbook, sheet),
cnts AS (SELECT workbook, sheet, count_if(split = 'train') AS ntr, count_if(split = 'test') AS nte FROM s
         GROUP BY workbook, sheet),
nl AS (SELECT workbook, sheet, count(*) AS num_labels FROM lmap GROUP BY workbook, sheet),
g AS (SELECT c.*, nl.num_labels, acc.accuracy FROM cnts c
      JOIN nl ON c.workbook = nl.workbook AND c.sheet = nl.sheet
      LEFT JOIN acc ON c.workbook = acc.workbook AND c.sheet = acc.sheet)
SELECT workbook, CAST(count(*) AS INTEGER) AS n_groups, CAST(sum(ntr) AS BIGINT) AS num_train_samples,
       CAST(sum(nte) AS BIGINT) AS num_test_samples,
       round(sum(accuracy * nte) / sum(CASE WHEN accuracy IS NOT NULL THEN nte END), 9) AS accuracy,
       string_agg(sheet || ':' || num_labels || ':' || ntr || ':' || nte, ',' ORDER BY sheet) AS sheets
FROM g GROUP BY workbook""")
def q_training_master_summary(spark, sf):
    s = l_split(spark, sf)
    pred = cl.nb_evaluate(s, "ctext", "lang")
    m = rp.master_summary(cl.training_summary(s, pred, lb.label_map_sorted(s, "lang")))
    shown = lambda g: F.concat_ws(":", g["sheet"], g["num_labels"], g["num_train_samples"], g["num_test_samples"])
    return m.select("workbook", "n_groups", "num_train_samples", "num_test_samples", F.round("accuracy", 9).alias("accuracy"),
                    F.array_join(F.transform("groups", shown), ",").alias("sheets"))


# ======================================================================
# vectors and clusters (step 5)
# ======================================================================
from corpusprep.operators import cluster as cu  # noqa: E402
from corpusprep.operators import vectors as vc  # noqa: E402
from corpusprep.plans import corpus as cp  # noqa: E402


@register("tfidf_vectors", f"""
WITH d AS ({S.D}),
tf AS (SELECT workbook, sheet, row_idx, token, count(*) AS tf
       FROM (SELECT workbook, sheet, row_idx, unnest({S.words('text')}) AS token FROM d) t
       GROUP BY workbook, sheet, row_idx, token),
n AS (SELECT workbook, sheet, count(*) AS n FROM d GROUP BY workbook, sheet),
dfq AS (SELECT workbook, sheet, token, count(*) AS dfreq FROM tf GROUP BY workbook, sheet, token),
w AS (SELECT tf.workbook, tf.sheet, tf.row_idx, tf.tf * (ln((n.n + 1) / (dfq.dfreq + 1)) + 1) AS w
      FROM tf JOIN dfq ON tf.workbook = dfq.workbook AND tf.sheet = dfq.sheet AND tf.token = dfq.token
      JOIN n ON tf.workbook = n.workbook AND tf.sheet = n.sheet),
nw AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY workbook, sheet, row_idx)) AS weight FROM w)
SELECT workbook, sheet, row_idx, CAST(count(*) AS BIGINT) AS nnz, round(max(weight), 9) AS max_weight
FROM nw GROUP BY workbook, sheet, row_idx""")
def q_tfidf_vectors(spark, sf):
    t = vc.tfidf(tb.docs_by_lang(spark, sf), "text")
    return t.groupBy(*GK, "row_idx").agg(F.count(F.lit(1)).cast("bigint").alias("nnz"),
                                         F.round(F.max("weight"), 9).alias("max_weight"))


@register("hashed_embedding")
def q_hashed_embedding(spark, sf):
    h = vc.hashed_embedding(tb.docs_by_lang(spark, sf), "text")
    return h.select(*GK, "row_idx", F.size(F.filter("embedding", lambda x: x != 0)).alias("nonzero_dims"))


_KM_SEEDS = f"""
e AS ({S.E}),
seeds AS (SELECT workbook, sheet, CAST(rn - 1 AS INTEGER) AS cluster, embedding AS c FROM (
            SELECT *, row_number() OVER (PARTITION BY workbook, sheet ORDER BY {S.shuffle_key()}, row_idx) AS rn
            FROM e) x WHERE rn <= 5),
dd AS (SELECT e.workbook, e.sheet, e.row_idx, s.cluster,
              list_sum(list_transform(list_zip(e.embedding, s.c),
                       lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE))))
                AS d
       FROM e JOIN seeds s ON e.workbook = s.workbook AND e.sheet = s.sheet),
a AS (SELECT workbook, sheet, row_idx, cluster FROM (
        SELECT *, row_number() OVER (PARTITION BY workbook, sheet, row_idx ORDER BY d, cluster) AS r FROM dd) x
      WHERE r = 1)"""


@register("kmeans_assign", f"WITH {_KM_SEEDS} SELECT workbook, sheet, row_idx, cluster FROM a")
def q_kmeans_assign(spark, sf):
    e = tb.vectors_by_block(spark, sf)
    return cu.assign(e, "embedding", cu.seed_centroids(e, "embedding", 5)).select(*GK, "row_idx", "cluster")


@register("kmeans_step", f"""
WITH {_KM_SEEDS},
x AS (SELECT a.workbook, a.sheet, a.cluster, a.row_idx, unnest(e.embedding) AS v,
             unnest(range(1, len(e.embedding) + 1)) AS i
      FROM a JOIN e ON a.workbook = e.workbook AND a.sheet = e.sheet AND a.row_idx = e.row_idx),
m AS (SELECT workbook, sheet, cluster, i, avg(CAST(v AS DOUBLE)) AS mv, count(DISTINCT row_idx) AS size
      FROM x GROUP BY workbook, sheet, cluster, i)
SELECT workbook, sheet, cluster, CAST(max(size) AS BIGINT) AS size, round(sum(mv), 6) AS centroid_sum,
       round(sum(mv * mv), 6) AS centroid_sq
FROM m GROUP BY workbook, sheet, cluster""")
def q_kmeans_step(spark, sf):
    e = tb.vectors_by_block(spark, sf)
    a = cu.assign(e, "embedding", cu.seed_centroids(e, "embedding", 5))
    c = cu.update(a, "embedding")
    return c.select(*GK, "cluster", "size",
                    F.round(F.aggregate("centroid", F.lit(0.0), lambda s, x: s + x), 6).alias("centroid_sum"),
                    F.round(F.aggregate("centroid", F.lit(0.0), lambda s, x: s + x * x), 6).alias("centroid_sq"))


@register("cluster_summary", f"""
WITH {_KM_SEEDS}
SELECT workbook, sheet, CAST(count(*) AS BIGINT) AS records,
       CAST(count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END) AS BIGINT) AS clusters, 'kmeans' AS algorithm
FROM a GROUP BY workbook, sheet""")
def q_cluster_summary(spark, sf):
    e = tb.vectors_by_block(spark, sf)
    a = cu.assign(e, "embedding", cu.seed_centroids(e, "embedding", 5))
    return cu.cluster_summary(a).select(*GK, "records", "clusters", "algorithm")


@register("kmeans_fit")
def q_kmeans_fit(spark, sf):
    rows, _ = cu.kmeans(tb.vectors_by_block(spark, sf), "embedding", 5)
    return rows.select(*GK, "row_idx", "cluster", F.round("dist2", 6).alias("dist2"))


@register("agglomerative_clusters")
def q_agglomerative_clusters(spark, sf):
    """Bottom-up Ward clusters of every group."""
    from corpusprep.operators.agglomerative import ward
    return ward(tb.vectors_by_block(spark, sf), "embedding", 5).select(*GK, "row_idx", "cluster")


@register("hierarchical_clusters")
def q_hierarchical_clusters(spark, sf):
    return cu.bisecting(tb.vectors_by_block(spark, sf), "embedding", 5).select(*GK, "row_idx", "cluster")


@register("pca_2d")
def q_pca_2d(spark, sf):
    return vc.pca_2d(tb.vectors_by_block(spark, sf), "embedding")


@register("knn_graph", f"""
WITH e AS (SELECT workbook, sheet, row_idx, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM ({S.E}) x),
p AS (SELECT a.workbook, a.sheet, a.row_idx AS src, b.row_idx AS dst,
             sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])))) AS distance
      FROM e a JOIN e b ON a.workbook = b.workbook AND a.sheet = b.sheet AND a.row_idx <> b.row_idx),
r AS (SELECT *, row_number() OVER (PARTITION BY workbook, sheet, src ORDER BY distance, dst) AS rn FROM p)
SELECT workbook, sheet, src, dst, round(distance, 6) AS distance, CAST(rn AS INTEGER) AS rank FROM r WHERE rn <= 10""")
def q_knn_graph(spark, sf):
    return vc.knn_graph(tb.vectors_by_block(spark, sf), "embedding", k=10) \
        .select(*GK, "src", "dst", F.round("distance", 6).alias("distance"), "rank")


@register("cluster_corpus")
def q_cluster_corpus(spark, sf):
    _, summary = cp.cluster_corpus(tb.docs_by_lang(spark, sf), ["source", "text"], k=5)
    return summary.select(*GK, "records", "clusters", "algorithm")


# ======================================================================
# files: workbook source and sinks (step 6)
# ======================================================================
from corpusprep.operators import report as rp  # noqa: E402
from corpusprep.session import scratch_path  # noqa: E402
from corpusprep.sources import xlsx as xl  # noqa: E402

ROWS_PER_BOOK = 500
_BOOK_COLS = ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice"]
_BOOK_SQL = f"'book-' || lpad(CAST(p_partkey // {ROWS_PER_BOOK} AS VARCHAR), 5, '0')"


def _write_part_books(spark, sf, empty_sheets=()):
    """Workbooks derived from ``part``: book = p_partkey div 500, one
    worksheet per brand; returns the folder."""
    folder = scratch_path(spark, "xlsx")
    p = tb.read_table(spark, sf, "part").withColumn(
        "book", F.concat(F.lit("book-"), F.lpad(F.floor(F.col("p_partkey") / ROWS_PER_BOOK).cast("string"), 5, "0")))
    xl.write_workbooks(p, folder, "book", "p_brand", _BOOK_COLS, order_col="p_partkey",
                       empty_sheets=tuple(empty_sheets)).collect()  # one small row per written workbook
    return folder


_BOOK_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_type", T.StringType()), T.StructField("p_size", T.LongType()),
    T.StructField("p_retailprice", T.DoubleType())])


def _typed_books(raw):
    return ty.typed_projection(xl.good_rows(raw), _BOOK_SCHEMA, keys=["workbook", "sheet", "row_idx"])


@register("xlsx_roundtrip", """
SELECT p_brand AS sheet, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(p_size) AS BIGINT) AS sum_size,
       CAST(count(DISTINCT p_type) AS BIGINT) AS n_types, round(sum(p_retailprice), 4) AS sum_price,
       CAST(sum(p_partkey) AS BIGINT) AS sum_key
FROM part GROUP BY p_brand""")
def q_xlsx_roundtrip(spark, sf):
    t = _typed_books(xl.read_workbooks(spark, _write_part_books(spark, sf)))
    return t.groupBy("sheet").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.sum("p_size").cast("bigint").alias("sum_size"),
        F.count_distinct("p_type").cast("bigint").alias("n_types"),
        F.round(F.sum("p_retailprice"), 4).alias("sum_price"), F.sum("p_partkey").cast("bigint").alias("sum_key"))


@register("xlsx_select_files", f"""
SELECT {_BOOK_SQL} || '.xlsx' AS workbook, p_brand AS sheet, CAST(count(*) AS BIGINT) AS n_rows
FROM part WHERE (p_partkey // {ROWS_PER_BOOK}) % 2 = 0 GROUP BY 1, 2""")
def q_xlsx_select_files(spark, sf):
    folder = _write_part_books(spark, sf)
    books = xl.list_workbooks(folder)
    chosen = ", ".join(b for i, b in enumerate(books) if int(b[5:10]) % 2 == 0) + ", ,"
    raw = xl.read_workbooks(spark, folder, files=chosen)
    return xl.good_rows(raw).groupBy("workbook", "sheet").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


@register("xlsx_bad_files", f"""
SELECT {_BOOK_SQL} || '.xlsx' AS workbook, CAST(count(*) AS BIGINT) AS n_rows, false AS failed
FROM part GROUP BY 1
UNION ALL SELECT 'broken.xlsx', CAST(0 AS BIGINT), true""")
def q_xlsx_bad_files(spark, sf):
    folder = _write_part_books(spark, sf)
    xl.write_bytes(f"{folder}/broken.xlsx", b"this is not a zip archive")
    raw = xl.read_workbooks(spark, folder)
    return raw.groupBy("workbook").agg(
        F.count(F.col("row_idx")).cast("bigint").alias("n_rows"),
        F.bool_or(F.col("_error").isNotNull()).alias("failed"))


ORDERS_PER_BOOK = 250_000
_ORDER_COLS = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"]
_ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderdate", T.TimestampType()),
    T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderpriority", T.StringType())])


def _write_order_books(spark, sf):
    """Workbooks derived from ``orders``: a worksheet per status, dates as
    styled serial numbers, unspecified priorities as the word ``N/A``."""
    folder = scratch_path(spark, "xlsx")
    o = tb.read_table(spark, sf, "orders").withColumn(
        "book", F.concat(F.lit("orders-"), F.floor(F.col("o_orderkey") / ORDERS_PER_BOOK).cast("string"))) \
        .withColumn("o_orderpriority", F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "N/A").otherwise(F.col("o_orderpriority")))
    xl.write_workbooks(o, folder, "book", "o_orderstatus", _ORDER_COLS, order_col="o_orderkey").collect()  # a small row per workbook
    return folder


@register("xlsx_typed_cells", f"""
SELECT 'orders-' || CAST(o_orderkey // {ORDERS_PER_BOOK} AS VARCHAR) || '.xlsx' AS workbook, o_orderstatus AS sheet,
       CAST(row_number() OVER (PARTITION BY o_orderkey // {ORDERS_PER_BOOK}, o_orderstatus ORDER BY o_orderkey) - 1 AS BIGINT) AS row_idx,
       o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_totalprice,
       nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
FROM orders""")
def q_xlsx_typed_cells(spark, sf):
    """Every cell of the order workbooks, each worksheet read by several tasks."""
    raw = xl.read_workbooks(spark, _write_order_books(spark, sf), split_bytes=1 << 18)
    t = ty.typed_projection(xl.good_rows(raw), _ORDER_SCHEMA, keys=["workbook", "sheet", "row_idx"])
    return t.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@register("scan_summary", f"""
SELECT workbook, CAST(count_if(NOT skipped) AS BIGINT) AS n_sheets,
       string_agg(CASE WHEN NOT skipped THEN sheet END, ', ' ORDER BY sheet) AS sheets,
       CAST(sum(CASE WHEN NOT skipped THEN n ELSE 0 END) AS BIGINT) AS n_rows,
       CAST(count_if(skipped) AS BIGINT) AS n_skipped FROM (
  SELECT {_BOOK_SQL} || '.xlsx' AS workbook, p_brand AS sheet, count(*) AS n,
         {_sql_norm('p_brand')} IN ('brand#1', 'brand#2') AS skipped
  FROM part GROUP BY 1, 2, 4) s GROUP BY workbook""")
def q_scan_summary(spark, sf):
    sheets = xl.read_workbooks(spark, _write_part_books(spark, sf), skip="Brand#1, AWS_Brand#2", output="sheets")
    kept = ~F.col("skipped")
    return xl.good_rows(sheets).groupBy("workbook").agg(
        F.count_if(kept).cast("bigint").alias("n_sheets"),
        F.array_join(F.sort_array(F.collect_list(F.when(kept, F.col("sheet")))), ", ").alias("sheets"),
        F.sum(F.when(kept, F.col("n_rows")).otherwise(0)).cast("bigint").alias("n_rows"),
        F.count_if(F.col("skipped")).cast("bigint").alias("n_skipped"))


@register("nonempty_groups", f"""
SELECT workbook, sheet, n_rows, n_rows > 0 AS kept FROM (
  SELECT {_BOOK_SQL} || '.xlsx' AS workbook, p_brand AS sheet, CAST(count(*) AS BIGINT) AS n_rows FROM part GROUP BY 1, 2
  UNION ALL
  SELECT DISTINCT {_BOOK_SQL} || '.xlsx', 'Empty', CAST(0 AS BIGINT) FROM part) g""")
def q_nonempty_groups(spark, sf):
    folder = _write_part_books(spark, sf, empty_sheets=("Empty",))
    catalog = xl.good_rows(xl.read_workbooks(spark, folder, output="sheets"))
    rows = xl.good_rows(xl.read_workbooks(spark, folder))
    return fl.nonempty_groups(catalog, rows)


@register("csv_roundtrip", f"""
WITH {_KM_SEEDS}
SELECT a.workbook, a.sheet, a.row_idx, e.label, a.cluster FROM a
JOIN e ON a.workbook = e.workbook AND a.sheet = e.sheet AND a.row_idx = e.row_idx""")
def q_csv_roundtrip(spark, sf):
    e = tb.vectors_by_block(spark, sf)
    a = cu.assign(e, "embedding", cu.seed_centroids(e, "embedding", 5)).drop("embedding", "dist2")
    path = scratch_path(spark, "csv")
    rp.write_csv(a, path)
    schema = "row_idx bigint, label string, cluster int, workbook string, sheet string"
    return spark.read.schema(schema).option("header", True).csv(path) \
        .select("workbook", "sheet", "row_idx", "label", "cluster")


@register("report_json", _EXACT_REPORT + """
SELECT workbook, sheet, CAST(num_train AS BIGINT) AS num_train, CAST(num_test AS BIGINT) AS num_test,
       CAST(exact_duplicates AS BIGINT) AS exact_duplicates FROM r""")
def q_report_json(spark, sf):
    rep = lk.sheet_report(d_split(spark, sf), "ctext", threshold=None)
    path = scratch_path(spark, "json")
    rp.write_json_report(rep, path)
    return spark.read.schema("workbook string, sheet string, num_train bigint, num_test bigint, "
                             "exact_duplicates bigint").json(path)


@register("versioned_write", f"""
SELECT 'nb' AS model, 'v1' AS version, workbook, sheet, CAST(count(*) AS BIGINT) AS n_rows
FROM ({S.R}) r GROUP BY workbook, sheet""")
def q_versioned_write(spark, sf):
    path = scratch_path(spark, "versioned")
    r = tb.parts_by_brand(spark, sf)
    rp.versioned_write(r, path, "nb", "v1")
    rp.versioned_write(r.where(F.col("sheet") == "Brand#1"), path, "nb", "v1")  # rewrites one group only
    back = spark.read.parquet(path)
    return back.groupBy("model", "version", "workbook", "sheet").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


# ======================================================================
# leakage candidate steps, reports, evaluation status (steps 3 and 4)
# ======================================================================
_BAND = f"""
s AS ({D_SPLIT}),
tt AS (SELECT DISTINCT workbook, sheet, split, md5(ctext) AS tid, length(ctext) AS len, ctext FROM s),
band AS (SELECT a.workbook, a.sheet, a.tid AS atid, b.tid AS btid, a.len AS alen, b.len AS blen
         FROM tt a JOIN tt b ON a.workbook = b.workbook AND a.sheet = b.sheet
         WHERE a.split = 'train' AND b.split = 'test' AND a.tid <> b.tid
           AND 2 * least(a.len, b.len) >= 0.9 * (a.len + b.len) - 1e-9)"""


@register("len_band_pairs", f"""
WITH {_BAND}
SELECT workbook, sheet, CAST(count(*) AS BIGINT) AS band_pairs FROM band GROUP BY workbook, sheet""")
def q_len_band_pairs(spark, sf):
    p = lk.length_band_pairs(d_split(spark, sf), "ctext")
    return p.groupBy(*GK).agg(F.count(F.lit(1)).cast("bigint").alias("band_pairs"))


@register("char_overlap_pairs", f"""
WITH {_BAND},
ch AS (SELECT tid, c, count(*) AS n FROM (SELECT DISTINCT tid, ctext FROM tt) x,
       unnest(string_split(ctext, '')) AS u(c) GROUP BY tid, c),
ov AS (SELECT band.workbook, band.sheet, atid, btid, alen, blen, sum(least(x.n, y.n)) AS o
       FROM band JOIN ch x ON x.tid = band.atid JOIN ch y ON y.tid = band.btid AND x.c = y.c
       GROUP BY band.workbook, band.sheet, atid, btid, alen, blen)
SELECT workbook, sheet, CAST(count(*) AS BIGINT) AS overlap_pairs FROM ov
WHERE o >= 0.9 * (alen + blen) / 2.0 - 1e-9 GROUP BY workbook, sheet""")
def q_char_overlap_pairs(spark, sf):
    p = lk.char_overlap_pairs(d_split(spark, sf), "ctext")
    return p.groupBy(*GK).agg(F.count(F.lit(1)).cast("bigint").alias("overlap_pairs"))


@register("minhash_pairs")
def q_minhash_pairs(spark, sf):
    return lk.minhash_pairs(d_split(spark, sf), "ctext")


@register("nested_report", _EXACT_REPORT + """
SELECT workbook, CAST(count(*) AS INTEGER) AS n_sheets, CAST(sum(num_train) AS BIGINT) AS total_train,
       min(sheet) AS first_sheet, CAST(sum(exact_duplicates) AS BIGINT) AS exact_duplicates
FROM r GROUP BY workbook""")
def q_nested_report(spark, sf):
    rep = lk.sheet_report(d_split(spark, sf), "ctext", threshold=None)
    n = rp.nest(rep, ["workbook"], "sheets", order=["sheet"])
    return n.select(
        "workbook", F.size("sheets").cast("int").alias("n_sheets"),
        F.aggregate("sheets", F.lit(0).cast("bigint"), lambda a, s: a + s["num_train"]).alias("total_train"),
        F.col("sheets")[0]["sheet"].alias("first_sheet"),
        F.aggregate("sheets", F.lit(0).cast("bigint"), lambda a, s: a + s["exact_duplicates"]).alias("exact_duplicates"))


Q_SPLIT = S.split(S.with_text(S.Q, ["text"]), "toxic")


@register("eval_by_group", "WITH " + S.nb_ctes(Q_SPLIT, "quality") + """,
acc AS (SELECT workbook, sheet, avg(CAST(pred_id = label_id AS DOUBLE)) AS accuracy FROM ev GROUP BY workbook, sheet),
wf AS (SELECT workbook, sheet, sum(f1 * support) / sum(support) AS f1 FROM repf GROUP BY workbook, sheet),
cnts AS (SELECT workbook, sheet, count_if(split = 'train') AS ntr, count_if(split = 'test') AS nte FROM s
         GROUP BY workbook, sheet),
nl AS (SELECT workbook, sheet, count(*) AS num_labels FROM lmap GROUP BY workbook, sheet)
SELECT c.workbook, c.sheet,
       CASE WHEN c.ntr > 0 AND c.nte > 0 THEN CAST(nl.num_labels AS INTEGER) END AS num_labels,
       CASE WHEN c.ntr > 0 AND c.nte > 0 THEN round(acc.accuracy, 9) END AS accuracy,
       CASE WHEN c.ntr > 0 AND c.nte > 0 THEN round(wf.f1, 9) END AS f1,
       CASE WHEN c.ntr > 0 AND c.nte > 0 THEN 'trained' ELSE 'skipped' END AS status
FROM cnts c LEFT JOIN nl ON c.workbook = nl.workbook AND c.sheet = nl.sheet
LEFT JOIN acc ON c.workbook = acc.workbook AND c.sheet = acc.sheet
LEFT JOIN wf ON c.workbook = wf.workbook AND c.sheet = wf.sheet""")
def q_eval_by_group(spark, sf):
    q = tb.docs_labelled(spark, sf).withColumn("ctext", tx.tagged_text(["text"]))
    s = sp.split_by_labels(q, ["quality", "toxic"])
    _, summary = cp.classify_corpus(s, "ctext", ["quality", "toxic"])
    return summary.select(*GK, "num_labels", F.round("accuracy", 9).alias("accuracy"),
                          F.round("f1", 9).alias("f1"), "status")


@register("lr_predict")
def q_lr_predict(spark, sf):
    return cl.lr_evaluate(l_split(spark, sf), "ctext", "lang").select(
        *GK, "row_idx", "label_id", "pred_id", F.round("confidence", 4).alias("confidence"))


@register("leakage_scope_workbook")
def q_leakage_scope_workbook(spark, sf):
    """Leakage across all sheets of a workbook (scope='workbook')."""
    return lk.sheet_report(d_split(spark, sf), "ctext", by=lk.scope_cols("workbook"))


@register("leakage_scope_corpus", f"""
WITH RECURSIVE s AS ({D_SPLIT}),
{S.near([])},
t AS (SELECT ctext, bool_or(split = 'train') AS a, bool_or(split = 'test') AS b FROM s GROUP BY ctext)
SELECT CAST(count_if(split = 'train') AS BIGINT) AS num_train, CAST(count_if(split = 'test') AS BIGINT) AS num_test,
       (SELECT CAST(count_if(a AND b) AS BIGINT) FROM t) AS exact_duplicates,
       (SELECT CAST(coalesce(sum(pairs), 0) AS BIGINT) FROM near) AS near_duplicates
FROM s""")
def q_leakage_scope_corpus(spark, sf):
    """Exact and near leakage over the whole corpus (scope='corpus', no group columns)."""
    return lk.sheet_report(d_split(spark, sf), "ctext", by=lk.scope_cols("corpus"))


@register("leakage_scope_corpus_near")
def q_leakage_scope_corpus_near(spark, sf):
    """Exact and near leakage over the whole corpus at the production threshold (scope='corpus')."""
    return lk.sheet_report(d_split(spark, sf), "ctext", by=lk.scope_cols("corpus"))


# ======================================================================
# DBSCAN (step 5)
# ======================================================================
from corpusprep.operators import dbscan as db  # noqa: E402

DB_EPS = 0.9


@register("dbscan_core_points", f"""
WITH e AS ({S.E}),
n AS (SELECT workbook, sheet, row_idx, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
             sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm FROM e),
u AS (SELECT workbook, sheet, row_idx, list_transform(v, lambda x: x / nrm) AS v FROM n),
p AS (SELECT a.workbook, a.sheet, a.row_idx,
             sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])))) AS d
      FROM u a JOIN u b ON a.workbook = b.workbook AND a.sheet = b.sheet)
SELECT workbook, sheet, row_idx, CAST(count(*) AS BIGINT) AS n_neighbors, count(*) >= 5 AS is_core
FROM p WHERE d <= sqrt(2 * {DB_EPS}) + 1e-12 GROUP BY workbook, sheet, row_idx""")
def q_dbscan_core_points(spark, sf):
    return db.core_points(tb.vectors_by_block(spark, sf), "embedding", eps=DB_EPS)


@register("dbscan_labels", f"""
WITH RECURSIVE e AS ({S.E}),
n AS (SELECT workbook, sheet, row_idx, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
             sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm FROM e),
u AS (SELECT workbook, sheet, row_idx, list_transform(v, lambda x: x / nrm) AS v FROM n),
p AS (SELECT a.workbook, a.sheet, a.row_idx AS x, b.row_idx AS y
      FROM u a JOIN u b ON a.workbook = b.workbook AND a.sheet = b.sheet
      WHERE sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2]))))
            <= sqrt(2 * {DB_EPS}) + 1e-12),
core AS (SELECT workbook, sheet, x FROM p GROUP BY workbook, sheet, x HAVING count(*) >= 5),
ce AS (SELECT p.* FROM p JOIN core a ON a.workbook = p.workbook AND a.sheet = p.sheet AND a.x = p.x
       JOIN core b ON b.workbook = p.workbook AND b.sheet = p.sheet AND b.x = p.y),
reach AS (SELECT workbook, sheet, x, y FROM ce
          UNION SELECT r.workbook, r.sheet, r.x, c.y FROM reach r
          JOIN ce c ON c.workbook = r.workbook AND c.sheet = r.sheet AND c.x = r.y),
comp AS (SELECT workbook, sheet, x, min(y) AS c FROM reach GROUP BY workbook, sheet, x),
edge AS (SELECT p.workbook, p.sheet, p.x, min(comp.c) AS c FROM p
         JOIN comp ON comp.workbook = p.workbook AND comp.sheet = p.sheet AND comp.x = p.y
         GROUP BY p.workbook, p.sheet, p.x),
l AS (SELECT e.workbook, e.sheet, e.row_idx, coalesce(comp.c, edge.c) AS c FROM e
      LEFT JOIN comp ON comp.workbook = e.workbook AND comp.sheet = e.sheet AND comp.x = e.row_idx
      LEFT JOIN edge ON edge.workbook = e.workbook AND edge.sheet = e.sheet AND edge.x = e.row_idx),
k AS (SELECT workbook, sheet, c, dense_rank() OVER (PARTITION BY workbook, sheet ORDER BY c) - 1 AS cid
      FROM (SELECT DISTINCT workbook, sheet, c FROM l WHERE c IS NOT NULL) d)
SELECT l.workbook, l.sheet, l.row_idx, CAST(coalesce(k.cid, -1) AS INTEGER) AS cluster
FROM l LEFT JOIN k ON k.workbook = l.workbook AND k.sheet = l.sheet AND k.c = l.c""")
def q_dbscan_labels(spark, sf):
    r = db.dbscan(tb.vectors_by_block(spark, sf), "embedding", eps=DB_EPS)
    return r.select(*GK, "row_idx", "cluster")


@register("inference_samples", "WITH " + S.nb_ctes(L_SPLIT, "lang", test_text="substr(ctext, 1, 250)") + f""",
ord AS (SELECT workbook, sheet, row_idx, substr(ctext, 1, 250) AS text,
               row_number() OVER (PARTITION BY workbook, sheet ORDER BY {S.shuffle_key()}, row_idx) AS rn
        FROM s WHERE split = 'test')
SELECT o.workbook, o.sheet, CAST(o.rn AS INTEGER) AS rn, o.text, ev.pred_label AS predicted_label,
       round(ev.confidence, 4) AS confidence
FROM ord o JOIN ev ON o.workbook = ev.workbook AND o.sheet = ev.sheet AND o.row_idx = ev.row_idx
WHERE o.rn <= 5""")
def q_inference_samples(spark, sf):
    s = l_split(spark, sf)
    return cl.inference_samples(s, cl.nb_fit(s, "ctext", "lang"), "ctext").select(
        *GK, "rn", "text", "predicted_label", F.round("confidence", 4).alias("confidence"))


def _balanced_accuracy(conf):
    """Example user metric over a group's confusion counts: mean recall."""
    recalls = []
    for cls, g in conf.groupby("label_id"):
        recalls.append(g.loc[g.pred_id == cls, "n"].sum() / g["n"].sum())
    return {"balanced_accuracy": round(float(sum(recalls) / len(recalls)), 9)}


@register("clf_custom_metric", _NB + """
SELECT workbook, sheet, round(avg(recall), 9) AS balanced_accuracy FROM rep WHERE support > 0
GROUP BY workbook, sheet""")
def q_clf_custom_metric(spark, sf):
    return cl.custom_metrics(_nb_eval(spark, sf), _balanced_accuracy, "balanced_accuracy double")


@register("near_dup_samples")
def q_near_dup_samples(spark, sf):
    """First five near-duplicate pairs per group (test order, then train order)."""
    pairs = lk.near_duplicate_pairs(d_split(spark, sf), "ctext")
    s = lk.sample_pairs(pairs)
    return s.select(*GK, F.explode("sample_near_duplicates").alias("p")).select(
        *GK, F.col("p.n").alias("rn"), F.md5("p.train_text").alias("train_md5"),
        F.md5("p.test_text").alias("test_md5"), F.col("p.similarity").alias("similarity"))
