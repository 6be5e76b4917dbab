"""The same results as plain SQL over the test tables."""

from __future__ import annotations

from workload.queries import CHECK_TIME, JOB_ID, MODES, PRIORITY, PRIORITY_FULL, SINCE
from workload.tables import DUCK_DIRTY_CUSTOMER as DIRTY
from workload.tables import DUCK_STATEFUL_ORDERS as STATEFUL
from workload.tables import HARD_TEXT

ORACLE: dict[str, str] = {}

GRADED = """
SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

CATALOGUE = """
SELECT p_partkey AS id, p_name AS name, upper(p_name) AS "originalName",
  p_type AS description, p_size AS "openProperty", p_brand AS "openCondition",
  0 AS deleted, timestamp '2018-12-17 00:00:00' AS "createdAt",
  timestamp '2018-12-18 00:00:00' AS "updatedAt", p_brand || '/' || p_type AS structured
FROM part
"""


def score(legal: str, total: str) -> str:
    """Percent rounded up at 10 decimals, then cut to 2; NULL without rows."""
    rows = f"nullif({total}, 0)::HUGEINT"
    up = f"(({legal})::HUGEINT * 1000000000000::HUGEINT + {rows} - 1) // {rows}"
    return f"(({up}) // 100000000::HUGEINT)::DOUBLE / 100"


def two_way(source: str, legal: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    return f"""
    SELECT {by + ',' if by else ''} total, legal, total - legal AS illegal,
      {score('legal', 'total')} AS score
    FROM (SELECT {by + ',' if by else ''} count(*) AS total,
            count(*) FILTER (WHERE {legal}) AS legal FROM ({source}) {group})"""


def regex_way(source: str, column: str, legal: str, by: str = "", empty: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    empty = empty or f"({column} IS NULL OR {column} = '')"
    return f"""
    SELECT {by + ',' if by else ''} total, legal, null_or_empty,
      total - legal - null_or_empty AS illegal, illegal_strict, {score('legal', 'total')} AS score
    FROM (SELECT {by + ',' if by else ''} count(*) AS total,
            count(*) FILTER (WHERE {legal}) AS legal,
            count(*) FILTER (WHERE {empty}) AS null_or_empty,
            count(*) FILTER (WHERE NOT coalesce({legal}, false) AND NOT {empty}) AS illegal_strict
          FROM ({source}) {group})"""


def rule_row(name: str, column: str, body: str) -> str:
    return f"SELECT '{name}' AS rule, '{column}' AS column_name, * FROM ({body})"


FOUND = f"regexp_matches(checked, '{PRIORITY}')"

# Sources

ORACLE["scan_table"] = "SELECT * FROM orders"
ORACLE["generic_source"] = """
SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_custkey > 100 AND o_totalprice < 200000"""
ORACLE["metastore_scan"] = """
SELECT *, year(o_orderdate)::INTEGER AS o_year FROM orders
WHERE year(o_orderdate) >= 1993 AND year(o_orderdate) % 2 = 0
  AND year(o_orderdate) IN (SELECT year(l_shipdate) FROM lineitem)"""
ORACLE["dispatched_copy"] = "SELECT o_orderkey, o_orderpriority FROM orders"
ORACLE["incremental_scan"] = f"SELECT * FROM orders WHERE o_orderdate >= timestamp '{SINCE}'"
ORACLE["partition_bounds"] = ORACLE["jdbc_bounds"] = """
SELECT min(o_orderkey) AS lower_bound, max(o_orderkey) AS upper_bound, count(*) AS row_count
FROM orders"""
ORACLE["jdbc_scan"] = "SELECT * FROM customer"
ORACLE["jdbc_partitioned_scan"] = "SELECT * FROM orders"
ORACLE["jdbc_balanced_scan"] = "SELECT o_orderkey * o_orderkey AS k, o_orderpriority FROM orders"
ORACLE["jdbc_hashed_scan"] = DIRTY
ORACLE["jdbc_hot_key_scan"] = """
SELECT CASE WHEN o_orderkey % 10 > 0 THEN 5 ELSE o_orderkey END AS k, o_custkey, o_orderpriority
FROM orders"""
ORACLE["jdbc_incremental_scan"] = f"""
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderdate >= timestamp '{SINCE}'"""
ORACLE["libsvm_scan"] = """
SELECT l_extendedprice AS label, l_quantity, l_discount, l_tax FROM lineitem"""
ORACLE["catalog_list"] = CATALOGUE
ORACLE["catalog_by_class"] = f"""
SELECT * FROM ({CATALOGUE}) WHERE id = (SELECT o_custkey FROM orders WHERE o_orderkey = 7)"""
ORACLE["catalog_by_class_semi"] = f"""
SELECT * FROM ({CATALOGUE}) WHERE id IN (SELECT l_partkey FROM lineitem WHERE l_suppkey = 7)"""

# Sinks

ORACLE["csv_roundtrip"] = f"SELECT id, {HARD_TEXT} AS hard, phone, mail FROM ({DIRTY})"
ORACLE["sorted_export"] = "SELECT * FROM orders"
ORACLE["split_legal_illegal"] = f"""
SELECT o_orderkey, checked, checked IS NOT NULL AS is_legal FROM ({STATEFUL})"""
ORACLE["sql_over_view"] = f"""
SELECT o_orderkey, o_orderpriority FROM orders
WHERE regexp_matches(o_orderpriority, '{PRIORITY}')"""
ORACLE["jdbc_append_roundtrip"] = f"""
SELECT id, name, phone, repeat(name, 100) AS long, {HARD_TEXT} AS hard
FROM ({DIRTY}), (VALUES (1), (2)) AS copies(copy)"""
for name in ("jdbc_copy_once", "jdbc_overwrite_roundtrip"):
    ORACLE[name] = "SELECT * FROM customer"
ORACLE["upsert_by_key"] = ORACLE["jdbc_merge"] = """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN upper('new ' || o_orderpriority) ELSE o_orderpriority END
    AS o_orderpriority, o_orderstatus
FROM orders
UNION ALL
SELECT -o_orderkey - 1, o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus = 'P'"""
ORACLE["upsert_partitioned"] = """
WITH o AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus, year(o_orderdate)::INTEGER AS y FROM orders)
SELECT o_orderkey, CASE WHEN y = 1996 THEN 'new' ELSE o_orderpriority END AS o_orderpriority,
  o_orderstatus, CASE WHEN y = 1993 THEN 2030 ELSE y END::INTEGER AS o_year FROM o
UNION ALL SELECT -o_orderkey - 1, o_orderpriority, o_orderstatus, y FROM o WHERE y = 1998"""
ORACLE["invalid_marks"] = ORACLE["mark_table_roundtrip"] = f"""
SELECT cast(o_orderkey AS varchar) AS "SOURCE_TABLE_PK", 'bad priority' AS "RESULT",
  'checked' AS "COLUMN_NAME", '{CHECK_TIME}' AS "CHECK_START_TIME"
FROM ({STATEFUL}) WHERE NOT {FOUND}"""

# Projections and filters

ORACLE["project_alias"] = """
SELECT c_custkey AS id, upper(c_mktsegment) AS segment,
  cast(c_nationkey AS varchar) || '-' || c_name AS label FROM customer"""
ORACLE["drop_columns"] = "SELECT * FROM orders"
ORACLE["stamp_check_state"] = f"""
SELECT o_orderkey, timestamp '{CHECK_TIME}' AS jcsjc FROM orders"""
ORACLE["row_to_json"] = f"""
SELECT id, cast(json_object(
    'id', cast(id AS varchar), 'name', trim(name), 'phone', coalesce(trim(phone), ' '),
    'mail', coalesce(trim(mail), ' '), 'id_card', coalesce(trim(id_card), ' ')) AS varchar) AS json
FROM ({DIRTY})"""
ORACLE["null_legal_rows"] = f"SELECT * FROM ({GRADED}) WHERE quality IS NOT NULL"
ORACLE["null_illegal_rows"] = f"SELECT doc_id, lang FROM ({GRADED}) WHERE quality IS NULL"
ORACLE["blank_legal_rows"] = f"SELECT * FROM ({DIRTY}) WHERE phone <> ''"
ORACLE["blank_illegal_rows"] = f"SELECT * FROM ({DIRTY}) WHERE phone = ''"
SAMPLE = f"""
SELECT * FROM ({STATEFUL})
WHERE NOT regexp_full_match(coalesce(checked, 'null'), '{PRIORITY_FULL}')
ORDER BY o_orderkey LIMIT 100"""
ORACLE["illegal_sample"] = f"SELECT * EXCLUDE (jcsjc) FROM ({SAMPLE})"
ORACLE["illegal_detail"] = f"""
SELECT '{JOB_ID}' AS "jobId", cast(json_object(
    'o_orderkey', cast(o_orderkey AS varchar), 'o_custkey', cast(o_custkey AS varchar),
    'o_orderstatus', o_orderstatus, 'o_orderdate', cast(o_orderdate AS varchar),
    'checked', coalesce(checked, ' ')) AS varchar) AS illgeadata
FROM ({SAMPLE})"""
ORACLE["pending_sentinel"] = f"""
SELECT * FROM ({STATEFUL}) WHERE jcsjc = timestamp '2100-01-01 00:00:00'"""
ORACLE["pending_null"] = f"SELECT * FROM ({STATEFUL}) WHERE jcsjc IS NULL"

# Checks

ORACLE["row_count"] = "SELECT count(*) AS total FROM lineitem"
ORACLE["null_check"] = two_way(GRADED, "quality IS NOT NULL")
ORACLE["null_check_by_group"] = two_way(GRADED, "quality IS NOT NULL", "lang")
ORACLE["blank_check"] = two_way(DIRTY, "phone <> ''")
ORACLE["regex_check"] = regex_way(
    "SELECT * FROM orders", "o_orderpriority", f"regexp_matches(o_orderpriority, '{PRIORITY}')"
)
ORACLE["regex_check_nulls"] = regex_way(
    STATEFUL, "checked", "regexp_matches(checked, '^([12]-.*)?')"
)
ORACLE["regex_check_long_text"] = regex_way(
    "SELECT * FROM documents", "text", "regexp_matches(text, '[A-Za-z0-9.]+@[a-z]+[.][a-z]+')"
)
ORACLE["regex_check_by_group"] = regex_way(STATEFUL, "checked", FOUND, "o_orderstatus")
ORACLE["regex_legal_count"] = f"""
SELECT count(*) AS legal FROM orders WHERE regexp_matches(o_orderpriority, '{PRIORITY}')"""
ORACLE["null_or_empty_count"] = f"""
SELECT count(*) AS null_or_empty FROM ({STATEFUL}) WHERE checked IS NULL OR checked IN ('', chr(10))"""
ORACLE["illegal_full_match_count"] = f"""
SELECT count(*) AS illegal_full FROM ({STATEFUL})
WHERE NOT regexp_full_match(coalesce(checked, 'null'), '{PRIORITY_FULL}')"""
ORACLE["quality_score"] = f"""
SELECT o_custkey, total, legal, {score('legal', 'total')} AS score
FROM (SELECT o_custkey, count(*) AS total,
        count(*) FILTER (WHERE regexp_matches(o_orderpriority, '{PRIORITY}')) AS legal
      FROM orders GROUP BY o_custkey)"""
ORACLE["macro_summary"] = f"""
WITH c AS ({regex_way(STATEFUL, 'checked', FOUND)}),
r AS (SELECT '0' AS isvalid, '不合格' AS checktype, illegal AS n, total FROM c
      UNION ALL SELECT '1', '合格', legal, total FROM c
      UNION ALL SELECT '0', '空', null_or_empty, total FROM c)
SELECT 'regex check' AS taskname, '{JOB_ID}' AS "jobId", isvalid, checktype, n AS "Count",
  (n * 10000 // total) / 100.0::DOUBLE AS percent, '{CHECK_TIME}' AS "Checktime"
FROM r"""
ORACLE["multi_rule_check"] = " UNION ALL ".join([
    rule_row("priority", "checked", regex_way(STATEFUL, "checked", FOUND)),
    rule_row("closed", "o_orderstatus", regex_way(
        STATEFUL, "o_orderstatus", "regexp_full_match(o_orderstatus, '[FO]')")),
    rule_row("present", "checked", regex_way(
        STATEFUL, "checked", "checked IS NOT NULL", empty="false")),
    rule_row("filled", "checked", regex_way(
        STATEFUL, "checked", "checked <> ''", empty="false")),
])
ORACLE["rule_template_check"] = " UNION ALL ".join([
    rule_row("mobile number", "phone", regex_way(
        DIRTY, "phone", "regexp_matches(phone, '^1[368][0-9]{9}$')")),
    rule_row("mail address", "mail", regex_way(
        DIRTY, "mail", "regexp_matches(mail, '^[^@]+@[^@]+[.][a-z]+')")),
    rule_row("identity number present", "id_card", regex_way(
        DIRTY, "id_card", "id_card IS NOT NULL", empty="false")),
    rule_row("identity number filled", "id_card", regex_way(
        DIRTY, "id_card", "id_card <> ''", empty="false")),
])

# Numbering

ORACLE["row_number_global"] = """
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS rownum FROM orders"""
ORACLE["row_number_ranged"] = """
SELECT l_orderkey, l_linenumber,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS rownum FROM lineitem"""
ORACLE["row_number_hot_key"] = """
SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderstatus) AS rownum FROM orders"""
ORACLE["pending_numbered"] = f"""
SELECT o_orderkey, checked, row_number() OVER (ORDER BY o_orderkey) AS rownum
FROM ({STATEFUL}) WHERE jcsjc = timestamp '2100-01-01 00:00:00'"""

# Scalars

STAR_REST = "CASE WHEN length({0}) > 1 THEN substr({0}, 1, 1) || repeat('*', length({0}) - 1) ELSE {0} END"
MASK_PHONE = """
CASE WHEN regexp_full_match(phone, '0?(13|14|15|18|17)[0-9]{9}')
     THEN substr(phone, 1, 3) || '****' || substr(phone, 8)
     WHEN length(phone) > 3
     THEN substr(phone, 1, 3) || regexp_replace(substr(phone, 4), '[0-9]', '*', 'g')
     ELSE phone END"""
MASK_CARD = """
CASE WHEN regexp_full_match(id_card, '[0-9]{15}')
     THEN substr(id_card, 1, 6) || '******' || substr(id_card, 13)
     WHEN regexp_full_match(id_card, '[0-9]{17}[0-9|x%s]')
     THEN substr(id_card, 1, 6) || '********' || substr(id_card, 15)
     ELSE id_card END"""
MASK_MAIL = """
CASE WHEN strpos(mail, '@') > 0
     THEN repeat('*', strpos(mail, '@') - 1) || substr(mail, strpos(mail, '@'))
     ELSE mail END"""

ORACLE["mask_name"] = f"""
SELECT c_custkey, {STAR_REST.format('c_name')} AS name,
  {STAR_REST.format('c_mktsegment')} AS segment FROM customer"""
ORACLE["mask_phone"] = f"SELECT id, {MASK_PHONE} AS phone FROM ({DIRTY})"
ORACLE["mask_id_card"] = f"""
SELECT id, {MASK_CARD % ''} AS id_card, {MASK_CARD % 'X'} AS id_card_upper FROM ({DIRTY})"""
ORACLE["mask_mail"] = f"SELECT id, {MASK_MAIL} AS mail FROM ({DIRTY})"
ORACLE["sql_udf_masks"] = f"""
SELECT id, {STAR_REST.format('name')} AS name, {MASK_PHONE} AS phone,
  {MASK_CARD % ''} AS id_card, {MASK_MAIL} AS mail FROM ({DIRTY})"""
CONTACTS = f"""
SELECT o_orderkey AS id, name, mail, o_orderdate AS ldsjc
FROM orders JOIN ({DIRTY}) c ON o_custkey = c.id
WHERE o_orderdate >= timestamp '{SINCE}'"""
ORACLE["export_masked"] = f"""
SELECT 'plain' AS entry, o_orderkey AS id, o_orderpriority AS name, o_orderdate AS ldsjc
FROM orders WHERE o_orderdate >= timestamp '{SINCE}'
UNION ALL SELECT 'hard', id, {HARD_TEXT}, ldsjc FROM ({CONTACTS})
UNION ALL SELECT 'masked', id, {STAR_REST.format('name')}, ldsjc FROM ({CONTACTS})
UNION ALL SELECT 'selected', id, {MASK_MAIL}, ldsjc FROM ({CONTACTS})"""
ORACLE["strip_quotes"] = """
SELECT c_custkey, c_name AS unquoted, chr(39) || c_name AS half_quoted FROM customer"""
ORACLE["concat_columns"] = f"SELECT id, concat_ws(',', name, phone, mail) AS joined FROM ({DIRTY})"
ORACLE["last_name_part"] = "SELECT page_id, split_part(url, '.', -1) AS last_part FROM pages"
ORACLE["format_timestamp"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
  strftime(ts, '%Y-%m-%d') || ' 00:00:00' AS day_text FROM events"""
ORACLE["encrypt_column"] = f"""
SELECT id, phone AS from_fixed, phone AS from_own,
  phone IS NOT NULL AS sealed FROM ({DIRTY})"""
ORACLE["decrypt_column"] = f"SELECT id, cast(NULL AS varchar) AS plain FROM ({DIRTY})"

# Checks with state

ORACLE["null_check_with_state"] = f"""
SELECT o_orderkey, checked,
  CASE WHEN jcsjc = timestamp '2100-01-01 00:00:00' AND checked IS NOT NULL
       THEN timestamp '{CHECK_TIME}'
       WHEN jcsjc = timestamp '2100-01-01 00:00:00' THEN timestamp '2200-01-01 00:00:00'
       ELSE jcsjc END AS jcsjc
FROM ({STATEFUL})"""
for name in ("null_check_state_job", "jdbc_null_check_state_job"):
    ORACLE[name] = ORACLE["null_check_with_state"]
ORACLE["blank_check_with_state"] = f"""
SELECT o_orderkey, checked,
  CASE WHEN jcsjc IS NULL AND checked <> '' THEN timestamp '{CHECK_TIME}' ELSE jcsjc END AS jcsjc
FROM ({STATEFUL})"""
ORACLE["jdbc_blank_check_state_job"] = ORACLE["blank_check_with_state"]


def job_rows(mode: str, regex: str) -> list[str]:
    """The rows of the four sinks of a regex check, as seven texts."""
    test = "regexp_full_match" if mode == "full" else "regexp_matches"
    legal = f"{test}(checked, '{regex}')"

    def row(sink: str, *values: str) -> str:
        texts = [f"cast({v} AS varchar)" for v in (*values, *["NULL"] * (7 - len(values)))]
        listed = ", ".join(f"{t} AS c{i}" for i, t in enumerate(texts, 1))
        return f"SELECT '{mode}' AS mode, '{sink}' AS sink, {listed}"

    counts = regex_way(STATEFUL, "checked", legal)
    json = f"""json_object('o_orderkey', cast(o_orderkey AS varchar),
      'o_custkey', cast(o_custkey AS varchar), 'o_orderstatus', o_orderstatus,
      'o_orderdate', cast(o_orderdate AS varchar), 'checked', coalesce(checked, ' '))"""
    result = """json_object('total', total, 'legal', legal, 'illegal', illegal,
      'null_or_empty', null_or_empty)"""
    macro = [
        row("macro", "'regex check'", f"'{JOB_ID}'", f"'{flag}'", f"'{label}'", n,
            f"({n} * 10000 // total) / 100.0::DOUBLE", f"'{CHECK_TIME}'") + f" FROM ({counts})"
        for flag, label, n in (("0", "不合格", "illegal"), ("1", "合格", "legal"), ("0", "空", "null_or_empty"))
    ]
    return [
        row("marks", "o_orderkey", "'bad priority'", "'checked'", f"'{CHECK_TIME}'")
        + f" FROM ({STATEFUL}) WHERE NOT {legal}",
        *macro,
        row("detail", f"'{JOB_ID}'", json)
        + f""" FROM (SELECT * FROM ({STATEFUL})
          WHERE NOT regexp_full_match(coalesce(checked, 'null'), '{regex}')
          ORDER BY o_orderkey LIMIT 100)""",
        row("result", f"'{JOB_ID}'", result, "score") + f" FROM ({counts})",
    ]


ORACLE["regex_check_job"] = ORACLE["jdbc_regex_check_job"] = " UNION ALL ".join(
    [sql for mode, regex in MODES.items() for sql in job_rows(mode, regex)]
)
ORACLE["pending_state_counts"] = two_way(ORACLE["pending_sentinel"], "checked IS NOT NULL")
ORACLE["result_writeback"] = f"""
SELECT 'job-' || cast(o_custkey AS varchar) AS spark_job_id, cast(legal AS varchar) AS result, score
FROM ({ORACLE['quality_score']})"""

# Regression

def in_training(*key: str) -> str:
    """True for the rows whose hash of seed and key falls into the training share."""
    text = " || '|' || ".join(["'12345'", *[f"cast({k} AS varchar)" for k in key]])
    slot = f"('0x' || substr(md5({text}), 1, 12))::BIGINT % 1000000"
    return f"({slot}) / 1000000.0::DOUBLE < 0.9"


ORACLE["split_sizes"] = f"""
SELECT part, count(*) AS n
FROM (SELECT CASE WHEN {in_training('o_orderkey')} THEN 'train' ELSE 'test' END AS part FROM orders)
GROUP BY part"""
ORACLE["linreg_scored"] = f"""
WITH parts AS (
  SELECT *, {in_training('l_orderkey', 'l_linenumber', 'l_partkey')} AS training FROM lineitem),
model AS (
  SELECT regr_slope(l_extendedprice, l_quantity) AS slope,
    regr_intercept(l_extendedprice, l_quantity) AS intercept FROM parts WHERE training)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS label,
  round(slope * l_quantity + intercept, 2) AS prediction
FROM parts, model WHERE NOT training"""
ORACLE["linreg_fit"] = """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem"""

# The tuned fit: moments of the fitting and the judging rows and of both, then coordinate
# descent, one sweep over the three coefficients for each step of the recursion.
X = ("l_quantity", "l_discount", "l_tax")


def _soft(value: str, limit: str) -> str:
    return f"sign({value}) * greatest(abs({value}) - {limit}, 0)"


def _sweep() -> str:
    """Nested selects: each coefficient is made of the newest values of the others."""
    sql = "SELECT *, b1 AS n1, b2 AS n2, b3 AS n3 FROM cd JOIN grams USING (part, intercept)"
    for j in (1, 2, 3):
        others = " - ".join(f"g{min(i, j)}{max(i, j)} * n{i}" for i in (1, 2, 3) if i != j)
        new = f"{_soft(f'(g{j}4 - {others})', 'lasso')} / (g{j}{j} + ridge)"
        sql = f"SELECT * REPLACE ({new} AS n{j}) FROM ({sql})"
    return sql


PAIRS = [(i, j) for i in (1, 2, 3, 4) for j in (1, 2, 3, 4) if i <= j]
TUNING = f"""
WITH RECURSIVE parts AS (
  SELECT *, {in_training('l_orderkey', 'l_linenumber', 'l_partkey')} AS training,
    {in_training('l_orderkey', 'l_linenumber', 'l_partkey').replace("'12345'", "'12346'").replace('0.9', '0.8')}
      AS fits FROM lineitem
), x AS (
  SELECT training, fits, {', '.join(f'{c}::DOUBLE AS x{i}' for i, c in enumerate((*X, 'l_extendedprice'), 1))}
  FROM parts
), moments AS (
  SELECT part, count(*)::DOUBLE AS n, {', '.join(f'sum(x{i}) AS s{i}' for i in (1, 2, 3, 4))},
    {', '.join(f'sum(x{i} * x{j}) AS p{i}{j}' for i, j in PAIRS)}
  FROM x, (VALUES ('fit'), ('judge'), ('all')) AS names(part)
  WHERE training AND (part = 'all' OR fits = (part = 'fit')) GROUP BY part
), spreads AS (
  SELECT *, {', '.join(f'sqrt(p{i}{i} / n - (s{i} / n) * (s{i} / n)) AS d{i}' for i in (1, 2, 3, 4))}
  FROM moments
), grams AS (
  SELECT part, intercept, n, s1, s2, s3, s4, d1, d2, d3, d4, {', '.join(
      f'(p{i}{j} / n - CASE WHEN intercept THEN s{i} / n * s{j} / n ELSE 0 END) / (d{i} * d{j}) AS g{i}{j}'
      for i, j in PAIRS)}
  FROM spreads, (VALUES (true), (false)) AS forms(intercept)
), settings AS (
  SELECT * FROM (VALUES (0.1::DOUBLE), (0.01::DOUBLE)) AS r(reg),
    (VALUES (false), (true)) AS i(intercept), (VALUES (0::DOUBLE), (0.5::DOUBLE), (1::DOUBLE)) AS e(net)
), cd AS (
  SELECT part, reg, intercept, net, 0 AS step, 0::DOUBLE AS b1, 0::DOUBLE AS b2, 0::DOUBLE AS b3,
    reg / d4 * net AS lasso, reg / d4 * (1 - net) AS ridge
  FROM settings JOIN grams USING (intercept) WHERE part <> 'judge'
  UNION ALL
  SELECT part, reg, intercept, net, step + 1, n1, n2, n3, lasso, ridge FROM ({_sweep()})
  WHERE step < 400
), models AS (
  SELECT part, reg, intercept, net, c1, c2, c3,
    CASE WHEN intercept THEN s4 / n - s1 / n * c1 - s2 / n * c2 - s3 / n * c3 ELSE 0 END AS c0
  FROM (SELECT *, b1 * d4 / d1 AS c1, b2 * d4 / d2 AS c2, b3 * d4 / d3 AS c3
        FROM cd JOIN grams USING (part, intercept) WHERE step = 400)
), errors AS (
  SELECT reg, intercept, net, sqrt(avg((x4 - c0 - c1 * x1 - c2 * x2 - c3 * x3) ** 2)) AS rmse
  FROM models, x WHERE part = 'fit' AND training AND NOT fits GROUP BY ALL
), winner AS (
  SELECT reg, intercept, net FROM errors ORDER BY rmse, reg DESC, intercept, net LIMIT 1
)"""
ORACLE["linreg_grid"] = f"""{TUNING}
SELECT reg AS reg_param, intercept AS fit_intercept, net AS elastic_net, round(rmse, 4) AS rmse,
  EXISTS (SELECT 1 FROM winner w WHERE w.reg = e.reg AND w.intercept = e.intercept AND w.net = e.net)
    AS wins
FROM errors e"""
ORACLE["linreg_tuned"] = f"""{TUNING}
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS label,
  round(c1 * l_quantity + c2 * l_discount + c3 * l_tax + c0, 2) AS prediction
FROM parts, models JOIN winner USING (reg, intercept, net)
WHERE NOT training AND part = 'all'"""
