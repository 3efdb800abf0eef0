"""The same results in SQL for DuckDB, written independently of the Spark queries."""

from __future__ import annotations

LABEL = "(l_returnflag = 'R')::INT"
SCORE = "round_even(l_discount + l_tax, 2)"
DEC = "(round_even(l_discount + l_tax, 2) > 0.08)::INT"
DATED = """CASE WHEN l_shipdate < TIMESTAMP '1997-01-01' THEN strftime(lo, '%Y%m%d') || ' ~ 19961231'
  WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN '19970101 ~ 19981231'
  ELSE '19990101 ~ ' || strftime(hi, '%Y%m%d') END"""
LIMITS = "(SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem)"

# name -> (sql, is a double); over columns bin_num, bad_num, good_num and the windows r, p.
BIN_RATES = {
    "bin_rate": "bin_num / sum(bin_num) OVER p",
    "bad_rate": "bad_num / nullif(bin_num, 0)",
    "good_rate": "1 - bad_num / nullif(bin_num, 0)",
    "odds": "(1 - bad_num / nullif(bin_num, 0)) / nullif(bad_num / nullif(bin_num, 0), 0)",
    "global_bad_rate": "bad_num / nullif(sum(bad_num) OVER p, 0)",
    "global_good_rate": "good_num / nullif(sum(good_num) OVER p, 0)",
    "cum_bin_bad_rate": "sum(bad_num) OVER r / sum(bin_num) OVER r",
    "cum_bin_good_rate": "sum(good_num) OVER r / sum(bin_num) OVER r",
    "cum_global_bad_rate": "sum(bad_num) OVER r / nullif(sum(bad_num) OVER p, 0)",
    "cum_global_good_rate": "sum(good_num) OVER r / nullif(sum(good_num) OVER p, 0)",
    "lift": "(sum(bad_num) OVER r / sum(bin_num) OVER r) / nullif(sum(bad_num) OVER p / sum(bin_num) OVER p, 0)",
}
TOTAL_RATE = {"total_bad_rate": "sum(bad_num) OVER p / sum(bin_num) OVER p"}
PSI = {
    "psi": """CASE WHEN dec_num > 0 AND bad_num > 0 THEN
        (bad_num / bin_num - dec_num / bin_num) * ln((bad_num / bin_num) / (dec_num / bin_num)) END"""
}


def rates(binned: str, keys: str, digits: int = 6, descending: bool = False, psi: bool = False, extra: str = "") -> str:
    """Statistics per bin from rows (keys, bin, y[, dec])."""
    columns = {**BIN_RATES, **(PSI if psi else {}), **TOTAL_RATE}
    shown = ", ".join(f"round_even({sql}, {digits}) AS {name}" for name, sql in columns.items())
    pred = ", sum(dec)::DOUBLE AS dec_num" if psi else ""
    order = "bin DESC" if descending else "bin"
    return f"""
    counted AS (SELECT {keys}, bin, count(y)::DOUBLE AS bin_num, sum(y)::DOUBLE AS bad_num{pred}
      FROM ({binned}) WHERE bin IS NOT NULL GROUP BY {keys}, bin),
    c AS (SELECT *, bin_num - bad_num AS good_num FROM counted)
    SELECT {keys}, bin::INT AS bin, {extra} bin_num::BIGINT AS bin_num, bad_num::BIGINT AS bad_num,
      good_num::BIGINT AS good_num, {shown}
    FROM c WINDOW p AS (PARTITION BY {keys}),
      r AS (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING)"""


def quantile_bins(
    source: str, keys: str, bins: int, digits: int | None, psi: bool = False, round_to: int = 6
) -> str:
    """Right-closed quantile bins of rows (keys, x, y[, dec]); labels with edges rounded up when digits are given."""
    inner = ", ".join(f"{i}/{bins}" for i in range(1, bins))
    shown = f"list_transform(e, lambda v: ceil({10**(digits or 0)} * v) / {10**(digits or 0)})"
    edges = f"list_concat(list_concat(['-infinity'::DOUBLE], {shown}), ['infinity'::DOUBLE])"
    join_keys = " AND ".join(f"c.{k.strip()} = edges.{k.strip()}" for k in keys.split(","))
    label = f"""(SELECT '(' || {edges}[bin] || ', ' || {edges}[bin + 1] || ']' FROM edges WHERE {join_keys}) AS bin_label,"""
    binned = f"SELECT source.*, 1 + len(list_filter(e, lambda v: v < x)) AS bin FROM source JOIN edges USING ({keys})"
    return f"""WITH source AS ({source}),
    edges AS (SELECT {keys}, list_sort(list_distinct(quantile_cont(x, [{inner}]))) AS e FROM source GROUP BY {keys}),
    {rates(binned, keys, round_to, psi=psi, extra=label if digits is not None else "")}"""


def points(weight: str = "1", score: str = SCORE, label: str = LABEL, key: str = "", source: str = "lineitem") -> str:
    """ROC points with running counts."""
    part = f"PARTITION BY {key}" if key else ""
    sel, group = (f"{key},", f"{key},") if key else ("", "")
    by = f"({part} ORDER BY s DESC ROWS UNBOUNDED PRECEDING)"
    order = f"({part} ORDER BY s DESC)"
    return f"""
    pts AS (SELECT {sel} {score} AS s, sum({label} * w)::DOUBLE AS tp, sum((1 - {label}) * w)::DOUBLE AS fp
      FROM (SELECT *, {weight} AS w FROM {source}) WHERE w <> 0 GROUP BY {group} s),
    cum AS (SELECT *, sum(tp) OVER {by} AS ctp, sum(fp) OVER {by} AS cfp, sum(tp) OVER ({part}) AS p,
      sum(fp) OVER ({part}) AS n, lead(tp) OVER {order} AS ntp, lead(fp) OVER {order} AS nfp,
      row_number() OVER {order} AS rn FROM pts),
    kept AS (SELECT *, coalesce(lag(cfp) OVER {order}, 0) AS pfp FROM cum
      WHERE rn = 1 OR ntp IS NULL OR ntp <> tp OR nfp <> fp)"""


AUC_TRAPEZOID = "sum(fp * (ctp - tp / 2)) / nullif(max(p) * max(n), 0)"
AUC_RIGHT = "sum(ctp * (cfp - pfp)) / nullif(max(p) * max(n), 0)"
KS = "max(abs(cfp / n - ctp / p))"


def class_metrics(digits: int, weight: str = "1", key: str = "", source: str = "lineitem") -> str:
    """One row of class metrics, as a CTE body."""
    group = f"GROUP BY {key}" if key else ""
    sel = f"{key}," if key else ""

    def r(sql):
        return f"round_even({sql}, {digits})"

    def ratio(a, b):
        return r(f"coalesce(({a}) / nullif({b}, 0), 0)")

    return f"""SELECT {sel} {r("(tn / neg + tp / pos) / 2")} AS balanced_acc,
      {ratio("tn", "tn + fn")} AS precision_0, {ratio("tp", "tp + fp")} AS precision_1,
      {ratio("tn", "neg")} AS recall_0, {ratio("tp", "pos")} AS recall_1,
      {ratio("2 * tn", "tn + fn + neg")} AS f1_0, {ratio("2 * tp", "tp + fp + pos")} AS f1_1,
      {{support}}
    FROM (SELECT *, neg - fp AS tn, pos - tp AS fn FROM (SELECT {sel}
      sum({LABEL} * {DEC} * {weight})::DOUBLE AS tp, sum((1 - {LABEL}) * {DEC} * {weight})::DOUBLE AS fp,
      sum({LABEL} * {weight})::DOUBLE AS pos, sum((1 - {LABEL}) * {weight})::DOUBLE AS neg FROM {source} {group}))"""


START = "UNION ALL SELECT 'infinity'::DOUBLE, 0, 0"
NULL_STATUS = "(SELECT *, nullif(l_linestatus, 'O') AS status FROM lineitem)"
COUNT_SUPPORT = "neg::BIGINT AS support_0, pos::BIGINT AS support_1"
DATED_ITEMS = f"(SELECT *, {DATED} AS date_range FROM lineitem, {LIMITS})"


def report(key: str = "", source: str = "lineitem", classes: bool = True) -> str:
    group = f"GROUP BY {key}" if key else ""
    sel = f"{key}," if key else ""
    on = f"USING ({key})" if key else "ON true"
    right = f"(SELECT {sel} round_even({AUC_RIGHT}, 5) AS auc FROM kept {group})"
    ks = f"(SELECT {sel} round_even({KS}, 5) AS ks FROM cum {group})"
    more = ""
    if classes:
        more = f"JOIN ({class_metrics(5, key=key, source=source).format(support=COUNT_SUPPORT)}) {on}"
    return f"WITH {points(key=key, source=source)} SELECT * FROM {right} JOIN {ks} {on} {more}"


def performance(key: str = "", source: str = "lineitem", descending: bool = False) -> str:
    part = f"PARTITION BY {key}" if key else ""
    sel = f"{key}," if key else ""
    order = "SCORE_CUT DESC" if descending else "SCORE_CUT"

    def r(sql, digits=4):
        return f"round_even({sql}, {digits})"

    return f"""WITH counted AS (SELECT {sel} floor(l_extendedprice / 10000)::INT AS SCORE_CUT,
        count(*)::DOUBLE AS t, sum({LABEL})::DOUBLE AS b FROM {source} GROUP BY {sel} SCORE_CUT),
    a AS (SELECT *, t - b AS g, {r("b / t")} AS BAD_RATE, {r("(t - b) / t")} AS GOOD_RATE,
        {r("t / sum(t) OVER p")} AS POP, {r("sum(b) OVER r / sum(t) OVER r")} AS CUM_POP_BAD_RATE,
        {r("b / sum(b) OVER p")} AS GLOBAL_BAD_RATE, {r("(t - b) / sum(t - b) OVER p")} AS GLOBAL_GOOD_RATE
      FROM counted WINDOW p AS ({part}), r AS ({part} ORDER BY {order} ROWS UNBOUNDED PRECEDING)),
    c AS (SELECT *, {r("sum(GLOBAL_BAD_RATE) OVER r")} AS CUM_GLOBAL_BAD_RATE,
        {r("sum(GLOBAL_GOOD_RATE) OVER r")} AS CUM_GLOBAL_GOOD_RATE, last(CUM_POP_BAD_RATE) OVER u AS last_pop
      FROM a WINDOW r AS ({part} ORDER BY {order} ROWS UNBOUNDED PRECEDING),
        u AS ({part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    SELECT {sel} SCORE_CUT, g::BIGINT AS GOOD_NUM, b::BIGINT AS BAD_NUM, t::BIGINT AS TOTAL, POP,
      {r("(1 - BAD_RATE) / nullif(BAD_RATE, 0)", 3)} AS ODDS, last(CUM_GLOBAL_BAD_RATE) OVER u AS TOTAL_BAD_RATE,
      GOOD_RATE, BAD_RATE, GLOBAL_BAD_RATE, CUM_POP_BAD_RATE, CUM_GLOBAL_BAD_RATE, GLOBAL_GOOD_RATE,
      CUM_GLOBAL_GOOD_RATE, {r("abs(CUM_POP_BAD_RATE - CUM_GLOBAL_GOOD_RATE)")} AS KS,
      {r("abs(CUM_POP_BAD_RATE / nullif(last_pop, 0))")} AS LIFT
    FROM c WINDOW u AS ({part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


def per_column(table: str, columns: dict[str, str], template: str) -> str:
    """One row per column from a template over {c} (name) and {t} (type)."""
    return " UNION ALL ".join(template.format(c=c, t=t, table=table) for c, t in columns.items())


CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
PART = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"}
DOCUMENTS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
LINEITEM = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp",
}
WIDTH = "CASE '{t}' WHEN 'bigint' THEN 8 WHEN 'double' THEN 8 WHEN 'int' THEN 4 ELSE strlen({c}::VARCHAR) END"
PROFILE = (
    "SELECT '{c}' AS column_name, '{t}' AS data_type, max(" + WIDTH + ")::BIGINT AS data_length, "
    "count(DISTINCT {c}) AS num_distinct, count(*) - count({c}) AS num_nulls, "
    "round_even(1 / count(DISTINCT {c}), 9) AS density FROM {table}"
)


def readable(size: str) -> str:
    """Bytes in 1024 steps."""
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]
    tests = " ".join(
        f"WHEN {size} < {1024 ** (i + 1)} THEN printf('%.2f {u}', ({size})::DOUBLE / {1024**i})" for i, u in enumerate(units[:-1])
    )
    return f"CASE {tests} ELSE printf('%.2f PiB', ({size})::DOUBLE / {1024**5}) END"


PRICE = f"SELECT 'price' AS feature, l_extendedprice AS x, {LABEL} AS y, {DEC} AS dec FROM lineitem"
TURNS = "SELECT conv_id, turn, regexp_replace('%' || role || chr(10) || text, '\\s*(%[\\w.]+\\s*\\n)', '#\\1', 'g') AS t FROM conversations"
SCRIPTS = f"""SELECT conv_id, count(*) AS paragraphs, string_agg(t, chr(10) ORDER BY turn, t) AS script
    FROM ({TURNS}) GROUP BY conv_id"""
CLEAN = "regexp_replace(replace(replace(replace({c}, '&copy;', chr(169)), '&middot;', chr(183)), '&quot;', '\"'), '&amp;?', '&', 'g')"
PIVOT_EDGES = [0, 20000, 50000, 80000, 200000]
PIVOT_BIN = "CASE " + " ".join(
    f"WHEN l_extendedprice <= {hi} THEN '({float(lo)}, {float(hi)}]'" for lo, hi in zip(PIVOT_EDGES, PIVOT_EDGES[1:])
) + " END"

ORACLE: dict[str, str] = {
    "bin_stat_price": quantile_bins(PRICE, "feature", 5, 2),
    "bin_stat_equal_width": f"""WITH source AS ({PRICE}),
      edges AS (SELECT feature, list_transform(range(1, 8), lambda i: min(x) + (max(x) - min(x)) / 8 * i) AS e FROM source GROUP BY feature),
      {rates("SELECT source.*, 1 + len(list_filter(e, lambda v: v < x)) AS bin FROM source JOIN edges USING (feature)", "feature", descending=True,
        extra='''(SELECT '(' || list_concat(['-infinity'::DOUBLE], list_transform(e, lambda v: ceil(10 * v) / 10))[bin] || ', ' ||
          list_concat(list_transform(e, lambda v: ceil(10 * v) / 10), ['infinity'::DOUBLE])[bin] || ']' FROM edges) AS bin_label,''')}""",
    "bin_stat_two_features": quantile_bins(
        f"SELECT 'price' AS feature, l_extendedprice AS x, {LABEL} AS y FROM lineitem UNION ALL "
        f"SELECT 'l_quantity', l_quantity, {LABEL} FROM lineitem", "feature", 10, None),
    "bin_stat_fixed_edges_left": f"""WITH source AS (SELECT 'l_quantity' AS feature, l_quantity AS x, {LABEL} AS y FROM lineitem),
      {rates('''SELECT *, CASE WHEN x < 5 OR x > 40 THEN 0 WHEN x < 10 THEN 1 WHEN x < 20 THEN 2 ELSE 3 END AS bin FROM source''', "feature",
        extra="['outside', '[5.0, 10.0)', '[10.0, 20.0)', '[20.0, 40.0)'][bin + 1] AS bin_label,")}""",
    "psi_by_bin": quantile_bins(PRICE, "feature", 5, 2, psi=True),
    "doc_quality_bins": quantile_bins(
        "SELECT 'n_chars' AS feature, n_chars::DOUBLE AS x, quality AS y FROM labels JOIN documents USING (doc_id)", "feature", 4, 0),
    "cut_bin_labels": """SELECT CASE WHEN l_quantity < 1 OR l_quantity > 45 THEN 'none' WHEN l_quantity <= 10 THEN '(1.0, 10.0]'
      WHEN l_quantity <= 25 THEN '(10.0, 25.0]' ELSE '(25.0, 45.0]' END AS label, count(*) AS rows FROM lineitem GROUP BY 1""",
    "quantile_edges": f"""SELECT feature, unnest(range(0, 11))::INT AS i, round_even(unnest(e), 6) AS edge FROM (
      SELECT 'price' AS feature, quantile_cont(l_extendedprice, [{", ".join(f"{i}/10" for i in range(11))}]) AS e FROM lineitem UNION ALL
      SELECT 'l_quantity', quantile_cont(l_quantity, [{", ".join(f"{i}/10" for i in range(11))}]) FROM lineitem)""",
    "roc_curve_ties": f"WITH {points()} SELECT s AS threshold, round_even(cfp / n, 6) AS fpr, round_even(ctp / p, 6) AS tpr FROM cum {START}",
    "roc_curve_kept_points": f"""WITH {points(score="l_extendedprice")} SELECT s AS threshold, round_even(cfp / n, 9) AS fpr,
      round_even(ctp / p, 9) AS tpr FROM kept {START}""",
    "roc_curve_null_keys": f"""WITH {points(key="status", source=NULL_STATUS)} SELECT status, s AS threshold, round_even(cfp / n, 6) AS fpr,
      round_even(ctp / p, 6) AS tpr FROM cum UNION ALL SELECT DISTINCT status, 'infinity'::DOUBLE, 0, 0 FROM cum""",
    "auc_null_keys": f"""WITH {points(score="l_extendedprice", key="status", source=NULL_STATUS)}
      SELECT status, round_even({AUC_TRAPEZOID}, 6) AS auc FROM cum GROUP BY status""",
    "auc_right": f"WITH {points(score='l_extendedprice')} SELECT round_even({AUC_RIGHT}, 6) AS auc FROM kept",
    "auc_trapezoid": f"WITH {points()} SELECT round_even({AUC_TRAPEZOID}, 6) AS auc FROM cum",
    "auc_of_class": f"""WITH {points(label="(l_returnflag = 'A')::INT")} SELECT round_even({AUC_TRAPEZOID}, 6) AS auc FROM cum""",
    "ks": f"WITH {points(score='l_extendedprice')} SELECT round_even({KS}, 6) AS ks FROM cum",
    "auc_weighted": f"""WITH {points(weight="l_quantity - 1")} SELECT * FROM (SELECT round_even({AUC_TRAPEZOID}, 6) AS auc_trapezoid,
      round_even({KS}, 6) AS ks FROM cum), (SELECT round_even({AUC_RIGHT}, 6) AS auc_right FROM kept)""",
    "class_stats": class_metrics(6).format(support=COUNT_SUPPORT),
    "class_stats_weighted": class_metrics(6, "l_quantity").format(support="neg AS support_0, pos AS support_1"),
    "target_type": " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, CASE WHEN bool_or(x <> floor(x)) THEN 'continuous'
          WHEN count(DISTINCT x) <= 2 THEN 'binary' ELSE 'multiclass' END AS type FROM (SELECT {sql} AS x FROM lineitem)"""
        for name, sql in (("label", LABEL), ("score", SCORE), ("l_linenumber", "l_linenumber"), ("l_quantity", "l_quantity"))),
    "binary_report": report(),
    "binary_report_bins": quantile_bins(PRICE, "feature", 6, None, psi=True),
    "model_report": report(classes=False),
    "binary_report_by_date": report("date_range", DATED_ITEMS),
    "bin_stat_by_date": quantile_bins(
        f"SELECT {DATED} AS date_range, 'price' AS feature, l_extendedprice AS x, {LABEL} AS y FROM lineitem, {LIMITS}",
        "date_range, feature", 5, None, round_to=5),
    "pivot_by_date": f"""SELECT {PIVOT_BIN} AS bin_label, """ + ", ".join(
        f"count(*) FILTER ({w}) AS r{i}_bin_num, sum({LABEL}) FILTER ({w})::BIGINT AS r{i}_bad_num" for i, w in enumerate((
            "l_shipdate < TIMESTAMP '1997-01-01'",
            "l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'",
            "l_shipdate >= TIMESTAMP '1999-01-01'",
        ))) + " FROM lineitem GROUP BY 1",
    "pivot_performance": "SELECT floor(l_extendedprice / 10000)::INT AS SCORE_CUT, " + ", ".join(
        f"nullif(count(*) FILTER ({w}), 0) AS r{i}_TOTAL, sum({LABEL}) FILTER ({w})::BIGINT AS r{i}_BAD_NUM" for i, w in enumerate((
            "l_shipdate < TIMESTAMP '1997-01-01'",
            "l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'",
            "l_shipdate >= TIMESTAMP '1999-01-01'",
        ))) + " FROM lineitem GROUP BY 1",
    "performance_table": performance(descending=True),
    "performance_by_date": performance("date_range", DATED_ITEMS),
    "performance_auc_by_date": f"""WITH {points(score="l_extendedprice", key="date_range", source=DATED_ITEMS)}
      SELECT date_range, round_even({AUC_TRAPEZOID}, 6) AS auc FROM cum GROUP BY date_range""",
    "date_ranges": f"""SELECT {DATED.replace("l_shipdate", "o_orderdate")} AS date_range, count(*) AS rows
      FROM orders, (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders) GROUP BY 1""",
    "filter_dates": """SELECT o_orderpriority, count(*) AS rows FROM orders
      WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1""",
    "nunique": per_column("lineitem", LINEITEM, "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS nunique FROM {table}"),
    "nunique_rows": """SELECT len(list_distinct([l_quantity, l_linenumber::DOUBLE, l_suppkey::DOUBLE]))::INT AS nunique, count(*) AS rows
      FROM lineitem GROUP BY 1""",
    "nunique_rows_text": """SELECT o_orderkey, whole, words FROM (SELECT o_orderkey,
        len(list_distinct([9007199254740992 + o_orderkey % 2, 9007199254740993, o_custkey]))::INT AS whole FROM orders)
      FULL JOIN (SELECT doc_id AS o_orderkey, (len(list_distinct([lang, source, text])) + (lang IS NULL)::INT + (source IS NULL)::INT
        + (text IS NULL)::INT)::INT AS words FROM documents) USING (o_orderkey)""",
    "column_profile": per_column("customer", CUSTOMER, PROFILE),
    "describe_table": per_column("part", PART, PROFILE),
    "column_sizes": f"""SELECT column_name, bytes, {readable("bytes")} AS size FROM ({per_column("documents", DOCUMENTS,
        "SELECT '{c}' AS column_name, sum(" + WIDTH + ")::BIGINT AS bytes FROM {table}")})""",
    "result_size": """SELECT count(*) AS rows, (sum(8 + 8 + strlen(o_orderstatus) + 8 + 8 + strlen(o_orderpriority)))::BIGINT AS bytes
      FROM orders""",
    "table_sizes": " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
        "pages", "benchmark", "labels", "conversations")),
    "shrink_types": """SELECT p_partkey::SMALLINT AS p_partkey, p_name, p_brand, p_type, p_size::TINYINT AS p_size,
      p_retailprice FROM part""",
    "normalize_decimals": """SELECT o_orderkey, o_totalprice::DECIMAL(12,2)::DOUBLE AS price, o_custkey AS customer FROM orders""",
    "cast_schema": """SELECT o_orderkey, o_custkey::INT AS o_custkey, o_orderstatus, o_totalprice::DECIMAL(12,2) AS o_totalprice,
      o_orderdate::DATE AS o_orderdate, o_orderpriority FROM orders""",
    "human_size": f"SELECT doc_id, {readable('strlen(text) * n_chars')} AS size FROM documents",
    "read_table_subset": "SELECT o_orderkey AS order_id, o_totalprice AS price FROM orders",
    "rename_columns": """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
      c_mktsegment AS segment FROM customer""",
    "strip_qualifiers": "SELECT o_orderkey, o_orderstatus FROM orders",
    "select_regex": "SELECT c_custkey, c_name FROM customer",
    "drop_columns": "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "binarize": "SELECT o_orderkey, (o_orderstatus = 'F')::INT AS is_f FROM orders",
    "extract_id": """SELECT event_id, regexp_extract(props, '"k": (\\d+)', 1) AS k FROM events""",
    "usage_report": f"""SELECT o_custkey AS custkey, o_orderkey, {readable("(trunc(o_totalprice * 100))::BIGINT")} AS memory, c_name
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "join_three_keys": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      sum(l_quantity) OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey) AS total FROM lineitem""",
    "stitch_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "first_per_key": """SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
    "stack": "SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY 1",
    "row_numbers": """SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_number FROM orders""",
    "page_of_rows": """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 300 OFFSET 900""",
    "chunk_ids": """SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk FROM orders""",
    "export_chunked": "SELECT * FROM orders",
    "export_by_chunk_id": """SELECT chunk::INT AS chunk, count(*) AS rows, min(o_orderkey) AS first, max(o_orderkey) AS last FROM (
      SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 AS chunk FROM orders) GROUP BY 1""",
    "export_ordered": """SELECT ((row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) // 2000)::BIGINT AS chunk, o_orderkey, o_totalprice, o_orderpriority,
      least(2000, count(*) OVER () - 2000 * ((row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) // 2000))::BIGINT AS rows FROM orders""",
    "bin_stat_many_groups": """WITH l AS (SELECT (l_suppkey % 97)::VARCHAR AS "group", unnest(['l_extendedprice', 'l_quantity', 'l_discount']) AS feature,
        unnest([l_extendedprice, l_quantity, l_discount]) AS v, (l_returnflag = 'R')::BIGINT AS y FROM lineitem),
      e AS (SELECT "group", feature, list_distinct(quantile_cont(v, [0.25, 0.5, 0.75])) AS cuts FROM l GROUP BY ALL)
      SELECT "group", feature, (1 + len(list_filter(cuts, lambda c: c < v)))::INT AS bin, count(*) AS bin_num, sum(y)::BIGINT AS bad_num
      FROM l JOIN e USING ("group", feature) GROUP BY ALL""",
    "split_table": """SELECT 'open' AS part, o_orderkey FROM orders WHERE o_orderstatus = 'O' UNION ALL
      SELECT 'dear', o_orderkey FROM orders WHERE o_totalprice >= 250000""",
    "write_csv": """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer""",
    **{f"csv_{t}": f"SELECT * FROM {t}" for t in ("documents", "pages", "conversations", "events")},
    "append_csv": "SELECT o_orderkey, o_totalprice FROM orders",
    "save_table_replace": "SELECT o_orderkey, o_custkey FROM orders",
    "insert_rows": "SELECT c_custkey, c_name FROM customer",
    "encrypt_roundtrip": "SELECT c_custkey, c_name, false AS readable FROM customer",
    "save_table_silent": "SELECT c_name AS value FROM customer UNION ALL SELECT c_custkey::VARCHAR FROM customer",
    "create_like_rename": "SELECT * FROM nation",
    "read_table_decrypted": "SELECT c_custkey AS id, c_name AS name FROM customer ORDER BY c_custkey LIMIT 100",
    "load": "SELECT * FROM supplier",
    "with_conf": "SELECT o_orderstatus, count(*) AS rows, 3 AS partitions FROM orders GROUP BY 1",
    "run_sql_database": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000",
    "run_sql_params": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000",
    "run_sql_script": "SELECT 'a;b' AS name, count(*) AS rows FROM orders UNION ALL SELECT 'c', count(*) FROM lineitem",
    "run_sqls": """SELECT name, rows, 1 AS errors FROM (SELECT 'orders' AS name, count(*) AS rows FROM orders UNION ALL
      SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'part', count(*) FROM part)""",
    "union_all_sql": """SELECT o_orderstatus AS status, round_even(sum(o_totalprice), 2) AS total FROM orders
      GROUP BY o_orderstatus, left(o_orderpriority, 1)""",
    "limit_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
    "read_tables": "SELECT o_orderkey AS id FROM orders UNION ALL SELECT c_custkey FROM customer",
    "clean_text": f"SELECT page_id, {CLEAN.format(c='url')} AS url, {CLEAN.format(c='html')} AS html FROM pages",
    "read_text_blocks": """WITH l AS (SELECT o_orderkey // 5000 AS part, o_orderkey, concat_ws('|', o_orderkey, o_orderstatus, o_orderpriority) AS v FROM orders),
      p AS (SELECT part, v, sum(strlen(v) + 1) OVER (PARTITION BY part ORDER BY o_orderkey) - strlen(v) - 1 AS pos,
        sum(strlen(v) + 1) OVER (PARTITION BY part) AS size FROM l)
      SELECT part::BIGINT AS part, CASE WHEN greatest(1, ceil(pos / 65536)) >= ceil(size / 65536) THEN -1 ELSE greatest(1, ceil(pos / 65536)) END::BIGINT AS block,
        count(*) AS lines, sum(length(v))::BIGINT AS chars FROM p GROUP BY 1, 2""",
    "assemble_documents": SCRIPTS,
    "split_documents": f"""WITH s AS (SELECT conv_id, string_split(regexp_replace(script,
        '\\n[ \\t]*#+(%[\\w.]+[ \\t\\r]*\\n)', chr(1) || '\\1', 'g'), chr(1)) AS p FROM ({SCRIPTS}))
      SELECT conv_id, (unnest(range(len(p))))::BIGINT AS index, unnest(p) AS paragraph FROM s""",
}
