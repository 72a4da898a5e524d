"""DuckDB oracle SQL for the registered queries.

Each statement is an independent plain-SQL formulation over the raw tables
(``customer``, ``orders``, ``lineitem``, ...), written the direct way (joins
before aggregation, windows over whole groups) to cross-check the Spark
plans.  Category vocabularies are those of the test data (fixed values):
order status F O P; priorities 1-URGENT 2-HIGH 3-MEDIUM 4-NOT SPECIFIED
5-LOW; return flags A N R; line status F O; market segments AUTOMOBILE
BUILDING FURNITURE HOUSEHOLD MACHINERY.
"""

from __future__ import annotations

from featspark.plans.sqlgen import APP, BB, BUREAU, INST, fin, q, two_level

ORDER_STATUS = ["F", "O", "P"]
PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RETURN_FLAG = ["A", "N", "R"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
INST_COLS = ["amt_due", "amt_paid", "payment_diff", "cnt_units", "days_late",
             "l_linenumber", "status"]


def header(value: str) -> str:
    """Category value as part of a column name: blanks out, '-' to '_'."""
    return value.replace(" ", "").replace("-", "_")


def tok(col: str) -> str:
    return f"replace(coalesce(CAST({col} AS VARCHAR), 'NA'), ' ', '')"


def on_spine(feature_sql: str, cols: list[tuple[str, str]]) -> str:
    """Left join a per-client feature relation to all clients."""
    names = ", ".join(f"f.{q(n)}" for n, _ in cols if n != "client_id")
    inner = (f"SELECT c.c_custkey AS client_id, {names} FROM customer c "
             f"LEFT JOIN ({feature_sql}) f ON c.c_custkey = f.client_id")
    return fin(inner, [("client_id", "i")] + [c for c in cols if c[0] != "client_id"])


# ---- basic statistics -------------------------------------------------------

def _basic_stats_cols(fields, suffix, kinds):
    out = []
    for f in fields:
        k = kinds[f]
        out += [(f"SUM_{f}{suffix}", k), (f"MEAN_{f}{suffix}", "d"), (f"MIN_{f}{suffix}", k),
                (f"MAX_{f}{suffix}", k), (f"SD_{f}{suffix}", "d")]
    return out


def _basic_stats_sql(src, key, fields, suffix):
    sel = []
    for f in fields:
        sel += [f"COALESCE(SUM({f}), 0) AS {q('SUM_' + f + suffix)}",
                f"AVG({f}) AS {q('MEAN_' + f + suffix)}",
                f"MIN({f}) AS {q('MIN_' + f + suffix)}",
                f"MAX({f}) AS {q('MAX_' + f + suffix)}",
                f"STDDEV_SAMP({f}) AS {q('SD_' + f + suffix)}"]
    return f"SELECT {key}, {', '.join(sel)} FROM ({src}) s GROUP BY {key}"


def client_basic_stats():
    cols = _basic_stats_cols(["o_totalprice", "days_credit"], "_bureau",
                             {"o_totalprice": "d", "days_credit": "i"})
    return on_spine(_basic_stats_sql(BUREAU, "client_id", ["o_totalprice", "days_credit"],
                                     "_bureau"), cols)


def _cat_count_parts():
    cols, sel = [("bureau_count", "i")], ["COUNT(*) AS bureau_count"]
    for field, vocab in (("o_orderstatus", ORDER_STATUS), ("o_orderpriority", PRIORITY)):
        for v in vocab:
            t = v.replace(" ", "")
            n = f"{header(v)}_count_{field}_bureau"
            sel.append(f"COUNT(*) FILTER (WHERE {tok(field)} = '{t}') AS {q(n)}")
            cols.append((n, "i"))
    return cols, f"SELECT client_id, {', '.join(sel)} FROM ({BUREAU}) b GROUP BY client_id"


def client_category_counts():
    cols, sql = _cat_count_parts()
    return on_spine(sql, cols)


def _status_parts():
    toks = RETURN_FLAG + ["NA"]
    cnt = [f"COUNT(*) FILTER (WHERE {tok('bb.status')} = '{t}') AS {q(t + '_count_bbalance')}"
           for t in toks]
    inner = (f"SELECT cw.client_id, {', '.join(cnt)}, COUNT(*) AS _n "
             f"FROM (SELECT client_id, credit_id FROM ({BUREAU}) b) cw "
             f"LEFT JOIN ({BB}) bb ON cw.credit_id = bb.credit_id GROUP BY cw.client_id")
    sel = ([q(t + "_count_bbalance") for t in toks]
           + [f"{q(t + '_count_bbalance')} / _n AS {q(t + '_proportion_bbalance')}" for t in toks])
    cols = ([(t + "_count_bbalance", "i") for t in toks]
            + [(t + "_proportion_bbalance", "d") for t in toks])
    return cols, f"SELECT client_id, {', '.join(sel)} FROM ({inner}) g"


def client_status_counts_proportions():
    cols, sql = _status_parts()
    return on_spine(sql, cols)


def _time_since_parts():
    sel = [f"MAX(months_balance) FILTER (WHERE {tok('bb.status')} = '{t}') "
           f"AS {q('Time_Since_Status_' + t + '_bbalance')}" for t in RETURN_FLAG]
    cols = [(f"Time_Since_Status_{t}_bbalance", "i") for t in RETURN_FLAG]
    sql = (f"SELECT cw.client_id, {', '.join(sel)} "
           f"FROM (SELECT client_id, credit_id FROM ({BUREAU}) b) cw "
           f"JOIN ({BB}) bb ON cw.credit_id = bb.credit_id GROUP BY cw.client_id")
    return cols, sql


def client_time_since_status():
    cols, sql = _time_since_parts()
    return on_spine(sql, cols)


# fixed values: limits of the quarters before the application
BUCKETS = [("1Q", "days_credit >= -90"),
           ("2Q", "days_credit < -90 AND days_credit >= -180"),
           ("3Q", "days_credit < -180 AND days_credit >= -270"),
           ("4Q", "days_credit < -270 AND days_credit >= -360")]


def _overdue_parts():
    case = "CASE " + " ".join(f"WHEN {c} THEN '{lab}'" for lab, c in BUCKETS) + " ELSE 'GT1Y' END"
    labs = [b[0] for b in BUCKETS] + ["GT1Y"]
    sel = [f"COALESCE(SUM(o_totalprice) FILTER (WHERE bk = '{lab}'), 0) "
           f"AS {q('AMT_CREDIT_OVERDUE_' + lab + '_bureau')}" for lab in labs]
    sql = (f"SELECT client_id, {', '.join(sel)} FROM (SELECT client_id, o_totalprice, "
           f"{case} AS bk FROM ({BUREAU}) b WHERE o_totalprice > 0) x GROUP BY client_id")
    return [(f"AMT_CREDIT_OVERDUE_{lab}_bureau", "d") for lab in labs], sql


def client_overdue_buckets():
    cols, sql = _overdue_parts()
    return on_spine(sql, cols)


def _gap_sql():
    return f"""
SELECT client_id, AVG(days_credit - nxt) AS Avg_Time_Btwn_Credit,
       STDDEV_SAMP(days_credit - nxt) AS SDev_Time_Btwn_Cred
FROM (SELECT client_id, days_credit,
        LEAD(days_credit) OVER (PARTITION BY client_id ORDER BY days_credit DESC NULLS LAST) AS nxt,
        ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY days_credit DESC NULLS LAST) AS rn,
        COUNT(*) OVER (PARTITION BY client_id) AS n
      FROM ({BUREAU}) b) o
WHERE rn <> n GROUP BY client_id"""


GAP_COLS = [("Avg_Time_Btwn_Credit", "d"), ("SDev_Time_Btwn_Cred", "d")]


def client_credit_gap():
    return fin(_gap_sql(), [("client_id", "i")] + GAP_COLS)


def credit_gap_rows():
    w = "PARTITION BY client_id ORDER BY days_credit DESC NULLS LAST, credit_id DESC"
    inner = f"""SELECT *, AVG(gap) OVER (PARTITION BY client_id) AS "Avg_Time_Btwn_Credit",
      STDDEV_SAMP(gap) OVER (PARTITION BY client_id) AS "SDev_Time_Btwn_Cred" FROM (
      SELECT *, days_credit - next_value AS gap FROM (
        SELECT client_id, credit_id, days_credit, LEAD(days_credit) OVER ({w}) AS next_value,
          CAST(ROW_NUMBER() OVER ({w}) = COUNT(*) OVER (PARTITION BY client_id) AS INTEGER) AS first_record
        FROM ({BUREAU}) b) r) g"""
    return fin(inner, [(n, "i") for n in ("client_id", "credit_id", "days_credit", "next_value", "first_record", "gap")]
               + GAP_COLS)


def _filtered_parts():
    conds = {"Bureau_Past_Credit_Count": "days_credit < -365",
             "Bureau_Current_Credit_Count": "days_credit >= -365",
             "Completed_Count_bureau": "o_orderstatus = 'F'"}
    sel = [f"NULLIF(COUNT(*) FILTER (WHERE {c}), 0) AS {q(n)}" for n, c in conds.items()]
    return ([(n, "i") for n in conds],
            f"SELECT client_id, {', '.join(sel)} FROM ({BUREAU}) b GROUP BY client_id")


def client_filtered_counts():
    cols, sql = _filtered_parts()
    return on_spine(sql, cols)


INST_CODED = f"""
SELECT i.client_id, i.loan_id, i.amt_due, i.amt_paid, i.amt_due - i.amt_paid AS payment_diff,
       i.cnt_units, i.days_late, i.l_linenumber, c.code AS status
FROM ({INST}) i LEFT JOIN (
  SELECT status, ROW_NUMBER() OVER (ORDER BY status) AS code
  FROM (SELECT DISTINCT status FROM ({INST}) x WHERE status IS NOT NULL) d) c
ON i.status = c.status"""


def _two_level():
    return two_level(INST_CODED, "client_id", "loan_id", INST_COLS, "_installments")


def loan_client_two_level():
    sql, cols = _two_level()
    return fin(sql, cols)


def two_level_ratios():
    sql, cols = _two_level()
    sm = [n for n, _ in cols if "_sum_mean" in n]
    sel, out = [], [("client_id", "i")]
    for a in sm:
        for b in sm:
            if a != b:
                sel.append(f"CAST({q(a)} AS DOUBLE) / NULLIF(CAST({q(b)} AS DOUBLE), 0) "
                           f"AS {q(a + '_' + b)}")
                out.append((a + "_" + b, "d"))
    return fin(f"SELECT client_id, {', '.join(sel)} FROM ({sql}) t", out)


def _mode_parts():
    per_loan = f"""
SELECT client_id, loan_id,
  FIRST(cnt_units ORDER BY cnt DESC, cnt_units ASC) FILTER (WHERE cnt_units IS NOT NULL)
    AS CNT_UNITS_MODE
FROM (SELECT client_id, loan_id, cnt_units, COUNT(*) OVER (
        PARTITION BY client_id, loan_id, cnt_units) AS cnt FROM ({INST}) i) x
GROUP BY client_id, loan_id"""
    cols = _basic_stats_cols(["CNT_UNITS_MODE"], "_POS_CASH", {"CNT_UNITS_MODE": "d"})
    return cols, _basic_stats_sql(per_loan, "client_id", ["CNT_UNITS_MODE"], "_POS_CASH")


def loan_mode_stats():
    cols, sql = _mode_parts()
    return fin(sql, [("client_id", "i")] + cols)


def _ever_late_sql():
    return f"""
SELECT client_id, CASE WHEN COUNT(f) = COUNT(*) THEN SUM(f) END AS Ever_DPD_Count_POS_CASH
FROM (SELECT client_id, CASE WHEN mx IS NULL THEN NULL WHEN mx > 0 THEN 1 ELSE 0 END AS f
      FROM (SELECT client_id, loan_id,
                   CASE WHEN COUNT(dpd) = COUNT(*) THEN MAX(dpd) END AS mx
            FROM ({INST}) i GROUP BY client_id, loan_id) l) g
GROUP BY client_id"""


def ever_late_count():
    return fin(_ever_late_sql(), [("client_id", "i"), ("Ever_DPD_Count_POS_CASH", "i")])


# ---- application row-wise features -----------------------------------------

from featspark.plans.sqlgen import APP_WIDE  # noqa: E402

APP_RATIO_COLS = [
    "CNT_CHILDREN", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE",
    "DAYS_BIRTH", "DAYS_EMPLOYED", "OWN_CAR_AGE", "CNT_FAM_MEMBERS",
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "DAYS_LAST_PHONE_CHANGE",
]
DOC_FLAGS = ["FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_4"]
ADDRESS_FLAGS = ["REG_REGION_NOT_LIVE_REGION", "REG_CITY_NOT_LIVE_CITY",
                 "LIVE_CITY_NOT_WORK_CITY"]
NA_COLS = APP_RATIO_COLS + DOC_FLAGS + ADDRESS_FLAGS + ["c_mktsegment", "NATION"]
SCORES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def nulls(cols) -> str:
    return " + ".join(f"CAST({q(c)} IS NULL AS INTEGER)" for c in cols)


def affordability_block():
    emp, birth = "emp", "DAYS_BIRTH"
    exprs = [
        ("DAYS_EMPLOYED_PERC", f"CASE WHEN {div(emp, birth)} >= 0 THEN sqrt({div(emp, birth)}) END"),
        ("INCOME_CREDIT_PERC", div("AMT_INCOME_TOTAL", "AMT_CREDIT")),
        ("INCOME_PER_PERSON", f"CASE WHEN {div('AMT_INCOME_TOTAL', 'CNT_FAM_MEMBERS')} > -1 "
                              f"THEN ln(1 + {div('AMT_INCOME_TOTAL', 'CNT_FAM_MEMBERS')}) END"),
        ("ANNUITY_INCOME_PERC",
         f"CASE WHEN {div('AMT_ANNUITY', '(1 + AMT_INCOME_TOTAL)')} >= 0 "
         f"THEN sqrt({div('AMT_ANNUITY', '(1 + AMT_INCOME_TOTAL)')}) END"),
        ("LOAN_INCOME_RATIO", div("AMT_CREDIT", "AMT_INCOME_TOTAL")),
        ("ANNUITY_LENGTH", div("AMT_CREDIT", "AMT_ANNUITY")),
        ("CHILDREN_RATIO", div("CNT_CHILDREN", "CNT_FAM_MEMBERS")),
        ("CREDIT_TO_GOODS_RATIO", div("AMT_CREDIT", "AMT_GOODS_PRICE")),
        ("INC_PER_CHLD", div("AMT_INCOME_TOTAL", "(1 + CNT_CHILDREN)")),
        ("SOURCES_PROD", "EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3"),
        ("CAR_TO_BIRTH_RATIO", div("OWN_CAR_AGE", birth)),
        ("CAR_TO_EMPLOY_RATIO", div("OWN_CAR_AGE", emp)),
        ("PHONE_TO_BIRTH_RATIO", div("DAYS_LAST_PHONE_CHANGE", birth)),
        ("PHONE_TO_EMPLOY_RATIO", div("DAYS_LAST_PHONE_CHANGE", emp)),
    ]
    inner = (f"SELECT client_id, na, emp AS DAYS_EMPLOYED, "
             + ", ".join(f"{e} AS {n}" for n, e in exprs)
             + f" FROM (SELECT *, {nulls(NA_COLS)} AS na, NULLIF(DAYS_EMPLOYED, 365243) AS emp "
             f"FROM ({APP_WIDE}) a) t")
    cols = [("client_id", "i"), ("na", "i"), ("DAYS_EMPLOYED", "i")] + [(n, "d") for n, _ in exprs]
    return fin(inner, cols)


def _ratio_sql():
    sel, cols = [], [("client_id", "i")]
    for a in APP_RATIO_COLS:
        for b in APP_RATIO_COLS:
            if a != b:
                n = f"{a}_{b}_ratio_application"
                sel.append(f"{div(a, b)} AS {q(n)}")
                cols.append((n, "d"))
    return f"SELECT client_id, {', '.join(sel)} FROM ({APP_WIDE}) a", cols


def pair_ratios():
    return fin(*_ratio_sql())


def row_null_and_flag_counts():
    inner = (f"SELECT client_id, {' + '.join(DOC_FLAGS)} AS Document_Count_application, "
             f"{' + '.join(ADDRESS_FLAGS)} AS Reg_mismatch_count_application, "
             f"{nulls(NA_COLS)} AS na FROM ({APP_WIDE}) a")
    return fin(inner, [("client_id", "i"), ("Document_Count_application", "i"),
                       ("Reg_mismatch_count_application", "i"), ("na", "i")])


def row_score_stats():
    lst = "[" + ", ".join(SCORES) + "]"
    allnn = " AND ".join(f"{s} IS NOT NULL" for s in SCORES)
    miss = nulls(SCORES)
    inner = f"""SELECT client_id,
      list_aggregate({lst}, 'avg') AS Avg_EXT_SOURCE_application,
      list_aggregate({lst}, 'stddev_samp') AS SD_EXT_SOURCE_application,
      {miss} AS EXT_SOURCE_missing_cnt_application,
      CASE WHEN {allnn} THEN greatest({', '.join(SCORES)}) END AS EXT_SOURCE_max_application,
      CASE WHEN {allnn} THEN least({', '.join(SCORES)}) END AS EXT_SOURCE_min_application,
      CASE WHEN {miss} < 2 AND {allnn}
           THEN greatest({', '.join(SCORES)}) - least({', '.join(SCORES)}) END
        AS EXT_SOURCE_range_application
    FROM ({APP_WIDE}) a"""
    return fin(inner, [("client_id", "i"), ("Avg_EXT_SOURCE_application", "d"),
                       ("SD_EXT_SOURCE_application", "d"),
                       ("EXT_SOURCE_missing_cnt_application", "i"),
                       ("EXT_SOURCE_max_application", "d"), ("EXT_SOURCE_min_application", "d"),
                       ("EXT_SOURCE_range_application", "d")])


# columns with NULLs in the train rows (score_2 / FLAG_DOCUMENT_3 are NULL only
# for test clients, so they are not imputed)
IMPUTE_COLS = [("EXT_SOURCE_1", "d"), ("EXT_SOURCE_3", "d"),
               ("FLAG_DOCUMENT_2", "i"), ("FLAG_DOCUMENT_4", "i")]


def _mode_sql(src: str, col: str) -> str:
    return (f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY COUNT(*) DESC, {col} ASC LIMIT 1)")


def impute_mean_median_mode():
    sel, cols = [], [("client_id", "i")]
    for st in ("mean", "median", "mode"):
        for c, k in IMPUTE_COLS:
            if st == "mean":
                v = f"(SELECT AVG({c}) FROM tr)"
            elif st == "median":
                v = f"(SELECT quantile_cont({c}, 0.5) FROM tr)"
            else:
                v = _mode_sql("tr", c)
            n = f"{c}_tr{st}"
            kk = k if st == "mode" else "d"
            sel.append(f"COALESCE({'CAST(' + c + ' AS DOUBLE)' if kk == 'd' else c}, {v}) AS {q(n)}")
            cols.append((n, kk))
    inner = (f"WITH app AS ({APP_WIDE}), tr AS (SELECT * FROM app WHERE NOT is_test) "
             f"SELECT client_id, {', '.join(sel)} FROM app WHERE is_test")
    return fin(inner, cols)


NATIONS = [str(i) for i in range(25)]


def one_hot():
    sel, cols = [], [("client_id", "i")]
    for c, vocab in (("c_mktsegment", SEGMENTS), ("NATION", NATIONS)):
        for v in vocab:
            n = f"{c}_{v}"
            sel.append(f"COALESCE(CAST({c} = '{v}' AS INTEGER), 0) AS {q(n)}")
            cols.append((n, "i"))
    return fin(f"SELECT client_id, {', '.join(sel)} FROM ({APP_WIDE}) a WHERE NOT is_test", cols)


def label_encode_query():
    inner = f"""SELECT b.client_id, b.credit_id, s.code AS o_orderstatus, p.code AS o_orderpriority
    FROM ({BUREAU}) b
    LEFT JOIN (SELECT o_orderstatus, DENSE_RANK() OVER (ORDER BY o_orderstatus) AS code
               FROM (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL)) s
      ON b.o_orderstatus = s.o_orderstatus
    LEFT JOIN (SELECT o_orderpriority, DENSE_RANK() OVER (ORDER BY o_orderpriority) AS code
               FROM (SELECT DISTINCT o_orderpriority FROM orders
                     WHERE o_orderpriority IS NOT NULL)) p
      ON b.o_orderpriority = p.o_orderpriority"""
    return fin(inner, [("client_id", "i"), ("credit_id", "i"), ("o_orderstatus", "i"),
                       ("o_orderpriority", "i")])


def union_with_origin():
    base = "client_id, c_nationkey, c_mktsegment, c_acctbal, score_1, score_2, score_3"
    inner = (f"SELECT {base}, 0 AS is_test FROM ({APP}) a WHERE NOT is_test UNION ALL "
             f"SELECT {base}, 1 AS is_test FROM ({APP}) a WHERE is_test")
    return fin(inner, [("client_id", "i"), ("c_nationkey", "i"), ("c_mktsegment", "s"),
                       ("c_acctbal", "d"), ("score_1", "d"), ("score_2", "d"), ("score_3", "d"),
                       ("is_test", "i")])


def suffix_join():
    means = ", ".join(f"(SELECT AVG({s}) FROM app) AS m_{s}" for s in SCORES)
    right = ", ".join(f"COALESCE({s}, m_{s}) AS {s}_y" for s in SCORES)
    inner = (f"WITH app AS ({APP_WIDE}), m AS (SELECT {means}) "
             f"SELECT l.client_id, "
             + ", ".join(f"l.{s} AS {s}_x" for s in SCORES)
             + f", l.DAYS_EMPLOYED AS DAYS_EMPLOYED_x, r.* EXCLUDE (client_id) FROM app l "
             f"LEFT JOIN (SELECT client_id, {right}, DAYS_EMPLOYED AS DAYS_EMPLOYED_y "
             f"FROM app, m) r ON l.client_id = r.client_id")
    cols = ([("client_id", "i")] + [(f"{s}_x", "d") for s in SCORES] + [("DAYS_EMPLOYED_x", "i")]
            + [(f"{s}_y", "d") for s in SCORES] + [("DAYS_EMPLOYED_y", "i")])
    return fin(inner, cols)


def duplicate_keys():
    inner = ("SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem "
             "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
    return fin(inner, [("l_orderkey", "i"), ("l_linenumber", "i"), ("n", "i")])


def category_drift():
    def freq(cond, name):
        return (f"SELECT c_mktsegment AS category, COUNT(*) / SUM(COUNT(*)) OVER () AS {name} "
                f"FROM ({APP}) a WHERE {cond} AND c_mktsegment IS NOT NULL GROUP BY c_mktsegment")
    inner = (f"SELECT COALESCE(t.category, s.category) AS category, t.freq_train, s.freq_test "
             f"FROM ({freq('NOT is_test', 'freq_train')}) t FULL OUTER JOIN "
             f"({freq('is_test', 'freq_test')}) s ON t.category = s.category")
    return fin(inner, [("category", "s"), ("freq_train", "d"), ("freq_test", "d")])


def _describe_sql(src: str, cols, name: str) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        for st, e in (("count", f"COUNT({x})"), ("mean", f"AVG({x})"),
                      ("std", f"STDDEV_SAMP({x})"), ("min", f"MIN({x})"),
                      ("25%", f"quantile_cont({x}, 0.25)"), ("50%", f"quantile_cont({x}, 0.5)"),
                      ("75%", f"quantile_cont({x}, 0.75)"), ("max", f"MAX({x})")):
            parts.append(f"SELECT '{c}' AS variable, '{st}' AS statistic, "
                         f"CAST({e} AS DOUBLE) AS {name} FROM {src}")
    return " UNION ALL ".join(parts)


def describe_compare():
    cols = ["o_totalprice", "days_credit"]
    inner = (f"WITH b AS ({BUREAU}), e AS (SELECT * FROM b WHERE days_credit < -1200), "
             f"l AS (SELECT * FROM b WHERE days_credit >= -1200) "
             f"SELECT x.variable, x.statistic, x.early, y.late FROM "
             f"({_describe_sql('e', cols, 'early')}) x JOIN "
             f"({_describe_sql('l', cols, 'late')}) y USING (variable, statistic)")
    return fin(inner, [("variable", "s"), ("statistic", "s"), ("early", "d"), ("late", "d")])


def skewness():
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    inner = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, skewness(CAST({c} AS DOUBLE)) AS skew FROM lineitem"
        for c in cols)
    return fin(inner, [("variable", "s"), ("skew", "d")])


def corr_matrix():
    cols = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "EXT_SOURCE_1", "EXT_SOURCE_2", "DAYS_BIRTH"]
    parts = [f"SELECT '{a}' AS var1, '{b}' AS var2, "
             f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM app"
             for a in cols for b in cols]
    inner = f"WITH app AS ({APP_WIDE}) " + " UNION ALL ".join(parts)
    return fin(inner, [("var1", "s"), ("var2", "s"), ("corr", "d")])


def _hist_sql(values_sql: str, bins: int) -> str:
    return f"""
WITH v AS (SELECT CAST(x AS DOUBLE) AS x FROM ({values_sql}) s WHERE x IS NOT NULL AND NOT isnan(CAST(x AS DOUBLE))),
e AS (SELECT CASE WHEN MIN(x) = MAX(x) THEN MIN(x) - 0.5 ELSE MIN(x) END AS lo,
             CASE WHEN MIN(x) = MAX(x) THEN MAX(x) + 0.5 ELSE MAX(x) END AS hi FROM v),
c AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin,
             COUNT(*) AS n FROM v, e GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
SELECT g.bin, lo + g.bin * (hi - lo) / {bins} AS lower, lo + (g.bin + 1) * (hi - lo) / {bins} AS upper,
       COALESCE(c.n, 0) AS n
FROM g CROSS JOIN e LEFT JOIN c ON g.bin = c.bin"""


HIST_COLS = [("bin", "i"), ("lower", "d"), ("upper", "d"), ("n", "i")]


def histogram():
    return fin(_hist_sql(f"SELECT o_totalprice AS x FROM ({BUREAU}) b", 20), HIST_COLS)


def group_size_histogram():
    return fin(_hist_sql(f"SELECT COUNT(credit_id) AS x FROM ({BUREAU}) b GROUP BY client_id", 10),
               HIST_COLS)


def missing_counts():
    cols = ["client_id", "label", "is_test", "weight", "c_mktsegment", "NATION",
            "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_CHILDREN",
            "CNT_FAM_MEMBERS", "DAYS_BIRTH", "DAYS_EMPLOYED", "EXT_SOURCE_1", "EXT_SOURCE_2",
            "EXT_SOURCE_3", "OWN_CAR_AGE", "DAYS_LAST_PHONE_CHANGE"] + DOC_FLAGS + ADDRESS_FLAGS
    parts = [f"SELECT '{c}' AS variable, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM app"
             for c in cols]
    inner = (f"WITH app AS ({APP_WIDE}) SELECT * FROM ({' UNION ALL '.join(parts)}) u "
             f"WHERE n_missing > 0")
    return fin(inner, [("variable", "s"), ("n_missing", "i")])


# ---- splits, metrics ----------------------------------------------------------

def hsql(purpose: str, key: str, seed: str) -> str:
    """Number in [0, 2^32) from the md5 of purpose, key and seeds."""
    return f"('0x' || substr(md5('{purpose}:' || {key} || ':' || {seed}), 1, 8))::BIGINT"


def _folds_sql(src: str) -> str:
    return (f"SELECT *, ((ROW_NUMBER() OVER (PARTITION BY label ORDER BY {hsql('fold', 'client_id', '1234')}, "
            f"client_id) - 1) % 5) + 1 AS fold FROM ({src}) s")


def fold_assign():
    inner = _folds_sql(f"SELECT client_id, label FROM ({APP_WIDE}) a WHERE NOT is_test")
    return fin(inner, [("client_id", "i"), ("label", "i"), ("fold", "i")])


def _auc_sql(src: str, grp: str, name: str) -> str:
    return f"""
SELECT {grp}, SUM(wp * (below + 0.5 * wn)) / NULLIF(SUM(wp) * SUM(wn), 0) AS {name}
FROM (SELECT *, COALESCE(SUM(wn) OVER (PARTITION BY {grp} ORDER BY score
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT {grp}, CAST(score AS DOUBLE) AS score, SUM(weight * label) AS wp,
                   SUM(weight * (1 - label)) AS wn
            FROM {src} WHERE score IS NOT NULL GROUP BY {grp}, score) p) c
GROUP BY {grp}"""


def weighted_auc():
    base = _folds_sql(f"SELECT client_id, label, weight, COALESCE(AMT_CREDIT, 0) AS score "
                      f"FROM ({APP_WIDE}) a WHERE NOT is_test")
    inner = f"""
WITH b AS ({base}),
v AS ({_auc_sql('b', 'fold', 'Validation_AUC')}),
t AS ({_auc_sql('(SELECT b.*, r.k FROM b, range(1, 6) r(k) WHERE b.fold <> r.k)', 'k',
                'Train_AUC')}),
per AS (SELECT 'fold_' || CAST(v.fold AS VARCHAR) AS Fold_Name, Validation_AUC, Train_AUC
        FROM v JOIN t ON v.fold = t.k)
SELECT * FROM per UNION ALL
SELECT 'fold_AVG', SUM(Validation_AUC) / 5, SUM(Train_AUC) / 5 FROM per"""
    return fin(inner, [("Fold_Name", "s"), ("Validation_AUC", "d"), ("Train_AUC", "d")])


def metric_log():
    """Two runs, the first written twice: each is there once."""
    one = weighted_auc()
    runs = " UNION ALL ".join(f"SELECT '{r}' AS run, * FROM ({one}) t" for r in ("first", "second"))
    return f"SELECT run, Fold_Name, Validation_AUC, Train_AUC FROM ({runs}) u"


def csv_inferred():
    inner = f"""SELECT client_id, c_nationkey, CASE WHEN client_id % 9 = 0 THEN '' WHEN client_id % 11 <> 0
      THEN c_mktsegment END AS segment, CASE WHEN client_id % 4 <> 0 THEN c_acctbal END AS balance,
      CASE WHEN client_id % 6 <> 0 THEN c_nationkey % 2 = 0 END AS even, CAST(client_id % 5 AS BIGINT) AS step
      FROM ({APP}) a"""
    return fin(inner, [("client_id", "i"), ("c_nationkey", "i"), ("segment", "s"), ("balance", "d"), ("even", "s"),
                       ("step", "i")])


def model_reload():
    return fin(f"SELECT client_id, 1 AS same, 1 AS in_range FROM ({APP}) a WHERE is_test",
               [("client_id", "i"), ("same", "i"), ("in_range", "i")])


def corr_all():
    """Every pair of columns of the ratio table, over the rows where both are there."""
    src, cols = _ratio_sql()
    cols = [n for n, _ in cols[1:]]
    long = " UNION ALL ".join(f"SELECT client_id, '{c}' AS name, {q(c)} AS x FROM r WHERE {q(c)} IS NOT NULL" for c in cols)
    names = " UNION ALL ".join(f"SELECT '{c}' AS name" for c in cols)
    flat = " AND ".join(f"stddev_pop({t}.x) > 1e-6 * sqrt(avg({t}.x * {t}.x))" for t in "ab")
    inner = f"""WITH r AS ({src}), l AS ({long}), n AS ({names}),
      p AS (SELECT a.name AS var1, b.name AS var2, COUNT(*) AS n, CASE WHEN {flat} THEN corr(a.x, b.x) END AS c
            FROM l a JOIN l b USING (client_id) GROUP BY a.name, b.name)
      SELECT n1.name AS var1, n2.name AS var2, COALESCE(p.n, 0) AS n_both, p.c AS corr
      FROM n n1 CROSS JOIN n n2 LEFT JOIN p ON p.var1 = n1.name AND p.var2 = n2.name"""
    return fin(inner, [("var1", "s"), ("var2", "s"), ("n_both", "i"), ("corr", "d")])


def density_odds():
    inner = f"""
SELECT client_id, AVG(p) / NULLIF(1 - AVG(p), 0) AS Weights
FROM (SELECT client_id, 1 / (1 + exp(-(c_acctbal / 5000 + r.i / 15 - 0.5))) AS p
      FROM ({APP}) a, range(15) r(i) WHERE NOT is_test) l
GROUP BY client_id"""
    return fin(inner, [("client_id", "i"), ("Weights", "d")])


PD_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH", "EXT_SOURCE_1",
           "EXT_SOURCE_3"]
PD_EXPLORE = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "DAYS_BIRTH"]


def pd_grid():
    st = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}, "
                   f"CAST(MIN({c}) AS DOUBLE) AS lo_{c}, CAST(MAX({c}) AS DOUBLE) AS hi_{c}"
                   for c in PD_COLS)
    ev = " UNION ALL ".join(f"SELECT '{v}' AS v" for v in PD_EXPLORE)
    sel = []
    for c in PD_COLS:
        grid = (f"CASE WHEN point = 99 THEN hi_{c} "
                f"ELSE lo_{c} + point * ((hi_{c} - lo_{c}) / 99) END")
        sel.append(f"CASE WHEN e.v = '{c}' THEN {grid} ELSE m_{c} END AS {c}")
    inner = (f"WITH tr AS (SELECT * FROM ({APP_WIDE}) a WHERE NOT is_test), st AS (SELECT {st} FROM tr), "
             f"g AS (SELECT CAST(range AS INTEGER) AS point FROM range(100)), e AS ({ev}) "
             f"SELECT e.v AS Batch_Var, point, {', '.join(sel)} FROM e, g, st")
    return fin(inner, [("Batch_Var", "s"), ("point", "i")] + [(c, "d") for c in PD_COLS])


def top_k():
    inner = (f"SELECT client_id, AMT_CREDIT FROM ({APP_WIDE}) a "
             f"ORDER BY AMT_CREDIT DESC NULLS LAST, client_id LIMIT 10")
    return fin(inner, [("client_id", "i"), ("AMT_CREDIT", "d")])


def column_agreement():
    nums = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "DAYS_BIRTH",
            "DAYS_EMPLOYED"]
    kinds = {"AMT_INCOME_TOTAL": "d", "AMT_CREDIT": "d", "AMT_ANNUITY": "d",
             "AMT_GOODS_PRICE": "d", "DAYS_BIRTH": "i", "DAYS_EMPLOYED": "i"}
    sel = [f"{c} AS {c}_app" for c in nums]
    cols = [(f"{c}_app", kinds[c]) for c in nums]
    for v in SEGMENTS:
        sel.append(f"COALESCE(CAST(c_mktsegment = '{v}' AS INTEGER), 0) AS c_mktsegment_{v}_app")
        cols.append((f"c_mktsegment_{v}_app", "i"))
    inner = f"SELECT {', '.join(sel)}, client_id, label, weight FROM ({APP_WIDE}) a WHERE NOT is_test"
    return fin(inner, cols + [("client_id", "i"), ("label", "i"), ("weight", "d")])


def submission_merge():
    inner = f"SELECT client_id, 1 / (1 + exp(-c_acctbal / 1000)) AS TARGET FROM ({APP}) a WHERE is_test"
    return fin(inner, [("client_id", "i"), ("TARGET", "d")])


def csv_round_trip():
    inner = f"SELECT client_id, c_nationkey, c_mktsegment, c_acctbal, score_1, is_test FROM ({APP}) a"
    return fin(inner, [("client_id", "i"), ("c_nationkey", "i"), ("c_mktsegment", "s"),
                       ("c_acctbal", "d"), ("score_1", "d"), ("is_test", "s")])


def holdout_split():
    inner = (f"SELECT client_id, CAST(row_number() OVER (ORDER BY {hsql('holdout', 'client_id', '42')}, client_id) "
             f"<= ceil(count(*) OVER () * CAST(0.33 AS DOUBLE)) AS INTEGER) AS holdout FROM ({APP_WIDE}) a WHERE NOT is_test")
    return fin(inner, [("client_id", "i"), ("holdout", "i")])


_RESAMPLE = "'7:' || r.i"


def bootstrap_samples():
    inner = (f"SELECT r.i AS iteration, client_id FROM ({APP}) a, range(15) r(i) QUALIFY row_number() OVER "
             f"(PARTITION BY r.i ORDER BY {hsql('resample', 'client_id', _RESAMPLE)}, client_id) "
             f"<= round_even(count(*) OVER (PARTITION BY r.i) * CAST(0.3 AS DOUBLE), 0)")
    return fin(inner, [("iteration", "i"), ("client_id", "i")])


def preview():
    inner = f"SELECT client_id, c_mktsegment, c_acctbal FROM ({APP}) a ORDER BY client_id LIMIT 5"
    return fin(inner, [("client_id", "i"), ("c_mktsegment", "s"), ("c_acctbal", "d")])


def natural_join():
    bcols = _basic_stats_cols(["o_totalprice", "days_credit"], "_bureau",
                              {"o_totalprice": "d", "days_credit": "i"})
    bsql = _basic_stats_sql(BUREAU, "client_id", ["o_totalprice", "days_credit"], "_bureau")
    fcols, fsql = _filtered_parts()
    inner = f"SELECT * FROM ({bsql}) a JOIN ({fsql}) b USING (client_id)"
    return fin(inner, [("client_id", "i")] + bcols + fcols)


# ---- flagship: everything joined to the client spine ----------------------------

def _app_feature_parts():
    """(cols, sql) of the application features (affordability, pair ratios,
    flag counts, score statistics) per client."""
    aff = affordability_block()
    pr = pair_ratios()
    fl = row_null_and_flag_counts()
    sc = row_score_stats()
    aff_cols = ([("na", "i"), ("DAYS_EMPLOYED", "i")]
                + [(n, "d") for n in ["DAYS_EMPLOYED_PERC", "INCOME_CREDIT_PERC",
                                       "INCOME_PER_PERSON", "ANNUITY_INCOME_PERC",
                                       "LOAN_INCOME_RATIO", "ANNUITY_LENGTH", "CHILDREN_RATIO",
                                       "CREDIT_TO_GOODS_RATIO", "INC_PER_CHLD", "SOURCES_PROD",
                                       "CAR_TO_BIRTH_RATIO", "CAR_TO_EMPLOY_RATIO",
                                       "PHONE_TO_BIRTH_RATIO", "PHONE_TO_EMPLOY_RATIO"]])
    pr_cols = [(f"{a}_{b}_ratio_application", "d") for a in APP_RATIO_COLS
               for b in APP_RATIO_COLS if a != b]
    fl_cols = [("Document_Count_application", "i"), ("Reg_mismatch_count_application", "i")]
    sc_cols = [("Avg_EXT_SOURCE_application", "d"), ("SD_EXT_SOURCE_application", "d"),
               ("EXT_SOURCE_missing_cnt_application", "i"), ("EXT_SOURCE_max_application", "d"),
               ("EXT_SOURCE_min_application", "d"), ("EXT_SOURCE_range_application", "d")]
    sel = ([f"a.{q(n)}" for n, _ in aff_cols] + [f"p.{q(n)}" for n, _ in pr_cols]
           + [f"f.{q(n)}" for n, _ in fl_cols] + [f"s.{q(n)}" for n, _ in sc_cols])
    sql = (f"SELECT a.client_id, {', '.join(sel)} FROM ({aff}) a JOIN ({pr}) p USING (client_id) "
           f"JOIN ({fl}) f USING (client_id) JOIN ({sc}) s USING (client_id)")
    return aff_cols + pr_cols + fl_cols + sc_cols, sql


def feature_parts():
    """(columns, SQL by client_id) of the feature families built from single tables."""
    parts = [_app_feature_parts()]
    cc, csql = _cat_count_parts()
    bcols = _basic_stats_cols(["o_totalprice", "days_credit"], "_bureau",
                              {"o_totalprice": "d", "days_credit": "i"})
    parts.append((cc, csql))
    parts.append((bcols, _basic_stats_sql(BUREAU, "client_id", ["o_totalprice", "days_credit"],
                                          "_bureau")))
    parts.append(_filtered_parts())
    parts.append(_overdue_parts())
    parts.append((GAP_COLS, _gap_sql()))
    parts.append(_status_parts())
    parts.append(_time_since_parts())
    tl_sql, tl_cols = _two_level()
    sm = [n for n, _ in tl_cols if "_sum_mean" in n]
    rsel = [f"CAST({q(a)} AS DOUBLE) / NULLIF(CAST({q(b)} AS DOUBLE), 0) AS {q(a + '_' + b)}"
            for a in sm for b in sm if a != b]
    parts.append((tl_cols[1:] + [(a + "_" + b, "d") for a in sm for b in sm if a != b],
                  f"SELECT *, {', '.join(rsel)} FROM ({tl_sql}) t"))
    mcols, msql = _mode_parts()
    parts.append((mcols, msql))
    parts.append(([("Ever_DPD_Count_POS_CASH", "i")], _ever_late_sql()))
    return parts


def attached(parts, table: str, key: str) -> tuple[list[tuple[str, str]], str, str]:
    """(columns, select list, left joins) of ``parts`` attached to ``table``.``key``."""
    sel, joins, cols = [], [], []
    for i, (pcols, psql) in enumerate(parts):
        pc = [c for c in pcols if c[0] != "client_id"]
        sel += [f"f{i}.{q(n)}" for n, _ in pc]
        cols += pc
        joins.append(f"LEFT JOIN ({psql}) f{i} ON {table}.{key} = f{i}.client_id")
    return cols, ", ".join(sel), " ".join(joins)
