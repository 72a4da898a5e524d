"""Helpers that write the DuckDB oracle SQL for the registered queries.

The oracle is an independent formulation of each query in plain SQL over the
raw tables; these helpers only generate repetitive column lists.
"""

from __future__ import annotations

from collections.abc import Sequence


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def sround(x: str, places: int, coarse: bool = False) -> str:
    """Rounding to ``places``, fewer for large values (twelve digits at least; in
    presentation cents up to 1e10, whole numbers up to 1e16)."""
    y = f"({x} + {x} * 1e-13)"
    steps = [(1e8, places), (1e10, 2), (1e16, 0)] if coarse else [
        (10.0 ** (12 - p), p) for p in range(places, -1, -1)]
    parts = []
    for bound, p in steps:
        f = repr(10.0 ** p)
        parts.append(f"WHEN abs({x}) < {bound!r} THEN sign({y}) * floor(abs({y} * {f}) + 0.5) / {f}")
    return f"(CASE {' '.join(parts)} ELSE {x} END)"


def fin(inner: str, cols: Sequence[tuple[str, str]]) -> str:
    """Final projection: doubles rounded to 4 places, integers as BIGINT."""
    out = []
    for n, k in cols:
        if k == "d":
            out.append(f"{sround(f'CAST({q(n)} AS DOUBLE)', 4, coarse=True)} AS {q(n)}")
        elif k == "i":
            out.append(f"CAST({q(n)} AS BIGINT) AS {q(n)}")
        else:
            out.append(q(n))
    return f"SELECT {', '.join(out)} FROM ({inner}) fq"


# Role views over the raw tables (same mapping as featspark.sources.roles).
APP = """SELECT c_custkey AS client_id, c_nationkey, c_mktsegment, c_acctbal,
  CAST(c_acctbal < 0 AS INTEGER) AS label,
  CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS score_1,
  CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS score_2,
  CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS score_3,
  (c_custkey % 5 = 0) AS is_test,
  1.0::DOUBLE + CAST(c_custkey % 4 AS DOUBLE) / 4.0::DOUBLE AS weight
FROM customer"""

BUREAU = """SELECT o_custkey AS client_id, o_orderkey AS credit_id, o_orderstatus,
  o_orderpriority, o_totalprice,
  date_diff('day', DATE '2001-08-02', CAST(o_orderdate AS DATE)) AS days_credit
FROM orders"""

BB = """SELECT l_orderkey AS credit_id, l_returnflag AS status,
  CAST(-floor(date_diff('day', CAST(l_shipdate AS DATE), DATE '2002-01-01') / 30) AS BIGINT)
    AS months_balance
FROM lineitem"""

INST = """SELECT o.o_custkey AS client_id, l.l_orderkey AS loan_id, l.l_linenumber,
  l.l_extendedprice AS amt_due, l.l_extendedprice * (1 - l.l_discount) AS amt_paid,
  l.l_quantity AS cnt_units, l.l_linestatus AS status,
  date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS days_late,
  date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) - 90 AS dpd
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

STATS8 = ["mean", "sd", "median", "Mode", "min", "max", "sum", "n_distinct"]


def long_union(src: str, keys: Sequence[str], cols: Sequence[str]) -> str:
    ks = ", ".join(keys)
    parts = [f"SELECT {ks}, '{c}' AS name, CAST({q(c)} AS DOUBLE) AS value FROM {src}"
             for c in cols]
    return "\nUNION ALL\n".join(parts)


def stats8(src: str, keys: Sequence[str]) -> str:
    """Eight statistics of ``value`` per (keys, name) from a long relation.

    Mode: most frequent non-null value, ties to the smallest.
    """
    ks = ", ".join(keys)
    return f"""
SELECT a.*, m."Mode" FROM (
  SELECT {ks}, name, AVG(value) AS mean, STDDEV_SAMP(value) AS sd,
         MEDIAN(value) AS median, MIN(value) AS "min", MAX(value) AS "max",
         COALESCE(SUM(value), 0) AS "sum", COUNT(DISTINCT value) AS n_distinct
  FROM {src} GROUP BY {ks}, name) a
LEFT JOIN (
  SELECT {ks}, name, FIRST(value ORDER BY cnt DESC, value ASC) AS "Mode"
  FROM (SELECT {ks}, name, value, COUNT(*) AS cnt FROM {src}
        WHERE value IS NOT NULL GROUP BY {ks}, name, value) c
  GROUP BY {ks}, name) m USING ({ks}, name)"""


def two_level(src_sql: str, key: str, sub: str, cols: Sequence[str], suffix: str
              ) -> tuple[str, list[tuple[str, str]]]:
    """SQL for the two-level statistics; returns (sql, output columns)."""
    l0 = long_union("src", [key, sub], cols)
    lvl2_src = "\nUNION ALL\n".join(
        f"SELECT {key}, name || '_{s}' AS name, "
        f"{sround(f'CAST({q(s)} AS DOUBLE)', 8)} AS value FROM s1"
        for s in STATS8)
    out_cols, sel = [(key, "i")], [key]
    for c in cols:
        for s1 in STATS8:
            for s2 in STATS8:
                n = f"{c}_{s1}_{s2}{suffix}"
                sel.append(f"MAX(CASE WHEN name = '{c}_{s1}' THEN {q(s2)} END) AS {q(n)}")
                out_cols.append((n, "i" if s2 == "n_distinct" else "d"))
    sql = f"""
WITH src AS ({src_sql}),
l0 AS ({l0}),
s1 AS ({stats8('l0', [key, sub])}),
l1 AS ({lvl2_src}),
s2 AS ({stats8('l1', [key])})
SELECT {', '.join(sel)} FROM s2 GROUP BY {key}"""
    return sql, out_cols

APP_WIDE = f"""
SELECT a.client_id, a.label, a.is_test, a.weight, a.c_mktsegment,
  CAST(a.c_nationkey AS VARCHAR) AS NATION,
  a.c_acctbal AS AMT_INCOME_TOTAL, p.AMT_CREDIT, p.AMT_ANNUITY, p.AMT_GOODS_PRICE,
  p.CNT_CHILDREN, p.CNT_FAM_MEMBERS, p.DAYS_BIRTH,
  CASE WHEN a.c_nationkey = 0 THEN 365243 ELSE p._last END AS DAYS_EMPLOYED,
  a.score_1 AS EXT_SOURCE_1, a.score_2 AS EXT_SOURCE_2, a.score_3 AS EXT_SOURCE_3,
  a.c_nationkey AS OWN_CAR_AGE, p._last - p.DAYS_BIRTH AS DAYS_LAST_PHONE_CHANGE,
  CASE WHEN a.score_1 IS NOT NULL THEN CAST(p._urgent > 0 AS INTEGER) END AS FLAG_DOCUMENT_2,
  CASE WHEN a.score_2 IS NOT NULL THEN CAST(p._low > 0 AS INTEGER) END AS FLAG_DOCUMENT_3,
  CASE WHEN a.score_3 IS NOT NULL THEN CAST(p._done > 0 AS INTEGER) END AS FLAG_DOCUMENT_4,
  CAST(p._urgent > p._low AS INTEGER) AS REG_REGION_NOT_LIVE_REGION,
  CAST(p._done > p.CNT_CHILDREN AS INTEGER) AS REG_CITY_NOT_LIVE_CITY,
  CAST(a.c_acctbal < 0 AS INTEGER) AS LIVE_CITY_NOT_WORK_CITY
FROM ({APP}) a LEFT JOIN (
  SELECT client_id, SUM(o_totalprice) AS AMT_CREDIT, AVG(o_totalprice) AS AMT_ANNUITY,
    MAX(o_totalprice) AS AMT_GOODS_PRICE,
    COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS CNT_CHILDREN, COUNT(*) AS CNT_FAM_MEMBERS,
    MIN(days_credit) AS DAYS_BIRTH, MAX(days_credit) AS _last,
    COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS _urgent,
    COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS _low,
    COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS _done
  FROM ({BUREAU}) b GROUP BY client_id) p ON a.client_id = p.client_id"""
