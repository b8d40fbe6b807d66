"""DuckDB oracle SQL for the exactly checkable catalogue entries.

Independent re-statements of each query over the pre-registered parquet views. The
stand-in raw rows are rebuilt by ``RAW`` (same rule as ``sources.tables.raw_shipments``).
"""

from __future__ import annotations


def H(expr: str, seed: str = "42") -> str:
    """Unsigned 32-bit hash used by the splits: first 8 hex digits of md5(key ‖ seed)."""
    return f"('0x' || substr(md5(CAST({expr} AS VARCHAR) || '{seed}'), 1, 8))::BIGINT"


RAW = r"""
lines AS (
  SELECT l_orderkey,
         min(l_suppkey) AS min_supp,
         max(s_acctbal) / 1000.0 AS reliability,
         CAST(max(p_size) AS DOUBLE) AS height,
         max(l_quantity) AS width,
         sum(l_quantity) AS weight,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value,
         max(l_tax) * 1000.0 AS fee,
         min(p_type) AS ptype,
         min(s_nationkey) AS min_snat,
         max(s_nationkey) AS max_snat,
         CAST(max(l_shipdate) AS DATE) AS ship
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY l_orderkey
),
base AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
         c.c_custkey, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_nationkey, n.n_regionkey,
         lines.*, md5(CAST(o.o_orderkey AS VARCHAR)) AS h,
         lpad(CAST(c.c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS zip5,
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(n.n_nationkey % 26 + 1 AS INTEGER), 1)
           || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST((n.n_regionkey * 5 + c.c_custkey) % 26 + 1 AS INTEGER), 1) AS st
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN lines ON o.o_orderkey = lines.l_orderkey
),
raw AS (
  SELECT o_orderkey,
    'Supplier#' || CAST(min_supp AS VARCHAR) AS Supplier_Name,
    CASE WHEN substr(h,5,1) IN ('0','1','2') THEN NULL ELSE reliability END AS Supplier_Reliability,
    CASE WHEN substr(h,6,1) = '0' THEN NULL ELSE height END AS Equipment_Height,
    CAST(width AS DOUBLE) AS Equipment_Width,
    CASE WHEN substr(h,7,1) = '0' THEN NULL ELSE CAST(weight AS DOUBLE) END AS Equipment_Weight,
    value AS Equipment_Value,
    CASE WHEN substr(h,8,1) = '0' THEN NULL ELSE fee END AS Base_Transport_Fee,
    ptype AS Equipment_Type,
    CASE WHEN min_snat IS NULL THEN NULL
         WHEN min_snat = c_nationkey AND max_snat = c_nationkey THEN 'No' ELSE 'Yes' END AS CrossBorder_Shipping,
    CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'Yes' ELSE 'No' END AS Urgent_Shipping,
    CASE WHEN substr(h,9,1) = '0' THEN NULL ELSE o_orderstatus END AS Installation_Service,
    o_orderpriority AS Transport_Method,
    CASE WHEN height > 40 THEN 'Yes' WHEN height IS NOT NULL THEN 'No' END AS Fragile_Equipment,
    CASE WHEN substr(h,10,1) = '0' THEN NULL ELSE c_mktsegment END AS Hospital_Info,
    CASE WHEN substr(h,11,1) = '0' THEN NULL WHEN n_regionkey IN (0, 2) THEN 'Yes' ELSE 'No' END AS Rural_Hospital,
    CASE WHEN substr(h,4,1) = 'f' THEN '13/45/99' ELSE strftime(CAST(o_orderdate AS DATE), '%m/%d/%y') END
      AS Order_Placed_Date,
    strftime(ship, '%m/%d/%y') AS Delivery_Date,
    CASE WHEN substr(h,3,1) = '0' THEN NULL
         WHEN substr(h,3,1) = '1' THEN 'Missing'
         WHEN substr(h,2,1) = 'a' THEN 'PSC ' || CAST(c_custkey AS VARCHAR) || ', Box 7, APO AE ' || zip5
         WHEN substr(h,2,1) = 'b' THEN 'USNS Vessel, fpo AP ' || zip5
         WHEN substr(h,2,1) = 'c' THEN CAST(c_custkey AS VARCHAR) || ' Harbor Rd, Suite ' || zip5
         ELSE CAST(c_custkey AS VARCHAR) || ' Main St, City ' || CAST(c_custkey AS VARCHAR) || ', ' || st || ' ' || zip5
    END AS Hospital_Location,
    o_totalprice / 10.0 + c_acctbal AS Transport_Cost
  FROM base
),
lab AS (SELECT * FROM raw WHERE """ + H("o_orderkey", "2024") + r""" % 1000 >= 100),
unlab AS (SELECT * EXCLUDE (Transport_Cost) FROM raw WHERE """ + H("o_orderkey", "2024") + r""" % 1000 < 100),
shift AS (SELECT CASE WHEN min(Transport_Cost) < 0 THEN abs(min(Transport_Cost)) + 1 ELSE 0.0 END AS Target_Shift_Value
          FROM lab),
lablog AS (SELECT lab.*, shift.Target_Shift_Value, ln(1 + Transport_Cost + shift.Target_Shift_Value) AS Transport_Cost_Log
           FROM lab CROSS JOIN shift)
"""

# Feature expressions over a relation with the raw columns.
LOC = r"""
    CASE WHEN Hospital_Location IS NULL OR Hospital_Location = 'Missing' THEN 'Missing'
         ELSE coalesce(nullif(regexp_extract(Hospital_Location, '\b([A-Z]{2})\b\s+\d{5}', 1), ''), 'Missing') END
      AS Location_State,
    CASE WHEN Hospital_Location IS NULL OR Hospital_Location = 'Missing' THEN 'Missing'
         ELSE coalesce(nullif(regexp_extract(Hospital_Location, '\b(\d{5})\b', 1), ''), 'Missing') END AS Location_Zip,
    CASE WHEN Hospital_Location IS NULL OR Hospital_Location = 'Missing' THEN 0
         WHEN regexp_matches(Hospital_Location, '(?i)\b(APO|FPO|DPO)\b')
           OR regexp_matches(Hospital_Location, '\b(AA|AE|AP)\b') THEN 1 ELSE 0 END AS Location_Is_Military"""


def _dates(prefix: str, d: str) -> str:
    return (
        f"CAST(year({d}) AS DOUBLE) AS {prefix}_Year, CAST(month({d}) AS DOUBLE) AS {prefix}_Month, "
        f"CAST(day({d}) AS DOUBLE) AS {prefix}_Day, CAST(isodow({d}) - 1 AS DOUBLE) AS {prefix}_DayOfWeek, "
        f"CAST(quarter({d}) AS DOUBLE) AS {prefix}_Quarter"
    )


DATES = (
    "CAST(try_strptime(Order_Placed_Date, '%m/%d/%y') AS DATE) AS od, "
    "CAST(try_strptime(Delivery_Date, '%m/%d/%y') AS DATE) AS dd"
)
DATE_FEATS = _dates("Order", "od") + ", " + _dates("Delivery", "dd") + ", CAST(date_diff('day', od, dd) AS DOUBLE) AS Delivery_Time"

PHYS = """
    Equipment_Height * Equipment_Width AS Equipment_Area,
    CASE WHEN Equipment_Height * Equipment_Width > 0 THEN Equipment_Weight / (Equipment_Height * Equipment_Width)
         ELSE 0.0 END AS Weight_per_Area,
    CASE WHEN Equipment_Weight > 0 THEN Equipment_Value / Equipment_Weight ELSE 0.0 END AS Value_per_Weight,
    CASE WHEN Equipment_Height * Equipment_Width > 0 THEN Equipment_Value / (Equipment_Height * Equipment_Width)
         ELSE 0.0 END AS Value_per_Area"""

# engineered labelled rows (dates + address + physical), keeps the raw columns
ENG = f"""
eng AS (
  SELECT x.* EXCLUDE (od, dd), {DATE_FEATS}, {PHYS}
  FROM (SELECT lablog.*, {LOC}, {DATES} FROM lablog) x
)"""

FOLDS = f"""
folds AS (SELECT eng.*, CAST({H('o_orderkey')} % 5 AS INTEGER) AS fold FROM eng)"""

# closed-form OOF predictions: mean, group_mean (Transport_Method), line (Equipment_Value)
BASE_PREDS = FOLDS + """,
fst AS (SELECT fold, count(Transport_Cost_Log) AS nf, sum(Transport_Cost_Log) AS sy,
               count(Equipment_Value * Transport_Cost_Log) AS nx,
               sum(CASE WHEN Equipment_Value IS NOT NULL THEN Transport_Cost_Log END) AS syx,
               sum(CASE WHEN Transport_Cost_Log IS NOT NULL THEN Equipment_Value END) AS sx,
               sum(Equipment_Value * Transport_Cost_Log) AS sxy,
               sum(CASE WHEN Transport_Cost_Log IS NOT NULL THEN Equipment_Value * Equipment_Value END) AS sxx
        FROM folds GROUP BY fold),
rst AS (SELECT fold, sum(nf) OVER () - nf AS n, sum(sy) OVER () - sy AS sy, sum(nx) OVER () - nx AS nx,
               sum(syx) OVER () - syx AS syx, sum(sx) OVER () - sx AS sx,
               sum(sxy) OVER () - sxy AS sxy, sum(sxx) OVER () - sxx AS sxx FROM fst),
pf AS (SELECT fold, sy / n AS m, (nx * sxy - sx * syx) / (nx * sxx - sx * sx) AS slope FROM rst),
pf2 AS (SELECT pf.fold, pf.m, pf.slope, (rst.syx - pf.slope * rst.sx) / rst.nx AS icpt FROM pf JOIN rst USING (fold)),
cst AS (SELECT Transport_Method AS v, fold, count(Transport_Cost_Log) AS n, sum(Transport_Cost_Log) AS s
        FROM folds GROUP BY 1, 2),
ctt AS (SELECT v, sum(n) AS nt, sum(s) AS st FROM cst GROUP BY v),
cre AS (SELECT cst.v, cst.fold, nt - n AS nr, st - s AS sr FROM cst JOIN ctt USING (v)),
wide AS (
  SELECT f.o_orderkey, f.fold, f.Transport_Cost_Log AS y, pf2.m AS mean,
         CASE WHEN cre.nr > 0 THEN cre.sr / cre.nr ELSE pf2.m END AS group_mean,
         coalesce(pf2.icpt + pf2.slope * f.Equipment_Value, pf2.m) AS line
  FROM folds f JOIN pf2 USING (fold) LEFT JOIN cre ON f.Transport_Method = cre.v AND f.fold = cre.fold
),
preds AS (
  SELECT o_orderkey, fold, y, 'mean' AS model, mean AS pred FROM wide
  UNION ALL SELECT o_orderkey, fold, y, 'group_mean', group_mean FROM wide
  UNION ALL SELECT o_orderkey, fold, y, 'line', line FROM wide
)"""

INV_W = """,
scores AS (SELECT model, sqrt(avg((y - pred) * (y - pred))) AS rmse FROM preds GROUP BY model),
rw AS (SELECT model, 1.0 / (rmse * rmse) AS weight FROM scores),
wts AS (SELECT model, CASE WHEN abs(sum(weight) OVER () - 1.0) <= 1e-9 THEN weight
                           WHEN sum(weight) OVER () <> 0 THEN weight / sum(weight) OVER () END AS weight FROM rw),
blended AS (SELECT p.o_orderkey, sum(w.weight * p.pred) AS blend_log FROM preds p JOIN wts w USING (model)
            WHERE w.weight > 0 GROUP BY p.o_orderkey),
blend_out AS (SELECT o_orderkey, blend_log,
                     greatest(exp(blend_log) - 1 - (SELECT Target_Shift_Value FROM shift), 0.0) AS value FROM blended)"""


def _te_oof(col: str, smoothing: float, min_leaf: int, src: str = "folds", alias: str | None = None) -> str:
    """Leak-free encoding of ``col`` as a CTE named ``te_{col}`` (key, fold, encoded)."""
    a = alias or f"te_{col}"
    lam = f"1.0 / (1.0 + exp(-((nr) - {float(min_leaf)}) / {float(smoothing)}))"
    return f"""
{a}_ft AS (SELECT fold, count(Transport_Cost_Log) AS nf, sum(Transport_Cost_Log) AS sf FROM {src} GROUP BY fold),
{a}_pr AS (SELECT fold, (sum(sf) OVER () - sf) / (sum(nf) OVER () - nf) AS prior FROM {a}_ft),
{a}_cs AS (SELECT {col} AS v, fold, count(Transport_Cost_Log) AS n, sum(Transport_Cost_Log) AS s FROM {src} GROUP BY 1, 2),
{a}_ct AS (SELECT v, sum(n) AS nt, sum(s) AS st FROM {a}_cs GROUP BY v),
{a}_en AS (SELECT {a}_cs.v, {a}_cs.fold, nt - n AS nr, st - s AS sr FROM {a}_cs JOIN {a}_ct USING (v)),
{a} AS (
  SELECT r.o_orderkey, r.fold, r.Transport_Cost_Log AS y,
         CASE WHEN e.nr > 0 THEN p.prior * (1.0 - {lam}) + (e.sr / e.nr) * {lam} ELSE p.prior END AS enc
  FROM {src} r JOIN {a}_pr p USING (fold) LEFT JOIN {a}_en e ON CAST(r.{col} AS VARCHAR) = e.v AND r.fold = e.fold
)"""


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes if c.strip())


def _cat_fill(cols) -> str:
    return ", ".join(f"coalesce({c}, 'Missing') AS {c}" for c in cols)


LABEL_COLS = ["Equipment_Type", "CrossBorder_Shipping", "Urgent_Shipping", "Installation_Service", "Transport_Method",
              "Fragile_Equipment", "Hospital_Info", "Location_State", "Location_Zip"]
RAW_CATS = ["Equipment_Type", "CrossBorder_Shipping", "Urgent_Shipping", "Installation_Service", "Transport_Method",
            "Fragile_Equipment", "Hospital_Info", "Rural_Hospital"]
RAW_NUMS = ["Supplier_Reliability", "Equipment_Height", "Equipment_Width", "Equipment_Weight", "Equipment_Value",
            "Base_Transport_Fee"]
ALL_RAW = ["o_orderkey", "Supplier_Name", *RAW_NUMS, *RAW_CATS[:7], "Rural_Hospital", "Order_Placed_Date",
           "Delivery_Date", "Hospital_Location", "Transport_Cost"]


def _long(cols, src: str, cast: str = "VARCHAR") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS {cast}) AS value FROM {src}" for c in cols)


def _stack_select(cols, fields_sql, src: str, name: str = "column") -> str:
    """One row per column from per-column expressions (fields_sql(c) → 'expr AS f, ...')."""
    return " UNION ALL ".join(f"SELECT '{c}' AS \"{name}\", {fields_sql(c)} FROM {src}" for c in cols)


def _pop_skew(c: str, src: str) -> str:
    return (f"(SELECT avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5) "
            f"FROM {src}, (SELECT avg({c}) AS m FROM {src}) mm WHERE {c} IS NOT NULL)")


def _corr_features():
    return ["Supplier_Reliability", "Equipment_Height", "Equipment_Width", "Equipment_Weight", "Equipment_Value",
            "Base_Transport_Fee", "Order_Year", "Order_Month", "Order_Day", "Order_DayOfWeek", "Order_Quarter",
            "Delivery_Year", "Delivery_Month", "Delivery_Day", "Delivery_DayOfWeek", "Delivery_Quarter",
            "Delivery_Time", "Location_Is_Military", "Equipment_Area", "Weight_per_Area", "Value_per_Weight",
            "Value_per_Area"]


CORR = _stack_select(
    _corr_features(), lambda c: f"corr(CAST({c} AS DOUBLE), Transport_Cost) AS r", "eng", name="feature"
)
CORR_BANDED = f"""corr_t AS (SELECT feature, r, abs(r) AS abs_r,
  CASE WHEN abs(r) > 0.3 THEN 'strong' WHEN abs(r) > 0.15 THEN 'moderate' ELSE 'weak' END AS band FROM ({CORR}) q)"""

VALID = f"{H('o_orderkey')} % 1000 < 200"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["oof_target_encoding_rmse"] = _w(RAW, ENG, FOLDS, _te_oof("Transport_Method", 1.0, 20)) + """
SELECT fold, count(*) AS n, sqrt(avg((y - enc) * (y - enc))) AS rmse, avg(abs(y - enc)) AS mae,
       1.0 - avg((y - enc) * (y - enc)) / var_pop(y) AS r2
FROM te_Transport_Method GROUP BY fold"""
    q["raw_shipments"] = _w(RAW) + "\nSELECT * FROM raw"
    q["location_features"] = _w(RAW) + f"\nSELECT o_orderkey, {LOC} FROM raw"
    q["date_features"] = _w(RAW) + f"\nSELECT o_orderkey, {DATE_FEATS} FROM (SELECT o_orderkey, {DATES} FROM raw) x"
    q["mixed_date_parse"] = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt, substr(md5(CAST(o_orderkey AS VARCHAR)), 12, 1) AS nib
           FROM orders),
t AS (SELECT o_orderkey, CASE WHEN nib IN ('0','1','2','3') THEN strftime(dt, '%Y-%m-%d')
                              WHEN nib IN ('4','5','6','7') THEN strftime(dt, '%m/%d/%Y')
                              WHEN nib = '8' THEN 'not a date'
                              ELSE strftime(dt, '%m/%d/%y') END AS text FROM o)
SELECT o_orderkey, text,
       strftime(coalesce(try_strptime(text, '%m/%d/%y'),
                     CASE WHEN regexp_matches(text, '^\\d{2}/\\d{2}/\\d{4}$') THEN try_strptime(text, '%m/%d/%Y') END,
                     CASE WHEN regexp_matches(text, '^\\d{4}-\\d{2}-\\d{2}$') THEN try_strptime(text, '%Y-%m-%d') END),
                '%Y-%m-%d') AS parsed
FROM t"""
    q["physical_features"] = _w(RAW) + f"""
SELECT o_orderkey, {PHYS},
       Equipment_Weight / (Equipment_Height * Equipment_Width + 1e-6) AS Density FROM raw"""
    q["target_shift_log"] = _w(RAW) + "\nSELECT o_orderkey, Target_Shift_Value, Transport_Cost_Log FROM lablog"
    q["flag_codes"] = _w(RAW) + """
SELECT o_orderkey,
  CASE coalesce(Rural_Hospital, 'Missing') WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'Missing' THEN -1 END AS Rural_Hospital,
  CASE WHEN Urgent_Shipping IN ('True', 'true', 'Yes') THEN 1 WHEN Urgent_Shipping IN ('False', 'false', 'No') THEN 0
       END AS Urgent_Shipping,
  CASE WHEN CrossBorder_Shipping IN ('True', 'true', 'Yes') THEN 1
       WHEN CrossBorder_Shipping IN ('False', 'false', 'No') THEN 0 END AS CrossBorder_Shipping
FROM raw"""
    q["target_filters"] = _w(RAW) + """
SELECT (SELECT count(*) FROM lab) AS n_rows,
       (SELECT count(*) FROM lab WHERE Transport_Cost IS NOT NULL) AS n_non_null,
       (SELECT count(*) FROM lab WHERE Transport_Cost >= 0) AS n_non_negative,
       (SELECT count(*) FROM lab WHERE Transport_Cost >= 0 AND NOT isnan(ln(1 + Transport_Cost))) AS n_valid_log,
       (SELECT max(abs(exp(ln(1 + Transport_Cost)) - 1 - Transport_Cost)) < 1e-6 FROM lab WHERE Transport_Cost >= 0)
         AS roundtrip_ok"""
    q["preview"] = _w(RAW) + """
(SELECT o_orderkey, Transport_Cost, 'head' AS part FROM raw ORDER BY o_orderkey LIMIT 5)
UNION ALL
(SELECT o_orderkey, Transport_Cost, 'tail' AS part FROM raw ORDER BY o_orderkey DESC LIMIT 5)"""
    q["distinct_values"] = _w(RAW) + "\nSELECT DISTINCT Transport_Method FROM raw ORDER BY 1"
    q["union_tagged"] = _w(RAW) + """
SELECT 1 AS is_train, count(*) AS n_rows, count(Transport_Cost) AS n_target, count(DISTINCT o_orderkey) AS n_keys FROM lab
UNION ALL
SELECT 0, count(*), 0, count(DISTINCT o_orderkey) FROM unlab"""
    q["separate"] = _w(RAW) + """
SELECT o_orderkey, Equipment_Type, CrossBorder_Shipping, Urgent_Shipping, Installation_Service, Transport_Method,
       Fragile_Equipment, Hospital_Info, Rural_Hospital, Supplier_Reliability, Equipment_Height, Equipment_Width,
       Equipment_Weight, Equipment_Value, Base_Transport_Fee, Transport_Cost FROM lab"""
    q["holdout_split"] = _w(RAW) + f"\nSELECT o_orderkey, {VALID} AS is_valid FROM raw"
    q["kfold"] = _w(RAW) + f"\nSELECT o_orderkey, CAST({H('o_orderkey')} % 5 AS INTEGER) AS fold FROM raw"
    q["kfold_contiguous"] = _w(RAW) + "\nSELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM raw"
    q["target_profile"] = _w(RAW) + """
SELECT min(Transport_Cost) AS min, max(Transport_Cost) AS max, avg(Transport_Cost) AS mean,
       count_if(Transport_Cost < 0) AS n_negative,
       CASE WHEN min(Transport_Cost) < 0 THEN abs(min(Transport_Cost)) + 1 ELSE 0.0 END AS shift FROM lab"""
    mom = lambda c: (
        f"count({c}) AS n, avg({c}) AS mean, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS median, "
        f"stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
        f"{_pop_skew(c, 'lablog')} AS skew, count_if({c} < 0) AS n_negative"
    )
    q["moments"] = _w(RAW) + "\n" + _stack_select(["Transport_Cost", "Transport_Cost_Log"], mom, "lablog")
    q["skew_report"] = _w(RAW) + f"""
SELECT {_pop_skew('Transport_Cost', 'lablog')} AS skew_before, {_pop_skew('Transport_Cost_Log', 'lablog')} AS skew_after,
       abs({_pop_skew('Transport_Cost', 'lablog')}) - abs({_pop_skew('Transport_Cost_Log', 'lablog')}) AS reduction,
       'log' AS transform"""
    desc = lambda c: (
        f"count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS p50, "
        f"CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS p75, CAST(max({c}) AS DOUBLE) AS max"
    )
    q["describe"] = _w(RAW) + "\n" + _stack_select(RAW_NUMS, desc, "raw")
    q["null_profile"] = _w(RAW) + "\n" + _stack_select(
        ALL_RAW, lambda c: f"count_if({c} IS NULL) AS n_missing, count_if({c} IS NULL) / count(*) AS frac_missing", "raw"
    )
    q["cardinality"] = _w(RAW, f"loc AS (SELECT raw.*, {LOC} FROM raw)") + "\n" + _stack_select(
        RAW_CATS + ["Location_State", "Location_Zip"], lambda c: f"count(DISTINCT {c}) AS n_distinct", "loc"
    )
    q["corr_with_target"] = _w(RAW, ENG, CORR_BANDED) + "\nSELECT * FROM corr_t ORDER BY r"
    q["corr_top_bottom"] = _w(RAW, ENG, CORR_BANDED) + """
(SELECT *, 'top' AS side FROM corr_t WHERE r IS NOT NULL ORDER BY r DESC, feature LIMIT 3)
UNION ALL
(SELECT *, 'bottom' AS side FROM corr_t WHERE r IS NOT NULL ORDER BY r ASC, feature LIMIT 3)"""
    q["histogram"] = _w(RAW, """
rng AS (SELECT min(Transport_Cost_Log) AS lo, max(Transport_Cost_Log) AS hi FROM lablog
        WHERE Transport_Cost_Log IS NOT NULL AND NOT isnan(Transport_Cost_Log)),
b AS (SELECT least(CAST(CASE WHEN (hi - lo) / 50 = 0 THEN 0 ELSE floor((Transport_Cost_Log - lo) / ((hi - lo) / 50)) END
                        AS INTEGER), 49) AS bin
      FROM lablog, rng WHERE Transport_Cost_Log IS NOT NULL AND NOT isnan(Transport_Cost_Log)),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)""") + """
SELECT CAST(g.bin AS INTEGER) AS bin, lo + g.bin * ((hi - lo) / 50) AS lo, lo + (g.bin + 1) * ((hi - lo) / 50) AS hi,
       coalesce(c.n, 0) AS n
FROM (SELECT range AS bin FROM range(50)) g CROSS JOIN rng LEFT JOIN c ON g.bin = c.bin"""
    q["categorical_fill"] = _w(RAW) + f"""
SELECT o_orderkey, {_cat_fill(RAW_CATS[:7])},
       CASE coalesce(Rural_Hospital, 'Missing') WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 WHEN 'Missing' THEN -1 END
         AS Rural_Hospital FROM raw"""
    filled_all = f"filled AS (SELECT o_orderkey, {_cat_fill(LABEL_COLS)} FROM (SELECT raw.*, {LOC} FROM raw) x)"
    dict_cte = f"""dict AS (SELECT "column", value, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER)
                  AS code FROM (SELECT DISTINCT * FROM ({_long(LABEL_COLS, 'filled')}) u WHERE value IS NOT NULL) d)"""
    q["label_dictionary"] = _w(RAW, filled_all, dict_cte) + "\nSELECT * FROM dict"
    joins = " ".join(
        f"LEFT JOIN (SELECT value, code FROM dict WHERE \"column\" = '{c}') d{i} ON f.{c} = d{i}.value"
        for i, c in enumerate(LABEL_COLS)
    )
    q["label_encoded"] = _w(RAW, filled_all, dict_cte) + "\nSELECT f.o_orderkey, " + ", ".join(
        f"d{i}.code AS {c}" for i, c in enumerate(LABEL_COLS)
    ) + f" FROM filled f {joins}"
    e2 = ["Location_State", "Location_Zip"]
    tv = _w(RAW, ENG, f"""
tr AS (SELECT o_orderkey, {_cat_fill(e2)}, Hospital_Info FROM eng WHERE NOT ({VALID})),
va AS (SELECT o_orderkey, {_cat_fill(e2)}, Hospital_Info FROM eng WHERE {VALID}),
dict AS (SELECT "column", value, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code
         FROM (SELECT DISTINCT * FROM ({_long(e2, 'tr')}) u WHERE value IS NOT NULL) d)""")
    q["label_encode_unseen"] = tv + "\nSELECT va.o_orderkey, " + ", ".join(
        f"coalesce(d{i}.code, -1) AS {c}" for i, c in enumerate(e2)
    ) + " FROM va " + " ".join(
        f"LEFT JOIN (SELECT value, code FROM dict WHERE \"column\" = '{c}') d{i} ON va.{c} = d{i}.value"
        for i, c in enumerate(e2)
    )
    oh = ["Location_State", "Hospital_Info"]
    q["one_hot"] = _w(RAW, ENG, f"""
tr AS (SELECT * FROM eng WHERE NOT ({VALID})),
va AS (SELECT * FROM eng WHERE {VALID}),
dict AS (SELECT "column", value, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code
         FROM (SELECT DISTINCT * FROM ({_long(oh, 'tr')}) u WHERE value IS NOT NULL) d)""") + "\nSELECT va.o_orderkey, " + ", ".join(
        f"coalesce(d{i}.code, -1) AS {c}_pos" for i, c in enumerate(oh)
    ) + " FROM va " + " ".join(
        f"LEFT JOIN (SELECT value, code FROM dict WHERE \"column\" = '{c}') d{i} ON va.{c} = d{i}.value"
        for i, c in enumerate(oh)
    )
    lam = "1.0 / (1.0 + exp(-(n - 20.0) / 1.0))"
    q["target_encoding"] = _w(RAW, f"tr AS (SELECT * FROM lablog WHERE NOT ({VALID}))",
                              "pri AS (SELECT avg(Transport_Cost_Log) AS prior FROM tr)") + f"""
SELECT "column", value, n, mean, prior * (1.0 - {lam}) + mean * {lam} AS encoded FROM (
  SELECT 'Transport_Method' AS "column", Transport_Method AS value, count(Transport_Cost_Log) AS n,
         avg(Transport_Cost_Log) AS mean FROM tr WHERE Transport_Method IS NOT NULL GROUP BY 2
  UNION ALL
  SELECT 'Hospital_Info', Hospital_Info, count(Transport_Cost_Log), avg(Transport_Cost_Log)
  FROM tr WHERE Hospital_Info IS NOT NULL GROUP BY 2) s CROSS JOIN pri"""
    enc = lambda c: f"""
e_{c} AS (SELECT coalesce({c}, 'Missing') AS v, count(*) AS n, avg(Transport_Cost_Log) AS mean FROM tr GROUP BY 1)"""  # noqa: E731
    one = "prior * (1.0 - 1.0 / (1.0 + exp(-({0}.n - 20.0) / 1.0))) + {0}.mean * (1.0 / (1.0 + exp(-({0}.n - 20.0) / 1.0)))"
    q["encoder_store"] = _w(RAW, f"""
tr AS (SELECT * FROM lablog WHERE NOT ({VALID})),
va AS (SELECT * FROM lablog WHERE {VALID}),
pri AS (SELECT avg(Transport_Cost_Log) AS prior, CAST(quantile_cont(Equipment_Height, 0.5) AS DOUBLE) AS mh, CAST(quantile_cont(Equipment_Value, 0.5) AS DOUBLE) AS mv FROM tr),
st AS (SELECT avg(coalesce(Equipment_Height, mh)) AS ah, stddev_pop(coalesce(Equipment_Height, mh)) AS sh,
              avg(coalesce(Equipment_Value, mv)) AS av, stddev_pop(coalesce(Equipment_Value, mv)) AS sv FROM tr CROSS JOIN pri)""", enc("Transport_Method"), enc("Hospital_Info")) + f"""
SELECT o_orderkey, coalesce({one.format('t')}, prior) AS Transport_Method, coalesce({one.format('h')}, prior) AS Hospital_Info,
       (coalesce(Equipment_Height, mh) - ah) / sh AS Equipment_Height, (coalesce(Equipment_Value, mv) - av) / sv AS Equipment_Value
FROM va CROSS JOIN pri CROSS JOIN st LEFT JOIN e_Transport_Method t ON t.v = coalesce(va.Transport_Method, 'Missing')
LEFT JOIN e_Hospital_Info h ON h.v = coalesce(va.Hospital_Info, 'Missing')"""
    q["target_encode_oof"] = _w(
        RAW, ENG, FOLDS, _te_oof("Transport_Method", 2.0, 20), _te_oof("Hospital_Info", 2.0, 20)
    ) + """
SELECT a.o_orderkey, a.fold, a.enc AS Transport_Method_te, b.enc AS Hospital_Info_te
FROM te_Transport_Method a JOIN te_Hospital_Info b USING (o_orderkey)"""
    lam1 = "1.0 / (1.0 + exp(-(n - 20.0) / 1.0))"
    q["target_encode_leakage"] = _w(RAW, ENG, FOLDS, _te_oof("Hospital_Info", 1.0, 20), f"""
pri AS (SELECT avg(Transport_Cost_Log) AS prior FROM folds),
st AS (SELECT Hospital_Info AS v, count(Transport_Cost_Log) AS n, avg(Transport_Cost_Log) AS mean FROM folds
       WHERE Hospital_Info IS NOT NULL GROUP BY 1),
enc AS (SELECT v, prior * (1.0 - {lam1}) + mean * {lam1} AS e FROM st CROSS JOIN pri),
leak AS (SELECT f.Transport_Cost_Log AS y, coalesce(enc.e, pri.prior) AS p
         FROM folds f CROSS JOIN pri LEFT JOIN enc ON f.Hospital_Info = enc.v)""") + """
SELECT 'whole_train' AS variant, count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse FROM leak
UNION ALL
SELECT 'out_of_fold', count(*), sqrt(avg((y - enc) * (y - enc))) FROM te_Hospital_Info"""
    q["ordered_target_stat"] = _w(RAW, """
o AS (SELECT o_orderkey, Hospital_Info, CAST(Transport_Cost AS DECIMAL(28,3)) AS y,
             md5(CAST(o_orderkey AS VARCHAR) || '42') AS h FROM lab),
pri AS (SELECT avg(Transport_Cost) AS prior FROM lab),
w AS (SELECT o_orderkey,
        count(y) OVER (PARTITION BY Hospital_Info ORDER BY h, o_orderkey
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n,
        sum(y) OVER (PARTITION BY Hospital_Info ORDER BY h, o_orderkey
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s
      FROM o)""") + """
SELECT o_orderkey, n AS Hospital_Info_ots_n, CAST(coalesce(s, 0) AS DOUBLE) AS Hospital_Info_ots_sum,
       (CAST(coalesce(s, 0) AS DOUBLE) + 1.0 * prior) / (n + 1.0) AS Hospital_Info_ots
FROM w CROSS JOIN pri"""
    q["standard_scale"] = _w(RAW, f"""
tr AS (SELECT * FROM lab WHERE NOT ({VALID})),
va AS (SELECT * FROM lab WHERE {VALID}),
st AS (SELECT avg(Equipment_Value) AS mv, stddev_pop(Equipment_Value) AS sv,
              avg(Equipment_Width) AS mw, stddev_pop(Equipment_Width) AS sw FROM tr)""") + """
SELECT o_orderkey,
  (Equipment_Value - mv) / CASE WHEN sv IS NULL OR sv = 0 THEN 1.0 ELSE sv END AS Equipment_Value_z,
  (Equipment_Width - mw) / CASE WHEN sw IS NULL OR sw = 0 THEN 1.0 ELSE sw END AS Equipment_Width_z
FROM va CROSS JOIN st"""
    med_cols = ["Supplier_Reliability", "Equipment_Height", "Base_Transport_Fee"]
    q["median_fill"] = _w(RAW, f"""
tr AS (SELECT * FROM lab WHERE NOT ({VALID})),
va AS (SELECT * FROM lab WHERE {VALID}),
md AS (SELECT {', '.join(f'CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS m_{c}' for c in med_cols)} FROM tr)""") + \
        "\nSELECT o_orderkey, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in med_cols) + " FROM va CROSS JOIN md"
    mf = ["Transport_Method", "Hospital_Info", "Location_State", "Installation_Service"]
    q["most_frequent"] = _w(RAW, ENG, f"tr AS (SELECT * FROM eng WHERE NOT ({VALID}))",
                            f"cnt AS (SELECT \"column\", value, count(*) AS n FROM ({_long(mf, 'tr')}) u "
                            "WHERE value IS NOT NULL GROUP BY 1, 2)") + """
SELECT "column", arg_min(value, (-n, value)) AS value, max(n) AS n FROM cnt GROUP BY 1"""
    q["iterative_impute_one_predictor"] = _w(RAW, """
d AS (SELECT o_orderkey, Equipment_Weight, Equipment_Value FROM lab WHERE Equipment_Value IS NOT NULL),
fit AS (SELECT regr_slope(Equipment_Weight, Equipment_Value) AS b, regr_intercept(Equipment_Weight, Equipment_Value) AS a
        FROM d)""") + """
SELECT o_orderkey, coalesce(Equipment_Weight, a + b * Equipment_Value) AS Equipment_Weight FROM d CROSS JOIN fit"""
    q["ols_one_feature"] = _w(RAW) + """
SELECT regr_slope(Transport_Cost_Log, Equipment_Value) AS slope, regr_intercept(Transport_Cost_Log, Equipment_Value) AS intercept
FROM lablog WHERE Equipment_Value IS NOT NULL"""
    # One feature: w minimises ½(c + l2)w² − s·w + l1·|w|, on the moments of the other folds.
    q["oof_linear_one_feature"] = _w(RAW, ENG, f"""
d AS (SELECT o_orderkey, Transport_Cost_Log AS y, Equipment_Value AS x, {H('o_orderkey')} % 5 AS fold FROM eng WHERE Equipment_Value IS NOT NULL),
k AS (SELECT DISTINCT fold FROM d),
m AS (SELECT k.fold, count(*) AS n, avg(x) AS xm, avg(y) AS ym, covar_pop(y, x) AS s, var_pop(x) AS c
      FROM k JOIN d ON d.fold <> k.fold GROUP BY k.fold),
w AS (SELECT *, s / c AS w_ols, s / (c + 1e12 / n) AS w_ridge, sign(s) * greatest(abs(s) - 1000.0, 0) / c AS w_lasso,
             sign(s) * greatest(abs(s) - 2000.0 * 0.25, 0) / (c + 2000.0 * 0.75) AS w_enet FROM m)""") + """
SELECT o_orderkey, CAST(d.fold AS INT) AS fold, """ + ", ".join(f"ym + w_{n} * (x - xm) AS {n}" for n in ("ols", "ridge", "lasso", "enet")) + """
FROM d JOIN w ON d.fold = w.fold"""
    q["iterative_impute_two_predictors"] = _w(RAW, """
m AS (SELECT avg(Equipment_Value) AS mv, avg(Equipment_Width) AS mw FROM lab),
d AS (SELECT o_orderkey, Supplier_Reliability AS y, Equipment_Value AS u, Equipment_Width AS v FROM lab
      WHERE Equipment_Value IS NOT NULL AND Equipment_Width IS NOT NULL),
f AS (SELECT regr_sxx(y, u) AS suu, regr_sxx(y, v) AS svv, regr_sxy(y, u) AS syu, regr_sxy(y, v) AS syv,
             covar_pop(u, v) * count(*) AS suv, avg(y) AS ym, avg(u) AS um, avg(v) AS vm FROM d WHERE y IS NOT NULL),
w AS (SELECT *, (syu * svv - syv * suv) / (suu * svv - suv * suv) AS bu, (syv * suu - syu * suv) / (suu * svv - suv * suv) AS bv FROM f)""") + """
SELECT o_orderkey, coalesce(y, ym + bu * (u - um) + bv * (v - vm)) AS Supplier_Reliability FROM d CROSS JOIN w"""
    bp = _w(RAW, ENG, BASE_PREDS)
    q["model_scores"] = bp + """
SELECT model, count(y - pred) AS n, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae,
       1.0 - avg((y - pred) * (y - pred)) / var_pop(y) AS r2 FROM preds GROUP BY model"""
    q["regression_metrics"] = bp + """,
lp AS (SELECT y, pred, exp(y) - 1 - s AS yo, exp(pred) - 1 - s AS po
       FROM preds CROSS JOIN (SELECT Target_Shift_Value AS s FROM shift) sh WHERE model = 'line')
SELECT count(yo - po) AS n, sqrt(avg((yo - po) * (yo - po))) AS rmse, avg(abs(yo - po)) AS mae,
       1.0 - avg((yo - po) * (yo - po)) / var_pop(yo) AS r2,
       avg(CASE WHEN yo <> 0 THEN abs((yo - po) / yo) END) * 100.0 AS mape, count_if(yo = 0) AS n_zero_y,
       sqrt(avg((yo - po) * (yo - po))) AS rmse_original FROM lp"""
    q["fold_mean_rmse"] = bp + """
SELECT model, avg(r) AS mean_fold_rmse, stddev_samp(r) AS std_fold_rmse FROM (
  SELECT model, fold, sqrt(avg((y - pred) * (y - pred))) AS r FROM preds GROUP BY model, fold) t GROUP BY model"""
    q["residuals"] = bp + "\nSELECT o_orderkey, model, pred, y - pred AS residual FROM preds"
    q["align_predictions"] = bp + "\nSELECT o_orderkey, group_mean, line, mean FROM wide"
    q["alignment_gaps"] = bp + """
SELECT o_orderkey, count(DISTINCT model) AS n_models FROM preds
WHERE NOT (model = 'line' AND substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 1) = '0') GROUP BY 1 HAVING count(DISTINCT model) <> 3"""
    q["simple_average"] = bp + "\nSELECT o_orderkey, avg(pred) AS pred, first(y) AS y FROM preds GROUP BY 1"
    bw = _w(RAW, ENG, BASE_PREDS + INV_W)
    q["normalise_weights"] = bw + "\nSELECT model, weight FROM wts"
    q["blend"] = bw + "\nSELECT o_orderkey, blend_log, value FROM blend_out"
    q["relative_improvement"] = bw + """,
allp AS (SELECT o_orderkey, pred, y, model FROM preds
         UNION ALL SELECT o_orderkey, avg(pred), first(y), 'simple_average' FROM preds GROUP BY 1
         UNION ALL SELECT b.o_orderkey, b.blend_log, w.y, 'weighted' FROM blended b
                   JOIN (SELECT o_orderkey, first(y) AS y FROM preds GROUP BY 1) w USING (o_orderkey)),
sc AS (SELECT model, sqrt(avg((y - pred) * (y - pred))) AS rmse FROM allp GROUP BY model),
best AS (SELECT arg_min(model, (rmse, model)) AS best_model, min(rmse) AS best_rmse FROM sc
         WHERE model NOT IN ('simple_average', 'weighted'))
SELECT model, rmse, best_model, best_rmse, (best_rmse - rmse) / best_rmse * 100.0 AS improvement_pct
FROM sc CROSS JOIN best WHERE model IN ('simple_average', 'weighted')"""
    q["ensemble_difference"] = bw + """,
man AS (SELECT o_orderkey, greatest(exp(sum(weight * pred)) - 1 - (SELECT Target_Shift_Value FROM shift), 0.0) AS value
        FROM preds JOIN (VALUES ('mean', 0.64), ('group_mean', 0.01), ('line', 0.35)) v(model, weight) USING (model) GROUP BY o_orderkey),
a AS (SELECT avg(value) AS mean_weighted FROM blend_out), b AS (SELECT avg(value) AS mean_manual FROM man)
SELECT mean_weighted, mean_manual, abs(mean_weighted - mean_manual) AS abs_diff FROM a CROSS JOIN b"""
    q["prediction_summary"] = bw + """
SELECT min(value) AS min, max(value) AS max, avg(value) AS mean, CAST(quantile_cont(value, 0.5) AS DOUBLE) AS median
FROM blend_out"""
    q["cross_model_means"] = bp + """
SELECT model, avg(pred) AS mean_pred, (SELECT avg(p) FROM (SELECT avg(pred) AS p FROM preds GROUP BY o_orderkey) t)
       AS ensemble_mean,
       abs(avg(pred) - (SELECT avg(p) FROM (SELECT avg(pred) AS p FROM preds GROUP BY o_orderkey) t)) AS abs_diff
FROM preds GROUP BY model"""
    models = ["group_mean", "line", "mean"]
    wcols = ", ".join(
        f"('0x' || substr(md5(CAST(trial AS VARCHAR) || '-{m}-42'), 1, 8))::BIGINT / 4294967296.0 AS u_{m}" for m in models
    )
    tot = " + ".join(f"u_{m}" for m in models)
    quad = " + ".join(f"w_{a} * w_{b} * e_{a}_{b}" for a in models for b in models)
    egram = ", ".join(f"sum((w.{a} - w.y) * (w.{b} - w.y)) AS e_{a}_{b}" for a in models for b in models)
    q["weight_search"] = bp + f""",
eg AS (SELECT {egram}, count(*) AS n FROM wide w),
tr AS (SELECT trial, {', '.join(f'u_{m} / ({tot}) AS w_{m}' for m in models)}
       FROM (SELECT range AS trial, {wcols} FROM range(3000)) u),
sc AS (SELECT trial, {', '.join(f'w_{m}' for m in models)}, sqrt(({quad}) / n) AS rmse FROM tr CROSS JOIN eg)
SELECT trial, {', '.join(f'w_{m} AS {m}' for m in models)}, rmse FROM sc ORDER BY rmse, trial LIMIT 1"""
    sets = {
        "w_100_0_0": (1.0, 0.0, 0.0), "w_0_0_100": (0.0, 0.0, 1.0), "w_50_0_50": (0.5, 0.0, 0.5),
        "w_64_1_35": (0.64, 0.01, 0.35), "w_20_40_40": (0.2, 0.4, 0.4),
    }
    vals = ", ".join(
        f"('{s}', '{m}', {w!r})" for s, ws in sets.items() for m, w in zip(("mean", "group_mean", "line"), ws)
    )
    q["manual_weight_grid"] = bp + f""",
ws AS (SELECT * FROM (VALUES {vals}) v(weight_set, model, weight))
SELECT ws.weight_set, p.o_orderkey, sum(ws.weight * p.pred) AS blend_log,
       exp(sum(ws.weight * p.pred)) - 1 - (SELECT Target_Shift_Value FROM shift) AS value
FROM preds p JOIN ws USING (model) WHERE ws.weight > 0 GROUP BY 1, 2"""
    q["knn_embeddings"] = f"""
WITH e AS (SELECT vec_id AS key, CAST(embedding AS DOUBLE[]) AS vec, CAST(label AS DOUBLE) AS y,
                  {H('vec_id')} % 1000 < 200 AS is_q FROM embeddings),
d AS (SELECT q.key AS qkey, t.key AS tkey, list_distance(q.vec, t.vec) AS dist, t.y
      FROM e q JOIN e t ON q.is_q AND NOT t.is_q),
r AS (SELECT *, row_number() OVER (PARTITION BY qkey ORDER BY dist, tkey) AS rk FROM d),
k AS (SELECT *, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qkey) AS ex FROM r WHERE rk <= 10)
SELECT qkey AS key,
       sum(CASE WHEN ex = 1 THEN (CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / dist END * y)
         / sum(CASE WHEN ex = 1 THEN (CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / dist END) AS pred,
       count(*) AS n_neighbours
FROM k GROUP BY qkey"""
    # sinks: the value read back equals the value written
    q["csv_roundtrip"] = _w(RAW) + "\nSELECT * FROM lab"
    q["predictions_sink"] = bw + "\nSELECT o_orderkey, value FROM blend_out"
    q["dictionary_sink"] = q["label_dictionary"]
    q["prediction_store"] = bp + "\nSELECT o_orderkey, pred AS pred_log, model FROM preds WHERE model = 'line'"
    q["weights_store"] = q["normalise_weights"]
    train_cols = ",".join(ALL_RAW)
    test_cols = ",".join(c for c in ALL_RAW if c != "Transport_Cost")
    q["run_metadata"] = _w(RAW) + f"""
SELECT 'train_shape' AS item, '(' || CAST((SELECT count(*) FROM lab) AS VARCHAR) || ', 20)' AS value
UNION ALL SELECT 'test_shape', '(' || CAST((SELECT count(*) FROM unlab) AS VARCHAR) || ', 19)'
UNION ALL SELECT 'train_columns', '{train_cols}'
UNION ALL SELECT 'test_columns', '{test_cols}'
UNION ALL SELECT 'target_shift_value', CAST((SELECT Target_Shift_Value FROM shift) AS VARCHAR)
UNION ALL SELECT 'features_engineered', 'Location_State,Location_Zip,Location_Is_Military,Equipment_Area'"""
    return q
