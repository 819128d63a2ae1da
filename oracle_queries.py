"""DuckDB oracle SQL for the registered queries (independent re-statement of
each operator in plain SQL over the driver's tables)."""

from __future__ import annotations

D = "CAST({} AS DOUBLE)".format


def catalog_cte(kind: str = "part", as_of_year: int = 2026) -> str:
    if kind == "part":
        return f"""
li AS (
  SELECT l_partkey, count(*) AS n_lines, sum(l_quantity) AS sum_quantity, avg(l_quantity) AS avg_quantity,
         avg(l_discount) AS avg_discount, avg(l_extendedprice) AS avg_extendedprice, min(l_shipdate) AS first_shipdate
  FROM lineitem GROUP BY l_partkey),
cat0 AS (
  SELECT p_partkey AS item_id, p_brand AS oem, p_name AS model, p_brand AS brand_group, p_type AS item_type,
         CAST(p_retailprice AS DOUBLE) AS price_eur,
         CAST(100 AS DOUBLE) * (p_size - 1) / CAST(49 AS DOUBLE) AS spec_score_0_100,
         CAST(p_size AS DOUBLE) AS size, CAST(n_lines AS DOUBLE) AS n_lines, avg_quantity, avg_discount,
         avg_extendedprice, CAST({as_of_year} - year(first_shipdate) AS DOUBLE) AS item_age
  FROM part LEFT JOIN li ON p_partkey = l_partkey),
cat AS (
  SELECT *, CAST(100 AS DOUBLE) * (spec_score_0_100 / nullif(price_eur, 0)) AS value_score,
         {tier_sql('price_eur')} AS price_tier
  FROM cat0)"""
    return f"""
li AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_quantity, avg(l_quantity) AS avg_quantity,
         avg(l_discount) AS avg_discount, avg(l_extendedprice) AS avg_extendedprice, min(l_shipdate) AS first_shipdate
  FROM lineitem GROUP BY l_orderkey),
topq AS (SELECT max(sum_quantity) AS max_quantity FROM li),
cat0 AS (
  SELECT o_orderkey AS item_id, o_orderpriority AS oem, o_orderstatus AS model, o_orderpriority AS brand_group,
         o_orderstatus AS item_type, CAST(o_totalprice AS DOUBLE) AS price_eur,
         CAST(100 AS DOUBLE) * sum_quantity / nullif(max_quantity, 0) AS spec_score_0_100,
         CAST(sum_quantity AS DOUBLE) AS size, CAST(n_lines AS DOUBLE) AS n_lines, avg_quantity, avg_discount,
         avg_extendedprice, CAST({as_of_year} - year(o_orderdate) AS DOUBLE) AS item_age
  FROM orders LEFT JOIN li ON o_orderkey = l_orderkey CROSS JOIN topq),
cat AS (
  SELECT *, CAST(100 AS DOUBLE) * (spec_score_0_100 / nullif(price_eur, 0)) AS value_score,
         {tier_sql('price_eur')} AS price_tier
  FROM cat0)"""


def tier_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) OR {x} <= 0 THEN NULL WHEN {x} <= 150 THEN 'budget' "
            f"WHEN {x} <= 400 THEN 'mid_range' WHEN {x} <= 800 THEN 'premium' ELSE 'flagship' END")


def fold_sql(col: str, k: int = 5) -> str:
    return f"CAST(CAST(('0x' || substr(md5(CAST({col} AS VARCHAR)), 1, 8)) AS BIGINT) % {k} AS INTEGER)"


def segmented_cte(kind: str = "part") -> str:
    return catalog_cte(kind) + """,
cuts AS (SELECT quantile_cont(price_eur, CAST(1 AS DOUBLE) / 3) AS c1,
                quantile_cont(price_eur, CAST(2 AS DOUBLE) / 3) AS c2 FROM cat),
seg AS (
  SELECT cat.*, CASE WHEN price_eur IS NULL THEN NULL WHEN price_eur <= c1 THEN 'Entry'
                     WHEN price_eur <= c2 THEN 'Mid-range' ELSE 'Flagship' END AS segment
  FROM cat CROSS JOIN cuts)"""


def value_cte(kind: str = "part", x: str = "spec_score_0_100", y: str = "price_eur") -> str:
    return segmented_cte(kind) + f""",
f AS (SELECT seg.*, {fold_sql('item_id')} AS fold FROM seg),
pf AS (
  SELECT fold,
         CAST(count(CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN 1 END) AS DOUBLE) AS n,
         sum(CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END) AS sx,
         sum(CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({y} AS DOUBLE) END) AS sy,
         sum(CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({x} AS DOUBLE) * CAST({x} AS DOUBLE) END) AS sxx,
         sum(CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({x} AS DOUBLE) * CAST({y} AS DOUBLE) END) AS sxy
  FROM f GROUP BY fold),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(5)),
tr AS (SELECT k, coalesce(sum(n), 0) AS n, coalesce(sum(sx), 0) AS sx, coalesce(sum(sy), 0) AS sy,
              coalesce(sum(sxx), 0) AS sxx, coalesce(sum(sxy), 0) AS sxy
       FROM ks LEFT JOIN pf ON pf.fold <> ks.k GROUP BY k),
coef AS (SELECT k AS cfold, (n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0) AS slope, sx, sy, n FROM tr),
coef2 AS (SELECT cfold, slope, (sy - slope * sx) / nullif(n, 0) AS icpt FROM coef),
pred AS (SELECT f.*, icpt + slope * CAST(f.{x} AS DOUBLE) AS market_pred FROM f LEFT JOIN coef2 ON f.fold = coef2.cfold),
v1 AS (SELECT pred.*, CAST(spec_score_0_100 AS DOUBLE) / nullif(CAST(price_eur AS DOUBLE), 0) AS performance_to_price_ratio FROM pred),
sb AS (SELECT segment AS sb_segment, avg(value_score) AS segment_mean_value_score,
              median(price_eur) AS segment_median_price_eur,
              median(performance_to_price_ratio) AS segment_median_performance_to_price_ratio
       FROM v1 WHERE segment IS NOT NULL GROUP BY segment),
v2 AS (
  SELECT v1.*, segment_mean_value_score, segment_median_price_eur, segment_median_performance_to_price_ratio,
         value_score / nullif(segment_mean_value_score, 0) AS value_score_lift_vs_segment,
         (segment_median_price_eur - price_eur) / nullif(segment_median_price_eur, 0) AS price_discount_vs_segment_median,
         CASE WHEN market_pred < 1 THEN CAST(1 AS DOUBLE) ELSE market_pred END AS expected_market_price_eur
  FROM v1 LEFT JOIN sb ON v1.segment = sb.sb_segment),
v3 AS (SELECT v2.*, expected_market_price_eur - price_eur AS market_price_gap_eur,
              (expected_market_price_eur - price_eur) / nullif(expected_market_price_eur, 0) AS market_price_discount_ratio
       FROM v2),
zs AS (SELECT segment AS zs_segment, avg(market_price_discount_ratio) AS m0, stddev_pop(market_price_discount_ratio) AS s0,
              avg(value_score) AS m1, stddev_pop(value_score) AS s1
       FROM v3 WHERE segment IS NOT NULL GROUP BY segment),
v4 AS (SELECT v3.*, (market_price_discount_ratio - m0) / nullif(s0, 0) AS market_underpricing_z_in_segment,
              (value_score - m1) / nullif(s1, 0) AS value_z_in_segment
       FROM v3 LEFT JOIN zs ON v3.segment = zs.zs_segment),
v5 AS (SELECT v4.*,
         coalesce(market_price_gap_eur > 0 AND market_underpricing_z_in_segment > 1.645
                  AND performance_to_price_ratio >= segment_median_performance_to_price_ratio, false) AS market_underpriced_outlier,
         coalesce(value_z_in_segment > 1.645, false) AS zscore_value_outlier,
         false AS isolation_raw_outlier, false AS isolation_value_outlier
       FROM v4),
vf AS (SELECT v5.*, zscore_value_outlier OR isolation_value_outlier OR market_underpriced_outlier AS is_value_outlier FROM v5)"""


def isolation_cte(kind: str) -> str:
    """vi: the value frame with every third item flagged in place of the isolation forest."""
    return value_cte(kind) + """,
qv AS (SELECT quantile_cont(value_score, 0.75) AS qq FROM vf),
v7 AS (SELECT * EXCLUDE (qq) REPLACE (item_id % 3 = 0 AS isolation_raw_outlier,
              item_id % 3 = 0 AND coalesce(value_score >= qq, false) AS isolation_value_outlier) FROM vf CROSS JOIN qv),
vi AS (SELECT * REPLACE (zscore_value_outlier OR isolation_value_outlier OR market_underpriced_outlier AS is_value_outlier) FROM v7)"""


def scenarios_cte(rows) -> str:
    vals = []
    for r in rows:
        sid, label, budget, seg = r[:4]
        brand = r[4] if len(r) > 4 else None
        top_n = r[5] if len(r) > 5 and r[5] is not None else 10
        q = lambda v: "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
        vals.append(f"({sid}, {q(label)}, CAST({budget} AS DOUBLE), {q(seg)}, {q(brand)}, {top_n})")
    return "sc(scenario, scenario_label, budget_eur, want_segment, want_brand, top_n) AS (VALUES " + ", ".join(vals) + ")"


def reason_sql(ppr="performance_to_price_ratio", value="value_score", spec="spec_score_0_100",
               disc="market_price_discount_ratio", ram="avg_quantity", cam="size") -> str:
    f = lambda c, p: f"coalesce(printf('%.{p}f', CAST({c} AS DOUBLE)), 'nan')"
    note = f"CASE WHEN {disc} IS NULL THEN '' ELSE ', market_discount=' || printf('%.1f', CAST({disc} AS DOUBLE) * 100) || '%' END"
    return (f"'PPR=' || {f(ppr, 3)} || ', value=' || {f(value, 2)} || ', spec=' || {f(spec, 1)} || {note} || "
            f"', RAM=' || {f(ram, 0)} || 'GB, camera=' || {f(cam, 0)} || 'MP'")


RECO_COLS_SQL = ("recommendation_rank, oem, model, brand_group, price_eur, budget_utilization, price_tier, segment, "
                 "spec_score_0_100, value_score, performance_to_price_ratio, market_price_discount_ratio, "
                 "expected_market_price_eur, market_underpriced_outlier, is_value_outlier, avg_quantity, n_lines, "
                 "avg_extendedprice, size, avg_discount, recommendation_reason, item_id")

SORT_SQL = ("performance_to_price_ratio DESC NULLS LAST, value_score DESC NULLS LAST, is_value_outlier DESC NULLS LAST, "
            "spec_score_0_100 DESC NULLS LAST, price_eur ASC NULLS LAST, item_id ASC")


def scenario_topn_sql(kind: str, scenarios, base: str = "vf", with_prefix: str | None = None) -> str:
    prefix = with_prefix if with_prefix is not None else value_cte(kind)
    return f"""WITH {prefix},
{scenarios_cte(scenarios)},
pairs AS (
  SELECT sc.scenario, sc.scenario_label, sc.budget_eur, sc.top_n, b.*,
         row_number() OVER (PARTITION BY sc.scenario ORDER BY {SORT_SQL.replace('item_id', 'b.item_id')}) AS rn
  FROM {base} b JOIN sc ON b.price_eur <= sc.budget_eur
       AND (sc.want_segment IS NULL OR b.segment = sc.want_segment)
       AND (sc.want_brand IS NULL OR b.brand_group = sc.want_brand)),
recs AS (
  SELECT scenario, scenario_label, budget_eur, CAST(rn AS INTEGER) AS recommendation_rank, oem, model, brand_group,
         price_eur, price_eur / budget_eur AS budget_utilization, price_tier, segment, spec_score_0_100, value_score,
         performance_to_price_ratio, market_price_discount_ratio, expected_market_price_eur,
         market_underpriced_outlier, is_value_outlier, avg_quantity, n_lines, avg_extendedprice, size, avg_discount,
         {reason_sql()} AS recommendation_reason, item_id
  FROM pairs WHERE rn <= top_n)"""


def validation_sql(kind: str, scenarios) -> str:
    return scenario_topn_sql(kind, scenarios) + """,
st AS (SELECT scenario, recommendation_rank, price_eur, value_score, performance_to_price_ratio,
              lag(value_score) OVER (PARTITION BY scenario ORDER BY recommendation_rank) AS pv,
              lag(performance_to_price_ratio) OVER (PARTITION BY scenario ORDER BY recommendation_rank) AS pp
       FROM recs),
per AS (SELECT scenario AS p_scenario, count(*) AS row_count, max(price_eur) AS max_price_eur,
               bool_and(CASE WHEN recommendation_rank = 1 THEN true ELSE coalesce(pv >= value_score, false) END) AS vdesc,
               bool_and(CASE WHEN recommendation_rank = 1 THEN true ELSE coalesce(pp >= performance_to_price_ratio, false) END) AS pdesc,
               max(CASE WHEN recommendation_rank = 1 THEN value_score END) AS top_value_score,
               max(CASE WHEN recommendation_rank = 1 THEN performance_to_price_ratio END) AS top_performance_to_price_ratio
        FROM st GROUP BY scenario)
SELECT sc.scenario, sc.scenario_label, sc.budget_eur, coalesce(row_count, 0) AS row_count, max_price_eur,
       coalesce(max_price_eur <= sc.budget_eur, true) AS all_within_budget,
       coalesce(vdesc, true) AS is_value_score_descending,
       coalesce(pdesc, true) AS is_performance_to_price_ratio_descending,
       top_value_score, top_performance_to_price_ratio
FROM sc LEFT JOIN per ON sc.scenario = per.p_scenario"""


# ---------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------
from pricewise.plans.value_plan import ORDER_SCENARIOS, PART_SCENARIOS  # noqa: E402

ORACLE: dict[str, str] = {}

ORACLE["scenario_topn"] = scenario_topn_sql("part", PART_SCENARIOS) + "\nSELECT * FROM recs"
ORACLE["scenario_topn_orders"] = scenario_topn_sql("orders", ORDER_SCENARIOS) + "\nSELECT * FROM recs"
ORACLE["recommendation_validation"] = validation_sql("part", PART_SCENARIOS)
ORACLE["recommendation_validation_orders"] = validation_sql("orders", ORDER_SCENARIOS)


# ---------------------------------------------------------------------------
# Cleaning and profiling
# ---------------------------------------------------------------------------
from pricewise.functions.clean import (  # noqa: E402
    CURRENCY_RULES, MISSING_TOKENS, MOJIBAKE_TAGS, NUMERIC_TEXT, PY_WHITESPACE)

# Test-table schemas (column, is_text), as listed in FIXTURES.md section 8.
SCHEMAS = {
    "region": [("r_regionkey", 0), ("r_name", 1)],
    "nation": [("n_nationkey", 0), ("n_name", 1), ("n_regionkey", 0)],
    "customer": [("c_custkey", 0), ("c_name", 1), ("c_nationkey", 0), ("c_acctbal", 0), ("c_mktsegment", 1)],
    "supplier": [("s_suppkey", 0), ("s_name", 1), ("s_nationkey", 0), ("s_acctbal", 0)],
    "part": [("p_partkey", 0), ("p_name", 1), ("p_brand", 1), ("p_type", 1), ("p_size", 0), ("p_retailprice", 0)],
    "orders": [("o_orderkey", 0), ("o_custkey", 0), ("o_orderstatus", 1), ("o_totalprice", 0), ("o_orderdate", 0),
               ("o_orderpriority", 1)],
    "lineitem": [("l_orderkey", 0), ("l_partkey", 0), ("l_suppkey", 0), ("l_linenumber", 0), ("l_quantity", 0),
                 ("l_extendedprice", 0), ("l_discount", 0), ("l_tax", 0), ("l_returnflag", 1), ("l_linestatus", 1),
                 ("l_shipdate", 0)],
    "events": [("event_id", 0), ("ts", 0), ("user_id", 0), ("event_type", 1), ("value", 0), ("props", 1)],
    "documents": [("doc_id", 0), ("text", 1), ("lang", 1), ("source", 1), ("n_chars", 0)],
    "embeddings": [("vec_id", 0), ("embedding", 0), ("label", 0)],
    "pages": [("page_id", 0), ("url", 1), ("html", 1)],
    "benchmark": [("item_id", 0), ("text", 1)],
    "labels": [("doc_id", 0), ("quality", 0), ("toxic", 0)],
    "conversations": [("conv_id", 0), ("turn", 0), ("role", 1), ("text", 1)],
}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS = PY_WHITESPACE


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, {lit('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def missing_sql(x: str) -> str:
    s = strip_sql(x)
    return f"CASE WHEN {s} IN ({', '.join(lit(t) for t in MISSING_TOKENS)}) THEN NULL ELSE {s} END"


def mojibake_sql(x: str) -> str:
    s = x
    for tag, rep in MOJIBAKE_TAGS:
        s = f"replace({s}, {lit(tag)}, {lit(rep)})"
    return strip_sql(f"regexp_replace({s}, {lit(WS + '+')}, ' ', 'g')")


def parse_price_sql(x: str) -> str:
    s = f"replace({mojibake_sql(x)}, ',', '')"
    parts = []
    for rate, pats in CURRENCY_RULES:
        for p in pats:
            p2 = p.replace(r"(?![\p{L}\p{N}_])", r"(?:[^\p{L}\p{N}_]|$)")
            e = f"regexp_extract({s}, {lit(p2)}, 1, 'i')"
            parts.append(f"CASE WHEN {e} <> '' THEN CAST({e} AS DOUBLE) * CAST({rate!r} AS DOUBLE) END")
    return "coalesce(" + ", ".join(parts) + ")"


def numeric_sql(x: str) -> str:
    s = f"replace({strip_sql(x)}, ',', '')"
    return f"CASE WHEN regexp_matches({s}, {lit(NUMERIC_TEXT)}) THEN TRY_CAST({s} AS DOUBLE) END"


MESSY_CTE = """messy AS (
  SELECT p_partkey AS item_id,
    CASE p_partkey % 8
      WHEN 0 THEN 'About ' || CAST(p_retailprice AS VARCHAR) || ' EUR'
      WHEN 1 THEN '$ ' || CAST(p_retailprice AS VARCHAR)
      WHEN 2 THEN '<c2><a3>' || CAST(p_retailprice AS VARCHAR)
      WHEN 3 THEN '  ' || CAST(p_retailprice AS VARCHAR) || ' inr  '
      WHEN 4 THEN ' - '
      WHEN 5 THEN '<e2><82><ac>1,' || CAST(p_retailprice AS VARCHAR) || ' / ' || CAST(p_retailprice AS VARCHAR) || ' USD'
      WHEN 6 THEN CAST(p_retailprice AS VARCHAR) || 'EURO'
      ELSE 'N/A' END AS misc_price
  FROM part)"""


def normalized_table_sql(t: str) -> str:
    cols = ", ".join(f"{missing_sql(c)} AS {c}" if txt else c for c, txt in SCHEMAS[t])
    return f"SELECT {cols} FROM {t}"


def column_profile_sql(t: str, with_dtype: bool = False) -> str:
    parts = []
    for i, (c, _) in enumerate(SCHEMAS[t]):
        parts.append(f"""SELECT {i} AS pos, '{c}' AS "column", count(*) AS n, count(*) - count(v) AS missing,
  count(DISTINCT v) AS "unique" FROM (SELECT CAST({c} AS VARCHAR) AS v FROM nt)""")
    body = " UNION ALL ".join(parts)
    return f"""WITH nt AS ({normalized_table_sql(t)}), per AS ({body})
SELECT "column", missing, CASE WHEN n > 0 THEN missing / n ELSE CAST(0 AS DOUBLE) END AS missing_ratio, "unique",
  CASE WHEN n - missing > 0 THEN "unique" / (n - missing) ELSE CAST(0 AS DOUBLE) END AS unique_ratio_non_missing
FROM per"""


def long_sql(t: str, cols=None) -> str:
    cols = cols or [c for c, _ in SCHEMAS[t]]
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM nt" for c in cols)


def top_k_sql(t: str, cols=None, k: int = 15) -> str:
    return f"""WITH nt AS ({normalized_table_sql(t)}), lv AS ({long_sql(t, cols)}),
cnt AS (SELECT "column", value, count(*) AS "count" FROM lv WHERE value IS NOT NULL GROUP BY "column", value),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, value ASC) AS INTEGER) AS rank FROM cnt)
SELECT * FROM r WHERE rank <= {k}"""


def numeric_like_sql(t: str) -> str:
    parts = [f"SELECT '{c}' AS \"column\", count(v) AS non_missing, count({numeric_sql('v')}) AS numeric_count "
             f"FROM (SELECT CAST({c} AS VARCHAR) AS v FROM nt)" for c, _ in SCHEMAS[t]]
    return f"""WITH nt AS ({normalized_table_sql(t)}), per AS ({' UNION ALL '.join(parts)})
SELECT "column", non_missing, numeric_count,
  greatest(CAST(50 AS BIGINT), CAST(floor(non_missing * CAST(0.3 AS DOUBLE)) AS BIGINT)) AS threshold,
  numeric_count >= greatest(CAST(50 AS BIGINT), CAST(floor(non_missing * CAST(0.3 AS DOUBLE)) AS BIGINT)) AS is_numeric_like
FROM per"""


def histogram_sql(values_sql: str, bins: int) -> str:
    n = f"CAST({bins} AS DOUBLE)"
    edge = lambda i: f"(CASE WHEN {i} >= {bins} THEN hi ELSE {i} * ((hi - lo) / {n}) + lo END)"
    return f"""WITH vals AS (SELECT x FROM ({values_sql}) WHERE x IS NOT NULL AND NOT isnan(x)),
rng0 AS (SELECT min(x) AS lo0, max(x) AS hi0 FROM vals),
rng AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM rng0),
r0 AS (SELECT x, lo, hi, CAST(floor((x - lo) * ({n} / (hi - lo))) AS INTEGER) AS i0 FROM vals CROSS JOIN rng),
r1 AS (SELECT x, lo, hi, CASE WHEN i0 >= {bins} THEN {bins - 1} ELSE i0 END AS i FROM r0),
r2 AS (SELECT CASE WHEN x < {edge('i')} THEN i - 1 WHEN x >= {edge('(i + 1)')} AND i <> {bins - 1} THEN i + 1 ELSE i END AS bin FROM r1),
cnt AS (SELECT bin, count(*) AS c FROM r2 GROUP BY bin),
grid AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
SELECT grid.bin, {edge('grid.bin')} AS bin_left, {edge('(grid.bin + 1)')} AS bin_right, coalesce(c, 0) AS "count"
FROM grid CROSS JOIN rng LEFT JOIN cnt ON grid.bin = cnt.bin"""


def tier_counts_sql(values_sql: str) -> str:
    return f"""WITH vals AS ({values_sql}),
t AS (SELECT {tier_sql('x')} AS tier FROM vals),
cnt AS (SELECT tier, count(*) AS c FROM t WHERE tier IS NOT NULL GROUP BY tier),
tiers(tier_order, tier) AS (VALUES (0, 'budget'), (1, 'mid_range'), (2, 'premium'), (3, 'flagship'))
SELECT tier_order, tiers.tier, coalesce(c, 0) AS "count" FROM tiers LEFT JOIN cnt ON tiers.tier = cnt.tier"""


def input_summary_sql() -> str:
    parts = []
    for t, cols in SCHEMAS.items():
        nulls = " + ".join(f"count_if({c} IS NULL)" for c, _ in cols)
        ntext = sum(txt for _, txt in cols)
        parts.append(f"SELECT '{t}' AS file, count(*) AS rows, {len(cols)} AS cols, CAST({nulls} AS BIGINT) AS null_total, "
                     f"{ntext} AS object_cols FROM {t}")
    return " UNION ALL ".join(parts)


ORACLE["normalize_missing"] = f"WITH {MESSY_CTE} SELECT item_id, {missing_sql('misc_price')} AS misc_price FROM messy"
ORACLE["normalize_missing_documents"] = (f"SELECT doc_id, {missing_sql('text')} AS text, {missing_sql('lang')} AS lang, "
                                         f"{missing_sql('source')} AS source FROM documents")
ORACLE["clean_mojibake"] = f"WITH {MESSY_CTE} SELECT item_id, {mojibake_sql('misc_price')} AS cleaned FROM messy"
ORACLE["clean_mojibake_documents"] = f"SELECT doc_id, {mojibake_sql('text')} AS cleaned FROM documents"
ORACLE["parse_price_eur"] = f"WITH {MESSY_CTE} SELECT item_id, {parse_price_sql('misc_price')} AS price_eur FROM messy"
ORACLE["parse_price_eur_documents"] = f"SELECT doc_id, {parse_price_sql('text')} AS price_eur FROM documents"
ORACLE["price_tier"] = (f"WITH {MESSY_CTE}, p AS (SELECT item_id, {parse_price_sql('misc_price')} AS price_eur FROM messy) "
                        f"SELECT item_id, price_eur, {tier_sql('price_eur')} AS price_tier FROM p")
ORACLE["to_numeric_lenient"] = ("SELECT c_custkey, " + ", ".join(
    f"{numeric_sql(f'CAST({c} AS VARCHAR)')} AS {c}_num" for c in ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    + " FROM customer")
ORACLE["clip_min"] = ("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_extendedprice * l_discount < 1 "
                      "THEN CAST(1 AS DOUBLE) ELSE l_extendedprice * l_discount END AS discount_amount FROM lineitem")
ORACLE["log_target"] = (f"WITH {catalog_cte('part')} SELECT item_id, ln(1 + price_eur) AS log_price, "
                        "exp(ln(1 + price_eur)) - 1 AS price_back, price_eur AS price_same FROM cat")
ORACLE["ppr_ratio"] = (f"WITH {catalog_cte('orders')} SELECT item_id, CAST(spec_score_0_100 AS DOUBLE) / "
                       "nullif(price_eur, 0) AS performance_to_price_ratio FROM cat")
for _t in ["customer", "part", "events", "documents"]:
    ORACLE[f"column_profile_{_t}"] = column_profile_sql(_t)
ORACLE["profile_extremes"] = (f"SELECT * FROM ({column_profile_sql('events')}) "
                              "WHERE missing_ratio > 0.9 OR unique_ratio_non_missing > 0.9")
ORACLE["duplicate_group_sizes"] = (f"WITH {catalog_cte('part')}, g AS (SELECT oem, model, count(*) AS group_size FROM cat "
                                   "WHERE oem IS NOT NULL AND model IS NOT NULL GROUP BY oem, model) "
                                   "SELECT group_size, count(*) AS number_of_groups FROM g GROUP BY group_size")
ORACLE["duplicate_group_sizes_model"] = (f"WITH {catalog_cte('part')}, g AS (SELECT model, count(*) AS group_size FROM cat "
                                         "WHERE model IS NOT NULL GROUP BY model) "
                                         "SELECT group_size, count(*) AS number_of_groups FROM g GROUP BY group_size")
ORACLE["top_k_values"] = top_k_sql("events")
ORACLE["top_k_values_documents"] = top_k_sql("documents")
ORACLE["top_k_values_part"] = top_k_sql("part")
ORACLE["numeric_like"] = numeric_like_sql("customer")
ORACLE["histogram"] = histogram_sql("SELECT CAST(c_acctbal AS DOUBLE) AS x FROM customer", 30)
ORACLE["histogram_price"] = histogram_sql(f"WITH {MESSY_CTE} SELECT {parse_price_sql('misc_price')} AS x FROM messy", 60)
ORACLE["tier_counts"] = tier_counts_sql(f"WITH {MESSY_CTE} SELECT {parse_price_sql('misc_price')} AS x FROM messy")
ORACLE["tier_counts_documents"] = tier_counts_sql(f"SELECT {parse_price_sql('text')} AS x FROM documents")
ORACLE["input_summary"] = input_summary_sql()
_QS = [i / 100 for i in range(101)]
ORACLE["sorted_index_curve"] = (f"WITH {catalog_cte('orders')}, q AS (SELECT quantile_cont(price_eur, ["
                                + ", ".join(f"CAST({v!r} AS DOUBLE)" for v in _QS) + "]) AS v FROM cat) "
                                "SELECT CAST(i - 1 AS INTEGER) AS point, (i - 1) / CAST(100 AS DOUBLE) AS quantile, v[i] AS value "
                                "FROM q CROSS JOIN range(1, 102) t(i)")
ORACLE["column_profile_report"] = None  # dtype names differ between engines; rows-only check
del ORACLE["column_profile_report"]


# ---------------------------------------------------------------------------
# Price tables, reports, joins, windows, harness
# ---------------------------------------------------------------------------
NUMERIC = ["size", "n_lines", "avg_quantity", "avg_discount", "avg_extendedprice", "item_age"]
NUM_ALL = ["is_premium_brand"] + NUMERIC
VOCAB = {
    "part": (sorted(f"Brand#{i}" for i in range(1, 26)), ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]),
    "orders": (["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], ["F", "O", "P"]),
}


def q(name: str) -> str:
    return '"' + name + '"'


def readable_cte(kind: str) -> str:
    return catalog_cte(kind) + f""",
bm AS (SELECT brand_group AS pb, avg(price_eur) AS bmean FROM cat GROUP BY brand_group),
om AS (SELECT avg(price_eur) AS omean FROM cat),
prem AS (SELECT pb, CASE WHEN bmean > omean THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS is_premium_brand FROM bm CROSS JOIN om),
rd AS (SELECT item_id, price_eur, brand_group, item_type, is_premium_brand, {', '.join(NUMERIC)}
       FROM cat LEFT JOIN prem ON cat.brand_group = prem.pb)"""


def encoded_cte(kind: str) -> str:
    brands, types = VOCAB[kind]
    meds = ", ".join(f"median({c}) AS m_{c}" for c in NUM_ALL)
    imp = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in NUM_ALL)
    st = ", ".join(f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) IS NULL OR stddev_pop({c}) = 0 THEN CAST(1 AS DOUBLE) "
                   f"ELSE stddev_pop({c}) END AS sd_{c}" for c in NUM_ALL)
    nums = ", ".join(f"({c} - mu_{c}) / sd_{c} AS num__{c}" for c in NUM_ALL)
    bcols = ", ".join(f"CASE WHEN brand_group = {lit(b)} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS {q('cat__brand_group_' + b)}"
                      for b in brands)
    tcols = ", ".join(f"CASE WHEN item_type = {lit(t)} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS {q('cat__item_type_' + t)}"
                      for t in types)
    return readable_cte(kind) + f""",
med AS (SELECT {meds} FROM rd),
imp AS (SELECT item_id, price_eur, brand_group, item_type, {imp} FROM rd CROSS JOIN med),
st AS (SELECT {st} FROM imp),
enc AS (SELECT item_id AS row_id, {nums}, {bcols}, {tcols}, CAST(price_eur AS DOUBLE) AS target_price_eur
        FROM imp CROSS JOIN st)"""


def enc_features(kind: str) -> list[str]:
    brands, types = VOCAB[kind]
    return ["num__" + c for c in NUM_ALL] + ["cat__brand_group_" + b for b in brands] + ["cat__item_type_" + t for t in types]


def importance_cte(kind: str = "part") -> str:
    parts = []
    for model, y in [("abs_corr (price_eur)", "target_price_eur"), ("abs_corr (log_price_eur)", "ln(1 + target_price_eur)")]:
        for f in enc_features(kind):
            parts.append(f"SELECT {lit(model)} AS model, {lit(f)} AS feature, coalesce(abs(corr({q(f)}, {y})), CAST(0 AS DOUBLE)) AS importance FROM enc")
    return encoded_cte(kind) + ",\nimpt AS (" + " UNION ALL ".join(parts) + ")"


def harness_cte(kind: str = "part", x: str = "num__avg_quantity") -> str:
    return encoded_cte(kind) + f""",
ef AS (SELECT enc.*, {fold_sql('row_id')} AS fold FROM enc),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(5)),
base AS (SELECT k AS bfold, median(target_price_eur) AS baseline FROM ks JOIN ef ON ef.fold <> ks.k GROUP BY k),
t AS (SELECT row_id, fold, target_price_eur AS y, {q(x)} AS x, target_price_eur AS yt, 'price_eur' AS target_mode FROM ef
      UNION ALL
      SELECT row_id, fold, target_price_eur AS y, {q(x)} AS x, ln(1 + target_price_eur) AS yt, 'log_price_eur' AS target_mode FROM ef),
medt AS (SELECT target_mode AS mm, k AS mfold, median(yt) AS med_t FROM ks JOIN t ON t.fold <> ks.k GROUP BY target_mode, k),
pm AS (SELECT row_id, fold, 'median_baseline' AS model, target_mode, y,
              CASE WHEN target_mode = 'log_price_eur' THEN exp(med_t) - 1 ELSE med_t END AS yhat
       FROM t LEFT JOIN medt ON t.fold = medt.mfold AND t.target_mode = medt.mm),
pf AS (SELECT target_mode AS pmode, fold AS pfold,
              CAST(count(CASE WHEN x IS NOT NULL AND yt IS NOT NULL THEN 1 END) AS DOUBLE) AS n,
              sum(CASE WHEN x IS NOT NULL AND yt IS NOT NULL THEN x END) AS sx,
              sum(CASE WHEN x IS NOT NULL AND yt IS NOT NULL THEN yt END) AS sy,
              sum(CASE WHEN x IS NOT NULL AND yt IS NOT NULL THEN x * x END) AS sxx,
              sum(CASE WHEN x IS NOT NULL AND yt IS NOT NULL THEN x * yt END) AS sxy
       FROM t GROUP BY target_mode, fold),
modes AS (SELECT DISTINCT target_mode AS md FROM t),
tr AS (SELECT md, k, coalesce(sum(n), 0) AS n, coalesce(sum(sx), 0) AS sx, coalesce(sum(sy), 0) AS sy,
              coalesce(sum(sxx), 0) AS sxx, coalesce(sum(sxy), 0) AS sxy
       FROM modes CROSS JOIN ks LEFT JOIN pf ON pf.pmode = modes.md AND pf.pfold <> ks.k GROUP BY md, k),
cf AS (SELECT md, k, (n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0) AS slope, sx, sy, n FROM tr),
cf2 AS (SELECT md, k, slope, (sy - slope * sx) / nullif(n, 0) AS icpt FROM cf),
po AS (SELECT row_id, fold, 'ols_one_feature' AS model, target_mode, y,
              CASE WHEN target_mode = 'log_price_eur' THEN exp(icpt + slope * x) - 1 ELSE icpt + slope * x END AS yhat
       FROM t LEFT JOIN cf2 ON t.target_mode = cf2.md AND t.fold = cf2.k),
preds AS (SELECT u.*, baseline FROM (SELECT * FROM pm UNION ALL SELECT * FROM po) u LEFT JOIN base ON u.fold = base.bfold),
mets AS (
  SELECT target_mode, model, fold, count(*) AS n, avg(abs(y - p)) AS MAE, sqrt(avg(abs(y - p) * abs(y - p))) AS RMSE,
         avg(CASE WHEN abs(y) + abs(p) = 0 THEN CAST(0 AS DOUBLE) ELSE 2 * abs(y - p) / (abs(y) + abs(p)) END) * 100 AS sMAPE,
         CASE WHEN avg(abs(y - baseline)) = 0 THEN NULL ELSE avg(abs(y - p)) / avg(abs(y - baseline)) END AS MASE,
         CASE WHEN var_pop(y) * count(*) = 0 THEN NULL ELSE 1 - sum(abs(y - p) * abs(y - p)) / (var_pop(y) * count(*)) END AS R2
  FROM (SELECT *, CASE WHEN yhat < 1 THEN CAST(1 AS DOUBLE) ELSE yhat END AS p FROM preds) GROUP BY target_mode, model, fold),
cvm AS (SELECT target_mode, model, avg(MAE) AS MAE, avg(RMSE) AS RMSE, avg(sMAPE) AS sMAPE, avg(MASE) AS MASE, avg(R2) AS R2
        FROM mets GROUP BY target_mode, model)"""


SEG_ORDER_SQL = "CASE segment WHEN 'Entry' THEN 0 WHEN 'Mid-range' THEN 1 WHEN 'Flagship' THEN 2 END"
SUMMARY_MEANS = ["spec_score_0_100", "size", "n_lines", "avg_quantity", "avg_discount", "avg_extendedprice", "item_age"]


def segment_summary_sql(kind: str = "part") -> str:
    means = ", ".join(f"avg({c}) AS avg_{c}" for c in SUMMARY_MEANS)
    return (f"WITH {value_cte(kind)} SELECT segment, count(*) AS \"count\", avg(price_eur) AS avg_price_eur, "
            f"median(price_eur) AS median_price_eur, {means} FROM vf WHERE segment IS NOT NULL GROUP BY segment")


def given_clusters_cte() -> str:
    return segmented_cte("part") + f""",
gc AS (SELECT seg.*, {fold_sql('item_id', 3)} AS cluster FROM seg),
co AS (SELECT cluster, avg(price_eur) AS avg_price_eur, avg(spec_score_0_100) AS avg_spec_score_0_100
       FROM gc WHERE cluster IS NOT NULL GROUP BY cluster),
co2 AS (SELECT *, CAST(row_number() OVER (ORDER BY avg_price_eur ASC NULLS LAST, avg_spec_score_0_100 ASC NULLS LAST, cluster) AS INTEGER) AS rank FROM co),
co3 AS (SELECT *, CASE rank WHEN 1 THEN 'Entry' WHEN 2 THEN 'Mid-range' WHEN 3 THEN 'Flagship' END AS segment FROM co2)"""


def method_counts_sql(kind: str) -> str:
    return f"""WITH {isolation_cte(kind)},
c AS (SELECT count_if(zscore_value_outlier) AS c1, count_if(isolation_value_outlier) AS c2, count_if(market_underpriced_outlier) AS c3,
             count_if(zscore_value_outlier AND isolation_value_outlier) AS c4,
             count_if(zscore_value_outlier AND isolation_value_outlier AND market_underpriced_outlier) AS c5,
             count_if(is_value_outlier) AS c6 FROM vi)
SELECT 1 AS method_order, 'Z-score within segment' AS method, c1 AS "count" FROM c
UNION ALL SELECT 2, 'IsolationForest + high value_score', c2 FROM c
UNION ALL SELECT 3, 'Market expected-price underpricing Z-score', c3 FROM c
UNION ALL SELECT 4, 'Intersection', c4 FROM c
UNION ALL SELECT 5, 'Intersection(all three)', c5 FROM c
UNION ALL SELECT 6, 'Union(final)', c6 FROM c"""


def topn_sql(kind: str, budget: float, n: int, seg=None, brand=None) -> str:
    cond = f"price_eur <= CAST({budget!r} AS DOUBLE)"
    if seg:
        cond += f" AND segment = {lit(seg)}"
    if brand:
        cond += f" AND brand_group = {lit(brand)}"
    return f"""WITH {value_cte(kind)},
cand AS (SELECT * FROM vf WHERE {cond}),
top AS (SELECT *, CAST(row_number() OVER (ORDER BY {SORT_SQL}) AS INTEGER) AS rn FROM cand)
SELECT rn AS recommendation_rank, oem, model, brand_group, price_eur, price_eur / CAST({budget!r} AS DOUBLE) AS budget_utilization,
       price_tier, segment, spec_score_0_100, value_score, performance_to_price_ratio, market_price_discount_ratio,
       expected_market_price_eur, market_underpriced_outlier, is_value_outlier, avg_quantity, n_lines,
       avg_extendedprice, size, avg_discount, {reason_sql()} AS recommendation_reason, item_id
FROM top WHERE rn <= {n}"""


O = ORACLE
O["read_table"] = "SELECT * FROM part"
O["brand_summary"] = (f"WITH {readable_cte('part')} SELECT brand_group, count(*) AS \"count\", avg(price_eur) AS avg_price_eur, "
                      "median(price_eur) AS median_price_eur, avg(is_premium_brand) AS avg_is_premium_brand "
                      "FROM rd WHERE brand_group IS NOT NULL GROUP BY brand_group")
O["segment_summary"] = segment_summary_sql("part")
O["rename_relabel"] = (f"SELECT segment AS segment_name, {SEG_ORDER_SQL} AS segment_order, \"count\" AS value "
                       f"FROM ({segment_summary_sql('part')})")
O["cluster_order"] = f"WITH {given_clusters_cte()} SELECT * FROM co3"
O["label_map_join"] = (f"WITH {given_clusters_cte()} SELECT gc.item_id, gc.cluster, co3.segment "
                       "FROM gc LEFT JOIN co3 ON gc.cluster = co3.cluster")
O["outlier_method_counts"] = method_counts_sql("part")
O["outlier_method_counts_orders"] = method_counts_sql("orders")
O["outlier_validation"] = f"""WITH {value_cte('part')} SELECT is_value_outlier, count(*) AS "count", avg(price_eur) AS avg_price_eur,
  avg(value_score) AS avg_value_score, avg(performance_to_price_ratio) AS avg_performance_to_price_ratio,
  avg(value_score_lift_vs_segment) AS avg_value_lift_vs_segment,
  avg(price_discount_vs_segment_median) AS avg_price_discount_vs_segment_median,
  avg(expected_market_price_eur) AS avg_expected_market_price_eur, avg(market_price_gap_eur) AS avg_market_price_gap_eur,
  avg(market_price_discount_ratio) AS avg_market_price_discount_ratio FROM vf GROUP BY is_value_outlier"""
O["outlier_by_segment"] = (f"WITH {value_cte('orders')} SELECT segment, count_if(is_value_outlier) AS \"sum\", count(*) AS \"count\", "
                           "count_if(is_value_outlier) / count(*) AS outlier_ratio FROM vf WHERE segment IS NOT NULL GROUP BY segment")
O["recommendation_lift"] = (scenario_topn_sql("part", PART_SCENARIOS) + """,
per AS (SELECT scenario, scenario_label, avg(value_score) AS recommendation_mean_value_score,
               avg(performance_to_price_ratio) AS recommendation_mean_performance_to_price_ratio FROM recs GROUP BY scenario, scenario_label),
ov AS (SELECT avg(value_score) AS overall_mean_value_score,
              avg(spec_score_0_100 / nullif(price_eur, 0)) AS overall_mean_performance_to_price_ratio FROM cat)
SELECT per.*, ov.*, recommendation_mean_value_score / nullif(overall_mean_value_score, 0) AS lift_vs_overall,
       recommendation_mean_performance_to_price_ratio / nullif(overall_mean_performance_to_price_ratio, 0) AS ppr_lift_vs_overall
FROM per CROSS JOIN ov""")
O["numeric_reference"] = f"WITH {readable_cte('part')} " + " UNION ALL ".join(
    f"SELECT {lit(c)} AS raw_feature, {lit('num__' + c)} AS model_feature, avg(CAST({c} AS DOUBLE)) AS mean, "
    f"CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) IS NULL OR stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN CAST(1 AS DOUBLE) "
    f"ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS std, median(CAST({c} AS DOUBLE)) AS median FROM rd" for c in NUM_ALL)
O["distinct_brands"] = f"WITH {catalog_cte('part')} SELECT DISTINCT brand_group FROM cat WHERE brand_group IS NOT NULL"
O["feature_medians"] = (f"WITH {readable_cte('orders')} SELECT " +
                        ", ".join(f"CAST(median({c}) AS DOUBLE) AS {c}" for c in NUM_ALL) + " FROM rd")
O["feature_importance_correlation"] = f"WITH {importance_cte()} SELECT * FROM impt"
O["union_all"] = O["feature_importance_correlation"]
O["topn_features_per_model"] = (f"WITH {importance_cte()}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY model "
                                "ORDER BY importance DESC NULLS LAST, feature) AS INTEGER) AS rank FROM impt) SELECT * FROM r WHERE rank <= 15")
O["consensus_factors"] = (f"WITH {importance_cte()}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY model "
                          "ORDER BY importance DESC NULLS LAST, feature) AS INTEGER) AS rank FROM impt), top AS (SELECT * FROM r WHERE rank <= 15) "
                          "SELECT feature, avg(rank) AS avg_rank, count(DISTINCT model) AS model_count FROM top GROUP BY feature "
                          "HAVING count(DISTINCT model) >= 2")
O["brand_importance_share"] = (f"WITH {importance_cte()} SELECT model, coalesce(sum(CASE WHEN starts_with(feature, 'cat__brand_group_') "
                               "THEN importance END), 0) AS brand_importance_sum, sum(importance) AS total_importance, "
                               "CASE WHEN sum(importance) = 0 THEN NULL ELSE coalesce(sum(CASE WHEN starts_with(feature, 'cat__brand_group_') "
                               "THEN importance END), 0) / sum(importance) END AS brand_importance_ratio FROM impt GROUP BY model")
O["top_price_drivers"] = (f"WITH {importance_cte()}, tot AS (SELECT model AS tm, sum(importance) AS t FROM impt GROUP BY model), "
                          "nrm AS (SELECT impt.*, importance / nullif(t, 0) AS share FROM impt LEFT JOIN tot ON impt.model = tot.tm), "
                          "top AS (SELECT * FROM nrm ORDER BY share DESC NULLS LAST, model, feature LIMIT 20) "
                          "SELECT *, CASE WHEN starts_with(feature, 'cat__brand_group_') THEN 'brand' ELSE 'hardware_or_spec' END AS driver_type FROM top")
O["prefix_flag"] = (f"WITH {importance_cte()} SELECT model, feature, CASE WHEN starts_with(feature, 'cat__brand_group_') "
                    "THEN 'brand' ELSE 'hardware_or_spec' END AS driver_type FROM impt")
O["kfold_assign"] = f"SELECT o_orderkey AS item_id, {fold_sql('o_orderkey')} AS fold FROM orders"
O["holdout_split"] = (f"SELECT o_orderkey AS item_id, CAST(o_totalprice AS DOUBLE) AS price_eur, CASE WHEN {fold_sql('o_orderkey')} = 0 "
                      "THEN 'test' ELSE 'train' END AS split FROM orders")
O["baseline_median"] = f"WITH {harness_cte()} SELECT bfold AS k, baseline FROM base"
O["oof_predict_ols"] = f"WITH {harness_cte()} SELECT * FROM preds"
O["regression_metrics"] = f"WITH {harness_cte()} SELECT * FROM mets"
O["cv_mean_metrics"] = f"WITH {harness_cte()} SELECT * FROM cvm"
O["model_leaderboard"] = f"WITH {harness_cte()} SELECT * FROM cvm ORDER BY MAE, RMSE, model, target_mode LIMIT 1"
O["leakage_guard"] = ("SELECT * FROM (VALUES ('price_tier', true), ('value_score', true), ('spec_score_0_100', true), "
                      "('price_per_ram_gb', false), ('price_per_storage_gb', false), ('battery_per_eur', false), ('oem', true), "
                      "('model', true)) t(\"column\", present_in_price_model)")
O["load_price_features"] = (f"WITH {encoded_cte('part')} SELECT row_id, " + ", ".join(q(f) for f in enc_features("part"))
                            + ", target_price_eur AS label FROM enc")
O["drop_target"] = O["load_price_features"]
O["budget_filter"] = (f"WITH {segmented_cte('part')} SELECT * FROM seg WHERE price_eur <= 950 AND segment = 'Mid-range' "
                      "AND brand_group = 'Brand#7'")
O["non_null_key_filter"] = (f"WITH {catalog_cte('orders')} SELECT item_id, brand_group FROM cat WHERE brand_group IS NOT NULL "
                            "AND spec_score_0_100 IS NOT NULL")
O["outlier_predicates"] = (f"WITH {isolation_cte('orders')} SELECT item_id, segment, market_underpriced_outlier, zscore_value_outlier, "
                           "isolation_value_outlier, is_value_outlier FROM vi")
O["flag_union"] = f"WITH {isolation_cte('orders')} SELECT item_id, is_value_outlier AS flag_union FROM vi"
O["flag_intersection"] = (f"WITH {isolation_cte('orders')} SELECT item_id, zscore_value_outlier AND isolation_value_outlier "
                          "AS flag_intersection FROM vi")
O["segment_baselines"] = (f"""WITH {segmented_cte('orders')},
sb AS (SELECT segment AS s, avg(value_score) AS segment_mean_value_score, median(price_eur) AS segment_median_price_eur,
              median(spec_score_0_100 / nullif(price_eur, 0)) AS segment_median_performance_to_price_ratio
       FROM seg WHERE segment IS NOT NULL GROUP BY segment)
SELECT item_id, segment, segment_mean_value_score, segment_median_price_eur, segment_median_performance_to_price_ratio
FROM seg LEFT JOIN sb ON seg.segment = sb.s""")
O["segment_lifts"] = (f"""WITH {segmented_cte('orders')},
sb AS (SELECT segment AS s, avg(value_score) AS m, median(price_eur) AS mp FROM seg WHERE segment IS NOT NULL GROUP BY segment)
SELECT item_id, value_score / nullif(m, 0) AS value_score_lift_vs_segment, (mp - price_eur) / nullif(mp, 0) AS price_discount_vs_segment_median
FROM seg LEFT JOIN sb ON seg.segment = sb.s""")
O["segment_zscore"] = (f"""WITH {segmented_cte('orders')},
z AS (SELECT segment AS s, avg(value_score) AS m0, stddev_pop(value_score) AS s0, avg(avg_discount) AS m1, stddev_pop(avg_discount) AS s1
      FROM seg WHERE segment IS NOT NULL GROUP BY segment)
SELECT item_id, (value_score - m0) / nullif(s0, 0) AS value_z_in_segment, (avg_discount - m1) / nullif(s1, 0) AS discount_z_in_segment
FROM seg LEFT JOIN z ON seg.segment = z.s""")
O["topn_brands_per_segment"] = (f"""WITH {segmented_cte('part')},
c AS (SELECT segment, brand_group, count(*) AS "count" FROM seg WHERE segment IS NOT NULL AND brand_group IS NOT NULL GROUP BY segment, brand_group),
r AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY "count" DESC, brand_group ASC) AS rk FROM c)
SELECT segment, brand_group, "count" FROM r WHERE rk <= 3""")
O["market_price_features"] = (f"WITH {value_cte('part')} SELECT item_id, expected_market_price_eur, market_price_gap_eur, "
                              "market_price_discount_ratio FROM vf")
O["high_value_filter"] = (f"WITH {catalog_cte('orders')}, qv AS (SELECT quantile_cont(value_score, 0.75) AS qq FROM cat) "
                          "SELECT item_id, coalesce(value_score >= qq, false) AS high_value FROM cat CROSS JOIN qv")
O["value_outliers"] = f"WITH {value_cte('part')} SELECT * EXCLUDE (fold, market_pred) FROM vf"
O["rank_value_outliers"] = (f"WITH {value_cte('orders')} SELECT item_id, performance_to_price_ratio, market_price_discount_ratio, "
                            "value_score FROM vf WHERE is_value_outlier")
O["recommend_topn"] = topn_sql("part", 960.0, 10)
O["recommendation_rank"] = (f"SELECT recommendation_rank, item_id FROM ({topn_sql('orders', 200000.0, 10, 'Mid-range', '3-MEDIUM')})")
O["outlier_flag_join"] = f"WITH {value_cte('orders')} SELECT item_id, price_eur, is_value_outlier FROM vf"
O["recommend_for_user"] = scenario_topn_sql("part", PART_SCENARIOS) + "\nSELECT * FROM recs"
O["scenario_join"] = (f"WITH {segmented_cte('orders')}, {scenarios_cte(ORDER_SCENARIOS)} SELECT scenario, count(*) AS candidates, "
                      "min(price_eur) AS min_price, max(price_eur) AS max_price FROM seg JOIN sc ON price_eur <= budget_eur "
                      "AND (want_segment IS NULL OR segment = want_segment) AND (want_brand IS NULL OR brand_group = want_brand) "
                      "GROUP BY scenario")
O["scenario_topn_many"] = f"""WITH {value_cte('orders')},
rq AS (SELECT CAST(c_custkey AS INTEGER) AS scenario, abs(c_acctbal) * 40 + 1000 AS budget,
              CASE WHEN c_custkey % 3 = 0 THEN ['Entry', 'Mid-range', 'Flagship'][c_nationkey % 3 + 1] END AS want_segment,
              CASE WHEN c_custkey % 5 = 0 THEN '3-MEDIUM' END AS want_brand, CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 10 END AS top_n FROM customer),
rk AS (SELECT scenario, top_n, item_id, row_number() OVER (PARTITION BY scenario ORDER BY performance_to_price_ratio DESC NULLS LAST,
              value_score DESC NULLS LAST, is_value_outlier DESC NULLS LAST, spec_score_0_100 DESC NULLS LAST, price_eur ASC NULLS LAST, item_id) AS recommendation_rank
       FROM vf JOIN rq ON price_eur <= budget AND (want_segment IS NULL OR segment = want_segment) AND (want_brand IS NULL OR brand_group = want_brand))
SELECT scenario, CAST(recommendation_rank AS INTEGER) AS recommendation_rank, item_id FROM rk WHERE recommendation_rank <= top_n"""
O["anchor_cross_join"] = (f"WITH {catalog_cte('orders')}, ov AS (SELECT avg(value_score) AS m FROM cat) "
                          "SELECT item_id, value_score / nullif(m, 0) AS value_vs_overall FROM cat CROSS JOIN ov")
O["group_stat_join"] = (f"WITH {catalog_cte('orders')}, z AS (SELECT brand_group AS b, avg(price_eur) AS m, stddev_pop(price_eur) AS s "
                        "FROM cat WHERE brand_group IS NOT NULL GROUP BY brand_group) "
                        "SELECT item_id, (price_eur - m) / nullif(s, 0) AS price_z_in_brand FROM cat LEFT JOIN z ON cat.brand_group = z.b")
O["sorted_index_positions"] = (f"WITH {catalog_cte('orders')} SELECT row_number() OVER (ORDER BY price_eur, item_id) - 1 AS position, "
                               "price_eur AS value FROM cat WHERE price_eur IS NOT NULL AND NOT isnan(price_eur)")
O["positional_align_by_place"] = (f"WITH {catalog_cte('orders')}, "
                                  "a AS (SELECT item_id AS by_price, price_eur, row_number() OVER (ORDER BY price_eur NULLS FIRST, item_id) - 1 AS position FROM cat), "
                                  "b AS (SELECT item_id AS by_spec, spec_score_0_100, row_number() OVER (ORDER BY spec_score_0_100 NULLS FIRST, item_id) - 1 AS position FROM cat) "
                                  "SELECT a.*, b.by_spec, b.spec_score_0_100 FROM a JOIN b USING (position)")
O["contiguous_folds"] = (f"WITH {catalog_cte('orders')} SELECT item_id, CAST(ntile(5) OVER (ORDER BY item_id) - 1 AS INTEGER) AS fold FROM cat")


def gram_vectors_cte() -> str:
    """vec: [1, features, price, log price] and fold of each encoded row; el: its elements."""
    feats = ", ".join(q(f) for f in enc_features("part"))
    return encoded_cte("part") + f""",
vec AS (SELECT row_id, target_price_eur, {fold_sql('row_id')} AS fold,
               [CAST(1 AS DOUBLE), {feats}, target_price_eur, ln(1 + target_price_eur)] AS v FROM enc),
el AS (SELECT row_id, fold, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM vec)"""


O["fold_gram"] = (f"WITH {gram_vectors_cte()} SELECT a.fold, CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, sum(a.x * b.x) AS total "
                  "FROM el a JOIN el b ON a.row_id = b.row_id AND a.i <= b.i GROUP BY a.fold, a.i, b.i")


def linear_fit_sql(alpha: float) -> str:
    """Holdout predictions (fold 0) of the log price: Gauss-Jordan elimination on the
    centred sums of the other folds; a pivot that is nothing but rounding is passed over."""
    p = len(enc_features("part"))
    return f"""WITH RECURSIVE {gram_vectors_cte()},
tr AS (SELECT * FROM el WHERE fold <> 0 AND i BETWEEN 1 AND {p} OR fold <> 0 AND i = {p + 2}),
mu AS (SELECT i, avg(x) AS m FROM tr GROUP BY i),
ce AS (SELECT row_id, CASE WHEN i = {p + 2} THEN {p + 1} ELSE i END AS i, x - m AS x FROM tr JOIN mu USING (i)),
pr AS (SELECT a.i, b.i AS j, sum(a.x * b.x) + CASE WHEN a.i = b.i THEN CAST({alpha!r} AS DOUBLE) ELSE 0 END AS s
       FROM ce a JOIN ce b ON a.row_id = b.row_id WHERE a.i <= {p} GROUP BY a.i, b.i),
m0 AS (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(s ORDER BY j) AS r FROM pr GROUP BY i)),
ge AS (
  SELECT 0 AS k, m, list_transform(range(1, {p + 1}), lambda i: m[i][i]) AS d FROM m0
  UNION ALL
  SELECT k + 1,
    CASE WHEN m[k + 1][k + 1] > 1e-9 * d[k + 1] THEN
      list_transform(range(1, {p + 1}), lambda i: CASE WHEN i = k + 1 THEN list_transform(m[i], lambda y: y / m[k + 1][k + 1])
        ELSE list_transform(range(1, {p + 2}), lambda j: m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END)
    ELSE m END, d
  FROM ge WHERE k < {p}),
w AS (SELECT list_transform(range(1, {p + 1}), lambda i: CASE WHEN m[i][i] > 0.5 THEN m[i][{p + 1}] ELSE 0 END) AS w FROM ge WHERE k = {p}),
ml AS (SELECT list(m ORDER BY i) FILTER (WHERE i <= {p}) AS mx, any_value(m) FILTER (WHERE i = {p + 2}) AS my FROM mu)
SELECT row_id, target_price_eur, exp(my + list_inner_product(w, list_transform(range(1, {p + 1}), lambda i: v[i + 1] - mx[i]))) - 1 AS yhat
FROM vec, w, ml WHERE fold = 0"""


O["fit_linear"] = linear_fit_sql(0.0)
O["fit_ridge"] = linear_fit_sql(1.0)
O["positional_align"] = (f"WITH {encoded_cte('part')} SELECT rd.item_id AS row_id, rd.brand_group, enc.target_price_eur "
                         "FROM rd JOIN enc ON rd.item_id = enc.row_id")
O["median_impute"] = (f"WITH {readable_cte('orders')}, m AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in NUMERIC)
                      + " FROM rd) SELECT item_id, " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in NUMERIC)
                      + " FROM rd CROSS JOIN m")
O["standardize"] = (f"WITH {readable_cte('orders')}, s AS (SELECT " + ", ".join(
    f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) IS NULL OR stddev_pop({c}) = 0 THEN CAST(1 AS DOUBLE) ELSE stddev_pop({c}) END AS sd_{c}"
    for c in NUMERIC) + " FROM rd) SELECT item_id, " + ", ".join(f"({c} - mu_{c}) / sd_{c} AS z_{c}" for c in NUMERIC)
    + " FROM rd CROSS JOIN s")
_OH = [b for b in VOCAB["part"][0] if b != "Brand#9"]
O["one_hot"] = (f"WITH {catalog_cte('part')} SELECT item_id, " + ", ".join(
    f"CASE WHEN brand_group = {lit(b)} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS {q('cat__brand_group_' + b)}" for b in _OH)
    + ", CASE WHEN brand_group IS NOT NULL AND brand_group NOT IN (" + ", ".join(lit(b) for b in _OH + ['Other'])
    + ") OR brand_group = 'Other' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS \"cat__brand_group_Other\" FROM cat")


# ---------------------------------------------------------------------------
# Guide pieces, clustering given clusters, blend arithmetic
# ---------------------------------------------------------------------------

def guide_requests_cte() -> str:
    def per(kind, tag):
        return f"""SELECT request_id * 10 + {tag} AS request_id, brand_group AS brand,
  CASE WHEN request_id % 3 = 0 THEN NULL ELSE budget END AS budget_price_eur,
  CASE WHEN request_id % 2 = 0 THEN NULL ELSE size END AS size, avg_quantity,
  CAST(floor(size / 10) AS DOUBLE) AS network_generation, CAST(w AS DOUBLE) AS resolution_width_px,
  CAST(h AS DOUBLE) AS resolution_height_px, CAST(2026 AS DOUBLE) - age AS launch_year
FROM (SELECT brand_group, min(item_id) AS request_id, max(price_eur) AS budget, avg(size) AS size,
             avg(avg_quantity) AS avg_quantity, min(size) AS w, max(size) AS h, max(item_age) AS age
      FROM {kind}_cat GROUP BY brand_group)"""
    pc = catalog_cte("part").replace("li AS", "pli AS").replace("cat0 AS", "pcat0 AS").replace("cat AS (", "part_cat AS (")
    pc = pc.replace("JOIN li ON", "JOIN pli ON").replace("FROM cat0)", "FROM pcat0)")
    oc = catalog_cte("orders").replace("li AS", "oli AS").replace("cat0 AS", "ocat0 AS").replace("cat AS (", "orders_cat AS (")
    oc = oc.replace("JOIN li ON", "JOIN oli ON").replace("FROM cat0)", "FROM ocat0)").replace("FROM li)", "FROM oli)")
    return pc + "," + oc + f",\nreq AS ({per('part', 0)} UNION ALL {per('orders', 1)})"


def fmt1(x: str) -> str:
    return f"coalesce(printf('%.1f', CAST({x} AS DOUBLE)), 'nan')"


O["price_guidance_label"] = (f"WITH {value_cte('orders')} SELECT item_id, price_eur - expected_market_price_eur AS price_gap_eur, "
                             "CASE WHEN price_eur - expected_market_price_eur IS NULL THEN 'no_planned_price_to_compare' "
                             "WHEN abs(price_eur - expected_market_price_eur) <= greatest(CAST(30 AS DOUBLE), expected_market_price_eur * CAST(0.08 AS DOUBLE)) "
                             "THEN 'planned_price_is_near_model_guideline' WHEN price_eur - expected_market_price_eur > 0 "
                             "THEN 'planned_price_is_above_model_guideline' ELSE 'planned_price_is_below_model_guideline' END AS guidance FROM vf")
O["adjusted_brand_summary"] = f"""WITH {value_cte('part')},
a AS (SELECT brand_group, price_eur AS actual_price_eur, expected_market_price_eur AS spec_only_pred_price_eur,
             price_eur - expected_market_price_eur AS r FROM vf WHERE brand_group IS NOT NULL)
SELECT brand_group, count(*) AS "count", avg(actual_price_eur) AS avg_actual_price_eur,
       avg(spec_only_pred_price_eur) AS avg_spec_only_pred_price_eur, avg(r) AS avg_adjusted_brand_premium_eur,
       median(r) AS median_adjusted_brand_premium_eur,
       avg(r) / nullif(avg(spec_only_pred_price_eur), 0) AS premium_ratio_vs_pred
FROM a GROUP BY brand_group"""
_gr = guide_requests_cte()
_rd_frag = readable_cte("part")[len(catalog_cte("part")):]
O["brand_note"] = f"""WITH {_gr}, {value_cte('part').lstrip()}{_rd_frag},
bs AS (SELECT brand_group AS b1, avg(price_eur) AS bp, count(*) AS bc FROM rd WHERE brand_group IS NOT NULL GROUP BY brand_group),
ad AS (SELECT brand_group AS b2, avg(price_eur - expected_market_price_eur) AS ba FROM vf WHERE brand_group IS NOT NULL GROUP BY brand_group)
SELECT request_id, brand,
  CASE WHEN brand IS NULL OR brand = '' THEN 'no brand specified'
       WHEN bc IS NULL AND ba IS NULL THEN 'brand premium row unavailable'
       ELSE concat_ws('; ', CASE WHEN bc IS NOT NULL THEN 'avg_price=' || {fmt1('bp')} || ' EUR, count=' || CAST(bc AS VARCHAR) END,
                            CASE WHEN ba IS NOT NULL THEN 'adjusted_premium=' || {fmt1('ba')} || ' EUR' END) END AS brand_premium_note
FROM req LEFT JOIN bs ON req.brand = bs.b1 LEFT JOIN ad ON req.brand = ad.b2"""
O["unit_flags"] = f"""WITH {_gr}
SELECT request_id,
  CASE WHEN network_generation IS NOT NULL THEN CASE WHEN network_generation >= 5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS has_5g,
  CASE WHEN network_generation IS NOT NULL THEN CASE WHEN network_generation >= 4 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS has_4g_or_more,
  resolution_width_px * resolution_height_px AS resolution_total_px,
  CASE WHEN resolution_width_px IS NOT NULL AND resolution_width_px <> 0 AND resolution_height_px IS NOT NULL
       THEN resolution_height_px / resolution_width_px END AS aspect_ratio,
  CASE WHEN launch_year IS NOT NULL THEN CASE WHEN CAST(2026 AS DOUBLE) - launch_year < 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST(2026 AS DOUBLE) - launch_year END END AS phone_age
FROM req"""
O["default_feature_row"] = f"""WITH {_gr}, m AS (SELECT median(size) AS ms, median(avg_quantity) AS mq FROM part_cat)
SELECT request_id, coalesce(size, ms) AS size, coalesce(avg_quantity, mq) AS avg_quantity FROM req CROSS JOIN m"""
O["reference_lookup"] = f"""WITH {_gr}, {readable_cte('part').lstrip()},
bs AS (SELECT brand_group AS b, avg(is_premium_brand) AS avg_is_premium_brand FROM rd WHERE brand_group IS NOT NULL GROUP BY brand_group),
ref AS (SELECT avg(CAST(size AS DOUBLE)) AS mean, CASE WHEN stddev_pop(CAST(size AS DOUBLE)) IS NULL OR stddev_pop(CAST(size AS DOUBLE)) = 0
               THEN CAST(1 AS DOUBLE) ELSE stddev_pop(CAST(size AS DOUBLE)) END AS std FROM rd)
SELECT request_id, brand, avg_is_premium_brand AS is_premium_brand, (size - mean) / std AS num__size
FROM req LEFT JOIN bs ON req.brand = bs.b CROSS JOIN ref"""
O["phone_key"] = f"WITH {catalog_cte('part')} SELECT item_id, oem || '||' || model AS phone_key FROM cat"

_DB = ["price_eur", "spec_score_0_100", "avg_quantity"]


def given_cluster_features_cte() -> str:
    meds = ", ".join(f"median({c}) AS m_{c}" for c in _DB)
    imp = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in _DB)
    st = ", ".join(f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) IS NULL OR stddev_pop({c}) = 0 THEN CAST(1 AS DOUBLE) "
                   f"ELSE stddev_pop({c}) END AS sd_{c}" for c in _DB)
    zs = ", ".join(f"({c} - mu_{c}) / sd_{c} AS z_{c}" for c in _DB)
    return catalog_cte("part") + f""",
g0 AS (SELECT item_id, {fold_sql('item_id', 3)} AS cluster, {', '.join(_DB)} FROM cat),
gm AS (SELECT {meds} FROM g0),
gi AS (SELECT item_id, cluster, {imp} FROM g0 CROSS JOIN gm),
gs AS (SELECT {st} FROM gi),
gz AS (SELECT item_id, cluster, {zs} FROM gi CROSS JOIN gs),
cents AS (SELECT cluster AS c, {', '.join(f'avg(z_{c}) AS c_{c}' for c in _DB)} FROM gz WHERE cluster IS NOT NULL GROUP BY cluster)"""


_dist = " + ".join(f"(z_{c} - c_{c}) * (z_{c} - c_{c})" for c in _DB)
_cdist = " + ".join(f"(a.c_{c} - b.c_{c}) * (a.c_{c} - b.c_{c})" for c in _DB)
O["davies_bouldin"] = f"""WITH {given_cluster_features_cte()},
sc AS (SELECT cluster AS c2, avg(sqrt({_dist})) AS s FROM gz JOIN cents ON gz.cluster = cents.c GROUP BY cluster),
ci AS (SELECT cents.*, s FROM cents JOIN sc ON cents.c = sc.c2),
pr AS (SELECT a.c AS i, (a.s + b.s) / nullif(sqrt({_cdist}), 0) AS r FROM ci a CROSS JOIN ci b WHERE a.c <> b.c),
mx AS (SELECT i, max(r) AS m FROM pr GROUP BY i)
SELECT avg(m) AS davies_bouldin FROM mx"""
O["assign_nearest"] = f"""WITH {given_cluster_features_cte()},
d AS (SELECT item_id, c, {_dist} AS d2 FROM gz CROSS JOIN cents),
r AS (SELECT item_id, c, row_number() OVER (PARTITION BY item_id ORDER BY d2, c) AS rn FROM d)
SELECT item_id, CAST(c AS INTEGER) AS cluster FROM r WHERE rn = 1"""
O["weighted_blend"] = f"""WITH {harness_cte()},
pp AS (SELECT * FROM preds WHERE target_mode = 'price_eur'),
mae AS (SELECT model AS wm, avg(abs(y - yhat)) AS cv_mae FROM pp GROUP BY model),
raw AS (SELECT wm, CAST(1 AS DOUBLE) / greatest(cv_mae, CAST(1e-6 AS DOUBLE)) AS w FROM mae),
tot AS (SELECT sum(w) AS t, count(*) AS n_models FROM raw),
wt AS (SELECT wm, w / t AS weight FROM raw CROSS JOIN tot)
SELECT row_id, sum(weight * yhat) AS yhat, n_models FROM pp JOIN wt ON pp.model = wt.wm CROSS JOIN tot GROUP BY row_id, n_models"""


# ---------------------------------------------------------------------------
# Inventory aliases and run summaries
# ---------------------------------------------------------------------------
O["load_model"] = None
del O["load_model"]  # model round trip: rows-only check
O["inverse_log_target"] = O["log_target"]
O["column_profile"] = O["column_profile_part"]
O["select_features"] = (f"WITH {encoded_cte('part')} SELECT row_id, " + ", ".join(q('num__' + c) for c in NUM_ALL)
                        + " FROM enc")
O["format_reason"] = f"WITH {value_cte('orders')} SELECT item_id, {reason_sql()} AS recommendation_reason FROM vf"
_SPARK_TYPE = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
               "WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp' ELSE lower(typeof({c})) END")
O["column_profile_report"] = (f"WITH prof AS ({column_profile_sql('part')}), types AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS tc, (SELECT {_SPARK_TYPE.format(c=c)} FROM part LIMIT 1) AS dtype" for c, _ in SCHEMAS["part"])
    + ") SELECT prof.*, dtype FROM prof LEFT JOIN types ON prof.\"column\" = types.tc")


O["modeling_summary"] = f"""WITH
best AS (WITH {harness_cte()} SELECT * FROM cvm ORDER BY MAE, RMSE, model, target_mode LIMIT 1),
drv AS (WITH {importance_cte()},
        tot AS (SELECT model AS tm, sum(importance) AS t FROM impt GROUP BY model),
        nrm AS (SELECT impt.*, importance / nullif(t, 0) AS share FROM impt LEFT JOIN tot ON impt.model = tot.tm),
        top5 AS (SELECT feature, row_number() OVER (ORDER BY share DESC NULLS LAST, model, feature) AS r FROM nrm)
        SELECT string_agg(feature, ', ' ORDER BY r) AS f FROM top5 WHERE r <= 5),
vfx AS (WITH {value_cte('part')} SELECT segment, is_value_outlier FROM vf),
segs AS (SELECT string_agg(segment, ', ' ORDER BY segment) AS s FROM (SELECT DISTINCT segment FROM vfx WHERE segment IS NOT NULL)),
nout AS (SELECT CAST(count_if(is_value_outlier) AS VARCHAR) AS o FROM vfx)
SELECT 1 AS pos, 'best_regression_model' AS item, model || ' (' || target_mode || ')' AS value FROM best
UNION ALL SELECT 2, 'holdout_mae_eur', printf('%.2f', MAE) FROM best
UNION ALL SELECT 3, 'holdout_r2', printf('%.4f', R2) FROM best
UNION ALL SELECT 4, 'top_price_features', f FROM drv
UNION ALL SELECT 5, 'market_segments', s FROM segs
UNION ALL SELECT 6, 'value_outlier_count', o FROM nout"""

def _rule(i: int, name: str, ok: str, evidence: str) -> str:
    return f"SELECT {i} AS pos, '{name}' AS \"check\", CASE WHEN coalesce({ok}, false) THEN 'PASS' ELSE 'FAIL' END AS status, {evidence} AS evidence FROM r"


def _num(x: str, places: int) -> str:
    return f"coalesce(printf('%.{places}f', {x}), 'nan')"


O["quality_checks"] = f"""WITH
val AS ({validation_sql('part', PART_SCENARIOS)}),
metx AS (WITH {harness_cte()} SELECT * FROM mets),
cvmx AS (WITH {harness_cte()} SELECT * FROM cvm),
vfx AS (WITH {value_cte('part')} SELECT * FROM vf),
v AS (SELECT bool_and(all_within_budget) AS budget_ok, bool_and(is_performance_to_price_ratio_descending) AS ppr_ok, sum(row_count) AS nrows FROM val),
m AS (SELECT min(MASE) AS mase FROM cvmx),
k AS (SELECT count(DISTINCT fold) AS folds, count(*) AS fold_rows FROM metx),
fl AS (SELECT count(*) AS n, count(DISTINCT segment) AS nseg,
              avg(CASE WHEN is_value_outlier THEN price_eur END) AS price_out, avg(CASE WHEN NOT is_value_outlier THEN price_eur END) AS price_in,
              avg(CASE WHEN is_value_outlier THEN performance_to_price_ratio END) AS ppr_out,
              avg(CASE WHEN NOT is_value_outlier THEN performance_to_price_ratio END) AS ppr_in,
              avg(CASE WHEN is_value_outlier THEN market_price_gap_eur END) AS gap_out,
              avg(CASE WHEN is_value_outlier THEN market_price_discount_ratio END) AS share_out FROM vfx),
r AS (SELECT * FROM v CROSS JOIN m CROSS JOIN k CROSS JOIN fl)
""" + "\nUNION ALL ".join([
    _rule(1, "input_rows_read", "n > 0", "'rows=' || n"),
    _rule(2, "regression_model_beats_median_baseline", "mase < 1 - 1e-9", f"'MASE=' || {_num('mase', 3)}"),
    _rule(3, "five_fold_cv_available", "folds = 5", "'folds=' || folds || ', rows=' || fold_rows"),
    _rule(4, "three_market_segments_created", "nseg = 3", "'segments=' || nseg"),
    _rule(5, "value_outliers_are_cheaper_than_non_outliers", "price_out < price_in",
          f"'outlier=' || {_num('price_out', 2)} || ', non_outlier=' || {_num('price_in', 2)}"),
    _rule(6, "value_outliers_have_higher_ppr", "ppr_out > ppr_in", f"'outlier=' || {_num('ppr_out', 3)} || ', non_outlier=' || {_num('ppr_in', 3)}"),
    _rule(7, "value_outliers_are_under_expected_market_price", "gap_out > 0 AND share_out > 0",
          f"'avg_gap=' || {_num('gap_out', 2)} || ', avg_discount=' || {_num('share_out * 100', 1)} || '%'"),
    _rule(8, "recommendations_respect_budget", "budget_ok", "'rows=' || nrows"),
    _rule(9, "recommendations_sorted_by_ppr", "ppr_ok", "'rows=' || nrows"),
    _rule(10, "business_price_guides_created", "n > 0", "'guides=' || n"),
])
O["write_csv"] = "SELECT doc_id, lang, '  ' || text || ' ' AS text FROM documents"
O["read_csv_fallback"] = "SELECT doc_id, lang, source, text FROM documents"
