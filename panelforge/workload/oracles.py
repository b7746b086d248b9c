"""DuckDB SQL giving the same rows as ``queries.QUERIES``."""

from __future__ import annotations

PANEL = """
panel AS (
  SELECT CAST(c_custkey AS VARCHAR) AS CCN, c_name AS PROVIDER_NAME,
    NULLIF(n_name, 'NATION_0') AS STATE,
    CAST(date_trunc('month', CAST(o_orderdate AS DATE) - 1) AS DATE) AS SNAPSHOT_DATE,
    CASE WHEN c_mktsegment <> 'MACHINERY'
         THEN CASE WHEN c_acctbal > 0 THEN floor(c_acctbal / 50) ELSE 0.0 END END
      AS NUMBER_OF_CERTIFIED_BEDS,
    o_totalprice / 2500.9 AS AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 97001.3 END AS HOURS,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 5101.3 END AS TOTAL_TURNOVER,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 100.0 - o_totalprice / 5101.3 END
      AS RN_TURNOVER
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), latest AS (
  SELECT max(SNAPSHOT_DATE) AS d FROM panel
), recent AS (
  SELECT panel.*, SNAPSHOT_DATE AS MONTH,
    CASE WHEN NUMBER_OF_CERTIFIED_BEDS > 0
         THEN AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY / NUMBER_OF_CERTIFIED_BEDS * 100.0 END AS OCC
  FROM panel, latest WHERE SNAPSHOT_DATE >= d - INTERVAL 11 MONTH
), ranked AS (
  SELECT CCN, PROVIDER_NAME, STATE, SNAPSHOT_DATE AS MONTH, AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY,
    HOURS AS TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_DAY,
    CAST(row_number() OVER (ORDER BY HOURS, CCN) AS INTEGER) AS NATIONAL_RANK,
    CAST(row_number() OVER (PARTITION BY STATE ORDER BY HOURS, CCN) AS INTEGER) AS STATE_RANK
  FROM panel, latest WHERE SNAPSHOT_DATE = d AND HOURS IS NOT NULL
)"""

PAIRS = PANEL + """, scores AS (
  SELECT CAST(o_custkey AS VARCHAR) AS CCN, CAST(o_orderdate AS DATE) - 365 AS s,
    CAST(o_orderdate AS DATE) AS e,
    CAST(date_trunc('month', CAST(o_orderdate AS DATE) - 1) AS DATE) AS m, o_totalprice AS score
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P'
), newest AS (
  SELECT * FROM scores
  QUALIFY row_number() OVER (PARTITION BY CCN ORDER BY e DESC, m DESC, score) = 1
), pairs AS (
  SELECT p.CCN, PROVIDER_NAME, STATE, SNAPSHOT_DATE AS PROVIDER_SNAPSHOT_DATE, s AS QRP_START_DATE,
    e AS QRP_END_DATE, m AS QRP_SNAPSHOT_DATE,
    HOURS AS TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_DAY, score AS READMISSION_RATE_RSRR
  FROM panel p JOIN newest n ON p.CCN = n.CCN WHERE HOURS IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY p.CCN
    ORDER BY abs(date_diff('day', e, SNAPSHOT_DATE)), SNAPSHOT_DATE DESC, HOURS) = 1
)"""


def clean_corr(x: str, y: str) -> str:
    """Correlation as NULL where DuckDB says NaN."""
    c = f"corr({y}, {x})"
    return f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"


def r6(expression: str) -> str:
    return f"round({expression}, 6) + 0.0"


HOURS = "TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_DAY"
SCORE = "READMISSION_RATE_RSRR"
SCORED = PAIRS + f""", by_state AS (
  SELECT STATE, {clean_corr(HOURS, SCORE)} AS r, count(*) AS n FROM pairs GROUP BY STATE
), overall AS (
  SELECT {clean_corr(HOURS, SCORE)} AS r, count(*) AS n FROM pairs
), scored AS (
  SELECT pairs.STATE, CCN, PROVIDER_NAME, PROVIDER_SNAPSHOT_DATE, QRP_START_DATE, QRP_END_DATE,
    QRP_SNAPSHOT_DATE, {r6(HOURS)} AS {HOURS}, {r6(SCORE)} AS {SCORE},
    {r6("by_state.r")} AS STATE_STAFFING_READMISSION_CORRELATION,
    by_state.n AS STATE_OBSERVATION_COUNT,
    {r6("overall.r")} AS NATIONAL_STAFFING_READMISSION_CORRELATION,
    overall.n AS NATIONAL_OBSERVATION_COUNT
  FROM pairs LEFT JOIN by_state ON pairs.STATE = by_state.STATE CROSS JOIN overall
)"""

STRENGTH = """CASE WHEN r IS NULL THEN 'Not enough data to calculate a correlation.'
  WHEN r = 0 THEN 'There is essentially no linear relationship in this population.'
  ELSE 'This is a ' || CASE WHEN abs(r) < 0.2 THEN 'very weak' WHEN abs(r) < 0.4 THEN 'weak'
    WHEN abs(r) < 0.6 THEN 'moderate' WHEN abs(r) < 0.8 THEN 'strong' ELSE 'very strong' END
    || CASE WHEN r > 0 THEN ' positive' ELSE ' negative' END
    || ' linear relationship. Correlation does not establish causation.' END"""


def text_of(value: str, decimals: int, suffix: str = "") -> str:
    return f"COALESCE(format('{{:,.{decimals}f}}', {value}) || '{suffix}', 'N/A')"


DATE_TEXT_VALUE = """CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
  THEN CAST(o_orderdate AS DATE) END"""
PRICE_VALUE = """CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
  THEN o_totalprice END"""
FLAG_VALUE = "CASE o_orderstatus WHEN 'P' THEN 'Y' WHEN 'O' THEN 'N' END"

RELEASED = f"""
SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS CCN,
  CAST(o_orderkey AS VARCHAR) AS ORDER_NUMBER, {FLAG_VALUE} AS ABUSE_ICON,
  {DATE_TEXT_VALUE} AS PROCESSING_DATE, {PRICE_VALUE} AS TOTAL_AMOUNT_OF_FINES_IN_DOLLARS,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderstatus END AS ORDER_STATUS,
  make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS SNAPSHOT_DATE
FROM orders"""

FIT = """
fit AS (
  SELECT regr_slope({y}, {x}) AS a, regr_intercept({y}, {x}) AS b, min({x}) AS lo, max({x}) AS hi
  FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL
)"""
GRID = f"""
SELECT CAST(i AS INTEGER) AS POINT, {r6("lo + (hi - lo) * (i / 99.0)")} AS X,
  {r6("a * (lo + (hi - lo) * (i / 99.0)) + b")} AS Y
FROM fit, range(100) AS g(i) WHERE lo < hi"""

VERSIONS = """
items AS (
  SELECT *, CAST(o_custkey AS VARCHAR) || '-' || o_orderpriority AS file_id FROM orders
), feed AS (
  SELECT DISTINCT file_id FROM items WHERE o_orderdate >= TIMESTAMP '2000-08-01'
), old_last AS (
  SELECT * FROM items WHERE o_orderdate < TIMESTAMP '2000-08-01'
  QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
), new_last AS (
  SELECT * FROM items WHERE o_orderdate >= TIMESTAMP '1999-01-01'
  QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
), old_m AS (
  SELECT file_id, 'mirror/' || o_orderstatus || '/' || file_id AS k,
    CASE WHEN o_orderstatus <> 'P'
         THEN md5(CASE WHEN o_totalprice > 250000 THEN 'big' ELSE 'small' END) END AS m
  FROM old_last
), new_m AS (
  SELECT file_id, 'mirror/' || o_orderstatus || '/' || file_id AS k,
    CASE WHEN o_orderstatus <> 'P'
         THEN md5(CASE WHEN o_totalprice > 250000 THEN 'big' ELSE 'small' END) END AS m
  FROM new_last
), diffed AS (
  SELECT COALESCE(o.file_id, n.file_id) AS file_id, 'file' AS type,
    CASE WHEN o.file_id IS NULL THEN 'added' WHEN n.file_id IS NULL THEN 'removed'
      WHEN o.k <> n.k THEN 'moved' WHEN f.file_id IS NULL THEN 'unchanged'
      WHEN o.m = n.m THEN 'metadata_only' ELSE 'content_changed' END AS change_type,
    o.k AS old_key, n.k AS new_key, substr(n.k, 8) AS relative_path,
    f.file_id IS NOT NULL AND COALESCE(o.m <> n.m, TRUE) AS download
  FROM old_m o FULL JOIN new_m n ON o.file_id = n.file_id
    LEFT JOIN feed f ON COALESCE(o.file_id, n.file_id) = f.file_id
), cleaned AS (
  SELECT file_id, old_key AS s3_key, change_type AS reason FROM diffed
  WHERE change_type IN ('removed', 'moved') AND old_key NOT IN (SELECT k FROM new_m)
), steps AS (
  SELECT file_id,
    CAST(CASE change_type WHEN 'added' THEN 2 WHEN 'moved' THEN 3 ELSE 4 END AS INTEGER) AS step,
    0 AS depth,
    CASE WHEN change_type = 'moved' AND NOT download THEN 'copy' ELSE 'download' END AS action,
    CASE WHEN change_type = 'moved' AND NOT download THEN old_key END AS source_key,
    new_key AS s3_key,
    CASE WHEN change_type <> 'moved' THEN 'downloaded' WHEN download THEN 'downloaded,moved'
      ELSE 'moved' END AS counts_as
  FROM diffed WHERE change_type IN ('added', 'moved', 'content_changed')
  UNION ALL
  SELECT file_id, 5, 0, 'delete', NULL, s3_key, CASE reason WHEN 'removed' THEN 'deleted' ELSE '' END
  FROM cleaned
)"""

# Customer places: the key goes from one order to the next, so most moves read what others write.
SWAPS = """
RECURSIVE old_m AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS file_id, 'mirror/' || o_custkey || '/' ||
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-08-01'
), new_m AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS file_id, 'mirror/' || o_custkey || '/' ||
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS k
  FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01'
), moves AS (
  SELECT file_id, o.k AS old_key, n.k AS new_key FROM old_m o FULL JOIN new_m n USING (file_id)
), after AS (
  SELECT w.file_id AS id, m.file_id AS nxt FROM moves m JOIN moves w ON w.new_key = m.old_key
  WHERE m.old_key <> m.new_key AND w.old_key IS DISTINCT FROM w.new_key
), chains AS (
  SELECT id, nxt, 1 AS turn FROM after WHERE nxt NOT IN (SELECT id FROM after)
  UNION ALL SELECT a.id, a.nxt, turn + 1 FROM after a JOIN chains c ON a.nxt = c.id
), walks AS (
  SELECT id, id AS met, 0 AS far FROM after WHERE id NOT IN (SELECT id FROM chains)
  UNION ALL SELECT w.id, a.nxt, far + 1 FROM walks w JOIN after a ON a.id = w.met WHERE a.nxt <> w.id
), circles AS (
  SELECT id, arg_min(far, met) AS far, count(*) AS n FROM walks GROUP BY id
), turns AS (
  SELECT id, turn, FALSE AS aside FROM chains
  UNION ALL SELECT id, CASE far WHEN 0 THEN n ELSE far END - 1, far = 0 FROM circles
), waiting AS (
  SELECT file_id, old_key FROM moves JOIN turns ON id = file_id WHERE aside
), steps AS (
  SELECT m.file_id, CAST(CASE WHEN m.old_key IS NULL AND t.id IS NULL THEN 2 ELSE 3 END AS INTEGER) AS step,
    CAST(coalesce(t.turn, 0) AS INTEGER) AS depth,
    CASE WHEN m.old_key IS NULL THEN 'download' ELSE 'copy' END AS action,
    CASE WHEN w.file_id IS NOT NULL THEN '.staging/' || m.file_id ELSE m.old_key END AS source_key,
    m.new_key AS s3_key, CASE WHEN m.old_key IS NULL THEN 'downloaded' ELSE 'moved' END AS counts_as
  FROM moves m LEFT JOIN waiting w ON m.file_id = w.file_id LEFT JOIN turns t ON t.id = m.file_id
  WHERE m.new_key IS NOT NULL AND m.old_key IS DISTINCT FROM m.new_key
  UNION ALL
  SELECT file_id, 5, 0, 'delete', NULL, old_key, CASE WHEN new_key IS NULL THEN 'deleted' ELSE '' END
  FROM moves WHERE old_key IS DISTINCT FROM new_key AND old_key IS NOT NULL
    AND old_key NOT IN (SELECT k FROM new_m)
)"""

TREE = """
RECURSIVE listing AS (
  SELECT 'r' || r_regionkey AS id, r_name AS name, 'root' AS parent, 'folder' AS kind FROM region
  UNION ALL SELECT 'n' || n_nationkey, n_name, 'r' || n_regionkey, 'folder' FROM nation
  UNION ALL SELECT 'c' || c_custkey, c_name, 'n' || c_nationkey, 'folder' FROM customer
  UNION ALL SELECT 'o' || o_orderkey, o_orderkey || '.csv', 'c' || o_custkey,
    CASE WHEN o_orderstatus = 'P' THEN 'skipped_native'
      WHEN o_orderpriority = '5-LOW' THEN 'skipped_shortcut'
      WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED'
        THEN 'skipped_not_downloadable' ELSE 'file' END
  FROM orders
), tree AS (
  SELECT id, kind, 1 AS depth, name || CASE kind WHEN 'folder' THEN '/' ELSE '' END AS path
  FROM listing WHERE parent = 'root'
  UNION ALL
  SELECT l.id, l.kind, depth + 1, path || name || CASE l.kind WHEN 'folder' THEN '/' ELSE '' END
  FROM listing l JOIN tree ON l.parent = tree.id AND tree.kind = 'folder'
)"""


def contract_sql() -> str:
    missing = {
        "customer": "c_phone", "part": "p_container", "orders": "o_clerk,o_shippriority",
        "lineitem": "l_shipmode", "events": "session_id", "labels": "severity",
        "benchmark": "answer", "conversations": "model",
    }
    names = (
        "region nation customer supplier part orders lineitem events documents labels "
        "embeddings pages benchmark conversations"
    ).split()
    return " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS rows, '{missing.get(n, '')}' AS missing FROM {n}"
        for n in names
    )


METRIC_ONE = """CCN, PROVIDER_NAME, STATE, MONTH, NUMBER_OF_CERTIFIED_BEDS,
  AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY"""
TURNOVER_LABEL = "CASE m WHEN 't' THEN 'Total Nursing Staff' ELSE 'Registered Nurses' END"

ORACLES: dict[str, str] = {
    "scan_parquet": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "csv_roundtrip_clean": RELEASED,
    "incremental_stream": RELEASED,
    "snapshot_discovery": """
SELECT make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS SNAPSHOT_DATE, count(*) AS ROWS
FROM orders GROUP BY 1""",
    "name_month_parse": """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders""",
    "clean_text_yn": """
SELECT c_custkey, NULLIF(c_mktsegment, 'MACHINERY') AS segment,
  CASE WHEN c_acctbal > 5000 THEN 'Y' WHEN c_acctbal > 0 THEN 'N' END AS flag
FROM customer""",
    "document_text_clean": """
SELECT doc_id, md5(NULLIF(trim(text, ' '), '')) AS text_md5, NULLIF(upper(trim(lang, ' ')), '') AS lang
FROM documents""",
    "clean_numeric": f"SELECT o_orderkey, {PRICE_VALUE} AS price FROM orders",
    "clean_date": f"SELECT o_orderkey, {DATE_TEXT_VALUE} AS order_date FROM orders",
    "dictionary_typing": f"""
SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS CCN, o_orderpriority AS PROVIDER_TYPE,
  {FLAG_VALUE} AS ABUSE_ICON, {DATE_TEXT_VALUE} AS PROCESSING_DATE,
  {PRICE_VALUE} AS TOTAL_AMOUNT_OF_FINES_IN_DOLLARS, ' ' || o_orderkey AS ORDER_NUMBER,
  'orders' AS SOURCE_FILE_NAME,
  CAST(date_trunc('month', CAST(o_orderdate AS DATE) - 1) AS DATE) AS SNAPSHOT_DATE
FROM orders""",
    "drift_union": """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL BY NAME
SELECT o_orderpriority, o_orderstatus, o_orderkey FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
    "contract_report": contract_sql(),
    "lookback_panel": f"WITH {PANEL} SELECT CCN, SNAPSHOT_DATE, MONTH, {r6('HOURS')} AS hours FROM recent",
    "safe_ratio": f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_quantity > 1 THEN {r6("l_extendedprice / (l_quantity - 1) * 100.0")} END AS ratio
FROM lineitem""",
    "occupancy_trend": f"WITH {PANEL} SELECT {METRIC_ONE}, {r6('OCC')} AS OCCUPANCY_RATE_PCT FROM recent",
    "staffing_vs_occupancy": f"""WITH {PANEL}
SELECT {METRIC_ONE}, {r6('OCC')} AS OCCUPANCY_RATE_PCT, {r6('HOURS')} AS {HOURS} FROM recent""",
    "low_staffing_ranking": f"WITH {PANEL} SELECT * FROM ranked",
    "rank_national_state": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag,
  row_number() OVER (ORDER BY l_quantity, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_extendedprice, l_returnflag) AS national_rank,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity, l_orderkey, l_linenumber,
    l_partkey, l_suppkey, l_extendedprice) AS state_rank
FROM lineitem""",
    "latest_per_key": """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_day, o_totalprice FROM orders
WHERE o_orderpriority = '1-URGENT'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "nearest_join": """
WITH anchors AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS urgent_day, o_orderkey AS urgent_key FROM orders
  WHERE o_orderpriority = '1-URGENT'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
)
SELECT o.o_custkey, CAST(o_orderdate AS DATE) AS other_day, o_orderkey AS other_key, urgent_day,
  urgent_key
FROM orders o JOIN anchors a ON o.o_custkey = a.o_custkey WHERE o_orderpriority <> '1-URGENT'
QUALIFY row_number() OVER (PARTITION BY o.o_custkey
  ORDER BY abs(date_diff('day', urgent_day, CAST(o_orderdate AS DATE))), o_orderdate DESC,
    o_orderkey) = 1""",
    "group_corr": f"""
SELECT l_partkey, {r6(clean_corr("l_quantity", "l_extendedprice"))} AS correlation, count(*) AS rows
FROM lineitem GROUP BY l_partkey""",
    "global_corr": f"""
SELECT {r6(clean_corr("l_quantity", "l_extendedprice"))} AS correlation, count(*) AS rows
FROM lineitem""",
    "readmission_correlation": f"WITH {SCORED} SELECT * FROM scored",
    "state_month_avg": f"""WITH {PANEL}
SELECT CCN, PROVIDER_NAME, STATE, MONTH, {r6("TOTAL_TURNOVER")} AS TOTAL_NURSING_STAFF_TURNOVER,
  {r6("RN_TURNOVER")} AS REGISTERED_NURSE_TURNOVER,
  {r6("avg(TOTAL_TURNOVER) OVER (PARTITION BY STATE, MONTH)")}
    AS STATE_AVG_TOTAL_NURSING_STAFF_TURNOVER,
  {r6("avg(RN_TURNOVER) OVER (PARTITION BY STATE, MONTH)")} AS STATE_AVG_REGISTERED_NURSE_TURNOVER
FROM recent""",
    "kpis": f"""WITH {PANEL}, a AS (
  SELECT avg(OCC) AS o, avg(HOURS) AS h, avg(TOTAL_TURNOVER) AS t, avg(RN_TURNOVER) AS rn,
    count(DISTINCT MONTH) AS months, max(MONTH) AS m,
    avg(OCC) FILTER (HOURS IS NOT NULL) AS po, avg(HOURS) FILTER (OCC IS NOT NULL) AS ph
  FROM recent
), b AS (SELECT min({HOURS}) AS low FROM ranked)
SELECT {r6("o")} AS AVG_OCCUPANCY, {r6("h")} AS AVG_STAFFING, {r6("low")} AS LOWEST_STAFFING,
  {r6("t")} AS AVG_TURNOVER, {text_of("o", 1, "%")} AS AVG_OCCUPANCY_TEXT,
  {text_of("h", 2)} AS AVG_STAFFING_TEXT, {text_of("low", 2)} AS LOWEST_STAFFING_TEXT,
  {text_of("t", 1)} AS AVG_TURNOVER_TEXT, strftime(m, '%B %Y') AS LATEST_MONTH_TEXT,
  {r6("po")} AS PAIRED_OCCUPANCY, {r6("ph")} AS PAIRED_STAFFING, months AS MONTHS,
  CASE WHEN months >= 2 THEN 'trend' ELSE 'snapshot' END AS MODE, {r6("rn")} AS AVG_RN_TURNOVER
FROM a, b""",
    "kpi_cube": f"""WITH {PANEL}, a AS (
  SELECT CASE WHEN GROUPING(STATE) = 1 THEN 'all' WHEN GROUPING(CCN) = 1 THEN 'state' ELSE 'facility' END AS SCOPE, STATE, CCN,
    avg(OCC) AS o, avg(HOURS) AS h, avg(TOTAL_TURNOVER) AS t, avg(RN_TURNOVER) AS rn, count(DISTINCT MONTH) AS months,
    avg(OCC) FILTER (HOURS IS NOT NULL) AS po, avg(HOURS) FILTER (OCC IS NOT NULL) AS ph,
    min(HOURS) FILTER (SNAPSHOT_DATE = (SELECT d FROM latest)) AS low
  FROM recent GROUP BY GROUPING SETS ((), (STATE), (STATE, CCN))
)
SELECT SCOPE, STATE, CCN, {r6("o")} AS AVG_OCCUPANCY, {r6("h")} AS AVG_STAFFING, {r6("low")} AS LOWEST_STAFFING,
  {r6("t")} AS AVG_TURNOVER, {r6("rn")} AS AVG_RN_TURNOVER, {r6("po")} AS PAIRED_OCCUPANCY, {r6("ph")} AS PAIRED_STAFFING,
  months AS MONTHS, CASE WHEN months >= 2 THEN 'trend' ELSE 'snapshot' END AS MODE
FROM a WHERE SCOPE = 'all' OR STATE IS NOT NULL""",
    "state_zscore": f"""WITH {PANEL}, means AS (
  SELECT STATE, avg(OCC) AS o, avg(HOURS) AS h FROM recent WHERE STATE IS NOT NULL GROUP BY STATE
), kept AS (SELECT * FROM means WHERE o IS NOT NULL OR h IS NOT NULL
), moments AS (
  SELECT avg(o) AS mo, stddev_pop(o) AS so, avg(h) AS mh, stddev_pop(h) AS sh FROM kept
)
SELECT STATE, {r6("o")} AS OCCUPANCY_RATE_PCT, {r6("h")} AS STAFFING_HOURS,
  {r6("CASE WHEN so IS NULL OR so = 0 THEN 0.0 ELSE (o - mo) / so END")} AS OCCUPANCY_RATE_PCT_Z,
  {r6("CASE WHEN sh IS NULL OR sh = 0 THEN 0.0 ELSE (h - mh) / sh END")} AS STAFFING_HOURS_Z
FROM kept, moments""",
    "linear_fit": f"""
WITH {FIT.format(x="l_quantity", y="l_extendedprice", source="lineitem")}
SELECT round(a, 3) + 0.0 AS SLOPE, round(b, 3) + 0.0 AS INTERCEPT, lo AS X_MIN, hi AS X_MAX FROM fit WHERE lo < hi""",
    "linear_fit_grid": f"""
WITH {FIT.format(x="l_quantity", y="l_extendedprice", source="lineitem")}
{GRID.replace(", 6)", ", 3)")}""",
    "staffing_points": f"""WITH {PANEL}
SELECT CCN, PROVIDER_NAME, STATE, {r6("OCC")} AS OCCUPANCY_RATE_PCT, {r6("HOURS")} AS {HOURS},
  AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY, NUMBER_OF_CERTIFIED_BEDS
FROM recent WHERE OCC IS NOT NULL AND HOURS IS NOT NULL""",
    "staffing_trend": f"WITH {PANEL}, {FIT.format(x='OCC', y='HOURS', source='recent')} {GRID}",
    "topn_lowest": f"""WITH {PANEL}
SELECT NATIONAL_RANK AS RANK, PROVIDER_NAME AS FACILITY, STATE,
  AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY AS AVG_RESIDENTS_PER_DAY,
  {r6(HOURS)} AS STAFFING_HOURS_PER_RESIDENT_DAY
FROM ranked ORDER BY NATIONAL_RANK LIMIT 25""",
    "topn_lowest_in_state": f"""WITH {PANEL}
SELECT STATE_RANK AS RANK, PROVIDER_NAME AS FACILITY, STATE,
  AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY AS AVG_RESIDENTS_PER_DAY,
  {r6(HOURS)} AS STAFFING_HOURS_PER_RESIDENT_DAY
FROM ranked WHERE STATE = 'NATION_7' ORDER BY STATE_RANK LIMIT 10""",
    "topn_customers": """
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 25""",
    "readmission_points": f"""WITH {SCORED}
SELECT CCN, PROVIDER_NAME, STATE, {HOURS}, {SCORE}, STATE_STAFFING_READMISSION_CORRELATION,
  NATIONAL_STAFFING_READMISSION_CORRELATION
FROM scored WHERE STATE = 'NATION_7'""",
    "readmission_trend": f"WITH {PAIRS}, {FIT.format(x=HOURS, y=SCORE, source='pairs')} {GRID}",
    "strength_label": f"""WITH {SCORED}, values_ AS (
  SELECT 'National Pearson Correlation' AS TITLE,
    max(NATIONAL_STAFFING_READMISSION_CORRELATION) AS r FROM scored
  UNION ALL
  SELECT 'NATION_7 Pearson Correlation', max(STATE_STAFFING_READMISSION_CORRELATION) FROM scored
  WHERE STATE = 'NATION_7'
  UNION ALL SELECT 'Correlation', CAST(NULL AS DOUBLE)
)
SELECT TITLE, r AS CORRELATION, {text_of("r", 3)} AS CORRELATION_TEXT,
  CASE TITLE WHEN 'Correlation' THEN 'A Pearson correlation cannot be calculated for one facility. '
    || 'Select All Facilities to view the national or selected-state correlation.'
  ELSE {STRENGTH} END AS SENTENCE
FROM values_""",
    "state_strengths": f"""WITH {SCORED}, s AS (
  SELECT STATE, n, {r6("r")} AS r FROM by_state
)
SELECT STATE, n AS ROWS, r AS R, {STRENGTH} AS SENTENCE, {text_of("r", 3)} AS R_TEXT FROM s""",
    "turnover_trend": f"""WITH {PANEL}, m AS (
  SELECT MONTH, avg(TOTAL_TURNOVER) AS t, avg(RN_TURNOVER) AS rn FROM recent GROUP BY MONTH
)
SELECT MONTH, 'TOTAL_NURSING_STAFF_TURNOVER' AS TURNOVER_TYPE, {r6("t")} AS TURNOVER FROM m
UNION ALL SELECT MONTH, 'REGISTERED_NURSE_TURNOVER', {r6("rn")} FROM m""",
    "top_states": f"""WITH {PANEL}, m AS (
  SELECT STATE, avg(TOTAL_TURNOVER) AS t, avg(RN_TURNOVER) AS rn FROM recent
  WHERE STATE IS NOT NULL GROUP BY STATE HAVING avg(TOTAL_TURNOVER) IS NOT NULL
  ORDER BY t DESC, STATE LIMIT 15
)
SELECT STATE, 'Total Nursing Staff' AS TURNOVER_TYPE, {r6("t")} AS TURNOVER_RATE_PCT FROM m
UNION ALL SELECT STATE, 'Registered Nurses', {r6("rn")} FROM m""",
    "turnover_distribution": f"""WITH {PANEL}, v AS (
  SELECT 't' AS m, TOTAL_TURNOVER AS x FROM recent WHERE STATE = 'NATION_7'
  UNION ALL SELECT 'r', RN_TURNOVER FROM recent WHERE STATE = 'NATION_7'
), binned AS (
  SELECT {TURNOVER_LABEL} AS TURNOVER_TYPE,
    CAST(CASE WHEN x = 100 THEN 20 ELSE floor(x / 5) + 1 END AS INTEGER) AS BIN
  FROM v WHERE x IS NOT NULL
)
SELECT TURNOVER_TYPE, BIN, (BIN - 1) * CAST(5 AS DOUBLE) AS BIN_START,
  BIN * CAST(5 AS DOUBLE) AS BIN_END, count(*) AS ROWS
FROM binned GROUP BY TURNOVER_TYPE, BIN""",
    "histogram": """
WITH binned AS (
  SELECT l_returnflag, CAST(least(floor(l_quantity * 2 / 5) + 1, 20) AS INTEGER) AS BIN
  FROM lineitem
)
SELECT l_returnflag, BIN, (BIN - 1) * CAST(5 AS DOUBLE) AS BIN_START,
  BIN * CAST(5 AS DOUBLE) AS BIN_END, count(*) AS ROWS
FROM binned GROUP BY l_returnflag, BIN""",
    "detail_unpivot": f"""WITH {PANEL}, one AS (
  SELECT * FROM recent WHERE CCN = '6'
  ORDER BY MONTH, PROVIDER_NAME, TOTAL_TURNOVER NULLS FIRST, RN_TURNOVER NULLS FIRST LIMIT 1
)
SELECT 'Total Nursing Staff' AS MEASURE, {r6("TOTAL_TURNOVER")} AS ANNUAL_TURNOVER_RATE_PCT FROM one
UNION ALL SELECT 'Registered Nurses', {r6("RN_TURNOVER")} FROM one""",
    "melt_lines": """
SELECT l_orderkey, l_linenumber, l_partkey, 'l_discount' AS measure, l_discount AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_tax', l_tax FROM lineitem""",
    "filter_lists": f"""WITH {PANEL}
SELECT DISTINCT 'state' AS LIST, STATE AS ENTRY FROM recent WHERE STATE IS NOT NULL
UNION ALL SELECT 'facility', PROVIDER_NAME || ' (' || CCN || ')'
FROM (SELECT DISTINCT CCN, PROVIDER_NAME, STATE FROM recent)""",
    "facility_labels": """
SELECT c_custkey, COALESCE(NULLIF(c_name, 'Customer#000000001'), 'Unknown facility')
  || ' (' || c_custkey || ')' AS label
FROM customer""",
    "scope_filter": f"""WITH {PANEL}, p AS (
  SELECT CCN, STATE, SNAPSHOT_DATE,
    {r6("HOURS")} AS REPORTED_TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_PER_DAY
  FROM panel
)
SELECT * FROM p WHERE STATE = 'NATION_7' UNION ALL SELECT * FROM p WHERE CCN = '6'""",
    "gold_roundtrip": f"""WITH {PANEL}
SELECT STATE, MONTH, count(*) AS rows_01, {r6("avg(HOURS)")} AS avg_staffing,
  {r6("avg(TOTAL_TURNOVER)")} AS state_avg
FROM recent WHERE STATE IS NOT NULL GROUP BY STATE, MONTH""",
    "manifest_diff": f"WITH {VERSIONS} SELECT * FROM diffed",
    "manifest_plan": f"""WITH {VERSIONS}
SELECT change_type, count(*) AS items FROM diffed GROUP BY change_type""",
    "cleanup_plan": f"WITH {VERSIONS} SELECT * FROM cleaned",
    "mirror_actions": f"WITH {VERSIONS} SELECT * FROM steps",
    "mirror_swaps": f"""WITH {SWAPS} SELECT * FROM steps
UNION ALL SELECT file_id, 0, 0, 'stage', old_key, '.staging/' || file_id, '' FROM waiting
UNION ALL SELECT file_id, 6, 0, 'unstage', NULL, '.staging/' || file_id, '' FROM waiting""",
    "mirror_counts": f"""WITH {VERSIONS}
SELECT count(*) FILTER (counts_as LIKE '%downloaded%') AS downloaded,
  count(*) FILTER (counts_as LIKE '%moved%') AS moved,
  count(*) FILTER (counts_as = 'deleted') AS deleted, CAST(0 AS BIGINT) AS folder_markers_created
FROM steps""",
    "tree_paths": f"""WITH {TREE}
SELECT id AS file_id, kind, CAST(depth AS INTEGER) AS depth, path AS relative_path FROM tree""",
    "crawl_summary": f"""WITH {TREE}
SELECT count(*) FILTER (kind = 'folder') AS folders, count(*) FILTER (kind = 'file') AS files,
  count(*) FILTER (kind LIKE 'skipped%') AS skipped
FROM tree""",
    "bootstrap_plan": f"""WITH {TREE}
SELECT id AS file_id, CAST(CASE kind WHEN 'folder' THEN 1 ELSE 2 END AS INTEGER) AS step,
  CAST(CASE kind WHEN 'folder' THEN depth ELSE 0 END AS INTEGER) AS depth,
  CASE kind WHEN 'folder' THEN 'mark_folder' ELSE 'download' END AS action,
  CAST(NULL AS VARCHAR) AS source_key, 'mirror/' || path AS s3_key,
  CASE kind WHEN 'folder' THEN 'folder_markers_created' ELSE 'downloaded' END AS counts_as
FROM tree WHERE kind IN ('folder', 'file')""",
    "duplicate_keys": """
SELECT l_orderkey || '/' || l_linenumber AS line, min(l_partkey || '-' || l_suppkey) AS first_id,
  max(l_partkey || '-' || l_suppkey) AS last_id
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING min(l_partkey || '-' || l_suppkey) <> max(l_partkey || '-' || l_suppkey)""",
    "mirror_incremental": f"""WITH {TREE}, seen AS (
  SELECT kind, id = 'n3' OR path LIKE '%/NATION_3/%' AS added_tree,
    CASE WHEN id LIKE 'o%' THEN CAST(substr(id, 2) AS BIGINT) % 4 END AS part
  FROM tree WHERE kind IN ('folder', 'file')
)
SELECT 'incremental' AS mode,
  count(*) FILTER (kind = 'file' AND part <> 1 AND (part = 0 OR added_tree)) AS downloaded,
  CAST(0 AS BIGINT) AS moved, count(*) FILTER (kind = 'file' AND part = 1 AND NOT added_tree) AS deleted,
  count(*) FILTER (kind = 'folder' AND added_tree) AS folder_markers_created
FROM seen""",
    "removed_release": f"""
SELECT * FROM ({RELEASED}) WHERE year(SNAPSHOT_DATE) <> 1995
  AND (year(SNAPSHOT_DATE) <> 1996 OR CAST(ORDER_NUMBER AS BIGINT) % 3 > 0)""",
    "rejected_rows": """
SELECT make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS SNAPSHOT_DATE,
  lpad(CAST(o_custkey AS VARCHAR), 6, '0') || ',' || o_orderkey
    || CASE WHEN o_orderkey % 10 = 1 THEN ',O,x y' ELSE '' END AS RECORD
FROM orders WHERE o_orderkey % 10 < 2""",
    "release_ledger": """
SELECT make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS SNAPSHOT_DATE,
  CAST(count(*) FILTER (year(o_orderdate) <> 1995) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (year(o_orderdate) <> 1995 AND o_orderkey % 10 < 2) AS BIGINT) AS n_malformed,
  max(year(o_orderdate)) = 1995 AS removed
FROM orders GROUP BY 1""",
    "measure_silver_build": """
SELECT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS CCN, 'S_' || o_orderkey AS MEASURE_CODE,
  CASE WHEN o_orderstatus = 'P' THEN 'Not Available' ELSE CAST(o_custkey % 100 AS VARCHAR) END AS SCORE,
  o_orderpriority[1] AS FOOTNOTE, CAST(o_orderdate AS DATE) AS START_DATE,
  CAST(CAST(o_orderdate AS DATE) + 30 AS DATE) AS END_DATE,
  'Skilled_Nursing_Facility_Quality_Reporting_Program_Provider_Data_' || strftime(o_orderdate, '%B%Y') || '.csv' AS SOURCE_FILE_NAME,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS SNAPSHOT_DATE
FROM orders""",
    "late_release": RELEASED,
    "restated_release": RELEASED,
    "manifest_state_json": f"""WITH {VERSIONS}
SELECT file_id, k AS s3_key, m AS md5_checksum, 'second' AS token FROM new_m""",
    "mirror_runs": f"""WITH {TREE}
SELECT 'bootstrap' AS mode, count(*) FILTER (kind = 'file') AS downloaded,
  count(*) FILTER (kind = 'folder') AS folder_markers_created
FROM tree
UNION ALL SELECT 'no_applicable_changes', 0, 0""",
}

ORACLES["feed_replay"] = """
SELECT DISTINCT 'f' || o_orderkey AS "fileId", o_orderstatus = 'F' AS removed, strftime(o_orderdate, '%Y-%m-%d') AS time
FROM orders"""
# Kept up month by month, the rows are those of a full build.
ORACLES["monthly_metrics"] = ORACLES["state_month_avg"]
ORACLES["merged_monthly_turnover"] = f"""WITH {PANEL}
SELECT MONTH, {r6("avg(TOTAL_TURNOVER)")} AS TOTAL_NURSING_STAFF_TURNOVER, {r6("avg(RN_TURNOVER)")} AS REGISTERED_NURSE_TURNOVER
FROM recent GROUP BY MONTH"""
