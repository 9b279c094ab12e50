"""Independent DuckDB SQL for every registered query (correctness oracle).

Written directly in SQL from the operator definitions (whole-symbol windows,
recursive CTEs for recurrences), not generated from the Spark plans.
"""
from __future__ import annotations

BARS = """
bars AS (
  SELECT l_suppkey AS symbol, l_shipdate AS "timestamp",
         min_by(l_extendedprice / l_quantity,
                row(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)) AS open,
         max(l_extendedprice / l_quantity) AS high,
         min(l_extendedprice / l_quantity) AS low,
         max_by(l_extendedprice / l_quantity,
                row(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume,
         count(*) AS trade_count
  FROM lineitem GROUP BY l_suppkey, l_shipdate)"""

W = 'PARTITION BY symbol ORDER BY "timestamp"'


def _roll(fn: str, col: str, n: int) -> str:
    frame = f'({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)'
    return f"CASE WHEN count({col}) OVER {frame} >= {n} THEN {fn}({col}) OVER {frame} END"


def _z(col: str, n: int) -> str:
    z = f"(({col}) - ({_roll('avg', col, n)})) / ({_roll('stddev_samp', col, n)})"
    return f"CASE WHEN isnan({z}) THEN 0.0 ELSE coalesce({z}, 0.0) END"


def _ff(col: str) -> str:
    return f"last_value({col} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _pct(col: str, n: int) -> str:
    return f"ff_{col} / lag(ff_{col}, {n}) OVER ({W}) - 1"


SQL: dict[str, str] = {}

SQL["feat_rolling_mean"] = f"""WITH {BARS}
SELECT symbol, "timestamp",
       round({_roll('avg', 'close', 5)}, 6) AS ma_close_5,
       round({_roll('avg', 'volume', 10)}, 6) AS ma_volume_10
FROM bars"""

SQL["feat_rolling_std"] = f"""WITH {BARS}
SELECT symbol, "timestamp",
       round({_roll('stddev_samp', 'close', 20)}, 6) AS vol_close_20,
       round({_roll('stddev_samp', 'volume', 10)}, 6) AS vol_volume_10
FROM bars"""

SQL["feat_zscore"] = f"""WITH {BARS}
SELECT symbol, "timestamp",
       round({_z('close', 20)}, 6) AS zscore_close_20,
       round({_z('volume', 20)}, 6) AS zscore_volume_20
FROM bars"""

SQL["feat_pct_change"] = f"""WITH {BARS},
f AS (SELECT *, {_ff('close')} AS ff_close, {_ff('volume')} AS ff_volume FROM bars)
SELECT symbol, "timestamp",
       round({_pct('close', 1)}, 6) AS return_1d,
       round({_pct('close', 5)}, 6) AS return_5d,
       round({_pct('volume', 20)}, 6) AS volume_return_20d
FROM f"""

SQL["feat_lag"] = f"""WITH {BARS}
SELECT symbol, "timestamp",
       round(lag(close, 1) OVER ({W}), 6) AS lag_close_1,
       round(lead(close, 2) OVER ({W}), 6) AS lead_close_2,
       lag(volume, 3) OVER ({W}) AS lag_volume_3
FROM bars"""

# adjusted EMA as the plain recurrence N_t = x_t + r N_t-1, D_t = 1 + r D_t-1
_EMA = f"""WITH RECURSIVE {BARS},
s AS (SELECT symbol, "timestamp", close, row_number() OVER ({W}) AS rn FROM bars),
e AS (
  SELECT symbol, rn, "timestamp", close AS n12, 1.0::DOUBLE AS d12, close AS n26, 1.0::DOUBLE AS d26
  FROM s WHERE rn = 1
  UNION ALL
  SELECT s.symbol, s.rn, s."timestamp",
         s.close + (1 - 2.0 / 13.0) * e.n12, 1 + (1 - 2.0 / 13.0) * e.d12,
         s.close + (1 - 2.0 / 27.0) * e.n26, 1 + (1 - 2.0 / 27.0) * e.d26
  FROM e JOIN s ON s.symbol = e.symbol AND s.rn = e.rn + 1)"""

SQL["feat_ema"] = _EMA + """
SELECT symbol, "timestamp", round(n12 / d12 + 1e-9, 6) AS ema_close_12, round(n26 / d26 + 1e-9, 6) AS ema_close_26 FROM e"""

SQL["feat_ema_nulls"] = f"""WITH RECURSIVE {BARS},
s AS (SELECT symbol, "timestamp", close, row_number() OVER ({W}) AS rn FROM bars WHERE volume % 4 <> 0),
e AS (
  SELECT symbol, rn, "timestamp", close AS n, 1.0::DOUBLE AS d FROM s WHERE rn = 1
  UNION ALL
  SELECT s.symbol, s.rn, s."timestamp", s.close + (1 - 2.0 / 13.0) * e.n, 1 + (1 - 2.0 / 13.0) * e.d
  FROM e JOIN s ON s.symbol = e.symbol AND s.rn = e.rn + 1)
SELECT b.symbol, b."timestamp", round(e.n / e.d + 1e-9, 6) AS ema_close_12
FROM bars b LEFT JOIN e ON e.symbol = b.symbol AND e."timestamp" = b."timestamp" """

SQL["target_return"] = f"""WITH {BARS}
SELECT symbol, "timestamp", round(lead(close, 1) OVER ({W}) / close - 1, 6) AS future_return_1d FROM bars"""

SQL["target_value"] = f"""WITH {BARS}
SELECT symbol, "timestamp", round(lead(close, 5) OVER ({W}), 6) AS future_close_5 FROM bars"""

_BASIC = f"""
  {_pct('close', 1)} AS return_1d,
  {_pct('close', 5)} AS return_5d,
  {_roll('avg', 'close', 5)} AS ma_close_5,
  {_roll('avg', 'close', 20)} AS ma_close_20,
  {_roll('stddev_samp', 'close', 20)} AS vol_close_20,
  {_z('close', 20)} AS zscore_close_20,
  {_roll('avg', 'volume', 10)} AS ma_volume_10,
  {_roll('stddev_samp', 'volume', 10)} AS vol_volume_10,
  lag(close, 1) OVER ({W}) AS lag_close_1"""

_BASIC_NAMES = ["return_1d", "return_5d", "ma_close_5", "ma_close_20", "vol_close_20",
                "zscore_close_20", "ma_volume_10", "vol_volume_10", "lag_close_1"]
_MACRO_NAMES = _BASIC_NAMES + ["ema_close_12", "ema_close_26", "volume_return_20d", "zscore_volume_20"]


def _rounded(names):
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


SQL["feature_frame"] = _EMA + f""",
f AS (SELECT *, {_ff('close')} AS ff_close, {_ff('volume')} AS ff_volume FROM bars),
g AS (SELECT symbol, "timestamp", {_BASIC},
        {_pct('volume', 20)} AS volume_return_20d,
        {_z('volume', 20)} AS zscore_volume_20
      FROM f)
SELECT g.symbol, g."timestamp", {_rounded(_BASIC_NAMES)},
       round(e.n12 / e.d12 + 1e-9, 6) AS ema_close_12, round(e.n26 / e.d26 + 1e-9, 6) AS ema_close_26,
       round(volume_return_20d, 6) AS volume_return_20d, round(zscore_volume_20, 6) AS zscore_volume_20
FROM g JOIN e ON g.symbol = e.symbol AND g."timestamp" = e."timestamp" """

SQL["supervised_rows"] = f"""WITH {BARS},
f AS (SELECT *, {_ff('close')} AS ff_close FROM bars),
g AS (SELECT symbol, "timestamp", {_BASIC},
        lead(close, 1) OVER ({W}) / close - 1 AS future_return_1d
      FROM f)
SELECT symbol, "timestamp", {_rounded(_BASIC_NAMES + ['future_return_1d'])}
FROM g WHERE {' AND '.join(n + ' IS NOT NULL' for n in _BASIC_NAMES + ['future_return_1d'])}"""

# ---- data quality ---------------------------------------------------------
_GAP_US = 600_000_000


def _gaps_sql(by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    sel = f"{by}, " if by else ""
    return f"""WITH d AS (SELECT DISTINCT {sel}ts FROM events WHERE ts IS NOT NULL),
p AS (SELECT {sel}ts AS start_timestamp, lead(ts) OVER ({part}ORDER BY ts) AS end_timestamp FROM d),
q AS (SELECT *, epoch_us(end_timestamp) - epoch_us(start_timestamp) AS gap_us FROM p
      WHERE end_timestamp IS NOT NULL)
SELECT {sel}start_timestamp, end_timestamp, gap_us,
       greatest(gap_us // {_GAP_US} - 1, 0) AS missing_intervals
FROM q WHERE gap_us > {_GAP_US}"""


SQL["time_gaps"] = _gaps_sql()
SQL["time_gaps_by_symbol"] = _gaps_sql("user_id")
SQL["gap_sample"] = f"""SELECT * FROM ({_gaps_sql()}) ORDER BY start_timestamp LIMIT 10"""

SQL["key_counts"] = """SELECT l_orderkey, l_linenumber, count(*) AS count
FROM lineitem GROUP BY l_orderkey, l_linenumber"""

SQL["duplicate_rows"] = """SELECT l.* FROM lineitem l JOIN (
  SELECT l_orderkey, l_linenumber FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
  GROUP BY 1, 2 HAVING count(*) > 1) d USING (l_orderkey, l_linenumber)"""

SQL["duplicate_summary"] = """SELECT count(*) AS duplicate_keys,
  CAST(coalesce(sum(c), 0) AS BIGINT) AS collapsed_count,
  CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS removed_count
FROM (SELECT count(*) AS c FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""

SQL["collapse_duplicates"] = """SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
           l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
           l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1"""

SQL["column_median"] = "SELECT round(median(TRY_CAST(value AS DOUBLE)), 6) AS median FROM events"

_MAD = """m AS (SELECT median(TRY_CAST(value AS DOUBLE)) AS med FROM events),
a AS (SELECT median(abs(TRY_CAST(value AS DOUBLE) - med)) AS mad FROM events, m),
s AS (SELECT e.*, CASE WHEN mad IS NOT NULL AND mad <> 0
                       THEN abs(TRY_CAST(value AS DOUBLE) - med) / mad * 0.67448975 END AS value_score,
             med, mad
      FROM events e, m, a),
f AS (SELECT *, coalesce(CASE WHEN isnan(value_score) THEN false ELSE value_score > 3.5 END, false)
                AS is_outlier FROM s)"""

SQL["column_mad"] = f"""WITH {_MAD} SELECT round(med, 6) AS median, round(mad, 6) AS mad FROM m, a"""
SQL["mad_scores"] = f"""WITH {_MAD}
SELECT event_id, round(value, 6) AS value, round(value_score, 6) AS value_score, is_outlier FROM f"""
SQL["mad_clean"] = f"""WITH {_MAD}
SELECT event_id, ts, user_id, event_type, round(value, 6) AS value FROM f WHERE NOT is_outlier"""
SQL["mad_quarantine"] = f"""WITH {_MAD}
SELECT event_id, ts, user_id, event_type, round(value, 6) AS value FROM f WHERE is_outlier"""
SQL["mad_summary"] = f"""WITH {_MAD}
SELECT 'value' AS "column", round(any_value(med), 6) AS median, round(any_value(mad), 6) AS mad,
       count(*) FILTER (WHERE is_outlier) AS outliers
FROM f GROUP BY med, mad HAVING any_value(mad) IS NOT NULL AND any_value(mad) <> 0"""

SQL["alerts"] = f"""WITH {_MAD},
g AS (SELECT count(*) AS c FROM ({_gaps_sql()})),
d AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS c FROM (
        SELECT count(*) AS c FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)),
o AS (SELECT count(*) AS c FROM f WHERE is_outlier)
SELECT 'time_gaps_detected' AS "check", c AS count, CAST(1000 AS BIGINT) AS threshold, c > 1000 AS fired, 'error' AS severity FROM g
UNION ALL SELECT 'duplicates_collapsed', c, 0, c > 0, 'error' FROM d
UNION ALL SELECT 'mad_outliers_quarantined', c, 0, c > 0, 'error' FROM o"""

# ---- schema contract, actions, scalar helpers -----------------------------
SQL["schema_null_counts"] = f"""WITH {BARS}
SELECT 'timestamp' AS "column", count(*) FILTER (WHERE "timestamp" IS NULL) AS null_count FROM bars
UNION ALL SELECT 'symbol', count(*) FILTER (WHERE symbol IS NULL) FROM bars
UNION ALL SELECT 'open', count(*) FILTER (WHERE open IS NULL) FROM bars
UNION ALL SELECT 'high', count(*) FILTER (WHERE high IS NULL) FROM bars
UNION ALL SELECT 'low', count(*) FILTER (WHERE low IS NULL) FROM bars
UNION ALL SELECT 'close', count(*) FILTER (WHERE close IS NULL) FROM bars
UNION ALL SELECT 'volume', count(*) FILTER (WHERE volume IS NULL) FROM bars
UNION ALL SELECT 'trade_count', count(*) FILTER (WHERE trade_count IS NULL) FROM bars"""

SQL["enforce_schema"] = f"""WITH {BARS}
SELECT "timestamp", CAST(symbol AS VARCHAR) AS symbol,
       round(CAST(CAST(open AS VARCHAR) AS DOUBLE), 6) AS open, round(CAST(CAST(high AS VARCHAR) AS DOUBLE), 6) AS high,
       round(CAST(CAST(low AS VARCHAR) AS DOUBLE), 6) AS low, round(CAST(CAST(close AS VARCHAR) AS DOUBLE), 6) AS close,
       CAST(CAST(volume AS VARCHAR) AS BIGINT) AS volume, CAST(CAST(trade_count AS VARCHAR) AS BIGINT) AS trade_count
FROM bars"""

CA = """
ca AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS ex_date,
         CASE WHEN r.q % 5 = 0 THEN NULL WHEN r.q % 5 = 1 THEN 0.0 ELSE 2.0 END AS split_ratio,
         CASE WHEN r.q % 7 = 0 THEN NULL ELSE r.t * 10 END AS cash_dividend,
         r.p / r.q AS close
  FROM (SELECT l_suppkey, l_shipdate,
               max_by({'q': l_quantity, 't': l_tax, 'p': l_extendedprice},
                      row(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)) AS r
        FROM lineitem GROUP BY l_suppkey, l_shipdate))"""

_FRAME_FACTORS = """
  1.0 / CASE WHEN split_ratio = 0 THEN 1.0 ELSE split_ratio END AS split_factor,
  CASE WHEN cash_dividend = 0 OR close IS NULL THEN 1.0 ELSE 1.0 - cash_dividend / close END AS dividend_factor"""
_SAFE_FACTORS = """
  CASE WHEN split_ratio IS NULL OR split_ratio = 0 THEN 1.0 ELSE 1.0 / split_ratio END AS split_factor,
  CASE WHEN cash_dividend IS NULL OR cash_dividend = 0 OR close IS NULL OR close = 0 THEN 1.0
       ELSE 1.0 - cash_dividend / close END AS dividend_factor"""

SQL["action_factors"] = f"""WITH {CA}, f AS (SELECT symbol, ex_date, {_FRAME_FACTORS} FROM ca)
SELECT symbol, CAST(ex_date AS TIMESTAMP) AS ex_date, round(split_factor, 6) AS split_factor, round(dividend_factor, 6) AS dividend_factor,
       round(split_factor * dividend_factor, 6) AS adjustment_factor FROM f"""

SQL["action_factors_safe"] = f"""WITH {CA}, f AS (SELECT symbol, ex_date, {_SAFE_FACTORS} FROM ca)
SELECT symbol, CAST(ex_date AS TIMESTAMP) AS ex_date, round(split_factor, 6) AS split_factor, round(dividend_factor, 6) AS dividend_factor,
       round(split_factor * dividend_factor, 6) AS adjustment_factor FROM f"""

_LATEST = f"""{CA},
b AS (SELECT symbol, ex_date, coalesce(split_ratio, 4.0) AS split_ratio, cash_dividend * 2 AS cash_dividend, close
      FROM ca WHERE CAST(symbol AS INTEGER) % 4 = 0),
latest AS (SELECT * FROM b
           UNION ALL SELECT * FROM ca WHERE (symbol, ex_date) NOT IN (SELECT (symbol, ex_date) FROM b)),
store AS (SELECT symbol, ex_date, split_ratio, cash_dividend, close, {_SAFE_FACTORS} FROM latest)"""

SQL["actions_latest"] = f"""WITH {_LATEST}
SELECT symbol, CAST(ex_date AS TIMESTAMP) AS ex_date, round(split_ratio, 6) AS split_ratio, round(cash_dividend, 6) AS cash_dividend,
       round(close, 6) AS close FROM latest"""

SQL["actions_table"] = f"""WITH {_LATEST}
SELECT symbol, CAST(ex_date AS TIMESTAMP) AS ex_date, round(split_ratio, 6) AS split_ratio, round(cash_dividend, 6) AS cash_dividend,
       round(close, 6) AS close, round(split_factor * dividend_factor, 6) AS adjustment_factor FROM store"""

SQL["action_lookup"] = f"""WITH {BARS}, {_LATEST}
SELECT CAST(b.symbol AS VARCHAR) AS symbol, CAST(CAST(b."timestamp" AS DATE) AS TIMESTAMP) AS day, round(b.close, 6) AS close,
       round(coalesce(s.split_factor * s.dividend_factor, 1.0), 6) AS adjustment_factor
FROM bars b LEFT JOIN store s ON CAST(b.symbol AS VARCHAR) = s.symbol AND CAST(b."timestamp" AS DATE) = s.ex_date"""

SQL["scan_bars"] = f"""WITH {BARS}
SELECT symbol, "timestamp", round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low,
       round(close, 6) AS close, volume, trade_count FROM bars"""

SQL["sorted_bars"] = f"""WITH {BARS}
SELECT "timestamp", symbol, round(close, 6) AS close FROM bars ORDER BY "timestamp", symbol"""

SQL["ist_to_utc"] = """SELECT event_id, ts - INTERVAL '5 hours 30 minutes' AS ts_utc,
       ts - INTERVAL '5 hours 30 minutes' AS ts_utc_from_text,
       ts - INTERVAL '5 hours 30 minutes' AS ts_utc_from_offset FROM events"""

SQL["time_range_filter"] = f"""WITH {BARS}
SELECT symbol, "timestamp", round(close, 6) AS close FROM bars
WHERE "timestamp" BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1998-02-28'"""

SQL["safe_cast"] = """SELECT event_id, TRY_CAST(props AS BIGINT) AS props_as_long,
       TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k,
       TRY_CAST(event_type AS DOUBLE) AS type_as_double, CAST(user_id AS VARCHAR) AS user_text
FROM events"""

SQL["scalar_math"] = f"""WITH {BARS}, r AS (SELECT *, close / open - 1 AS r FROM bars)
SELECT symbol, "timestamp", round(abs(r), 6) AS abs_ret, round(sign(r), 6) AS sign_ret,
       round(sqrt(high - low), 6) AS sqrt_range, round(pow(r, 2), 6) AS square_ret,
       round(pow(volume, 0.5), 6) AS pow_vol, round(tanh(r), 6) AS tanh_ret,
       round(round_even(r * 10, 0), 6) AS rint_ret, round(greatest(-0.1, least(0.1, r)), 6) AS clip_ret
FROM r"""

SQL["history_bounds"] = f"""WITH {BARS}
SELECT symbol, min("timestamp") AS first_ts, max("timestamp") AS last_ts, count(*) AS bars FROM bars GROUP BY symbol"""

SIGNAL_TIMES = """
st AS (SELECT date_trunc('month', l_shipdate) AS month, max(l_shipdate) AS "timestamp"
       FROM lineitem GROUP BY 1)"""

SIGNALS = f"""{SIGNAL_TIMES},
act AS (SELECT DISTINCT l_suppkey AS symbol, date_trunc('month', l_shipdate) AS month FROM lineitem),
cnt AS (SELECT CAST(s_suppkey % 3 AS INTEGER) AS strategy, count(*) AS n_sym FROM supplier GROUP BY 1),
signals AS (
  SELECT CAST(a.symbol % 3 AS INTEGER) AS strategy, st."timestamp", a.symbol,
         ((a.symbol * 31 + (year(a.month) * 12 + month(a.month)) * 17) % 21 - 10) / 10.0 / c.n_sym AS target_weight
  FROM act a JOIN st USING (month) JOIN cnt c ON c.strategy = CAST(a.symbol % 3 AS INTEGER))"""

SQL["signal_times"] = f"""WITH {SIGNALS} SELECT DISTINCT strategy, "timestamp" FROM signals"""
# source_hash: no oracle (the SQL side cannot name the data directory); rows-only check.
SQL["text_hash"] = "SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR)) AS hash FROM orders"

# ---- universe and portfolio -----------------------------------------------
MASTER = """
master AS (
  SELECT s_suppkey AS symbol, n_regionkey AS region,
         CAST(DATE '1995-01-01' + CAST(s_suppkey * 97 % 700 AS INTEGER) AS TIMESTAMP) AS start_date,
         CASE WHEN s_suppkey % 3 = 0 THEN NULL
              ELSE CAST(DATE '2001-12-31' - CAST(s_suppkey * 131 % 900 AS INTEGER) AS TIMESTAMP) END AS end_date
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
members AS (
  SELECT 'IDX' || CAST(region AS VARCHAR) AS "index", symbol,
         CAST(CAST(start_date AS DATE) + CAST(symbol % 200 AS INTEGER) AS TIMESTAMP) AS start_date,
         CAST(CAST(end_date AS DATE) - CAST(symbol % 200 AS INTEGER) AS TIMESTAMP) AS end_date
  FROM master)"""


def rsig(x: str, digits: int = 10) -> str:
    e = f"(floor(log10(abs({x}))) - {digits - 1})"
    return (f"CASE WHEN {x} = 0 OR {x} IS NULL OR isnan({x}) THEN {x} "
            f"ELSE round({x} / pow(10.0, {e}), 0) * pow(10.0, {e}) END")


def _valid(alias: str, t: str) -> str:
    return f"({alias}.start_date <= {t} AND ({alias}.end_date IS NULL OR {alias}.end_date >= {t}))"


SQL["universe_as_of"] = f"""WITH {MASTER}
SELECT DISTINCT symbol FROM master m WHERE {_valid('m', "TIMESTAMP '1998-06-30'")}"""

SQL["universe_panel"] = f"""WITH {MASTER}, {SIGNAL_TIMES}
SELECT DISTINCT st."timestamp", m.symbol FROM st JOIN master m ON {_valid('m', 'st."timestamp"')}"""

SQL["universe_index"] = f"""WITH {MASTER}, {SIGNAL_TIMES}
SELECT DISTINCT st."timestamp", m.symbol FROM st JOIN master m ON {_valid('m', 'st."timestamp"')}
WHERE EXISTS (SELECT 1 FROM members x WHERE x."index" = 'IDX1' AND x.symbol = m.symbol
              AND {_valid('x', 'st."timestamp"')})"""

_BT = f"""WITH RECURSIVE {BARS}, {SIGNALS}, {MASTER},
sig AS (SELECT * FROM signals WHERE "timestamp" BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2001-12-31'),
tk AS (SELECT strategy, "timestamp", dense_rank() OVER (PARTITION BY strategy ORDER BY "timestamp") - 1 AS k
       FROM (SELECT DISTINCT strategy, "timestamp" FROM sig)),
gated AS (SELECT s.* FROM sig s WHERE EXISTS (
            SELECT 1 FROM master m WHERE m.symbol = s.symbol AND {_valid('m', 's."timestamp"')})),
atk AS (SELECT g.strategy, t.k, g.symbol, g.target_weight AS w FROM gated g JOIN tk t USING (strategy, "timestamp")),
rws AS (SELECT strategy, k, symbol, max(w) AS w
        FROM (SELECT strategy, k, symbol, w FROM atk
              UNION ALL SELECT strategy, k + 1, symbol, NULL FROM atk) GROUP BY strategy, k, symbol),
panel0 AS (SELECT r.strategy, r.k, t."timestamp", r.symbol, coalesce(r.w, 0.0) AS w
           FROM rws r JOIN tk t ON t.strategy = r.strategy AND t.k = r.k),
px AS (SELECT t.strategy, t.k, b.symbol, b.close FROM bars b JOIN tk t ON b."timestamp" = t."timestamp"
       WHERE b.close IS NOT NULL AND NOT isnan(b.close)),
pe AS (SELECT p.*, x.close AS p, CASE WHEN x.close <> 0 THEN p.w ELSE 0.0 END AS w_eff
       FROM panel0 p ASOF LEFT JOIN px x ON p.strategy = x.strategy AND p.symbol = x.symbol AND p.k >= x.k),
contrib AS (SELECT c.strategy, c.k,
                   sum(CASE WHEN pr.w_eff <> 0 THEN pr.w_eff * (c.p / pr.p - 1) ELSE 0.0 END) AS g
            FROM pe c LEFT JOIN pe pr ON pr.strategy = c.strategy AND pr.symbol = c.symbol AND pr.k = c.k - 1
            GROUP BY c.strategy, c.k),
gk AS (SELECT t.strategy, t.k, t."timestamp", coalesce(c.g, 0.0) AS g FROM tk t LEFT JOIN contrib c USING (strategy, k)),
nav AS (SELECT strategy, k, "timestamp", 1000000.0::DOUBLE AS v FROM gk WHERE k = 0
        UNION ALL
        SELECT g.strategy, g.k, g."timestamp", n.v * (1 + g.g) FROM nav n JOIN gk g ON g.strategy = n.strategy AND g.k = n.k + 1),
eq AS (SELECT strategy, k, "timestamp", v AS portfolio_value,
              v / coalesce(lag(v) OVER (PARTITION BY strategy ORDER BY k), 1000000.0) - 1 AS period_return FROM nav),
dd AS (SELECT *, max(portfolio_value) OVER (PARTITION BY strategy ORDER BY k ROWS UNBOUNDED PRECEDING) AS peak FROM eq),
dd2 AS (SELECT *, CASE WHEN peak > 0 THEN portfolio_value / peak - 1 ELSE 0.0 END AS drawdown FROM dd)"""

def _friction(trade: str) -> str:
    """Slippage and cost of a trade of so many shares (10 bps, minimum 20, 1 per order; 5 bps)."""
    return (f"CASE WHEN abs({trade}) < 1e-6 THEN 0.0 ELSE p * 0.0005 * abs({trade}) "
            f"+ greatest(abs(p * (1 + sign({trade}) * 0.0005) * ({trade})) * 0.001 + 1.0, 20.0) END")


SQL["gated_signals"] = f"""{_BT}
SELECT strategy, "timestamp", symbol, round(target_weight, 6) AS target_weight FROM gated"""

SQL["signal_price_panel"] = f"""WITH {BARS}, {SIGNALS}
SELECT s.strategy, s."timestamp", s.symbol, round(s.target_weight, 6) AS target_weight, round(b.close, 6) AS close
FROM signals s LEFT JOIN bars b ON b.symbol = s.symbol AND b."timestamp" = s."timestamp" """

SQL["last_price"] = f"""{_BT} SELECT strategy, "timestamp", symbol, round(p, 6) AS p FROM pe"""
SQL["rebalance_panel"] = f"""{_BT}
SELECT strategy, "timestamp", symbol, round(w, 6) AS w, round(w_eff, 6) AS w_eff FROM pe"""

SQL["trades"] = f"""{_BT},
sh AS (SELECT pe.strategy, pe.k, pe."timestamp", pe.symbol,
              CASE WHEN w_eff <> 0 THEN w_eff * n.v / p ELSE 0.0 END AS shares
       FROM pe JOIN nav n ON n.strategy = pe.strategy AND n.k = pe.k)
SELECT c.strategy, c."timestamp", c.symbol, round(c.shares, 4) AS shares,
       round(c.shares - coalesce(pr.shares, 0.0), 4) AS trade_shares
FROM sh c LEFT JOIN sh pr ON pr.strategy = c.strategy AND pr.symbol = c.symbol AND pr.k = c.k - 1"""

SQL["nav_frictionless"] = f"""{_BT}
SELECT strategy, "timestamp", {rsig('portfolio_value')} AS portfolio_value, round(period_return, 6) AS period_return FROM eq"""

# the trading loop as a recursion over (strategy, k): values before trading and friction paid
SQL["nav_costed"] = f"""{_BT},
pp AS (SELECT c.strategy, c.k, c.w_eff AS w, c.p, coalesce(pr.w_eff, 0.0) AS w0, pr.p AS p0
       FROM pe c LEFT JOIN pe pr ON pr.strategy = c.strategy AND pr.symbol = c.symbol AND pr.k = c.k - 1),
loop AS (
  SELECT g.strategy, g.k, g."timestamp", 1000000.0::DOUBLE AS v,
         coalesce((SELECT sum({_friction('CASE WHEN w <> 0 THEN w * 1000000.0 / p ELSE 0.0 END')})
                   FROM pp WHERE pp.strategy = g.strategy AND pp.k = 0), 0.0) AS f
  FROM gk g WHERE g.k = 0
  UNION ALL
  SELECT x.strategy, x.k, x."timestamp", x.v,
         coalesce((SELECT sum({_friction('CASE WHEN w <> 0 THEN w * x.v / p ELSE 0.0 END - CASE WHEN w0 <> 0 THEN w0 * x.v0 / p0 ELSE 0.0 END')})
                   FROM pp WHERE pp.strategy = x.strategy AND pp.k = x.k), 0.0) AS f
  FROM (SELECT g.strategy, g.k, g."timestamp", l.v * (1 + g.g) - l.f AS v, l.v AS v0
        FROM loop l JOIN gk g ON g.strategy = l.strategy AND g.k = l.k + 1) x),
n AS (SELECT strategy, k, "timestamp", v - f AS portfolio_value FROM loop)
SELECT strategy, "timestamp", {rsig('portfolio_value')} AS portfolio_value,
       round(portfolio_value / coalesce(lag(portfolio_value) OVER (PARTITION BY strategy ORDER BY k), 1000000.0) - 1, 6) AS period_return
FROM n"""

SQL["period_returns"] = f"""{_BT} SELECT strategy, "timestamp", round(period_return, 6) AS period_return FROM eq"""

SQL["drawdown"] = f"""{_BT}
SELECT strategy, "timestamp", {rsig('peak')} AS peak, round(drawdown, 6) AS drawdown FROM dd2"""

SQL["backtest_summary"] = f"""{_BT},
agg AS (SELECT strategy, min("timestamp") AS start_date, max("timestamp") AS end_date,
               arg_min(portfolio_value, k) AS first_value, arg_max(portfolio_value, k) AS final_value,
               coalesce(stddev_samp(period_return) FILTER (WHERE k >= 1), 0.0) AS sd,
               coalesce(avg(period_return) FILTER (WHERE k >= 1), 0.0) AS mu,
               min(drawdown) AS mdd
        FROM dd2 GROUP BY strategy)
SELECT strategy, start_date, end_date, 1000000.0::DOUBLE AS initial_capital, {rsig('final_value')} AS final_value,
       round(final_value / first_value - 1, 6) AS total_return,
       round(final_value / 1000000.0 - 1, 6) AS return_on_capital,
       round(CASE WHEN sd <> 0 THEN sd * sqrt(252) ELSE 0.0 END, 6) AS annualised_volatility,
       round(CASE WHEN sd <> 0 THEN mu / sd * sqrt(252) ELSE 0.0 END, 6) AS sharpe_ratio,
       round(abs(least(mdd, 0.0)), 6) AS max_drawdown
FROM agg"""

SQL["trade_costs"] = f"""WITH {BARS},
n AS (SELECT symbol, "timestamp", close * volume * CASE WHEN close >= open THEN 1.0 ELSE -1.0 END AS notional FROM bars)
SELECT symbol, "timestamp", round(notional, 6) AS notional,
       round(CASE WHEN notional = 0 THEN 0.0 ELSE greatest(abs(notional) * (10.0 / 10000) + 1.0, 20.0) END, 6) AS cost
FROM n"""

SQL["exec_prices"] = f"""WITH {BARS}
SELECT symbol, "timestamp",
       round(CASE WHEN sign(close - open) = 0 THEN close ELSE close * (1 + sign(close - open) * (5.0 / 10000)) END, 6)
         AS exec_price
FROM bars"""

# ---- splits, folds, metrics -----------------------------------------------
SQL["split_rows"] = f"""WITH {BARS},
t AS (SELECT 'early' AS split, 'train' AS role, "timestamp" FROM bars WHERE "timestamp" BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1998-12-31'
      UNION ALL SELECT 'early', 'validation', "timestamp" FROM bars WHERE "timestamp" BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-06-30'
      UNION ALL SELECT 'late', 'train', "timestamp" FROM bars WHERE "timestamp" BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'
      UNION ALL SELECT 'late', 'validation', "timestamp" FROM bars WHERE "timestamp" BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2001-06-30')
SELECT split, role, count(*) AS rows, min("timestamp") AS first_ts, max("timestamp") AS last_ts FROM t GROUP BY split, role"""


def _folds_sql(src: str) -> str:
    return f"""
wcfg AS (SELECT * FROM (VALUES ('1yr_train_3mo_val', 252, 63, 21), ('2yr_train_6mo_val', 504, 126, 42))
         AS t(name, td, vd, sd)),
hb AS (SELECT greatest(TIMESTAMP '1994-01-01', min("timestamp")) AS st, max("timestamp") AS lt FROM {src}),
folds AS (
  SELECT name AS "window", CAST(i AS INTEGER) AS fold,
         st + to_days(CAST(i * sd AS INTEGER)) AS train_start,
         st + to_days(CAST(i * sd + td - 1 AS INTEGER)) AS train_end,
         st + to_days(CAST(i * sd + td AS INTEGER)) AS validation_start,
         st + to_days(CAST(i * sd + td + vd - 1 AS INTEGER)) AS validation_end
  FROM wcfg, hb, range(0, 100000) r(i)
  WHERE st + to_days(CAST(i * sd + td + vd - 1 AS INTEGER)) <= lt)"""


SQL["cv_folds"] = f"""WITH {BARS}, {_folds_sql('bars')} SELECT * FROM folds"""

SQL["cv_fold_rows"] = f"""WITH {BARS}, {_folds_sql('bars')},
t AS (SELECT f."window", f.fold, 'train' AS role, b."timestamp" FROM bars b JOIN folds f
        ON b."timestamp" BETWEEN f.train_start AND f.train_end
      UNION ALL
      SELECT f."window", f.fold, 'validation', b."timestamp" FROM bars b JOIN folds f
        ON b."timestamp" BETWEEN f.validation_start AND f.validation_end)
SELECT "window", fold, role, count(*) AS rows, min("timestamp") AS first_ts, max("timestamp") AS last_ts
FROM t GROUP BY "window", fold, role"""

_SUP = f"""{BARS},
f AS (SELECT *, {_ff('close')} AS ff_close FROM bars),
g AS (SELECT symbol, "timestamp", {_BASIC},
        lead(close, 1) OVER ({W}) / close - 1 AS future_return_1d
      FROM f),
sup AS (SELECT * FROM g WHERE {' AND '.join(n + ' IS NOT NULL' for n in _BASIC_NAMES + ['future_return_1d'])})"""


def _metrics_sql(src: str, keys: str) -> str:
    return f"""
mm AS (SELECT *, avg(y) OVER (PARTITION BY {keys}) AS ybar FROM {src}),
m1 AS (SELECT {keys}, count(*) AS n, avg((p - y) * (p - y)) AS mse, avg(abs(p - y)) AS mae,
              sum((y - p) * (y - p)) AS sse, sum((y - ybar) * (y - ybar)) AS sst,
              avg(CASE WHEN sign(p) = sign(y) THEN 1.0 ELSE 0.0 END) AS directional_accuracy,
              avg(sign(p) * y) AS avg_strategy_return,
              CASE WHEN count(*) > 1 THEN coalesce(stddev_samp(sign(p) * y), 0.0) ELSE 0.0 END AS strategy_volatility
       FROM mm GROUP BY {keys}),
m2 AS (SELECT {keys}, n, sqrt(mse) AS rmse, mae, mse,
              CASE WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - sse / sst END AS r2,
              directional_accuracy, avg_strategy_return, strategy_volatility,
              CASE WHEN strategy_volatility > 1e-12 THEN avg_strategy_return / strategy_volatility ELSE 0.0 END
                AS strategy_sharpe
       FROM m1)"""


_METRICS = ["rmse", "mae", "mse", "r2", "directional_accuracy", "avg_strategy_return",
            "strategy_volatility", "strategy_sharpe"]

SQL["regression_metrics"] = f"""WITH {_SUP},
src AS (SELECT symbol, future_return_1d AS y, return_1d AS p FROM sup), {_metrics_sql('src', 'symbol')}
SELECT symbol, n, {_rounded(_METRICS)} FROM m2"""

SQL["cv_metrics"] = f"""WITH {_SUP}, {_folds_sql('sup')},
t AS (SELECT f."window", f.fold, 'train' AS role, s.future_return_1d AS y, s.return_1d AS p FROM sup s JOIN folds f
        ON s."timestamp" BETWEEN f.train_start AND f.train_end
      UNION ALL
      SELECT f."window", f.fold, 'validation', s.future_return_1d, s.return_1d FROM sup s JOIN folds f
        ON s."timestamp" BETWEEN f.validation_start AND f.validation_end),
okf AS (SELECT "window", fold FROM t GROUP BY "window", fold
        HAVING count(*) FILTER (WHERE role = 'train') > 0 AND count(*) FILTER (WHERE role = 'validation') > 0),
src AS (SELECT t."window", t.fold, y, p FROM t JOIN okf USING ("window", fold) WHERE role = 'validation'),
{_metrics_sql('src', '"window", fold')},
avgw AS (SELECT "window", {', '.join(f'avg({m}) AS {m}' for m in _METRICS)} FROM m2 GROUP BY "window")
SELECT 'cv_' || "window" || '_' || metric AS key, round(value, 6) AS value
FROM (UNPIVOT avgw ON {', '.join(_METRICS)} INTO NAME metric VALUE value)"""

SQL["cv_linear"] = f"""WITH {_SUP}, {_folds_sql('sup')},
fit AS (SELECT f."window", f.fold, regr_slope(s.future_return_1d, s.return_1d) AS b,
               regr_intercept(s.future_return_1d, s.return_1d) AS a
        FROM sup s JOIN folds f ON s."timestamp" BETWEEN f.train_start AND f.train_end GROUP BY 1, 2),
src AS (SELECT f."window", f.fold, s.future_return_1d AS y, a + b * s.return_1d AS p
        FROM folds f JOIN fit USING ("window", fold) JOIN sup s ON s."timestamp" BETWEEN f.validation_start AND f.validation_end),
{_metrics_sql('src', '"window", fold')},
avgw AS (SELECT "window", {', '.join(f'avg({m}) AS {m}' for m in _METRICS)} FROM m2 GROUP BY "window")
SELECT 'cv_' || "window" || '_' || metric AS key, round(value, 6) AS value
FROM (UNPIVOT avgw ON {', '.join(_METRICS)} INTO NAME metric VALUE value)"""

# ---- rewards ---------------------------------------------------------------
_LIN = [i * ((0.2 - 1.0) / 8) + 1.0 for i in range(8)] + [0.2]
_SIG = "0.0::DOUBLE"
for _n, _w in zip(_BASIC_NAMES, _LIN):
    _SIG = f"({_SIG} + {_n} * {_w!r}::DOUBLE)"

_POL = f"""{_SUP},
pol0 AS (SELECT *, {_SIG} AS signal FROM sup),
pol1 AS (SELECT *, greatest(-1.0, least(1.0, round_even(tanh(0.001::DOUBLE * signal), 0))) AS action FROM pol0),
pol AS (SELECT *, coalesce(lag(action) OVER ({W}), 0.0) AS prev_action,
               row_number() OVER ({W}) - 1 AS rn, count(*) OVER (PARTITION BY symbol) AS n FROM pol1)"""

_RISK = "(action * future_return_1d - 0.0005::DOUBLE * abs(action - prev_action) - 0.001::DOUBLE * action * action)"

SQL["feature_signal"] = f"""WITH {_POL} SELECT symbol, "timestamp", round(signal, 4) AS signal FROM pol"""
SQL["action_policy"] = f"""WITH {_POL} SELECT symbol, "timestamp", action FROM pol"""
SQL["action_turnover"] = f"""WITH {_POL} SELECT symbol, "timestamp", abs(action - prev_action) AS turnover FROM pol"""
SQL["reward_risk_adjusted"] = f"""WITH {_POL}
SELECT symbol, "timestamp", action, round({_RISK}, 6) AS reward FROM pol"""
SQL["reward_directional"] = f"""WITH {_POL}
SELECT symbol, "timestamp", action,
       CASE WHEN sign(action) = sign(future_return_1d - 0.0) THEN 1.0 ELSE -1.0 END AS reward FROM pol"""
SQL["discounted_reward"] = f"""WITH {_POL}
SELECT symbol, round(sum({_RISK} * pow(0.95, rn)), 6) AS discounted_reward FROM pol GROUP BY symbol"""

_EP = f"""{_POL},
syms AS (SELECT DISTINCT symbol, n FROM pol WHERE n >= 63),
eps AS (SELECT symbol, CAST(e AS INTEGER) AS episode, (e * 97) % (n - 63 + 1) AS start FROM syms, range(0, 25) r(e)),
er AS (SELECT e.symbol, e.episode, CAST(p.rn - e.start AS INTEGER) AS step, p."timestamp", p.action, p.future_return_1d
       FROM eps e JOIN pol p ON p.symbol = e.symbol AND p.rn BETWEEN e.start AND e.start + 62),
er2 AS (SELECT * EXCLUDE (prev_action0), prev_action0 AS prev_action FROM (
          SELECT *, coalesce(lag(action) OVER (PARTITION BY symbol, episode ORDER BY step), 0.0) AS prev_action0 FROM er)),
er3 AS (SELECT *, {_RISK} AS reward FROM er2),
kp AS (SELECT symbol, episode, sum(reward) AS cumulative_reward, sum(reward * pow(0.95, step)) AS discounted_reward,
              avg(reward) AS mean_reward, sum(abs(action - prev_action)) AS turnover,
              CASE WHEN count(*) > 1 AND stddev_samp(action * future_return_1d) > 1e-12
                   THEN avg(action * future_return_1d) / stddev_samp(action * future_return_1d) ELSE 0.0 END AS sharpe,
              avg(CASE WHEN sign(action) = sign(future_return_1d) THEN 1.0 ELSE 0.0 END) AS directional_accuracy,
              avg(CASE WHEN reward > 0 THEN 1.0 ELSE 0.0 END) AS hit_rate
       FROM er3 GROUP BY symbol, episode)"""

_KPIS = ["cumulative_reward", "discounted_reward", "mean_reward", "turnover", "sharpe",
         "directional_accuracy", "hit_rate"]

SQL["episode_rows"] = f"""WITH {_EP}
SELECT symbol, episode, step, "timestamp", action, round(reward, 6) AS reward FROM er3"""
SQL["episode_kpis"] = f"""WITH {_EP} SELECT symbol, episode, {_rounded(_KPIS)} FROM kp"""
SQL["episode_summary"] = f"""WITH {_EP}
SELECT symbol, count(*) AS episodes,
       {', '.join(f"round(avg({k}), 6) AS mean_{k}, round(CASE WHEN count({k}) > 1 THEN stddev_samp({k}) ELSE 0.0 END, 6) AS std_{k}" for k in _KPIS)}
FROM kp GROUP BY symbol"""

# ---- ledger, points, audit ------------------------------------------------
_LEDGER = """
ledger AS (SELECT o_orderkey AS id, 'landing/' || CAST(o_orderkey AS VARCHAR) || '.csv' AS source_path,
                  'clean/' || CAST(o_orderkey AS VARCHAR) || '.parquet' AS destination_path,
                  sha256(CAST(o_orderkey AS VARCHAR)) AS source_hash, o_custkey AS row_count,
                  'completed' AS status, o_orderdate AS created_at, o_orderdate AS completed_at
           FROM orders WHERE o_orderkey % 2 = 1),
batch AS (SELECT 'landing/' || CAST(o_orderkey AS VARCHAR) || '.csv' AS source_path,
                 sha256(CAST(o_orderkey AS VARCHAR)) AS source_hash, o_custkey AS row_count,
                 o_orderdate + INTERVAL 3650 DAY AS created_at
          FROM orders)"""

SQL["ledger_new_files"] = f"""WITH {_LEDGER}
SELECT source_path, source_hash FROM batch WHERE source_hash NOT IN (SELECT source_hash FROM ledger)"""

SQL["ledger_upsert"] = f"""WITH {_LEDGER},
runs AS (SELECT source_path, regexp_replace(source_path, '^landing/(.*)\\.csv$', 'clean/\\1.parquet') AS destination_path,
                source_hash, row_count, 'completed' AS status, created_at, created_at AS completed_at FROM batch),
upd AS (SELECT l.id, l.source_path, r.destination_path, l.source_hash, r.row_count, r.status, l.created_at, r.completed_at
        FROM ledger l JOIN runs r USING (source_hash)),
keep AS (SELECT * FROM ledger WHERE source_hash NOT IN (SELECT source_hash FROM runs)),
ins AS (SELECT (SELECT max(id) FROM ledger) + row_number() OVER (ORDER BY completed_at, source_hash) AS id,
               source_path, destination_path, source_hash, row_count, status, created_at, completed_at
        FROM runs WHERE source_hash NOT IN (SELECT source_hash FROM ledger))
SELECT * FROM upd UNION ALL SELECT * FROM keep UNION ALL SELECT * FROM ins"""

_FIELDS = """concat_ws(',',
   'event_id=' || CAST(event_id AS VARCHAR) || 'i',
   CASE WHEN user_id IS NOT NULL THEN 'user_id=' || CAST(user_id AS VARCHAR) || 'i' END,
   CASE WHEN value IS NOT NULL AND NOT isnan(value) THEN 'value=' || CAST(value AS VARCHAR) END,
   CASE WHEN props IS NOT NULL THEN 'props="' || replace(replace(props, '\\', '\\\\'), '"', '\\"') || '"' END)"""

SQL["points_tags"] = """SELECT event_id, 'events' AS measurement,
       CASE WHEN event_type IS NULL THEN '' ELSE 'event_type=' || event_type END AS tags FROM events"""

SQL["points_fields"] = f"""SELECT event_id, {_FIELDS} AS fields, epoch_us(ts) * 1000 AS time_ns FROM events"""

SQL["points_lines"] = f"""SELECT event_id,
       'events' || CASE WHEN event_type IS NULL THEN ''
                        ELSE ',event_type=' || regexp_replace(event_type, '([ ,=])', '\\\\\\1', 'g') END
       || ' ' || {_FIELDS} || ' ' || CAST(epoch_us(ts) * 1000 AS VARCHAR) AS line FROM events"""

SQL["audit_json"] = f"""WITH {_MAD},
g AS (SELECT count(*) AS c FROM ({_gaps_sql()})),
d AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS c FROM (
        SELECT count(*) AS c FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)),
o AS (SELECT count(*) AS c FROM f WHERE is_outlier)
SELECT 'time_gaps_detected' AS event,
       '{{"application":"barspark.ingest","details":{{"count":' || c || ',"expected_frequency":"0:10:00"}},"event":"time_gaps_detected","level":"INFO","timestamp":"{'2026-01-01T00:00:00+00:00'}"}}' AS json FROM g
UNION ALL SELECT 'duplicates_collapsed',
       '{{"application":"barspark.ingest","details":{{"collapsed_count":' || c || ',"keys":["l_orderkey","l_linenumber"]}},"event":"duplicates_collapsed","level":"INFO","timestamp":"2026-01-01T00:00:00+00:00"}}' FROM d
UNION ALL SELECT 'mad_outliers_quarantined',
       '{{"application":"barspark.ingest","details":{{"threshold":3.5,"total_quarantined":' || c || '}},"event":"mad_outliers_quarantined","level":"WARNING","timestamp":"2026-01-01T00:00:00+00:00"}}' FROM o"""

SQL["ingest_clean"] = f"""WITH {BARS},
m AS (SELECT median(close) AS med FROM bars),
a AS (SELECT median(abs(close - med)) AS mad FROM bars, m),
f AS (SELECT b.*, coalesce(CASE WHEN mad IS NOT NULL AND mad <> 0
                                THEN abs(close - med) / mad * 0.67448975 > 3.5 END, false) AS o
      FROM bars b, m, a)
SELECT "timestamp" - INTERVAL '5 hours 30 minutes' AS "timestamp", CAST(symbol AS VARCHAR) AS symbol,
       round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close,
       volume, trade_count
FROM f WHERE NOT o"""


SQL["ingest_outcomes"] = """WITH t AS (
  SELECT l_suppkey % 7 AS f, l_shipdate AS ts, l_suppkey AS symbol, l_extendedprice / l_quantity AS price,
         l_suppkey % 7 = 3 AND l_linenumber = 7 AS odd, l_suppkey % 7 = 5 AND l_linenumber = 1 AS nameless,
         row(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS k
  FROM lineitem),
gate AS (SELECT f, count(*) AS n, bool_or(odd) AS bad, bool_or(nameless) AS empty FROM t GROUP BY 1),
d AS (SELECT t.f, ts, symbol, arg_max(price, k) AS price, count(*) AS times FROM t JOIN gate USING (f) WHERE NOT bad AND NOT empty GROUP BY ALL),
dup AS (SELECT f, sum(CASE WHEN times > 1 THEN times ELSE 0 END) AS collapsed, sum(times - 1) AS removed FROM d GROUP BY 1),
g AS (SELECT f, count(*) FILTER (nxt - ts > INTERVAL 1 DAY) AS gaps
      FROM (SELECT f, ts, lead(ts) OVER (PARTITION BY f ORDER BY ts) AS nxt FROM (SELECT DISTINCT f, ts FROM d)) GROUP BY 1),
m AS (SELECT f, median(price) AS med FROM d GROUP BY 1),
a AS (SELECT d.f, any_value(med) AS med, median(abs(price - med)) AS mad FROM d JOIN m USING (f) GROUP BY 1),
o AS (SELECT d.f, count(*) FILTER (mad <> 0 AND abs(price - med) / mad * 0.67448975 > 3.5) AS outliers, count(*) AS kept
      FROM d JOIN a USING (f) GROUP BY 1)
SELECT 'file' || CAST(f AS VARCHAR) || '.csv' AS file, CASE WHEN bad OR empty THEN 'rejected' ELSE 'passed' END AS status, n AS rows,
       CASE WHEN bad THEN 'close' ELSE '' END AS bad_columns, CASE WHEN empty THEN 'symbol' ELSE '' END AS null_columns,
       CAST(coalesce(collapsed, 0) AS BIGINT) AS duplicates_collapsed, CAST(coalesce(removed, 0) AS BIGINT) AS duplicates_removed,
       coalesce(gaps, 0) AS gaps, coalesce(outliers, 0) AS outliers, coalesce(kept - outliers, 0) AS rows_clean
FROM gate LEFT JOIN dup USING (f) LEFT JOIN g USING (f) LEFT JOIN o USING (f)"""
