"""The same queries in plain SQL, written independently of the engine, for DuckDB."""

from __future__ import annotations

TODAY = "DATE '2001-11-10'"
POSITION = "row(l_orderkey, l_linenumber, l_partkey)"

BARS = f"""
bars AS MATERIALIZED (
  SELECT 'SRC' || CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
         arg_min(sqrt(l_extendedprice), {POSITION}) AS open,
         max(sqrt(l_extendedprice)) AS high, min(sqrt(l_extendedprice)) AS low,
         arg_max(sqrt(l_extendedprice), {POSITION}) AS close,
         CAST(sum(l_quantity) AS DOUBLE) AS volume
  FROM lineitem GROUP BY 1, 2)"""

DIRTY = """
dirty AS MATERIALIZED (
  SELECT 'SRC' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
         sqrt(l_extendedprice) AS open, sqrt(l_extendedprice) * (0.99 + l_tax / 2) AS high,
         sqrt(l_extendedprice) * (1 - l_tax) AS low, sqrt(l_extendedprice) * (1 - l_discount) AS close,
         CAST(l_quantity AS DOUBLE) AS volume, l_orderkey, l_linenumber, l_partkey
  FROM lineitem)"""

INVALID = "(high < low OR high < open OR high < close OR low > open OR low > close)"

NEWS = """
news AS MATERIALIZED (
  SELECT doc_id, source AS ticker, DATE '1995-01-02' + CAST(doc_id % 2400 AS INTEGER) AS query_date,
         split_part(text, chr(10), 1) AS title,
         CASE WHEN doc_id % 11 <> 0 THEN text END AS text,
         CASE WHEN doc_id % 17 <> 0 THEN 'http://n/' || md5(text) END AS url
  FROM documents)"""

ARTICLES = (
    NEWS
    + """,
articles AS MATERIALIZED (
  SELECT doc_id, upper(ticker) AS ticker, query_date AS date_key, title, text, url,
         CASE WHEN text IS NOT NULL AND trim(text) <> '' THEN title || ' ' || text ELSE title END AS sentiment_text
  FROM news
  WHERE ticker IS NOT NULL AND query_date IS NOT NULL AND title IS NOT NULL AND trim(title) <> '')"""
)

LEXICON = """
lexicon AS (SELECT * FROM (VALUES ('the', 0.5), ('and', -0.3), ('of', 1.2), ('is', -1.1), ('that', 0.8)) AS v(word, valence)),
tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(sentiment_text), '[a-z]+')) AS word FROM articles),
sums AS (
  SELECT t.doc_id, sum(CAST(coalesce(valence, 0) AS DOUBLE)) AS total,
         sum(CASE WHEN valence > 0 THEN valence + 1 ELSE 0 END) AS up,
         sum(CASE WHEN valence < 0 THEN 1 - valence ELSE 0 END) AS down,
         count(*) FILTER (WHERE coalesce(valence, 0) = 0) AS flat
  FROM tokens t LEFT JOIN lexicon USING (word) GROUP BY t.doc_id),
words AS (
  SELECT a.doc_id,
         CASE WHEN sentiment_text <> '' THEN coalesce(total / sqrt(total * total + 15), 0) END AS vader_compound,
         CASE WHEN sentiment_text <> '' THEN coalesce(up / nullif(up + down + flat, 0), 0) END AS vader_pos,
         CASE WHEN sentiment_text <> '' THEN coalesce(flat / nullif(up + down + flat, 0), 0) END AS vader_neu,
         CASE WHEN sentiment_text <> '' THEN coalesce(down / nullif(up + down + flat, 0), 0) END AS vader_neg
  FROM articles a LEFT JOIN sums USING (doc_id))"""


def _emphatic() -> str:
    """Each word with the three before it; a value is shifted by one after the other."""
    around = ", ".join(f"lag({c}, {k}) OVER o AS {c}{k}" for k in (1, 2, 3) for c in ("valence", "boost", "caps", "negates"))
    steps, value = [], "v0"
    for k, near in ((1, 1.0), (2, 0.95), (3, 0.9)):
        push = f"CASE WHEN boost{k} <> 0 THEN (boost{k} + caps{k}) * {near} ELSE 0 END"
        turned = f"({value} + sign({value}) * {push}) * CASE WHEN negates{k} THEN -0.74::DOUBLE ELSE 1 END"
        known = f"valence{k} IS NOT NULL OR boost{k} IS NULL"
        steps.append(f"s{k} AS (SELECT *, CASE WHEN {known} THEN {value} ELSE {turned} END AS v{k} FROM {f's{k - 1}' if k > 1 else 'starts'})")
        value = f"v{k}"
    return f"""
WITH lexicon AS (SELECT * FROM (VALUES ('the', 0.5::DOUBLE), ('and', -0.3), ('of', 1.2), ('is', -1.1), ('that', 0.8)) AS v(word, valence)),
shifters AS (SELECT * FROM (VALUES ('to', 'booster', 0.293::DOUBLE), ('on', 'booster', -0.293), ('in', 'negation', 0), ('that', 'negation', 0), ('with', 'contrast', 0)) AS v(word, kind, amount)),
texts AS (
  SELECT doc_id, CASE WHEN doc_id % 13 <> 0 THEN translate(split_part(text, chr(10), 1), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') || ' ' || text || ' ' || repeat('!', CAST(doc_id % 6 AS INTEGER)) || repeat('?', CAST(doc_id % 5 AS INTEGER)) END AS t
  FROM documents),
lists AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+(?:''[A-Za-z]+)?') AS l FROM texts),
places AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM lists WHERE t IS NOT NULL),
words AS (
  SELECT p.doc_id, i, l[i] AS w, x.valence, coalesce(s.amount, 0) AS boost, coalesce(s.kind = 'negation', false) AS negates, coalesce(s.kind = 'contrast', false) AS contrasts,
         CASE WHEN l[i] = upper(l[i]) AND count(*) FILTER (WHERE l[i] <> upper(l[i])) OVER (PARTITION BY p.doc_id) > 0 THEN 0.733::DOUBLE ELSE 0 END AS caps
  FROM places p LEFT JOIN lexicon x ON x.word = lower(l[i]) LEFT JOIN shifters s ON s.word = lower(l[i])),
starts AS (
  SELECT *, coalesce(valence + sign(valence) * caps, 0) AS v0, min(CASE WHEN contrasts THEN i END) OVER (PARTITION BY doc_id) AS turn, {around}
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
{", ".join(steps)},
weighed AS (SELECT doc_id, i, {value} * CASE WHEN i < turn THEN 0.5::DOUBLE WHEN i > turn THEN 1.5 ELSE 1 END AS v FROM s3),
sums AS (
  SELECT doc_id, sum(v ORDER BY i) AS total, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END ORDER BY i) AS up, sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END ORDER BY i) AS down,
         count(*) FILTER (WHERE v = 0) AS flat
  FROM weighed GROUP BY doc_id),
stress AS (
  SELECT l.doc_id, t, coalesce(total, 0) AS total, coalesce(up, 0) AS up, coalesce(down, 0) AS down, coalesce(flat, 0) AS flat,
         least(len(t) - len(replace(t, '!', '')), 4) * 0.292::DOUBLE + CASE WHEN len(t) - len(replace(t, '?', '')) > 3 THEN 0.96 WHEN len(t) - len(replace(t, '?', '')) > 1 THEN (len(t) - len(replace(t, '?', ''))) * 0.18 ELSE 0 END AS e
  FROM lists l LEFT JOIN sums s ON s.doc_id = l.doc_id),
final AS (SELECT doc_id, t, flat, total + sign(total) * e AS total, up + CASE WHEN up > down THEN e ELSE 0 END AS up, down + CASE WHEN down > up THEN e ELSE 0 END AS down FROM stress)
SELECT doc_id, CASE WHEN t <> '' THEN round(total / sqrt(total * total + 15), 8) END AS vader_compound, CASE WHEN t <> '' THEN round(coalesce(up / nullif(up + down + flat, 0), 0), 8) END AS vader_pos,
       CASE WHEN t <> '' THEN round(coalesce(flat / nullif(up + down + flat, 0), 0), 8) END AS vader_neu, CASE WHEN t <> '' THEN round(coalesce(down / nullif(up + down + flat, 0), 0), 8) END AS vader_neg
FROM final"""


EMPHATIC = _emphatic()


def _share(letter: str) -> str:
    n = "length(sentiment_text)"
    return f"exp(10.0 * ({n} - length(replace(sentiment_text, '{letter}', ''))) / {n})"


MODEL = f"""
letters AS (
  SELECT doc_id, {_share('e')} AS pos, {_share('a')} AS neg, {_share('o')} AS neu FROM articles WHERE sentiment_text <> ''),
model AS (
  SELECT doc_id, (pos - neg) / (pos + neg + neu) AS finbert_score,
         CASE WHEN pos >= neg AND pos >= neu THEN 'positive' WHEN neg >= neu THEN 'negative' ELSE 'neutral' END AS finbert_label
  FROM letters)"""

SCORED = f"{ARTICLES}, {LEXICON}, {MODEL}"

VECTORS = """
logits AS (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 5 AS a, CAST(embedding[2] AS DOUBLE) * 5 AS b, CAST(embedding[3] AS DOUBLE) * 5 AS c
  FROM embeddings),
probs AS (
  SELECT vec_id, exp(a) / (exp(a) + exp(b) + exp(c)) AS p, exp(b) / (exp(a) + exp(b) + exp(c)) AS n,
         CASE WHEN a >= b AND a >= c THEN 'positive' WHEN b >= c THEN 'negative' ELSE 'neutral' END AS finbert_label
  FROM logits)"""

# Features ---------------------------------------------------------------------------------------------

FRAMES = ", ".join(
    f"w{n} AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    for n in (5, 9, 10, 14, 20, 50, 60)
)
WINDOWS = (
    "WINDOW w AS (PARTITION BY ticker ORDER BY date), "
    "wc AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), " + FRAMES
)

FEATURES = f"""
step1 AS (
  SELECT *, lag(close) OVER w AS prev_close, lag(open) OVER w AS prev_open,
         lag(close, 5) OVER w AS close_5, lag(close, 20) OVER w AS close_20,
         avg(close) OVER w5 AS sma_5, avg(close) OVER w10 AS sma_10, avg(close) OVER w20 AS sma_20, avg(close) OVER w50 AS sma_50,
         avg(volume) OVER w5 AS volume_sma_5, avg(volume) OVER w10 AS volume_sma_10, avg(volume) OVER w20 AS volume_sma_20,
         sum(close * volume) OVER wc / nullif(sum(volume) OVER wc, 0) AS vwap_cumulative,
         sum(close * volume) OVER w20 / nullif(sum(volume) OVER w20, 0) AS vwap_20d,
         avg(close) OVER w20 AS bb_middle, stddev_samp(close) OVER w20 AS bb_std,
         max(close) OVER wc AS running_max,
         min(low) OVER w20 AS support_20d, max(high) OVER w20 AS resistance_20d,
         min(low) OVER w50 AS support_50d, max(high) OVER w50 AS resistance_50d,
         row_number() OVER w AS rn
  FROM bars {WINDOWS}),
step2 AS (
  SELECT *, close - prev_close AS price_change,
         CASE WHEN prev_close <> 0 THEN (close - prev_close) / prev_close * 100 END AS price_change_pct,
         CASE WHEN prev_close > 0 AND close > 0 THEN ln(close / prev_close) END AS log_return,
         CASE WHEN close > prev_close THEN close - prev_close ELSE 0 END AS gain,
         CASE WHEN close < prev_close THEN prev_close - close ELSE 0 END AS loss,
         high - low AS daily_range, (high - low) / nullif(close, 0) * 100 AS daily_range_pct,
         volume / nullif(volume_sma_20, 0) AS volume_ratio,
         close - close_5 AS momentum_5d, (close - close_5) / nullif(close_5, 0) * 100 AS momentum_5d_pct,
         close - close_20 AS momentum_20d, (close - close_20) / nullif(close_20, 0) * 100 AS momentum_20d_pct,
         bb_middle + 2 * bb_std AS bb_upper, bb_middle - 2 * bb_std AS bb_lower,
         (close - running_max) / nullif(running_max, 0) AS drawdown,
         (close - running_max) / nullif(running_max, 0) * 100 AS drawdown_pct,
         CASE WHEN abs(open - close) / nullif(close, 0) < 0.001 THEN 1 ELSE 0 END AS is_doji,
         CASE WHEN (CASE WHEN open > close THEN open - low ELSE close - low END) > 2 * abs(close - open)
               AND (CASE WHEN open > close THEN high - open ELSE high - close END) < 0.5 * abs(close - open)
              THEN 1 ELSE 0 END AS is_hammer,
         CASE WHEN prev_close < prev_open AND close > open AND open < prev_close AND close > prev_open THEN 1 ELSE 0 END AS is_bullish_engulfing,
         CASE WHEN prev_close > prev_open AND close < open AND open > prev_close AND close < prev_open THEN 1 ELSE 0 END AS is_bearish_engulfing,
         CASE WHEN high <> low THEN (close - low) / (high - low) ELSE 0.5 END AS price_position,
         (close - support_20d) / nullif(close, 0) * 100 AS distance_to_support_20d,
         (resistance_20d - close) / nullif(close, 0) * 100 AS distance_to_resistance_20d,
         (close - support_50d) / nullif(close, 0) * 100 AS distance_to_support_50d,
         (resistance_50d - close) / nullif(close, 0) * 100 AS distance_to_resistance_50d
  FROM step1),
feat AS (
  SELECT *, bb_upper - bb_lower AS bb_width,
         CASE WHEN bb_upper <> bb_lower THEN (close - bb_lower) / (bb_upper - bb_lower) END AS bb_percent_b,
         stddev_samp(price_change_pct) OVER w5 AS volatility_5d, stddev_samp(price_change_pct) OVER w10 AS volatility_10d,
         stddev_samp(price_change_pct) OVER w20 AS volatility_20d,
         sum(log_return) OVER wc AS cumulative_return,
         avg(log_return) OVER w20 / nullif(stddev_samp(log_return) OVER w20, 0) * sqrt(252) AS sharpe_ratio_20d,
         avg(log_return) OVER w60 / nullif(stddev_samp(log_return) OVER w60, 0) * sqrt(252) AS sharpe_ratio_60d,
         avg(gain) OVER w14 AS gain_mean, avg(loss) OVER w14 AS loss_mean
  FROM step2 {WINDOWS})"""

EMA_DAYS = (5, 9, 10, 12, 20, 26, 50)


def _recursion() -> str:
    """Every recurrence of the feature set, one row number at a time."""
    first = ", ".join(f"close AS ema_{n}" for n in EMA_DAYS)
    then = ", ".join(f"s.close * {2 / (n + 1)!r} + r.ema_{n} * (1 - {2 / (n + 1)!r})" for n in EMA_DAYS)
    wilder = ", ".join(f"CASE WHEN s.rn <= 14 THEN s.{x}_mean ELSE (r.{x}_avg * 13 + s.{x}) / 14 END" for x in ("gain", "loss"))
    return f"""
series AS MATERIALIZED (SELECT ticker, date, rn, close, gain, loss, gain_mean, loss_mean FROM feat),
rec AS (
  SELECT ticker, date, rn, {first}, gain_mean AS gain_avg, loss_mean AS loss_avg FROM series WHERE rn = 1
  UNION ALL
  SELECT s.ticker, s.date, s.rn, {then}, {wilder}
  FROM rec r JOIN series s ON s.ticker = r.ticker AND s.rn = r.rn + 1),
averaged AS (
  SELECT *, ema_12 - ema_26 AS macd,
         avg(ema_12 - ema_26) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 8 PRECEDING AND CURRENT ROW) AS macd_signal,
         CASE WHEN loss_avg <> 0 THEN 100 - 100 / (1 + gain_avg / loss_avg) END AS rsi_14
  FROM rec)"""


RECURSION = _recursion()


def _round(columns: str, prefix: str = "", places: int = 4) -> str:
    return ", ".join(f"round({prefix}{c}, {places}) AS {c}" for c in columns.split())


def _feature_sql(columns: str, flags: str = "", places: int = 4) -> str:
    plain = "".join(f", {c}" for c in flags.split())
    return f"WITH {BARS}, {FEATURES} SELECT ticker, date, {_round(columns, places=places)}{plain} FROM feat"


def _average_sql(columns: str) -> str:
    return f"WITH RECURSIVE {BARS}, {FEATURES}, {RECURSION} SELECT ticker, date, {_round(columns)} FROM averaged"


# The columns of the Silver price table, as SQL lists them.
PRICE_NUMBERS = """
    open high low close volume prev_close price_change price_change_pct sma_5 sma_10 sma_20 sma_50
    daily_range daily_range_pct volatility_5d volatility_10d volatility_20d
    volume_sma_5 volume_sma_10 volume_sma_20 volume_ratio vwap_cumulative vwap_20d
    momentum_5d momentum_5d_pct momentum_20d momentum_20d_pct
    bb_middle bb_upper bb_lower bb_width bb_percent_b log_return cumulative_return
    sharpe_ratio_20d sharpe_ratio_60d drawdown drawdown_pct price_position
    support_20d resistance_20d distance_to_support_20d distance_to_resistance_20d
    support_50d resistance_50d distance_to_support_50d distance_to_resistance_50d
"""
FLAGS = "is_doji is_hammer is_bullish_engulfing is_bearish_engulfing"
AVERAGES = "ema_5 ema_10 ema_20 ema_50 rsi_14 macd macd_signal"

CLEAN_BARS = f"""
single AS (
  SELECT symbol AS ticker, date, open, close, volume,
         CASE WHEN {INVALID} THEN greatest(high, open, close, low) ELSE high END AS high,
         CASE WHEN {INVALID} THEN least(low, open, close, greatest(high, open, close, low)) ELSE low END AS low
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey, l_linenumber, l_partkey) AS k FROM dirty)
  WHERE k = 1),
bars AS MATERIALIZED (
  SELECT * FROM single WHERE ticker IN (SELECT ticker FROM single GROUP BY ticker HAVING count(date) >= 530))"""

EVENT_BARS = """
event_bars AS (
  SELECT event_type AS ticker, CAST(ts AS DATE) AS date, value - 5 AS open, value AS high, value - 5 AS low,
         CASE WHEN user_id % 50 <> 0 THEN value - 5 END AS close, CAST(floor(value - 1) AS BIGINT) AS volume
  FROM events)"""

# Checks -----------------------------------------------------------------------------------------------


def _check(check: str, item: str, failures: str, critical: bool, table: str, share: bool = True, detail: str = "SELECT CAST(NULL AS VARCHAR)") -> str:
    percentage = "coalesce(round(f * 100.0 / nullif(n, 0), 4), 0)" if share else "CAST(NULL AS DOUBLE)"
    rows = f"(SELECT count(*) FROM {table})" if share else "0"
    return (
        f"SELECT '{check}' AS \"check\", '{item}' AS item, CAST(f AS BIGINT) AS failures, {percentage} AS percentage, "
        f"{str(critical).lower()} AS critical, f = 0 AS passed, detail FROM (SELECT ({failures}) AS f, {rows} AS n, ({detail}) AS detail)"
    )


def _type_check(column: str, want: str, found: str, failures: int = 0) -> str:
    return _check("column_types", column, str(failures), False, "", share=False, detail=f"SELECT 'expected {want}, found {found}'")


def _span(table: str, date: str) -> str:
    return (
        f"SELECT CAST(min({date}) AS VARCHAR) || ' to ' || CAST(max({date}) AS VARCHAR) || ', ' || count(DISTINCT {date}) || ' days' FROM {table}"
    )


def _groups(table: str, keys: str) -> str:
    return (
        f"SELECT count(*) || ' groups, at most ' || coalesce(max(n), 0) || ' rows, ' || "
        f"CAST(round(coalesce(avg(n), 0), 1) AS DECIMAL(20,1)) || ' on average' FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys} HAVING count(*) > 1)"
    )


def _longest(table: str, ticker: str, date: str) -> str:
    return f"SELECT 'longest ' || coalesce(max(gap_days), 0) || ' days' FROM ({_gaps(table, ticker, date, 0)})"


def _count(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def _duplicates(table: str, keys: str) -> str:
    return f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


def _gaps(table: str, ticker: str, date: str, days: int) -> str:
    return (
        f"SELECT ticker, gap_start, gap_end, CAST(date_diff('day', gap_start, gap_end) AS INTEGER) AS gap_days FROM ("
        f"SELECT ticker, d AS gap_end, lag(d) OVER (PARTITION BY ticker ORDER BY d) AS gap_start "
        f"FROM (SELECT DISTINCT {ticker} AS ticker, {date} AS d FROM {table}) WHERE d IS NOT NULL) "
        f"WHERE date_diff('day', gap_start, gap_end) > {days}"
    )


def _listed(check: str, item: str, failures: str, detail: str, source: str) -> str:
    """Rows of a list: ``source`` is a query with the rank of each row."""
    return (
        f"SELECT '{check}' AS \"check\", CAST({item} AS VARCHAR) AS item, CAST({failures} AS BIGINT) AS failures, CAST(NULL AS DOUBLE) AS percentage, "
        f"false AS critical, {failures} = 0 AS passed, {detail} AS detail FROM ({source})"
    )


def _gap_list(table: str, ticker: str, date: str) -> str:
    ranked = f"SELECT *, row_number() OVER (ORDER BY gap_days DESC, ticker, gap_start) AS k FROM ({_gaps(table, ticker, date, 7)}) QUALIFY k <= 5"
    return _listed("longest_gap", "k", "gap_days", "ticker || ' ' || gap_start || ' to ' || gap_end", ranked)


def _summary(table: str, ticker: str, date: str, rows: str) -> list[str]:
    values = {
        "unique_tickers": f"count(DISTINCT {ticker})",
        "unique_dates": f"count(DISTINCT {date})",
        rows: f"CAST(round(count(*) / count(DISTINCT {ticker}), 1) AS DECIMAL(20,1))",
        "date_range_days": f"date_diff('day', min({date}), max({date}))",
    }
    return [_listed("summary", f"'{name}'", "0", "CAST(v AS VARCHAR)", f"SELECT {value} AS v FROM {table}") for name, value in values.items()]


BROKEN = " || ".join(
    f"CASE WHEN {rule} THEN ', {rule}' ELSE '' END" for rule in ("high < low", "high < open", "high < close", "low > open", "low > close")
)


def _price_lists(table: str, ticker: str) -> list[str]:
    days = f"SELECT {ticker} AS t, date, count(*) AS n FROM {table} GROUP BY ALL HAVING n > 1 AND t IS NOT NULL AND date IS NOT NULL"
    repeated = f"SELECT *, row_number() OVER (ORDER BY t, date) AS k FROM ({days}) QUALIFY k <= 5"
    first = f"SELECT {ticker} AS t, * FROM {table} WHERE {INVALID} QUALIFY row_number() OVER (PARTITION BY {ticker}, date ORDER BY open, high, low, close) = 1"
    broken = f"SELECT *, {BROKEN} AS labels, row_number() OVER (ORDER BY t, date) AS k FROM ({first}) QUALIFY k <= 5"
    prices = " || ' ' || ".join(f"'{c} ' || CAST(round({c}, 4) AS DECIMAL(28,4))" for c in ("open", "high", "low", "close"))
    return [
        _listed("repeated_day", "k", "n", "t || ' ' || date", repeated),
        _listed("broken_row", "k", "len(labels) - len(replace(labels, ',', ''))", f"t || ' ' || date || ' ' || {prices} || ': ' || substr(labels, 3)", broken),
    ]


def _price_report(table: str, ticker: str) -> str:
    parts = [_check("null_dates", "date", _count(table, "date IS NULL"), True, table, detail=_span(table, "date"))]
    parts += [_check("prices_positive", c, _count(table, f"{c} <= 0"), True, table) for c in ("open", "high", "low", "close")]
    parts += [
        _check("volume_non_negative", "volume", _count(table, "volume < 0"), True, table),
        _check("ohlc_order", "all", _count(table, INVALID), True, table),
    ]
    parts += [_type_check("ticker", "string", "string"), _type_check("date", "date", "date")]
    parts += [_type_check(c, "floating", "double") for c in ("open", "high", "low", "close")]
    # Volume is fractional here, which the type check reports.
    parts += [
        _type_check("volume", "integer", "double", 1),
        _check("duplicates", "ticker,date", _duplicates(table, f"{ticker}, date"), True, table, False, _groups(table, f"{ticker}, date")),
        _check(
            "duplicates",
            "all_columns",
            f"SELECT count(*) FROM (SELECT count(*) AS n FROM {table} GROUP BY {ticker}, date, open, high, low, close, volume HAVING n > 1)",
            False,
            table,
            False,
            "SELECT 'groups of rows alike in prices and volume'",
        ),
        _check("date_gaps", "over_7_days", f"SELECT count(*) FROM ({_gaps(table, ticker, 'date', 7)})", False, table, False, _longest(table, ticker, "date")),
        _gap_list(table, ticker, "date"),
        *_price_lists(table, ticker),
        *_summary(table, ticker, "date", "records_per_ticker"),
    ]
    return " UNION ALL ".join(parts)


def _news_report() -> str:
    def gaps(days: int) -> str:
        return f"SELECT count(*) FROM ({_gaps('news', 'ticker', 'query_date', days)})"

    longest = _longest("news", "ticker", "query_date")
    parts = [
        _check("null_dates", "query_date", _count("news", "query_date IS NULL"), True, "news", detail=_span("news", "query_date")),
        _check("required_fields", "title", _count("news", "title IS NULL OR trim(title) = ''"), True, "news"),
        _check("required_fields", "ticker", _count("news", "ticker IS NULL"), True, "news"),
        _type_check("query_date", "date", "date"),
        *[_type_check(c, "string", "string") for c in ("ticker", "title", "text", "url")],
        _check("date_gaps", "over_1_day", gaps(1), False, "news", False, longest),
        _check("date_gaps", "over_7_days", gaps(7), False, "news", False, longest),
        *[
            _check("duplicates", f"ticker,query_date,{c}", _duplicates("news", f"ticker, query_date, {c}"), False, "news", False, _groups("news", f"ticker, query_date, {c}"))
            for c in ("url", "title")
        ],
        _gap_list("news", "ticker", "query_date"),
        *[
            _listed(
                f"repeated_{c}",
                "k",
                "n",
                f"ticker || ' ' || query_date || ' ' || CASE WHEN len({c}) > 100 THEN substr({c}, 1, 100) || '...' ELSE {c} END",
                f"SELECT *, row_number() OVER (ORDER BY ticker, query_date, {c}) AS k FROM (SELECT ticker, query_date, {c}, count(*) AS n FROM news "
                f"WHERE ticker IS NOT NULL AND query_date IS NOT NULL AND {c} IS NOT NULL GROUP BY ALL HAVING n > 1) QUALIFY k <= 5",
            )
            for c in ("url", "title")
        ],
        *_summary("news", "ticker", "query_date", "articles_per_ticker"),
    ]
    return " UNION ALL ".join(parts)


# Article selection ------------------------------------------------------------------------------------

LETTER = "chr(97 + CAST(substr(source, 4) AS INTEGER))"
TICKERS = f"""
tickers AS (
  SELECT DISTINCT 'E' || upper({LETTER}) AS ticker, 'o' || {LETTER} AS company_name,
         CASE WHEN CAST(substr(source, 4) AS INTEGER) % 3 <> 0 THEN 'u' || {LETTER} END AS abbrev1,
         CASE WHEN CAST(substr(source, 4) AS INTEGER) % 4 <> 0 THEN 'tion' END AS abbrev2
  FROM documents)"""

CANDIDATES = f"""
slots AS (
  SELECT *, doc_id // 400 AS day, doc_id % 10 - CASE WHEN (doc_id // 400) % 2 = 1 THEN 4 ELSE 0 END AS slot FROM documents),
candidates AS MATERIALIZED (
  SELECT 'E' || upper({LETTER}) AS ticker, DATE '1995-01-02' + CAST(day AS INTEGER) AS date,
         CASE WHEN slot < 3 OR slot = 8 THEN 'advanced' ELSE 'regular' END AS endpoint,
         CASE slot WHEN 5 THEN 'company_name' WHEN 6 THEN 'abbrev1' WHEN 7 THEN 'abbrev2' ELSE 'ticker' END AS term,
         CAST(CASE WHEN slot >= 8 THEN 2 + (doc_id // 10) % 2 ELSE 1 END AS INTEGER) AS page,
         doc_id AS rank, split_part(text, chr(10), 1) AS title, text,
         CASE WHEN doc_id % 17 <> 0 THEN 'http://n/' || CAST(doc_id % 350 AS VARCHAR) END AS url,
         doc_id % 37 = 0 AS failed
  FROM slots)"""

MATCHED = f"""
{TICKERS}, {CANDIDATES},
capitals AS (
  -- Upper case of the sharp s is SS, which upper() leaves out.
  SELECT c.*, t.company_name, t.abbrev1, t.abbrev2, upper(replace(title, 'ß', 'SS')) AS head, upper(replace(text, 'ß', 'SS')) AS body,
         CASE c.term WHEN 'company_name' THEN t.company_name WHEN 'abbrev1' THEN t.abbrev1 WHEN 'abbrev2' THEN t.abbrev2 ELSE c.ticker END AS searched
  FROM candidates c JOIN tickers t USING (ticker)),
matched AS MATERIALIZED (
  SELECT * EXCLUDE (head, body),
         coalesce(contains(head, upper(searched)) OR contains(body, upper(searched)), false)
            OR contains(head, ticker) OR contains(body, ticker) AS term_matched,
         contains(head, ticker) AND contains(body, ticker) AS ticker_in_both
  FROM capitals)"""


def _tier(k: int, condition: str, extra: str, due: str = "true") -> str:
    """Add the articles of one search to what is held, where the day still needs them."""
    held = f"held{k - 1}"
    return f"""
due{k} AS (SELECT d.ticker, d.date FROM days d LEFT JOIN {held} h USING (ticker, date)
           GROUP BY ALL HAVING count(h.rank) < 7),
new{k} AS (
  SELECT m.ticker, m.date, m.endpoint, m.term, m.page, m.rank, m.url, m.title, {k} AS tier FROM usable m
  SEMI JOIN due{k} USING (ticker, date)
  WHERE m.page = 1 AND {condition} AND {extra}
    AND NOT EXISTS (SELECT 1 FROM {held} h WHERE h.ticker = m.ticker AND h.date = m.date AND h.url = m.url AND h.url <> '')),
held{k} AS MATERIALIZED (SELECT * FROM {held} UNION ALL SELECT * FROM new{k})"""


CASCADE = f"""
WITH {MATCHED},
broken AS (
  SELECT ticker, date, endpoint, term, page FROM matched GROUP BY ALL HAVING bool_or(failed)),
days AS (SELECT DISTINCT ticker, date FROM matched),
stand_in AS (SELECT ticker, date FROM broken WHERE endpoint = 'advanced' AND term = 'ticker' AND page = 1),
usable AS MATERIALIZED (
  SELECT * FROM matched WHERE NOT failed AND coalesce(searched, '') <> ''),
held1 AS MATERIALIZED (
  SELECT ticker, date, endpoint, term, page, rank, url, title, 1 AS tier FROM usable m
  WHERE page = 1 AND term = 'ticker' AND CASE WHEN EXISTS (SELECT 1 FROM stand_in s WHERE s.ticker = m.ticker AND s.date = m.date)
        THEN endpoint = 'regular' AND ticker_in_both ELSE endpoint = 'advanced' END),
{_tier(2, "term = 'ticker' AND endpoint = 'regular'", '''term_matched AND NOT EXISTS (
    SELECT 1 FROM held1 h WHERE h.ticker = m.ticker AND h.date = m.date AND h.endpoint = 'regular')''')},
{_tier(3, "term = 'company_name' AND endpoint = 'regular'", "term_matched")},
{_tier(4, "term = 'abbrev1' AND endpoint = 'regular'", "term_matched")},
{_tier(5, "term = 'abbrev2' AND endpoint = 'regular'", "term_matched")},
state AS (
  SELECT ticker, date, count(h.rank) AS n, arg_max(h.endpoint, h.tier) AS endpoint,
         coalesce(bool_or(h.term = 'ticker'), false) AS t, coalesce(bool_or(h.term = 'company_name'), false) AS c,
         coalesce(bool_or(h.term = 'abbrev1'), false) AS a1, coalesce(bool_or(h.term = 'abbrev2'), false) AS a2
  FROM days LEFT JOIN held5 h USING (ticker, date) GROUP BY ticker, date),
pages AS (
  SELECT DISTINCT m.ticker, m.date, m.page FROM matched m JOIN state s USING (ticker, date)
  WHERE m.term = 'ticker' AND m.page > 1 AND m.endpoint = coalesce(s.endpoint, 'advanced')
    AND NOT EXISTS (SELECT 1 FROM broken b WHERE b.ticker = m.ticker AND b.date = m.date AND b.endpoint = m.endpoint AND b.term = 'ticker' AND b.page = m.page)),
run AS (
  SELECT ticker, date, page FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY page) AS k FROM pages) WHERE page = k + 1),
listed AS (
  SELECT h.*, s.n FROM held5 h JOIN state s USING (ticker, date)
  UNION ALL
  SELECT m.ticker, m.date, m.endpoint, m.term, m.page, m.rank, m.url, m.title, 5 + m.page, s.n
  FROM usable m JOIN run r ON r.ticker = m.ticker AND r.date = m.date AND r.page = m.page
  JOIN state s ON s.ticker = m.ticker AND s.date = m.date
  WHERE s.n < 10 AND m.term = 'ticker' AND m.endpoint = coalesce(s.endpoint, 'advanced') AND (m.endpoint = 'advanced' OR m.term_matched)),
by_url AS (
  SELECT *, trim(coalesce(title, '')) AS head, coalesce(url, '') <> '' AND
         row_number() OVER (PARTITION BY ticker, date, coalesce(url, '') ORDER BY tier, rank) = 1 AS fresh_url FROM listed),
by_title AS (
  SELECT *, row_number() OVER (PARTITION BY ticker, date, fresh_url, head ORDER BY tier, rank) AS title_no FROM by_url),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY tier, rank) AS position
  FROM by_title WHERE n >= 10 OR fresh_url OR (head <> '' AND title_no = 1))
SELECT k.ticker, k.date, CAST(k.position AS INTEGER) AS position, k.rank, k.term AS search_source,
       coalesce(s.endpoint, 'none') AS endpoint_used,
       coalesce(nullif(array_to_string(list_filter([
         CASE WHEN s.t THEN 'ticker:' || k.ticker END, CASE WHEN s.c THEN 'company:' || d.company_name END,
         CASE WHEN s.a1 THEN 'abbrev1:' || d.abbrev1 END, CASE WHEN s.a2 THEN 'abbrev2:' || d.abbrev2 END], lambda x: x IS NOT NULL), ', '), ''), 'ticker') AS search_terms_used,
       d.company_name
FROM kept k JOIN state s USING (ticker, date) JOIN tickers d USING (ticker) WHERE k.position <= 10"""

# Gold -------------------------------------------------------------------------------------------------

DAILY_NUMBERS = "avg_finbert_score avg_vader_compound"
DAILY = f"""
{SCORED},
daily AS MATERIALIZED (
  SELECT 'SRC' || CAST(doc_id % 20 + 1 AS VARCHAR) AS ticker, date_key, count(*) AS articles,
         avg(finbert_score) AS avg_finbert_score, avg(vader_compound) AS avg_vader_compound,
         count(*) FILTER (WHERE finbert_label = 'positive') AS positive_count,
         count(*) FILTER (WHERE finbert_label = 'negative') AS negative_count,
         count(*) FILTER (WHERE finbert_label = 'neutral') AS neutral_count
  FROM articles JOIN words USING (doc_id) LEFT JOIN model USING (doc_id) GROUP BY 1, 2)"""
COUNTS = "positive_count, negative_count, neutral_count"

RANGES = f"""
ranges AS (
  SELECT t.ticker, coalesce(o.last + 1, (SELECT max(date) FROM bars) + 1, {TODAY} - 365) AS start_date, {TODAY} AS end_date
  FROM (SELECT DISTINCT ticker FROM bars UNION SELECT DISTINCT 'NEW' || ticker FROM bars) t
  LEFT JOIN (SELECT ticker, max(date) AS last FROM bars GROUP BY ticker) o USING (ticker)
  WHERE coalesce(o.last + 1, (SELECT max(date) FROM bars) + 1, {TODAY} - 365) <= {TODAY})"""


def _mix(name: str) -> str:
    n = f"count(*) FILTER (WHERE source = '{name}')"
    return f"{n} AS {name}_count, round({n} * 100.0 / count(*), 4) AS {name}_pct"


def _silver_sql(bars: str, min_bars: int, more: str = "") -> str:
    """All columns of the Silver price table, and more."""
    return (
        f"WITH RECURSIVE {bars}, {FEATURES}, {RECURSION} SELECT f.ticker, f.date, f.date AS date_key, "
        f"{_round(PRICE_NUMBERS, 'f.')}, {', '.join('f.' + c for c in FLAGS.split())}, {_round(AVERAGES, 'a.')}, "
        f"round(a.macd - a.macd_signal, 4) AS macd_histogram{', ' + more if more else ''} "
        "FROM feat f JOIN averaged a ON a.ticker = f.ticker AND a.date = f.date "
        f"WHERE f.ticker IN (SELECT ticker FROM bars GROUP BY ticker HAVING count(date) >= {min_bars})"
    )


def _silver_news_sql(order: str) -> str:
    """The Silver news table, its first article of a key in the given order."""
    return (
        f"WITH {SCORED} SELECT ticker, CAST(NULL AS VARCHAR) AS company_name, date_key, CAST(NULL AS DATE) AS article_date, "
        "date_key AS query_date_parsed, title, text, url, CAST(NULL AS VARCHAR) AS search_source, CAST(NULL AS VARCHAR) AS endpoint_used, "
        f"{_round('finbert_score', places=8)}, finbert_label, {_round('vader_compound vader_pos vader_neu vader_neg', places=8)}, 'stock_news_api' AS data_source "
        "FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date_key, coalesce(url, '') = '', "
        f"CASE WHEN coalesce(url, '') = '' THEN title ELSE url END ORDER BY {order}) AS k FROM articles) a "
        "JOIN words USING (doc_id) LEFT JOIN model USING (doc_id) WHERE k = 1"
    )


ORACLE: dict[str, str] = {
    "price_change": _feature_sql("prev_close price_change price_change_pct"),
    "sma": _feature_sql("sma_5 sma_10 sma_20 sma_50"),
    "ema": _average_sql("ema_5 ema_10 ema_20 ema_50"),
    "volatility": _feature_sql("daily_range daily_range_pct volatility_5d volatility_10d volatility_20d"),
    "volume_vwap": _feature_sql("volume_sma_5 volume_sma_10 volume_sma_20 volume_ratio vwap_cumulative vwap_20d", places=8),
    "rsi": _average_sql("rsi_14"),
    "momentum": _feature_sql("momentum_5d momentum_5d_pct momentum_20d momentum_20d_pct"),
    "bollinger": _feature_sql("bb_middle bb_upper bb_lower bb_width bb_percent_b"),
    "macd": f"WITH RECURSIVE {BARS}, {FEATURES}, {RECURSION} SELECT ticker, date, {_round('macd macd_signal')}, "
    "round(macd - macd_signal, 4) AS macd_histogram FROM averaged",
    "returns_sharpe": _feature_sql("log_return cumulative_return sharpe_ratio_20d sharpe_ratio_60d"),
    "drawdown": _feature_sql("drawdown drawdown_pct"),
    "candle_patterns": _feature_sql("price_position", FLAGS),
    "support_resistance": _feature_sql(
        "support_20d resistance_20d distance_to_support_20d distance_to_resistance_20d "
        "support_50d resistance_50d distance_to_support_50d distance_to_resistance_50d"
    ),
    "completeness": f"WITH {DIRTY} SELECT symbol, count(date) AS record_count, min(date) AS min_date, max(date) AS max_date, "
    "count(DISTINCT date) AS unique_dates FROM dirty GROUP BY symbol",
    "date_range": f"WITH {DIRTY} SELECT min(date) AS min_date, max(date) AS max_date FROM dirty",
    "qualified_bars": f"WITH {BARS} SELECT ticker, date, {_round('open high low close volume')} FROM bars "
    "WHERE ticker IN (SELECT ticker FROM bars GROUP BY ticker HAVING count(date) >= 530)",
    "one_ticker": f"WITH {BARS}, {FEATURES} SELECT ticker, date, {_round('open high low close volume sma_5 sma_10 sma_20 sma_50')} "
    "FROM feat WHERE ticker = 'SRC7'",
    "sma_min_periods": f"WITH {BARS}, {FEATURES} SELECT ticker, date, CASE WHEN rn >= 5 THEN round(sma_5, 4) END AS sma_5, "
    "CASE WHEN rn >= 5 THEN round(sma_50, 4) END AS sma_50 FROM feat",
    "sorted_prices": f"WITH {BARS}, {FEATURES} SELECT ticker, date, {_round('close drawdown')} FROM feat ORDER BY ticker, date",
    "macd_ema_signal": f"""WITH RECURSIVE {BARS}, {FEATURES}, {RECURSION},
lines AS MATERIALIZED (SELECT ticker, date, rn, macd FROM averaged),
smooth AS (
  SELECT ticker, date, rn, macd, macd AS signal FROM lines WHERE rn = 1
  UNION ALL
  SELECT l.ticker, l.date, l.rn, l.macd, l.macd * 0.2 + s.signal * 0.8
  FROM smooth s JOIN lines l ON l.ticker = s.ticker AND l.rn = s.rn + 1)
SELECT ticker, date, round(macd, 4) AS macd, round(signal, 4) AS macd_signal, round(macd - signal, 4) AS macd_histogram FROM smooth""",
    "silver_prices": _silver_sql(BARS, 530),
    "refreshed_prices": _silver_sql(BARS, 530),
    "prices_from_states": _silver_sql(BARS, 530),
    "bars_of_loads": f"WITH {BARS} SELECT ticker AS symbol, date, round(CASE WHEN date >= DATE '1998-06-01' THEN 2 * close ELSE close END, 4) AS close FROM bars",
    "merged_fields": f"WITH {BARS} SELECT ticker, date, round(close, 4) AS close, "
    "CASE WHEN date >= DATE '1998-06-15' THEN round(volume, 4) END AS volume FROM bars",
    "silver_prices_of_all": _silver_sql(BARS, 1),
    "price_features_all": _silver_sql(BARS, 1, f"{_round('ema_9 ema_12 ema_26', 'a.')}, {_round('bb_std running_max', 'f.')}"),
    "raw_to_silver": _silver_sql(f"{DIRTY}, {CLEAN_BARS}", 1),
    "bars_dedup": f"WITH {DIRTY} SELECT symbol, date, {_round('open high low close volume')}, l_orderkey, l_linenumber, l_partkey FROM "
    "(SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY l_orderkey, l_linenumber, l_partkey) AS k FROM dirty) WHERE k = 1",
    "ohlc_violations": f"WITH {DIRTY} SELECT symbol, date, l_orderkey, l_linenumber, l_partkey, {_round('open high low close')}, "
    + ", ".join(
        f"CASE WHEN {a} {op} {b} THEN '{a} {op} {b}' ELSE '' END AS {a}_{word}_{b}"
        for a, op, b, word in (
            ("high", "<", "low", "below"),
            ("high", "<", "open", "below"),
            ("high", "<", "close", "below"),
            ("low", ">", "open", "above"),
            ("low", ">", "close", "above"),
        )
    )
    + f" FROM dirty WHERE {INVALID}",
    "ohlc_repair": f"WITH {DIRTY} SELECT symbol, date, l_orderkey, l_linenumber, l_partkey, {_round('open close')}, "
    f"round(CASE WHEN {INVALID} THEN greatest(high, open, close, low) ELSE high END, 4) AS high, "
    f"round(CASE WHEN {INVALID} THEN least(low, open, close, greatest(high, open, close, low)) ELSE low END, 4) AS low FROM dirty",
    "zero_negative": f"WITH {EVENT_BARS} SELECT count(*) AS records, "
    "count(*) FILTER (WHERE open < 0 OR high < 0 OR low < 0 OR close < 0) AS negative_prices, "
    + ", ".join(f"count(*) FILTER (WHERE {c} <= 0) AS non_positive_{c}" for c in ("open", "high", "low", "close"))
    + f", count(*) FILTER (WHERE {INVALID}) AS invalid_ohlc, count(*) FILTER (WHERE volume = 0) AS zero_volume, "
    "count(*) FILTER (WHERE volume < 0) AS negative_volume, "
    "count(*) FILTER (WHERE ticker IS NULL OR date IS NULL OR close IS NULL) AS null_critical FROM event_bars",
    "null_critical_rows": f"WITH {EVENT_BARS} SELECT ticker, date, round(open, 4) AS open FROM event_bars "
    "WHERE ticker IS NULL OR date IS NULL OR close IS NULL",
    "bars_in_range": f"WITH {BARS} SELECT ticker, date, round(close, 4) AS close FROM bars "
    "WHERE date BETWEEN DATE '1996-03-01' AND DATE '1996-04-15'",
    "bars_of_tickers": f"WITH {BARS} SELECT ticker, date, round(close, 4) AS close FROM bars WHERE ticker IN ('SRC1', 'SRC5', 'NONE')",
    "price_summary": f"WITH {BARS} SELECT count(*) AS total_records, count(DISTINCT ticker) AS unique_tickers, "
    "count(DISTINCT date) AS unique_dates, min(date) AS min_date, max(date) AS max_date, round(avg(close), 4) AS avg_close, "
    "round(avg(volume), 4) AS avg_volume FROM bars",
    "null_profile": f"WITH {NEWS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_percentage FROM news"
        for c in ("doc_id", "ticker", "query_date", "title", "text", "url")
    ),
    "unique_counts": f"WITH {NEWS} SELECT count(DISTINCT ticker) AS unique_ticker, count(DISTINCT query_date) AS unique_query_date, "
    "count(DISTINCT url) AS unique_url FROM news",
    "repeated_keys": f"WITH {DIRTY} SELECT symbol, date, count(*) AS rows FROM dirty GROUP BY symbol, date HAVING count(*) > 1",
    "repeated_url_count": f"WITH {NEWS} SELECT count(*) AS repeated_keys FROM (SELECT url FROM news GROUP BY url HAVING count(*) > 1)",
    "dup_profile": f"WITH {DIRTY} SELECT CAST(sum(n) AS BIGINT) AS duplicate_rows, count(*) AS duplicate_groups, "
    "round(avg(n), 4) AS avg_group_rows, max(n) AS max_group_rows FROM "
    "(SELECT count(*) AS n FROM dirty GROUP BY symbol, date HAVING count(*) > 1)",
    "dup_profile_null_keys": f"WITH {NEWS} SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows, count(*) FILTER (WHERE whole) AS duplicate_groups, "
    "coalesce(round(avg(n) FILTER (WHERE whole), 4), 0) AS avg_group_rows, coalesce(max(n) FILTER (WHERE whole), 0) AS max_group_rows FROM "
    "(SELECT count(*) AS n, ticker IS NOT NULL AND url IS NOT NULL AS whole FROM news GROUP BY ticker, url HAVING count(*) > 1)",
    "dup_sample": f"WITH {DIRTY} SELECT symbol, date, count(*) AS rows FROM dirty GROUP BY symbol, date HAVING count(*) > 1 "
    "ORDER BY symbol, date LIMIT 5",
    "exact_dups": f"WITH {DIRTY} SELECT symbol, date, {_round('open high low close volume')}, rows FROM (SELECT symbol, date, open, high, low, close, volume, "
    "CAST(sum(CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS rows FROM dirty GROUP BY ALL HAVING rows > 1)",
    "date_gaps": f"WITH {DIRTY} {_gaps('dirty', 'symbol', 'date', 7)}",
    "news_gaps": f"WITH {NEWS} {_gaps('news', 'ticker', 'query_date', 1)}",
    "price_report": f"WITH {DIRTY} {_price_report('dirty', 'symbol')}",
    "price_verdict": f"WITH {DIRTY}, {CLEAN_BARS.replace('>= 530', '>= 0')} SELECT CASE WHEN "
    "count(*) FILTER (WHERE date IS NULL OR open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 OR volume < 0 OR "
    f"{INVALID}) = 0 AND count(*) = count(DISTINCT (ticker, date)) THEN 'PASS' ELSE 'FAIL' END AS overall_status FROM bars",
    "news_report": f"WITH {NEWS} {_news_report()}",
    "news_verdict": f"WITH {NEWS} SELECT CASE WHEN count(*) FILTER (WHERE query_date IS NULL OR title IS NULL OR trim(title) = '' "
    "OR ticker IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status FROM news",
    "news_metrics": f"WITH {NEWS} SELECT count(*) FILTER (WHERE ticker IS NULL) AS null_ticker, "
    "count(*) FILTER (WHERE query_date IS NULL) AS null_date, count(*) FILTER (WHERE title IS NULL) AS null_title, "
    "count(*) FILTER (WHERE title IS NULL OR trim(title) = '') AS empty_title, "
    f"count(*) FILTER (WHERE query_date < {TODAY} - 730 OR query_date > {TODAY}) AS invalid_dates, "
    "(SELECT count(*) FROM (SELECT url FROM news GROUP BY url HAVING count(*) > 1)) AS duplicate_urls FROM news",
    "dataset_summary": f"WITH {DIRTY} SELECT count(DISTINCT symbol) AS unique_tickers, count(DISTINCT date) AS unique_dates, "
    "round(count(*) / count(DISTINCT symbol), 4) AS records_per_ticker FROM dirty",
    "news_valid": f"WITH {NEWS} SELECT doc_id, ticker, query_date, title FROM news "
    "WHERE ticker IS NOT NULL AND query_date IS NOT NULL AND title IS NOT NULL AND trim(title) <> ''",
    "news_clean": f"WITH {NEWS} SELECT doc_id, "
    + ", ".join(
        f"coalesce(trim(lower(regexp_replace({c}, '[^\\w\\s]', '', 'g'))), '') AS {c}_clean" for c in ("title", "text")
    )
    + " FROM news",
    "sentiment_text": f"WITH {ARTICLES} SELECT doc_id, ticker, date_key, sentiment_text FROM articles",
    "article_dedup": f"WITH {NEWS} SELECT doc_id, ticker, query_date, url FROM (SELECT *, row_number() OVER (PARTITION BY ticker, query_date, "
    "coalesce(url, '') = '', CASE WHEN coalesce(url, '') = '' THEN title ELSE url END ORDER BY doc_id) AS k FROM news) WHERE k = 1",
    "article_dedup_quirk": f"WITH {NEWS}, by_url AS (SELECT *, coalesce(url, '') <> '' AND row_number() OVER "
    "(PARTITION BY ticker, coalesce(url, '') ORDER BY doc_id) = 1 AS fresh_url FROM news), by_title AS (SELECT *, row_number() OVER "
    "(PARTITION BY ticker, fresh_url, trim(title) ORDER BY doc_id) AS k FROM by_url) "
    "SELECT doc_id, ticker, title, url FROM by_title WHERE fresh_url OR (k = 1 AND trim(coalesce(title, '')) <> '')",
    "lexicon_sentiment": f"WITH {ARTICLES}, {LEXICON} SELECT doc_id, {_round('vader_compound vader_pos vader_neu vader_neg', places=8)} FROM words",
    "emphatic_sentiment": EMPHATIC,
    "chart_outcomes": f"WITH {BARS}, answers AS (SELECT DISTINCT ticker, year(date) AS y FROM bars), kinds AS "
    "(SELECT (CAST(substr(ticker, 4) AS INTEGER) + y) % 7 AS k FROM answers) SELECT outcome, count(*) AS answers FROM (SELECT CASE k "
    "WHEN 0 THEN 'broken' WHEN 1 THEN 'empty' WHEN 2 THEN 'no result: Not Found' WHEN 3 THEN 'no result' WHEN 4 THEN 'broken' ELSE 'read' END "
    "AS outcome FROM kinds) GROUP BY outcome",
    "refused_news": "SELECT doc_id, CASE WHEN doc_id % 7 = 1 THEN 'broken' WHEN doc_id % 7 = 2 THEN 'empty' ELSE 'no result: none' END AS outcome "
    "FROM documents WHERE doc_id % 7 IN (1, 2) OR doc_id % 13 = 0",
    "article_dates": "SELECT doc_id, CASE doc_id % 6 WHEN 5 THEN NULL WHEN 1 THEN d + 1 WHEN 4 THEN d + 1 ELSE d END AS day, doc_id % 6 = 5 AS unread "
    "FROM (SELECT doc_id, DATE '1995-01-02' + CAST(doc_id % 2400 AS INTEGER) AS d FROM documents)",
    "trading_days": f"WITH {BARS}, {NEWS}, a AS (SELECT doc_id, 'SRC' || (doc_id % 20 + 1) AS ticker, query_date FROM news) "
    "SELECT doc_id, a.ticker, coalesce((SELECT min(date) FROM bars b WHERE b.ticker = a.ticker AND b.date >= a.query_date), query_date) AS date_key, "
    "query_date AS article_day FROM a",
    "prob_sentiment": f"WITH {VECTORS} SELECT vec_id, round(p - n, 4) AS finbert_score, finbert_label FROM probs",
    "model_sentiment": f"WITH {ARTICLES}, {MODEL} SELECT doc_id, round(finbert_score, 4) AS finbert_score, finbert_label "
    "FROM articles LEFT JOIN model USING (doc_id)",
    "silver_news": _silver_news_sql("doc_id"),
    "merged_news": _silver_news_sql("doc_id % 3 <> 0, doc_id"),
    "attached_scores": f"WITH {ARTICLES} SELECT a.doc_id, a.ticker, a.date_key, a.url, CAST(s.title_length AS INTEGER) AS title_length FROM articles a LEFT JOIN "
    "(SELECT ticker, date_key, url, min(length(title)) AS title_length FROM articles GROUP BY 1, 2, 3) s "
    "ON s.ticker = a.ticker AND s.date_key = a.date_key AND s.url = a.url",
    "label_distribution": f"WITH {SCORED} SELECT finbert_label, count(*) AS articles, "
    "round(count(*) * 100.0 / (SELECT count(*) FROM model), 4) AS percentage FROM model GROUP BY finbert_label",
    "text_length_stats": f"WITH {ARTICLES}, sizes AS (SELECT length(sentiment_text) AS n FROM articles) SELECT count(*) AS count, round(avg(n), 4) AS mean, "
    "round(stddev_samp(n), 4) AS std, CAST(min(n) AS INTEGER) AS min, quantile_cont(n, 0.25) AS q25, quantile_cont(n, 0.5) AS median, "
    "quantile_cont(n, 0.75) AS q75, CAST(max(n) AS INTEGER) AS max FROM sizes",
    "articles_per_ticker": f"WITH {NEWS} SELECT ticker, count(*) AS articles FROM news GROUP BY ticker",
    "article_totals": f"WITH {NEWS} SELECT count(*) AS total_articles, count(DISTINCT ticker) AS unique_tickers, "
    "round(count(*) / count(DISTINCT ticker), 4) AS articles_per_ticker FROM news",
    "news_summary": f"WITH {SCORED} SELECT count(*) AS total_articles, count(DISTINCT ticker) AS unique_tickers, "
    "count(DISTINCT date_key) AS unique_dates, round(avg(finbert_score), 4) AS avg_finbert_score, "
    "round(avg(vader_compound), 4) AS avg_vader_compound, "
    + ", ".join(f"count(*) FILTER (WHERE finbert_label = '{x}') AS {x}_count" for x in ("positive", "negative", "neutral"))
    + " FROM articles JOIN words USING (doc_id) LEFT JOIN model USING (doc_id)",
    "term_match": f"WITH {MATCHED} SELECT rank, ticker, term, term_matched, ticker_in_both FROM matched",
    "candidate_cascade": CASCADE,
    "top_articles": f"WITH {CANDIDATES} SELECT ticker, date, rank, title, CAST(k AS INTEGER) AS position FROM "
    "(SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY rank) AS k FROM candidates) WHERE k <= 10",
    "search_source_mix": f"WITH {CANDIDATES}, found AS (SELECT ticker, CASE WHEN rank % 5 <> 0 THEN term ELSE 'ticker' END AS source FROM candidates) "
    f"SELECT ticker, count(*) AS articles, {', '.join(_mix(x) for x in ('ticker', 'company_name', 'abbrev1', 'abbrev2'))} FROM found GROUP BY ticker",
    "company_names": f"WITH {TICKERS}, {CANDIDATES} SELECT rank, ticker, company_name, abbrev1, abbrev2 FROM candidates JOIN tickers USING (ticker)",
    "incremental_ranges": f"WITH {BARS} SELECT max(date) + 1 AS start_date, {TODAY} AS end_date FROM bars HAVING max(date) + 1 <= {TODAY}",
    "first_load_range": f"WITH {BARS} SELECT coalesce(max(date) + 1, {TODAY} - 365) AS start_date, {TODAY} AS end_date FROM bars WHERE close < 0",
    "ticker_ranges": f"WITH {BARS}, {RANGES} SELECT * FROM ranges",
    "day_spine": f"WITH {BARS}, {RANGES} SELECT ticker, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date FROM ranges",
    "missing_days": f"WITH {BARS}, spine AS (SELECT ticker, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM "
    "(SELECT ticker, min(date) AS lo, max(date) AS hi FROM bars GROUP BY ticker)) "
    "SELECT ticker, date FROM spine ANTI JOIN bars USING (ticker, date)",
    "chart_json_bars": f"WITH {BARS} SELECT ticker AS symbol, date, "
    "CASE WHEN row_number() OVER (PARTITION BY ticker, year(date) ORDER BY date DESC) > 1 THEN round(open, 4) END AS open, "
    "round(high, 4) AS high, round(low, 4) AS low, round(close, 4) AS close, CAST(volume AS BIGINT) AS volume FROM bars",
    "news_json": "SELECT doc_id, split_part(text, chr(10), 1) AS title, text, '2024-01-02' AS date, 'http://n/' || md5(text) AS url, source "
    "FROM documents WHERE doc_id % 13 <> 0",
    "union_of_sources": "SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS size, CAST(NULL AS VARCHAR) AS url FROM documents "
    "UNION ALL SELECT page_id, NULL, NULL, url FROM pages",
    "daily_sentiment": f"WITH {DAILY} SELECT ticker, date_key, articles, {_round(DAILY_NUMBERS)}, {COUNTS} FROM daily",
    "sentiment_price": f"WITH {BARS}, {FEATURES}, {DAILY} SELECT f.ticker, f.date AS date_key, {_round('close prev_close price_change price_change_pct', 'f.')}, "
    f"coalesce(articles, 0) AS articles, {_round(DAILY_NUMBERS)}, {COUNTS} "
    "FROM feat f LEFT JOIN daily d ON d.ticker = f.ticker AND d.date_key = f.date",
    "sentiment_price_corr": f"WITH {BARS}, {FEATURES}, {DAILY} SELECT f.ticker, count(*) AS days, "
    "round(covar_pop(avg_vader_compound, price_change_pct) / nullif(stddev_pop(avg_vader_compound) * stddev_pop(price_change_pct), 0), 4) AS correlation "
    "FROM feat f JOIN daily d ON d.ticker = f.ticker AND d.date_key = f.date "
    "WHERE avg_vader_compound IS NOT NULL AND price_change_pct IS NOT NULL GROUP BY f.ticker",
    "sentiment_trend": f"WITH {DAILY} SELECT ticker, date_key, round(avg(avg_vader_compound) OVER "
    "(PARTITION BY ticker ORDER BY date_key ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS sentiment_trend FROM daily",
    "ml_features": f"WITH RECURSIVE {BARS}, {FEATURES}, {RECURSION}, {DAILY}, labelled AS (SELECT *, lead(close) OVER (PARTITION BY ticker ORDER BY date) AS later FROM feat) "
    f"SELECT f.ticker, f.date AS date_key, {_round('close price_change_pct sma_20 log_return', 'f.')}, round(a.rsi_14, 4) AS rsi_14, "
    "coalesce(d.articles, 0) AS articles, round(d.avg_vader_compound, 4) AS avg_vader_compound, "
    "round((later - f.close) / nullif(f.close, 0) * 100, 4) AS next_change_pct, "
    "CASE WHEN later > f.close THEN 1 WHEN later IS NOT NULL THEN 0 END AS next_up "
    "FROM labelled f JOIN averaged a ON a.ticker = f.ticker AND a.date = f.date LEFT JOIN daily d ON d.ticker = f.ticker AND d.date_key = f.date",
}
