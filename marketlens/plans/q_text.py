"""Registered text queries: T1-T4, A2-A4, W24-W25, J6."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions.panel import Panel
from marketlens.operators import text as tx
from marketlens.plans.registry import query, rounded
from marketlens.plans.sqlkit import R
from marketlens.sources.tables import NEWS_TITLES, news_articles, table

# A lexicon of words that occur in the driver's multilingual
# documents and conversations (the default market lexicon does not).
DOC_POSITIVE = ["is", "with", "this", "are", "be", "und", "la"]
DOC_NEGATIVE = ["was", "from", "that", "der", "die", "que"]

# Python ``str.split()`` whitespace, written for DuckDB's regex engine.
_WS_SQL = r"[\t\n\x0B\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _tok_sql(x: str) -> str:
    return (f"list_filter(string_split_regex(lower(replace(replace(coalesce({x}, ''), '#', ' '), '@', ' ')), "
            f"'{_WS_SQL}'), lambda w: w <> '')")


def _lex(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _sent_sql(src: str, text: str, keep: str, pos, neg) -> str:
    """SQL CTE body scoring ``text`` of ``src`` with the keyword rule."""
    return f"""(SELECT {keep}, p, n,
      CASE WHEN p + n > 0 THEN p / (p + n) ELSE 0.0 END AS sentiment_positive,
      CASE WHEN p + n > 0 THEN n / (p + n) ELSE 0.0 END AS sentiment_negative
    FROM (SELECT {keep}, CAST(len(list_filter(t, lambda w: list_contains({_lex(pos)}, w))) AS DOUBLE) AS p,
                 CAST(len(list_filter(t, lambda w: list_contains({_lex(neg)}, w))) AS DOUBLE) AS n
          FROM (SELECT *, {_tok_sql(text)} AS t FROM {src})))"""


def _scored(keep: str, src: str, text: str, pos, neg) -> str:
    return f"""s0 AS {_sent_sql(src, text, keep, pos, neg)},
s AS (SELECT *, CASE WHEN p + n > 0 THEN 1.0 - (sentiment_positive + sentiment_negative) ELSE 1.0 END AS sentiment_neutral,
  sentiment_positive - sentiment_negative AS sentiment_score FROM s0),
sl AS (SELECT *, CASE WHEN sentiment_score > 0.1 THEN 'positive' WHEN sentiment_score < -0.1 THEN 'negative'
  ELSE 'neutral' END AS sentiment_label FROM s)"""


_NEWS = "news AS (SELECT event_id, event_type AS symbol, ts AS publishedAt, CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in NEWS_TITLES.items()) + " END AS title FROM events)"
#: Articles with url and sentiment, as ``scored``.
NEWS_SCORED = (_NEWS.removesuffix(" FROM events)") + ", 'https://news.example/' || event_type || '/' || CAST(user_id AS VARCHAR) AS url FROM events), "
               + _scored("event_id, publishedAt, url", "news", "title", tx.POSITIVE_WORDS, tx.NEGATIVE_WORDS) + ", scored AS (SELECT * FROM sl)")
_SENT_COLS = ["sentiment_positive", "sentiment_negative", "sentiment_neutral", "sentiment_score"]


@query("t1_t2_news_sentiment", f"""WITH {_NEWS}, {_scored('event_id, symbol, publishedAt', 'news', 'title', tx.POSITIVE_WORDS, tx.NEGATIVE_WORDS)}
SELECT event_id, {', '.join(R(c, c) for c in _SENT_COLS)}, sentiment_label FROM sl""")
def t1_t2_news_sentiment(spark, sf):
    """T1 keyword rule + T2 article columns, default lexicon, on every article title."""
    d = tx.keyword_sentiment(news_articles(spark, sf), "title")
    return rounded(d.select("event_id", *_SENT_COLS, "sentiment_label"))


@query("t1_documents_custom_lexicon", f"""WITH {_scored('doc_id', 'documents', 'text', DOC_POSITIVE, DOC_NEGATIVE)}
SELECT doc_id, CAST(p AS BIGINT) AS pos_hits, CAST(n AS BIGINT) AS neg_hits,
  {', '.join(R(c, c) for c in _SENT_COLS)}, sentiment_label FROM sl""")
def t1_documents_custom_lexicon(spark, sf):
    """T1 on whole documents (up to 20,000 words each) with a lexicon parameter."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    d = d.withColumn("_t", tx.tokens("text")).withColumns({
        "pos_hits": F.size(F.filter("_t", lambda w: F.array_contains(F.array(*map(F.lit, DOC_POSITIVE)), w)))
        .cast("bigint"),
        "neg_hits": F.size(F.filter("_t", lambda w: F.array_contains(F.array(*map(F.lit, DOC_NEGATIVE)), w)))
        .cast("bigint")}).drop("_t")
    d = tx.keyword_sentiment(d, "text", DOC_POSITIVE, DOC_NEGATIVE)
    return rounded(d.select("doc_id", "pos_hits", "neg_hits", *_SENT_COLS, "sentiment_label"))


def _period_sql(period: str, keys: str = "", step: str = "1 DAY") -> str:
    k = f"{keys}, " if keys else ""
    part = f"GROUP BY {keys}" if keys else ""
    on = " AND ".join([f"sp.{c} = a.{c}" for c in keys.split(", ") if c] + ["sp.period = a.period"])
    return f"""a AS (SELECT {k}{period} AS period,
    avg(sentiment_score) AS sentiment_score_mean, stddev_samp(sentiment_score) AS sentiment_score_std,
    min(sentiment_score) AS sentiment_score_min, max(sentiment_score) AS sentiment_score_max,
    count(sentiment_score) AS sentiment_score_count, avg(sentiment_positive) AS sentiment_positive_mean,
    avg(sentiment_negative) AS sentiment_negative_mean, avg(sentiment_neutral) AS sentiment_neutral_mean
  FROM sl GROUP BY {k}period),
sp AS (SELECT {k}unnest(generate_series(min(period), max(period), INTERVAL {step}))::DATE AS period FROM a {part})
SELECT {', '.join('sp.' + c for c in keys.split(', ') if c) + (', ' if keys else '')}sp.period,
  {', '.join(R('a.' + c, c) for c in ['sentiment_score_mean', 'sentiment_score_std', 'sentiment_score_min', 'sentiment_score_max'])},
  coalesce(a.sentiment_score_count, 0) AS sentiment_score_count,
  {', '.join(R('a.' + c, c) for c in ['sentiment_positive_mean', 'sentiment_negative_mean', 'sentiment_neutral_mean'])}
FROM sp LEFT JOIN a ON {on}"""


_AGG_COLS = ["period", "sentiment_score_mean", "sentiment_score_std", "sentiment_score_min", "sentiment_score_max",
             "sentiment_score_count", "sentiment_positive_mean", "sentiment_negative_mean", "sentiment_neutral_mean"]


@query("t3_a2_daily_sentiment", f"""WITH {_NEWS}, {_scored('event_id, symbol, publishedAt', 'news', 'title', tx.POSITIVE_WORDS, tx.NEGATIVE_WORDS)},
{_period_sql("CAST(publishedAt AS DATE)")}""")
def t3_a2_daily_sentiment(spark, sf):
    """T3 = T2 then A2: daily sentiment statistics over all articles, empty days included."""
    _, agg = tx.news_flow(news_articles(spark, sf), "title", "publishedAt", "D")
    return rounded(agg.select(*_AGG_COLS))


@query("a2_weekly_sentiment_by_symbol", f"""WITH {_NEWS}, {_scored('event_id, symbol, publishedAt', 'news', 'title', tx.POSITIVE_WORDS, tx.NEGATIVE_WORDS)},
{_period_sql("CAST(date_trunc('week', publishedAt) AS DATE) + 6", "symbol", "7 DAY")}""")
def a2_weekly_sentiment_by_symbol(spark, sf):
    """A2 with window 'W' (label = the Sunday ending the week) per symbol."""
    scored = tx.keyword_sentiment(news_articles(spark, sf), "title")
    agg = tx.aggregate_by_period(scored, "publishedAt", "W", keys=["symbol"])
    return rounded(agg.select("symbol", *_AGG_COLS))


@query("a3_sentiment_by_symbol", f"""WITH {_NEWS}, {_scored('event_id, symbol, publishedAt', 'news', 'title', tx.POSITIVE_WORDS, tx.NEGATIVE_WORDS)}
SELECT symbol, {', '.join(R(f'avg({c})', c) for c in _SENT_COLS)} FROM sl GROUP BY symbol""")
def a3_sentiment_by_symbol(spark, sf):
    """A3: mean of the numeric sentiment columns per symbol (label excluded)."""
    return rounded(tx.sentiment_by_symbol(tx.keyword_sentiment(news_articles(spark, sf), "title")))


@query("a4_sentiment_statistics", f"""WITH {_scored('doc_id', 'documents', 'text', DOC_POSITIVE, DOC_NEGATIVE)}
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {R(f'avg({c})', 'mean')}, {R(f'stddev_samp({c})', 'std')}, "
    f"{R(f'min({c})', 'min')}, {R(f'max({c})', 'max')} FROM sl" for c in _SENT_COLS))
def a4_sentiment_statistics(spark, sf):
    """A4: mean/std/min/max of each sentiment column over all documents."""
    d = tx.keyword_sentiment(table(spark, sf, "documents").select("doc_id", "text"), "text",
                             DOC_POSITIVE, DOC_NEGATIVE)
    return rounded(tx.sentiment_statistics(d.select(*_SENT_COLS)))


CONV = Panel(keys=("conv_id",), ts="turn")


@query("w24_w25_conversation_shifts", f"""WITH {_scored('conv_id, turn', 'conversations', 'text', DOC_POSITIVE, DOC_NEGATIVE)}
SELECT conv_id, turn AS timestamp, {R('magnitude', 'magnitude')}, {R('before', 'sentiment_before')},
  {R('sentiment_score', 'sentiment_after')}, {R('mom', 'sentiment_momentum')} FROM (
  SELECT *, lag(sentiment_score) OVER (PARTITION BY conv_id ORDER BY turn) AS before,
    abs(sentiment_score - lag(sentiment_score) OVER (PARTITION BY conv_id ORDER BY turn)) AS magnitude,
    sentiment_score - lag(sentiment_score, 2) OVER (PARTITION BY conv_id ORDER BY turn) AS mom FROM sl)
WHERE magnitude > 0.3""")
def w24_w25_conversation_shifts(spark, sf):
    """W24 momentum (lag 2) and W25 shifts > 0.3 between turns of each conversation."""
    d = tx.keyword_sentiment(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "text",
                             DOC_POSITIVE, DOC_NEGATIVE)
    d = tx.sentiment_momentum(d, CONV, "sentiment_score", 2)
    shifts = tx.sentiment_shifts(d, CONV, 0.3, "sentiment_score")
    mom = d.select("conv_id", F.col("turn").alias("timestamp"), "sentiment_momentum")
    return rounded(shifts.join(mom, ["conv_id", "timestamp"], "left"))


@query("t4_model_scoring", f"""WITH {_NEWS},
t AS (SELECT event_id, title, {_tok_sql('title')} AS tk FROM news),
c AS (SELECT event_id, title, CAST(len(list_filter(tk, lambda w: list_contains({_lex(tx.POSITIVE_WORDS)}, w))) AS DOUBLE) AS p,
        CAST(len(list_filter(tk, lambda w: list_contains({_lex(tx.NEGATIVE_WORDS)}, w))) AS DOUBLE) AS n FROM t)
SELECT event_id,
  CASE WHEN trim(coalesce(title, '')) = '' OR p + n = 0 THEN 'neutral' WHEN p >= n THEN 'positive' ELSE 'negative' END
    AS model_sentiment_label,
  {R("CASE WHEN trim(coalesce(title, '')) = '' OR p + n = 0 THEN 1.0 WHEN p >= n THEN p / (p + n) ELSE n / (p + n) END", 'model_sentiment_confidence')},
  {R("CASE WHEN trim(coalesce(title, '')) = '' OR p + n = 0 THEN 0.0 WHEN p >= n THEN p / (p + n) ELSE -n / (p + n) END", 'model_sentiment_score')}
FROM c""")
def t4_model_scoring(spark, sf):
    """T4: batched model scoring in an Arrow pandas UDF (a lexicon predictor stands in for the model)."""
    d = tx.model_sentiment(news_articles(spark, sf).select("event_id", "title"), "title", tx.lexicon_predictor)
    return rounded(d.select("event_id", "model_sentiment_label", "model_sentiment_confidence",
                            "model_sentiment_score"))
