"""Text sentiment T1-T4, sentiment aggregates A2-A4 and shifts W24-W25.

Keyword scoring is pure column expressions: lower-case, replace '#'/'@' by
spaces, split on Unicode whitespace (empty tokens dropped, as ``str.split()``),
then count lexicon hits with ``filter``/``array_contains``.  Whole texts are
processed; nothing is truncated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.panel import Panel, col, on_shards

# The default keyword lexicon (exact, lower-case token matches).
POSITIVE_WORDS = [
    "bullish", "gain", "surge", "rally", "jump", "spike",
    "strong", "outperform", "upgrade", "beat", "growth",
    "profit", "success", "boom", "soar", "upside",
    "positive", "optimistic", "increase", "recover",
    "momentum", "breakthrough", "rise",
]
NEGATIVE_WORDS = [
    "bearish", "loss", "crash", "plunge", "tumble",
    "weak", "underperform", "downgrade", "miss", "decline",
    "failure", "bust", "plummet", "downside",
    "negative", "pessimistic", "decrease", "struggle",
    "collapse", "breakdown", "fall", "drop", "recession",
]
LABEL_THRESHOLD = 0.1
SENTIMENT_COLS = ["sentiment_positive", "sentiment_negative", "sentiment_neutral", "sentiment_score"]


# The characters Python's ``str.split()`` treats as whitespace.
PY_WHITESPACE = r"[\t\n\x0B\f\r \x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"


def tokens(text) -> Column:
    """``text.lower().replace('#',' ').replace('@',' ').split()`` as a column expression."""
    t = F.translate(F.lower(F.coalesce(col(text), F.lit(""))), "#@", "  ")
    return F.filter(F.split(t, PY_WHITESPACE), lambda w: w != "")


def keyword_sentiment(df: DataFrame, text: str = "title", positive: Sequence[str] = POSITIVE_WORDS,
                      negative: Sequence[str] = NEGATIVE_WORDS, prefix: str = "sentiment_") -> DataFrame:
    """Positive / negative / neutral ratios, score = pos - neg, label at +-0.1.

    NULL text scores as the empty string (neutral 1.0).
    """
    pos_l = F.array(*[F.lit(w) for w in positive])
    neg_l = F.array(*[F.lit(w) for w in negative])
    d = df.withColumn("_tok", tokens(text))
    d = d.withColumns({"_p": F.size(F.filter("_tok", lambda w: F.array_contains(pos_l, w))),
                       "_n": F.size(F.filter("_tok", lambda w: F.array_contains(neg_l, w)))})
    tot = F.col("_p") + F.col("_n")
    pr = F.when(tot > 0, F.col("_p") / tot).otherwise(F.lit(0.0))
    nr = F.when(tot > 0, F.col("_n") / tot).otherwise(F.lit(0.0))
    score = pr - nr
    d = d.withColumns({f"{prefix}positive": pr, f"{prefix}negative": nr,
                       f"{prefix}neutral": F.when(tot > 0, F.lit(1.0) - (pr + nr)).otherwise(F.lit(1.0)),
                       f"{prefix}score": score})
    lab = (F.when(F.col(f"{prefix}score") > LABEL_THRESHOLD, F.lit("positive"))
           .when(F.col(f"{prefix}score") < -LABEL_THRESHOLD, F.lit("negative")).otherwise(F.lit("neutral")))
    return d.withColumn(f"{prefix}label", lab).drop("_tok", "_p", "_n")


def period_start(ts, window: str = "D") -> Column:
    """Resample label: the day, or the Sunday that ends the week ('W')."""
    day = F.to_date(col(ts))
    if window.upper() == "D":
        return day
    if window.upper() == "W":
        return F.date_add(F.to_date(F.date_trunc("week", col(ts))), 6)
    raise ValueError(f"unsupported window {window}")


def period_aggregates() -> list[Column]:
    """The columns of A2: score mean/std/min/max/count and pos/neg/neutral means."""
    score = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "count": F.count}
    return [*[fn("sentiment_score").alias(f"sentiment_score_{name}") for name, fn in score.items()],
            *[F.avg(f"sentiment_{c}").alias(f"sentiment_{c}_mean") for c in ("positive", "negative", "neutral")]]


def aggregate_by_period(df: DataFrame, ts: str = "publishedAt", window: str = "D",
                        keys: Sequence[str] = ()) -> DataFrame:
    """A2 + J6: score mean/std/min/max/count and pos/neg/neutral means per period.

    Empty periods between the first and the last one appear with count 0: a
    calendar spine (one row per period, per key) is left-joined to the grouped
    aggregate.
    """
    step = 1 if window.upper() == "D" else 7
    d = df.withColumn("period", period_start(ts, window))
    agg = d.groupBy(*keys, "period").agg(*period_aggregates())
    bounds = agg.groupBy(*keys).agg(F.min("period").alias("_lo"), F.max("period").alias("_hi"))
    spine = bounds.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step} DAY")))
                          .alias("period"))
    out = spine.join(agg, [*keys, "period"], "left")
    return out.withColumn("sentiment_score_count", F.coalesce("sentiment_score_count", F.lit(0)).cast("long"))


def sentiment_by_symbol(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """A3: mean of every numeric sentiment_* column per symbol (the label is excluded)."""
    cols = [c for c, t in df.dtypes if c.startswith("sentiment_") and t in ("double", "float", "int", "bigint")]
    return df.groupBy(symbol).agg(*[F.avg(c).alias(c) for c in cols])


def sentiment_statistics(df: DataFrame) -> DataFrame:
    """A4: mean/std/min/max of each numeric sentiment_* column, one row per column."""
    cols = [c for c, t in df.dtypes if c.startswith("sentiment_") and t in ("double", "float", "int", "bigint")]
    wide = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
                                              F.min(c).cast("double").alias(f"{c}__min"),
                                              F.max(c).cast("double").alias(f"{c}__max"))])
    rows = ", ".join(f"'{c}', `{c}__mean`, `{c}__std`, `{c}__min`, `{c}__max`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {rows}) AS (column, mean, std, min, max)")


@on_shards
def sentiment_momentum(df: DataFrame, panel: Panel, score: str = "sentiment_score_mean", window: int = 5,
                       out: str = "sentiment_momentum") -> DataFrame:
    """Score - score[t-window]."""
    return df.withColumn(out, col(score) - panel.lag(score, window))


def sentiment_shifts(df: DataFrame, panel: Panel, threshold: float = 0.3, score: str | None = None) -> DataFrame:
    """Rows whose score moved by more than ``threshold``: magnitude, before, after.

    ``score`` defaults to the first column whose name contains "score".
    """
    score = score or next(c for c in df.columns if "score" in c)
    prev = panel.lag(score)
    d = df.withColumns({"sentiment_before": prev, "sentiment_after": col(score),
                        "magnitude": F.abs(col(score) - prev)})
    return d.where(F.col("magnitude") > threshold).select(
        *panel.keys, F.col(panel.ts).alias("timestamp"), "magnitude", "sentiment_before", "sentiment_after")


def news_flow(df: DataFrame, text: str = "title", ts: str = "publishedAt", window: str = "D",
              keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Article sentiment (T2) and its period aggregate (A2)."""
    scored = keyword_sentiment(df, text)
    return scored, aggregate_by_period(scored, ts, window, keys)


# ---------------------------------------------------------------- T4
def model_sentiment(df: DataFrame, text: str, predict_factory: Callable[[], Callable[[list[str]], list]],
                    batch_size: int = 32, out: str = "model_sentiment") -> DataFrame:
    """T4: batch text-classifier scoring in an Arrow-batched pandas UDF.

    ``predict_factory()`` is called once in each Python worker and must return ``predict(list_of_texts) -> list of
    (label, score)``.  Positive labels give +score, negative -score, anything else 0; blank text is (neutral, 1.0) and 0.
    A batch that the model fails on is tried text by text; a text it still fails on is neutral as well, with the error
    in ``{out}_error``. A factory that fails, or a model that gives fewer results than texts, fails the job. Texts are passed whole.
    """
    from pyspark import cloudpickle
    made = cloudpickle.dumps(predict_factory)

    @F.pandas_udf(f"{out}_label string, {out}_confidence double, {out}_score double, {out}_error string")
    def score(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import sys
        models = sys.__dict__.setdefault("_text_models", {})  # outlives the task: workers are reused
        if made not in models:
            models[made] = cloudpickle.loads(made)()
        predict = models[made]

        def run(texts: list[str]) -> list[tuple]:
            try:
                got = [(str(lab).lower(), float(conf), None) for lab, conf in predict(texts)]
            except Exception as e:  # noqa: BLE001 - reported with the text
                if len(texts) > 1:
                    return [r for t in texts for r in run([t])]
                return [("neutral", 1.0, f"{type(e).__name__}: {e}"[:500])]
            if len(got) != len(texts):
                raise ValueError(f"the model gave {len(got)} results for {len(texts)} texts")
            return got

        for s in it:
            texts = s.fillna("").astype(str).tolist()
            res = [("neutral", 1.0, None)] * len(texts)
            todo = [i for i, t in enumerate(texts) if t.strip()]
            for b in range(0, len(todo), batch_size):
                idx = todo[b:b + batch_size]
                for i, r in zip(idx, run([texts[i] for i in idx])):
                    res[i] = r
            sign = {"positive": 1.0, "negative": -1.0}
            yield pd.DataFrame({f"{out}_label": [r[0] for r in res], f"{out}_confidence": [r[1] for r in res],
                                f"{out}_score": [sign.get(r[0], 0.0) * r[1] for r in res], f"{out}_error": [r[2] for r in res]})
    return df.withColumn("_ms", score(col(text))).select("*", "_ms.*").drop("_ms")


def model_failures(scored: DataFrame, out: str = "model_sentiment") -> DataFrame:
    """T4: texts scored, texts the model failed on, and how often each error came."""
    return scored.groupBy(F.col(f"{out}_error").alias("error")).agg(F.count(F.lit(1)).alias("n"))


def lexicon_predictor(positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS):
    """A deterministic stand-in text model for T4 (keyword ratio as confidence)."""
    pos, neg = set(positive), set(negative)

    def predict(texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for t in texts:
            w = t.lower().replace("#", " ").replace("@", " ").split()
            p, n = sum(x in pos for x in w), sum(x in neg for x in w)
            if p + n == 0:
                out.append(("neutral", 1.0))
            else:
                out.append(("positive", p / (p + n)) if p >= n else ("negative", n / (p + n)))
        return out
    return predict
