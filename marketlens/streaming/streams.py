"""Structured Streaming forms ST1-ST3.

* ST1 ``windowed_bars``: event-time tumbling windows per key with a watermark; append mode emits a window once the
  watermark passes its end, later rows for it are dropped. ``sentiment_windows``: sentiment per key and period the same
  way, and the empty periods between a key's periods by a stateful processor that remembers the last one.
* ST2 ``dedup_urls``: ``dropDuplicatesWithinWatermark`` on the url. ``first_articles``: the earliest article of each url
  by event time, held until the watermark has passed it, forgotten ``ttl`` later; urls are dealt into buckets, so a batch
  costs a few state calls for each bucket that it touches, not for each url.
* ST3 ``running_ema``: per-key EMA in event-time order; rows wait in a state map by time bucket until the watermark
  passes them, so a batch reads and writes the buckets that it touches, not all that a key holds.

Stateful processors use ``transformWithStateInPandas`` with keyed timers and the RocksDB state store, which keeps state on
disk. Sources and sinks are files: checkpoints and outputs live under the session's ``spark.checkpoint.dir`` (a shared
folder on a cluster), so a restarted query resumes from its offsets and state.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from marketlens.operators.text import keyword_sentiment, period_aggregates
from marketlens.session import checkpoint_dir

_STORE = "spark.sql.streaming.stateStore.providerClass"
#: Rows of a value of the waiting map, and the length of its time buckets.
CHUNK_ROWS, BUCKET_SECONDS = 10_000, 3600
#: Buckets that urls are dealt into.
URL_BUCKETS = 1024


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def _micros(column: pd.Series) -> np.ndarray:
    return pd.to_datetime(column).to_numpy().astype("datetime64[us]").astype(np.int64)


def _packed(pdf: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(state) -> pd.DataFrame | None:
    """The frame that a value state of one binary holds, or None."""
    if not state.exists():
        return None
    with pa.ipc.open_stream(state.get()[0]) as got:
        return got.read_pandas()


def _put(state, pdf: pd.DataFrame) -> None:
    if len(pdf):
        state.update((_packed(pdf),))
    elif state.exists():
        state.clear()


def event_stream(spark: SparkSession, sf_dir: str, table: str = "events", max_files: int | None = None) -> DataFrame:
    """A file stream over a driver table; NTZ event time cast to TIMESTAMP (required by watermarks)."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(sf_dir)


def windowed_bars(stream: DataFrame, ts: str = "ts", key: str = "event_type", value: str = "value",
                  order: str = "event_id", window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """ST1: OHLCV per (key, tumbling window) with a watermark."""
    s = stream.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay)
    g = s.groupBy(F.col(key).alias("symbol"), F.window("_t", window).alias("w")).agg(
        F.min_by(value, order).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
        F.max_by(value, order).alias("close"), F.count(F.lit(1)).alias("n"))
    return g.select("symbol", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "open", "high", "low", "close", "n")


def dedup_urls(stream: DataFrame, url: str = "url", ts: str = "publishedAt", delay: str = "1 hour") -> DataFrame:
    """ST2: keep one article per url among those within the watermark delay of each other."""
    s = stream.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay)
    return s.dropDuplicatesWithinWatermark([url]).drop("_t")


def first_articles(stream: DataFrame, url: str = "url", ts: str = "publishedAt", order: str = "event_id", delay: str = "1 hour",
                   ttl_seconds: int = 30 * 86400, buckets: int = URL_BUCKETS) -> DataFrame:
    """ST2: the earliest article of each url by (event time, ``order``), all columns, emitted once the watermark has passed it.

    Until then an earlier article that comes later takes its place; from then on further ones of the url are left out for
    ``ttl_seconds`` of event time, after which the url counts as new. Rows behind the watermark are late. A url without a value
    is a url. State of a bucket of urls: the row of each url that waits, and for each url that was emitted its name and a number,
    removed with the next emission after its time or by a timer. A batch reads the buckets that it touches, so ``buckets`` should
    grow with the urls of ``ttl_seconds``: some thousands of urls in each.
    """
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    columns, name, bucket = s.columns, f"{url}_name", f"{url}_bucket"

    class First(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getValueState("waiting", "rows binary")
            self.emitted = handle.getValueState("emitted", "urls binary")
            self.cleaning = handle.getValueState("cleaning", "ms long")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            now, best, emitted, new = timerValues.getCurrentWatermarkInMs(), _unpacked(self.waiting), _unpacked(self.emitted), False
            seen = set() if emitted is None else set(emitted["name"][emitted["ms"] > now])
            for pdf in rows:
                pdf = pdf.drop(columns=bucket)[(_micros(pdf[ts]) >= now * 1000) & ~pdf[name].isin(seen).to_numpy()]
                if len(pdf):
                    new = True
                    pdf = pdf if best is None else pd.concat([best, pdf], ignore_index=True)
                    pdf = pdf.iloc[np.lexsort((pdf[order].to_numpy(np.int64), _micros(pdf[ts])))]  # stable: of equal ones the one that waits
                    best = pdf[~pdf[name].duplicated()]
            if new:
                _put(self.waiting, best)
                self.handle.registerTimer(int(_micros(best[ts]).min()) // 1000 + 1)
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            now, best, emitted = timerValues.getCurrentWatermarkInMs(), _unpacked(self.waiting), _unpacked(self.emitted)
            left = None if emitted is None else emitted[emitted["ms"] > now]
            passed = np.zeros(0, bool) if best is None else _micros(best[ts]) < now * 1000
            if passed.any():
                out = best[passed]
                until = _micros(out[ts]) // 1000 + ttl_seconds * 1000
                added = pd.DataFrame({"name": out[name].to_numpy(), "ms": until})[until > now]
                left = added if left is None else pd.concat([left, added], ignore_index=True)
                rest = best[~passed]
                _put(self.waiting, rest)
                if len(rest):
                    self.handle.registerTimer(int(_micros(rest[ts]).min()) // 1000 + 1)
                yield out[columns]
            if left is not None:
                if passed.any() or len(left) < len(emitted):
                    _put(self.emitted, left)
                # one timer at a time that removes what has gone by, however often the bucket emits
                if len(left) and not (self.cleaning.exists() and self.cleaning.get()[0] > now):
                    self.cleaning.update((int(left["ms"].max()),))
                    self.handle.registerTimer(int(left["ms"].max()))

        def close(self) -> None:
            pass

    keyed = s.withColumn(name, F.coalesce(F.concat(F.lit("="), F.col(url).cast("string")), F.lit("")))
    keyed = keyed.withColumn(bucket, F.pmod(F.xxhash64(name), F.lit(buckets)))
    return keyed.groupBy(bucket).transformWithStateInPandas(First(), s.schema, "Append", "EventTime")


def sentiment_windows(stream: DataFrame, text: str = "title", ts: str = "publishedAt", keys: Sequence[str] = ("symbol",), days: int = 1,
                      delay: str = "1 hour") -> DataFrame:
    """ST1 of A2: sentiment aggregates per key and period of ``days`` days, with the empty periods between a key's first and last one.

    The aggregates are a windowed aggregation (partial sums before the shuffle, state by key and period, append mode), so a hot key
    is not in one task. What follows gets one row for each closed period of a key and remembers the last period. A period is emitted
    once the watermark has passed its end; the empty ones before it come with it, count 0 and no statistics.
    """
    s = keyword_sentiment(stream, text).withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay)
    g = s.groupBy(*keys, F.window("_t", f"{days} days")).agg(*period_aggregates())
    g = g.select(*keys, F.to_date("window.start").alias("period"), *[c for c in g.columns if c.startswith("sentiment_")])
    schema = g.schema
    statistics = [f.name for f in schema.fields if f.name.startswith("sentiment_") and f.name != "sentiment_score_count"]

    class Spine(StatefulProcessor):
        def init(self, handle) -> None:
            self.last = handle.getValueState("last", "day int")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            pdf = pd.concat(rows, ignore_index=True)
            day = pd.to_datetime(pdf["period"]).to_numpy().astype("datetime64[D]").astype(int)
            first = self.last.get()[0] + days if self.last.exists() else int(day.min())
            at = np.arange(first, int(day.max()) + 1, days)
            self.last.update((int(day.max()),))
            out = pdf.set_index(day).reindex(at)
            for name, value in zip(keys, key):
                out[name] = value
            out["period"] = pd.Series(at.astype("datetime64[D]"), index=at).dt.date
            out["sentiment_score_count"] = out["sentiment_score_count"].fillna(0).astype("int64")
            out[statistics] = out[statistics].astype(float)
            yield out[schema.names]

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            yield from ()

        def close(self) -> None:
            pass

    return g.groupBy(*keys).transformWithStateInPandas(Spine(), schema, "Append", "None")


def running_ema(stream: DataFrame, key: str = "event_type", ts: str = "ts", value: str = "value",
                order: str = "event_id", span: float = 12.0, delay: str = "10 minutes") -> DataFrame:
    """ST3: EMA(span, adjust=False) per key in event-time order across micro-batches.

    Rows wait until the watermark (greatest event time less ``delay``, in milliseconds) has passed them, and are
    then averaged in (time, order) and emitted; so a row up to ``delay`` late takes its place. A row behind the
    watermark is late and left out, as in any watermarked operator. State of a key: the average, and a map of the waiting rows
    by hour in values of at most ``CHUNK_ROWS`` rows. A batch adds values and never rewrites one; a timer takes the
    hours that have begun to pass in order, one at a time, and removes them; what has yet to pass of the last one is written again.
    """
    name, a, width = key, 2.0 / (span + 1.0), BUCKET_SECONDS * 1_000_000
    out_schema = f"{key} string, {ts} timestamp, {order} long, {value} double, ema double"

    class Waiting(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "ema double")
            self.open = handle.getValueState("open", "bucket array<long>, chunks array<int>")
            self.rows = handle.getMapState("rows", "bucket long, chunk int", "t binary, o binary, x binary")

        def _put(self, open_: dict, t, o, x) -> None:
            bucket = t // width
            for b in np.unique(bucket).tolist():
                mine = np.flatnonzero(bucket == b)
                for i in range(0, len(mine), CHUNK_ROWS):
                    own = mine[i:i + CHUNK_ROWS]
                    self.rows.updateValue((b, open_.get(b, 0)), (t[own].tobytes(), o[own].tobytes(), x[own].tobytes()))
                    open_[b] = open_.get(b, 0) + 1

        def _close(self, open_: dict, now: int) -> None:
            """Write the list of waiting buckets and ask for a timer when the first of them begins to pass."""
            if not open_:
                self.open.clear()
                return
            at = sorted(open_)
            self.open.update((at, [open_[b] for b in at]))
            self.handle.registerTimer(max(at[0] * width // 1000, now) + 1)

        def _opened(self) -> dict:
            return dict(zip(*self.open.get())) if self.open.exists() else {}

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            now, open_ = timerValues.getCurrentWatermarkInMs(), self._opened()
            for pdf in rows:
                t = _micros(pdf[ts])
                new = t >= now * 1000
                self._put(open_, t[new], pdf[order].to_numpy(np.int64)[new], pdf[value].to_numpy(float)[new])
            self._close(open_, now)
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            now, open_ = timerValues.getCurrentWatermarkInMs(), self._opened()
            passed = now * 1000
            last = self.last.get()[0] if self.last.exists() else None
            for b in sorted(open_):
                if b * width >= passed:
                    break
                got = [self.rows.getValue((b, i)) for i in range(open_[b])]
                t, o, x = (np.frombuffer(b"".join(v[i] for v in got), kind) for i, kind in enumerate((np.int64, np.int64, float)))
                for i in range(open_.pop(b)):
                    self.rows.removeKey((b, i))
                at = np.lexsort((o, t))
                t, o, x = t[at], o[at], x[at]
                n = int(np.searchsorted(t, passed))  # rows before the watermark
                if n:
                    seed = [] if last is None else [last]
                    ema = pd.Series(np.concatenate([seed, x[:n]])).ewm(alpha=a, adjust=False).mean().to_numpy()[len(seed):]
                    last = float(ema[-1])
                    yield pd.DataFrame({name: key[0], ts: t[:n].astype("datetime64[us]"), order: o[:n], value: x[:n], "ema": ema})
                if n < len(t):
                    self._put(open_, t[n:], o[n:], x[n:])
            if last is not None:
                self.last.update((last,))
            self._close(open_, now)

        def close(self) -> None:
            pass

    s = stream.select(F.col(key), F.col(ts).cast("timestamp").alias(ts), F.col(order).cast("long"),
                      F.col(value).cast("double")).withWatermark(ts, delay)
    return s.groupBy(key).transformWithStateInPandas(Waiting(), out_schema, "Append", "EventTime")


def run_to_table(df: DataFrame, name: str, output_mode: str = "append", base: str | None = None) -> DataFrame:
    """Drain a stream with ``availableNow`` into Parquet under the checkpoint folder; return the table.

    Calls with the same ``base`` go on from the offsets and state of the last one.
    """
    spark = df.sparkSession
    base = base or f"{checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex[:8]}"
    with rocksdb(spark):
        q = (df.writeStream.format("parquet").outputMode(output_mode)
             .option("checkpointLocation", f"{base}/_checkpoint").option("path", f"{base}/out")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(f"{base}/out")
