"""Queries over time windows and over a stream that ends when its files are read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vacancylake.plans.queries import Registered
from vacancylake.plans.queries.extraction import AS_OF, listing_pages
from vacancylake.plans.queries.storage import SIGHTINGS, sightings
from vacancylake.schemas import RAW_PAGE_DDL
from vacancylake.session import new_shared_path
from vacancylake.sources.driver_tables import table
from vacancylake.sources.saved_pages import register_saved_pages
from vacancylake.streaming import ingest, progress, windows
from vacancylake.streaming.log import PostingLog
from vacancylake.streaming.progress import wait_for_listeners
from vacancylake.streaming.seen import seen_until

_DAY = "2024-02-01 00:00:00"


def _as_writes(batch):
    return batch.select(
        F.concat(F.lit("site_"), F.col("user_id") % 3).alias("platform"),
        F.concat(F.col("user_id") % 50, F.lit("-"), F.lower("event_type")).alias("id"),
        F.col("props").alias("title"),
        F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("text "), F.col("event_id"))).alias("description"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("experience_level"),
        F.lit(None).cast("string").alias("education_level"), F.col("ts").alias("scraped_date"), "event_id",
    )


def _event_log(spark, sf, home):
    kinds = {f.name: f.dataType.simpleString() for f in sightings(spark, sf).schema}
    return PostingLog(spark, f"{home}/log", kinds)


def _streamed_upsert(spark, sf):
    """The events file as a stream of writes into a posting log, then the log's table."""
    home = new_shared_path(spark, "streamed-upsert")
    log = _event_log(spark, sf, home)
    stream = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events*.parquet")
    ingest.write_batches(stream, log, f"{home}/checkpoint", _DAY, ["event_id"], _as_writes).awaitTermination()
    return log.current()


def _streamed_upsert_restart(spark, sf):
    """The same events in two runs with a checkpoint each, even ids then odd ids, compacted in between."""
    home = new_shared_path(spark, "streamed-restart")
    log = _event_log(spark, sf, home)
    stream = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events*.parquet")
    for name, half in (("a", F.col("event_id") % 2 == 0), ("b", F.col("event_id") % 2 == 1)):
        ingest.write_batches(stream.where(half), log, f"{home}/checkpoint-{name}", _DAY, ["event_id"], _as_writes).awaitTermination()
        if name == "a":
            log.compact()
    return log.current()


def _stream_rejects(spark, sf):
    """Printed listing pages as files, streamed into a listing log: what the stream left out."""
    home = new_shared_path(spark, "stream-rejects")
    pages = listing_pages(spark, sf).withColumns({
        "status": F.when(F.col("page_id") % 19 == 0, 500).otherwise(200), "fetched_at": F.lit(AS_OF).cast("timestamp_ntz"),
    })
    wanted = {f.name: f.dataType for f in StructType.fromDDL(RAW_PAGE_DDL)}
    pages = pages.select(*[(F.col(n) if n in pages.columns else F.lit(None)).cast(t).alias(n) for n, t in wanted.items()])
    pages.write.parquet(f"{home}/pages")
    ingest.ingest_pages(spark, f"{home}/pages", f"{home}/log", f"{home}/checkpoint", AS_OF, 4).awaitTermination()
    return ingest.listing_log(spark, f"{home}/log").rejects().select("page_id", "platform", "row_no", "problem")


def _saved(spark, sf):
    """The pages as saved files of three sources, some of them empty; returns the folder."""
    home = new_shared_path(spark, "saved-pages")
    register_saved_pages(spark)
    key = F.col("page_id")
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("site_"), key % 3).alias("platform"), (key + 1).cast("int").alias("page_no"),
        F.when(key % 97 == 96, "").otherwise(F.col("html")).alias("html"), F.lit(200).alias("status"),
    )
    wanted = {f.name: f.dataType for f in StructType.fromDDL(RAW_PAGE_DDL)}
    pages = pages.select(*[(F.col(n) if n in pages.columns else F.lit(None)).cast(t).alias(n) for n, t in wanted.items()])
    pages.write.format("saved_pages").option("path", f"{home}/pages").mode("append").save()
    return home


def _page_digest(pages):
    return pages.select("platform", "page_no", "status", F.md5("html").alias("html"))


def _saved_pages_batch(spark, sf):
    """Saved pages read back, up to a page limit and each source's first empty page."""
    home = _saved(spark, sf)
    return _page_digest(spark.read.format("saved_pages").option("path", f"{home}/pages").option("last_page", 200).load())


def _saved_pages_stream(spark, sf):
    """The same in two runs of a stream: the first with a lower limit, the second goes on after it."""
    home = _saved(spark, sf)
    for limit in (80, 200):
        stream = spark.readStream.format("saved_pages").option("path", f"{home}/pages").option("last_page", limit).load()
        write = stream.writeStream.format("parquet").option("path", f"{home}/read").option("checkpointLocation", f"{home}/checkpoint")
        write.trigger(availableNow=True).start().awaitTermination()
    return _page_digest(spark.read.schema(RAW_PAGE_DDL).parquet(f"{home}/read"))


_SAVED_PAGES_SQL = """WITH p AS (SELECT 'site_' || (page_id % 3) AS platform, CAST(page_id + 1 AS INTEGER) AS page_no,
  CASE WHEN page_id % 97 = 96 THEN '' ELSE html END AS html FROM pages),
e AS (SELECT platform, min(page_no) AS stop FROM p WHERE html = '' GROUP BY platform)
SELECT platform, page_no, 200 AS status, md5(html) AS html FROM p LEFT JOIN e USING (platform)
WHERE page_no <= 200 AND (stop IS NULL OR page_no < stop)"""

_SEEN_SPLIT, _SEEN_DAYS = "2024-01-16 00:00:00", 10


def _seen_until(spark, sf):
    """Sightings in two runs of a stream with one checkpoint; a key counts as seen for ten days from when it last passed."""
    home = new_shared_path(spark, "seen-until")
    rows = sightings(spark, sf).select("platform", "id", "scraped_date", "event_id")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    boundary = F.lit(_SEEN_SPLIT).cast("timestamp_ntz")
    for part in (F.col("scraped_date") < boundary, F.col("scraped_date") >= boundary):
        rows.where(part).coalesce(1).write.mode("append").parquet(f"{home}/arrived")
        once = seen_until(spark.readStream.schema(kinds).parquet(f"{home}/arrived"), ["platform", "id"], "scraped_date",
                          dt.timedelta(days=_SEEN_DAYS), order=["event_id"])
        write = once.writeStream.format("parquet").option("path", f"{home}/passed").option("checkpointLocation", f"{home}/checkpoint")
        write.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(kinds).parquet(f"{home}/passed")


def _batch_counters(spark, sf):
    """Events written to a posting log in two runs, with a listener's counters beside what the log's batches say."""
    home = new_shared_path(spark, "counted")
    log = _event_log(spark, sf, home)
    events = table(spark, sf, "events")
    listener = progress.BatchCounters(spark, f"{home}/counters")
    spark.streams.addListener(listener)
    try:
        for half in (0, 1):
            events.where(F.col("event_id") % 2 == half).coalesce(1).write.mode("append").parquet(f"{home}/arrived")
            stream = spark.readStream.schema(events.schema).parquet(f"{home}/arrived")
            counted = progress.counted(stream, F.col("event_type") == "error")
            ingest.write_batches(counted, log, f"{home}/checkpoint", _DAY, ["event_id"], _as_writes).awaitTermination()
            wait_for_listeners(spark)
    finally:
        spark.streams.removeListener(listener)
    found = progress.counters(spark, f"{home}/counters")
    return found.select("batch", "total", "failed").join(log.batch_counts().groupBy("batch").agg(F.sum("writes").alias("in_log")), "batch")


QUERIES: Registered = {
    "saved_pages_batch": (_saved_pages_batch, _SAVED_PAGES_SQL),
    "saved_pages_stream": (_saved_pages_stream, _SAVED_PAGES_SQL),
    "seen_until": (
        _seen_until,
        f"""{SIGHTINGS}, a AS (SELECT platform, id, min((scraped_date, event_id)) AS place FROM writes
          WHERE scraped_date < TIMESTAMP '{_SEEN_SPLIT}' GROUP BY platform, id),
        b AS (SELECT w.platform, w.id, min((w.scraped_date, w.event_id)) AS place FROM writes w LEFT JOIN a USING (platform, id)
          WHERE w.scraped_date >= TIMESTAMP '{_SEEN_SPLIT}' AND (a.place IS NULL OR w.scraped_date >= a.place[1] + INTERVAL {_SEEN_DAYS} DAY)
          GROUP BY w.platform, w.id)
        SELECT platform, id, place[1] AS scraped_date, place[2] AS event_id FROM (FROM a UNION ALL FROM b)""",
    ),
    "batch_counters": (
        _batch_counters,
        """SELECT CAST(event_id % 2 AS BIGINT) AS batch, count(*) AS total, count(*) FILTER (event_type = 'error') AS failed,
        CAST(count(*) AS BIGINT) AS in_log FROM events GROUP BY 1""",
    ),
    "stream_rejects": (
        _stream_rejects,
        """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 3 AS s, o_orderkey % 19 = 0 AS failed,
          CASE o_orderkey % 3 WHEN 0 THEN 'jobs_ge' WHEN 1 THEN 'cv_ge' ELSE 'ss_ge' END AS platform FROM orders)
        SELECT k AS page_id, platform, CAST(NULL AS INTEGER) AS row_no, 'HTTP 500' AS problem FROM o WHERE failed
        UNION ALL SELECT k, platform, 1, CASE WHEN s = 0 THEN 'no id' ELSE 'no title' END FROM o WHERE NOT failed
        UNION ALL SELECT k, platform, 2, 'fewer than 6 cells' FROM o WHERE NOT failed AND s = 0""",
    ),
    "activity_windows": (
        lambda spark, sf: windows.activity_windows(table(spark, sf, "events"), "ts", "event_type"),
        """WITH w AS (SELECT event_type, ts, unnest(generate_series(date_trunc('hour', ts) - INTERVAL 23 HOUR,
                             date_trunc('hour', ts), INTERVAL 1 HOUR)) AS s FROM events)
        SELECT s AS window_start, s + INTERVAL 24 HOUR AS window_end, event_type, count(*) AS n, max(ts) AS last_seen
        FROM w GROUP BY s, event_type""",
    ),
    "daily_windows": (
        lambda spark, sf: windows.daily_windows(table(spark, sf, "events"), "ts"),
        "SELECT date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1",
    ),
    "streamed_upsert": (
        _streamed_upsert,
        f"""{SIGHTINGS} SELECT platform, id, arg_min(title, event_id) AS title,
        arg_min_null(description, event_id) AS description, arg_min_null(experience_level, event_id) AS experience_level,
        CAST(NULL AS VARCHAR) AS education_level, arg_max(scraped_date, event_id) AS scraped_date,
        min(event_id) AS event_id, TIMESTAMP '{_DAY}' AS created_at, TIMESTAMP '{_DAY}' AS updated_at
        FROM writes GROUP BY platform, id""",
    ),
    "streamed_upsert_restart": (
        _streamed_upsert_restart,
        f"""{SIGHTINGS}, turns AS (SELECT *, (event_id % 2) * 1000000000000 + event_id AS turn FROM writes)
        SELECT platform, id, arg_min(title, turn) AS title,
        arg_min_null(description, turn) AS description, arg_min_null(experience_level, turn) AS experience_level,
        CAST(NULL AS VARCHAR) AS education_level, arg_max(scraped_date, turn) AS scraped_date,
        arg_min(event_id, turn) AS event_id, TIMESTAMP '{_DAY}' AS created_at, TIMESTAMP '{_DAY}' AS updated_at
        FROM turns GROUP BY platform, id""",
    ),
}
