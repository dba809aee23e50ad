"""Queries: streaming jobs run to the end of the available data; results equal the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from bureaulake.operators import batches, monitoring
from bureaulake.queries import decision_queries as dq
from bureaulake.queries import monitoring_queries as mq
from bureaulake.queries import report_queries as rq
from bureaulake.queries.ctes import FEATURE_NAMES, _imputed, sql
from bureaulake.sources import scratch, views
from bureaulake.sources.views import table
from bureaulake.streaming import jobs

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


@query("stream_requests", """SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k FROM events GROUP BY 1""")
def stream_requests(spark, d):
    """Requests as JSON text, parsed with an explicit schema that ignores unknown fields."""
    events = jobs.source(spark, d, "events")
    raw = events.select(F.to_json(F.struct("event_id", "event_type", "props", F.lit(1).alias("unknown"))).alias("value"))
    parsed = raw.select(F.from_json("value", "event_id long, event_type string, props string").alias("m")).select("m.*")
    typed = parsed.select("event_id", "event_type", F.from_json("props", "k long")["k"].alias("k"))
    return jobs.rows(typed, "requests").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"))


@query("stream_dedup", "SELECT DISTINCT event_id - event_id % 3 AS message_id, event_type FROM events")
def stream_dedup(spark, d):
    """Each message once; what is more than a day late is kept aside instead of being dropped."""
    ev = F.col("event_id")
    stream = jobs.source(spark, d, "events").select((ev - ev % 3).alias("message_id"), "event_type", jobs.utc(F.col("ts")).alias("ts"))
    out = jobs.run(stream, jobs.late_sink(["message_id", "event_type"], "ts", 86_400_000), "append", "dedup")
    return jobs.written(stream, f"{out}/rows").select("message_id", "event_type")


@query("stream_late", """SELECT CASE WHEN event_id % 3 = 2 AND ts < (SELECT max(ts) FROM events WHERE event_id % 3 < 2) - INTERVAL 10 DAY THEN 'late' ELSE 'rows' END AS kind, count(*) AS n,
  sum(event_id)::BIGINT AS ids FROM events GROUP BY 1""")
def stream_late(spark, d):
    """Events whose third share is delivered last: what is more than ten days late goes to a side table."""
    ev = F.col("event_id")
    events = table(spark, d, "events").select("event_id", jobs.utc(F.col("ts")).alias("at"))
    stream = jobs.staged(events, F.when(ev % 3 == 2, 1).otherwise(0), 2, "late-events")
    out = jobs.run(stream, jobs.late_sink(["event_id"], "at", 10 * 86_400_000), "append", "late")
    kept = [spark.read.schema(stream.schema).parquet(f"{out}/{kind}").withColumn("kind", F.lit(kind)) for kind in ("rows", "late")]
    return kept[0].unionByName(kept[1]).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("stream_fanout", """SELECT 'job-' || event_id || '-' || lpad(CAST(i AS VARCHAR), 5, '0') AS request_id, event_id FROM events, range(0, 3) r(i) WHERE i <= event_id % 3""")
def stream_fanout(spark, d):
    """A job message becomes one message per applicant."""
    ev = F.col("event_id")
    stream = jobs.source(spark, d, "events").select("event_id", F.posexplode(F.sequence(F.lit(0), (ev % 3).cast("int"))).alias("i", "x"))
    return jobs.rows(stream.select(
        F.concat(F.lit("job-"), "event_id", F.lit("-"), F.lpad(F.col("i").cast("string"), 5, "0")).alias("request_id"), "event_id"), "fanout")


def _messages(spark, d):
    """Contexts and results as one message table with an event time."""
    number = F.regexp_extract("request_id", r"(\d+)$", 1).cast("long") + 28_401_120  # minutes until 2024: time 0 would be late from the start
    none = F.lit(None).cast("string")
    contexts = dq.contexts(spark, d).select(
        "request_id", F.lit("context").alias("kind"), F.array_join("models", ",").alias("models"), "selective",
        F.col("decision_label").alias("label"), none.alias("model_type"), none.alias("flag"), (number * 60_000).alias("at_ms"))
    results = dq.results(spark, d).select(
        "request_id", F.lit("result").alias("kind"), none.alias("models"), F.lit(None).cast("boolean").alias("selective"), none.alias("label"),
        "model_type", F.col("fraud_risk_flag").alias("flag"), (number * 60_000 + F.length("model_type") * 1_000).alias("at_ms"))
    return contexts.unionByName(results).withColumn("ts", F.timestamp_millis("at_ms"))


@query("stream_collect", sql("SELECT rid AS request_id, state FROM got", **dq._COL))
def stream_collect(spark, d):
    """Two-phase collection over four micro-batches; ends where the batch collector ends."""
    messages = _messages(spark, d)
    stream = jobs.staged(messages, F.pmod(F.xxhash64("request_id", "model_type"), F.lit(4)), 4, "messages")
    span = messages.agg(F.max("at_ms") - F.min("at_ms")).first()[0] or 0  # any message may come in any micro-batch
    reached = jobs.final_states(jobs.rows(jobs.collect(stream, delay=f"{span} milliseconds"), "collect"))
    asked = dq.contexts(spark, d).select("request_id")
    return asked.join(reached, "request_id", "left").select("request_id", F.coalesce("state", F.lit("waiting")).alias("state"))


_NAMES = "(['credit_risk','fraud_detection','loan_amount','income_verification'])[i + 1]"


@query("stream_timeout", sql(f"""SELECT state, missing, count(*) AS n FROM (
  SELECT state, '' AS missing FROM times WHERE state <> 'waiting'
  UNION ALL SELECT 'timeout', array_to_string(list_sort(list_transform(list_filter(wanted, lambda i: NOT list_contains(present, i)), lambda i: {_NAMES})), ',')
  FROM times, (SELECT max(latest) - 60000 AS seen FROM times) WHERE state <> 'decide' AND latest + 300000 <= seen) GROUP BY 1, 2""",
    **dq._COL, times=f"SELECT *, k * 60000 + coalesce(list_max(list_transform(present, lambda i: length({_NAMES}))), 0) * 1000 AS latest FROM got"))
def stream_timeout(spark, d):
    """Requests whose results did not come within 300 seconds of the last message, by event time; a request's messages share a micro-batch."""
    messages = _messages(spark, d)
    number = F.regexp_extract("request_id", r"(\d+)$", 1).cast("long")
    last = messages.agg(F.max(number).alias("m")).first()["m"] or 0
    stream = jobs.staged(messages, F.floor(number * 4 / (last + 1)), 4, "timed-messages")
    found = jobs.rows(jobs.collect(stream, timeout_ms=300_000, delay="1 minute"), "timeout")
    return found.groupBy("state", "missing").agg(F.count(F.lit(1)).alias("n"))


@query("stream_batch_progress", sql("SELECT *, CASE WHEN completed + failed >= total THEN 'complete' ELSE 'in_progress' END AS status FROM jobs", jobs=mq._JOBS))
def stream_batch_progress(spark, d):
    key, job = F.col("o_orderkey"), F.col("o_custkey") % 97
    rows = jobs.source(spark, d, "orders").select(
        F.concat(F.lit("job-"), job).alias("job_id"), F.when(job % 5 == 0, F.lit(10 ** 9)).otherwise(1).cast("long").alias("total"),
        F.when(key % 11 == 0, F.lit("error")).otherwise("ok").alias("outcome"))
    return jobs.newest(batches.job_progress(rows), ["job_id"], "progress")


@query("stream_training_done", sql("""SELECT training_id, count(*) AS models, count(*) FILTER (status = 'SUCCESS') AS succeeded,
  CASE WHEN count(*) FILTER (status <> 'SUCCESS') = 0 THEN 'COMPLETE' WHEN count(*) FILTER (status = 'SUCCESS') > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS run_status FROM tr GROUP BY 1""", tr=mq._TR))
def stream_training_done(spark, d):
    key = F.col("o_orderkey")
    rows = jobs.source(spark, d, "orders").select(
        F.concat(F.lit("run-"), F.floor(key / 4)).alias("training_id"),
        F.when((key % 9 == 0) | (F.floor(key / 4) % 13 == 0), F.lit("FAILED")).otherwise("SUCCESS").alias("status"),
        (F.col("o_totalprice") / 1000).alias("duration_seconds"))
    return jobs.newest(batches.training_run(rows), ["training_id"], "training").drop("total_duration")


@query("stream_daily", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def stream_daily(spark, d):
    """Tumbling days with a one-day watermark."""
    stream = jobs.source(spark, d, "events").withColumn("at", jobs.utc(F.col("ts"))).withWatermark("at", "1 day")
    daily = stream.groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    flat = daily.select(jobs.utc_day(F.col("w.start")).alias("day"), "event_type", "n", "value")
    return jobs.newest(flat, ["day", "event_type"], "daily").withColumn("value", F.round("value", 4))


_V = "CAST(json_extract_string(props, '$.k') AS BIGINT) / 100e0"
_SB = "CASE " + " ".join(f"WHEN v >= {i} * 0.1e0 THEN {i}" for i in range(9, 0, -1)) + " ELSE 0 END"


@query("stream_drift", sql("""SELECT day, feature, round(sum((a - e) * ln(a / e)), 4) AS psi FROM (
  SELECT g.day, g.feature, g.bin, coalesce(bb.n, 0) / bt.total::DOUBLE + 1e-6 AS e, coalesce(w.n, 0) / g.total::DOUBLE + 1e-6 AS a
  FROM (SELECT t.day, t.feature, t.total, unnest(range(0, 10)) AS bin FROM (SELECT day, feature, sum(n) AS total FROM win GROUP BY 1, 2 HAVING sum(n) >= 10) t WHERE day IN (SELECT day FROM win GROUP BY 1 HAVING sum(n) >= 50)) g
  JOIN (SELECT feature, sum(n) AS total FROM base GROUP BY 1) bt USING (feature)
  LEFT JOIN win w ON w.day = g.day AND w.feature = g.feature AND w.bin = g.bin LEFT JOIN base bb ON bb.feature = g.feature AND bb.bin = g.bin) GROUP BY 1, 2""",
    ev=f"SELECT CAST(ts AS DATE) AS d, event_type AS feature, {_V} AS v FROM events",
    base=f"SELECT feature, {_SB} AS bin, count(*) AS n FROM ev WHERE d < DATE '2024-01-08' GROUP BY 1, 2",
    win=f"SELECT strftime(d - CAST(o AS INTEGER), '%Y-%m-%d') AS day, feature, {_SB} AS bin, count(*) AS n FROM ev, range(0, 7) r(o) GROUP BY 1, 2, 3"))
def stream_drift(spark, d):
    """Seven-day histograms sliding by a day against the first week; windows with 50 or more rows, features with ten or more."""
    def values(df):
        return df.select("ts", F.col("event_type").alias("feature"), (F.from_json("props", "k long")["k"] / 100.0).alias("value"))

    stream = values(jobs.source(spark, d, "events")).withColumn("at", jobs.utc(F.col("ts"))).withWatermark("at", "1 day")
    windowed = stream.groupBy(F.window("at", "7 days", "1 day").alias("w"), "feature", monitoring.histogram_bin(F.col("value")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    flat = windowed.select(jobs.utc_day(F.col("w.start")).alias("day"), "feature", "bin", "n")
    recent = jobs.newest(flat, ["day", "feature", "bin"], "drift")
    first_week = values(table(spark, d, "events").filter("ts < timestamp_ntz'2024-01-08'"))
    base = first_week.groupBy("feature", monitoring.histogram_bin(F.col("value")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # One "feature" per window and event type lets the batch operator score all windows in one plan.
    enough = recent.groupBy("day").agg(F.sum("n").alias("rows")).filter("rows >= 50").select("day")
    tagged = recent.join(enough, "day", "left_semi").withColumn("tag", F.concat_ws("|", "day", "feature"))
    expected = tagged.select("tag", "feature").distinct().join(base, "feature").select(F.col("tag").alias("feature"), "bin", "n")
    scores = monitoring.psi(expected, tagged.select(F.col("tag").alias("feature"), "bin", "n"), minimum=10)
    parts = F.split("feature", r"\|")
    return scores.select(parts[0].alias("day"), parts[1].alias("feature"), "psi")


_DAILY_COHORT = "SELECT cohort, DATE '2024-01-01' + CAST(applicant_id % 14 AS INTEGER) AS d, " + ", ".join(f"{_imputed(n)} AS {n}" for n in FEATURE_NAMES) + " FROM cohort_fact"
_DAILY_LONG = "SELECT cohort, d, feature, " + mq._BIN + " AS bin FROM (SELECT * FROM daily_cohort) UNPIVOT (value FOR feature IN (" + ", ".join(FEATURE_NAMES) + "))"


@query("stream_feature_drift", sql("""SELECT day, feature, round(sum((a - e) * ln(a / e)), 4) AS psi FROM (
  SELECT g.day, g.feature, g.bin, coalesce(bb.n, 0) / bt.total::DOUBLE + 1e-6 AS e, coalesce(w.n, 0) / g.total::DOUBLE + 1e-6 AS a
  FROM (SELECT day, feature, total, unnest(range(0, 10)) AS bin FROM totals WHERE total >= 10 AND day IN (SELECT day FROM totals GROUP BY 1 HAVING max(total) >= 50)) g
  JOIN (SELECT feature, sum(n) AS total FROM base WHERE bin IS NOT NULL GROUP BY 1) bt USING (feature)
  LEFT JOIN win w ON w.day = g.day AND w.feature = g.feature AND w.bin = g.bin LEFT JOIN base bb ON bb.feature = g.feature AND bb.bin = g.bin) GROUP BY 1, 2""",
    cohort_fact=mq._COHORT_FACT, daily_cohort=_DAILY_COHORT, daily_long=_DAILY_LONG,
    base="SELECT feature, bin, count(*) AS n FROM daily_long WHERE cohort = 'baseline' GROUP BY 1, 2",
    win="SELECT strftime(d - CAST(o AS INTEGER), '%Y-%m-%d') AS day, feature, bin, count(*) AS n FROM daily_long, range(0, 7) r(o) WHERE cohort = 'recent' GROUP BY 1, 2, 3",
    totals="SELECT day, feature, sum(n) AS total FROM win GROUP BY 1, 2"))
def stream_feature_drift(spark, d):
    """All thirty features of scored applicants, streamed over two weeks, against the baseline cohort: seven-day windows with 50 or more applicants."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("applicant_id") % 14).cast("int"))
    vectors = scratch.written(mq.cohorts(spark, d).select("cohort", jobs.utc(day.cast("timestamp_ntz")).alias("at"), *FEATURE_NAMES), "cohort-vectors")
    base = monitoring.histograms(vectors.filter("cohort = 'baseline'").drop("cohort", "at"))
    recent = vectors.filter("cohort = 'recent'").drop("cohort")
    stream = jobs.staged(recent, F.floor(F.dayofmonth(jobs.utc_day(F.col("at")).cast("date")) / 8), 2, "vectors").withWatermark("at", "1 day")
    long = stream.unpivot(["at"], FEATURE_NAMES, "feature", "value").filter("value is not null")
    windowed = long.groupBy(F.window("at", "7 days", "1 day").alias("w"), "feature", monitoring.histogram_bin(F.col("value")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    counts = jobs.newest(windowed.select(jobs.utc_day(F.col("w.start")).alias("day"), "feature", "bin", "n"), ["day", "feature", "bin"], "feature-drift")
    enough = counts.groupBy("day", "feature").agg(F.sum("n").alias("rows")).groupBy("day").agg(F.max("rows").alias("rows")).filter(F.col("rows") >= monitoring.LEAST_ROWS).select("day")
    tagged = counts.join(enough, "day", "left_semi").withColumn("tag", F.concat_ws("|", "day", "feature"))
    expected = tagged.select("tag", "feature").distinct().join(base, "feature").select(F.col("tag").alias("feature"), "bin", "n")
    scores = monitoring.psi(expected, tagged.select(F.col("tag").alias("feature"), "bin", "n"), minimum=10)
    parts = F.split("feature", r"\|")
    return scores.select(parts[0].alias("day"), parts[1].alias("feature"), "psi")


@query("stream_audit", """SELECT strftime(d, '%Y-%m-%d') AS day, count(*) AS n FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase') GROUP BY 1""")
def stream_audit(spark, d):
    """Decisions arrive in three micro-batches with repeats across them; each is stored once."""
    log = dq.decisions_log(spark, d).withColumn("part", F.col("audit_id") % 3)
    stream = jobs.staged(log, F.col("part"), 3, "audit-log")
    out = jobs.run(stream, jobs.audit_sink(["request_id", "decision_date"], "decision_date"), "append", "audit")
    return spark.read.parquet(out).groupBy(F.date_format("decision_date", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("run_state", """SELECT user_id AS run_id, event_type AS system, arg_max(event_id, event_id) AS event_id, (['running','completed','failed','cancelled'])[arg_max(event_id, event_id) % 4 + 1] AS status FROM events GROUP BY 1, 2""")
def run_state(spark, d):
    """Latest status per run and system from a stream of state events."""
    status = F.get(F.array(F.lit("running"), F.lit("completed"), F.lit("failed"), F.lit("cancelled")), (F.col("event_id") % 4).cast("int"))
    stream = jobs.source(spark, d, "events").groupBy(F.col("user_id").alias("run_id"), F.col("event_type").alias("system")).agg(
        F.max(F.struct("ts", "event_id", status.alias("status"))).alias("top"))
    return jobs.newest(stream.select("run_id", "system", "top.event_id", "top.status"), ["run_id", "system"], "run-state")


@query("stream_route", rq.ORACLE["route_messages"].replace("SELECT coalesce(route, 'none') AS route, trigger, count(*) AS n", "SELECT coalesce(route, 'none') AS route, count(*) AS n").replace("GROUP BY 1, 2", "GROUP BY 1"))
def stream_route(spark, d):
    """One topic split into a folder per route by a single stream."""
    staged = jobs.staged(rq.messages(spark, d), F.col("event_id") % 2, 2, "topic")
    routed = staged.withColumn("route", F.coalesce(batches.route(), F.lit("none")))

    def split(batch, batch_id, folder):
        batch.write.mode("overwrite").partitionBy("route").parquet(f"{folder}/batch_id={batch_id}")

    return spark.read.parquet(jobs.run(routed, split, "append", "routes")).groupBy("route").agg(F.count(F.lit(1)).alias("n"))
