"""Event-stream queries in batch form over the ``events`` and
``conversations`` tables (streaming twins live in rivulet.streaming)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rivulet.functions.codecs import alert_text, decode_event, parse_tuple_text
from rivulet.functions.text import nonword_tokens, token_route
from rivulet.operators import patterns as P
from rivulet.operators import windows as W
from rivulet.operators.iterate import fibonacci_steps, route
from rivulet.operators.statemachine import TRANSITIONS, state_machine_alerts
from rivulet.operators.trigger import delta_trigger_top
from rivulet.plans.catalog import query
from rivulet.session import checkpoint_dir
from rivulet.sinks import tuple_line
from rivulet.sinks.ledger import committed, write_ledger
from rivulet.sources.replay import replay_stream
from rivulet.sources.streams import decode_word_events, encode_state_events, encode_word_events
from rivulet.sources.tables import table
from rivulet.streaming.config import ROCKSDB_PROVIDER, run_to_end
from rivulet.streaming.keyed import followed_by_in_time
from rivulet.streaming.windows import session_windows, until_end


def cents():
    """Value in integer cents (exact sums)."""
    return F.round(F.col("value") * 100).cast("long")


_CENTS_SQL = "CAST(round(value * 100) AS BIGINT)"

# Event type of the table -> letter of the state machine.
EVENT_LETTERS = {"signup": "a", "click": "b", "error": "d", "view": "e", "purchase": "g"}


def _events(spark, sf):
    return table(spark, sf, "events")


@query("running_total", sql=f"""
SELECT user_id, event_id,
       CAST(sum({_CENTS_SQL}) OVER (PARTITION BY user_id ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents
FROM events
""")
def running_total(spark, sf):
    ev = _events(spark, sf).select("user_id", "event_id", cents().alias("cents"))
    return W.running_sum(ev, "user_id", "event_id", "cents", "running_cents").drop("cents")


@query("count_window", sql=f"""
SELECT event_type, event_id, rn, window_cents FROM (
  SELECT event_type, event_id, row_number() OVER w AS rn,
         CAST(sum({_CENTS_SQL}) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS BIGINT)
           AS window_cents
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id))
WHERE rn % 5 = 0
""")
def count_window(spark, sf):
    ev = _events(spark, sf).select("event_type", "event_id", cents().alias("cents"))
    return W.count_window_sum(ev, "event_type", "event_id", "cents", size=10, slide=5,
                              out="window_cents", width=1024).drop("cents")


@query("tumbling_word_count", sql="""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def tumbling_word_count(spark, sf):
    return W.tumbling(_events(spark, sf), "ts", "1 hour", ["event_type"],
                      [F.count(F.lit(1)).alias("n")])


@query("sliding_window_sum", sql=f"""
SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, user_id,
       CAST(sum(cents) AS BIGINT) AS sum_cents, count(*) AS n
FROM (SELECT user_id, {_CENTS_SQL} AS cents,
             time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR AS ws
      FROM events, range(4) r(k))
GROUP BY 1, 2, 3
""")
def sliding_window_sum(spark, sf):
    ev = _events(spark, sf).withColumn("cents", cents())
    return W.sliding(ev, "ts", "1 day", "6 hours", ["user_id"],
                     [F.sum("cents").alias("sum_cents"), F.count(F.lit(1)).alias("n")])


@query("session_window", sql=f"""
WITH s AS (
  SELECT user_id, event_id, ts, {_CENTS_SQL} AS cents,
         CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 1 HOUR
              THEN 1 ELSE 0 END AS st
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end,
       count(*) AS n_events, CAST(sum(cents) AS BIGINT) AS sum_cents
FROM n GROUP BY user_id, sid
""")
def session_window(spark, sf):
    ev = _events(spark, sf).select("user_id", "event_id", "ts", cents().alias("cents"))
    return W.sessions(ev, "user_id", "event_id", "ts", "1 hour",
                      [F.count(F.lit(1)).alias("n_events"), F.sum("cents").alias("sum_cents")])


@query("window_join", sql="""
SELECT c.user_id, time_bucket(INTERVAL 1 DAY, c.ts) AS window_start,
       c.event_id AS click_id, p.event_id AS purchase_id
FROM events c JOIN events p
  ON c.user_id = p.user_id AND time_bucket(INTERVAL 1 DAY, c.ts) = time_bucket(INTERVAL 1 DAY, p.ts)
WHERE c.event_type = 'click' AND p.event_type = 'purchase'
""")
def window_join(spark, sf):
    ev = _events(spark, sf)
    clicks = ev.where(F.col("event_type") == "click").select("user_id", "ts",
                                                             F.col("event_id").alias("click_id"))
    buys = ev.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("ts").alias("ts_p"), F.col("event_id").alias("purchase_id"))
    j = W.window_join(clicks, buys, ["user_id"], "ts", "ts_p", "1 day")
    return j.select("user_id", "window_start", "click_id", "purchase_id")


def _conv_tokens(spark, sf):
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return conv.select("conv_id", "turn", F.explode(nonword_tokens("text")).alias("token"))


_TOKENS_SQL = """
WITH t AS (SELECT conv_id, turn, unnest(regexp_split_to_array(lower(text), '\\W+')) AS token
           FROM conversations)
"""


@query("side_output_kept", sql=_TOKENS_SQL + """
SELECT token AS word, count(*) AS n FROM t
WHERE length(token) BETWEEN 1 AND 5 GROUP BY token
""")
def side_output_kept(spark, sf):
    toks = _conv_tokens(spark, sf)
    kept = toks.where(F.length("token").between(1, 5))
    return kept.groupBy(F.col("token").alias("word")).agg(F.count(F.lit(1)).alias("n"))


@query("side_output_rejected", sql=_TOKENS_SQL + """
SELECT conv_id, turn, 'rejected: ' || token AS rejected FROM t WHERE length(token) > 5
""")
def side_output_rejected(spark, sf):
    toks = _conv_tokens(spark, sf)
    return toks.where(F.length("token") > 5).select(
        "conv_id", "turn", F.concat(F.lit("rejected: "), "token").alias("rejected"))


@query("pattern_ab", sql="""
SELECT user_id, event_id, ts, value, next_event_id FROM (
  SELECT *, lead(event_type) OVER w AS nt, lead(ts) OVER w AS nts,
         lead(event_id) OVER w AS next_event_id
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
WHERE event_type = 'click' AND nt = 'purchase' AND nts < ts + INTERVAL 1 HOUR
""")
def pattern_ab(spark, sf):
    ev = _events(spark, sf).select("user_id", "event_id", "ts", "value", "event_type")
    m = P.followed_by(ev, "user_id", "event_id", "ts", F.col("event_type") == "click",
                      F.col("event_type") == "purchase", "1 hour", ["event_id"], exclusive=True)
    return m.select("user_id", "event_id", "ts", "value", "next_event_id")


@query("pattern_run", sql="""
WITH x AS (
  SELECT user_id, event_id, event_type, event_type = 'view' AS isa,
         lag(event_type = 'view') OVER w AS prev_a, lag(event_id) OVER w AS prev_id,
         lag(event_type) OVER w AS prev_type
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
r AS (SELECT *, sum(CASE WHEN isa AND NOT coalesce(prev_a, false) THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run_no
      FROM x),
g AS (SELECT user_id, run_no, min(event_id) AS first_a, max(event_id) AS last_a,
             count(*) AS len, arg_min(prev_id, event_id) AS strt_id,
             arg_min(prev_type, event_id) AS strt_type, bool_or(event_id = first_id) AS opens_key
      FROM r JOIN (SELECT user_id AS u, min(event_id) AS first_id FROM events GROUP BY 1)
           ON u = user_id
      WHERE isa GROUP BY user_id, run_no)
SELECT user_id,
       CASE WHEN opens_key THEN first_a ELSE strt_id END AS start_event_id,
       CASE WHEN opens_key THEN 'view' ELSE strt_type END AS start_event_type,
       last_a, CASE WHEN opens_key THEN len - 1 ELSE len END AS run_length
FROM g WHERE NOT opens_key OR len >= 2
""")
def pattern_run(spark, sf):
    ev = _events(spark, sf).select("user_id", "event_id", "event_type")
    return P.start_then_run(ev, "user_id", "event_id", F.col("event_type") == "view",
                            ["event_id", "event_type"])


def _letter_sql():
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_LETTERS.items())
    return f"CASE event_type {cases} END"


def _sm_step_sql(state, event):
    cases = " ".join(
        f"WHEN {state} = '{s}' AND {event} = '{e}' THEN '{'Initial' if t == 'Terminal' else t}'"
        for (s, e), t in TRANSITIONS.items())
    return f"CASE {cases} ELSE NULL END"


@query("state_machine_alerts", sql=f"""
WITH RECURSIVE ev AS (
  SELECT user_id, event_id, {_letter_sql()} AS e,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
  FROM events),
walk(user_id, rn, event_id, e, st, nxt) AS (
  SELECT user_id, rn, event_id, e, 'Initial', {_sm_step_sql("'Initial'", 'e')} FROM ev WHERE rn = 1
  UNION ALL
  SELECT ev.user_id, ev.rn, ev.event_id, ev.e, coalesce(w.nxt, w.st),
         {_sm_step_sql('coalesce(w.nxt, w.st)', 'ev.e')}
  FROM walk w JOIN ev ON ev.user_id = w.user_id AND ev.rn = w.rn + 1)
SELECT user_id, event_id, st AS state, e AS event,
       'ALERT ' || concat_ws('.', (user_id >> 24) & 255, (user_id >> 16) & 255,
                             (user_id >> 8) & 255, user_id & 255)
       || ' : ' || st || ' -> ' || e AS alert
FROM walk WHERE nxt IS NULL
""")
def state_machine_alerts_q(spark, sf):
    ev = _events(spark, sf)
    letters = F.create_map(*[F.lit(x) for kv in EVENT_LETTERS.items() for x in kv])
    ev = ev.select("user_id", "event_id", letters[F.col("event_type")].alias("letter"))
    alerts = state_machine_alerts(ev, "user_id", "event_id", "letter")
    # the alert's text form; the key plays the source address
    return alerts.withColumn("alert", alert_text(F.col("user_id").cast("int"), "state", "event"))


@query("delta_trigger_top", sql=f"""
WITH RECURSIVE x AS (
  SELECT user_id, event_id, ts, value,
         sum({_CENTS_SQL}) OVER (PARTITION BY user_id ORDER BY event_id
                                 ROWS UNBOUNDED PRECEDING) AS dist,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
  FROM events),
top AS (
  SELECT a.user_id, a.event_id AS fire_id,
         arg_max(b.event_id, struct_pack(v := b.value, o := -b.event_id)) AS top_id
  FROM x a JOIN x b ON a.user_id = b.user_id AND b.event_id <= a.event_id
                   AND b.ts > a.ts - INTERVAL 10 DAY
  GROUP BY 1, 2),
walk(user_id, rn, event_id, last_d, fired) AS (
  SELECT user_id, rn, event_id, dist, false FROM x WHERE rn = 1
  UNION ALL
  SELECT x.user_id, x.rn, x.event_id,
         CASE WHEN x.dist - w.last_d > 50000 THEN x.dist ELSE w.last_d END,
         x.dist - w.last_d > 50000
  FROM walk w JOIN x ON x.user_id = w.user_id AND x.rn = w.rn + 1)
SELECT w.user_id, w.event_id AS fire_event_id, t.top_id AS event_id, b.value,
       CAST(b.dist AS DOUBLE) AS distance, b.ts
FROM walk w JOIN top t ON t.user_id = w.user_id AND t.fire_id = w.event_id
JOIN x b ON b.event_id = t.top_id
WHERE w.fired
""")
def delta_trigger_top_q(spark, sf):
    ev = _events(spark, sf).select("user_id", "event_id", "ts", "value", cents().alias("cents"))
    withdist = W.running_sum(ev, "user_id", "event_id", "cents", "distance")
    return delta_trigger_top(withdist, "user_id", "ts", "event_id", "value", "distance",
                             threshold=50000, evict="10 days")


@query("iterate_until_bound", sql="""
WITH RECURSIVE r AS (
  SELECT l_orderkey, l_linenumber, 1 + l_linenumber AS a, 1 + CAST(l_quantity AS INTEGER) AS b FROM lineitem),
s AS (
  SELECT DISTINCT a, b FROM r),
it(a, b, x, y, n) AS (
  SELECT a, b, b, a + b, 1 FROM s
  UNION ALL
  SELECT a, b, y, x + y, n + 1 FROM it WHERE x < 100 AND y < 100),
m AS (SELECT a, b, max(n) AS steps FROM it GROUP BY a, b)
SELECT l_orderkey, l_linenumber, a, b, steps FROM r JOIN m USING (a, b)
""")
def iterate_until_bound(spark, sf):
    li = table(spark, sf, "lineitem")
    pairs = li.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") + 1).cast("int").alias("a"),
                      (F.col("l_quantity").cast("int") + 1).alias("b"))
    return fibonacci_steps(pairs, "a", "b", 100)


@query("count_window_value", sql="""
SELECT event_type, event_id, rn, round(window_value, 6) AS window_value FROM (
  SELECT event_type, event_id, row_number() OVER w AS rn,
         sum(value) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS window_value
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id))
WHERE rn % 3 = 0
""")
def count_window_value(spark, sf):
    ev = _events(spark, sf).select("event_type", "event_id", "value")
    out = W.count_window_sum(ev, "event_type", "event_id", "value", size=7, slide=3, out="window_value",
                             width=1024)
    return out.withColumn("window_value", F.round("window_value", 6))


@query("side_output_windows", sql="""
SELECT time_bucket(INTERVAL 5 SECOND, ts) AS window_start,
       time_bucket(INTERVAL 5 SECOND, ts) + INTERVAL 5 SECOND AS window_end,
       event_type AS word, count(*) AS n
FROM events WHERE length(event_type) BETWEEN 1 AND 5 GROUP BY 1, 2, 3
""")
def side_output_windows(spark, sf):
    """The tokens that the length router keeps, counted in 5 s windows."""
    words = _events(spark, sf).select("ts", F.col("event_type").alias("word"))
    kept = words.where(token_route("word") == "kept")
    return W.tumbling(kept, "ts", "5 seconds", ["word"], [F.count(F.lit(1)).alias("n")])


@query("window_contents", sql="""
SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n,
       max(value) - min(value) AS spread
FROM events GROUP BY 1, 2
""")
def window_contents(spark, sf):
    """A function of a window's whole contents, merged from its parts."""
    def part(rows):
        return rows.iloc[:1][["event_type", "window_start"]].assign(
            n=len(rows), low=rows["value"].min(), high=rows["value"].max())

    def merge(parts):
        return parts.iloc[:1][["event_type", "window_start"]].assign(
            n=parts["n"].sum(), spread=parts["high"].max() - parts["low"].min())
    ev = _events(spark, sf).select("event_type", "ts", "value")
    frame = "event_type string, window_start timestamp_ntz, n long"
    return W.window_apply_parts(ev, "ts", "1 day", ["event_type"], part, f"{frame}, low double, high double",
                                merge, f"{frame}, spread double")


@query("split_select", sql="""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS output FROM events
""")
def split_select(spark, sf):
    even, odd = route(_events(spark, sf).select("event_id"), F.col("event_id") % 2 == 0)
    return (even.withColumn("output", F.lit("even"))
            .unionByName(odd.withColumn("output", F.lit("odd"))))


@query("state_event_codec", sql=f"""
SELECT CAST(user_id AS INT) AS address, {_letter_sql()} AS type, 8 AS n_bytes FROM events
""")
def state_event_codec(spark, sf):
    """Events to 8-byte records and back."""
    letters = F.create_map(*[F.lit(x) for kv in EVENT_LETTERS.items() for x in kv])
    ev = _events(spark, sf).select(F.col("user_id").cast("int").alias("address"),
                                   letters[F.col("event_type")].alias("type"))
    raw = encode_state_events(ev)
    return raw.select(F.octet_length("value").alias("n_bytes"), decode_event("value").alias("e")) \
        .select("e.*", "n_bytes")


@query("word_event_codec", sql=f"""
SELECT event_type || ',' || CAST(CAST({_CENTS_SQL} AS INT) AS VARCHAR) || ',' || CAST(event_id AS VARCHAR) AS value
FROM events
""")
def word_event_codec(spark, sf):
    """Events as JSON records, decoded, and written as delimited text."""
    ev = _events(spark, sf).select(F.to_json(F.struct(
        F.col("event_type").alias("word"), cents().cast("int").alias("frequency"),
        F.col("event_id").alias("timestamp"))).alias("value"))
    return encode_word_events(decode_word_events(ev))


@query("tuple_text", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_shipmode FROM (
  SELECT *, 'mode ' || (l_linenumber % 3) AS l_shipmode FROM lineitem)
""")
def tuple_text(spark, sf):
    """Rows written as "(a,b,c,d)" and parsed back."""
    li = table(spark, sf, "lineitem").withColumn(
        "l_shipmode", F.concat(F.lit("mode "), (F.col("l_linenumber") % 3).cast("string")))
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipmode"]
    text = li.select(tuple_line(names).alias("line"))
    kinds = [dict(li.dtypes)[n] for n in names]
    return text.select(parse_tuple_text("line", kinds).alias("t")).select(
        *[F.col(f"t._{i + 1}").alias(n) for i, n in enumerate(names)])


@query("pattern_global", sql=f"""
WITH r AS (
  SELECT event_id, event_type, ts,
         CAST(sum({_CENTS_SQL}) OVER (PARTITION BY event_type ORDER BY event_id
              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
  FROM events),
n AS (SELECT *, lead(event_type) OVER w AS nt, lead(ts) OVER w AS nts, lead(event_id) OVER w AS next_event_id,
             lead(total) OVER w AS next_total
      FROM r WINDOW w AS (ORDER BY ts, event_id))
SELECT event_id, total, next_event_id, next_total FROM n
WHERE event_type = 'click' AND nt = 'purchase' AND nts < ts + INTERVAL 1 HOUR
""")
def pattern_global(spark, sf):
    """The pattern over the running totals of all keys, in event time."""
    ev = _events(spark, sf).select("event_id", "event_type", "ts", cents().alias("cents"))
    totals = W.running_sum(ev, "event_type", "event_id", "cents", "total").drop("cents")
    hits = P.followed_by_in_time(totals, "ts", "event_id", F.col("event_type") == "click",
                                 F.col("event_type") == "purchase", "1 hour", ["event_id", "total"],
                                 exclusive=True)
    return hits.select("event_id", "total", "next_event_id", "next_total")


@query("running_total_by_type", sql=f"""
SELECT event_type, event_id,
       CAST(sum({_CENTS_SQL}) OVER (PARTITION BY event_type ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_cents
FROM events
""")
def running_total_by_type(spark, sf):
    """Few keys with many rows each: every key spans many blocks."""
    ev = _events(spark, sf).select("event_type", "event_id", cents().alias("cents"))
    return W.running_sum(ev, "event_type", "event_id", "cents", "running_cents", width=1024).drop("cents")


@query("pattern_run_by_type", sql="""
WITH x AS (
  SELECT event_id, event_type, value > 250 AS isa, lag(value > 250) OVER w AS prev_a, lag(event_id) OVER w AS prev_id
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id)),
r AS (SELECT *, sum(CASE WHEN isa AND NOT coalesce(prev_a, false) THEN 1 ELSE 0 END)
                OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run_no FROM x),
g AS (SELECT event_type, run_no, min(event_id) AS first_a, max(event_id) AS last_a, count(*) AS len,
             arg_min(prev_id, event_id) AS strt_id, bool_or(prev_id IS NULL) AS opens_key
      FROM r WHERE isa GROUP BY event_type, run_no)
SELECT event_type, CASE WHEN opens_key THEN first_a ELSE strt_id END AS start_event_id, last_a,
       CASE WHEN opens_key THEN len - 1 ELSE len END AS run_length
FROM g WHERE NOT opens_key OR len >= 2
""")
def pattern_run_by_type(spark, sf):
    """Runs of high values, in keys that span many blocks."""
    ev = _events(spark, sf).select("event_type", "event_id", "value")
    return P.start_then_run(ev, "event_type", "event_id", F.col("value") > 250, ["event_id"], width=1024)


@query("stream_sessions", sql=f"""
WITH s AS (
  SELECT user_id, event_id, ts, {_CENTS_SQL} AS cents,
         CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 1 HOUR
              THEN 1 ELSE 0 END AS st
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts) + INTERVAL 1 HOUR) AS end_us,
       count(*) AS n_events, CAST(sum(cents) AS BIGINT) AS sum_cents
FROM n GROUP BY user_id, sid
""")
def stream_sessions(spark, sf):
    """The events replayed as a stream in order of time, sessions closed by
    watermark and end marker, written by the sink that commits."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/rivulet-stream/{uuid.uuid4().hex}"
    ev = _events(spark, sf).where("ts is not null").select(
        "user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), cents().alias("cents"))
    ev.repartitionByRange("ts").sortWithinPartitions("ts").write.parquet(f"{root}/events")
    stream = until_end(replay_stream(spark, f"{root}/events", ev.schema, marker="ts"), "ts")
    sessions = session_windows(stream, "ts", "1 hour", ["user_id"],
                               [F.count(F.lit(1)).alias("n_events"), F.sum("cents").alias("sum_cents")])
    timed = sessions.select("user_id", F.unix_micros("session_start").alias("start_us"),
                            F.unix_micros("session_end").alias("end_us"), "n_events", "sum_cents")
    run_to_end(write_ledger(timed, f"{root}/out", f"{root}/checkpoint"))
    return committed(spark, f"{root}/out", timed.schema)


@query("stream_pattern_global", sql="""
WITH n AS (SELECT *, lead(event_type) OVER w AS nt, lead(ts) OVER w AS nts, lead(event_id) OVER w AS next_event_id
           FROM events WINDOW w AS (ORDER BY ts, event_id))
SELECT event_id, next_event_id FROM n
WHERE event_type = 'click' AND nt = 'purchase' AND nts < ts + INTERVAL 1 HOUR
""")
def stream_pattern_global(spark, sf):
    """The pattern over all keys in event time, on a replayed stream."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/rivulet-stream/{uuid.uuid4().hex}"
    ev = _events(spark, sf).where("ts is not null").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    ev.repartitionByRange("ts").sortWithinPartitions("ts").write.parquet(f"{root}/events")
    stream = until_end(replay_stream(spark, f"{root}/events", ev.schema, marker="ts"), "ts")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKSDB_PROVIDER)  # a query takes it when it starts
    try:
        hits = followed_by_in_time(stream, "ts", "event_id", F.col("event_type") == "click",
                                   F.col("event_type") == "purchase", "1 hour", [], "1 day")
        found = hits.select("event_id", "next_event_id")
        run_to_end(write_ledger(found, f"{root}/out", f"{root}/checkpoint"))
    finally:
        spark.conf.set(provider, before)
    return committed(spark, f"{root}/out", found.schema)
