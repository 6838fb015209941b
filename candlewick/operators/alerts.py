"""Alert engine as DataFrame operators (D-DUP, D-FSM, J4, D-ESC, D-RTE, D-PAY,
A5, T2, T4, F4, F10, F11).

Order of the reference engine is kept: cooldown dedup first, then the
breaker state machine on the accepted alerts, then routing and counting with
the escalated severity.

Cooldown dedup is a sequential fold ("kept if no *kept* alert of the same
type and symbol in the last c seconds"). It is made parallel exactly, on one
path for every size:

1. Each key's timeline is cut into buckets of a number of cooldowns that follows
   from the key's counted density. A
   bucket does not know which of its first alerts the bucket before leaves
   eligible, so it works out the last time it keeps for each of them.
2. These (start, exit) pairs link the buckets; pointer doubling over them
   (``_starts``) finds where each bucket really starts.
3. Each bucket is then folded once from its start.

A task holds the distinct alert times of one key in one bucket, a bounded number unless two cooldowns hold more.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.ordered import DEFAULT_BUCKET_US, prefix_max_before
from candlewick.session import materialize
from candlewick.sources.decode import iso_utc

# Cooldown per alert type (seconds), default for other types
COOLDOWNS_S = {"CIRCUIT_BREAKER": 300, "PRICE_SPIKE": 60, "VOLUME_SPIKE": 30}
DEFAULT_COOLDOWN_S = 60
BREAKER_TIMEOUT_S = 300  # OPEN -> HALF_OPEN after five minutes
FOLD_COOLDOWNS = 720  # width of a fold bucket in cooldowns, and its alert times where a key is dense;
FOLD_ROWS = 100_000  # they bound a task, never the result

KEYS = ["alert_type", "symbol"]


def cooldown_us(alert_type: F.Column) -> F.Column:
    c = F.lit(DEFAULT_COOLDOWN_S * 1_000_000)
    expr = None
    for t, s in COOLDOWNS_S.items():
        expr = (F.when(alert_type == t, F.lit(s * 1_000_000)) if expr is None
                else expr.when(alert_type == t, F.lit(s * 1_000_000)))
    return expr.otherwise(c).cast("long")


def _key(name: str) -> F.Column:
    """A missing type or symbol is a key like any other."""
    return F.coalesce(F.col(name), F.lit("\u0000"))


def _cells(alerts: DataFrame, cooldowns: int, rows: int) -> DataFrame:
    """Distinct alert times of each key with their bucket ``b``, ``width`` cooldowns wide: up to ``cooldowns``, fewer where a
    key is dense, so that a bucket holds ``rows`` times at most, or those of two cooldowns."""
    t = alerts.select(*[_key(k).alias(k) for k in KEYS], "u", cooldown_us(F.col("alert_type")).alias("cd")).distinct()
    per_cooldown = t.groupBy(*KEYS, F.floor(F.col("u") / F.col("cd")).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    width = F.greatest(F.lit(min(2, cooldowns)), F.least(F.lit(cooldowns), F.floor(F.lit(rows) / F.max("n")))).cast("long")
    t = t.join(per_cooldown.groupBy(*KEYS).agg(width.alias("width")), KEYS)
    return t.select("*", F.floor(F.col("u") / (F.col("cd") * F.col("width"))).alias("b"))


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """For every time a bucket may start to keep at: the last time it then keeps."""
    u, cd, b, width = np.sort(pdf["u"].to_numpy()), pdf["cd"].iat[0], pdf["b"].iat[0], pdf["width"].iat[0]
    own = np.arange(len(u))
    after = np.searchsorted(u, u + cd)
    last = np.where(after < len(u), after, own)
    while (last[last] != last).any():
        last = last[last]
    # an earlier kept time blocks less than one cooldown of the bucket
    n = min(len(u), int(np.searchsorted(u, b * width * cd + cd)) + 1)
    return pd.DataFrame({"alert_type": pdf["alert_type"].iat[0], "symbol": pdf["symbol"].iat[0], "cd": cd, "b": b,
                         "start": u[:n], "exit": u[last[:n]], "first_u": u[0], "last_u": u[-1]})


def _kept_times(pdf: pd.DataFrame) -> pd.DataFrame:
    """The times one bucket keeps, from its known start on."""
    u, cd = np.sort(pdf["u"].to_numpy()), pdf["cd"].iat[0]
    kept, at = [], int(np.searchsorted(u, pdf["start"].iat[0]))
    while at < len(u):
        kept.append(u[at])
        at = int(np.searchsorted(u, u[at] + cd))
    return pd.DataFrame({"alert_type": pdf["alert_type"].iat[0], "symbol": pdf["symbol"].iat[0], "u": kept})


def _starts(exits: DataFrame) -> DataFrame:
    """The time each bucket really starts to keep at (no row: it keeps nothing).

    A bucket whose first alert comes a cooldown or more after the bucket before starts there. Every other start is
    the first alert a cooldown or more after an exit; it lies in the next bucket or opens the one behind it. These
    pointers are followed by doubling, in as many rounds as the logarithm of the longest run of linked buckets.
    """
    w = Window.partitionBy(*KEYS).orderBy("b")  # one row per key and bucket
    per_b = exits.groupBy(*KEYS, "cd", "b").agg(F.first("first_u").alias("first_u"), F.first("last_u").alias("last_u"))
    prev_last = F.lag("last_u").over(w)
    per_b = per_b.select(
        *KEYS, "b", "first_u", F.lead("b").over(w).alias("next_b"), F.lead("first_u", 2).over(w).alias("behind_u"),
        (prev_last.isNull() | (F.col("first_u") - prev_last >= F.col("cd"))).alias("fresh"))
    heads = per_b.where("fresh").select(*KEYS, F.col("first_u").alias("start"))
    probes = exits.join(per_b.select(*KEYS, "b", "next_b", "behind_u"), [*KEYS, "b"]).where("next_b is not null").select(
        *KEYS, F.col("next_b").alias("b"), (F.col("exit") + F.col("cd")).alias("at"), F.lit(0).alias("kind"), "start",
        "behind_u")
    points = exits.select(*KEYS, "b", F.col("start").alias("at"), F.lit(1).alias("kind"))
    ahead = Window.partitionBy(*KEYS, "b").orderBy("at", "kind").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    found = F.first(F.when(F.col("kind") == 1, F.col("at")), ignorenulls=True).over(ahead)
    jump = probes.unionByName(points, allowMissingColumns=True).select("*", found.alias("found")).where("kind = 0")
    jump = jump.select(*KEYS, "start", F.coalesce("found", "behind_u").alias("next")).where("next is not null")
    jump = materialize(jump.join(heads.withColumnRenamed("start", "next"), [*KEYS, "next"], "left_anti"))
    reached = heads
    while not jump.isEmpty():
        step = reached.join(jump, [*KEYS, "start"]).select(*KEYS, F.col("next").alias("start"))
        reached = materialize(reached.unionByName(step))
        far = jump.select(*KEYS, F.col("start").alias("next"), F.col("next").alias("far"))
        jump = materialize(jump.join(far, [*KEYS, "next"]).select(*KEYS, "start", F.col("far").alias("next")))
    return reached


def dedup_cooldown(alerts: DataFrame, cooldowns: int = FOLD_COOLDOWNS, input_materialized: bool = False,
                   rows: int = FOLD_ROWS) -> DataFrame:
    """D-DUP: keep an alert iff no alert of the same (type, symbol) was kept in
    the previous cooldown (exactly c later is kept). Suppressed alerts do not
    extend the cooldown. Of several alerts of one key at the same instant the
    least by (seq, all columns) counts; a null type or symbol is a key like any
    other. ``cooldowns`` and ``rows`` bound a fold bucket; they do not change
    the result."""
    cols = alerts.columns
    if not input_materialized:
        alerts = materialize(alerts)
    cells = materialize(_cells(alerts, cooldowns, rows))  # narrow, and read twice
    key_cols = "alert_type string, symbol string"
    exits = materialize(cells.groupBy(*KEYS, "b").applyInPandas(
        _exits, f"{key_cols}, cd long, b long, start long, exit long, first_u long, last_u long"))
    starts = _starts(exits).join(exits.select(*KEYS, "b", "start"), [*KEYS, "start"])
    times = cells.join(starts, [*KEYS, "b"]).groupBy(*KEYS, "b").applyInPandas(_kept_times, f"{key_cols}, u long")
    times = times.select(*[F.col(k).alias(f"__{k}") for k in KEYS], F.col("u").alias("__u"))
    same = (_key("alert_type") == F.col("__alert_type")) & (_key("symbol") == F.col("__symbol")) & (F.col("u") == F.col("__u"))
    kept = alerts.join(times, same, "left_semi").groupBy(*KEYS, "u").agg(
        F.min(F.struct("seq", F.struct(*cols).alias("r"))).alias("x"))
    return kept.select("x.r.*")


def breaker_states(kept: DataFrame, timeout_s: int = BREAKER_TIMEOUT_S, reset_after_s: int | None = None,
                   bucket_us: int = DEFAULT_BUCKET_US, carried_trips: DataFrame | None = None) -> DataFrame:
    """D-FSM / J4: for each accepted alert, the breaker state of its symbol
    just before it: last accepted CIRCUIT_BREAKER strictly earlier (as-of);
    none -> CLOSED, within ``timeout_s`` -> OPEN, later -> HALF_OPEN. Nothing
    resets a breaker unless ``reset_after_s`` is given (D6). ``carried_trips``
    (symbol, carried_trip_u) are the last trips before these alerts."""
    k = prefix_max_before(kept, "symbol", F.when(F.col("alert_type") == "CIRCUIT_BREAKER", F.col("u")),
                          "trip_u", seq=["seq", "fan"], bucket_us=bucket_us)
    if carried_trips is not None:
        k = k.join(carried_trips, "symbol", "left").withColumn("trip_u", F.greatest("trip_u", "carried_trip_u")).drop("carried_trip_u")
    age = F.col("u") - F.col("trip_u")
    state = F.when(F.col("trip_u").isNull(), "CLOSED")
    if reset_after_s is not None:
        state = state.when(age > F.lit(reset_after_s * 1_000_000), "CLOSED")
    state = state.when(age <= F.lit(timeout_s * 1_000_000), "OPEN").otherwise("HALF_OPEN")
    return k.select("*", state.alias("breaker_state"))


def escalate(with_state: DataFrame) -> DataFrame:
    """D-ESC: PRICE_SPIKE while the breaker is not CLOSED becomes CRITICAL."""
    esc = (F.col("alert_type") == "PRICE_SPIKE") & (F.col("breaker_state") != "CLOSED")
    cols = [c for c in with_state.columns if c != "severity"]
    return with_state.select(*cols, F.col("severity").alias("original_severity"),
                             F.when(esc, F.lit("CRITICAL")).otherwise(F.col("severity")).alias("severity"))


def alerts_final(raw: DataFrame, **kw) -> DataFrame:
    # both the breaker lookup and its bucket table read the kept alerts
    kept = materialize(dedup_cooldown(raw, **{k: v for k, v in kw.items() if k in ("cooldowns", "input_materialized")}))
    st = breaker_states(kept, **{k: v for k, v in kw.items() if k in ("timeout_s", "reset_after_s", "bucket_us")})
    return escalate(st).drop("trip_u")


def breaker_report(final: DataFrame) -> DataFrame:
    """Breaker state seen by each accepted PRICE_SPIKE."""
    return final.filter(F.col("alert_type") == "PRICE_SPIKE").select(
        "alert_id", "symbol", "triggered_at", "breaker_state", "severity")


def deliveries(final: DataFrame, webhook_url: str | None = None) -> DataFrame:
    """D-RTE / D-PAY: outbox rows, one per (alert, channel). CRITICAL ->
    webhook + log_critical, HIGH -> webhook + log_high, MEDIUM -> log_medium,
    otherwise log_low; the webhook channel is ``webhook_stub`` without a URL.
    Webhook rows carry the JSON payload."""
    hook = "webhook" if webhook_url else "webhook_stub"
    sev = F.col("severity")
    channels = (F.when(sev == "CRITICAL", F.array(F.lit(hook), F.lit("log_critical")))
                .when(sev == "HIGH", F.array(F.lit(hook), F.lit("log_high")))
                .when(sev == "MEDIUM", F.array(F.lit("log_medium")))
                .otherwise(F.array(F.lit("log_low"))))
    ts_txt = iso_utc(F.col("triggered_at"))
    text = F.concat(F.lit("*["), sev, F.lit("] "), F.col("alert_type"), F.lit("*\n"), F.col("message"))
    payload = F.to_json(F.struct(
        text.alias("text"),
        F.struct(F.col("alert_id").alias("id"), F.col("alert_type").alias("type"), sev.alias("severity"),
                 F.col("symbol").alias("symbol"), ts_txt.alias("ts")).alias("alert")))
    d = final.select("alert_id", "alert_type", "severity", "symbol", "message", "triggered_at",
                     F.explode(channels).alias("channel"))
    is_hook = F.col("channel").startswith("webhook")
    return d.select("alert_id", "alert_type", "severity", "symbol", "channel",
                    F.when(is_hook, text).alias("webhook_text"),
                    F.when(is_hook, payload).alias("payload"))


def alert_counts(final: DataFrame) -> DataFrame:
    """Total, per symbol and per severity in one grouping-sets pass
    (no alerts: no rows)."""
    g = final.groupingSets([[], [F.col("symbol")], [F.col("severity")]], "symbol", "severity").agg(
        F.grouping_id("symbol", "severity").cast("int").alias("gid"), F.count(F.lit(1)).alias("alert_count"))
    return g.select("gid", "symbol", "severity", "alert_count")


def _newest_first(df: DataFrame):
    return [F.col("u").desc(), F.col("seq").desc(), F.col("fan").desc()]


def _text(df: DataFrame) -> DataFrame:
    from candlewick.operators.detect import with_message
    return df if "message" in df.columns else with_message(df)


def recent_alerts(final: DataFrame, n: int = 100) -> DataFrame:
    """The newest ``n`` accepted alerts (top-k, no full sort); the
    text is built for those ``n`` rows only."""
    top = final.orderBy(*_newest_first(final)).limit(n)
    return _text(top).select("alert_id", "alert_type", "severity", "symbol", "message", "triggered_at")


def ack_requests_fixture(raw: DataFrame, final: DataFrame) -> DataFrame:
    """Acknowledge requests derived from the data: every accepted
    CIRCUIT_BREAKER is acknowledged 60 s after it fired by ``api-user`` and
    again 120 s after by ``desk-2`` (second request must fail); every
    suppressed alert id gets one request (unknown id, must fail)."""
    cb = final.filter(F.col("alert_type") == "CIRCUIT_BREAKER").select("alert_id", "u")
    r1 = cb.select("alert_id", (F.col("u") + 60_000_000).alias("req_u"), F.lit("api-user").alias("acknowledged_by"))
    r2 = cb.select("alert_id", (F.col("u") + 120_000_000).alias("req_u"), F.lit("desk-2").alias("acknowledged_by"))
    sup = raw.join(final.select("alert_id"), "alert_id", "left_anti").select(
        "alert_id", (F.col("u") + 60_000_000).alias("req_u"), F.lit("api-user").alias("acknowledged_by"))
    return r1.unionByName(r2).unionByName(sup)


def acknowledge(final: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """apply acknowledge requests (alert_id, req_u, acknowledged_by).

    An update succeeds only for an existing alert that is not yet
    acknowledged, so per alert the earliest request wins and later ones are
    "not found". Returns (per-request status, alert table with ack columns).
    """
    from candlewick.functions.timecols import ntz_from_micros

    win = requests.groupBy("alert_id").agg(F.min(F.struct("req_u", "acknowledged_by")).alias("w"))
    exists = final.select("alert_id", F.lit(True).alias("exists"))
    status = (requests.join(win, "alert_id").join(exists, "alert_id", "left")
              .select("alert_id", ntz_from_micros("req_u").alias("requested_at"), "acknowledged_by",
                      F.when(F.coalesce(F.col("exists"), F.lit(False))
                             & (F.col("w.req_u") == F.col("req_u"))
                             & (F.col("w.acknowledged_by") == F.col("acknowledged_by")),
                             F.lit("acknowledged")).otherwise(F.lit("not_found")).alias("status")))
    table = (final.join(win, "alert_id", "left")
             .withColumn("acknowledged", F.col("w").isNotNull())
             .withColumn("acknowledged_at", ntz_from_micros(F.col("w.req_u")))
             .withColumn("acknowledged_by", F.col("w.acknowledged_by"))
             .drop("w"))
    return status, table


def alerts_filtered(table: DataFrame, symbol: str | None = None, severity: str | None = None,
                    unacked_only: bool = False, limit: int = 50) -> DataFrame:
    """F4 + T2: optional conjunctive filters, newest first, ``limit`` 1-500."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be in [1, 500]")
    t = table
    if symbol:
        t = t.filter(F.col("symbol") == symbol.strip().upper())
    if severity:
        t = t.filter(F.col("severity") == severity.strip().upper())
    if unacked_only:
        t = t.filter(~F.col("acknowledged"))
    top = t.orderBy(*_newest_first(t)).limit(limit)
    return _text(top).select("alert_id", "alert_type", "severity", "symbol", "message", "triggered_at",
                             "acknowledged")


def whales(final: DataFrame) -> DataFrame:
    """accepted VOLUME_SPIKE alerts, biggest multiplier first."""
    return final.filter(F.col("alert_type") == "VOLUME_SPIKE").select(
        "alert_id", "symbol", "triggered_at", "quantity", "avg_volume", "multiplier").orderBy(
        F.desc("multiplier"), "triggered_at", "alert_id")
