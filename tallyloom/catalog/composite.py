"""Episodes, populations, reconciliation and rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import dates
from tallyloom.operators import groups, intervals, joins
from tallyloom.plans import episodes, facts, measures, population, reconcile, scores, utilisation
from tallyloom.session import materialise

# ---------------------------------------------------------------- simple measures


# Billing lines carry one of two codes, charges and payments, active and not; quantities of a code may
# add up to zero or less. Owners have two versions with a month between them.
BILLED = """billing AS (
  SELECT l_orderkey, CASE WHEN l_partkey % 3 = 0 THEN '90791' ELSE '90832' END AS code, CAST(l_quantity AS INTEGER) - 25 AS quantity,
         CASE WHEN l_linestatus = 'F' THEN 'Charge' ELSE 'payment' END AS kind, CAST(l_suppkey % 10 = 0 AS INTEGER) AS inactive
  FROM lineitem),
owners AS (
  SELECT k AS owner_key, v, CASE WHEN v = 1 THEN DATE '1990-01-01' ELSE DATE '1998-02-01' + CAST(k AS INTEGER) END AS valid_from,
         CASE WHEN v = 1 THEN DATE '1997-12-31' + CAST(k AS INTEGER) END AS valid_to
  FROM (SELECT DISTINCT s_suppkey % 10 AS k FROM supplier), (VALUES (1), (2)) x(v)),
billed AS (
  SELECT o_orderkey, o_custkey, o_date, month, code, quantity FROM orders_d
  JOIN (SELECT l_orderkey, code, sum(quantity) AS quantity FROM billing
        WHERE code = '90791' AND lower(kind) = 'charge' AND inactive = 0 GROUP BY 1, 2 HAVING sum(quantity) > 0) ON l_orderkey = o_orderkey
  JOIN owners ON owner_key = o_orderkey % 10 AND o_date >= valid_from AND (valid_to IS NULL OR o_date <= valid_to)
  WHERE o_orderkey > 0)"""


def billed(spark, d):
    """Encounters with a positive billed quantity of the intake code, whose owner is on duty that day."""
    encounters = fx.orders(spark, d).select(
        F.col("o_orderkey").alias("encounter"), F.col("o_custkey").alias("subject"), F.col("o_date").alias("day"),
        (F.col("o_orderkey") % 10).alias("owner_key"),
    )
    billing = fx.t(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("encounter"), F.when(F.col("l_partkey") % 3 == 0, "90791").otherwise("90832").alias("code"),
        (F.col("l_quantity").cast("int") - 25).alias("quantity"),
        F.when(F.col("l_linestatus") == "F", "Charge").otherwise("payment").alias("transaction"),
        (F.col("l_suppkey") % 10 == 0).cast("int").alias("inactive"),
    )
    keys = fx.t(spark, d, "supplier").select((F.col("s_suppkey") % 10).alias("owner_key")).distinct()
    shift = F.col("owner_key").cast("int")
    owners = keys.select(
        "owner_key",
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("owner"), dates.day("1990-01-01").alias("valid_from"), F.date_add(dates.day("1997-12-31"), shift).alias("valid_to")),
                F.struct(F.lit(2).alias("owner"), F.date_add(dates.day("1998-02-01"), shift).alias("valid_from"), F.lit(None).cast("date").alias("valid_to")),
            )
        ),
    )
    return facts.billed_encounters(encounters, billing, owners, ["90791"])


@query("measure_event_count", f"""
WITH {fx.counts_sql()}, {BILLED}, num AS (
  SELECT month, site, CAST(count(DISTINCT o_orderkey) AS DOUBLE) AS numerator
  FROM billed JOIN sites ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT num.month, num.site, numerator, CAST(n AS DOUBLE) AS denominator
FROM num LEFT JOIN counts c ON c.site = num.site AND c.month = num.month""")
def measure_event_count(spark, d):
    ev = billed(spark, d).join(fx.sites(spark, d), F.col("subject") == F.col("c_custkey"))
    den = fx.counts(spark, d).select("site", "month", F.col("n").cast("double").alias("denominator"))
    return measures.event_measure(ev, den, "site", "day", "encounter")


@query("billed_encounters", f"""
WITH {fx.ORDERS}, {BILLED} SELECT o_orderkey AS encounter, o_custkey AS subject, o_date AS day, code, CAST(quantity AS BIGINT) AS quantity FROM billed""")
def billed_encounters(spark, d):
    return billed(spark, d).select("encounter", "subject", "day", "code", "quantity")


# Several answers a day, the last hour counts; ties of hour and value stay.
@query("latest_answers", f"""
WITH {fx.EVENTS}, a AS (SELECT DISTINCT user_id, event_type AS question, day, hour(ts) AS hr, round(value) AS response FROM ev)
SELECT user_id, question, day, hr, response FROM a
QUALIFY dense_rank() OVER (PARTITION BY user_id, question ORDER BY day DESC, hr DESC, response DESC) = 1""")
def latest_answers(spark, d):
    answers = fx.events(spark, d).select(
        "user_id", F.col("event_type").alias("question"), "day", F.hour("ts").cast("long").alias("hr"), F.round("value").alias("response")
    )
    return facts.latest_answers(answers, ["user_id", "question"], [("day", True), ("hr", True), ("response", True)])


FLAGGED = fx.EVENTS + """, fl AS (
  SELECT user_id, user_id % 3 AS site, day, event_type, event_id, CASE WHEN event_id % 3 > 0 THEN event_id % 2 END AS flag FROM ev)"""


# The flag varies within subject and site: only the first day's flags can match.
@query("measure_after_first", f"""
WITH {FLAGGED}, sc AS (
  SELECT DISTINCT user_id, site, flag, day AS first_score FROM fl WHERE event_type = 'click'
  QUALIFY day = min(day) OVER (PARTITION BY user_id, site)),
num AS (SELECT CAST(date_trunc('month', fl.day) AS DATE) AS month, fl.site, CAST(count(DISTINCT event_id) AS DOUBLE) AS numerator
  FROM fl JOIN sc ON sc.user_id = fl.user_id AND sc.site = fl.site AND sc.flag IS NOT DISTINCT FROM fl.flag
  WHERE event_type = 'purchase' AND fl.day > first_score GROUP BY 1, 2),
den AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, site, CAST(count(*) AS DOUBLE) AS denominator
  FROM fl WHERE event_type = 'signup' GROUP BY 1, 2)
SELECT num.month, num.site, numerator, denominator FROM num LEFT JOIN den ON den.month = num.month AND den.site = num.site""")
def measure_after_first(spark, d):
    ev = fx.events(spark, d).select(
        "event_id", "user_id", "day", "event_type", (F.col("user_id") % 3).alias("site"),
        F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 2).alias("flag"),
    )
    first_scores = ev.filter("event_type = 'click'").withColumnRenamed("day", "score_day")
    kept = measures.events_after_first(
        ev.filter("event_type = 'purchase'"), first_scores, ["user_id", "site"], ["user_id", "site", "flag"], "day", "score_day"
    )
    intake = ev.filter("event_type = 'signup'").groupBy(F.trunc("day", "MM").alias("month"), "site")
    return measures.event_measure(kept, intake.agg(F.count("*").cast("double").alias("denominator")), "site", "day", "event_id")


# ---------------------------------------------------------------- scores and episodes


def owner(n):
    return F.concat(F.lit("P"), (F.col("event_id") % n).cast("string"))


def user_scores(spark, d, kind, prefix, *by):
    """Best score of one kind per user-day, and who entered it."""
    ev = fx.events(spark, d).filter(F.col("event_type") == kind)
    return ev.groupBy("user_id", "day", *by).agg(
        F.max("value").alias(prefix + "_score"), F.min(owner(5)).alias(prefix + "_owner")
    )


# Scores take part in picking the visit: latest type, then both scores, then the event.
@query("preferred_score", f"""
WITH {fx.EVENTS}, v AS (SELECT user_id, day, event_id, event_type FROM ev WHERE event_type IN ('view', 'signup')),
a AS (SELECT user_id, day, event_id % 2 AS k, max(value) AS s, min('P' || CAST(event_id % 5 AS VARCHAR)) AS o FROM ev WHERE event_type = 'click' GROUP BY 1, 2, 3),
b AS (SELECT user_id, day, event_id % 2 AS k, max(value) AS s, min('P' || CAST(event_id % 5 AS VARCHAR)) AS o FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2, 3)
SELECT v.user_id, v.day, v.event_id, coalesce(b.s, a.s) AS score,
  CASE WHEN b.s IS NOT NULL THEN b.o WHEN a.s IS NOT NULL THEN a.o END AS entered_by
FROM v LEFT JOIN a ON a.user_id = v.user_id AND a.day = v.day AND a.k = v.event_id % 2
  LEFT JOIN b ON b.user_id = v.user_id AND b.day = v.day AND b.k = v.event_id % 2
QUALIFY row_number() OVER (PARTITION BY v.user_id, v.day
  ORDER BY event_type DESC, b.s DESC NULLS LAST, a.s DESC NULLS LAST, v.event_id DESC) = 1""")
def preferred_score(spark, d):
    half = (F.col("event_id") % 2).alias("k")
    visits = fx.events(spark, d).filter(F.col("event_type").isin("view", "signup")).select(
        "user_id", "day", half, "event_id", "event_type"
    )
    order = [F.desc_nulls_last(c) for c in ("event_type", "staff_score", "self_score", "event_id")]
    best = scores.preferred(
        visits, user_scores(spark, d, "click", "self", half), user_scores(spark, d, "purchase", "staff", half),
        ["user_id", "day", "k"], order, per=["user_id", "day"],
    )
    return best.select("user_id", "day", "event_id", "score", "entered_by")


RULES = episodes.EpisodeRules(
    gap=3, quiet=1, min_visits=1, report_from="2024-01-05", seen_from="2024-01-03", target_score=40.0, improved_share=0.4
)
AS_OF = "2024-03-01"


def user_days(spark, d):
    """Subject-days: sign-ups are intake visits, errors end markers, the rest visits."""
    ev = fx.events(spark, d).select(
        "user_id", "day", owner(2).alias("owner"), "event_type",
        F.when(F.col("event_type") != "view", F.col("value")).alias("score"),
    )
    visits = ev.filter("event_type <> 'error'").select(
        "user_id", "day", "owner", "score", F.upper("event_type").alias("code"),
        (F.col("event_type") == "signup").cast("int").alias("start"),
    )
    ends = ev.filter("event_type = 'error'").select("user_id", "day", "owner", "score", F.lit("end of treatment").alias("value"))
    return episodes.collapse_days(visits, ends, ["user_id"])


DAYS = f"""{fx.EVENTS}, raw AS (
  SELECT user_id, day, 'P' || CAST(event_id % 2 AS VARCHAR) AS owner, CASE WHEN event_type <> 'view' THEN value END AS score,
    CASE WHEN event_type = 'error' THEN '' ELSE upper(event_type) END AS code,
    CASE WHEN event_type = 'error' THEN 'end of treatment' ELSE '' END AS value,
    CAST(event_type = 'signup' AS DOUBLE) AS s, CAST(event_type = 'error' AS DOUBLE) AS e,
    CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS source FROM ev),
own AS (SELECT user_id, day, owner FROM raw QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY source, owner) = 1),
agg AS (SELECT user_id, day, nullif(max(coalesce(score, -1)), -1) AS score, max(value) AS value, max(code) AS code,
          max(s) AS s, max(e) AS e FROM raw GROUP BY 1, 2),
days AS (SELECT agg.user_id, agg.day, score, value, code, own.owner, e,
    CASE WHEN s = 0 AND e = 0 AND lag(e) OVER (PARTITION BY agg.user_id ORDER BY agg.day) = 1 THEN 1.1 ELSE s END AS s
  FROM agg JOIN own ON own.user_id = agg.user_id AND own.day = agg.day)"""

# start x end join, then the latest start of each end: the long way round
PAIRS = DAYS + """, c0 AS (
  SELECT a.user_id, a.day AS start_date, a.owner AS start_owner, a.s AS start_flag, b.day AS end_date,
         b.owner AS end_owner, b.e AS end_flag
  FROM days a LEFT JOIN (SELECT * FROM days WHERE e = 1) b ON a.user_id = b.user_id AND a.day < b.day WHERE a.s > 0),
pairs AS (SELECT * FROM c0 WHERE end_date IS NULL UNION ALL
  SELECT * FROM (SELECT * FROM c0 WHERE end_date IS NOT NULL
                 QUALIFY start_date = max(start_date) OVER (PARTITION BY user_id, end_date)))"""

EPISODES = PAIRS + """, c1 AS (
  SELECT *, lead(end_date) OVER w AS next_end, lag(end_date) OVER w AS last_end, row_number() OVER w AS srn,
         min(end_date) OVER (PARTITION BY user_id, start_date) AS first_end
  FROM pairs WINDOW w AS (PARTITION BY user_id, start_date ORDER BY end_date)),
c2a AS (SELECT * FROM c1 WHERE end_date - first_end < 3 QUALIFY srn = max(srn) OVER (PARTITION BY user_id, start_date)),
c2c AS (SELECT *, lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date) AS next_start FROM c1 WHERE first_end IS NULL),
all_ep AS (
  SELECT user_id, start_date, start_owner, end_date, end_owner, start_flag, end_flag FROM c2a
  UNION ALL SELECT user_id, CASE WHEN srn > 2 AND end_date - last_end >= 3 THEN last_end + 1 ELSE first_end + 3 END, start_owner,
    CASE WHEN next_end - end_date < 3 THEN next_end ELSE end_date END, end_owner, 1.2, end_flag
  FROM c1 WHERE end_date - first_end >= 3
  UNION ALL SELECT user_id, start_date, start_owner, next_start - 1, end_owner, start_flag, 1.1 FROM c2c),
ep AS (SELECT * FROM all_ep WHERE start_owner = end_owner OR end_owner IS NULL)"""

STATS = EPISODES + """, st AS (
  SELECT ep.user_id, start_date, end_date, start_owner, end_owner, start_flag, end_flag,
         count(DISTINCT day) AS visits, max(day) AS last_seen
  FROM ep JOIN days ON days.user_id = ep.user_id
  WHERE day >= start_date AND (day <= end_date OR end_date IS NULL) AND code <> '' GROUP BY ALL)"""

LOST = STATS + """, ltfu AS (
  SELECT *, CASE WHEN end_date IS NULL THEN last_seen + 1 END AS ltfu_date FROM st
  WHERE ((end_date IS NOT NULL AND end_date >= DATE '2024-01-05')
      OR (end_date IS NULL AND visits >= 1 AND last_seen >= DATE '2024-01-03'))
    AND NOT (end_date IS NULL AND last_seen + 1 >= DATE '2024-03-01')),
lost AS (SELECT user_id, start_date, coalesce(end_date, ltfu_date) AS end_date, start_owner, end_owner, start_flag, end_flag,
  visits, last_seen, ltfu_date, CAST(CASE WHEN end_date IS NOT NULL THEN date_trunc('month', end_date)
     WHEN ltfu_date < DATE '2024-01-05' THEN DATE '2024-01-05'
     ELSE date_trunc('month', ltfu_date) + INTERVAL 1 MONTH END AS DATE) AS report_month,
  CASE WHEN end_date IS NULL THEN 'Y' ELSE 'N' END AS lost FROM ltfu)"""

SCORED = LOST + """, firsts AS (
  SELECT DISTINCT l.user_id, l.start_date, l.end_date, d.day AS first_score_day, d.score AS first_score
  FROM lost l JOIN days d ON d.user_id = l.user_id AND d.day BETWEEN l.start_date AND l.end_date WHERE d.score IS NOT NULL
  QUALIFY d.day = min(d.day) OVER (PARTITION BY l.user_id, l.start_date, l.end_date)),
scored AS (SELECT l.*, d.score AS final_score, f.first_score_day, f.first_score FROM lost l
  JOIN days d ON d.user_id = l.user_id AND d.day = CASE WHEN l.lost = 'N' THEN l.end_date ELSE l.last_seen END AND d.score IS NOT NULL
  LEFT JOIN firsts f ON f.user_id = l.user_id AND f.start_date = l.start_date AND f.end_date = l.end_date)"""

EP_COLS = "user_id, start_date, end_date, start_owner, end_owner, start_flag, end_flag"


@query("day_collapse", f"""WITH {DAYS} SELECT user_id, day, score, value, code, owner, s AS start, e AS "end" FROM days""")
def day_collapse(spark, d):
    return user_days(spark, d)


@query("episode_pair", f"WITH {PAIRS} SELECT {EP_COLS} FROM pairs")
def episode_pair(spark, d):
    return episodes.pair(user_days(spark, d), ["user_id"])


def user_episodes(days):
    return episodes.build(episodes.pair(days, ["user_id"]), ["user_id"], RULES)


@query("episode_build", f"WITH {EPISODES} SELECT {EP_COLS} FROM ep")
def episode_build(spark, d):
    return user_episodes(user_days(spark, d))


def user_stats(spark, d):
    # day rows are read twice, by the episodes and by their visits
    days = materialise(user_days(spark, d))
    return episodes.episode_stats(user_episodes(days), days, ["user_id"])


@query("episode_visits", f"WITH {STATS} SELECT {EP_COLS}, visits, last_seen FROM st")
def episode_visits(spark, d):
    return user_stats(spark, d).select(*[c.strip() for c in EP_COLS.split(",")], "visits", "last_seen")


@query("lost_to_follow_up", f"""
WITH {LOST} SELECT {EP_COLS}, visits, last_seen, ltfu_date, report_month, lost FROM lost""")
def lost_to_follow_up(spark, d):
    reported = episodes.lost_to_follow_up(user_stats(spark, d), dates.day(AS_OF), RULES)
    return reported.drop("seen_score", "end_score", "first_score_day", "first_score")


def scored_episodes(spark, d):
    return episodes.attach_scores(episodes.lost_to_follow_up(user_stats(spark, d), dates.day(AS_OF), RULES))


@query("episode_scores", f"""
WITH {SCORED} SELECT {EP_COLS}, visits, last_seen, ltfu_date, report_month, lost, final_score, first_score_day, first_score FROM scored""")
def episode_scores(spark, d):
    return scored_episodes(spark, d)


@query("measure_improved", f"""
WITH {SCORED} SELECT report_month AS month, start_owner AS site, CAST(count(*) AS DOUBLE) AS denominator,
  CAST(sum(CASE WHEN final_score <= 40 OR (first_score <> 0 AND (final_score - first_score) / first_score <= -0.4)
           THEN 1 ELSE 0 END) AS DOUBLE) AS numerator
FROM scored WHERE report_month < DATE '2024-03-01' GROUP BY 1, 2""")
def measure_improved(spark, d):
    scored = scored_episodes(spark, d).withColumn("site", F.col("start_owner"))
    return episodes.improved_measure(scored, dates.day(AS_OF), ["site"], RULES)


@query("subject_first_last", f"""
WITH {fx.EVENTS}, w AS (SELECT *, min(day) OVER (PARTITION BY user_id) AS first_day, max(day) OVER (PARTITION BY user_id) AS last_day FROM ev)
SELECT user_id, first_day, last_day, max(CASE WHEN day = first_day THEN value END) AS first_score,
  max(CASE WHEN day = last_day THEN value END) AS last_score FROM w GROUP BY 1, 2, 3""")
def subject_first_last(spark, d):
    return scores.first_last(fx.events(spark, d), ["user_id"], "day", "value")


DISCHARGED = f"""{fx.EVENTS}, base AS (SELECT user_id * 40 + day(day) % 10 * 4 + hour(ts) % 4 AS subject, day, CASE WHEN event_id % 9 > 0 THEN event_type = 'error' END AS dis,
  CASE WHEN event_type = 'view' THEN value ELSE 0 END AS a, CASE WHEN event_type = 'click' THEN value ELSE 0 END AS b,
  CASE WHEN event_type = 'error' AND user_id % 2 = 0 THEN 0 ELSE value END AS c FROM ev),
dis AS (SELECT subject, max(day) AS dis_day FROM base WHERE dis GROUP BY 1),
post AS (SELECT DISTINCT base.subject FROM base JOIN dis ON base.subject = dis.subject WHERE day > dis_day),
sc1 AS (SELECT subject, count(DISTINCT day) AS k FROM base WHERE dis AND subject NOT IN (SELECT subject FROM post) GROUP BY 1),
sc2 AS (SELECT subject, count(DISTINCT day) AS k FROM base WHERE NOT dis GROUP BY 1),
w AS (SELECT *, a + b + c AS score, min(day) OVER (PARTITION BY subject) AS first_day, max(day) OVER (PARTITION BY subject) AS last_day FROM base),
fl AS (SELECT subject, first_day, last_day, max(CASE WHEN day = first_day THEN score END) AS first_score,
         max(CASE WHEN day = last_day THEN score END) AS last_score FROM w GROUP BY 1, 2, 3),
both_lists AS (
  SELECT fl.*, k AS session_days, CAST(NULL AS DATE) AS follow_up, 'No' AS lost, CAST(date_trunc('month', last_day) AS DATE) AS month
  FROM fl JOIN sc1 ON fl.subject = sc1.subject
  UNION ALL SELECT fl.*, k, last_day + 2,
    CASE WHEN k >= 3 AND last_day + 2 <= DATE '2024-01-31' THEN 'Yes' ELSE 'Not Yet' END,
    CAST(date_trunc('month', last_day + 2) + INTERVAL 1 MONTH AS DATE) FROM fl JOIN sc2 ON fl.subject = sc2.subject),
zeros AS (SELECT subject FROM base GROUP BY 1 HAVING max(a) = 0 AND max(b) = 0 AND max(c) = 0),
split AS (SELECT * FROM both_lists WHERE subject NOT IN (SELECT subject FROM zeros)
          QUALIFY count(*) OVER (PARTITION BY subject) = 1)"""


@query("discharge_split", f"""
WITH {DISCHARGED} SELECT subject, first_day, last_day, round(first_score, 6) AS first_score,
  round(last_score, 6) AS last_score, session_days, follow_up, lost, month FROM split""")
def discharge_split(spark, d):
    return _discharged(spark, d).withColumns(
        {"first_score": F.round("first_score", 6), "last_score": F.round("last_score", 6)}
    )


def _discharged(spark, d):
    v, kind, err = F.col("value"), F.col("event_type"), F.col("event_type") == "error"
    base = fx.events(spark, d).select(
        (F.col("user_id") * 40 + F.dayofmonth("day") % 10 * 4 + F.hour("ts") % 4).alias("subject"), "day",
        F.when(F.col("event_id") % 9 > 0, kind).alias("code"),  # some rows have none
        F.when(kind == "view", v).otherwise(0.0).alias("a"),
        F.when(kind == "click", v).otherwise(0.0).alias("b"),
        F.when(err & (F.col("user_id") % 2 == 0), 0.0).otherwise(v).alias("c"),
    )
    return scores.discharge_split(
        base, "subject", "day", F.col("code") == "error", ["a", "b", "c"], dates.day("2024-02-15"), quiet=2, min_days=3
    )


@query("measure_improved_log", f"""
WITH {DISCHARGED} SELECT month, CAST(count(*) AS DOUBLE) AS denominator, CAST(sum(CASE WHEN last_score <= 40
  OR (first_score <> 0 AND (first_score - last_score) / first_score >= 0.4) THEN 1 ELSE 0 END) AS DOUBLE) AS numerator
FROM split WHERE month < DATE '2024-03-01' GROUP BY 1""")
def measure_improved_log(spark, d):
    split = _discharged(spark, d).withColumnsRenamed({"last_score": "final_score", "month": "report_month"})
    return episodes.improved_measure(split, dates.day(AS_OF), [], RULES)


FORM_ROWS = f"""{fx.ORDERS}, {fx.SITES}, form_rows AS (
  SELECT site, month, o_orderkey, o_totalprice / 10000 AS start_score,
    CASE WHEN o_orderstatus = 'F' THEN o_date + CAST(o_orderkey % 25 AS INTEGER) END AS end_date,
    o_totalprice / 10000 * (o_orderkey % 11) / 10 AS end_score,
    o_date - CAST(o_orderkey % 150 AS INTEGER) AS last_seen, o_orderkey % 10 AS sessions,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS pat_id
  FROM orders_d JOIN sites ON o_custkey = c_custkey)"""


@query("measure_improved_forms", f"""
WITH {FORM_ROWS}, k AS (SELECT site, month, CAST(count(*) AS DOUBLE) AS denominator,
    CAST(sum(CASE WHEN end_score <= 9 OR (start_score <> 0 AND (start_score - end_score) / start_score >= 0.4) THEN 1 ELSE 0 END) AS DOUBLE) AS numerator
  FROM form_rows WHERE pat_id IS NOT NULL AND (date_trunc('month', end_date) = month
    OR (sessions >= 6 AND last_seen < CAST(month + INTERVAL 1 MONTH AS DATE) - 91)) GROUP BY 1, 2)
SELECT f.site, f.month, numerator, denominator FROM (SELECT DISTINCT site, month FROM form_rows) f
LEFT JOIN k ON k.site = f.site AND k.month = f.month""")
def measure_improved_forms(spark, d):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    rows = fx.orders(spark, d).join(fx.sites(spark, d), F.col("o_custkey") == F.col("c_custkey")).select(
        "site", "month", (price / 10000).alias("start_score"),
        F.when(F.col("o_orderstatus") == "F", F.date_add("o_date", (key % 25).cast("int"))).alias("end_date"),
        (price / 10000 * (key % 11) / 10).alias("end_score"),
        F.date_sub("o_date", (key % 150).cast("int")).alias("last_seen"), (key % 10).alias("sessions"),
        F.when(F.col("o_orderpriority") != "5-LOW", key).alias("pat_id"),
    )
    flag = episodes.improved(F.col("start_score"), F.col("end_score"))
    return facts.form_outcomes(rows, fx.counts(spark, d), ["site", "month"], flag)


# ---------------------------------------------------------------- populations


def bounds():
    return dates.day(fx.FIRST_MONTH), dates.day(fx.LAST_MONTH)


@query("snapshot_latest_member", f"""
WITH {fx.MONTHS}, {fx.ORDERS} SELECT month, o_custkey, o_orderkey, o_orderpriority FROM (
  SELECT months.month, o_custkey, o_orderkey, o_orderpriority, o_date FROM orders_d JOIN months ON o_date <= month_end)
QUALIFY row_number() OVER (PARTITION BY month, o_custkey ORDER BY o_date DESC, o_orderkey) = 1""")
def snapshot_latest_member(spark, d):
    o = fx.orders(spark, d).select("o_custkey", "o_orderkey", "o_orderpriority", "o_date")
    latest = population.latest_member(o, "o_custkey", "o_date", [F.col("o_orderkey")], *bounds())
    return latest.select("month", "o_custkey", "o_orderkey", "o_orderpriority")


@query("snapshot_active_30d", f"""
WITH {fx.MONTHS}, {fx.ORDERS} SELECT DISTINCT month, o_custkey, o_date, o_orderpriority FROM (
  SELECT months.month, o_custkey, o_date, o_orderpriority FROM orders_d JOIN months ON o_date <= month_end WHERE o_date > month_end - 30)
QUALIFY o_date = max(o_date) OVER (PARTITION BY month, o_custkey)""")
def snapshot_active_30d(spark, d):
    o = fx.orders(spark, d).select("o_custkey", "o_date", "o_orderpriority")
    active = population.active_members(o, ["o_custkey"], "o_date", *bounds(), carry=["o_orderpriority"])
    return active.select("month", "o_custkey", "o_date", "o_orderpriority")


LINKED = fx.SPANS + """, lk AS (
  SELECT o_custkey, start_date, CASE WHEN end_date >= DATE '2001-06-01' THEN NULL ELSE end_date END AS end_date,
         start_date + CAST(o_custkey % 400 AS INTEGER) AS start2,
         CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE start_date + 2000 END AS end2 FROM spans)"""


def linked_spans(spark, d):
    """Two validity spans per member, some open."""
    return fx.spans(spark, d).withColumns(
        {
            "end_date": F.when(F.col("end_date") < dates.day("2001-06-01"), F.col("end_date")),
            "start2": F.date_add("start_date", (F.col("o_custkey") % 400).cast("int")),
            "end2": F.when(F.col("o_custkey") % 7 != 0, F.date_add("start_date", 2000)),
        }
    )


# Three populations; some starts are missing, some care-team spans have no length.
NETWORK = LINKED + """, nw AS (
  SELECT o_custkey, CASE WHEN o_custkey % 11 > 0 THEN start_date END AS s1, end_date AS e1, start2 AS s2, end2 AS e2,
    CAST(date_trunc('month', start_date) AS DATE) AS s3, CAST(date_trunc('month', start_date) AS DATE) + CAST(o_custkey % 4 * 200 AS INTEGER) AS e3 FROM lk),
vs AS (
  SELECT months.month, o_custkey FROM nw JOIN months ON month >= s1 AND month >= s2
  WHERE (month <= e1 OR e1 IS NULL) AND (month <= e2 OR e2 IS NULL)
  UNION SELECT months.month, o_custkey FROM nw JOIN months ON month >= s3 AND month <= e3 WHERE e3 > s3
  UNION SELECT months.month, o_custkey FROM nw JOIN months ON month >= s1 WHERE month <= e2 AND o_custkey % 5 = 0)"""


@query("snapshot_valid_span", f"""
WITH {fx.MONTHS}, {NETWORK}, {fx.SITES} SELECT vs.month, site, count(DISTINCT o_custkey) AS members
FROM vs JOIN sites ON o_custkey = c_custkey GROUP BY 1, 2""")
def snapshot_valid_span(spark, d):
    team = F.trunc("start_date", "MM")
    spans = linked_spans(spark, d).select(
        "o_custkey", F.when(F.col("o_custkey") % 11 > 0, F.col("start_date")).alias("s1"), F.col("end_date").alias("e1"),
        F.col("start2").alias("s2"), F.col("end2").alias("e2"), team.alias("s3"),
        F.date_add(team, (F.col("o_custkey") % 4 * 200).cast("int")).alias("e3"),
    )
    member = ["o_custkey"]
    populations = [
        population.valid_spans(spans, member, ["s1", "s2"], ["e1", "e2"]),
        population.valid_spans(spans, member, ["s3"], ["e3"], some_length=[("s3", "e3")]),
        population.valid_spans(spans.filter("o_custkey % 5 = 0 AND e2 IS NOT NULL"), member, ["s1"], ["e2"]),
    ]
    stays = population.any_population_spans(populations, member)
    held = stays.join(fx.sites(spark, d), F.col("o_custkey") == F.col("c_custkey"))
    return intervals.count_by_month(held, ["site"], "from_month", "until_month", *bounds()).select(
        "month", "site", F.col("n").alias("members")
    )


@query("eligibility_flag", f"""
WITH {LINKED}, {fx.MONTHS}, pop AS (SELECT DISTINCT o_custkey, month FROM orders_d WHERE month <= DATE '2001-07-01'),
el AS (SELECT DISTINCT o_custkey, months.month FROM lk JOIN months ON start2 <= month_end
       WHERE ((end_date > start2 AND end_date > month) OR end_date IS NULL) AND (end2 IS NULL OR end2 > month))
SELECT pop.o_custkey, pop.month, CAST(el.o_custkey IS NOT NULL AS INTEGER) AS eligible
FROM pop LEFT JOIN el ON el.o_custkey = pop.o_custkey AND el.month = pop.month""")
def eligibility_flag(spark, d):
    pop = fx.orders(spark, d).filter(F.col("month") <= dates.day(fx.LAST_MONTH)).select("o_custkey", "month").distinct()
    return population.eligibility_flag(
        pop, linked_spans(spark, d), "o_custkey", "start2", "end_date", "end2", *bounds()
    )


# ---------------------------------------------------------------- reconciliation


ENCOUNTERS = """enc AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 = 0 THEN -2 ELSE o_orderkey % 5 END AS type_category,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Hospital Encounter' END AS encounter_type,
    CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderkey % 6 = 0 AS INTEGER) END AS is_outpatient,
    CASE WHEN o_custkey % 5 > 0 THEN CAST(o_custkey % 3 = 0 AS INTEGER) END AS is_admission,
    CASE o_custkey % 4 WHEN 0 THEN 'Observation' WHEN 1 THEN 'Inpatient Encounter' WHEN 2 THEN 'Day' END AS patient_class,
    CASE WHEN o_custkey % 6 > 0 THEN o_custkey % 8 END AS class_category,
    CASE WHEN o_orderkey % 13 = 0 THEN 'Expired' WHEN o_orderkey % 4 = 0 THEN 'Home' END AS disposition,
    CASE WHEN o_orderpriority LIKE '1-%' THEN 'Elective' WHEN o_orderpriority LIKE '2-%' THEN 'Urgent' END AS admission_type,
    CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderstatus = 'F' AS INTEGER) END AS is_ed,
    CASE WHEN o_custkey % 7 > 0 THEN CAST(o_custkey % 10 = 0 AS INTEGER) END AS has_following_admission,
    CASE WHEN o_orderkey % 10 = 3 THEN 'Observation' END AS message_type,
    CAST(o_orderkey % 3 = 0 AS INTEGER) AS f1, CAST(o_orderkey % 4 >= 2 AS INTEGER) AS f2,
    CAST(o_orderkey % 3 > 0 AS INTEGER) AS f3, CAST(o_orderkey % 8 >= 6 AS INTEGER) AS f4 FROM orders)"""


def encounters(spark, d):
    """Orders with the columns of an encounter, many of them missing at times."""
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    flag = lambda known, holds: F.when(known, holds.cast("int"))
    return fx.t(spark, d, "orders").select(
        order.alias("k"), F.when(order % 9 == 0, -2).otherwise(order % 5).alias("type_category"),
        F.when(order % 2 == 0, "Hospital Encounter").alias("encounter_type"),
        flag(order % 7 > 0, order % 6 == 0).alias("is_outpatient"), flag(cust % 5 > 0, cust % 3 == 0).alias("is_admission"),
        F.when(cust % 4 == 0, "Observation").when(cust % 4 == 1, "Inpatient Encounter").when(cust % 4 == 2, "Day").alias("patient_class"),
        F.when(cust % 6 > 0, cust % 8).alias("class_category"),
        F.when(order % 13 == 0, "Expired").when(order % 4 == 0, "Home").alias("disposition"),
        F.when(F.col("o_orderpriority").startswith("1-"), "Elective").when(F.col("o_orderpriority").startswith("2-"), "Urgent").alias("admission_type"),
        flag(order % 11 > 0, F.col("o_orderstatus") == "F").alias("is_ed"),
        flag(cust % 7 > 0, cust % 10 == 0).alias("has_following_admission"),
        F.when(order % 10 == 3, "Observation").alias("message_type"),
        (order % 3 == 0).cast("int").alias("f1"), (order % 4 >= 2).cast("int").alias("f2"),
        (order % 3 > 0).cast("int").alias("f3"), (order % 8 >= 6).cast("int").alias("f4"),
    )


RULED = """ruled AS (SELECT *, CASE
  WHEN (type_category IN (1, 2) OR (type_category = -2 AND encounter_type = 'Hospital Encounter'))
    AND coalesce(is_outpatient, 0) <> 1 AND (is_admission = 1 OR patient_class = 'Observation')
    AND coalesce(disposition, '') <> 'Expired' THEN 'Inpatient Admissions'
  WHEN (type_category IN (2, 3) OR (type_category = -2 AND encounter_type = 'Hospital Encounter'))
    AND (class_category IS NULL OR class_category NOT IN (5, 6)) AND (admission_type IS NULL OR admission_type NOT IN ('Elective', 'Routine Elective'))
    AND is_ed = 1 AND (is_admission IS NULL OR is_admission = 0) AND (has_following_admission IS NULL OR has_following_admission = 0)
    AND (message_type IS NULL OR message_type NOT IN ('Observation', 'Inpatient Encounter'))
    AND (patient_class IS NULL OR patient_class NOT IN ('Observation', 'Inpatient Encounter')) THEN 'ED Visits (Discharged)' END AS measure,
  CASE WHEN f1 = 1 AND f2 = 0 AND f3 = 0 AND f4 = 0 THEN 1 WHEN f1 = 0 AND f2 = 1 AND f3 = 1 AND f4 = 1 THEN 2
    WHEN f1 = 0 AND f2 = 0 AND f3 = 1 AND f4 = 0 THEN 3 WHEN f1 = 0 AND f2 = 1 AND f3 = 1 AND f4 = 0 THEN 4 END AS src FROM enc)"""
ENCOUNTER_LISTS = reconcile.EncounterLists(inpatient_types=[1, 2], ed_types=[2, 3], untyped=-2, excluded_classes=[5, 6])


@query("classify_encounter", f"""
WITH {ENCOUNTERS}, {RULED} SELECT k, measure, CAST(src AS DOUBLE) AS source FROM ruled WHERE measure IS NOT NULL""")
def classify_encounter(spark, d):
    source = reconcile.source_class(F.col("f1"), F.col("f2"), F.col("f3"), F.col("f4"))
    ruled = reconcile.classify(encounters(spark, d), reconcile.encounter_rules(ENCOUNTER_LISTS))
    return ruled.select("k", "measure", source.cast("double").alias("source"))


# Codes of two to five characters and missing ones among the usual four.
CODE_OF = ("0456", "0450", "0981", "0762", "0120", "0180", "0210", "1001", "0300", "04512", "045", "01", "012", "04561", None, "0760")
CODES = f"""lines AS (
  SELECT l_orderkey, CAST(l_returnflag = 'A' AS INTEGER) AS admitted, CASE l_partkey % {len(CODE_OF)}
    {" ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CODE_OF) if c)} END AS code FROM lineitem)"""


def claim_lines(spark, d):
    pick = F.element_at(F.array(*[F.lit(c) for c in CODE_OF]), (F.col("l_partkey") % len(CODE_OF) + 1).cast("int"))
    return fx.t(spark, d, "lineitem").select(
        "l_orderkey", (F.col("l_returnflag") == "A").cast("int").alias("is_admission"), pick.alias("code")
    )


@query("classify_claim_lines", f"""
WITH {CODES}, cl AS (SELECT 'mapped' AS form, l_orderkey, max(CAST(code = '0456' AS INTEGER)) AS urgent,
  max(CAST(code = '0981' OR (code LIKE '045%' AND code NOT LIKE '0456%') AS INTEGER)) AS emergency,
  max(CAST(code IN ('0760', '0762', '0769') AS INTEGER)) AS observation,
  max(CAST((code LIKE '01%' AND code NOT LIKE '018%') OR code LIKE '020%' OR code LIKE '021%' OR code IN ('1000', '1001', '1002') AS INTEGER)) AS inpatient,
  max(admitted) AS admitted FROM lines GROUP BY 2
UNION ALL SELECT 'unmapped', l_orderkey, max(CAST(code = '0456' AS INTEGER)),
  max(CAST(code = '0981' OR regexp_full_match(code, '045[^6]') AS INTEGER)), max(CAST(code IN ('0760', '0762', '0769') AS INTEGER)),
  max(CAST(regexp_full_match(code, '01[^8].*') OR regexp_full_match(code, '02[01].*') OR code IN ('1000', '1001', '1002') AS INTEGER)), 0
  FROM lines GROUP BY 2)
SELECT form, l_orderkey, coalesce(urgent, 0) AS urgent, coalesce(emergency, 0) AS emergency, coalesce(observation, 0) AS observation,
  coalesce(inpatient, 0) AS inpatient, admitted, measure FROM (SELECT *, CASE
  WHEN (observation = 1 OR inpatient = 1) AND emergency = 0 AND urgent = 0 THEN 'Inpatient Admissions'
  WHEN emergency = 1 AND urgent = 0 AND observation = 0 AND inpatient = 0 AND admitted = 0 THEN 'ED Visits (Discharged)' END AS measure
  FROM cl) WHERE measure IS NOT NULL""")
def classify_claim_lines(spark, d):
    """Claims mapped to an encounter, whose admission flag counts, and unmapped ones."""
    lines = claim_lines(spark, d)
    mapped = reconcile.claim_class(lines, ["l_orderkey"], "code", F.col("is_admission"))
    unmapped = reconcile.claim_class(lines, ["l_orderkey"], "code", classes=reconcile.UNMAPPED_REVENUE_CLASS)
    return mapped.withColumn("form", F.lit("mapped")).unionByName(unmapped.withColumn("form", F.lit("unmapped")))


# A claim is an order from its date to that of its last line; birth dates make some subjects adult.
CLAIMS = fx.ORDERS + """, last_line AS (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS end_date FROM lineitem GROUP BY 1),
claims AS (
  SELECT o_orderkey, o_custkey, o_date AS start_date, CASE WHEN end_date > o_date THEN least(end_date, o_date + 40) ELSE o_date END AS end_date,
    nullif(o_orderpriority, '5-LOW') AS code, DATE '1978-06-15' + CAST(o_custkey % 9000 * 3 % 9000 AS INTEGER) AS birth, o_orderstatus, month
  FROM orders_d LEFT JOIN last_line ON l_orderkey = o_orderkey)"""


@query("unmatched_claims", f"""
WITH {CLAIMS}, mapped AS (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F' AND l_quantity > 45),
pop AS (SELECT DISTINCT o_custkey, month FROM claims WHERE o_custkey % 3 > 0),
rep AS (SELECT o_custkey, start_date, end_date, code FROM claims WHERE o_orderkey % 4 = 0)
SELECT c.month, c.o_custkey, c.o_orderkey, c.start_date, c.end_date, c.code FROM claims c JOIN pop ON pop.o_custkey = c.o_custkey AND pop.month = c.month
WHERE end_date <= last_day(c.month) AND code IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  AND date_diff('year', birth, start_date) - CAST(month(start_date) < month(birth) OR (month(start_date) = month(birth) AND day(start_date) < day(birth)) AS INTEGER) < 18
  AND NOT EXISTS (SELECT 1 FROM mapped WHERE l_orderkey = o_orderkey)
  AND NOT EXISTS (SELECT 1 FROM rep WHERE rep.o_custkey = c.o_custkey AND rep.start_date = c.start_date AND rep.end_date = c.end_date
    AND rep.code IS NOT DISTINCT FROM c.code)
QUALIFY row_number() OVER (PARTITION BY c.month, c.o_custkey, c.code ORDER BY c.start_date, c.o_orderkey) = 1""")
def unmatched_claims(spark, d):
    last = fx.t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.to_date(F.max("l_shipdate")).alias("shipped"))
    claims = fx.orders(spark, d).join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", "o_custkey", F.col("o_date").alias("start_date"),
        F.greatest(F.when(F.col("shipped").isNotNull(), F.least("shipped", F.date_add("o_date", 40))), "o_date").alias("end_date"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("code"),
        F.date_add(dates.day("1978-06-15"), (F.col("o_custkey") % 9000 * 3 % 9000).cast("int")).alias("birth"),
    )
    claims = materialise(claims)  # read as claims, as those already reported and for the population
    mapped = fx.t(spark, d, "lineitem").filter("l_linestatus = 'F' AND l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    pop = claims.filter("o_custkey % 3 > 0").select("o_custkey", F.trunc("start_date", "MM").alias("month"))
    values = spark.createDataFrame([("1-URGENT",), ("2-HIGH",), ("3-MEDIUM",)], "code string")
    found = reconcile.unmatched_in_population(
        claims, mapped, ["o_orderkey"], claims.filter("o_orderkey % 4 = 0"), ["o_custkey", "start_date", "end_date", "code"],
        pop, values, "o_custkey", "code", "start_date", "end_date", "birth",
        ["month", "o_custkey", "code"], [F.col("start_date"), F.col("o_orderkey")],
    )
    return found.select("month", "o_custkey", "o_orderkey", "start_date", "end_date", "code")


SOURCE_NUMBER = {"purchase": 1.0, "signup": 2.0, "click": 2.1, "view": 3.0, "error": 4.0}


MERGED = """ev2 AS (SELECT user_id, day, event_id, event_type, user_id % 4 AS site,
    CASE WHEN event_id % 3 = 0 THEN 'ED Visits (Discharged)' ELSE 'Inpatient Admissions' END AS measure,
    CASE WHEN event_id % 5 > 0 THEN CAST(event_id % 2 AS VARCHAR) END AS code_list FROM ev)"""


@query("merge_sources_priority", f"""
WITH {fx.EVENTS}, {MERGED} SELECT measure, site, user_id, day, code_list, CAST(source AS DOUBLE) AS source, skey FROM (
  SELECT *, CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'signup' THEN 2.0 WHEN 'click' THEN 2.1
    WHEN 'view' THEN 3.0 ELSE 4.0 END AS source,
    CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) || '.' || CAST(event_id AS VARCHAR)
         ELSE 'X.' || CAST(event_id AS VARCHAR) END AS skey FROM ev2)
QUALIFY row_number() OVER (PARTITION BY measure, site, user_id, day, code_list ORDER BY source, event_id) = 1""")
def merge_sources_priority(spark, d):
    """Own encounters, mapped claims, unmatched claims and other systems' encounters, four frames into one."""
    kind, user, event = F.col("event_type"), F.col("user_id").cast("string"), F.col("event_id").cast("string")
    ev = fx.events(spark, d).withColumns(
        {
            "site": F.col("user_id") % 4,
            "measure": F.when(F.col("event_id") % 3 == 0, reconcile.ED).otherwise(reconcile.INPATIENT),
            "code_list": F.when(F.col("event_id") % 5 > 0, (F.col("event_id") % 2).cast("string")),
        }
    )
    key = ["measure", "site", "user_id", "day", "code_list"]
    encounter, claim = F.concat(F.lit("X."), event), F.concat_ws(".", user, event)

    def source(kinds, number, skey):
        return ev.filter(kind.isin(kinds)).select(*key, "event_id", number.alias("source"), skey.alias("skey"))

    other = F.when(kind == "view", SOURCE_NUMBER["view"]).otherwise(SOURCE_NUMBER["error"])
    frames = [
        source(["purchase"], F.lit(SOURCE_NUMBER["purchase"]), encounter), source(["signup"], F.lit(SOURCE_NUMBER["signup"]), encounter),
        source(["click"], F.lit(SOURCE_NUMBER["click"]), claim), source(["view", "error"], other, encounter),
    ]
    merged = reconcile.merge_priority(frames, key, "source", [F.col("event_id")])
    return merged.select(*key, "source", "skey")


NETWORK_SITES = ["NATION_0", "NATION_1", "NATION_2", "NATION_7", "NATION_13"]
RATES = f"""{fx.ORDERS}, {fx.TWO_SITES}, pop AS (SELECT DISTINCT month, site, o_custkey FROM orders_d JOIN two ON o_custkey = c_custkey),
num AS (SELECT month, site, o_orderkey FROM orders_d JOIN two ON o_custkey = c_custkey WHERE o_orderstatus = 'P' AND o_totalprice > 300000),
nets AS (SELECT * FROM (VALUES ('NATION_0'), ('NATION_1'), ('NATION_2'), ('NATION_7'), ('NATION_13')) v(site)),
d1 AS (SELECT month, site, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS denominator FROM pop GROUP BY 1, 2),
n1 AS (SELECT month, site, CAST(count(DISTINCT o_orderkey) AS DOUBLE) AS numerator FROM num GROUP BY 1, 2),
site_rates AS (SELECT d1.month, d1.site, denominator, coalesce(numerator, 0) AS numerator, 'Practice' AS aggregation
               FROM d1 LEFT JOIN n1 ON n1.month = d1.month AND n1.site = d1.site)"""


@query("rate_site_network", f"""
WITH {RATES},
d2 AS (SELECT month, CAST(count(DISTINCT o_custkey) AS DOUBLE) AS denominator FROM pop WHERE site IN (SELECT site FROM nets) GROUP BY 1),
n2 AS (SELECT month, CAST(count(DISTINCT o_orderkey) AS DOUBLE) AS numerator FROM num WHERE site IN (SELECT site FROM nets) GROUP BY 1)
SELECT * FROM site_rates UNION ALL
SELECT d2.month, 'Main Network', denominator, coalesce(numerator, 0), 'Network' FROM d2 LEFT JOIN n2 ON n2.month = d2.month""")
def rate_site_network(spark, d):
    pop, num = _population_and_events(spark, d)
    return measures.site_and_network_rates(
        pop, num, "o_custkey", "o_orderkey", NETWORK_SITES, "Main Network", dense_members=True
    )


@query("rate_site_network_sums", f"""
WITH {RATES} SELECT * FROM site_rates UNION ALL
SELECT month, 'Main Network', sum(denominator), sum(numerator), 'Network' FROM site_rates
WHERE site IN (SELECT site FROM nets) GROUP BY month""")
def rate_site_network_sums(spark, d):
    pop, num = _population_and_events(spark, d)
    return measures.site_and_network_rates(
        pop, num, "o_custkey", "o_orderkey", NETWORK_SITES, "Main Network", recount=False
    )


def _population_and_events(spark, d):
    site = fx.two_sites(spark, d)
    o = fx.orders(spark, d)
    pop = o.select("o_custkey", "month").distinct().join(site, "o_custkey")
    num = o.filter("o_orderstatus = 'P' AND o_totalprice > 300000").select("o_custkey", "o_orderkey", "month").join(site, "o_custkey")
    return pop, num


MEMBERS = fx.SPANS + f""", {fx.SITES}, {fx.MONTHS}, pop AS (
  SELECT months.month, month_end, o_custkey AS subject, site, DATE '1975-01-01' + CAST(o_custkey * 37 % 9000 AS INTEGER) AS birth
  FROM spans JOIN months ON start_date <= month_end JOIN sites ON o_custkey = c_custkey)"""

# Encounters by the ordered rules (every fifth or so from other systems), claims mapped to one (two of three),
# claims that no encounter has, all of the young population and with the codes of a value set.
UTILISATION = MEMBERS + f""", {CODES}, {ENCOUNTERS}, {RULED},
vs AS (SELECT DISTINCT p_size AS dx, p_brand AS code FROM part),
cl AS (SELECT dx, string_agg(code, '; ' ORDER BY code) AS code_list
       FROM (SELECT *, row_number() OVER (PARTITION BY dx ORDER BY code) AS rn FROM vs) WHERE rn <= 3 GROUP BY 1),
fact AS (SELECT o_orderkey AS encounter, o_custkey AS subject, o_date AS day, month, o_orderkey % 60 AS dx,
    nullif(o_orderpriority, '5-LOW') AS code, o_date + CAST(o_orderkey % 12 AS INTEGER) AS end_date FROM orders_d),
flags AS (SELECT l_orderkey, max(CAST(code = '0456' AS INTEGER)) AS uc,
    max(CAST(code = '0981' OR (code LIKE '045%' AND code NOT LIKE '0456%') AS INTEGER)) AS ed,
    max(CAST(code = '0981' OR regexp_full_match(code, '045[^6]') AS INTEGER)) AS ed4,
    max(CAST(code IN ('0760', '0762', '0769') AS INTEGER)) AS obs,
    max(CAST((code LIKE '01%' AND code NOT LIKE '018%') OR code LIKE '020%' OR code LIKE '021%' OR code IN ('1000', '1001', '1002') AS INTEGER)) AS ip,
    max(CAST(regexp_full_match(code, '01[^8].*') OR regexp_full_match(code, '02[01].*') OR code IN ('1000', '1001', '1002') AS INTEGER)) AS ip3,
    max(admitted) AS adm FROM lines GROUP BY 1),
clm AS (SELECT l_orderkey, CASE WHEN (obs = 1 OR ip = 1) AND ed = 0 AND uc = 0 THEN 'Inpatient Admissions'
    WHEN ed = 1 AND uc = 0 AND obs = 0 AND ip = 0 AND adm = 0 THEN 'ED Visits (Discharged)' END AS mapped_measure,
    CASE WHEN (obs = 1 OR ip3 = 1) AND ed4 = 0 AND uc = 0 THEN 'Inpatient Admissions'
    WHEN ed4 = 1 AND uc = 0 AND obs = 0 AND ip3 = 0 THEN 'ED Visits (Discharged)' END AS own_measure FROM flags),
free_claims AS (SELECT fact.*, own_measure AS measure FROM fact JOIN clm ON l_orderkey = encounter
  JOIN (SELECT DISTINCT month, subject, birth FROM pop) p ON p.subject = fact.subject AND p.month = fact.month
  WHERE own_measure IS NOT NULL AND encounter % 3 = 0 AND end_date <= last_day(day) AND code IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
    AND year(day) - year(birth) - CASE WHEN strftime(day, '%m%d') < strftime(birth, '%m%d') THEN 1 ELSE 0 END < 18
    AND NOT EXISTS (SELECT 1 FROM fact r WHERE r.encounter % 3 > 0 AND r.encounter % 4 = 0 AND r.subject = fact.subject AND r.day = fact.day
      AND r.end_date = fact.end_date AND r.code IS NOT DISTINCT FROM fact.code)
  QUALIFY row_number() OVER (PARTITION BY fact.month, fact.subject, code ORDER BY day, encounter) = 1),
src AS (SELECT encounter, subject, day, dx, 1.0 AS source, measure, 'X.' || encounter AS skey FROM fact JOIN ruled ON k = encounter
    WHERE measure IS NOT NULL AND encounter % 5 >= 2
  UNION ALL SELECT encounter, subject, day, dx, 3.0 + encounter % 5, measure, 'X.' || encounter FROM fact JOIN ruled ON k = encounter
    WHERE measure IS NOT NULL AND encounter % 5 < 2
  UNION ALL SELECT encounter, subject, day, dx, 2.0, mapped_measure, 'X.' || encounter FROM fact JOIN clm ON l_orderkey = encounter
    WHERE mapped_measure IS NOT NULL AND encounter % 3 > 0
  UNION ALL SELECT encounter, subject, day, dx, 2.1, measure, subject || '.' || encounter FROM free_claims),
inpop AS (SELECT pop.month, site, src.subject, skey, day, source, measure, code_list FROM src
  JOIN pop ON pop.subject = src.subject AND src.day >= pop.month AND src.day <= pop.month_end JOIN cl ON cl.dx = src.dx
  WHERE year(day) - year(birth) - CASE WHEN strftime(day, '%m%d') < strftime(birth, '%m%d') THEN 1 ELSE 0 END < 18),
merged AS (SELECT * FROM inpop QUALIFY row_number() OVER (PARTITION BY month, measure, site, subject, day, code_list ORDER BY source, skey) = 1),
young AS (SELECT * FROM pop WHERE year(month_end) - year(birth)
  - CASE WHEN strftime(month_end, '%m%d') < strftime(birth, '%m%d') THEN 1 ELSE 0 END < 18),
nets AS (SELECT * FROM (VALUES ('NATION_0'), ('NATION_1'), ('NATION_2'), ('NATION_7'), ('NATION_13')) v(site)),
both_m AS (SELECT * FROM (VALUES ('Inpatient Admissions'), ('ED Visits (Discharged)')) v(measure)),
dd AS (SELECT month, site, CAST(count(DISTINCT subject) AS DOUBLE) AS denominator, 'Practice' AS aggregation FROM young GROUP BY 1, 2
  UNION ALL SELECT month, 'Main Network', CAST(count(DISTINCT subject) AS DOUBLE), 'Network' FROM young WHERE site IN (SELECT site FROM nets) GROUP BY 1),
nn AS (SELECT month, measure, site, CAST(count(DISTINCT skey) AS DOUBLE) AS numerator FROM merged GROUP BY 1, 2, 3
  UNION ALL SELECT month, measure, 'Main Network', CAST(count(DISTINCT skey) AS DOUBLE) FROM merged WHERE site IN (SELECT site FROM nets) GROUP BY 1, 2)"""


def young_population(spark, d):
    """Members per month, with their site and birth."""
    birth = F.date_add(dates.day("1975-01-01"), (F.col("o_custkey") * 37 % 9000).cast("int"))
    members = fx.spans(spark, d).join(fx.sites(spark, d), F.col("o_custkey") == F.col("c_custkey"))
    lo, hi = bounds()
    pop = joins.expand_months(members, F.col("start_date"), hi, lo, hi)
    return pop.select("month", F.col("o_custkey").alias("subject"), "site", birth.alias("birth"))


def utilisation_sources(spark, d, pop):
    """The four sources of the utilisation measures in their common shape."""
    key = F.col("encounter")
    fact = fx.orders(spark, d).select(
        F.col("o_orderkey").alias("encounter"), F.col("o_custkey").alias("subject"), F.col("o_date").alias("day"),
        (F.col("o_orderkey") % 60).alias("dx"), F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("code"),
        F.date_add("o_date", (F.col("o_orderkey") % 12).cast("int")).alias("end_date"),
    )
    value_set = fx.t(spark, d, "part").select(F.col("p_size").alias("dx"), "p_brand")
    # read by all four sources
    young = materialise(utilisation.with_codes(utilisation.in_population(fact, pop), value_set, "dx", "p_brand"), "young")
    ruled = reconcile.classify(encounters(spark, d), reconcile.encounter_rules(ENCOUNTER_LISTS))
    seen = young.join(ruled.select(F.col("k").alias("encounter"), "measure"), "encounter")
    lines = claim_lines(spark, d).withColumnRenamed("l_orderkey", "encounter")
    mapped = reconcile.claim_class(lines, ["encounter"], "code", F.col("is_admission")).select("encounter", "measure")
    unmapped = reconcile.claim_class(lines, ["encounter"], "code", classes=reconcile.UNMAPPED_REVENUE_CLASS).select("encounter", "measure")
    claims = young.join(unmapped, "encounter")
    priorities = spark.createDataFrame([("1-URGENT",), ("2-HIGH",), ("3-MEDIUM",)], "code string")
    free = reconcile.unmatched_in_population(
        claims, young.filter(key % 3 > 0).select("encounter"), ["encounter"],
        young.filter((key % 3 > 0) & (key % 4 == 0)), ["subject", "day", "end_date", "code"],
        young.select("subject", "month"), priorities, "subject", "code", "day", "end_date", "birth",
        ["month", "subject", "code"], [F.col("day"), key],
    )
    skey = utilisation.encounter_key(key)
    return [
        utilisation.shaped(seen.filter(key % 5 >= 2), skey, F.lit(1)),
        utilisation.shaped(young.filter(key % 3 > 0).join(mapped, "encounter"), skey, F.lit(2)),
        utilisation.shaped(free, F.concat_ws(".", "subject", "encounter"), F.lit(2.1)),
        utilisation.shaped(seen.filter(key % 5 < 2), skey, 3 + key % 5),
    ]


@query("measure_utilisation", f"""
WITH {UTILISATION} SELECT dd.month, both_m.measure, dd.site, denominator, coalesce(numerator, 0) AS numerator, aggregation
FROM dd CROSS JOIN both_m LEFT JOIN nn ON nn.month = dd.month AND nn.measure = both_m.measure AND nn.site = dd.site""")
def measure_utilisation(spark, d):
    pop = young_population(spark, d)
    sources = utilisation_sources(spark, d, pop)
    return utilisation.utilisation_rates(
        pop, F.last_day("month"), sources, NETWORK_SITES, "Main Network", dense_members=True
    )


@query("utilisation_sources", f"""
WITH {UTILISATION} SELECT source, measure, count(*) AS n, CAST(count(DISTINCT subject) AS BIGINT) AS subjects
FROM (SELECT CAST(source AS DOUBLE) AS source, measure, subject FROM merged) GROUP BY 1, 2""")
def merged_sources(spark, d):
    """What each source contributes once earlier ones had their turn."""
    sources = utilisation_sources(spark, d, young_population(spark, d))
    merged = reconcile.merge_priority(sources, utilisation.MERGE_KEY, "source", [F.col("skey")])
    return merged.groupBy("source", "measure").agg(F.count("*").alias("n"), F.countDistinct("subject").alias("subjects"))
