"""Registered queries of contests, profiles, clusters and pictures, with their SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from sievewright.functions import pixels
from sievewright.operators import contest, gates, profiles, ranking
from sievewright.plans.catalog import _t, query

#: Slots of a room in the contest.
SLOTS = 4


def _scorer():
    """The queries' scorer: the greatest balance first; the others are turned down, and a balance below zero has no place there. A scorer of a deployment asks a model."""

    def ask(room: str, slots: int, items: list[dict]) -> str:
        told = sorted(items, key=lambda x: (-x["score"], x["file"]))
        return json.dumps({
            "picks": [{"file": x["file"], "reason": f"balance {x['score']:.2f}", "purpose": 5, "staging": 5} for x in told[:slots]],
            "rejected": [{"file": x["file"], "why": f"balance {x['score']:.2f}"} for x in told[slots:]], "nao_pertence": [{"file": x["file"], "why": "below zero"} for x in told if x["score"] < 0]})

    return ask


@query(f"""WITH c AS (SELECT 'room ' || c_nationkey AS room, c_name || '.jpg' AS file, c_acctbal AS score, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_name) AS rank FROM customer)
SELECT room, file, 'pick' AS part, rank::INT AS rank, 'balance ' || printf('%.2f', score) AS why FROM c WHERE rank <= {SLOTS}
UNION ALL SELECT room, file, 'rejected', NULL, 'balance ' || printf('%.2f', score) FROM c WHERE rank > {SLOTS}
UNION ALL SELECT room, file, 'not here', NULL, 'below zero' FROM c WHERE score < 0""")
def contest_verdicts(spark, d):
    own = _t(spark, d, "customer").select(F.concat(F.lit("room "), "c_nationkey").alias("room"), F.concat("c_name", F.lit(".jpg")).alias("file"), F.col("c_acctbal").cast("double").alias("score"))
    slots = own.select("room").distinct().withColumn("slots", F.lit(SLOTS))
    v = contest.contest(own, slots, [F.desc("score"), "file"], _scorer())
    part = lambda df, name: df.select("room", "file", F.lit(name).alias("part"), F.lit(None).cast("int").alias("rank"), "why")
    return v.picks.select("room", "file", F.lit("pick").alias("part"), "rank", F.col("reason").alias("why")).unionByName(part(v.rejected, "rejected")).unionByName(part(v.not_room, "not here"))


FILES = "f AS (SELECT l_suppkey AS delivery, l_returnflag = 'R' AND l_suppkey % 3 = 0 OR l_suppkey % 7 = 0 AS raw, l_linestatus = 'F' AS dated, l_linenumber > 4 AS bracketed, CASE WHEN l_suppkey % 5 < 3 OR l_linenumber = 1 THEN CASE WHEN l_suppkey % 11 = 0 THEN 'HOUSE' ELSE 'room ' || l_partkey % 7 END END AS room FROM lineitem)"


def _files(spark, d):
    s, line = F.col("l_suppkey"), F.col("l_linenumber")
    room = F.when((s % 5 < 3) | (line == 1), F.when(s % 11 == 0, "HOUSE").otherwise(F.concat(F.lit("room "), F.col("l_partkey") % 7)))
    return _t(spark, d, "lineitem").select(
        s.alias("delivery"), ((F.col("l_returnflag") == "R") & (s % 3 == 0) | (s % 7 == 0)).alias("raw"), (F.col("l_linestatus") == "F").alias("dated"), (line > 4).alias("bracketed"), room.alias("room"))


@query("WITH " + FILES + """, h AS (SELECT delivery, room, count(*) AS n FROM f WHERE room IS NOT NULL GROUP BY ALL), m AS (SELECT delivery, count(*) AS rooms, median(n) AS median_per_room FROM h GROUP BY delivery),
s AS (SELECT delivery, count(*) AS files, avg(raw::INT) AS raw_share, avg(dated::INT) AS dated_share, avg((room IS NOT NULL)::INT) AS labelled_share, avg(bracketed::INT) AS bracket_share FROM f GROUP BY delivery)
SELECT s.delivery, files, round(raw_share, 6) AS raw_share, round(dated_share, 6) AS dated_share, round(labelled_share, 6) AS labelled_share, round(bracket_share, 6) AS bracket_share, coalesce(rooms, 0) AS rooms, median_per_room,
CASE WHEN raw_share >= 0.5 THEN CASE WHEN bracket_share >= 0.2 THEN 'D' ELSE 'E' END WHEN files <= 60 AND median_per_room <= 3 THEN 'A' WHEN files <= 60 AND rooms IS NULL THEN 'A' WHEN labelled_share >= 0.6 AND rooms = 1 THEN 'C' WHEN labelled_share >= 0.6 THEN 'B' ELSE 'C' END AS kind
FROM s LEFT JOIN m ON m.delivery = s.delivery""")
def delivery_profile(spark, d):
    told = profiles.profile(_files(spark, d), "delivery")
    return told.select("delivery", "files", *(F.round(c, 6).alias(c) for c in ("raw_share", "dated_share", "labelled_share", "bracket_share")), "rooms", "median_per_room", "kind")


@query("WITH " + FILES + " SELECT delivery, room, count(*) AS files FROM f WHERE room IS NOT NULL GROUP BY ALL")
def profile_rooms(spark, d):
    return profiles.rooms(_files(spark, d), "delivery")


@query("SELECT p_brand, p_size, min(p_name) AS first, row_number() OVER (PARTITION BY p_brand ORDER BY min(p_name), p_size) AS place FROM part GROUP BY p_brand, p_size")
def cluster_order(spark, d):
    return ranking.cluster_order(_t(spark, d, "part"), "p_brand", "p_size", "p_name")


#: A vector of 64 components as a picture of eight rows: a component of -0.5 or less is grey 0, one of 0.5 or more 255.
GREY = "greatest(0, least(255, floor((x::DOUBLE + 0.5) * 255)::INT))"


@query(f"""WITH g AS (SELECT vec_id, list_transform(embedding, lambda x: {GREY}) AS p FROM embeddings),
l AS (SELECT vec_id, p, list_transform(list_filter(range(1, 65), lambda i: i > 8 AND i <= 56 AND (i - 1) % 8 BETWEEN 1 AND 6), lambda i: p[i - 1] + p[i + 1] + p[i - 8] + p[i + 8] - 4 * p[i]) AS v FROM g)
SELECT vec_id, round(list_var_pop(v), 4) AS sharpness, round(100.0 * len(list_filter(p, lambda x: x <= 2)) / 64, 6) AS shadow_clip, round(100.0 * len(list_filter(p, lambda x: x >= 253)) / 64, 6) AS highlight_clip FROM l""")
def grey_measures(spark, d):
    grey = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 0.5) * 255).cast("int"))))
    told = _t(spark, d, "embeddings").select("vec_id", pixels.measured(grey, F.lit(8)).alias("m"))
    return told.select("vec_id", F.round("m.sharpness", 4).alias("sharpness"), F.round("m.shadow_clip", 6).alias("shadow_clip"), F.round("m.highlight_clip", 6).alias("highlight_clip"))


@query("""WITH w AS (SELECT event_id, user_id, event_id % 3 AS generation FROM events), c AS (SELECT user_id, max(event_id) % 3 AS now FROM events WHERE user_id % 10 <> 0 GROUP BY user_id),
f AS (SELECT w.user_id, min(event_id) AS first FROM w JOIN c ON c.user_id = w.user_id AND now = generation GROUP BY w.user_id)
SELECT event_id, w.user_id, generation, CASE WHEN c.user_id IS NULL THEN 'unknown' WHEN generation = now AND event_id = first THEN NULL ELSE 'stale' END AS refused FROM w LEFT JOIN c ON c.user_id = w.user_id LEFT JOIN f ON f.user_id = w.user_id""")
def stale_writes(spark, d):
    own = _t(spark, d, "events").select("event_id", "user_id", (F.col("event_id") % 3).alias("generation"))
    current = _t(spark, d, "events").where("user_id % 10 <> 0").groupBy("user_id").agg((F.max("event_id") % 3).alias("generation"))
    return gates.admitted(own, current, "user_id", ["event_id"])
