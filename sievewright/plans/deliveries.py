"""Registered queries of labels, rooms, files, gates and answers, with their SQL.

The tables stand for deliveries: documents for photos, their sources for rooms, customers and
orders for jobs and frames.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sievewright.functions import names, quality, scalars
from sievewright.operators import answers, files, gates, geometry, ranking, rooms
from sievewright.plans.catalog import _t, query
from sievewright.streaming import ledger

CODES = [names.code_pattern("WC-N")]


@query("SELECT doc_id, md5(strip_accents(lower(text))) AS folded FROM documents")
def folds(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(names.fold(F.col("text"))).alias("folded"))


@query("SELECT p_partkey, trim(regexp_replace(lower('WC-0' || p_partkey || ' - ' || p_name || CASE p_partkey % 3 WHEN 0 THEN ' WC-7' ELSE '' END), 'wc-[0-9]+', ' ', 'g'), ' -_') AS bare, true AS coded FROM part")
def codes_stripped(spark, d):
    label = F.concat(F.lit("WC-0"), F.col("p_partkey").cast("string"), F.lit(" - "), "p_name", F.when(F.col("p_partkey") % 3 == 0, " WC-7").otherwise(""))
    return _t(spark, d, "part").select("p_partkey", names.strip_codes(label, CODES).alias("bare"), names.has_code(label, CODES).alias("coded"))


PATHS = "paths AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '1_Home/' || c_mktsegment || '/' WHEN 1 THEN 'WC-9 x/' WHEN 2 THEN 'all/' || c_nationkey % 10 || '_' || c_mktsegment || '/' ELSE '' END AS folder, CASE c_custkey % 3 WHEN 0 THEN c_nationkey || '_' || c_mktsegment || '_' || c_custkey % 50 || 'b' WHEN 1 THEN c_mktsegment || ' ' || c_custkey % 100 ELSE 'IMG' || c_custkey || 'x' END AS stem FROM customer)"


def _paths(spark, d):
    key, kind, nation = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    folder = F.when(key % 4 == 0, F.concat(F.lit("1_Home/"), kind, F.lit("/"))).when(key % 4 == 1, "WC-9 x/").when(key % 4 == 2, F.concat(F.lit("all/"), (nation % 10).cast("string"), F.lit("_"), kind, F.lit("/"))).otherwise("")
    stem = F.when(key % 3 == 0, F.concat(nation.cast("string"), F.lit("_"), kind, F.lit("_"), (key % 50).cast("string"), F.lit("b"))).when(key % 3 == 1, F.concat(kind, F.lit(" "), (key % 100).cast("string"))).otherwise(F.concat(F.lit("IMG"), key.cast("string"), F.lit("x")))
    return _t(spark, d, "customer").select("c_custkey", F.concat(folder, stem, F.lit(".JPG")).alias("path"))


@query("WITH " + PATHS + r""", own AS (SELECT *, regexp_extract(stem, '^([0-9]{1,2})_(.+?)_([0-9]{1,3}[a-z]?)$', ['o', 'r', 's']) AS a, regexp_extract(stem, '^([^0-9_][^_]*?)[ _-]([0-9]{1,3}[a-z]?)$', ['r', 's']) AS b,
list_filter(string_split(folder, '/'), lambda x: x <> '') AS parts FROM paths),
f AS (SELECT *, list_filter(parts, lambda x: regexp_matches(x, '^[0-9]{1,2}_.+$'))[1] AS numbered, parts[-1] AS inner_ FROM own),
g AS (SELECT *, nullif(CASE WHEN a.r <> '' THEN a.r ELSE b.r END, '') AS mine, CASE WHEN inner_ IS NOT NULL AND NOT regexp_matches(lower(inner_), 'wc-[0-9]+') THEN inner_ END AS usable FROM f)
SELECT c_custkey, coalesce(mine, regexp_replace(usable, '^[0-9]{1,2}_', '')) AS room, coalesce(nullif(a.o, ''), CASE WHEN mine IS NULL THEN nullif(regexp_extract(usable, '^([0-9]{1,2})_', 1), '') END)::INT AS room_order,
nullif(CASE WHEN a.r <> '' THEN a.s ELSE b.s END, '') AS shot, regexp_extract(numbered, '^[0-9]{1,2}_(.+)$', 1) AS area, nullif(regexp_extract(numbered, '^([0-9]{1,2})_', 1), '')::INT AS area_order FROM g""")
def path_labels(spark, d):
    return _paths(spark, d).select("c_custkey", names.labels(F.col("path"), CODES).alias("l")).select("c_custkey", "l.*")


@query("""WITH once AS (SELECT DISTINCT 'S' || o_orderstatus || '_' AS prefix, o_orderkey AS num FROM orders WHERE o_orderkey % 7 <> 3), hole AS (SELECT prefix, num, coalesce(lead(num) OVER (PARTITION BY prefix ORDER BY num) - num - 1, 0) AS hole FROM once)
SELECT prefix, min(num) AS first, max(num) AS last, count(*) AS present, sum(hole)::BIGINT AS missing, max(hole) AS longest, count(*) FILTER (hole > 0) AS holes, max(hole) >= 12 AS alarm FROM hole GROUP BY prefix HAVING count(*) >= 5""")
def frame_gaps(spark, d):
    path = F.format_string("day/S%s_%06d.NEF", "o_orderstatus", "o_orderkey")
    return files.frame_gaps(_t(spark, d, "orders").where("o_orderkey % 7 <> 3").select(path.alias("path")), "path")


@query("SELECT o_orderstatus, num + 1 AS first, next - 1 AS last, next - num - 1 AS size FROM (SELECT o_orderstatus, o_orderkey AS num, lead(o_orderkey) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS next FROM (SELECT DISTINCT o_orderstatus, o_orderkey FROM orders)) WHERE next > num + 1")
def missing_runs(spark, d):
    return files.missing_runs(_t(spark, d, "orders"), "o_orderstatus", "o_orderkey")


@query("""WITH e AS (SELECT lower('f' || doc_id || CASE doc_id % 4 WHEN 0 THEN ' (1)' WHEN 1 THEN ' copy 2' ELSE '' END || '.jpg') AS key, 'a/F' || doc_id || CASE doc_id % 4 WHEN 0 THEN ' (1)' WHEN 1 THEN ' copy 2' ELSE '' END || '.JPG' AS path, 'f' || doc_id || '.jpg' AS twin FROM (SELECT DISTINCT doc_id FROM documents)),
h AS (SELECT DISTINCT 'f' || doc_id || CASE doc_id % 8 WHEN 0 THEN ' (1)' ELSE '' END || '.jpg' AS key FROM (SELECT doc_id FROM labels UNION ALL SELECT doc_id + 100000 FROM labels))
SELECT coalesce(e.key, h.key) AS key, path, CASE WHEN path IS NULL THEN 'extra' WHEN h.key IS NOT NULL THEN 'arrived' WHEN twin <> e.key AND twin IN (SELECT key FROM h) THEN 'deduped' ELSE 'missing' END AS status FROM e FULL JOIN h ON e.key = h.key""")
def inventory_twins(spark, d):
    i = F.col("doc_id")
    mark = F.when(i % 4 == 0, " (1)").when(i % 4 == 1, " copy 2").otherwise("")
    wanted = _t(spark, d, "documents").select(F.concat(F.lit("a/F"), i.cast("string"), mark, F.lit(".JPG")).alias("path"))
    labels = _t(spark, d, "labels").select("doc_id")
    here = labels.unionByName(labels.select((i + 100000).alias("doc_id"))).select(F.concat(F.lit("b/c/f"), i.cast("string"), F.when(i % 8 == 0, " (1)").otherwise(""), F.lit(".jpg")).alias("path"))
    return files.inventory(wanted, here, "path")


@query("""WITH a AS (SELECT 'zips/c' || o_custkey || '|.zip' AS set, (o_orderkey % 9) + 1 AS number, max(o_totalprice) AS size FROM orders GROUP BY ALL), m AS (SELECT *, max(number) OVER (PARTITION BY set) AS last, count(*) OVER (PARTITION BY set) AS n FROM a)
SELECT set, n AS parts, last::INT AS highest, array_to_string(list_filter(range(min(number), last + 1), lambda x: NOT list_contains(list(number), x)), ',') AS holes, max(size) FILTER (number = last) >= 0.95 * avg(size) FILTER (number < last) AS last_is_full,
len(list_filter(range(min(number), last + 1), lambda x: NOT list_contains(list(number), x))) > 0 OR max(size) FILTER (number = last) >= 0.95 * avg(size) FILTER (number < last) AS alarm FROM m WHERE n > 1 GROUP BY set, n, last""")
def part_sets(spark, d):
    path = F.format_string("zips/c%d-%03d.zip", "o_custkey", F.col("o_orderkey") % 9 + 1)
    own = _t(spark, d, "orders").groupBy(path.alias("path")).agg(F.max("o_totalprice").alias("size"))
    return files.part_report(own, "path", "size").withColumn("holes", F.array_join(F.transform("holes", lambda x: x.cast("string")), ","))


SHOTS = "s AS (SELECT p_partkey, CASE WHEN p_partkey % 11 > 0 THEN (p_partkey % 97) / 16.0 - 3 END AS roll, CASE WHEN p_partkey % 5 > 0 THEN (p_partkey % 40) / 2.0 END AS conv, p_partkey % 9 AS lines, CASE WHEN p_partkey % 4 > 0 THEN 10.0 + p_partkey % 15 END AS f35, CASE WHEN p_partkey % 3 > 0 THEN 20.0 END AS mm, (p_size / 3)::DOUBLE AS blown, (p_size / 2)::DOUBLE AS black, p_partkey % 2 = 0 AS bracket FROM part)"
WHOLE = "round_even({x}, 0)::BIGINT"


def _shots(spark, d):
    k = F.col("p_partkey")
    return _t(spark, d, "part").select(
        "p_partkey", F.when(k % 11 > 0, (k % 97) / 16.0 - 3).alias("roll"), F.when(k % 5 > 0, (k % 40) / 2.0).alias("conv"), (k % 9).alias("lines"), F.when(k % 4 > 0, F.lit(10.0) + k % 15).alias("f35"), F.when(k % 3 > 0, F.lit(20.0)).alias("mm"),
        (F.col("p_size") / 3.0).alias("blown"), (F.col("p_size") / 2.0).alias("black"), (k % 2 == 0).alias("bracket"))


@query("WITH " + SHOTS + """ SELECT p_partkey, concat_ws('|', CASE WHEN abs(roll) >= 3 THEN 'leaning ' || printf('%+.1f', roll) || '°' END, CASE WHEN conv >= 12 THEN 'verticals splay ' || """ + WHOLE.format(x="conv") + """ || '° (three-point perspective)' END, CASE WHEN f35 < 15 THEN """ + WHOLE.format(x="f35") + """ || 'mm equivalent — edge stretching' END) AS flags,
concat_ws('|', CASE WHEN abs(roll) >= 1 AND abs(roll) < 3 THEN 'slight lean ' || printf('%+.1f', roll) || '°' END, CASE WHEN conv >= 5 AND conv < 12 THEN 'verticals splay ' || """ + WHOLE.format(x="conv") + """ || '°' END, CASE WHEN conv IS NULL AND lines < 6 THEN 'geometry unmeasurable (' || lines || ' verticals found)' END,
CASE WHEN f35 >= 15 AND f35 < 18 THEN """ + WHOLE.format(x="f35") + """ || 'mm equivalent, wide' END, CASE WHEN f35 IS NULL AND mm IS NOT NULL THEN """ + WHOLE.format(x="mm") + """ || 'mm, sensor unknown — can''t check the wide-angle rule' END,
CASE WHEN blown >= 8 THEN """ + WHOLE.format(x="blown") + """ || '% blown out' || CASE WHEN bracket THEN ' — a bracket should fix this' ELSE '' END END, CASE WHEN black >= 12 THEN """ + WHOLE.format(x="black") + """ || '% crushed black' END) AS warnings FROM s""")
def quality_flags(spark, d):
    x, c = quality.Limits(), F.col
    warned = quality.warnings(x, c("roll"), c("conv"), c("lines"), c("f35"), c("mm"), c("blown"), c("black"), c("bracket"))
    return _shots(spark, d).select("p_partkey", F.array_join(quality.flags(x, c("roll"), c("conv"), c("f35")), "|").alias("flags"), F.array_join(warned, "|").alias("warnings"))


@query("WITH " + SHOTS + """ SELECT p_partkey, concat_ws('; ', CASE WHEN roll IS NULL THEN 'levelness not measurable' WHEN abs(roll) >= 3 THEN 'FAULT: leaning ' || """ + WHOLE.format(x="abs(roll)") + """ || ' degrees off level' WHEN abs(roll) >= 1 THEN 'slightly off level' ELSE 'level' END,
CASE WHEN conv IS NULL THEN 'too few verticals in frame to check them' WHEN conv >= 12 THEN 'FAULT: verticals splay badly (three-point perspective)' WHEN conv >= 5 THEN 'verticals splay a little' ELSE 'verticals straight' END,
CASE WHEN blown >= 8 THEN 'large blown-out areas' WHEN blown >= 3 THEN 'some blown highlights' END, CASE WHEN black >= 12 THEN 'crushed blacks' END, CASE WHEN f35 < 15 THEN 'FAULT: ' || """ + WHOLE.format(x="f35") + """ || 'mm equivalent, stretches the edges' END, CASE WHEN lines > 1 THEN 'exposure bracket of ' || lines || ', will be merged' END) AS verdict FROM s""")
def verdicts(spark, d):
    c = F.col
    return _shots(spark, d).select("p_partkey", quality.verdict(quality.Limits(), c("roll"), c("conv"), c("f35"), c("blown"), c("black"), c("lines")).alias("verdict"))


RATIO_ROWS = ", ".join(f"({i}, '{k}', {v!r})" for i, (k, v) in enumerate(quality.RATIOS.items()))


@query("WITH r(i, name, v) AS (VALUES " + RATIO_ROWS + """), w AS (SELECT p_partkey, 200 + p_partkey * 37 % 4000 AS w, 200 + p_size * 53 AS h FROM part), n AS (SELECT p_partkey, arg_min(name, (abs(w / h - v), i)) AS ratio FROM w, r GROUP BY p_partkey)
SELECT n.p_partkey, ratio, greatest(16, (round_even((CASE WHEN w / h >= 1 THEN 2048.0::DOUBLE ELSE 2048 * (w / h) END) / 16, 0) * 16)::INT) AS width, greatest(16, (round_even((CASE WHEN w / h >= 1 THEN 2048 / (w / h) ELSE 2048.0::DOUBLE END) / 16, 0) * 16)::INT) AS height FROM n JOIN w ON w.p_partkey = n.p_partkey""")
def sizes(spark, d):
    w, h = F.lit(200) + F.col("p_partkey") * 37 % 4000, F.lit(200) + F.col("p_size") * 53
    size = quality.custom_size(w, h)
    return _t(spark, d, "part").select("p_partkey", quality.nearest_ratio(w, h).alias("ratio"), size["width"].alias("width"), size["height"].alias("height"))


@query("SELECT vec_id, round(100.0 * len(list_filter(embedding, lambda x: x <= -0.2)) / 64, 6) AS shadow_clip, round(100.0 * len(list_filter(embedding, lambda x: x >= 0.2)) / 64, 6) AS highlight_clip FROM embeddings")
def grey_stats(spark, d):
    # A component of -0.2 stands for grey 0, of 0.2 for 255.
    pixels = F.transform("embedding", lambda x: F.when(x.cast("float") <= F.lit(-0.2), 0).when(x >= F.lit(0.2), 255).otherwise(100))
    return _t(spark, d, "embeddings").select("vec_id", quality.greys(pixels).alias("g")).select("vec_id", F.round("g.shadow_clip", 6).alias("shadow_clip"), F.round("g.highlight_clip", 6).alias("highlight_clip"))


CATALOG = "cat AS (SELECT doc_id AS key, CASE quality WHEN 1 THEN 'SALA' ELSE 'QUARTO' END AS ambiente, CASE doc_id % 3 WHEN 0 THEN 'SALA' WHEN 1 THEN 'QUARTO' END AS seen, (doc_id % 4 + 1)::INT AS room_no FROM (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id))"
SCENES = "scenes AS (SELECT doc_id AS scene, source AS area, lang AS room, (n_chars % 4)::INT AS room_order, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'SALA' ELSE 'QUARTO' END AS ambiente, [doc_id + 1, doc_id, doc_id + 2] AS frames FROM documents)"
HIT = ", tries AS (SELECT scene, unnest(frames) AS key, unnest(range(0, 3)) AS place FROM scenes), hits AS (SELECT scene, arg_min(struct_pack(ambiente, seen, room_no), place) AS r FROM tries JOIN cat USING (key) GROUP BY scene)"


def _catalog(spark, d):
    i = F.col("doc_id")
    own = _t(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return own.select(i.alias("key"), F.when(F.col("quality") == 1, "SALA").otherwise("QUARTO").alias("ambiente"), F.when(i % 3 == 0, "SALA").when(i % 3 == 1, "QUARTO").alias("seen"), (i % 4 + 1).cast("int").alias("room_no"), F.lit("keyword").alias("source"), F.lit(None).cast("string").alias("note"))


def _scenes(spark, d):
    i = F.col("doc_id")
    own = _t(spark, d, "documents").select(i.alias("scene"), F.col("source").alias("area"), F.col("lang").alias("room"), (F.col("n_chars") % 4).cast("int").alias("room_order"), F.when(i % 5 == 0, None).when(i % 5 == 1, "SALA").otherwise("QUARTO").alias("ambiente"), F.array(i + 1, i, i + 2).alias("frames"))
    return own.withColumns({"area_order": F.lit(None).cast("int"), "seen": F.lit(None).cast("string"), "source": F.lit("keyword"), "note": F.lit(None).cast("string")})


@query("WITH " + SCENES + ", " + CATALOG + HIT + """ SELECT s.scene, CASE WHEN r.seen IS NOT NULL AND r.ambiente <> r.seen THEN r.ambiente ELSE s.ambiente END AS ambiente, CASE WHEN r.seen IS NOT NULL AND r.ambiente <> r.seen THEN 'manual' ELSE 'keyword' END AS source,
CASE WHEN r IS NOT NULL AND NOT coalesce(r.seen IS NOT NULL AND r.ambiente <> r.seen, false) AND r.ambiente IS NOT DISTINCT FROM s.ambiente THEN r.room_no ELSE 1 END AS hint FROM scenes s LEFT JOIN hits h ON h.scene = s.scene""")
def catalog_applied(spark, d):
    joined = rooms.first_hit(_scenes(spark, d), "scene", "frames", _catalog(spark, d), "key")
    hint = rooms.room_hint(F.col("ambiente"), F.col("row"), F.lit(None).cast("int"))
    return rooms.applied(joined.withColumn("hint", hint), only_edited=True).select("scene", "ambiente", "source", "hint")


@query("WITH " + SCENES + """, split AS (SELECT area, coalesce(ambiente, '') AS a FROM scenes WHERE room <> '' GROUP BY ALL HAVING count(DISTINCT (room_order, room)) > 1),
k AS (SELECT s.*, sp.area IS NOT NULL AS cut FROM scenes s LEFT JOIN split sp ON sp.area = s.area AND sp.a = coalesce(s.ambiente, '')),
r AS (SELECT area, CASE WHEN cut THEN room_order ELSE 99 END AS ro, CASE WHEN cut THEN room ELSE '' END AS room, coalesce(ambiente, '') AS a, count(*) AS scenes FROM k GROUP BY ALL),
w AS (SELECT *, CASE a WHEN '' THEN 'NAO_IDENTIFICADO' ELSE a END AS kind, row_number() OVER (ORDER BY area, ro, room, a) AS step FROM r), f AS (SELECT *, min(step) OVER (PARTITION BY kind) AS f FROM w)
SELECT area, ro AS room_order, room, kind, scenes, step, row_number() OVER (PARTITION BY kind ORDER BY step) AS room_no, dense_rank() OVER (ORDER BY f) AS kind_no FROM f""")
def room_walk(spark, d):
    out = rooms.walked(rooms.keyed(_scenes(spark, d), F.lit(1)))
    return out.select("room_key.area", "room_key.room_order", "room_key.room", "kind", "scenes", "step", "room_no", "kind_no")


@query("WITH " + CATALOG + """ SELECT source AS room, bool_and(coalesce(seen IS NOT NULL AND ambiente <> seen, false)) AND count(DISTINCT ambiente) FILTER (seen IS NOT NULL AND ambiente <> seen) = 1 AS settled,
CASE WHEN bool_and(coalesce(seen IS NOT NULL AND ambiente <> seen, false)) AND count(DISTINCT ambiente) FILTER (seen IS NOT NULL AND ambiente <> seen) = 1 THEN min(ambiente) END AS answer FROM (SELECT d.lang || d.doc_id % 97 AS source, c.* FROM documents d LEFT JOIN cat c ON c.key = d.doc_id) GROUP BY source""")
def settled_rooms(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("key"), F.concat("lang", (F.col("doc_id") % 97).cast("string")).alias("room"))
    return rooms.settled(docs.join(_catalog(spark, d), "key", "left"), "room")


@query("SELECT lang, free::INT AS free FROM (SELECT lang, min(i) AS free FROM (SELECT DISTINCT lang FROM documents) l, range(1, 100000) r(i) WHERE NOT EXISTS (SELECT 1 FROM documents x WHERE x.lang = l.lang AND x.doc_id = i) GROUP BY lang)")
def next_free(spark, d):
    return rooms.next_free(_t(spark, d, "documents"), "lang", "doc_id")


@query("SELECT source, coalesce(max(n_chars) FILTER (lang = 'en'), 0) + 1 AS next FROM documents GROUP BY source")
def next_number(spark, d):
    return rooms.next_number(_t(spark, d, "documents").withColumn("n", F.when(F.col("lang") == "en", F.col("n_chars"))), "source", "n")


@query("SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY floor(s_acctbal / 1000) DESC, s_name) AS room_no FROM supplier")
def split_order(spark, d):
    own = _t(spark, d, "supplier").withColumn("size", F.floor(F.col("s_acctbal") / 1000))
    return rooms.split_order(own, "s_nationkey", "size", "s_name").select("s_nationkey", "s_suppkey", "room_no")


@query("""SELECT d.doc_id, coalesce(note IS NOT NULL, false) AS chosen, note AS pick_note FROM documents d LEFT JOIN (SELECT doc_id, 'q' || min(toxic) AS note FROM labels WHERE quality = 1 GROUP BY doc_id) p ON p.doc_id = d.doc_id""")
def picks_override(spark, d):
    picks = _t(spark, d, "labels").where("quality = 1").select(F.col("doc_id").alias("key"), F.concat(F.lit("q"), F.col("toxic").cast("string")).alias("note"))
    scenes = _t(spark, d, "documents").withColumn("chosen", F.col("n_chars") > 1000)
    return rooms.picked(scenes, "doc_id", picks, "key").select("doc_id", "chosen", "pick_note")


KINDS = "k AS (SELECT c_custkey, c_custkey % 120 AS files, (c_custkey % 10) / 10.0 AS raw, (c_custkey % 7) / 10.0 AS bracket, (c_custkey % 11) / 10.0 AS labelled, c_custkey % 4 AS rooms, c_custkey % 5 AS mid, CASE WHEN c_custkey % 13 = 0 THEN 'B' END AS forced FROM customer)"


@query("WITH " + KINDS + """, t AS (SELECT *, CASE WHEN raw >= 0.5 AND bracket >= 0.2 THEN 'D' WHEN raw >= 0.5 THEN 'E' WHEN files <= 60 AND rooms > 0 AND mid <= 3 THEN 'A' WHEN files <= 60 AND rooms = 0 THEN 'A' WHEN labelled >= 0.6 AND rooms = 1 THEN 'C' WHEN labelled >= 0.6 THEN 'B' ELSE 'C' END AS kind FROM k),
r AS (SELECT *, CASE WHEN kind = 'A' AND rooms = 0 AND forced IS NULL AND files / 10.0 > 3 THEN 'C' ELSE coalesce(forced, kind) END AS revised FROM t)
SELECT c_custkey, kind, revised, CASE WHEN revised = 'A' THEN 9 ELSE 4 END AS slots, CASE WHEN rooms <= 0 THEN 'T0' WHEN rooms <= 1 THEN 'T1' END AS warned FROM r""")
def delivery_kinds(spark, d):
    k, c = F.col("c_custkey"), F.col
    own = _t(spark, d, "customer").select("c_custkey", (k % 120).alias("files"), ((k % 10) / 10.0).alias("raw"), ((k % 7) / 10.0).alias("bracket"), ((k % 11) / 10.0).alias("labelled"), (k % 4).alias("rooms"), (k % 5).alias("mid"), F.when(k % 13 == 0, "B").alias("forced"))
    own = own.withColumn("kind", rooms.delivery_kind(c("files"), c("raw"), c("bracket"), c("labelled"), c("rooms"), c("mid")))
    own = own.withColumn("revised", rooms.revised_kind(c("kind"), c("rooms"), c("forced"), c("files"), F.lit(10)))
    bands = [(0, "T0", 10, 20), (1, "T1", 15, 25), (9, "T2", 30, 50)]
    return own.select("c_custkey", "kind", "revised", rooms.quota_of(c("revised"), F.lit(4), F.lit(9)).alias("slots"), rooms.typology(c("rooms"), bands, 40, 60).alias("warned"))


@query("SELECT o_custkey, count(DISTINCT o_orderpriority) AS photos FROM orders GROUP BY o_custkey")
def identities(spark, d):
    mark = F.element_at(F.array(F.lit(""), F.lit("_edit"), F.lit("_final_2")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return rooms.identities(_t(spark, d, "orders"), "o_custkey", names.strip_result(F.concat("o_orderpriority", mark)))


@query("""SELECT n_name, array_to_string(list_sort(list(s_name))[1:3], ', ') || CASE WHEN count(*) > 3 THEN ' … ' || (count(*) - 3) || ' more' ELSE '' END AS names FROM (SELECT DISTINCT n_name, s_name FROM supplier JOIN nation ON n_nationkey = s_nationkey) GROUP BY n_name""")
def top_names(spark, d):
    own = _t(spark, d, "supplier").join(F.broadcast(_t(spark, d, "nation")), F.col("n_nationkey") == F.col("s_nationkey"))
    return rooms.listed(own, "n_name", "s_name", 3)


RESULTS = "photos AS (SELECT DISTINCT o_custkey AS job, 'P' || o_orderkey AS stem FROM orders), made AS (SELECT DISTINCT o_custkey AS job, 'P' || o_orderkey || CASE WHEN o_orderkey % 3 = 0 THEN '_edit.jpg' ELSE '_edit_1.jpg' END AS name FROM orders WHERE o_orderkey % 4 > 0), done AS (SELECT p.job, stem, name AS result FROM photos p LEFT JOIN made m ON m.job = p.job AND (name = stem || '_edit.jpg' OR name = stem || '_edit_1.jpg'))"


def _results(spark, d):
    k = F.col("o_orderkey")
    orders = _t(spark, d, "orders").select(F.col("o_custkey").alias("job"), F.concat(F.lit("P"), k.cast("string")).alias("stem"), k)
    made = orders.where(k % 4 > 0).select("job", F.concat("stem", F.when(k % 3 == 0, "_edit.jpg").otherwise("_edit_1.jpg")).alias("name"))
    return files.results(orders.select("job", "stem").distinct(), made, "job", "stem", "name", "_edit")


@query("WITH " + RESULTS + " SELECT job, stem, result FROM done")
def results_of(spark, d):
    return _results(spark, d)


@query("WITH " + RESULTS + " SELECT job, stem FROM done WHERE result IS NULL")
def work_left(spark, d):
    done = _results(spark, d)
    return files.to_run(done.select("job", "stem"), done.where("result is not null"), ["job", "stem"])


@query("SELECT o_orderkey, CASE WHEN l IS NULL THEN true ELSE l < greatest(o_orderdate, TIMESTAMP '1996-01-01') END AS stale FROM (SELECT DISTINCT o_orderkey, o_orderdate FROM orders) LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS l FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey")
def stale_results(spark, d):
    made = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("l"))
    own = _t(spark, d, "orders").select("o_orderkey", "o_orderdate").distinct().join(made, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return own.select("o_orderkey", files.is_stale(F.col("l"), F.col("o_orderdate"), F.lit("1996-01-01").cast("timestamp_ntz")).alias("stale"))


@query("""WITH f AS (SELECT DISTINCT 'r' || p_size % 5 || '/' || p_brand || '.nef' AS path, p_brand AS stem, 'r' || p_size % 5 AS folder FROM part WHERE p_size > 3), p AS (SELECT DISTINCT 'r' || p_size % 5 || '/' || p_brand || '.nef' AS path FROM part WHERE p_retailprice > 1098)
SELECT path, CASE WHEN row_number() OVER (PARTITION BY stem ORDER BY path) = 1 THEN stem ELSE folder || '_' || stem END AS name FROM f WHERE path NOT IN (SELECT path FROM p)""")
def rest_names(spark, d):
    path = F.concat(F.lit("r"), (F.col("p_size") % 5).cast("string"), F.lit("/"), "p_brand", F.lit(".nef")).alias("path")
    part = _t(spark, d, "part")
    return files.rest(part.where("p_size > 3").select(path).distinct(), part.where("p_retailprice > 1098").select(path), "path")


@query("""SELECT 'Job_' || o_custkey AS job, CASE min(CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 WHEN 'P' THEN 2 END) WHEN 0 THEN 'O' WHEN 1 THEN 'F' ELSE 'P' END AS stage, count(DISTINCT o_orderstatus) > 1 AS clash FROM orders WHERE o_orderstatus IN ('O', 'F', 'P') GROUP BY o_custkey""")
def jobs_once(spark, d):
    own = _t(spark, d, "orders").select(F.concat(F.lit("Job_"), F.col("o_custkey").cast("string")).alias("job"), F.col("o_orderstatus").alias("stage"))
    return files.jobs(own, "job", "stage", ["O", "F", "P"])


@query("""WITH v AS (SELECT DISTINCT o_custkey AS stem, (o_orderkey % 6 + 1) AS n FROM orders) SELECT stem, 'S' || stem || '_edit_r' || max(n) || '.jpg' AS newest, (SELECT min(i) FROM range(1, 9) r(i) WHERE NOT list_contains(list(n), i))::INT AS next FROM v GROUP BY stem""")
def shelved_versions(spark, d):
    own = _t(spark, d, "orders").select(F.col("o_custkey").alias("stem"), F.format_string("S%d_edit_r%d.jpg", "o_custkey", F.col("o_orderkey") % 6 + 1).alias("name"))
    return files.versions(own, "stem", "name").select("stem", "newest", F.col("next").cast("int").alias("next"))


MARKS = "marks AS (SELECT DISTINCT o_custkey AS job, o_orderkey, 'P' || CASE WHEN o_orderkey % 10 = 0 THEN 'x' ELSE '' END || o_orderkey AS stem, o_orderkey % 5 <> 1 AS back, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS comment FROM orders WHERE o_orderkey % 4 = 1 OR o_orderkey % 10 = 0)"


def _marks(spark, d):
    k = F.col("o_orderkey")
    key = F.concat(F.lit("some/P"), F.when(k % 10 == 0, "x").otherwise(""), k.cast("string"), F.when(k % 2 == 0, "_edit.jpg").otherwise(""))
    own = _t(spark, d, "orders").where("o_orderkey % 4 = 1 or o_orderkey % 10 = 0").select(F.col("o_custkey").alias("job"), k, key.alias("key"), (k % 5 != 1).alias("back"), F.when(k % 3 > 0, F.col("o_orderpriority")).alias("comment")).distinct()
    photos = _t(spark, d, "orders").select(F.col("o_custkey").alias("job"), F.concat(F.lit("P"), k.cast("string")).alias("stem")).distinct()
    return gates.marks_on(own, photos, "job", "key")


@query("WITH " + MARKS + " SELECT job, o_orderkey, stem, o_orderkey % 10 <> 0 AS known FROM marks")
def marks_resolved(spark, d):
    return _marks(spark, d).select("job", "o_orderkey", "stem", "known")


@query("WITH " + RESULTS + ", " + MARKS + """, b AS (SELECT job, count(DISTINCT stem) AS back FROM marks WHERE back AND o_orderkey % 10 <> 0 GROUP BY job), m AS (SELECT job, count(*) AS photos, count(*) FILTER (result IS NULL) AS missing FROM done GROUP BY job)
SELECT m.job, photos, missing, coalesce(back, 0) AS back, missing = 0 AND coalesce(back, 0) = 0 AS sound FROM m LEFT JOIN b ON b.job = m.job""")
def approval_checks(spark, d):
    return gates.approvals(_results(spark, d), _marks(spark, d), "job")


@query("WITH " + MARKS + """, c AS (SELECT job, count(*) FILTER (o_orderkey % 10 <> 0) AS known, count(*) FILTER (o_orderkey % 10 <> 0 AND back) AS back, count(*) FILTER (o_orderkey % 10 <> 0 AND back AND comment IS NULL) AS silent, count(*) FILTER (o_orderkey % 10 = 0) AS unknown FROM marks GROUP BY job)
SELECT *, CASE WHEN known = 0 THEN 'nothing marked' WHEN back = 0 THEN 'nothing sent back' WHEN silent > 0 THEN 'no comment' END AS refused FROM c""")
def rework_checks(spark, d):
    return gates.reworks(_marks(spark, d), "job")


@query("WITH " + RESULTS + ", " + MARKS + " SELECT d.job, d.stem, result, comment FROM done d JOIN marks m ON m.job = d.job AND m.stem = d.stem WHERE back AND o_orderkey % 10 <> 0")
def rework_list(spark, d):
    return gates.to_rework(_results(spark, d), _marks(spark, d), "job")


@query("SELECT o_custkey, o_orderstatus, count(*) AS n, count(*) > 1 AS refused FROM orders GROUP BY ALL")
def stage_moves(spark, d):
    return gates.moves(_t(spark, d, "orders"), "o_custkey", "o_orderstatus")


CLAIMS = "offered AS (SELECT DISTINCT s_nationkey AS room, 'img_' || lpad((s_suppkey * 31 % 97)::VARCHAR, 4, '0') || CASE WHEN s_suppkey % 2 = 0 THEN '.jpg' ELSE '.heic' END AS name FROM supplier), claims AS (SELECT DISTINCT s_nationkey AS room, CASE s_suppkey % 4 WHEN 0 THEN 'a/IMG_' ELSE 'IMG_' END || lpad((s_suppkey * 31 % 97)::VARCHAR, 4, '0') || CASE s_suppkey % 5 WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' WHEN 2 THEN '' ELSE '.jpg' END AS claim FROM supplier)"


@query("WITH " + CLAIMS + """, c AS (SELECT *, lower(claim) AS whole, lower(string_split(claim, '/')[-1]) AS base FROM claims), e AS (SELECT *, regexp_replace(base, '\\.[^.]+$', '') AS stem, left(base, greatest(8, length(base) - 4)::BIGINT) AS prefix FROM c),
h AS (SELECT e.room, claim, name, CASE WHEN name = whole THEN 1 WHEN name = base THEN 2 END AS r12, regexp_replace(name, '\\.[^.]+$', '') = stem AS r3, starts_with(name, prefix) AS r4 FROM e JOIN offered o ON o.room = e.room),
g AS (SELECT room, claim, arg_min(name, r12) FILTER (r12 IS NOT NULL) AS a, CASE WHEN count(*) FILTER (r3) = 1 THEN min(name) FILTER (r3) END AS b, CASE WHEN count(*) FILTER (r4) = 1 THEN min(name) FILTER (r4) END AS c FROM h GROUP BY room, claim)
SELECT c.room, c.claim, coalesce(a, b, g.c) AS match FROM claims c LEFT JOIN g ON g.room = c.room AND g.claim = c.claim""")
def answers_matched(spark, d):
    k = F.col("s_suppkey")
    number = F.lpad((k * 31 % 97).cast("string"), 4, "0")
    own = _t(spark, d, "supplier")
    offered = own.select(F.col("s_nationkey").alias("room"), F.concat(F.lit("img_"), number, F.when(k % 2 == 0, ".jpg").otherwise(".heic")).alias("name"))
    ending = F.when(k % 5 == 0, ".png").when(k % 5 == 1, ".JPG").when(k % 5 == 2, "").otherwise(".jpg")
    claims = own.select(F.col("s_nationkey").alias("room"), F.concat(F.when(k % 4 == 0, "a/IMG_").otherwise("IMG_"), number, ending).alias("claim")).distinct()
    return gates.matched(claims, offered, "room", "claim", "name")


@query("""WITH l AS (SELECT conv_id, min(turn) AS turn, text FROM conversations WHERE role = 'user' GROUP BY conv_id, text), r AS (SELECT conv_id, text, arg_min(role, turn) AS role, min(turn) AS turn FROM conversations WHERE role <> 'user' GROUP BY conv_id, text)
SELECT conv_id, 'retouch ' || turn AS label, md5(text) AS digest, 'done' AS kind FROM l UNION ALL SELECT conv_id, 'round ' || turn, md5(text), CASE WHEN turn % 3 = 0 THEN 'failed' ELSE 'kept' END FROM r WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.conv_id = r.conv_id AND l.text = r.text)""")
def asks(spark, d):
    own = _t(spark, d, "conversations").withColumns({"n": F.col("turn").cast("int"), "at": F.col("turn").cast("string"), "back": F.col("turn") % 3 == 0, "previous": F.lit(None).cast("string")})
    logs = own.where("role = 'user'").groupBy("conv_id", "text").agg(F.min("n").alias("n"), F.min("at").alias("at"), F.min("previous").alias("previous"))
    out = gates.asked(logs, own.where("role <> 'user'"), "conv_id")
    return out.select("conv_id", "label", F.md5("text").alias("digest"), "kind")


@query("""WITH f AS (SELECT user_id, min(ts) FILTER (event_type = 'signup') AS a, min(ts) FILTER (event_type = 'view') AS b, min(ts) FILTER (event_type = 'purchase') AS c FROM events GROUP BY user_id)
SELECT 1 AS place, 'signup' AS step, count(*) AS keys, NULL::DOUBLE AS seconds FROM f WHERE a IS NOT NULL UNION ALL SELECT 2, 'view', count(*), median(datesub('second', a, b)) FROM f WHERE a <= b HAVING count(*) > 0 UNION ALL SELECT 3, 'purchase', count(*), median(datesub('second', b, c)) FROM f WHERE a <= b AND b <= c HAVING count(*) > 0""")
def ledger_funnel(spark, d):
    return ledger.funnel(_t(spark, d, "events"), "user_id", "ts", "event_type", ["signup", "view", "purchase"])


@query("""WITH c AS (SELECT s_nationkey AS room, s_name AS file, (s_suppkey % 3)::INT AS flags, s_acctbal AS score, s_suppkey FROM supplier), l AS (SELECT *, row_number() OVER (PARTITION BY room ORDER BY flags, score DESC, file) AS rank FROM c)
SELECT room, file, rank, 'measured' AS reason, (10 - flags)::INT AS purpose FROM l WHERE rank <= 3""")
def scorer_picks(spark, d):
    own = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("room"), F.col("s_name").alias("file"), (F.col("s_suppkey") % 3).cast("int").alias("flags"), F.col("s_acctbal").alias("score"))
    told = answers.Offline().ranking(own).select("room", answers.ranking(F.col("answer")).alias("a")).select("room", "a.picks")
    slots = own.select("room").distinct().withColumn("slots", F.lit(3))
    return answers.chosen(told, own, slots, "room", "file").select("room", "file", "rank", "reason", "purpose")


@query("""WITH v AS (SELECT user_id AS room, event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY ALL) SELECT room, 'view' AS mapped, arg_max(event_type, (n, -first)) AS ambiente, arg_max(event_type, (n, -first)) <> 'view' AS corrected, count(*) > 1 AS split FROM v GROUP BY room""")
def rooms_confirmed(spark, d):
    votes = _t(spark, d, "events").select(F.col("user_id").alias("room"), "event_id", F.lit("view").alias("mapped"), F.col("event_type").alias("ambiente"))
    return answers.confirmed(votes, "room", "event_id")


@query("""WITH p AS (SELECT s_nationkey % 20 AS room, s_name AS file, CASE WHEN s_suppkey % 17 > 0 THEN s_suppkey % 3 END AS part FROM supplier), w AS (SELECT *, count(*) OVER (PARTITION BY room) <= 12 AND count(part) OVER (PARTITION BY room) = count(*) OVER (PARTITION BY room) AS whole FROM p),
q AS (SELECT room, file, CASE WHEN whole THEN part ELSE 0 END AS part FROM w), g AS (SELECT room, part, row_number() OVER (PARTITION BY room ORDER BY count(*) DESC, min(file)) AS no FROM q GROUP BY room, part) SELECT q.room, file, no AS part FROM q JOIN g ON g.room = q.room AND g.part = q.part""")
def rooms_split(spark, d):
    own = _t(spark, d, "supplier").select((F.col("s_nationkey") % 20).alias("room"), F.col("s_name").alias("file"), F.col("s_suppkey").alias("k"))
    claims = own.where("k % 17 > 0").select("room", "file", (F.col("k") % 3).alias("part"))
    return answers.split(claims, own.select("room", "file"), "room", "file")


LINES = "s AS (SELECT l_orderkey % 400 AS photo, l_partkey % 1000 AS x1, 50 AS y1, l_partkey % 1000 + (l_suppkey * 7 % 90 - 45) + l_partkey % 1000 // 40 AS x2, (200 + l_linenumber * 30)::INT AS y2 FROM lineitem)"


@query("WITH " + LINES + """, m AS (SELECT *, (x1 + x2) / 2.0 AS x, degrees(atan2((x2 - x1)::DOUBLE, (y2 - y1)::DOUBLE)) AS y, sqrt((x2 - x1)::DOUBLE * (x2 - x1) + (y2 - y1)::DOUBLE * (y2 - y1)) AS len FROM s), g AS (SELECT * FROM m WHERE abs(y) <= 15 AND len >= 700 * 0.14),
u AS (SELECT photo, x, y, row_number() OVER (PARTITION BY photo ORDER BY x1, x2, y2) - 1 AS i, count(*) OVER (PARTITION BY photo) AS n, max(x) OVER (PARTITION BY photo) - min(x) OVER (PARTITION BY photo) AS span FROM g), f AS (SELECT * FROM u WHERE n >= 6 AND span >= 350),
e AS (SELECT * FROM f WHERE n <= 40 OR i IN (SELECT unnest(list_transform(range(0, 40), lambda k: (k * (n - 1)) // 39)))),
l AS (SELECT a.photo, median((b.y - a.y) / (b.x - a.x)) AS slope FROM e a JOIN e b ON a.photo = b.photo AND a.i < b.i WHERE abs(b.x - a.x) > 50 GROUP BY a.photo HAVING count(*) >= 3),
r AS (SELECT f.photo, round_even(abs(any_value(slope) * 1000), 2) AS convergence_deg, round_even(median(y - slope * (x - 500.0)), 2) AS roll_deg FROM f JOIN l ON l.photo = f.photo GROUP BY f.photo)
SELECT c.photo, convergence_deg, roll_deg, lines FROM (SELECT photo, count(*) FILTER (abs(y) <= 15 AND len >= 700 * 0.14) AS lines FROM m GROUP BY photo) c LEFT JOIN r ON r.photo = c.photo""")
def vertical_geometry(spark, d):
    x = F.col("l_partkey") % 1000
    own = _t(spark, d, "lineitem").select((F.col("l_orderkey") % 400).alias("photo"), x.alias("x1"), F.lit(50).alias("y1"), (x + (F.col("l_suppkey") * 7 % 90 - 45) + F.floor(x / 40)).alias("x2"), (F.lit(200) + F.col("l_linenumber") * 30).alias("y2"), F.lit(1000).alias("w"), F.lit(700).alias("h"))
    return geometry.vertical_geometry(own, "photo", ["x1", "x2", "y2"])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment ELSE 'SEM_AMBIENTE' END AS kind, CASE WHEN c_custkey % 4 > 0 THEN printf('%s_%02d', c_mktsegment, c_nationkey) ELSE '—' END AS room,
c_custkey % 4 = 0 AS odd, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment ELSE lower(c_mktsegment) || c_custkey END AS first, CASE WHEN c_custkey % 4 > 0 THEN c_nationkey ELSE 0 END AS second, (CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 10000 ELSE 0 END)::INT AS third FROM customer""")
def name_sections(spark, d):
    k = F.col("c_custkey")
    name = F.when(k % 4 > 0, F.format_string("%s_%02d_%04d_edit", "c_mktsegment", "c_nationkey", k % 10000)).otherwise(F.concat(F.lower("c_mktsegment"), k.cast("string")))
    own = _t(spark, d, "customer").select("c_custkey", ranking.sort_key(name).alias("k"), ranking.section(name).alias("s"))
    return own.select("c_custkey", "s.kind", "s.room", "k.odd", F.col("k.kind").alias("first"), F.col("k.room").alias("second"), F.col("k.number").alias("third"))
