"""Registered queries against their SQL over rows that the given tables don't have, or have only in their larger copies."""

import json
from pathlib import Path

import duckdb

from sievewright.operators import contest, gates
from sievewright.plans import catalog, deliveries, verdicts  # noqa: F401


def both(spark, tmp_path, name, table, select):
    """The rows of a query and of its SQL over one table that DuckDB makes."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"COPY ({select}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    df = catalog.QUERIES[name](spark, str(tmp_path))
    want = con.execute(catalog.ORACLES[name])
    columns = [c[0] for c in want.description]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str), sorted(want.fetchall(), key=str)


def test_noun_conflict_keeps_short_singulars(spark, tmp_path):
    got, want = both(spark, tmp_path, "noun_conflict", "conversations", "SELECT 1::BIGINT AS conv_id, 2::BIGINT AS turn, 'user' AS role, 'Vases and eses. Kettle und ches! Eses in vase. Ches la kettle.' AS text")
    assert got == want
    assert {"ch", "es", "kettle"} <= {r[1] for r in got}


def test_retry_summary_rounds_to_seconds(spark, tmp_path):
    ends = ("2024-01-01 23:59:59.4", "2024-01-01 23:59:59.5", "2024-01-01 23:59:59.6", "2024-01-02 00:00:00.5", "1969-12-31 23:59:59.2", "1969-12-30 23:59:58.5", "1969-12-28 12:00:00")
    rows = ", ".join(f"({i}, 7, TIMESTAMP '{at}', 'error')" for i, at in enumerate(ends)) + ", (20, 7, TIMESTAMP '2024-01-01 10:00:00', 'view'), (21, 7, NULL, 'view'), (22, 8, TIMESTAMP '2024-01-01 10:00:00', NULL)"
    got, want = both(spark, tmp_path, "retry_summary", "events", f"SELECT column0::BIGINT AS event_id, column2 AS ts, column1::BIGINT AS user_id, column3 AS event_type, 1.0::DOUBLE AS value, '' AS props FROM (VALUES {rows}) v(column0, column1, column2, column3)")
    assert got == want


def test_a_contest_of_many_heats_has_few_tasks(spark):
    """Its tasks are bounded, not its heats: they took a task for each eight heats, so a large round had thousands of tasks and files."""

    def ask(room, slots, items):
        told = sorted(items, key=lambda x: x["score"])
        return json.dumps({"picks": [{"file": x["file"]} for x in told[:slots]], "rejected": [{"file": x["file"], "why": "low"} for x in told[slots:]]})

    items = spark.range(480).selectExpr("concat('r', id % 2) AS room", "concat('f', id, '.jpg') AS file", "id * 7919 % 480 AS score")
    slots = spark.createDataFrame([("r0", 2), ("r1", 2)], "room string, slots int")
    rounds = lambda: set(Path(spark.conf.get("spark.checkpoint.dir")).glob("contest-answers0-*"))
    before = rounds()
    got = contest.contest(items, slots, ["file"], ask, tasks=2)
    (first,) = rounds() - before
    assert 1 <= len(list(first.glob("*.parquet"))) <= 2 and spark.read.parquet(str(first)).count() == 40
    best = sorted((i * 7919 % 480, f"f{i}.jpg", f"r{i % 2}") for i in range(480))
    want = {(r, f, n + 1) for room in ("r0", "r1") for n, (_, f, r) in enumerate([b for b in best if b[2] == room][:2])}
    assert {(r["room"], r["file"], r["rank"]) for r in got.picks.collect()} == want
    assert got.rejected.count() == 476 and got.unmatched.count() == 0


def test_matches_by_equal_names_first(spark):
    """Small groups joined plainly come to the same; a claim that equals no name still meets the names that others equal."""
    offered = spark.createDataFrame([(g, n) for g in (1, 2) for n in ("A.jpg", "a.jpg", "holiday_01.jpg", "holiday_02.jpg", "stem.raw")] + [(None, "x.jpg")], "room int, name string")
    claims = spark.createDataFrame([(1, "a.JPG"), (1, "dir/A.jpg"), (1, "stem.png"), (1, "holiday_01.jpg"), (1, "holiday_"), (1, "holiday_02"), (2, "holiday_01.jpg"), (3, "a.jpg"), (None, "x.jpg"), (1, None), (1, "a.JPG")], "room int, claim string")
    want = [(1, None, None), (1, "a.JPG", "A.jpg"), (1, "a.JPG", "A.jpg"), (1, "dir/A.jpg", "A.jpg"), (1, "holiday_", None), (1, "holiday_01.jpg", "holiday_01.jpg"), (1, "holiday_02", "holiday_02.jpg"), (1, "stem.png", "stem.raw"), (2, "holiday_01.jpg", "holiday_01.jpg"), (3, "a.jpg", None), (None, "x.jpg", None)]
    for bounded in (False, True):
        got = gates.matched(claims, offered, "room", "claim", "name", bounded)
        assert sorted(((r["room"], r["claim"], r["match"]) for r in got.collect()), key=str) == sorted(want, key=str)
