import re

import pytest

import corpus_pipeline
from sievewright.llm import near_dedup, toxicity

DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, at = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        stage(spark, docs, DIR).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        at[name] = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert at[name] <= before and (after.columns == columns) == (i < len(corpus_pipeline.STAGES) - 1)
        if name == "toxicity":
            judged = toxicity.toxicity(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
            assert at[name] == {r["doc_id"] for r in judged.where("predicted = 0").collect()}
        elif name == "near_dedup":
            assert at[name] == {r["doc_id"] for r in near_dedup.near_duplicates(docs).where("kept").collect()}
        elif name in ("pii", "packing"):
            assert at[name] == before
        docs = after
    whole = corpus_pipeline.run(spark, DIR)
    assert {r["doc_id"] for r in whole.collect()} == at["packing"]


def test_decontamination_stage_against_all_windows(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    words = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    windows = set()
    for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    clean = {r["doc_id"] for r in docs.collect() if not any(tuple(w[i : i + n]) in windows for w in [words(r["text"])] for n in {len(x) for x in windows} for i in range(len(w) - n + 1))}
    kept = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, DIR)
    assert {r["doc_id"] for r in kept.collect()} == clean and len(clean) < docs.count()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"w{i % 997}q{i}" for i in range(60_000))
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "plain words of no account", None, None, None), (3, "plain words of no account", None, None, None), (None, "without an id", "en", "s", 13), (4, long, "en", "s", len(long)), (5, " \n\t ", "en", "s", 4)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    got = stage(spark, docs, DIR).collect()
    if name == "packing":
        assert sum(r["length"] for r in got if r["doc_id"] == 1) == 1 and {r["doc_id"] for r in got} == {r[0] for r in rows} and max(r["length"] for r in got) <= 1024
    else:
        want = sorted(map(str, map(tuple, rows if name != "near_dedup" else rows[:2] + rows[3:])))
        assert sorted(map(str, map(tuple, got))) == want
    assert stage(spark, docs.limit(0), DIR).count() == 0
