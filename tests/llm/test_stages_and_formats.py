"""Stages beside columns of any name, vectors of doubles, and every kind of pseudonym recomputed by hand over whole documents."""

from datetime import date, timedelta

import hashlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from sievewright.llm import hash_forest, pii, token_counts, toxicity
from sievewright.llm.tokens import library, vocabulary
from test_llm_operators import by_hand

DIR = "/root/testdata/sf0.001"
TAKEN = ["score", "predicted", "evidence", "held_out", "n_private", "toxic", "secrets", "class_id", "kept"]


@pytest.mark.parametrize("stage", [toxicity.stage, pii.stage])
@pytest.mark.parametrize("bare", [False, True])
def test_stages_keep_the_callers_columns(spark, stage, bare):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    if not bare:
        docs = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in TAKEN})
    got = stage(spark, docs, DIR)
    assert got.columns == docs.columns
    if not bare:
        rows = got.collect()
        assert rows and all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in TAKEN)
    assert stage(spark, docs.limit(0), DIR).count() == 0


def test_scores_are_those_of_the_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=16) * (1 + 1e-9 * i)).tolist()) for i in range(200)]
    got = hash_forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5, every=20).collect()
    assert len(got) == 50
    for r in got:
        assert r["score"] == pytest.approx(float(np.dot(rows[r["query_id"]][1], rows[r["vec_id"]][1])), rel=1e-14, abs=1e-15)
    for q in range(0, 200, 20):
        best = sorted((-float(np.dot(rows[q][1], v)), i) for i, v in rows if i != q)[:5]
        assert len({i for _, i in best} & {r["vec_id"] for r in got if r["query_id"] == q}) >= 3


@pytest.mark.parametrize("part_rows", [64, 8192])
def test_exact_search(spark, part_rows):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)] + [(7, rows[7][1]), (400, None), (401, [0.0] * 8), (402, [float("nan")] + [1.0] * 7)]
    got = hash_forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=12, every=20, part_rows=part_rows, exact=True).collect()
    sound = {i: np.array(v, dtype=np.float64) for i, v in rows[:341]}
    want = {}
    for q in (i for i in sound if i % 20 == 0):
        best = sorted((-float(np.einsum("j,j->", sound[q], v)), i) for i, v in sound.items() if i != q)[:12]
        want[q] = [(r, i) for r, (_, i) in enumerate(best, 1)]
    assert {q: sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q) for q in want} == want and len(got) == 12 * len(want)


def test_counts_of_recurring_stretches(spark):
    texts = ["a b  c\n\nd <|endoftext|> e", " ", "don't  stop", "x" * 5000, "word. " * 3000, "日本 語 é ñ", "tail \n", None, "", "<|endoftext|>", "a<|endoftext|>b c"] * 3
    got = token_counts.token_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"), vocabulary(), batch_bytes=700, part_chars=400).collect()
    assert [r["n_tokens"] for r in sorted(got, key=lambda r: r["i"])] == [len(library(vocabulary()).encode(t or "", add_special_tokens=False).ids) for t in texts]


# ------------------------------------------------------- pseudonyms, by hand

SECRET = pii.SECRET


def pair(kind, left, right, a, b):
    """The network over two numbers, one step on between the ways there and back."""

    def drawn(step, other):
        return int(hashlib.sha256(f"{SECRET}|{kind}|{step}|{other}".encode()).hexdigest()[:15], 16)

    for step in range(pii.ROUNDS):
        if step % 2 == 0:
            left = (left + drawn(step, right)) % a
        else:
            right = (right + drawn(step, left)) % b
    left = (left + 1) % a
    for step in reversed(range(pii.ROUNDS)):
        if step % 2 == 0:
            left = (left - drawn(step, right)) % a
        else:
            right = (right - drawn(step, left)) % b
    return left, right


def laid(old, digits):
    digits = iter(digits)
    return "".join(next(digits) if c in "0123456789" else c for c in old)


def luhn(payload):
    total = sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(payload)))
    return str(-total % 10)


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def digits_of(x):
    return regex.sub("[^0-9]", "", x)


def card(x):
    d = digits_of(x)
    if luhn(d[:-1]) != d[-1]:
        return x
    new = d[0] + by_hand(d[1:-1], SECRET, "card")
    return laid(x, new + luhn(new))


def account(x):
    flat = x.replace(" ", "")
    if mod97(flat[4:] + flat[:4]) != 1:
        return x
    rest = by_hand(flat[4:], SECRET, "account")
    whole = iter(f"{flat[:2]}{98 - mod97(rest + flat[:2] + '00'):02d}{rest}")
    return "".join(c if c == " " else next(whole) for c in x)


def number(x):
    area, group, serial = map(int, x.split("-"))
    if not (area and area != 666 and area < 900 and group and serial):
        return x
    left, right = pair("number", (area - 1 - (area > 666)) * 99 + group - 1, serial - 1, 898 * 99, 9999)
    return f"{left // 99 + 1 + (left // 99 >= 665):03d}-{left % 99 + 1:02d}-{right + 1:04d}"


def address(x):
    o = [int(p) for p in x.split(".")]
    if max(o) > 255:
        return x
    return ".".join(str(v) for part in pair("address", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536) for v in divmod(part, 256))


def phone(x):
    code = regex.match(pii.COUNTRY, x)
    code = code[0] if code else ""
    rest = x[len(code) :]
    return code + laid(rest, by_hand(digits_of(rest), SECRET, "phone")) if 8 <= len(digits_of(x)) <= 15 else x


def day(x):
    a, b, c = regex.split("[-/.]", x)
    iso, month_first = "-" in x, "/" in x and int(a) <= 12
    year, month, own = (a, b, c) if iso else (c, a, b) if month_first else (c, b, a)
    try:
        at = date(int(year), int(month), int(own))
    except ValueError:
        return x
    start = date(at.year // 100 * 100, 1, 1)
    p, q = pii.CENTURIES[at.year // 100]
    left, right = pair("date", (at - start).days // q, (at - start).days % q, p, q)
    new = start + timedelta(days=left * q + right)
    wide = lambda old, v: str(v) if len(old) == 1 else f"{v:02d}"
    if iso:
        return f"{new.year}-{wide(b, new.month)}-{wide(c, new.day)}"
    if month_first:
        return f"{wide(a, new.month)}/{wide(b, new.day)}/{new.year}"
    sign = "/" if "/" in x else "."
    return f"{wide(a, new.day)}{sign}{wide(b, new.month)}{sign}{new.year}"


def mail(x):
    own, _, domain = x.partition("@")
    return f"{by_hand(own, SECRET, 'mail')}@{domain}"


MAKERS = {"mail": mail, "account": account, "date": day, "address": address, "number": number, "card": card, "phone": phone}


def pseudonym(m):
    """Of the kinds that the whole value is, the first."""
    x = m[0]
    for kind, pattern in pii.KINDS.items():
        if regex.fullmatch(pattern.replace(r"\3", r"\1") if kind == "phone" else pattern, x):
            return kind, MAKERS[kind](x)
    raise AssertionError(x)


def test_every_kind_over_whole_documents(spark):
    old = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    odd = ["4785380592391139, 4785-3805-9239-1139; 378282246310005", "DE89 3704 0044 0532 0130 00 DE89370400440532013000 GB82WEST12345698765432", "123-45-6789 665-01-0001 667-99-9999 899-50-5000 900-11-1111", "1.2.3.4 255.255.255.255 0.0.0.0 256.1.1.1",
           "2021-02-28, 2/28/2021, 28/2/2021, 28.02.2021; 2020-2-9 1999-12-31 31.12.1999 12/31/1900 2099-12-31 2021-02-30", "+1 (663) 555-6869 (663) 555-6869 663-555-6869 +44 20 7123 4567 +420 123 456 789"]
    docs = spark.createDataFrame([*old.items(), *((-i - 1, t) for i, t in enumerate(odd))], "doc_id long, text string")
    seen = {kind: 0 for kind in pii.KINDS}

    def replaced(m):
        kind, new = pseudonym(m)
        seen[kind] += new != m[0]
        return new

    whole = dict(old) | {-i - 1: t for i, t in enumerate(odd)}
    for r in pii.pseudonymise(docs, SECRET).collect():
        before = whole[r["doc_id"]]
        want = None if before is None else regex.sub(pii.ANY, replaced, before)
        assert r["text"] == want, (before, r["text"], want)
    assert min(seen.values()) >= 3, seen
