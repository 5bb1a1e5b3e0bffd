import hashlib
import random

import pytest

from nivalis.llm import suffix_dedup

SCHEMA = "doc_id long, text string, t string, runs int, k int, rest string, n_chars long"


def brute(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = [True] * 100
            seen.add(raw[i : i + 100])
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(2, 9))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base, passage = text(120), text(40)
    rows = [(i, text(30) + passage[: 90 + i] + text(30)) for i in range(30)]
    rows += [(100 + i, base[:i * 9] + "X" + base[i * 9 + 1 :]) for i in range(20)]
    rows += [(200, base), (201, base), (202, None), (203, ""), (204, "a" * 5000), (None, passage), (205, text(20) * 4), (206, "ab" * 99)]
    return rows


@pytest.mark.parametrize("every_position", [False, True])
def test_matches_brute_force(spark, every_position):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_report(df, every_position).collect()}
    assert got == brute(rows)


def test_salts_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SALT_KINDS", 2)
    ranked = suffix_dedup._common_anchors

    def all_common(keyed):
        names = keyed.mapInArrow(suffix_dedup._emit_runs, suffix_dedup.RUNS).select("name").distinct()
        return names.selectExpr("name", "cast(pmod(name, 3) + 1 as int) as salts")

    monkeypatch.setattr(suffix_dedup, "_common_anchors", all_common)
    assert ranked is not all_common
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_report(df).collect()}
    assert got == brute(rows)


def test_texts_longer_than_a_slice(spark, monkeypatch):
    rnd = random.Random(1)
    a = "".join(rnd.choice("abcdefgh") for _ in range(700_000))
    rows = [(1, a), (2, a[3:600_000] + "?" + a[600_000:])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.removal_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (700_000, 0, 0), 2: (699_998, 699_997, 2)}


def test_remove_repeats_keeps_columns_and_repeated_rows(spark):
    base = "one two three four five six " * 3 + "seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(1, base, "a", 1, 2, "z", 0), (2, "Début " + base, "b", 1, 2, "z", 0), (2, "Début " + base, "b", 1, 2, "z", 0), (2, "other", "c", 1, 2, "z", 0), (3, None, None, None, None, None, None)]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA))
    assert out.schema == spark.createDataFrame(rows, SCHEMA).schema
    got = sorted((r.doc_id, r.text, r.t or "", r.n_chars) for r in out.collect())
    assert got == [(1, base, "a", len(base)), (2, "Début ", "b", 6), (2, "Début ", "b", 6), (2, "other", "c", 5), (3, "", "", 0)]


def test_empty(spark):
    assert suffix_dedup.removal_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_runs_are_told_apart_by_their_whole_name(spark, monkeypatch):
    # two texts with one anchor, whose runs have names of equal upper halves
    anchor = "xvqefrcoscijjkgmwmiuepnqdmaqvatvpeuxppkf"
    ends = [("yvxuoynbtvyeqvjeinukxctthseeqm", "aqpgytnobjhmvzandwtqvgkvwxnzsg"), ("oqrvmbsnbmeqafhacvyzxekrrhwmki", "nqamufmjzsfqhwexnbshjtbhzixknu")]
    texts = [a + anchor + b for a, b in ends]
    runs = [suffix_dedup.anchor_runs(x.encode()) for x in texts]
    assert len({int(r[0][0]) for r in runs}) == 1 and len({int(r[1][0]) >> 32 for r in runs}) == 1
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for salts in (1, 3):
        name = df.sparkSession.createDataFrame([(int(runs[0][0].view("int64")[0]), salts)], "name long, salts int")
        monkeypatch.setattr(suffix_dedup, "_common_anchors", lambda keyed, name=name: name)
        assert [r.n_removed for r in suffix_dedup.removal_report(df).collect()] == [0, 0]


def test_a_thousand_texts_under_a_null_id(spark):
    rnd = random.Random(8)
    letters = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    texts = [(p := letters(130)) + letters(rnd.randint(20, 400)) + p + letters(i % 7) for i in range(1000)]
    rows = [(None, text) for text in texts] + [(7, text) for text in texts[:300]]
    want = sorted([brute([(1, text)])[1] for text in texts] + [(len(text), len(text), 1, hashlib.sha256(b"").hexdigest()) for text in texts[:300]])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_report(df).collect()) == want
    kept = sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in suffix_dedup.remove_repeats(df).collect())
    assert kept == sorted(x[3] for x in want)
