import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
import zstandard

from nivalis.llm import common, language_id, quality_classifier, quality_rules
from nivalis.llm.common import documents, labels

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = [(1, None), (2, ""), (3, " \n\t\n"), (4, "# a|b <x> 100% é é"), (5, "same line\nsame line\n\nsame line \nother"), (6, "a b c d e f g h " * 5), (7, "é " * 19), (8, "x" * 50_000), (None, "w " * 30), (1, "again")]
SCHEMA = "doc_id long, text string, quality int, kept string, score int"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 8)}
    counts = [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)]
    return counts, len(words) < 20 or 100 * len(repeated) > 30 * len(words)


def test_statistics_match_brute_force():
    rnd = random.Random(2)
    texts = [t for _, t in EDGES] + [" ".join(rnd.choice(["a", "b|", "é\n", "c\n\n", "$", " "]) for _ in range(rnd.randint(0, 120))) for _ in range(200)]
    for text in texts:
        counts, _ = quality_rules.statistics((text or "").encode())
        assert (counts, quality_rules.base_failed(counts)) == brute(text)


def test_rules_on_edges(spark):
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in EDGES], SCHEMA)
    got = quality_rules.judge(df, None).collect()
    assert len(got) == len(EDGES)
    assert sorted(str((r.doc_id, list(r[1:6]), r.base_failed)) for r in got) == sorted(str((i, *brute(t))) for i, t in EDGES)
    assert all(r.kept == (not r.base_failed) for r in got)
    assert quality_rules.keep_good(df, None).schema == df.schema
    empty = df.where("false")
    assert quality_rules.judge(empty, None).collect() == []
    assert quality_rules.fit_on_labels(empty, spark.createDataFrame([], "doc_id long, quality int")) is None


def test_rules_keep_good_and_reject_bad(spark):
    docs = documents(spark, SF)
    forest = quality_rules.fit_on_labels(docs, labels(spark, SF))
    marks = {r.doc_id: r.quality for r in labels(spark, SF).collect()}
    rows = [r for r in quality_rules.judge(docs, forest).collect() if r.doc_id in marks]
    good = [r.kept for r in rows if marks[r.doc_id] == 1 and not r.base_failed]
    bad = [r.kept for r in rows if marks[r.doc_id] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.25


def test_classifier_held_out(spark):
    docs = documents(spark, SF)
    marks = {r.doc_id: r.quality for r in labels(spark, SF).collect()}
    rows = quality_classifier.op5_quality_classifier(spark, SF).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, marks[r.doc_id]) for r in rows if r.held_out and r.doc_id in marks]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.85


def test_classifier_edges(spark):
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in EDGES], SCHEMA)
    flat = quality_classifier.fit_on_labels(df, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int"))
    rows = quality_classifier.score(df, flat, quality_classifier.F.lit(False)).collect()
    assert len(rows) == len(EDGES) and all(r.score == 0.5 for r in rows)
    marks = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (8, 0)], "doc_id long, quality int")
    rows = quality_classifier.score(df, quality_classifier.fit_on_labels(df, marks), quality_classifier.F.lit(True)).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)


def test_language_held_out(spark):
    rows = language_id.op7_language_id(spark, SF).collect()
    langs = {r.doc_id: (r.lang, r.text) for r in documents(spark, SF).select("doc_id", "lang", "text").collect()}
    held = [r.lang_pred == langs[r.doc_id][0] for r in rows if r.held_out and langs[r.doc_id][0] and r.lang_pred != "und"]
    assert np.mean(held) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.05


def test_language_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !? 34", "en"), (4, "é", None), (None, "the cat and the dog", "en"), (5, "der hund und die katze", "de"), (5, "der hund und die katze", "de"), (6, "x " * 700_000, "en")]
    df = spark.createDataFrame([(*r, "s", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    none = language_id.predict(df, None, language_id.F.lit(False)).collect()
    assert {r.lang_pred for r in none} == {"und"} and all(r.rejected for r in none)
    model = language_id.fit_on(df, language_id.F.lit(True))
    got = language_id.predict(df, model, language_id.F.lit(True)).collect()
    assert sorted(str((r.doc_id, r.lang_pred == "und")) for r in got) == sorted(str((i, t is None or not any(c.isalpha() for c in t))) for i, t, _ in rows)
    assert language_id.fit_on(df.where("false"), language_id.F.lit(True)) is None


def test_forest_finds_what_lies_outside():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 0.05, (800, 3)), rng.normal(1, 0.05, (40, 3))
    forest = quality_rules.fit(np.concatenate([good, bad]), np.arange(840) < 800)
    assert (forest.scores(bad) > forest.limit).mean() > 0.95
    assert (forest.scores(rng.normal(0, 0.05, (800, 3))) > forest.limit).mean() < 0.03



# ---- the models, computed step by step


def test_forest_scores_match_a_walk_of_each_tree():
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, quality_rules.FEATURES))
    forest = quality_rules.fit(x, np.arange(300) < 260)

    def depth(tree, row, node=0):
        feature = forest.feature[tree][node]
        if feature < 0:
            return forest.depth[tree][node]
        return depth(tree, row, forest.left[tree][node] + (row[feature] >= forest.value[tree][node]))

    usual = 2 * (np.log(forest.rows - 1) + np.euler_gamma) - 2 * (forest.rows - 1) / forest.rows
    want = [2 ** (-np.mean([depth(t, row) for t in range(len(forest.feature))]) / usual) for row in x[:40]]
    assert np.allclose(forest.scores(x[:40]), want)


def test_verdicts_match_the_forest_row_by_row(spark):
    docs = documents(spark, SF)
    forest = quality_rules.fit_on_labels(docs, labels(spark, SF))
    text = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    for r in quality_rules.judge(docs, forest).collect()[:200]:
        counts, features = quality_rules.statistics(text[r.doc_id])
        score = forest.scores(np.array([features]))[0]
        assert r.score == pytest.approx(score) and r.kept == (not quality_rules.base_failed(counts) and score <= forest.limit)
    kept = quality_rules.keep_good(docs, forest)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in quality_rules.judge(docs, forest).where("kept").collect())


def test_classifier_scores_match_two_compressions(spark):
    docs = documents(spark, SF)
    model = quality_classifier.fit_on_labels(docs, labels(spark, SF))
    packers = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False) for d in (model.good, model.bad)]
    for r in documents(spark, SF).select("text").limit(60).collect():
        text = (r.text or "").encode()
        good, bad = (len(p.compress(text)) for p in packers)
        z = model.weights[0] + model.weights[1] * 10 * (bad - good) / max(len(text), 1) + model.weights[2] * (bad - good) / max(len(text), 1) * math.log1p(len(text))
        assert model.scores([text])[0] == pytest.approx(1 / (1 + math.exp(-z)) if text else model.empty)


def test_classifier_learns_no_label_that_is_not_there(spark):
    docs = spark.createDataFrame([(i, "" if i % 4 == 0 else f"good fine words {i}" if i % 2 else f"### !!! {i}") for i in range(40)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1 if i % 2 or i % 8 == 0 else 0) for i in range(40)] + [(1, 1), (1, 1)], "doc_id long, quality int")
    model = quality_classifier.fit_on_labels(docs, marks)
    share = 25 / 40
    assert model.empty == pytest.approx((5 + share) / 11)  # 10 empty texts, 5 of label 1
    empty = quality_classifier.fit_on_labels(docs.where("false"), marks)
    assert empty.scores([b"", b"x"]).tolist() == [0.5, 0.5]


def test_language_logits_match_a_sum_over_subwords(spark):
    docs = documents(spark, SF)
    model = language_id.fit_on(docs, language_id.F.lit(True))

    def logits(text):
        out = bytearray()
        for byte in text:
            byte = byte + 32 if 65 <= byte <= 90 else byte if byte > 127 or 97 <= byte <= 122 else 32
            if byte != 32 or not out or out[-1] != 32:
                out.append(byte)
        total, n = np.zeros(len(model.languages)), 0
        for size in range(1, language_id.LONGEST + 1):
            for i in range(len(out) - size + 1):
                h = 0
                for byte in out[i : i + size]:
                    h = (h + byte + 1) * 0x9E3779B1 % 2**32
                    h ^= h >> 15
                total += model.table[((h + (size - 1) * 0x5EBCA6B) % 2**32 >> 7) % language_id.BUCKETS]
                n += 1
        return total / n + model.bias

    for r in docs.where("text is not null and length(text) between 1 and 600").limit(20).collect():
        assert np.allclose(model.logits(r.text.encode()), logits(r.text.encode()))


def test_slices_lose_no_subword(monkeypatch):
    text = ("Ünder the  12 old  tree " * 40).encode()
    whole = np.concatenate(list(language_id.slices(text)))
    monkeypatch.setattr(language_id, "SLICE", 37)
    assert sorted(np.concatenate(list(language_id.slices(text))).tolist()) == sorted(whole.tolist())


def test_models_on_empty_tables_and_repeated_labels(spark):
    docs, marks = documents(spark, SF), labels(spark, SF)
    none = docs.where("false")
    model = quality_classifier.fit_on_labels(none, marks.where("false"))
    assert quality_classifier.score(none, model, quality_classifier.F.lit(True)).collect() == []
    assert language_id.predict(none, None, language_id.F.lit(True)).collect() == []
    once, twice = (quality_classifier.fit_on_labels(docs, x) for x in (marks, marks.unionByName(marks)))
    assert once == twice


def test_texts_that_do_not_fit_are_passed_over():
    assert common.fitting([5, 20, 3, 2, 1], 10) == [0, 2, 3]
    assert common.fitting([20, 30, 15], 10) == [2]
    assert common.fitting([], 10) == []


def in_turn(spark, n):
    """Ids in the order in which labelled texts are taken."""
    from pyspark.sql import functions as F

    return [r.id for r in spark.range(n).orderBy(F.xxhash64("id"), "id").collect()]


@pytest.mark.parametrize("place", [0, 30, 59])
def test_one_long_labelled_text_does_not_erase_its_class(spark, monkeypatch, place):
    monkeypatch.setattr(quality_classifier, "SAMPLE_BYTES", 200_000)
    ids = in_turn(spark, 120)
    good, bad = ids[:60], ids[60:]
    text = lambda i: (("the river runs down to the sea and the hills " if i in set(good) else "buy $$ click ### win ||| now ") + f"{i} ") * 30
    docs = [(i, text(i)) for i in ids]
    marks = spark.createDataFrame([(i, int(i in set(good)), 0) for i in ids], "doc_id long, quality int, toxic int")
    long_one = good[place]
    with_long = [(i, t if i != long_one else t * 400) for i, t in docs]
    model = quality_classifier.fit_on_labels(spark.createDataFrame(with_long, "doc_id long, text string"), marks)
    scores = model.scores([text(good[5]).encode(), text(bad[5]).encode()])
    assert scores[0] > 0.8 > 0.2 > scores[1]


@pytest.mark.parametrize("place", [0, 20, 39])
def test_one_long_text_does_not_erase_its_language(spark, monkeypatch, place):
    monkeypatch.setattr(language_id, "SAMPLE_BYTES", 200_000)
    from pyspark.sql import functions as F

    ids = in_turn(spark, 80)
    english, german = set(ids[:40]), set(ids[40:])
    text = lambda i: ("the house and the river of this land " if i in english else "das haus und der fluss dieses landes ") * 20 + str(i)
    docs = [(i, text(i) * (500 if i == ids[place] else 1), "en" if i in english else "de") for i in ids]
    model = language_id.fit_on(spark.createDataFrame(docs, "doc_id long, text string, lang string"), F.lit(True))
    found = language_id.predict(spark.createDataFrame([(1, "the house and the river"), (2, "das haus und der fluss")], "doc_id long, text string"), model, F.lit(False)).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "en", 2: "de"}


def test_a_class_with_long_texts_only_has_the_smallest(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a" * 500), (2, "b" * 300), (3, "c" * 10), (3, "d")], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "id long, label int")
    found = common.sample_texts(docs, chosen, 100)
    assert [(r.id, r.label, len(r.text), r.text[0]) for r in found.itertuples()] == [(2, 1, 300, "b"), (3, 0, 10, "c")]


def test_rules_count_a_labelled_id_once(spark, monkeypatch):
    """One id that comes many times, is labelled many times, or both ways, brings one row to the driver, or none."""
    seen = {}
    monkeypatch.setattr(quality_rules, "fit", lambda x, good: seen.update(n=len(x), good=int(good.sum())))
    words = " ".join(f"word{i} thing{i}" for i in range(30))
    docs = spark.range(5000).selectExpr("7L as doc_id", f"'{words}' as text").unionByName(spark.createDataFrame([(8, words), (9, words), (10, words)], "doc_id long, text string"))
    marks = spark.createDataFrame([(7, 1)] * 50 + [(8, 0), (9, 1), (9, 0), (10, 1)], "doc_id long, quality int")
    quality_rules.fit_on_labels(docs, marks)
    assert seen == {"n": 3, "good": 2}
