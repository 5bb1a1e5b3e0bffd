import hashlib
import os

import corpus_pipeline
from nivalis.llm.common import documents, materialise

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark):
    docs = documents(spark, SF)
    columns, counts = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = materialise(stage(spark, before, SF))
        counts.append(docs.count())
        if i < 4:
            assert docs.columns == columns
        if i == 4:
            texts = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in before.collect())
            assert sorted(r.decoded_sha256 for r in docs.collect()) == texts
    rejected, near, cut, mixed, encoded = counts[1:]
    assert counts[0] > rejected > near == cut < mixed == encoded


def test_empty_documents(spark):
    docs = documents(spark, SF).where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF))
    assert docs.count() == 0


def test_nulls_in_every_column(spark):
    docs = documents(spark, SF)
    nulls = spark.createDataFrame([(None,) * len(docs.columns)] * 2, docs.schema)
    docs = docs.unionByName(nulls)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF))
    assert docs.count() > 0


def test_run_equals_brute_force(spark):
    """All stages in plain Python and SQL, one document at a time, over the whole smallest table."""
    import struct

    import duckdb
    import pandas as pd

    from nivalis.llm import bpe, mixing, quality_rules
    from nivalis.llm.common import labels
    from tests.llm.test_joins_and_models import grams

    docs = [(r.doc_id, r.text or "", r.source) for r in documents(spark, SF).collect()]
    # rules: one document at a time
    forest = quality_rules.fit_on_labels(documents(spark, SF), labels(spark, SF))
    kept = []
    for doc in docs:
        counts, features = quality_rules.statistics(doc[1].encode())
        if not quality_rules.base_failed(counts) and forest.scores(pd.DataFrame([features]).to_numpy())[0] <= forest.limit:
            kept.append(doc)
    assert 0 < len(kept) < len(docs)
    # near copies: the smallest id of each connected group
    sets, group = [grams(t) for _, t, _ in kept], list(range(len(kept)))
    links = [(i, j) for i in range(len(kept)) for j in range(i) if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for _ in kept:
        before = list(group)
        for i, j in links:
            group[i] = group[j] = min(group[i], group[j])
        if group == before:
            break
    smallest = {}
    for (doc_id, *_), g in zip(kept, group, strict=True):
        smallest[g] = min(smallest.get(g, doc_id), doc_id)
    kept = sorted(d for d, g in zip(kept, group, strict=True) if d[0] == smallest[g])
    # strings of 100 bytes that start earlier
    seen, cut = set(), []
    for doc_id, text, source in kept:
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            part = raw[i : i + 100]
            if part in seen:
                gone[i : i + 100] = b"\x01" * 100
            seen.add(part)
        cut.append((doc_id, bytes(c for c, g in zip(raw, gone, strict=True) if not g).decode("utf-8", "ignore"), source))
    assert sum(len(t) for _, t, _ in cut) < sum(len(t) for _, t, _ in kept)
    # the mix, by SQL, and the ids of each copy
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(cut, columns=["doc_id", "text", "source"]))
    copies = dict(con.sql(f"select doc_id, copies from ({mixing.OP8_SQL})").fetchall())
    known, want = bpe.tokenizer(bpe.default_path()), []
    for doc_id, text, _ in cut:
        ids = known.encode(text, add_special_tokens=False).ids
        back = known.decode(ids, skip_special_tokens=False)
        row = (doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        want += [row] * copies[doc_id]
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)
