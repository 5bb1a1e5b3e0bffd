import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nivalis.llm import cross_tokenizer as ct
from nivalis.llm.bpe import default_path
from nivalis.llm.token_fragments import Fragment, Tokens, fragment

pytest.importorskip("sentencepiece")

TEXTS = [None, "", " ", "a", "  a  b ", "don't  we'll \r\n\t12 34!!  　 z q \x1c k\r\n", "x <|endoftext|> <s> </s> <0x41> foo\n\n\n bar  \n", "a ▁ b", "▁", "émoji 😀 ​ x ﬁ ½ ñañá ñ o", "ab" * 300 + " é", "The the THE the, the. the", "\x00a \t b", "a\n b\n  c", "x" * 50 + "\ny\n" * 50]


def both():
    return ct.tokenizers(default_path(), ct.piece_path())


def streams(text):
    """Ids and ends of A and B over space + text; None without tokens."""
    whole = (" " + (text or "")).encode()
    a, b = both().encode_a([whole])[0], both().encode_b([whole])[0]
    out, joined = [], []
    for ids, of in ((a, both().a_bytes), (b, both().b_bytes)):
        parts = [of.joined(np.array([i])).tobytes() for i in ids]
        joined.append(b"".join(parts))
        out.append((ids, np.cumsum([len(x) for x in parts]).tolist()))
    return out if text and joined == [whole, whole] else None


def brute(docs):
    found = []
    for doc_id, text in docs:
        if not (s := streams(text)):
            found.append((doc_id, 0, 0, 0, "", []))
            continue
        (a, a_ends), (b, b_ends) = s
        groups, links, at = [], [], 0
        for end in sorted(set(a_ends) & set(b_ends)):
            groups.append(",".join(str(i) for i, e in zip(a, a_ends, strict=True) if at < e <= end) + "|" + ",".join(str(i) for i, e in zip(b, b_ends, strict=True) if at < e <= end))
            at = end
        for i, (x, e) in enumerate(zip(a, a_ends, strict=True)):
            for j, (y, f) in enumerate(zip(b, b_ends, strict=True)):
                if max(a_ends[i - 1] if i else 0, b_ends[j - 1] if j else 0) < min(e, f):
                    links.append((x, y))
        found.append((doc_id, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    count = Counter(x for *_, links in found for x in links)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return [(i, a, b, g, len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), sha) for i, a, b, g, sha, links in found]


def key(row):
    return tuple(map(str, row))


@pytest.mark.parametrize("long, part", [(1 << 20, 1 << 18), (40, 12), (0, 3), (200, 90)])
def test_align_equals_brute_force(spark, monkeypatch, long, part):
    monkeypatch.setattr(ct, "LONG", long)
    monkeypatch.setattr(ct, "GROUP", min(long, 1 << 19))
    monkeypatch.setattr(ct, "PART", part)
    monkeypatch.setattr(ct, "FAN", 3)
    monkeypatch.setattr(ct, "PAGE_BYTES", 100)
    docs = [*enumerate(TEXTS), (None, TEXTS[6]), (3, TEXTS[5]), (3, TEXTS[5])]
    got = ct.align(spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, part int, page string").repartition(3))
    assert got.dtypes == [(k, v.replace("long", "bigint")) for k, v in ct.RESULT.items()]
    assert sorted(map(key, map(tuple, got.collect()))) == sorted(map(key, brute(docs)))


def test_long_text_over_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(ct, "LONG", 5000)
    monkeypatch.setattr(ct, "GROUP", 3000)
    monkeypatch.setattr(ct, "PART", 700)
    monkeypatch.setattr(ct, "FAN", 2)
    rng = np.random.default_rng(5)
    words = ["alpha", "beta\n", "γάμμα", "1234", "δ\tx", "the", "  of", "x\r\n", "naïve"]
    text = " ".join(words[i] for i in rng.integers(0, len(words), 4000))
    docs = [(1, text), (2, text[:4000]), (3, "z" * 9000), (4, text + "▁")]
    assert len(list(ct._ranges(text.encode(), 700))) > 20
    got = ct.align(spark.createDataFrame(docs, "doc_id long, text string"))
    expected = {}
    for doc_id, t in docs:
        s = streams(t)
        expected[doc_id] = (len(s[0][0]), len(s[1][0]), len(set(s[0][1]) & set(s[1][1]))) if s else (0, 0, 0)
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups) for r in got.collect()} == expected
    monkeypatch.undo()
    whole = ct.align(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(key, map(tuple, whole.collect()))) == sorted(map(key, map(tuple, got.collect())))


def test_empty(spark):
    assert ct.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []


ends = st.lists(st.integers(1, 3), min_size=1, max_size=30)


def chunks(ids, stops, cuts):
    """Tokens by the range that their end falls in."""
    out, stops, ids = [], np.array(stops), np.array(ids, np.int64)
    for low, high in zip([0, *cuts], [*cuts, 10**9], strict=True):
        own = (stops > low) & (stops <= high)
        out.append(Tokens(ids[own], stops[own]))
    return out


def plain(x):
    side = lambda t: (t.ids.tolist(), t.ends.tolist())
    return side(x.prefix_a), side(x.prefix_b), x.closed, x.n_a, x.n_b, x.n_groups, x.text, x.codes.tolist(), x.times.tolist(), side(x.suffix_a), side(x.suffix_b)


@settings(max_examples=300, deadline=None)
@given(ends, ends, st.lists(st.integers(0, 60), min_size=2, max_size=5), st.lists(st.integers(0, 2), min_size=5, max_size=5), st.randoms())
def test_fragments_are_a_monoid(a, b, cuts, ahead, rnd):
    """Any way of cutting two token lists into ranges (B's ends further on than A's), and any order of putting them together, gives one fragment."""
    a_ends, b_ends = np.cumsum(a).tolist(), np.cumsum(b).tolist()
    total = max(a_ends[-1], b_ends[-1])
    for x in (a_ends, b_ends):
        if x[-1] < total:
            x.append(total)
    a_ids, b_ids = [rnd.randrange(5) for _ in a_ends], [rnd.randrange(5) for _ in b_ends]
    cuts = sorted(cuts)
    a_cuts, b_cuts = cuts, np.maximum.accumulate([c + d for c, d in zip(cuts, ahead, strict=False)]).tolist()
    parts = [fragment(x, y) for x, y in zip(chunks(a_ids, a_ends, a_cuts), chunks(b_ids, b_ends, b_cuts), strict=True)]
    whole = fragment(Tokens(np.array(a_ids, np.int64), np.array(a_ends)), Tokens(np.array(b_ids, np.int64), np.array(b_ends)))
    while len(parts) > 1:
        i = rnd.randrange(len(parts) - 1)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    assert plain(parts[0]) == plain(whole)
    assert plain(Fragment() + whole) == plain(whole) == plain(whole + Fragment())
    done = whole.whole()
    assert (done.n_a, done.n_b, done.n_groups) == (len(a_ids), len(b_ids), len(set(a_ends) & set(b_ends)))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\té1!日"), min_size=1, max_size=60), st.integers(1, 9))
def test_parts_put_together_are_the_whole(text, size):
    """The ranges of a text, each made a fragment by itself, add up to the fragment of its tokens."""
    known = ct.Words(both())
    raw = text.encode()
    parts = [ct.part_fragment(known, r["text"], r["at"], r["b_begin"], r["a_end"]) for r in ct._ranges(raw, size)]
    total = Fragment()
    for x in parts:
        total = total + x
    (a, a_ends), (b, b_ends) = streams(text)
    whole = fragment(Tokens(np.array(a), np.array(a_ends)), Tokens(np.array(b), np.array(b_ends)))
    assert plain(total) == plain(whole)
    assert plain(total.whole()) == plain(whole.whole())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\t\r\x0b\x0c\x85\xa0　'sé1!<|>\x1c日"), min_size=1, max_size=30))
def test_words_are_tokenized_as_the_whole(text):
    words = [b" " + w for w in ct.split(text.encode())]
    whole = b" " + text.encode()
    assert b"".join(words) == whole
    assert [i for x in both().encode_a(words) for i in x] == both().encode_a([whole])[0]
    assert [i for x in both().encode_b(words) for i in x] == both().encode_b([whole])[0]


def test_the_query_equals_a_walk_over_both_token_lists(spark):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.001"
    found = {}
    for row in pq.read_table(f"{sf}/documents.parquet").to_pylist():
        s = streams(row["text"])
        if not s:
            found[row["doc_id"]] = (0, 0, "", [])
            continue
        (a, a_ends), (b, b_ends) = s
        i = j = 0
        links, texts, open_a, open_b = [], [], [], []
        while i < len(a):
            links.append((a[i], b[j]))
            end_a, end_b = a_ends[i], b_ends[j]
            if end_a <= end_b:
                open_a.append(str(a[i]))
                i += 1
            if end_b <= end_a:
                open_b.append(str(b[j]))
                j += 1
            if end_a == end_b:
                texts.append(",".join(open_a) + "|" + ",".join(open_b))
                open_a, open_b = [], []
        found[row["doc_id"]] = (len(a), len(b), ";".join(texts), links)
    count = Counter(x for *_, links in found.values() for x in links)
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    want = {
        i: (a, b, text.count(";") + 1 if text else 0, len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if text else "")
        for i, (a, b, text, links) in found.items()
    }
    assert {r.doc_id: tuple(r)[1:] for r in ct.op13_token_alignment(spark, sf).collect()} == want


def test_pages_go_one_by_one_through_the_shared_folder(spark, monkeypatch):
    """Writers and readers hold whole row groups, and writers the values of their statistics: with several pages in each a task's memory grew with its input."""
    import pyarrow.parquet as pq

    written = []
    keep = ct.materialise
    monkeypatch.setattr(ct, "materialise", lambda df, **how: written.append(keep(df, **how)) or written[-1])
    monkeypatch.setattr(ct, "PAGE_BYTES", 100)
    monkeypatch.setattr(ct, "GROUP", 200)
    # the last one goes in parts
    texts = ["a page of its own " * 10] * 8 + ["long " * (ct.LONG // 4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert sorted(r.doc_id for r in ct.align(docs).collect()) == list(range(9))
    assert len(written) == 2
    for table in written:
        parts = [pq.ParquetFile(path.removeprefix("file://")).metadata for path in table.inputFiles()]
        groups = [part.row_group(i) for part in parts for i in range(part.num_row_groups)]
        assert len(groups) == table.count() and all(g.num_rows == 1 for g in groups)
        assert all(g.column(i).statistics is None for g in groups for i in range(g.num_columns))
    assert written[0].where("part is null").count() >= 8
