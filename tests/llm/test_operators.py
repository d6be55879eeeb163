"""Corpus operators against brute force, on small tables with nulls, ties, repeats and odd names."""

import hashlib
import os
import re
import sys
import zlib

import numpy as np
import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, os.path.dirname(os.path.dirname(HERE)))

import oracle_compare  # noqa: E402
from qualia.llm import (annsearch, decontam, htmlcut, lengths, mixing, neardup, ordinal, queries, rangecoder, tokenbin,  # noqa: E402
                        tokens, toxicity, warc)

SF = "/root/testdata/sf0.001"
ODD = "leak_n_words string, doc_id long, text string, source string, _kept int, expected_grade int, n_tokens int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, an empty text, repeats, and columns named like those that operators add."""
    w = " ".join(f"w{i}" for i in range(40))
    rows = [("a", 1, w, "s", 1, 1, 1), ("a", 1, w, "s", 1, 1, 1), ("b", 2, None, None, 2, 2, 2), (None, None, w + " tail", "t", None, None, None), ("d", 4, "", "s", 4, 4, 4),
            ("e", 5, "one two", "t", 5, 5, 5), ("f", 6, "x" * 200_000 + " y", "u", 6, 6, 6)]
    return spark.createDataFrame(rows, ODD)


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_sql(spark, key):
    assert oracle_compare.run(spark, SF, [key])[key] is None


def test_suffix_search_matches_brute_force():
    rng = np.random.default_rng(1)
    texts = [rng.integers(1, 4, n).astype(np.uint64) << np.uint64(60) for n in (50, 0, 7, 300)]
    items = [rng.integers(1, 4, n).astype(np.uint64) << np.uint64(60) for n in (12, 3, 30)] + [texts[3][5:40]]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    item_first = np.concatenate([[0], np.cumsum([len(t) for t in items])])
    spans, found, _ = decontam.judge(np.concatenate(texts), first, (np.concatenate(items), item_first, list("abcd")), 5)
    for t, text in enumerate(texts):
        hit, ids = set(), set()
        for name, item in zip("abcd", items):
            n = min(len(item), 5)
            for k in range(len(item) - n + 1):
                for p in range(len(text) - n + 1):
                    if (text[p:p + n] == item[k:k + n]).all():
                        hit.update(range(p, p + n))
                        ids.add(name)
        assert {p for s in spans[t] for p in range(s["start"], s["end"])} == hit
        assert found[t] == sorted(ids)


def test_windows_shared_by_many_items_and_texts():
    import tracemalloc

    rng = np.random.default_rng(0)
    n = 1500
    shared = rng.integers(1, 2**62, 10).astype(np.uint64)
    own = lambda: rng.integers(1, 2**62, 5).astype(np.uint64)
    texts, items = ([np.concatenate([own(), shared, own()]) for _ in range(n)] for _ in range(2))
    first = np.arange(n + 1) * 20
    tracemalloc.start()
    spans, found, longest = decontam.judge(np.concatenate(texts), first, (np.concatenate(items), first, [str(k) for k in range(n)]), 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(s == [{"start": 5, "end": 15}] for s in spans) and (longest == 10).all()
    assert all(len(f) == n for f in found) and peak < 25 * n * n  # the lists found take eight bytes for each


def test_benchmark_in_blocks_gives_the_same(spark, odd):
    bench = spark.createDataFrame([(1, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (2, "one two"), (None, "w20 w21 w22 w23 w24 w25 w26 w27 w28 w29"), (3, None)], "item_id long, text string")
    rows = []
    for size in (1 << 20, 40):
        got = decontam.with_hits(decontam.find_leaks(odd.select("doc_id", "text"), bench, block_bytes=size))
        rows.append(sorted(map(str, got.select("doc_id", "leak_n_hit", "leak_items").collect())))
    assert rows[0] == rows[1]
    kept = decontam.remove_leaks(odd, bench)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 6]


def test_filters_and_mix_keep_columns_and_take_empty_tables(spark, odd):
    none = odd.limit(0)
    assert neardup.drop_near_duplicates(odd).columns == odd.columns
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == odd.count() and {r.component for r in got if r.id in (1, None)} == {1}
    assert {r.id: r.component for r in got if r.id in (2, 4)} == {2: 2, 4: 4}
    assert neardup.near_duplicates(none).count() == 0
    taken = mixing.taken(odd, key=["doc_id"]).collect()
    assert len(taken) == odd.count() and all(r.taken <= 2 * r.size for r in taken)
    assert mixing.mixed(odd, key=["doc_id"]).columns == odd.columns
    assert mixing.taken(none, key=["doc_id"]).count() == 0
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (None, 1, 1)], "doc_id long, rating int, toxic int")
    model = ordinal.train(odd, labels, ordinal.label_grade(), 3)
    assert ordinal.select(odd, model).columns == odd.columns
    assert ordinal.score(none, model).count() == 0
    assert toxicity.score(odd, toxicity.train(odd, labels, labels.toxic)).count() == odd.count()


def test_rows_kept_of_null_and_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(None, a, 0), (None, b, 1), (None, None, 2), (None, " \n", 3), (7, c, 4), (7, d, 5), (7, c + " tail", 6), (3, c + " end", 7), (7, c, 8), (7, "", 9), (7, "", 10), (8, b, 11)]
    kept = {r.k for r in neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, k int")).collect()}
    assert kept == {0, 11, 2, 3, 7, 5, 9, 10}
    # the smallest id stands twice, with linked texts and with one that is linked with nothing; equal rows count once
    rows = [(1, a, 0), (1, a + " x", 1), (1, b, 2), (2, a, 3), (None, d, 4), (None, d, 4), (None, d + " y", 5)]
    kept = [r.k for r in neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, k int")).collect()]
    assert len(kept) == 3 and len({0, 1} & set(kept)) == 1 and 2 in kept and len({4, 5} & set(kept)) == 1


def test_rows_joined_grow_with_null_ids_not_with_their_square(spark):
    base = " ".join(f"w{i}" for i in range(60))
    for n in (200, 400):
        df = spark.createDataFrame([(None, f"{base} x{i}") for i in range(n)], "doc_id long, text string")
        m = neardup.Matcher(df, "doc_id", "text", 5, 75, 100)
        sets = m.sets(m.nodes.select("node"))
        assert sets.count() == n
        need = m.nodes.selectExpr("row.id id", "row.mark need")
        assert m.docs.withColumnRenamed("id", "doc").join(need, m.docs.mark == need.need).count() == n
        assert {r.component for r in neardup.near_duplicates(df).collect()} == {None}


def test_family_of_one_large_component_and_some_others(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(5)
    core = [f"c{i}" for i in range(60)]
    rows = []
    for k in range(40):  # drifting copies: neighbours are linked, distant ones are not
        w = list(core)
        for j in range(k // 4):
            w[j * 5 % 60] = f"d{j}"
        rows.append((k, " ".join(w + [f"t{k % 3}"])))
    for k in range(40, 60):
        w = list(core)
        for j in rng.integers(0, 60, 4):
            w[j] = f"e{k}{j}"
        rows.append((k, " ".join(w)))
    got = {r.id: r.component for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {k: {tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for k, t in rows}
    group = {k: k for k in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    assert got == group


def test_encoder_equals_the_library():
    import pyarrow as pa

    e = tokens.Encoder(queries.tokenizer_path())
    texts = ["", " a  b", "a \n b\n\nc\td", "it's we'll", "<|endoftext|> x", "é  ñ　z", "x" * 5000, "日本 語\n漢字"] * 2
    rng = np.random.default_rng(8)
    texts += ["".join(rng.choice(list(" a'bs5.—(éʼʰ\n-漢_ªß"), 300)) for _ in range(60)] + ["it's!'s 5's 'll'ld x'(s a.b,c1d2 (e) İıſ", "a\u0300b ªº µ ǅ ɏ ɐ"]
    got = [ids[a:b].tolist() for _, _, ids, first in e.encode(pa.array(texts)) for a, b in zip(first[:-1], first[1:])]
    assert got == [x.ids for x in e.lib.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("most", [1, 2, 16, 50])
def test_encoder_of_more_pieces_than_it_remembers(monkeypatch, most):
    import pyarrow as pa

    monkeypatch.setattr(tokens.Encoder, "remembered", most)
    e = tokens.Encoder(queries.tokenizer_path())
    texts = ["a few words", " ".join(str(i * 7919) for i in range(300)) + "\nwords", "", "few " * 60 + "x\ty  z"]
    for _ in range(2):  # the second time with a full memory
        got = [ids[a:b].tolist() for _, _, ids, first in e.encode(pa.array(texts)) for a, b in zip(first[:-1], first[1:])]
        assert got == [x.ids for x in e.lib.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("n", [0, 1, 2, 33, 2047, 2049, 9000, 257 * 2048, 3000 * 2048 + 5])
def test_range_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), rng.zipf(1.3, n) % 50257, np.zeros(n, np.int64))[:1 if n > 10**6 else 3]:
        assert (rangecoder.decode(rangecoder.encode(ids, 50257), n, 50257) == ids).all()


@pytest.mark.parametrize("vocab", [1, 2, 3, 255, 300, 1 << 16])
def test_range_coder_of_other_vocabularies(vocab):
    ids = np.append(np.random.default_rng(vocab).integers(0, vocab, 5000), [vocab - 1, 0, vocab - 1])
    assert (rangecoder.decode(rangecoder.encode(ids, vocab), len(ids), vocab) == ids).all()
    with pytest.raises(ValueError):
        rangecoder.encode(ids, (1 << 16) + 1)


def test_blocks_are_coded_alike_whatever_is_beside_them():
    ids = np.random.default_rng(1).zipf(1.3, 40 * 2048 + 700) % 50257
    together = rangecoder.encode(ids, 50257)
    assert together == [c for k in range(41) for c in rangecoder.encode(ids[k * 2048:(k + 1) * 2048], 50257)]
    assert (rangecoder.decode(together[7:], len(ids) - 7 * 2048, 50257) == ids[7 * 2048:]).all()
    assert (rangecoder.decode(together[:9], 9 * 2048, 50257) == ids[:9 * 2048]).all()


def test_range_coder_learns():
    ids = np.random.default_rng(0).zipf(1.2, 200_000) % 3000
    assert sum(map(len, rangecoder.encode(ids, 50257))) < 1.5 * len(ids)
    again = np.tile(ids[:100], 2000)
    assert sum(map(len, rangecoder.encode(again, 50257))) < 0.5 * len(again)


def test_models_take_in_only_what_is_coded_after(monkeypatch):
    counted, count = [], rangecoder._Model.count
    monkeypatch.setattr(rangecoder._Model, "count", lambda m, ids, right: counted.append(ids.shape[1]) or count(m, ids, right))
    ids = np.random.default_rng(2).zipf(1.3, 3 * 2048) % 50257
    assert (rangecoder.decode(rangecoder.encode(ids, 50257), len(ids), 50257) == ids).all()
    assert counted == 2 * rangecoder.STRETCHES[:-1]  # nothing follows the last stretch


def test_carries_go_through_full_words():
    words = np.array([5, 2**32 - 1, 2**32 - 1, 7, 8, 9], np.uint32)
    rangecoder._carry(words, np.array([2, 4]))
    assert words.tolist() == [6, 0, 0, 7, 9, 9]


def test_new_words_are_learned_in_rows():
    import pyarrow as pa

    e = tokens.Encoder(queries.tokenizer_path())
    odd = "".join(map(chr, range(0xA0, 0x260)))
    words = [w + c + w[::-1] for w in ("nu", "\u0163e", "") for c in odd] + [f"{a}{b}x" for a in odd[32:] for b in "ab\u00e9"]
    texts = [" " + " ".join(words), " a", "", "  ", "\u00d7 \u00f7 \u024f \u0250 \u00e9"]
    calls = []

    class Counted:
        def encode_batch_fast(self, rows, **options):
            calls.append(len(rows))
            return tokens_of(rows, **options)

    tokens_of, e.plain = e.plain.encode_batch_fast, Counted()
    got = [ids[a:b].tolist() for _, _, ids, first in e.encode(pa.array(texts)) for a, b in zip(first[:-1], first[1:])]
    assert got == [x.ids for x in e.lib.encode_batch(texts, add_special_tokens=False)]
    assert max(calls) < len(words) / 16


def test_token_file_of_several_groups(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(rangecoder, "LANES", 3)
    texts = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["a b c " * 9000, None, "d " * 40_000])], ["id", "text"])
    frames = [f.as_py() for b in tokenbin._writer(queries.tokenizer_path(), 0)(iter([texts])) for f in b.column(0)]
    content = memoryview(b"".join(f + b"\n" for f in frames))
    want = [i for t in texts.column(1) for i in (*tokens.encoder(queries.tokenizer_path()).lib.encode(t.as_py() or "", add_special_tokens=False).ids, 0)]
    parts = list(tokenbin.file_ids(content, 50257))
    assert len(parts) > 3 and np.concatenate(parts).tolist() == want


def test_damaged_token_file_is_found():
    frame = next(tokenbin._blocks(np.arange(100, dtype=np.int32), 50257))
    assert list(tokenbin.file_ids(memoryview(frame + b"\n"), 50257))[0].tolist() == list(range(100))
    with pytest.raises(ValueError):
        list(tokenbin.file_ids(memoryview(frame[:-1] + bytes([frame[-1] ^ 1]) + b"\n"), 50257))


def test_token_files_and_counts(spark, odd):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(queries.tokenizer_path())
    got = sorted(tokenbin.encode_and_read_back(odd, queries.tokenizer_path()).collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = {r.doc_id: lib.encode(r.text or "", add_special_tokens=False).ids + [0] for r in odd.collect()}
    for r in got:
        assert (r.n_tokens, r.ids_crc32) == (len(ids[r.id]), zlib.crc32(np.array(ids[r.id], "<u4").tobytes()))
    assert [r.id for r in got] == sorted(ids, key=lambda x: (x is not None, x))[:1] + [1, 1, 2, 4, 5, 6]
    hist = lengths.histogram(lengths.token_counts(odd, queries.tokenizer_path()))
    size = np.array([len(ids[r.doc_id]) - 1 for r in odd.collect()])
    for r in lengths.at_every_limit(hist).collect():
        assert r.tokens_kept == np.minimum(size, r.context_limit).sum() and r.tokens_cut == np.maximum(size - r.context_limit, 0).sum()
    q = {r.share: r.length for r in lengths.quantiles(hist, [0.5, 1.0]).collect()}
    assert q == {0.5: int(np.sort(size)[3]), 1.0: int(size.max())}


def test_warc_segments(spark):
    rows = [(1, "u", "a" * 50000), (2, "u", "a" * 50000), (3, None, None), (4, "http://x y", "é\r\n\r\n<p>"), (5, "u", "WARC/1.1\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.write_and_read_back(pages, segment_bytes=1000, chunk_bytes=300).collect()}
    assert (got[1].record_type, got[1].refers_to, got[1].payload_bytes) == ("revisit", 2, 50000)
    for k, _, h in rows[1:]:
        assert bytes(got[k].payload) == (h or "").encode() and got[k].record_type == "response"
    assert warc.write_and_read_back(pages.limit(0)).count() == 0


def test_main_text():
    page = """<body><header><h1>Site</h1></header><div class="cookie-consent"><p>We use cookies. They are good, all of them.</p></div><article><h1>Head</h1>
    <p>First &amp; long paragraph<br>of text.</p><p>Short<div class="ad">Buy this thing now.</div><form><p>Mail us here.</p></form>
    <section id="comments"><article><p>I like it a lot. Thanks.</p></article></section><script>"<p>no</p>"</script></article><footer>(c)</footer>"""
    assert htmlcut.main_text(page)[0] == "Head\n\nFirst & long paragraph of text.\n\nShort"
    assert htmlcut.main_text(None) == ("", 0, 0) and htmlcut.main_text("<p") == ("", 0, 0)


@pytest.mark.parametrize("page, kept", [
    ("<body class='single no-sidebar'><div id='content'>{}</div>", True),
    ("<html class='cookie-consent'><body class='sidebar comments social'><p>{}</p>", True),
    ("<article class='post comments-open related'>{}</article>", True),
    ("<main class='social notice discussion'>{}</main>", True),
    ("<div class='has-sidebar'><div class='entry-content'>{}</div></div>", True),
    ("<div class='side'><div><article>{}</article></div></div>", True),
    ("<div class='share tags'><div id='content'>{}</div></div>", True),
    ("<div class='comments-open post'><div class='entry'>{}</div></div>", True),
    ("<div class='discussion'><article>{}</article></div>", True),
    ("<div class='comments'><main>{}</main></div>", True),
    ("<form id='aspnet'><div class='content'>{}</div></form>", True),
    ("<aside><article>{}</article></aside>", False),
    ("<div role='navigation'><div id='content'>{}</div></div>", False),
    ("<nav class='main'><main>{}</main></nav>", False),
    ("<section id='comments'><article>{}</article></section>", False),
    ("<ol class='comment-list'><li class='comment'><div class='content'>{}</div></li></ol>", False),
    ("<div class='discussion'><article class='comment'>{}</article></div>", False),
    ("<div class='ad'><div class='content'>{}</div></div>", False),
    ("<article><div class='sidebar'>{}</div></article>", False),
    ("<main><div class='comments'><nav><div id='content'>{}</div></nav></div></main>", False),
    ("<article hidden><main>{}</main></article>", False)])
def test_main_text_of_containers_named_for_other_things(page, kept):
    text = "A sentence of the page that is long enough to count, with some more words. And one more sentence."
    assert htmlcut.main_text(page.format(text))[0] == (text if kept else "")


@pytest.mark.parametrize("tag", ["div", "section", "ul", "table"])
def test_main_text_of_deep_pages(tag):
    text = "A sentence of the page that is long enough to count. And one more."
    for end in ("", f"</{tag}>" * 5000):
        page = f"<body><article>{f'<{tag}>' * 5000}<p>{text}</p><p>{text}</p>{end}</article>"
        assert htmlcut.main_text(page) == (f"{text}\n\n{text}", 2, 2)


def test_min_cut_is_least():
    import itertools

    rng = np.random.default_rng(3)
    for _ in range(50):
        odds = rng.normal(0, 2, 6).round(2).tolist()
        edges = {(a, b): float(rng.random()) for a in range(6) for b in range(a + 1, 6) if rng.random() < 0.5}
        cost = lambda s: sum(max(-o, 0) if x else max(o, 0) for o, x in zip(odds, s)) + sum(c for (a, b), c in edges.items() if s[a] != s[b])
        assert cost(htmlcut.min_cut(odds, edges)) == pytest.approx(min(cost(s) for s in itertools.product([False, True], repeat=6)))


def test_automaton_is_levenshtein():
    words = ["idiot", "scum", "worthless"]
    a = toxicity.Automaton([toxicity.Entry(w, False, 3.0) for w in words] + [toxicity.Entry("lowei", True, 3.0)])
    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            row, old = [i], row
            for j, d in enumerate(y, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (c != d)))
        return row[-1]
    letters = toxicity._is_word_letter()
    for text in ["idiot", "idot", "idiott", "jdiot", "idt", "scum", "scun", "wortless", "lowei", "loweischaft", "lowe", "other", "worthlesss", "xidiot"]:
        found, *_ = toxicity.hits(text, a, letters)
        best = min([(distance(text, w), w) for w in words if distance(text, w) <= (1 if len(w) >= toxicity.FUZZY_LENGTH else 0)] + ([(0, "lowei")] if text.startswith("lowei") else []), default=None)
        assert (found[0] >= 0) == (best is not None), text


def test_letters_of_all_planes():
    words = ["바보멍청이", "ばかやろう", "𐐨𐐩𐐪𐐫𐐬"]
    a = toxicity.Automaton([toxicity.Entry(w, False, 3.0) for w in words])
    letters = toxicity._is_word_letter()
    for k, w in enumerate(words):
        for text, match in ((w, 2 * k), (w[:-1], 2 * k + 1), (w[:2], -1), (f"「{w}」", 2 * k), (f"、{w}。", 2 * k)):
            found, start, end, _ = toxicity.hits(text, a, letters)
            assert found.tolist() == [match], text
    assert toxicity.describe(f"『{words[1]}』", a, letters)[toxicity.FEATURES.index("exact_quoted")] > 0


def test_ordinal_grades_are_ordered():
    rng = np.random.default_rng(5)
    grade = rng.integers(0, 5, 400)
    who, bucket = np.repeat(np.arange(400), 2), np.empty(800, np.int64)
    bucket[::2], bucket[1::2] = grade, 10 + rng.integers(0, 5, 400)
    m = ordinal.fit(who, bucket, np.full(800, 0.7), grade, 5)
    assert (np.diff(m.thresholds) > 0).all()
    expected = m.tails(np.bincount(who, m.weights[bucket] * 0.7)).sum(1)
    assert np.corrcoef(expected, grade)[0, 1] > 0.9


def test_nearest_recall_and_ties(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(1500, 16))
    v[100:160] = v[99]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(9000, None), (9001, [0.0] * 16), (9002, [float("nan")] * 16), (None, [1.0] * 16)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in annsearch.search(t, t.where("vec_id % 50 = 0"), k=10, shard_points=500).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    hit = []
    for q in range(0, 1500, 50):
        s = v @ v[q]
        s[q] = -np.inf
        hit.append(len(set(got[q]) & set(np.lexsort((np.arange(1500), -s))[:10].tolist())) / 10)
    assert np.mean(hit) >= 0.9 and len(got) == 30
    assert got[100][:5] == [99, 101, 102, 103, 104] or np.dot(v[99], v[99]) < np.max(np.delete(v, np.arange(99, 160), 0) @ v[99])


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline

    docs = queries.read(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    left = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        new = stage(spark, left, SF)
        assert new.columns == docs.columns
        left = new
    kept = left.select("doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in kept}
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sets = {k: {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} for k, w in ((k, word.findall(t.lower())) for k, t in texts.items())}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            assert 100 * len(sets[a] & sets[b]) < 75 * len(sets[a] | sets[b])
    out = corpus_pipeline.STAGES[4][1](spark, left, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in kept)


def test_digest_of_payload():
    assert warc.payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and hashlib.sha1(b"").hexdigest().startswith("da39")


def _exact(v, q, k):
    """Ids of the k largest inner products with v[q], itself left out."""
    scale = np.abs(v).max()
    s = (v / scale) @ (v[q] / np.abs(v[q]).max())
    s[q] = -np.inf
    return set(np.lexsort((np.arange(len(v)), -s))[:k].tolist())


@pytest.mark.parametrize("kind", ["gaussian", "one long", "huge", "mixed"])
def test_nearest_of_unequal_lengths(spark, kind):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(2500, 32))
    if kind == "one long":
        v[77] *= 1e4
    if kind == "huge":
        v[77] *= 1e20
        v[78] *= 1e-20
    if kind == "mixed":
        v *= 10 ** rng.uniform(-3, 3, (2500, 1))
    t = spark.createDataFrame([(i, [float(x) for x in r], "x") for i, r in enumerate(v)], "vec_id long, embedding array<double>, shard string")
    got = {}
    for r in annsearch.search(t, t.where("vec_id % 25 = 0"), k=20, shard_points=1000).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    assert len(got) == 100 and all(len(x) == 20 for x in got.values())
    assert np.mean([len(got[q] & _exact(v, q, 20)) / 20 for q in got]) >= 0.95


def test_nearest_of_empty_tables_and_repeated_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [1.0]), (4, [0.0, 0.0]), (5, None)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.id, round(r.score, 3)) for r in annsearch.search(t, t.where("vec_id in (2, 3)"), k=3).collect())
    assert got == [(2, 1, 0.5), (2, 1, 1.0)]
    assert annsearch.search(t.limit(0), t, k=3).count() == 0 and annsearch.search(t, t.limit(0), k=3).count() == 0
