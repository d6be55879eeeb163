"""Aligned tokenizers and the perfect hash against brute force."""

import collections
import hashlib
import os
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from qualia.llm import align, mph, queries  # noqa: E402

A, B = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")
TEXTS = ["The quick brown fox. It's here!", "", None, " ", "  a  b ", "a▁b", "x\n\ty\r\n", "日本語 テキスト 漢字", "naïve café — “quoted”", "<|endoftext|> <s> </s> <0x41> <unk>",
         "aaaa" * 300, " trailing ", "\x00\x07 tab\tx", "𝔘𝔫𝔦 🎉🎉 ok", "1234567 89,000.5", "The quick brown fox. It's here!", "for (int i = 0; i < n; i++) { x += 2; }"]


def tokens(text):
    """(ids of A, their bytes, ids of B, their bytes) by the libraries on the whole text."""
    import sentencepiece
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: b for b, c in align.BYTE_LETTERS.items()}
    a, b = lib.encode(" " + text, add_special_tokens=False).ids, piece.encode(text)
    raw_b = [bytes([int(piece.id_to_piece(i)[3:5], 16)]) if piece.is_byte(i) else piece.id_to_piece(i).replace("▁", " ").encode() for i in b]
    return a, [bytes(letters[c] for c in lib.id_to_token(i)) for i in a], b, raw_b


def brute(texts):
    out = []
    for text in texts:
        a, ra, b, rb = tokens(text) if text else ([], [], [], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(ra) != whole or b"".join(rb) != whole:
            a, ra, b, rb = [], [], [], []
        ends_a, ends_b = np.cumsum([0, *map(len, ra)]).tolist(), np.cumsum([0, *map(len, rb)]).tolist()
        links = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if ends_a[i] < ends_b[j + 1] and ends_b[j] < ends_a[i + 1]]
        cuts = sorted(set(ends_a[1:]) & set(ends_b[1:]))
        groups = [(",".join(str(x) for i, x in enumerate(a) if lo < ends_a[i + 1] <= hi) + "|" + ",".join(str(y) for j, y in enumerate(b) if lo < ends_b[j + 1] <= hi)) for lo, hi in zip([0, *cuts], cuts)]
        out.append((len(a), len(b), groups, links))
    docs = collections.Counter(p for *_, links in out for p in set(links))
    most = collections.defaultdict(int)
    for (x, _), n in docs.items():
        most[x] = max(most[x], n)
    return [(n_a, n_b, len(g), len(l), sum(docs[p] == most[p[0]] for p in l), sum(docs[p] for p in l), ";".join(g)) for n_a, n_b, g, l in out], docs, most


@pytest.mark.parametrize("block_pairs", [align.BLOCK_PAIRS, 40])
def test_equals_brute_force(spark, monkeypatch, block_pairs):
    monkeypatch.setattr(align, "FAN", 2)  # several levels of the trees
    rows = [(k, t, k) for k, t in enumerate(TEXTS)] + [(None, TEXTS[0], -1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _a int").repartition(7)
    want, docs, most = brute([t for _, t, _ in rows])
    found = align.Alignment(df, A, B, block_pairs=block_pairs)
    if block_pairs == 40:
        assert len(found.blocks(found.tables())) >= 3
    got = {r["_a"]: tuple(r[c] for c in align.NAMES) for r in found.result().collect()}
    for (_, _, k), w in zip(rows, want):
        assert got[k] == w
    assert len(got) == len(rows)
    if block_pairs != 40:
        pairs = {(r.a_id, r.b_id): (r.documents, r.best) for r in found.pairs().collect()}
        assert pairs == {p: (n, n == most[p[0]]) for p, n in docs.items()}


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = queries.read(spark, sf, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_align_tokenizers(spark, sf).collect()}
    assert len(got) == len(rows)
    short = sorted(rows, key=lambda r: len(r.text or ""))[:40]
    for r, w in zip(short, brute([r.text for r in short])[0]):
        g = got[r.doc_id]
        assert (g.n_a, g.n_b, g.n_groups, g.n_links) == w[:4]
        assert g.groups_sha256 == (hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "")


def test_empty_tables_and_clashing_names(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in align.Alignment(df, A, B).result().collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]
    assert align.Alignment(df.limit(0), A, B).result().count() == 0
    assert align.Alignment(df.withColumnRenamed("doc_id", "n_best"), A, B).result().columns == list(align.NAMES)


def test_piece_encoder_equals_the_library():
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=B)
    rng = np.random.default_rng(0)
    texts = [t for t in TEXTS if t and "▁" not in t] + ["".join(rng.choice(list(" ab\tc.é日\n"), 200)) for _ in range(50)]
    e = align.PieceEncoder(B)
    assert e.by_piece
    got = [ids[a:b].tolist() for _, _, ids, first in _encode(e, texts) for a, b in zip(first[:-1], first[1:])]
    assert got == [lib.encode(t) for t in texts]
    e.by_piece = False
    assert [ids[a:b].tolist() for _, _, ids, first in _encode(e, texts) for a, b in zip(first[:-1], first[1:])] == got


def _encode(e, texts):
    for lo, hi, data, off in align.text_slices(pa.array([" " + t for t in texts])):
        yield lo, hi, *e._pieces(data, off)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 40, n))
    h = mph.PerfectHash.load(mph.PerfectHash.of(keys).dump())
    assert sorted(h.index(keys).tolist()) == list(range(len(keys))) and h.n == len(keys)
    other = np.setdiff1d(rng.integers(1 << 41, 1 << 42, 1000), keys)
    assert (h.index(other) < max(len(keys), 1)).all()
