"""Texts beyond the slices that bound working memory, and the URL model on
labelled urls that it has not seen."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ampere.llm import neardup, packing, substring, urls
from ampere.llm import words as W

tokenizers = pytest.importorskip("public_tokenizers")


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(5000)}" for _ in range(n))


LONG = prose(450_000, 1)
assert len(LONG) > 2 * W.SLICE_BYTES


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    column = pa.array([LONG, None, "", "a b c", LONG[: 3 << 19]])
    want = W.hashed_words(column)
    monkeypatch.setattr(W, "SLICE_BYTES", 1 << 12)
    got = W.hashed_words(column)
    assert all((x == y).all() for x, y in zip(got, want)) and want[1].tolist()[:2] == [0, 450_000]
    assert [hi - lo for lo, hi in W.slices(column)] == [1, 3, 1] or sum(hi - lo for lo, hi in W.slices(column)) == 5


def test_long_texts_in_substring_dedup(spark):
    shared = prose(60, 2)
    rows = [(1, shared), (2, LONG + " " + shared + " " + LONG[:100]), (3, "x " + shared)]
    got = {r.doc_id: r for r in substring.op3_substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_removed, got[3].n_removed, got[2].n_removed) == (0, 60, 60)
    kept = (LONG + " " + LONG[:100]).split()
    assert got[2].n_words == len(kept) + 60 and got[2].kept_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_long_near_duplicates(spark):
    words = LONG.split()
    other = list(words)
    for at in range(100, len(words), 9000):
        other[at] = "changed"
    rows = [(1, LONG), (2, " ".join(other)), (3, prose(450_000, 7)), (4, LONG)]
    got = {r.doc_id: r.class_id for r in neardup.op9_minhash_neardup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1}


def test_long_texts_are_packed_whole(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    text = LONG[: 5 << 19]
    ids = t.encode(text, add_special_tokens=False).ids + [1]
    pieces = packing.op8_packing(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).collect()
    mine = sorted((p for p in pieces if p.doc_id == 1), key=lambda p: p.start)
    assert sum(p.length for p in mine) == len(ids) == mine[0].doc_tokens
    for p in mine:
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], dtype="<u4").tobytes())


def score(w, b, url):
    host, slash, path = url.partition("/")
    g = np.bincount(urls.grams(host, slash + path), minlength=urls.BUCKETS)
    return 1 / (1 + np.exp(-(g @ w / np.sqrt((g * g).sum()) + b)))


def test_url_model_on_urls_left_out():
    """Leave out each fifth: the labels of unseen urls."""
    right = 0
    for k in range(5):
        w, b = urls.train([x for i, x in enumerate(urls.LABELLED) if i % 5 != k])
        right += sum((score(w, b, u) >= 0.5) == bool(y) for i, (u, y) in enumerate(urls.LABELLED) if i % 5 == k)
    assert right / len(urls.LABELLED) >= 0.75


def test_url_scores_against_the_plain_formula(spark):
    w, b = urls.train()
    rows = [(i, f"http://{u}") for i, (u, _) in enumerate(urls.LABELLED)]
    got = {r.page_id: r for r in urls.op7_url_filter(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    for i, (u, _) in enumerate(urls.LABELLED):
        want = score(w, b, u)
        assert abs(got[i].score - want) < 1e-9
        if got[i].rule is None:
            assert got[i].verdict == ("block" if want >= 0.5 else "allow")
