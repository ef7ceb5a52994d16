"""Alignment against whole-text tokenizers and a plain count of links."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ampere.llm import alignment as A

tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string"
WORDS = "The naïve café cost 12,50 € — isn't it? 漢字とかな 😀👩‍👩‍👧 x_y_z http://a.b/c?d=e  two  spaces\tand\ttabs\r\nlines ".split(" ")
ROWS = [
    (1, "Hello world, this is a test."), (2, "Hello world, this is a test."), (3, " leading and trailing  "), (4, "\n\n\ttabs\r\n"),
    (5, None), (6, ""), (7, " "), (8, "   "), (9, "a ▁ piece mark"), (10, "▁"), (11, "\x00 nul \x1c"), (12, "<s> </s> <unk> <0x41> <|endoftext|>"),
    (13, "ünï 漢字 😀 é ﬁ Å"), (14, "x" * 3000), (15, "1234567890 " * 50), (16, " ".join(WORDS * 40)), (None, "null id"), (None, None),
    (17, "dup id one"), (17, "dup id two"), (18, "‍﻿  　"), (19, "word " * 9000),
]


def plain(rows):
    """The contract, text by text, with both tokenizers on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))
    ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}

    def piece(i):
        p = s.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if s.is_byte(i) else p.replace("▁", " ").encode()

    done = []
    for doc, text in rows:
        if not text:
            done.append((doc, [], [], [], []))
            continue
        a, b = t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)
        ab, bb = [ranks[i] for i in a], [piece(i) for i in b]
        raw = (" " + text).encode()
        if b"".join(ab) != raw or b"".join(bb) != raw:
            done.append((doc, [], [], [], []))
            continue
        ae, be = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        cuts = sorted(set(ae) & set(be))
        groups, links, i, j = [], [], 0, 0
        for c in cuts:
            i0, j0 = i, j
            while i < len(a) and ae[i] <= c:
                i += 1
            while j < len(b) and be[j] <= c:
                j += 1
            groups.append((a[i0:i], b[j0:j]))
            for x in range(i0, i):
                for y in range(j0, j):
                    if max(ae[x] - len(ab[x]), be[y] - len(bb[y])) < min(ae[x], be[y]):
                        links.append((a[x], b[y]))
        done.append((doc, a, b, groups, links))
    count = Counter(p for d in done for p in d[4])
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for doc, a, b, groups, links in done:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=key)


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, DOCS)
    for c in ("row", "a", "b", "n", "count", "best", "most", "n_a"):
        df = df.selectExpr("*", f"cast(7 as int) AS `{c}`")
    return df.repartition(3)


@pytest.mark.parametrize("heavy", [A.HEAVY, 40, 1])
def test_against_whole_texts(spark, docs, heavy):
    got = A.align(docs, tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"), tokenizers.PATTERN, heavy=heavy)
    assert rows_of(got) == sorted(plain(ROWS), key=key)


def test_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(A.op12_alignment(docs)) == sorted(plain(rows), key=key)


def test_empty_table(spark, docs):
    assert A.op12_alignment(docs.limit(0)).collect() == []


def test_memory_is_bounded_and_changes_nothing(monkeypatch):
    pair = A.Pair(tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"), tokenizers.PATTERN)
    texts = [t for _, t in ROWS]
    want = [list(t) for t in pair.texts(texts)]
    pair.most, pair.longest = 5, 3
    monkeypatch.setattr(A, "CHUNK_CHARS", 40)
    for _ in range(3):
        assert [list(t) for t in pair.texts(texts)] == want
    assert all(len(w) <= 3 for w in pair.known)


def test_common_words_are_aligned_once():
    pair = A.Pair(tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"), tokenizers.PATTERN)
    pair.most, asked, align = 20, [], pair.align
    pair.align = lambda words: (asked.extend(words), align(words))[1]
    for i in range(100):
        text = f"x common {chr(97 + i % 26) * (1 + i // 26)}"
        assert [len(t) for t in pair.texts([text])] == [3]
    assert asked.count(" common") == 1 and len(pair.known) + len(pair.old) <= 30


def test_a_word_before_marks_is_aligned_once():
    pair = A.Pair(tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"), tokenizers.PATTERN)
    asked, align = [], pair.align
    pair.align = lambda words: (asked.extend(words), align(words))[1]
    rows = [(i, f"x common{m} x") for i, m in enumerate(["", ",", ".", "!?", ":", "; ", "..\r\n", ".b/c?d=e"])]
    counts, hashes, _ = A._align(pair, [t for _, t in rows[:1]])
    for _, t in rows[1:]:
        more, h, _ = A._align(pair, [t])
        counts, hashes = [np.append(a, b) for a, b in zip(counts, more)], hashes + h
    assert [(*map(int, c), h) for *c, h in zip(*counts, hashes)] == [(*w[1:5], w[7]) for w in plain(rows)]
    assert asked.count(" common") == 1 and not any(w.startswith(" common") and w != " common" for w in asked)


def test_one_unfaithful_word_costs_little():
    pair = A.Pair(tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"), tokenizers.PATTERN)
    calls, aligned = [], pair._aligned
    pair._aligned = lambda words: (calls.append(len(words)), aligned(words))[1]
    words = [f" w{i}x" for i in range(500)] + [" a▁b"]
    told = pair.align(words)
    assert [w for w in words if told[w] is None] == [" a▁b"] and len(calls) < 40


@pytest.mark.parametrize("word", ["<u4", "<u8"])
def test_marks_at_random(monkeypatch, word):
    """Words cut before marks, in any company, are the whole text's alignment, with either width of links."""
    monkeypatch.setattr(A, "CHUNK_CHARS", 40)
    r = random.Random(5)
    bits = list(".,;:!?.,") + [" ", " ", "\r", "\n", "\xa0", "a", "Bc", "the", "'s", "'", "é", "ﬁ", "я", "12", "http://", "e.g", "...", "(", ")", "😀", "—", "\u0301"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(1, 30)))) for i in range(1500)]
    pair = A.Pair(tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"), tokenizers.PATTERN)
    pair.word = np.dtype(word)
    pair.top = pair.word.type(1 << (8 * pair.word.itemsize - 1))
    counts, hashes, lists = A._align(pair, [t for _, t in rows])
    want = plain(rows)
    assert [(*map(int, c), h) for *c, h in zip(*counts, hashes)] == [(*w[1:5], w[7]) for w in want]
    assert [sum(n) for n in lists[2].to_pylist()] == [w[4] for w in want]


def test_words_at_random(monkeypatch):
    """Words aligned apart, and new ones together, are the whole text's alignment."""
    monkeypatch.setattr(A, "CHUNK_CHARS", 60)
    r = random.Random(8)
    bits = list(" \t\n\r\x0b\x0c\x1c\x85\xa0\u2003\u3000") * 2 + ["  ", "\r\n", "a", "Bc", "don't", "é", "漢字", "12", "345", "!?", "();", "}", "😀", "\u0301", "'s", "\u200b", "_", "<s>"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(1, 30)))) for i in range(1500)]
    pair = A.Pair(tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model"), tokenizers.PATTERN)
    counts, hashes, _ = A._align(pair, [t for _, t in rows])
    want = plain(rows)
    assert [(*map(int, c), h) for *c, h in zip(*counts, hashes)] == [(*w[1:5], w[7]) for w in want]


def test_coalesce_and_overlaps_at_random():
    r = np.random.default_rng(1)
    for _ in range(200):
        n = int(r.integers(1, 40))
        a_end, b_end = (np.unique(np.append(r.integers(1, n + 1, int(r.integers(0, 20))), n)) for _ in range(2))
        a_start, b_start = np.append(0, a_end[:-1]), np.append(0, b_end[:-1])
        ga, gb = A.coalesce(a_start, a_end, b_start, b_end)
        cuts = sorted(set(a_end.tolist()) & set(b_end.tolist()))
        assert ga.tolist() == [sum(c < e for c in cuts) for e in a_end.tolist()]
        assert gb.tolist() == [sum(c < e for c in cuts) for e in b_end.tolist()]
        left, right = A.overlaps(a_start, a_end, ga, b_start, b_end, gb)
        want = [(i, j) for i in range(len(a_end)) for j in range(len(b_end)) if max(a_start[i], b_start[j]) < min(a_end[i], b_end[j])]
        assert list(zip(left.tolist(), right.tolist())) == want
