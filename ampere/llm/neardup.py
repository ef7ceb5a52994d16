"""Near-duplicates by order MinHash, verified by banded alignment.

Texts are sequences of five-word shingles. An order MinHash keeps, for each
of ``FUNCTIONS`` hash functions, the ``KEPT`` occurrence-labelled shingles of
least hash, in the order in which the text has them; texts of small edit
distance agree in many of these. Texts that agree in one are candidates.

Two texts are linked if the shingles that a banded alignment matches in order
are at least ``LEAST`` of all: matched / (a + b - matched) >= 0.8. The band is
as wide as that bound needs, so the alignment finds every such pair. Linked
texts form groups, of which the smallest doc_id stays.

Equal word sequences are one text from the start. The members of a bucket of
candidates are first compared with its smallest one, which joins most of them.
In each bucket whose members still lie in several components, all pairs across
components are then compared: the bucket is dealt into blocks of bounded size,
and a task has two blocks of it, so no pair becomes a row. Within a task a pair
is aligned only if the shingles that both texts have, however ordered, reach
the bound, and if no other pair of the task has joined its components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.llm import words as W
from ampere.llm.base import connected_components, forget_tokenizers, materialize, small_batches

SHINGLE, LEAST, FUNCTIONS, KEPT = 5, 0.8, 16, 2
#: At most about so many texts and so many shingles are in a block of a bucket;
#: so many columns of the matrix of texts and shingles are held at once.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 500_000, 1024
_SEEDS = W.mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOW = np.uint64((1 << 24) - 1)


def shingles(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts and where each text's begin. A text of one
    to four words has one shingle, of all its words."""
    counts = np.diff(offsets)
    per_row = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), per_row)
    first = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    rolled = W.rolling(hashes, SHINGLE)
    at = offsets[:-1][row] + first
    out = rolled[np.minimum(at, len(rolled) - 1)] if len(rolled) else np.zeros(len(row), dtype=np.uint64)
    starts = np.append(0, np.cumsum(per_row))
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        out[starts[i]] = W.rolling(hashes[offsets[i] : offsets[i + 1]], int(counts[i]))[0]
    return out, starts


def _labelled(found: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Shingles mixed with how often the text had them before."""
    key = W.mix(found ^ W.mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    begin = np.flatnonzero(new)
    nth = np.arange(len(k)) - np.repeat(begin, np.diff(np.append(begin, len(k))))
    out = found.copy()
    again = order[nth > 0]
    out[again] = W.mix(found[again] + nth[nth > 0].astype(np.uint64))
    return out


def order_minhash(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``(texts with shingles, FUNCTIONS)`` band values."""
    counts = np.diff(starts)
    have = np.flatnonzero(counts)
    begin, counts = starts[:-1][have], counts[have]
    row = np.repeat(np.arange(len(have)), counts)
    labelled = _labelled(found, row)
    place = (np.arange(len(found)) - np.repeat(begin, counts)).astype(np.uint64) & _LOW
    out = np.empty((len(have), FUNCTIONS), dtype=np.uint64)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    for i, seed in enumerate(_SEEDS):
        value = (labelled ^ seed) * np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(29)
        value = ((value * np.uint64(0x94D049BB133111EB)) & ~_LOW) | place
        picks = []
        for _ in range(KEPT):
            least = np.minimum.reduceat(value, begin)
            picks.append(least)
            value[value == least[row]] = none
        chosen = np.stack(picks)
        gone = chosen == none
        at = np.where(gone, 0, (chosen & _LOW).astype(np.int64) + begin)
        what = np.where(gone, none, labelled[np.minimum(at, len(found) - 1)])
        order = np.argsort(np.where(gone, np.iinfo(np.int64).max, at), axis=0, kind="stable")
        what = np.take_along_axis(what, order, axis=0)
        band = np.full(len(have), np.uint64(i + 1))
        for w in what:
            band = W.mix(band * np.uint64(0xD6E8FEB86659FD93) + w)
        out[:, i] = band
    return out


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget_tokenizers()
    for b in batches:
        for lo, hi in W.slices(b.column(2)):
            part = b.slice(lo, hi - lo)
            hashes, offsets = W.hashed_words(part.column(2))
            found, starts = shingles(hashes, offsets)
            have = np.flatnonzero(np.diff(starts))
            bands = order_minhash(found, starts) if len(have) else np.zeros((0, FUNCTIONS), dtype=np.uint64)
            whole = []
            for salt in (0, 1):
                h = hashes if not salt else W.mix(hashes + np.uint64(salt))
                sums = np.zeros(len(h) + 1, dtype=np.uint64)
                np.cumsum(h * W.powers(W._Q, len(h)), out=sums[1:])
                value = (sums[offsets[1:]] - sums[offsets[:-1]]) * W.powers(W._Q_INV, len(h) + 1)[offsets[:-1]]
                whole.append(pa.array(W.mix(value ^ np.diff(offsets).astype(np.uint64))[have].view(np.int64)))
            ids = [pa.array(part.column(i).to_numpy(zero_copy_only=False)[have]) for i in (0, 1)]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(have) + 1, dtype=np.int32) * FUNCTIONS), pa.array(bands.reshape(-1).view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [*ids, *whole, pa.array(np.diff(starts)[have].astype(np.int64)), lists], ["id", "key", "e1", "e2", "n", "bands"]
            )


def similarity(x: np.ndarray, y: np.ndarray, least: float = LEAST) -> float:
    """Matched share of two shingle sequences by banded alignment; 0 where it
    cannot reach ``least``. Common ends are matched at once; in between, rows
    of the alignment are bit sets, restricted to the band."""
    n, m = len(x), len(y)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    short = min(n, m)
    differ = np.flatnonzero(x[:short] != y[:short])
    head = int(differ[0]) if len(differ) else short
    differ = np.flatnonzero(x[::-1][: short - head] != y[::-1][: short - head])
    tail = int(differ[0]) if len(differ) else short - head
    a, b = x[head : n - tail].tolist(), y[head : m - tail].tolist()
    matched = head + tail
    if a and b:
        band = max(n, m) - int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
        where: dict[int, int] = {}
        for j, s in enumerate(b):
            where[s] = where.get(s, 0) | 1 << j
        full = (1 << len(b)) - 1
        window = (1 << (2 * band + 1)) - 1
        v = full
        for i, s in enumerate(a):
            at = where.get(s)
            if at:
                at &= window << (i - band) if i >= band else window >> (band - i)
                u = v & at
                v = ((v + u) | (v - u)) & full
        matched += len(b) - v.bit_count()
    return matched / (n + m - matched)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget_tokenizers()
    for b in batches:
        known: dict[int, np.ndarray] = {}

        def of(i: int, texts: pa.Array, k: int, known=known) -> np.ndarray:
            if i not in known:
                if len(known) > 64:
                    known.clear()
                known[i] = shingles(*W.hashed_words(texts.slice(k, 1)))[0]
            return known[i]

        left, right, s, t = (b.column(i) for i in range(4))  # the texts stay in the batch
        good = [similarity(of(i, s, k), of(j, t, k)) >= LEAST for k, (i, j) in enumerate(zip(left.to_pylist(), right.to_pylist()))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(good, type=pa.bool_())], ["c", "id", "good"])


def _common(texts: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many occurrence-labelled shingles each left text shares with each right one."""
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    found, column, uses = np.unique(_labelled(np.concatenate(texts), row), return_inverse=True, return_counts=True)
    rank = np.cumsum(uses > 1) - 1
    shared = uses[column] > 1
    row, column = row[shared], rank[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (lo, lo + COLUMNS))
        have = np.zeros((len(texts), COLUMNS), dtype=np.float32)
        have[row[a:b], column[a:b] - lo] = 1
        out += have[left] @ have[right].T
    return out


def _across(group: tuple, table: pa.Table) -> pa.Table:
    """Links that join the components of two blocks of a bucket, of the pairs
    whose first common band is the bucket's."""
    i, _, p, q = (x.as_py() for x in group)
    ids, part, block = (table.column(c).to_numpy() for c in ("id", "part", "block"))
    bands = np.asarray(table.column("bands").combine_chunks().flatten()).reshape(-1, FUNCTIONS)
    left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
    todo = part[left][:, None] != part[right][None, :]
    if p == q:
        todo &= np.triu(np.ones(todo.shape, dtype=bool), 1)
    for j in range(i):
        todo &= bands[left, j][:, None] != bands[right, j][None, :]
    links: list[tuple[int, int]] = []
    if todo.any():
        rows, cols = np.flatnonzero(todo.any(axis=1)), np.flatnonzero(todo.any(axis=0))
        left, right, todo = left[rows], right[cols], todo[np.ix_(rows, cols)]
        wanted, at = np.unique(np.concatenate([left, right]), return_inverse=True)
        found, starts = shingles(*W.hashed_words(table.column("text").take(pa.array(wanted)).combine_chunks()))
        texts = [found[a:b] for a, b in zip(starts[:-1], starts[1:])]
        n = np.diff(starts)
        at_left, at_right = at[: len(left)], at[len(left) :]
        total = n[at_left][:, None] + n[at_right][None, :]
        common = _common(texts, at_left, at_right)
        todo &= common >= np.ceil(LEAST * total / (1 + LEAST) - 1e-9)
        x, y = np.nonzero(todo)
        root: dict[int, int] = {}

        def of(v: int) -> int:
            while root.get(v, v) != v:
                root[v] = v = root.get(root[v], root[v])
            return v

        share = common[x, y] / (total[x, y] - common[x, y])
        for k in np.argsort(-share, kind="stable").tolist():
            u, v = int(at_left[x[k]]), int(at_right[y[k]])
            a, b = of(int(part[wanted[u]])), of(int(part[wanted[v]]))
            if a != b and similarity(texts[u], texts[v]) >= LEAST:
                root[max(a, b)] = min(a, b)
                links.append((int(ids[wanted[u]]), int(ids[wanted[v]])))
    return pa.table({"a": pa.array([a for a, _ in links], type=pa.int64()), "b": pa.array([b for _, b in links], type=pa.int64())})


def _ids(docs: DataFrame, doc_id: str, text: str) -> list:
    """id, key and text; a null doc_id stands behind all others, by its text."""
    key = F.xxhash64(F.col(f"`{text}`"))
    behind = F.lit(2**62) + key.bitwiseAND(F.lit(2**61 - 1))
    return [F.coalesce(F.col(f"`{doc_id}`").cast("long"), behind).alias("id"), key.alias("key"), F.col(f"`{text}`").alias("text")]


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, key, class_id)`` for each distinct id and text with a word;
    class_id is the smallest id of its group. Texts without words (null or
    empty) have no shingles and belong to no group; rows that share a doc_id
    are one document."""
    base = docs.select(*_ids(docs, doc_id, text))
    sketch = materialize(
        base.mapInArrow(_sketches, "id bigint, key bigint, e1 bigint, e2 bigint, n bigint, bands array<bigint>"), "sketch"
    )
    # a class of equal word sequences is the vertex of its smallest id and key; further texts of one id have
    # vertices of their own, which their rows join to the id at the end
    least = sketch.groupBy("e1", "e2").agg(F.min(F.struct("id", "key", "n", "bands")).alias("r"))
    least = least.select("e1", "e2", F.col("r.id").alias("doc"), "r.key", "r.n", "r.bands")
    several = sketch.groupBy("id").agg(F.min("key").alias("own"), F.max("key").alias("other")).where("own < other")
    if several.isEmpty():  # the common case: no id needs a join to know its own vertex
        classes = least.withColumn("id", F.col("doc"))
    else:
        apart = F.lit(2**61) + F.xxhash64("doc", "key").bitwiseAND(F.lit(2**60 - 1))
        own = F.coalesce(F.col("key") == F.col("own"), F.lit(True))
        classes = least.join(several.select(F.col("id").alias("doc"), "own"), "doc", "left")
        classes = classes.withColumn("id", F.when(own, F.col("doc")).otherwise(apart)).drop("own")
    classes = materialize(classes, "classes")
    rows = classes.select("id", "n", F.posexplode("bands").alias("i", "h"))
    center = F.struct(F.col("id").alias("c"), F.col("n").alias("cn"))
    centers = rows.groupBy("i", "h").agg(F.min(center).alias("s"), F.max("id").alias("hi")).where("s.c < hi")
    members = materialize(rows.join(centers.select("i", "h", "s.c", "s.cn"), ["i", "h"]).where("id > c"), "star")
    wanted = members.select("id").unionByName(members.select(F.col("c").alias("id"))).distinct()
    chosen = classes.select("id", "doc", "key").join(wanted, "id")
    source = base.withColumnRenamed("id", "doc")
    texts = materialize(chosen.join(source, ["doc", "key"]).groupBy("id").agg(F.min("text").alias("text")), "texts")
    pairs = members.where(F.least("n", "cn") >= F.lit(LEAST) * F.greatest("n", "cn")).select("c", "id").distinct()
    both = pairs.join(texts, "id").select("c", "id", F.col("text").alias("t"))
    both = both.join(texts.select(F.col("id").alias("c"), F.col("text").alias("s")), "c")
    told = materialize(both.select("c", "id", "s", "t").mapInArrow(_verify, "c bigint, id bigint, good boolean"), "told")
    first = told.where("good").select(F.col("c").alias("a"), F.col("id").alias("b"))

    # buckets in several components; of those with the same members, the first. Two members are told by now
    parts = connected_components(first).select(F.col("vertex").alias("id"), F.col("component").alias("part"))
    placed = classes.select("id", "key", "n", "bands").join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))
    placed = materialize(placed, "placed")
    rows = placed.select("id", "key", "n", "part", F.posexplode("bands").alias("i", "h"))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    same = [F.bit_xor(F.xxhash64("id", "key", F.lit(k))).alias(f"x{k}") for k in (0, 1)]
    still = rows.groupBy("i", "h").agg(
        F.count("*").alias("size"), blocks.alias("blocks"), F.min("part").alias("lo"), F.max("part").alias("hi"), *same
    ).where("size > 2 and lo < hi")
    still = still.groupBy("size", "x0", "x1").agg(F.min(F.struct("i", "h", "blocks")).alias("s")).select("s.*")
    still = materialize(still, "open")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = rows.select("id", "key", "i", "h").join(still, ["i", "h"]).withColumn("block", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("id", "key", "i", "h", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
    dealt = dealt.join(placed.select("id", "key", "part", "bands").join(texts, "id"), ["id", "key"])
    across = dealt.groupBy("i", "h", "p", "q").applyInArrow(_across, "a bigint, b bigint")
    links = first.unionByName(materialize(across, "across"))
    # rows of one doc_id with several texts are one document
    shared = sketch.join(classes.select("e1", "e2", F.col("id").alias("rep")), ["e1", "e2"])
    one = shared.where("id != rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    groups = connected_components(links.unionByName(one))
    return (
        sketch.select("id", "key").distinct().join(groups, F.col("id") == F.col("vertex"), "left")
        .select("id", "key", F.coalesce("component", "id").alias("class_id"))
    )


def op9_minhash_neardup(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class_id (the smallest doc_id of its group) and
    kept (it is that document). Texts without words are their own group."""
    groups = near_duplicates(docs)
    real = lambda c: F.when(F.col(c) < 2**62, F.col(c))
    rows = docs.select(*_ids(docs, "doc_id", "text")[:2]).join(groups, ["id", "key"], "left")
    rows = rows.withColumn("class_id", F.coalesce("class_id", "id"))
    return rows.select(real("id").alias("doc_id"), real("class_id").alias("class_id"), (F.col("id") == F.col("class_id")).alias("kept"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one of the smallest doc_id; of rows
    that repeat it, one. Texts without words all stay."""
    small_batches(spark)
    groups = near_duplicates(docs)
    first = groups.where("id = class_id").groupBy("id").agg(F.min("key").alias("key"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    tagged = docs.select(row, *_ids(docs, "doc_id", "text")[:2])
    marks = groups.select("id", "key", F.lit(True).alias("grouped")).join(first.withColumn("first", F.lit(True)), ["id", "key"], "left")
    out = tagged.join(marks, ["id", "key"], "left").where("first or grouped is null")
    repeated = tagged.groupBy("id", "key").count().where("count > 1")
    if not repeated.isEmpty():
        out = out.where("first").dropDuplicates(["id"]).unionByName(out.where("first is null"))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
