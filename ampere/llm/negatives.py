"""Hard negatives for contrastive training, by exact integer inner products.

Vectors are taken as whole numbers, ``floor(scale * x)``. Anchors are dealt
into blocks and all rows into tiles; each pair of a block and a tile is one
group, whose scores come from Strassen's recursive product of int64 tiles, odd
sides being padded with zeros. All steps of it are integer additions and
multiplications modulo 2**64, so a score that fits a long is exact whatever
the intermediate sums are; whether it must fit is known from the lengths of
the vectors, and where that is open the tile is computed in unbounded
integers.

A group returns at most its first few rows for each anchor (positives) or for
each anchor and positive (the window of negatives). Such lists are mergeable:
the first few of a union are among the first few of its parts, so a partial
``row_number`` merges them before and after the shuffle. The size of a group
is bounded by the block and the tile, never by a label or a vector that many
rows share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampere.llm.base import materialize

SCALE = 256
POSITIVES = NEGATIVES = 5
#: A negative scores at least this share of the positive, in hundredths, and at most as much as it.
LEAST = 80
#: Rows of a tile and anchors of a block, on average; and what a task multiplies at once.
TILE, BLOCK = 4096, 4096
ROWS_AT_ONCE = 512
#: Strassen's recursion ends where a side is at most this long.
LEAF = 64

ROW = "id bigint, key bigint, label int, q array<bigint>"


def _even(x: np.ndarray) -> np.ndarray:
    rows, cols = x.shape
    return np.pad(x, ((0, rows % 2), (0, cols % 2))) if rows % 2 or cols % 2 else x


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` by seven products of half the size, down to ``leaf``."""
    m, n = a.shape[0], b.shape[1]
    if min(m, n, a.shape[1]) <= leaf:
        return a @ b
    a, b = _even(a), _even(b)
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), dtype=p1.dtype)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two int64 matrices."""
    longest = [float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)).max(initial=0)) for x in (a, c)]
    if longest[0] * longest[1] < 2.0**62:
        return strassen(a, np.ascontiguousarray(c.T))
    exact = strassen(a.astype(object), c.T.astype(object))
    if any(not -(2**63) <= x < 2**63 for x in exact.flat):
        raise ValueError("an inner product does not fit a long")
    return exact.astype(np.int64)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """The rows of a list column, short ones padded with zeros."""
    out = np.zeros((len(column), width), dtype=np.int64)
    at = 0
    for chunk in column.chunks:
        sizes = np.diff(chunk.offsets.to_numpy())
        row = np.repeat(np.arange(len(chunk)), sizes) + at
        col = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[row, col] = chunk.flatten().to_numpy(zero_copy_only=False)
        at += len(chunk)
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max([0, *(int(np.diff(c.offsets.to_numpy()).max(initial=0)) for column in columns for c in column.chunks)])


def _first(values: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest values, largest first; of equal ones those
    that come first."""
    if len(values) > 4 * k:
        open_ = np.flatnonzero(values >= np.partition(values, len(values) - k)[len(values) - k])
    else:
        open_ = np.arange(len(values))
    return open_[np.argsort(-values[open_], kind="stable")[:k]]


def _blocks(left: pa.Table, right: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first anchor, scores, order)`` for a few anchors at a time against
    the tile, whose rows ``order`` puts in the order of id and key."""
    order = np.lexsort((right.column("key").to_numpy(), right.column("id").to_numpy()))
    width = _width(left.column("q"), right.column("q"))
    a, c = _matrix(left.column("q"), width), _matrix(right.column("q"), width)[order]
    for at in range(0, len(a), ROWS_AT_ONCE):
        yield at, scores(a[at : at + ROWS_AT_ONCE], c), order


def _table(rows: list[tuple], ddl: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({n: pa.array([r[i] for r in rows], type=t) for i, (n, t) in enumerate(ddl.items())})


def _positives(count: int):
    """The first ``count`` rows of a tile for each anchor, of its own label."""

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        ids, keys, labels = (left.column(n).to_numpy() for n in ("id", "key", "label"))
        for at, s, order in _blocks(left, right):
            to, to_key, to_label = (right.column(n).to_numpy()[order] for n in ("id", "key", "label"))
            for i, row in enumerate(s, at):
                ok = np.flatnonzero((to_label == labels[i]) & ((to != ids[i]) | (to_key != keys[i])))
                for j in ok[_first(row[ok], count)].tolist():
                    found.append((ids[i], keys[i], to[j], to_key[j], row[j]))
        return _table(found, {n: pa.int64() for n in ("id", "key", "p", "p_key", "p_score")})

    return one


def _negatives(count: int, least: int):
    """The first ``count`` rows of a tile within the window of each anchor and
    positive, of another label than the anchor's."""

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        ids, keys, labels = (left.column(n).to_numpy() for n in ("id", "key", "label"))
        partners = left.column("partners").to_pylist()
        for at, s, order in _blocks(left, right):
            to, to_key, to_label = (right.column(n).to_numpy()[order] for n in ("id", "key", "label"))
            for i, row in enumerate(s, at):
                other = np.flatnonzero(to_label != labels[i])
                value = row[other]
                for p in partners[i]:
                    top = p["p_score"]
                    # least * positive <= 100 * negative <= 100 * positive, without a product that could overflow
                    ok = np.flatnonzero((value <= top) & (value >= -(-least * top // 100)))
                    for j in ok[_first(value[ok], count)].tolist():
                        n = other[j]
                        found.append((ids[i], keys[i], p["p"], p["p_key"], top, to[n], to_key[n], value[j]))
        return _table(found, {n: pa.int64() for n in ("id", "key", "p", "p_key", "p_score", "n", "n_key", "n_score")})

    return one


def whole_numbers(vectors: DataFrame, label: Column, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """``(id, key, label, q)``: the rows that take part, each once."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col(f"`{vec_id}`").isNotNull() & label.isNotNull() & v.isNotNull() & finite
    whole = F.transform(
        v, lambda x: F.when(F.abs(x * scale) < 2.0**62, F.floor(x * scale)).otherwise(F.raise_error(F.lit("a component does not fit a long")).cast("bigint"))
    )
    rows = vectors.where(usable).select(F.col(f"`{vec_id}`").cast("long").alias("id"), label.cast("int").alias("label"), whole.alias("q"))
    return rows.distinct().select("id", F.xxhash64("label", "q").alias("key"), "label", "q")


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` for every row that ``anchor`` (a condition on ``id``)
    selects, against all rows.

    A score is the inner product of ``floor(scale * x)``; higher scores come
    first, ties by smaller vec_id. An anchor's positives are its first other
    rows of the same label; its negatives for a positive the first rows of
    another label that score from ``least`` hundredths of the positive's score
    up to that score.

    Rows with a null vec_id, label, vector or a null or non-finite component
    take no part. Rows that agree in vec_id, label and vector are one row;
    rows that share only the vec_id are different rows, ordered by a hash.
    A shorter vector counts as continued by zeros, an empty one as zeros. An
    anchor without a positive, or a positive without a negative, has no rows;
    an empty table gives none. A score or component beyond a long is an error.
    """
    label = F.col("label") if label is None else label
    rows = materialize(whole_numbers(vectors, label, scale, vec_id, embedding), "whole-vectors")
    chosen = rows.where(anchor)
    count = rows.agg(F.count("*").alias("rows"), F.count(F.when(anchor, 1)).alias("anchors")).first()
    tiles, blocks = max(1, -(-count["rows"] // TILE)), max(1, -(-count["anchors"] // BLOCK))
    place = F.xxhash64("id", "key")
    candidates = rows.select("*", F.pmod(place, F.lit(tiles)).alias("tile"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"))

    def against(anchors: DataFrame, work, ddl: str) -> DataFrame:
        left = anchors.select("*", F.pmod(place, F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles - 1).cast("bigint"))).alias("tile"))
        return left.groupBy("block", "tile").cogroup(candidates.groupBy("block", "tile")).applyInArrow(work, ddl)

    def first(found: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    found = against(chosen, _positives(positives), "id bigint, key bigint, p bigint, p_key bigint, p_score bigint")
    kept = first(found, ["id", "key"], [F.desc("p_score"), "p", "p_key"], positives)
    partners = kept.groupBy("id", "key").agg(F.collect_list(F.struct("p", "p_key", "p_score")).alias("partners"))  # at most `positives`
    paired = materialize(chosen.join(partners, ["id", "key"]), "anchors")
    ddl = ", ".join(f"{n} bigint" for n in ("id", "key", "p", "p_key", "p_score", "n", "n_key", "n_score"))
    mined = first(against(paired, _negatives(negatives, least), ddl), ["id", "key", "p", "p_key"], [F.desc("n_score"), "n", "n_key"], negatives)
    return mined.select(
        F.col("id").alias("anchor_id"), F.col("p").alias("positive_id"), "rank", F.col("n").alias("negative_id"),
        F.col("p_score").alias("positive_score"), F.col("n_score").alias("negative_score"),
    )


#: Every so many vec_ids one anchor; every so many a label that is wrong on purpose.
ANCHORS, RELABELLED, LABELS = 100, 7, 10


def op13_hard_negatives(vectors: DataFrame) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 100, against
    all rows; where vec_id is divisible by 7 the label is (label + 1) % 10.

    Nulls, non-finite components, empty vectors, ties, repeated rows and empty
    tables as in ``hard_negatives``; extra columns are not read.
    """
    vectors = vectors.select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % RELABELLED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("id") % ANCHORS == 0, moved)


ORACLE = """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (
  SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM q a, q c WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT a, c, score FROM e WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5),
n AS (
  SELECT p.a, p.c AS p, p.score AS ps, e.c AS n, e.score AS ns,
         row_number() OVER (PARTITION BY p.a, p.c ORDER BY e.score DESC, e.c)::INTEGER AS rank
  FROM p JOIN e ON e.a = p.a AND NOT e.same
  WHERE 80 * p.score <= 100 * e.score AND 100 * e.score <= 100 * p.score)
SELECT a AS anchor_id, p AS positive_id, rank, n AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE rank <= 5
"""
