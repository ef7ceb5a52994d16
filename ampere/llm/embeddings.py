"""All pairs of embeddings at a cosine of 0.95 or more, by PCA-ordered tiles.

Vectors are scaled to length one and turned onto principal axes, those of
largest variance first. Tiles are the leaves of median splits over the leading
axes. A tile has a box, the range of its leading coordinates, and the range of
its suffix norms, the length of what the other coordinates hold; a vector is
sent to the tiles that it can reach: whose box and suffix norms are not
farther from its own than any linked pair can be. Two tiles are compared a
block at a time, leading coordinates first: what the others can add is at most
the product of the suffix norms, so a block stops, or goes on with the rows
and columns still in question, once the bound falls below the threshold. The
pairs left are decided by the cosine of the vectors as given, in double
precision. Only sums of links and a spanning forest of each block leave a
task, so a dense group costs no list of its pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.llm.base import connected_components, materialize

LEAST = 0.95
#: The axes are fitted on at most this many vectors; they decide speed alone.
SAMPLE = 4096
TILE, BLOCK, LEADING = 8192, 1024, 16
#: Leaves of the splits: so many boxes are all the driver and a task ever hold. A leaf of more
#: vectors than a tile is cut into several tiles by hash.
LEAVES = 1024
#: Rows that are sent on together.
SENT = 4096


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a graph on ``n`` vertices."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = np.flatnonzero(label != np.arange(n))
    return list(zip(label[moved].tolist(), moved.tolist()))


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def compare(ids: np.ndarray, x: np.ndarray, z: np.ndarray, weight: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, least: float):
    """``(ids, links)`` sums and forest edges between two tiles' rows."""
    links = np.zeros(len(ids))
    edges: list[tuple[int, int]] = []
    lead = min(LEADING, z.shape[1])
    suffix = np.sqrt(np.maximum((z[:, lead:] ** 2).sum(axis=1), 0)) + 1e-9
    for i in range(0, len(left), BLOCK):
        for j in range(i if same else 0, len(right), BLOCK):
            l, r = left[i : i + BLOCK], right[j : j + BLOCK]
            partial = z[l, :lead] @ z[r, :lead].T
            open_ = partial + suffix[l][:, None] * suffix[r][None, :] >= least - 1e-7
            rows, cols = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            if not len(rows):
                continue
            l, r = l[rows], r[cols]
            near = partial[np.ix_(rows, cols)] + z[l, lead:] @ z[r, lead:].T >= least - 1e-7
            a, b = np.nonzero(near)
            a, b = l[a], r[b]
            if same:
                a, b = a[ids[a] < ids[b]], b[ids[a] < ids[b]]
            exact = np.empty(len(a), dtype=bool)
            for k in range(0, len(a), 1 << 16):
                p, q = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
                exact[k : k + (1 << 16)] = np.einsum("ij,ij->i", x[p], x[q]) >= least
            a, b = a[exact], b[exact]
            if len(a):
                links += np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
                here, back = np.unique(np.concatenate([a, b]), return_inverse=True)
                edges += [(int(here[u]), int(here[v])) for u, v in _forest(back[: len(a)], back[len(a) :], len(here))]
    return links, edges


def link_all(vectors: DataFrame, least: float = LEAST, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, embedding, n_links, component_id)`` for each distinct row.

    Equal vectors are compared once. Null ids, and vectors that are null,
    empty, zero or hold null or non-finite components, link with nothing;
    vectors of different length do not link. Rows that agree in id and vector
    are one vector.
    """
    spark = vectors.sparkSession
    v = F.col(f"`{embedding}`")
    usable = (
        F.col(f"`{vec_id}`").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), v.cast("array<double>").alias("v"), F.coalesce(usable, F.lit(False)).alias("ok")).distinct()
    classes = materialize(
        rows.where("ok").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")).withColumn("d", F.size("v")), "vectors"
    )
    parts = []
    for d, count in [(r["d"], r["count"]) for r in classes.groupBy("d").count().collect()]:
        parts.append(_linked(classes.where(F.col("d") == d).select("rep", "v", "n"), d, count, least))
    ddl = "id bigint, links double, other bigint"
    found = spark.createDataFrame([], ddl)
    for p in parts:
        found = found.unionByName(p)
    found = materialize(found, "links")
    sums = found.where("links is not null").groupBy("id").agg(F.sum("links").cast("long").alias("links"))
    members = rows.where("ok").join(classes.select("v", "rep", "n"), "v")
    same = members.where("id != rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    groups = connected_components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")).unionByName(same))
    per_class = classes.select("v", "rep", "n").join(sums, F.col("rep") == F.col("id"), "left").select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    linked = rows.where("ok").join(per_class, "v").join(groups, F.col("id") == F.col("vertex"), "left")
    linked = linked.select("id", "n_links", F.coalesce("component", "id").alias("component_id"))
    alone = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone)


def _rows(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    return np.concatenate([np.empty(0), *(c.flatten().to_numpy(zero_copy_only=False) for c in chunks)]).reshape(-1, d)


def median_splits(z: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and cut of each inner node of a complete binary tree, in breadth-
    first order: the axis along which the node's part of ``z`` varies most, cut
    at its median."""
    axes, cuts = np.zeros(2**depth - 1, dtype=np.int64), np.zeros(2**depth - 1)
    parts = [z]
    for node in range(2**depth - 1):
        part = parts[node]
        if len(part):
            axes[node] = part.var(axis=0).argmax()
            cuts[node] = np.median(part[:, axes[node]])
        above = part[:, axes[node]] > cuts[node]
        parts += [part[~above], part[above]]
    return axes, cuts


def leaves_of(z: np.ndarray, axes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    node = np.zeros(len(z), dtype=np.int64)
    for _ in range((len(axes) + 1).bit_length() - 1):
        node = 2 * node + 1 + (z[np.arange(len(z)), axes[node]] > cuts[node])
    return node - len(axes)


def in_reach(z: np.ndarray, low: np.ndarray, high: np.ndarray, reach: float) -> np.ndarray:
    """Which boxes (rows of ``low`` and ``high``) come within ``reach`` of each row of ``z``."""
    square = np.zeros((len(z), len(low)))
    for k in range(z.shape[1]):  # one axis at a time: no array of rows x boxes x axes
        gap = np.maximum(0, np.maximum(low[:, k] - z[:, k : k + 1], z[:, k : k + 1] - high[:, k]))
        square += gap * gap
    return square <= reach * reach


def _linked(classes: DataFrame, d: int, count: int, least: float) -> DataFrame:
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("v").toPandas()["v"]
    s = _unit(np.array(sample.tolist(), dtype=np.float64).reshape(-1, d))
    _, axes = np.linalg.eigh(s.T @ s - len(s) * np.outer(s.mean(axis=0), s.mean(axis=0)))
    axes = np.ascontiguousarray(axes[:, ::-1])
    lead = min(LEADING, d)
    depth = min(LEAVES, max(1, -(-count // TILE))).bit_length() - 1
    depth += 2**depth < min(LEAVES, -(-count // TILE))
    split, cuts = median_splits(s @ axes[:, :lead], depth)
    names = [f"z{k}" for k in range(lead + 1)]

    def coordinates(column) -> np.ndarray:
        """Leading coordinates and suffix norm."""
        x = _unit(_rows(column, d))
        z = x @ axes[:, :lead]
        return np.column_stack([z, np.sqrt(np.maximum((x * x).sum(axis=1) - (z * z).sum(axis=1), 0))])

    def place(batches):
        for b in batches:
            z = coordinates(b.column(1))
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, z.T), pa.array(leaves_of(z, split, cuts))], ["rep", "v", "n", *names, "leaf"])

    ddl = "rep bigint, v array<double>, n bigint, " + ", ".join(f"{n} double" for n in names) + ", leaf bigint"
    placed = materialize(classes.mapInArrow(place, ddl), "placed")
    # one row for each leaf, of which there are at most LEAVES
    spans = placed.groupBy("leaf").agg(F.count("*").alias("m"), *[f(n).alias(f.__name__ + n) for n in names for f in (F.min, F.max)]).toPandas().sort_values("leaf")
    low, high = (spans[[f + n for n in names]].to_numpy() for f in ("min", "max"))
    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-6
    subs = -(-spans["m"].to_numpy() // TILE)
    start = np.append(0, np.cumsum(subs))  # the parts of a leaf are start[leaf] to start[leaf + 1] - 1
    number = np.full(2**depth, -1)
    number[spans["leaf"].to_numpy()] = np.arange(len(spans))

    def send(batches):
        for b in batches:
            for at in range(0, len(b), SENT):
                part = b.slice(at, SENT)
                leaf = number[part.column("leaf").to_numpy()]
                z = np.column_stack([part.column(n).to_numpy() for n in names])
                own = start[leaf] + part.column("salt").to_numpy() % subs[leaf]
                row, to = np.nonzero(in_reach(z, low, high, reach))
                times = subs[to]  # every part of a leaf in reach
                row, to = np.repeat(row, times), np.repeat(start[to] - np.cumsum(times) + times, times) + np.arange(times.sum())
                for k in range(0, len(row), SENT):
                    r, q = row[k : k + SENT], to[k : k + SENT]
                    i, j, side = np.minimum(own[r], q), np.maximum(own[r], q), (own[r] > q).astype(np.int32)
                    taken = part.select(["rep", "v", "n"]).take(pa.array(r))
                    yield pa.RecordBatch.from_arrays([*taken.columns, *map(pa.array, (i, j, side))], ["rep", "v", "n", "i", "j", "side"])

    salted = placed.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(1 << 31)))
    rows = salted.mapInArrow(send, "rep bigint, v array<double>, n bigint, i bigint, j bigint, side int")

    def one(key, table):
        ids = table.column("rep").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        x = _unit(_rows(table.column("v"), d)[order])
        side = table.column("side").to_numpy()[order]
        weight = table.column("n").to_numpy()[order].astype(np.float64)
        same = key[0].as_py() == key[1].as_py()
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        links, edges = compare(ids, x, x @ axes, weight, left, right, same, least)
        hit = np.flatnonzero(links)
        out = pd.DataFrame({"id": np.append(ids[hit], ids[[e[0] for e in edges]] if edges else ids[:0])})
        out["links"] = np.append(links[hit], np.full(len(edges), np.nan))
        out["other"] = pd.array([None] * len(hit) + ids[[e[1] for e in edges]].tolist() if edges else [None] * len(hit), dtype="Int64")
        return pa.Table.from_pandas(out, schema=pa.schema([("id", pa.int64()), ("links", pa.float64()), ("other", pa.int64())]), preserve_index=False)

    done = rows.groupBy("i", "j").applyInArrow(one, "id bigint, links double, other bigint")
    return done.select("id", F.when(~F.isnan("links"), F.col("links")).alias("links"), "other")


def op6_embedding_neardup(vectors: DataFrame) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    found = link_all(vectors).groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    out = rows.join(found, F.col("vec_id").eqNullSafe(F.col("id")), "left")
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


ORACLE = """
WITH RECURSIVE ok AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a, ok b
  WHERE a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    AND list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.95),
r(v, c) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT e.b, r.c FROM r JOIN e ON e.a = r.v),
m AS (SELECT v, min(c) AS component_id FROM r GROUP BY v),
n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT x.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, m.component_id, x.vec_id = m.component_id AS kept
FROM embeddings x JOIN m ON m.v = x.vec_id LEFT JOIN n ON n.a = x.vec_id
"""
