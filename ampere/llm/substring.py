"""Removal of word sequences that repeat across documents.

A *window* is ``width`` consecutive words of one document. A word goes if some
window that covers it also starts, word for word, in a document with a
smaller doc_id; all windows are judged on the input.

Method: Rabin-Karp hashes of every window are counted in Spark, and repeated
windows merge into maximal removal intervals. Shuffling a hash for every word
of the corpus is avoided without losing a window:

1. Each window is represented by its *anchor*, the smallest of the hashes of
   the shorter ``ANCHOR``-word sequences inside it. Equal windows have equal
   anchors, and neighbouring windows mostly share theirs, so a document has
   about one anchor for 18 words. Spark finds the anchors that occur in two
   documents or more.
2. Only windows with such an anchor are hashed out. A *run* is a maximal
   sequence of neighbouring windows with one anchor; equal runs are collapsed
   to that of the smallest document, whose windows are then counted.
3. A window of a run goes if its run occurs in a smaller document, or if the
   window occurs in a smaller document's run.

Window equality is by 128 bits: the window's hash and its anchor's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.llm import words as W
from ampere.llm.base import forget_tokenizers, keyed_text, materialize, real_id, small_batches

ANCHOR = 16
_NO = np.uint64(0xFFFFFFFFFFFFFFFF)


def _windows(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text column: each window's row, its first word in the row, its
    hash and its anchor; and the words of each row."""
    hashes, offsets = W.hashed_words(column)
    counts = np.diff(offsets)
    anchor = min(ANCHOR, width)
    grams = W.rolling(hashes, anchor)
    least = W.sliding_min(grams, width - anchor + 1)
    whole = W.rolling(hashes, width)
    per_row = np.maximum(counts - width + 1, 0)
    row = np.repeat(np.arange(len(counts)), per_row)
    first = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    at = offsets[:-1][row] + first
    return row, first, whole[at], least[at], counts


def _anchor_batches(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_tokenizers()
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for lo, hi in W.slices(b.column(1)):
                row, _, _, anchor, _ = _windows(b.column(1).slice(lo, hi - lo), width)
                new = np.ones(len(row), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[new].view(np.int64)), pa.array(ids[lo:hi][row[new]])], ["anchor", "id"]
                )

    return run


_RUN = pa.struct([("anchor", pa.int64()), ("run", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary())])
RUN_DDL = "array<struct<anchor:bigint,run:bigint,first:bigint,n:bigint,hashes:binary>>"


def _runs(column: pa.Array, anchors: pa.Array, width: int) -> pa.Array:
    """The runs of each row whose anchor is in the row's list."""
    row, first, whole, anchor, counts = _windows(column, width)
    listed = anchors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    of = np.repeat(np.arange(len(anchors)), np.diff(anchors.offsets.to_numpy()))
    salt = W.mix(np.arange(1, len(counts) + 1, dtype=np.uint64))
    keep = np.isin(anchor ^ salt[row], listed ^ salt[of])
    at = np.flatnonzero(keep)
    row, first, whole, anchor = row[at], first[at], whole[at], anchor[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at))
    sums = np.zeros(len(at) + 1, dtype=np.uint64)
    np.cumsum(whole * W.powers(W._Q, len(at)), out=sums[1:])
    inverse = W.powers(W._Q_INV, len(at) + 1)
    run = W.mix(((sums[end] - sums[begin]) * inverse[begin]) ^ (end - begin).astype(np.uint64))
    offsets = np.append(begin, len(at)) * 8
    hashes = pa.Array.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(whole))]
    ).cast(pa.binary())
    values = pa.StructArray.from_arrays(
        [pa.array(anchor[begin].view(np.int64)), pa.array(run.view(np.int64)), pa.array(first[begin].astype(np.int64)), pa.array((end - begin).astype(np.int64)), hashes],
        fields=list(_RUN),
    )
    per_row = np.bincount(row[begin], minlength=len(counts))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per_row)).astype(np.int32)), values)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal intervals covering ``[start, end)`` spans."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def digest(text: str | None, spans: list[tuple[int, int]]) -> dict:
    """Counts of words, and the hash of the kept ones joined by one space."""
    found = (text or "").encode().split()  # bytes: ASCII white space only
    kept, at = [], 0
    for s, e in spans:
        kept += found[at:s]
        at = e
    kept += found[at:]
    return {"n_words": len(found), "n_removed": len(found) - len(kept), "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest()}


DIGEST_DDL = "struct<n_words:bigint,n_removed:bigint,kept_sha256:string>"


def rewrite(text: str | None, spans: list[tuple[int, int]]) -> dict:
    """The text without the spans' words; the white space between kept words
    stays, and where a span goes, that in front of it. Texts without a span
    are unchanged."""
    if not spans:
        return {"text": text, "n_kept": None if text is None else len(text.encode().split())}
    raw = (text or "").encode()
    starts, ends = W.word_spans(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
    parts, at = [], 0
    for s, e in spans:
        if s > at:
            parts.append(raw[(starts[at] if not at else ends[at - 1]) : ends[s - 1]])
        at = e
    if at < len(starts):
        parts.append(raw[ends[at - 1] :])
    kept = b"".join(parts).strip(W.SEPARATORS)
    return {"text": kept.decode(), "n_kept": len(kept.split())}


REWRITE_DDL = "struct<text:string,n_kept:bigint>"


def _finish(rows, spans, how: Callable, kind: pa.DataType) -> pa.Array:
    return pa.array([how(t, merged([(x["s"], x["e"]) for x in s or []])) for t, s in zip(rows, spans)], type=kind)


def _arrow_of(ddl: str) -> pa.StructType:
    names = {"bigint": pa.int64(), "string": pa.string()}
    return pa.struct([(f.split(":")[0], names[f.split(":")[1]]) for f in ddl[7:-1].split(",")])


def remove_repeats(
    docs: DataFrame,
    how: Callable = rewrite,
    result: str = REWRITE_DDL,
    carry: list[str] | None = None,
    width: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: ``row`` (a struct of the ``carry`` columns) and
    ``result``, what ``how(text, removal intervals in words)`` returns.

    Null and empty texts have no words and no windows. Rows that share a
    doc_id do not remove each other's words, as neither id is the smaller;
    null ids count as larger than all numbers, and as equal. Rows with a null
    id are still kept apart by their texts, so no task gathers all of them. The whole of every text is
    used, and nothing depends on other columns.
    """
    carry = list(carry or [])
    kind = _arrow_of(result)
    at, key, content = keyed_columns(doc_id, text)
    apart = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.xxhash64(F.lit("null"), F.col(f"`{text}`"))).alias("id")
    base = docs.select(
        apart, key, content, F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(0).alias("__")).alias("row"), at.alias("at")
    )

    anchors = materialize(
        base.select("id", "text").mapInArrow(_anchor_batches(width), "anchor bigint, id bigint"), "anchors"
    )
    shared = materialize(
        anchors.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("anchor"),
        "shared",
    )
    listed = anchors.join(shared, "anchor").groupBy("id").agg(F.collect_set("anchor").alias("anchors"))
    empty = F.array().cast("array<bigint>")
    joined = base.join(listed, "id", "left").select("id", "key", "text", "row", F.coalesce("anchors", empty).alias("anchors"), "at")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_tokenizers()
        for b in batches:
            for lo, hi in W.slices(b.column(2)):
                part = b.slice(lo, hi - lo)
                texts = part.column(2)
                flagged = pa.array(np.diff(part.column(4).offsets.to_numpy()) > 0)
                runs = _runs(texts, part.column(4), width) if flagged.true_count else pa.array([[]] * len(part), type=pa.list_(_RUN))
                pairs = list(zip(texts.to_pylist(), flagged.to_pylist()))
                told = [None if f else how(t, []) for t, f in pairs]
                later = pa.array([t if f else None for t, f in pairs], type=pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), later, part.column(3), runs, pa.array(told, type=kind), part.column(5)],
                    ["id", "key", "text", "row", "runs", "result", "at"],
                )

    row_ddl = base.schema["row"].dataType.simpleString()
    state = materialize(
        joined.mapInArrow(split, f"id bigint, key bigint, text string, row {row_ddl}, runs {RUN_DDL}, result {result}, at bigint"), "state", "zstd"
    )
    runs = state.where("result is null").select("id", "key", "at", F.inline("runs"))
    groups = materialize(
        runs.groupBy("anchor", "run").agg(F.min("at").alias("rep"), F.first("hashes").alias("hashes")), "runs"
    )

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_tokenizers()
        for b in batches:
            sizes = pc.binary_length(b.column(3)).to_numpy() // 8
            found = np.frombuffer(b"".join(b.column(3).to_pylist()), dtype=np.int64)
            at = np.repeat(np.arange(len(sizes)), sizes)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            cols = [b.column(i).to_numpy(zero_copy_only=False)[at] for i in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*cols, nth, found)], ["anchor", "run", "rep", "nth", "window"])

    windows = groups.select("anchor", "run", "rep", "hashes").mapInArrow(
        explode, "anchor bigint, run bigint, rep bigint, nth bigint, window bigint"
    )
    repeated = materialize(
        windows.groupBy("window", "anchor").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("window", "anchor", "lo"),
        "windows",
    )
    partly = (
        windows.join(repeated, ["window", "anchor"]).where("lo < rep").groupBy("anchor", "run").agg(F.collect_list("nth").alias("nths"))
    )
    verdicts = materialize(groups.select("anchor", "run", "rep").join(partly, ["anchor", "run"], "left"), "verdicts")

    whole = F.array(F.struct(F.col("first").alias("s"), (F.col("first") + F.col("n") + (width - 1)).alias("e")))
    some = F.transform("nths", lambda j: F.struct((F.col("first") + j).alias("s"), (F.col("first") + j + width).alias("e")))
    spans = (
        runs.drop("hashes").join(verdicts, ["anchor", "run"]).where("at > rep or nths is not null")
        .select("id", "key", F.when(F.col("at") > F.col("rep"), whole).otherwise(some).alias("part"))
        .groupBy("id", "key").agg(F.flatten(F.collect_list("part")).alias("spans"))
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_tokenizers()
        for b in batches:
            told = _finish(b.column(0).to_pylist(), b.column(2).to_pylist(), how, kind)
            yield pa.RecordBatch.from_arrays([b.column(1), told], ["row", "result"])

    flagged = (
        state.where("result is null").select("id", "key", "text", "row").join(spans, ["id", "key"], "left")
        .select("text", "row", "spans").mapInArrow(finish, f"row {row_ddl}, result {result}")
    )
    return state.where("result is not null").select("row", "result").unionByName(flagged)


def keyed_columns(doc_id: str, text: str) -> list:
    """``keyed_text``'s columns, to select beside others."""
    return [
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(2**63 - 1)).alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("key"),
        F.col(f"`{text}`").alias("text"),
    ]


def op3_substring_dedup(docs: DataFrame, width: int = 50) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    out = remove_repeats(docs, digest, DIGEST_DDL, ["doc_id"], width)
    return out.select("row.doc_id", "result.n_words", "result.n_removed", "result.kept_sha256")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages, ``n_chars`` counted anew;
    documents that had words and of which none is left go."""
    small_batches(spark)
    out = remove_repeats(docs, rewrite, REWRITE_DDL, docs.columns)
    changed = {"text": F.col("result.text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("result.text").cast(docs.schema["n_chars"].dataType)
    kept = (F.col("result.n_kept") > 0) | F.col("result.text").eqNullSafe(F.col("row.text"))
    return out.where(kept).select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


#: DuckDB has the windows as joined strings; the same rule stated plainly.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
n AS (SELECT doc_id, words, len(words) AS n_words FROM d),
w AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i+49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(generate_series(1, n_words - 49)) AS i FROM n WHERE n_words >= 50)),
m AS (SELECT h, min(doc_id) AS lo FROM w GROUP BY h),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS i FROM w JOIN m USING (h) WHERE lo < doc_id),
k AS (
  SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.i) FILTER (WHERE c.i IS NULL) AS kept, count(c.i) AS n_removed
  FROM (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, n_words)) AS i FROM n) u
  LEFT JOIN c ON c.doc_id = u.doc_id AND c.i = u.i GROUP BY u.doc_id)
SELECT n.doc_id, n.n_words::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM n LEFT JOIN k USING (doc_id)
"""
