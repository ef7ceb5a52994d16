"""Toxicity by a subsequence string kernel and a support vector machine.

The kernel compares two words by their common subsequences of three letters,
each weighted by ``DECAY`` to the power of the characters it spans, up to
``SPAN``; other characters take up room but never match. An insult with gaps
or inserted characters so keeps most of its likeness. A word's map is divided
by the root of the summed squared weights of its subsequences, which keeps
the kernel positive definite and bounds it.

Nystroem landmarks turn the kernel into features, on which a linear support
vector machine is trained. Its decision is linear in the landmarks' maps, so
it is compiled into one weight for each of the 27**3 letter triples; scoring
a word sums the weights of its triples, and equals the machine's decision.

Labels are known for documents; their sentences take them, and as a toxic
sentence is toxic for some of its words only, a sentence's decision is the
largest of its words', and a document's the largest of its sentences'.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.llm.base import materialize
from ampere.llm.labelled import fold, labelled_sample

#: At most this many labelled documents of either label are fitted on, this
#: many words of each label's sentences are trained on, and this many of them
#: are landmarks.
SAMPLE, WORDS, LANDMARKS = 3000, 3000, 160
DECAY, SPAN, LETTERS = 0.7, 10, 27
THRESHOLD = 0.5

_FOLD = str.maketrans("áàâäãåéèêëíìîïóòôöõúùûüçñýÿ0134$@5", "aaaaaaeeeeiiiiooooouuuucnyyoieasas")
_SPACED = re.compile(r"(?<!\S)(?:\w\s){2,}\w(?!\S)")
_CODE = np.zeros(256, dtype=np.int64)
_CODE[ord("a") : ord("z") + 1] = np.arange(1, 27)


def words_of(text: str) -> set[str]:
    """The distinct words of a text in lower case; a run of single characters
    between white space is a word as well."""
    text = text.lower()
    found = set(text.split())
    for run in _SPACED.findall(text):
        found.add("".join(run.split()))
    return found


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [w.translate(_FOLD).encode("latin-1", "replace") for w in words]
    ends = np.cumsum([len(r) for r in raw]) if raw else np.zeros(0, dtype=np.int64)
    return _CODE[np.frombuffer(b"".join(raw), dtype=np.uint8)], np.append(0, ends).astype(np.int64)


def _triples(codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of distances: where a triple of letters begins within a
    word, which it is, and its weight."""
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(codes))
    letter = codes > 0
    for far in range(2, SPAN):
        at = np.flatnonzero(letter & (room > far))
        at = at[letter[at + far]]
        if not len(at):
            continue
        ends = codes[at] * (LETTERS * LETTERS) + codes[at + far]
        for near in range(1, far):
            mid = codes[at + near]
            yield at, ends + mid * LETTERS, DECAY ** (far + 1)


def _per_word(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.append(0.0, np.cumsum(values))
    return sums[offsets[1:]] - sums[offsets[:-1]]


_MIDDLE = (np.arange(LETTERS**3) // LETTERS) % LETTERS > 0


def maps(words: list[str]) -> np.ndarray:
    """The normalised kernel maps, one row per word."""
    codes, offsets = _codes(words)
    of = np.repeat(np.arange(len(words)), np.diff(offsets))
    out = np.zeros((len(words), LETTERS**3))
    for at, triple, weight in _triples(codes, offsets):
        ok = _MIDDLE[triple]
        np.add.at(out, (of[at[ok]], triple[ok]), weight)
    return out / np.maximum(_norms(codes, offsets), 1e-12)[:, None]


def _norms(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    squares = np.zeros(len(codes))
    for at, triple, weight in _triples(codes, offsets):
        squares[at] += _MIDDLE[triple] * (weight * weight)
    return np.sqrt(_per_word(squares, offsets))


def decide(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of the triples' weights over the norm, for each word; 0 for words
    without three letters. Words are taken in pieces of bounded size."""
    weights = weights * _MIDDLE
    out = np.zeros(len(words))
    for lo in range(0, len(words), 20_000):
        codes, offsets = _codes(words[lo : lo + 20_000])
        sums, squares = np.zeros(len(codes)), np.zeros(len(codes))
        for at, triple, weight in _triples(codes, offsets):
            sums[at] += weights[triple] * weight
            squares[at] += _MIDDLE[triple] * (weight * weight)
        out[lo : lo + 20_000] = _per_word(sums, offsets) / np.maximum(np.sqrt(_per_word(squares, offsets)), 1e-9)
    return out


def fit_machine(positive: list[str], negative: list[str], landmarks: int = LANDMARKS, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """``(weights of the triples, intercept)`` of the support vector machine."""
    marks = positive[: landmarks // 2]
    marks = marks + negative[: landmarks - len(marks)]
    base = maps(marks)
    values, vectors = np.linalg.eigh(base @ base.T)
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # Nystroem: k(x, marks) @ root
    x = np.vstack([maps(positive[i : i + 500]) @ base.T for i in range(0, len(positive), 500)]
                  + [maps(negative[i : i + 500]) @ base.T for i in range(0, len(negative), 500)]) @ root
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.append(np.ones(len(positive)), -np.ones(len(negative)))
    upper = np.where(y > 0, cost * len(negative) / max(len(positive), 1), cost)
    alpha, w, square = np.zeros(len(y)), np.zeros(x.shape[1]), (x * x).sum(axis=1)
    order = np.random.default_rng(7)
    for _ in range(60):  # dual coordinate ascent
        for i in order.permutation(len(y)):
            new = min(max(alpha[i] - (y[i] * (x[i] @ w) - 1) / square[i], 0), upper[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return (root @ w[:-1]) @ base, float(w[-1])


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through decisions and labels, each
    label weighing the same."""
    weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, h = weight * (p - y), weight * p * (1 - p)
        hessian = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hessian, [(g * z).sum() + 1e-3 * a, g.sum()])
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


def decided(docs: DataFrame, weights: np.ndarray, *carry: str) -> DataFrame:
    """The carried columns and ``z``, the largest decision of a text's words
    (0 for a null text or one without words)."""
    n = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for b in batches:
            out: list[float] = []
            texts, at = b.column(n).to_pylist(), 0
            while at < len(texts):
                to, chars, found = at, 0, []
                while to < len(texts) and (to == at or chars < 1 << 20):
                    found.append(words_of(texts[to] or ""))
                    chars += len(texts[to] or "")
                    to += 1
                new = list(set().union(*found).difference(known))
                if len(known) + len(new) > 400_000:
                    known.clear()
                    new = list(set().union(*found))
                known.update(zip(new, decide(new, weights).tolist()))
                out += [max(map(known.__getitem__, w), default=0.0) for w in found]
                at = to
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(out, type=pa.float64())], [*carry, "z"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(*carry, "text").mapInArrow(run, f"{kinds}, z double")


def training_words(sample: DataFrame, most: int = WORDS) -> tuple[list[str], list[str]]:
    """Words that explain the toxic sentences, most telling first, and words
    of clean sentences.

    Candidates are words of toxic sentences that clean ones hardly hold. Not
    all words of a toxic sentence are toxic, so candidates are taken greedily,
    each time the one that most documents without a taken word hold, until
    what a candidate adds could be chance.
    """
    sample = sample.dropDuplicates(["text", "label"])  # copies are no further evidence
    sentences = sample.select("doc_id", "label", F.explode(F.split(F.lower("text"), r"[.!?\n]+")).alias("s"))
    words = sentences.select("doc_id", "label", F.explode(F.array_distinct(F.split("s", r"\s+"))).alias("w"))
    words = words.withColumn("w", F.regexp_replace("w", r"^[^\p{L}]+|[^\p{L}]+$", "")).where("char_length(w) >= 3").distinct()
    words = materialize(words, "words")
    counts = words.groupBy("w").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    odds = F.log((F.col("toxic") + 0.5) / (n.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (n.get(0, 0) + 1))
    counts = materialize(counts.withColumn("odds", odds), "counts")
    likely = counts.where("toxic >= 3 and odds >= ln(8)").orderBy(F.desc("toxic"), "w").limit(most)
    held = words.where("label = 1").join(F.broadcast(likely.select("w", "odds")), "w").select("w", "doc_id", "odds").collect()
    having: dict[str, set] = {}
    for r in held:
        having.setdefault(r["w"], set()).add(r["doc_id"])
    positive: list[str] = []
    while having:
        w = max(having, key=lambda x: (len(having[x]), x))
        found = having.pop(w)
        if len(found) < max(2, 0.005 * n.get(1, 0)):
            break
        positive.append(w)
        having = {x: d - found for x, d in having.items()}
    negative = counts.where("clean >= 1 and odds < ln(8)").orderBy(F.xxhash64("w"), "w").limit(most).collect()
    return positive, [r["w"] for r in negative]


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[np.ndarray, float, float]:
    """``(weights, slope, offset)``: a text's probability is the logistic
    curve of slope times its decision plus offset. With no telling word or one
    label only, all texts get that label's smoothed share."""
    sample = materialize(labelled_sample(docs, labels, "toxic", most), "sample")
    positive, negative = training_words(sample)
    if not positive or not negative:
        r = sample.agg(F.sum("label").alias("s"), F.count("*").alias("n")).first()
        share = ((r["s"] or 0) + 0.5) / (r["n"] + 1)
        return np.zeros(LETTERS**3), 0.0, float(np.log(share / (1 - share)))
    weights, intercept = fit_machine(positive, negative)
    rows = decided(sample, weights, "label").toPandas()
    slope, offset = platt(rows["z"].to_numpy() + intercept, rows["label"].to_numpy())
    return weights, slope, offset + slope * intercept


def op5_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Null and empty texts have no words and the score of the offset; long texts
    count whole. A row is scored by its text alone, so ties and repeated rows
    score alike; a null doc_id is not held out. An empty table gives no rows;
    other columns are not read. Labels with a null id or value teach nothing.
    """
    weights, slope, offset = train(docs, labels)
    z = decided(docs.select("doc_id", "text"), weights, "doc_id")
    score = 1.0 / (1.0 + F.exp(-(F.col("z") * slope + offset)))
    return z.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        score.alias("score"),
        F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
