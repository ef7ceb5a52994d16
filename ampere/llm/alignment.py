"""Alignment of two tokenizations of the same text, by interval coalescing.

Every token covers a range of the text's bytes. All ranges of both sides are
sorted by start (``lexsort``) and their ends are accumulated to a running
maximum; a group ends where the next range starts at that maximum, which is
where tokens of both sides end. Within a group, each A token is expanded to the
B tokens whose ranges overlap its own.

Neither side has a token that goes on from a character into the blank, tab or
line feed behind it, or from a letter into the mark behind it, so a text falls
into words (white space and what follows it, or marks and what follows them)
that are aligned apart. What a word's alignment leaves is remembered in a
bounded table, so that the common words of a language are aligned once; new
words are aligned together, many at a time. Texts are taken in slices small
enough that a slice's words are still in the processor's cache when they are
put together.

The links of an id pair are counted over the whole corpus. Pairs that hold at
least one ``HEAVY``-th of all links, of which there are at most ``HEAVY``, are
joined by a broadcast whose size that bounds; no other pair can be hot, and
those are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampere.llm.base import materialize
from ampere.llm.packing import Encoder
from ampere.llm.pieces import byte_level

#: The most pairs that a broadcast can hold.
HEAVY = 1 << 17
#: Texts are taken together, and new words encoded together, up to so many characters (one at least).
SLICE_CHARS, CHUNK_CHARS = 1 << 17, 1 << 13
#: Remembered words, and parts of unsettled words on side A; a longer word is aligned anew each time.
REMEMBERED, PARTS, LONGEST = 500_000, 50_000, 64

_SPACE = "▁"
_UNMET = object()


#: A word ends before one of these that follows a character which is no white space.
BREAKS = " \t\n"
#: A word also ends before one of these that follows one of the letters.
MARKS, LETTERS = ".,;:!?", "A-Za-z"
#: A word that any other may stand before, and a mark behind.
BEFORE_MARK = " a"
#: What a word's alignment leaves, in units of ``Pair.word``: its links (id pairs), which have the top bit set, and its
#: groups as written, which do not, with ``COMMA`` for A's commas and filled up with NUL.
Told = bytes
COMMA = b"\x01"
_COMMAS = bytes.maketrans(COMMA, b",")


class Pair:
    """The two tokenizers, and for each id its bytes and its decimal digits."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        import sentencepiece

        self.a = Encoder(a_path, pattern, PARTS)
        to_byte = byte_level()
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (1 + max(vocabulary.values(), default=-1))
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(to_byte[c] for c in entry) if all(c in to_byte for c in entry) else entry.encode()
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.space = self.pieces.piece_to_id(_SPACE)
        self.split = re.compile(self._breaks()).split
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.bits_b = (len(self.b_bytes) - 1).bit_length()
        self.bits = (len(self.a_bytes) - 1).bit_length() + self.bits_b
        self.word = np.dtype("<u4" if self.bits < 32 else "<u8")
        self.top = self.word.type(1 << (8 * self.word.itemsize - 1))
        # a token's digits and what stands behind them: within a side (A, B) or at its end
        digits = [b"%d" % i for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.step = len(digits)
        self.written = np.array([d + c for c in (COMMA, b"|", b",", b";") for d in digits])  # filled up with NUL
        self.written_len = np.char.str_len(self.written)
        self.known: dict[str, Told | None] = {}
        self.old: dict[str, Told | None] = {}  # met before those, and not since
        self.most, self.longest = REMEMBERED, LONGEST

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(_SPACE, " ").encode()

    def _breaks(self) -> str:
        """Where texts fall into words, which no token of either side goes across."""
        # a break that stands behind a character within a token, or behind the space a piece begins with, is none
        inner = [(x.decode("utf-8", "replace"), before) for of, before in ((self.a_bytes, r"\S"), (self.b_bytes, r"[\S ]")) for x in of]
        blanks = [c for c in BREAKS if not any(c in x and re.search((r"\S" if c == " " else before) + c, x) for x, before in inner)]
        marks = [c for c in MARKS if not any(c in x and re.search(f"[{LETTERS}]{re.escape(c)}", x) for x, _ in inner)]
        self.marks = frozenset(marks if " " in blanks and self._encoded(BEFORE_MARK) else ())
        if not blanks:
            return "(?!)"
        blank, mark = "".join(blanks), "".join(self.marks)
        behind_letter = f"|(?<=[{LETTERS}])(?=[{mark}])" if mark else ""
        return rf"(?=[{blank}{mark}])(?:(?<=\S)(?=[{blank}]){behind_letter})"  # what is behind a place is looked at only where need be

    def _encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides; None where one does not give the text back."""
        a = self.a.fresh(text).astype(np.int64)
        # the pieces begin with a space of their own, which a text that begins with one has instead
        spaced = text.startswith(" ")
        b = np.array(self.pieces.encode(text[1:] if spaced else text) or [self.space], dtype=np.int64)
        b = b if spaced else b[1:]
        raw = text.encode()
        faithful = all(b"".join(map(of.__getitem__, ids.tolist())) == raw for of, ids in ((self.a_bytes, a), (self.b_bytes, b)))
        return (a, b) if faithful else None

    def align(self, words: list[str]) -> dict[str, Told | None]:
        """For each word what its alignment leaves; None if a side does not give
        it back."""
        out: dict[str, Told | None] = {}
        apart = {w for w in words if w[-1].isspace()}  # would run into the white space of the next one
        for w in apart:
            out |= self._aligned([w])
        settled, others = [], []
        for w in words:
            if w not in apart:
                (settled if self.a.settled(w) else others).append(w)
        for kind in (settled, others):
            at, ends = 0, np.cumsum([len(w) for w in kind])
            while at < len(kind):
                to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_CHARS)) + 1
                out |= self._aligned(kind[at:to])
                at = to
        return out

    def _aligned(self, words: list[str]) -> dict[str, Told | None]:
        marked = [w for w in words if w[0] in self.marks]
        together = words if not marked else [w for w in words if w[0] not in self.marks]
        for w in marked:
            together += (BEFORE_MARK, w)
        text = "".join(together)
        ids = self._encoded(text)
        if ids is None:
            half = len(words) // 2
            return self._aligned(words[:half]) | self._aligned(words[half:]) if half else {words[0]: None}
        a, b = ids
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        a_start, b_start = a_end - self.a_len[a], b_end - self.b_len[b]
        a_group, b_group = coalesce(a_start, a_end, b_start, b_end)
        left, right = overlaps(a_start, a_end, a_group, b_start, b_end, b_group)
        a_last, b_last = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (a_group, b_group))
        code = np.concatenate([a + self.step * a_last, b + self.step * (2 + b_last)])
        code = code[np.argsort(np.concatenate([a_group, b_group]), kind="stable")]  # A's before B's within a group
        written = np.frombuffer(self.written[code].tobytes().translate(None, b"\0"), dtype=np.uint8)
        links = ((a[left] << self.bits_b) | b[right]).astype(self.word) | self.top
        # words end where groups end, so everything is cut by the words' bytes
        ends = np.cumsum(list(map(len, together if text.isascii() else map(str.encode, together))))
        a_to, b_to = np.searchsorted(a_end, ends, side="right"), np.searchsorted(b_end, ends, side="right")
        n_written = np.diff(np.append(0, np.cumsum(self.written_len[code]))[a_to + b_to], prepend=0)
        n_links = np.diff(np.searchsorted(left, a_to, side="left"), prepend=0)
        wide = self.word.itemsize
        size = n_links - -n_written // wide
        start = np.cumsum(size) - size
        out = np.zeros(int(size.sum()), dtype=self.word)
        out[runs(start, n_links)] = links
        out.view(np.uint8)[runs(wide * (start + n_links), n_written)] = written
        raw, to = out.tobytes(), (wide * np.cumsum(size)).tolist()
        return {w: raw[i:j] for w, i, j in zip(together, [0, *to], to)}

    def texts(self, texts: list[str | None]) -> list[list[Told]]:
        """The words of each text; none where a side's bytes are not those of
        space and text. U+2581 in a text reads as a space in B."""
        words = [self.split(" " + t) if t and _SPACE not in t else [] for t in texts]
        flat = list(chain.from_iterable(words))
        found = list(map(self.known.get, flat, repeat(_UNMET)))
        gone = [i for i, told in enumerate(found) if told is _UNMET]
        if gone:
            learned = self._learned({flat[i] for i in gone})
            for i in gone:
                found[i] = learned[flat[i]]
        out, at = [], 0
        for w in words:
            told = found[at : at + len(w)]
            out.append([] if None in told else told)
            at += len(w)
        return out

    def _learned(self, new: set[str]) -> dict[str, Told | None]:
        if len(self.known) + len(new) > self.most // 2:
            self.old, self.known = self.known, {}
        out = {w: self.old[w] for w in new if w in self.old}
        out |= self.align([w for w in new if w not in out])
        self.known |= {w: told for w, told in out.items() if len(w) <= self.longest}
        return out


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and of each B range, numbered in text order."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order]) if len(order) else end
    new = np.ones(len(order), dtype=bool)
    new[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    return group[: len(a_start)], group[len(a_start) :]


def overlaps(a_start, a_end, a_group, b_start, b_end, b_group) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping pairs of an A and a B range; no pair leaves a group, so
    each A range looks only at its group's B ranges."""
    low, high = np.searchsorted(b_group, a_group, side="left"), np.searchsorted(b_group, a_group, side="right")
    first = np.maximum(low, np.searchsorted(b_end, a_start, side="right"))
    beyond = np.minimum(high, np.searchsorted(b_start, a_end, side="left"))
    n = np.maximum(beyond - first, 0)
    return np.repeat(np.arange(len(a_start)), n), runs(first, n)


def runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The ``n`` numbers from each ``start`` on, one run behind the other."""
    return np.arange(int(n.sum())) + np.repeat(start - np.cumsum(n) + n, n)


_PAIRS: dict[tuple[str, str, str], Pair] = {}
NAMES = ["n_a", "n_b", "n_groups", "n_links"]


def _align(pair: Pair, texts: list[str | None]):
    """Per text the counts of ``NAMES``, the groups' hash, and the id pairs
    that it links with their number of links."""
    counts, hashes, links = [], [], []
    for told in pair.texts(texts):
        words = np.frombuffer(b"".join(told), dtype=pair.word)
        link = words >= pair.top
        links.append((words[link] ^ pair.top).astype(np.int64))
        written = words[~link].tobytes()
        groups = written.count(b";")
        counts.append((written.count(COMMA) + written.count(b"|"), written.count(b",") + groups, groups, len(links[-1])))
        hashes.append(hashlib.sha256(written.translate(_COMMAS, b"\0")[:-1]).hexdigest() if told else "")
    n, per_doc = len(texts), [len(x) for x in links]
    key = np.concatenate([*links, np.empty(0, dtype=np.int64)]) | (np.repeat(np.arange(n), per_doc) << pair.bits)
    key, times = np.unique(key, return_counts=True)
    offsets = pa.array(np.append(0, np.cumsum(np.bincount(key >> pair.bits, minlength=n))).astype(np.int32))
    ids = ((key & ((1 << pair.bits) - 1)) >> pair.bits_b, key & ((1 << pair.bits_b) - 1), times)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in ids]
    return list(np.array(counts, dtype=np.int64).reshape(-1, len(NAMES)).T), hashes, lists


def aligned(docs: DataFrame, a_path: str, b_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, a, b, n)`` for
    each row; ``a``, ``b`` and ``n`` are its linked id pairs and how often."""
    kind = docs.select(f"`{doc_id}`").schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = (a_path, b_path, pattern)
        if names not in _PAIRS:
            _PAIRS[names] = Pair(*names)
        for batch in batches:
            at, texts = 0, batch.column(1)
            while at < len(texts):
                to, chars, part = at, 0, []
                while to < len(texts) and (to == at or chars < SLICE_CHARS):
                    part.append(texts[to].as_py())
                    chars += len(part[-1] or "")
                    to += 1
                counts, hashes, lists = _align(_PAIRS[names], part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), *map(pa.array, counts), pa.array(hashes, pa.string()), *lists],
                    ["doc_id", *NAMES, "groups_sha256", "a", "b", "n"],
                )
                at = to

    ddl = f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in NAMES) + ", groups_sha256 string, a array<int>, b array<int>, n array<int>"
    return docs.select(f"`{doc_id}`", f"`{text}`").mapInArrow(run, ddl)


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, heavy: int = HEAVY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256)`` for each row of ``docs``.

    Texts that are null, empty, or not given back byte for byte by both
    tokenizers have no tokens: zeros and an empty ``groups_sha256``. Equal
    rows, and rows that share a doc_id, each have a row of their own and each
    count in the corpus. All counts that tie for a B id's highest are best.
    """
    rows = materialize(aligned(docs, a_path, b_path, pattern, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "aligned")
    # one row per document and pair; the inner arrays have the same length
    links = rows.select("row", F.inline(F.arrays_zip("a", "b", "n"))).select("row", "a", "b", F.col("n").cast("bigint").alias("n"))
    counted = materialize(links.groupBy("a", "b").agg(F.sum("n").alias("count")), "pairs")
    most = counted.groupBy("b").agg(F.max("count").alias("most"))  # at most one row per entry of B's vocabulary
    scored = counted.join(F.broadcast(most), "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    total = counted.agg(F.sum("count")).first()[0] or 0
    bound = max(1, -(-total // heavy))  # at most `heavy` pairs can hold as many links
    hot, cold = scored.where(F.col("count") >= bound), scored.where(F.col("count") < bound)
    met = links.join(F.broadcast(hot), ["a", "b"], "left")
    sums = [F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")]
    parts = met.where("count is not null").groupBy("row").agg(*sums)
    if total >= heavy:  # else the bound is one link, and every pair holds it
        rest = met.where("count is null").select("row", "a", "b", "n").join(cold, ["a", "b"])
        parts = parts.unionByName(rest.groupBy("row").agg(*sums))
    per_row = parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = rows.select("row", "doc_id", *NAMES, "groups_sha256").join(per_row, "row", "left")
    zero = F.lit(0).cast("bigint")
    return out.select("doc_id", *NAMES, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op12_alignment(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Per document: the tokens of a byte-level and of a piece vocabulary, their
    groups and links, and how the links rank over the corpus.

    Null, empty and unfaithful texts, ties and repeated rows as in ``align``;
    long texts are aligned whole; an empty table gives no rows; extra columns
    are not read.
    """
    import public_tokenizers as tokenizers

    a, b = a_path or tokenizers.path("byte_bpe_50k.json"), b_path or tokenizers.path("piece_bpe_32k.model")
    return align(docs, a, b, tokenizers.PATTERN).select(F.col("doc_id").cast("long").alias("doc_id"), *NAMES, "n_best", "count_sum", "groups_sha256")
