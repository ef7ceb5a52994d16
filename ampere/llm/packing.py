"""Vector bin packing of tokenised texts into training sequences.

A sequence has three limits at once: tokens, segments (pieces of texts) and
loss-bearing tokens. Each task packs the texts it reads, block by block, by
the dot-product heuristic: the open sequence takes the piece whose demand,
relative to the limits and weighted by how scarce each is in the block, has
the largest dot product with what the sequence has left. Where no whole piece
fits and cutting is allowed, the largest one is cut to fill the rest. The
last sequence of a block stays open for the next; that of a task is cut into
sequences whose lengths are powers of two, which need no padding.

Nothing is shuffled, and a task holds one block of ids at a time. Sequence
numbers carry the task's partition, so a task that is run again for a lost
executor gives the same numbers.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ampere.llm.base import small_batches
from ampere.llm.pieces import byte_level, splitter

#: What the byte-level pre-tokenizer of the tokenizers library cuts at.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Below this, Unicode's classes are the same in all versions in use.
SETTLED = "\u0530"
#: About so many pre-tokens are looked up together, while they are in the processor's cache.
PART = 3_000


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 512
    loss: int = 2048


@dataclass
class Example:
    """Ids as little-endian 32-bit words; the first ``quiet`` bear no loss."""

    key: object
    ids: bytes
    quiet: int = 0

    def __len__(self) -> int:
        return len(self.ids) // 4


@dataclass
class Sequence:
    limits: Limits
    pieces: list[tuple[Example, int, int]] = field(default_factory=list)
    tokens: int = 0
    loss: int = 0

    def add(self, e: Example, start: int, length: int) -> None:
        self.pieces.append((e, start, length))
        self.tokens += length
        self.loss += _loss(e, start, length)

    def left(self) -> np.ndarray:
        x = self.limits
        return np.array([x.tokens - self.tokens, x.segments - len(self.pieces), x.loss - self.loss])


def _loss(e: Example, start: int, length: int) -> int:
    return max(0, start + length - max(start, e.quiet))


#: The demand of a placed example, which fits nowhere else.
_PLACED = 1e18


def pack(examples: list[Example], opened: Sequence, limits: Limits, cut: bool) -> Iterator[Sequence]:
    """Full sequences, and last the one that stays open."""
    caps = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
    items: list[tuple[Example, int]] = []  # example, first id not placed
    for e in examples:
        start, n = 0, len(e)
        while n - start >= limits.tokens or _loss(e, start, n - start) > limits.loss:
            length = min(n - start, limits.tokens)
            while _loss(e, start, length) > limits.loss:  # the quiet ids stand first
                length -= _loss(e, start, length) - limits.loss
            whole = Sequence(limits)
            whole.add(e, start, length)
            yield whole
            start += length
        if start < n:
            items.append((e, start))
    placed = 0
    demand = np.array([(len(e) - s, 1, _loss(e, s, len(e) - s)) for e, s in items], dtype=np.float64).reshape(-1, 3)
    scarce = demand.sum(axis=0) / caps**2
    demand = np.ascontiguousarray(demand.T)  # one row per limit
    seq = opened
    while items:
        left = seq.left()
        score = (scarce * left / caps) @ demand
        score[(demand[0] > left[0]) | (demand[1] > left[1]) | (demand[2] > left[2])] = -1
        i = int(score.argmax())
        if score[i] >= 0:
            e, s = items[i]
            seq.add(e, s, len(e) - s)
            demand[0, i] = _PLACED
            placed += 1
            if 2 * placed > len(items):
                keep = np.flatnonzero(demand[0] < _PLACED)
                items, demand, placed = [items[j] for j in keep], np.ascontiguousarray(demand[:, keep]), 0
            continue
        if cut and left.min() > 0:
            i = int(np.where(demand[0] < _PLACED, demand[0], -1).argmax())
            e, s = items[i]
            length = int(min(left[0], len(e) - s))
            length -= max(0, _loss(e, s, length) - int(left[2]))
            if length > 0:
                seq.add(e, s, length)
                s += length
                items[i] = (e, s)
                demand[:, i] = len(e) - s, 1, _loss(e, s, len(e) - s)
                if seq.tokens < limits.tokens:
                    continue
        yield seq
        seq = Sequence(limits)
    yield seq


def powers_of_two(seq: Sequence) -> Iterator[Sequence]:
    """A sequence cut into ones whose lengths are powers of two."""
    todo = list(reversed(seq.pieces))
    left = seq.tokens
    while left:
        size = 1 << (left.bit_length() - 1)
        out = Sequence(seq.limits)
        while out.tokens < size:
            e, s, n = todo.pop()
            take = min(n, size - out.tokens)
            out.add(e, s, take)
            if take < n:
                todo.append((e, s + take, n - take))
        left -= size
        yield out


class Encoder:
    """Ids of whole texts; those of each pre-token come from the tokenizer
    once and are remembered, as the vocabulary never joins pre-tokens. When
    half of ``most`` pre-tokens are new, the older half is let go."""

    def __init__(self, path: str, pattern: str, most: int = 800_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.split = splitter(pattern)
        self.line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[-1]
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.most = most
        cut = self.tokenizer.pre_tokenizer
        bare = pattern == BYTE_LEVEL and self.tokenizer.normalizer is None and isinstance(cut, pre_tokenizers.ByteLevel)
        # the model takes pre-tokens as they are where the tokenizer does nothing else to them
        self.model = self.tokenizer.model if bare and cut.use_regex and not cut.add_prefix_space else None
        shown = {b: c for c, b in byte_level().items()}
        self.shown = "".join(shown[b] for b in range(255)) + "\n"  # UTF-8 has no byte 255

    def _words(self, pieces: list[str]) -> list[str]:
        """Pre-tokens as the model takes them."""
        return b"\xff".join(map(str.encode, pieces)).decode("latin-1").translate(self.shown).split("\n")

    def _modelled(self, new: list[str]) -> None:
        ids: list[int] = []
        ends: list[int] = []
        tokenize = self.model.tokenize
        for word in self._words(new):
            ids += [t.id for t in tokenize(word)]
            ends.append(4 * len(ids))
        raw, at = np.array(ids, dtype="<u4").tobytes(), 0
        for p, end in zip(new, ends):
            self.known[p] = raw[at:end]
            at = end

    def _tokenized(self, new: list[str]) -> None:
        # many pre-tokens go through the tokenizer as lines of one text; those that hold line feeds do not
        lines = [p for p in new if "\n" not in p and not p.endswith(" ")]
        for at in range(0, len(lines), 2000):
            part = lines[at : at + 2000]
            ids = np.array(self.tokenizer.encode("\n".join(part) + "\n", add_special_tokens=False).ids, dtype="<u4")
            ends = np.flatnonzero(ids == self.line_feed)
            if len(ends) == len(part):
                raw, at = ids.tobytes(), 0
                for p, e in zip(part, ends.tolist()):
                    self.known[p] = raw[at : 4 * e]
                    at = 4 * e + 4
        rest = [p for p in new if p not in self.known]
        for p, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False)):
            self.known[p] = struct.pack(f"<{len(e.ids)}I", *e.ids)

    def _learn(self, new: set[str]) -> None:
        if len(self.known) + len(new) > self.most // 2:
            self.old, self.known = self.known, {}
        self.known |= {p: self.old[p] for p in new if p in self.old}
        rest = [p for p in new if p not in self.known]
        settled = list(filter(self.settled, rest))
        if settled:
            self._modelled(settled)
            rest = [p for p in rest if p not in self.known]
        if rest:
            self._tokenized(rest)

    def settled(self, text: str) -> bool:
        """Whether the model takes the text's pre-tokens as they are."""
        return self.model is not None and (text.isascii() or max(text) < SETTLED)

    def fresh(self, text: str) -> np.ndarray:
        """Ids of a text of words not met before; those of settled texts are not remembered."""
        if text and self.settled(text):
            tokenize = self.model.tokenize
            return np.array([t.id for word in self._words(self.split(text)) for t in tokenize(word)], dtype="<u4")
        return np.frombuffer(self.encode([text])[0], dtype="<u4")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        part: list[list[str]] = []
        size = 0
        for t in texts:
            part.append(self.split(t or ""))
            size += len(part[-1])
            if size >= PART:
                out += self._encoded(part)
                part, size = [], 0
        return out + self._encoded(part)

    def _encoded(self, pieces: list[list[str]]) -> list[bytes]:
        flat = list(chain.from_iterable(pieces))
        found = list(map(self.known.get, flat))
        gone = [i for i, x in enumerate(found) if x is None]
        if gone:
            self._learn({flat[i] for i in gone})
            for i in gone:
                found[i] = self.known[flat[i]]
        out, at = [], 0
        for p in pieces:
            out.append(b"".join(found[at : at + len(p)]))
            at += len(p)
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}
BLOCK_TOKENS = 2_000_000
BLOCK_EXAMPLES = 4096
SLICE_CHARS = 1 << 20


def pack_texts(
    docs: DataFrame,
    path: str,
    pattern: str,
    limits: Limits = Limits(),
    cut: bool = True,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    prompt: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    loss_tokens, sequence_id, offset.

    A text's ids are those of ``prompt`` (which bear no loss) and ``text``,
    null ones counting as empty, and ``end_id``. Texts longer than a sequence
    are always cut; others only if ``cut``.
    """
    kind = docs.select(f"`{doc_id}`").schema[0].dataType.simpleString()
    cols = [f"`{doc_id}`", f"`{text}`", *([f"`{prompt}`"] if prompt else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, pattern) not in _ENCODERS:
            _ENCODERS[path, pattern] = Encoder(path, pattern)
        encoder = _ENCODERS[path, pattern]
        serial = TaskContext.get().partitionId() << 33
        opened, block, size, key_type = Sequence(limits), [], 0, None
        rows: list[tuple] = []

        def place(seq: Sequence) -> None:
            nonlocal serial
            at = 0
            for e, s, n in seq.pieces:
                rows.append((e.key, s, n, zlib.crc32(e.ids[4 * s : 4 * (s + n)]), len(e), _loss(e, s, n), serial, at))
                at += n
            serial += 1

        def flush() -> None:
            nonlocal opened, block, size
            *full, opened = pack(block, opened, limits, cut)
            for seq in full:
                place(seq)
            block, size = [], 0

        def table() -> pa.RecordBatch:
            types = [key_type, *[pa.int64()] * 7]
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)], NAMES)
            rows.clear()
            return out

        for b in batches:
            key_type = b.column(0).type
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            prompts = b.column(2).to_pylist() if prompt else [None] * len(texts)
            at = 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (to == at or chars < SLICE_CHARS):
                    chars += len(texts[to] or "") + len(prompts[to] or "")
                    to += 1
                heads = encoder.encode(prompts[at:to]) if prompt else [b""] * (to - at)
                for key, head, ids in zip(keys[at:to], heads, encoder.encode(texts[at:to])):
                    block.append(Example(key, head + ids + struct.pack("<I", end_id), len(head) // 4))
                    size += len(block[-1])
                at = to
                if size >= BLOCK_TOKENS or len(block) >= BLOCK_EXAMPLES:
                    flush()
                    if rows:
                        yield table()
        flush()
        if opened.pieces:
            for seq in powers_of_two(opened) if cut else [opened]:
                place(seq)
        if rows:
            yield table()

    ddl = f"doc_id {kind}, " + ", ".join(f"`{n}` bigint" for n in NAMES[1:])
    return docs.select(*cols).mapInArrow(run, ddl)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset"]


def op8_packing(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, loss_tokens,
    sequence_id, offset.

    A null or empty text is its end id alone, one piece of one token. Long
    texts are cut into whole sequences; rows that repeat a doc_id or a text
    are packed each; ties of the heuristic go to the row that comes first. An
    empty table gives no rows; other columns are not read. With these limits
    (as many loss-bearing tokens as tokens, 512 segments) only the tokens bind.
    """
    import public_tokenizers as tokenizers

    return pack_texts(docs, path or tokenizers.path("byte_bpe_50k.json"), tokenizers.PATTERN)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences, as ``op8_packing``."""
    small_batches(spark)
    return op8_packing(docs)
