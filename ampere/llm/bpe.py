"""Byte-level BPE as a finite-state transducer, and streaming decoding.

The merges are compiled, as far as texts need them, into a deterministic
transducer over bytes. Its state is the last token emitted and the bytes not
yet decided; a transition reads a byte and emits the tokens that no
continuation can change. Which token ends the encoding of a prefix follows
from the shorter prefixes: exactly one vocabulary entry that is a suffix of
the prefix fits behind the token which ends the rest, where a pair of tokens
fits if merging their joined bytes gives just that pair. A position may still
become a token boundary only while the bytes behind it begin some entry, so
the lookahead is bounded by the longest entry.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from ampere.llm.pieces import Memo, splitter


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Byte-pair merging by its definition: join the leftmost pair of lowest
    rank until no pair is in the vocabulary."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """``encode(piece)`` is the ids of one pre-token's bytes.

    States are compiled when first met, up to ``most_states``; where a piece
    needs another one then, its rest is simulated without them, with the same
    result.
    """

    def __init__(self, ranks: dict[bytes, int], most_states: int = 20_000):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.prefixes = {t[:i] for t in ranks for i in range(1, len(t))}
        self.reach: dict[bytes, int] = {}  # by three bytes, the longest entry that they begin
        for t in sorted(ranks, key=len):
            self.reach[t[:3]] = len(t)
        self.most_states = most_states
        self.tokens = {i: t for t, i in ranks.items()}
        self.whole: dict[bytes, bool] = {}
        self.fitting: dict[int, bool] = {}  # by left id and id; -1: nothing in front
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = (None, b"", (), (0,))
        # last token emitted, undecided bytes, the token that ends at each of them, where one may begin
        self.states = [start]
        self.number = {start[:3]: 0}
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.ends: dict[int, tuple[int, ...]] = {}

    def _reachable(self, token: bytes) -> bool:
        """Whether merging yields ``token`` from its own bytes."""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = merge(token, self.ranks) == [token]
        return known

    def _fits(self, left: bytes | None, token: bytes) -> bool:
        if left is None:
            return True
        known = self.pairs.get((left, token))
        if known is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            known = self.pairs[left, token] = merge(left + token, self.ranks) == [left, token]
        return known

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        before, waiting, last, live = self.states[state]
        waiting += bytes((byte,))
        n = len(waiting)
        ranks, whole, pairs = self.ranks, self.whole, self.pairs
        for size in range(1, min(n, self.longest) + 1):
            token = waiting[n - size :]
            if token in ranks and (whole.get(token) or self._reachable(token)):
                left = last[n - size - 1] if n > size else before
                fits = pairs.get((left, token))
                if fits or fits is None and self._fits(left, token):
                    last += (token,)
                    break
        else:
            raise ValueError("the vocabulary lacks a byte")
        live = tuple([i for i in live if waiting[i:] in self.prefixes])  # where a longer token may still begin
        path = [n]
        while path[-1]:
            path.append(path[-1] - len(last[path[-1] - 1]))
        for i in live:  # keep the boundaries that all these share
            have = {i}
            while i:
                i -= len(last[i - 1])
                have.add(i)
            path = [x for x in path if x in have]
        sure = path[0]
        emitted = []
        i = sure
        while i:
            emitted.append(ranks[last[i - 1]])
            i -= len(last[i - 1])
        live = (*(i - sure for i in live), n - sure)
        # what is in front matters only while a token may still begin right behind it
        key = ((last[sure - 1] if sure else before) if live[0] == 0 else b"", waiting[sure:], last[sure:])
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append((*key, live))
        move = self.moves[state << 8 | byte] = (to, tuple(reversed(emitted)))
        return move

    def _end(self, state: int) -> tuple[int, ...]:
        _, waiting, last, _ = self.states[state]
        out, i = [], len(waiting)
        while i:
            out.append(self.ranks[last[i - 1]])
            i -= len(last[i - 1])
        self.ends[state] = tuple(reversed(out))
        return self.ends[state]

    def _simulate(self, piece: bytes, at: int, out: list[int]) -> list[int]:
        """The same run without the deterministic states, from a boundary on
        behind which ``out`` is sure: the longest entry that fits is tried
        first, and where nothing fits behind it, the next shorter one. A place
        from which there is no way on has one token in front of it whichever
        way it is reached, so it is left for good."""
        ranks, fitting, reach, n = self.ranks.get, self.fitting, self.reach.get, len(piece)
        sizes: list[int] = []
        dead: set[int] = set()
        left = out[-1] if out else -1
        size = min(n - at, reach(piece[at : at + 3], 2))
        while at < n:
            token = piece[at : at + size]
            i = ranks(token)
            if i is not None and at + size not in dead:
                fits = fitting.get(left << 20 | i)
                if fits is None:
                    fits = self._learn(left, i, token)
                if fits:
                    out.append(i)
                    sizes.append(size)
                    at += size
                    left = i
                    size = min(n - at, reach(piece[at : at + 3], 2))
                    continue
            size -= 1
            while not size:
                if not sizes:
                    raise ValueError("the vocabulary lacks a byte")
                dead.add(at)
                size = sizes.pop()
                out.pop()
                left = out[-1] if out else -1
                at -= size
                size -= 1
        return out

    def _learn(self, left: int, i: int, token: bytes) -> bool:
        if len(self.fitting) > 1_000_000:
            self.fitting.clear()
        fits = self._reachable(token) and (left < 0 or self._fits(self.tokens[left], token))
        self.fitting[left << 20 | i] = fits
        return fits

    def encode(self, piece: bytes) -> list[int]:
        known = self.ranks.get(piece)  # also an entry that no merges reach
        if known is not None:
            return [known]
        state, out, moves = 0, [], self.moves
        for at, byte in enumerate(piece):
            move = moves.get(state << 8 | byte)
            if move is None:
                if len(self.states) >= self.most_states:
                    return self._simulate(piece, at - len(self.states[state][1]), out)
                move = self._move(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
        tail = self.ends.get(state)
        out += self._end(state) if tail is None else tail
        return out


class Utf8Stream:
    """An incremental UTF-8 state machine: ``feed`` takes any cut of the bytes
    and returns the text that is complete; a cut character waits.

    The state is the number of bytes still missing and the allowed range of
    the next one. Only the last three bytes of a piece can leave the machine
    within a character, so the machine runs over those, and what lies before
    them is decoded at once. Ill-formed bytes become U+FFFD.
    """

    def __init__(self):
        self.waiting = b""

    @staticmethod
    def pending(data: bytes) -> int:
        """How many bytes at the end begin a character and do not end it."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:
                continue
            need, low, high = 0, 0x80, 0xBF
            if 0xC2 <= lead <= 0xDF:
                need = 1
            elif 0xE0 <= lead <= 0xEF:
                need = 2
                low, high = (0xA0 if lead == 0xE0 else low), (0x9F if lead == 0xED else high)
            elif 0xF0 <= lead <= 0xF4:
                need = 3
                low, high = (0x90 if lead == 0xF0 else low), (0x8F if lead == 0xF4 else high)
            if need < back:
                return 0
            for b in data[len(data) - back + 1 :]:
                if not low <= b <= high:
                    return 0
                low, high = 0x80, 0xBF
            return back
        return 0

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        n = self.pending(data)
        self.waiting = data[len(data) - n :]
        return data[: len(data) - n].decode("utf-8", "replace")

    def end(self) -> str:
        out, self.waiting = self.waiting.decode("utf-8", "replace"), b""
        return out


class Codec:
    """Encoder and decoder of whole texts over one vocabulary."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.bytes_of[i] = token
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.split = splitter(pattern)
        self.transducer = Transducer(self.ranks)
        self.memo = Memo(lambda piece: tuple(self.transducer.encode(piece.encode())), 600_000)

    def encode(self, text: str | None) -> list[int]:
        """The ids of ``text``; none for a null or empty one."""
        return list(chain.from_iterable(map(self.memo.__getitem__, self.split(text or ""))))

    def joined(self, ids: list[int]) -> str:
        """The ids in decimal, with commas between them."""
        return ",".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids: list[int], step: int = 16384) -> Iterator[bytes]:
        """The bytes of ids, ``step`` ids at a time."""
        of = self.bytes_of.__getitem__
        for at in range(0, len(ids), step):
            yield b"".join(map(of, ids[at : at + step]))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process, with what it has compiled so far."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode_documents(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row: its id, n_tokens, ids_sha256, decoded_sha256, valid_utf8 (the
    streaming decoder gives the text back) and, on demand, the ids.

    Null and empty texts have no tokens. Rows are independent of each other,
    so nothing is shuffled; a long text costs memory in proportion to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                ids = c.encode(text)
                hashed, stream, same, at = hashlib.sha256(), Utf8Stream(), True, 0
                for part in c.decode(ids):
                    hashed.update(part)
                    told = stream.feed(part)
                    same = same and text.startswith(told, at)
                    at += len(told)
                rest = stream.end()
                rows.append((len(ids), hashlib.sha256(c.joined(ids).encode()).hexdigest(), hashed.hexdigest(), same and (text or "")[at:] == rest, ids))
            cols = [b.column(0), *(pa.array([r[i] for r in rows], type=t) for i, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.bool_())))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "valid_utf8"]
            if with_ids:
                cols.append(pa.array([r[4] for r in rows], type=pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.select(f"`{doc_id}`").schema[0].dataType.simpleString()
    ddl = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, valid_utf8 boolean"
    return docs.select(f"`{doc_id}`", f"`{text}`").mapInArrow(run, ddl + (", ids array<int>" if with_ids else ""))


def op4_byte_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, valid_utf8.

    Null and empty texts have no tokens; long texts are encoded whole; ties
    and repeated rows have equal results; an empty table gives no rows; other
    columns are not read.
    """
    import public_tokenizers as tokenizers

    return encode_documents(docs, path or tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
