"""Byte-level BPE: a lazily determinised transducer encodes, a UTF-8 state machine decodes streams.

**Encoding.** Merging by ranks has one property that makes it finite-state: a sequence of tokens is what merging
gives if and only if merging leaves each two neighbours as they are. So a transducer that
doesn't merge is compiled from the ranks. It walks down the trie of tokens byte by byte; at a
node that is a token, and that may follow the token before, it may emit this and go on at the
root. Exactly one of its walks ends well for any input. Its determinised states are sets of
(token before, node, tokens not emitted yet); what all walks of a set agree on is emitted, and
a walk dies as soon as no token begins with its bytes, so the lookahead is bounded by the longest token.
States and steps are made when an input first asks for them, and kept, ``STATES`` at most: then they are
made anew. Whether two tokens stay as they are follows from the merges that made them.

**Pieces.** A text falls into the matches of a pattern, each encoded by itself; a match that is a token as a
whole is that token. Texts are matched a block at a time, and the last matches of a block are sought
again with what follows them. Ids of short matches, and of what stands between two spaces, are kept, ``PIECES`` at
most of each by a worker.

**Decoding.** ``StreamDecoder`` takes ids in any portions and gives whole characters: a state machine
of UTF-8 runs over the tokens and tells where the last whole character ends; the bytes behind
it wait for the next portion. Bytes that are no UTF-8 become U+FFFD, as Python's decoder has it.

Cases: a null text counts as empty and has no ids; rows that repeat, or lack a doc_id, are encoded each; an empty table
gives an empty result; further columns are ignored; an id without a token is an error.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = 1 << 18
PIECES = 1 << 18
PIECE_CHARS = 40  #: of matches that are kept
BLOCK_CHARS = 1 << 18
_ROWS = 256
_AHEAD = 8  #: characters that the pattern looks at behind a match, at most
_NEVER = 1 << 62
_ROOT = 0


class Vocabulary:
    """Tokens by rank, their trie, and which tokens may follow which."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.children: list[dict[int, int]] = [{}]
        self.token_at = [-1]  #: of each node of the trie
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._left: dict[int, list[tuple[int, int, int]]] = {}
        self._right: dict[int, list[tuple[int, int, int]]] = {}
        for token, rank in ranks.items():
            node = _ROOT
            for byte in token:
                node = self.children[node].setdefault(byte, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token_at.append(-1)
            self.token_at[node] = rank

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merging makes it of; (-1, -1) for a byte, None if merging never makes it."""
        if token not in self._halves:
            parts = [bytes([b]) for b in self.tokens[token]]
            found: tuple[int, int] | None = (-1, -1) if len(parts) == 1 else None
            while len(parts) > 1:
                best, at = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if best == _NEVER:
                    break
                if len(parts) == 2:
                    found = (self.ranks[parts[0]], self.ranks[parts[1]])
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = found
        return self._halves[token]

    def _edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """(token, when it is made, when it is merged on) of all that stand at one end of a token while it is made.

        When: ranks of merges, the greatest so far, as merging takes them up in this order.
        """
        kept = self._right if side else self._left
        if token not in kept:
            out, until, now = [], _NEVER, token
            while True:
                made = self._made(now)
                out.append((now, made, until))
                pair = self.halves(now)
                if pair is None or pair[side] < 0:
                    break
                until, now = made, pair[side]
            kept[token] = out
        return kept[token]

    def _made(self, token: int) -> int:
        pair = self.halves(token)
        return -1 if pair is None or pair[0] < 0 else max(token, self._made(pair[0]), self._made(pair[1]))

    def stay(self, a: int, b: int) -> bool:
        """Whether merging leaves token b behind token a as they are.

        What stands at the end of a and at the start of b at one time merges if the rank of both together comes up
        before either is merged on; of equal ranks the left one comes first.
        """
        for x, x_from, x_until in self._edge(a, 1):
            for y, y_from, y_until in self._edge(b, 0):
                if max(x_from, y_from) < min(x_until, y_until):
                    rank = self.ranks.get(self.tokens[x] + self.tokens[y])
                    if rank is not None and rank < x_until and rank <= y_until:
                        return False
        return True


Walk = tuple[int, int, bytes]  #: token before, node, packed ids not emitted yet


class Transducer:
    """Encodes bytes to packed ids (32 bits each, little-endian); its states are made as they are reached."""

    def __init__(self, vocabulary: Vocabulary, states: int = STATES):
        self.vocabulary, self.most = vocabulary, states
        self.packed = [i.to_bytes(4, "little") for i in range(len(vocabulary.tokens))]
        self._stay: dict[int, bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.walks: list[tuple[Walk, ...]] = []
        self.numbers: dict[tuple[Walk, ...], int] = {}
        self.steps: dict[int, tuple[int, bytes]] = {}  #: of 256 * state + byte
        self.ends: list[bytes] = []  #: what a state emits where the input ends
        self._number(((-1, _ROOT, b""),))

    def _number(self, walks: tuple[Walk, ...]) -> int:
        found = self.numbers.get(walks)
        if found is None:
            found = self.numbers[walks] = len(self.walks)
            self.walks.append(walks)
            self.ends.append(walks[-1][2] if walks[-1][1] == _ROOT else b"")
        return found

    def _follows(self, before: int, token: int) -> bool:
        if len(self._stay) > 16 * self.most:
            self._stay.clear()
        words = self.vocabulary
        found = self._stay[before << 32 | token] = words.halves(token) is not None and (before < 0 or words.stay(before, token))
        return found

    def _step(self, state: int, byte: int) -> tuple[int, bytes]:
        """The state that a byte leads to and the packed ids that are then certain."""
        children, token_at, stay = self.vocabulary.children, self.vocabulary.token_at, self._stay
        made: list[Walk] = []
        whole: Walk | None = None  #: the one walk that ends with this byte
        for before, node, rest in self.walks[state]:
            child = children[node].get(byte)
            if child is None:
                continue
            if children[child]:
                made.append((before, child, rest))
            token = token_at[child]
            if token >= 0 and whole is None:
                follows = stay.get(before << 32 | token)
                if self._follows(before, token) if follows is None else follows:
                    whole = (token, _ROOT, rest + self.packed[token])
        if whole is None:
            raise ValueError(f"no token for the byte {byte}")
        made.append(whole)
        emitted = made[0][2]
        if emitted:  # what all walks have in common
            for _, _, rest in made:
                while not rest.startswith(emitted):
                    emitted = emitted[:-4]
            if emitted:
                made = [(before, node, rest[len(emitted) :]) for before, node, rest in made]
        walks = tuple(made)
        if len(self.walks) >= self.most:
            self._clear()
            return self._number(walks), emitted
        found = self.steps[state << 8 | byte] = (self._number(walks), emitted)
        return found

    def encode(self, data: bytes) -> bytes:
        out = []
        state, steps = 0, self.steps
        for byte in data:
            step = steps.get(state << 8 | byte)
            if step is None:
                step = self._step(state, byte)
                steps = self.steps
            state = step[0]
            if step[1]:
                out.append(step[1])
        out.append(self.ends[state])
        return b"".join(out)


class _Kept(dict):
    """What ``make`` gives for short texts, ``most`` of them: those that came first, which are those that come most."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, text: str) -> bytes:
        found = self.make(text)
        if len(self) < self.most and len(text) <= PIECE_CHARS:
            self[text] = found
        return found


class _Odd(Exception):
    """White space beside a space."""


class Encoder:
    """Packed ids of texts.

    ``pattern`` has to begin a match at every space between two characters that are no white space, as public
    patterns for such vocabularies do. So texts without other runs of white space fall apart there, and what
    stands between two spaces is looked up at once; all other texts are matched as a whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, pieces: int = PIECES, states: int = STATES):
        self.vocabulary = Vocabulary(ranks)
        self.transducer = Transducer(self.vocabulary, states)
        self.pattern = regex.compile(pattern)
        self.pieces = _Kept(self._piece, pieces)
        self.words = _Kept(self._word, pieces)  #: that follow a space

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.vocabulary.ranks.get(data)
        return self.transducer.encode(data) if whole is None else self.transducer.packed[whole]

    def _word(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Odd
        found = self.pattern.findall(" " + word)
        return self._piece(found[0]) if len(found) == 1 else b"".join(map(self.pieces.__getitem__, found))

    def blocks(self, text: str, block: int = BLOCK_CHARS) -> Iterator[list[str]]:
        """The matches of the pattern in the whole text, about a block at a time."""
        start, size = 0, block
        while start < len(text):
            found = self.pattern.findall(text, start, start + size)
            if start + size < len(text):
                unsure = 0
                while found and unsure < _AHEAD:
                    unsure += len(found.pop())
                if not found:  # one match may be longer than any block
                    size *= 2
                    continue
            yield found
            start, size = start + sum(map(len, found)), block

    def encode(self, text: str) -> bytes:
        head, *words = text.split(" ")
        if words and head and not head[-1].isspace():
            try:
                rest = b"".join(map(self.words.__getitem__, words))
                return self._matched(head) + rest
            except _Odd:
                pass
        return self._matched(text)

    def _matched(self, text: str) -> bytes:
        return b"".join(b"".join(map(self.pieces.__getitem__, found)) for found in self.blocks(text))


def _utf8() -> list[list[int]]:
    """next[state][byte]; states: 0 between characters, 1 to 3 that many bytes to come, 4 to 7 a restricted second byte, 8 no UTF-8."""
    table = [[8] * 256 for _ in range(9)]
    lead = [(0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7)]
    later = [(1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2), (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2)]
    for state, low, high, to in [(0, *x) for x in lead] + later:
        for byte in range(low, high + 1):
            table[state][byte] = to
    return table


_NEXT = _utf8()


def _waiting(data: bytes, state: int = 0, held: int = 0) -> tuple[int, int]:
    """(state, bytes of a character that isn't whole yet) after more bytes; held: such bytes before them."""
    for byte in data:
        to = _NEXT[state][byte]
        if to == 8 and state:  # what was held is no character; the byte may begin one
            to, held = _NEXT[0][byte], 0
        state, held = (0, 0) if to in (0, 8) else (to, held + 1)
    return state, held


class StreamDecoder:
    """Text of ids that come in portions; characters that a portion divides wait for the next."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self._state, self._held = 0, b""
        self._steps: dict[tuple[int, int], tuple[int, int]] = {}

    def feed(self, ids: list[int]) -> str:
        data = self._held + b"".join(map(self.tokens.__getitem__, ids))
        # a token that begins behind a byte of ASCII begins between characters, so the machine starts at the last such place
        tail, at = b"", len(ids)
        while at and not (tail and tail[0] < 0x80):
            at -= 1
            tail = self.tokens[ids[at]] + tail
        state, held = _waiting(tail) if at or (tail and tail[0] < 0x80) else _waiting(tail, self._state, len(self._held))
        self._state, self._held = state, data[len(data) - held :] if held else b""
        return data[: len(data) - held].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self._state, self._held = self._held, 0, b""
        return rest.decode("utf-8", "replace")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base64 and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


_encoders: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker, which serves many tasks."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(read_ranks(path), pattern)
    return _encoders[path, pattern]


def _decoded(tokens: list[bytes], packed: bytes, portion: int = 1 << 16) -> str:
    decoder, ids = StreamDecoder(tokens), np.frombuffer(packed, "<u4")
    return "".join([*(decoder.feed(ids[lo : lo + portion].tolist()) for lo in range(0, len(ids), portion)), decoder.close()])


def encode(docs: DataFrame, path: str, pattern: str, with_text: bool = False) -> DataFrame:
    """(doc_id, ids) of each row; ids: 32 bits each, little-endian. with_text: and ``decoded``, what the ids decode to.

    ``path`` is that of a rank file on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for whole in batches:
            for lo in range(0, len(whole), _ROWS):
                batch = whole.slice(lo, _ROWS)
                ids = [encoder.encode(text or "") for text in batch.column(1).to_pylist()]
                columns, names = [batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"]
                if with_text:
                    columns.append(pa.array([_decoded(encoder.vocabulary.tokens, x) for x in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, ids binary" + ", decoded string" * with_text
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of each row of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        for whole in batches:
            for lo in range(0, len(whole), _ROWS):
                batch = whole.slice(lo, _ROWS)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_decoded(tokens, x or b"") for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
