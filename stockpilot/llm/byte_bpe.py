"""Byte-level BPE as a lazily determinised finite-state transducer.

A sequence of tokens is the one that the merges give exactly when each two
neighbours are: when merging the bytes of both leaves the two as they are.  So
the merges compile into an automaton whose non-deterministic states are token
boundaries: the last token before the boundary and the bytes read since, as a
node of the vocabulary's trie.  A state of the transducer is the set of the
boundaries that can still matter.  Bytes older than the longest token cannot
start one, so the set stays small, and what comes before the boundary that all
of them go back to is emitted: after a bounded lookahead.  States are made when first met and kept; past
``MAX_STATES`` the table is emptied and filled again as needed, which costs time
only.

Decoding runs token by token through an incremental UTF-8 state machine, so
characters may be split between tokens and between calls.

Cases: a null text counts as empty and has no tokens; rows that repeat a
``doc_id`` are encoded each on their own; an empty table gives an empty result;
further columns are not read.  Texts are encoded whole; a text is cut only
where the pattern cuts it whatever stands around.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stockpilot.llm.text import map_batches

MAX_STATES = 150_000
MAX_UNITS = 250_000
WINDOW = 1024

RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

# A space before a visible character always begins a match of its own.
_CUT = re.compile(r" (?=\S)")
_RUN = re.compile(r" (?!\S)")


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: base64 token and rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Transducer:
    """Encodes one match of the pattern.

    On each byte it gives the last token of the bytes so far; tokens are emitted
    by walking back over these, at the end of the match or, in a long one, every
    ``WINDOW`` bytes as far as all live boundaries agree."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: dict[int, bytes] = {i: token for token, i in ranks.items()}
        self.sizes = {i: len(token) for token, i in ranks.items()}
        self.next: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        self.depth: list[int] = [0]
        for token, i in ranks.items():
            node = 0
            for byte in token:
                following = self.next[node].get(byte)
                if following is None:
                    following = self.next[node][byte] = len(self.next)
                    self.next.append({})
                    self.ends.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = following
            self.ends[node] = i
        self.pairs: dict[tuple[int, int], bool] = {}
        self.edges: dict[int, tuple[list, list] | None] = {}
        self._forget()

    def _forget(self) -> None:
        start = (0, -1)
        self.states = {start: 0}
        self.sets: list[tuple[int, ...]] = [start]  # node, last token, node, last token, ...
        self.steps: list[dict[int, tuple[int, int]]] = [{}]

    def _spines(self, token: int) -> tuple[list, list] | None:
        """The parts of a token at its left and at its right end as its own bytes
        merge, each with its rank, the byte first; None where merging its bytes
        does not give it."""
        known = self.edges.get(token, 0)
        if known != 0:
            return known
        ranks, none = self.ranks, 1 << 60
        whole = self.tokens[token]
        parts = [whole[i : i + 1] for i in range(len(whole))]
        costs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        left, right = [(parts[0], -1)], [(parts[-1], -1)]
        while costs and (best := min(costs)) != none:
            i = costs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i:
                costs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
            else:
                left.append((parts[0], best))
            if i < len(costs):
                costs[i] = ranks.get(parts[i] + parts[i + 1], none)
            else:
                right.append((parts[-1], best))
        found = self.edges[token] = (left, right) if len(parts) == 1 else None
        return found

    def _stays(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives the two: no merge across the
        boundary comes first.  Merges go by rank, from the left where equal."""
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        if len(self.pairs) >= 4 * MAX_STATES:
            self.pairs.clear()
        after = self._spines(right)
        before = self._spines(left) if left >= 0 else None
        if after is None:
            stays = False
        elif before is None:
            stays = left < 0
        else:
            stays, none, a, b = True, 1 << 60, before[1], after[0]
            i = j = 0
            while True:
                next_a = a[i + 1][1] if i + 1 < len(a) else none
                next_b = b[j + 1][1] if j + 1 < len(b) else none
                across = self.ranks.get(a[i][0] + b[j][0], none)
                if across < next_a and across <= next_b and across != none:
                    stays = False
                    break
                if next_a == none and next_b == none:
                    break
                if next_a <= next_b:
                    i += 1
                else:
                    j += 1
        self.pairs[left, right] = stays
        return stays

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        alive: list[int] = []
        here = -1
        now, ends, following = self.sets[state], self.ends, self.next
        for i in range(0, len(now), 2):
            node = following[now[i]].get(byte)
            if node is None:
                continue
            last = now[i + 1]
            if following[node]:
                alive += (node, last)
            token = ends[node]
            if here < 0 and token >= 0 and self._stays(last, token):
                here = token
        key = (*alive, 0, here)
        target = self.states.get(key)
        if target is None:
            target = self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
        found = self.steps[state][byte] = (target, here)
        return found

    def _path(self, lasts: list[int], end: int) -> list[int]:
        """The tokens up to ``end``, walking back."""
        out = []
        while end > 0:
            token = lasts[end - 1]
            out.append(token)
            end -= self.sizes[token]
        out.reverse()
        return out

    def _agreed(self, lasts: list[int], state: int) -> int:
        """The last boundary that the paths to all live boundaries share."""
        shared: set[int] | None = None
        for node in self.sets[state][::2]:
            at, seen = len(lasts) - self.depth[node], set()
            while at > 0:
                seen.add(at)
                at -= self.sizes[lasts[at - 1]]
            shared = seen if shared is None else shared & seen
        return max(shared or {0})

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.sets) > MAX_STATES:
            self._forget()
        state, out, lasts, steps = 0, [], [], self.steps
        for at in range(0, len(piece), WINDOW):
            for byte in piece[at : at + WINDOW]:
                known = steps[state].get(byte)
                state, token = known if known is not None else self._step(state, byte)
                lasts.append(token)
            if at + WINDOW < len(piece):
                cut = self._agreed(lasts, state)
                out += self._path(lasts, cut)
                del lasts[:cut]
        return out + self._path(lasts, len(lasts))


class Recent(dict):
    """What ``make`` gives for a key, remembered for the keys met lately: two
    generations of ``size`` entries, of which the older one is dropped."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.find = regex.compile(pattern).findall
        self.pieces = Recent(lambda piece: array("I", self.transducer.encode(piece.encode())).tobytes(), MAX_UNITS)
        self.spaced = Recent(lambda part: self.unit(" " + part), MAX_UNITS)

    def unit(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def encode(self, text: str) -> bytes:
        parts = _CUT.split(text) if _RUN.search(text) else text.split(" ")
        return self.unit(parts[0]) + b"".join(map(self.spaced.__getitem__, parts[1:]))


# UTF-8.  First byte -> (continuation bytes to come, range of the next).
def _lead(byte: int) -> tuple[int, int, int] | None:
    if byte < 0x80:
        return (0, 0, 0)
    if 0xC2 <= byte <= 0xDF:
        return (1, 0x80, 0xBF)
    if 0xE0 <= byte <= 0xEF:
        return (2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF)
    if 0xF0 <= byte <= 0xF4:
        return (3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF)
    return None


class Decoder:
    """Ids to text, incrementally.  Bytes that are no UTF-8 give U+FFFD."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.whole: dict[int, str] = {}
        self.pending = b""
        self.state = (0, 0, 0)

    def _bytes(self, data: bytes) -> str:
        out = []
        for byte in data:
            need, low, high = self.state
            if need and low <= byte <= high:
                self.pending += bytes((byte,))
                self.state = (need - 1, 0x80, 0xBF)
                if need == 1:
                    out.append(self.pending.decode())
                    self.pending = b""
                continue
            if need:
                out.append("�")
                self.pending = b""
            lead = _lead(byte)
            if lead is None:
                out.append("�")
                self.state = (0, 0, 0)
            elif lead[0]:
                self.pending, self.state = bytes((byte,)), lead
            else:
                out.append(chr(byte))
                self.state = lead
        return "".join(out)

    def feed(self, ids) -> str:
        out = []
        for i in ids:
            if not self.pending:
                text = self.whole.get(i)
                if text is not None:
                    out.append(text)
                    continue
                text = self._bytes(self.tokens[i])
                if not self.pending:
                    self.whole[i] = text
            else:
                text = self._bytes(self.tokens[i])
            out.append(text)
        return "".join(out)

    def end(self) -> str:
        left, self.pending, self.state = self.pending, b"", (0, 0, 0)
        return "�" if left else ""


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes, pattern: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(read_ranks(vocabulary), pattern)


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def byte_bpe(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of ``docs``.  The
    vocabulary file is read by the driver and travels with the tasks."""
    vocabulary = read_file(vocabulary_path)

    def run(batch: pa.RecordBatch) -> dict:
        coder = encoder(vocabulary, pattern)
        decoder = Decoder(coder.transducer.tokens)
        counts, hashes, decoded = [], [], []
        for text in batch.column("text"):
            data = coder.encode(text.as_py() or "")
            ids = array("I")
            ids.frombytes(data)
            counts.append(len(ids))
            hashes.append(hashlib.sha256(data).hexdigest())
            decoded.append(hashlib.sha256((decoder.feed(ids) + decoder.end()).encode()).hexdigest())
        return {"doc_id": batch.column("doc_id"), "n_tokens": counts, "ids_sha256": hashes, "decoded_sha256": decoded}

    return map_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text"), run, RESULT)
