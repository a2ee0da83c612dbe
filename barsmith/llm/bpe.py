"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

The merges compile into a transducer over bytes: a trie of the vocabulary's tokens, started anew at every byte. Its
states are determinised on first use, as the set of live trie nodes, and kept; there are no more of them than trie nodes. Greedy
merging has a left-to-right form: after each byte exactly one token can end there, the one that is whole under the merges and
that they keep apart from the token chosen at its start. Choices wait in a queue until all live starts agree on
them, so output lags by a bounded lookahead: no start lives longer than the longest token.

Decoding is incremental: ids become bytes, and a small state machine over UTF-8 lead and tail bytes holds back
an unfinished character until its bytes arrive.

Defined cases: a null text is an empty one; the longest texts stream through in pieces; extra columns are ignored; rows are
never merged, so repeated rows and an empty table need no care.
"""

import base64
import gc
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.arrays import claim

MAX_PAIRS, MAX_PIECES, LONG_PIECE, QUEUE = 500_000, 500_000, 64, 4096
ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary, n_replaced long"


class Merges:
    """Ranks of a vocabulary, and which tokens and pairs of tokens the merges leave as they are."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.known: dict[int, bool] = {}
        self._right: dict[int, list[tuple[bytes, int, int]]] = {}
        self._left: dict[int, list[tuple[bytes, int, int]]] = {}
        self.trie: list[dict[int, int]] = [{}]
        self.depth = [0]
        self.ends: list[int | None] = [None]
        for token, i in ranks.items():
            if self.merge(token) == [i]:
                self._add(token, i)

    def _add(self, token: bytes, i: int) -> None:
        node = 0
        for b in token:
            nxt = self.trie[node].get(b)
            if nxt is None:
                nxt = self.trie[node][b] = len(self.trie)
                self.trie.append({})
                self.ends.append(None)
                self.depth.append(self.depth[node] + 1)
            node = nxt
        self.ends[node] = i

    def merge(self, piece: bytes) -> list[int]:
        """Plain merging of a short piece: the lowest rank first, the leftmost of equals."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def edge(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """The parts that lie at one edge of a token while it is merged (side 0: left, 1: right), each with the ranks at
        which it comes into being and is merged further."""
        part, gone, out = self.bytes_of[token], 1 << 60, []
        while True:
            born = self.ranks[part] if len(part) > 1 else -1
            out.append((part, born, gone))
            if len(part) == 1:
                return out
            parts = [part[i:i + 1] for i in range(len(part))]
            while len(parts) > 2:
                _, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            part, gone = parts[side], born

    def apart(self, a: int, b: int) -> bool:
        """Whether the merges leave the boundary between tokens a and b: no two edge parts that exist at the same time
        have a merge of their own. Of equal ranks the left merge comes first."""
        known = self.known.get(a << 32 | b)
        if known is None:
            if len(self.known) >= MAX_PAIRS:
                self.known.clear()
            lefts = self._right.get(a) or self._right.setdefault(a, self.edge(a, 1))
            rights = self._left.get(b) or self._left.setdefault(b, self.edge(b, 0))
            known, rank_of = True, self.ranks.get
            for x, x_born, x_gone in lefts:
                for y, y_born, y_gone in rights:
                    rank = rank_of(x + y)
                    if rank is not None and x_gone > max(rank, x_born, y_born) <= y_gone:
                        known = False
            self.known[a << 32 | b] = known
        return known


class Transducer:
    """bytes -> ids. A state is the set of trie nodes live after the bytes read, by subset construction on first use; it
    names the tokens that end here. Which of them was chosen at each byte waits in a queue until all live starts agree."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.states: list[tuple[int, ...]] = [(0,)]
        self.number = {(0,): 0}
        self.arcs: list[dict[int, int]] = [{}]
        self.closing: list[tuple[tuple[int, int], ...]] = [()]  # (token, length), the longest first

    def _arc(self, at: int, byte: int) -> int:
        trie, ends = self.m.trie, self.m.ends
        nodes = [n for n in (trie[x].get(byte) for x in self.states[at]) if n is not None]
        live = (*[n for n in nodes if trie[n]], 0)
        closing = tuple((ends[n], len(self.m.bytes_of[ends[n]])) for n in nodes if ends[n] is not None)
        key = (live, closing)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(live)
            self.arcs.append({})
            self.closing.append(closing)
        self.arcs[at][byte] = to
        return to

    def encode(self, piece: bytes) -> list[int]:
        arcs, closing, apart, known = self.arcs, self.closing, self.m.apart, self.m.known
        out, before, at = [], -1, 0  # `before`: the last token emitted
        tokens, sizes = [before], [0]  # the queue: for each byte since then, the token that ends there
        for byte in piece:
            to = arcs[at].get(byte)
            at = self._arc(at, byte) if to is None else to
            here = len(tokens)
            for token, size in closing[at]:
                if size <= here:
                    prev = tokens[here - size]
                    free = prev < 0 or known.get(prev << 32 | token)
                    if free or free is None and apart(prev, token):
                        tokens.append(token)
                        sizes.append(size)
                        break
            else:
                raise ValueError(f"the vocabulary has no token for byte {byte} here")
            if here >= QUEUE:
                done = self._agreed(sizes, at)
                if done:
                    out += self._path(tokens, sizes, done)
                    tokens, sizes = tokens[done:], [0, *sizes[done + 1:]]
        return out + self._path(tokens, sizes, len(tokens) - 1)

    def _agreed(self, sizes: list[int], at: int) -> int:
        """The last boundary that the tokens chosen up to every live start pass."""
        end = len(sizes) - 1
        places = {end - self.m.depth[n] for n in self.states[at]}
        while len(places) > 1:
            last = max(places)
            places = places - {last} | {last - sizes[last]}
        return places.pop()

    @staticmethod
    def _path(tokens: list[int], sizes: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(tokens[end])
            end -= sizes[end]
        return out[::-1]


class Codec:
    """Text to ids and back under one vocabulary file and split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.merges = Merges(ranks)
        self.fst = Transducer(self.merges)
        self.split = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}
        self.token_bytes = [self.merges.bytes_of.get(i, b"") for i in range(max(ranks.values()) + 1)]

    def piece(self, text: str) -> bytes:
        """Ids of one match of the pattern, as little-endian unsigned 32-bit integers. A match that is a token as it
        stands is that token, even if the merges do not reach it."""
        raw = text.encode("utf-8", "surrogatepass")
        whole = self.merges.ranks.get(raw)
        ids = np.array([whole] if whole is not None else self.fst.encode(raw), "<u4").tobytes()
        if len(text) <= LONG_PIECE:
            if len(self.pieces) >= MAX_PIECES:
                self.pieces.clear()
            self.pieces[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        known, make = self.pieces, self.piece
        return b"".join([known.get(p) or make(p) for p in self.split.findall(text)])

    def decode(self, ids: bytes, step: int = 65536):
        """Bytes of the ids, `step` ids at a time."""
        token, numbers = self.token_bytes, np.frombuffer(ids, "<u4")
        for lo in range(0, len(numbers), step):
            yield b"".join([token[i] for i in numbers[lo:lo + step].tolist()])


class Utf8Stream:
    """Incremental UTF-8: feed bytes, get the characters that are complete. `bad` counts bytes replaced by U+FFFD."""

    def __init__(self):
        self.held, self.bad = b"", 0

    @staticmethod
    def wanted(lead: int) -> int:
        """Bytes of a character that starts with `lead`; 1 for a byte that starts none."""
        return 1 if lead < 0xC2 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4 if lead < 0xF5 else 1

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):  # a lead byte among the last three may want more than there is
            byte = data[-back]
            if byte >= 0xC0:
                if self.wanted(byte) > back:
                    cut = len(data) - back
                break
            if byte < 0x80:
                break
        self.held = data[cut:]
        return self._text(data[:cut])

    def finish(self) -> str:
        data, self.held = self.held, b""
        return self._text(data)

    def _text(self, data: bytes) -> str:
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            text = data.decode("utf-8", "replace")
            self.bad += text.count("�") - data.count("�".encode())
            return text


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One per Python worker, which Spark reuses for later tasks."""
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, keep_ids: bool = True) -> DataFrame:
    """ENCODED: per row its ids and the digests of ids and decoded bytes; n_replaced counts bytes that are no UTF-8."""
    def run(batches):
        claim("bpe", codec.cache_clear)
        c = codec(path, pattern)
        gc.disable()  # the tables hold no cycles, and walking them costs a quarter of the time
        for b in batches:
            out = {"doc_id": b.column(0), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "n_replaced": []}
            for text in b.column(1):
                ids = c.encode(text.as_py() or "")
                digest, stream = hashlib.sha256(), Utf8Stream()
                for raw in c.decode(ids):
                    digest.update(raw)
                    stream.feed(raw)
                stream.finish()
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(digest.hexdigest())
                out["ids"].append(ids if keep_ids else None)
                out["n_replaced"].append(stream.bad)
            yield pa.RecordBatch.from_arrays(
                [out["doc_id"].cast(pa.int64()), *(pa.array(out[n], t) for n, t in (
                    ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
                    ("ids", pa.binary()), ("n_replaced", pa.int64())))], names=list(out))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ENCODED)
