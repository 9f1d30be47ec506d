"""SentencePiece-style encoding by merges, with seeded merge-dropout, and its decoding.

A text gets the dummy prefix, spaces become U+2581, and chunks that no piece of the
vocabulary can span are segmented on their own. In a chunk all adjacent pairs that form a
piece wait on an agenda, best score first, leftmost on ties. A popped candidate is
skipped for good when a hash of (seed, text, piece, position in the text) falls below the dropout
rate, so the same seed always gives the same segmentation, other seeds give others, and each occurrence
of a chunk is drawn anew. What is remembered is not an outcome but a tree per chunk: a node holds the
next candidate, its two successors what follows a merge and a skip, its ends the segmentations; each
occurrence goes down by its own draws. Draws not met before run their agendas side by side in arrays;
very long chunks use a heap. Characters outside the vocabulary become byte pieces; so does a literal U+2581, which
makes decoding exact for every text. With dropout 0 the result is the usual merge encoding.

Cases: a null text has null ids, an empty one no ids; both decode to what they were. Repeated
rows and null ids give one result each; an empty table gives an empty result; other
columns are not read. Work stays in the scan's task. Memory is one Arrow batch, the texts and results of one
group of about ``GROUP_CHARS`` characters, and
trees of about ``CACHE_BYTES``, whatever the length of their chunks, which are then begun anew.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Bytes of trees, and about those of a chunk's entry, of one of its characters, of a node, of an id at an end.
CACHE_BYTES = 40_000_000
ENTRY_BYTES, CHAR_BYTES, NODE_BYTES, ID_BYTES = 200, 4, 16, 4
#: Chunks longer than this are segmented each time and not remembered.
CACHE_CHARS = 64
#: Rank of a pair that is no piece, or whose merge was skipped.
NEVER = 2**31 - 1
PAIR_BITS = 18
#: Marks of a node without known candidate, and of one whose agenda is empty.
UNKNOWN, END = -2, -1
#: Chunks whose agendas run together.
BLOCK_CHUNKS = 4096
#: Texts whose chunks are gathered together.
GROUP_CHARS = 1_500_000
MASK, WIDE = 2**64 - 1, 2**21 + 2**20


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores by id; ids of the 256 byte pieces."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    special: frozenset[int]

    @staticmethod
    def load(path: str = MODEL_PATH) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        pieces = tuple(sp.id_to_piece(i) for i in ids)
        at = {p: i for i, p in enumerate(pieces)}
        byte_ids = tuple(at[f"<0x{b:02X}>"] for b in range(256))
        special = frozenset(i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
        for i in ids:  # what the split into chunks relies on
            if i not in special and (SPACE in pieces[i].lstrip(SPACE) or "\n" in pieces[i]):
                raise ValueError(f"piece {i} spans words; this vocabulary can't be segmented by chunks")
        return Vocabulary(pieces, tuple(sp.get_score(i) for i in ids), byte_ids, special)


class Encoder:
    """Encodes and decodes texts.

    Pairs that form a piece are a sorted table of (left id, right id) keys with the rank of the
    piece's score and its id. Symbols outside the vocabulary have ids beyond it.
    """

    _CHUNK = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def __init__(self, vocab: Vocabulary, dropout: float = 0.0, seed: int = 0):
        self.vocab, self.size = vocab, len(vocab.pieces)
        self.bound = min(2**64 - 1, int(dropout * 2.0**64))
        self.seed = seed * 0xD6E8FEB86659FD93 & MASK
        normal = [i for i in range(self.size) if i not in vocab.special]
        self.id_of = {vocab.pieces[i]: i for i in normal}
        order = {x: r for r, x in enumerate(sorted({-vocab.scores[i] for i in normal}))}
        pairs = sorted((self.id_of[p[:k]] * WIDE + self.id_of[p[k:]], order[-vocab.scores[i]], i)
                       for i in normal for p in [vocab.pieces[i]] for k in range(1, len(p))
                       if p[:k] in self.id_of and p[k:] in self.id_of)
        self.keys, self.ranks, self.merged = (np.array([x[j] for x in pairs], t) for j, t in enumerate((np.int64, np.int32, np.int32)))
        # keys by the top bits of their hash, so that a look-up tries a few places
        code = self._code(self.keys)
        by = np.argsort(code, kind="stable")
        self.keys, self.ranks, self.merged = self.keys[by], self.ranks[by], self.merged[by]
        self.first = np.searchsorted(code[by], np.arange(2**PAIR_BITS + 1)).astype(np.int32)
        self.tries = int(np.diff(self.first).max(initial=0))
        self.keys, self.ranks, self.merged = (np.append(x, np.full(self.tries + 1, v, x.dtype))
                                              for x, v in ((self.keys, -1), (self.ranks, NEVER), (self.merged, 0)))
        self.lookup = {k: (r, i) for k, r, i in pairs}
        # id of a character: its piece, or beyond the vocabulary its code point
        self.char_id = np.arange(0x110000, dtype=np.int32) + self.size
        for p in (p for p in self.id_of if len(p) == 1):
            self.char_id[ord(p)] = self.id_of[p]
        self.pack_bytes = [struct.pack("<i", i) for i in vocab.byte_ids]
        self.escaped = b"".join(self.pack_bytes[b] for b in SPACE.encode())
        self.out = [p.replace(SPACE, " ").encode() for p in vocab.pieces]
        for i in vocab.special:
            self.out[i] = b""
        for b, i in enumerate(vocab.byte_ids):
            self.out[i] = bytes([b])
        self._clear()

    def skipped(self, piece: int, position: int, key: int) -> bool:
        """Keyed hash of a candidate below the dropout rate."""
        x = piece * 0x9E3779B97F4A7C15 ^ position * 0xC2B2AE3D27D4EB4F ^ key * 0x165667B19E3779F9 ^ self.seed
        x &= MASK
        x = (x ^ x >> 33) * 0xFF51AFD7ED558CCD & MASK
        x = (x ^ x >> 29) * 0xC4CEB9FE1A85EC53 & MASK
        return x ^ x >> 32 < self.bound

    def _skipped(self, piece: np.ndarray, position: np.ndarray, key: np.ndarray) -> np.ndarray:
        u = np.uint64
        x = (piece.astype(u) * u(0x9E3779B97F4A7C15) ^ position.astype(u) * u(0xC2B2AE3D27D4EB4F)
             ^ key * u(0x165667B19E3779F9) ^ u(self.seed))
        x = (x ^ x >> u(33)) * u(0xFF51AFD7ED558CCD)
        x = (x ^ x >> u(29)) * u(0xC4CEB9FE1A85EC53)
        return x ^ x >> u(32) < u(self.bound)

    @staticmethod
    def _code(key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece that two symbols form; ``NEVER`` if none."""
        key = (a.astype(np.int64) * WIDE + b).ravel()
        code = self._code(key)
        at, stop = self.first[code], self.first[code + 1]
        left = np.flatnonzero((at < stop) & (self.keys[at] != key))
        while len(left):
            at[left] += 1
            x = at[left]
            left = left[(x < stop[left]) & (self.keys[x] != key[left])]
        hit = (at < stop) & (self.keys[at] == key)
        return np.where(hit, self.ranks[at], np.int32(NEVER)).reshape(a.shape), self.merged[at].reshape(a.shape)

    def _packed(self, ids: np.ndarray) -> bytes:
        if (ids < self.size).all():
            return ids.astype("<i4").tobytes()
        return b"".join([struct.pack("<i", i) if i < self.size else
                         b"".join([self.pack_bytes[x] for x in chr(i - self.size).encode()]) for i in ids.tolist()])

    def _clear(self) -> None:
        """Forget all outcomes; the empty chunk stands for a literal U+2581."""
        self.nodes = self.stored = self.chars = 0
        self.piece, self.place = np.empty(4096, np.int32), np.empty(4096, np.int32)
        self.next = np.empty((4096, 2), np.int32)
        self.ids = np.empty(4096, np.int32)
        self.root: dict[str, int] = {"": int(self._grow(1)[0])}
        self._keep(np.zeros(1, np.int64), np.frombuffer(self.escaped, np.int32), np.array([len(SPACE.encode())]))

    def held(self) -> int:
        """Bytes of the trees, about."""
        return ENTRY_BYTES * len(self.root) + CHAR_BYTES * self.chars + NODE_BYTES * self.nodes + ID_BYTES * self.stored

    def _grow(self, n: int) -> np.ndarray:
        """New nodes without candidate and successors."""
        out = np.arange(self.nodes, self.nodes + n)
        self.nodes += n
        if self.nodes > len(self.piece):
            for name in ("piece", "place", "next"):
                old = getattr(self, name)
                new = np.empty((max(self.nodes, 2 * len(old)), *old.shape[1:]), old.dtype)
                new[:len(old)] = old
                setattr(self, name, new)
        self.piece[out], self.next[out] = UNKNOWN, UNKNOWN
        return out

    def _keep(self, node: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The segmentations of end nodes, one after the other in ``ids``; place and length stand for successors."""
        end = self.stored + len(ids)
        if end > len(self.ids):
            new = np.empty(max(end, 2 * len(self.ids)), np.int32)
            new[:self.stored] = self.ids[:self.stored]
            self.ids = new
        self.ids[self.stored:end] = ids
        self.piece[node], self.next[node, 1] = END, lengths
        self.next[node, 0] = self.stored + np.cumsum(lengths) - lengths
        self.stored = end

    def _walk(self, node: np.ndarray, start: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Occurrences go from node to node by their own draws; ``node`` is left at the last known one. Returns
        the occurrences that met no end, one of each (node, draw)."""
        at = np.arange(len(node))
        stuck, draw = [], []
        while len(at):
            n = node[at]
            piece = self.piece[n]
            fresh = piece == UNKNOWN
            if fresh.any():
                stuck.append(at[fresh])
                draw.append(n[fresh] * 2)
            go = piece >= 0
            at, n, piece = at[go], n[go], piece[go]
            skip = self._skipped(piece, start[at] + self.place[n], key[at]).astype(np.int64)
            to = self.next[n, skip]
            new = to == UNKNOWN
            if new.any():
                stuck.append(at[new])
                draw.append(n[new] * 2 + skip[new])
                at, to = at[~new], to[~new]
            node[at] = to
        if not stuck:
            return np.zeros(0, np.int64)
        at = np.concatenate(stuck)
        return at[np.unique(np.concatenate(draw), return_index=True)[1]]

    def _expand(self, chunks: list[str], root: np.ndarray, start: np.ndarray, key: np.ndarray) -> None:
        """The agendas of occurrences of at most ``CACHE_CHARS`` characters, all of a block at once: a row holds the
        ranks of a chunk's adjacent pairs, and each step merges or skips the best of every row. What each
        step met is added to the tree."""
        order = np.argsort(np.fromiter(map(len, chunks), np.int64, len(chunks)), kind="stable")
        for first in range(0, len(chunks), BLOCK_CHUNKS):
            rows = order[first:first + BLOCK_CHUNKS]
            block = [chunks[i] for i in rows.tolist()]
            n, width = len(block), len(block[-1])
            size = np.fromiter(map(len, block), np.int64, n)
            col = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            sym = np.full((n, width + 1), -1, np.int32)
            sym[np.repeat(np.arange(n), size), col] = self.char_id[np.frombuffer("".join(block).encode("utf-32-le"), np.uint32)]
            pos = np.tile(np.arange(width + 1, dtype=np.int32), (n, 1))
            rank, _ = self._pair(sym[:, :-1], sym[:, 1:])  # a pair with the -1 at the end is no piece

            def put(row: np.ndarray, s: np.ndarray, sym: np.ndarray = sym) -> None:
                sym[row] = -1
                sym[row, :s.shape[1]] = s

            row = np.arange(n)  # chunks whose agenda isn't empty
            s, p, k = sym.copy(), pos, rank
            node, at, own = root[rows], start[rows], key[rows]
            while width > 1:
                i = k.argmin(axis=1)
                live = k[np.arange(len(k)), i] < NEVER
                if not live.all():
                    put(row, s)
                    row, s, p, k, i = row[live], s[live], p[live], k[live], i[live]
                    longest = int((s >= 0).sum(axis=1).max(initial=0))
                    s, p, k = s[:, :longest + 1], p[:, :longest + 1], k[:, :longest]
                if len(row) == 0:
                    break
                r = np.arange(len(row))
                _, piece = self._pair(s[r, i], s[r, i + 1])
                here, place = node[row], p[r, i]
                self.piece[here], self.place[here] = piece, place
                skip = self._skipped(piece, at[row] + place, own[row])
                draw = skip.astype(np.int64)
                to = self.next[here, draw]
                new = np.flatnonzero(to == UNKNOWN)
                to[new] = self._grow(len(new))
                self.next[here[new], draw[new]] = to[new]
                node[row] = to
                k[r[skip], i[skip]] = NEVER
                merge = r[~skip]
                if len(merge):
                    i = i[merge]
                    s[merge, i] = piece[merge]
                    wide = np.arange(s.shape[1])
                    cut = np.full(len(r), s.shape[1])
                    cut[merge] = i
                    take = np.minimum(wide + (wide > cut[:, None]), s.shape[1] - 1)
                    s, p = s.take(take + (r * s.shape[1])[:, None]), p.take(take + (r * s.shape[1])[:, None])
                    k = k.take(np.minimum(take[:, :-1], k.shape[1] - 1) + (r * k.shape[1])[:, None])
                    s[merge, -1], k[merge, -1] = -1, NEVER
                    k[merge, i], _ = self._pair(s[merge, i], s[merge, i + 1])
                    h = np.flatnonzero(i > 0)
                    m, j = merge[h], i[h]
                    k[m, j - 1], _ = self._pair(s[m, j - 1], s[m, j])
            if len(row):
                put(row, s)
            flat, counts = sym[sym >= 0], (sym >= 0).sum(axis=1)
            if not (flat < self.size).all():
                packed = [self._packed(x) for x in np.split(flat, np.cumsum(counts)[:-1])]
                flat, counts = np.frombuffer(b"".join(packed), np.int32), np.array([len(x) // 4 for x in packed])
            self._keep(node, flat, counts)

    def merge_short(self, chunk: str, key: int, start: int = 0) -> bytes:
        """The agenda in arrays, for one occurrence by itself."""
        node, at, own = self._grow(1), np.array([start]), np.array([key], np.uint64)
        self._expand([chunk], node, at, own)
        self._walk(node, at, own)
        begin, length = self.next[node[0]].tolist()
        return self.ids[begin:begin + length].tobytes()

    def merge_long(self, chunk: str, key: int, start: int = 0) -> bytes:
        """The agenda as a heap, for one occurrence of any length."""
        sym, n = self.char_id[np.frombuffer(chunk.encode("utf-32-le"), np.uint32)].tolist(), len(chunk)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple] = []

        def offer(a: int, b: int) -> None:
            found = self.lookup.get(sym[a] * WIDE + sym[b])
            if found is not None:
                heapq.heappush(agenda, (found[0], a, b, sym[a], sym[b], found[1]))

        for a in range(n - 1):
            offer(a, a + 1)
        while agenda:
            _, a, b, was_a, was_b, piece = heapq.heappop(agenda)
            if sym[a] != was_a or sym[b] != was_b or right[a] != b:
                continue
            if self.bound and self.skipped(piece, start + a, key):
                continue
            sym[a], sym[b], right[a] = piece, -1, right[b]
            if right[b] < n:
                left[right[b]] = a
                offer(a, right[b])
            if left[a] >= 0:
                offer(left[a], a)
        return self._packed(np.array([x for x in sym if x >= 0], np.int32))

    def _split(self, text: str) -> list[str]:
        """Chunks of the marked text; an empty one for each literal U+2581, which goes in between as bytes."""
        if not text:
            return []
        first, *more = (" " + text).split(SPACE)
        out = self._CHUNK.findall(first.replace(" ", SPACE))
        for p in more:
            out.append("")
            out += self._CHUNK.findall(p.replace(" ", SPACE))
        return out

    def encode_many(self, texts: list[str], keys: list[int]) -> list[bytes]:
        """Ids of each text as packed 32-bit integers; its merges are drawn by its key and their places in the text."""
        if self.held() > CACHE_BYTES:
            self._clear()
        chunks: list[str] = []
        ends = []
        for t in texts:
            chunks += self._split(t)
            ends.append(len(chunks))
        n, counts = len(chunks), np.diff([0, *ends])
        size = np.maximum(np.fromiter(map(len, chunks), np.int64, n), 1)  # a literal U+2581 is one character
        start = np.cumsum(size) - size
        start -= np.repeat(np.append(start, 0)[np.array([0, *ends[:-1]], int)], counts)
        key = np.repeat(np.array(keys, np.uint64), counts)
        long = np.flatnonzero(size > CACHE_CHARS)
        root = np.fromiter(map(self.root.get, chunks, repeat(-1)), np.int64, n)
        root[long] = 0
        unknown = np.flatnonzero(root < 0)
        missing = [chunks[i] for i in unknown.tolist()]
        new = set(missing)
        self.root.update(zip(new, self._grow(len(new)).tolist(), strict=True))
        self.chars += sum(map(len, new))
        root[unknown] = [self.root[c] for c in missing]
        node = root.copy()
        todo = np.arange(n)
        while len(todo):
            here = node[todo]
            stuck = todo[self._walk(here, start[todo], key[todo])]
            node[todo] = here
            self._expand([chunks[i] for i in stuck.tolist()], root[stuck], start[stuck], key[stuck])
            todo = todo[self.piece[here] != END]
        begin, length = self.next[node].astype(np.int64).T
        ids = self.ids
        if len(long):
            made = [np.frombuffer(self.merge_long(chunks[i], int(key[i]), int(start[i])), np.int32) for i in long.tolist()]
            length[long] = [len(x) for x in made]
            begin[long] = self.stored + np.cumsum(length[long]) - length[long]
            ids = np.concatenate([ids[:self.stored], *made])
        stop = np.cumsum(length)
        out = ids[np.arange(length.sum()) + np.repeat(begin - stop + length, length)].astype("<i4")
        cuts = np.append(0, stop)[np.array([0, *ends])]
        return [out[a:b].tobytes() for a, b in pairwise(cuts.tolist())]

    def encode(self, text: str, key: int = 0) -> bytes:
        return self.encode_many([text], [key])[0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.out.__getitem__, ids))[1:].decode()


@lru_cache(maxsize=1)
def _encoder(vocab: Vocabulary, dropout: float, seed: int) -> Encoder:
    """The encoder of a Python worker, which its tasks share."""
    return Encoder(vocab, dropout, seed)


def _groups(texts: pa.Array) -> Iterator[list[str | None]]:
    """Runs of texts of about ``GROUP_CHARS`` characters, decoded one by one."""
    group, size = [], 0
    for x in texts:
        t = x.as_py()
        group.append(t)
        size += len(t or "")
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, vocab: Vocabulary, dropout: float = 0.1, seed: int = 7,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, ids, n_ids, n_chars, lossless (its ids decode to the text).

    The key of a document is a hash of its text, so copies are segmented alike, and a word shows
    different segmentations from document to document and from place to place.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared.value, dropout, seed)
        for b in batches:
            at = 0
            for texts in _groups(b.column(1)):  # a group's results leave before the next is encoded
                packed = enc.encode_many([t or "" for t in texts], [xxhash.xxh64_intdigest(t or "") for t in texts])
                null = [t is None for t in texts]
                chars = [len(t or "") for t in texts]
                ok = [enc.decode(np.frombuffer(p, np.int32).tolist()) == (t or "") for p, t in zip(packed, texts, strict=True)]
                ends = np.cumsum([0, *[len(p) // 4 for p in packed]])
                ids = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)),
                    mask=pa.array(null, pa.bool_()))
                n = pa.array([None if x else (len(p) // 4) for x, p in zip(null, packed, strict=True)], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), ids, n, pa.array(chars, pa.int64()), pa.array(ok, pa.bool_())],
                    names=["doc_id", "ids", "n_ids", "n_chars", "lossless"])
                at += len(texts)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, ids array<int>, n_ids bigint, n_chars bigint, lossless boolean")


def decode(encoded: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Per row of (doc_id, ids): doc_id, text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(shared.value)
        for b in batches:
            texts = [None if (ids := x.as_py()) is None else enc.decode(ids) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def load_vocabulary(spark: SparkSession, path: str | None = None) -> Vocabulary:
    """The vocabulary at ``path`` or at the setting ``carelake.llm.pieces``."""
    return Vocabulary.load(path or spark.conf.get("carelake.llm.pieces", MODEL_PATH))
