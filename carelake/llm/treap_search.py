"""Ranked lexical search with K2-treaps over the term-document grid.

A shard holds some thousand documents: its grid has a row per term and a column per document (by ascending id),
and a cell holds the impact of the term in the document. The grid is stored as a K2-treap: a quadtree whose nodes are
a mask of the quadrants that hold cells, and the largest impact below, stored as its difference from the
parent's. Rows are ordered by the number of documents and the first of them, so that cells lie close together.

A query of several terms descends the paths of its rows jointly: a state is a range of documents with the node of each row
in that range; its bound is the weighted sum of the nodes' maxima. States are expanded best-first, the best
ones of a level together as arrays, until no bound reaches the score of the last place: the result is
exact, ties included, however few documents were looked at.

A first pass counts documents and terms (impacts need the mean length) on the texts' bytes in arrays; the index is then built in the tasks that read
the documents, without a shuffle, every document in one shard, and written to the shared folder. Queries go
through the index in blocks of bounded size. A shard answers with its best documents, which are
ranked in two steps (per item and salt, then per item), so that an item's rows gather in no task.

A score is integer: the sum over the query's terms, repeats included, of w * ((10^9 tf) div (1000 tf + 12 m)), with
w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 75 + (25 n N) div L.

Cases: a null or empty text has no terms; such a document is not counted and never found, such an item finds nothing.
Repeated rows are documents, or items, of their own, also if they share an id. A null id sorts before
all others. Very long texts are cut into words piece by piece. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import materialize

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes outside terms become spaces, A-Z lower case.
_FOLD = bytes(32 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F
              else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_IN_TERM = np.frombuffer(_FOLD, np.uint8) != 32
TOP = 20
#: Bounds of a shard (documents, cells, bytes of text), of a query block (bytes of its terms) and of a step of the descent.
SHARD_DOCS, SHARD_CELLS, SHARD_BYTES = 4096, 1 << 21, 1 << 25
BLOCK_BYTES, BEAM, PIECE = 1 << 20, 512, 1 << 20
SALTS = 64
_POP = np.array([bin(x).count("1") for x in range(16)], np.int64)
_IMPACT_BITS = 20

INDEX_SCHEMA = "shard bigint, ids array<bigint>, terms binary, dfs binary, tree binary"


def pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    start = 0
    while start < len(raw):
        end = min(start + PIECE, len(raw))
        while end < len(raw) and _FOLD[raw[end]] != 32:
            end += 1
        yield raw[start:end].translate(_FOLD).split()
        start = end


def _slice(data: pa.Buffer | None, start: int, end: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8, end - start, start) if end > start else np.zeros(0, np.uint8)


def term_counts(texts: pa.Array) -> np.ndarray:
    """How many terms each text has: the places where a byte of a term follows none, counted in runs of texts of bounded size."""
    raw = pc.fill_null(texts.cast(pa.binary()), b"")
    ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1].astype(np.int64)
    data, out, i = raw.buffers()[2], np.zeros(len(raw), np.int64), 0
    while i < len(raw):
        j = max(int(np.searchsorted(ends, ends[i] + PIECE, "right")) - 1, i + 1)
        part, cuts = _slice(data, int(ends[i]), int(ends[j])), ends[i:j + 1] - ends[i]
        inside = _IN_TERM[part]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first = cuts[:-1][cuts[:-1] < cuts[1:]]  # a text's first byte follows none
        begins[first] = inside[first]
        out[i:j] = np.diff(np.searchsorted(np.flatnonzero(begins), cuts))
        i = j
    return out


# ------------------------------------------------------------------ the tree


def _spread(x: np.ndarray) -> np.ndarray:
    """The lower 32 bits of each number with a zero before each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


@dataclass
class K2Treap:
    """Quadtree levels from the root: masks of the quadrants that hold cells, and each node's largest value."""

    depth: int
    masks: list[np.ndarray]
    maxima: list[np.ndarray]
    first: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.first = [np.concatenate([[0], np.cumsum(_POP[m])[:-1]]).astype(np.int64) for m in self.masks]

    @classmethod
    def build(cls, rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> K2Treap:
        """The tree of distinct cells (at least one) with values from 0 to 2^20 - 1."""
        depth = max(int(rows.max()).bit_length(), int(cols.max()).bit_length(), 1)
        at = (_spread(rows) << np.uint64(1)) | _spread(cols)
        if 2 * depth + _IMPACT_BITS <= 64:  # place and value fit one number: sort it
            packed = np.sort((at << np.uint64(_IMPACT_BITS)) | values.astype(np.uint64))
            at = packed >> np.uint64(_IMPACT_BITS)
            top = (packed & np.uint64((1 << _IMPACT_BITS) - 1)).astype(np.int64)
        else:
            order = np.argsort(at)
            at, top = at[order], values[order].astype(np.int64)
        masks, maxima = [], [top]
        for _ in range(depth):
            up = at >> np.uint64(2)
            starts = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]]))
            masks.append(np.bitwise_or.reduceat(np.left_shift(1, (at & np.uint64(3)).astype(np.int64)), starts).astype(np.uint8))
            top, at = np.maximum.reduceat(top, starts), up[starts]
            maxima.append(top)
        return cls(depth, masks[::-1], maxima[::-1])

    def pack(self) -> bytes:
        """Masks and differences of maxima from the parents', compressed; the sizes follow from the masks."""
        down = [np.repeat(up, _POP[m]) - low for up, m, low in zip(self.maxima, self.masks, self.maxima[1:], strict=False)]
        body = b"".join(m.tobytes() for m in self.masks) + b"".join(d.astype(np.uint32).tobytes() for d in down)
        return struct.pack("<IQ", self.depth, int(self.maxima[0][0])) + zstandard.ZstdCompressor(3).compress(body)

    @classmethod
    def unpack(cls, data: bytes) -> K2Treap:
        depth, root = struct.unpack_from("<IQ", data)
        body = zstandard.ZstdDecompressor().decompress(data[12:])
        masks, n, at = [], 1, 0
        for _ in range(depth):
            masks.append(np.frombuffer(body, np.uint8, n, at))
            n, at = int(_POP[masks[-1]].sum()), at + n
        maxima = [np.array([root], np.int64)]
        for m in masks:
            up = np.repeat(maxima[-1], _POP[m])
            maxima.append(up - np.frombuffer(body, np.uint32, len(up), at).astype(np.int64))
            at += 4 * len(up)
        return cls(depth, masks, maxima)

    def best(self, rows: np.ndarray, weights: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) of the ``top`` columns with the largest weighted sums over ``rows`` above 0, equal sums by
        column. All rows descend jointly; a state is dropped once ``top`` leaves are better."""
        cols, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        # per level: column prefixes, bounds, and the node of each row (-1: no cell below)
        start = np.zeros((1, len(rows)), np.int64)
        level = {0: (np.zeros(1, np.int64), (weights * self.maxima[0][0]).sum(keepdims=True), start)}
        while level:
            at = max(level, key=lambda x: (int(level[x][1].max()), x))
            prefix, bound, nodes = level.pop(at)
            if len(bound) > BEAM:
                order = np.argsort(-bound, kind="stable")
                rest, order = order[BEAM:], order[:BEAM]
                level[at] = prefix[rest], bound[rest], nodes[rest]
                prefix, nodes = prefix[order], nodes[order]
            mask = np.where(nodes >= 0, self.masks[at][nodes], 0)
            lower = 2 * ((rows >> (self.depth - 1 - at)) & 1)  # the quadrant of each row's half, left column
            new = []
            for right in (0, 1):
                bit = lower + right
                child = np.where((mask >> bit) & 1, self.first[at][nodes] + _POP[mask & ((1 << bit) - 1)], -1)
                value = (np.where(child >= 0, self.maxima[at + 1][child], 0) * weights).sum(axis=1)
                new.append((2 * prefix + right, value, child))
            prefix, bound, nodes = (np.concatenate([n[i] for n in new]) for i in range(3))
            live = bound > 0
            if at + 1 == self.depth:
                cols, scores = np.concatenate([cols, prefix[live]]), np.concatenate([scores, bound[live]])
                order = np.lexsort((cols, -scores))[:top]
                cols, scores = cols[order], scores[order]
            elif live.any():
                if at + 1 in level:
                    old = level[at + 1]
                    level[at + 1] = tuple(np.concatenate([o, n[live]]) for o, n in zip(old, (prefix, bound, nodes), strict=True))
                else:
                    level[at + 1] = prefix[live], bound[live], nodes[live]
            if len(cols) == top:
                least, last = scores[-1], cols[-1]
                for x in list(level):
                    p, b, n = level[x]
                    ok = (b > least) | ((b == least) & ((p << (self.depth - x)) < last))
                    if ok.all():
                        continue
                    if ok.any():
                        level[x] = p[ok], b[ok], n[ok]
                    else:
                        del level[x]
        return cols, scores


# ------------------------------------------------------------------ the index


class _Shard:
    """Documents gathered for one grid."""

    def __init__(self) -> None:
        self.vocab: defaultdict[bytes, int] = defaultdict()
        self.vocab.default_factory = self.vocab.__len__
        self.ids, self.terms, self.tfs, self.ns, self.cells, self.bytes = [], [], [], [], 0, 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        """Add a document if it has terms."""
        found, total = [], 0
        for words in pieces(raw):
            if words:
                found.append(np.fromiter(map(self.vocab.__getitem__, words), np.int64, len(words)))
                total += len(words)
        if not total:
            return
        terms, tf = np.unique(found[0] if len(found) == 1 else np.concatenate(found), return_counts=True)
        self.ids.append(doc_id)
        self.terms.append(terms)
        self.tfs.append(tf)
        self.ns.append(total)
        self.cells += len(terms)
        self.bytes += len(raw)

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.cells >= SHARD_CELLS or self.bytes >= SHARD_BYTES

    def row(self, number: int, n_docs: int, n_terms: int) -> dict:
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is not None, self.ids[i] or 0))
        terms = np.concatenate([self.terms[i] for i in order])
        tf = np.concatenate([self.tfs[i] for i in order])
        cols = np.repeat(np.arange(len(order)), [len(self.terms[i]) for i in order])
        m = np.repeat([75 + 25 * self.ns[i] * n_docs // n_terms for i in order], [len(self.terms[i]) for i in order])
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * m)
        df = np.bincount(terms, minlength=len(self.vocab))
        first = np.full(len(self.vocab), len(order), np.int64)
        np.minimum.at(first, terms, cols)
        rank = np.lexsort((first, -df))  # frequent terms first, rare ones by their first document
        rows = np.empty(len(rank), np.int64)
        rows[rank] = np.arange(len(rank))
        names = np.array(list(self.vocab), dtype=object)[rank]
        pack = zstandard.ZstdCompressor(3).compress
        return {"shard": number, "ids": [self.ids[i] for i in order], "terms": pack(b" ".join(names.tolist())),
                "dfs": pack(df[rank].astype(np.uint32).tobytes()), "tree": K2Treap.build(rows[terms], cols, impact).pack()}


@dataclass(frozen=True)
class Index:
    """Shards in the shared folder, and the counts N and L of their documents."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index every row of ``docs``."""
    d = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = term_counts(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([np.count_nonzero(n)], pa.int64()), pa.array([n.sum()], pa.int64())],
                                             names=["docs", "terms"])

    n_docs, n_terms = d.select("text").mapInArrow(counted, "docs bigint, terms bigint").agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("docs", "terms")]).first()
    schema = pa.schema([("shard", pa.int64()), ("ids", pa.list_(pa.int64())), ("terms", pa.binary()), ("dfs", pa.binary()),
                        ("tree", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        shard = _Shard()
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                shard.add(i, t.as_py() or b"")
                if shard.full():
                    yield pa.RecordBatch.from_pylist([shard.row(number, n_docs, n_terms)], schema)
                    shard, number = _Shard(), number + 1
        if shard.ids:
            yield pa.RecordBatch.from_pylist([shard.row(number, n_docs, n_terms)], schema)

    return Index(materialize(d.mapInArrow(run, INDEX_SCHEMA), "treap"), n_docs, n_terms)


# ------------------------------------------------------------------ queries


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Items with their distinct terms and counts, numbered in blocks of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        block, held, at = (task.partitionId() if task else 0) << 32, 0, 0
        for b in batches:
            rows = {x: [] for x in ("block", "at", "terms", "counts")}
            for t in b.column(1).cast(pa.binary()):
                counts: dict[bytes, int] = {}
                for words in pieces(t.as_py() or b""):
                    for w in words:
                        counts[w] = counts.get(w, 0) + 1
                size = 16 + sum(map(len, counts))
                if held + size > BLOCK_BYTES and held:
                    block, held, at = block + 1, 0, 0
                rows["block"].append(block)
                rows["at"].append(at)
                rows["terms"].append(list(counts))
                rows["counts"].append(list(counts.values()))
                held, at = held + size, at + 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(rows["block"], pa.int64()), pa.array(rows["at"], pa.int64()),
                 pa.array(rows["terms"], pa.list_(pa.binary())), pa.array(rows["counts"], pa.list_(pa.int64()))],
                names=["item_id", "block", "at", "terms", "counts"])

    return items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"item_id {items.schema[id_col].dataType.simpleString()}, block bigint, at bigint, terms array<binary>, counts array<bigint>")


def _names(blob: bytes) -> pa.Array:
    return pa.array(zstandard.ZstdDecompressor().decompress(blob).split(b" "), pa.binary())


def _frequencies(index: Index, terms: list[bytes]) -> np.ndarray:
    """How many documents hold each term: the shards' numbers, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(terms, pa.binary())
        total = np.zeros(len(terms), np.int64)
        for b in batches:
            for names, dfs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                df = np.frombuffer(zstandard.ZstdDecompressor().decompress(dfs), np.uint32)
                row = pc.fill_null(pc.index_in(wanted, value_set=_names(names)), -1).to_numpy()
                total += np.where(row >= 0, df[row], 0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["t", "df"])

    found = index.shards.select("terms", "dfs").mapInArrow(run, "t bigint, df bigint").groupBy("t").agg(F.sum("df")).collect()
    df = np.zeros(len(terms), np.int64)
    for t, n in found:
        df[t] = n
    return df


def _search_block(index: Index, rows: list, top: int) -> DataFrame:
    """The best documents of each shard for the items of one block: block, at, shard, doc_id, score."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    queries = [(r["block"], r["at"], np.array([number[bytes(t)] for t in r["terms"]], np.int64), np.array(r["counts"], np.int64))
               for r in rows if r["terms"]]
    terms = list(number)
    df = _frequencies(index, terms)
    weight = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(terms, pa.binary())
        for b in batches:
            for i in range(b.num_rows):
                ids, tree = b.column(1)[i].values, K2Treap.unpack(b.column(3)[i].as_py())
                place = pc.fill_null(pc.index_in(wanted, value_set=_names(b.column(2)[i].as_py())), -1).to_numpy()
                out = []
                for block, at, held, counts in queries:
                    here = place[held] >= 0
                    if here.any():
                        cols, scores = tree.best(place[held][here], (weight[held] * counts)[here], top)
                        out.append((block, at, cols, scores))
                if not out:
                    continue
                n = [len(x[2]) for x in out]
                cols = np.concatenate([x[2] for x in out])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([x[0] for x in out], n), pa.int64()), pa.array(np.repeat([x[1] for x in out], n), pa.int64()),
                     pa.array(np.full(len(cols), b.column(0)[i].as_py()), pa.int64()), ids.take(pa.array(cols)),
                     pa.array(np.concatenate([x[3] for x in out]))], names=["block", "at", "shard", "doc_id", "score"])

    return index.shards.select("shard", "ids", "terms", "tree").mapInArrow(
        run, "block bigint, at bigint, shard bigint, doc_id bigint, score bigint")


def search(index: Index, items: DataFrame, top: int = TOP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Per item the ``top`` documents with the highest scores above 0: item_id, rank, doc_id, score."""
    held = materialize(_items(items, id_col, text_col), "items")
    found = None
    for (block,) in held.select("block").distinct().orderBy("block").collect():
        part = _search_block(index, held.where(F.col("block") == block).collect(), top)
        # the driver holds one block at a time
        part = materialize(part, "found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return held.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"),
                           F.lit(0).cast("bigint").alias("score")).limit(0)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    salt = F.pmod(F.xxhash64("shard"), F.lit(SALTS))
    some = found.withColumn("salt", salt).withColumn(
        "r", F.row_number().over(Window.partitionBy("block", "at", "salt").orderBy(*order))).where(F.col("r") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("block", "at").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(held.select("item_id", "block", "at"), ["block", "at"]).select("item_id", "rank", "doc_id", "score")
