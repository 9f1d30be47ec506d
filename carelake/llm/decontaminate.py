"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are reduced to words (ASCII lower case; runs of digits, letters and
characters beyond ASCII). An item of n words may differ by ``k = n // 5`` word edits. It is split
into k + 1 pieces; of any match with k edits, one piece is untouched (pigeonhole), so an automaton
of all pieces finds every place worth a look. There, Myers' bit-parallel distance is run over the
words around, and the item is reported where its distance is at most k.

The items are the query set, searched in all documents in blocks of about ``BLOCK_ITEMS`` items and ``BLOCK_BYTES``
bytes at most, so that a task's automaton and what the driver gathers are bounded however many items there are; the
documents are read once per block.

Cases: null, empty or wordless texts match nothing, and so do such items. Equal items match each
on its own. Repeated rows are reported each; null ids are passed through. Empty tables give an
empty result (``search``) or the documents as they are (``filter_documents``), which keeps all
columns whatever their names. Work stays in the scan's task; no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialize

BLOCK_ITEMS, BLOCK_BYTES = 20_000, 1 << 24
#: One word edit is allowed for so many words of an item.
WORDS_PER_EDIT = 5

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
                  for c in range(256))


def to_words(raw: bytes) -> list[bytes]:
    return raw.translate(_TO_WORDS).split()


def pieces(words: list[bytes], k: int) -> list[tuple[int, list[bytes]]]:
    """k + 1 pieces of nearly equal size, with the place of their first word."""
    n = len(words)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def myers(pattern: list[bytes], text: list[bytes]) -> tuple[int, int]:
    """Smallest edit distance of the pattern to any run of words in the text, and that run's end."""
    peq: dict[bytes, int] = {}
    for i, w in enumerate(pattern):
        peq[w] = peq.get(w, 0) | 1 << i
    n = len(pattern)
    ones, top = (1 << n) - 1, 1 << n - 1
    vp, vn, dist, best, end = ones, 0, n, n, 0
    for j, w in enumerate(text, 1):
        eq = peq.get(w, 0)
        xv = eq | vn
        xh = ((eq & vp) + vp ^ vp) | eq
        hp = vn | ~(xh | vp) & ones
        hn = vp & xh
        if hp & top:
            dist += 1
        elif hn & top:
            dist -= 1
        hp = hp << 1 & ones
        vp = (hn << 1 | ~(xv | hp)) & ones
        vn = hp & xv
        if dist < best:
            best, end = dist, j
    return best, end


class Matcher:
    """Finds a block of items in single texts; one per task."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.items = []
        found: dict[bytes, list[tuple[int, int]]] = {}
        for item_id, raw in items:
            words = to_words(raw)
            if not words:
                continue
            k = len(words) // WORDS_PER_EDIT
            for at, piece in pieces(words, k):
                found.setdefault(b" " + b" ".join(piece) + b" ", []).append((len(self.items), at))
            self.items.append((item_id, words, k))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece.decode("latin-1"), (len(piece), uses))
        if found:
            self.automaton.make_automaton()

    def search(self, raw: bytes) -> list[tuple]:
        """(item id, words of the item, edits allowed, distance, first word after the match)."""
        if not self.items:
            return []
        words = to_words(raw)
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        spans: dict[int, list[list[int]]] = {}
        at = index = 0
        for end, (size, uses) in self.automaton.iter(line):
            start = end - size + 1
            index += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
            at = start
            for item, place in uses:
                _, pattern, k = self.items[item]
                low = max(0, index - place - k)
                high = index - place + len(pattern) + k
                spans.setdefault(item, []).append([low, high])
        out = []
        for item, found in spans.items():
            item_id, pattern, k = self.items[item]
            best, where = k + 1, 0
            for low, high in _joined(found):
                dist, end = myers(pattern, words[low:high])
                if dist < best:
                    best, where = dist, low + end
            if best <= k:
                out.append((item_id, len(pattern), k, best, where))
        return out


def _joined(spans: list[list[int]]) -> list[list[int]]:
    """Overlapping spans as one, so that a text is read once however often its pieces recur."""
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(high, out[-1][1])
        else:
            out.append([low, high])
    return out


def _blocks(benchmark: DataFrame, block_items: int) -> list[DataFrame]:
    """The items in blocks of at most about ``block_items`` items and ``BLOCK_BYTES`` bytes, by a hash of the item."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("i"), F.col("text").alias("t")).where("t is not null")
    count, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    n = max(-(-count // block_items), -(-size // BLOCK_BYTES))
    return [items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b) if n > 1 else items for b in range(n)]


def _items(block: DataFrame) -> list[tuple[int | None, bytes]]:
    return sorted(((r["i"], r["t"].encode()) for r in block.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def search(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, item_words, allowed, distance, end_word. The documents
    are read once per block of items; of several blocks each is finished and let go before the next is gathered."""
    schema = "doc_id bigint, item_id bigint, item_words bigint, allowed bigint, distance bigint, end_word bigint"
    names = [f.split()[0] for f in schema.split(", ")]
    out = docs.sparkSession.createDataFrame([], schema)
    blocks = _blocks(benchmark, block_items)
    for block in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(_items(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for b in batches:
                rows = [(d.as_py(), *hit) for d, t in zip(b.column(0), b.column(1).cast(pa.binary()), strict=True)
                        if (raw := t.as_py()) for hit in matcher.search(raw)]
                cols = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)
        if len(blocks) > 1:
            found = materialize(found, "found")
            shared.destroy()
        out = out.unionByName(found)
    return out


def filter_documents(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The documents in which no item was found, with all their columns; block by block as in ``search``."""
    text = docs.columns.index("text")
    blocks = _blocks(benchmark, block_items)
    for block in blocks:
        shared = docs.sparkSession.sparkContext.broadcast(_items(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value)
            for b in batches:
                clean = [not matcher.search(t.as_py() or b"") for t in b.column(text).cast(pa.binary())]
                yield b.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if len(blocks) > 1:
            docs = materialize(docs, "clean")
            shared.destroy()
    return docs
