"""Filter interaction audit: which filter removes what, in every order, from one survival word per document.

A document's failures are a mask of five bits. Its survival word is the truth table of the mask: bit S of 32 is
set if the document survives the subset S of filters, that is if it fails none of them. Positional popcounts
of the words of all documents, by carry-save adders, give the number of survivors of each subset, per part and
label. Everything asked of an order of filters follows from these 32 numbers: a filter removes what its
predecessors' subset keeps and the subset with it does not.

Documents are turned into masks in their own rows. Copies are found by a digest of the text: the smallest id of
each digest by partial sums, looked up through ``left_join_counted``, so a hot text gathers in no task. Labels are
joined by id in the same way. Counts are added up within each task before the one small shuffle by part.

Cases: a null or empty text has no words and fails A; null texts are copies of empty ones. A null source
is the part ''. Null ids have no labels, are copies of nothing and nothing is a copy of them; rows that repeat an id
count each, and are no copies of each other. Repeated labels of an id count as 1 if any does; a null label is 0.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import HOT_PARTS, left_join_counted, materialize

#: The filters, by the bit of their failure: A few words, B few distinct words, C capitals, D symbols, E copies.
FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
#: The survival word of each failure mask.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & f) for f in range(SUBSETS)], np.uint32)
LABELS = ("every", "good", "toxic")
#: Parts whose counts a task holds before it sends them on.
MAX_PARTS = 4096

_CAPITALS = bytes(range(65, 91))
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOL = re.compile(rb"[#$%&*|]")


def text_failures(raw: bytes) -> int:
    """The mask of the filters that a text fails by itself: A to D."""
    words = raw.split()
    points = len(raw.translate(None, _CONTINUATION))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return (len(words) < 50) | (100 * len(set(words)) < 65 * len(words)) << 1 | (100 * capitals > 5 * points) << 2 \
        | (_SYMBOL.search(raw) is not None) << 3


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per document: doc_id, part, digest of its text, mask of the filters A to D it fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, masks = [], []
            for t in b.column(2).cast(pa.binary()):
                raw = t.as_py() or b""
                digests.append(hashlib.blake2b(raw, digest_size=16).digest())
                masks.append(text_failures(raw))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(digests, pa.binary()),
                                              pa.array(masks, pa.int32())], names=["doc_id", "part", "digest", "mask"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, part string, digest binary, mask int")


def with_copies(masks: DataFrame) -> DataFrame:
    """Masks with the bit of filter E."""
    total = masks.count()
    first = masks.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).where("n > 1")
    found = left_join_counted(masks, first, ["digest"], "n", total)
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return found.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(copy, 16).otherwise(0)).alias("mask"))


def with_labels(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Masks with the labels ``good`` and ``toxic`` of their documents."""
    known = masks.where("doc_id is not null")
    total = known.count()
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    lab = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("doc_id"))
           .agg(flag("quality").alias("good"), flag("toxic").alias("toxic")))
    # ids that many rows repeat: fewer than HOT_PARTS, so their counts may be broadcast
    often = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("often")).where(F.col("often") * HOT_PARTS > total)
    lab = lab.join(F.broadcast(often), "doc_id", "left").withColumn("n", F.coalesce("often", F.lit(1))).drop("often")
    no = F.lit(False)
    found = left_join_counted(known, lab, ["doc_id"], "n", total).select(
        "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    return found.unionByName(masks.where("doc_id is null").select("part", "mask", no.alias("good"), no.alias("toxic")))


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many words have each of the 32 bits set.

    Carry-save adders turn three words of one weight into a sum of that weight and a carry of twice
    the weight, for all 32 positions at once; at most two words per weight are left to be read bit by bit.
    """
    total = np.zeros(32, np.int64)
    weight, level = 1, words.astype(np.uint32)
    while len(level):
        carries = []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c = level[:third], level[third:2 * third], level[2 * third:3 * third]
            either = a ^ b
            carries.append((a & b) | (either & c))
            level = np.concatenate([either ^ c, level[3 * third:]])
        for w in level.tolist():
            total += weight * ((w >> np.arange(32)) & 1)
        weight, level = 2 * weight, np.concatenate(carries) if carries else words[:0]
    return total


def survivors(masks: DataFrame) -> DataFrame:
    """Per part: for all documents and each label an array of the survivors of the 32 subsets of filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            rows = list(held.values())
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string())] + [pa.array([r[i].tolist() for r in rows], pa.list_(pa.int64()))
                                                       for i in range(3)], names=["part", *LABELS])
            held.clear()
            return made

        for b in batches:
            codes = b.column(0).dictionary_encode()
            at, names = np.asarray(codes.indices), codes.dictionary.to_pylist()
            words = WORDS[np.asarray(b.column(1))]
            label = [np.asarray(b.column(i)).astype(bool) for i in (2, 3)]
            order = np.argsort(at, kind="stable")
            for mine in np.split(order, np.flatnonzero(np.diff(at[order])) + 1) if len(order) else ():
                w = words[mine]
                rows = np.stack([positional_popcount(x) for x in (w, w[label[0][mine]], w[label[1][mine]])])
                part = names[at[mine[0]]]
                held[part] = held[part] + rows if part in held else rows
            if len(held) > MAX_PARTS:
                yield out()
        if held:
            yield out()

    some = masks.select("part", "mask", "good", "toxic").mapInArrow(
        run, "part string, " + ", ".join(f"{x} array<bigint>" for x in LABELS))
    sums = [F.array(*[F.sum(F.get(F.col(x), F.lit(s))) for s in range(SUBSETS)]).alias(x) for x in LABELS]
    return some.groupBy("part").agg(*sums)


def _shapley(bit: int) -> Column:
    """What a filter removes, summed over all orders: each subset of the others precedes it in |S|! (4 - |S|)! orders."""
    n = len(FILTERS)
    terms = [math.factorial(k) * math.factorial(n - 1 - k) * (F.get("every", F.lit(s)) - F.get("every", F.lit(s | 1 << bit)))
             for s in range(SUBSETS) if not s >> bit & 1 for k in [s.bit_count()]]
    return sum(terms[1:], terms[0])


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    bit = "shiftleft(1, ascii(substring(filter_order, {}, 1)) - 65)"
    d = (counts.withColumn("each", F.array(*[_shapley(i) for i in range(len(FILTERS))]))
         .select("*", F.explode(F.array(*[F.lit(o) for o in orders])).alias("filter_order"))
         .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
         .withColumn("own", F.expr(bit.format("step")))
         .withColumn("before", F.expr(f"aggregate(sequence(1, step), 0, (m, i) -> m | {bit.format('i')}) - own")))
    at = lambda x, s: F.get(F.col(x), s)
    after = F.col("before") + F.col("own")
    gone = lambda x: at(x, F.col("before")) - at(x, after)
    others = F.lit(SUBSETS - 1) - F.col("own")
    return d.select(
        "part", "filter_order", "step", at("every", after).alias("kept"), gone("every").alias("removed"),
        (at("every", F.lit(0)) - at("every", F.col("own")) - gone("every")).alias("redundant"),
        (at("every", others) - at("every", F.lit(SUBSETS - 1))).alias("unique_fails"),
        gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"),
        F.get("each", F.ascii(F.substring("filter_order", F.col("step"), F.lit(1))) - 65).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """The audit of the five filters over ``docs``; masks are written to the shared folder once."""
    masks = materialize(failures(docs, id_col, text_col, part_col), "masks")
    return interactions(survivors(with_labels(materialize(with_copies(masks), "masks"), labels)))
