"""Near-duplicates by SetSketch registers: band, estimate by likelihood, verify, connect.

A document's set holds its distinct word shingles (64-bit hashes). Register i is the smallest of
exponentially distributed hashes of all shingles, on a logarithmic scale: K = 1 - log_b(min), cut to
16 bits. Equal sets have equal registers, the registers of a union are the larger ones (``merge``), and two
registers agree the likelier the more similar the sets. Documents that agree in all registers of a
band are candidates; their similarity is estimated jointly from the numbers of registers that are
larger, smaller and equal, by maximum likelihood; a candidate is dropped only if more registers differ than
the binomial tail allows at the threshold and the estimate is as low; all others are verified
on their full sets; verified links are connected into components.

Copies collapse first: texts with equal words are one class, represented by its smallest id; what
follows sees classes only. Within a bucket no pairs are listed. In the first bands all members are compared with one
head (the smallest id), which joins most groups. Of all bands, only buckets that hold several components (open ones) go on:
their members are compared with members of other components (two rounds, each over the buckets still
open), and at last the members outside a bucket's main component with all others, as arrays in blocks
bounded in rows and bytes of sets that emit links only. So no link that
agrees in a band is lost to a cap; a pair at the threshold agrees in no band or is dropped before it is
verified with a probability of at most ``miss()`` (1.4e-5 for the query, 1.7e-5 for
pipeline stages).

Cases: a text without words has an empty set and is linked with nothing. Fewer words than a shingle
make one shingle. Rows with a null id are linked with nothing: component null, kept. Rows
that repeat an id are one document: kept or dropped alike. An empty table gives an
empty result. ``filter_documents`` keeps all columns, whatever their names.

Hot classes, buckets and heads: counted by partial sums, looked up by broadcasts of fewer than 1000
keys, blocks salted.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import inner_join_counted, left_join_counted, materialize
from carelake.llm.components import components

BLOCK, REST_BLOCK = 1024, 512
#: Bytes of sets on one side of a block, on average; sets of at most so many ids are looked up by a broadcast.
BLOCK_BYTES, FEW_IDS = 1 << 23, 500_000
#: Bands whose buckets are compared with their heads before all others are built.
FIRST_BANDS = 4
_ODD = np.random.default_rng(5).integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)
_SCALE = 20.0


@dataclass(frozen=True)
class Settings:
    """Shingle length, threshold in percent, and the sketch: ``bands`` of ``rows`` registers to base ``base``."""

    words: int = 3
    percent: int = 85
    rows: int = 6
    bands: int = 24
    base: float = 1.001

    @property
    def registers(self) -> int:
        return self.rows * self.bands

    def band_miss(self) -> float:
        """Probability that a pair at the threshold agrees in no band."""
        return (1 - (self.percent / 100) ** self.rows) ** self.bands

    def most_differing(self) -> int:
        """The least number of differing registers that a pair at the threshold exceeds with a probability of at most
        a quarter of ``band_miss``. A register differs with at most 1 - similarity, whatever the sizes."""
        return _tail(self.registers, 1 - self.percent / 100, self.band_miss() / 4)[0]

    def miss(self) -> float:
        """Probability, at most, that a pair at the threshold agrees in no band or isn't verified."""
        return self.band_miss() + _tail(self.registers, 1 - self.percent / 100, self.band_miss() / 4)[1]

    def lowest_estimate(self) -> float:
        """The estimate of sets of one size that differ in ``most_differing`` registers."""
        return 1 - self.most_differing() / self.registers


@lru_cache
def _tail(m: int, p: float, most: float) -> tuple[int, float]:
    """The least k that a binomial number exceeds with at most ``most``, and with what probability."""
    above = 0.0
    for k in range(m, 0, -1):
        chance = math.comb(m, k) * p ** k * (1 - p) ** (m - k)
        if above + chance > most:
            return k, above
        above += chance
    return 0, above


#: The contract of op2, and the default of five words and 0.8 for pipeline stages.
QUERY, STAGE = Settings(), Settings(words=5, percent=80, rows=5, bands=28)


def shingles(raw: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    w = raw.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    n = max(1, len(h) - words + 1)
    x = np.zeros(n, np.uint64)
    for j in range(min(words, len(h))):
        x = (x ^ h[j:j + n]) * _ODD[4000 + j % 64]
        x ^= x >> np.uint64(29)
    return np.unique(x * np.uint64(0xBF58476D1CE4E5B9))


def sketch(hashes: np.ndarray, s: Settings) -> np.ndarray:
    """The registers of a set of hashes (not empty)."""
    low = np.full(s.registers, np.uint64(2**64 - 1))
    for a in range(0, len(hashes), 512):
        x = hashes[a:a + 512, None] * _ODD[None, :s.registers]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        np.minimum(low, x.min(axis=0), out=low)
    e = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64)
    k = np.floor(1 - np.log(np.maximum(e, 1e-300) / _SCALE) / math.log(s.base))
    return np.clip(k, 0, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union."""
    return np.maximum(a, b)


def estimate(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, m: int, base: float) -> np.ndarray:
    """Similarity of largest likelihood from the numbers of registers where the first is larger or smaller."""
    u = n_a / (n_a + n_b)
    v, top = 1 - u, np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    chance = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (base - 1) / base) / math.log(base)
    best, value = np.full(len(u), -np.inf), np.zeros(len(u))
    for step in range(201):
        j = top * step / 200
        p, q = chance(u - v * j), chance(v - u * j)
        ll = larger * np.log(p) + smaller * np.log(q) + (m - larger - smaller) * np.log(np.maximum(1 - p - q, 1e-12))
        better = ll > best
        best, value = np.where(better, ll, best), np.where(better, j, value)
    return value


def _likely(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, s: Settings) -> np.ndarray:
    """Which pairs of register rows could reach the threshold."""
    larger, smaller = (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)
    fits = 100 * np.minimum(na, nb) >= s.percent * np.maximum(na, nb)  # sizes bound the similarity
    ok = fits & (larger + smaller <= s.most_differing())
    # the estimate is costly: only for pairs whose share of equal registers leaves it open
    at = np.flatnonzero(fits & ~ok & ((s.registers - larger - smaller) >= (s.lowest_estimate() - 0.1) * s.registers))
    if len(at):
        ok[at] = estimate(larger[at], smaller[at], na[at].astype(float), nb[at].astype(float), s.registers,
                          s.base) >= s.lowest_estimate()
    return ok


def similar(a: np.ndarray, b: np.ndarray, s: Settings) -> bool:
    """Whether two full sets reach the threshold."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= s.percent * (len(a) + len(b) - both)


def sketches(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, class hashes c1 and c2, n (size of its set), regs (null if empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c1, c2, n, regs = [], [], [], []
            for t in b.column(1).cast(pa.binary()):
                raw = t.as_py() or b""
                h = shingles(raw, s.words)
                key = hashlib.blake2b(b" ".join(raw.lower().split()), digest_size=16).digest()
                c1.append(int.from_bytes(key[:8], "little", signed=True))
                c2.append(int.from_bytes(key[8:], "little", signed=True))
                n.append(len(h))
                regs.append(sketch(h, s).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(regs, pa.binary())], names=["doc_id", "c1", "c2", "n", "regs"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, c1 bigint, c2 bigint, n bigint, regs binary")


def _rows(column: pa.Array, s: Settings) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, s.registers)


def _estimated(pairs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Pairs (a, b) that the estimate leaves open."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("regs").alias(f"r{x}"), F.col("n").alias(f"n{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ok = _likely(_rows(b.column(2), s), _rows(b.column(3), s), np.asarray(b.column(4)),
                             np.asarray(b.column(5)), s)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ra", "rb", "na", "nb")
            .mapInArrow(run, "a bigint, b bigint"))


def _verified(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold. The set of b is sent once per block of its pairs."""
    salts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("q"))
    salts = materialize(salts, "heads")
    heads = (salts.join(sets.withColumnRenamed("id", "b"), "b")
             .select("b", F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("salt"), F.lit(None).cast("bigint").alias("a"), "set"))
    rows = (pairs.join(sets.withColumnRenamed("id", "a"), "a").join(salts, "b")
            .select("b", F.pmod(F.xxhash64("a"), F.col("q")).cast("int").alias("salt"), "a", "set"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heads = None, []
        for x in batches:
            a_out, b_out = [], []
            for b, salt, a, data in zip(*[x.column(i).to_pylist() for i in range(4)], strict=True):
                if (b, salt) != at:
                    at, heads = (b, salt), []
                own = np.frombuffer(data, np.uint64)
                if a is None:  # sorts before the pairs of its block
                    heads.append(own)
                    continue
                if any(similar(own, head, s) for head in heads):
                    a_out.append(a)
                    b_out.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    return (heads.unionByName(rows).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())
            .mapInArrow(run, "a bigint, b bigint"))


def _sets(docs: DataFrame, ids: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    """The sets of the documents ``ids`` (a written table of distinct ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t.as_py() or b"", s.words).tobytes() for t in b.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], names=["id", "set"])

    d = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    few = F.broadcast(ids) if ids.count() <= FEW_IDS else ids.hint("shuffle_hash")
    return d.join(few, "id", "left_semi").mapInArrow(run, "id bigint, set binary")


def _label(m: DataFrame, comp: DataFrame | None) -> DataFrame:
    """Members with their component ``c`` so far."""
    if comp is None:
        return m.withColumn("c", F.col("id"))
    return m.join(comp.select(F.col("node").alias("id"), "root"), "id", "left").withColumn(
        "c", F.coalesce("root", "id")).drop("root")


def _open_members(m: DataFrame, seed: int) -> DataFrame:
    """Members of the buckets that hold several components, each with one of another component (``other``). From the second
    round on, buckets of two are settled: their only pair was compared."""
    one = F.struct("c", F.xxhash64("id", F.lit(seed)).alias("h"), "id")
    heads = materialize(m.groupBy("band", "key").agg(F.count(F.lit(1)).alias("cnt"), F.min(one).alias("lo"), F.max(one).alias("hi"))
                        .where("cnt > 1"), "buckets")
    total = heads.agg(F.sum("cnt")).first()[0] or 0
    is_open = (F.col("lo.c") != F.col("hi.c")) & (F.col("cnt") > (1 if seed == 1 else 2))
    other = F.when(F.col("c") != F.col("lo.c"), F.col("lo.id")).otherwise(F.col("hi.id"))
    return inner_join_counted(m, heads.withColumn("open", is_open), ["band", "key"], "cnt", total, F.col("open")).select(
        "id", "n", "band", "key", other.alias("other"))


def _rest(m: DataFrame, classes: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Verified links across the components of a bucket: members outside its main component with all others, in
    blocks of arrays. A pair is looked at for the first band it agrees in only, and a member needs one link
    to each component, so few rows leave a block however many pairs it compares."""
    blocks = lambda rows, elements: F.ceil(F.greatest(
        F.col(rows) / REST_BLOCK, F.col(elements) * 8 / BLOCK_BYTES)).cast("int")
    sizes = m.groupBy("band", "key", "c").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("e"))
    mains = (sizes.groupBy("band", "key").agg(F.sum("k").alias("cnt"), F.sum("e").alias("e"), F.max(F.struct("k", "c", "e")).alias("top"),
                                              F.count(F.lit(1)).alias("parts"))
             .withColumn("out", F.col("cnt") - F.col("top.k")).withColumn("e_out", F.col("e") - F.col("top.e"))
             .select("band", "key", "cnt", "parts", F.col("top.c").alias("main"), blocks("cnt", "e").alias("qm"),
                     blocks("out", "e_out").alias("qs")))
    mains = materialize(mains, "mains")
    total = mains.agg(F.sum("cnt")).first()[0] or 0
    j = inner_join_counted(m.drop("n"), mains, ["band", "key"], "cnt", total, F.expr("parts > 1 and cnt > 2"))
    j = j.join(classes.select("id", "regs", "n").join(sets, "id"), "id")
    slot = lambda q, x: F.pmod(F.xxhash64("id", F.lit(x)), F.col(q)).cast("int")
    every = lambda q: F.explode(F.sequence(F.lit(0), F.col(q) - 1))
    cols = ["band", "key", "id", "c", "regs", "n", "set"]
    right = j.select(*cols, "qs", slot("qm", 1).alias("x")).select(*cols, "x", every("qs").alias("y"), F.lit(0).alias("side"))
    left = (j.where("c <> main").select(*cols, "qm", slot("qs", 2).alias("y"))
            .select(*cols, every("qm").alias("x"), "y", F.lit(1).alias("side")).select(right.columns))

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        band, out = int(key[0]), []
        a, b = g[g["side"] == 1], g[g["side"] == 0]
        rb = np.frombuffer(b"".join(b["regs"]), np.uint16).reshape(-1, s.registers)
        idb, cb, nb = (b[x].to_numpy() for x in ("id", "c", "n"))
        both = set(a["id"].tolist())
        outside = np.array([i in both for i in idb.tolist()], bool)
        held = [np.frombuffer(x, np.uint64) for x in b["set"]]
        for i, c, regs, n, data in zip(a["id"], a["c"], a["regs"], a["n"], a["set"], strict=True):
            ra, own, linked = np.frombuffer(regs, np.uint16), np.frombuffer(data, np.uint64), {c}
            # a pair of two outside members may meet twice in a block: take it once
            use = np.flatnonzero((cb != c) & ~(outside & (idb < i)))
            same = (rb[use] == ra).reshape(len(use), s.bands, s.rows).all(axis=2)
            use = use[same.argmax(axis=1) == band]
            if len(use) == 0:
                continue
            ok = _likely(np.broadcast_to(ra, (len(use), len(ra))), rb[use], np.full(len(use), n), nb[use], s)
            for x in use[ok].tolist():
                if cb[x] not in linked and similar(own, held[x], s):
                    linked.add(cb[x])
                    out.append((i, idb[x]))
        return pd.DataFrame({"a": [x[0] for x in out], "b": [x[1] for x in out]}, dtype="int64")

    return left.unionByName(right).groupBy("band", "key", "x", "y").applyInPandas(run, "a bigint, b bigint")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _join_up(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after more links: the links between components are contracted, the labels mapped."""
    if comp is None:
        return components(links)
    old = comp.select(F.col("node").alias("id"), F.col("root").alias("c"))
    at = lambda d, x: d.join(old.withColumnRenamed("id", x).withColumnRenamed("c", f"c{x}"), x, "left").withColumn(
        f"c{x}", F.coalesce(f"c{x}", x))
    new = components(at(at(links, "a"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    moved = comp.join(new.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select(
        "node", F.coalesce("to", "root").alias("root"))
    added = new.join(comp, "node", "left_anti").select("node", "root")
    return materialize(moved.unionByName(added).distinct(), "components")


def classes_and_components(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text"):
    """(sketches, classes, components of class ids), all as written tables."""
    sk = materialize(sketches(docs, s, id_col, text_col), "sketches")
    classes = materialize(
        sk.where("n > 0 and doc_id is not null").groupBy("c1", "c2")
        .agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("regs").alias("regs")),
        "classes")
    comp, tested = None, None

    def buckets(labelled: DataFrame, bands: int) -> DataFrame:
        width = 2 * s.rows
        key = F.xxhash64("band", F.substring(F.col("regs"), F.col("band") * width + 1, F.lit(width)))
        return labelled.select("id", "c", "n", "regs", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")).select(
            "id", "c", "n", "band", key.alias("key"))

    def of(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
        ids = materialize(ids.distinct(), "ids")
        return (materialize(classes.join(ids, "id", "left_semi").select("id", "n", "regs").dropDuplicates(["id", "regs"]), "candidates"),
                materialize(_sets(docs, ids, s, id_col, text_col), "sets"))

    # the first bands: all members with the head of their bucket
    b = buckets(classes.select("id", "n", "regs", F.col("id").alias("c")), min(FIRST_BANDS, s.bands))
    heads = materialize(b.groupBy("band", "key").agg(F.count(F.lit(1)).alias("cnt"), F.min("id").alias("head"))
                        .where("cnt > 1"), "buckets")
    total = heads.agg(F.sum("cnt")).first()[0] or 0
    pairs = materialize(_ordered(inner_join_counted(b, heads, ["band", "key"], "cnt", total)
                                 .select(F.col("id").alias("a"), F.col("head").alias("b"))), "pairs")
    if not pairs.isEmpty():
        some, sets = of(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))))
        tested = materialize(_estimated(pairs, some, s), "pairs")
        comp = _join_up(None, materialize(_verified(tested, sets, s), "verified"))
    # all bands: members of open buckets
    m = materialize(_open_members(buckets(_label(classes.select("id", "n", "regs"), comp), s.bands), 1), "members")
    if m.isEmpty():
        return sk, classes, comp
    some, sets = of(m.select("id"))
    for step in (1, 2, 3):
        if step > 1:
            m = _label(m.drop("other"), comp)
            m = materialize(_open_members(m, step), "members") if step < 3 else m
            if m.isEmpty():
                break
        if step == 3:
            links = materialize(_rest(m, some, sets, s), "verified")
        else:
            pairs = _ordered(m.select(F.col("id").alias("a"), F.col("other").alias("b")))
            pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
            pairs = materialize(_estimated(pairs, some, s), "pairs")
            tested = pairs if tested is None else tested.unionByName(pairs)
            links = materialize(_verified(pairs, sets, s), "verified")
        if not links.isEmpty():
            comp = _join_up(comp, links)
    return sk, classes, comp


def near_duplicates(docs: DataFrame, s: Settings = QUERY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    sk, classes, comp = classes_and_components(docs, s, id_col, text_col)
    c = _label(classes.select("id", "c1", "c2", "copies"), comp)
    total = classes.agg(F.sum("copies")).first()[0] or 0
    d = left_join_counted(sk.select("doc_id", "c1", "c2", "n"), c.select("c1", "c2", "copies", "c"), ["c1", "c2"], "copies", total)
    linked: Column = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("c")).otherwise(F.col("doc_id"))
    d = d.select("doc_id", F.col("n").alias("n_shingles"), linked.alias("component_id"))
    return d.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def filter_documents(docs: DataFrame, s: Settings = STAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with all columns."""
    gone = near_duplicates(docs, s, id_col, text_col).where(~F.col("kept")).select("doc_id").distinct()
    d = docs.select(F.struct("*").alias("row"))
    left = d.join(gone.hint("shuffle_hash"), F.col("row")[id_col].cast("bigint") == F.col("doc_id"), "left_anti")
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])
