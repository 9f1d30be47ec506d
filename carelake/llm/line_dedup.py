"""Line de-duplication with levelled sorted runs of line hashes.

A run is a table of line keys (two hashes) sorted and bucketed by the key, with the number of
documents that hold the key and the largest of their ids. Each new batch of documents is reduced
to one row per key and merge-anti-joined with the runs: keys that no run holds are ``fresh``, the others count up
a key held before. The batch becomes a run of level 0. When a level has ``fanout`` runs they are merged into one run of
the next level: only the keys of the newer run that are not fresh are joined with the older run, the fresh
ones are added as they are. Runs share their buckets, so these joins need no shuffle. ``dedup`` deals the documents into
``BATCHES`` batches by a hash of their id, so several levels form whatever files the table has.

A line's key is the line stripped of white space at both ends with A-Z in lower case. A key
of ``min_chars`` code points that ``min_docs`` documents hold loses its lines in all
documents but the one with the largest id.

Cases: a null or empty text is one empty line and stays. Rows that repeat an id are one document: it counts once,
and if it has the largest id, all its rows keep their lines. Rows without an id count as no document and
lose the lines that others hold. An empty table gives
an empty result. ``rewrite`` keeps all columns of the input, whatever their names.

Hot lines: keys are counted by partial sums; keys that a large share of all lines have (fewer
than 1000 can) are looked up by a broadcast, the others in a shuffled join. The run tables are dropped once
their counts are written.
"""

from __future__ import annotations

import string
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import WHITE_CHARS, left_join_counted, let, materialize, shared_path

MIN_CHARS = 20
MIN_DOCS = 3
FANOUT = 2
BATCHES = 4


def line_keys(text: Column, min_chars: int = MIN_CHARS) -> Column:
    """The keys of a text's lines by position; null for lines under ``min_chars``."""
    strip = lambda x: F.btrim(x, F.lit(WHITE_CHARS))
    lower = lambda s: F.translate(s, string.ascii_uppercase, string.ascii_lowercase)
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: let(
        strip(x), lambda s: F.when(F.char_length(s) >= min_chars, lower(s))))


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with a key: its document (d), a hash of the text (th), the position and the key's hashes."""
    return (docs.select(F.col(id_col).cast("bigint").alias("d"), F.xxhash64(text_col).alias("th"),
                        F.posexplode(line_keys(F.col(text_col), min_chars)).alias("pos", "k"))
            .where(F.col("k").isNotNull())
            .select("d", "th", "pos", F.xxhash64("k").alias("h1"), F.hash("k").alias("h2")))


@dataclass
class LineRuns:
    """The runs of line hashes of all batches so far, in a database of their own in the shared folder."""

    spark: SparkSession
    fanout: int = FANOUT
    buckets: int = 0
    levels: dict[int, list[DataFrame]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.database = f"line_runs_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE DATABASE {self.database} LOCATION '{shared_path(self.spark, 'lines')}'")

    def runs(self) -> list[DataFrame]:
        """Oldest first."""
        return [r for level in sorted(self.levels, reverse=True) for r in self.levels[level]]

    def _write(self, run: DataFrame) -> DataFrame:
        name = f"{self.database}.run_{uuid.uuid4().hex}"
        run.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name)
        return self.spark.table(name)

    def add(self, lines: DataFrame) -> DataFrame:
        """Add the lines (see ``line_table``) of new documents; returns their run: h1, h2, n_docs, top_doc, fresh."""
        run = lines.groupBy("h1", "h2").agg(F.count_distinct("d").alias("n_docs"), F.max("d").alias("top_doc"))
        # the merge-anti-join, run by run: what none of them matches is fresh
        fresh = F.lit(True)
        for i, old in enumerate(self.runs()):
            run = run.join(old.select("h1", "h2", F.lit(True).alias(f"seen{i}")), ["h1", "h2"], "left")
            fresh = fresh & F.col(f"seen{i}").isNull()
        written = self._write(run.select("h1", "h2", "n_docs", "top_doc", fresh.alias("fresh")))
        self.levels.setdefault(0, []).append(written)
        self._compact()
        return written

    def _compact(self) -> None:
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            merged = self._write(reduce(self._merge, self.levels[level]))
            self.levels[level] = []
            self.levels.setdefault(level + 1, []).append(merged)
            level += 1

    @staticmethod
    def _merge(old: DataFrame, new: DataFrame) -> DataFrame:
        """Both runs' keys with their sums. No run before ``new`` holds its fresh keys, so they meet no join."""
        a = old.select("h1", "h2", *[F.col(c).alias(f"a_{c}") for c in ("n_docs", "top_doc", "fresh")])
        b = new.where(~F.col("fresh")).select("h1", "h2", *[F.col(c).alias(f"b_{c}") for c in ("n_docs", "top_doc")])
        zero = lambda c: F.coalesce(c, F.lit(0))
        met = a.join(b, ["h1", "h2"], "full").select(
            "h1", "h2", (zero("a_n_docs") + zero("b_n_docs")).alias("n_docs"),
            F.greatest("a_top_doc", "b_top_doc").alias("top_doc"), F.coalesce("a_fresh", F.lit(False)).alias("fresh"))
        return met.unionByName(new.where("fresh"))

    def counts(self) -> DataFrame | None:
        """One row per key over all batches: h1, h2, n_docs, top_doc."""
        return reduce(self._merge, self.runs()).drop("fresh") if self.runs() else None

    def drop(self) -> None:
        """Drop the runs' tables and their files."""
        self.levels.clear()
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")


def _lines_to_drop(lines: DataFrame, counts: DataFrame, min_docs: int) -> DataFrame:
    """Per document (its id and a hash of its text): the positions of the lines it loses."""
    drops = counts.where(F.col("n_docs") >= min_docs).select("h1", "h2", "n_docs", "top_doc", F.lit(True).alias("hit"))
    total = drops.agg(F.sum("n_docs")).first()[0] or 0
    found = left_join_counted(lines.select("d", "th", "pos", "h1", "h2"), drops, ["h1", "h2"], "n_docs", total)
    return (found.where(F.col("hit") & ~F.col("d").eqNullSafe(F.col("top_doc")))
            .groupBy("d", "th").agg(F.collect_set("pos").alias("gone")))


def rewrite(docs: DataFrame, counts: DataFrame, lines: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` as a struct ``row``, with ``kept_text``, ``n_lines`` and ``n_dropped``. ``lines`` is their ``line_table``."""
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    gone = _lines_to_drop(lines, counts, min_docs)
    j = docs.select(F.struct("*").alias("row")).join(
        gone.hint("shuffle_hash"),
        F.col("row")[id_col].cast("bigint").eqNullSafe(F.col("d"))
        & (F.xxhash64(F.col("row")[text_col]) == F.col("th")), "left").select("row", "gone")
    j = j.select("row", "gone", F.size(F.split(text, "\n")).alias("n"))
    left = F.array_except(F.sequence(F.lit(0), F.col("n") - 1), "gone")
    kept = let(F.split(text, "\n"), lambda lines: F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    return j.select(
        "row", F.when(F.col("gone").isNull(), text).otherwise(kept).alias("kept_text"),
        F.col("n").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"))


def dedup(docs: DataFrame, batches: int = BATCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count the lines batch by batch, then rewrite all documents. The lines' hashes are written once; each batch
    reads its own part of them."""
    part = F.pmod(F.xxhash64("d"), F.lit(batches)).cast("int").alias("part")
    lines = materialize(line_table(docs, id_col, text_col).select("*", part), "line-hashes", partition_by="part")
    runs = LineRuns(docs.sparkSession)
    for i in range(batches):
        runs.add(lines.where(F.col("part") == i))
    counts = materialize(runs.counts(), "line-counts")
    runs.drop()
    return rewrite(docs, counts, lines, id_col, text_col)
