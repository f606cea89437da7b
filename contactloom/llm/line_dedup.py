"""Lines that many documents share, found with levelled sorted runs of line hashes.

A run is a table of (line hash, documents), bucketed and sorted by the hash.  Each batch of documents is counted, loses
the hashes that are settled already (a merge anti-join of equally bucketed tables, nothing of the settled side moves)
and adds the rest as its own run of level 0.  When a level holds ``fan_in`` runs they are compacted into one of the next
level; hashes that reach ``at_least`` documents leave it for the settled runs.  ``finish`` compacts what is left.

A line's hash is the MD5 of its key, the line stripped of white space and lower-cased (A-Z).  Counts are combined before
every shuffle.  Dropping reads positions only: lines whose hash is among the ``HOT`` most frequent ones meet a broadcast of at
most that many hashes, so no frequent line fills a task; the others are joined with the settled hashes, which stand there
once each.  A document is rebuilt from the positions that stay, in time linear in its lines.

Defined cases: a null or empty text is one empty line; empty keys are never dropped; every row counts as a document, also if
its id or text repeats; a null id is kept; further columns are not read; an empty table gives none; a text that loses
all lines becomes empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.common import lower_ascii, texts
from contactloom.sources.staging import shared_folder, stage

AT_LEAST, MIN_CHARS = 10, 1
FAN_IN, BATCHES = 2, 4
#: Hashes of 16 bytes that are broadcast at most.
HOT = 1 << 16
_WS = " \t\n\x0b\f\r"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keys(text: Column) -> Column:
    """The keys of a text's lines; an ASCII text is lower-cased at once."""
    text = F.coalesce(text, F.lit(""))
    small = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(lower_ascii(text))
    return F.transform(F.split(small, "\n", -1), lambda line: F.btrim(line, F.lit(_WS)))


def line_hash(key: Column) -> Column:
    return F.unhex(F.md5(key))


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(hash, n): in how many rows each key of at least ``min_chars`` characters stands."""
    each = docs.select(F.explode(F.array_distinct(keys(F.col("text")))).alias("key")).where(F.char_length("key") >= max(min_chars, 1))
    return each.groupBy(line_hash(F.col("key")).alias("hash")).agg(F.count(F.lit(1)).alias("n"))


class LineRuns:
    """Levelled runs of line hashes; ``add`` batches, then ``finish``."""

    def __init__(self, spark: SparkSession, at_least: int = AT_LEAST, min_chars: int = MIN_CHARS, fan_in: int = FAN_IN, buckets: int | None = None):
        self.spark, self.at_least, self.min_chars, self.fan_in = spark, at_least, min_chars, max(fan_in, 2)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder, self.tag = shared_folder(spark), uuid.uuid4().hex
        self.levels: list[list[str]] = []
        self.settled: list[str] = []
        self.written = 0

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{self.tag}_{self.written}"
        self.written += 1
        writer = run.write.bucketBy(self.buckets, "hash").sortBy("hash").option("path", f"{self.folder}/{name}")
        writer.format("parquet").saveAsTable(name)
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs as one, by merge joins of equally bucketed tables (a union of such scans followed by a group is not
        planned right by Spark 4.1)."""
        whole = self.spark.table(names[0])
        for name in names[1:]:
            more = self.spark.table(name).withColumnRenamed("n", "m").hint("merge")
            both = F.coalesce("n", F.lit(0).cast("long")) + F.coalesce("m", F.lit(0).cast("long"))
            whole = whole.join(more, "hash", "full").select("hash", both.alias("n"))
        return whole

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def add(self, docs: DataFrame) -> None:
        """Count a batch (doc_id, text) and keep what is not settled as a run of its own."""
        fresh = line_counts(docs, self.min_chars)
        for name in self.settled:
            known = self.spark.table(name).select(F.col("hash").alias("known")).hint("merge")
            # the condition on n keeps the join behind the count; before it, frequent lines would move one by one
            fresh = fresh.join(known, (F.col("hash") == F.col("known")) & (F.col("n") > 0), "left_anti")
        self._push(self._write(fresh), 0)

    def _push(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_in:
            runs, self.levels[level] = self.levels[level], []
            whole = self._write(self._merged(runs))
            self._settle(whole)
            self._push(whole, level + 1)
            self._drop(runs)

    def _settle(self, name: str) -> None:
        """Frequent hashes of a compacted run; few, so the run keeps them, and later batches lose them."""
        self.settled.append(self._write(self.spark.table(name).where(F.col("n") >= self.at_least)))
        if len(self.settled) > self.fan_in:
            runs, self.settled = self.settled, []
            self.settled.append(self._write(self._merged(runs)))
            self._drop(runs)

    def finish(self) -> DataFrame:
        """(hash, n) of all lines found in ``at_least`` documents; n counts those seen until a hash was settled."""
        left = [name for level in self.levels for name in level]
        if not left:
            return self.spark.createDataFrame([], "hash binary, n bigint")
        whole = stage(self._merged(left).where(F.col("n") >= self.at_least))
        self._drop(left + self.settled)
        self.levels, self.settled = [], []
        return whole


def drop_lines(docs: DataFrame, frequent: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text without the lines whose hash is in ``frequent``."""
    docs = texts(docs)
    own = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")))))
    each = docs.select(own.alias("row"), F.posexplode(keys(F.col("text"))).alias("place", "key")).where(F.char_length("key") >= max(min_chars, 1))
    each = each.select("row", "place", line_hash(F.col("key")).alias("hash"))
    hot = stage(frequent.orderBy(F.desc("n"), "hash").limit(HOT).select("hash"))
    rest = frequent.join(F.broadcast(hot), "hash", "left_anti").select("hash")
    often = F.broadcast(hot.withColumn("often", F.lit(True)))
    marked = each.join(often, "hash", "left")
    hits = marked.where("often").select("row", "place").unionByName(
        marked.where("often IS NULL").join(rest, "hash", "left_semi").select("row", "place")
    )
    gone = hits.groupBy("row").agg(F.collect_set("place").alias("gone"))
    back = docs.withColumn("row", own).join(gone, "row", "left").withColumn("lines", lines(F.col("text")))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = F.array_except(places, F.coalesce("gone", F.array().cast("array<int>")))
    kept = F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n"))
    return back.withColumn("stay", stay).select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"), kept.alias("kept"),
    )


def batches(docs: DataFrame, number: int = BATCHES) -> list[DataFrame]:
    """A table of Parquet files as batches of whole files, each of which is read once."""
    files = sorted(docs.inputFiles())
    if len(files) < 2:
        return [docs]
    spark = docs.sparkSession
    return [spark.read.schema(docs.schema).parquet(*files[i::number]) for i in range(min(number, len(files)))]


def deduplicate(parts: list[DataFrame], docs: DataFrame, at_least: int = AT_LEAST, min_chars: int = MIN_CHARS) -> DataFrame:
    """``drop_lines`` of ``docs`` by the lines that its ``parts`` share."""
    runs = LineRuns(docs.sparkSession, at_least, min_chars)
    for part in parts:
        runs.add(texts(part))
    return drop_lines(docs, runs.finish(), min_chars)
