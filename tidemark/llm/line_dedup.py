"""Removal of lines that several documents share, by levelled sorted runs of line hashes.

Documents come in batches. The hashes of a batch's lines, one row each with the number of documents and the largest id
that has it, are anti-joined by merging with every run so far; what no run has becomes a run of its own, sorted and
bucketed by hash, so that these joins move only the batch. As soon as a level has ``FAN_IN`` runs they are merged into
one of the next level. Runs hold every hash once; what a batch had in common with them is added up apart from them.

Everything is DataFrame functions. A line's key is the line without white space at its ends and with A-Z in lower case;
keys are compared by 128 bits of hash.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import stored
from tidemark.session import column, shared_folder

# White space, and what makes a line count as shared.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_DOCS = 20, 3
# Parameters: batches of documents (by a hash of the id), runs of a level before they are merged.
BATCHES, FAN_IN = 6, 3
# Keys found in at least one of this many (document, key) pairs are no more than this many, so they can be broadcast.
HOT_KEYS = 1_000
# Rows without an id count as one document below all others.
NO_ID = -(2**63)

KEY = ["h1", "h2"]
TEXT = ["doc", "t1", "t2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def hashes(value: Column, names: list[str]) -> list[Column]:
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit("second"), value).alias(names[1])]


class LineRuns:
    """Levelled sorted runs of ``h1``, ``h2``, ``docs`` and ``keeper``; a hash is in one run only."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN) -> None:
        self.spark, self.fan_in = spark, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.met_again: list[DataFrame] = []
        self.tables: list[str] = []

    def write(self, rows: DataFrame) -> str:
        """A table sorted and bucketed by hash, in the folder all executors share."""
        name = f"line_run_{uuid.uuid4().hex}"
        self.tables.append(name)
        writer = rows.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY)
        writer.option("path", shared_folder(self.spark, "line-run")).saveAsTable(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Takes in the hashes of a batch; ids of batches may come in any order."""
        runs = self.runs()
        incoming = self.write(batch)
        own = incoming
        if runs:
            every = self.spark.table(incoming)
            own = self.write(reduce(lambda rows, run: rows.join(run.hint("merge"), KEY, "left_anti"), runs, every))
            self.met_again.append(every.join(self.spark.table(own).hint("merge"), KEY, "left_anti"))
        self.place(own, 0)

    def place(self, run: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            merged = reduce(DataFrame.unionByName, [self.spark.table(name) for name in self.levels[level]])
            self.levels[level] = []
            self.place(self.write(merged.repartition(self.buckets, *KEY)), level + 1)

    def totals(self) -> DataFrame:
        """Every hash with its documents and the largest id, over all batches."""
        return tallied(reduce(DataFrame.unionByName, [*self.runs(), *self.met_again]))

    def drop(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def tallied(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))


def long_lines(texts: DataFrame, min_chars: int) -> DataFrame:
    """Position and hashes of every line that is long enough, with the id and hashes of its text."""
    lines = texts.where("text IS NOT NULL").select(*TEXT, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.where(F.length("line") >= min_chars).select(*TEXT, "pos", line_key(F.col("line")).alias("key"))
    return lines.where(F.length("key") >= min_chars).select(*TEXT, "pos", *hashes(F.col("key"), KEY))


def shared_lines(lines: DataFrame, min_docs: int, batches: int = BATCHES, fan_in: int = FAN_IN) -> DataFrame:
    """``h1``, ``h2``, ``docs`` and ``keeper`` of lines in at least ``min_docs`` documents; ``lines`` has ``batch``."""
    runs = LineRuns(lines.sparkSession, fan_in)
    for number in range(batches):
        of_batch = lines.where(F.col("batch") == number)
        once = of_batch.groupBy(*KEY, "doc").agg(F.lit(1).cast("long").alias("docs"))
        runs.add(once.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("doc").alias("keeper")))
    found = stored(runs.totals().where(F.col("docs") >= min_docs), "shared-lines")
    runs.drop()
    return found


def dropped_positions(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """``TEXT`` and the sorted positions ``gone`` of lines that another document keeps.

    Lines of the few keys with a large share of all are told apart by a broadcast bounded by ``HOT_KEYS``, so that the
    others can be joined by hash in even parts.
    """
    total = shared.agg(F.sum("docs")).first()[0] or 0
    of_many = F.col("docs") * HOT_KEYS >= F.lit(total)
    hot, others = (shared.where(c).select(*KEY, "keeper") for c in (of_many, ~of_many))
    places = lines.select(*TEXT, "pos", *KEY)
    of_hot = places.join(F.broadcast(hot), KEY)
    of_others = places.join(F.broadcast(hot.select(*KEY)), KEY, "left_anti").join(others, KEY)
    gone = of_hot.unionByName(of_others).where("doc <> keeper")
    return gone.groupBy(*TEXT).agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def kept_text(text: Column, gone: Column) -> Column:
    """The text without the lines at the sorted positions ``gone`` (null: none)."""
    before = F.zip_with(gone, F.concat(F.array(F.lit(-1)), gone), lambda at, last: F.when(at.isNotNull(), at - last - 1))
    keep = F.flatten(F.transform(F.filter(before, lambda n: n.isNotNull()), lambda n: F.concat(F.array_repeat(F.lit(True), n), F.array(F.lit(False)))))
    left = F.zip_with(F.split(text, "\n", -1), keep, lambda line, stays: F.when(F.coalesce(stays, F.lit(True)), line))
    return F.when(gone.isNull(), text).otherwise(F.array_join(left, "\n"))


def without_shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fan_in: int = FAN_IN, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``row`` (the row as it came), ``n_lines``, ``n_dropped`` and ``kept`` (the text that is left) of each row.

    Keys of at least ``min_chars`` code points that are in at least ``min_docs`` documents lose all their lines but
    those of the largest id. Rows with the same id are one document, and so are all rows without an id, which comes
    below all others. A null or empty text is one empty line. An empty table gives an empty one; other columns stay
    in ``row``, whatever their names.
    """
    texts = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("row"),
        F.coalesce(column(id_column).cast("long"), F.lit(NO_ID)).alias("doc"),
        *hashes(column(text_column), ["t1", "t2"]),
        column(text_column).cast("string").alias("text"),
    )
    lines = long_lines(texts, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int"))
    path = shared_folder(docs.sparkSession, "lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = docs.sparkSession.read.schema(lines.schema).parquet(path)
    gone = dropped_positions(lines, shared_lines(lines, min_docs, batches, fan_in))
    text = F.coalesce("text", F.lit(""))
    return texts.join(gone, TEXT, "left").select(
        "row",
        F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        kept_text(text, F.col("gone")).alias("kept"),
    )


def drop_shared_lines(docs: DataFrame, **options) -> DataFrame:
    """The rows and columns of ``docs`` with what is left of each ``text``; a null text becomes empty."""
    left = without_shared_lines(docs, **options)
    name = options.get("text_column", "text")
    return left.select(*[(F.col("kept") if c == name else F.col("row").getField(c)).alias(c) for c in docs.columns])


def line_report(docs: DataFrame) -> DataFrame:
    left = without_shared_lines(docs.select("doc_id", "text"))
    return left.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


LINE_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), places AS (
  SELECT r, doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM texts
), lines AS (
  SELECT r, doc_id, i, parts[i] AS line,
    translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM places
), shared AS (
  SELECT key, max(coalesce(doc_id, {NO_ID + 1})) AS keeper FROM lines WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT coalesce(doc_id, {NO_ID + 1})) >= {MIN_DOCS}
), judged AS (
  SELECT r, doc_id, i, line, coalesce(keeper <> coalesce(doc_id, {NO_ID + 1}), false) AS gone
  FROM lines LEFT JOIN shared USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""
