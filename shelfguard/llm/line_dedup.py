r"""Line dedup over range-partitioned line hashes (DataFrame operations only).

Every text is split at ``\n``. A line's key is the line with ``[\x20\x09-\x0D]``
stripped at both ends and A-Z lower-cased; keys shorter than ``min_chars`` code
points are never repeated lines. A key found in at least ``min_docs`` documents
loses all its lines except those of the largest doc_id that holds it.

Method. Lines are hashed once, into a table of (128-bit key digest, doc_id, position), and
dealt out by range of (digest, doc_id), each partition sorted by (digest, doc_id, position).
The lines of one document with one key are then neighbours; a stream over the sorted rows (a window in
the order they are already in) marks the first of each run, which stands for the document. A very frequent
key is a long stretch of documents cut over as many partitions as it needs. Per partition and digest only
a count of firsts and the largest doc_id go on. Documents get back a compressed bitmap of
their lines (32 to a word, words without a dropped line left out), never text.

Defined results: a null or empty text has one empty line; a row without doc_id
is no document: its lines are neither counted nor dropped; repeated rows of one
doc_id and text each get the same answer; rows of one doc_id with different
texts count as one document. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfguard.llm.common import SPACES, ascii_lower, stage

MIN_CHARS, MIN_DOCS = 40, 5
#: Lines that one element of a bitmap covers (bits of a non-negative long).
WORD = 32


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_digests(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k, doc_id, text_id, pos) of every line long enough to count."""
    lines = docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("text_id"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line")
    )
    lines = lines.where(F.char_length("line") >= min_chars).withColumn("key", line_key(F.col("line")))
    return lines.where(F.char_length("key") >= min_chars).select(
        F.unhex(F.md5(F.col("key"))).alias("k"), "doc_id", "text_id", "pos"
    )


def first_occurrences(lines: DataFrame) -> DataFrame:
    """``lines`` with ``first``: whether a line is its document's first with this key.

    The range partitioning on (k, doc_id) holds each such pair in one partition, sorted, so the
    window needs no exchange and no sort of its own.
    """
    dealt = lines.repartitionByRange("k", "doc_id").sortWithinPartitions("k", "doc_id", "text_id", "pos")
    run = Window.partitionBy("k", "doc_id").orderBy("text_id", "pos")
    return dealt.withColumn("first", F.row_number().over(run) == 1)


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text_id, pos) of every line that goes."""
    # Written first: the ranges are cut from a sample of this table, not of the texts once more.
    digests = stage(line_digests(docs, min_chars), "line-digests")
    lines = stage(first_occurrences(digests), "line-stream")
    repeated = (
        lines.where("first").groupBy("k").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")).where(F.col("n_docs") >= min_docs)
    )
    # The repeated keys are a small share of all; written out, both sides of the
    # join are plain scans, and a hot key's stretch can be split at run time.
    repeated = stage(repeated.select("k", "keeper"), "line-repeated")
    gone = lines.join(repeated, "k").where(F.col("doc_id") != F.col("keeper"))
    return gone.select("doc_id", "text_id", "pos")


def keep_bitmaps(gone: DataFrame) -> DataFrame:
    """(doc_id, text_id, drops): ``drops`` maps a block of 32 lines to the bits of
    the lines that go; blocks that lose nothing are left out."""
    block = (F.col("pos") / WORD).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % WORD)
    words = gone.groupBy("doc_id", "text_id", block.alias("block")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("doc_id", "text_id").agg(
        F.map_from_entries(F.collect_list(F.struct("block", "bits"))).alias("drops")
    )


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with kept_text, n_lines, n_dropped."""
    own = {"n_lines", "n_dropped", "kept_text"}
    docs = docs.select(*[c for c in docs.columns if c not in own])
    bitmaps = keep_bitmaps(dropped_positions(docs, min_chars, min_docs))
    rows = docs.alias("d").join(
        bitmaps.alias("b"),
        (F.col("d.doc_id") == F.col("b.doc_id")) & (F.xxhash64(F.col("d.text")) == F.col("b.text_id")),
        "left",
    )
    lines = split_lines(F.col("d.text"))

    def dropped(i: Column) -> Column:
        bits = F.try_element_at("b.drops", (i / WORD).cast("int"))
        return F.coalesce(F.getbit(bits, i % WORD) == 1, F.lit(False))

    kept = F.when(F.col("b.drops").isNull(), F.coalesce("d.text", F.lit(""))).otherwise(
        F.array_join(F.filter(lines, lambda _, i: ~dropped(i)), "\n")
    )
    gone = F.aggregate(
        F.map_values("b.drops"), F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w)
    )
    return rows.select(
        "d.*",
        kept.alias("kept_text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_dropped"),
    )


def op2_line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the kept text."""
    out = line_dedup(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
rep AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, pos, line, (rep.k IS NOT NULL AND doc_id <> keeper) AS gone
  FROM keyed LEFT JOIN rep ON keyed.k = rep.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
