"""How five document filters interact, from a sparse document-term matrix.

Documents are cut into shards of bounded text. A shard is a block of rows of the document-term matrix in CSR
form: row pointers, column indices, counts. Its own distinct words, sorted and dealt over buckets by their
hash, travel once to a global dictionary, a row for each bucket; there equal words get one number, and the
numbers travel back in the same order and replace the shard's own. Words are thus hashed and shuffled once
per shard, not once per occurrence. The length of a document is the sum of its row, its number of
distinct words the count of its entries; they decide filters A and B. The other flags are attached, and
documents are counted by source and set of failed filters: all that the 120 orders need.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import staged

FILTERS = "ABCDE"
#: Bytes of text of a shard, unless one document is longer.
SHARD_BYTES = 8 << 20
#: Shards whose words, or whose rows, meet in one task of the global dictionary, on average, at most.
TASK_SHARDS = 4
#: Buckets of words for each shuffle partition of the session, so that many shards can use more tasks than those.
SPLIT = 4
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "#$%&*|"


def _counted(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """CSR of ``texts`` (row pointers, indices, counts), the buckets that hold words, and the words of each, sorted
    and joined by blanks; indices count through these."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary
    row = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy(zero_copy_only=False))
    own = coded.indices.to_numpy(zero_copy_only=False)
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # blanks at either end leave an empty word
    row, own = row[real[own]], own[real[own]]
    in_order = pc.sort_indices(words).to_numpy()
    in_order = in_order[real[in_order]]
    each = words.take(pa.array(in_order)).cast(pa.large_binary()).to_pylist()
    bucket = np.fromiter(map(zlib.crc32, each), np.int64, len(each)) % buckets
    by_bucket = np.argsort(bucket, kind="stable")
    place = np.zeros(len(real), np.int64)
    place[in_order[by_bucket]] = np.arange(len(by_bucket))
    n = max(1, len(by_bucket))
    entry, times = np.unique(row * n + place[own], return_counts=True)
    found, first = np.unique(bucket[by_bucket], return_index=True)
    order = by_bucket.tolist()
    blobs = [b" ".join(map(each.__getitem__, order[lo:hi])).decode() for lo, hi in zip(first, np.r_[first[1:], len(order)])]
    return np.searchsorted(entry // n, np.arange(len(texts) + 1)), (entry % n).astype(np.int32), times.astype(np.int32), found.astype(np.int32), blobs


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(shard, doc_id, part, fails, digest, indptr, indices, data, buckets, words)``, a row per shard.

    ``indices`` count through the words of the shard, sorted inside buckets: ``words`` has a bucket's words,
    joined by blanks, for each of ``buckets``. ``fails`` says per document whether C (1) and D (2) fail;
    ``digest`` is the SHA-256 of the text. To be stored before use, as the shard's number is that of the task.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    n = SPLIT * _partitions(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for b in batches:
            every = pc.fill_null(b.column(1).cast(pa.large_string()), "")
            upto = np.r_[0, np.cumsum(pc.binary_length(every).to_numpy(zero_copy_only=False))]
            start = 0
            while start < b.num_rows:
                end = max(start + 1, int(np.searchsorted(upto, upto[start] + shard_bytes, "right")) - 1)
                texts = every.slice(start, end - start)
                fails, digests = bytearray(), []
                for text in texts.to_pylist():
                    raw = text.encode()
                    caps = len(raw) - len(raw.translate(None, UPPER))
                    fails.append((100 * caps > 2 * len(text)) + 2 * any(m in text for m in MARKS))
                    digests.append(hashlib.sha256(raw).digest())
                indptr, indices, data, buckets, words = _counted(texts, n)
                cells = [(shard, pa.int64()), (b.column(0).slice(start, end - start).to_pylist(), pa.list_(b.schema.field(0).type)), (b.column(2).slice(start, end - start).to_pylist(), pa.list_(pa.string())),
                         (bytes(fails), pa.binary()), (digests, pa.list_(pa.binary())), (indptr.astype(np.int64).tobytes(), pa.binary()), (indices.tobytes(), pa.binary()),
                         (data.tobytes(), pa.binary()), (buckets, pa.list_(pa.int32())), (words, pa.list_(pa.string()))]
                yield pa.record_batch([pa.array([c], t) for c, t in cells], names=["shard", "doc_id", "part", "fails", "digest", "indptr", "indices", "data", "buckets", "words"])
                start, shard = end, shard + 1

    taken = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    return taken.mapInArrow(run, f"shard long, doc_id array<{kind}>, part array<string>, fails binary, digest array<binary>, indptr binary, indices binary, data binary, "
                                 "buckets array<int>, words array<string>")


def _dealt(local: DataFrame) -> DataFrame:
    """``(bucket, shard, at, word, rank)``: every shard's words, dealt over buckets while still joined, and the words' numbers in their bucket."""
    sent = local.select("shard", F.explode(F.arrays_zip("buckets", "words")).alias("x")).select("shard", F.col("x.buckets").alias("bucket"), "x.words")
    tasks = max(_partitions(local), -(-local.count() // TASK_SHARDS))
    each = sent.repartition(tasks, "bucket").select("bucket", "shard", F.posexplode(F.split("words", " ")).alias("at", "word"))
    return each.withColumn("rank", F.dense_rank().over(Window.partitionBy("bucket").orderBy("word")))


def encoded(local: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``shards`` with ``indices`` turned into the 64-bit numbers of the global dictionary, and ``(bucket, first)``.

    A word's number is its place in its bucket plus the sizes of the buckets before it, so numbers run from 0
    without gaps. A shard's numbers travel as one row for each bucket.
    """
    ranks = _dealt(local).groupBy("bucket", "shard").agg(F.sort_array(F.collect_list(F.struct("at", "rank")))["rank"].alias("ranks"))
    ranks = staged(ranks, "ranks", "zstd")
    sizes = ranks.groupBy("bucket").agg(F.max(F.array_max("ranks")).cast("long").alias("n"))  # a row per bucket
    first = sizes.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("first"))
    # Both sides are dealt by shard over so many tasks that each holds a few shards: merged by their compressed bytes, tasks would hold dozens.
    count = local.count()
    tasks = max(1, min(count, _partitions(local)), -(-count // TASK_SHARDS))
    sent = ranks.join(F.broadcast(first), "bucket").select("shard", F.struct("bucket", "first", "ranks").alias("x")).repartition(tasks, "shard")
    codes = sent.groupBy("shard").agg(F.sort_array(F.collect_list("x")).alias("codes"))  # a shard's own words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("indices")
            made = []
            for i in range(b.num_rows):
                codes = b.column("codes")[i].values
                own = np.frombuffer(b.column(at)[i].as_py(), np.int32)
                if codes is None:
                    made.append(b"")
                    continue
                _, first_of, ranks = codes.flatten()
                number = np.repeat(first_of.to_numpy(), ranks.value_lengths().to_numpy()) + ranks.flatten().to_numpy() - 1
                made.append(number[own].astype(np.int64).tobytes())
            yield b.set_column(at, "indices", pa.array(made, pa.binary())).drop_columns(["codes"])

    slim = local.drop("buckets", "words").repartition(tasks, "shard")
    kinds = ", ".join(f"{c} {t}" for c, t in slim.dtypes)
    return slim.join(codes, "shard", "left").select(*slim.columns, "codes").mapInArrow(run, kinds), first


def matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """The document-term matrix of all ``docs`` as stored CSR shards, and its dictionary ``(word, word_id)``, made when used."""
    local = staged(shards(docs, id_col, text_col, part_col, shard_bytes), "shards", "zstd", wide=True)
    csr, first = encoded(local)
    words = _dealt(local).select("bucket", "word", "rank").distinct().join(F.broadcast(first), "bucket")
    return staged(csr, "csr", "zstd", wide=True), words.select("word", (F.col("first") + F.col("rank") - 1).alias("word_id"))


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            ptr = np.frombuffer(b.column("indptr")[i].as_py(), np.int64)
            upto = np.r_[0, np.cumsum(np.frombuffer(b.column("data")[i].as_py(), np.int32), dtype=np.int64)]
            n_words, n_distinct = upto[ptr[1:]] - upto[ptr[:-1]], np.diff(ptr)
            rest = np.frombuffer(b.column("fails")[i].as_py(), np.uint8)
            failed = (n_words < 200) + 2 * (100 * n_distinct < 50 * n_words) + 4 * (rest & 1) + 8 * (rest >> 1)
            yield pa.record_batch([b.column("doc_id")[i].values, b.column("part")[i].values, b.column("digest")[i].values, pa.array(n_words), pa.array(n_distinct), pa.array(failed.astype(np.int32))],
                                  names=["doc_id", "part", "digest", "n_words", "n_distinct", "failed"])


def failures(csr: DataFrame) -> DataFrame:
    """``(doc_id, part, n_words, n_distinct, failed)`` of every document of the shards; ``failed`` adds up 1, 2, 4, 8, 16 for A to E.

    Copies are found by the digest of the text; the smallest id of each comes from one aggregation, and
    only digests of several ids meet the documents again, in a join that splits where a text is hot.
    """
    kind = csr.schema["doc_id"].dataType.elementType.simpleString()
    rows = csr.select("doc_id", "part", "fails", "digest", "indptr", "data").mapInArrow(_flags, f"doc_id {kind}, part string, digest binary, n_words long, n_distinct long, failed int")
    each = csr.select(F.explode(F.arrays_zip("doc_id", "digest")).alias("x")).select("x.doc_id", "x.digest")
    first = each.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("digest", "first")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return rows.join(first, "digest", "left").select("doc_id", "part", "n_words", "n_distinct", (F.col("failed") + 16 * copy).alias("failed"))


def interactions(counted: DataFrame) -> DataFrame:
    """All orders and steps from ``counted (part, failed, docs, good, toxic)``, a row per source and set of failed filters."""
    letters = F.array(*(F.lit(c) for c in FILTERS))
    own = F.concat(*(F.when(F.col("failed").bitwiseAND(1 << i) > 0, c).otherwise("") for i, c in enumerate(FILTERS)))
    rows = counted.withColumn("own", own).withColumn("filter_order", F.explode(F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))))
    first = F.array_min(F.transform(F.filter(letters, lambda c: F.instr(F.col("own"), c) > 0), lambda c: F.instr(F.col("filter_order"), c)))
    rows = rows.withColumn("first", F.coalesce(first, F.lit(6))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(5))))
    fails = F.instr("own", F.substring("filter_order", F.col("step"), F.lit(1))) > 0
    n = lambda when, what: F.sum(F.when(when, what).otherwise(F.lit(0))).cast("long")
    here, docs = F.col("step") == F.col("first"), F.col("docs")
    return rows.groupBy("part", "filter_order", "step").agg(
        n(F.col("step") < F.col("first"), docs).alias("kept"), n(here, docs).alias("removed"), n(fails & (F.col("step") > F.col("first")), docs).alias("redundant"),
        n(fails & (F.length("own") == 1), docs).alias("unique_fails"), n(here, F.col("good")).alias("good_lost"), n(here, F.col("toxic")).alias("toxic_lost"),
        # of the orders of m failed filters, one in m has this one first
        n(fails, docs * F.floor(F.lit(120) / F.greatest(F.length("own"), F.lit(1)))).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``.

    Failing A: under 200 words; B: under half of the words distinct; C: over 2 % of the code points A-Z; D:
    any of ``#$%&*|``; E: text identical to that of a smaller id anywhere. One row per source (null: empty
    string), order of the five and step; counts of documents. ``shapley`` adds up what the step's filter
    removes over all orders.

    A null text is empty, with no words: it fails A. A row with a null id is nobody's copy and has no label;
    rows that repeat an id and text are no copies of each other, and each counts. A document is good or
    toxic if any of its labels says so. An empty table gives no rows. Ids may be of any type that has an
    order; other columns are ignored.
    """
    csr, _ = matrix(docs, id_col, text_col, part_col, shard_bytes)
    kind = docs.schema[id_col].dataType
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    flagged = failures(csr).join(marks, "doc_id", "left")
    counted = flagged.groupBy("part", "failed").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    return interactions(counted)
