"""Documents dealt into blocks, and keys of blocks dealt into buckets.

What an operator knows about a key (a pre-token, a word, a pair of words) is made once per key over all
documents and is needed where the documents are. Documents are dealt into blocks by a hash of their id
and text, a bounded amount of text each. A block sends each of its distinct keys once, packed into one
row per bucket; keys are dealt into buckets by hash, so a bucket meets every block's copy of a key. The
reply goes back, in the order of the keys, to the block. Rows are thus few and their sizes even, whatever
the keys' frequencies: a key held by every document is one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most text per block, on average; a block is held in memory by one task.
BLOCK_BYTES = 16 << 20


def block_count(docs: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> int:
    """How many blocks, and as many buckets: the session's shuffle partitions, or more for larger texts."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + size // block_bytes)


def in_blocks(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(block, doc_id, packed)`` dealt by block; ``texts`` unpacks the texts, null ones as empty.

    Texts travel compressed, as they are dealt only to stand beside the answers for their block.
    Identical plans built from it share one exchange.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            packed = pa.array([pack((t.as_py() or "").encode()) for t in b.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed], names=["block", "doc_id", "packed"])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    dealt = own.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("block"), "doc_id", "text")
    kind = docs.schema[id_col].dataType.simpleString()
    return dealt.mapInArrow(run, f"block int, doc_id {kind}, packed binary").repartition(n, "block")


def texts(packed: pa.ChunkedArray) -> Iterator[str]:
    """The texts of a block, one after the other."""
    unpack = zstandard.ZstdDecompressor().decompress
    for x in packed:
        yield unpack(x.as_py()).decode()
