"""Quality rules: base counts per text, and lines that too many documents of a host share.

Lines are normalised (A-Z to lower case, digits to 0, white space to one space) and hashed. Per host,
the distinct documents with a line are counted; lines in more than ``max_docs`` of them are boilerplate and
removed, however large the host. A document that loses too many of its words is rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.common import staged

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
_NORMAL = bytes(48 if 48 <= c <= 57 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def repeated_words(words: list, width: int = 3) -> int:
    """Number of words that lie in a window of ``width`` words which the text holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(width))))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    covered = bytearray(len(words))
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered[i:i + width] = b"\x01" * width
    return sum(covered)


def measures(text: str | None) -> tuple[int, int, int, int, int, dict[int, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the words of each normalised line's hash."""
    text = text or ""
    words = text.encode().split()
    seen, doubled, lines = set(), 0, {}
    for line in text.split("\n"):
        raw = line.encode()
        parts = raw.split()
        if parts:
            doubled += raw in seen
            seen.add(raw)
            h = xxhash.xxh64_intdigest(b" ".join(parts).translate(_NORMAL)) - (1 << 63)
            lines[h] = lines.get(h, 0) + len(parts)
    return (len(words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), doubled, repeated_words(words), lines)


def line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_docs: int = 50,
               min_words: int = 50, max_repeat_pct: int = 50, max_removed_pct: int = 50) -> DataFrame:
    """One row per row of ``docs``: base counts, words lost to shared lines, and the verdict.

    ``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words,
    kept)``. ``base_failed``: fewer than ``min_words`` words, or over ``max_repeat_pct`` percent of the
    words in repeated windows. ``kept``: not failed, and at most ``max_removed_pct`` percent of the words
    lie in removed lines.

    Null texts have no words and fail. A null host counts as the empty host; rows without an id count as
    one document per host. Repeated rows are one document for the counts, and each gets its row. An empty
    table gives no rows; other columns are ignored. Documents of a host are never brought together: lines
    are counted with partial sums, and only lines above the limit are joined back.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [measures(t) for t in b.column(2).to_pylist()]
            lines = [[{"h": h, "w": w} for h, w in g[5].items()] for g in got]
            yield pa.record_batch([b.column(0), b.column(1), *(pa.array([g[k] for g in got], pa.int64()) for k in range(5)),
                                   pa.array(lines, pa.list_(pa.struct([("h", pa.int64()), ("w", pa.int64())])))],
                                  names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"])

    kind = docs.schema[id_col].dataType.simpleString()
    measured = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<h:long,w:long>>")
    own = staged(measured.withColumn("row", F.monotonically_increasing_id()), "lines")
    each = own.select("row", "doc_id", "host", F.inline("lines"))
    counts = each.groupBy("host", "h", "doc_id").agg(F.lit(1).alias("one")).groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
    often = counts.where(F.col("n") > max_docs).select("host", "h")
    lost = each.join(often, ["host", "h"]).groupBy("row").agg(F.sum("w").alias("removed_words"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    removed = F.coalesce("removed_words", F.lit(0)).cast("long")
    return own.drop("lines").join(lost, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), removed.alias("removed_words"),
        (~failed & (100 * removed <= max_removed_pct * F.col("n_words"))).alias("kept"))
