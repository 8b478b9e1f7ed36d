"""Token counts without token ids: pieces are counted once per distinct pre-token.

The vocabulary is a sentencepiece BPE model. In it no piece holds a blank after another character, and
none holds a line feed, so merges never cross those places: a text is a sequence of pre-tokens (blanks
and what follows them up to the next blank; line feeds) that are encoded independently, and the number
of a text's tokens is the sum over its pre-tokens. Both facts are checked when the model is loaded.

Documents are dealt into blocks. Each block sends its distinct pre-tokens to buckets by hash; a bucket
counts the pieces of each distinct pre-token once and sends the counts back; the block joins them to its
documents' pre-token frequencies and sums.
"""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.blocks import block_count, in_blocks, texts

BLANK = "▁"
PRE_TOKEN = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a whole text; blanks are written as the vocabulary does."""
    return PRE_TOKEN.findall(BLANK + text.replace(" ", BLANK)) if text else []


def processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_boundaries(model: bytes) -> None:
    """Raises if some piece of the vocabulary could join two pre-tokens."""
    sp = processor(model)
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)) and ("\n" in piece or re.search(f"[^{BLANK}]{BLANK}", piece)):
            raise ValueError(f"piece {piece!r} crosses pre-tokens; this vocabulary needs other boundaries")


def piece_counts(model: bytes, tokens: list[str]) -> list[int]:
    """Number of pieces of each pre-token."""
    sp = processor(model)
    # A line feed in front keeps the blank that the library puts before a text out of the pre-token.
    extra = len(sp.encode("\n"))
    return [len(x) - extra for x in sp.encode(["\n" + t.replace(BLANK, " ") for t in tokens], num_threads=1)]


def _sent(packed: pa.ChunkedArray, buckets: int) -> list[list[str]]:
    """The distinct pre-tokens of a block without the line feed, dealt into buckets, sorted."""
    distinct: set[str] = set()
    for t in texts(packed):
        distinct.update(pre_tokens(t))
    distinct.discard("\n")
    out: list[list[str]] = [[] for _ in range(buckets)]
    for t in sorted(distinct):
        out[xxhash.xxh64_intdigest(t) % buckets].append(t)
    return out


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``: the library's count of the whole text.

    No begin, end or added special tokens; strings of special tokens inside a text are ordinary text.
    Null and empty texts have no bytes and no tokens. Rows with a null id and repeated rows each get
    their row. An empty table gives no rows; other columns are ignored. ``model_path`` is read on the
    driver and sent along.
    """
    model = Path(model_path).read_bytes()
    check_boundaries(model)
    line_feed = piece_counts(model, ["\n"])[0]
    n = block_count(docs, text_col)
    blocks = in_blocks(docs, n, id_col, text_col)

    def send(f: pa.Table) -> pa.Table:
        sent = _sent(f["packed"], n)
        pack = zstandard.ZstdCompressor(level=3).compress
        used = [k for k, t in enumerate(sent) if t]
        return pa.table({"bucket": pa.array(used, pa.int32()), "block": pa.array([f["block"][0].as_py()] * len(used), pa.int32()),
                         "tokens": pa.array([pack("\n".join(sent[k]).encode()) for k in used], pa.binary())})

    def reply(f: pa.Table) -> pa.Table:
        each = [t.split("\n") for t in texts(f["tokens"])]
        distinct = sorted(set().union(*each))
        size = dict(zip(distinct, piece_counts(model, distinct)))
        pack = zstandard.ZstdCompressor(level=3).compress
        sizes = [pack(np.array([size[t] for t in ts], np.int32).tobytes()) for ts in each]
        return pa.table({"block": f["block"], "bucket": f["bucket"], "sizes": pa.array(sizes, pa.binary())})

    def total(f: pa.Table, replies: pa.Table) -> pa.Table:
        sent = _sent(f["packed"], n)
        unpack = zstandard.ZstdDecompressor().decompress
        size = {"\n": line_feed}
        for bucket, sizes in zip(replies["bucket"].to_pylist(), replies["sizes"].to_pylist()):
            size.update(zip(sent[bucket], np.frombuffer(unpack(sizes), np.int32).tolist()))
        n_bytes, n_tokens = [], []
        for text in texts(f["packed"]):
            n_bytes.append(len(text.encode()))
            n_tokens.append(sum(size[t] * k for t, k in Counter(pre_tokens(text)).items()))
        return pa.table({"doc_id": f["doc_id"], "n_bytes": pa.array(n_bytes, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64())})

    kind = docs.schema[id_col].dataType.simpleString()
    sent = blocks.groupBy("block").applyInArrow(send, "bucket int, block int, tokens binary")
    replies = sent.groupBy("bucket").applyInArrow(reply, "block int, bucket int, sizes binary")
    out = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(total, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
