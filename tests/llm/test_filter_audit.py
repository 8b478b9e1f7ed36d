from itertools import permutations

import numpy as np
import pyarrow.parquet as pq
import pytest

from recsift.llm import filter_audit
from tests.llm import brute

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def failing(docs):
    """(part, letters) of every row, one by one."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, s in docs:
        t = t or ""
        words = brute.WORD.findall(t)
        bad = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
               "D": any(c in "#$%&*|" for c in t), "E": i is not None and least[t] < i}
        yield i, s or "", {k for k, v in bad.items() if v}


def expected(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, x in labels if x == 1} - {None}
    rows = list(failing(docs))
    out = {}
    for part in {p for _, p, _ in rows}:
        own = [(i, f) for i, p, f in rows if p == part]
        removed = {}
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, c in enumerate(order, 1):
                gone = [i for i, f in left if c in f]
                left = [(i, f) for i, f in left if c not in f]
                removed[c] = removed.get(c, 0) + len(gone)
                out[part, order, step] = (len(left), len(gone), sum(c in f for _, f in own) - len(gone), sum(f == {c} for _, f in own),
                                          sum(i in good for i in gone), sum(i in toxic for i in gone), c)
        for key, row in out.items():
            if key[0] == part:
                out[key] = (*row[:6], removed[row[6]]) if isinstance(row[6], str) else row
    return out


def got(df):
    rows = [tuple(r) for r in df.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()]
    assert len({r[:3] for r in rows}) == len(rows)
    return {r[:3]: r[3:] for r in rows}


def test_audit_against_one_row_at_a_time(spark):
    docs, labels = brute.table("documents", "doc_id, text, source"), brute.table("labels", "doc_id, quality, toxic")
    result = got(filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), shard_bytes=40_000))
    assert result == expected(docs, labels) and len(result) == 600 * len({s for _, _, s in docs})


@pytest.mark.parametrize("shard_bytes", [1, 1 << 20])
def test_edge_rows(spark, shard_bytes):
    long = "w " * 60_000 + "x"
    docs = [(1, "a b c", "s"), (1, "a b c", "s"), (2, "a b c", None), (3, None, None), (4, "", "s"), (None, "a b c", "s"), (None, None, None), (5, long, "t"), (6, long, "s"),
            (7, " ".join(f"w{i}" for i in range(200)), "s"), (8, "A\x85b c\x1cd\ve", "t"), (9, "É" * 99 + "AB", "t")]
    labels = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS + ", part int, word_id string")
    marks = spark.createDataFrame(labels, LABELS)
    assert got(filter_audit.audit(frame, marks, shard_bytes=shard_bytes)) == expected(docs, labels)
    assert filter_audit.audit(frame.limit(0), marks).collect() == []
    texts = frame.withColumn("doc_id", frame.doc_id.cast("string"))
    assert got(filter_audit.audit(texts, marks.limit(0))) == expected(docs, [])


def test_matrix_is_that_of_the_words(spark):
    docs = [(i, t, s) for i, t, s in brute.table("documents", "doc_id, text, source")]
    csr, words = filter_audit.matrix(spark.createDataFrame(docs, DOCS), shard_bytes=30_000)
    known = {r.word_id: r.word for r in words.collect()}
    assert sorted(known) == list(range(len(known))) and set(known.values()) == {w for _, t, _ in docs for w in brute.WORD.findall(t or "")}
    from collections import Counter
    seen = {}
    for r in csr.collect():
        ptr, at, n = np.frombuffer(r.indptr, np.int64), np.frombuffer(r.indices, np.int64), np.frombuffer(r.data, np.int32)
        for k, i in enumerate(r.doc_id):
            seen[i] = Counter({known[int(w)]: int(c) for w, c in zip(at[ptr[k]:ptr[k + 1]], n[ptr[k]:ptr[k + 1]])})
    assert seen == {i: Counter(brute.WORD.findall(t or "")) for i, t, _ in docs} and csr.count() > 3


def test_a_hot_text_and_a_hot_source(spark):
    docs = [(i, "same text" if i % 2 else f"text {i}", "hot" if i % 3 else None) for i in range(3000)]
    assert got(filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS))) == expected(docs, [])


def test_stored_shards_are_not_held_by_the_hundred(spark, monkeypatch):
    from recsift.llm import common

    monkeypatch.setattr(common, "GROUP_BYTES", 1 << 10, raising=False)
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(300)), "s") for i in range(40)]
    few = spark.createDataFrame(docs, DOCS).coalesce(1)
    local = common.staged(filter_audit.shards(few, shard_bytes=1), "shards", "zstd", wide=True)
    csr, _ = filter_audit.matrix(few, shard_bytes=1)
    for stored in (local, csr):
        files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in stored.inputFiles()]
        groups = [m.row_group(g).num_rows for m in files for g in range(m.num_row_groups)]
        assert sum(groups) == stored.count() >= 40 and max(groups) == 1


def test_many_shards_take_more_tasks_than_shuffle_partitions(spark):
    docs = [(i, f"a b c{i}", "s") for i in range(200)]
    local = filter_audit.staged(filter_audit.shards(spark.createDataFrame(docs, DOCS), shard_bytes=1), "shards")
    tasks = -(-200 // filter_audit.TASK_SHARDS)
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    csr, _ = filter_audit.encoded(local)
    assert csr.rdd.getNumPartitions() == tasks
