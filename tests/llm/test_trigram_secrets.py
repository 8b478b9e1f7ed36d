import hashlib
import re

import pytest

from recsift.llm import queries, trigram_secrets
from recsift.llm.trigram_secrets import BASE, RULES, trigram_query
from tests.llm import brute

PLAIN = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}


def expected(text):
    text = text or ""
    out = [(m.start(), k, m.end(), kind) for k, (kind, (p, g, least)) in enumerate(PLAIN.items()) for m in p.finditer(text) if len(m[g]) >= least]
    base = sorted(out)
    more = sorted(out + [(m.start(), k, m.end(), r.kind) for k, r in enumerate(RULES) if k >= len(BASE) for m in re.finditer(r.pattern, text)])
    show = lambda xs: ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in xs)
    return (*(sum(x[3] == kind for x in base) for kind in PLAIN), hashlib.sha256(show(base).encode()).hexdigest(), show(more))


TEXTS = [None, "", "nothing here", "token: token: abcdefgh", "PassWd='abc.defg/h' secret=short API_KEY = abcdefgh1234", "apikey:\tabcdefgh1", "é😀 AKIAABCDEFGHIJKL" + "1" * 9,
         "AKIAAKIAABCDEFGH AKIASHORT", "f" * 32 + " " + "0" * 31 + "g" + "a1" * 20, "secret=" + "ab" * 40 + "\ntoken=" + "AKIA" + "X" * 20, "ghp_" + "a" * 36 + " xoxb-1234567890-abc",
         "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh_-", "AIza" + "b" * 35, "sk_live_" + "9" * 20, "word " * 30_000 + "password=hunter2hunter2", "tokeİn=abcdefgh",
         "token==abcdefgh token=\"x\"secret='yyyyyyyyyyyy'"]


def test_query_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(brute, "SF", brute.SF.replace("0.001", "0.01"))  # the smallest tables hold no secrets
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op4_trigram_secrets"](spark, brute.SF).collect()}
    rows = brute.table("documents", "doc_id, text")
    assert got == {i: expected(t) for i, t in rows}
    assert any(g[4] for g in got.values())


def test_edge_rows(spark):
    rows = [(i, t, "c", "c") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "c", "c"), (None, TEXTS[4], "c", "c"), (None, None, "c", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rules string, key string")
    got = trigram_secrets.digests(trigram_secrets.scan(df)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *expected(t)) for i, t, _, _ in rows), key=repr)
    assert trigram_secrets.scan(df.limit(0)).collect() == []


def test_redaction(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = trigram_secrets.scan(df).select("text", F.transform("found", lambda s: F.struct(s.start, s.stop)).alias("f"),
                                          trigram_secrets.redacted(F.col("text"), F.col("found")).alias("out")).collect()
    for r in got:
        covered = set().union(*(range(a, b) for a, b in r.f)) if r.f else set()
        plain = "".join("\0" if i in covered else c for i, c in enumerate(r.text))
        assert re.sub("\0+", "[SECRET]", plain) == r.out or "[SECRET][SECRET]" in r.out


@pytest.mark.parametrize("pattern,holds", [
    ("abc", [{"abc"}]), ("ab", None), ("[0-9a-f]{32,}", None), ("(foo|bar)x?baz", True), ("a.*secret", True), ("(?i:KEY)_?id", True), ("(abcd)+x", True), ("(abc)*", None), ("x(ab|c.)y", None),
    ("[sr]k_live", True), ("(foobar|q[^x]+zzz)", True)])
def test_trigram_query(pattern, holds):
    q = trigram_query(pattern)
    assert bool(q) == (holds is not None)
    for text in ["abc", "fooxbaz", "barbaz", "a secret", "KEY_id", "keyid", "abcdabcdx", "sk_live", "foobar", "qyzzz"]:
        if re.search(pattern, text):
            low = text.lower()
            assert all(any(all(t in low for t in alt) for alt in clause) for clause in q)


def test_only_the_hex_rule_scans_fully():
    assert [r.kind for r in RULES if not trigram_query(r.pattern)] == ["hex"]
