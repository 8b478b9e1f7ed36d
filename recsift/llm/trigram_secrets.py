"""Secret scan with a trigram index.

Each rule's regular expression is turned into a Boolean trigram query: a conjunction of clauses, each a
choice of literal strings, each string a conjunction of its trigrams (over text lower-cased in A-Z). The
inverted index holds, for every document, which of the trigrams that any rule asks for are in it. The
postings are intersected per rule; only candidates are verified with the regular expression. A rule
without a mandatory trigram scans every text. Built-in column functions only.
"""

from __future__ import annotations

from re import _constants as sre
from re import _parser as sre_parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """A kind of secret. Matches are leftmost and do not overlap; those that fail a length are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Further kinds; they add spans and never take one from the base rules.
MORE = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + MORE

#: A clause keeps at most so many alternative strings; a longer choice ends the string there.
MOST = 64
Clause = frozenset  # of alternatives, each a frozenset of trigrams


def _low(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def _clause(strings: set[str]) -> Clause | None:
    """One of ``strings`` is in the text; None if that says nothing about trigrams."""
    alternatives = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    return None if frozenset() in alternatives else frozenset(a for a in alternatives if not any(b < a for b in alternatives))


def _members(items: list) -> set[str] | None:
    """The lower-cased characters of a small set; None if it is large or negated."""
    out: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(_low(chr(arg)))
        elif op is sre.RANGE and arg[1] - arg[0] < MOST:
            out.update(_low(chr(c)) for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return out if len(out) <= 8 else None


def _walk(nodes) -> tuple[set[str] | None, list[Clause]]:
    """``(strings, clauses)`` of a sequence: all it can match, if few; and what must hold of any match."""
    clauses: list[Clause] = []
    now, exact = {""}, True

    def flush() -> None:
        nonlocal now, exact
        if (c := _clause(now)) is not None:
            clauses.append(c)
        now, exact = {""}, False

    for op, arg in nodes:
        own: set[str] | None = None
        inner: list[Clause] = []
        if op is sre.LITERAL:
            own = {_low(chr(arg))}
        elif op is sre.IN:
            own = _members(arg)
        elif op is sre.SUBPATTERN:
            own, inner = _walk(arg[3])
        elif op is sre.BRANCH:
            parts = [_walk(b) for b in arg[1]]
            if all(s is not None for s, _ in parts):
                own = set().union(*(s for s, _ in parts))
            else:
                known = [c + ([k] if b is not None and (k := _clause(b)) is not None else []) for b, c in parts]
                if all(known):
                    inner = [frozenset().union(*(min(c, key=len) for c in known))]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            strings, within = _walk(body)
            if strings is not None and (low, high) in ((0, 1), (1, 1)):
                own = strings | ({""} if low == 0 else set())
            elif low >= 1:
                inner = within + ([c] if strings is not None and (c := _clause(strings)) is not None else [])
        elif op is sre.AT:
            continue
        if own is not None and len(now) * len(own) <= MOST:
            now = {a + b for a in now for b in own}
        else:
            flush()
            if own is not None and len(own) <= MOST:
                now = own
        clauses.extend(inner)
    if exact:
        return now, clauses
    if (c := _clause(now)) is not None:
        clauses.append(c)
    return None, clauses


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that all hold for any text with a match of ``pattern``; none: the index cannot help."""
    strings, clauses = _walk(sre_parser.parse(pattern))
    if strings is not None and (c := _clause(strings)) is not None:
        clauses = clauses + [c]
    return clauses


def _key() -> Column:
    """Names a row for the index. A collision only adds a candidate, which verification drops."""
    return F.xxhash64("doc_id", "text")


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """``(trigram, key)``: the inverted index of ``docs`` for the given trigrams, one row per pair."""
    low = docs.select(_key().alias("key"), _lower(F.col("text")).alias("low"))
    return low.select("key", F.explode(F.filter(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams)), lambda t: t.isNotNull())).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(key, rules)``: the documents that the index cannot rule out, with the kinds to verify."""
    spark: SparkSession = docs.sparkSession
    asked = [(r.kind, c, a, t, len(alt), len(q)) for r in rules for q in [trigram_query(r.pattern)]
             for c, clause in enumerate(q) for a, alt in enumerate(sorted(clause, key=sorted)) for t in sorted(alt)]
    table = spark.createDataFrame(asked, "kind string, clause int, alt int, trigram string, trigrams int, clauses int")
    met = postings(docs, sorted({x[3] for x in asked})).join(F.broadcast(table), "trigram")  # the rules' own size
    alts = met.groupBy("key", "kind", "clause", "alt", "trigrams", "clauses").agg(F.count_distinct("trigram").alias("n")).where("n = trigrams")
    kinds = alts.groupBy("key", "kind", "clauses").agg(F.count_distinct("clause").alias("n")).where("n = clauses")
    return kinds.groupBy("key").agg(F.collect_set("kind").alias("rules"))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of ``(start, place, stop, kind)`` for the rule's matches in ``text``, in code points."""
    pattern = F.lit(rule.pattern)
    hits = F.arrays_zip(F.split(text, pattern, -1).alias("before"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
                        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"))
    none = F.array().cast("array<struct<start:int,place:int,stop:int,kind:string,part:int>>")
    every = F.aggregate(
        hits, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda a, h: F.struct(
            (a.at + F.length(h.before) + F.coalesce(F.length(h.hit), F.lit(0))).alias("at"),
            F.when(h.hit.isNull(), a.out).otherwise(F.concat(a.out, F.array(F.struct(
                (a.at + F.length(h.before)).alias("start"), F.lit(order).alias("place"), (a.at + F.length(h.before) + F.length(h.hit)).alias("stop"),
                F.lit(rule.kind).alias("kind"), F.length(h.part).alias("part"))))).alias("out")),
        lambda a: a.out)
    return F.filter(every, lambda s: s.part >= rule.least)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, text, *keep, found)`` for every row; ``found``: its spans ``(start, place, stop, kind, part)``.

    Spans are sorted by start, then by the place of their kind in ``rules``; ends are exclusive, both in
    code points of the whole text. Null texts count as empty. Rows with a null id and repeated rows each
    keep their row. An empty table gives no rows. ``keep`` names further columns to carry along; others
    are ignored. Texts meet their candidates in a join on a hash of id and text, so copies spread.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *keep)
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    out = own.withColumn("rules", F.array().cast("array<string>"))
    if indexed:
        found = candidates(own, indexed)
        out = own.withColumn("key", _key()).join(found, "key", "left").drop("key")
    none = F.array().cast("array<struct<start:int,place:int,stop:int,kind:string,part:int>>")
    parts = []
    for order, r in enumerate(rules):
        ask = F.col("rules").isNotNull() & F.array_contains("rules", F.lit(r.kind)) if r in indexed else F.rlike("text", F.lit(r.pattern))
        parts.append(F.when(ask, spans(F.col("text"), r, order)).otherwise(none))
    return out.select("doc_id", "text", *keep, F.array_sort(F.concat(*parts)).alias("found"))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat(s.kind, F.lit(":"), s.start.cast("string"), F.lit(":"), s.stop.cast("string"))), ",")


def digests(scanned: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` from the result of ``scan``."""
    n = lambda kind: F.size(F.filter("found", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s.place < len(BASE))
    return scanned.select("doc_id", *(n(r.kind) for r in BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span, overlapping ones as one, replaced by ``mark``."""
    done = F.aggregate(
        found, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a.at, s.stop).alias("at"),
            F.when((s.start >= a.at) & (s.stop > a.at), F.concat(a.out, F.substring(text, a.at + 1, s.start - a.at), F.lit(mark))).otherwise(a.out).alias("out")))
    return F.when(F.size(found) == 0, text).otherwise(F.concat(done.out, F.substring(text, done["at"] + 1, F.length(text))))
