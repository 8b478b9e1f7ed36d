"""SQL (DuckDB) builders for the hashing and bucketing expressions."""

from __future__ import annotations

# Fixed values that must equal the studied jobs, stated here anew so that a wrong edge in the library shows.
SCORE_EDGES = (0.0, 3.0, 3.9, 4.0, 4.1, 4.2, 4.3, 4.4, 4.5, 4.6, 4.7, 4.8, 4.9, 5.0)
RATE_EDGES = (0.0, 10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0, 80.0, 90.0)
PRICE_EDGES = (0.0, 5.0, 10.0, 15.0, 25.0, 50.0, 70.0, 150.0, 200.0, 250.0, 300.0)
COMMISSION_EDGES = (0.0, 2.0, 4.0, 6.0, 8.0, 10.0, 14.0, 20.0, 40.0)

EDGES = {"Mc": SCORE_EDGES, "Md": SCORE_EDGES, "Me": SCORE_EDGES, "Sl": RATE_EDGES, "Sj": RATE_EDGES,
         "Sf": PRICE_EDGES, "Ss": COMMISSION_EDGES}


def sql_hash(text: str) -> str:
    return (f"list_reduce(list_transform(string_split({text}, ''), lambda ch: CAST(unicode(ch) AS BIGINT)), "
            f"lambda acc, c: (acc * 131 + c) % 134217728)")


def sql_prefix(v: str) -> str:
    return f"(CASE WHEN length(replace({v}, ':', '')) > 0 THEN split_part({v}, ':', 1) ELSE '-1' END)"


def sql_hash_feature(name: str, v: str) -> str:
    return f"({sql_prefix(v)} || ':' || CAST({sql_hash(f"'{name}:' || {v}")} AS VARCHAR))"


def sql_bucketize(v: str, edges) -> str:
    arr = "[" + ", ".join(f"CAST({float(e)!r} AS DOUBLE)" for e in edges) + "]"
    x = (f"(CASE WHEN regexp_full_match({v}, '-?([0-9]+([.][0-9]+)?|[.][0-9]+)') "
         f"THEN CAST({v} AS DOUBLE) ELSE CAST(-1.0 AS DOUBLE) END)")
    n = f"len(list_filter({arr}, lambda e: e <= {x}))"
    return f"CAST(CASE WHEN {n} = 0 THEN -1 ELSE {n} END AS BIGINT)"


def sql_json(key: str, col: str = "predictor_json") -> str:
    return f"json_extract_string({col}, '$.{key}')"


def sql_trim(v: str) -> str:
    return f"regexp_replace({v}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def sql_features(names, col: str = "predictor_json") -> str:
    parts = []
    for n in names:
        v = f"coalesce({sql_trim(sql_json(n, col))}, '-1')"
        if n in EDGES:
            v = f"CAST({sql_bucketize(v, EDGES[n])} AS VARCHAR)"
        parts.append(sql_hash_feature(n, v))
    return " || ',' || ".join(parts)


def sql_sequence(key: str, fea: str, col: str = "predictor_json", length: int = 50) -> str:
    v = f"coalesce({sql_json(key, col)}, '-1')"
    stripped = f"regexp_replace({v}, ',+$', '')"
    empty = f"({v} = '' OR {v} = '-1' OR {stripped} = '')"
    parts = f"(CASE WHEN {empty} THEN CAST([] AS VARCHAR[]) ELSE string_split({stripped}, ',') END)"
    padded = f"list_slice(list_concat({parts}, list_transform(range({length}), lambda i: '0')), 1, {length})"
    hashed = f"list_transform({padded}, lambda x: {sql_hash_feature(fea, 'x')})"
    return f"(array_to_string({hashed}, ',') || ',' || CAST(least(len({parts}), {length}) AS VARCHAR))"
