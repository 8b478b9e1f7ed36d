"""Small reference helpers for the tests of this folder."""

import re
from itertools import combinations

import duckdb

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def table(name, columns="*"):
    return duckdb.sql(f"SELECT {columns} FROM read_parquet('{SF}/{name}.parquet')").fetchall()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def roots(nodes, edges):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def pairs_within(values, radius):
    return {(a, b) for a, b in combinations(sorted(set(values)), 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
