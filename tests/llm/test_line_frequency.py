from collections import Counter, defaultdict

from recsift.llm import line_frequency
from tests.llm.brute import WORD, lower


def expected(rows, max_docs):
    have = defaultdict(set)
    norm = lambda line: "".join("0" if c in "0123456789" else c for c in " ".join(WORD.findall(lower(line))))
    for i, t, s in rows:
        for line in (t or "").split("\n"):
            have[s or "", norm(line)].add(i)
    out = []
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        rep = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        gone = sum(len(WORD.findall(x)) for x in lines if len(have[s or "", norm(x)]) > max_docs)
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), failed, gone,
                    not failed and 100 * gone <= 50 * len(w)))
    return sorted(out, key=repr)


def test_rows_match_brute_force(spark):
    body = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    rows = [(k, f"{body(k)}\nShared  LINE number {k % 10} here\n{'a b c ' * (k % 3)}", "hot" if k % 3 else "cold") for k in range(60)]
    rows += [(100 + k, "\n".join([body(k), body("same"), body("same too")]), "hot") for k in range(8)]
    rows += [(200, None, "hot"), (201, "", None), (202, " \n \t\n", None), (203, "é è | # # x\x0by", None), (204, "x y z " * 40_000, "long"),
             (0, rows[0][1], "cold"), (None, rows[1][1], "cold"), (None, body("n"), None)]
    df = spark.createDataFrame([r + ("clash", 1) for r in rows], "doc_id long, text string, source string, lines string, row int")
    got = line_frequency.line_rules(df, max_docs=5)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows, 5)
    assert any(r.removed_words and not r.kept and not r.base_failed for r in got.collect())
    assert line_frequency.line_rules(df.limit(0)).collect() == []


def test_a_shared_line_goes_however_large_its_host(spark):
    for n in (300, 3000):
        name = lambda k: str(k).translate(str.maketrans("0123456789", "abcdefghij"))
        rows = [(k, " ".join(f"{name(k)}x{name(j)}" for j in range(60)) + ("\nAll rights  reserved 2024" if k < 60 else ""), "host") for k in range(n)]
        got = {r.doc_id: r.removed_words for r in line_frequency.line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
        assert all(got[k] == (4 if k < 60 else 0) for k in range(n))
