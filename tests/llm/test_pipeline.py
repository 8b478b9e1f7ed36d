import numpy as np

import corpus_pipeline as cp
from recsift.llm import importance
from recsift.llm.soft_mixing import DOMAINS
from recsift.llm.trigram_secrets import BASE
from tests.llm import brute
from tests.llm.test_simhash_gph import expected as components
from tests.llm.test_simhash_windows import expected as held
from tests.llm.test_soft_mixing import best
from tests.llm.test_trigram_secrets import expected as secrets

SF = "/root/testdata/sf0.01"


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(brute, "SF", SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = cp.quality(spark, docs, SF).cache()
    judged = rows(importance.resample(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert set(rows(good)) == {i for i, r in judged.items() if r.kept} and good.columns == list(cp.COLUMNS)
    deduped = cp.near_dedup(spark, good, SF).cache()
    group = components([(r.doc_id, r.text) for r in good.collect()])
    assert sorted(rows(deduped)) == sorted({c for _, _, c in group}) and deduped.count() < good.count()
    clean = cp.decontaminate(spark, deduped, SF).cache()
    leaked = {d for d, _ in held([(r.doc_id, r.text) for r in deduped.collect()], brute.table("benchmark", "item_id, text"))}
    assert set(rows(clean)) == set(rows(deduped)) - leaked and leaked
    safe = cp.secrets(spark, clean, SF).cache()
    before = rows(clean)
    assert set(rows(safe)) == set(before)
    changed = 0
    for i, r in rows(safe).items():
        if not secrets(before[i].text)[-1]:
            assert tuple(r) == tuple(before[i])
        else:
            changed += 1
            assert "[SECRET]" in r.text and r.n_chars == len(r.text) and not any(secrets(r.text)[:len(BASE)])
    assert changed
    last = cp.mixing(spark, safe, SF).collect()
    assert {r.doc_id for r in last} == set(before) and all(r.rate >= 0 for r in last)
    assert sum(r.rate * r.tokens * r.p_clean for r in last) > 0


def test_run_and_edge_rows(spark, tmp_path):
    d = spark.createDataFrame([(None, None, None, None, None), (None, "a b", "en", "s", 3), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "one two three", None, None, None)],
                              "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "some benchmark item of more than five words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = cp.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {None, 1, 2} and len(got) == 4
    assert [n for n, _ in cp.STAGES] and list(got[0].asDict())[:5] == list(cp.COLUMNS)


def test_totals_are_the_targets_or_the_nearest(spark):
    last = cp.run(spark, SF).toPandas()
    p, n, rate = last[[f"p_{d}" for d in DOMAINS]].to_numpy(), last.tokens.to_numpy(float), last.rate.to_numpy()
    before = n @ p / n.sum()
    share = np.array([0, before[1] * cp.FACTORS["low"], before[2] * cp.FACTORS["toxic"]])
    share[0] = 1 - share.sum()
    assert best(p, n, rate, share, cp.MAX_RATE)
    assert np.allclose((rate * n) @ p / n.sum(), share, atol=1e-6)  # within reach
    assert (rate[n > 0] > 0).mean() > 0.9
    assert before[1:].min() > 0 and np.abs((rate * n) @ p / n.sum() / share - 1).max() < 1e-4 and rate.std() > 0  # the stage moves tokens
