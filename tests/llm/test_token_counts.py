import random

import public_tokenizers
import pytest
import sentencepiece

from recsift.llm import queries, token_counts
from tests.llm.brute import SF, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TEXTS = ["", " ", "  ", "a", " a", "a  b", "a\nb", "\n", "\n\n b", "x▁y ▁▁", "<s> </s><unk>", "é ﬁ Ｈ", "a \n", "\x00a\x00 b", "a\r\nb\t c", "a\xa0b　c​", "😀😀 😀", "İstanbul", "𝔘𝔫 " * 3,
         "long" * 20_000, "word " * 40_000, " " * 100, "\r\n\r\n  );\r\n", "1234567890 0x00"]


def test_query_matches_library(spark):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.QUERIES["op7_token_counts"](spark, SF).collect()}
    want = {i: (len(t.encode()), len(SP.encode(t)), len(SP.encode(t)) > 4096) for i, t in table("documents", "doc_id, text")}
    assert got == want and any(w[2] for w in want.values())


def test_edge_rows(spark):
    r = random.Random(5)
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (None, None), (3, "a"), (99, None)]
    rows += [(200 + k, "".join(r.choice(" \n▁ab;)\r\té<s>/") for _ in range(40))) for k in range(200)]
    df = spark.createDataFrame([x + (1, "c") for x in rows], "doc_id long, text string, block int, tokens string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(df, MODEL).collect()), key=repr)
    assert got == sorted(((i, len((t or "").encode()), len(SP.encode(t or ""))) for i, t in rows), key=repr)
    assert token_counts.token_counts(df.limit(0), MODEL).collect() == []


def test_pre_tokens_join_to_the_text():
    for t in TEXTS:
        assert "".join(token_counts.pre_tokens(t)) == ("▁" + t.replace(" ", "▁") if t else "")


def test_other_vocabularies_are_refused(monkeypatch):
    class Crossing:
        get_piece_size = staticmethod(lambda: 1)
        id_to_piece = staticmethod(lambda i: "a▁b")
        is_byte = is_control = is_unknown = staticmethod(lambda i: False)

    monkeypatch.setattr(token_counts, "processor", lambda model: Crossing)
    with pytest.raises(ValueError):
        token_counts.check_boundaries(b"")
