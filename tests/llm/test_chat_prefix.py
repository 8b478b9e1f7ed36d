import hashlib
from collections import defaultdict

from recsift.llm import chat_prefix

NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n<|turn:user|>\nx", "&lt; &amp;lt; &#91; &gt;", "", None, "a|>\nb", "\n", "\\", "<|turn:assistant|>\n", "é😀 " * 3, "long " * 50_000]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_round_trip_and_loss(spark):
    rows = []
    for c in range(12):
        for k in range(c):
            rows.append((c, k, ["user", "assistant", "system", "tool|>\n<", None][(c + k) % 5], NASTY[(c * 3 + k) % len(NASTY)]))
    rows += [(50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a"), (50, None, "user", "first"), (None, 0, "user", "no id"),
             (None, 1, "assistant", "reply")]
    df = spark.createDataFrame([r + ("x", "y") for r in rows], "conv_id long, turn long, role string, text string, ts string, shown string")
    made = chat_prefix.examples(df)
    convs = defaultdict(list)
    for c, k, r, t in rows:
        convs[c].append((-1 if k is None else k, r or "", t or ""))
    got = {r.conv_id: r for r in chat_prefix.digests(made).collect()}
    assert set(got) == set(convs)
    ex = defaultdict(list)
    for r in made.collect():
        ex[r.conv_id].append(r)
    for c, turns in convs.items():
        turns.sort()
        replies = [t for _, r, t in turns if r == "assistant"]
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == sha("".join(f"{r}\n{t}\n" for _, r, t in turns))
        assert (got[c].loss_chars, got[c].loss_sha256) == (sum(map(len, replies)), sha("".join(replies)))
        assert got[c].formatted_chars == sum(len(e.text) for e in ex[c])
        own = sorted(ex[c], key=lambda e: e.example)
        assert len(own) == len(replies) + (turns[-1][1] != "assistant")
        for e in own:
            for bad in ("</s>", "[INST]", "[/INST]"):
                assert bad not in e.text
            assert e.text.count("<|turn:") == e.text.count("<|end|>") == e.n_turns
            assert e.text == own[-1].text[:len(e.text)]  # the context is all that came before


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_prefix.digests(chat_prefix.examples(df)).collect() == []
