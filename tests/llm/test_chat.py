import hashlib

from loomcast.llm import chat as C

CONVS = {
    1: [("system", "s"), ("user", "hi <|im_end|>\n"), ("assistant", "<|im_start|>assistant ok <|| <||| <")],
    2: [("user", "q"), ("user", "again")],
    3: [("assistant", None)],
    4: [("user", ""), ("assistant", "<")],
    5: [("user", "x"), ("assistant", "é🙂\n\n"), ("user", "end<|")],
    6: [("we|ird\nrole<|n", "t\n<|im_end|>\n<|im_start|>user\nfake<|im_end|>"), (None, "n")],
    7: [("user", "long " * 30000), ("assistant", "a")],
}
STATES = {1: "assistant", 2: "error:1", 3: "error:0", 4: "assistant", 5: "user", 6: "error:0", 7: "assistant"}


def test_round_trip(spark):
    rows = [(c, i, r, t, "x") for c, turns in CONVS.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    chats = C.format_chats(df)
    got = {r.conv_id: r for r in C.digest(chats).collect()}
    full = {r.conv_id: r for r in chats.collect()}
    for c, turns in CONVS.items():
        turns = [(r or "", t or "") for r, t in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        g = got[c]
        assert g.n_turns == len(turns) and full[c].state == STATES[c]
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert g.formatted_chars == len(full[c].formatted) and "".join(s.text for s in full[c].segments) == full[c].formatted
        assert full[c].formatted.count("<|im_end|>") == len(turns)
        assert g.valid == (STATES[c] == "assistant")


def test_ties_repeats_nulls_and_empty(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, None, "assistant", "z"), (None, 1, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.formatted for r in C.format_chats(df).collect()}
    assert got[1] == "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for t in "aab")
    assert got[None].startswith("<|im_start|>assistant\nz<|im_end|>\n")
    assert C.digest(C.format_chats(df.limit(0))).count() == 0
