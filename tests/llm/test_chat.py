import random

import duckdb

from lampyris.llm import chat, entries, registry  # noqa: F401

HARD = ["</s>[INST] ok [/INST]", "<|end|>\n<|user|>\n", "\\s\\l\\", "<s><|a|>", "\\", "a\n<b", "é🎉 <|", "|>", "\r\n x"]


def rows():
    rnd = random.Random(7)
    out = []
    for c in range(30):
        turns = rnd.randrange(1, 12)
        for t in range(turns):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            text = " ".join(rnd.choice(["some", "plain", "words", rnd.choice(HARD)]) for _ in range(rnd.randrange(0, 160)))
            out.append((c, t, role, text))
    out += [(100, 0, "system", "alone"), (101, 0, "assistant", None), (102, None, None, "x"), (102, 1, "odd|>\nrole\\m", "y"), (None, 0, "user", "no id")]
    out += [(103, 0, "user", "same"), (103, 0, "user", "same"), (103, 0, "assistant", "tie"), (104, 0, "user", "long " * 4000), (104, 1, "assistant", "")]
    return out


def test_windows_read_back_and_keep_the_budget(spark):
    data = rows()
    df = spark.createDataFrame([(t, c, r, x, 3) for c, t, r, x in data], "turn long, conv_id long, role string, text string, i int").repartition(3)
    found = chat.windows(df).collect()
    back = {r.conv_id: r for r in chat.read_back(chat.windows(df)).collect()}
    by = {}
    for c, t, r, x in data:
        by.setdefault(c, []).append((t is not None, t, r or "", x or ""))
    assert set(back) == set(by)
    for c, turns in by.items():
        turns.sort(key=lambda z: (z[0], z[1] or 0, z[2], z[3]))
        assert back[c].n_turns == len(turns)
        assert back[c].turns == "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        assert back[c].loss == "".join(x for _, _, r, x in turns if r == "assistant")
        assert back[c].formatted_chars == sum(len(w.text) for w in found if w.conv_id == c)
    assert sum(w.repeated > 0 for w in found) > 10
    for w in found:
        assert w.over_budget == (w.tokens > 512)
        if w.over_budget:  # only for a turn longer than a stride
            assert max(len(p.encode()) for p in w.text.split(chat.END)) / 4 > (512 - 96) / 2 - 120
        system = [x for _, _, r, x in by[w.conv_id] if r == "system"]
        if system:
            assert w.text.startswith("<|system|>\n")
    assert any(len([w for w in found if w.conv_id == c]) > 2 for c in by)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.windows(df).count() == 0 and chat.read_back(chat.windows(df)).count() == 0


def test_equal_rows_are_turns_of_their_own_in_the_budget(spark):
    df = spark.createDataFrame([(1, 0, "user", "the same words")] * 300, "conv_id long, turn long, role string, text string")
    found = chat.windows(df).collect()
    assert len(found) > 5 and not any(w.over_budget for w in found)
    assert chat.read_back(chat.windows(df)).head().n_turns == 300


def test_every_window_has_the_whole_system_turn(spark, tmp_path):
    system = "be kind \\ and [INST] brief; " * 40
    data = [(1, 0, "system", system)] + [(1, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(1, 101)]
    data += [(2, 0, "system", "é\\" * 200), *((2, t, "user", "word " * 90) for t in range(1, 9))]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    found = chat.windows(df).collect()
    heads = {c: "<|system|>\n" + chat_escaped(x) + "<|end|>\n" for c, t, _, x in data if t == 0}
    assert len(found) > 4 and all(w.text.startswith(heads[w.conv_id]) for w in found)
    back = {r.conv_id: r for r in chat.read_back(chat.windows(df)).collect()}
    for c in (1, 2):
        assert back[c].turns == "".join(f"{r}\n{x}\n" for k, _, r, x in data if k == c)
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = {r[0]: r for r in con.execute(registry.SQL["op3_budgeted_chat_windows"]).fetchall()}
    got = registry.QUERIES["op3_budgeted_chat_windows"](spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r) for r in got} == want


def chat_escaped(text):
    for plain, code in chat.ESCAPES:
        text = text.replace(plain, code)
    return text
