import hashlib
import random

import duckdb

from quarrystone.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, turns int"


def rows():
    rng = random.Random(8)
    bits = ["<|", "|>", "\\", "<", "\n", "<|im_end|>\n", "<|im_start|>user\n", "n", "é🙂", " ", "<\\|", "<\\n", "\\\\", "ok"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
    out = [(c, t, rng.choice(["user", "assistant", "system", "us\ner", "<|im_end|>", "a\\n"]), text()) for c in range(40) for t in range(rng.randint(1, 6))]
    for c in range(40, 60):
        out += [(c, t, "user" if t % 2 == 0 else "assistant", text()) for t in range(rng.randint(1, 6))]
    out += [(70, 0, "system", "s"), (70, 1, "user", None), (70, 2, "assistant", ""), (71, 0, None, "x"), (None, 0, "user", "q"), (None, 1, "assistant", "a"), (72, 0, "user", "u" * 50_000), (72, 1, "assistant", "v" * 50_000)]
    return out + [(73, 0, "user", "same"), (73, 0, "user", "same"), (74, 5, "b", "tie"), (74, 5, "a", "tie"), (75, None, "assistant", "late"), (75, 0, "user", "q")]


def brute(data):
    by = {}
    for c, t, r, x in data:
        by.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        said = "".join(x for _, r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        roles = [r for _, r, _ in turns]
        rest = roles[1:] if roles[:1] == ["system"] else roles
        valid = bool(rest) and len(rest) % 2 == 0 and all(r == ("user", "assistant")[k % 2] for k, r in enumerate(rest))
        out.append((c, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), valid))
    return sorted(out, key=str)


def test_round_trip(spark):
    data = rows()
    df = spark.createDataFrame([(*r, "clash", 1) for r in data], SCHEMA).repartition(3)
    made = chat.format_conversations(df)
    got = [(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.valid) for r in chat.digest(made).collect()]
    assert sorted(got, key=str) == brute(data)
    for r in made.collect():
        assert r.formatted == "".join(s.text for s in r.segments)
        for s in r.segments[1::3]:  # texts: no control string is left
            assert "<|" not in s.text and not s.text.endswith("\n<|")
    assert chat.digest(chat.format_conversations(df.limit(0))).count() == 0


def test_as_sql(spark):
    df = spark.createDataFrame([r for r in rows()], "conv_id bigint, turn bigint, role string, text string")
    got = [tuple(r) for r in chat.digest(chat.format_conversations(chat.with_probe(df))).collect()]
    con = duckdb.connect()
    con.register("conversations", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    assert sorted(got, key=str) == sorted(con.sql(chat.SQL).fetchall(), key=str)


def test_no_python_in_the_plan(spark):
    plan = chat.digest(chat.format_conversations(chat.with_probe(spark.createDataFrame([], SCHEMA))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
