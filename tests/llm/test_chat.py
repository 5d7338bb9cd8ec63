import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from textpanel.llm import chat

SF = "/root/testdata/sf0.001"
LOG = "conv_id long, message string, seq long, kind string, role string, text string"
NASTY = ["</s>", "<s>", "[INST]", "[/INST] ", "[ROLE:a] ", "[SYS]", "\\", "<\\/s>", "[\\\\INST]", "<", "[", "\n", " ", "a", "é", "😀", "/s>"]


def folded(events):
    """One event after the other, with all messages of a conversation in a list."""
    convs = {}
    order = {k: i for i, k in enumerate(chat.KINDS)}
    for conv, message, seq, kind, role, text in sorted(events, key=lambda e: (e[2], order[e[3]], e[5] or "")):
        msgs = convs.setdefault(conv, {})
        m = msgs.setdefault(message, {"begin": seq, "opened": False, "role": None, "text": "", "gone": False, "back": False})
        if kind == "open" and not m["opened"]:
            m |= {"begin": seq, "opened": True, "role": role}
        elif kind == "delta":
            m["text"] += text or ""
        elif kind == "edit":
            m["text"] = text or ""
        elif kind == "regenerate":
            m |= {"text": "", "again": seq}
        elif kind == "retract":
            m["gone"] = True
    out = {}
    for conv, msgs in convs.items():
        rows = sorted(((m["begin"], k, m) for k, m in msgs.items()), key=lambda x: x[:2])
        stand = [m for i, (b, _, m) in enumerate(rows) if not m["gone"] and not any(o.get("again") is not None and o["again"] > b for _, _, o in rows[:i])]
        out[conv] = [(m["role"], m["text"]) for m in stand]
    return {k: v for k, v in out.items() if v}


def spoken(spark, events):
    got = {}
    for r in chat.fold(spark.createDataFrame(events, LOG)).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    return got


def test_log_folds_as_one_event_after_the_other(spark):
    luck = random.Random(5)
    events = []
    for conv in range(40):
        seq = 0
        for m in range(luck.randint(1, 6)):
            events.append((conv, f"m{m}", seq, "open", luck.choice(["user", "assistant"]), None))
            seq += 1
            for _ in range(luck.randint(0, 6)):
                on = f"m{luck.randint(0, m)}"
                kind = luck.choice(["delta"] * 5 + ["edit", "regenerate"] + ["retract"] * (luck.random() < 0.2))
                events.append((conv, on, seq, kind, None, None if luck.random() < 0.1 else "".join(luck.choices("abc ", k=3))))
                seq += 1
    luck.shuffle(events)
    assert spoken(spark, events) == folded(events)


def test_events_without_an_opening_or_with_ties(spark):
    events = [(1, "a", 5, "delta", "user", "x"), (1, "a", 5, "edit", None, "y"), (1, "b", 1, "open", "user", None), (1, "b", 1, "delta", None, None), (None, None, 1, "delta", None, "z"), (2, "c", 1, "open", "user", None), (2, "c", 2, "retract", None, None)]
    assert spoken(spark, events) == {1: [("user", ""), (None, "yx")], None: [(None, "z")]}


def test_regeneration_takes_back_what_came_after(spark):
    events = [(1, "q", 0, "open", "user", None), (1, "q", 1, "delta", None, "why"), (1, "r", 2, "open", "assistant", None), (1, "r", 3, "delta", None, "no"), (1, "s", 4, "open", "user", None), (1, "r", 5, "regenerate", None, None), (1, "r", 6, "delta", None, "because"), (1, "t", 7, "open", "user", None)]
    assert spoken(spark, events) == {1: [("user", "why"), ("assistant", "because"), ("user", "")]}


def digests(turns):
    said = hashlib.sha256("".join(f"{r or ''}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), said, len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_marks_inside_texts_and_roles_come_back(spark):
    luck = random.Random(9)
    rows = [(c, t, luck.choice(["user", "assistant", "system", None, "", "to ol]:", "[/ROLE]"]), "".join(luck.choices(NASTY, k=luck.randint(0, 9)))) for c in range(60) for t in range(luck.randint(1, 5))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.turns(chat.render(df)).collect()}
    assert got == {c: digests([(r, t) for k, _, r, t in rows if k == c]) for c in range(60)}
    bare = df.select("text", chat.escaped(F.col("text")).alias("e")).collect()
    assert all(chat.unescaped(r.e) == r.text for r in bare)
    assert not any(m in r.e for r in bare for m in ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[ROLE:", "[/ROLE]"))


def test_reader_takes_pieces_that_end_anywhere():
    whole = "[SYS] a [/SYS][INST] </ [/INST]<s>x\\</s>[ROLE:t+1] y [/ROLE]"
    span = (whole.index("<s>") + 3, whole.index("</s>"))
    one = chat.Reader()
    one.feed(whole, [span])
    n, said, chars, loss, size = one.result()
    assert (n, chars, size) == (4, 2, len(whole))
    pieces = chat.Reader()
    for c in whole:
        pieces.feed(c, [])
    assert pieces.result()[:2] == (n, said)
    with pytest.raises(ValueError):
        short = chat.Reader()
        short.feed(whole[:-1], [])
        short.result()


def test_empty_null_repeated_and_long_rows(spark):
    long = "<s>é " * 100_000
    rows = [(None, 1, "user", "x"), (None, None, "assistant", None), (5, 1, "user", "same"), (5, 1, "user", "same"), (6, 0, "assistant", long), (7, 2, "b", "2"), (7, 2, "a", "1")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, message int")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.turns(chat.render(chat.fold(chat.events_of(df)))).collect()}
    assert got == {None: digests([("assistant", ""), ("user", "x")]), 5: digests([("user", "same")] * 2), 6: digests([("assistant", long)]), 7: digests([("a", "1"), ("b", "2")])}
    assert chat.turns(chat.render(chat.fold(chat.events_of(df.limit(0))))).collect() == []


def test_query_equals_its_sql(spark):
    got = sorted(map(tuple, chat.op11_query(spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert got == sorted(con.sql(chat.ORACLE).fetchall())
    assert got[0][0] == -7 and got[0][1:5] == digests([("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")])
