from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import functions as F

from shardstream.llm import chat

SF_DIR = "/root/testdata/sf0.01"


def test_roles_and_texts_of_whole_conversations_come_back(spark):
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    found = {r.conv_id: r for r in chat.format_chats(chat.transcribe(turns), chat.learn(turns)).collect()}
    want: dict = {}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn)):
        want.setdefault(r.conv_id, []).append((r.role, r.text))
    assert found.keys() == want.keys()
    right = sum(found[i].rendered == chat.render([(role, text.strip()) for role, text in t]) for i, t in want.items())
    assert right >= 0.97 * len(want)
    assert chat.format_chats(chat.transcribe(turns.limit(0)), chat.learn(turns.limit(0))).count() == 0


def model():
    pair = [("user", "What is this?"), ("assistant", "It is a thing.\nIt has lines.\n\n- and items")]
    return chat.train([([("system", "Be brief."), *pair, *pair], 0.9)] * 20)


def test_markers_of_several_forms_and_missing_ones(spark):
    text = "### System\nBe brief.\nHuman: What is this?\n**AI:** It is a thing.\nIt has lines.\nNote: not a speaker.\nQ: And why?"
    parsed = model().parse(text)
    assert [role for role, _ in parsed] == ["system", "user", "assistant", "user"]
    assert parsed[2][1] == "It is a thing.\nIt has lines.\nNote: not a speaker."
    rows = [(1, text), (1, text), (2, None), (3, ""), (4, " \n "), (None, "User: " + "x" * 100_000)]
    table = spark.createDataFrame(rows, "conv_id long, transcript string").withColumn("roles", F.lit(0))
    found = chat.format_chats(table, model()).collect()
    assert sorted(r.n_turns for r in found) == [0, 0, 0, 1, 4, 4]


def test_viterbi_finds_the_best_of_all_sequences():
    m, rng = model(), np.random.default_rng(1)
    for _ in range(10):
        lines = [(int(rng.integers(4)), int(rng.integers(6)), 0) for _ in range(4)]

        def worth(states, lines=lines):
            total = m.start[states[0]] + sum(m.step[a, b] for a, b in zip(states, states[1:], strict=False))
            return total + sum(m.marker[s, a] + m.looks[s, b] for s, (a, b, _) in zip(states, lines, strict=True))

        best = max(map(worth, product(range(6), repeat=4)))
        assert abs(worth(m.roles(lines)) - best) < 1e-9


def lines_by_role(turns):
    return [role for role, text in turns for _ in text.strip().split("\n")]


def by_markers(transcript):
    """Roles where a line's marker says so, else the line before's."""
    turns = []
    for line in transcript.split("\n"):
        role, _, begin = chat.observe(line)
        if role < 3 or not turns:
            turns.append((chat.ROLES[role] if role < 3 else "user", [line[begin:]]))
        else:
            turns[-1][1].append(line)
    return [(role, "\n".join(lines).strip()) for role, lines in turns]


def test_roles_where_markers_vary_and_lack(spark):
    turns = chat.show(spark.read.parquet(f"{SF_DIR}/conversations.parquet"))
    rows = sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn))
    assert 0.05 < sum(r.shown == r.text for r in rows) / len(rows) < 0.25
    want: dict = {}
    for r in rows:
        want.setdefault(r.conv_id, []).append((r.role, r.text))
    held_out = F.pmod("conv_id", F.lit(5)) == 0
    model = chat.learn(turns.where(~held_out))
    right, simple, n = 0, 0, 0
    for r in chat.transcribe(turns.where(held_out)).collect():
        parsed = model.parse(r.transcript)
        truth = lines_by_role(want[r.conv_id])
        n += len(truth)
        right += sum(a == b for a, b in zip(truth, lines_by_role(parsed), strict=False))
        simple += sum(a == b for a, b in zip(truth, lines_by_role(by_markers(r.transcript)), strict=False))
    print("lines", n, "model", right / n, "markers", simple / n)
    assert right / n >= 0.9 and right > simple


def test_model_is_counted_from_bounded_turns(spark):
    """Turns from 1, a conversation with a third of the rows, and turns without an id."""
    rows = [(c, t, ("user", "assistant")[t % 2], f"text {t}") for c in range(200) for t in range(1, 5)]
    rows += [(999, t, "system", "hot") for t in range(400)] + [(None, t, "system", "none") for t in range(50)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    known = turns.where("conv_id IS NOT NULL")
    drawn = chat._drawn(known, 100).collect()
    assert 90 < len(drawn) <= 100 and all(r.conv_id != 999 for r in drawn)
    assert {len([r for r in drawn if r.conv_id == c]) for c in {r.conv_id for r in drawn}} == {4}
    one = chat.learn(turns, turns=100)
    assert np.exp(one.start[0]) < 0.01  # neither the hot conversation nor turns without an id
    assert (chat.learn(turns, turns=100).step == one.step).all()
    found = chat.transcribe(turns.withColumn("shown", F.col("text"))).where("conv_id IS NULL").collect()
    assert [r.transcript for r in found] == ["none"] * 50
    assert chat.learn(turns.limit(0)).start.shape == (6,)


def test_ids_of_text(spark):
    rows = [("a", 1, "user", "Hi?"), ("a", 2, "assistant", "Yes."), (None, 1, "user", "x")]
    turns = chat.show(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"))
    found = chat.format_chats(chat.transcribe(turns), chat.learn(turns)).collect()
    assert sorted((r.conv_id or "", r.n_turns) for r in found) == [("", 1), ("a", 2)]
