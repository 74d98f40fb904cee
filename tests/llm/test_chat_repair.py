"""Role repair against brute force over all relabellings."""

import itertools
import random
import re

import pytest

from rivulet.llm import chat_repair as C

TURN = re.compile(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", re.S)


def brute_cost(roles):
    best = None
    for new in itertools.product((1, 2, 3), repeat=len(roles)):
        cost, s = 0, 0
        for r, q in zip(roles, new):
            cost += C.step(s, r, q)
            s = q
        cost += C.ending(s)
        best = cost if best is None else min(best, cost)
    return best


def key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def check(rows, got):
    """Costs are least, the turns legal, and all texts are there in order."""
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t, r, x))
    parts = {}
    for g in sorted(got, key=lambda g: g.part):
        parts.setdefault(g.conv_id, []).append(g)
    assert set(parts) == set(convs)
    for c, ms in convs.items():
        ms = sorted(ms, key=key)
        ps = parts[c]
        assert [p.part for p in ps] == list(range(len(ps)))
        text = "".join(p.text for p in ps)
        turns = TURN.findall(text)
        assert "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in turns) == text
        names = [r for r, _ in turns]
        body = names[1:] if names[0] == "system" else names
        assert body and body == ["user", "assistant"] * (len(body) // 2)
        assert "\n".join(x for _, x in turns if x).replace("\n", "") == "".join(x or "" for _, _, x in ms).replace("\n", "")
        cost = sum(p.cost for p in ps)
        assert sum(p.messages for p in ps) == len(ms) and sum(p.turns for p in ps) == len(turns)
        roles = [C.role_state(r) for _, r, _ in ms]
        if len(roles) <= 7:
            assert cost == brute_cost(roles), roles
        else:
            m = C.transfer(roles)
            assert cost == min(m[0][q] + C.ending(q) for q in (1, 2, 3))


@pytest.mark.parametrize("block", [512, 3, 2])
def test_random_conversations(spark, block):
    rng = random.Random(8)
    roles = ["user", "assistant", "system", "User ", "human", "tool", None]
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t * rng.choice([1, 1, 2]), rng.choice(roles), rng.choice([f"m{t}", None, "", f"é\n{t}"])))
    rows += [(100, t, rng.choice(roles[:3]), f"x{t}") for t in range(40)] + [(None, 1, "user", "q"), (None, None, "system", "s")]
    rows += rows[:20]
    df = spark.createDataFrame([(*r, "b", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, b string, s int")
    check(rows, C.format_chats(df, block=block).collect())


def test_legal_conversation_is_unchanged(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = C.format_chats(df).collect()
    assert [(g.cost, g.turns) for g in got] == [(0, 3)]
    assert C.format_chats(df.limit(0)).collect() == []


def test_whole_table(spark):
    from rivulet.llm.queries import QUERIES
    from tests.conftest import SF_SMALL
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    check(rows, QUERIES["op4_chat_repair"](spark, SF_SMALL).collect())


@pytest.mark.parametrize("block", [512, 7])
def test_blocks_are_bounded_whatever_the_turns(spark, block):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool", None]
    rows = [(1, None, rng.choice(roles), f"a{i}") for i in range(1500)]  # no turn numbers
    rows += [(2, 7, rng.choice(roles), f"b{i}") for i in range(1500)]  # one turn number
    rows += [(None, i % 4, rng.choice(roles), f"c{i}") for i in range(1500)]  # no conversation
    rows += [(3, 1 << 40, "user", "far"), (3, 1, "user", "near")]
    rows += rows[:700]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    got = C.format_chats(df, block=block).collect()
    check(rows, got)
    assert max(g.messages for g in got) == block
    assert sum(g.conv_id == 3 for g in got) == 1


@pytest.mark.parametrize("block", [512, 3])
def test_repeated_messages_are_all_kept(spark, block, monkeypatch):
    monkeypatch.setattr(C, "RUN", 4)
    rows = [(1, 0, "user", "yes")] * 9 + [(1, 1, "assistant", "no"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = C.format_chats(df, block=block).collect()
    check(rows, got)
    assert sum(g.text.count("yes") for g in got) == 9 and max(g.messages for g in got) <= block
