"""Roles against Viterbi over the whole transcript and against all paths."""

from itertools import product

import numpy as np

from kotomori.llm.chat import ROLES, ChatSettings, as_transcript, best_path, format_chats, op1_chat, rendered, steps
from tests.llm.rows import LONG

SCHEMA = "conv_id long, turn long, role string, text string, name int, block string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "b") for r in rows], SCHEMA)


def whole(texts, settings):
    parsed = [steps(t, settings) for t in texts]
    return best_path(np.log(settings.start), [m for p in parsed for m in p[0]], -1)


def test_best_path_is_the_best_of_all():
    rng = np.random.default_rng(2)
    matrices, before = [rng.normal(size=(3, 3)) for _ in range(6)], rng.normal(size=3)
    score = lambda path: max(before[r] + matrices[0][r, path[0]] for r in range(3)) + sum(m[a, b] for m, a, b in zip(matrices[1:], path, path[1:]))
    assert tuple(best_path(before, matrices, -1)) == max(product(range(3), repeat=6), key=score)
    assert tuple(best_path(before, matrices, 1)) == max((p for p in product(range(3), repeat=6) if p[-1] == 1), key=score)


def test_blocks_give_the_path_of_the_whole(spark, sf):
    df = as_transcript(spark.read.parquet(f"{sf}/conversations.parquet"))
    long = df.selectExpr("-1L conv_id", "conv_id * 1000 + turn AS turn", "role", "text")
    both = df.unionByName(long)
    settings = ChatSettings(fan=4)
    got = {(r.conv_id, r.turn): r for r in format_chats(both, settings).collect()}
    by = {}
    for r in sorted(both.collect(), key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append(r)
    for conv, rows in by.items():
        roles, at = whole([r.text for r in rows], settings), 0
        for r in rows:
            n = len(r.text.split("\n"))
            assert (got[conv, r.turn].first_role, got[conv, r.turn].last_role) == (ROLES[roles[at]], ROLES[roles[at + n - 1]])
            at += n


def test_canonical_turns(spark):
    df = rows_of(spark, [(1, 0, None, "System: be brief"), (1, 1, None, "### User:\nWhat is it?\nTell me"), (1, 2, None, "AI: a thing"), (2, 0, None, "Q: why?")])
    said = {}
    for r in sorted(format_chats(df, ChatSettings()).collect(), key=lambda r: (r.conv_id, r.turn)):
        said[r.conv_id] = said.get(r.conv_id, "") + r.rendered
    assert said[1] == "<|system|>\nbe brief\n<|end|>\n<|user|>\nWhat is it?\nTell me\n<|end|>\n<|assistant|>\na thing\n<|end|>\n"
    assert said[2] == "<|user|>\nwhy?\n<|end|>\n"


def test_marker_words_inside_a_turn_stay(spark):
    inner = ["# Context", "- answer", "| model | size |", "Response: 200", "plain"]
    df = rows_of(spark, [(1, 0, None, "User: how does it look?"), (1, 1, None, "AI: like this\n" + "\n".join(inner))])
    said = "".join(r.rendered for r in sorted(format_chats(df, ChatSettings()).collect(), key=lambda r: r.turn))
    assert said == "<|user|>\nhow does it look?\n<|end|>\n<|assistant|>\nlike this\n" + "\n".join(inner) + "\n<|end|>\n"


def spoken(texts):
    parsed = [steps(t, ChatSettings()) for t in texts]
    roles = whole(texts, ChatSettings())
    out, at, previous = "", 0, -1
    for i, (_, lines) in enumerate(parsed):
        mine = roles[at : at + len(lines)]
        out += rendered(mine, lines, previous, closes=i + 1 == len(parsed))
        previous, at = mine[-1], at + len(lines)
    return out


def test_lists_and_quotations_open_no_turn():
    assert spoken(["Please compare these\n- answer\n- question\nand tell me more"]) == "<|user|>\nPlease compare these\n- answer\n- question\nand tell me more\n<|end|>\n"
    assert spoken(["User: which one?\nA: first option\nQ: second option"]) == "<|user|>\nwhich one?\nA: first option\nQ: second option\n<|end|>\n"
    assert spoken(["which one?\nA: first option\nB: second option"]) == "<|user|>\nwhich one?\nA: first option\nB: second option\n<|end|>\n"


def test_turns_within_one_row():
    want = "<|user|>\nwhy is it so?\n<|end|>\n<|assistant|>\nit is\n<|end|>\n<|user|>\nthanks\n<|end|>\n"
    assert spoken(["Q: why is it so?\nA: it is\nQ: thanks"]) == want
    assert spoken(["### User: why is it so?\n### Assistant: it is\n### User: thanks"]) == want
    assert spoken(["<|user|>\nwhy is it so?\n<|assistant|>\nit is\n<|user|>\nthanks"]) == want
    assert spoken(["why is it so?\n\nAI: it is\n\nHuman: thanks"]) == want.replace("so?\n", "so?\n\n").replace("is\n", "is\n\n")


def test_awkward_rows(spark):
    df = rows_of(spark, [(1, 0, "user", None), (1, 0, "user", None), (None, 1, None, "User: a"), (None, None, None, ""), (3, 2**60 + 1, "x", LONG), (3, None, "x", "\n\n")])
    rows = format_chats(df, ChatSettings()).collect()
    assert sorted((str(r.conv_id), str(r.turn)) for r in rows) == sorted((str(r.conv_id), str(r.turn)) for r in df.collect())
    assert LONG in next(r.rendered for r in rows if r.turn == 2**60 + 1)
    assert format_chats(rows_of(spark, []), ChatSettings()).count() == 0


def test_op1_recovers_roles(spark, sf):
    truth = {(r.conv_id, r.turn): r.role for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    rows = op1_chat(spark, sf).collect()
    assert len(rows) == len(truth)
    assert np.mean([truth[r.conv_id, r.turn] == r.first_role == r.last_role for r in rows]) > 0.95
