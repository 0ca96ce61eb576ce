"""Conversation repair against all edits tried in turn, and the damage against its rule."""

import hashlib
import random
import re
import zlib

from barline.llm import repair

KINDS = "conv_id long, turn long, role string, text string, at long, conv string, cost int"
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def chats(spark, rows):
    return spark.createDataFrame([(*r, 5, "x", 1) for r in rows], KINDS)


def cheapest(codes):
    """(cost, audit) of rows (initial, kind): every list of edits for few rows; for many, the
    least one to each state after each row, as strings."""
    now, few = {0: {(0, "")}}, len(codes) < 7

    def inserted(now):
        out, last = {q: set(v) for q, v in now.items()}, now
        for _ in range(3):
            more = {}
            for q, v in last.items():
                for role in "ua":
                    if (q, role) in MOVES:
                        more.setdefault(MOVES[q, role], set()).update((c + 2, a + "I") for c, a in v)
            for q, v in more.items():
                out.setdefault(q, set()).update(v)
            last = more
        return out

    for initial, kind in codes:
        after = {}
        for q, v in inserted(now).items():
            v = v if few else {min(v)}
            after.setdefault(q, set()).update((c + 3, a + "D") for c, a in v)
            if kind != "x":
                extra = kind == "t"
                if (q, initial) in MOVES:
                    after.setdefault(MOVES[q, initial], set()).update((c + extra, a + "K") for c, a in v)
                for role in "ua":
                    if (q, role) in MOVES:
                        after.setdefault(MOVES[q, role], set()).update((c + 2 + extra, a + "R") for c, a in v)
        now = after
    return min(x for q, v in inserted(now).items() if q in (0, 3) for x in v)


def judged(rows):
    """What a conversation's rows (turn, role, text), in order, come to."""
    seen, codes, sums, out = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}, []
    for i, (_, role, said) in enumerate(rows):
        marks = re.findall(r"[^\x20\x09-\x0D]", said)
        kind = "blank" if not marks else "duplicate" if (role, said) in seen else "truncated" if marks[-1] not in ".!?" else "k"
        seen.add((role, said))
        if kind != "k":
            sums[kind] += 1
        if i:
            sums["illegal"] += rows[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        codes.append((role[:1] if role[:1] in ("s", "u", "a") else "o", {"truncated": "t", "k": "k"}.get(kind, "x")))
    turns = [t for t, _, _ in rows if t is not None]
    sums["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    sums["cost"], sums["audit"] = cheapest(codes)
    at, state = 0, 0
    for letter in sums["audit"]:
        role, said = ("", "") if letter == "I" else rows[at][1:]
        at += letter != "I"
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == 2 else "user"
        state = MOVES[state, role[0]]
        out.append(f"{role}:{said}")
    assert state in (0, 3)
    return sums | {"repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest()}


def order(row):
    turn, role, said = row
    return (turn is not None, turn or 0, role.encode(), said.encode())


def expected(rows):
    kept = {}
    for conv, turn, role, said in rows:
        kept.setdefault(conv, [])
        shown = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, said = shown(role), shown(said)
        if kind == 0:
            continue
        said = "" if kind == 1 else re.sub("[.!?]", "", said) if kind == 2 else said
        kept[conv] += [(turn, "user" if kind == 4 else role, said)] * (2 if kind == 3 else 1)
    return {conv: judged(sorted(v, key=order)) for conv, v in kept.items()}


def result(spark, rows):
    table = chats(spark, rows)
    return {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in repair.summary(table, repair.damaged(table)).collect()}


def test_damaged_conversations_are_repaired_at_least_cost(spark):
    rng = random.Random(3)
    roles = ["user", "assistant"] * 4 + ["system", "User", "tool", "agent", "", None, "s"]
    says = ["Yes.", "No!", "cut of", "Why? ", " \n\t", "", None, "é…", " ", "So. \x0b", "x:y\nuser:z."]
    rows = [
        (rng.choice([conv, conv, conv, None]) if conv % 9 == 0 else conv, rng.choice([turn, turn, turn + 2, None]), rng.choice(roles), rng.choice(says))
        for conv in range(120) for turn in range(rng.randint(1, 7))
    ]
    rows += [(-5, None, None, None)] * 4
    assert result(spark, rows) == expected(rows)


def test_a_long_conversation_is_cut_into_blocks_with_the_same_result(spark):
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), f"text {t}" + rng.choice(["", ".", "."])) for t in range(3000)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hello.")]
    got = result(spark, rows)
    want = expected(rows)
    assert got == want and len(want[1]["audit"]) > 2500


def test_blocks_of_any_length_give_the_cheapest_audit():
    rng = random.Random(1)
    none = dict(blank=0, duplicate=0, truncated=0, illegal=0, turns=0, first_turn=None, last_turn=None)
    for _ in range(50):
        codes = [(rng.choice("suao"), rng.choice("kkktx")) for _ in range(rng.randint(0, 5))]
        for cut in (1, 2, 9):
            whole = repair.Conversation()
            for i in range(0, len(codes), cut):
                part = "".join(a + b for a, b in codes[i : i + cut])
                whole.take({**none, "codes": part, "weights": repair.packed(part)})
            found = whole.result()
            assert (found["cost"], found["audit"]) == cheapest(codes), codes


def test_best_paths_settle_so_that_integers_stay_short():
    rng = random.Random(2)
    whole = repair.Conversation()
    for _ in range(30):
        part = "".join(rng.choice("suauauao") + rng.choice("kkktx") for _ in range(512))
        none = dict(blank=0, duplicate=0, truncated=0, illegal=0, turns=0, first_turn=None, last_turn=None)
        whole.take({**none, "codes": part, "weights": repair.packed(part)})
        assert whole.paths.width < 60


def test_repaired_rows_are_whole_and_empty_tables_stay_empty(spark):
    table = chats(spark, [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "x" * 2_000_000 + "."), (2, 0, "user", None), (3, None, "system", "Be.")])
    in_order = repair.placed(table)
    found = repair.plans(repair.blocks(repair.faults(in_order)))
    got = [tuple(r) for r in repair.repaired(in_order, found).orderBy("conv", "place").collect()]
    assert [(c, p, r) for c, p, r, _ in got] == [("1", 1, "user"), ("1", 2, "assistant")] and len(got[1][3]) == 2_000_001
    empty = chats(spark, [])
    assert repair.summary(empty, repair.damaged(empty)).count() == 0
