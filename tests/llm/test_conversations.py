"""Conversation repair against a brute force over all edit lists."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from agrosense.llm import conversations as conv
from agrosense.llm.conversations import repaired_conversations

SCHEMA = ("conv_id bigint, turn bigint, role string, text string, "
          "c string, id bigint, seg bigint, path string, codes string, cost double")
CORRECT = re.compile(r"(s?(ua)+)?")
SEEN = re.compile(r"[^\x20\x09-\x0D]")


def frame(spark, data):
    return spark.createDataFrame([(*r, "x", 1, 2, "p", "q", 0.5) for r in data], SCHEMA)


def damaged(data):
    out = []
    for cid, turn, role, text in data:
        key = f"{' ' if cid is None else cid}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(cid, turn, role, text)] * (2 if k == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit) of the least edit list, by trying all in all states."""
    memo = {}

    def best(i, initials, budget):
        # what matters of the roles so far: none, a system turn, an open user turn, closed pairs
        state = initials if initials in ("", "s") else initials[-1]
        if (i, state, budget) in memo:
            return memo[i, state, budget]
        options = []
        if i == len(rows) and CORRECT.fullmatch(initials):
            options.append((0, ""))

        def go(edit, cost, j, more, left):
            if re.fullmatch(r"(s?(ua)*u?)?", initials + more):
                rest = best(j, initials + more, left)
                if rest is not None:
                    options.append((cost + rest[0], edit + rest[1]))
        if budget:
            for who in "ua":
                go("I", 2, i, who, budget - 1)
        if i < len(rows):
            role, fault = rows[i]
            go("D", 3, i + 1, "", 2)
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                if role[:1]:
                    go("K", 0 + cut, i + 1, role[:1], 2)
                for who in "ua":
                    go("R", 2 + cut, i + 1, who, 2)
        memo[i, state, budget] = min(options, default=None)
        return memo[i, state, budget]

    return best(0, "", 2)


def brute(data):
    by, ids = defaultdict(list), {r[0] for r in data}
    for r in damaged(data):
        by[r[0]].append(r[1:])
    out = {}
    for cid in ids:
        rows = sorted(by[cid], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64],
                                              hashlib.sha256(r[2].encode()).digest()))
        turns = {t for t, *_ in rows if t is not None}
        seen, faults = set(), []
        for _, role, text in rows:
            solid = SEEN.findall(text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                          else "truncated" if solid[-1] not in ".!?" else "ok")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest([(role, f) for (_, role, _), f in zip(rows, faults)])
        lines, i, roles = [], 0, ""
        for e in audit:
            if e == "D":
                i += 1
                continue
            role, text = ("", "") if e == "I" else rows[i][1:]
            if e != "K":
                role = "assistant" if roles.endswith("u") else "user"
            i += e != "I"
            roles += role[0]
            lines.append(f"{role}:{text}")
        assert CORRECT.fullmatch(roles) and i == len(rows)
        out[cid] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talks(seed, n, length):
    rng = random.Random(seed)
    out = []
    for cid in range(n):
        for turn in range(rng.randrange(1, length)):
            role = rng.choice(["user", "assistant"] * 3 + ["system", "tool", None])
            if rng.random() < 0.7:
                role = ("user", "assistant")[turn % 2]
            text = rng.choice(["One.", "Two!", "three", "Vier?", "\n", "", None, "Ünï.", "so on. \n"]) \
                if rng.random() < 0.5 else f"text {rng.randrange(30)}."
            out.append((cid, rng.choice([turn, turn, turn, turn + 1, None]) if rng.random() < 0.2 else turn,
                        role, text))
    return out


ODD = [(None, None, None, None), (None, 3, "user", "no id."), (9001, 0, "", "empty role."), (9001, 1, "user", "x."),
       (9002, 0, "user", "a" * 300_000 + "."), (9002, 1, "assistant", "b " * 100_000 + "!"), (9003, None, "user", "."),
       (9004, 5, "system", "only."), (9005, 1, "user", "twice."), (9005, 1, "user", "twice."),
       (9006, 7, "assistant", "q?"), (9007, -3, "user", "minus."), (9007, 4, "assistant", "gap.")]


def compared(df, data):
    got = {r["conv_id"]: tuple(r)[1:] for r in df.collect()}
    want = brute(data)
    assert got.keys() == want.keys()
    for cid in want:
        assert got[cid] == want[cid], (cid, got[cid], want[cid])


def test_repair_equals_brute_force(spark):
    data = talks(3, 150, 9) + ODD
    compared(repaired_conversations(frame(spark, data).repartition(7)), data)


def test_long_conversations_are_searched_in_segments(spark, monkeypatch):
    monkeypatch.setattr(conv, "SEGMENT_BITS", 3)
    monkeypatch.setattr(conv, "PIECE", 3)
    data = talks(8, 25, 70)
    compared(repaired_conversations(frame(spark, data).repartition(3)), data)


def test_search_in_pieces_equals_whole_search():
    rng = random.Random(4)
    for _ in range(300):
        rows = "".join(chr(65 + rng.randrange(16)) for _ in range(rng.randrange(1, 14)))
        whole = conv.search(conv._codes(rows), conv.EMPTY, conv.AT_END)
        roles = ["suax"[c] for c, _ in conv._codes(rows)]
        faults = [("ok", "blank", "duplicate", "truncated")[f] for _, f in conv._codes(rows)]
        assert (whole[0], whole[1] + conv.END_EDITS[whole[2]]) == cheapest(list(zip(roles, faults)))


def test_the_bound_of_the_rest_is_admissible():
    rng = random.Random(5)
    for _ in range(300):
        rows = [(rng.randrange(4), rng.randrange(4)) for _ in range(rng.randrange(1, 10))]
        exact = conv._cost_matrix(rows)
        for exits in (conv.AT_END, [0, 0, 0, 0], [9, 3, 1, 0], [conv.INFINITE, conv.INFINITE, 0, conv.INFINITE]):
            bounds = conv.rest_bounds(rows, exits)
            assert all(bounds[0][a] <= min(exact[a][b] + exits[b] for b in range(4)) for a in range(4))


@pytest.mark.parametrize("data", [[], [(1, 0, "user", "crc drops nothing here.")]])
def test_empty_and_tiny_tables(spark, data):
    compared(repaired_conversations(frame(spark, data)), data)
