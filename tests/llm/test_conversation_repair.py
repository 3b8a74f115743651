"""Conversation repair against a plain search, over blocks and tasks of any cut."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from transitlake.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute(rows):
    """One conversation's (role, text) rows in order: faults, least cost, ASCII-least edits, repaired rows."""
    faults, seen = [], set()
    for role, text in rows:
        found = WORD.findall(text)
        faults.append("b" if not found else "d" if (role, text) in seen else "t" if found[-1] not in ".!?" else "-")
        seen.add((role, text))
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    filled = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    @functools.lru_cache(None)
    def best(i, last, inserted):
        """(cost, letters, repaired) of rows from i on, after a row of initial ``last``."""
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            role = filled[last]
            cost, letters, made = best(i, role[0], inserted + 1)
            options.append((cost + 5, "I" + letters, ((role, ""), *made)))
        if i < len(rows):
            role, text = rows[i]
            cost, letters, made = best(i + 1, last, 0)
            options.append((cost + 2, "D" + letters, made))
            if faults[i] not in "bd":
                extra = 5 if faults[i] == "t" else 0
                if role[:1] in step[last]:
                    cost, letters, made = best(i + 1, role[:1], 0)
                    options.append((cost + extra, "K" + letters, (rows[i], *made)))
                for other in ("user", "assistant"):
                    if other[0] in step[last]:
                        cost, letters, made = best(i + 1, other[0], 0)
                        options.append((cost + 1 + extra, "R" + letters, ((other, text), *made)))
        return min(options, default=(10**9, "", ()))

    for i in range(len(rows), -1, -1):  # from behind, so that no call goes deep
        for last in ("", "s", "u", "a"):
            best(i, last, 0)
    cost, letters, made = best(0, "", 0)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, letters), made


def sha(made):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()


def ordered(rows):
    """Rows of each conversation in order, nulls as a space."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, own in out.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    return out


def expected(rows, every):
    wanted = {}
    for conv in every:
        own = ordered(rows).get(conv, [])
        facts, made = brute([r[1:] for r in own])
        turns = {r[0] for r in own if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        wanted[conv] = (gaps, *facts, sha(made))
    return wanted


def damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        which = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if which:
            text = "" if which == 1 else re.sub("[.!?]", "", text) if which == 2 else text
            for _ in range(2 if which == 3 else 1):
                yield conv, turn, "user" if which == 4 else role, text


def got(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def chatter(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Hello.", "Why?", "So it goes!", "no end", "", "  \n", "ends.\t\n", "Gut.", "é ß", "?", "a b c."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] if turn % 3 else ["system", "user", "assistant", "tool", "", "User", None])
            text = rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()} is a number{rng.choice('.!?, ')}"
            rows.append((conv, rng.choice([turn, turn, turn, None, 2 * turn]), role, text))
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "x" * 200_000 + "."), (77, None, None, "Yes."), (78, 1, "user", "a."),
             (78, 1, "user", "a."), (78, 1, "user", "a."), (79, -2**63, "user", "q."), (79, 2**63 - 1, "assistant", "w.")]
    return rows


def test_any_cut_of_blocks_gives_the_plain_result(spark):
    rows = chatter(1, 25, 9)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS number", "2 AS block", "3 AS conv", "4 AS code", "5 AS hash", "6 AS copy_", "7 AS w")
    every = {r[0] for r in rows}
    broken = list(damage(rows))
    wanted = expected(broken, every)
    wanted[79] = (min(2**63 - 1, wanted[79][0]), *wanted[79][1:])
    assert got(C.audited(C.damaged(df), every=df)) == wanted
    plain = expected(rows, every)
    plain[79] = (min(2**63 - 1, plain[79][0]), *plain[79][1:])
    assert got(C.audited(df, least_block=2)) == plain


def test_repaired_rows(spark):
    rows = chatter(2, 6, 7)
    found = {}
    for r in C.repaired(spark.createDataFrame(rows, SCHEMA), least_block=1).orderBy("conv_id", "at").collect():
        found.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    wanted = {conv: brute([r[1:] for r in own])[1] for conv, own in ordered(rows).items()}
    assert {k: tuple(v) for k, v in found.items()} == {k: v for k, v in wanted.items() if v}


def test_one_conversation_holds_nearly_all_rows(spark):
    """It is cut into blocks of about its square root, in many tasks; only one walks it."""
    rng = random.Random(3)
    rows = [(1, k, rng.choice(["user", "assistant", "system", "x"]), f"text {rng.randint(0, 900)}{rng.choice(['.', '', '!'])}") for k in range(1200)]
    rows += [(c, 0, "user", "Hm.") for c in range(2, 30)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    blocks, span = C.checkpoints(C.in_order(df, "conv_id", "turn", "role", "text"), 4)
    assert span == 35 and blocks.where("conv = 1").count() <= 1200 // 35 + 6
    assert blocks.agg(F.max(F.length("codes"))).first()[0] <= 35
    assert got(C.audited(df, least_block=4)) == expected(rows, {r[0] for r in rows})


def test_empty_table_and_nothing_left(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert got(C.audited(C.damaged(nothing), every=nothing)) == {} and C.repaired(nothing).count() == 0
    every = spark.createDataFrame([(1, 1, "user", "a."), (None, 1, "user", "a.")], SCHEMA)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got(C.audited(nothing, every=every)) == {1: empty, None: empty}


@pytest.mark.parametrize("seed", range(4))
def test_blocks_compose(seed):
    """Costs folded over blocks equal those of one sweep, and the walk is tight."""
    rng = random.Random(seed)
    codes = "".join(rng.choice([C.letter(i, f) for i in "suax" for f in "-tbd"]) for _ in range(rng.randint(0, 60)))
    whole = C.END
    for code in reversed(codes):
        whole = C.before(code, whole)
    vector, cut = C.END, len(codes)
    while cut:
        at = max(0, cut - rng.randint(1, 9))
        vector, cut = C.through(C.block_costs(codes[at:cut]), vector), at
    assert vector == whole if codes else vector == C.END
    state, letters = 0, []
    for edit, state in C.walk(codes, C.END, 0):
        letters.append(edit)
    letters += [e for e, _ in C.tail(state)]
    assert sum(e != "I" for e in letters) == len(codes)
    faults = [C._meaning(c)[1] for c in codes]
    kept = iter(faults)
    paid = 0
    for edit in letters:
        fault = next(kept) if edit != "I" else "-"
        paid += {"I": 5, "D": 2, "K": 0, "R": 1}[edit] + (5 if fault == "t" and edit != "D" else 0)
        assert edit == "D" or fault not in "bd"
    assert paid == whole[0]
