"""Conversation repair against plain Python: every cheapest edit by memoized search, strings compared in full."""

import hashlib
import random
import re
import zlib
from functools import cache

from pyspark.sql import types as T

from fieldglean.llm import conversations
from fieldglean.llm.queries import QUERIES

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
WHITE = " \t\n\v\f\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_, turn_ = (" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def by_force(conv, rows):
    """The result row of one conversation's damaged rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        text = text.strip(WHITE)
        faults.append("blank" if not text else "duplicate" if (role, rows[len(faults)][3]) in seen else None if text[-1] in ".!?" else "truncated")
        seen.add((role, rows[len(faults) - 1][3]))
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]

    def step(had, initial):
        """The role initials so far, shortened to what decides what may follow; None if they cannot go on."""
        if initial == "s":
            return "s" if had == "" else None
        if initial == "u":
            return "u" if had in ("", "s", "a") else None
        return "a" if initial == "a" and had == "u" else None

    @cache
    def search(i, had, inserted):
        """(cost, audit, lines) of the rest."""
        options = []
        if i == len(rows) and had in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if (to := step(had, role[0])) and (rest := search(i, to, inserted + 1)):
                    options.append((rest[0] + 5, "I" + rest[1], (f"{role}:", *rest[2])))
        if i < len(rows):
            _, _, role, text = rows[i]
            if rest := search(i + 1, had, 0):
                options.append((rest[0] + 2, "D" + rest[1], rest[2]))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                for letter, own, cost in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if (to := step(had, own[:1])) and (rest := search(i + 1, to, 0)):
                        options.append((rest[0] + cost + more, letter + rest[1], (f"{own}:{text}", *rest[2])))
        return min(options, default=None)

    for i in range(len(rows), -1, -1):  # from the end, so that the search is never deep
        for had in ("", "s", "u", "a"):
            search(i, had, 0)
    cost, audit, lines = search(0, "", 0)
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    groups = {r[0]: [] for r in rows}
    for row in damage(rows):
        groups[row[0]].append(row)
    return sorted((by_force(c, v) for c, v in groups.items()), key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType())])


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    names = [*df.columns, "TEXT", "Turn", "times", "block", "cost"]
    return df.selectExpr(*df.columns, *["cast(null as string)"] * 5).toDF(*names)


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        for place in range(rng.randint(1, longest)):
            turn = rng.choice([place * 2, None, place // 2]) if rng.random() < 0.3 else place
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "agent", "ünit"]) if rng.random() < 0.4 else ["user", "assistant"][place % 2]
            text = rng.choice(["Yes.", "No", "", " \n", None, "é!", "Long answer? ", "cut of", "\u00a0"]) if rng.random() < 0.5 else f"Text {rng.randint(0, 30)}."
            rows.append((conv, turn, role, text))
    return rows


def test_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(QUERIES["op11_conversation_repair"](spark, sf_dir)) == expected(rows)


def test_random_conversations(spark):
    rows = random_rows(1, 300, 9)
    assert result(conversations.repair(conversations.damaged(table(spark, rows)))) == expected(rows)


def test_conversations_in_many_blocks(spark):
    """Blocks of three rows: the same results, copies across blocks and paths through many blocks included."""
    rows = random_rows(2, 60, 40)
    for block_rows in (1, 3):
        assert result(conversations.repair(conversations.damaged(table(spark, rows)), block_rows=block_rows)) == expected(rows)


def test_one_conversation_of_most_rows(spark):
    rows = [(7, t, ["user", "assistant"][t % 2], f"Turn {t // 3}.") for t in range(600)] + [(c, 0, "user", "Hi.") for c in range(20, 40)]
    want = expected(rows)
    assert result(conversations.repair(conversations.damaged(table(spark, rows)), block_rows=50)) == want
    assert result(conversations.repair(conversations.damaged(table(spark, rows)))) == want


def test_empty_and_dropped(spark):
    assert result(conversations.repair(conversations.damaged(table(spark, [])))) == []
    dropped = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert result(conversations.repair(conversations.damaged(table(spark, [(dropped, 0, "user", "Hi.")])))) == [
        (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_far_turns_and_long_texts(spark):
    rows = [(1, -(1 << 63), "user", "Hi."), (1, (1 << 63) - 1, "assistant", "x" * 5_000_000 + "."), (2, 3, "user", " " * 2_000_000 + "a")]
    got = {r["conv_id"]: r for r in conversations.repair(conversations.damaged(table(spark, rows)), outputs=("audit", "repaired")).collect()}
    assert got[1]["gaps"] == (1 << 63) - 1
    assert len(got) == 2


def test_least_audit_of_ties():
    """Many cheapest edits: the one that comes first in ASCII."""
    block = conversations.Block(None)
    for role in ("assistant", "user", "user", "assistant", "assistant"):
        block.add(None, 1, role.encode(), f"{role}{len(block.roles)}.".encode())
    want = by_force(0, [(0, None, r.decode(), t.decode()) for r, t in zip(block.roles, block.texts)])
    # The rows of the brute force are sorted by role, so compare on that order.
    order = sorted(range(5), key=lambda i: (block.roles[i], block.texts[i]))
    block.roles, block.texts = [block.roles[i] for i in order], [block.texts[i] for i in order]
    got = conversations.repaired([(block, block.faults())], [0], (conversations.TAIL * 5)[None, :])[0]
    assert (got[0], got[1] + "I" * conversations.TAIL[got[3]]) == (want[6], want[7])
