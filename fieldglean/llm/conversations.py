"""Repair of conversation structure: cost DP, then prefix-doubling path ranking.

A conversation's rows are edited (K keep, R rerole, D delete, I insert) until the role initials read `(s?(ua)+)?`. Nodes are
places before a row with one of four states. After the cost DP only arcs on cheapest paths stay; nodes are ranked by their least
audits of length 1, 2, 4, ..., each length made of two halves, and pointers that double with the lengths read off the least path.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.llm.common import pick, prepare, written

#: A conversation is worked on in blocks of at most so many rows and, but for a single longer row, bytes.
BLOCK_ROWS, BLOCK_BYTES = 8192, 4 << 20
#: Rows solved together, about.
TOGETHER = 4096
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States by what was given so far: nothing, s, ...u, ...a. An added turn leads from each to:
NEXT = np.array([2, 2, 3, 2])
#: Turns to insert at the end of a conversation in each state.
TAIL = np.array([0, 2, 1, 0])
_FAR = 1 << 40
_LETTERS = np.frombuffer(b"DIKR", np.uint8)
_WHITE = b" \t\n\v\f\r"
_WORD = re.compile(rb"[^\x20\x09-\x0D]")
_INITIALS = {b"s": 0, b"u": 1, b"a": 2}
_LEGAL = {b"su", b"ua", b"au"}
_BLANK, _REPEAT, _CUT = 1, 2, 3
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turn, times, role, text): rows as damaged by crc32(`key:turn`) % 20, nulls read as one space. 0 drops a row (times 0),
    1 empties its text, 2 removes its `.!?`, 3 repeats it (times 2), 4 makes its role user."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told(key), F.lit(":"), told(turn)).cast("binary")) % 20
    rows = pick(rows, key, turn, role, text).select("*", kind.alias("kind"))
    return rows.select(
        key, F.col(turn).cast("long").alias("turn"), F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("times"),
        F.when(F.col("kind") == 4, "user").otherwise(told(role)).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(told(text), ".!?", "")).otherwise(told(text)).alias("text"))


# --- cheapest edits of one block ------------------------------------------------------------------

class Block:
    """Rows of one conversation that follow one another."""

    def __init__(self, key):
        self.key, self.number = key, 0
        self.roles: list[bytes] = []
        self.texts: list[bytes] = []
        self.turns: list[int] = []
        self.bytes = 0

    def add(self, turn, times: int, role: bytes, text: bytes) -> None:
        for _ in range(times):
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += len(role) + len(text)
        if times and turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def digests(self) -> list[bytes]:
        return [hashlib.blake2b(b"%d:%b%b" % (len(r), r, t), digest_size=16).digest() for r, t in zip(self.roles, self.texts)]

    def faults(self, seen_before: frozenset = frozenset()) -> np.ndarray:
        """Of each row the first that holds: blank, repeat (role and text seen earlier), cut off; else 0."""
        seen, out = set(), []
        for role, text, digest in zip(self.roles, self.texts, self.digests() if seen_before else [None] * len(self.roles)):
            if not _WORD.search(text):
                out.append(_BLANK)
            elif (role, text) in seen or digest in seen_before:
                out.append(_REPEAT)
            else:
                out.append(0 if text.rstrip(_WHITE)[-1:] in (b".", b"!", b"?") else _CUT)
            seen.add((role, text))
        return np.array(out, np.int8)

    def initials(self) -> np.ndarray:
        return np.array([_INITIALS.get(r[:1], 3) for r in self.roles], np.int8)

    def first_letters(self) -> list[bytes]:
        return [r.decode("utf-8", "replace")[:1].encode() for r in self.roles]

    def illegal(self) -> int:
        letters = self.first_letters()
        return sum(a + b not in _LEGAL for a, b in zip(letters, letters[1:]))


def cheapest(initials: np.ndarray, faults: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs to go, and of the cheapest arcs that leave a node the one with the least letter, for blocks padded to one length.

    `ends` holds the cost of ending a block in each state. Returns costs[block, place, state], letters (0: none, the path ends) and
    the nodes that the arcs lead to, numbered place * 4 + state. Letters of arcs that leave one node differ and so do their ends,
    so the arc with the least letter begins the least audit.
    """
    blocks, longest = initials.shape
    costs = np.full((blocks, longest + 1, 4), _FAR, np.int64)
    letters = np.zeros((blocks, longest + 1, 4), np.uint8)
    to = np.tile(np.arange((longest + 1) * 4).reshape(1, longest + 1, 4), (blocks, 1, 1))
    costs[np.arange(blocks), sizes] = ends
    for i in range(longest - 1, -1, -1):
        live = np.flatnonzero(sizes > i)
        if not len(live):
            continue
        after, initial, fault = costs[live, i + 1], initials[live, i], faults[live, i]
        keeps = np.where((initial == 1)[:, None] & (NEXT == 2) | (initial == 2)[:, None] & (NEXT == 3), NEXT, -1)
        keeps[initial == 0, 0] = 1
        extra = np.where(fault == _CUT, TRUNCATED, 0)[:, None]
        gone = np.isin(fault, (_BLANK, _REPEAT))[:, None]
        keep = np.where(gone | (keeps < 0), _FAR, np.take_along_axis(after, np.maximum(keeps, 0), 1) + extra)
        rerole = np.where(gone, _FAR, after[:, NEXT] + REROLE + extra)
        delete = after + DELETE
        row = np.minimum(np.minimum(delete, keep), rerole)
        best = row
        for _ in range(2):  # a third insertion in a row leads back to a state there was
            best = np.minimum(row, best[:, NEXT] + INSERT)
        best = np.minimum(best, _FAR)
        insert = best[:, NEXT] + INSERT
        choice = np.where(delete == best, 0, np.where(insert == best, 1, np.where(keep == best, 2, 3)))
        target = np.choose(choice, [np.arange(4) + (i + 1) * 4, NEXT + i * 4, np.maximum(keeps, 0) + (i + 1) * 4, NEXT + (i + 1) * 4])
        dead = best >= _FAR
        costs[live, i] = best
        letters[live, i] = np.where(dead, 0, _LETTERS[choice])
        to[live, i] = np.where(dead, np.arange(4) + i * 4, target)
    return costs, letters, to


def doubled(letters: np.ndarray, to: np.ndarray, ranked: bool = False) -> tuple[list[np.ndarray], np.ndarray | None]:
    """Pointers of 1, 2, 4, ... arcs until all paths have ended, and the nodes' ranks by their whole audits (nodes of all blocks
    in one row). The audit of twice a length is two of that length: a node's own and that of the node its pointer leads to."""
    blocks, places, _ = letters.shape
    hop = (to + (np.arange(blocks) * places * 4)[:, None, None]).ravel()
    rank = np.unique(letters.ravel(), return_inverse=True)[1].astype(np.int64) if ranked else None
    pointers = [hop]
    while True:
        if ranked:
            rank = np.unique(rank * (rank.max() + 1) + rank[hop], return_inverse=True)[1].astype(np.int64)
        further = hop[hop]
        if np.array_equal(further, hop):
            return pointers, rank
        pointers.append(further)
        hop = further


def least_paths(pointers: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
    """The nodes of the least path from each start, one row a start; the last node repeats to the end."""
    nodes = starts[:, None]
    for hop in pointers:
        nodes = np.concatenate([nodes, hop[nodes]], 1)
    return np.concatenate([nodes, pointers[-1][nodes[:, -1:]]], 1)


def _padded(blocks: list[tuple[Block, np.ndarray]]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks in lots of like length: (their numbers, initials, faults, sizes)."""
    order = sorted(range(len(blocks)), key=lambda i: len(blocks[i][0].roles))
    at = 0
    while at < len(order):
        size = len(blocks[order[at]][0].roles)
        most = 1 << max(2, size.bit_length())
        end = at
        while end < len(order) and len(blocks[order[end]][0].roles) <= most and (end == at or (end - at) * most <= 4 * TOGETHER):
            end += 1
        lot = order[at:end]
        sizes = np.array([len(blocks[i][0].roles) for i in lot])
        initials, faults = (np.zeros((len(lot), max(1, sizes.max())), np.int8) for _ in "if")
        for row, i in enumerate(lot):
            initials[row, :sizes[row]], faults[row, :sizes[row]] = blocks[i][0].initials(), blocks[i][1]
        yield lot, initials, faults, sizes
        at = end


def repaired(blocks: list[tuple[Block, np.ndarray]], entries: Sequence[int], ends: np.ndarray) -> list[tuple[int, str, list[bytes], int]]:
    """For blocks with their faults: (cost, audit, lines, state at the end) of the least cheapest path from an entry state."""
    out: list = [None] * len(blocks)
    for lot, initials, faults, sizes in _padded(blocks):
        costs, letters, to = cheapest(initials, faults, sizes, ends[lot])
        pointers, _ = doubled(letters, to)
        places = letters.shape[1]
        first = np.arange(len(lot)) * places * 4
        entry = np.array([entries[i] for i in lot])
        paths = least_paths(pointers, first + entry)
        said, paths = letters.ravel()[paths], paths - first[:, None]
        lengths = np.count_nonzero(said, axis=1)
        for row, i in enumerate(lot):
            block, n = blocks[i][0], lengths[row]
            audit, nodes = said[row, :n].tobytes().decode(), paths[row, :n + 1].tolist()
            lines = []
            for letter, node, target in zip(audit, nodes, nodes[1:]):
                if letter != "D":
                    role = b"user" if target % 4 == 2 else b"assistant"
                    lines.append((block.roles[node // 4] if letter == "K" else role) + b":" + (b"" if letter == "I" else block.texts[node // 4]))
            out[i] = (int(costs[row, 0, entry[row]]), audit, lines, nodes[-1] % 4)
    return out


def transfers(blocks: list[tuple[Block, np.ndarray]]) -> list[tuple[list[int], list[int]]]:
    """For each block, 16 costs from an entry state to an end state, and the ranks of their least audits among all."""
    out: list = [None] * len(blocks)
    for lot, initials, faults, sizes in _padded(blocks):
        ends = np.tile(np.where(np.eye(4, dtype=bool), 0, _FAR), (len(lot), 1))
        costs, letters, to = cheapest(*(np.repeat(x, 4, axis=0) for x in (initials, faults, sizes)), ends)
        _, rank = doubled(letters, to, ranked=True)
        firsts = [x.reshape(len(lot), 4, -1, 4)[:, :, 0, :].transpose(0, 2, 1).reshape(len(lot), 16).tolist() for x in (costs, rank)]
        for row, i in enumerate(lot):
            out[i] = (firsts[0][row], firsts[1][row])
    return out


def _gaps(turns: list[int]) -> int:
    return min(turns[-1] - turns[0] + 1 - len(turns), (1 << 63) - 1) if turns else 0


# --- conversations that lie in one task, blocks of the others --------------------------------------

def _sorted_blocks(rows: DataFrame, key: str, outputs: tuple[str, ...], block_rows: int) -> DataFrame:
    """One row per conversation that a task holds in whole and in one block: what `repair` gives; one row per block of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        done: list[Block] = []
        kept: list[Block] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if done:
                pairs = [(b, b.faults()) for b in done]
                told = repaired(pairs, [0] * len(done), np.tile(TAIL * INSERT, (len(done), 1)))
                made = {c: [] for c in names}
                for (block, faults), (cost, audit, lines, state) in zip(pairs, told):
                    text = b"\n".join(lines + [b"user:", b"assistant:"][2 - TAIL[state]:])
                    values = {"whole": True, "gaps": _gaps(block.turns), "blank": int((faults == _BLANK).sum()), "duplicate": int((faults == _REPEAT).sum()),
                              "truncated": int((faults == _CUT).sum()), "illegal": block.illegal(), "cost": cost, "audit": audit + "I" * TAIL[state],
                              "repaired": text, "repaired_sha256": hashlib.sha256(text).hexdigest()}
                    for c in names:
                        made[c].append(block.key if c == key else values.get(c))
                yield batch_of(made)
                done.clear()
            for block in kept:  # one at a time: a block may be long
                values = {"whole": False, "block": part + block.number, "turns": block.turns, "roles": block.roles, "texts": block.texts}
                yield batch_of({c: [block.key if c == key else values.get(c)] for c in names})
            kept.clear()

        def batch_of(made: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, kinds[c]) for c, v in made.items()], list(made))

        def close(last: bool) -> None:
            # The first and the last conversation of a task may go on in other tasks.
            alone = numbers[0] > 0 and not last and now.number == numbers[0]
            (done if alone else kept).append(now)

        kinds, now, numbers, waiting = None, None, [0, 0], 0
        for batch in batches:
            if kinds is None:
                kinds = {key: batch.schema.field(0).type, "whole": pa.bool_(), "block": pa.int64(), "turns": pa.list_(pa.int64()), "roles": pa.list_(
                    pa.binary()), "texts": pa.list_(pa.binary()), **dict.fromkeys(COUNTS, pa.int64()), "audit": pa.string(), "repaired": pa.binary(),
                    "repaired_sha256": pa.string()}
            for conv, turn, times, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None:
                    now = Block(conv)
                elif conv != now.key or len(now.roles) >= block_rows or now.bytes >= BLOCK_BYTES:
                    same = conv == now.key
                    numbers[1] += 1
                    if same:
                        kept.append(now)
                    else:
                        close(False)
                        numbers[0] = numbers[1]
                    waiting += len(now.roles) + 1
                    if waiting >= TOGETHER or now.bytes >= BLOCK_BYTES:
                        yield from flush()
                        waiting = 0
                    now = Block(conv)
                    now.number = numbers[1]
                now.add(turn, times, role, text)
        if now is not None:
            close(True)
            yield from flush()

    names = [key, "whole", "block", "turns", "roles", "texts", *COUNTS, *outputs]
    kind = rows.schema[key].dataType.simpleString()
    types = {"whole": "boolean", "block": "long", "turns": "array<long>", "roles": "array<binary>", "texts": "array<binary>", "audit": "string",
             "repaired": "binary", "repaired_sha256": "string"}
    schema = ", ".join(f"`{c}` {kind if c == key else types.get(c, 'long')}" for c in names)
    return rows.select(key, "turn", "times", F.col("role").cast("binary"), F.col("text").cast("binary")).mapInArrow(run, schema)


def _block_of(row: dict) -> Block:
    block = Block(None)
    block.roles, block.texts, block.turns = row["roles"], row["texts"], row["turns"]
    return block


def _earlier(blocks: DataFrame, key: str) -> DataFrame:
    """(block, before): the digests of a block's rows that an earlier block of its conversation holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                digests = sorted(set(_block_of({**row, "turns": []}).digests()))
                yield pa.RecordBatch.from_arrays([pa.array([row[key]] * len(digests), batch.schema.field(key).type), pa.array(
                    [row["block"]] * len(digests), pa.int64()), pa.array(digests, pa.binary())], [key, "block", "digest"])

    kind = blocks.schema[key].dataType.simpleString()
    held = blocks.select(key, "block", "roles", "texts").mapInArrow(run, f"`{key}` {kind}, block long, digest binary")
    held = written(held, "conversation-digests")
    first = held.groupBy(key, "digest").agg(F.min("block").alias("first"), F.count("*").alias("n")).where("n > 1").select(
        F.col(key).alias("k"), F.col("digest").alias("d"), "first")
    met = held.join(first, held[key].eqNullSafe(first["k"]) & (held["digest"] == first["d"]) & (held["block"] > first["first"]))
    return met.groupBy("block").agg(F.collect_list("digest").alias("before"))


def _summaries(blocks: DataFrame, key: str) -> DataFrame:
    """What a conversation needs to know of each block: counts, borders, transfers between states. Faults come along for `_pieces`."""
    fields = ["n", "blank", "duplicate", "truncated", "illegal"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _block_of(row)
                faults = block.faults(frozenset(row["before"] or ()))
                (costs, ranks), letters = transfers([(block, faults)])[0], block.first_letters()
                counts = [len(faults), *(int((faults == f).sum()) for f in (_BLANK, _REPEAT, _CUT)), block.illegal()]
                turns = block.turns
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[key]], batch.schema.field(key).type), pa.array([row["block"]], pa.int64())]
                    + [pa.array([c], pa.int64()) for c in counts] + [pa.array([c], pa.binary()) for c in (letters[:1], letters[-1:]) for c in (c or [None])]
                    + [pa.array([c], pa.int64()) for c in ((turns[0], turns[-1], len(turns)) if turns else (None, None, 0))]
                    + [pa.array([costs], pa.list_(pa.int64())), pa.array([ranks], pa.list_(pa.int64())), pa.array([faults.tobytes()], pa.binary())], names)

    names = [key, "block", *fields, "first", "last", "low", "high", "n_turns", "costs", "ranks", "faults"]
    kind = blocks.schema[key].dataType.simpleString()
    schema = (f"`{key}` {kind}, block long, {', '.join(f'{c} long' for c in fields)}, first binary, last binary, low long, high long, n_turns long, "
              "costs array<long>, ranks array<long>, faults binary")
    return blocks.mapInArrow(run, schema)


def _routes(summaries: DataFrame, key: str) -> DataFrame:
    """Per block: the states in which the least cheapest path of its conversation enters and leaves it, and the conversation's counts.

    One task takes the blocks of a conversation, one small row each: costs to go from the last block to the first, then the path.
    """

    def route(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["block"])
        after, choices = [int(c) for c in TAIL * INSERT], []
        for row in reversed(rows):
            best = [min((row["costs"][q * 4 + z] + after[z], row["ranks"][q * 4 + z], z) for z in range(4)) for q in range(4)]
            after = [min(b[0], _FAR) for b in best]
            choices.append([b[2] for b in best])
        total = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")} | {"cost": after[0], "gaps": 0}
        full = [r for r in rows if r["n"]]
        total["illegal"] += sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(full, full[1:]))
        timed = [r for r in rows if r["n_turns"]]
        if timed:
            distinct = sum(r["n_turns"] for r in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
            total["gaps"] = min(timed[-1]["high"] - timed[0]["low"] + 1 - distinct, (1 << 63) - 1)
        state, enters, leaves = 0, [], []
        for choice in reversed(choices):
            enters.append(state)
            state = choice[state]
            leaves.append(state)
        n = len(rows)
        return pa.table({"block": pa.array([r["block"] for r in rows], pa.int64()), "enters": pa.array(enters, pa.int64()), "leaves": pa.array(
            leaves, pa.int64()), "tail": pa.array([0] * (n - 1) + [int(TAIL[state])], pa.int64())} | {c: pa.array([total[c]] * n, pa.int64()) for c in COUNTS})

    small = summaries.select(key, "block", "n", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "n_turns", "costs", "ranks")
    return small.groupBy(key).applyInArrow(route, ", ".join(f"{c} long" for c in ("block", "enters", "leaves", "tail", *COUNTS)))


def _pieces(blocks: DataFrame, key: str) -> DataFrame:
    """(key, block, counts, audit, lines) of each block with its entry and end state; lines are joined, null if there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, tail = _block_of(row), row["tail"]
                ends = np.where(np.arange(4) == row["leaves"], 0, _FAR)[None, :]
                _, audit, lines, _ = repaired([(block, np.frombuffer(row["faults"], np.int8))], [row["enters"]], ends)[0]
                lines += [b"user:", b"assistant:"][2 - tail:]
                yield pa.RecordBatch.from_arrays([pa.array([row[key]], batch.schema.field(key).type), pa.array([row["block"]], pa.int64()), *(pa.array(
                    [row[c]], pa.int64()) for c in COUNTS), pa.array([audit + "I" * tail]), pa.array([b"\n".join(lines) if lines else None], pa.binary())],
                    [key, "block", *COUNTS, "audit", "lines"])

    kind = blocks.schema[key].dataType.simpleString()
    return blocks.mapInArrow(run, f"`{key}` {kind}, block long, {', '.join(f'{c} long' for c in COUNTS)}, audit string, lines binary")


def _joined(pieces: DataFrame, key: str, outputs: tuple[str, ...]) -> DataFrame:
    """Blocks in order into one row per conversation. A digest over a whole conversation is made in one task, but streaming."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def finish() -> pa.RecordBatch:
            values = {"audit": "".join(now["audit"]), "repaired": b"\n".join(now["lines"]), "repaired_sha256": now["sha"].hexdigest()}
            return pa.RecordBatch.from_arrays(
                [pa.array([now["row"][key]], kind), *(pa.array([now["row"][c]], pa.int64()) for c in COUNTS), *(pa.array(
                    [values[c]], pa.binary() if c == "repaired" else pa.string()) for c in outputs)], [key, *COUNTS, *outputs])

        for batch in batches:
            kind = batch.schema.field(key).type
            for row in batch.to_pylist():
                if now is None or row[key] != now["row"][key]:
                    if now is not None:
                        yield finish()
                    now = {"row": row, "audit": [], "lines": [], "sha": hashlib.sha256(), "any": False}
                now["audit"].append(row["audit"])
                if row["lines"] is not None:
                    now["sha"].update((b"\n" if now["any"] else b"") + row["lines"])
                    now["any"] = True
                    if "repaired" in outputs:
                        now["lines"].append(row["lines"])
        if now is not None:
            yield finish()

    kind = pieces.schema[key].dataType.simpleString()
    types = ", ".join(f"{c} {'binary' if c == 'repaired' else 'string'}" for c in outputs)
    return pieces.repartition(key).sortWithinPartitions(key, "block").mapInArrow(run, f"`{key}` {kind}, {', '.join(f'{c} long' for c in COUNTS)}, {types}")


def repair(rows: DataFrame, key: str = "conv_id", outputs: Sequence[str] = ("audit", "repaired_sha256"), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per conversation of `rows(key, turn, times, role, text)`: key, gaps, blank, duplicate, truncated, illegal, cost and the asked
    outputs (audit, repaired: UTF-8 bytes of `role:text` lines, repaired_sha256).

    Rows stand by turn (nulls first), of one turn by role and text; a row counts `times` times, 0 only keeps its conversation in the
    result, with zeros, an empty audit and an empty text if it has no other. A null role or text is given as the caller wants it
    read, none may be null here. Null keys are one conversation. An empty table gives an empty result. A gap count beyond a long
    is the largest long. An audit and a repaired text are as long as their conversation.

    Rows are range-partitioned by conversation and place, so a very long conversation lies in several tasks. What a task holds in whole
    is settled there. Other conversations go on as blocks: repeats are found across blocks, each block tells costs and audit ranks
    between its border states, one small row a block gives the path, and blocks are repaired apart. Rows alike in key, turn, role and
    the first characters of the text stay in one task, which reads them as a stream.
    """
    spark = rows.sparkSession
    prepare(spark)
    outputs = tuple(outputs)
    ranges = rows.repartitionByRange(F.col(key), F.col("turn"), F.col("role"), F.substring("text", 1, 32))
    found = written(_sorted_blocks(ranges.sortWithinPartitions(key, "turn", "role", "text"), key, outputs, block_rows), "conversation-blocks")
    settled = found.where("whole").select(key, *COUNTS, *outputs)
    blocks = found.where("not whole").select(key, "block", "turns", "roles", "texts")
    summaries = written(_summaries(blocks.join(_earlier(blocks, key), "block", "left"), key), "conversation-summaries")
    routed = blocks.join(summaries.select("block", "faults"), "block").join(_routes(summaries, key), "block")
    return settled.unionByName(_joined(_pieces(routed, key), key, outputs))
