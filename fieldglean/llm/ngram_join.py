"""N-gram Jaccard join with set-relation skipping.

Index lists are skipped in blocks by size and position, and a set's answers are derived from those of a highly similar
set: what is far enough from a leader is far enough from all that the leader already answers for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.llm.common import batch_words, components, mix, pick, prepare, rolling, written
from fieldglean.session import parallelism

WIDTH, PERCENT = 5, 75
#: Shingles that one task counts, about; hashes gathered in a scan before they are dealt out.
BUCKET_SHINGLES, FLUSH = 2_000_000, 1_000_000
#: Shingles that this share of a sample of about so many documents holds are not counted but put last in the order of rarity
#: at once. The sample bears on how evenly the work is dealt, not on what is found.
HOT_SHARE, HOT_SAMPLE = 0.01, 4_000
#: Leaders that a set is compared with; shingles of a block of a group whose members are compared, about.
LEADERS, BLOCK_SHINGLES = 4, 400_000
#: Lists of more entries than this are compared in memory, without a row for a pair of groups.
LONG_LIST = 32
_U = np.uint64
_LOW = _U((1 << 48) - 1)


def _sets(batch: pa.RecordBatch, column: int, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a batch."""
    words, bounds = batch_words([(v or b"").lower() for v in batch.column(column).to_pylist()])  # of bytes: A-Z only
    runs = rolling(words, width)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= width:
            yield np.unique(runs[a:b - width + 1])
        else:
            yield rolling(words[a:b], int(b - a)) if b > a else words[:0]


def _set_id(hashes: np.ndarray, seed: int) -> int:
    with np.errstate(over="ignore"):
        return int(np.add.reduce(mix(hashes + _U(seed)), dtype=_U).view(np.int64))


def shingle_sets(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, set_id, check) of `rows(doc_id, t binary)`; the last two identify a set and are null if it is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch, 1, width))
            ids = [(_set_id(s, 1), _set_id(s, 2)) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([i for i, _ in ids], pa.int64()),
                 pa.array([c for _, c in ids], pa.int64())], ["doc_id", "n_shingles", "set_id", "check"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_shingles long, set_id long, check long")


def hot_shingles(rows: DataFrame, n_docs: int, width: int, share: float = HOT_SHARE, sample: int = HOT_SAMPLE) -> np.ndarray:
    """Shingles in a large share of a sample of the documents; at most mean set size / share of them."""
    rate = int(min(1.0, sample / max(1, n_docs)) * (1 << 20)) + 1
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("hot"), "doc_id"), F.lit(1 << 20)) < rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, c = np.unique(np.concatenate([*_sets(batch, 1, width), np.empty(0, _U)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["h", "c"])

    counts = drawn.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    least = max(3, int(share * min(n_docs, sample)))
    return np.sort(np.array([r["h"] for r in counts.where(F.col("c") >= least).select("h").collect()], np.int64).view(_U))


def shared_shingles(rows: DataFrame, n_buckets: int, hot: np.ndarray, width: int, percent: int) -> DataFrame:
    """(set_id, n, tokens, rarity) of the sets of which at least `percent` of the shingles are in another set too, with these.

    A scan packs (set, hash) pairs by hash bucket; each bucket counts the sets of each hash and passes on those with at least
    two, packed by set; there the parts of a set are put together. Fewer shared shingles than that leave no room for a link. 48 bits of a hash and its bucket tell shingles apart. Rarity is a small number that rises with the number of sets; hot
    shingles are passed on uncounted with the highest.
    """
    shared_hot = rows.sparkSession.sparkContext.broadcast(hot)

    def pack(held: list[tuple[int, np.ndarray]], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(s) for _, s in held])
        hashes, ids = np.concatenate([s for _, s in held]), np.repeat(np.array([i for i, _ in held], np.int64), sizes)
        whole = np.repeat(sizes.astype(np.uint32), sizes)
        bucket = ((hashes >> _U(40)) % _U(n_buckets)).astype(np.int64)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
            bucket = np.where(frequent[at] == hashes, n_buckets + ids % n_buckets, bucket)
            hashes = np.where(frequent[at] == hashes, hashes & _LOW, hashes)
        order = np.argsort(bucket, kind="stable")
        bucket, hashes, ids, whole = bucket[order], hashes[order], ids[order], whole[order]
        ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket))
        out = {"bucket": [], "ids": [], "sizes": [], "counts": [], "tokens": []}
        for a, b in zip(np.append(0, ends[:-1]), ends):
            steps = np.append(0, np.flatnonzero(np.diff(ids[a:b])) + 1)
            out["bucket"].append(bucket[a])
            out["ids"].append(ids[a:b][steps].tobytes())
            out["sizes"].append(whole[a:b][steps].tobytes())
            out["counts"].append(np.diff(np.append(steps, b - a)).astype(np.uint32).tobytes())
            out["tokens"].append(hashes[a:b].view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
        for i in range(0, len(out["bucket"]), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(out["bucket"][i:i + 1000], pa.int64()), *[
                pa.array(out[c][i:i + 1000], pa.binary()) for c in list(out)[1:]]], list(out))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, seen, held, waiting = shared_hot.value, set(), [], 0
        for batch in batches:
            for s in _sets(batch, 0, width):
                if len(s) and (i := _set_id(s, 1)) not in seen:
                    seen.add(i)
                    held.append((i, s))
                    waiting += len(s)
                if waiting >= FLUSH:
                    yield from pack(held, frequent)
                    held, waiting = [], 0
        if held:
            yield from pack(held, frequent)

    def count(group: pa.Table) -> pa.Table:
        number = group.column("bucket")[0].as_py()
        join = lambda c, kind: np.frombuffer(b"".join(group.column(c).to_pylist()), kind)
        low = np.zeros((sum(len(x) for x in group.column("tokens").to_pylist()) // 6, 8), np.uint8)
        low[:, :6] = join("tokens", np.uint8).reshape(-1, 6)
        counts = join("counts", np.uint32)
        tokens, ids, whole = low.view(_U).ravel(), np.repeat(join("ids", np.int64), counts), np.repeat(join("sizes", np.uint32), counts)
        order = np.lexsort((ids, tokens))
        tokens, ids, whole = tokens[order], ids[order], whole[order]
        fresh = np.append(True, (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1]))
        tokens, ids, whole = tokens[fresh], ids[fresh], whole[fresh]
        if number >= n_buckets:
            rarity = np.full(len(tokens), 127, np.int8)
        else:
            starts = np.append(0, np.flatnonzero(tokens[1:] != tokens[:-1]) + 1)
            sizes = np.diff(np.append(starts, len(tokens)))
            n = np.repeat(sizes, sizes)
            tokens, ids, whole, n = tokens[n > 1], ids[n > 1], whole[n > 1], n[n > 1]
            rarity = np.minimum(126, np.log2(np.maximum(n, 1)) * 4).astype(np.int8)
            tokens = tokens | _U((number % 65535 + 1) << 48)
        to = (ids.view(_U) >> _U(20)) % _U(n_buckets)
        order = np.argsort(to, kind="stable")
        ends = np.searchsorted(to[order], np.arange(n_buckets + 1))
        out = [(i, order[a:b]) for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if a < b]
        return pa.table({"part": pa.array([i for i, _ in out], pa.int64())} | {c: pa.array([x[o].tobytes() for _, o in out], pa.binary()) for c, x in (
            ("ids", ids), ("sizes", whole), ("tokens", tokens), ("rarity", rarity))})

    def gather(group: pa.Table) -> pa.Table:
        join = lambda c, kind: np.frombuffer(b"".join(group.column(c).to_pylist()), kind)
        ids, whole, tokens, rarity = join("ids", np.int64), join("sizes", np.uint32), join("tokens", np.int64), join("rarity", np.int8)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        starts = np.append(0, np.flatnonzero(ids[1:] != ids[:-1]) + 1)
        n, shared = whole[order][starts].astype(np.int64), np.diff(np.append(starts, len(ids)))
        enough = shared * 100 >= n * percent
        keep = order[np.repeat(enough, shared)]
        cuts = pa.array(np.append(0, np.cumsum(shared[enough])), pa.int32())
        return pa.table({"set_id": pa.array(ids[starts][enough]), "n": pa.array(n[enough]), "tokens": pa.ListArray.from_arrays(
            cuts, pa.array(tokens[keep])), "rarity": pa.ListArray.from_arrays(cuts, pa.array(rarity[keep]))})

    packed = rows.select("t").mapInArrow(deal, "bucket long, ids binary, sizes binary, counts binary, tokens binary")
    parts = packed.groupBy("bucket").applyInArrow(count, "part long, ids binary, sizes binary, tokens binary, rarity binary")
    return parts.groupBy("part").applyInArrow(gather, "set_id long, n long, tokens array<long>, rarity array<tinyint>")


def _need(n, percent: int):
    """The least overlap of a set of n with a linked set."""
    return (n * percent + 99) // 100


def index(candidates: DataFrame, percent: int) -> DataFrame:
    """(token, set_id, n, pos): the index lists. A set stands in the lists of its rarest shingles only, as many as are sure to
    hold one that it shares with each linked set; shingles no other set holds come first in that order and need no list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column(2).offsets.to_numpy()
            tokens, rarity = (batch.column(c).values.to_numpy() for c in (2, 3))
            for i, (set_id, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                own = slice(cuts[i], cuts[i + 1])
                size = cuts[i + 1] - cuts[i]
                listed = tokens[own][np.lexsort((tokens[own], rarity[own]))][:size - _need(n, percent) + 1]
                k = len(listed)
                yield pa.RecordBatch.from_arrays([pa.array(listed), pa.array(np.full(k, set_id)), pa.array(np.full(k, n)), pa.array(
                    np.arange(k) + (n - size))], ["token", "set_id", "n", "pos"])

    return candidates.select("set_id", "n", "tokens", "rarity").mapInArrow(run, "token long, set_id long, n long, pos long")


def overlaps(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """`pairs(a, b)` with n_a, n_b and `common`, counted on the sets in full."""
    left = candidates.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("x"))
    right = candidates.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    both = both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("x", "y")).cast("long").alias("common"))
    return both.withColumn("distance", 1 - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common")))


def _linked(percent: int):
    return 100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))


def compare_members(near: DataFrame, member: DataFrame, candidates: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between members of groups whose leaders `near(a, b, apart, far_a, far_b)` holds. Of each pair the larger group is
    held in blocks of bounded size and the sets of the smaller stream past them, so no row is made for a pair of sets. A group is
    connected already: a set needs one link to a block at most."""
    limit = 1 - percent / 100
    sets = candidates.select("set_id", "n").join(member, "set_id", "left").select(
        "set_id", "n", F.coalesce("root", "set_id").alias("root"), F.coalesce("distance", F.lit(0.0)).alias("distance"))
    sizes = sets.groupBy("root").agg(F.sum("n").alias("size"))
    for side in "ab":
        near = near.join(sizes.select(F.col("root").alias(side), F.col("size").alias(f"size_{side}")), side)
    held = F.col("size_a") >= F.col("size_b")
    near = written(near.select(
        F.when(held, F.col("a")).otherwise(F.col("b")).alias("held"), F.when(held, F.col("b")).otherwise(F.col("a")).alias("root"),
        F.when(held, F.col("far_a")).otherwise(F.col("far_b")).alias("far"), F.greatest("size_a", "size_b").alias("size"), "apart"), "join-near")
    asking = written(near.join(sets, "root").where(F.col("distance") + F.col("far") >= F.col("apart") - limit - 1e-9).select(
        "held", "set_id", "n", "size", (F.col("apart") - F.col("distance") - limit - 1e-9).alias("least")), "join-asking")
    # Both sides of a task are bounded: the held group is cut in blocks, those that ask it in parts.
    cuts = asking.groupBy(F.col("held").alias("root")).agg(F.ceil(F.max("size") / BLOCK_SHINGLES).cast("long").alias("blocks"), F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("parts"))
    blocks = sets.join(cuts, "root").select(
        F.col("root").alias("held"), F.pmod(F.xxhash64("set_id"), "blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "set_id", "distance")
    asking = asking.join(cuts.withColumnRenamed("root", "held"), "held").select("held", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.pmod(
        F.xxhash64("set_id"), "parts").cast("int").alias("part"), "set_id", "least")
    tokens = candidates.select("set_id", "n", "tokens")

    def compare(kept: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if kept.num_rows and asked.num_rows:
            ids, distance, n = (kept.column(c).to_numpy() for c in ("set_id", "distance", "n"))
            lists = kept.column("tokens").combine_chunks()
            flat = lists.flatten().to_numpy()
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))[order]
            for set_id, size, least, own in zip(asked.column("set_id").to_pylist(), asked.column("n").to_pylist(), asked.column("least").to_pylist(), asked.column("tokens")):
                may = (distance >= least) & (n * 100 >= size * percent) & (size * 100 >= n * percent)
                if may.any():
                    own = own.values.to_numpy()
                    at, end = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
                    count = end - at
                    places = np.arange(count.sum()) + np.repeat(at - np.append(0, np.cumsum(count)[:-1]), count)
                    common = np.bincount(owner[places], minlength=len(ids))
                    hit = np.flatnonzero(may & (100 * common >= percent * (n + size - common)))
                    if len(hit):
                        out.append((ids[hit[0]], set_id))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    key = ["held", "block", "part"]
    return blocks.join(tokens, "set_id").groupBy(*key).cogroup(asking.join(tokens, "set_id").groupBy(*key)).applyInArrow(compare, "a long, b long")


def long_lists(entries: DataFrame) -> DataFrame:
    """(token, set_id): entries of long lists (`entries(token, set_id, size)`) that are enough to bring all pairs of them together.

    A set's home is the longest of its lists. Lists that are a home are taken whole; near copies have few homes among them, and most
    pairs share one. Of any other list, a set meets sets of the homes in that list again where it stands in these homes too; it is
    taken only if one of them is not among its own lists.
    """
    homes = entries.groupBy("set_id").agg(F.max(F.struct("size", "token"))["token"].alias("home"))
    home = homes.select(F.col("home").alias("token")).distinct().withColumn("is_home", F.lit(True))
    known = written(entries.join(home, "token", "left").join(homes, "set_id").select("token", "set_id", "home", F.coalesce("is_home", F.lit(False)).alias("is_home")), "join-homes")
    own = known.where("is_home").groupBy("set_id").agg(F.collect_set("token").alias("own"))
    rest = known.where("not is_home")
    present = rest.groupBy("token").agg(F.collect_set("home").alias("present")).where(F.size("present") > 1)
    met = rest.join(present, "token").join(own, "set_id").where(F.size(F.array_except("present", "own")) > 0)
    return known.where("is_home").select("token", "set_id").unionByName(met.select("token", "set_id"))


def compare_lists(entries: DataFrame, groups: DataFrame, candidates: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect all linked sets of a list of `entries(token, set_id)`, given what `groups(set_id, root)` connects already.

    A list is cut in blocks of bounded size and every two blocks meet in a task. A set is counted against a whole block at once; of the
    sets it is linked with, one of each group that is not connected yet gives an edge, so edges are fewer than the sets of a task."""
    sets = entries.join(candidates.select("set_id", "n"), "set_id").join(groups, "set_id", "left").select(
        "token", "set_id", F.coalesce("root", "set_id").alias("root"), "n")
    cuts = sets.groupBy("token").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("long").alias("blocks"), F.min("root").alias("p"), F.max("root").alias("q"))
    own = F.pmod(F.xxhash64("set_id"), "blocks")
    dealt = sets.join(cuts.where("p < q"), "token").select("token", "set_id", "root", own.alias("block"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "set_id", "root")

    def compare(group: pa.Table) -> pa.Table:
        ids, n, label, block = (group.column(c).to_numpy() for c in ("set_id", "n", "root", "block"))
        label, out = label.copy(), []
        lists = group.column("tokens").combine_chunks()
        flat, cut = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        cut = cut - cut[0]
        held = block == group.column("i")[0].as_py()
        asking = np.flatnonzero(block == group.column("j")[0].as_py())
        order = np.argsort(flat, kind="stable")
        owner = np.repeat(np.arange(len(ids)), np.diff(cut))[order]
        ordered = flat[order]
        for y in asking:
            may = held & (label != label[y]) & (n * 100 >= n[y] * percent) & (n[y] * 100 >= n * percent)
            if may.any():
                tokens = flat[cut[y]:cut[y + 1]]
                at, end = np.searchsorted(ordered, tokens, "left"), np.searchsorted(ordered, tokens, "right")
                count = end - at
                places = np.arange(count.sum()) + np.repeat(at - np.append(0, np.cumsum(count)[:-1]), count)
                common = np.bincount(owner[places], minlength=len(ids))
                hit = np.flatnonzero(may & (100 * common >= percent * (n + n[y] - common)))
                for x in hit:
                    if label[x] != label[y]:
                        out.append((ids[x], ids[y]))
                        label[label == label[x]] = label[y]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    whole = dealt.join(candidates.select("set_id", "n", "tokens"), "set_id").select("token", "i", "j", "block", "set_id", "root", "n", "tokens")
    return whole.groupBy("token", "i", "j").applyInArrow(compare, "a long, b long")


def links(candidates: DataFrame, percent: int, long_list: int = LONG_LIST) -> DataFrame:
    """Edges (a, b) between linked sets that connect all linked sets, without all pairs of a group.

    1. Each set is compared with its leader, the first set of most of its lists. If they are linked and the leader has no leader
       itself, the set becomes a member of the leader's group at a known distance. It is compared with the next few leaders too,
       whose links may connect it already.
    2. A list is cut in blocks: the entries of a group of like size. Two blocks of a list meet only if their sizes and best
       positions still allow the overlap. The leaders of groups that meet are compared.
    3. Leaders that these links connect need no more. By the triangle inequality (1 - Jaccard is a metric) members of others further from their leaders than the distance of the
       leaders less the limit remain; only these are compared, in blocks (`compare_members`).
    """
    limit = 1 - percent / 100
    lists = written(index(candidates, percent), "join-lists")
    first = lists.groupBy("token").agg(F.min("set_id").alias("leader"))
    votes = lists.join(first, "token").groupBy("set_id", "leader").agg(F.count("*").alias("votes"))
    ranked = votes.where("leader <> set_id").groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("votes", "leader")), False).alias("leaders"))
    asked = ranked.select(F.col("set_id").alias("a"), F.posexplode(F.slice("leaders", 1, LEADERS)).alias("rank", "l")).select("a", "rank", F.col("l.leader").alias("b"))
    every = written(overlaps(asked, candidates).where(_linked(percent)).join(asked, ["a", "b"]), "join-leaders")
    told = every.where("rank = 0")
    member = told.join(told.select(F.col("a").alias("b")), "b", "left_anti").select(
        F.col("a").alias("set_id"), F.col("b").alias("root"), "distance")
    member = written(member, "join-members")
    sizes = written(lists.groupBy("token").agg(F.count("*").alias("size")).where(F.col("size") > long_list), "join-long")
    met = compare_lists(written(long_lists(lists.join(sizes, "token").select("token", "set_id", "size")), "join-met"), member.select("set_id", "root"), candidates, percent)
    entries = lists.join(sizes, "token", "left_anti").join(member, "set_id", "left").select("token", "set_id", "n", "pos", F.coalesce("root", "set_id").alias("root"),
                                                          F.coalesce("distance", F.lit(0.0)).alias("distance"))
    size_class = F.floor(F.log("n") / F.log(F.lit(100 / percent)) + 1e-9)
    blocks = entries.groupBy("token", "root", size_class.alias("class")).agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("pos").alias("pos"), F.max("distance").alias("far"))
    # Only lists that more than one group stands in.
    plural = blocks.groupBy("token").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p < q").select("token")
    blocks = written(blocks.join(plural, "token", "left_semi"), "join-blocks")
    other = blocks.select("token", F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("class"), *[
        F.col(c).alias(f"{c}_2") for c in ("root", "lo", "hi", "pos", "far")], F.col("class").alias("class_2"))
    need = F.ceil((F.col("lo") + F.col("lo_2")) * percent / (100 + percent) - 1e-9)
    meets = blocks.join(other, ["token", "class"]).where(
        (F.col("root") != F.col("root_2")) & ((F.col("class") != F.col("class_2")) | (F.col("root") < F.col("root_2")))
        & (F.col("hi_2") * 100 >= F.col("lo") * percent) & (F.col("hi") * 100 >= F.col("lo_2") * percent)
        & (F.least(F.col("hi") - F.col("pos"), F.col("hi_2") - F.col("pos_2")) >= need))
    swap = F.col("root") > F.col("root_2")
    pairs = meets.select(F.least("root", "root_2").alias("a"), F.greatest("root", "root_2").alias("b"), F.when(swap, F.col("far_2")).otherwise(
        F.col("far")).alias("far_a"), F.when(swap, F.col("far")).otherwise(F.col("far_2")).alias("far_b"))
    pairs = written(pairs.groupBy("a", "b").agg(F.max("far_a").alias("far_a"), F.max("far_b").alias("far_b")), "join-pairs")
    roots = written(overlaps(pairs, candidates).withColumn("ok", _linked(percent)), "join-roots")
    joined = written(components(every.select("a", "b").unionByName(roots.where("ok").select("a", "b")).unionByName(met)), "join-groups")
    ends = [joined.select(F.col("node").alias(c), F.col("component").alias(f"group_{c}")) for c in "ab"]
    apart = roots.where("not ok").join(ends[0], "a", "left").join(ends[1], "b", "left").where(
        F.coalesce("group_a", "a") != F.coalesce("group_b", "b")).select("a", "b", "distance")
    near = apart.join(pairs, ["a", "b"]).where(
        (F.col("far_a") + F.col("far_b") > 0) & (F.col("distance") - F.col("far_a") - F.col("far_b") <= limit + 1e-9))
    inner = compare_members(near.withColumnRenamed("distance", "apart"), member, candidates, percent)
    return joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(inner.select("a", "b"))


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, key: str = "doc_id", text: str = "text",
                       long_list: int = LONG_LIST) -> DataFrame:
    """Per row: key, n_shingles (size of its shingle set), component_id (smallest key that links reach, itself included).

    Letters A-Z are lower-cased; words are runs of anything but ASCII white space; a set holds the distinct shingles of `width`
    words, of a text with fewer words the whole sequence as one. Two rows link when 100 * common >= percent * union. A null
    or wordless text has size 0, links with nothing and has its own key as component. Rows with equal sets are one set; a null
    key takes part but is never a component's id unless the component has no other. An empty table gives an empty result; other
    columns are not looked at.

    Sets are told apart by 64-bit sums of hashes. Should two different sets ever have the same sum, a second sum shows it and the run
    stops with an error instead of joining them.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, key, text).select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("t"))
    sets = written(shingle_sets(rows, width), "join-sets")
    distinct = sets.where("n_shingles > 0").groupBy("set_id").agg(
        F.max("n_shingles").alias("n"), F.min("doc_id").alias("least"), (F.min("check") != F.max("check")).alias("clash"))
    distinct = written(distinct, "join-distinct")
    total = distinct.agg(F.sum("n").alias("shingles"), F.max("clash").alias("clash")).first()
    if total["clash"]:
        raise RuntimeError("two different shingle sets have the same 64-bit sum")
    n_buckets = max(parallelism(spark), -(-(total["shingles"] or 0) // BUCKET_SHINGLES))
    hot = hot_shingles(rows, sets.count(), width)
    candidates = written(shared_shingles(rows, n_buckets, hot, width, percent), "join-candidates")
    found = components(links(candidates, percent, long_list))
    named = found.join(distinct, found["node"] == distinct["set_id"]).groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = found.join(named, "component").select(F.col("node").alias("set_id"), "component_id")
    of_set = distinct.join(of_set, "set_id", "left").select("set_id", F.coalesce("component_id", "least").alias("component_id"))
    return sets.join(of_set, "set_id", "left").select(
        F.col("doc_id").alias(key), "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
