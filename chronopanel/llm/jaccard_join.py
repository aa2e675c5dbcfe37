"""Exact n-gram Jaccard join in metric space, and its link components.

A document is the set of its distinct n-word shingles; d = 1 - Jaccard is a
metric, and two documents link when d <= eps (eps = 0.25).

Unrelated documents are all at distance 1 from each other, so pivots drawn
from the corpus at random tell nothing about them. The pivots are therefore
chosen where documents come near each other at all:

1. Documents with equal sets are one class; one of them stands for it.
2. Of two linked sets x and y, at most floor(|x| / 4) shingles of x miss in
   y. In any fixed order of all shingles, the first floor(|x| / 4) + 1 of x
   (its prefix) and the first of y therefore share one. The documents with
   one prefix shingle are a region; every linked pair meets in a region. In
   order of size a region is cut wherever the next set is more than 4/3 as
   large: no link crosses that gap.
3. Each region goes whole to the cell of its pivot, its first document by size
   and id. A document lies in the cells of all pivots with which it shares a
   region: its nearest ones, and those across the boundary. Every linked pair
   is in one cell, and cells are few: near copies share their pivots.
4. Inside a cell a triangle inequality tells strangers apart before any set
   is moved: with the slices U_j of the hash range as pivots in the metric of
   the symmetric difference, |x ^ y| >= sum_j | |x & U_j| - |y & U_j| |, and
   linked sets differ in at most (|x| + |y|) / 7 shingles. Documents without
   a possible partner leave the cell. A set of n shingles has about n / 8
   slices, at four bits each. A large cell is compared block by block.
   A pair meets again in the cell of every stranger that shares one of its
   shingles, and strangers grow with the table. So the possible partners of
   all cells are chained to groups, over ids alone, and the sets of a group
   move once, however many cells it was found in.
5. Of a group that is too large for one task the cells are joined one by one. A
   cell that is itself too large is split again by the ball of its
   smallest member that is left: the members within eps of that centre are
   linked through it and need no comparison with each other; the others meet
   each other, and those within 2 eps of the centre also meet the ball, block
   by block.
6. Groups, small cells and blocks are joined exactly on the whole sets by an
   inverted index in a task. It returns the edges of a spanning forest: enough for the
   components, and no group emits all its pairs.

The order of shingles is by how rare their words are, then by hash, except
that shingles found often come last; both are told from a bounded sample of
documents. The order affects the size of the regions only, never the result.

Defined cases: a document with fewer words than n has its whole sequence as
one shingle; without words or text it has no shingle and is a component of
its own; rows without id get no component; rows that share an id count as
one document that has all their links; repeated rows fall into one class; an
empty table gives no rows; only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import remove_table, shuffles_removed, sized, tidy, written
from .words import Words, _mix, slices

SHINGLE = 5
SLICES = 128              # slices of a small set
SAMPLE_DOCS = 5000        # documents of the sample that finds frequent shingles
SAMPLE_SHINGLES = 2000    # at most so many shingles and words of each
WORD_BITS = 20            # words are counted by so many bits of their hash
FREQUENT = 3              # found in so many of the sample's documents
MOST_FREQUENT = 200_000   # at most so many are put last
UNIT_SHINGLES = 3_000_000  # shingles that one task joins at a time
CELL_DOCS = 4096          # members of a cell that one task compares by slices
SIZE_STEPS = 8            # size classes between a set and one of 4/3 its size


# --- one row per document ----------------------------------------------------

def _describe(share: float):
    limit = np.uint64(min(int(share * 2 ** 64), 2 ** 64 - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                words = Words(b.column("text"), lower=True)
                sets = words.shingle_sets(SHINGLE)
                slots = word_slots(words)
                n = np.array([len(s) for s in sets], np.int64)
                k1 = np.array([_mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
                k2 = np.array([_mix(s ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64) for s in sets], np.uint64)
                pick = _mix(k1 + k2) <= limit
                yield pa.record_batch([
                    b.column("doc_id"), pa.array(n), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                    pa.array([slice_counts(s) for s in sets], pa.binary()),
                    pa.array([s[:SAMPLE_SHINGLES].tobytes() if p else None for s, p in zip(sets, pick)], pa.binary()),
                    pa.array([slots[a:min(z, a + SAMPLE_SHINGLES)].tobytes() if p else None for a, z, p in zip(words.first[:-1], words.first[1:], pick)], pa.binary()),
                ], names=["doc_id", "n", "k1", "k2", "counts", "sample", "words"])

    return run


def word_slots(words: Words) -> np.ndarray:
    return (words.hash >> np.uint64(64 - WORD_BITS)).astype(np.uint32)


def n_slices(n: int) -> int:
    """A power of two, n / 8 or more."""
    return max(SLICES, 1 << (max(n - 1, 0) // 8).bit_length())


def slice_counts(s: np.ndarray) -> bytes:
    """Shingles in each slice of the hash range, two counts a byte. Counts
    stop at 15: that keeps differences at or below the true ones."""
    k = n_slices(len(s))
    c = np.minimum(np.bincount((s >> np.uint64(64 - k.bit_length() + 1)).astype(np.int64), minlength=k), 15).astype(np.uint8)
    return (c[::2] | c[1::2] << 4).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    return np.stack([b & 15, b >> 4], axis=1).ravel().astype(np.int16)


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, n, k1, k2, counts, sample, words) of every document; k1 and k2
    are a 128-bit key of the set."""
    total = max(docs.count(), 1)
    return written(docs.mapInArrow(tidy(_describe(SAMPLE_DOCS / total)),
                                   "doc_id long, n long, k1 long, k2 long, counts binary, sample binary, words binary"), "near-sets")


def frequent(described: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles found often in the sample, sorted, their rank by how often, and
    the cost of each word slot: 16 times the logarithm of how often its words
    were found."""
    rows = described.where("sample is not null").dropDuplicates(["k1", "k2"]).select("sample", "words").limit(2 * SAMPLE_DOCS).collect()
    found = np.zeros(1 << WORD_BITS, np.int64)
    for r in rows:
        np.add.at(found, np.frombuffer(r[1], np.uint32), 1)
    cost = np.round(16 * np.log2(found + 1)).astype(np.uint16)
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), cost
    h, c = np.unique(np.concatenate([np.frombuffer(r[0], np.uint64) for r in rows]), return_counts=True)
    often = c >= FREQUENT
    h, c = h[often], c[often]
    order = np.lexsort((h, c))  # rare first
    if len(order) > MOST_FREQUENT:
        order = order[-MOST_FREQUENT:]
    rank = np.full(len(h), -1, np.int64)
    rank[order] = np.arange(len(order))
    return h[rank >= 0], rank[rank >= 0], cost


# --- regions and cells -------------------------------------------------------

def shingles(words: Words, cost: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sorted distinct shingles of each text, and what each one's words cost."""
    h, at = words.ngrams(SHINGLE)
    upto = np.zeros(len(words.hash) + 1, np.int64)
    np.cumsum(cost[word_slots(words)], out=upto[1:])
    last = np.repeat(words.first[1:], np.diff(words.first))
    paid = (upto[np.minimum(at + SHINGLE, last[at])] - upto[at]).astype(np.uint16)
    cut, sets, costs = np.searchsorted(at, words.first), [], []
    for a, b in zip(cut[:-1], cut[1:]):
        order = np.argsort(h[a:b], kind="stable")
        s = h[a:b][order]
        keep = np.ones(len(s), bool)
        np.not_equal(s[1:], s[:-1], out=keep[1:])
        sets.append(s[keep])
        costs.append(paid[a:b][order][keep])
    return sets, costs


def prefix(s: np.ndarray, often: np.ndarray, rank: np.ndarray, cost: np.ndarray | None = None) -> np.ndarray:
    """The first floor(n / 4) + 1 shingles of a sorted set in the order that
    puts cheap ones first and frequent ones last."""
    k = len(s) // 4 + 1
    is_often = np.zeros(len(s), bool)
    if len(often):
        at = np.searchsorted(often, s)
        at[at == len(often)] = 0
        is_often = often[at] == s
    rare = s[~is_often]
    rare = rare[:k] if cost is None else rare[np.argsort(cost[~is_often], kind="stable")[:k]]
    if len(rare) == k or not is_often.any():
        return rare
    hot = s[is_often]
    return np.concatenate([rare, hot[np.argsort(rank[at[is_often]], kind="stable")][: k - len(rare)]])


def size_class(n: np.ndarray) -> np.ndarray:
    """Classes of linked sets differ by ``SIZE_STEPS`` at most, or by one more
    where a logarithm is rounded."""
    return np.floor(np.log(np.maximum(n, 1)) * (SIZE_STEPS / np.log(4 / 3))).astype(np.int32)


def _regions(often):
    def run(batches):
        h, rank, cost = often.value
        for whole in batches:
            for b in slices(whole, "text"):
                sets, costs = shingles(Words(b.column("text"), lower=True), cost)
                first = [prefix(s, h, rank, c) if len(s) else s for s, c in zip(sets, costs)]
                many = [len(x) for x in first]
                ids = np.repeat(b.column("doc_id").to_numpy(), many)
                size = np.repeat(size_class(np.array([len(s) for s in sets], np.int64)), many)
                s = np.concatenate(first)
                hot = np.isin(s, h, assume_unique=False) if len(h) else np.zeros(len(s), bool)
                # 48 bits tell regions apart; two that fall together are one
                yield pa.record_batch([pa.array((s >> np.uint64(16)).view(np.int64)), pa.array(size), pa.array(ids), pa.array(hot)], names=["s", "size", "doc", "hot"])

    return run


def cells(reps: DataFrame, often) -> DataFrame:
    """(pivot, doc) for all cells of two documents or more. A region of a
    shingle that is not frequent is read once, in order of size, behind one
    shuffle, and cut where no link crosses. Frequent shingles can have regions
    of any size (a group of copies may hold a third of all rows): their
    smallest document is found by partial aggregation, and the join with it is
    split where a region is large."""
    regions = written(reps.mapInArrow(tidy(_regions(often)), "s long, size int, doc long, hot boolean"), "near-regions")
    by_size = Window.partitionBy("s").orderBy("size", "doc")
    so_far = by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rare = (regions.where("not hot").select("s", "size", "doc", (F.col("size") - F.lag("size").over(by_size)).alias("gap"))
            .select("doc", F.last(F.when(F.coalesce(F.col("gap") > SIZE_STEPS + 1, F.lit(True)), F.col("doc")), ignorenulls=True).over(so_far).alias("pivot")))
    hot = regions.where("hot").select("s", "doc")
    low = hot.groupBy("s").agg(F.min("doc").alias("pivot"))
    near = written(rare.where("pivot <> doc").select("pivot", "doc")
                   .unionByName(hot.join(low, "s").where("pivot <> doc").select("pivot", "doc")).distinct(), "near-cells")
    remove_table(regions)
    return near.unionByName(near.select("pivot", F.col("pivot").alias("doc")).distinct())


def possible(n: np.ndarray, counts: list[bytes]) -> np.ndarray:
    """Members of a cell for which the slices allow a linked partner."""
    return partners(n, counts) >= 0


def partners(n: np.ndarray, counts: list[bytes]) -> np.ndarray:
    """For each member of a cell the number of its group: members for which the
    slices allow a link are in one group, those without any are in -1. Sets of
    4/3 of a set's size have as many slices or twice as many; those are summed
    in pairs, and the sums stop at 15 as the counts do: each is then the count
    of the wider slice."""
    order = np.argsort(n, kind="stable")
    n, c = n[order], [unpacked(counts[k]) for k in order]
    group, width, rows, base = np.full(len(n), -1, np.int64), 0, None, 0
    for i in range(len(n) - 1):
        stop = int(np.searchsorted(n, 4 * n[i] // 3, "right"))
        if stop == i + 1:
            continue
        if len(c[i]) != width or base + len(rows) < stop:
            width, base = len(c[i]), i
            last = int(np.searchsorted(n, 2 * max(n[i], 8 * width), "right"))
            rows = np.stack([x if len(x) == width else np.minimum(x.reshape(width, -1).sum(axis=1, dtype=np.int16), 15) for x in c[i:max(last, stop)]])
        j = slice(i + 1, stop)
        differ = np.abs(rows[i + 1 - base: stop - base] - rows[i - base]).sum(axis=1, dtype=np.int64)
        ok = 7 * np.maximum(differ, n[j] - n[i]) <= n[j] + n[i]
        if ok.any():
            at = np.append(i + 1 + np.flatnonzero(ok), i)
            known = np.unique(group[at])
            known = known[known >= 0]
            group[at] = to = known[0] if len(known) else i
            if len(known) > 1:
                group[np.isin(group, known)] = to
    back = np.empty_like(group)
    back[order] = group
    return back


def _prune(table: pa.Table) -> pa.Table:
    group = partners(table.column("n").to_numpy(), table.column("counts").to_pylist())
    kept = table.select(["pivot", "doc", "n"]).filter(pa.array(group >= 0))
    group, doc = group[group >= 0], kept.column("doc").to_numpy()
    first = np.full(table.num_rows, np.iinfo(np.int64).max)
    np.minimum.at(first, group, doc)
    return kept.append_column("mate", pa.array(first[group]))


def pruned(found: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members (pivot, doc, n, mate) with a possible partner; mate is the
    smallest document of their group in the cell. Of a cell with more than
    ``CELL_DOCS`` members each task compares two blocks."""
    block = max(CELL_DOCS // 2, 1)
    large = written(found.groupBy("pivot").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > CELL_DOCS)
                    .select("pivot", F.ceil(F.col("m") / block).cast("int").alias("blocks")), "near-large")
    if large.isEmpty():
        parts = found.withColumn("part", F.lit(0).cast("long"))
    else:
        own = F.pmod(F.xxhash64("doc", F.lit("block")), F.col("blocks"))
        met = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1), lambda j: F.least(own, j) * F.col("blocks") + F.greatest(own, j))
        parts = (found.join(sized(large), "pivot", "left")
                 .select("pivot", "doc", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(met)).alias("part")))
    return (parts.join(sizes, "doc").select("pivot", "part", "doc", "n", "counts").groupBy("pivot", "part")
            .applyInArrow(_prune, "pivot long, doc long, n long, mate long"))


def gathered(near: DataFrame, unit: int) -> DataFrame:
    """Members (pivot, doc, n) of the units that are joined. Possible partners
    of all cells (pivot, doc, n, mate), chained, are a group; its pivot is its
    smallest document, and each of its sets is in it alone. Documents of a group
    with more than ``unit`` shingles stay in their cells; where such a cell has
    the pivot of a group, the two are joined as one."""
    chained = components(near.select(F.col("doc").alias("a"), F.col("mate").alias("b")))
    groups = written(near.groupBy("doc").agg(F.max("n").alias("n")).join(chained.withColumnRenamed("node", "doc"), "doc", "left")
                     .select(F.coalesce("component", "doc").alias("pivot"), "doc", "n"), "near-groups")
    large = written(groups.groupBy("pivot").agg(F.sum("n").alias("w")).where(F.col("w") > unit).select("pivot"), "near-large-groups")
    if large.isEmpty():
        return groups
    inside = groups.join(sized(large), "pivot", "left_semi").select("doc")
    return (groups.join(sized(large), "pivot", "left_anti")
            .unionByName(near.join(inside, "doc", "left_semi").groupBy("pivot", "doc").agg(F.max("n").alias("n")).select("pivot", "doc", "n")))


# --- exact joins -------------------------------------------------------------

def forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning forest of the link graph of the given sets, by breadth-first
    search over an inverted index of the members that are not yet reached."""
    size = np.array([len(s) for s in sets], np.int64)
    edges, left = [], np.ones(len(sets), bool)
    index = None
    for root in range(len(sets)):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue:
            x = queue.pop()
            if index is None or left.sum() * 2 < index[3]:
                index = _index(sets, np.flatnonzero(left))
            keys, start, docs, _ = index
            if not len(keys):
                break
            at = np.searchsorted(keys, sets[x])
            at[at == len(keys)] = 0
            at = at[keys[at] == sets[x]]
            span = start[at + 1] - start[at]
            if not span.sum():
                continue
            where = np.repeat(start[at] - np.cumsum(span) + span, span) + np.arange(span.sum())
            near, shared = np.unique(docs[where], return_counts=True)
            ok = left[near] & (100 * shared >= 75 * (size[near] + size[x] - shared))
            for y in near[ok].tolist():
                edges.append((x, y))
                left[y] = False
                queue.append(y)
    return edges


def _index(sets, members):
    """Sorted shingles of the members, where each one's members begin, the
    members, and how many they are."""
    if not len(members):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64), 0
    h = np.concatenate([sets[k] for k in members])
    d = np.repeat(members, [len(sets[k]) for k in members])
    order = np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    return h[at], np.append(at, len(h)), d, len(members)


def _join_unit(table: pa.Table) -> pa.Table:
    ids = table.column("doc").to_pylist()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
    edges = [(ids[a], ids[b]) for a, b in forest(sets) if ids[a] != ids[b]]
    return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})


def _sets(batches):
    for whole in batches:
        for b in slices(whole, "text"):
            sets = Words(b.column("text"), lower=True).shingle_sets(SHINGLE)
            yield pa.record_batch([b.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc", "set"])


def _ball(batches):
    """Distances to the cell's centre; of each (pivot, salt) the centre's row
    comes first and is all that is held."""
    key, middle, center = None, None, None
    for b in batches:
        out = []
        for pivot, salt, doc, is_member, n, raw in zip(*(b.column(c).to_pylist() for c in ("pivot", "salt", "doc", "is_member", "n", "set"))):
            s = np.frombuffer(raw, np.uint64)
            if (pivot, salt) != key:
                if is_member:
                    raise ValueError(f"cell {pivot} has no centre in part {salt}")
                key, middle, center = (pivot, salt), doc, s
            if is_member:
                i = len(np.intersect1d(center, s, assume_unique=True))
                out.append((pivot, middle, doc, n, 1.0 - i / (len(center) + len(s) - i), 100 * i >= 75 * (len(center) + len(s) - i)))
        if out:
            p, c, d, n, dist, linked = zip(*out)
            yield pa.record_batch([pa.array(p, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(n, pa.int64()), pa.array(dist), pa.array(linked)],
                                  names=["pivot", "center", "doc", "n", "d", "linked"])


def split_large(large: DataFrame, sets: DataFrame, unit: int, salts: int = 32) -> tuple[DataFrame, DataFrame]:
    """Large cells (pivot, doc, n): the links of the cells' balls, and the
    units (unit, doc) in which the remaining pairs meet. The centre of a ball
    is the cell's smallest member that is left: the pivot, unless the slices
    told it apart. All parts of a cell use the same one of its sets."""
    salted = large.join(sets, "doc").select("pivot", F.pmod(F.xxhash64("doc"), F.lit(salts)).alias("salt"), "doc", F.lit(1).alias("is_member"), "n", "set")
    middle = large.groupBy("pivot").agg(F.min("doc").alias("doc"))
    one = sets.join(middle.select("doc").distinct(), "doc", "left_semi").groupBy("doc").agg(F.min("set").alias("set"))
    centers = (middle.join(one, "doc")
               .select("pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"), "doc", F.lit(0).alias("is_member"),
                       F.lit(0).cast("long").alias("n"), "set"))
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    balls = written(salted.unionByName(centers).repartition(parts, "pivot", "salt").sortWithinPartitions("pivot", "salt", "is_member")
                    .mapInArrow(_ball, "pivot long, center long, doc long, n long, d double, linked boolean"), "near-balls")
    links = balls.where("linked and center <> doc").select(F.col("center").alias("a"), F.col("doc").alias("b"))
    blocks = balls.groupBy("pivot").agg(F.ceil(F.sum(F.when(F.col("linked"), F.col("n")).otherwise(0)) * 2 / unit).cast("int").alias("n_in"),
                                        F.ceil(F.sum(F.when(F.col("linked"), 0).otherwise(F.col("n"))) * 2 / unit).cast("int").alias("n_out"))
    rows = balls.join(blocks, "pivot").where("n_out > 0")
    at = lambda n: F.pmod(F.xxhash64("doc", F.lit("block")), n).cast("int")
    name = lambda i, j: F.concat_ws("/", F.col("pivot"), i, j)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inner = rows.where("linked").withColumn("j", each("n_out")).select(name(F.concat(F.lit("in"), at(F.col("n_in"))), F.col("j")).alias("unit"), "doc")
    # beyond 2 eps of the centre no member of the ball can be near (a rounding step is left)
    rim = (rows.where("not linked and n_in > 0 and d <= 0.5000001").withColumn("i", each("n_in"))
           .select(name(F.concat(F.lit("in"), F.col("i")), at(F.col("n_out"))).alias("unit"), "doc"))
    outer = (rows.where("not linked").withColumn("j", each("n_out"))
             .select(name(F.concat(F.lit("out"), F.least(F.col("j"), at(F.col("n_out")))), F.greatest(F.col("j"), at(F.col("n_out")))).alias("unit"), "doc"))
    return links, inner.unionByName(rim).unionByName(outer)


def join_cells(members: DataFrame, sets: DataFrame, unit: int = UNIT_SHINGLES) -> DataFrame:
    """Edges (a, b) that connect whatever is linked inside the cells."""
    weight = written(members.groupBy("pivot").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("m")).where("m > 1"), "near-weights")
    small = members.join(weight.where(F.col("w") <= unit).select("pivot"), "pivot", "left_semi")
    units = small.select(F.col("pivot").cast("string").alias("unit"), "doc")
    edges = []
    if not weight.where(F.col("w") > unit).isEmpty():
        large = members.join(weight.where(F.col("w") > unit).select("pivot"), "pivot", "left_semi")
        links, more = split_large(large, sets, unit)
        edges.append(links)
        units = units.unionByName(more)
    # names of units only; the sets move once, to their units
    units = written(units, "near-units")
    edges.append(sets.join(sized(units), "doc").select("unit", "doc", "set").groupBy("unit").applyInArrow(_join_unit, "a long, b long"))
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return written(out, "near-edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, by alternating large
    and small stars (Kiveris et al., 2014). Each round is a table in the
    shared folder."""
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "near-stars")
    mark = lambda x: tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    last = mark(e)
    while last[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "near-stars")
        now = mark(e)
        if now == last:
            break
        last = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def near_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = UNIT_SHINGLES) -> DataFrame:
    """One row per row of ``documents``: (doc_id, n_shingles, component_id)."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with shuffles_removed(documents.sparkSession):
        told, comps = _linked(docs, unit)
    out = told.select("doc_id", F.col("n").alias("n_shingles"))
    return (out.join(comps, out["doc_id"] == comps["node"], "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))


def _linked(docs: DataFrame, unit: int) -> tuple[DataFrame, DataFrame]:
    """The described documents, and the components of those that are linked."""
    spark = docs.sparkSession
    told = describe(docs)
    known = told.where("doc_id is not null and n > 0")
    classes = written(known.groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "near-classes")
    # an id that stands for the class of one of its texts stays, with all of them
    copies = written(known.join(classes.where("copies > 1"), ["n", "k1", "k2"]).where("doc_id <> rep").select("doc_id").distinct()
                     .join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti"), "near-copies")
    often = spark.sparkContext.broadcast(frequent(told))
    reps = docs.where("doc_id is not null").join(sized(copies), "doc_id", "left_anti")
    found = cells(reps, often)
    sizes = known.select(F.col("doc_id").alias("doc"), "n", "counts")
    near = written(pruned(found, sizes), "near-possible")
    remove_table(found)
    members = written(gathered(near, unit), "near-members")
    wanted = written(members.select("doc").distinct(), "near-wanted")
    sets = written(docs.join(sized(wanted.withColumnRenamed("doc", "doc_id")), "doc_id", "left_semi").mapInArrow(tidy(_sets), "doc long, set binary"), "near-shingles")
    edges = join_cells(members, sets, unit)
    remove_table(sets)
    # rows that share an id join the classes of all their texts
    same = known.join(classes, ["n", "k1", "k2"]).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    return told, components(edges.unionByName(same))


def near_duplicates(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return near_components(documents)


SQL = r"""
WITH RECURSIVE tok AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM tok)
  UNION ALL SELECT doc_id, len(ws) || ':' || array_to_string(ws, ' ') FROM tok WHERE len(ws) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pr AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pr JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 75 * (na.n + nb.n - i)),
reach(a, b) AS (SELECT doc_id, doc_id FROM tok UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM tok t LEFT JOIN n ON n.doc_id = t.doc_id JOIN reach r ON r.a = t.doc_id GROUP BY t.doc_id, n.n
"""
