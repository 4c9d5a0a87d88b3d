"""Exact Jaccard join of documents on word n-grams.

A document's set is its distinct shingles as 64-bit hashes, sorted. Equal sets are one node
from the start. Sizes fall into bands that a similar partner can leave by one at most; a
tile is two neighbouring bands. Similar sets of a tile differ in at most D elements, so of
more than D parts of the hash space, one holds the same elements in both: the hash of each
part is a key that similar sets share. Empty parts give no key. There are more parts than D
by what random sets leave empty, as a rule; a set that leaves more of them empty than a
similar partner could account for is cut into parts once more by another hash, and both
partners are if only empty parts are equal in them. So no pair is lost, and keys are shared
by sets that are alike somewhere, not by all that lack something.

The smallest node of a key is its pivot; all others of the key are paired with it, not with
each other. Two nodes of one key are both in the family of its pivot, so what remains after
the pivot pairs are only pairs of a family that links do not join yet. These are compared
inside tiles of a family: the bit counts of parity bitmaps bound the overlap from above,
whole blocks at a time, and pairs that pass are intersected exactly. A first round takes
just the closest pairs that would join groups, a second one every pair between groups that
are then still apart. So no group of copies is expanded into pairs, and every link between
different sets is found, or its ends are joined by others.

Shuffled per document: a number of keys that is a fixed share of its set size, pre-combined
per task; bitmaps travel for nodes that share a key, sets only for pairs within the bound.

Defined cases: a document without words has an empty set and links with nothing; with fewer
words than a shingle the whole sequence is its only shingle; a NULL text is empty; a NULL id
links with nothing and has a NULL component; rows that repeat an id are one node for the
component and keep their own set size; an empty table gives no rows. Extra columns are
ignored. Sets whose 64-bit fingerprints collide would count as equal.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import plain
from . import common
from .graph import connected
from .words import mix, windows, words_of

BITMAP_BITS = 1024  # least bits of a bitmap
FILTER_BITS = 1 << 25  # bits of the filter for documents whose sets are needed
SEEDS = 6  # hashes tried for sets that leave too many parts empty
FAMILY_BLOCK = 4096  # nodes of a family block
BLOCK_ROWS = 64
BLOCK_WORDS = 1 << 22  # 64-bit words compared at a time
PIECE_BYTES = 2 << 20
KEY_BITS = 48  # of a key as it travels; keys that meet by chance only add a pair to test


@dataclass(frozen=True)
class Rule:
    """Shingle width and similarity as a fraction: intersection * den >= union * num."""

    width: int = 5
    num: int = 80
    den: int = 100

    def similar(self, n, m, common_size):
        return self.den * common_size >= self.num * (n + m - common_size)

    def differing(self, total):
        """The most elements in which similar sets of that total size differ."""
        return total * (self.den - self.num) // (self.den + self.num)

    def bands(self, largest: int) -> np.ndarray:
        """First sizes of the bands; a partner of a size is in its band or a neighbour."""
        out = [1]
        while out[-1] <= largest * self.den // self.num + 1:
            out.append(out[-1] * self.den // self.num + 1)
        return np.array([*out, out[-1] * self.den // self.num + 1], dtype=np.int64)

    def most_differing(self, n):
        """The most elements in which a set of that size differs from a similar one."""
        return self.differing(n + n * self.den // self.num)

    def parts(self, bands: np.ndarray, tile: np.ndarray) -> np.ndarray:
        """Parts of each tile, none where only equal sets are similar: more than similar
        sets differ in, by those that a set of middle size leaves empty, and two deviations."""
        low = bands[tile + 1] - 1
        differing = self.most_differing(low)
        spare = np.full(len(tile), 3, dtype=np.int64)
        for _ in range(40):
            parts = differing + 1 + spare
            share = np.exp(-low / parts)
            empty = parts * share
            deviation = np.sqrt(empty * np.maximum(1 - (1 + low / parts) * share, 0))
            spare = np.maximum(spare, np.ceil(empty + 2 * deviation).astype(np.int64))
        return np.where(differing > 0, differing + 1 + spare, 0)


@dataclass
class Sets:
    """Sorted distinct shingle hashes of a batch of texts, one after the other."""

    values: np.ndarray
    first: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.sizes)

    def fingerprints(self) -> np.ndarray:
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.values + np.uint64(77)))))
        total = sums[self.first[1:]] - sums[self.first[:-1]]
        return mix(total + self.sizes.astype(np.uint64)).view(np.int64)


def shingle_sets(column: pa.Array, width: int) -> Sets:
    batch = words_of(column)
    counts = batch.counts
    n = len(counts)
    hashes, at = windows(batch, width)
    short = np.flatnonzero((counts > 0) & (counts < width))
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(sizes)))
    values = np.empty(int(first[-1]), dtype=np.uint64)
    doc = batch.doc[at]
    # The windows of a text are as many as its place is wide, in order.
    values[at - batch.first[doc] + first[doc]] = hashes
    for d in short:
        own = batch.hashes[batch.first[d] : batch.first[d + 1]]
        factors = np.array([pow(0xA24BAED4963EE407, k + 1, 2**64) for k in range(len(own))], dtype=np.uint64)
        values[first[d]] = mix(np.sum(own * factors, dtype=np.uint64, keepdims=True))[0]
    for d in range(n):
        values[first[d] : first[d + 1]].sort()
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    keep[first[:-1][sizes > 0]] = True
    kept = np.concatenate(([0], np.cumsum(keep)))
    return Sets(values[keep], kept[first])


def keys_of(sets: Sets, rule: Rule, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all sets and the set each belongs to."""
    sizes = sets.sizes
    band = np.searchsorted(bands, sizes, side="right") - 1
    all_keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for shift in (0, 1):  # as a smaller and as a larger partner
        tile = np.maximum(band - shift, 0)
        parts = np.where((sizes > 0) & (band >= shift), rule.parts(bands, tile), 0)
        # Similar sets are equal in all but so many parts: in more than can be empty.
        low = bands[tile + 1] - 1
        spare = parts - 1 - np.minimum(rule.most_differing(low), rule.most_differing(sizes))
        left = parts > 0
        for seed in range(SEEDS):
            key, owner, place = _part_keys(sets, np.where(left, parts, 0), tile, seed)
            all_keys.append(key)
            owners.append(owner)
            left &= parts - np.bincount(owner, minlength=len(sizes)) > spare
            if not left.any():
                break
        # What every hash leaves too empty also gives the keys of the last one's empty parts.
        for d in np.flatnonzero(left):
            missing = np.setdiff1d(np.arange(parts[d], dtype=np.uint64), place[owner == d])
            all_keys.append(mix(mix((np.uint64(tile[d]) << np.uint64(40) | missing) + np.uint64(2))))
            owners.append(np.full(len(missing), d))
    return np.concatenate(all_keys).view(np.int64), np.concatenate(owners)


def _part_keys(sets: Sets, parts: np.ndarray, tile: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the parts that are not empty, with their sets and the parts' numbers."""
    inside = np.repeat(parts > 0, sets.sizes)
    values, doc = sets.values[inside], sets.doc[inside]
    spread = values if seed == 0 else mix(values + np.uint64(0x9E3779B97F4A7C15 * seed % 2**64))
    part = ((spread >> np.uint64(32)) * parts[doc].astype(np.uint64)) >> np.uint64(32)
    if seed:
        order = np.lexsort((part, doc))
        values, doc, part = values[order], doc[order], part[order]
    head = np.ones(len(values), dtype=bool)
    head[1:] = (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(head)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), at)
    owner, place = doc[at], part[at]
    salt = np.uint64(seed) << np.uint64(60) | tile[owner].astype(np.uint64) << np.uint64(40) | place
    return mix(sums + mix(salt + np.uint64(1))), owner, place


def fingerprints(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles and the fingerprint of each document's set."""

    def work(piece: pa.RecordBatch) -> dict:
        sets = shingle_sets(piece.column("text"), rule.width)
        return {"doc_id": piece.column("doc_id"), "n_shingles": sets.sizes, "node": sets.fingerprints()}

    return common.by_pieces(docs, work, "doc_id long, n_shingles long, node long")


def _combined(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
    """One row per key of a piece: its smallest node and the other ones."""
    order = np.argsort(keys, kind="stable")
    keys, nodes = keys[order], nodes[order]
    head = np.ones(len(keys), dtype=bool)
    head[1:] = keys[1:] != keys[:-1]
    at = np.append(np.flatnonzero(head), len(keys))
    least, others, counts = nodes[at[:-1]].copy(), [], np.zeros(len(at) - 1, dtype=np.int64)
    for g in np.flatnonzero(np.diff(at) > 1):
        own = np.unique(nodes[at[g] : at[g + 1]])
        least[g], counts[g] = own[0], len(own) - 1
        if len(own) > 1:
            others.append(own[1:])
    flat = np.concatenate(others) if others else np.zeros(0, np.int64)
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
    rows = pa.RecordBatch.from_arrays([pa.array(least), pa.array(keys[at[:-1]]), lists], names=["node", "key", "others"])
    # Rows of one node next to each other take less room when they are shuffled.
    return rows.take(pa.array(np.argsort(least, kind="stable")))


def pivot_pairs(docs: DataFrame, rule: Rule, largest: int) -> DataFrame:
    """pivot, node: each node of a key with the key's smallest node, without repeats.

    Nearly all of the shuffle are keys of one node. They go without their upper bits, and
    behind the node, so that the zeros are next to what is the same in all such rows and
    compress with it.
    """
    bands = rule.bands(largest)

    def run(batches):
        for batch in batches:
            for piece in common.pieces(batch, "text", PIECE_BYTES):
                sets = shingle_sets(piece.column("text"), rule.width)
                keys, owner = keys_of(sets, rule, bands)
                yield _combined(keys & np.int64((1 << KEY_BITS) - 1), sets.fingerprints()[owner])

    keyed = docs.mapInArrow(run, "node long, key long, others array<long>")
    first = F.first("node").over(W.partitionBy("key").orderBy("node"))
    keyed = keyed.withColumn("pivot", first).where((F.col("node") != F.col("pivot")) | (F.size("others") > 0))
    members = keyed.select("pivot", F.explode(F.concat(F.array("node"), "others")).alias("node"))
    return members.where("node <> pivot").distinct()


def bitmap_bits(sizes: np.ndarray) -> np.ndarray:
    """Bits of a set's bitmap: a power of two, at least twice its size."""
    return np.maximum(BITMAP_BITS, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype(np.int64))


def _bitmaps(sets: Sets) -> list[bytes]:
    """A parity bit per hash class and set: sets differ in at least as many elements.

    The class is the hash modulo the number of bits, so a longer bitmap is brought to half
    its length by combining its halves.
    """
    sizes, out = sets.sizes, [b""] * (len(sets.first) - 1)
    bits = bitmap_bits(sizes)
    for length in np.unique(bits):
        chosen = np.flatnonzero(bits == length)
        number = np.repeat(np.arange(len(chosen)), sizes[chosen])
        values = sets.values[np.repeat(bits == length, sizes)]
        place = number * length + (values % np.uint64(length)).astype(np.int64)
        odd = (np.bincount(place, minlength=len(chosen) * length) & 1).astype(np.uint8)
        packed = np.packbits(odd.reshape(len(chosen), length), axis=1)
        for d, row in zip(chosen, packed):
            out[d] = row.tobytes()
    return out


def _folded(bitmap: bytes, words: int) -> np.ndarray:
    """A bitmap as 64-bit words, brought down to so many of them."""
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, dtype=np.uint64).reshape(-1, words), axis=0)


def _id_places(ids: DataFrame) -> np.ndarray:
    """A bit per hash of the ids, of a fixed size; it may say yes to others, never no."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = ids.select(F.shiftright(place, 5).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 32).cast("int")).alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 32, dtype=np.uint32)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy().astype(np.uint32)
    return out


def node_sets(docs: DataFrame, prints: DataFrame, pairs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """node, n, bitmap of the nodes in ``pairs``, from one document of each; doc_id, node, data
    of these documents and a few others; doc_id, node of these documents.

    The sets, which are most of the bytes, are written where they are made. Who needs some of
    them asks for the documents by the third table.
    """
    nodes = pairs.select(F.explode(F.array("pivot", "node")).alias("node")).distinct()
    ids = prints.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    wanted = common.checkpointed(ids.join(nodes, "node"), "set-owners")
    shared = docs.sparkSession.sparkContext.broadcast(_id_places(wanted.select("doc_id")))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("place")

    def run(batches):
        for batch in batches:
            at = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((shared.value[at >> 5] >> (at % 32).astype(np.uint32) & 1).astype(bool)))
            for piece in common.pieces(batch, "text", PIECE_BYTES):
                sets = shingle_sets(piece.column("text"), rule.width)
                first = sets.first * 8
                raw = sets.values.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(sets.fingerprints()),
                        pa.array(sets.sizes),
                        pa.array(_bitmaps(sets), pa.binary()),
                        pa.array([raw[a:b] for a, b in zip(first[:-1], first[1:])], pa.binary()),
                    ],
                    names=["doc_id", "node", "n", "bitmap", "data"],
                )

    found = docs.select("doc_id", "text", place).mapInArrow(run, "doc_id long, node long, n long, bitmap binary, data binary")
    found = common.checkpointed(found, "node-sets")
    # Rows that repeat an id and its text give a set twice, which only repeats a link.
    maps = found.select("doc_id", "node", "n", "bitmap").join(wanted, ["doc_id", "node"], "left_semi")
    return common.checkpointed(maps.drop("doc_id"), "node-bitmaps"), found.select("doc_id", "node", "data"), wanted


def _within(rule: Rule, n: np.ndarray, m: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Can sets of sizes n and m be similar, given that so many parity bits differ?"""
    close = (rule.den * np.minimum(n, m) >= rule.num * np.maximum(n, m))
    return close & (bits * (rule.den + rule.num) <= (n + m) * (rule.den - rule.num))


def bounded(pairs: DataFrame, maps: DataFrame, rule: Rule) -> DataFrame:
    """Pairs a, b that sizes and bit counts do not rule out."""

    def run(batches):
        for batch in batches:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            differ = np.zeros(len(batch), dtype=np.int64)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = x.as_buffer(), y.as_buffer()
                words = min(len(x), len(y)) // 8
                differ[i] = np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum()
            yield batch.select(["a", "b"]).filter(pa.array(_within(rule, n, m, differ)))

    left = maps.select(F.col("node").alias("a"), "n", F.col("bitmap").alias("x"))
    right = maps.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("bitmap").alias("y"))
    joined = pairs.join(right, "b").join(left, "a")
    return joined.select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, owners: DataFrame, rule: Rule) -> DataFrame:
    """Pairs a, b whose sorted sets are similar: an exact intersection.

    ``sets`` and ``owners`` are the second and third table of :func:`node_sets`.
    """

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                keep.append(rule.similar(len(x), len(y), int((both[1:] == both[:-1]).sum())))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Sets are large and few of them may be asked for: only those are moved.
    nodes = {c: pairs.select(F.col(c).alias("node")).distinct() for c in "ab"}
    ends = {c: common.checkpointed(owners.join(nodes[c], "node", "left_semi"), "asked-sets") for c in "ab"}
    asked = {c: sets.join(ends[c], ["doc_id", "node"], "left_semi") for c in "ab"}
    left = asked["a"].select(F.col("node").alias("a"), F.col("data").alias("x"))
    right = asked["b"].select(F.col("node").alias("b"), F.col("data").alias("y"))
    # The pivots may be in very many pairs, so their side is joined last and not moved on.
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _families(pairs: DataFrame, groups: DataFrame, maps: DataFrame) -> DataFrame:
    """Rows of all families whose nodes are not all of one group, dealt out in tiles.

    ``groups`` holds node, label of nodes that links already join; others stand alone. The
    pivot itself is no row: all pairs with it have been tested. Blocks keep a family of any
    size from meeting in one task. Nodes of the family's largest group meet the others only,
    not each other: a few strays of a large group cost as many rows as it has nodes.
    """
    label = F.coalesce("label", "node").alias("label")
    named = common.checkpointed(pairs.join(groups, "node", "left").select("pivot", "node", label), "families")
    sizes = named.groupBy("pivot", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("pivot").agg(F.sum("n").alias("g"), F.max(F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))

    def blocks(rows):
        return F.ceil(rows / FAMILY_BLOCK).cast("int")

    sizes = sizes.where("labels > 1").select(
        "pivot", F.col("main.label").alias("main"), blocks(F.col("g") - F.col("main.n")).alias("strays"), blocks(F.col("main.n")).alias("mains")
    )
    rows = named.join(common.checkpointed(sizes, "family-sizes"), "pivot")
    is_main, place = F.col("label") == F.col("main"), F.xxhash64("node", F.lit(1))
    block = F.when(is_main, F.col("strays") + F.pmod(place, F.col("mains"))).otherwise(F.pmod(place, F.col("strays"))).cast("int")
    last = F.when(is_main, F.col("strays")).otherwise(F.col("strays") + F.col("mains")) - 1
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    tile = (F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return rows.select("pivot", "node", "label", "block", *tile).join(maps, "node")


def _by_tile(batches, compare):
    """Apply ``compare`` to the rows of each tile, which come one after the other."""
    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if waiting is None else pa.concat_tables([waiting, table])
        keys = np.stack([table.column(c).to_numpy() for c in ("pivot", "i", "j")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        starts = [0, *cuts.tolist()]
        for a, b in zip(starts[:-1], starts[1:]):
            if b - a > 1:
                yield from compare(table.slice(a, b - a))
        waiting = table.slice(starts[-1])
    if waiting is not None and len(waiting) > 1:
        yield from compare(waiting)


def family_pairs(pairs: DataFrame, groups: DataFrame, maps: DataFrame, rule: Rule, every: bool) -> DataFrame:
    """Pairs a, b of a family, of different groups, that bit counts do not rule out.

    With ``every`` all such pairs; otherwise only enough of them to join what they would
    join, the ones with the fewest differing bits first: fewer than a tile has nodes.
    """

    def compare(table: pa.Table):
        # By size, so that the partners of some rows are a range after them.
        table = table.sort_by("n")
        node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        _, group = np.unique(table.column("label").to_numpy(), return_inverse=True)
        block, maps = table.column("block").to_numpy(), table.column("bitmap").to_pylist()
        across = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        end_of = np.searchsorted(n, n * rule.den // rule.num, side="right")
        folded: dict[tuple[int, int], np.ndarray] = {}
        at = 0
        while at < len(node):
            words = len(maps[at]) // 8
            rows = max(1, min(BLOCK_ROWS, BLOCK_WORDS // (words * max(1, int(end_of[at]) - at))))
            own = np.arange(at, min(at + rows, len(node)))
            other = np.arange(at, int(end_of[own[-1]]))
            at = own[-1] + 1
            near = group[own][:, None] != group[other][None, :]
            near &= other[None, :] > own[:, None]
            if across:
                near &= block[own][:, None] != block[other][None, :]
            if not near.any():
                continue
            for i in other:
                if (i, words) not in folded:
                    folded[i, words] = _folded(maps[i], words)
            bits = np.stack([folded[i, words] for i in other])
            differ = np.bitwise_count(bits[: len(own)][:, None, :] ^ bits[None, :, :]).sum(axis=2, dtype=np.int64)
            near &= _within(rule, n[own][:, None], n[other][None, :], differ)
            x, y = np.nonzero(near)
            y = other[y]
            if not every:
                x, y = _joining(x, y, differ, own, group)
            if len(x):
                a, b = node[own[x]], node[y]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    dealt = _families(pairs, groups, maps).repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")
    return dealt.mapInArrow(lambda batches: _by_tile(batches, compare), "a long, b long").distinct()


def _joining(x, y, differ, own, group) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of rows, those that join groups; ``group`` is brought up to date."""
    keep_x, keep_y = [], []
    for i in np.unique(x):
        others = y[x == i]
        others = others[np.argsort(differ[i, others - own[0]], kind="stable")]
        names, first = np.unique(group[others], return_index=True)
        mine = group[own[i]]
        new = names != mine
        if new.any():
            keep_x.extend([i] * int(new.sum()))
            keep_y.extend(others[first[new]].tolist())
            group[np.isin(group, names[new])] = mine
    return np.array(keep_x, dtype=np.int64), np.array(keep_y, dtype=np.int64)


def jaccard_links(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all documents, and links a, b between nodes of different sets.

    The links join all similar sets, directly or through their pivots.
    """
    docs = common.id_and_text(docs)
    prints = common.checkpointed(fingerprints(docs, rule), "fingerprints")
    largest = prints.agg(F.max("n_shingles")).first()[0] or 0
    known = docs.where("doc_id is not null")
    pairs = common.checkpointed(pivot_pairs(known, rule, largest), "pivot-pairs")
    maps, sets, owners = node_sets(known, prints.where("doc_id is not null"), pairs, rule)
    stars = pairs.select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    close = common.checkpointed(bounded(stars, maps, rule), "bounded-pairs")
    links = common.checkpointed(verified(close, sets, owners, rule), "pivot-links")
    # First what the closest pairs join; then, of what is still apart, every pair.
    for every in (False, True):
        rest = common.checkpointed(family_pairs(pairs, connected(links), maps, rule, every), "family-pairs")
        links = links.unionByName(common.checkpointed(verified(rest, sets, owners, rule), "family-links"))
    return prints, links


def jaccard_groups(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id that links lead to, or its own."""
    prints, links = jaccard_links(docs, rule)
    labels = connected(links)
    named = prints.where("doc_id is not null").join(labels, "node", "left")
    named = named.withColumn("group", F.when(F.col("n_shingles") > 0, F.coalesce("label", "node")))
    # Rows that repeat an id tie the groups of their sets together.
    split = named.groupBy("doc_id").agg(F.min("group").alias("a"), F.max("group").alias("b"), F.count(F.lit(1)).alias("n"))
    ties = named.join(split.where("n > 1 and a <> b").select("doc_id", "a"), "doc_id").where("group <> a")
    tied = connected(ties.select("a", F.col("group").alias("b")))
    named = named.join(tied.select(F.col("node").alias("group"), F.col("label").alias("whole")), "group", "left")
    named = common.checkpointed(
        named.select("doc_id", "n_shingles", F.coalesce("whole", "group").alias("group")), "named-groups"
    )
    sizes = named.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    several = common.checkpointed(sizes.where("n > 1").select("group", "least"), "group-ids")
    out = named.join(several, "group", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
    nameless = prints.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nameless)


def without_near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row of each group of sets that links join: the one with the smallest id.

    Rows that repeat an id are told apart by their sets and do not tie the groups of these
    together, so no text goes unless one that links lead to stays. Of rows with the same id
    and set the smallest text stays; rows without an id all stay. The ids that go, and those
    that repeat, are tables of their own, so that Spark broadcasts them only if their known
    size allows it.
    """
    prints, links = jaccard_links(docs, rule)
    named = prints.where("doc_id is not null").join(connected(links), "node", "left")
    group = F.when(F.col("n_shingles") > 0, F.coalesce("label", "node"))
    named = common.checkpointed(named.select("doc_id", "node", group.alias("group")), "named-sets")
    sizes = named.where("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "node")).alias("least"), F.count(F.lit(1)).alias("n"))
    several = common.checkpointed(sizes.where("n > 1").select("group", "least"), "group-sets")
    own = F.col("least").isNull() | (F.col("least") == F.struct("doc_id", "node"))
    named = named.join(several, "group", "left").select("doc_id", "node", own.alias("stays"))
    verdict = named.groupBy("doc_id").agg(F.min("stays").alias("stays"), F.count(F.lit(1)).alias("n"))
    special = common.checkpointed(verdict.where("n > 1 or not stays"), "special-ids")
    id_name = common.fresh_names(docs, ["row_id"])[0]
    rows = docs.withColumn(id_name, plain("doc_id").cast("long"))
    out = rows.join(special.select(F.col("doc_id").alias(id_name)), id_name, "left_anti").drop(id_name)
    again = special.where("n > 1").select("doc_id")
    repeated = rows.join(again.select(F.col("doc_id").alias(id_name)), id_name, "left_semi")

    def work(piece: pa.RecordBatch) -> dict:
        return {"node": shingle_sets(piece.column("text"), rule.width).fingerprints()}

    repeated, names = common.appended(repeated, work, "node long")
    node = names["node"]
    kept = named.where("stays").join(again, "doc_id", "left_semi").select(F.col("doc_id").alias(id_name), F.col("node").alias(node)).distinct()
    repeated = repeated.join(kept, [id_name, node], "left_semi")
    place = common.fresh_names(repeated, ["place"])[0]
    order = W.partitionBy(plain(id_name), plain(node)).orderBy(plain("text"), F.xxhash64(*(plain(c) for c in docs.columns)))
    first = repeated.withColumn(place, F.row_number().over(order)).where(plain(place) == 1)
    return out.select(*map(plain, docs.columns)).unionByName(first.select(*map(plain, docs.columns)))


OP1_RULE = Rule(width=4, num=85, den=100)


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(common.table(spark, sf_dir, "documents"), OP1_RULE)
