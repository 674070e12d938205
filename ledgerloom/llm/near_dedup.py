"""Near-duplicates by SimHash, found with pivot distance tables.

A text's fingerprint is the bitwise majority of its word-shingle hashes.
Equal fingerprints are one node, so copies never multiply. To find pairs of
different fingerprints within `distance` bits:

1. Work is dealt out by blocks of bits: of b blocks, two fingerprints that
   differ in at most d bits agree in b - d whole blocks at least, so each
   fingerprint goes to one bucket per choice of b - d blocks and no pair is
   missed. The number of blocks follows from the number of fingerprints.
2. A table holds each fingerprint's Hamming distances to PIVOTS reference
   fingerprints. It is made once, before work is dealt out, and its rows travel
   with the fingerprints, a byte a pivot. By the triangle inequality two fingerprints
   within d bits differ by at most d in every coordinate; pairs that differ by
   more in any are discarded.
3. Survivors are verified bit by bit.

Small buckets test all their pairs; larger ones grow components outward from
one fingerprint, comparing only with those not reached yet, and emit a
spanning forest. A bucket of more than BUCKET fingerprints is cut into chunks
of which every two meet in a task of their own: all pairs are still tested.

For a similarity threshold (`similar_groups`) the same search comes first: texts
whose fingerprints are within `DISTANCE` bits, found by blocks and pivot tables,
are candidates. Pairs further apart than that are left to a second one, as at a
Jaccard similarity of 0.8 a sixth of the bits differ, as few blocks agree as by
chance, and no pivot's distances are further apart: texts that share a band of
minimum hashes and whose sketches allow the similarity. Both kinds of candidates
make families, and in each family the Jaccard similarity of whole shingle sets
decides. Of pairs just at 0.8 about one in 20,000 shares no band; it is found if
its fingerprints are close.

Defined cases: a null text counts as empty. Texts without words have
fingerprint zero and are linked like any other; texts shorter than a shingle
are one shingle. A component's id is its smallest document id, null ids
aside; rows that repeat a document are linked to it. An empty table gives no
rows. Columns other than the id and the text do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, mapped, parts_for, saved
from .graph import components, stars
from .wordcode import chunks, mixed, paired, word_codes

PIVOTS = 16
#: Fingerprints that one bucket holds before it is cut into chunks.
BUCKET = 20_000
#: Rows that a task links at once, but for one bucket, and rows that it gets.
ROWS, PART_ROWS = 100_000, 400_000
#: Buckets up to this size test all pairs at once.
SMALL = 12
#: Chance pairs per fingerprint that the choice of blocks allows for.
CHANCE_PAIRS = 64
SEED = 42


def shingle_hashes(text: bytes, words: int = 4) -> list[int]:
    """XXH64 of each run of `words` words; of all words where there are fewer, of none where there are none."""
    from xxhash import xxh64_intdigest

    parts = text.translate(ASCII_LOWER).split()
    if len(parts) <= words:
        return [xxh64_intdigest(b" ".join(parts), SEED)] if parts else []
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(parts) - words + 1].tolist()
    return [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]


def majority(hashes: list[int] | np.ndarray) -> int:
    """The unsigned fingerprint: a bit is set if it is in over half of the hashes."""
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        bits = np.unpackbits(np.array(hashes[at : at + 65536], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """doc_id, a hash of the text and the fingerprint's 64 bits as a signed long `fp`, one row per row of `docs`."""
    slim = _slim(docs, id_col, text_col)

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            prints = np.fromiter((majority(shingle_hashes(x.as_py() or b"", words)) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(prints.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return slim.transform(mapped, printed, "doc_id bigint, text_hash bigint, fp bigint")


def block_masks(prints: int, distance: int) -> list[int]:
    """Bit masks of the block choices for so many fingerprints: as few as keep chance pairs rare."""
    for blocks in range(distance + 1, 2 * distance + 5):
        edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
        parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
        masks = [sum(c) for c in combinations(parts, blocks - distance)]
        if sum(prints / 2 ** (m.bit_count() + 1) for m in masks) <= CHANCE_PAIRS:
            break
    return masks


def pivots(lanes: int = 1, count: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(11).integers(0, 2**64, (count, lanes), np.uint64)


def distance_table(prints: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint (row, of several 64-bit lanes) to each reference fingerprint (column)."""
    return np.stack([np.bitwise_count(prints ^ r).sum(1, dtype=np.int16) for r in reference], 1)


#: The table's rows as two longs.
PIVOT_LONGS = ["p0", "p1"]


def with_pivots(prints: DataFrame, lane: str = "fp") -> DataFrame:
    """`prints` with each fingerprint's row of the pivot distance table."""
    at = prints.columns.index(lane)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reference = pivots()
        for batch in batches:
            table = distance_table(batch.column(at).to_numpy().view(np.uint64)[:, None], reference).astype(np.uint8).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(PIVOT_LONGS)))], names=[*batch.schema.names, *PIVOT_LONGS])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prints.schema) + "".join(f", {p} bigint" for p in PIVOT_LONGS)
    return prints.transform(mapped, measured, schema)


def close(prints: np.ndarray, table: np.ndarray, i: np.ndarray | int, j: np.ndarray, distance: int) -> np.ndarray:
    """Which of the pairs (i, j) are within the distance: by the table first, then survivors by their bits."""
    passed = np.flatnonzero((np.abs(table[i] - table[j]) <= distance).all(-1))
    left = prints[i[passed]] if isinstance(i, np.ndarray) else prints[i]
    return passed[np.bitwise_count(left ^ prints[j[passed]]).sum(1, dtype=np.int16) <= distance]


def bucket_links(prints: np.ndarray, distance: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of links that connect whatever pairs within the distance connect in one bucket."""
    left, a, b = np.arange(len(prints)), [], []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            node = frontier.pop()
            near = close(prints, table, node, left, distance)
            if len(near):
                a.append(np.full(len(near), node))
                b.append(left[near])
                frontier.extend(left[near].tolist())
                left = np.delete(left, near)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def sorted_links(keys: np.ndarray, prints: np.ndarray, distance: int, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of links within each run of equal keys."""
    starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
    sizes = np.diff(np.append(starts, len(keys)))
    a, b = [], []
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        i, j = bucket_links(prints[s : s + n], distance, table[s : s + n])
        a.append(s + i)
        b.append(s + j)
    rows = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL), sizes))
    prints, keys, table = prints[rows], keys[rows], table[rows]
    for lag in range(1, SMALL):
        i = np.flatnonzero(keys[:-lag] == keys[lag:]) if len(keys) > lag else np.zeros(0, np.int64)
        if not len(i):
            break
        hit = i[close(prints, table, i, i + lag, distance)]
        a.append(rows[hit])
        b.append(rows[hit + lag])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _cut(keyed: DataFrame, by: list[str], bucket: int, weight: Column | None = None) -> DataFrame:
    """`keyed` (key and others) with buckets of more than `bucket` rows, or of that `weight`, cut into chunks, of which every two share a key."""
    full = keyed.groupBy("key").agg((F.count("*") if weight is None else F.sum(weight)).alias("n_key")).where(F.col("n_key") > bucket).select("key", F.ceil(F.col("n_key") / bucket).cast("int").alias("parts"))
    full = saved(full, "full-buckets")
    if full.isEmpty():
        return keyed
    # Chunk r of p meets every chunk of its bucket: in the tasks (min, max) of the two.
    part = F.pmod(F.xxhash64(*by), F.col("parts")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.xxhash64("key", F.least(o, F.col("part")), F.greatest(o, F.col("part"))))
    others = [c for c in keyed.columns if c != "key"]
    return keyed.join(full, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", part).select(F.explode(meets).alias("key"), *others)


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows (of long columns, sorted by the first) of about ROWS at a time, no run of equal keys cut."""
    held: list[np.ndarray] = []
    size = 0
    for got in batches:
        held.append(np.stack([c.to_numpy() for c in got.columns], 1))
        size += len(held[-1])
        if size >= ROWS and held[-1][-1, 0] != held[0][0, 0]:
            rows = np.concatenate(held)
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))  # the last run may go on
            yield rows[:cut]
            held, size = [rows[cut:]], len(rows) - cut
    if size:
        yield np.concatenate(held)


def links(prints: DataFrame, distance: int = 4, bucket: int = BUCKET) -> DataFrame:
    """`prints` (fp, all different) to links (child, root) that connect what pairs within `distance` bits connect."""
    prints = saved(with_pivots(prints.select("fp")), "pivot-table")
    masks = [m - 2**64 if m >= 2**63 else m for m in block_masks(prints.count(), distance)]
    keys = F.explode(F.array(*(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(masks))))
    keyed = _cut(prints.select(keys.alias("key"), "fp", *PIVOT_LONGS), ["fp"], bucket)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_runs(batches):
            table = np.ascontiguousarray(rows[:, 2:]).view(np.uint8).astype(np.int16)
            a, b = sorted_links(rows[:, 0], np.ascontiguousarray(rows[:, 1:2]).view(np.uint64), distance, table)
            child, root = stars(rows[a, 1], rows[b, 1])
            yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(root)], names=["child", "root"])

    dealt = keyed.select("key", "fp", *PIVOT_LONGS).repartition(parts_for(prints, PART_ROWS, len(masks)), "key")
    return dealt.sortWithinPartitions("key").transform(mapped, found, "child bigint, root bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id, the smallest document id that links reach, and text_hash."""
    printed = saved(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = saved(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), distance))
    rooted = nodes.join(roots, F.col("fp") == F.col("child"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "name")
    labels = rooted.join(named, F.col("root") == F.col("name")).select(F.col("fp").alias("node"), "component_id")
    return printed.join(labels, F.col("fp") == F.col("node")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash")


# ---- near-duplicates by a similarity threshold ---------------------------------------------------------------------------

LANES = ["l0", "l1", "l2", "l3"]
#: Shingles of a family that one task holds, and then another so many.
FAMILY = 1 << 20
#: Minimum hashes of a text; BANDS times BAND of them make its buckets, two bits of each its sketch.
HASHES, BANDS, BAND = 128, 25, 5
#: Deviations by which the sketches of a pair at the threshold may differ from their mean: exceeded about twice in a million.
SLACK = 5.0
#: Bits by which fingerprints of candidates differ at most.
DISTANCE = 4
#: Bits of the bitmap that picks texts whose sets are compared, at most: 16 MB on the driver and in each worker.
BITMAP = 1 << 27


def shingle_sets(texts: list[bytes | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the different shingles of each text, in order, one text after another; and how many each has."""
    codes, of = word_codes(texts)
    n = np.bincount(of, minlength=len(texts))
    begin = np.cumsum(n) - n
    place = np.arange(len(codes)) - begin[of]
    runs = np.zeros(len(codes), np.uint64)
    for i in range(words):  # a text of fewer words is one shingle, of those it has
        at = np.flatnonzero(place + i < n[of])
        runs[at] = paired(runs[at], codes[at + i])
    whole = (place + words <= n[of]) | ((place == 0) & (n[of] < words))
    runs, of = runs[whole], of[whole]
    order = np.lexsort((runs, of))
    runs, of = runs[order], of[order]
    new = np.append(True, (runs[1:] != runs[:-1]) | (of[1:] != of[:-1]))[: len(runs)]
    return runs[new], np.bincount(of[new], minlength=len(texts))


def _split(flat: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []


def _node(shingles: np.ndarray) -> int:
    """A number for a set of shingles, as a signed long."""
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def min_hashes(sets: list[np.ndarray], piece: int = 1 << 16) -> np.ndarray:
    """HASHES minimum hashes of each set (row); of two sets each is equal with the chance of their Jaccard similarity."""
    rng = np.random.default_rng(29)
    factors, terms = rng.integers(0, 2**64, (2, HASHES), np.uint64)
    factors |= np.uint64(1)
    out = np.zeros((len(sets), HASHES), np.uint64)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (size == 0 or size + len(sets[last]) <= piece):
            size += max(1, len(sets[last]))
            last += 1
        some = [x if len(x) else np.zeros(1, np.uint64) for x in sets[first:last]]
        joined = np.concatenate(some)
        starts = np.cumsum([0, *map(len, some[:-1])])
        for i in range(HASHES):
            out[first:last, i] = np.minimum.reduceat(joined * factors[i] + terms[i], starts)
        first = last
    return out


def bands(signatures: np.ndarray) -> np.ndarray:
    """A code of each run of BAND minimum hashes, different from run to run."""
    parts = signatures[:, : BANDS * BAND].reshape(-1, BANDS, BAND)
    codes = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(BAND):
        codes = paired(codes, parts[:, :, i])
    return codes


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Two bits of each minimum hash, 32 to a lane."""
    bits = (mixed(signatures) & np.uint64(3)).reshape(-1, len(LANES), 32) << (2 * np.arange(32, dtype=np.uint64))
    return np.bitwise_or.reduce(bits, 2)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of their minimum hashes two sketches (rows) show to be different."""
    x = a ^ b
    return np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(-1, dtype=np.int16)


def sketch_limit(similarity: float) -> float:
    share = 0.75 * (1 - similarity)
    return HASHES * share + SLACK * np.sqrt(HASHES * share * (1 - share))


def _sketch_links(rows: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of links that connect, in each run of equal keys, what sketches and sizes allow to be similar. `rows`: key, node, size, lanes."""
    keys, sizes, prints = rows[:, 0], rows[:, 2], np.ascontiguousarray(rows[:, 3:]).view(np.uint64)
    limit = sketch_limit(similarity)

    def near(i, j: np.ndarray) -> np.ndarray:
        fit = np.minimum(sizes[i], sizes[j]) + 1e-9 >= similarity * np.maximum(sizes[i], sizes[j])
        return fit & (apart(prints[i], prints[j]) <= limit)

    starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
    counts = np.diff(np.append(starts, len(keys)))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s, n in zip(starts[counts > SMALL].tolist(), counts[counts > SMALL].tolist(), strict=True):
        left = np.arange(s, s + n)
        while len(left) > 1:
            frontier, left = [left[0]], left[1:]
            while frontier and len(left):
                node = frontier.pop()
                hit = near(node, left)
                if hit.any():
                    a.append(np.full(int(hit.sum()), node))
                    b.append(left[hit])
                    frontier.extend(left[hit].tolist())
                    left = left[~hit]
    small = np.flatnonzero(np.repeat((counts > 1) & (counts <= SMALL), counts))
    for lag in range(1, SMALL):
        if len(small) <= lag:
            break
        i, j = small[:-lag], small[lag:]
        i, j = i[keys[i] == keys[j]], j[keys[i] == keys[j]]
        hit = near(i, j)
        a.append(i[hit])
        b.append(j[hit])
    return np.concatenate(a), np.concatenate(b)


def _print_links(nodes: DataFrame, bucket: int, distance: int = DISTANCE) -> DataFrame:
    """`nodes` (node, fp) to links (child, root) that connect what pairs of fingerprints within `distance` bits connect."""
    heads = saved(nodes.groupBy("fp").agg(F.min("node").alias("head")), "print-heads")
    same = nodes.join(heads, "fp").where("node != head").select(F.col("node").alias("child"), F.col("head").alias("root"))
    near = links(heads.select("fp"), distance, bucket)
    for side in ("child", "root"):
        near = near.join(heads.select(F.col("fp").alias(side), F.col("head").alias(f"{side}_node")), side)
    return same.unionByName(near.select(F.col("child_node").alias("child"), F.col("root_node").alias("root")))


def _families(nodes: DataFrame, similarity: float, bucket: int) -> DataFrame:
    """`nodes` (node, fp, size, lanes, bands) to child and root: families that hold all pairs of nodes whose fingerprints are close, or whose bands and sketches allow the similarity."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_runs(batches):
            i, j = _sketch_links(rows, similarity)
            child, root = stars(rows[i, 1], rows[j, 1])
            yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(root)], names=["child", "root"])

    keyed = _cut(nodes.select(F.explode("bands").alias("key"), "node", "size", *LANES), ["node"], bucket)
    banded = keyed.select("key", "node", "size", *LANES).repartition(parts_for(nodes, PART_ROWS, BANDS), "key").sortWithinPartitions("key").transform(mapped, found, "child bigint, root bigint")
    return components(_print_links(nodes.select("node", "fp"), bucket).unionByName(banded))


def set_links(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of links that connect whatever pairs of the sets with that Jaccard similarity connect, by an index of what they have in common."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    of = np.repeat(np.arange(len(sets)), sizes)
    values, which, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holders = of[np.argsort(which, kind="stable")]  # of each value in turn
    begin = np.cumsum(n) - n
    common = n[which] > 1
    mine = _split(which[common], np.bincount(of[common], minlength=len(sets)))
    left, a, b = np.ones(len(sets), bool), [], []
    while left.any():
        frontier = [int(left.argmax())]
        left[frontier[0]] = False
        while frontier and left.any():
            i = frontier.pop()
            count = n[mine[i]]
            at = np.arange(count.sum()) + np.repeat(begin[mine[i]] - (np.cumsum(count) - count), count)
            both = np.bincount(holders[at], minlength=len(sets))
            hit = np.flatnonzero(left & (both + 1e-9 >= similarity * (sizes[i] + sizes - both)) & (both > 0))
            a += [i] * len(hit)
            b += hit.tolist()
            left[hit] = False
            frontier += hit.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _wanted(slim: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The shingle sets of the `wanted` nodes (node, all different), and of a few more, as node and bytes: made again from the texts.

    A bitmap picks them before anything is shuffled: of 16 to 32 bits a wanted node, but never more than BITMAP in all.
    With more nodes than that is sharp for, more sets than the wanted ones are made and shuffled, in the worst case all
    of them once; the join by node leaves the wanted ones.
    """
    size = 1 << min(BITMAP.bit_length() - 1, max(10, int(16 * wanted.count()).bit_length()))
    at = F.col("node").bitwiseAND(F.lit(size - 1))
    words_ = wanted.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, int((node & {size - 1}L) & 63))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(size // 64, np.uint64)
    bitmap[words_["word"].to_numpy()] = words_["bits"].to_numpy().view(np.uint64)
    held = slim.sparkSession.sparkContext.broadcast(bitmap)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, texts in chunks(batch.column(0).cast(pa.binary()).to_pylist()):
                sets = _split(*shingle_sets(texts, words))
                nodes = np.fromiter(map(_node, sets), np.int64, len(sets))
                at = nodes.view(np.uint64) & np.uint64(size - 1)
                some = np.flatnonzero(held.value[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).tolist()
                some = [i for i in some if nodes[i] not in seen]  # copies within a task; others are found below
                seen.update(nodes[some].tolist() if len(seen) < 1 << 17 else ())
                yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array([sets[i].tobytes() for i in some], pa.binary())], names=["node", "shingles"])

    return slim.select("text").transform(mapped, made, "node bigint, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _verified(members: DataFrame, similarity: float, shingles: int) -> DataFrame:
    """`members` (key: a family, node, shingles) to links between nodes of a family that reach the Jaccard similarity."""
    weight = F.length("shingles") / 8
    cut = _cut(members, ["node"], shingles, weight).select("key", "node", "shingles")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets = None, [], []

        def linked() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1:
                a, b = set_links(sets, similarity)
                at = np.array(nodes, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at[b]), pa.array(at[a])], names=["child", "root"])

        for batch in batches:
            for k, node, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if k != key:
                    yield from linked()
                    key, nodes, sets = k, [], []
                nodes.append(node)
                sets.append(np.frombuffer(value.as_py(), np.uint64))
        yield from linked()

    return cut.repartition("key").sortWithinPartitions("key", "node").transform(mapped, found, "child bigint, root bigint")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, bucket: int = BUCKET, family: int = FAMILY) -> DataFrame:
    """doc_id, component_id and text_hash of texts connected by pairs whose shingle sets have a Jaccard similarity of the threshold at least.

    Equal sets are one node. Nodes whose SimHash fingerprints are close, by pivot distance tables, make families; so does,
    for what is further apart, whatever sketches and sizes allow to be similar in buckets of equal bands of minimum hashes.
    Both give spanning links, never all pairs. A family's whole shingle sets then meet once, in chunks of `family`
    shingles, of which every two share a task.
    """
    slim = _slim(docs, id_col, text_col)
    lanes = ", ".join(f"{c} bigint" for c in LANES)

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch.column(2).cast(pa.binary()).to_pylist()):
                flat, sizes = shingle_sets(texts, words)
                sets = _split(flat, sizes)
                signed = min_hashes(sets)
                drawn = sketches(signed).view(np.int64)
                columns = [
                    *(c.slice(first, len(texts)) for c in batch.columns[:2]),
                    pa.array([_node(x) for x in sets], pa.int64()),
                    pa.array(np.fromiter(map(majority, sets), np.uint64, len(sets)).view(np.int64)),
                    pa.array(sizes, pa.int64()),
                    *(pa.array(np.ascontiguousarray(drawn[:, i])) for i in range(len(LANES))),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(bands(signed).view(np.int64).reshape(-1))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "node", "fp", "size", *LANES, "bands"])

    rows = saved(slim.transform(mapped, printed, f"doc_id bigint, text_hash bigint, node bigint, fp bigint, size bigint, {lanes}, bands array<bigint>"), "shingle-prints")
    nodes = saved(rows.groupBy("node").agg(F.min("doc_id").alias("least"), *(F.first(c).alias(c) for c in ("fp", "size", *LANES, "bands"))), "nodes")
    families = _families(nodes, similarity, bucket)
    members = families.select(F.col("root").alias("key"), F.col("child").alias("node")).unionByName(families.select(F.col("root").alias("key"), F.col("root").alias("node")).distinct())
    sets = _wanted(slim, members.select("node"), words)
    held = saved(members.join(sets, "node"), "families")
    roots = components(_verified(held, similarity, family))
    labelled = nodes.join(roots.withColumnRenamed("child", "node"), "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "name")
    labels = labelled.join(named, F.col("root") == F.col("name")).select("node", "component_id")
    return rows.select("doc_id", "text_hash", "node").join(labels, "node").select("doc_id", "component_id", "text_hash")


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """`docs` with the row of smallest id of each group of similar texts; as `drop_near_duplicates` otherwise."""
    return _without(docs, id_col, text_col, similar_groups(docs, id_col, text_col, words, similarity))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4) -> DataFrame:
    """`docs` with the row of smallest id of each component; all columns as they were. Rows without an id cannot be told apart and stay."""
    return _without(docs, id_col, text_col, near_duplicates(docs, id_col, text_col, words, distance))


def _without(docs: DataFrame, id_col: str, text_col: str, found: DataFrame) -> DataFrame:
    """`docs` without rows of another id than their component's. Rows are told apart by id and text, so an id may have several texts."""
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_text")).distinct()
    names = docs.columns
    renamed = docs.toDF(*(f"c{i}" for i in range(len(names))))
    same = (F.col(f"c{names.index(id_col)}").cast("long") == F.col("_gone")) & (F.xxhash64(f"c{names.index(text_col)}") == F.col("_text"))
    return renamed.join(gone, same, "left_anti").toDF(*names)
