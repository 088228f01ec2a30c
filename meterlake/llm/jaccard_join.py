"""N-gram Jaccard join by a count-vector R-tree.

A document's set of 5-word shingles is hashed into groups; the counts of the groups are its point, and
the summed minima of two points bound the overlap of their sets. The tree has two levels of partitions:

* Tiles. With fine groups (one hash value each) a point is sparse. Coordinates are taken rarest first, by
  a histogram of fixed size. If two points share none of the first ``n - ceil(0.75 n) + 1`` coordinates
  of each, the summed minima over the rest cannot reach the threshold; so a point is entered in the tiles
  of these coordinates alone, and linked points meet in a tile.
* Trees. In a tile, points of ``GROUPS`` coarse coordinates are packed into leaves with their largest
  counts; leaves and then points are skipped by summed minima and by size.

Copies (equal sets) are one class. First each member of a tile is compared with the tile's hub alone (the
member that has most in common with others), which joins most groups of near copies; then the trees are searched for pairs that are not yet in
one component. Surviving pairs are verified on the whole sets. So a group of k near copies costs about
k comparisons, and no link between different components is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.bits import BITS, bit_filter, buckets, has
from meterlake.llm.components import components
from meterlake.llm.shared import discard, id_or_last, id_or_null, keyed_rows, stored
from meterlake.llm.text import BLANK, chunks, mixed, runs, text_array, words

SHINGLE = 5
#: Sets link when 100 * overlap >= PERCENT * union.
PERCENT = 75
GROUPS = 256
#: The histogram that orders coordinates has 2**ORDER_BITS counters in PIECES pieces, at any size of input.
ORDER_BITS, PIECES = 20, 64
#: A coordinate expected in more points than this is dealt out to several tiles, whose leaders meet.
TILE = 50_000
LEAF, BLOCK = 32, 4096
#: Pairs that a task remembers to have given.
SEEN = 1_000_000
#: A count that stands for any larger one.
FULL = 255


def shingle_sets(column) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each text) per chunk."""
    for first, part in chunks(text_array(column)):
        w = words(part, BLANK)
        grams = runs(w.hashes, SHINGLE)
        sets = []
        for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                sets.append(np.unique(grams[a : b - SHINGLE + 1]))
            else:
                sets.append(runs(w.hashes[a:b], b - a) if b > a else w.hashes[:0])
        yield first, sets


def class_of(shingles: np.ndarray) -> int:
    """One number for a set: equal sets have equal numbers, others differ but for 64-bit collisions."""
    if not len(shingles):
        return 0
    total = mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mixed(np.array([total], np.uint64)).view(np.int64)[0])


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and the task's histogram in pieces at the end."""
    histogram = np.zeros(1 << ORDER_BITS, np.int64)
    names = ["doc_id", "row_text", "n", "class", "point", "piece", "counts"]
    for batch in batches:
        for first, sets in shingle_sets(batch.column("text")):
            some = [s for s in sets if len(s)]
            if some:
                histogram += np.bincount(buckets(np.concatenate(some), ORDER_BITS), minlength=len(histogram))
            points = [
                np.minimum(np.bincount((s & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS), FULL)
                .astype(np.uint8)
                .tobytes()
                for s in sets
            ]
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, n),
                    batch.column("row_text").slice(first, n),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) for s in sets], pa.int64()),
                    pa.array(points, pa.binary()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ],
                names,
            )
    if histogram.any():
        pieces = [zlib.compress(x.tobytes(), 1) for x in np.split(histogram, PIECES)]
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.nulls(PIECES, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())),
                pa.array(range(PIECES), pa.int32()),
                pa.array(pieces, pa.binary()),
            ],
            names,
        )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, counts in zip(*(batch.column(c).to_pylist() for c in ("piece", "counts")), strict=True):
            totals[piece] = totals.get(piece, 0) + np.frombuffer(zlib.decompress(counts), np.int64)
    for piece, counts in totals.items():
        yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()), "counts": [counts.tobytes()]})


def _histogram(points: DataFrame) -> np.ndarray:
    """Tokens per bucket over all documents: 8 MB on the driver, whatever the input."""
    pieces = points.where("piece IS NOT NULL").select("piece", "counts").repartition("piece")
    out = np.zeros((PIECES, (1 << ORDER_BITS) // PIECES), np.int64)
    for row in pieces.mapInArrow(_summed, "piece int, counts binary").collect():
        out[row.piece] = np.frombuffer(row.counts, np.int64)
    return out.ravel()


def _tile_rows(histogram):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = histogram.value
        rank = (64 * np.log2(counts + 1.0)).astype(np.uint64) << np.uint64(48)
        usual = counts.mean()
        tiles = 1 + (np.maximum(counts - 4 * usual - 1000, 0) // TILE).astype(np.int64)
        for batch in batches:
            for _, sets in shingle_sets(batch.column("text")):
                seen, tokens, classes, sizes = set(), [], [], []
                for s in sets:
                    n, of = len(s), class_of(s)
                    if not n or of in seen:
                        continue
                    seen.add(of)
                    first = n + (-n * PERCENT // 100) + 1  # n - ceil(0.75 n) + 1
                    # Equal keys keep the order of the hashes, so that every set is in one order.
                    key = rank[buckets(s, ORDER_BITS)] | (s >> np.uint64(16))
                    tokens.append(s[np.argsort(key, kind="stable")[:first]])
                    classes.append(of)
                    sizes.append(n)
                if not tokens:
                    continue
                lengths = [len(t) for t in tokens]
                token = np.concatenate(tokens)
                of = np.repeat(np.array(classes, np.int64), lengths)
                shares = tiles[buckets(token, ORDER_BITS)]
                salt = np.where(shares > 1, 1 + of % shares, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token.view(np.int64)),
                        pa.array(salt.astype(np.int32)),
                        pa.array(of),
                        pa.array(np.repeat(np.array(sizes, np.int64), lengths)),
                    ],
                    ["token", "salt", "class", "n"],
                )

    return rows


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order: each member of a tile with its leader, and the leaders of dealt-out tiles."""
    names = ["token", "class", "n", "leader", "leader_n"]
    last = None  # token, salt, class, leader, leader_n
    for batch in batches:
        if not batch.num_rows:
            continue
        token, salt, of, n = (batch.column(c).to_numpy() for c in ("token", "salt", "class", "n"))
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])
        again = np.zeros(len(token), bool)
        again[1:] = ~new[1:] & (of[1:] == of[:-1])
        if last is not None and last[:2] == (token[0], salt[0]):
            new[0], again[0] = False, last[2] == of[0]
        head = np.maximum.accumulate(np.where(new, np.arange(len(token)), -1))
        leader = np.where(head < 0, last[3] if last else 0, of[head])
        leader_n = np.where(head < 0, last[4] if last else 0, n[head])
        last = (token[-1], salt[-1], of[-1], leader[-1], leader_n[-1])
        member = ~again & ((leader != of) | (new & (salt > 0)))
        if member.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[member]) for x in (token, of, n, leader, leader_n)], names)


def _pairs_in_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of each tile (rows in order of tile): other components, sizes and bounds that allow a link."""
    tile, rows = None, []
    given: set[tuple[int, int]] = set()

    def flush():
        of, n, component, side = (np.concatenate(x) for x in list(zip(*rows, strict=True))[:4])
        points = np.concatenate([r[4] for r in rows])
        found = {p for a, b in _search(of, n, component, side, points) for p in zip(a.tolist(), b.tolist())} - given
        # Near copies meet in many tiles; most repeats go here, the rest by the distinct that follows.
        if len(given) > SEEN:
            given.clear()
        given.update(found)
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(c).to_numpy() for c in ("token", "low", "high")]
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
        edges = [*np.flatnonzero(new).tolist(), batch.num_rows]
        cols = [batch.column(c).to_numpy() for c in ("class", "n", "component", "side")]
        points = np.frombuffer(b"".join(batch.column("point").to_pylist()), np.uint8).reshape(-1, GROUPS)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            this = tuple(k[a] for k in key)
            if this != tile and rows:
                yield from flush()
                rows = []
            tile = this
            rows.append([*(c[a:b] for c in cols), points[a:b]])
    if rows:
        yield from flush()


def _search(of, n, component, side, points) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    points = np.where(points == FULL, 1 << 20, points.astype(np.int32))
    order = np.lexsort((points[:, 1], points[:, 0], (np.log(n) * 8).astype(np.int64)))
    of, n, component, side, points = (x[order] for x in (of, n, component, side, points))
    starts = np.arange(0, len(of), LEAF)
    most, least_n = np.maximum.reduceat(points, starts), np.minimum.reduceat(n, starts)
    most_n = np.maximum.reduceat(n, starts)
    for i in range(len(of)):
        low, high = -(-n[i] * PERCENT // 100), n[i] * 100 // PERCENT
        leaf = np.flatnonzero((most_n >= low) & (least_n <= high))
        need = PERCENT * (n[i] + np.maximum(least_n[leaf], low))
        leaf = leaf[(100 + PERCENT) * np.minimum(most[leaf], points[i]).sum(axis=1) >= need]
        if not len(leaf):
            continue
        j = (starts[leaf][:, None] + np.arange(LEAF)).ravel()
        j = j[(j < len(of)) & (j > i)]
        j = j[(component[j] != component[i]) & (n[j] >= low) & (n[j] <= high)]
        if side.any():
            j = j[side[j] != side[i]]
        overlap = np.minimum(points[j], points[i]).sum(axis=1)
        j = j[(100 + PERCENT) * overlap >= PERCENT * (n[i] + n[j])]
        if len(j):
            yield np.minimum(of[i], of[j]), np.maximum(of[i], of[j])


def _within_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose summed minima allow a link."""
    for batch in batches:
        x, y = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, GROUPS) for c in ("x", "y")
        )
        low = np.minimum(x, y)
        overlap = np.where(low == FULL, 1 << 20, low.astype(np.int32)).sum(axis=1)
        n = batch.column("n").to_numpy()
        yield batch.select(["a", "b"]).filter(pa.array((100 + PERCENT) * overlap >= PERCENT * n))


def _bounded(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    x = classes.select(F.col("class").alias("a"), F.col("point").alias("x"), F.col("n").alias("m"))
    y = classes.select(F.col("class").alias("b"), F.col("point").alias("y"), F.col("n").alias("k"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", (F.col("m") + F.col("k")).alias("n"))
    return both.mapInArrow(_within_bound, "a long, b long")


def _sets(wanted):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = has(wanted.value, batch.column("probe").to_numpy())
            texts = batch.column("text").filter(pa.array(keep))
            for _, sets in shingle_sets(texts):
                some = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([class_of(s) for s in some], pa.int64()),
                        pa.array([s.tobytes() for s in some], pa.binary()),
                    ],
                    ["class", "shingles"],
                )

    return rows


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets link."""
    spark = docs.sparkSession
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    owners = classes.join(ends, "class", "left_semi").select(F.xxhash64("doc_id").alias("probe"))
    wanted = spark.sparkContext.broadcast(bit_filter(owners, "probe", BITS))
    probed = docs.select("text", F.xxhash64("doc_id").alias("probe"))
    sets = stored(
        probed.mapInArrow(_sets(wanted), "class long, shingles binary")
        .groupBy("class")
        .agg(F.first("shingles").alias("shingles")),
        f"{name}-sets",
    )
    x = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    checked = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verified, "a long, b long")
    links = stored(checked, f"{name}-links")
    discard(sets)
    return links


def _tree_pairs(tiles: DataFrame, classes: DataFrame, joined: DataFrame) -> DataFrame:
    """Candidate pairs from the trees of the tiles that still hold several components."""
    labelled = (
        tiles.select("token", "class", "n")
        .join(joined.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    # Near copies meet in many tiles: of tiles with the same members one is searched.
    mark = F.xxhash64("class").cast("decimal(20,0)")
    other_mark = F.xxhash64(F.lit(1), "class").cast("decimal(20,0)")
    open_tiles = (
        labelled.groupBy("token")
        .agg(
            F.min("component").alias("least"),
            F.max("component").alias("most"),
            F.count(F.lit(1)).alias("k"),
            F.sum(mark).alias("mark"),
            F.sum(other_mark).alias("other_mark"),
        )
        .where("least <> most")
        .groupBy("k", "mark", "other_mark")
        .agg(F.min("token").alias("token"))
        .select("token", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks"))
    )
    blocks = (
        labelled.join(open_tiles, "token")
        .join(classes.select("class", "point"), "class")
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "token",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            # Of two blocks, only pairs across them are sought; of a block with itself, all.
            F.when(F.col("block") == F.col("other"), 0)
            .when(F.col("block") < F.col("other"), 1)
            .otherwise(2)
            .alias("side"),
            "class",
            "n",
            "component",
            "point",
        )
    )
    ordered = blocks.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")
    return ordered.mapInArrow(_pairs_in_trees, "a long, b long").distinct()


def labelled(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id (the largest long if missing), row_text (a hash of the text), n, component.

    ``n`` is the size of the shingle set; a component is one of its classes, null for an empty set.
    """
    text = F.col("text").cast("string")
    docs = docs.select(
        id_or_last(F.col("doc_id")).alias("doc_id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("row_text"),
        text.alias("text"),
    )
    spark = docs.sparkSession
    read = stored(
        docs.mapInArrow(_points, "doc_id long, row_text long, n long, class long, point binary, piece int, counts binary"),
        "points",
    )
    points = read.where("piece IS NULL").select("doc_id", "row_text", "n", "class", "point")
    histogram = spark.sparkContext.broadcast(_histogram(read))
    classes = stored(
        points.where("n > 0").groupBy("class").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("point").alias("point")
        ),
        "classes",
    )
    entries = docs.select("text").mapInArrow(_tile_rows(histogram), "token long, salt int, class long, n long")
    found = stored(
        entries.repartition("token", "salt")
        .sortWithinPartitions("token", "salt", "class")
        .mapInArrow(_members, "token long, class long, n long, leader long, leader_n long"),
        "members",
    )
    # Leaders of dealt-out tiles (rows that lead themselves) meet under the least of them.
    shares = found.where("class = leader").select("token", "class", "n")
    chief = shares.groupBy("token").agg(F.min(F.struct("class", "n")).alias("chief"))
    meetings = shares.join(chief, "token").where("class <> chief.class").select(
        "token", "class", "n", F.col("chief.class").alias("leader"), F.col("chief.n").alias("leader_n")
    )
    members = found.where("class <> leader").union(meetings)
    heads = members.select("token", F.col("leader").alias("class"), F.col("leader_n").alias("n"))
    inside = members.select("token", "class", "n").union(heads).distinct()
    # A hub has most of its coordinates in common with others: of near copies, the one they come from.
    common = inside.groupBy("class").agg((F.count(F.lit(1)) / F.max("n")).alias("hub"))
    tiles = stored(inside.join(common, "class"), "tiles")
    discard(found)
    hubs = tiles.groupBy("token").agg(F.max(F.struct("hub", "class", "n")).alias("top"))
    met = tiles.join(hubs.select("token", F.col("top.class").alias("leader"), F.col("top.n").alias("leader_n")), "token")
    fitting = f"class <> leader AND least(n, leader_n) * 100 >= greatest(n, leader_n) * {PERCENT}"
    stars = met.where(fitting).select(
        F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b")
    )
    first_pairs = stored(stars.distinct(), "stars")
    star_pairs = stored(_bounded(first_pairs, classes), "star-pairs")
    links = _links(docs, classes, star_pairs, "star")
    discard(star_pairs)
    joined = components(links)
    tree_pairs = stored(
        _tree_pairs(tiles, classes, joined).join(first_pairs, ["a", "b"], "left_anti"), "tree-pairs"
    )
    discard(tiles, first_pairs)
    if not tree_pairs.isEmpty():
        links = links.union(_links(docs, classes, tree_pairs, "tree"))
        joined = components(links)
    return points.join(joined.withColumnRenamed("node", "class"), "class", "left").select(
        "doc_id", "row_text", "n", F.when(F.col("n") > 0, F.coalesce("component", "class")).alias("component")
    )


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    Words are runs without white space, A-Z in lower case; a text of fewer than five words is one
    shingle; a null or empty text has none and links with nothing. Rows without doc_id count as the
    largest id, and have component_id null if nothing smaller is reached. Repeated rows are copies. Other
    columns are not read; an empty table gives no rows. Sets are compared by 64-bit hashes of shingles.
    """
    rows = labelled(docs)
    some = rows.where("n > 0")
    least = some.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = some.join(least, "component").select("doc_id", "n", "component_id")
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.union(alone).select(
        id_or_null(F.col("doc_id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        id_or_null(F.col("component_id")).alias("component_id"),
    )


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one row of each component, the one of the smallest doc_id; all columns.

    Rows without words link with nothing and all stay. Of rows that repeat id and text one stays; of rows
    of one id, the one with the least hash of its text.
    """
    rows = labelled(docs)
    first = rows.where("n > 0").groupBy("component").agg(F.min(F.struct("doc_id", "row_text")).alias("row"))
    stay = first.select(F.col("row.doc_id").alias("_row_id"), F.col("row.row_text").alias("_row_text"))
    key = ["_row_id", "_row_text"]
    number = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    keyed = keyed_rows(docs)
    has_words = F.coalesce(F.col("rest.text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = keyed.where(has_words).join(stay, key).withColumn("number", number).where("number = 1")
    # Rows without words need no partner, so they are not shuffled: many may have the same empty text and no id.
    return kept.select("rest.*").union(keyed.where(~has_words).select("rest.*"))
