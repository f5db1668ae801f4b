"""Jaccard join of documents over their word shingles, as a blocked sparse matrix product.

Think of the incidence matrix of documents by shingles: the product with its own transpose holds the size of every
intersection. Only entries that can reach the threshold are formed:

1. Documents with one shingle set are one class, and one row of the matrix.
2. Columns are ordered from rare to common by a sketch of how many documents hold them. Two rows that link share a
   column among the first n - ceil(0.75 n) + 1 of each, so the product runs over these leading columns alone.
3. A short column, with up to SHORT rows, gives its pairs of rows, whose shared columns are added up. A pair goes on
   only if its sizes allow the threshold and the columns counted so far, with all that may be left, reach the overlap
   the sizes ask for. The rows of a long column form a tile with those of other long columns that have the same central
   row, and each is paired with that row.
4. Rows are folded to about a bit a column. Folds that differ in more bits than two linked sets can differ in columns
   discard a pair. Of the rest, one pair of each row is confirmed on whole sets, with the tile's center where there is one,
   then those whose rows are not connected by that.
5. Within a tile, rows of one component of these links need no product with each other. Rows that are not of its center's are
   multiplied with every row of the tile, in pairs of blocks of bounded size: first on folds, and what remains on whole
   sets. A pair of blocks hands on the links that connect its rows, never all pairs.
6. The components of all links are taken.

Steps 2 to 5 discard only pairs that cannot link or are connected already, and two rows that share a leading column meet in
step 3 or 5, so no link between different components is lost.

Defined cases: a null text counts as empty; a document without words has an empty set and links with nothing; one
with fewer words than a shingle has its whole sequence as its one shingle; a text of any length is read whole; rows with
null or repeated ids are rows like others, and a component's id is the least id that isn't null among its rows; rows that
tie or repeat are of one class. An empty table gives an empty result. Other columns, whatever their names, are not read by
jaccard_components() and pass through keep_one_of_each().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import common
from tidewright.llm.common import batch_rows, checked, drop_staged, fresh, join_by_key, numbered, stage, without_rows
from tidewright.llm.components import components
from tidewright.llm.shingles import fold_of, halved, parts_of, set_digests, shingle_sets

#: Link where 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
_SKETCH_BITS = 19
_SKETCH_COLUMNS = 32  # counts in a row
#: Rows up to which a column gives pairs; longer ones are multiplied in blocks.
SHORT = 32
#: Columns whose bucket stands 2**HOT_RANK above chance or more count as long without being counted in one place.
HOT_RANK = 11
_BLOCK_COLUMNS, _BLOCK_ROWS, _STAR_ROWS = 200_000, 1000, 500  # columns that are multiplied and rows in a block, about
_COLUMNS_AT_ONCE = 1024
_TEXTS, _LISTS = 1000, 128  # rows in a batch of texts and in one of whole sets
_BITMAP_BITS = 25  # of the filter of wanted sets where their ids are too many to broadcast


def _sketch(docs: DataFrame) -> np.ndarray:
    """For each of a fixed number of shingle buckets, how far its count stands above chance, as a small rank. A set that
    one task meets again counts once there."""

    def count(batches):
        counts, seen = np.zeros(1 << _SKETCH_BITS, np.int64), set()
        for batch in batches:
            for _, _, data, offsets in parts_of(batch.column(0)):
                sets, at = shingle_sets(data, offsets)
                new = np.ones(len(at) - 1, bool)
                for i, d in enumerate(set_digests(sets, at)[0].tolist()):
                    new[i] = d not in seen
                    seen.add(d)
                counts += np.bincount((sets[np.repeat(new, np.diff(at))] >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64), minlength=len(counts))
        if counts.any():
            wide = counts.reshape(-1, _SKETCH_COLUMNS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(wide), dtype=np.int32)), *[pa.array(c) for c in wide.T]], names=["part", *names])

    names = [f"c{i}" for i in range(_SKETCH_COLUMNS)]
    found = docs.mapInArrow(count, ", ".join(["part int", *[f"{c} long" for c in names]])).groupBy("part").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    counts = np.zeros(((1 << _SKETCH_BITS) // _SKETCH_COLUMNS, _SKETCH_COLUMNS))
    counts[np.asarray(found.column("part"))] = np.stack([np.asarray(found.column(c)) for c in names], axis=1)
    counts = counts.ravel()
    mean = counts.mean()
    return np.minimum(np.log2(1 + np.maximum(0, counts - mean - 6 * np.sqrt(mean) - 8)), 62).astype(np.uint8)


def _digested(docs: DataFrame, rank: np.ndarray) -> DataFrame:
    """docs (id, text) -> id, n, d1, d2, lead, fold: the set's size, its digests, its leading columns in order, and its size and
    fold; the last two are null where the task has met the set before."""

    def digest(batches):
        seen = set()
        for batch in batches:
            for a, b, data, offsets in parts_of(batch.column(1)):
                sets, at = shingle_sets(data, offsets)
                d1, d2 = set_digests(sets, at)
                n = np.diff(at)
                known = n == 0
                for i, d in enumerate(zip(d1.tolist(), d2.tolist(), strict=True)):
                    known[i] |= d in seen
                    seen.add(d)
                columns = (sets >> np.uint64(8) | rank[(sets >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)).view(np.int64)
                folds = [None] * (b - a)
                for i in np.flatnonzero(~known).tolist():
                    folds[i] = int(n[i]).to_bytes(8, "little") + fold_of(sets[at[i] : at[i + 1]])
                    columns[at[i] : at[i + 1]].sort()
                size = np.where(known, 0, n - (THRESHOLD * n + 99) // 100 + 1)
                ends = np.concatenate([[0], np.cumsum(size)])
                leading = columns[np.arange(ends[-1]) + np.repeat(at[:-1] - ends[:-1], size)]
                lead = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(leading), mask=pa.array(known))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n), pa.array(d1), pa.array(d2), lead, pa.array(folds, pa.binary())], names=["id", "n", "d1", "d2", "lead", "fold"])

    return docs.mapInArrow(digest, T.StructType([docs.schema["id"], *T._parse_datatype_string("n long, d1 long, d2 long, lead array<long>, fold binary").fields]))


def _cells(nodes: DataFrame) -> DataFrame:
    """(column, node, n, long) of the leading columns that more than one row may have. The rows of a column are counted in one
    place but for hot ones, which are dealt out and long whatever their count."""
    every = nodes.select(F.explode("lead").alias("column"), "node", "n")
    hot = F.shiftright("column", 56) >= HOT_RANK
    spread = F.when(hot, F.pmod(F.xxhash64("node"), F.lit(1024))).otherwise(0)
    counted = every.withColumn("rows", F.count(F.lit(1)).over(Window.partitionBy("column", spread)))
    return counted.filter(hot | (F.col("rows") > 1)).select("column", "node", "n", (hot | (F.col("rows") > SHORT)).alias("long"))


def _fits(n: str, m: str) -> str:
    return f"100 * least({n}, {m}) >= {THRESHOLD} * greatest({n}, {m})"


def _short_pairs(cells: DataFrame) -> DataFrame:
    """Pairs (a, b) of rows that share short columns and can reach the threshold. Long columns count as shared."""
    long = cells.groupBy("node").agg(F.count_if("long").alias("long"))
    short = cells.filter("not long").select("column", "node", "n")
    left, right = short.withColumnsRenamed({"node": "a", "n": "n_a"}), short.withColumnsRenamed({"node": "b", "n": "n_b"})
    met = left.join(right, "column").filter(f"a < b and {_fits('n_a', 'n_b')}")
    counted = met.groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("both"))
    for x in "ab":
        counted = counted.join(long.withColumnsRenamed({"node": x, "long": f"long_{x}"}), x)
    rest = lambda n: f"((({THRESHOLD} * {n} + 99) div 100) - 1)"  # noqa: E731  columns past the leading ones
    most = f"both + least(long_a, long_b) + greatest({rest('n_a')}, {rest('n_b')})"
    return counted.filter(f"{100 + THRESHOLD} * ({most}) >= {THRESHOLD} * (n_a + n_b)").select("a", "b")


def _tiles(cells: DataFrame) -> DataFrame:
    """(tile, node, n): rows of long columns, by the row of each column that shares most of its own."""
    central = cells.groupBy("node").agg((F.count(F.lit(1)) / F.any_value("n")).alias("shared"))
    long = cells.filter("long").join(central, "node")
    heart = stage(long.groupBy("column").agg(F.max(F.struct("shared", "node"))["node"].alias("tile")), "hearts")
    return long.join(checked(heart), "column").select("tile", "node", "n").distinct()


def _stars(pairs: DataFrame) -> DataFrame:
    """Pairs (center, node) -> center, part, node: the rows of a center in parts of a bounded size, each with the center itself."""
    parts = stage(pairs.groupBy("center").agg(F.ceil(F.count(F.lit(1)) / _STAR_ROWS).cast("int").alias("parts")), "parts")
    large = stage(parts.filter("parts > 1"), "large")
    cut = pairs.join(checked(large), "center", "left").select("center", F.coalesce(F.pmod(F.xxhash64("node"), "parts"), F.lit(0)).cast("int").alias("part"), "node")
    hearts = parts.select("center", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("center").alias("node"))
    return hearts.unionByName(cut)


def _against_center(passes):
    """For mapInArrow over rows (center, part, node, list) in order of center and part, the center's own first: the (center, node)
    whose list passes against the center's. One center is held at a time."""

    def hold(batches):
        center = heart = None
        for batch in batches:
            centers, nodes = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            keep = np.zeros(len(nodes), bool)
            lists = batch.column(3)
            own = np.flatnonzero(nodes == centers)
            for s, e in zip([0, *own.tolist()], [*own.tolist(), len(nodes)], strict=True):
                if s < e:
                    if nodes[s] == centers[s]:
                        center, heart, s = centers[s], lists.slice(s, 1), s + 1
                    if s < e and center is not None:
                        keep[s:e] = passes(heart, lists.slice(s, e - s)) & (centers[s:e] == center)
            yield pa.RecordBatch.from_arrays([pa.array(centers[keep]), pa.array(nodes[keep])], names=["center", "node"])

    return hold


def _held(stars: DataFrame, column: str, passes) -> DataFrame:
    """(center, node) of the stars (center, part, node, column) that pass against their centers."""
    rows = stars.select("center", "part", "node", column).repartition("center", "part").sortWithinPartitions("center", "part", F.col("node") != F.col("center"))
    return rows.mapInArrow(_against_center(passes), "center long, node long")


def _apart(n_a, n_b, differ):
    """Whether sets of these sizes that differ in so many columns cannot link."""
    return (100 + THRESHOLD) * differ > (100 - THRESHOLD) * (n_a + n_b)


def _sized(folds) -> list[tuple[int, np.ndarray]]:
    """Each fold's set size, which it carries in its first 8 bytes, and its bytes."""
    return [(int.from_bytes(f[:8], "little"), np.frombuffer(f, np.uint8, -1, 8)) for f in folds.to_pylist()]


def _folds_pass(heart, folds) -> np.ndarray:
    ((n, mine),) = _sized(heart)
    out = np.zeros(len(folds), bool)
    for i, (m, other) in enumerate(_sized(folds)):
        a, b = mine, other
        while len(a) > len(b):
            a = halved(a)
        while len(b) > len(a):
            b = halved(b)
        out[i] = 100 * min(n, m) >= THRESHOLD * max(n, m) and not _apart(n, m, int(np.bitwise_count(a ^ b).sum()))
    return out


def _sets_pass(heart, sets) -> np.ndarray:
    """Which sets link with the heart: one row of the product, over the heart's columns."""
    row = np.asarray(heart.flatten()).view(np.uint64)
    ends = np.concatenate([[0], np.cumsum(np.asarray(sets.value_lengths()))])
    block = np.asarray(sets.flatten()).view(np.uint64)
    sums = np.concatenate([[0], np.cumsum(row[np.minimum(np.searchsorted(row, block), len(row) - 1)] == block)])
    both = np.diff(sums[ends])
    return 100 * both >= THRESHOLD * (len(row) + np.diff(ends) - both)


def _bitmap(digests: DataFrame) -> np.ndarray:
    """A bit for each d1, in a fixed number of bits."""

    def bits(batches):
        found = np.zeros(1 << (_BITMAP_BITS - 6), np.uint64)
        for batch in batches:
            at = np.asarray(batch.column(0)).view(np.uint64) & np.uint64((1 << _BITMAP_BITS) - 1)
            np.bitwise_or.at(found, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        (some,) = found.nonzero()
        for a in range(0, len(some), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(some[a : a + (1 << 16)]), pa.array(found[some[a : a + (1 << 16)]].view(np.int64))], names=["cell", "bits"])

    cells = digests.mapInArrow(bits, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (_BITMAP_BITS - 6), np.uint64)
    out[np.asarray(cells.column("cell"))] = np.asarray(cells.column("bits")).view(np.uint64)
    return out


def _with_sets(docs: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """rows (node and others) with grams, the set's hashes in ascending order. Only texts of the wanted ids are read, or, if those
    are too many to broadcast, only sets whose digest is in a bitmap are handed on: texts are never shuffled."""
    keys = [c for c in rows.columns if c != "node"]
    members = stage(rows.join(nodes.select("node", "id", "d1", "d2"), "node"), "members")
    ids = stage(members.select(F.col("id").alias("wanted_id")).distinct(), "ids")
    wanted = None
    if ids.count() <= common.MOST_BROADCAST:
        docs = docs.join(F.broadcast(ids), docs["id"].eqNullSafe(ids["wanted_id"]), "left_semi")
    else:
        wanted = _bitmap(members.select("d1"))

    def sets_of(batches):
        seen = set()
        for batch in batches:
            for _, _, data, offsets in parts_of(batch.column(0)):
                sets, at = shingle_sets(data, offsets)
                d1, d2 = set_digests(sets, at)
                new = np.diff(at) > 0
                if wanted is not None:
                    bit = d1.view(np.uint64) & np.uint64((1 << _BITMAP_BITS) - 1)
                    new &= (wanted[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
                for i in np.flatnonzero(new).tolist():
                    new[i] = (d1[i], d2[i]) not in seen
                    seen.add((d1[i], d2[i]))
                grams = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(d1), pa.array(d2), grams], names=["d1", "d2", "grams"]).filter(pa.array(new))

    found = docs.select("text").mapInArrow(sets_of, "d1 long, d2 long, grams array<long>")
    return found.join(checked(members.drop("id")), ["d1", "d2"]).select(*keys, "node", "grams")


def _unlinked_blocks(tiles: DataFrame, columns: str, most_columns: int) -> DataFrame:
    """tiles (tile, node, n, label, alone) -> tile, i, j, node and the rest: the rows of a tile once for each pair of blocks that their own block is
    in. Blocks of rows that stand alone meet every block; the others meet those alone. columns: how many of a row are used."""
    blocks = lambda which: F.ceil(F.greatest(F.sum(F.when(which, F.expr(columns)).otherwise(0)) / most_columns, F.count_if(which) / _BLOCK_ROWS)).cast("int")
    sizes = stage(tiles.groupBy("tile").agg(blocks(F.col("alone")).alias("u"), blocks(~F.col("alone")).alias("l"), F.count(F.lit(1)).alias("rows")).filter("u > 0 and rows > 1").drop("rows"), "sizes")
    cut = tiles.join(checked(sizes), "tile").withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("alone"), F.col("u")).otherwise(F.col("l"))).cast("int"))
    dealt = cut.withColumn("k", F.explode(F.sequence(F.lit(0), F.when(F.col("alone"), F.col("u") + F.col("l") - 1).otherwise(F.col("u") - 1))))
    within = F.col("alone") & (F.col("k") < F.col("u"))
    i = F.when(within, F.least("own", "k")).when(F.col("alone"), F.col("own")).otherwise(F.col("k"))
    j = F.when(within, F.greatest("own", "k")).when(F.col("alone"), F.col("k")).otherwise(F.col("u") + F.col("own"))
    return dealt.select("tile", i.alias("i"), j.alias("j"), "node", "n", "label", "alone")


def _in_reach(key, rows):
    """Of the rows (node, label, fold) of a pair of blocks of a tile those that can link with one of another label."""
    sized = _sized(rows.column("fold"))
    n, width = np.array([m for m, _ in sized]), np.array([len(f) for _, f in sized])
    label = np.asarray(rows.column("label"))
    some = np.zeros(len(n), bool)
    for w in np.unique(width):
        same = own = np.flatnonzero(width == w)
        folds = np.stack([sized[i][1] for i in same])
        wider = np.flatnonzero(width == 2 * w)  # sizes that can link are less than twice apart
        if len(wider):
            same = np.concatenate([same, wider])
            folds = np.concatenate([folds, halved(np.stack([sized[i][1] for i in wider]))])
        words = np.ascontiguousarray(folds).view(np.uint64)
        for k in range(len(own)):
            i, rest = same[k], same[k + 1 :]
            differ = np.bitwise_count(words[k + 1 :] ^ words[k]).sum(axis=1, dtype=np.int64)
            fits = ~_apart(n[i], n[rest], differ) & (100 * np.minimum(n[i], n[rest]) >= THRESHOLD * np.maximum(n[i], n[rest])) & (label[i] != label[rest])
            some[rest[fits]] = True
            some[i] |= fits.any()
    return rows.select(["tile", "node", "n", "label", "alone"]).filter(pa.array(some))


def _product(lists: list[np.ndarray]) -> np.ndarray:
    """How many values each pair of lists of distinct values shares: the product of their incidence matrix with its
    transpose, over the columns that more than one list has, some at a time."""
    k = len(lists)
    owner = np.repeat(np.arange(k), [len(x) for x in lists])
    _, column, rows_in = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = rows_in[column] > 1
    column, owner = (np.cumsum(rows_in > 1) - 1)[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((k, k), np.float32)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS_AT_ONCE):
        lo, hi = np.searchsorted(column, [a, a + _COLUMNS_AT_ONCE])
        block = np.zeros((k, _COLUMNS_AT_ONCE), np.float32)
        block[owner[lo:hi], column[lo:hi] - a] = 1
        both += block @ block.T
    return both


def _lists(column) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values, at = np.asarray(column.values), np.asarray(column.offsets)
    return [values[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _multiply(key, rows):
    """The links that connect the rows (node, grams) of a pair of blocks: each component's rows with its least."""
    nodes, lists = np.asarray(rows.column("node")), _lists(rows.column("grams"))
    n = np.array([len(x) for x in lists])
    linked = (100 + THRESHOLD) * _product(lists) >= THRESHOLD * (n[:, None] + n[None, :])
    least = np.arange(len(nodes))
    while True:
        new = np.array([least[row].min() if row.any() else i for i, row in enumerate(linked)])
        new = np.minimum(least, new)[np.minimum(least, new)]
        if (new == least).all():
            break
        least = new
    some = least != np.arange(len(nodes))
    return pa.table({"u": pa.array(nodes[some]), "v": pa.array(nodes[least[some]])})


def _links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (u, v) with the same components as all links between nodes (node, id, n, d1, d2, lead, fold)."""
    spark = docs.sparkSession
    cells = stage(_cells(nodes), "cells")
    tiles = stage(_tiles(cells), "tiles")
    met = _short_pairs(cells).select(F.col("a").alias("center"), F.col("b").alias("node"), F.lit(True).alias("short"))
    met = stage(met.unionByName(tiles.filter("tile <> node").select(F.col("tile").alias("center"), "node", F.lit(False).alias("short"))), "pairs")
    drop_staged(cells)
    folds = nodes.select("node", "fold")
    near = stage(_held(_stars(met.select("center", "node").distinct()).join(folds, "node"), "fold", _folds_pass), "near")
    # one pair of each row first, with a tile's center if there is one
    first = near.join(met, ["center", "node"]).groupBy("node").agg(F.min(F.struct("short", "center"))["center"].alias("center"))
    first = stage(first.select("center", "node"), "first")
    drop_staged(met)
    with batch_rows(spark, _LISTS):
        linked = stage(_held(_with_sets(docs, nodes, _stars(first)), "grams", _sets_pass), "linked")
        up = stage(linked.join(linked.select(F.col("center").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("center"), F.col("center").alias("top")), "up")
        label = linked.join(checked(up), "center", "left").select("node", F.coalesce("top", "center").alias("label"))
        rest = near.join(first, ["center", "node"], "left_anti")
        for x in ("center", "node"):
            rest = rest.join(label.withColumnsRenamed({"node": x, "label": f"{x}_label"}), x, "left")
        rest = stage(rest.filter(F.coalesce("center_label", "center") != F.coalesce("node_label", "node")).select("center", "node"), "rest")
        further = stage(_held(_with_sets(docs, nodes, _stars(rest)), "grams", _sets_pass), "linked")
        known = stage(components(linked.unionByName(further).toDF("u", "v")), "known")
        tops = stage(known.join(tiles.select(F.col("tile").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("tile"), F.col("root").alias("top")), "tops")
        told = tiles.join(known, "node", "left").join(checked(tops), "tile", "left").withColumn("label", F.coalesce("root", "node"))
        told = stage(told.select("tile", "node", "n", "label", (F.col("label") != F.coalesce("top", "tile")).alias("alone")), "told")
        dealt = _unlinked_blocks(told, "n", 8 * _BLOCK_COLUMNS).join(folds, "node")
        reach = stage(dealt.groupBy("tile", "i", "j").applyInArrow(_in_reach, "tile long, node long, n long, label long, alone boolean").distinct(), "reach")
        blocks = _with_sets(docs, nodes, _unlinked_blocks(reach, "n", _BLOCK_COLUMNS).select("tile", "i", "j", "node"))
        connected = stage(blocks.groupBy("tile", "i", "j").applyInArrow(_multiply, "u long, v long").distinct(), "links")
    for done in (tiles, near, first, linked, up, rest, further, tops, told, reach):
        drop_staged(done)
    return known.toDF("u", "v").unionByName(connected)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_shingles, component_id."""
    rows = _members(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")))
    names = fresh([id_col], "n_shingles", "component_id")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias(names[0]), F.col("component_id").alias(names[1]))


def _members(docs: DataFrame) -> DataFrame:
    """docs (id, text) -> id, n, row, root, component_id; root is equal for the rows of one component."""
    with batch_rows(docs.sparkSession, _TEXTS):
        rank = _sketch(docs.select("text"))
        rows = stage(_digested(docs, rank).withColumn("row", F.monotonically_increasing_id()), "rows")
    some = rows.filter("n > 0")
    classes = stage(some.groupBy("d1", "d2").agg(F.min(F.when(F.col("lead").isNotNull(), F.col("row"))).alias("node")), "classes")
    told = stage(join_by_key(some.select("id", "n", "row", "d1", "d2"), classes, ["d1", "d2"]), "members")
    led = rows.filter("lead is not null")
    nodes = without_rows(led, "row", told.filter("row <> node").select("row")).withColumn("node", F.col("row"))
    roots = components(_links(docs, nodes))
    rooted = told.select("id", "n", "row", "node").join(roots, "node", "left").select("id", "n", "row", F.coalesce("root", "node").alias("root"))
    rooted = stage(rooted.unionByName(rows.filter("n = 0").select("id", "n", "row", F.col("row").alias("root"))), "rooted")
    least = stage(rooted.groupBy("root").agg(F.min("id").alias("component_id")), "least-ids")
    for done in (rows, classes, told):
        drop_staged(done)
    return join_by_key(rooted, least, ["root"])


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that stand for their component: one row of each, with its least id (null
    ids count as largest), of those the first by a hash of all columns. A row without words stays."""
    rows, row = numbered(docs, "numbered")
    plain = [F.col(c) for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    key = F.struct(F.col(id_col).isNull().alias("without"), F.col(id_col).alias("own"), F.xxhash64(*plain).alias("tie"), F.col(row).alias("row"))
    members = _members(rows.select(key.alias("id"), F.col(text_col).cast("string").alias("text")))
    return without_rows(rows, row, members.filter("id.row != component_id.row").select("id.row")).select(*docs.columns)
