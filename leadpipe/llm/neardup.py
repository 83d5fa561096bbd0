"""Near-duplicates by DartMinHash over weighted word shingles.

A text is the weighted set of its five-word shingles, the weight being how often
each occurs.  Darts are points of a fixed random process over elements, weights
and ranks: whether a dart falls, where and into which of the k coordinates is
hashed from the element alone.  A text throws the darts of its elements up to
the weight it gives them, and keeps the earliest, that is of the lowest rank,
per coordinate.  Two texts then agree in a coordinate with the probability of
their weighted Jaccard similarity.  Bands of coordinates bring candidates
together, and an exact comparison of the shingles decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadpipe.llm import words as W
from leadpipe.operators.relational import same_key
from leadpipe.session import remove, scratch_path

SHINGLE = 5
SIMILARITY = 0.8
# A pair of similarity 0.8 shares a band with a probability of 0.998.
BANDS = 16
ROWS = 5
COORDINATES = BANDS * ROWS
# Darts expected per text; an empty coordinate then has a probability of 1/(k e^2).
DARTS = int(COORDINATES * np.log(COORDINATES) + 2 * COORDINATES)
FILES_PER_CORE = 4
# Eight bytes each: 32 MB.
MAX_BROADCAST_ROWS = 4_000_000


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, W.Runs]:
    """Sorted shingle hashes of each text, end to end, the index of each text's first, the words.

    Words are runs of letters, marks and digits in lower case, and single letters in
    scripts without blanks; a text of fewer than five words has one shingle, of all
    its words.
    """
    data, at = W.buffers(pa.compute.utf8_lower(texts))
    found = W.Runs(data, at)
    hashes = W.windows(found.hash, SHINGLE)
    inside = W.whole(found.first, len(hashes), SHINGLE)
    owner = found.owner
    short = np.flatnonzero((found.count > 0) & (found.count < SHINGLE))
    few = np.array([_combined(found.hash[found.first[i] : found.first[i + 1]]) for i in short], np.uint64)
    owners = np.concatenate([owner[: len(hashes)][inside], short])
    values = np.concatenate([hashes[inside], few])
    order = np.argsort(owners, kind="stable")
    owners, values = owners[order], values[order]
    first = np.searchsorted(owners, np.arange(len(at)))
    for a, b in zip(first[:-1], first[1:], strict=True):
        values[a:b].sort()
    return values, first, found


def _combined(hashes: np.ndarray) -> np.uint64:
    factors = W.stream(4, len(hashes))
    return W.mix(np.array([(hashes * factors).sum()], np.uint64))[0]


def contents(found: W.Runs) -> list[bytes]:
    """128 bits that stand for the sequence of words of each text."""
    place = np.arange(len(found.hash)) - np.repeat(found.first[:-1], found.count)
    halves = []
    for seed in (5, 6):
        scale = W.mix(place.astype(np.uint64) * np.uint64(2) + W.stream(seed, 1)[0]) | np.uint64(1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(found.hash * scale, dtype=np.uint64)])
        halves.append(W.mix(total[found.first[1:]] - total[found.first[:-1]] + found.count.astype(np.uint64)))
    return [a.tobytes() + b.tobytes() for a, b in zip(*halves, strict=True)]


def signatures(elements: np.ndarray, weights: np.ndarray, first: np.ndarray, k: int = COORDINATES, darts: int = DARTS) -> np.ndarray:
    """The k earliest darts of each weighted set, as 64-bit names; 0 for an empty set.

    `elements` are the distinct hashes of all sets, end to end, `weights` their
    positive weights, `first` the index of each set's first element.  The region
    of an element is cut into cells of unit weight.  In a cell darts follow each
    other by exponential gaps of rank, each with a coordinate and a weight at
    which it lands, and counts if that weight is within the region.  Ranks are
    thrown up to a limit that suits the set's total weight, and further for the
    sets that still have an empty coordinate.
    """
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    cells = np.ceil(weights).astype(np.int64)
    cell_owner = np.repeat(owner, cells)
    level = np.arange(len(cell_owner)) - np.repeat(np.cumsum(cells) - cells, cells)
    room = np.repeat(weights, cells) - level  # of the cell's unit of weight, how much the region has
    name = W.mix(np.repeat(elements, cells) + W.mix(level.astype(np.uint64) + np.uint64(11)))
    total = np.bincount(owner, weights, n)
    limit = np.where(total > 0, darts / np.maximum(total, 1e-300), 0.0)
    rank = np.zeros(len(name))
    thrown = np.zeros(len(name), np.uint64)
    best_rank = np.full(n * k, np.inf)
    best = np.zeros(n * k, np.uint64)
    rank += _gap(name, thrown)
    open_sets = total > 0
    while open_sets.any():
        active = np.flatnonzero(open_sets[cell_owner] & (rank < limit[cell_owner]))
        while len(active):
            dart = W.mix(name[active] + (thrown[active] * np.uint64(2) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
            lands = (dart >> np.uint64(11)).astype(np.float64) / 2.0**53 < room[active]
            place = cell_owner[active] * k + (W.mix(dart) % np.uint64(k)).astype(np.int64)
            _keep_earliest(best_rank, best, place[lands], rank[active][lands], dart[lands])
            thrown[active] += np.uint64(1)
            rank[active] += _gap(name[active], thrown[active])
            active = active[rank[active] < limit[cell_owner[active]]]
        open_sets = (total > 0) & np.isinf(best_rank.reshape(n, k)).any(axis=1)
        limit = np.where(open_sets, limit * 2, limit)
    return best.reshape(n, k)


def _gap(name: np.ndarray, thrown: np.ndarray) -> np.ndarray:
    bits = W.mix(name ^ W.mix(thrown * np.uint64(2) + np.uint64(7)))
    return -np.log1p(-((bits >> np.uint64(11)).astype(np.float64) / 2.0**53))


def _keep_earliest(best_rank, best, place, rank, dart) -> None:
    order = np.lexsort((dart, rank, place))
    place, rank, dart = place[order], rank[order], dart[order]
    head = np.ones(len(place), bool)
    head[1:] = place[1:] != place[:-1]
    place, rank, dart = place[head], rank[head], dart[head]
    earlier = rank < best_rank[place]
    best_rank[place[earlier]] = rank[earlier]
    best[place[earlier]] = dart[earlier]


def weighted(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of each sorted set, their counts, and the index of each set's first."""
    head = np.ones(len(values), bool)
    head[1:] = values[1:] != values[:-1]
    head[first[:-1][first[:-1] < len(values)]] = True
    at = np.flatnonzero(head)
    counts = np.diff(np.append(at, len(values)))
    return values[at], counts.astype(np.float64), np.searchsorted(at, first)


def _sign(texts: pa.Array) -> list:
    values, first, found = shingles(texts)
    elements, weights, begin = weighted(values, first)
    drawn = signatures(elements, weights, begin).reshape(len(texts), BANDS, ROWS)
    bands = np.zeros((len(texts), BANDS), np.uint64)
    for i, factor in enumerate(W.stream(8, ROWS)):
        bands += drawn[:, :, i] * factor
    bands = W.mix(bands + W.stream(9, BANDS)[None, :]).view(np.int64)
    some = found.count > 0
    keys = contents(found)
    return [
        pa.array([k if s else None for k, s in zip(keys, some, strict=True)], pa.binary()),
        pa.array([list(b) if s else [] for b, s in zip(bands, some, strict=True)], pa.list_(pa.int64())),
        np.diff(first).astype(np.int64),
    ]


def _key(texts: pa.Array) -> list:
    data, at = W.buffers(pa.compute.utf8_lower(texts))
    found = W.Runs(data, at)
    return [pa.array([k if n else None for k, n in zip(contents(found), found.count, strict=True)], pa.binary())]


def _numbered(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Names of sorted hashes that tell the repeats of one in a text apart, so weights count as members."""
    place = np.arange(len(values))
    head = np.ones(len(values), bool)
    head[1:] = values[1:] != values[:-1]
    head[first[:-1][first[:-1] < len(values)]] = True
    nth = place - np.maximum.accumulate(np.where(head, place, 0))
    return W.mix(values + nth.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def _sets(texts: pa.Array) -> list:
    values, first, found = shingles(texts)
    values = _numbered(values, first)
    lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64), pa.int64()))
    return [pa.array(contents(found), pa.binary()), lists]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets of numbered shingles."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


Save = Callable[..., DataFrame]


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Save]:
    """A function that makes rows a table in the shared folder: computed once, without lineage.

    A narrow one, of names alone, is written by a few tasks per core, as its
    rounds would else leave more files than rows.  At the end of the block all
    tables are deleted, but for those to be kept; what reads them must have run by then.
    """
    paths = []

    def save(df: DataFrame, name: str, narrow: bool = False, keep: bool = False) -> DataFrame:
        path = scratch_path(spark, name)
        if not keep:
            paths.append(path)
        if narrow:
            df = df.coalesce(FILES_PER_CORE * spark.sparkContext.defaultParallelism)
        df.write.parquet(path)
        return spark.read.parquet(path)

    try:
        yield save
    finally:
        for path in paths:
            remove(spark, path)


def _close(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs `a`, `b` whose shingles are similar enough, compared exactly."""
    left = sets.select(F.col("content").alias("a_"), F.col("hashes").alias("x"))
    right = sets.select(F.col("content").alias("b_"), F.col("hashes").alias("y"))
    both = (
        pairs.join(right, same_key(F.col("b"), F.col("b_")))
        .select("a", "b", "y")
        .join(left, same_key(F.col("a"), F.col("a_")))
        .select("a", "b", "x", "y")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            close = [jaccard(x[i].values.to_numpy(), y[i].values.to_numpy()) >= similarity for i in range(len(x))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]
            ).filter(pa.array(close, pa.bool_()))

    W.bound_batches(pairs.sparkSession)
    return both.mapInArrow(compare, "a binary, b binary")


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _may_be(a: str, b: str, similarity: float) -> Column:
    """Sets whose sizes differ by more cannot be as similar."""
    return F.least(a, b) >= similarity * F.greatest(a, b)


def _first_pairs(met: DataFrame, similarity: float) -> DataFrame:
    """Each member of a band and the member that meets the most others in all of its bands."""
    degree = met.groupBy(F.col("node").alias("node_")).agg(F.sum("n").alias("degree"))
    ranked = met.join(degree, F.col("node") == F.col("node_")).select("band", "node", "size", "degree")
    lead = ranked.groupBy(F.col("band").alias("led")).agg(
        F.max_by(F.struct("node", "size"), F.struct("degree", "node")).alias("lead")
    )
    lead = lead.select("led", F.col("lead.node").alias("lead"), F.col("lead.size").alias("lead_size"))
    near = _may_be("size", "lead_size", similarity) & (F.col("node") != F.col("lead"))
    return _pairs(met.join(lead, same_key(F.col("band"), F.col("led")) & near), "node", "lead")


def _rooted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with the class of their node, itself where it has no link."""
    known = labels.select(F.col("node").alias("node_"), "root")
    return rows.join(known, same_key(F.col("node"), F.col("node_")), "left").select(
        *rows.columns, F.coalesce("root", "node").alias("root")
    )


def _outsiders(met: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes and classes of the members that are not in the largest class of one of their bands.

    Bands become one row per class before they are looked at, and those of one class are no
    more; of the others their largest class is joined, to pass by its members.
    """
    now = _rooted(met.select("band", "node"), labels)
    classes = now.groupBy("band", "root").agg(F.count("*").alias("members"))
    lead = classes.groupBy(F.col("band").alias("led")).agg(
        F.max_by("root", F.struct("members", "root")).alias("lead"), F.count("*").alias("classes")
    )
    lead = lead.where("classes > 1").select("led", "lead")
    outside = same_key(F.col("band"), F.col("led")) & (F.col("root") != F.col("lead"))
    return now.join(lead, outside).select("node", "root").distinct()


def _rare_first(sets: DataFrame, similarity: float) -> DataFrame:
    """The rarest shingles of each set that can be the first it shares with a similar one, as
    `node` and `token`, with their place `at` in the order of all and the `size` of the set.

    The order is by how many sets have a shingle, and then by its hash.  Shingles
    that no other set has come first and are left out.  A shingle is there once
    in a set, so no partition has more rows than there are sets, or shingles in one.
    """
    each = sets.select(F.col("content").alias("node"), F.size("hashes").alias("size"), F.explode("hashes").alias("token"))
    shared = each.withColumn("n", F.count("*").over(Window.partitionBy("token"))).where("n > 1")
    own = Window.partitionBy("node")
    placed = shared.select(
        "node",
        "token",
        "size",
        (F.col("size") - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "token")) - 1).alias("at"),
    )
    return placed.where(F.col("at") <= F.floor(F.col("size") * (1 - similarity) + 1e-6))


def _few(df: DataFrame, rows: int) -> DataFrame:
    """The rows, to be broadcast if they are few; else the join shuffles them."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _left_pairs(outsiders: DataFrame, labels: DataFrame, sets: DataFrame, similarity: float, save: Save) -> DataFrame:
    """All pairs of an outsider and a set of another class that may be similar.

    Similar sets share enough for the first shingle they share, in an order of
    all shingles, to have as many after it in both.  So pairs come from equal
    shingles near the begin of that order, where the rare ones are; what
    thousands have in common is met only in sets that have little else.  Of all
    other sets, only those of the outsiders' rare shingles that are near the
    begin there too are kept.
    """
    rare = save(_rare_first(sets, similarity), "rare")
    apart = _few(outsiders.select(F.col("node").alias("outsider"), "root"), MAX_BROADCAST_ROWS // 8)
    own = rare.join(apart, same_key(F.col("node"), F.col("outsider"))).select("token", "at", "size", "node", "root")
    wanted = save(own.select(F.col("token").alias("wanted")).distinct(), "wanted", narrow=True)
    every = rare.join(_few(wanted, MAX_BROADCAST_ROWS), same_key(F.col("token"), F.col("wanted")), "left_semi")
    others = _rooted(every, labels).select(
        F.col("token").alias("token_"), F.col("at").alias("at_"), F.col("size").alias("size_"),
        F.col("node").alias("other"), F.col("root").alias("root_"),
    )
    shared = similarity / (1 + similarity) * (F.col("size") + F.col("size_")) - 1e-6
    first = F.least(F.col("size") - F.col("at"), F.col("size_") - F.col("at_")) >= shared
    meet = same_key(F.col("token"), F.col("token_")) & (F.col("root") != F.col("root_"))
    return _pairs(others.join(own, meet & first & _may_be("size", "size_", similarity)), "node", "other")


def links(docs: DataFrame, signed: DataFrame, save: Save, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Enough pairs `a`, `b` of similar contents to connect all that the bands bring together.

    Members of a band are never paired all with all.  First each one meets the
    member with the most neighbours, and the links make classes.  Then the
    members outside a band's largest class meet all sets of other classes that
    may be similar, found by their rare shingles, see `_left_pairs`; of two
    similar members of different classes one is always outside.  Pairs whose
    sizes rule the similarity out are left out, all others are compared exactly.
    Only texts that share a band are read again; their ids are broadcast if
    few, else joined.
    """
    nodes = signed.where("content IS NOT NULL").groupBy(F.col("content").alias("node")).agg(
        F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("size").alias("size")
    )
    each = nodes.select("node", "id", "size", F.explode("bands").alias("band"))
    shared = each.groupBy(F.col("band").alias("shared")).agg(F.count("*").alias("n")).where("n > 1")
    met = each.join(shared, same_key(F.col("band"), F.col("shared"))).select("band", "node", "size", "id", "n")
    met = save(met, "bands")
    ids = save(met.select("id").distinct(), "ids", narrow=True)
    again = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(_few(ids, MAX_BROADCAST_ROWS), "id", "left_semi")
    sets = W.map_texts(again, _sets, "content binary, hashes array<long>", [], "text")
    sets = save(sets.groupBy("content").agg(F.first("hashes").alias("hashes")), "sets")
    found = save(_close(_first_pairs(met, similarity), sets, similarity), "links", narrow=True)
    labels = components(found, save)
    outsiders = save(_outsiders(met, labels), "outsiders", narrow=True)
    if outsiders.isEmpty():
        return found
    left = save(_left_pairs(outsiders, labels, sets, similarity, save), "left", narrow=True)
    return found.union(save(_close(left, sets, similarity), "links", narrow=True))


def components(edges: DataFrame, save: Save, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest node of each node's connected component, as `node`, `root`.

    Labels go to the neighbours and then to the labels' own labels until none
    changes, so the number of rounds is about the logarithm of the longest path.
    Each round is a table in the shared folder; a node of many edges is spread
    by partial aggregation and by splitting its partition.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(b, a)).distinct()
    both = save(both, "edges", narrow=True)
    labels = save(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("root")), "roots", narrow=True)
    while True:
        near = (
            both.join(labels, same_key(F.col("v"), F.col("node")))
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        up = labels.select(F.col("node").alias("up"), F.col("root").alias("top"))
        step = lower.join(up, same_key(F.col("next"), F.col("up")), "left").select(
            "node", F.least("next", "top").alias("root"), (F.least("next", "top") != F.col("root")).alias("moved")
        )
        step = save(step, "roots", narrow=True)
        labels = step.select("node", "root")
        if step.where("moved").isEmpty():
            return labels


def _sign_all(plain: DataFrame, save: Save, keep: bool = False) -> DataFrame:
    signed = W.map_texts(plain, _sign, "content binary, bands array<long>, size long", ["id"], "text")
    return save(signed, "signed", keep=keep)


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: `id`, `content`, `class_id` and `n_links`.

    The class id is the smallest document id of the class, a class being what
    links of similar contents connect; documents of equal words have the same
    content.  `n_links` counts the links of the content that connect the class.  A
    text without words, null among them, is a class of its own with a null
    content.  Repeated rows stay repeated and share a class; rows without an id
    take the class of their content, without one a null class.  An id column
    called like a result keeps its name, and the result gets an underscore.  The
    rows come from two tables in the shared folder, of a row per document and per linked content.
    """
    plain = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    with scratch_tables(docs.sparkSession) as save:
        signed = _sign_all(plain, save)
        edges = links(plain, signed, save, "id", "text", similarity)
        roots = components(edges, save).withColumnRenamed("node", "content_")
        degree = edges.select(F.explode(F.array("a", "b")).alias("linked")).groupBy("linked").agg(F.count("*").alias("links"))
        known = roots.join(degree, F.col("content_") == F.col("linked")).select("content_", "root", "links")
        known = save(known, "classes", narrow=True, keep=True)
        signed = save(signed.select("id", "content"), "contents", keep=True)
    rows = signed.join(known, same_key(F.col("content"), F.col("content_")), "left")
    rows = rows.select("id", "content", F.coalesce("root", "content").alias("root"), F.coalesce("links", F.lit(0)).alias("n_links"))
    least = rows.where("root IS NOT NULL").groupBy(F.col("root").alias("root_")).agg(F.min("id").alias("least"))
    content, class_id, n_links = (W.fresh(n, [id]) for n in ("content", "class_id", "n_links"))
    return rows.join(least, same_key(F.col("root"), F.col("root_")), "left").select(
        F.col("id").alias(id),
        F.col("content").alias(content),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias(class_id),
        F.col("n_links").cast("long").alias(n_links),
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The document of the smallest id of each class, all columns as they are.

    Rows without an id stay only where their class has none with one.  Of rows
    of the same id and words one stays; documents without words stay, once each.
    Documents are shuffled once, and map tasks send one of each content.  The
    rows that go are a table in the shared folder.
    """
    plain = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    with scratch_tables(docs.sparkSession) as save:
        signed = _sign_all(plain, save)
        roots = components(links(plain, signed, save, "id", "text", similarity), save)
        least = signed.groupBy("content").agg(F.min("id").alias("least"))
        members = roots.join(least, F.col("node") == F.col("content")).select("node", "root", "least")
        order = F.struct(F.col("least").isNull().alias("none"), "least", "node")
        keepers = members.groupBy(F.col("root").alias("root_")).agg(F.min_by("node", order).alias("keeper"))
        dropped = members.join(keepers, same_key(F.col("root"), F.col("root_"))).where("node <> keeper")
        dropped = save(dropped.select("node"), "dropped", narrow=True, keep=True)
    key, nth, gone = (W.fresh(n, docs.columns) for n in ("_content", "_nth", "_gone"))
    keyed = W.map_texts(docs, _key, f"{key} binary", docs.columns, text)
    alone = F.unhex(F.sha2(F.to_json(F.struct(F.col(id).alias("id"), F.col(text).alias("text"))), 256))
    # The rank filter lets map tasks send one row of each content.
    order = Window.partitionBy(key).orderBy(F.col(id).asc_nulls_last(), F.col(text))
    first = keyed.withColumn(key, F.coalesce(key, alone)).withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1)
    goes = dropped.select(F.col("node").alias(gone))
    # One row of each content is left, where the rank put it, so no text moves again.
    return first.join(_few(goes, MAX_BROADCAST_ROWS // 4), F.col(key) == F.col(gone), "left_anti").select(*docs.columns)
