"""Similarity join on word shingles by chosen paths.

Every text is a set of windows of words, and its sketch is a list of minimum hashes, two
of which agree as often as the sets are similar.  In a run all texts start in one bucket.
A bucket samples coordinates of the sketch and sends each text on to one bucket for each
of them, by the text's value there; the path of choices names the bucket.  So many
coordinates are sampled that a pair at the threshold is expected to stay together in one
bucket.  Small buckets are compared by brute force and larger ones are split again.  Runs
are repeated until the recall that is asked for is reached.

Buckets compare sketches, with a margin.  The pairs they find connect texts to groups, and
inside each group all pairs are verified on the sets themselves.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    BLOCK,
    Forest,
    block_tasks,
    gathered,
    in_blocks,
    map_arrow,
    map_groups,
    named,
    paired_blocks,
    shuffle_width,
    slices,
    stored,
    text_id,
)
from .components import connected_components
from .words import mixed, shingles

#: Coordinates of a sketch.
SKETCH = 64
#: Largest bucket that is compared and not split, while it can be split.
SMALL = 64
#: Splits of a bucket at most; what is then still large holds texts that hardly differ,
#: and is compared in blocks.
DEPTH = 3
#: Standard deviations by which a sketch may understate the similarity of a pair.
MARGIN = 4.0
#: Runs beyond which a recall counts as out of reach.
MOST_RUNS = 1000
#: Bytes of text hashed at once.
STEP_BYTES = 4 << 20

_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, SKETCH, np.uint64) * np.uint64(
    2
) + np.uint64(1)


def least_equal(threshold: float) -> int:
    """Equal coordinates that two sketches need to be reported."""
    least = threshold - MARGIN * math.sqrt(threshold * (1 - threshold) / SKETCH)
    return math.ceil(least * SKETCH)


def loss_of(runs: int, similarity: float, threshold: float, depth: int = DEPTH + 1) -> float:
    """Probability that a pair of this similarity meets in no bucket that reports it.

    All runs share one sketch, so they are independent only when the number of equal
    coordinates is given; that number is binomial.  In each of ``depth`` choices a pair
    goes on together over each equal coordinate that is sampled.
    """
    least = least_equal(threshold)
    sampled = 1 / (threshold * SKETCH)
    lost = 0.0
    for equal in range(SKETCH + 1):
        survives = 1.0
        for _ in range(depth):
            survives = 1 - (1 - sampled * survives) ** equal
        missed = (1 - survives) ** runs if equal >= least else 1.0
        share = similarity**equal * (1 - similarity) ** (SKETCH - equal)
        lost += math.comb(SKETCH, equal) * share * missed
    return lost


def runs_for(recall: float, threshold: float = 0.8) -> int:
    """Runs after which a pair at the threshold is found with this probability.

    The buckets are taken to be split as often as they can be, so the recall does not fall
    as buckets fill.  No number of runs finds pairs whose sketches differ by more than the
    margin; a recall above that is refused.
    """
    runs = 1
    while loss_of(runs, threshold, threshold) > 1 - recall:
        runs += 1
        if runs > MOST_RUNS:
            raise ValueError(f"Sketches of {SKETCH} values cannot reach a recall of {recall}.")
    return runs


def _sketches(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over each set; all ones for an empty set."""
    full = np.diff(bounds) > 0
    out = np.full((len(bounds) - 1, SKETCH), np.iinfo(np.uint32).max, np.uint32)
    if len(values):
        starts = bounds[:-1][full]
        for i, factor in enumerate(_FACTORS):
            out[full, i] = np.minimum.reduceat(values * factor, starts) >> np.uint64(32)
    return out


def _chosen(paths: np.ndarray, threshold: float) -> np.ndarray:
    """Which coordinates each bucket samples: one row per path."""
    draws = mixed(paths[:, None] + np.arange(1, SKETCH + 1, dtype=np.uint64) * _FACTORS[0])
    return draws < np.uint64(int(2.0**64 / (threshold * SKETCH)))


def _children(paths, sketches, threshold):
    """Row numbers and paths of the buckets that rows go to next."""
    row, coordinate = np.nonzero(_chosen(paths, threshold))
    value = sketches[row, coordinate].astype(np.uint64)
    step = mixed(value * np.uint64(SKETCH) + coordinate.astype(np.uint64))
    return row, mixed(paths[row] ^ step)


def _sketch_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, SKETCH)


def near_documents(
    documents: DataFrame,
    threshold: float = 0.8,
    shingle: int = 5,
    recall: float = 0.999,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Links between texts whose sets of shingles have a Jaccard similarity of at least
    ``threshold``.

    One row per input row: the id, ``n_links`` (other rows linked directly),
    ``component_id`` (least id reachable by links, its own included) and ``kept`` (whether
    that is its own id).  Texts with equal sets form a class; they link with each other and
    are compared once.  A text with fewer words than a shingle has all its words as its
    one shingle; null texts and texts without words link with nothing.  A null id sorts
    first, and such rows are told apart by their texts.  Repeated rows link with each
    other like copies.  An empty table gives no rows; other columns are not read.

    Ids may repeat with different texts, so ``row_id`` and ``row_mark``, a hash of the
    text, tell which row is meant.  ``row_group`` numbers the groups of linked rows, also
    those whose least ids are equal; it is null for a text without words.

    ``recall`` is that of a pair exactly at the threshold; pairs that are more similar, or
    are connected through others, are found with a higher probability.
    """
    marked = documents.select(
        text_id(id_column, text_column).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.xxhash64(text_column).alias("mark"),
    )
    base = stored(map_arrow(marked, _summaries(shingle), _SUMMARY), "sketches")
    usable = base.where("size > 0")
    # counts of stored rows are read from the footers
    classes = (
        usable.groupBy("digest")
        .agg(
            F.count("*").alias("copies"),
            F.min(F.struct("id", "mark")).alias("lead"),
            F.first("sketch").alias("sketch"),
            F.first("size").alias("size"),
        )
        .select("*", F.col("lead.id").alias("first"), F.col("lead.mark").alias("lead_mark"))
        .drop("lead")
        .withColumn("class", F.monotonically_increasing_id())
    )
    classes = stored(gathered(classes, base.count()), "classes")
    n_classes = classes.count()
    runs = runs_for(recall, threshold)
    pairs = _candidate_edges(classes, threshold, runs)
    # a class is seldom tied more than once in a run
    groups = connected_components(pairs, runs * n_classes).withColumnRenamed("id", "class")
    members = groups.join(classes.drop("sketch"), "class")
    members = stored(gathered(members, n_classes), "members")
    verified = _verified(marked, members, threshold, shingle)
    verified = stored(gathered(verified, members.count(), BLOCK // 8), "links")
    links = (
        verified.where("other IS NULL").groupBy("class").agg(F.sum("links").alias("links"))
    )
    edges = verified.where("other IS NOT NULL").select(
        F.col("class").alias("a"), F.col("other").alias("b")
    )
    component = connected_components(edges, verified.count())
    component = stored(
        gathered(component.withColumnRenamed("id", "class"), n_classes), "components"
    )
    least = (
        component.join(members.select("class", "first"), "class")
        .groupBy("component")
        .agg(F.min("first").alias("least"))
    )
    linked = component.join(least, "component").join(links, "class")
    linked = linked.select("class", "links", "least", "component")
    found = classes.join(linked, "class", "left").select(
        "digest",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("least", "first").alias("component_id"),
        F.coalesce("component", "class").alias("group"),
    )
    result = usable.select("id", "mark", "digest").join(found, "digest")
    alone = base.where("size = 0").select(
        "id",
        "mark",
        F.lit(0).cast("bigint").alias("n_links"),
        F.col("id").alias("component_id"),
        F.lit(None).cast("bigint").alias("group"),
    )
    return (
        result.select("id", "mark", "n_links", "component_id", "group")
        .union(alone)
        .select(
            "id",
            named("id").alias("name"),
            "n_links",
            named("component_id").alias("component_id"),
            (F.col("id") == F.col("component_id")).alias("kept"),
            F.col("mark").alias("row_mark"),
            F.col("group").alias("row_group"),
        )
        .withColumnRenamed("name", id_column)
        .withColumnRenamed("id", "row_id")
    )


_SUMMARY = "id bigint, mark bigint, digest binary, size bigint, sketch binary"


def _summaries(shingle: int):
    """Digest, size and sketch of the set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, STEP_BYTES):
                values, bounds = shingles(batch.column(1), shingle)
                sketches = _sketches(values, bounds)
                digests = [
                    hashlib.blake2b(values[a:b], digest_size=16).digest()
                    for a, b in zip(bounds[:-1], bounds[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array(digests, pa.binary()),
                        pa.array(np.diff(bounds)),
                        pa.array([s.tobytes() for s in sketches], pa.binary()),
                    ],
                    ["id", "mark", "digest", "size", "sketch"],
                )

    return run


def _candidate_edges(classes: DataFrame, threshold: float, runs: int) -> DataFrame:
    """Edges that connect the classes whose sketches agree in some bucket."""
    sketches = classes.select("class", "sketch")

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = mixed(np.arange(1, runs + 1, dtype=np.uint64))
        for batch in batches:
            number = batch.column(0).to_numpy()
            matrix = _sketch_matrix(batch.column(1))
            for root in roots:
                row, path = _children(
                    np.full(len(number), root, np.uint64), matrix, threshold
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[row]), pa.array(path.view(np.int64))],
                    ["class", "path"],
                )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("paths")
            owner = np.repeat(np.arange(batch.num_rows), paths.value_lengths().to_numpy())
            row, path = _children(
                paths.flatten().to_numpy().view(np.uint64),
                _sketch_matrix(batch.column("sketch"))[owner],
                threshold,
            )
            number = batch.column("class").to_numpy()[owner[row]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), pa.array(path.view(np.int64))], ["class", "path"]
            )

    def sketched(rows: DataFrame, buckets: str) -> DataFrame:
        """Each class once, with its buckets and its sketch.

        A class is in few buckets: about 1.25 in each run, times as many for each split.
        """
        lists = rows.groupBy("class").agg(F.collect_list(buckets).alias("paths"))
        return lists.join(sketches, "class")

    fields = "class bigint, path bigint"
    held = stored(map_arrow(sketches, start, fields), "paths")
    finished = []
    for depth in range(DEPTH + 1):
        sizes = held.groupBy("path").count().where("count > 1")
        small = sizes.where(F.col("count") <= SMALL).select("path")
        finished.append(held.join(small, "path"))
        large = held.join(sizes.where(F.col("count") > SMALL).select("path"), "path")
        if depth == DEPTH:
            break
        held = stored(
            map_arrow(sketched(large, "path"), split, fields), "paths"
        )
    leaves = finished[0]
    for more in finished[1:]:
        leaves = leaves.union(more)
    # the same few texts meet in many small buckets, which are compared once
    lists = leaves.groupBy("path").agg(F.sort_array(F.collect_list("class")).alias("all"))
    small = (
        lists.select("all", F.xxhash64("all").alias("bucket"))
        .distinct()
        .select("bucket", F.explode("all").alias("class"))
    )
    small = (
        sketched(small, "bucket")
        .select("class", "sketch", F.explode("paths").alias("bucket"))
        .withColumn("_i", F.lit(0))
        .withColumn("_j", F.lit(0))
        .withColumn("_own", F.lit(0))
    )
    large = sketched(large, "path").select(
        "class", "sketch", F.explode("paths").alias("bucket")
    )
    large = paired_blocks(large, "bucket", "class")
    needed = least_equal(threshold)

    def compare(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = np.append(starts[1:], rows.num_rows)
        number = rows["class"].to_numpy()
        matrix = _sketch_matrix(rows["sketch"])
        a, b = [], []
        for begin, end in zip(starts.tolist(), ends.tolist()):
            roots = _connected(matrix[begin:end], needed)
            (moved,) = np.nonzero(roots != np.arange(len(roots)))
            a.append(number[begin + moved])
            b.append(number[begin + roots[moved]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"]
        )

    columns = ["class", "bucket", "sketch", "_own", "_i", "_j"]
    found = map_groups(
        small.select(*columns).union(large.select(*columns)),
        ["bucket", "_i", "_j"],
        compare,
        "a bigint, b bigint",
        shuffle_width(classes.sparkSession),
    )
    return found.where("a <> b").distinct()


def _connected(sketches: np.ndarray, needed: int) -> np.ndarray:
    """For each sketch the first one that it is connected with by agreeing pairs.

    A row is compared only with rows that it is not connected with yet.
    """
    label = np.arange(len(sketches))
    for x in range(len(sketches) - 1):
        rest = np.nonzero(label[x + 1 :] != label[x])[0] + x + 1
        agree = (sketches[rest] == sketches[x]).sum(axis=1)
        for other in np.unique(label[rest[agree >= needed]]).tolist():
            label[label == other] = label[x]
    _, first, group = np.unique(label, return_index=True, return_inverse=True)
    return first[group]


def _verified(
    rows: DataFrame, members: DataFrame, threshold: float, shingle: int
) -> DataFrame:
    """Exact links: ``class, links`` in each task, and edges ``class, other``.

    Members learn their blocks before their sets are made, so that the sets are shuffled
    once.  The join to the texts always sorts: a broadcast could only serve small inputs.
    Of rows with the id and the text of a member, which come one after the other, the
    first brings the set.
    """
    of_member = in_blocks(members, "component", "class", "size").select(
        F.col("first").alias("id"),
        F.col("lead_mark").alias("mark"),
        "class",
        "component",
        "copies",
        "digest",
        "_blocks",
        "_own",
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for whole in batches:
            number = whole.column("class").to_numpy()
            fresh = np.ones(len(number), bool)
            fresh[1:] = number[1:] != number[:-1]
            if len(number):
                fresh[0] = number[0] != last
                last = number[-1]
            whole = whole.filter(pa.array(fresh))
            for batch in slices(whole, 0, STEP_BYTES):
                values, bounds = shingles(batch.column(0), shingle)
                parts = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                digests = [hashlib.blake2b(p, digest_size=16).digest() for p in parts]
                # a row whose hash is that of a member may hold another text
                same = pa.compute.equal(
                    pa.array(digests, pa.binary()), batch.column("digest")
                )
                kept = ["class", "component", "copies", "_blocks", "_own"]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(n) for n in kept],
                        pa.array([p.tobytes() for p in parts], pa.binary()),
                    ],
                    [*kept, "set"],
                ).filter(same)

    keys = ["id", "mark"]
    texts = rows.hint("merge").join(of_member, keys).drop(*keys)
    filled = map_arrow(
        texts,
        sets,
        "class bigint, component bigint, copies bigint, _blocks int, _own int, set binary",
    )
    dealt = block_tasks(filled)

    def verify(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ends = np.append(starts[1:], table.num_rows)
        number, copies = table["class"].to_numpy(), table["copies"].to_numpy()
        own = table["_own"].to_numpy()
        links = np.zeros(len(number), np.int64)
        a, b = [], []
        for begin, end in zip(starts.tolist(), ends.tolist()):
            # a set can come from several tasks if its rows were divided
            _, firsts = np.unique(number[begin:end], return_index=True)
            firsts.sort()
            part = table["set"].slice(begin, end - begin).take(pa.array(firsts))
            crossed = table["_i"][begin].as_py() != table["_j"][begin].as_py()
            x, y = _similar([np.frombuffer(s, np.uint64) for s in part.to_pylist()], threshold)
            x, y = firsts[x], firsts[y]
            if crossed:
                block = own[begin:end]
                across = block[x] != block[y]
                x, y = x[across], y[across]
            np.add.at(links, begin + x, copies[begin + y])
            np.add.at(links, begin + y, copies[begin + x])
            forest = Forest(end - begin)
            forest.join(x, y)
            roots = forest.roots()
            (moved,) = np.nonzero(roots != np.arange(len(roots)))
            a.append(number[begin + moved])
            b.append(number[begin + roots[moved]])
        a, b = np.concatenate(a), np.concatenate(b)
        none = pa.nulls(len(number), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(number), none, pa.array(links)], ["class", "other", "links"]
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())],
            ["class", "other", "links"],
        )

    return map_groups(
        dealt,
        ["component", "_i", "_j"],
        verify,
        "class bigint, other bigint, links bigint",
        shuffle_width(members.sparkSession),
    )


#: Columns of the matrix of sets that are multiplied at once.
WIDTH = 4096


def _similar(sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``x < y`` of sets that reach the threshold.

    Sizes of all intersections come from products of a matrix of sets and shingles, a
    few shingles at a time; shingles of one set only are left out.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, shingle, count = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    shared = count[shingle] > 1
    owner, shingle = owner[shared], (np.cumsum(count > 1) - 1)[shingle[shared]]
    order = np.argsort(shingle, kind="stable")
    owner, shingle = owner[order], shingle[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    columns = int(shingle[-1]) + 1 if len(shingle) else 0
    for first in range(0, columns, WIDTH):
        low, high = np.searchsorted(shingle, [first, first + WIDTH])
        part = np.zeros((len(sets), min(WIDTH, columns - first)), np.float32)
        part[owner[low:high], shingle[low:high] - first] = 1
        common += part @ part.T
    x, y = np.nonzero(np.triu(common >= (threshold * sizes[:, None] - 0.5).clip(0.5), 1))
    both = np.rint(common[x, y]).astype(np.int64)
    right = both / (sizes[x] + sizes[y] - both) >= threshold
    return x[right], y[right]
