"""MinHash near-duplicates with odd sketches: banded candidates, parity estimate, exact proof.

A document's set is its distinct runs of `n` words (the whole sequence if it has fewer). Equal
sets form a class with one node, so copies never meet one another. Each set draws `ROWS * BANDS`
MinHash values; nodes that agree on a whole band are candidates. All samples of a set are folded
into an odd sketch, a bitmap in which each (place, value) flips one bit: the bits that differ
between two sketches estimate how many samples differ, precisely so at high similarity. Pairs
that the sketch leaves far below the threshold are dropped without a proof (`SLACK` below it); the
others are proved on their full sets. From the draw of samples and the parity noise together, a
pair of similarity 0.80 has 92.7 differing bits on average with a deviation of 10.2; it is dropped
above 152, with a probability of 7.1e-9 (7e-11 at 0.82). Bands miss 4.6e-7 of pairs at 0.80.

Candidates also have a parity bitmap of the whole set, of 4 to 8 bits a shingle. Each shingle that
only one of two sets has flips one bit, so the bits that differ are never more than these shingles:
with the sizes this is an exact bound, and a pair beyond it is dropped without any loss. Bitmaps
end at `MOST_BITS`; longer sets leave more pairs to the proof.

In a bucket of a band every member is first compared with one centre, in several rounds: after
each, proved links are contracted to components, and the next centre is compared only with
members of other components. What is then left in a bucket, members of components that are not
linked yet, is compared pair by pair, unless their sizes or sketches or, by the triangle inequality,
their distances to the bucket's first centre rule a link out; pairs inside the bucket's largest
component are not formed. So a group of near copies costs a few comparisons per member and no link
between different components is left out.

Null and empty texts and texts without words have an empty set and are linked with nothing.
A class is known by a 64-bit hash of its set and the set's size. Rows without an id take part
through their class and never are the smallest id; a component without any id keeps all its
rows. Equal rows get equal results. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costwatch.llm import bloom
from costwatch.llm.words import mix, word_slices
from costwatch.staging import stage

BANDS, ROWS = 48, 6
SKETCH_BITS = 512
THRESHOLD = 80  # percent
SLACK = 0.2
STAR_ROUNDS = 3
LEAST_BITS, MOST_BITS = 128, 1 << 14  # of a whole set's bitmap
BITS_A_SHINGLE = 4

_SAMPLES = BANDS * ROWS
_SEEDS = mix(np.arange(1, _SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mix(_SEEDS) | np.uint64(1)
_CHUNK = 2048


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, _, words in word_slices(column):
        hashes, first = words.hashes(), words.first
        if len(hashes) >= n:
            runs = hashes[: len(hashes) - n + 1].copy()
            for k in range(1, n):
                runs = mix(runs * np.uint64(3) ^ hashes[k : len(hashes) - n + 1 + k])
        for low, high in zip(first[:-1], first[1:], strict=True):
            if high - low >= n:
                yield np.unique(runs[low : high - n + 1])
            elif high > low:
                whole = hashes[low : low + 1]
                for k in range(low + 1, high):
                    whole = mix(whole * np.uint64(3) ^ hashes[k : k + 1])
                yield whole
            else:
                yield np.empty(0, np.uint64)


def set_key(shingles: np.ndarray) -> int:
    """A hash of the set, the same for every order."""
    total = mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([total]))[0].astype(np.int64))


def minhash(shingles: np.ndarray) -> np.ndarray:
    best = np.full(_SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        part = shingles[None, at : at + _CHUNK]
        np.minimum(best, ((part ^ _SEEDS[:, None]) * _FACTORS[:, None]).min(1), out=best)
    return best


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of (place, value) pairs, as signed 64-bit integers."""
    place = mix(samples + _SEEDS) & np.uint64(SKETCH_BITS - 1)
    odd = (np.bincount(place.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def parity_bitmap(shingles: np.ndarray) -> np.ndarray:
    """Parity bitmap of a whole set, as signed 64-bit integers; its length is a power of two.

    Folding the halves of a bitmap over one another gives the next shorter one.
    """
    bits = LEAST_BITS
    while bits < min(BITS_A_SHINGLE * len(shingles), MOST_BITS):
        bits *= 2
    place = mix(shingles) & np.uint64(bits - 1)
    odd = (np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    grid = samples.reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for r in range(ROWS):
        keys = mix(keys * np.uint64(5) ^ grid[:, r])
    return keys.view(np.int64)


def most_differing_bits(similarity: float) -> int:
    """Sketch bits expected to differ at this similarity of the sets."""
    differing = 2 * _SAMPLES * (1 - similarity)
    return int(np.ceil(SKETCH_BITS / 2 * (1 - np.exp(-2 * differing / SKETCH_BITS))))


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def sketches(documents: DataFrame, n: int) -> DataFrame:
    """doc_id, node, n_shingles, sketch, bands; the last three are empty for an empty set."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for batch in batches:
            nodes, sizes, bits, bands = [], [], [], []
            for shingles in shingle_sets(batch.column(1), n):
                sizes.append(len(shingles))
                nodes.append(set_key(shingles) if len(shingles) else None)
                samples = minhash(shingles) if len(shingles) else None
                bits.append(none if samples is None else odd_sketch(samples))
                bands.append(none if samples is None else band_keys(samples))
            columns = [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*columns, _lists(bits), _lists(bands)],
                ["doc_id", "node", "n_shingles", "sketch", "bands"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, node long, n_shingles long, sketch array<long>, bands array<long>"
    return documents.select("doc_id", "text").mapInArrow(draw, schema)


def full_sets(documents: DataFrame, n: int, wanted) -> DataFrame:
    """node, its whole set and bitmap, for documents whose id passes the Bloom filter `wanted`."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bloom.bits(wanted.value)
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            rows = pa.array(np.flatnonzero(bloom.passes(table, keys)))
            sets = list(shingle_sets(batch.column(1).take(rows), n))
            nodes = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
            bitmaps = _lists([parity_bitmap(s) for s in sets])
            yield pa.RecordBatch.from_arrays([nodes, _lists(sets), bitmaps], ["node", "shingles", "parity"])

    keyed = documents.select(F.xxhash64("doc_id").alias("key"), "text")
    return keyed.mapInArrow(gather, "node long, shingles array<long>, parity array<long>")


def _ordered(a: Column | str, b: Column | str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _differing(x: Column, y: Column) -> Column:
    """Bits that differ between two bitmaps of one length."""
    return F.aggregate(
        F.zip_with(x, y, lambda v, w: F.bit_count(v.bitwiseXOR(w))),
        F.lit(0),
        lambda total, v: total + v.cast("int"),
    )


def _folded(bitmap: Column) -> Column:
    half = (F.size(bitmap) / 2).cast("int")
    return F.zip_with(F.slice(bitmap, F.lit(1), half), F.slice(bitmap, half + 1, half), lambda v, w: v.bitwiseXOR(w))


def _may_link(a: str, b: str) -> Column:
    """Whether sizes, sketches and bitmaps of two sets leave room for the threshold.

    `a` and `b` stand for `{}` in a column's name. Sets of such sizes have bitmaps of one length
    or of twice the other's.
    """
    n_a, n_b = F.col(a.format("n")), F.col(b.format("n"))
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * THRESHOLD
    bits = _differing(F.col(a.format("sketch")), F.col(b.format("sketch")))
    p_a, p_b = F.col(a.format("parity")), F.col(b.format("parity"))
    apart = (
        F.when(F.size(p_a) > F.size(p_b), _differing(_folded(p_a), p_b))
        .when(F.size(p_a) < F.size(p_b), _differing(p_a, _folded(p_b)))
        .otherwise(_differing(p_a, p_b))
    )
    room = apart * (100 + THRESHOLD) <= (n_a + n_b) * (100 - THRESHOLD)
    return sizes & (bits <= most_differing_bits(THRESHOLD / 100 - SLACK)) & room


class _Prover:
    """Turns candidate pairs of nodes into links; sketches and sets of all candidates are written once."""

    def __init__(self, documents: DataFrame, drawn: DataFrame, nodes: DataFrame, n: int):
        info = (
            drawn.join(nodes, "node", "left_semi")
            .groupBy("node")
            .agg(
                F.min("doc_id").alias("doc_id"),
                F.first("n_shingles").alias("n"),
                F.first("sketch").alias("sketch"),
            )
        )
        info = stage(info, "neardup_info")
        # Sets leave the scan only where the id passes; the join by node is exact.
        wanted = bloom.build(info, F.xxhash64("doc_id"))
        sets = (
            full_sets(documents, n, wanted)
            .join(nodes, "node", "left_semi")
            .groupBy("node")
            .agg(F.first("shingles").alias("shingles"), F.first("parity").alias("parity"))
        )
        self.sets = stage(sets, "neardup_sets")
        self.info = stage(info.join(self.sets.select("node", "parity"), "node"), "neardup_facts")

    def shared(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs that may be linked, with the sizes of intersection and union of their sets."""
        left, right = (
            self.info.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("n", "sketch", "parity")])
            for end in "ab"
        )
        likely = (
            pairs.join(left, "a").join(right, "b").filter(_may_link("{}_a", "{}_b")).select("a", "b", "n_a", "n_b")
        )
        likely = stage(likely, f"{name}_likely")
        both = F.size(F.array_intersect("x", "y"))
        proved = (
            likely.join(self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
            .select("a", "b", "n_a", "n_b", both.alias("both"))
        )
        union = F.col("n_a") + F.col("n_b") - F.col("both")
        return stage(proved.select("a", "b", "both", union.alias("union")), f"{name}_proved")


def components(links: DataFrame, roots: DataFrame | None = None, name: str = "links") -> DataFrame:
    """node -> root for all nodes that have a link: contraction to the smallest neighbour.

    Each round every node takes the smallest name among itself and its neighbours; links are
    renamed and those inside a component vanish, until none is left. `roots` is an earlier
    result whose names are taken on. Tables of each round are written, so lineage stays short.
    """
    spark = links.sparkSession
    if roots is None:
        roots = spark.createDataFrame([], "node long, root long")
    ends = F.explode(F.array("a", "b")).alias("node")
    edges = rename(links, roots)
    known = roots.select("node").unionByName(links.select(ends)).distinct()
    total = stage(
        known.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root")),
        f"{name}_roots",
    )
    step = 0
    edges = stage(edges, f"{name}_{step}")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("least"))
        moved = stage(
            nearest.select(F.col("a").alias("node"), F.least("a", "least").alias("root")), f"{name}_moved"
        )
        step += 1
        edges = stage(rename(edges, moved), f"{name}_{step}")
        onward = moved.select(F.col("node").alias("root"), F.col("root").alias("next"))
        total = stage(
            total.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root")),
            f"{name}_roots",
        )
    return total


def rename(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges between the roots of their ends, each once, none inside a component."""
    for end in ("a", "b"):
        table = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
        edges = edges.join(table, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    return edges.filter("a != b").select(*_ordered("a", "b")).distinct()


def _by_root(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _near(d: Column, other: Column) -> Column:
    """Whether two sets at these distances from a third can be linked; unknown distances can.

    The Jaccard distance obeys the triangle inequality.
    """
    apart = F.abs(d - other) <= 1 - THRESHOLD / 100 + 1e-9
    return F.coalesce(apart, F.lit(True))


def node_components(documents: DataFrame, drawn: DataFrame, n: int) -> DataFrame:
    """node -> root for all nodes that are linked with another one."""
    spark = drawn.sparkSession
    banded = drawn.select("node", F.explode("bands").alias("key"))
    pivots = (
        banded.groupBy("key")
        .agg(F.min("node").alias("pivot"), F.max("node").alias("other"))
        .filter("pivot != other")
        .select("key", "pivot")
    )
    members = stage(banded.join(pivots, "key").distinct(), "neardup_buckets")
    prover = _Prover(documents, drawn, members.select("node").distinct(), n)
    pairs = stage(
        members.filter("node != pivot").select(*_ordered("node", "pivot")).distinct(), "neardup_pairs"
    )
    linked = F.col("both") * 100 >= F.col("union") * THRESHOLD
    proved = prover.shared(pairs, "neardup")
    roots = components(proved.filter(linked).select("a", "b"), None, "neardup")
    # The distance of each member to the first centre of its bucket, where the sketch let it pass.
    # Sketches and bitmaps are met by distinct pair, in the proof; a row for each bucket and member
    # carries them in the last round only.
    away = proved.select("a", "b", (1 - F.col("both") / F.col("union")).alias("d"))
    ends = [F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")]
    members = members.select("key", "node", "pivot", *ends).join(away, ["a", "b"], "left")
    members = members.select("key", "node", F.when(F.col("node") == F.col("pivot"), 0.0).otherwise(F.col("d")).alias("d"))
    facts = ("root", "node", "d", "n", "sketch", "parity")
    tried = pairs
    for turn in range(1, STAR_ROUNDS + 1):
        # Buckets that still hold several components, with a centre each.
        placed = _by_root(members.select("key", "node", "d"), roots)
        pick = F.max if turn % 2 else F.min
        open_buckets = (
            placed.groupBy("key")
            .agg(
                F.min("root").alias("low"),
                F.max("root").alias("high"),
                pick(F.struct("root", "node", "d")).alias("centre"),
            )
            .filter("low != high")
            .select("key", "centre")
        )
        members = stage(placed.join(open_buckets, "key"), f"neardup_open_{turn}")
        if members.isEmpty():
            return roots
        if turn < STAR_ROUNDS:
            near = (F.col("root") != F.col("centre.root")) & _near(F.col("d"), F.col("centre.d"))
            pairs = members.filter(near).select(*_ordered(F.col("node"), F.col("centre.node")))
        else:
            # All pairs of components but those of the largest one's members with one another.
            sizes = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
            largest = sizes.groupBy("key").agg(F.max(F.struct("size", "root"))["root"].alias("hub"))
            members = members.join(largest, "key").withColumn("in_hub", F.col("root") == F.col("hub"))
            members = members.join(prover.info.drop("doc_id"), "node")
            one, two = (
                members.select("key", "in_hub", *facts).withColumnsRenamed({c: c + end for c in ("in_hub", *facts)})
                for end in ("_x", "_y")
            )
            once = F.col("in_hub_y") | (F.col("node_x") < F.col("node_y"))
            near = once & (F.col("root_x") != F.col("root_y")) & _near(F.col("d_x"), F.col("d_y"))
            pairs = (
                one.filter("NOT in_hub_x").join(two, "key").filter(near & _may_link("{}_x", "{}_y"))
                .select(*_ordered("node_x", "node_y"))
            )
        pairs = stage(pairs.distinct().join(tried, ["a", "b"], "left_anti"), f"neardup_pairs_{turn}")
        if not pairs.isEmpty():
            tried = tried.unionByName(pairs)
            links = prover.shared(pairs, f"neardup_{turn}").filter(linked).select("a", "b")
            roots = components(links, roots, f"neardup_{turn}")
    return roots


def near_duplicates(documents: DataFrame, n: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of its component) and kept, for every row."""
    drawn = stage(sketches(documents, n), "neardup_sketches")
    roots = node_components(documents, drawn, n)
    rows = _by_root(drawn.select("doc_id", "n_shingles", "node"), roots)
    named = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(named, "root", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def drop_duplicates(documents: DataFrame, n: int = 5) -> DataFrame:
    """`documents` with one row of each component: that of the smallest id.

    Rows are known by id and text: of a repeated id each text goes or stays by its own component.
    Rows equal in id and text count as one. Rows without an id stay if no row of their component
    has one, and go otherwise.
    """
    uid = F.xxhash64("doc_id", "text")
    named = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), uid.alias("uid"))
    found = near_duplicates(documents.select(named.alias("doc_id"), "text"), n)
    kept = found.filter("kept OR component_id.no_id").select(F.col("doc_id.uid").alias("_uid")).distinct()
    # The row travels as one column, so no name of the caller can meet these.
    keyed = documents.select(uid.alias("_uid"), F.col("doc_id").isNull().alias("_no_id"), F.struct("*").alias("_of"))
    left = keyed.join(stage(kept, "neardup_kept"), "_uid", "left_semi")
    once = left.filter("NOT _no_id").dropDuplicates(["_uid"])
    return once.unionByName(left.filter("_no_id")).select("_of.*")
