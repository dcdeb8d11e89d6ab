"""Near-duplicate documents by min-max hashing.

Words lie between white space of the text with A-Z lower-cased; a document's set holds its distinct shingles of K words
(the whole sequence if it has fewer words). Each of PERMUTATIONS hash functions gives the least and the largest value
over the set, two signature values for one evaluation; ROWS of them make a band. Documents that share a band are
candidates; a link is confirmed on the full sets (64-bit shingle hashes): 100 * intersection >= 80 * union.
A pair at the threshold itself misses all bands with probability (1 - 0.8 ** ROWS) ** BANDS = 5e-8.

Null, empty and wordless texts have an empty set and are linked with nothing. Documents of equal sets form a class that
its smallest doc_id stands for; only representatives are compared. Rows of equal doc_id are one document where their texts
are equal, and each gives a row; where they differ, links of any hold for the doc_id. Rows without doc_id take the component
of an equal set, if any, hold none together and have a null kept. The work on a long text grows with its words. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import discard, small, text_of, written

PERMUTATIONS, ROWS = 64, 4
BANDS = 2 * PERMUTATIONS // ROWS
PERCENT = 80
#: Rows of text that a task gets, rows of them and shingles handled at once.
BATCH_ROWS, SLICE_ROWS, PART = 2000, 500, 1 << 15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, those of each text in ascending order, and how many each text has."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = words.flatten().dictionary_encode()
    of_word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    real = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    index = coded.indices.to_numpy()
    offsets = words.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    kept = real[index] if len(index) else np.zeros(0, bool)
    bounds = np.concatenate([[0], np.cumsum(kept)])[offsets]  # without the empty strings at the ends of texts
    hashes = of_word[index[kept]] if len(index) else np.zeros(0, np.uint64)
    rolled = np.zeros(max(len(hashes) - k + 1, 0), np.uint64)
    for j in range(k):
        rolled = rolled * np.uint64(0x100000001B3) + mixed(hashes[j : len(hashes) - k + 1 + j] + np.uint64(j + 1))
    out, sizes = [], np.zeros(len(texts), np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if b > a:
            if b - a >= k:
                found = np.unique(rolled[a : b - k + 1])
            else:
                one = np.zeros(1, np.uint64)
                for j in range(a, b):
                    one = one * np.uint64(0x100000001B3) + mixed(hashes[j : j + 1] + np.uint64(j - a + 101))
                found = one
            out.append(found)
            sizes[i] = len(found)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def functions() -> tuple[np.ndarray, np.ndarray]:
    base = np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)
    return mixed(base * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1), mixed(base + np.uint64(0xA5A5A5A5))


def band_hashes(sets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The signature, a column for each non-empty set, and an array of BANDS hashes for each."""
    factor, shift = functions()
    sizes = sizes[sizes > 0]
    starts = np.cumsum(sizes) - sizes
    signature = np.zeros((2 * PERMUTATIONS, len(sizes)), np.uint64)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(starts + sizes, starts[at] + PART, "right")))
        part = mixed(sets[starts[at] : starts[to - 1] + sizes[to - 1]])
        cuts = starts[at:to] - starts[at]
        value = np.empty_like(part)
        for p in range(PERMUTATIONS):
            np.multiply(part, factor[p], out=value)
            np.add(value, shift[p], out=value)
            signature[p, at:to] = np.minimum.reduceat(value, cuts)
            signature[PERMUTATIONS + p, at:to] = np.maximum.reduceat(value, cuts)
        at = to
    bands = np.zeros((BANDS, len(sizes)), np.uint64)
    for b in range(BANDS):
        bands[b] = np.uint64(b + 1)
        for r in range(ROWS):
            bands[b] = mixed(bands[b] + signature[b + r * BANDS])
    return signature, bands.T


#: A pair goes to the exact check if ESTIMATE of the signature agree: at a similarity of 0.8 fewer do with probability 1e-7.
ESTIMATE = 0.62
#: Shingles that a block of a bucket holds about.
BLOCK_SHINGLES = 1 << 18
#: Rows of a block, and rows of it that are compared at once: very short texts have few shingles.
BLOCK_ROWS, STRIP = 4096, 256
#: Parts that the members of a bucket are dealt into before they learn of their blocks.
SALTS = 32


def documents_with_bands(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, key (of the set), sketch (a byte of each signature value), bands."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                sets, sizes = shingle_sets(part.column("text"), k)
                ends = np.cumsum(sizes)
                keys = [sets[e - n : e] for e, n in zip(ends, sizes, strict=True)]
                keys = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in keys]
                sketch, bands = np.zeros((len(sizes), 2 * PERMUTATIONS), np.uint8), np.zeros((len(sizes), BANDS), np.int64)
                if len(sets):
                    signature, found = band_hashes(sets, sizes)
                    sketch[sizes > 0], bands[sizes > 0] = (signature >> np.uint64(24)).astype(np.uint8).T, found.view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]), pa.int32()), pa.array(bands[sizes > 0].ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes), pa.array(keys, pa.binary()), pa.array([x.tobytes() for x in sketch], pa.binary()), lists], ["doc_id", "n_shingles", "key", "sketch", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, n_shingles long, key binary, sketch binary, bands array<long>")


def shingle_table(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """rep, shingles (ascending 64-bit hashes, as bytes) of the documents whose id is in wanted.rep."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                sets, sizes = shingle_sets(part.column("text"), k)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array([sets[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary())], ["rep", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), text_of().alias("text")).join(small(wanted), "rep", "left_semi")
    return written(texts.mapInArrow(run, "rep long, shingles binary"), "shingles", BATCH_ROWS)


def rows_of(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), np.uint8).reshape(-1, width)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    if PERCENT * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def estimated(pairs: DataFrame) -> DataFrame:
    """The pairs whose sketches agree enough and whose sizes allow a link."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                same = (rows_of(batch.column("sketch"), 2 * PERMUTATIONS) == rows_of(batch.column("leader_sketch"), 2 * PERMUTATIONS)).mean(1)
                yield batch.select(["rep", "leader"]).filter(pa.array(same >= ESTIMATE))

    return pairs.mapInArrow(run, "rep long, leader long")


def confirmed(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """The pairs (rep, leader) whose full sets are alike."""

    def run(batches):
        for batch in batches:
            keep = [alike(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)) for a, b in zip(batch.column("shingles"), batch.column("leader_shingles"), strict=True)]
            yield batch.select(["rep", "leader"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(shingles, "rep").join(shingles.select(F.col("rep").alias("leader"), F.col("shingles").alias("leader_shingles")), "leader")
    return both.select("rep", "leader", "shingles", "leader_shingles").mapInArrow(run, "rep long, leader long")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least reachable node).

    Every edge hangs its higher end on its lower one. A round moves each edge to the least node that its lower end hangs
    on, then all nodes that a node hangs on to the least of them, until every node hangs on one node that hangs on none: a
    chain of n nodes takes about log2(n) rounds, and each round's table replaces the last.
    """

    def least(hung: DataFrame) -> DataFrame:
        return hung.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))

    hung = written(edges.filter("rep <> leader").select(F.greatest("rep", "leader").alias("high"), F.least("rep", "leader").alias("low")).distinct(), "hung")
    while hung.groupBy("high").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count() or hung.join(hung.select(F.col("high").alias("low")), "low", "left_semi").limit(1).count():
        moved = written(hung.join(least(hung), F.col("low") == F.col("node"), "left").select("high", F.coalesce("least", "low").alias("low")).distinct(), "moved")
        lows = moved.join(least(moved), F.col("high") == F.col("node")).filter("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        after = written(least(moved).select(F.col("node").alias("high"), F.col("least").alias("low")).unionAll(lows).distinct(), "hung")
        discard(hung, moved)
        hung = after
    return hung.select(F.col("high").alias("node"), F.col("low").alias("component")).unionAll(hung.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())


def blocks_of(rows: DataFrame) -> DataFrame:
    """rows (bucket, rep, component, n_shingles, ...) of mixed buckets, each once for every pair of blocks that it is in: bucket, first, second, own.

    A component with more than half the rows of a bucket of several blocks has blocks of its own, which are not paired with
    one another, as its members need no comparison: so where few rows stand beside a large component, each is dealt out a
    few times only.
    """
    parts = rows.groupBy("bucket", "component").agg(F.sum("n_shingles").alias("s"), F.count("*").alias("r"))
    whole = parts.groupBy("bucket").agg(F.max(F.struct("r", "component", "s")).alias("major"), F.sum("r").alias("r"), F.sum("s").alias("s"))

    def blocks(r, s):
        return F.greatest(F.ceil(s / BLOCK_SHINGLES), F.ceil(r / BLOCK_ROWS)).cast("int")

    apart = (blocks(F.col("r"), F.col("s")) > 1) & (2 * F.col("major.r") > F.col("r"))
    rest = blocks(F.col("r") - F.when(apart, F.col("major.r")).otherwise(0), F.col("s") - F.when(apart, F.col("major.s")).otherwise(0))
    whole = whole.select("bucket", F.when(apart, F.col("major.component")).alias("major"), rest.alias("minors"), F.when(apart, blocks(F.col("major.r"), F.col("major.s"))).otherwise(0).alias("majors"))
    whole = whole.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.hash("rep"), F.lit(SALTS)))
    placed = salted.join(whole, ["bucket", "salt"]).drop("salt")
    is_major = F.col("component").eqNullSafe(F.col("major"))
    placed = placed.withColumn("own", F.when(is_major, F.col("minors") + F.pmod(F.xxhash64("rep"), F.col("majors")).cast("int")).otherwise(F.pmod(F.xxhash64("rep"), F.col("minors")).cast("int")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(is_major, F.col("minors") - 1).otherwise(F.col("minors") + F.col("majors") - 1))))
    return placed.withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other")).drop("other", "minors", "majors", "major")


def by_group(batches):
    """The rows of each (bucket, first, second) of sorted batches, as a table."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
        if not rows.num_rows:
            continue
        key = np.stack([rows.column(c).to_numpy() for c in ("bucket", "first", "second")])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        bounds = [0, *cuts.tolist()]
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield rows.slice(a, b - a)
        held = rows.slice(bounds[-1])
    if held is not None and held.num_rows:
        yield held


def crossing(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Indices of the rows on the two sides of a pair of blocks, the components of all rows, and whether any pair is of different ones."""
    own, component = group.column("own").to_numpy(), group.column("component").to_numpy()
    first, second = group.column("first")[0].as_py(), group.column("second")[0].as_py()
    a, b = np.flatnonzero(own == first), np.flatnonzero(own == second)
    both = component[np.concatenate([a, b])]
    return a, b, component, bool(len(a) and len(b) and (both != both[0]).any())


def close_members(rows: DataFrame) -> DataFrame:
    """bucket, rep of the members that by their sketches may be linked with a member of another component."""

    def run(batches):
        for group in by_group(batches):
            a, b, component, open_ = crossing(group)
            if not open_:
                continue
            sketch, n, rep = rows_of(group.column("sketch"), 2 * PERMUTATIONS), group.column("n_shingles").to_numpy(), group.column("rep").to_numpy()
            near = np.zeros(len(rep), bool)
            for at in range(0, len(a), STRIP):
                i = a[at : at + STRIP]
                same = np.zeros((len(i), len(b)), np.uint8)
                for c in range(2 * PERMUTATIONS):
                    same += sketch[i, c][:, None] == sketch[b, c][None, :]
                small_, large = np.minimum(n[i][:, None], n[b][None, :]), np.maximum(n[i][:, None], n[b][None, :])
                hit = (component[i][:, None] != component[b][None, :]) & (same >= ESTIMATE * 2 * PERMUTATIONS) & (100 * small_ >= PERCENT * large)
                near[i] |= hit.any(1)
                near[b] |= hit.any(0)
            if near.any():
                kept = group.filter(pa.array(near))
                yield kept.select(["bucket", "rep"]).combine_chunks().to_batches()[0]

    return rows.repartition("bucket", "first", "second").sortWithinPartitions("bucket", "first", "second").select("bucket", "first", "second", "own", "rep", "component", "n_shingles", "sketch").mapInArrow(run, "bucket long, rep long").distinct()


def crossing_links(rows: DataFrame) -> DataFrame:
    """Links between members of different components, enough of them to join all that are linked: a pair for each member and component at most."""

    def run(batches):
        for group in by_group(batches):
            a, b, component, open_ = crossing(group)
            if not open_:
                continue
            rep = group.column("rep").to_numpy()
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("shingles")]
            shared, counts = np.unique(np.concatenate(sets), return_counts=True)
            shared = shared[counts > 1]
            n = np.array([len(x) for x in sets])
            common = [np.searchsorted(shared, x[np.isin(x, shared, assume_unique=True)]) for x in sets]
            both = np.zeros((len(a), len(b)), np.float32)
            for at in range(0, len(shared), 2048):  # columns of the incidence matrix
                left, right = np.zeros((len(a), 2048), np.float32), np.zeros((len(b), 2048), np.float32)
                for side, index in ((left, a), (right, b)):
                    for row, i in enumerate(index):
                        x = common[i]
                        lo, hi = np.searchsorted(x, (at, at + 2048))
                        side[row, x[lo:hi] - at] = 1
                both += left @ right.T
            pair = {}
            for at in range(0, len(a), STRIP):
                i, shares = a[at : at + STRIP], both[at : at + STRIP]
                hit = (component[i][:, None] != component[b][None, :]) & (100 * shares >= PERCENT * (n[i][:, None] + n[b][None, :] - shares))
                x, y = np.nonzero(hit)
                for p, q in zip(i[x].tolist(), b[y].tolist(), strict=True):
                    pair.setdefault((min(component[p], component[q]), max(component[p], component[q])), (rep[p], rep[q]))
            if pair:
                found = np.array(list(pair.values()), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["rep", "leader"])

    return rows.repartition("bucket", "first", "second").sortWithinPartitions("bucket", "first", "second").select("bucket", "first", "second", "own", "rep", "component", "shingles").mapInArrow(run, "rep long, leader long").distinct()


def near_duplicates(docs: DataFrame, *, shingle_words: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id that links reach), kept (it is that one), class_id (least doc_id of the same set).

    Two rounds find the links. First every member of a bucket is compared with the bucket's least one. Where the other
    members of a bucket are then still in different components, those are compared with one another, in blocks; pairs
    inside a component need no comparison, as they cannot change it.
    """
    found = written(documents_with_bands(docs, shingle_words), "bands", BATCH_ROWS)
    classes = found.filter("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("class_id"))
    members = written(found.select("doc_id", "n_shingles", "key").join(classes, "key", "left").select("doc_id", "n_shingles", "key", F.coalesce("class_id", "doc_id").alias("class_id")), "members")
    reps = found.filter("n_shingles > 0").join(members.filter("doc_id = class_id").select("doc_id", "key").distinct(), ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
    reps = written(reps.select(F.col("doc_id").alias("rep"), "n_shingles", "sketch", "bands"), "reps")
    buckets = reps.select("rep", F.explode("bands").alias("bucket"))
    leaders = written(buckets.groupBy("bucket").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).filter("n > 1"), "leaders")
    shared = written(buckets.join(leaders, "bucket").filter("rep <> leader").select("bucket", "rep", "leader", "n"), "buckets")
    sketches = reps.select("rep", "sketch", "n_shingles")
    pairs = shared.select("rep", "leader").distinct().join(sketches, "rep").join(sketches.select(F.col("rep").alias("leader"), F.col("sketch").alias("leader_sketch"), F.col("n_shingles").alias("m")), "leader")
    pairs = written(estimated(pairs.filter(f"100 * least(n_shingles, m) >= {PERCENT} * greatest(n_shingles, m)").select("rep", "leader", "sketch", "leader_sketch")).distinct(), "pairs")
    shingles = shingle_table(docs, pairs.select("rep").unionAll(pairs.select("leader")).distinct(), shingle_words)
    links = written(confirmed(pairs, shingles), "links")
    labels = components(links)

    labelled = written(shared.filter("n > 2").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component")), "labelled")
    mixed = written(labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("bucket"), "mixed")
    # both are plain tables: the join deals out nothing if mixed is small, and Spark splits a hot bucket if it is not
    open_ = written(labelled.join(mixed, "bucket", "left_semi").join(sketches, "rep").select("bucket", "rep", "component", "n_shingles", "sketch"), "open")
    close = written(close_members(blocks_of(open_)).join(open_.select("bucket", "rep", "component", "n_shingles"), ["bucket", "rep"]), "close")
    more = shingle_table(docs, close.select("rep").distinct(), shingle_words)
    late = written(crossing_links(blocks_of(close).join(more, "rep")), "late-links")
    if late.limit(1).count():
        labels = components(links.unionAll(late))
    return (
        members.join(labels.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"), "class_id")
        .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"), "class_id")
    )


def without_copies(docs: DataFrame, *, shingle_words: int = 5) -> DataFrame:
    """One document of each component: that of the least doc_id; all rows without doc_id."""
    gone = written(near_duplicates(docs, shingle_words=shingle_words).filter(~F.col("kept")).select("doc_id").distinct(), "copies")
    return docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
