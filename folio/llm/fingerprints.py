"""Document fingerprints by winnowing, in DataFrame expressions only.

A text is a sequence of words between white space. Every K consecutive words have a rolling (cyclic polynomial) hash:
the words' hashes rotated by their distance from the last one and combined by exclusive or. A column expression has no
state to roll; the same values are made from hashes of 1, 2, 4 ... words, each used by all grams that have it. Of each
WINDOW consecutive hashes the smallest is kept, the rightmost of equal ones, with its position. So two texts that share
K + WINDOW - 1 consecutive words share a fingerprint. Texts of fewer than K words give one hash of all their words; a null
text counts as empty, and a text without words has an empty fingerprint. Two empty fingerprints are alike by 1, an empty
and another by 0. Rows without doc_id come first; rows of the same doc_id follow one another in the order of a hash of
their texts. The work on a long text grows with its words. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.llm.common import discard, let, text_of, written

#: Words in a gram; hashes in a window (a power of two).
K, WINDOW = 5, 8
#: A packed hash is a long: 60 bits of hash above PLACE_BITS that count down from WINDOW - 1 with the place in a window,
#: so that the least long is the least hash, rightmost among equals.
PLACE_BITS = WINDOW.bit_length() - 1
#: Consecutive rows that meet in one group to find each document's successor, at least; groups at most (about).
BLOCK_ROWS, MAX_BLOCKS = 256, 1 << 16
FIRST_ID = -(1 << 63)


def rotated(x: Column, by: int) -> Column:
    return F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, 64 - by))


def rolling(words: Column, k: int, then=lambda x: x) -> Column:
    """At each place then of the rolling hash of k words, where so many follow."""

    def joined(a: Column, b: Column, n: int, m: int, done=lambda x: x) -> Column:
        """From the hashes of n and of m words those of n + m."""
        return F.transform(a, lambda x, i: done(rotated(x, m).bitwiseXOR(F.get(b, i + n))))

    def longer(h: Column, n: int) -> Column:
        if 2 * n <= k:
            return joined(h, h, n, n, then) if 2 * n == k else let(joined(h, h, n, n), lambda x: longer(x, 2 * n))
        return let(rolling(words, k - n), lambda rest: joined(h, rest, n, k - n, then))

    return F.transform(words, then) if k == 1 else longer(words, 1)


def grams(words: Column, k: int = K) -> Column:
    """array<long>: the packed hashes of all k-grams; of fewer words, which 0 follows, one."""

    def packed(x: Column) -> Column:
        return F.shiftleft(F.shiftrightunsigned(F.xxhash64(x), 1 + PLACE_BITS), PLACE_BITS) + F.lit(WINDOW - 1)

    def of(h: Column) -> Column:
        padded = F.when(F.size(h) < k, F.concat(h, F.array_repeat(F.lit(0).cast("long"), k - 1))).otherwise(h)
        n = F.when(F.size(h) > 0, F.greatest(F.size(h) - k + 1, F.lit(1))).otherwise(0)
        return F.slice(let(padded, lambda w: rolling(w, k, packed)), F.lit(1), n)

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def winnow(hashes: Column, window: int = WINDOW) -> Column:
    """array<struct<hash, position>>: the least of each window, found by minima over 2, 4, ... neighbours."""

    def step(g: Column, reach: int) -> Column:
        least = lambda x, i: F.least(x, F.get(g, i + reach) - reach)
        if 2 * reach < window:
            return let(F.transform(g, least), lambda m: step(m, 2 * reach))
        return F.slice(F.transform(g, least), F.lit(1), F.greatest(F.size(g) - window + 1, F.lit(1)))

    def kept(m: Column) -> Column:
        """A window whose least hash is that of the window before holds it one place further left, which counts one more."""

        def one(x, i):
            new = x != F.get(m, F.greatest(i - 1, F.lit(0))) + 1
            return F.when(new, F.struct(F.shiftright(x, PLACE_BITS).alias("hash"), (i + (WINDOW - 1) - x.bitwiseAND(F.lit(WINDOW - 1)).cast("int")).alias("position")))

        return F.filter(F.transform(m, one), lambda x: x.isNotNull())

    return let(let(hashes, lambda g: step(g, 1)), kept)


def fingerprint(text: Column) -> Column:
    """array<struct<hash, position>> of a text, in order of position."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return winnow(grams(words))


def hashes_of(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda x: x["hash"]))


def printed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat(F.hex(x["hash"]), F.lit("@"), x["position"].cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Of two sets of hashes: the size of the intersection over that of the union."""
    both = F.size(F.array_intersect(a, b))
    return let(both, lambda n: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(n / (F.size(a) + F.size(b) - n)))


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """doc_id, hash, position: the fingerprints of every document, a row each."""
    return docs.select("doc_id", F.explode(fingerprint(text_of())).alias("x")).select("doc_id", "x.hash", F.col("x.position").cast("long").alias("position"))


def block_starts(keys: DataFrame) -> list[tuple[int, int]]:
    """The (id, h) at which blocks of consecutive rows begin, in order: one for BLOCK_ROWS rows, or fewer where these would be more than MAX_BLOCKS."""
    size = max(BLOCK_ROWS, -(-keys.count() // MAX_BLOCKS))
    rank = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # in the partition
    found = written(keys.repartitionByRange("id", "h").sortWithinPartitions("id", "h").withColumn("rank", rank).filter(F.col("rank") % size == 0).select("id", "h").distinct(), "blocks")
    starts = sorted((r.id, r.h) for r in found.collect())
    discard(found)
    return starts


def with_successors(docs: DataFrame) -> DataFrame:
    """doc_id, text, h, and the block, turn that put each document before its successor.

    The first document of a block also goes to the block before it (that of the first block to the last one), with turn 1.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(FIRST_ID)).alias("id"), F.xxhash64("text").alias("h"))
    starts = block_starts(docs.select("id", "h")) or [(FIRST_ID, 0)]
    ids, hs = (F.split(F.lit(",".join(map(str, x))), ",").cast("array<long>") for x in zip(*starts, strict=True))

    def further(n: Column, p: Column) -> Column:
        begun = (F.get(ids, n + p) < F.col("id")) | ((F.get(ids, n + p) == F.col("id")) & (F.get(hs, n + p) <= F.col("h")))
        return F.when(F.coalesce(begun, F.lit(False)), n + p).otherwise(n)

    powers = F.array(*[F.lit(1 << k) for k in range(len(starts).bit_length(), -1, -1)])
    docs = docs.withColumn("block", F.aggregate(powers, F.lit(0), further))
    first = (F.get(ids, F.col("block")) == F.col("id")) & (F.get(hs, F.col("block")) == F.col("h"))
    before = F.struct(F.pmod(F.col("block") - 1, F.lit(len(starts))).alias("block"), F.lit(1).alias("turn"))
    places = F.array(F.struct("block", F.lit(0).alias("turn")))
    return docs.select("doc_id", "text", "h", F.explode(F.when(first, F.array_append(places, before)).otherwise(places)).alias("place")).select("doc_id", "text", "h", "place.*")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text (the last half replaced by the start of the next document), and likenesses."""
    order = W.partitionBy("block").orderBy("turn", "doc_id", "h", "text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_successors(docs).withColumn("n_chars", F.length("text").cast("long")).withColumn("next", F.lead("text").over(order))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half)))
    rows = rows.select("block", "turn", "doc_id", "h", "text", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("found"), F.when(F.col("turn") == 0, fingerprint(F.col("edited"))).alias("edited_found"))
    rows = rows.withColumn("own", hashes_of(F.col("found")))
    rows = rows.withColumn("following", F.lead("own").over(order)).filter("turn = 0")
    rows = rows.withColumn("edited_own", hashes_of(F.col("edited_found")))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("found")).alias("fingerprint"), printed(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
