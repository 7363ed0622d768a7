"""Near-duplicates: banded MinHash, odd sketches to check candidates, full sets to confirm links.

1.  Each text becomes its set of word shingles, the hashes of the bands of its MinHash signature,
    and an odd sketch: up to 1,024 samples of one-permutation MinHash, the smallest hash of each
    bin, flip one of 2,048 bits each, so that samples which two texts share cancel out in the XOR of
    their sketches and its population count tells how many samples differ.
2.  Texts with the same set are one class from here on, so copies cost nothing more.
3.  Classes that share a band are a bucket. Its members are compared with a few leaders at a time,
    sixteen times as many in each round, until every member of another component has been compared
    with every other. Links found on the way join components, and members of one component need
    no further comparison; so a group of thousands of near copies takes time in proportion to its
    size, without a cap on the size of a bucket or the number of partners. What is still open after
    sixteen leaders are texts that are alike, but mostly not enough to be linked. Their buckets are
    replaced by finer ones: texts that share one of their rarest shingles, as all linked ones do.
    These are compared in the same rounds.
4.  A pair with close sketches is a candidate; the full sets decide.

With 25 bands of 5 samples a pair with a similarity of 0.85 shares no band with a probability of
4e-7, and (measured) its sketches are five standard deviations closer than the limit at least.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmetrics.llm.common import by_ids, few, lists, map_texts, stored
from eventmetrics.llm.components import connected_components
from eventmetrics.llm.hashing import blocks, mix, shingles

WORDS = 5
BANDS, BAND_ROWS = 25, 5
SAMPLES = BANDS * BAND_ROWS
BINS, SKETCH_BITS = 1024, 2048
DEVIATIONS = 3.5
ROUND_FACTOR = 16

_RANDOM = np.random.default_rng(3)
_FACTORS = _RANDOM.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MASKS = _RANDOM.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)


def shingle_sets(column: pa.Array, size: int = WORDS):
    """First row, hashes and numbers of distinct shingles of each row, block by block."""
    for block in blocks(column):
        runs, counts = shingles(block.hashes, block.counts, size)
        bounds = np.concatenate(([0], np.cumsum(counts)))
        sets = [np.unique(runs[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        yield (block.first, np.concatenate(sets) if sets else runs,
               np.array([len(s) for s in sets], np.int64))


def minhash(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Signatures of the sets, all of which have members."""
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    short = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(counts), SAMPLES), np.uint32)
    for i in range(SAMPLES):
        out[:, i] = np.minimum.reduceat((short ^ _MASKS[i]) * _FACTORS[i], starts)
    return out


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(BAND_ROWS):
        total = mix(total ^ parts[:, :, k])
    return total.view(np.int64)


def odd_sketches(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bitmaps of the sets' samples, as 64-bit words, and how many samples each has.

    The values of a set are sorted, so the first of each bin (its upper bits) is its smallest.
    """
    n = len(counts)
    row = np.repeat(np.arange(n), counts)
    place = row * BINS + (values >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.ones(len(values), bool)
    first[1:] = place[1:] != place[:-1]
    row = row[first]
    bit = (mix(values[first]) & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
    parts = []
    for low in range(0, n, 512):  # a counter for each bit of a few sets at a time
        a, b = np.searchsorted(row, [low, low + 512])
        size = min(512, n - low)
        flips = np.bincount((row[a:b] - low) * SKETCH_BITS + bit[a:b], minlength=size * SKETCH_BITS)
        parity = (flips & 1).astype(np.uint8).reshape(size, SKETCH_BITS)
        parts.append(np.packbits(parity, axis=1).view(np.int64))
    return np.concatenate(parts), np.bincount(row, minlength=n)


def _signatures(batch: pa.RecordBatch):
    for first, values, counts in shingle_sets(batch.column(1)):
        n, full = len(counts), np.flatnonzero(counts)
        set_a, set_b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        bands, sketch = np.zeros(0, np.int64), np.zeros(0, np.int64)
        samples = np.zeros(n, np.int64)
        if len(full):
            starts = (np.cumsum(counts) - counts)[full]
            set_a[full] = np.add.reduceat(mix(values), starts)
            set_b[full] = np.bitwise_xor.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
            bands = band_hashes(minhash(values, counts[full]))
            sketch, samples[full] = odd_sketches(values, counts[full])
        has = (counts > 0).astype(np.int64)
        yield {"doc_id": batch.column(0).slice(first, n), "n_shingles": counts,
               "set_a": set_a.view(np.int64), "set_b": set_b.view(np.int64),
               "samples": samples, "bands": lists(bands.ravel(), has * BANDS),
               "sketch": lists(sketch.ravel(), has * (SKETCH_BITS // 64))}


def _sets(batch: pa.RecordBatch):
    for first, values, counts in shingle_sets(batch.column(1)):
        yield {"id": batch.column(0).slice(first, len(counts)),
               "shingles": lists(values.view(np.int64), counts)}


def _close(percent: int) -> F.Column:
    """Whether the sketches of a pair are as close as those of linked texts are.

    With a similarity J, a share of 1 - J of the bins differs. A bin that differs has one sample or,
    if both texts have words in it, two that the other text lacks: `each` on average. The formulas
    give the number of differing samples at J, add the deviations, and turn that into bits.
    """
    j = percent / 100
    samples = F.col("samples_a") + F.col("samples_b")
    smaller, larger = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    each = 2 - F.exp(-smaller / BINS)
    differing = samples / (1 + 2 * j / (1 - j) / each)
    left_out = 1 - F.least(F.lit(1.0), samples / 2 / larger)  # share of the sets not sampled
    deviation = each * F.sqrt(j * differing / each * left_out + 1)
    most = differing + DEVIATIONS * deviation + 2
    bits = SKETCH_BITS / 2 * (1 - F.exp(-2 * most / SKETCH_BITS))
    folding = DEVIATIONS * (2 / SKETCH_BITS) ** 0.5 * differing + 2
    words = [F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i]))
             for i in range(SKETCH_BITS // 64)]
    return sum(words[1:], words[0]) <= bits + folding


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The stored pairs whose full sets are similar enough. Only sets of the pairs are shuffled."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    sets = by_ids(sets, "id", ids)
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    both = pairs.join(left, "a").join(right, "b").select(
        "a", "b", shared.alias("shared"), (F.size("x") + F.size("y") - shared).alias("all"))
    return both.filter(F.col("shared") * 100 >= F.col("all") * percent).select("a", "b")


def _place(key: str, member: str) -> F.Column:
    """A fixed number in [0, 1) by which a bucket's members take turns as its leaders."""
    return F.pmod(F.xxhash64(key, member), F.lit(1 << 30)) / float(1 << 30)


def _sided(members: DataFrame, side: str) -> DataFrame:
    return members.select(
        "bucket", "band", F.col("id").alias(side), F.col("component").alias(f"of_{side}"),
        *[F.col(c).alias(f"{c}_{side}") for c in ("bands", "sketch", "samples", "n")])


def _first_shared_band() -> F.Column:
    """Whether the pair shares no band before this bucket's, so that it is compared only once."""
    apart = [(F.lit(k) >= F.col("band")) | (F.col("bands_a")[k] != F.col("bands_b")[k])
             for k in range(BANDS)]
    out = apart[0]
    for condition in apart[1:]:
        out = out & condition
    return out


def _relabelled(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components after each has taken the smallest name around it, twice.

    Some components may get several names this way, which only means a few more comparisons.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    for _ in range(2):
        name = few(components.select(F.col("id").alias("b"), "component"))
        named = both.join(name, "b", "left").select(
            "a", F.coalesce("component", "b").alias("component"))
        found = named.groupBy("a").agg(F.min("component").alias("component")).select(
            F.col("a").alias("id"), F.least("a", "component").alias("component"))
        components = stored(components.unionByName(found).groupBy("id").agg(
            F.min("component").alias("component")))
    # The name itself may have got a smaller one.
    return stored(_renamed(components, components))


def _renamed(components: DataFrame, names: DataFrame) -> DataFrame:
    """The components under the names that stored `names` (id, component) give to them."""
    newer = few(names.select(F.col("id").alias("component"), F.col("component").alias("newer")))
    return components.join(newer, "component", "left").select(
        "id", F.coalesce("newer", "component").alias("component"))


def _settled(components: DataFrame, links: DataFrame) -> DataFrame:
    """The components with all names of each made one: links between names are solved exactly."""
    for end in ("a", "b"):
        name = few(components.select(F.col("id").alias(end), F.col("component").alias("name")))
        links = links.join(name, end).drop(end).withColumnRenamed("name", end)
    between = stored(links.filter("a <> b").distinct())
    if between.isEmpty():
        return components
    return _renamed(components, stored(connected_components(between)))


def _link_classes(classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """id and component of the classes that have links."""
    banded = classes.select(F.col("class_id").alias("id"),
                            F.posexplode("bands").alias("band", "bucket"))
    members = _buckets(banded)
    ids = stored(members.select("id").distinct())
    # For telling the first shared band, 32 bits of each band's hash are enough.
    short = F.transform("bands", lambda b: b.bitwiseAND(0x7FFFFFFF).cast("int"))
    known = stored(by_ids(classes.select(
        F.col("class_id").alias("id"), short.alias("bands"), "sketch", "samples",
        F.col("n_shingles").alias("n")), "id", ids))
    sets = stored(map_texts(by_ids(docs, "doc_id", ids), _sets,
                            "id bigint, shingles array<bigint>"))
    state = _Links(classes.sparkSession.createDataFrame([], "id bigint, component bigint"), None,
                   few(known), sets, percent)
    left = state.compare(members, _first_shared_band() & _close(percent), most_rounds=2)
    if left is not None:
        # Near copies have one name from here on, so that only others are compared.
        state.components = stored(_settled(state.components, state.links))
        left = _still_open(members, state.components, ROUND_FACTOR)
        rare = _rare_shingles(left, sets, percent)
        state.known = few(stored(known.drop("bands").join(few(rare), ["id", "n"])))
        state.compare(_buckets(rare.select("id", F.explode("bands").alias("bucket")).withColumn(
            "band", F.col("bucket"))), _close(percent) & _first_shared_shingle())
    return state.components if state.links is None else _settled(state.components, state.links)


def _buckets(rows: DataFrame) -> DataFrame:
    """The stored rows (id, band, bucket) of buckets with several members, their number and smallest id.

    Texts that are alike share many buckets with the same members. The one with the smallest band
    is enough: it is the first shared band of all its pairs that another of them has.
    """
    several = stored(rows.groupBy("bucket").agg(F.count("*").alias("members"))
                     .filter("members > 1").select("bucket"))
    members = stored(rows.join(few(several), "bucket"))
    # Sums rather than exclusive ors: an id may be there twice, and would cancel itself out.
    same = ["members", "first", "last", "ids_a", "ids_b"]
    kept = (members.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min("id").alias("first"), F.max("id").alias("last"),
        F.min("band").alias("lowest"), F.sum(F.shiftright(F.xxhash64("id"), 32)).alias("ids_a"),
        F.sum(F.shiftright(F.xxhash64(F.lit("member"), "id"), 32)).alias("ids_b"))
        .groupBy(*same).agg(F.min_by("bucket", "lowest").alias("bucket"))
        .select("bucket", "first", "members"))
    return stored(members.join(few(stored(kept)), "bucket"))


def _rare_shingles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """id, n and, as `bands`, the rarest shingles of each member's set, which has n; stored.

    Of n shingles a linked text lacks at most n less `percent` of them, rounded up. If both sets are
    put in one order, so many of the first ones and one more have a shingle in common, or the texts are
    not linked. Rare shingles come first in that order, and those that only one member has need not be
    kept: what texts that are merely alike have in common then plays no part. Counts are those
    among the members.
    """
    ids = members.select("id").distinct()
    every = by_ids(sets, "id", ids).select(
        "id", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    several = stored(every.groupBy("shingle").agg(F.count("*").alias("texts")).filter("texts > 1"))
    common = every.join(few(several), "shingle").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("texts", "shingle"))).alias("common"))
    needed = F.ceil(F.col("n") * percent / 100)
    first = F.slice("common", 1, F.greatest(F.size("common") - needed + 1, F.lit(0)).cast("int"))
    return stored(common.select("id", F.col("n").cast("bigint").alias("n"),
                                F.transform(first, lambda x: x["shingle"]).alias("bands")))


def _first_shared_shingle() -> F.Column:
    """Whether this bucket's is the first rare shingle that the pair shares."""
    return F.col("band") == F.array_min(F.array_intersect("bands_a", "bands_b"))


def _labelled(members: DataFrame, components: DataFrame) -> DataFrame:
    return members.join(few(components), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))


def _still_open(members: DataFrame, components: DataFrame, more_than: int) -> DataFrame:
    """The stored members, with components, of larger buckets that have several components."""
    labelled = _labelled(members, components)
    several = labelled.filter(F.col("members") > more_than).groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("low <> high").select("bucket")
    return stored(labelled.join(few(stored(several)), "bucket", "left_semi"))


@dataclass
class _Links:
    """What is known of the classes, and the links and components found so far."""

    components: DataFrame
    links: DataFrame | None
    known: DataFrame
    sets: DataFrame
    percent: int

    def compare(self, members: DataFrame, condition: F.Column,
                most_rounds: int | None = None) -> DataFrame | None:
        """Compare the members of each bucket with its leaders, round by round.

        Pairs that fulfil `condition` are candidates. Returns the members of buckets that are still open
        after so many rounds, if any.
        """
        most = members.agg(F.max("members")).first()[0] or 0
        share, rounds = 0, 0  # leaders of a bucket so far, 0 at first: only its smallest id
        while most:
            if share == 0:
                pending = _labelled(members, self.components)
                leaders = pending.filter("id = first")
            else:
                # All pairs of the smaller buckets have been compared by now.
                pending = _still_open(members, self.components, share // ROUND_FACTOR)
                if pending.isEmpty():
                    break
                if rounds == most_rounds:
                    return pending
                turn = _place("bucket", "id") * F.col("members")
                earlier = share // ROUND_FACTOR if share > ROUND_FACTOR else 0
                leaders = pending.filter((turn < share) & (turn >= earlier))
            near = (_sided(leaders.join(self.known, "id"), "a")
                    .join(_sided(pending.join(self.known, "id"), "b").drop("band"), "bucket")
                    .filter((F.col("of_a") != F.col("of_b")) & condition)
                    .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
            found = stored(_confirmed(stored(near), self.sets, self.percent))
            self.links = found if self.links is None else self.links.unionByName(found)
            if not found.isEmpty():
                self.components = _relabelled(self.components, self.links)
            if share >= most:
                break
            share = ROUND_FACTOR if share == 0 else share * ROUND_FACTOR
            rounds += 1
        return None


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Texts are linked if their shingle sets share `percent` of their union at least, exactly
    computed; at least 85, for which the number of bands and the sketch limit are chosen. A text
    with fewer than five words is one shingle; one without words, or null, has none and is linked
    with nothing. Rows that repeat an id are one document: links of each hold for all. A row
    without an id is linked with nothing, has no component_id and is kept. Of each component the
    document with the smallest id is kept.
    """
    if percent < 85:
        raise ValueError("the bands are chosen for a similarity of 85 % and more")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signatures = stored(map_texts(
        rows, _signatures, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, "
        "samples bigint, bands array<bigint>, sketch array<bigint>"))
    key = ["n_shingles", "set_a", "set_b"]
    known = signatures.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(known.groupBy(*key).agg(
        F.min("doc_id").alias("class_id"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"), F.first("samples").alias("samples")))
    components = few(stored(_link_classes(classes, rows, percent)))
    # A document's class, or classes if its id repeats, and then the component of the class.
    of_class = classes.select(*key, "class_id").join(
        components.withColumnRenamed("id", "class_id"), "class_id", "left").select(
        *key, F.coalesce("component", "class_id").alias("component_id"))
    labelled = signatures.select("doc_id", *key).join(of_class, key, "left")
    return _joined_by_id(labelled)


def _joined_by_id(labelled: DataFrame) -> DataFrame:
    """Rows of one id get one component, and components that such an id holds together are one."""
    labelled = stored(labelled)
    several = (labelled.filter("component_id is not null").groupBy("doc_id")
               .agg(F.min("component_id").alias("a"), F.max("component_id").alias("b"))
               .filter("a <> b"))
    names = labelled.join(several.select("doc_id"), "doc_id", "left_semi").filter(
        "component_id is not null").join(several.select("doc_id", "a"), "doc_id").select(
        "a", F.col("component_id").alias("b"))
    if not several.isEmpty():
        merged = connected_components(names).select(
            F.col("id").alias("component_id"), F.col("component").alias("merged"))
        labelled = labelled.join(merged, "component_id", "left").withColumn(
            "component_id", F.coalesce("merged", "component_id"))
        # A row without words takes the component of the rows with words of the same id.
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return labelled.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               percent: int = 85) -> DataFrame:
    """The rows of the documents that are kept, with all their columns."""
    dropped = near_duplicates(docs, doc_id, text, percent).filter("not kept")
    return by_ids(docs, doc_id, dropped.select("doc_id"), "left_anti")
