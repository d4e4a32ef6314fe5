"""Near-duplicates by one-permutation hashing: bins, densified, in banded buckets, star by star."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.llm.common import LOWER, arrow_rows, free_name, matched, mix, portions, stretch_hashes, text_bytes, words
from fairlead.llm.components import components
from fairlead.session import stored

SHINGLE = 5
PERCENT = 80
# At 80 % a pair shares none of the bands with a chance of (1 - 0.8**5)**40, about 1e-7.
BANDS, ROWS = 40, 5
BINS = BANDS * ROWS
# Centers per bucket in the second round.
CENTERS = 4
# How often hopeless documents are dropped before the last round; the differences do the rest.
PRUNINGS = 1
PORTION = 2 << 20


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash) of the shingles of each text, sorted; a short text is one shingle."""
    data, at = text_bytes(texts)
    data = LOWER[data]
    start, end, row = words(data, at)
    hashes = stretch_hashes(data, start, end, 41)
    count = np.bincount(row, minlength=len(texts))
    first = np.cumsum(count) - count
    # A shingle begins at each word with size - 1 more behind it, or at a short text's first.
    length = np.minimum(count, size)
    nth = np.arange(len(row)) - first[row]
    begins = np.flatnonzero((nth + size <= count[row]) | ((nth == 0) & (count[row] < size)))
    total = length[row[begins]].astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            inside = k < length[row[begins]]
            at_word = np.minimum(begins + k, max(len(hashes) - 1, 0))
            total = np.where(inside, mix(total ^ hashes[at_word], 42), total)
    owner = row[begins]
    order = np.lexsort((total, owner))
    owner, total = owner[order], total[order]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (total[1:] != total[:-1])
    return owner[fresh], total[fresh]


def _probes() -> np.ndarray:
    """The bins that an empty bin tries, in order: pseudo-random ones, then all in turn."""
    tries = mix(np.arange(BINS * 256, dtype=np.uint64), 43) % np.uint64(BINS)
    around = (np.arange(BINS)[:, None] + np.arange(1, BINS + 1)[None, :]) % BINS
    return np.concatenate([tries.reshape(BINS, 256).astype(np.int64), around], axis=1)


def signatures(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """BINS minima per row from its sorted distinct hashes; rows without hashes get zeros.

    One permutation: the upper half of a hash names its bin, and within a bin the smallest hash
    counts. An empty bin borrows from the first of its probes that is not empty; the probes are
    the same for all rows, which keeps the chance of agreement at the Jaccard similarity.
    """
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    lead = np.ones(len(owner), bool)
    lead[1:] = (owner[1:] != owner[:-1]) | (bins[1:] != bins[:-1])
    least = np.zeros((n, BINS), np.uint64)
    filled = np.zeros((n, BINS), bool)
    least[owner[lead], bins[lead]] = hashes[lead]
    filled[owner[lead], bins[lead]] = True
    row, place = np.nonzero(~filled & filled.any(axis=1)[:, None])
    probes, attempt, out = _probes(), 0, least.copy()
    while len(row):
        source = probes[place, attempt]
        found = filled[row, source]
        out[row[found], place[found]] = least[row[found], source[found]]
        row, place, attempt = row[~found], place[~found], attempt + 1
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(signature), BANDS), np.uint64)
    for k in range(ROWS):
        keys = mix((keys ^ signature[:, k::ROWS]).ravel(), 44).reshape(keys.shape)
    return mix((keys ^ np.arange(BANDS, dtype=np.uint64)).ravel(), 45).reshape(keys.shape)


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, n_shingles, a 128-bit digest of its set (s1, s2), and band keys.

    given_id and text_hash are passed on.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("given_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bands", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in portions(whole, "text", PORTION):
                n = batch.num_rows
                owner, hashes = shingle_sets(batch.column(1), size)
                counts = np.bincount(owner, minlength=n)
                digests = []
                for seed in (46, 47):
                    sums = np.zeros(len(hashes) + 1, np.uint64)
                    np.cumsum(mix(hashes, seed), out=sums[1:])
                    ends = np.cumsum(counts)
                    digests.append((sums[ends] - sums[ends - counts]).view(np.int64))
                keys = band_keys(signatures(owner, hashes, n))
                yield arrow_rows(
                    schema,
                    doc_id=batch.column(0),
                    given_id=batch.column(2),
                    text_hash=batch.column(3),
                    n_shingles=counts.astype(np.int64),
                    s1=digests[0],
                    s2=digests[1],
                    bands=pa.ListArray.from_arrays(
                        np.arange(0, (n + 1) * BANDS, BANDS, dtype=np.int32), keys.ravel().view(np.int64)
                    ),
                )

    slim = docs.select("doc_id", "text", "given_id", "text_hash")
    return slim.mapInArrow(run, "doc_id long, given_id long, text_hash long, n_shingles long, s1 long, s2 long, bands array<long>")


def full_sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per document: doc_id and its whole set, sorted 64-bit shingle hashes."""
    schema = pa.schema([("doc_id", pa.int64()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in portions(whole, "text", PORTION):
                owner, hashes = shingle_sets(batch.column(1), size)
                ends = np.cumsum(np.bincount(owner, minlength=batch.num_rows))
                at = np.concatenate([[0], ends])
                packed = [hashes[a:b].astype("<u8").tobytes() for a, b in zip(at[:-1], at[1:])]
                yield arrow_rows(schema, doc_id=batch.column(0), hashes=packed)

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(run, "doc_id long, hashes binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of distinct pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(left.as_buffer(), "<u8"), np.frombuffer(right.as_buffer(), "<u8")
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    close.append(False)
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                close.append(100 * common >= percent * (len(x) + len(y) - common))
            chosen = np.flatnonzero(close)
            yield arrow_rows(schema, a=batch.column(0).take(chosen), b=batch.column(1).take(chosen))

    one = sets.select(F.col("doc_id").alias("_b"), F.col("hashes").alias("right"))
    two = sets.select(F.col("doc_id").alias("_a"), F.col("hashes").alias("left"))
    both = pairs.join(one, F.col("b") == F.col("_b")).join(two, F.col("a") == F.col("_a"))
    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest doc_id linked, itself included)."""
    return judged_duplicates(docs, size, percent).select("doc_id", "n_shingles", "component_id")


def keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """text, given_id, text_hash and a key called doc_id per row; and whether keys differ from ids.

    The key is the id unless an id has rows of several texts: then all keys are hashes of id and
    text, so that each text is judged on its own set. A null id's key is null.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("given_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    spread = rows.filter("given_id is not null").groupBy("given_id").agg(
        F.min("text_hash").alias("lo"), F.max("text_hash").alias("hi")
    )
    several = not spread.filter("lo < hi").isEmpty()
    key = F.when(F.col("given_id").isNotNull(), F.xxhash64("given_id", "text_hash")) if several else F.col("given_id")
    return rows.withColumn("doc_id", key), several


def judged_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, text_hash, n_shingles, component_id and kept.

    Documents with the same set are one class, found by a digest of the set, and only the
    smallest id of a class goes on. In every bucket that several classes share, a star links its
    members to a center, the member with most company in all its buckets: of a family of edited
    copies that is the text most like all. First each member is compared with the center that
    most of its buckets have, then, where a bucket still holds more than one component, with the
    first few centers. Links are confirmed on full sets and joined to components. What is left
    in open buckets is compared where two sets share rare differences from their center (see
    `_rest`). So every pair of a bucket is compared, connected or ruled out.

    Documents without words are linked with nothing; an empty table gives an empty one; columns
    other than doc_id and text are ignored. A set is as long as its text, and only pairs that
    are compared bring two whole sets into a task. A null doc_id is linked with nothing, its
    component is null. Rows that repeat an id and the text are one document; rows that repeat an
    id with other texts are documents of their own, each linked by its own text. `kept` is true
    for one document of each component, that of the smallest id and then text_hash.
    """
    docs, several = keyed(docs)
    sketched = stored(sketches(docs, size), "sketches")
    usable = sketched.filter("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("n_shingles", "s1", "s2").agg(
        F.min(F.struct("doc_id", "bands")).alias("least"), F.count(F.lit(1)).alias("n")
    )
    classes = stored(classes.select("n_shingles", "s1", "s2", "least.*", "n"), "classes")
    member = usable.select("doc_id", "n_shingles", "s1", "s2").join(
        classes.filter("n > 1").select("n_shingles", "s1", "s2", F.col("doc_id").alias("a")), ["n_shingles", "s1", "s2"]
    )
    links = stored(member.filter("a < doc_id").select("a", F.col("doc_id").alias("b")), "class-links")

    buckets = stored(_buckets(classes), "buckets")
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    wanted = texts.join(buckets.select("doc_id").distinct(), F.col("id") == F.col("doc_id")).select("doc_id", "text")
    sets = stored(full_sets(wanted, size).dropDuplicates(["doc_id"]), "sets")

    center = F.max(F.struct("company", (-F.col("doc_id")).alias("c"))).alias("center")
    centers = buckets.groupBy("bucket").agg(center)
    centers = centers.select(F.col("bucket").alias("_bucket"), (-F.col("center.c")).alias("center"))
    votes = buckets.join(centers, F.col("bucket") == F.col("_bucket")).filter("doc_id <> center")
    votes = votes.groupBy("doc_id", "center").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("doc_id").agg(F.max(F.struct("n", (-F.col("center")).alias("c"))).alias("best"))
    center = -F.col("best.c")
    pairs = best.select(F.least(center, "doc_id").alias("a"), F.greatest(center, "doc_id").alias("b")).distinct()
    tried = stored(pairs, "tried")
    links = links.unionByName(stored(confirmed(tried, sets, percent), "close"))
    parts = components(links)
    for compare in (_stars, lambda rows: _rest(rows, sets, percent)):
        buckets = _open_buckets(buckets, parts)
        pairs = stored(compare(buckets).join(tried, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        close = stored(confirmed(pairs, sets, percent), "close")
        tried = tried.unionByName(pairs)
        if not close.isEmpty():
            # What is joined already goes on as stars, which need fewer rounds than its links.
            stars = parts.filter("component < id").select(F.col("component").alias("a"), F.col("id").alias("b"))
            parts = components(stars.unionByName(close))
    out = sketched.join(parts, F.col("doc_id") == F.col("id"), "left")
    component, kept = F.coalesce("component", "doc_id"), F.col("given_id").eqNullSafe(F.col("component_id"))
    if several:
        out = stored(out.select("given_id", "text_hash", "n_shingles", "component"), "keyed-components")
        least = out.filter("component is not null").groupBy(F.col("component").alias("_component"))
        least = least.agg(F.min(F.struct("given_id", "text_hash")).alias("least"))
        out = out.join(least, F.col("component") == F.col("_component"), "left")
        component = F.coalesce("least.given_id", "given_id")
        kept = F.col("least").isNull() | F.col("least").eqNullSafe(F.struct("given_id", "text_hash"))
        out = out.withColumn("component_id", component).withColumn("kept", kept)
    else:
        out = out.withColumn("component_id", component).withColumn("kept", kept)
    return out.select(F.col("given_id").alias("doc_id"), "text_hash", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """One document of each component, with its own columns; of rows that repeat it, one."""
    kept = matched(docs, judged.filter("not kept"), "left_anti")
    twice = judged.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = stored(twice.select("doc_id", "text_hash"), "repeated-rows")
    if twice.isEmpty():
        return kept
    id_name, hash_name = free_name(docs, "repeated_id"), free_name(docs, "repeated_hash")
    repeated = matched(kept, twice, "left_semi").withColumns({id_name: F.col("doc_id"), hash_name: F.xxhash64("text")})
    once = repeated.dropDuplicates([id_name, hash_name]).select(*docs.columns)
    return matched(kept, twice, "left_anti").unionByName(once)


def _buckets(classes: DataFrame) -> DataFrame:
    """bucket, doc_id and company of the members of shared buckets.

    A member's company is the sum of the sizes of its buckets.
    """
    keys = classes.select("doc_id", F.explode("bands").alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    rows = keys.join(shared.withColumnRenamed("bucket", "_bucket"), F.col("bucket") == F.col("_bucket"))
    rows = stored(rows.select("bucket", "doc_id", "size"), "bucket-sizes")
    company = rows.groupBy("doc_id").agg(F.sum("size").alias("company")).withColumnRenamed("doc_id", "_id")
    return rows.join(company, F.col("doc_id") == F.col("_id")).select("bucket", "doc_id", "company")


def _open_buckets(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, with their component."""
    slim = buckets.select("bucket", "doc_id", "company")
    labelled = slim.join(parts, F.col("doc_id") == F.col("id"), "left")
    labelled = labelled.select("bucket", "doc_id", "company", F.coalesce("component", "doc_id").alias("component"))
    labelled = stored(labelled, "labelled")
    spread = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    spread = spread.filter("lo < hi").select(F.col("bucket").alias("_bucket"))
    return stored(labelled.join(spread, F.col("bucket") == F.col("_bucket"), "left_semi"), "open")


def _stars(buckets: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of a center and a member of its bucket in another component."""
    nth = F.row_number().over(W.partitionBy("bucket").orderBy(F.col("company").desc(), "doc_id"))
    middle = buckets.withColumn("nth", nth).filter(F.col("nth") <= CENTERS)
    middle = middle.select(
        F.col("bucket").alias("_bucket"), F.col("doc_id").alias("center"), F.col("component").alias("other")
    )
    met = buckets.join(middle, (F.col("bucket") == F.col("_bucket")) & (F.col("component") != F.col("other")))
    return met.select(F.least("doc_id", "center").alias("a"), F.greatest("doc_id", "center").alias("b")).distinct()


def _rest(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a < b) in different components of a bucket that may still be close.

    First documents are dropped to which even the smallest member of the bucket leaves no hope:
    of a document's n shingles only the `most` that an open document of another component has
    too can be common, and sizes n and m need a common part of percent * (n + m) / (100 +
    percent).

    The members of a bucket meet by what sets them apart from its center. If d and e shingles
    tell two sets from the center's, at most (n + m) * (100 - percent) / (100 + percent) may
    tell them from each other, so they need at least half of what d + e is more than that in
    common among those. Where that is nothing, the pair is close, and so are both to the member
    that is best in this respect: a star links them. Else the pair shares one of the rarest
    differences of each, so many that fewer than the needed ones are left: only such pairs are
    compared. What a family has in common is no difference and brings no pairs together.
    """
    rows = buckets
    for _ in range(PRUNINGS):
        sized = stored(_sized(rows, sets), "sized")
        least = sized.groupBy(F.col("bucket").alias("_bucket")).agg(F.min("n").alias("least"))
        hopeful = sized.join(least, F.col("bucket") == F.col("_bucket"))
        hopeful = hopeful.filter((100 + percent) * F.col("most") >= percent * (F.col("n") + F.col("least")))
        rows = stored(hopeful.select("bucket", "doc_id", "company", "component"), "hopeful")
    centers = rows.groupBy(F.col("bucket").alias("_bucket")).agg(
        F.max(F.struct("company", (-F.col("doc_id")).alias("c"))).alias("center")
    )
    groups = rows.join(centers, F.col("bucket") == F.col("_bucket"))
    groups = groups.select((-F.col("center.c")).alias("center"), "doc_id", "component").distinct()
    apart = stored(_differences(groups, sets), "differences")

    far = (100 + percent) * F.col("d") - (100 - percent) * F.col("n")
    members = apart.select("center", "doc_id", "component", "n", "d", far.alias("far"))
    ends = members.groupBy(F.col("center").alias("_center")).agg(
        F.min(F.struct("far", "doc_id")).alias("best"), F.min(F.when(F.col("d") > 0, F.col("far"))).alias("low")
    )
    ranged = members.join(ends, F.col("center") == F.col("_center")).drop("_center")
    star = ranged.filter((F.col("far") + F.col("best.far") <= 0) & (F.col("doc_id") != F.col("best.doc_id")))
    star = star.select(F.least("doc_id", "best.doc_id").alias("a"), F.greatest("doc_id", "best.doc_id").alias("b"))

    # So many differences have to be common at least, with any other member.
    half = F.lit(2 * (100 + percent))
    needed = F.greatest(F.ceil((F.col("far") + F.col("low")) / half), F.lit(1))
    ranged = ranged.select("center", "doc_id", "component", "d", "far", needed.alias("needed"))
    each = apart.select(F.col("center").alias("_center"), F.col("doc_id").alias("_id"), F.col("component").alias("_part"), F.explode("hashes").alias("hash"))
    spread = each.groupBy(F.col("_center").alias("_c"), F.col("hash").alias("_hash")).agg(
        F.count(F.lit(1)).alias("held"), F.min("_part").alias("lo"), F.max("_part").alias("hi")
    )
    each = each.join(spread, (F.col("_center") == F.col("_c")) & (F.col("hash") == F.col("_hash")))
    rarest = W.partitionBy("_center", "_id").orderBy("held", "hash")
    each = each.withColumn("nth", F.row_number().over(rarest)).filter("lo < hi").select("_center", "_id", "hash", "nth")
    early = each.join(ranged, (F.col("_center") == F.col("center")) & (F.col("_id") == F.col("doc_id")))
    early = early.filter(F.col("nth") <= F.col("d") - F.col("needed") + 1)
    early = stored(early.select("center", "doc_id", "component", "d", "far", "hash", "nth"), "rare-differences")
    other = early.select(*[F.col(c).alias(f"_{c}") for c in early.columns])
    common = F.greatest(F.ceil((F.col("far") + F.col("_far")) / half), F.lit(1))
    met = early.join(
        other,
        (F.col("center") == F.col("_center"))
        & (F.col("hash") == F.col("_hash"))
        & (F.col("doc_id") < F.col("_doc_id"))
        & (F.col("component") != F.col("_component"))
        & (F.col("nth") <= F.col("d") - common + 1)
        & (F.col("_nth") <= F.col("_d") - common + 1),
    )
    met = met.select(F.col("doc_id").alias("a"), F.col("_doc_id").alias("b"))
    return star.unionByName(met).distinct()


def _differences(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Per row (center, doc_id, component): the set's size n and the d hashes in one of both sets only."""
    schema = pa.schema(
        [
            ("center", pa.int64()), ("doc_id", pa.int64()), ("component", pa.int64()),
            ("n", pa.int64()), ("d", pa.int64()), ("hashes", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, apart = [], []
            for own, of_center in zip(batch.column(3), batch.column(4)):
                x, y = np.frombuffer(own.as_buffer(), "<i8"), np.frombuffer(of_center.as_buffer(), "<i8")
                sizes.append(len(x))
                apart.append(np.setxor1d(x, y, assume_unique=True))
            yield arrow_rows(
                schema, center=batch.column(0), doc_id=batch.column(1), component=batch.column(2),
                n=sizes, d=[len(x) for x in apart], hashes=apart,
            )

    own = sets.select(F.col("doc_id").alias("_id"), F.col("hashes").alias("own"))
    of_center = sets.select(F.col("doc_id").alias("_center"), F.col("hashes").alias("of_center"))
    rows = groups.join(own, F.col("doc_id") == F.col("_id")).join(of_center, F.col("center") == F.col("_center"))
    rows = rows.select("center", "doc_id", "component", "own", "of_center")
    return rows.mapInArrow(run, "center long, doc_id long, component long, n long, d long, hashes array<long>")


def _sized(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows (bucket, doc_id, company, component) with n and most of each document."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("component", pa.int64()), ("hash", pa.int64())])
        for batch in batches:
            for doc_id, component, hashes in zip(*batch.columns):
                values = np.frombuffer(hashes.as_buffer(), "<i8")
                ids = np.full(len(values), doc_id.as_py())
                yield arrow_rows(schema, doc_id=ids, component=np.full(len(values), component.as_py()), hash=values)

    slim = rows.select("bucket", "doc_id", "company", "component")
    members = slim.select(F.col("doc_id").alias("_id"), "component").distinct()
    opened = sets.join(members, F.col("doc_id") == F.col("_id")).select("doc_id", "component", "hashes")
    shingles = opened.mapInArrow(each, "doc_id long, component long, hash long")
    shingles = stored(shingles, "open-shingles")
    spread = shingles.groupBy("hash").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    spread = spread.filter("lo < hi").select(F.col("hash").alias("_hash"))
    common = shingles.join(spread, F.col("hash") == F.col("_hash"), "left_semi")
    common = common.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("most"))
    sizes = shingles.groupBy(F.col("doc_id").alias("_doc")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.join(common, F.col("_doc") == F.col("_id"), "left")
    sizes = sizes.select("_doc", "n", F.coalesce("most", F.lit(0)).alias("most"))
    return slim.join(sizes, F.col("doc_id") == F.col("_doc")).drop("_doc")
