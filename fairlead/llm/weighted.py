"""Document fingerprints by consistent weighted sampling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fairlead.llm.common import arrow_rows, mix, partitions, portions, stretch_hashes, text_bytes, words
from fairlead.session import stored

SAMPLES = 128
# Bytes; a longer word is several terms, so that text without spaces has terms too. REACH is how
# far a cut looks to both sides, which makes pieces of about PIECE bytes; LONGEST bounds them.
PIECE, REACH, LONGEST = 16, 8, 64
PORTION = 1 << 20
BLOCK = 4096
# One odd factor per sample and draw.
FACTORS = mix(np.arange(3 * SAMPLES, dtype=np.uint64), 21).reshape(3, SAMPLES) | np.uint64(1)


def draws(terms: np.ndarray, nth: int) -> np.ndarray:
    """64 pseudo-random bits per term hash and sample; every worker has the same."""
    with np.errstate(over="ignore"):
        x = terms[:, None] * FACTORS[nth]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def exponential(bits: np.ndarray) -> np.ndarray:
    """Exponential numbers of mean 1, rising with the bits; small ones keep their precision."""
    return -np.log1p(-(bits.astype(np.float64) + 0.5) / float(1 << 64) * (1 - 2**-53))


def cut_words(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the words, those over PIECE bytes in pieces that begin at characters.

    A cut is where the hash of the REACH bytes before it is below that of every other place
    within REACH bytes, so an edit changes the pieces around it alone. Where a stretch has no
    such place for LONGEST bytes, as in a run of one character, pieces are of LONGEST bytes
    counted from the last cut.
    """
    long = np.flatnonzero(end - start > PIECE)
    if not len(long):
        return start, end, row
    size = end[long] - start[long] - REACH
    place = np.arange(size.sum()) + np.repeat(start[long] + REACH - (np.cumsum(size) - size), size)
    place = place[(data[place] & 0xC0) != 0x80]
    value = stretch_hashes(data, place - REACH, place, 32)
    lowest = np.ones(len(place), bool)
    for k in range(1, REACH + 1):
        near = place[k:] - place[:-k] <= REACH
        lowest[:-k] &= ~near | (value[:-k] < value[k:])
        lowest[k:] &= ~near | (value[k:] < value[:-k])
    begins = np.sort(np.concatenate([start, place[lowest]]))
    owner = np.searchsorted(start, begins, side="right") - 1
    limit = np.minimum(np.r_[begins[1:], len(data)], end[owner])
    count = -(-(limit - begins) // LONGEST)
    which = np.repeat(np.arange(len(begins)), count)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    first = begins[which] + nth * LONGEST
    for _ in range(3):
        first -= (data[first] & 0xC0) == 0x80
    last = np.r_[first[1:], len(data)]
    return first, np.minimum(last, limit[which]), row[owner[which]]


def weighted_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, 64-bit hash and weight (how often) of the distinct terms of each text, by row."""
    data, at = text_bytes(texts)
    start, end, row = words(data, at)
    start, end, row = cut_words(data, start, end, row)
    term = stretch_hashes(data, start, end, 31)
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    fresh = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (term[1:] != term[:-1])][: len(row)])
    return row[fresh], term[fresh], np.diff(np.r_[fresh, len(row)])


def _least(best: np.ndarray, rows: np.ndarray, value: np.ndarray) -> None:
    """Lower each row of `best` to the least of its values; equal rows stand together."""
    begins = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    least = np.minimum.reduceat(value, begins, axis=0)
    best[rows[begins]] = np.minimum(best[rows[begins]], least)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """SAMPLES 16-bit codes per text; two texts agree in a code with their generalised Jaccard chance.

    For each sample a term of weight w gets t = floor(ln w / r + beta), y = exp(r (t - beta))
    and a = c / (y exp r); the term of the smallest a, with its t, is the sample. Here ln a is
    compared, and the code is a hash of the smallest ln a, which term and t determine.

    r and c, gamma(2, 1), and beta come from three exponential numbers e, f and g of the term's
    hash: c = e + f, and with v = ln(c / e), which is exponential and independent of c, r = v + g
    and beta = g / r. So ln a = ln e - r t. A term that occurs once has t = 0, and of those the
    least bits of e decide; the numbers of others are drawn once per block of equal terms.
    """
    row, term, weight = weighted_terms(texts)
    n = len(texts)
    has = np.bincount(row, minlength=n) > 0
    bits = np.full((n, SAMPLES), 2**64 - 1, np.uint64)
    light = np.flatnonzero(weight == 1)
    for first in range(0, len(light), BLOCK):
        part = light[first : first + BLOCK]
        _least(bits, row[part], draws(term[part], 0))
    best = np.log(exponential(bits)).astype(np.float32)
    best[np.bincount(row[light], minlength=n) == 0] = np.inf
    heavy = np.flatnonzero(weight > 1)
    heavy = heavy[np.argsort(term[heavy], kind="stable")]
    for first in range(0, len(heavy), BLOCK):
        part = heavy[first : first + BLOCK]
        distinct, which = np.unique(term[part], return_inverse=True)
        e, f, g = (exponential(draws(distinct, nth)) for nth in range(3))
        level = np.log(e).astype(np.float32)
        r = (np.log1p(f / e) + g).astype(np.float32)
        beta = (g / r).astype(np.float32)
        by_row = np.argsort(row[part], kind="stable")
        which, part = which[by_row], part[by_row]
        scale = r[which]
        steps = np.floor(np.log(weight[part]).astype(np.float32)[:, None] / scale + beta[which])
        _least(best, row[part], level[which] - scale * steps)
    codes = mix(best.view(np.uint32).astype(np.uint64).ravel(), 26) >> np.uint64(48)
    codes = codes.astype("<u2").reshape(best.shape)
    codes[~has] = 0
    return codes, has


def likeness(a: np.ndarray, has_a: np.ndarray, b: np.ndarray, has_b: np.ndarray) -> np.ndarray:
    """Share of equal codes per row; two texts without terms are alike, one without is not."""
    share = (a == b).mean(axis=1)
    return np.where(has_a & has_b, share, (has_a == has_b).astype(float))


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
SEAM_SCHEMA = SCHEMA.append(pa.field("part", pa.int32())).append(pa.field("seam", pa.string())).append(pa.field("text", pa.string()))


def _compared(doc_ids: pa.Array, texts: list[str], following: list[str]) -> dict:
    """The result columns of documents, given each one's text and the next document's."""
    edited = [edited_text(t, f) for t, f in zip(texts, following)]
    own, has = fingerprints(pa.array(texts, pa.string()))
    changed, has_changed = fingerprints(pa.array(edited, pa.string()))
    last, has_last = fingerprints(pa.array(following[-1:], pa.string()))
    # Within a run, the next document's fingerprint is the next row's.
    after, has_after = np.concatenate([own[1:], last]), np.concatenate([has[1:], has_last])
    return {
        "doc_id": doc_ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
        "fingerprint": [c.tobytes() if h else b"" for c, h in zip(own, has)],
        "edited_fingerprint": [c.tobytes() if h else b"" for c, h in zip(changed, has_changed)],
        "near_edited": likeness(own, has, changed, has_changed),
        "near_next": likeness(own, has, after, has_after),
    }


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, both fingerprints (hex), near_edited, near_next.

    The documents are ranged by descending doc_id (null last, then by a hash of the text), one
    shuffle of the texts; the next document is the next row. The last row of a partition meets
    the first of the next one that has rows in a join of one row per partition. Null text is
    empty; an empty text's fingerprint is empty, alike to another empty one (1) and to no other
    (0). The first document follows the last, so a lone document follows itself; an empty table
    gives one. Rows that repeat an id follow each other by a hash of their texts. Columns other
    than doc_id and text are ignored. A text of any length is a portion of its own.
    """
    spark = docs.sparkSession
    given = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash")]
    ranged = given.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ranged = ranged.select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, part = [], [], 0
        for whole in batches:
            for batch in portions(whole, "text", PORTION):
                if not batch.num_rows:
                    continue
                part = batch.column(0)[0].as_py()
                if not texts:
                    yield _seam(part, "first", batch.column(1)[0].as_py(), batch.column(2)[0].as_py())
                ids += batch.column(1).to_pylist()
                texts += batch.column(2).to_pylist()
                if len(texts) > 1:
                    done = _compared(ids[:-1], texts[:-1], texts[1:])
                    n = len(texts) - 1
                    yield arrow_rows(SEAM_SCHEMA, **done, part=[part] * n, seam=[""] * n, text=[None] * n)
                    ids, texts = ids[-1:], texts[-1:]
        if texts:
            yield _seam(part, "last", ids[0], texts[0])

    rows = stored(ranged.mapInArrow(run, f"{FIELDS}, part int, seam string, text string"), "fingerprints")
    inner = rows.filter("seam = ''").select(*SCHEMA.names)
    firsts = rows.filter("seam = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    every = firsts.select("next_part")
    after = F.lead("next_part").over(W.orderBy("next_part"))
    smallest = F.min("next_part").over(W.partitionBy())
    chain = every.select(F.col("next_part").alias("part"), F.coalesce(after, smallest).alias("next_part"))
    lasts = rows.filter("seam = 'last'").select("doc_id", "text", "part")
    met = lasts.join(F.broadcast(chain), "part").join(firsts, "next_part").select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield arrow_rows(SCHEMA, **_compared([row["doc_id"]], [row["text"]], [row["following"]]))

    out = inner.unionByName(met.mapInArrow(finish, FIELDS))
    return out.withColumns(
        {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    )


def _seam(part: int, kind: str, doc_id: int | None, text: str) -> pa.RecordBatch:
    empty = {name: [None] for name in SCHEMA.names}
    return arrow_rows(SEAM_SCHEMA, **(empty | {"doc_id": [doc_id]}), part=[part], seam=[kind], text=[text])
