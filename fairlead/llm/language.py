"""Language identification by compression: the dictionary that shortens a text most names its language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import arrow_rows, fold_of, portions, uniform
from fairlead.session import stored

FOLDS = 3
# A language's dictionary: excerpts of at most so many distinct texts, up to so many bytes; of
# a text that is too long, so many places.
DOCUMENTS, DICTIONARY, PLACES = 80, 60_000, 3
# The draw takes more, so that the bound is met from above.
SPARE = 1.5
LEVEL = 9
MARGIN = 0.02
UNKNOWN = "und"


def excerpts(text: str, room: Column, places: int = PLACES) -> Column:
    """The whole text if it has at most `room` bytes, else `places` excerpts that fill the room.

    The text is cut into as many equal parts, and the place of an excerpt in its part is drawn
    by a hash of the text.
    """
    n = F.length(text)
    size = F.floor(room / places / F.octet_length(text) * n)
    slack = n / places - size

    def piece(k: int) -> Column:
        first = F.floor(n * k / places + uniform(F.xxhash64(text), seed=60 + k) * slack)
        return F.substring(F.col(text), (first + 1).cast("int"), size.cast("int"))

    return F.when(F.octet_length(text) <= room, F.array(text)).otherwise(F.array(*map(piece, range(places))))


def learn_dictionaries(
    docs: DataFrame, documents: int = DOCUMENTS, dictionary: int = DICTIONARY, places: int = PLACES
) -> dict[str, bytes]:
    """Raw dictionary content per language, from the documents outside the held-out fold.

    Of each language at most `documents` distinct texts are drawn by a hash of the text, however
    many copies they have, and each gets the same room of the `dictionary` bytes; a text that
    does not fit is excerpted from as many drawn `places` all over it. Languages are counted over all documents. Later content is
    cheaper to refer to, so the order is that of the draw. The most frequent language comes
    first.
    """
    known = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id", FOLDS) != 1) & F.col("text").rlike(r"\p{L}")
    ).select("lang", "text", F.xxhash64("text").alias("hash"))
    each = known.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("n"))
    counts = each.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    counts = stored(counts, "languages")
    rates = counts.select(
        F.col("lang").alias("_lang"),
        (F.lit(SPARE * documents) / F.col("texts")).alias("rate"),
        F.floor(F.lit(dictionary) / F.least("texts", F.lit(documents))).alias("room"),
    )
    drawn = known.withColumn("draw", uniform("hash", seed=6))
    drawn = drawn.join(F.broadcast(rates), F.col("lang") == F.col("_lang")).filter(F.col("draw") < F.col("rate"))
    drawn = drawn.select("lang", "hash", "draw", "room", excerpts("text", F.col("room"), places).alias("pieces"))
    rows = drawn.groupBy("lang", "hash").agg(F.min(F.struct("draw", "room", "pieces")).alias("of")).select("lang", "of.*")
    found: dict[str, list] = {}
    for row in sorted(rows.collect(), key=lambda r: (r["lang"], r["draw"], r["pieces"])):
        found.setdefault(row["lang"], []).append(row)
    out = {lang: b"".join(content(r["pieces"], r["room"]) for r in of[:documents]) for lang, of in found.items()}
    frequent = counts.orderBy(F.col("n").desc(), "lang").collect()
    return {r["lang"]: out[r["lang"]] for r in frequent if r["lang"] in out}


def content(pieces: list[str], room: int) -> bytes:
    """The pieces as lines of a dictionary, each within its share of the room."""
    share = room // len(pieces) - 1
    return b"".join(plain(p)[:share].decode(errors="ignore").encode() + b"\n" for p in pieces)


# Bytes that count: letters, and all beyond ASCII; others part words.
LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 0x20 for c in range(256))


def plain(text: str) -> bytes:
    """The whole text in lower case with single spaces for whatever is no letter."""
    return b" ".join(text.lower().encode().translate(LETTERS).split())


class Compressors:
    """One compressor per language, each with its digested dictionary."""

    def __init__(self, contents: dict[str, bytes]):
        self.names = list(contents)
        self.each = []
        for name in self.names:
            held = zstandard.ZstdCompressionDict(contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.each.append(
                zstandard.ZstdCompressor(
                    dict_data=held, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def sizes(self, text: bytes) -> np.ndarray:
        return np.array([len(c.compress(text)) for c in self.each])


def identify(
    docs: DataFrame,
    contents: dict[str, bytes] | None = None,
    documents: int = DOCUMENTS,
    dictionary: int = DICTIONARY,
    places: int = PLACES,
) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, reliable.

    Every whole text, in lower case and without what is no letter, is compressed once per
    language; the smallest result wins, and of equal ones the most frequent language. `score` is 1 minus the smallest size over the second
    smallest, stretched to [0, 1] as d / (d + MARGIN). `reliable` is false where the margin is
    narrow (below MARGIN): such an answer is to be rejected. "und" with score 0 is the answer
    for null texts and texts without a letter, and for all if nothing could be learnt. With a
    single language every text is of it, with score 1. Rows that repeat an id are judged each
    by its own text. An empty table gives one. A text of any length is compressed whole.
    Columns other than doc_id, text and lang are ignored.

    Without `contents`, dictionaries are learnt from a bounded sample: at most `documents` texts
    and `dictionary` bytes a language, `places` excerpts of a text that does not fit.
    """
    contents = learn_dictionaries(docs, documents, dictionary, places) if contents is None else contents
    shared = docs.sparkSession.sparkContext.broadcast(contents)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("reliable", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = Compressors(shared.value)
        for whole in batches:
            for batch in portions(whole, "text", 16 << 20):
                names, scores, sure = [], [], []
                for text, letters in zip(batch.column(1), batch.column(3)):
                    if not tools.names or not letters.as_py():
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        sure.append(False)
                        continue
                    sizes = tools.sizes(plain(text.as_py()))
                    best = int(sizes.argmin())
                    rest = np.delete(sizes, best)
                    gap = 1 - sizes[best] / rest.min() if len(rest) else 1.0
                    names.append(tools.names[best])
                    scores.append(float(gap / (gap + MARGIN)) if len(rest) else 1.0)
                    sure.append(bool(gap >= MARGIN))
                yield arrow_rows(
                    schema, doc_id=batch.column(0), held_out=batch.column(2), lang_pred=names, score=scores, reliable=sure
                )

    given = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        (fold_of("doc_id", FOLDS) == 1).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    return given.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, reliable boolean")
