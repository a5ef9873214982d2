"""Language identification by compression.

Each language is represented by a raw-content zstandard dictionary made of text
in that language. A text is cut into blocks, every block is compressed with
every dictionary, and the language with the smallest sum of sizes wins. If the
runner-up comes close the text is rejected.

The dictionaries are fitted on a bounded sample of labelled rows: about
``sample_rows`` distinct texts a language, chosen by the hash of the text, with
an excerpt of ``excerpt_chars`` characters each, at a place the hash decides. So
the driver holds ``languages * sample_rows * excerpt_chars`` characters.
Prediction reads whole texts and is a narrow pass without a shuffle.

Letters are lower-cased, everything ASCII that is not a letter becomes a space:
figures, punctuation and mark-up say nothing about the language.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and
so is every text if no labelled row exists; rows without label or text are not
learned from; ties go to the smaller language name (margin 0, rejected);
repeated rows each get the same answer; an empty table gives an empty result;
other columns of the input are ignored by :func:`identify` and kept by
:func:`drop_unidentified`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearfold.llm.common import drop_ids
from nearfold.sources.scratch import stage

UNDETERMINED = "und"
SAMPLE_ROWS = 256
EXCERPT_CHARS = 512
LEVEL = 6
#: Bytes compressed at once: short enough that the dictionary, not the text itself, decides.
BLOCK_BYTES = 1024
#: A winner must be smaller than the runner-up by this share of its size.
MARGIN = 0.004
#: Bits of evidence are divided by this for the score, as blocks are not independent.
TEMPERATURE = 8.0

_LETTER = regex.compile(r"\p{L}")
_SPACED = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


def letters_only(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_SPACED).split())


def fit_dictionaries(
    docs: DataFrame,
    label_col: str = "lang",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    excerpt_chars: int = EXCERPT_CHARS,
) -> dict[str, bytes]:
    """Dictionary of each label, from a bounded sample of the labelled rows of ``docs``."""
    rows = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    digest = F.xxhash64(text_col)
    # Distinct texts: the draw is by hash of the text, so copies are drawn as one.
    distinct = rows.groupBy(F.col(label_col)).agg(F.approx_count_distinct(digest))
    counts = {r[0]: r[1] for r in distinct.collect()}
    if not counts:
        return {}
    span = 1 << 30
    # Twice the rows wanted, as some repeat; the rest is cut off in the order of the hash.
    shares = [(k, min(span, int(2 * sample_rows * span / n) + 1)) for k, n in counts.items()]
    share = F.broadcast(docs.sparkSession.createDataFrame(shares, "label string, share long"))
    drawn = (
        rows.select(F.col(label_col).alias("label"), digest.alias("h"), F.col(text_col).alias("t"))
        .join(share, "label")
        .where(F.pmod("h", F.lit(span)) < F.col("share"))
    )
    room = F.greatest(F.lit(1), F.length("t") - excerpt_chars + 1)
    begin = F.pmod(F.shiftright("h", 30), room).cast("int") + 1
    drawn = drawn.select("label", "h", F.substring("t", begin, F.lit(excerpt_chars)).alias("t")).distinct()
    first = Window.partitionBy("label").orderBy("h", "t")
    kept = drawn.withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample_rows)
    excerpts: dict[str, list[bytes]] = {}
    for row in kept.orderBy("label", "n").collect():
        excerpts.setdefault(row["label"], []).append(letters_only(row["t"]))
    return {k: joined for k, v in sorted(excerpts.items()) if len(joined := b" ".join(v)) >= 8}


class Classifier:
    """Compressors of the languages in the order of their names; made once a task."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL, block_bytes: int = BLOCK_BYTES):
        self.languages = sorted(dictionaries)
        self.block_bytes = block_bytes
        self.compressors = []
        for language in self.languages:
            held = zstandard.ZstdCompressionDict(
                dictionaries[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            held.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False)
            )

    def sizes(self, text: str) -> np.ndarray:
        data = letters_only(text)
        blocks = [data[i : i + self.block_bytes] for i in range(0, len(data), self.block_bytes)]
        return np.array([sum(len(c.compress(b)) for b in blocks) for c in self.compressors])

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score from 0 to 1, and margin as a share of the smallest size."""
        if not self.languages or text is None or not _LETTER.search(text):
            return UNDETERMINED, 0.0, 0.0
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        score = 1 / np.exp2(-8 / TEMPERATURE * (sizes - sizes[best])).sum()
        others = np.delete(sizes, best)
        margin = (others.min() - sizes[best]) / sizes[best] if len(others) else 1.0
        return self.languages[best], float(score), float(margin)


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    id_col: str = "doc_id",
    text_col: str = "text",
    margin: float = MARGIN,
) -> DataFrame:
    """``(id, lang_pred, score, margin, rejected)`` of every row."""

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(dictionaries)
        for batch in batches:
            found = [classifier.predict(t.as_py()) for t in batch.column(1)]
            names = [f[0] for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(names, pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.float64()),
                    pa.array([f[0] == UNDETERMINED or f[2] < margin for f in found], pa.bool_()),
                ],
                ["id", "lang_pred", "score", "margin", "rejected"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(
        classify, f"id {id_type}, lang_pred string, score double, margin double, rejected boolean"
    )
    return found.withColumnRenamed("id", id_col)


def drop_unidentified(
    docs: DataFrame,
    training: Column | None = None,
    id_col: str = "doc_id",
    label_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without the texts that are rejected; fitted on the rows where ``training``.

    The rejected are named by id; a row with a null id stays.
    """
    labelled = docs if training is None else docs.where(training)
    dictionaries = fit_dictionaries(labelled, label_col, text_col)
    found = identify(docs, dictionaries, id_col, text_col)
    gone = found.where(F.col("rejected") & F.col(id_col).isNotNull())
    return drop_ids(docs, stage(gone.select(id_col).distinct(), "unidentified"), id_col)
